"""The queries of this subpackage, with DuckDB SQL where SQL can express them."""

from pyspark.sql import DataFrame, SparkSession

from pagelore.llm import language, mixing, multiset, ngram_join, packing, quality, quoting, repeats, secrets, toxicity

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
JACCARD = rf"""WITH RECURSIVE ws AS MATERIALIZED (SELECT doc_id, regexp_extract_all({LOWERED}, '[^\x20\x09-\x0D]+') AS w FROM documents),
  sets AS MATERIALIZED (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM ws),
  items AS MATERIALIZED (SELECT doc_id, unnest(s) AS g FROM sets),
  common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM items a JOIN items b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
  links AS MATERIALIZED (SELECT a, b FROM common JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b WHERE 100 * n >= 75 * (len(x.s) + len(y.s) - n)),
  ends AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
  reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, e.b FROM reach r JOIN ends e ON e.a = r.other)"""


@query(JACCARD + " SELECT r.doc_id, CAST(any_value(len(s)) AS BIGINT) AS n_shingles, min(other) AS component_id FROM reach r JOIN sets USING (doc_id) GROUP BY r.doc_id")
def op1_ngram_join(spark, sf_dir):
    """Documents by n-gram Jaccard links of 0.75 and more over shingles of five words."""
    return ngram_join.join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


WEIGHTS = {"domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1}, "lang": {"en": 3, "fr": 1, "de": 1, "es": 2}}


def _level(name: str, parents: list[str], weight: str, above: str | None) -> str:
    """One level of water-filling in SQL: children up to the last that fills up, the rest by weight."""
    cols, part = ", ".join([*parents, name]), f"PARTITION BY {', '.join(parents)}" if parents else ""
    budget = f"JOIN {above} USING ({', '.join(parents)})" if above else "CROSS JOIN (SELECT CAST(sum(tokens) AS BIGINT) * 4 // 5 AS budget FROM leaves)"
    return f"""{name}_n AS (SELECT {cols}, CAST(sum(room) AS BIGINT) AS room, {weight} AS weight FROM leaves GROUP BY {cols}),
  {name}_f AS (SELECT *, room::HUGEINT * sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
      <= (budget - coalesce(sum(room) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * weight AS filled
    FROM {name}_n {budget} WINDOW o AS ({part} ORDER BY room / weight, {name})),
  {name}_s AS (SELECT {cols}, CAST(CASE WHEN filled THEN room ELSE (budget - sum(CASE WHEN filled THEN room ELSE 0 END) OVER (w))::HUGEINT * weight
      // greatest(1, sum(CASE WHEN filled THEN 0 ELSE weight END) OVER (w)) END AS BIGINT) AS budget FROM {name}_f WINDOW w AS ({part}))"""


def _case(name: str) -> str:
    return f"CASE {name} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in WEIGHTS[name].items()) + " ELSE 1 END"


MIX = rf"""WITH src AS (SELECT *, coalesce(source, '') AS s FROM documents),
  light AS MATERIALIZED (SELECT doc_id, CASE WHEN regexp_extract(s, '(\d+)$', 1) = '' THEN 'other' ELSE 'd' || (CAST(regexp_extract(s, '(\d+)$', 1) AS BIGINT) % 4) END AS domain,
    coalesce(lang, 'und') AS lang, s AS source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens FROM src),
  leaves AS (SELECT domain, lang, source, CAST(sum(tokens) AS BIGINT) AS tokens, CAST(sum(tokens) * 2 AS BIGINT) AS room FROM light GROUP BY ALL),
  {_level("domain", [], _case("domain"), None)},
  {_level("lang", ["domain"], _case("lang"), "domain_s")},
  {_level("source", ["domain", "lang"], "1", "lang_s")},
  plan AS (SELECT domain, lang, source, coalesce(budget // nullif(tokens, 0), 0) AS whole, budget - coalesce(budget // nullif(tokens, 0), 0) * tokens AS rest FROM leaves JOIN source_s USING (domain, lang, source)),
  own AS (SELECT * FROM light JOIN plan USING (domain, lang, source)),
  begun AS (SELECT *, coalesce(sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5('7:' || whole || ':' || doc_id), doc_id, tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
    FROM own WHERE rest > 0)
  SELECT doc_id, domain, lang, source, CAST(epoch AS INTEGER) AS epoch, CAST(taken AS BIGINT) AS taken FROM (
    SELECT doc_id, domain, lang, source, unnest(range(CAST(whole AS BIGINT))) AS epoch, tokens AS taken FROM own
    UNION ALL SELECT doc_id, domain, lang, source, whole, least(tokens, rest - start) FROM begun WHERE start < rest)"""


@query(MIX)
def op2_mixing(spark, sf_dir):
    """Uses of documents under a budget of four fifths of all tokens, two epochs at most, by weights of domains and languages."""
    return mixing.mix(table(spark, sf_dir, "documents"), (4, 5), WEIGHTS, max_epochs=2)


@query()
def op4_fingerprints(spark, sf_dir):
    """Multiset fingerprints of documents and of their edited texts."""
    return multiset.fingerprints(table(spark, sf_dir, "documents"))


@query()
def op8_packing(spark, sf_dir):
    """Documents packed into sequences of 256 to 4096 words."""
    return packing.of_documents(table(spark, sf_dir, "documents"))


@query()
def op9_quotes(spark, sf_dir):
    """Conversations without quotes, ordered by replies."""
    return quoting.conversations(table(spark, sf_dir, "conversations"))


@query()
def op5_quality(spark, sf_dir):
    """Documents by base counts and a calibrated n-gram regression trained on labels.quality."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.score(docs, quality.fit(docs, labels))


@query()
def op7_toxicity(spark, sf_dir):
    """Documents by a factorization machine trained on labels.toxic."""
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op10_language(spark, sf_dir):
    """Languages of documents by bit-sliced Bloom filters."""
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language.learn(docs))


@query()
def op3_repeats(spark, sf_dir):
    """Documents without the bytes that a repeated string of 400 bytes covers."""
    return repeats.remove(table(spark, sf_dir, "documents"))


@query()
def op6_secrets(spark, sf_dir):
    """Secrets in documents, false positives removed."""
    return secrets.findings(table(spark, sf_dir, "documents"))


@query()
def pipeline(spark, sf_dir):
    """The stages of corpus_pipeline.py."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
