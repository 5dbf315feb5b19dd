"""The registry: each operator as a query over the driver's tables, with DuckDB SQL where SQL can express it.

The tables hold no Vietnamese, so rules for it run over fixture rows.
"""

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelore.functions import correction as C
from pagelore.functions import lexicon as V
from pagelore.functions import sentences as S
from pagelore.functions import spans, text
from pagelore.operators import chapters, corpus, correction, numbering, toc
from pagelore.schemas import CACHE, TOKEN
from pagelore.sinks import writers
from pagelore.sources.tables import conversation_pages, document_pages, read, staged

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# ---- The same steps as DuckDB expressions (RE2: no lookarounds, ASCII \s). ----


def q(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def d_sub(e: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({e}, {q(pattern)}, {q(to)}, 'g')"


WS = r"[\s\p{Z}\x{0b}\x{85}]"


def d_strip(e: str) -> str:
    return d_sub(e, f"^{WS}+|{WS}+$")


def d_fix_chars(e: str) -> str:
    hidden = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f\x{00ad}\x{feff}\x{200b}\x{200c}\x{200d}]"
    return f"replace(translate({d_sub(e, hidden)}, {q(''.join(V.ONE_TO_ONE))}, {q(''.join(V.ONE_TO_ONE.values()))}), '…', '...')"


def d_fix_tones(e: str) -> str:
    def twice(x, pattern, to):
        return d_sub(d_sub(x, pattern, to), pattern, to)

    for second in "ae":
        for a, b in zip(V.toned("o"), V.toned(second), strict=True):
            e = f"replace(replace({e}, 'o{b}', '{a}{second}'), 'O{b}', '{a.upper()}{second}')"
    for a, b in zip(V.toned("u"), V.toned("y"), strict=True):
        e = twice(twice(e, f"(^|[^qQ])u{b}", rf"\1{a}y"), f"(^|[^qQ])U{b}", rf"\1{a.upper()}y")
    for a, b in zip(V.toned("o"), V.toned("a"), strict=True):
        e = twice(e, f"{a}a([{V.CLOSING}])", rf"o{b}\1")
    return e


def d_notes(e: str) -> str:
    return reduce(lambda x, p: d_sub(x, *p), [("[®©™°]+", ""), (rf"({V.WORD})\(\d{{1,2}}\)", r"\1"), (rf"({V.WORD})\(\?+\)?", r"\1")], e)


def d_respace(e: str) -> str:
    steps = [(rf"({V.WORD})-\n({V.WORD})", r"\1\2"), (rf"{WS}*\n{WS}*", " "), (f"{WS}+", " "), (rf"{WS}+([,.;:!?)\]])", r"\1"), (rf"([(\[]){WS}+", r"\1"), (rf"([.!?,])([{V.UPPER}])", r"\1 \2")]
    return d_strip(reduce(lambda x, p: d_sub(x, *p), steps, e))


def d_lines(e: str) -> str:
    return f"regexp_split_to_array({e}, {q(r'\r\n|[\n\r\x{85}\x{2028}\x{2029}]')})"


def d_is(s: str, pattern: str) -> str:
    return f"regexp_matches({s}, {q(pattern)})"


def d_heading(s: str) -> str:
    return f"({d_is(s, V.HEADING.replace('(?U)', ''))} OR {d_is(s, V.CONTINUED.replace('(?U)', ''))})"


def d_junk(s: str) -> str:
    own = d_sub(s, f"[{V.UPPER}0-9]")
    url = r"(?i)https?://|www\.|\.com|\.vn($|[^\p{L}\p{N}_])"
    short = f"length({s}) <= 20 AND NOT {d_is(s, '[.!?:;,\"”)]$')}"
    signs = f"length({d_sub(s, r'[\p{L}\p{N}\s\p{Z}]')}) / length({s}) > 0.25"
    scraps = f"(len(list_filter(regexp_split_to_array({s}, {q(WS + '+')}), lambda t: length(t) > 3)) = 0 AND NOT {d_is(f'lower({s})', f'[{V.ACCENTED}]')})"
    return f"""CASE WHEN {s} = '' THEN 'blank' WHEN {d_is(s, V.PAGE_NUMBER.replace("(?U)", ""))} THEN 'page_number'
      WHEN {d_is(s, V.RUNNING_HEADER.replace("(?iU)", "(?i)"))} THEN 'running_header' WHEN {d_is(s, url)} THEN 'url'
      WHEN length({s}) <= 80 AND {d_is(s, r"\p{L}")} AND NOT {d_is(own, r"[\p{L}\p{N}_]")} THEN 'all_caps'
      WHEN length({s}) <= 2 AND NOT {d_is(s, r"^\p{L}+$")} THEN 'too_short'
      WHEN {short} AND (NOT {d_is(s, r"\p{L}")} OR {signs} OR {scraps}) THEN 'gibberish' END"""


MARKED = f"CASE WHEN {d_heading('s')} THEN chr(1) ELSE ln END"
NORMAL = f"""SELECT id, list_filter(list_transform(string_split(coalesce(string_agg({MARKED}, chr(10) ORDER BY k), ''), chr(1)), lambda b: {d_respace("b")}), lambda b: b <> '') AS blocks
  FROM (SELECT id, k, ln, s, {d_heading("s")} AS h, {d_junk("s")} AS j
        FROM (SELECT id, k, ln, {d_strip("ln")} AS s FROM (SELECT id, unnest(ls) AS ln, generate_subscripts(ls, 1) AS k
              FROM (SELECT id, {d_lines(d_notes(d_fix_tones(d_fix_chars("nfc_normalize(raw)"))))} AS ls FROM raw)))) WHERE h OR j IS NULL GROUP BY id"""
DOCS = f"raw AS (SELECT doc_id AS id, text AS raw FROM documents), normal AS ({NORMAL})"
SENT = rf"regexp_split_to_array(regexp_replace(b, '([.!?]+[\"''\)\]]*)[\s\p{{Z}}]+', '\1' || chr(1), 'g'), chr(1))"
SENTS = f"""{DOCS}, cut AS (SELECT id, list_filter(list_transform(flatten(list_transform(blocks, lambda b: {SENT})), lambda s: {d_strip("s")}),
  lambda s: length(s) >= 4 AND regexp_matches(s, '[a-zA-ZÀ-ỹĐđ]')) AS ss FROM normal WHERE len(blocks) > 0),
  sents AS (SELECT source AS chap_code, id AS page_no, row_number() OVER (PARTITION BY source ORDER BY id, k) AS seq, sentence
  FROM (SELECT id, unnest(ss) AS sentence, generate_subscripts(ss, 1) AS k FROM cut) JOIN documents ON doc_id = id)"""


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_pages(read(spark, sf_dir, "documents"))


def values(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def d_values(rows: list[tuple], names: str) -> str:
    cell = lambda x: "NULL" if x is None else q(x) if isinstance(x, str) else str(x)
    return "(VALUES " + ", ".join("(" + ", ".join(map(cell, r)) + ")" for r in rows) + f") AS v({names})"


# ---- Queries ----


@query(f"""SELECT source, coalesce({d_junk("s")}, 'text') AS line_class, count(*) AS n FROM (SELECT source, {d_strip("ln")} AS s
  FROM (SELECT source, unnest({d_lines(d_fix_chars("text"))}) AS ln FROM documents)) GROUP BY ALL""")
def line_classes(spark, sf_dir):
    """F8-F14, N10: lines by the first junk rule that drops them."""
    own = corpus.spread(docs(spark, sf_dir)).select("chap_code", F.explode(text.lines(text.fix_chars(F.col("raw")))).alias("ln"))
    kind = F.coalesce(text.junk_class(F.col("s")), F.lit("text")).alias("line_class")
    return own.select(F.col("chap_code").alias("source"), text.ustrip(F.col("ln")).alias("s")).select("source", kind).groupBy("source", "line_class").agg(F.count("*").alias("n"))


@query(f"SELECT doc_id, length(t) AS n, md5(t) AS h FROM (SELECT doc_id, {d_notes(d_fix_chars('text'))} AS t FROM documents)")
def char_fixes(spark, sf_dir):
    """N2, N3, N7-N9."""
    fixed = docs(spark, sf_dir).select(F.col("page_no").alias("doc_id"), text.drop_notes(text.fix_chars(F.col("raw"))).alias("t"))
    return fixed.select("doc_id", F.length("t").alias("n"), F.md5("t").alias("h"))


@query(f"SELECT doc_id, md5({d_respace('text')}) AS h FROM documents")
def spacing(spark, sf_dir):
    """N12-N18."""
    return docs(spark, sf_dir).select(F.col("page_no").alias("doc_id"), F.md5(text.respace(F.col("raw"))).alias("h"))


TONES = [(x,) for x in "hoà bình|thuỷ lợi|quý|toàn|loại|huỳnh|khuỷu|Oán|QUÝ|khoẻ khoắn|hoạ sĩ|Uý|tuỳ ý|ngoài|hoè|hoàô|hoào|hoàớ".split("|")]


@query(f"SELECT x, {d_fix_tones('x')} AS y FROM {d_values(TONES, 'x')}")
def tone_fixes(spark, sf_dir):
    """N4-N6 over fixture rows."""
    return values(spark, TONES, "x string").select("x", text.fix_tones(F.col("x")).alias("y"))


DECOMPOSED = [("Lê Thánh Tông",), ("hòa",), ("plain",), ("ệ",), ("",)]


@query(f"SELECT x, nfc_normalize(x) AS y, length(nfc_normalize(x)) AS n FROM {d_values(DECOMPOSED, 'x')}")
def nfc(spark, sf_dir):
    """N1 over fixture rows."""
    return values(spark, DECOMPOSED, "x string").select("x", text.nfc(F.col("x")).alias("y")).select("x", "y", F.length("y").cast("long").alias("n"))


@query(f"WITH {DOCS} SELECT doc_id, len(coalesce(blocks, [])) AS n_blocks, md5(array_to_string(coalesce(blocks, []), chr(10))) AS h FROM documents LEFT JOIN normal ON id = doc_id")
def page_texts(spark, sf_dir):
    """All of page normalisation (N1-N18, F6-F16, O1) over documents."""
    out = corpus.normalize(docs(spark, sf_dir)).select(F.col("page_no").alias("doc_id"), F.col("blocks").alias("b"))
    return out.select("doc_id", F.size("b").cast("long").alias("n_blocks"), F.md5(F.array_join("b", "\n")).alias("h"))


PAGES = [
    (1, "25\nLịch triều hiến chương loại chí 26\nQuyển I\nVua Lê Lợi lên ngôi.Năm ấy dựng chương-\ntrình mới\nRa go\nDƯ ĐỊA CHÍ\nxem www.abc.com"),
    (2, "Một câu dài ở trước.\nChương II\nMột câu dài ở sau."),
    (3, "tr.290 G.S. ngôi.Năm"),
    (4, "Phần thứ 3\n(Tiếp theo)\n\n12\n"),
    (5, "Trước ( sau ) nhé , thôi\r\nDòng   hai [ 1 ] Lam-\nSơn hoà thuỷ® chú(1) thích(??)"),
]


@query(f"WITH raw AS (SELECT * FROM {d_values(PAGES, 'id, raw')}), normal AS ({NORMAL}) SELECT CAST(id AS BIGINT) AS id, unnest(blocks) AS block, generate_subscripts(blocks, 1) AS block_no FROM normal")
def blocks(spark, sf_dir):
    """O1, F15, F16 over fixture pages."""
    made = values(spark, PAGES, "id long, raw string").select("id", F.posexplode(text.page_blocks(F.col("raw"))).alias("p", "block"))
    return made.select("id", "block", (F.col("p") + 1).cast("long").alias("block_no"))


MODEL = "m"
CHUNKED = f"""{DOCS}, bs AS (SELECT id, b, k, len(blocks) AS n FROM (SELECT id, blocks, unnest(blocks) AS b, generate_subscripts(blocks, 1) AS k FROM normal)),
  walk AS (SELECT id, k, n, b, 0 AS c, length(b) AS size FROM bs WHERE k = 1 UNION ALL
    SELECT bs.id, bs.k, bs.n, bs.b, CASE WHEN size + 1 + length(bs.b) > {{most}} THEN c + 1 ELSE c END, CASE WHEN size + 1 + length(bs.b) > {{most}} THEN length(bs.b) ELSE size + 1 + length(bs.b) END
    FROM walk JOIN bs ON bs.id = walk.id AND bs.k = walk.k + 1),
  chunks AS (SELECT source AS chap_code, id AS page_no, CAST(c AS BIGINT) AS chunk_no, string_agg(b, chr(10) ORDER BY k) AS chunk FROM walk JOIN documents ON doc_id = id GROUP BY ALL)"""


@query("WITH RECURSIVE " + CHUNKED.replace("{most}", "2500") + f" SELECT chap_code, page_no, chunk_no, length(chunk) AS n_chars, sha256('{MODEL}' || chr(10) || chunk) AS key FROM chunks")
def chunk_keys(spark, sf_dir):
    """O2, T2: chunks of 2500 characters and their cache keys."""
    made = correction.chunks(corpus.normalize(docs(spark, sf_dir)), MODEL)
    return made.select("chap_code", "page_no", F.col("chunk_no").cast("long").alias("chunk_no"), F.length("chunk").alias("n_chars"), "key")


BLOCK_LISTS = [(1, "aaa\nbbb\nccc\nddd", 8), (2, "short\n" + "x" * 30, 10), (3, "   \n  \n", 2500), (4, "a\nb\n\nc", 3)]


@query("SELECT CAST(id AS BIGINT) AS id, CAST(k AS INTEGER) AS chunk_no, chunk FROM " + d_values([(1, 0, "aaa\nbbb"), (1, 1, "ccc\nddd"), (2, 0, "short"), (2, 1, "x" * 30), (4, 0, "a\nb"), (4, 1, "c")], "id, k, chunk"))
def chunk_fixtures(spark, sf_dir):
    """O2 on the shapes of small pages."""
    made = [values(spark, [r], "id long, t string, n int").select("id", F.posexplode(C.chunks(F.split("t", "\n", -1), r[2])).alias("chunk_no", "chunk")) for r in BLOCK_LISTS]
    return reduce(DataFrame.unionAll, made)


GUARDS = [("Viet Nam ta", "Việt Nam ta"), ("x" * 100, "x" * 50), ("abc", "   "), ("0123456789", "0123456789abc"), ("", "a"), ("0123456789", "0123456789abcd")]


@query(f"""SELECT a, b, trim(b) <> '' AND abs(length(b) - length(a)) / greatest(length(a), 1) <= 0.3 AS ok FROM {d_values(GUARDS, "a, b")}""")
def length_guard(spark, sf_dir):
    """F19."""
    return values(spark, GUARDS, "a string, b string").withColumn("ok", C.within_guard(F.col("a"), F.col("b")))


class DemoClient:
    """A fixed client for queries and tests: fails on one word, answers far too short on another, else replaces a word."""

    def generate(self, prompt: str, model: str) -> str:
        chunk = prompt[len(V.PROMPT) :]
        if "idiot" in chunk:
            raise RuntimeError("refused")
        return "x" if "scum" in chunk else chunk.replace(" the ", " THE ")


KNOWN = "chunk LIKE '%a%' AND length(chunk) % 7 = 0"


@query("WITH RECURSIVE " + CHUNKED.replace("{most}", "800") + f""", keyed AS (SELECT *, {KNOWN} AS hit, chunk LIKE '%idiot%' AS bad, replace(chunk, ' the ', ' THE ') AS fixed,
  row_number() OVER (PARTITION BY chunk ORDER BY chap_code, page_no, chunk_no) AS nth FROM chunks)
  SELECT chap_code, page_no, chunk_no, md5(CASE WHEN hit THEN 'K:' || chunk WHEN bad OR chunk LIKE '%scum%' AND length(chunk) > 1 THEN chunk ELSE fixed END) AS corrected_md5,
  CASE WHEN hit THEN 'cache_hit' WHEN bad THEN 'fallback_error' WHEN nth > 1 THEN 'cache_hit' WHEN chunk LIKE '%scum%' THEN 'kept_original_length_guard' ELSE 'corrected' END AS action FROM keyed""")
def cache_join(spark, sf_dir):
    """J1-J3, O4 with a fixed client and a prepared cache over documents."""
    chunked = staged(correction.chunks(corpus.normalize(docs(spark, sf_dir)), MODEL, 800), "chunks")  # four branches read it
    cache = chunked.filter(KNOWN).select("key", F.concat(F.lit("K:"), "chunk").alias("corrected")).dropDuplicates(["key"])
    replies = staged(correction.ask(correction.misses(chunked, cache), DemoClient, MODEL, tasks=max(8, spark.sparkContext.defaultParallelism)), "replies")  # each key is asked for once
    done = correction.resolve(chunked, replies, cache)
    return done.select("chap_code", "page_no", F.col("chunk_no").cast("long").alias("chunk_no"), F.md5("corrected").alias("corrected_md5"), "action")


ID = "CASE WHEN seq < 1000000 THEN chap_code || '_' || lpad(CAST(seq AS VARCHAR), 6, '0') ELSE chap_code || '_' || seq END"


@query(f"WITH {SENTS} SELECT chap_code, page_no, {ID} AS sentence_id, sentence FROM sents")
def sentences(spark, sf_dir):
    """T1 (own splitter), F17, F18, W3, T4 over documents."""
    return corpus.sentences(corpus.normalize(docs(spark, sf_dir))).select("chap_code", "page_no", "sentence_id", "sentence")


@query(f"WITH {SENTS} SELECT {ID} AS sentence_id, sentence FROM sents WHERE seq <= 10")
def first_sentences(spark, sf_dir):
    """B2: the first ten sentences of each work."""
    return corpus.sentences(corpus.normalize(docs(spark, sf_dir)), limit=10).select("sentence_id", "sentence")


@query(f"WITH {SENTS} SELECT {ID} || chr(9) || sentence AS value FROM sents")
def sentence_lines(spark, sf_dir):
    """K1: the lines of the TSV files."""
    return corpus.sentences(corpus.normalize(docs(spark, sf_dir))).select(writers.tsv_line().alias("value"))


@query(f"WITH {SENTS.replace('SELECT doc_id AS id, text AS raw FROM documents', "SELECT conv_id * 1000 + turn AS id, text AS raw FROM conversations").replace('JOIN documents ON doc_id = id', "JOIN (SELECT conv_id * 1000 + turn AS cid, CAST(conv_id AS VARCHAR) AS source FROM conversations) ON cid = id")} SELECT chap_code, count(*) AS n_sentences FROM sents GROUP BY ALL")
def conversation_sentences(spark, sf_dir):
    """A1 over conversations as works of one page a turn."""
    own = corpus.sentences(corpus.normalize(conversation_pages(read(spark, sf_dir, "conversations"))))
    return own.groupBy("chap_code").agg(F.count("*").alias("n_sentences"))


NUMBER = rf"(?:^|[^\p{{L}}\p{{N}}_])(\d+(?:(?:\.\.|,,)\d+)*(?:\s+(?:{V.UNITS})(?:$|[^\p{{L}}\p{{N}}_]))?)"
DOUBLED = d_sub("sentence", r"([^\p{L}\p{N}_])", r"\1\1")
EDGES = " ,.;:!?()[]\"'-"


@query(f"""WITH {SENTS} SELECT sentence_id, m AS number FROM (SELECT sentence_id, unnest(list_transform(regexp_extract_all(d, {q(NUMBER)}, 1),
  lambda x: replace(replace(replace(trim(x, {q(EDGES)}), '  ', ' '), ',,', ','), '..', '.'))) AS m FROM (SELECT {ID} AS sentence_id, {DOUBLED} AS d FROM sents))""")
def numbers(spark, sf_dir):
    """E22, T7: number spans of each sentence."""
    own = corpus.sentences(corpus.normalize(docs(spark, sf_dir)))
    seq, (label, pattern) = len(V.rules()), V.rules()[-1]
    found = spans.entities(F.col("sentence"), spans.find(F.col("sentence"), pattern, label, seq))
    return own.select("sentence_id", F.explode(found).alias("e")).select("sentence_id", F.col("e.text").alias("number"))


GOLDEN = {
    "Năm 1428, vua Lê Thái Tổ lên ngôi ở Thăng Long.": [("Năm 1428", "TME"), ("vua", "TITLE"), ("Lê Thái Tổ", "PER"), ("Thăng Long", "LOC")],
    "đời vua Lê Thánh Tông năm Hồng Đức thứ 2, nhà Lê đánh nước Chiêm Thành.": [("đời vua Lê Thánh Tông", "TME"), ("năm Hồng Đức thứ 2", "TME"), ("nhà Lê", "DYNASTY"), ("nước Chiêm Thành", "LOC")],
    "Quan lang dẫn 3 vạn người qua sông Bạch Đằng ngày 2-9-1945.": [("Quan lang", "TITLE"), ("3 vạn", "NUM"), ("sông Bạch Đằng", "LOC"), ("ngày 2-9-1945", "TME")],
    "tỉnh Viện Khảo cổ học": [("tỉnh Viện Khảo", "LOC")],
    "Theo Viện Khảo cổ học, Âu-Lạc mất năm 179 TCN.": [("Viện Khảo cổ học", "ORG"), ("Âu-Lạc", "LOC"), ("năm 179 TCN", "TME")],
    "mùa xuân, giờ Tý, tháng giêng nhuận": [("mùa xuân", "TME"), ("giờ Tý", "TME"), ("tháng giêng nhuận", "TME")],
    "ngày mồng 5 tháng 3": [("ngày mồng 5", "TME"), ("tháng 3", "TME")],
    "Khoảng 207 TCN, họ Triệu Đà chiếm Âu Lạc.": [("207 TCN", "TME"), ("Triệu Đà", "PER"), ("Âu Lạc", "LOC")],
    "niên hiệu Hồng Đức thứ 3": [("niên hiệu Hồng Đức thứ 3", "TME")],
    "thế kỷ thứ XV trước Công nguyên": [("thế kỷ thứ XV trước Công nguyên", "TME")],
    "sơ kỳ thời đại đồng thau": [("sơ kỳ thời đại đồng thau", "TME")],
    "ông Nguyễn Văn Tố đến": [("Nguyễn Văn Tố", "PER")],
    "": [],
}
GOLDEN_ROWS = [(s, i, *e) for s, es in GOLDEN.items() for i, e in enumerate(es)]


def _golden(spark):
    own = values(spark, [(s,) for s in GOLDEN], "sentence string").withColumn("entities", spans.extract(F.col("sentence")))
    return own.select("sentence", F.posexplode("entities").alias("pos", "e")).select("sentence", "pos", F.col("e.text").alias("entity"), F.col("e.label").alias("label"))


@query(f"SELECT sentence, CAST(pos AS INTEGER) AS pos, entity, label FROM {d_values(GOLDEN_ROWS, 'sentence, pos, entity, label')}")
def rule_entities(spark, sf_dir):
    """E1-E22, O3, F21, T7 on golden sentences."""
    return _golden(spark)


@query(f"SELECT label, count(*) AS n FROM {d_values(GOLDEN_ROWS, 'sentence, pos, entity, label')} GROUP BY ALL")
def label_counts(spark, sf_dir):
    """A1, A2 on golden sentences."""
    return _golden(spark).groupBy("label").agg(F.count("*").alias("n"))


def _record(sentence: str, found: list[tuple[str, str]]) -> str:
    return json.dumps({"sentence": sentence, "entities": [{"text": t, "label": k} for t, k in found]}, ensure_ascii=False, separators=(",", ":"))


@query(f"SELECT * FROM {d_values([(_record(s, es),) for s, es in GOLDEN.items()], 'record')}")
def entity_records(spark, sf_dir):
    """K2, P1: the records of golden sentences as JSON."""
    own = values(spark, [(s,) for s in GOLDEN], "sentence string").withColumn("entities", spans.extract(F.col("sentence")))
    return own.select(F.to_json(F.struct("sentence", "entities")).alias("record"))


TAGGED = [
    ("Ông Nam ở Hà Nội năm 1945", [("Ông", "O"), ("Nam", "B-PER"), ("ở", "O"), ("Hà", "B-LOC"), ("Nội", "I-LOC"), ("năm", "O"), ("1945", "O")]),
    ("về Thăng Long", [("về", "O"), ("Thăng", "B-PER"), ("Long", "I-PER")]),
]
TAGGED_ROWS = [("Ông Nam ở Hà Nội năm 1945", 0, "Nam", "PER"), ("Ông Nam ở Hà Nội năm 1945", 1, "Hà Nội", "LOC"), ("Ông Nam ở Hà Nội năm 1945", 2, "năm 1945", "TME"), ("về Thăng Long", 0, "Thăng Long", "LOC")]


@query(f"SELECT sentence, CAST(pos AS INTEGER) AS pos, entity, label FROM {d_values(TAGGED_ROWS, 'sentence, pos, entity, label')}")
def model_and_rules(spark, sf_dir):
    """U1: a model's spans and the rules' together; a known name keeps its label."""
    own = spark.createDataFrame(TAGGED, "sentence string, tokens " + TOKEN.simpleString())
    found = own.withColumn("entities", spans.extract(F.col("sentence"), F.col("tokens")))
    return found.select("sentence", F.posexplode("entities").alias("pos", "e")).select("sentence", "pos", F.col("e.text").alias("entity"), F.col("e.label").alias("label"))


CANDIDATES = [(0, 3, 2), (4, 17, 6), (4, 17, 3), (9, 30, 0), (17, 18, 7), (17, 20, 7)]


@query(f"SELECT * FROM {d_values([(0, 3, 2), (4, 17, 3), (17, 20, 7)], 'st, en, prio')}")
def span_resolution(spark, sf_dir):
    """O3 on candidate spans."""
    span = F.array(*(F.struct(F.lit(a).alias("st"), F.lit(b).alias("en"), F.lit(p).alias("prio"), F.lit(i).alias("seq"), F.lit("x").alias("label")) for i, (a, b, p) in enumerate(CANDIDATES)))
    return spark.range(1).select(F.explode(spans.resolve(span)).alias("s")).select("s.st", "s.en", "s.prio")


TOKENS = [("Ông Nam ở Hà Nội nhé", [("Ông", "O"), ("Nam", "B-PER"), ("ở", "O"), ("Hà", "B-LOC"), ("zz", "I-LOC"), ("Nội", "I-LOC"), ("nhé", "I-PER")]), ("Sao Mai", [("Sao", "B-MISC"), ("Mai", "I-PER")])]


@query(f"SELECT * FROM {d_values([('Ông Nam ở Hà Nội nhé', 4, 7, 'PER'), ('Ông Nam ở Hà Nội nhé', 10, 16, 'LOC')], 'sentence, st, en, label')}")
def bio_merge(spark, sf_dir):
    """E23, F20: a model's tokens to spans."""
    own = spark.createDataFrame(TOKENS, "sentence string, tokens " + TOKEN.simpleString())
    return own.select("sentence", F.explode(spans.merge_bio(F.col("sentence"), F.col("tokens"))).alias("s")).select("sentence", "s.st", "s.en", "s.label")


@query()
def entities(spark, sf_dir):
    """The whole chain over documents: normalise, split, number, extract (E1-E22, O3, W3)."""
    return corpus.entities(corpus.sentences(corpus.normalize(docs(spark, sf_dir)))).select("chap_code", "sentence_id", "sentence", "entities")


@query()
def work_summary(spark, sf_dir):
    """A2, K6: sentences and entities of each work."""
    return corpus.summary(corpus.entities(corpus.sentences(corpus.normalize(docs(spark, sf_dir)))))


MARKS = [
    ("a", 1, "Bìa", 1, 30), ("a", 1, "I. A", 3, 30), ("a", 2, "I.1", 5, 30), ("a", 1, "Phụ lục", 10, 30), ("a", 1, "II. B", 12, 30), ("a", 1, " Mục lục ", 25, 30),
    ("b", 1, "Lời nói đầu", 1, 9), ("c", 1, "Chương 1", 1, 8), ("c", 1, "Chương 2", 4, 8), ("d", 1, "Sách", 1, 5),
]
BOOKS = [("a", 30), ("b", 9), ("c", 8), ("d", 5), ("e", 77)]


@query(f"SELECT * FROM {d_values([('a', 3, 24), ('b', 1, 9), ('c', 1, 8), ('d', 1, 5), ('e', 1, 77)], 'chap_code, start_page, end_page')}")
def content_range(spark, sf_dir):
    """C1, F2-F5, W1, W2 on fixture bookmarks."""
    marks = values(spark, MARKS, "chap_code string, lvl int, title string, page int, total int")
    return toc.content_range(values(spark, BOOKS, "chap_code string, total int"), marks)


@query(f"SELECT * FROM {d_values([('a', 5, 24), ('b', 5, 9), ('c', 5, 8), ('d', 5, 5), ('e', 5, 77)], 'chap_code, start_page, end_page')}")
def page_ranges(spark, sf_dir):
    """a start page given by hand, an end page of 0 that counts as unset."""
    return toc.page_range(content_range(spark, sf_dir), 5, 0)


FILES = [("x", "in/x/x_tap_1_ocr.pdf"), ("x", "in/x/x_tap_2_ocr.pdf"), ("y", "in/y/a1.pdf"), ("y", "in/y/b.pdf"), ("z", "in/z/v2_1.pdf"), ("z", "in/z/w3_1.pdf"), ("one", "in/one/book 7.pdf")]
FILE_CODES = [("x", "in/x/x_tap_1_ocr.pdf", 1, "x_01"), ("x", "in/x/x_tap_2_ocr.pdf", 2, "x_02"), ("y", "in/y/a1.pdf", 1, "y_01"), ("y", "in/y/b.pdf", 2, "y_02"), ("z", "in/z/v2_1.pdf", 1, "z_01"), ("z", "in/z/w3_1.pdf", 2, "z_02"), ("one", "in/one/book 7.pdf", 7, "one")]


@query(f"SELECT code, pdf_path, CAST(num AS BIGINT) AS num, chap_code FROM {d_values(FILE_CODES, 'code, pdf_path, num, chap_code')}")
def chapter_codes(spark, sf_dir):
    """T5, T6, W4, A3 on fixture files."""
    return chapters.chapter_numbers(values(spark, FILES, "code string, pdf_path string"))


@query("SELECT * FROM " + d_values([("HVQ_036", 7, "HVQ_036_000007"), ("HVQ_036", 1234567, "HVQ_036_1234567")], "code, seq, id"))
def sentence_ids(spark, sf_dir):
    """T4, also beyond six digits."""
    own = values(spark, [("HVQ_036", 7), ("HVQ_036", 1234567)], "code string, seq int")
    return own.withColumn("id", numbering.sentence_id(F.col("code"), F.col("seq")))
