"""Each stage of the pipeline on nulls, repeated rows, ties, empty tables, a very long text and clashing column names; then all of them."""

import random

import pytest

import corpus_pipeline


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _maybe string, _toxicity string, _gone int, _row string, key string"
TOKEN = "f3a91b7c0de24586a9b7c1d2e3f40516"
BASE = " ".join(f"word{i}" for i in range(60))


def rows():
    rng = random.Random(6)
    plain = [f"w{i}" for i in range(400)]
    own = [(i, " ".join(rng.choice(plain) for _ in range(rng.randrange(20, 90))), "en", f"src{i % 3}") for i in range(200)]
    own = [(d, t + " you vile scum" if d % 4 == 0 else t, lang, source) for d, t, lang, source in own]
    own += [(300, BASE, "en", "src1"), (301, BASE, "en", "src1"), (302, BASE + " more", "en", "src2"), (303, f'api_key = "{TOKEN}"', "fr", "src1")]
    own += [(None, "no id", None, None), (None, "no id", None, None), (400, None, "en", "src1"), (401, "", None, "src2"), (402, "one two three four five six", "de", None)]
    own += [own[5], own[5], (403, "long " * 60_000, "en", "src0"), (404, None, None, None), (404, "kept of two", "en", "src1")]
    return [(*r, len(r[1]) if r[1] is not None else None, "m", "t", 7, "r", "k") for r in own]


@pytest.fixture(scope="module")
def place(spark, tmp_path_factory):
    to = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows(), SCHEMA).write.parquet(str(to / "documents.parquet"))
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(200)], "doc_id long, quality int, toxic int").write.parquet(str(to / "labels.parquet"))
    return str(to)


def counted(got):
    return sorted((str(r.doc_id), str(r.text)) for r in got)


@pytest.mark.parametrize("stage", range(4))
def test_stage_keeps_columns_and_clean_rows(spark, place, stage):
    name, run = corpus_pipeline.STAGES[stage]
    docs = spark.read.parquet(f"{place}/documents.parquet")
    out = run(spark, docs, place)
    assert out.columns == docs.columns and [t for _, t in out.dtypes] == [t for _, t in docs.dtypes]
    got, had = out.collect(), docs.collect()
    ids = [r.doc_id for r in got]
    if name == "toxicity":
        assert counted(got) == counted(r for r in had if "vile scum" not in (r.text or ""))
    elif name == "near_duplicates":
        assert {300, 303, 400, 401, 403, 404} <= set(ids) and not {301, 302} & set(ids)
        assert ids.count(None) == 2 and len(set(ids)) == len(ids) - 1
        assert [(r.text, r.lang, r.key) for r in got if r.doc_id == 404] == [("kept of two", "en", "k")]
    elif name == "secrets":
        masked = next(r for r in got if r.doc_id == 303)
        assert masked.text == 'api_key = "[SECRET]"' and masked.n_chars == len(masked.text)
        assert counted(r for r in got if r.doc_id != 303) == counted(r for r in had if r.doc_id != 303)
    else:
        assert set(counted(got)) <= set(counted(had)) and ids.count(None) == 2 and 0 < len(got) <= len(had)
    assert run(spark, docs.limit(0), place).collect() == []


def test_packing(spark, place):
    got = corpus_pipeline.packed(spark, spark.read.parquet(f"{place}/documents.parquet"), place).collect()
    assert sum(r.n_tokens for r in got if r.doc_id == 403) == 60_000 and {r.bin_id for r in got if r.doc_id in (400, 401)} == {None}
    assert corpus_pipeline.packed(spark, spark.createDataFrame([], SCHEMA), place).collect() == []


def test_secrets_without_a_count(spark):
    docs = spark.createDataFrame([(1, f'api_key = "{TOKEN}"')], "doc_id long, text string")
    assert corpus_pipeline.secret(spark, docs, "").collect() == [(1, 'api_key = "[SECRET]"')]


def test_run(spark, place):
    """The last stage's rows are the stages one after the other; toxic documents and copies aren't among them."""
    got = corpus_pipeline.run(spark, place).collect()
    ids = {r.doc_id for r in got}
    assert not ids & {0, 4, 8, 301, 302} and 300 in ids and corpus_pipeline.ORACLE_SQL is None
    docs = spark.read.parquet(f"{place}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, place)
    assert sorted(map(str, docs.collect())) == sorted(map(str, got))
