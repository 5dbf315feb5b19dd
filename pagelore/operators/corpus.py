"""pages(chap_code, page_no, raw) -> sentences -> entities; narrow but for the numbering."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelore.functions import sentences as S
from pagelore.functions import spans, text
from pagelore.operators import numbering


def spread(pages: DataFrame) -> DataFrame:
    """Deals few input splits out over all cores before the regex work; large inputs have splits enough and stay."""
    cores = pages.sparkSession.sparkContext.defaultParallelism
    return pages.repartition(cores) if pages.rdd.getNumPartitions() < cores else pages


def normalize(pages: DataFrame) -> DataFrame:
    """Pages with ``blocks`` for their raw texts. An empty page has none and so gives no chunk or sentence; a filter on
    the derived array would make Spark compute it twice."""
    return spread(pages).select("chap_code", "page_no", text.page_blocks(F.col("raw")).alias("blocks"))


def sentences(normal: DataFrame, limit: int = 0, cutter: Callable[[Column], Column] | None = None) -> DataFrame:
    """sentences(chap_code, page_no, seq, sentence_id, sentence); cutter is a model's UDF array<string> -> array<string>."""
    cut = S.of_blocks(F.col("blocks")) if cutter is None else S.by_model(F.col("blocks"), cutter)
    split = normal.select("chap_code", "page_no", cut.alias("_sents"))
    numbered = numbering.explode_numbered(split, "chap_code", "page_no", "_sents", "sentence", limit)
    return numbered.select("chap_code", "page_no", "seq", numbering.sentence_id(F.col("chap_code"), F.col("seq")).alias("sentence_id"), "sentence")


def entities(sents: DataFrame, tokens: Callable[[Column], Column] | None = None) -> DataFrame:
    """Adds ``entities``; tokens is a model's UDF string -> array<(word, tag)>, whose failure means no tokens."""
    found = spans.extract(F.col("sentence")) if tokens is None else spans.extract(F.col("sentence"), F.col("_tokens"))
    given = sents if tokens is None else sents.withColumn("_tokens", F.coalesce(tokens(F.col("sentence")), F.array()))
    return given.withColumn("entities", found).drop("_tokens")


def progress(ner: DataFrame, seconds: float) -> str:
    """Totals and rates of a run, in one line."""
    n, found = ner.agg(F.count("*"), F.coalesce(F.sum(F.size("entities")), F.lit(0))).first()
    return f"{n} sentences, {found} entities in {seconds:.1f} s ({n / max(seconds, 1e-9):.0f} sentences/s)"


def summary(ner: DataFrame) -> DataFrame:
    """Sentences and entities of each work."""
    return ner.groupBy("chap_code").agg(F.count("*").alias("n_sentences"), F.sum(F.size("entities")).alias("n_entities"))
