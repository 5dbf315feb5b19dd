"""A training corpus from documents: toxic documents go, one of each near-duplicate group stays, secrets are masked,
sources are mixed to target weights, and what is left is packed into sequences.

Each stage takes (spark, docs, sf_dir); its rows are written as Parquet and are the next one's docs.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelore.llm import mixing, ngram_join, packing, secrets, toxicity
from pagelore.llm.common import fresh, without, written
from pagelore.llm.queries import WEIGHTS

#: Share of the tokens that the mix keeps.
BUDGET = (9, 10)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a toxicity of 0.7 and more; the machine learns from the training rows of labels.

    Null and empty texts are scored as texts without terms; rows without an id are scored like others.
    """
    labels, name = spark.read.parquet(f"{sf_dir}/labels.parquet"), fresh(docs, "_toxicity")
    model = toxicity.fit(docs, toxicity.training_labels(labels))
    return toxicity.score(docs, model, column=name).filter(F.col(name) < toxicity.REJECT).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each component of Jaccard links; rows without an id stay.

    Rows that repeat an id count as one document, of which one whole row stays: the first by text, null texts last.
    """
    joined = written(ngram_join.join(docs).select("doc_id", "component_id"), "joined")
    ids = joined.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n"), F.min("component_id").alias("component_id"))
    kept = without(docs, written(ids.filter("doc_id != component_id").select("doc_id"), "dropped"))
    twice = written(ids.filter("doc_id = component_id AND n > 1").select("doc_id"), "twice")
    if twice.isEmpty():
        return kept
    rest = [c for c in docs.columns if c != "doc_id"]
    row = fresh(docs, "_row")
    order = F.struct(F.col("text").isNull(), "text", F.xxhash64(*rest))
    first = kept.join(twice, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by(F.struct(*rest), order).alias(row)).select("doc_id", f"{row}.*")
    return without(kept, twice).unionByName(first.select(*docs.columns))


def secret(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets in texts; every document stays. n_chars, where there is one, counts the masked text."""
    masked = secrets.redacted(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked.select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the mix uses, one epoch at most; rows without an id stay."""
    rows = mixing.light(docs)
    used = mixing.select(rows, BUDGET, WEIGHTS).select("doc_id")
    unused = rows.filter("doc_id IS NOT NULL AND tokens > 0").select("doc_id").join(used, "doc_id", "left_anti")
    return without(docs, written(unused.distinct(), "unused"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs documents into sequences of permitted lengths; a text without words, or null, has a row without a bin."""
    return packing.of_documents(docs)


STAGES = [("toxicity", toxic), ("near_duplicates", near_duplicates), ("secrets", secret), ("mixing", mixed), ("packing", packed)]
#: Learned models and sequential packing can't be told in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
