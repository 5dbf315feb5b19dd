"""Tables of texts as pages, and tables written on the way."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see; one of our own only where none is set."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return found or f"{spark.conf.get('spark.sql.warehouse.dir')}/pagelore-shared"


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the shared folder, where several branches read them: nothing is held by executors."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def document_pages(documents: DataFrame) -> DataFrame:
    """documents -> pages: a source is a work, doc_id the page number."""
    return documents.select(F.col("source").alias("chap_code"), F.col("doc_id").alias("page_no"), F.col("text").alias("raw"))


def conversation_pages(conversations: DataFrame) -> DataFrame:
    return conversations.select(F.col("conv_id").cast("string").alias("chap_code"), F.col("turn").alias("page_no"), F.col("text").alias("raw"))
