"""Pages that keep arriving: stateless steps on the stream, ids per micro-batch."""

from pyspark.sql import DataFrame, SparkSession

from pagelore.operators import corpus
from pagelore.schemas import PAGES


def page_stream(spark: SparkSession, path: str) -> DataFrame:
    """Parquet page files as they land."""
    return spark.readStream.schema(PAGES).parquet(path)


def run_available(pages: DataFrame, out: str, checkpoint: str) -> None:
    """Works through what is there and stops. A micro-batch must hold whole chapters, as ids count from 1 in each."""

    def write(batch: DataFrame, epoch: int) -> None:
        ner = corpus.entities(corpus.sentences(corpus.normalize(batch)))
        ner.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")  # the same epoch again overwrites itself

    pages.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(write).start().awaitTermination()
