"""The correction cache: a JSON object on disk, or a Parquet table."""

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from pagelore.schemas import CACHE


def load_json(spark: SparkSession, path: str) -> DataFrame:
    """cache(key, corrected) of one JSON object; a missing or malformed file is an empty cache."""
    try:
        text = spark.read.text(path, wholetext=True)
    except AnalysisException:
        return spark.createDataFrame([], CACHE)
    entries = F.explode(F.from_json("value", "map<string,string>")).alias("key", "corrected")
    return text.select(entries).filter(F.col("corrected").isNotNull())


def save_json(cache: DataFrame, path: str) -> None:
    """One JSON object, for tools that expect it; rows stream to the driver one partition at a time."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    made = Path(f"{path}.new")  # the rows may come from the old file
    with made.open("w", encoding="utf-8") as f:
        f.write("{")
        for i, r in enumerate(cache.toLocalIterator()):
            f.write(("," if i else "") + f"\n  {json.dumps(r.key, ensure_ascii=False)}: {json.dumps(r.corrected, ensure_ascii=False)}")
        f.write("\n}")
    made.replace(path)


def load_table(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(CACHE).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], CACHE)


def known(spark: SparkSession, folder: str) -> DataFrame:
    """The table in a cache folder, with a JSON object of an earlier tool beside it (``gemini.json``); the table goes first."""
    table = load_table(spark, f"{folder}/corrected").dropDuplicates(["key"])
    old = load_json(spark, f"{folder}/gemini.json")
    return table.unionByName(old.join(table.select("key"), "key", "left_anti"))


def append_table(entries: DataFrame, path: str) -> None:
    entries.select("key", "corrected").write.mode("append").parquet(path)
