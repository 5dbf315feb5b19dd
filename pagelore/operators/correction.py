"""Correction of page texts by an injected client, with a content-keyed cache.

Each distinct missing key is asked for once per run. Replies are appended to a
journal in waves of EVERY for each task, before they are used: a lost executor
or a job that fails midway bills one wave again at most, and a new run with the
same journal asks only for what it lacks.

Differs from a page-by-page loop in one way: a client that answers None counts
as failed (``fallback_error``) and doesn't abort the run.
"""

import time
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelore.functions import correction as C
from pagelore.functions import lexicon as V
from pagelore.schemas import CACHE, REPLIES
from pagelore.sources.tables import shared_dir, staged

#: Replies of a task in one wave.
EVERY = 25


def with_retry(client, prompt: str, model: str, retries: int = 3, sleep: Callable[[float], None] = time.sleep) -> str:
    """Up to ``retries`` calls, sleeping 1, 2, 4, ... s between them; the last error is raised."""
    for attempt in range(retries):
        try:
            return client.generate(prompt, model)
        except Exception:
            if attempt == retries - 1:
                raise
            sleep(2**attempt)
    raise ValueError("retries must be 1 or more")


class Throttle:
    """At most ``rpm`` calls a minute over ``tasks`` tasks that run side by side; 0: no limit."""

    def __init__(self, rpm: int, tasks: int, clock=time.monotonic, sleep=time.sleep):
        self.gap, self.next, self.clock, self.sleep = (60.0 * tasks / rpm if rpm else 0.0), 0.0, clock, sleep

    def wait(self) -> None:
        now = self.clock()
        if self.gap and now < self.next:
            self.sleep(self.next - now)
        self.next = max(now, self.next) + self.gap


def chunks(pages: DataFrame, model: str, max_chars: int = 2500) -> DataFrame:
    """pages(chap_code, page_no, blocks) -> chunks(chap_code, page_no, chunk_no, chunk, key)."""
    cut = pages.select("chap_code", "page_no", F.posexplode(C.chunks(F.col("blocks"), max_chars)).alias("chunk_no", "chunk"))
    return cut.withColumn("key", C.cache_key(model, F.col("chunk")))


def misses(chunked: DataFrame, cache: DataFrame) -> DataFrame:
    """Distinct (key, chunk) that the cache lacks."""
    return chunked.select("key", "chunk").dropDuplicates(["key"]).join(cache, "key", "left_anti")


def ask(missing: DataFrame, make_client: Callable[[], object], model: str, rpm: int = 0, tasks: int = 8) -> DataFrame:
    """replies(key, reply, failed); the client is made once per task."""
    schema = "key string, reply string, failed boolean"

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client, throttle = make_client(), Throttle(rpm, tasks)
        for pdf in batches:
            rows = []
            for key, chunk in zip(pdf["key"], pdf["chunk"], strict=True):
                throttle.wait()
                try:
                    reply = client.generate(V.PROMPT + chunk, model)
                except Exception:
                    reply = None
                rows.append((key, reply, reply is None))
            yield pd.DataFrame(rows, columns=["key", "reply", "failed"])

    return missing.select("key", "chunk").repartition(tasks).mapInPandas(call, schema)


def journaled(spark, path: str) -> DataFrame:
    """replies(key, reply, failed) of a journal; none where there is no journal yet."""
    try:
        return spark.read.schema(REPLIES).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], REPLIES)


def ask_all(missing: DataFrame, make_client: Callable[[], object], model: str, journal: str, rpm: int = 0, tasks: int = 8, every: int = EVERY) -> DataFrame:
    """replies(key, reply, failed) for every missing key, read from the journal after the last wave.

    What an earlier run failed at is asked again; its answers are used.
    """
    spark = missing.sparkSession
    open_keys = staged(missing.join(journaled(spark, journal).filter("NOT failed").select("key"), "key", "left_anti"), "missing")
    waves = -(-open_keys.count() // (tasks * every))
    wave = F.pmod(F.xxhash64("key"), F.lit(max(1, waves)))
    for i in range(waves):
        ask(open_keys.filter(wave == i), make_client, model, rpm, tasks).write.mode("append").parquet(journal)
    told = journaled(spark, journal).join(missing.select("key"), "key", "left_semi")
    return told.groupBy("key").agg(F.min(F.struct("failed", "reply")).alias("r")).select("key", "r.reply", "r.failed")  # an answer before a failure


def resolve(chunked: DataFrame, replies: DataFrame, cache: DataFrame, max_ratio: float = 0.3) -> DataFrame:
    """corrections(chap_code, page_no, chunk_no, key, original, corrected, action).

    The first occurrence of a missing key gets the true action, later ones
    ``cache_hit``; a failed key gets ``fallback_error`` each time. All that is
    known of a key is put in one row, so that chunks meet it in one join, whose
    side of chunks Spark can split where one chunk is very common.
    """
    at = F.struct("chap_code", "page_no", "chunk_no")
    first = chunked.join(replies.select("key"), "key", "left_semi").groupBy("key").agg(F.min(at).alias("first"))
    asked = replies.join(first, "key")
    known = cache.select("key", F.col("corrected").alias("cached")).join(asked, "key", "full")
    joined = chunked.join(known, "key", "left")
    passes = C.within_guard(F.col("chunk"), F.col("reply"), max_ratio)
    fresh = F.when(passes, F.col("reply")).otherwise(F.col("chunk"))
    action = (
        F.when(F.col("cached").isNotNull() | F.col("failed").isNull(), "cache_hit").when(F.col("failed"), "fallback_error")
        .when(at != F.col("first"), "cache_hit").when(passes, "corrected").otherwise("kept_original_length_guard")
    )
    text = F.coalesce(F.col("cached"), F.when(F.col("failed"), F.col("chunk")).otherwise(fresh))
    return joined.select("chap_code", "page_no", "chunk_no", "key", F.col("chunk").alias("original"), text.alias("corrected"), action.alias("action"))


def new_entries(corrections: DataFrame) -> DataFrame:
    """What the run adds to the cache: kept originals too, errors not."""
    made = corrections.filter(F.col("action").isin("corrected", "kept_original_length_guard"))
    return made.select("key", "corrected").dropDuplicates(["key"])


def correct(pages: DataFrame, make_client, model: str, cache: DataFrame | None = None, max_ratio: float = 0.3, rpm: int = 0, journal: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(pages with corrected blocks, corrections). journal: where replies stay, for a run to go on from; a folder of this run's own by default."""
    spark = pages.sparkSession
    cache = spark.createDataFrame([], CACHE) if cache is None else cache
    chunked = staged(chunks(pages, model), "chunks")
    replies = ask_all(misses(chunked, cache), make_client, model, journal or f"{shared_dir(spark)}/replies-{uuid.uuid4().hex}", rpm)
    done = resolve(chunked, replies, cache, max_ratio)
    parts = F.transform(F.array_sort(F.collect_list(F.struct("chunk_no", "corrected"))), lambda x: x["corrected"])
    texts = done.groupBy("chap_code", "page_no").agg(F.array_join(parts, "\n").alias("text"))
    return texts.select("chap_code", "page_no", F.split("text", "\n", -1).alias("blocks")), done
