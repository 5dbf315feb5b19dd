"""What the operators share: written tables, bitmaps, connected components."""

import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of the bitmaps that are sent to executors: 8 MB, whatever the input. More keys only mean more false positives.
BITS = 1 << 26


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one only where none is set (tests, local use)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        found = tempfile.mkdtemp(prefix="pagelore-")
        spark.sparkContext.setCheckpointDir(found)
    return found


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings that hold inside the block only."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: Bytes of an Arrow batch: texts are long, and a worker and the JVM hold several at once.
BATCH = 4 << 20
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded(df: DataFrame) -> DataFrame:
    """The same rows; Arrow batches of its session hold BATCH bytes at most from now on (a smaller setting stays)."""
    spark = df.sparkSession
    if not 0 < int(re.sub(r"\D", "", spark.conf.get(_BATCH_KEY)) or 0) <= BATCH:
        spark.conf.set(_BATCH_KEY, str(BATCH))
    return df


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the shared folder: cuts lineage, survives lost executors.

    The shuffles behind them are freed at once, as nothing else can read them.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/pagelore/{name}-{uuid.uuid4().hex}"
    with settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def dropped(*tables: DataFrame) -> None:
    """Deletes written tables. Only for those that nothing still to run reads."""
    for table in tables:
        jvm, conf = table.sparkSession._jvm, table.sparkSession._jsparkSession.sessionState().newHadoopConf()
        path = jvm.org.apache.hadoop.fs.Path(table.written_to)
        path.getFileSystem(conf).delete(path, True)


def sent(spark: SparkSession, value) -> Broadcast:
    context: SparkContext = spark.sparkContext
    return context.broadcast(value)


def bitmap(keys: DataFrame, key: str) -> np.ndarray:
    """uint8[BITS / 8] of the keys' low bits, built by executors in 4 KB pieces."""
    place = F.col(key).bitwiseAND(F.lit(BITS - 1))
    pieces = keys.filter(F.col(key).isNotNull()).select((place + 1).alias("p")).groupBy(F.bitmap_bucket_number("p").alias("b"))
    out = np.zeros(BITS // 8, np.uint8)
    got = pieces.agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("m")).toArrow()  # 8 MB at most
    for b, m in zip(got["b"].to_pylist(), got["m"], strict=True):
        piece = np.frombuffer(m.as_buffer(), np.uint8)
        at = (b - 1) * 4096
        out[at : at + len(piece)] = piece[: len(out) - at]
    return out


def in_bitmap(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    k = keys.astype(np.int64) & (BITS - 1)
    return (bits[k >> 3] >> (k & 7).astype(np.uint8)) & 1 == 1


def crc_mod(key: Column, m: int) -> Column:
    """crc32 of the key as text, mod m (null: the remainder of the empty text)."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % m


#: Edges that a task contracts at once.
EDGES = 1 << 18


def roots(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, the smallest node that each reaches) of a bounded list of edges, by hooking and pointer jumping."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b, up = ends[: len(u)], ends[len(u) :], np.arange(len(nodes))
    while True:
        low = np.minimum(up[a], up[b])
        np.minimum.at(up, up[a], low)
        np.minimum.at(up, up[b], low)
        while (further := up[up] != up).any():
            up[further] = up[up[further]]
        if (up[a] == up[b]).all():
            return nodes, nodes[up]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (u, v), EDGES at a time, as stars around the smallest node; what is connected stays so."""

    def star(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        u, low = roots(*(np.concatenate([b.column(i).to_numpy() for b in held]) for i in (0, 1)))
        return pa.RecordBatch.from_arrays([pa.array(u[u > low]), pa.array(low[u > low])], names=["u", "v"])

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= EDGES:
            yield star(held)
            held, size = [], 0
    if size:
        yield star(held)


def components(links: DataFrame) -> DataFrame:
    """links(a, b) -> (node, component): the smallest node of each connected component, for every node that has a link.

    Tasks contract EDGES edges each, which ends it where one task is enough.
    Else large-star and small-star steps take turns with that until nothing
    changes; a hub's edges are spread by the joins. Each round is written and
    the one before it deleted.
    """
    ends = lambda e, x, y: e.select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).filter("u > v").distinct()
    own, before, held = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v"), None, None
    while True:
        n, sums = (own if held is None else held).agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        tasks = -(-n // EDGES)
        if tasks > 1 and (n, sums) == before:
            break
        before = n, sums
        edges = written(own.coalesce(max(1, tasks)).mapInArrow(_contracted, "u long, v long"), "edges")
        if held is not None:
            dropped(held)
        if tasks <= 1:
            held = edges
            break
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("x"), F.col("m").alias("y"))
        stars = ends(large, "x", "y")
        least = stars.groupBy("u").agg(F.min("v").alias("m"))
        small = stars.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("x"), F.col("m").alias("y")), F.struct(F.col("u").alias("x"), F.col("m").alias("y")))).alias("e"))
        own = held = written(ends(small, "e.x", "e.y"), "edges")
        dropped(edges)
    stars = held.select(F.explode(F.array("u", "v")).alias("node"), F.col("v").alias("component"))
    return stars.groupBy("node").agg(F.min("component").alias("component"))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have."""
    while name.lower() in (c.lower() for c in df.columns):
        name += "_"
    return name


def without(docs: DataFrame, dropped: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """docs but the rows whose id is in dropped(doc_id). Only rows that a bitmap of the dropped ids lets through are shuffled."""
    bits = sent(docs.sparkSession, bitmap(dropped, "doc_id"))

    @F.pandas_udf("boolean")
    def maybe(ids):
        known = ids.notna()
        return known & in_bitmap(bits.value, ids.fillna(0).to_numpy())

    flag, gone_id = fresh(docs, "_maybe"), fresh(docs, "_gone")
    marked = bounded(docs).withColumn(flag, maybe(F.col(id_col).cast("long")))
    sure = marked.filter(~F.col(flag)).drop(flag)
    gone = dropped.select(F.col("doc_id").alias(gone_id))
    open_rows = marked.filter(F.col(flag)).drop(flag)
    return sure.unionAll(open_rows.join(gone, F.col(id_col).cast("long") == F.col(gone_id), "left_anti"))
