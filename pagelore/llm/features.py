"""Hashed word and byte n-gram features of an Arrow text column, by position, without a Python loop over words."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelore.llm import bytehash as B

U = np.uint64
_BLANK = np.arange(256, dtype=np.uint8)
_BLANK[[*range(9, 14)]] = 32
_FOLD = _BLANK.copy()
_FOLD[65:91] += 32


def grams(own: np.ndarray, n: int) -> np.ndarray:
    """The n-byte strings (n <= 8) at each position, as integers."""
    m = max(len(own) - n + 1, 0)
    code = own[:m].astype(U)
    for j in range(1, n):
        code |= own[j : j + m].astype(U) << U(8 * j)
    return code


def slots(codes: np.ndarray, bits: int, salt: int = 0) -> np.ndarray:
    return ((codes + U(salt)) * U(0x9E3779B97F4A7C15) >> U(64 - bits)).astype(np.int64)


class Rows:
    """The texts of a batch: row r's grams of n begin in at[r]:at[r + 1] - n + 1, its words are bounds[r]:bounds[r + 1]."""

    def __init__(self, col: pa.Array, fold: bool):
        data, at = B.utf8(col)
        self.at = at - at[0]
        self.own = (_FOLD if fold else _BLANK)[data[at[0] : at[-1]]]
        _, _, self.words, self.bounds = B.words(data, at, lower=fold)
        self.n = len(col)

    def gram_slots(self, n: int, bits: int) -> np.ndarray:
        return slots(grams(self.own, n), bits, n)

    def gram_ends(self, n: int) -> np.ndarray:
        return np.maximum(self.at[1:] - n + 1, self.at[:-1])

    def word_slots(self, bits: int) -> np.ndarray:
        return (self.words >> U(64 - bits)).astype(np.int64)


def means(values: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    last = len(values)
    return (sums[np.minimum(ends, last)] - sums[np.minimum(begins, last)]) / np.maximum(ends - begins, 1)


def text_batches(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from B.pieces(batch, column, most)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, bounds: tuple[int, int], id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, dict[int, int]]:
    """((doc_id, label, text) of at most bounds[0] and bounds[1] labelled rows of class 0 and 1, the classes' sizes in all labels).

    The bound is on training rows only: those with the smallest hash of their
    id. Null labels and ids are left out.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).filter("doc_id IS NOT NULL AND label IN (0, 1)")
    sizes = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    ids = [r for k in (0, 1) for r in known.filter(F.col("label") == k).select("doc_id", "label").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(bounds[k]).collect()]
    picked = docs.sparkSession.createDataFrame(ids, "doc_id long, label int")
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return own.join(F.broadcast(picked), "doc_id"), sizes  # sum(bounds) ids at most
