"""Variable-capacity best-fit packing into several permitted sequence lengths.

Documents are dealt to shards of bounded expected size by a hash of their id;
each shard is packed on its own by best-fit decreasing. A new bin gets the
length whose cost for the tokens it can hope to hold (the item and what is
still to come that fits beside it) is least; at the end each bin shrinks to
the smallest permitted length that holds its contents.
"""

from bisect import bisect_left, insort
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelore.llm.common import written
from pagelore.llm.mixing import WORD

LENGTHS = (256, 512, 1024, 2048, 4096)
SHARD = 4096
SCHEMA = "doc_id long, piece int, n_tokens long, bin_id string, bin_size int, bin_offset int"


def cost(length: int) -> float:
    """Default cost of a sequence: a fixed part, its tokens, and attention that grows with the square."""
    return 16 + length + length * length / 32768


def pack(sizes: list[int], lengths=LENGTHS, price: Callable[[int], float] = cost) -> tuple[list[tuple[int, int]], list[int]]:
    """Sizes (1 to the largest length) -> ((bin, offset) of each size, length of each bin)."""
    lengths = sorted(lengths)
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    falling = np.array([-sizes[i] for i in order])
    left = np.concatenate((np.cumsum(-falling[::-1])[::-1], [0])) if order else np.zeros(1)
    gaps: list[tuple[int, int]] = []  # (free, bin), sorted
    used: list[int] = []
    placed: list[tuple[int, int]] = [(0, 0)] * len(sizes)
    for at, i in enumerate(order):
        size = sizes[i]
        k = bisect_left(gaps, (size, -1))
        if k < len(gaps):
            free, b = gaps.pop(k)
        else:

            def each(length: int) -> float:
                room = length - size
                to_come = int(left[max(at + 1, int(np.searchsorted(falling, -room)))])
                return price(length) / (size + min(room, to_come))

            free, b = min(lengths[bisect_left(lengths, size) :], key=lambda x: (each(x), x)), len(used)
            used.append(0)
        placed[i] = (b, used[b])
        used[b] += size
        if free > size:
            insort(gaps, (free - size, b))
    return placed, [lengths[bisect_left(lengths, u)] for u in used]


def best_fit(sized: DataFrame, lengths=LENGTHS, price: Callable[[int], float] = cost) -> DataFrame:
    """sized(doc_id, n_tokens) -> a row per piece with its bin.

    A document longer than the largest length is cut into pieces of that length
    and a rest. Documents without tokens have one row with null bin columns.
    Rows that share a doc_id share a shard.
    """
    sized = written(sized.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n_tokens")), "sized")
    most = max(lengths)
    shards = max(1, -(-sized.count() // SHARD))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n_tokens", "doc_id"], kind="stable")
        rows = [(d, k, min(most, n - k * most)) for d, n in zip(pdf["doc_id"], pdf["n_tokens"], strict=True) for k in range(max(1, -(-n // most)))]
        filled = [r for r in rows if r[2]]
        placed, sizes = pack([int(r[2]) for r in filled], lengths, price)
        name = f"{int(pdf['shard'].iloc[0])}-"
        out = [(*r, name + str(b), sizes[b], at) for r, (b, at) in zip(filled, placed, strict=True)] + [(*r, None, None, None) for r in rows if not r[2]]
        made = pd.DataFrame(out, columns=["doc_id", "piece", "n_tokens", "bin_id", "bin_size", "bin_offset"], dtype=object)
        return made.astype({"doc_id": "Int64", "piece": "int32", "n_tokens": "int64", "bin_size": "Int32", "bin_offset": "Int32"})

    key = F.coalesce("doc_id", F.monotonically_increasing_id())  # rows without an id are dealt out by their place in the written table
    dealt = sized.withColumn("shard", F.pmod(F.xxhash64(key), F.lit(shards)))
    return dealt.groupBy("shard").applyInPandas(run, SCHEMA)


def of_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lengths=LENGTHS) -> DataFrame:
    """documents packed by their numbers of words."""
    sized = docs.select(F.col(id_col).alias("doc_id"), F.regexp_count(text_col, F.lit(WORD)).alias("n_tokens"))
    return best_fit(sized, lengths)


