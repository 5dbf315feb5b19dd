"""Scalar pieces of the correction step: chunks, cache keys, prompts, length guard."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelore.functions import lexicon as V
from pagelore.functions.text import ustrip


def chunks(blocks: Column, max_chars: int = 2500) -> Column:
    """Blocks packed greedily into chunks of max_chars; a longer block stands alone.

    The fold keeps the closed chunks, the open one and whether it is open, so
    that the length test matches ``open + LF + block``.
    """
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("open"))

    def step(acc, b):
        full = acc["open"].isNotNull() & (F.length(acc["open"]) + 1 + F.length(b) > max_chars)
        return F.struct(
            F.when(full, F.concat(acc["done"], F.array(acc["open"]))).otherwise(acc["done"]).alias("done"),
            F.when(full | acc["open"].isNull(), b).otherwise(F.concat(acc["open"], F.lit("\n"), b)).alias("open"),
        )

    some = F.filter(blocks, lambda b: ustrip(b) != "")
    return F.aggregate(some, start, step, lambda a: F.when(a["open"].isNull(), a["done"]).otherwise(F.concat(a["done"], F.array(a["open"]))))


def cache_key(model: str, chunk: Column) -> Column:
    return F.sha2(F.concat(F.lit(model + "\n"), chunk), 256)


def prompt(chunk: Column) -> Column:
    return F.concat(F.lit(V.PROMPT), chunk)


def within_guard(original: Column, corrected: Column, max_ratio: float = 0.3) -> Column:
    """The corrected text isn't blank and its length differs by max_ratio at most (inclusive)."""
    ratio = F.abs(F.length(corrected) - F.length(original)) / F.greatest(F.length(original), F.lit(1))
    return (ustrip(corrected) != "") & (ratio <= max_ratio)
