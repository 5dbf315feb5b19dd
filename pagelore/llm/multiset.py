"""Homomorphic multiset fingerprints, in DataFrame functions only.

A text is a multiset of pieces (paragraphs, cut further at sentence ends). Each
piece's two 64-bit hashes give 120 bits; a lane counts, modulo 2**14, the
pieces whose bit is set, four lanes to a long with a spare bit each, so that
sums never overflow. Vectors add and subtract: order doesn't matter, equal
texts have equal fingerprints, and pieces can be put in or taken out. Two more
lanes of 61 bits sum the hashes and one counts pieces. As a lane is a random
+-1 projection, mean squares of lane differences estimate how much differs. A
projection wraps at 2**14: one piece so many times, or 10 million different.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STEP, PER_LONG = 15, 4
BITS = STEP  # longs per hash
MOD = 1 << (STEP - 1)
ONES = sum(1 << (STEP * i) for i in range(PER_LONG))
LANES = sum((MOD - 1) << (STEP * i) for i in range(PER_LONG))
SPARE = sum(MOD << (STEP * i) for i in range(PER_LONG))
WIDE = (1 << 61) - 1
SEEDS = (11, 12)
PIECES = r"\n+|(?<=[.!?])[ \t]+"
#: Rows of a bucket of neighbouring ids, and the most buckets there may be.
BUCKET, BUCKETS = 2000, 20_000


def _bound(value: Column, use) -> Column:
    """use(value) with the value as a lambda's variable: computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def vector(text: Column) -> Column:
    """array<long>: piece count, two wide sums, then the packed lanes. Null text is empty."""
    own = F.filter(F.split(F.coalesce(text, F.lit("")), PIECES), lambda p: p != "")

    def total(hashes: Column, bit: int, mask: int, keep: int) -> Column:
        take = lambda h: (F.shiftrightunsigned(h, bit) if bit else h).bitwiseAND(F.lit(mask))
        return F.aggregate(hashes, F.lit(0).cast("long"), lambda acc, h: (acc + take(h)).bitwiseAND(F.lit(keep)))

    def of_hashes(x: Column) -> Column:
        sums = [total(x["h"], 0, WIDE, WIDE), total(x["g"], 0, WIDE, WIDE)]
        return F.array(F.size(x["h"]).cast("long"), *sums, *(total(x[c], bit, ONES, LANES) for c in ("h", "g") for bit in range(BITS)))

    def of_pieces(pieces: Column) -> Column:
        h, g = (F.transform(pieces, lambda p: F.xxhash64(p, F.lit(SEEDS[0]))), F.transform(pieces, lambda p: F.xxhash64(p, F.lit(SEEDS[1]))))
        return _bound(F.struct(h.alias("h"), g.alias("g")), of_hashes)

    return _bound(own, of_pieces)


def _lanewise(a: Column, b: Column, wide, packed) -> Column:
    return F.zip_with(F.transform(a, lambda x, i: F.struct(x.alias("x"), i.alias("i"))), b, lambda x, y: F.when(x["i"] < 3, wide(x["x"], y)).otherwise(packed(x["x"], y)))


def add(a: Column, b: Column) -> Column:
    """The fingerprint vector of both multisets together."""
    return _lanewise(a, b, lambda x, y: (x + y).bitwiseAND(F.lit(WIDE)), lambda x, y: (x + y).bitwiseAND(F.lit(LANES)))


def subtract(a: Column, b: Column) -> Column:
    """The vector with b's pieces taken out again."""
    return _lanewise(a, b, lambda x, y: (x - y).bitwiseAND(F.lit(WIDE)), lambda x, y: (x.bitwiseOR(F.lit(SPARE)) - y).bitwiseAND(F.lit(LANES)))


def to_string(vec: Column) -> Column:
    return F.array_join(F.transform(vec, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def _square(vec: Column, n: Column) -> Column:
    """Mean square of 2 * lane - n over all lanes; that difference is known modulo 2 * MOD and taken as near 0."""
    lane = lambda x, i: F.shiftright(x, STEP * i).bitwiseAND(F.lit(MOD - 1))
    near = lambda v: F.pmod(v * 2 - n + MOD, F.lit(2 * MOD)) - MOD
    off = F.flatten(F.transform(F.slice(vec, 4, 2 * BITS), lambda x: F.array(*(near(lane(x, i)) for i in range(PER_LONG)))))
    return F.aggregate(off, F.lit(0).cast("long"), lambda acc, v: acc + v * v) / (2 * BITS * PER_LONG)


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: one less the estimated share of pieces that differ; 1 for equal vectors."""

    def of(x: Column) -> Column:
        na, nb = F.element_at(x["a"], 1), F.element_at(x["b"], 1)
        both = _square(x["a"], na) + _square(x["b"], nb)
        apart = _square(subtract(x["a"], x["b"]), na - nb)
        return F.when(x["a"] == x["b"], 1.0).when(both <= 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - apart / both)))

    return _bound(F.struct(a.alias("a"), b.alias("b")), of)


def with_next(docs: DataFrame, order: str, text: str, carried: list[str]) -> DataFrame:
    """Adds ``next_<c>`` of the row after, by ``order`` descending (after the last: the first), nulls last, ties by text.

    Rows go to buckets of neighbouring ids; each bucket also gets the first row
    of the one after it. Only those first ids (BUCKETS at most) are broadcast.
    """
    n, low, high = docs.agg(F.count("*"), F.min(order), F.max(order)).first()
    buckets = max(1, min(BUCKETS, -(-n // BUCKET)))
    width = 1 if low is None else max(1, -(-(high - low + 1) // buckets))
    key = F.coalesce(F.expr(f"{order} div {width}"), F.lit((0 if low is None else int(low / width)) - 2))
    own = docs.withColumn("_bucket", key)
    heads = own.groupBy("_bucket").agg(F.max(order).alias("_head"))
    every = Window.orderBy("_bucket")  # a row for each bucket
    heads = heads.select("_head", F.coalesce(F.lead("_bucket").over(every), F.min("_bucket").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("_to"), F.lit(True).alias("_is"))
    marked = own.join(F.broadcast(heads), own[order].eqNullSafe(heads["_head"]), "left").drop("_head")
    places = F.array_compact(F.array(F.struct(F.col("_bucket").alias("b"), F.lit(0).alias("extra")), F.when(F.col("_is"), F.struct(F.col("_to").alias("b"), F.lit(1).alias("extra")))))
    dealt = marked.withColumn("_place", F.explode(places)).drop("_bucket", "_to", "_is")
    run = Window.partitionBy("_place.b").orderBy(F.col("_place.extra"), F.desc_nulls_last(order), F.col(text))
    return dealt.withColumns({f"next_{c}": F.lead(c).over(run) for c in carried}).filter("_place.extra = 0").drop("_place")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """documents -> a row per row with its fingerprint, its edited text's, and their likeness.

    The edited text has its last floor(n / 2) code points replaced by the first
    as many (or all) of the next document. Null text is empty; one document is
    its own next; an empty table gives no rows.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    own = own.withColumn("vec", vector(F.col("text")))
    placed = with_next(own, "doc_id", "text", ["text", "vec"])
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    made = placed.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "vec", "next_vec")
    made = made.withColumn("edited_vec", vector(F.col("edited")))
    return made.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        to_string(F.col("vec")).alias("fingerprint"), to_string(F.col("edited_vec")).alias("edited_fingerprint"),
        likeness(F.col("vec"), F.col("edited_vec")).alias("near_edited"), likeness(F.col("vec"), F.col("next_vec")).alias("near_next"),
    )
