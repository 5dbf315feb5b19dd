"""N-gram Jaccard self-join by token-combination prefixes.

Texts are sets of word shingles ("tokens"). Tokens that many documents hold are
the frequent class. All tokens have one order: rare before frequent, then by
hash. A set of size n must share ceil(t * n) tokens with any partner, so a
prefix that loses more than n - ceil(t * n) tokens meets every partner's. Rare
tokens are indexed singly. Where a set runs out of rare tokens, its prefix is
extended into the frequent ones, which are split into subclasses by hash, and
pairs of tokens of one subclass are indexed: each subclass may waste one token,
so the prefix grows until sum(max(0, n_s - 1)) covers the loss. The number of
subclasses depends on the size band of the smaller partner.

Equal sets are one class. In each index bucket neighbours by size are paired;
the best pair of each set is verified and links make components. Only buckets
that still hold several components are expanded, over pairs of different
components whose size and number of shared prefix tokens can reach the
threshold. Bitmaps of both sets, some bits a token, bound their differences
from below and rule most of those pairs out; in crowded buckets they do so in
the join itself, and a pair comes from its first common crowded bucket. The
rest are verified too. So no bucket is expanded into pairs that can't change
the result, and no link between components is missed.
"""

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelore.llm import bytehash as B
from pagelore.llm.common import bitmap, bounded, components, dropped, in_bitmap, sent, written

U = np.uint64
#: A token seen in more documents is frequent. Any choice gives the same links; this one only steers cost.
FREQUENT = 64
#: Frequent tokens sent to executors: 8 MB at most, the commonest first.
MOST = 1 << 20
#: Tokens counted at once, and sets of a task whose repeats are passed over. Those seen once in such a block aren't reported.
BLOCK, KNOWN = 1 << 21, 1 << 17
#: A bucket with more sets is crowded. Any choice gives the same links.
CROWD = 64
#: Longs of a crowd's bitmaps and of their quick form, and the most earlier buckets of a set that ride with it to keep a pair from coming twice.
MARKS, QUICK, EARLIER = 64, 4, 64
#: Stands for the component of a class without links.
NONE = -(1 << 63)
SIZE_BITS, HASH_BITS = 20, 42
SIZE_MAX = (1 << SIZE_BITS) - 1


def _id(n: int, heavy: bool, lo: int) -> int:
    """size | frequent prefix | hash in 63 bits: sorts by size. Sets that share an id by chance are told apart later."""
    return (min(n, SIZE_MAX) << (HASH_BITS + 1)) | (heavy << HASH_BITS) | (lo & ((1 << HASH_BITS) - 1))


def _ceil(n, num: int, den: int):
    return -(-n * num // den)


def _scan(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """Rows (doc_id, n, hi, lo) of documents, and (token, seen) of tokens held by several sets of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, known = [], 0, set()

        def counted() -> pa.RecordBatch:
            allt, seen = np.unique(np.concatenate(held or [np.zeros(0, U)]), return_counts=True)
            many = seen > 1
            t, s = allt[many].view(np.int64), seen[many].astype(np.int64)
            none = pa.nulls(len(t), pa.int64())
            return pa.RecordBatch.from_arrays([none, none, none, none, pa.array(t), pa.array(s)], names=["doc_id", "n", "hi", "lo", "token", "seen"])

        for batch in batches:
            for piece in B.pieces(batch, "text"):
                rows = []
                for own in B.row_shingles(piece.column("text"), k):
                    hi, lo = B.signature(own)
                    rows.append((len(own), hi, lo))
                    if (hi, lo) not in known:
                        known.add((hi, lo))
                        held.append(own)
                        size += len(own)
                    if size >= BLOCK:
                        yield counted()
                        held, size, known = [], 0, set()
                n, hi, lo = (pa.array(c, pa.int64()) for c in zip(*rows, strict=True))
                none = pa.nulls(len(rows), pa.int64())
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), n, hi, lo, none, none], names=["doc_id", "n", "hi", "lo", "token", "seen"])
        yield counted()

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return own.mapInArrow(run, "doc_id long, n long, hi long, lo long, token long, seen long")


def _pairs(tokens: np.ndarray, need: int, subclasses: int) -> list[int]:
    """Index keys of pairs within subclasses of the shortest prefix of tokens that covers ``need``."""
    group = (B.mix(tokens ^ U(0x0DD5EED5)) % U(subclasses)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    rank = np.empty(len(tokens), np.int64)
    sorted_group = group[order]
    begins = np.searchsorted(sorted_group, sorted_group)
    rank[order] = np.arange(len(tokens)) - begins  # how many of the subclass came before
    end = int(np.searchsorted(np.cumsum(rank > 0), need)) + 1
    keys, by = [], {}
    for t, g in zip(tokens[:end].tolist(), group[:end].tolist(), strict=True):
        for other in by.setdefault(g, []):
            keys.append((other, t))
        by[g].append(t)
    if not keys:
        return []
    a, b = (np.array(c, U) for c in zip(*keys, strict=True))
    return (B.mix(B.mix(a) * U(3) + b + U(subclasses * 0x9E3779B97F4A7C15 % (1 << 64))) | U(1)).tolist()


def index_keys(own: np.ndarray, frequent: np.ndarray, num: int, den: int) -> tuple[np.ndarray, bool]:
    """(keys, whether they reach into frequent tokens) of one sorted set. Even keys are tokens, odd keys pairs."""
    n = len(own)
    need = n - _ceil(n, num, den) + 1
    rare = own
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, own), len(frequent) - 1)
        rare = own[frequent[at] != own]
    single = rare[:need] & ~U(1)
    if len(rare) >= need:
        return single, False
    often = own[frequent[at] == own]
    bands = {max(1, (1 << (m.bit_length() - 1)) // 8) for m in (n, _ceil(n, num, den))}
    more = [key for s in sorted(bands) for key in _pairs(often, need - len(rare), s)]
    return np.concatenate([single, np.array(more, U)]), True


def _index(docs: DataFrame, id_col: str, text_col: str, k: int, num: int, den: int, frequent) -> DataFrame:
    """(key, id) of each distinct set of a task, sets of one token aside: they link with equal ones only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, known = frequent.value, set()
        for batch in batches:
            for piece in B.pieces(batch, "text"):
                keys, ids, many = [], [], []
                for own in B.row_shingles(piece.column("text"), k):
                    if len(own) < 2 or (sig := B.signature(own)) in known:
                        continue
                    if len(known) >= KNOWN:
                        known.clear()
                    known.add(sig)
                    found, heavy = index_keys(own, often, num, den)
                    keys.append(found)
                    ids.append(_id(len(own), heavy, sig[1]))
                    many.append(len(found))
                if keys:
                    columns = [np.concatenate(keys).view(np.int64), np.repeat(np.array(ids, np.int64), many)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "id"])

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return own.select("text").mapInArrow(run, "key long, id long")


def _neighbours(index: DataFrame) -> DataFrame:
    """(key, a, b): ids next to each other in a bucket, by size. Streams over sorted partitions with one row of state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, last = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            k = np.concatenate([key, batch.column(0).to_numpy()])
            i = np.concatenate([last, batch.column(1).to_numpy()])
            near = (k[1:] == k[:-1]) & (i[1:] != i[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (k[1:][near], i[:-1][near], i[1:][near])], names=["key", "a", "b"])
            key, last = k[-1:], i[-1:]

    return index.repartition("key").sortWithinPartitions("key", "id").mapInArrow(run, "key long, a long, b long")


def _size(c: str):
    return F.shiftright(c, HASH_BITS + 1)


def _size_ok(a: str, b: str, num: int, den: int):
    """a <= b in size; sizes beyond SIZE_MAX count as it."""
    return _size(a) * den >= _size(b) * num


def sketch(own: np.ndarray) -> bytes:
    """A bitmap of the low bits of a set's tokens, 16 to 32 bits a token. Halves laid over each other give a narrower one."""
    width = max(64, 1 << (16 * len(own)).bit_length())
    bits = np.zeros(width, bool)
    bits[(own & U(width - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def may_link(x: bytes, y: bytes, nx: int, ny: int, num: int, den: int) -> bool:
    """False only for sets of these sizes and sketches that can't link: a bit of one alone is a token that the other lacks."""
    a, b = int.from_bytes(x, "little"), int.from_bytes(y, "little")
    wx, wy = 8 * len(x), 8 * len(y)
    while wx != wy:
        if wx > wy:
            wx //= 2
            a = a >> wx | a & ((1 << wx) - 1)
        else:
            wy //= 2
            b = b >> wy | b & ((1 << wy) - 1)
    need = _ceil(nx + ny, num, num + den)
    return (a & ~b).bit_count() <= nx - need and (b & ~a).bit_count() <= ny - need


def _tasks(pairs: DataFrame, sets: DataFrame) -> int:
    """Tasks enough for these written tables, so that few rows don't start a worker for each shuffle partition."""
    return 1 + pairs.count() // 1000 + sets.count() // 1000


def _ends(pairs: DataFrame) -> DataFrame:
    """(id): what pairs(ia, ib) name, made distinct on each side first."""
    return pairs.select(F.col("ia").alias("id")).distinct().unionAll(pairs.select(F.col("ib").alias("id")).distinct())


def marks(own: np.ndarray) -> np.ndarray:
    """int64[MARKS]: the bits of a set's tokens modulo 64 * MARKS."""
    bits = np.zeros(64 * MARKS, bool)
    bits[(own % U(64 * MARKS)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").view(np.int64)


def _solo(sets: DataFrame) -> DataFrame:
    """(id, hi, solo): how many tokens of a set no other of these sets holds; sets without such tokens have no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in B.pieces(batch, "own"):
                owns = [np.frombuffer(x.as_buffer(), np.int64) for x in piece.column("own")]
                many = [len(x) for x in owns]
                columns = [np.concatenate(owns), *(np.repeat(piece.column(c).to_numpy(), many) for c in ("id", "hi"))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["token", "id", "hi"])

    who = F.struct("id", "hi")  # a class that has several rows counts once
    alone = sets.select("id", "hi", "own").mapInArrow(run, "token long, id long, hi long").groupBy("token").agg(F.min(who).alias("who"), F.max(who).alias("last")).filter("who = last")
    return alone.groupBy("who.id", "who.hi").agg(F.count("*").alias("solo"))


def _band(size) -> F.Column:
    """Sizes by steps of 15 in a hundred."""
    return F.floor(F.log(size) / math.log(1.15)).cast("int")


def _fitted(crowd: DataFrame, marked: DataFrame, num: int, den: int) -> DataFrame:
    """crowd(id, at, key, heavy, component) with the sets' sizes and bitmaps, and ``shared``, a bound on what a set shares.

    In heavy buckets that is what isn't a set's own alone. Sets that it keeps
    from linking with any size are left out there.
    """
    shared = F.when(F.col("heavy"), F.col("size") - F.coalesce("solo", F.lit(0))).otherwise(F.col("size"))
    rows = crowd.join(marked.withColumnRenamed("id", "own"), (F.col("id") == F.col("own")) & (shared * den >= F.col("size") * num))
    narrow = {f"q{j}": reduce(lambda x, y: x.bitwiseOR(y), [F.col("m")[i] for i in range(j, MARKS, QUICK)]) for j in range(QUICK)}
    return rows.withColumns({"shared": shared, "band": _band(F.col("size")), **narrow}).drop("solo", "own", "heavy")


def _ends_and_all(crowd: DataFrame, marked: DataFrame, num: int, den: int) -> DataFrame:
    """Fitted rows with ``end``, whether a set is outside its bucket's largest component, and ``earlier``, the EARLIER buckets before."""
    part = F.coalesce("component", F.lit(NONE))
    rows = _fitted(crowd, marked, num, den).withColumn("part", part)
    rows = rows.withColumn("earlier", F.collect_list("key").over(Window.partitionBy("id").orderBy("key").rowsBetween(-EARLIER, -1)))
    rows = rows.withColumn("many", F.count("*").over(Window.partitionBy("key", "part")))
    main = F.max_by("part", F.struct("many", "part")).over(Window.partitionBy("key"))
    return rows.withColumn("end", (main != F.col("part")) | (F.col("part") == NONE)).drop("part", "many", "id")


def _pivots(crowd: DataFrame, marked: DataFrame, num: int, den: int) -> DataFrame:
    """Fitted rows of each set's first heavy bucket; ``end`` is the set with the fewest tokens of its own of each bucket and band."""
    first = crowd.filter("heavy").groupBy("id", "at", "heavy", "component").agg(F.min("key").alias("key"))
    rows = _fitted(first, marked, num, den).drop("id").withColumn("earlier", F.array().cast("array<bigint>"))
    least = F.max_by("at", F.struct(F.col("shared") / F.col("size"), -F.col("at"))).over(Window.partitionBy("key", "band"))
    return rows.withColumn("end", F.col("at") == least)


def _crowded(rows: DataFrame, num: int, den: int) -> DataFrame:
    """rows of crowded buckets -> (ia, ib, c): the pairs of different components that could link, one end of which is an ``end``.

    A set asks only the bands of sizes that it can reach, in heavy buckets often
    none. So a large group of linked sets isn't paired with itself. Bitmaps rule
    out most of the rest. A pair is made in its first common bucket; where that
    is more than EARLIER buckets back, perhaps in later ones too. c is a bound
    on what both share.
    """
    low, high = F.ceil(F.col("size") * num / den), F.least(F.floor(F.col("size") * den / num), F.floor(F.col("shared") * (num + den) / num) - F.col("size"))
    asks = rows.filter(F.col("end") & (low <= high)).withColumn("band", F.explode(F.sequence(_band(low), _band(high))))
    side = lambda r, s: r.select("key", "band", *(F.col(c).alias(c + s) for c in r.columns if c not in ("key", "band")))
    # first the bitmaps laid over themselves, QUICK longs each, then the whole ones as a fold, which Spark calls instead of inlining: the loop over pairs stays small enough to be compiled
    bits = lambda s, t: F.zip_with("m" + s, "m" + t, lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y))))
    alone = lambda s, t: F.aggregate(bits(s, t), F.lit(0), lambda acc, n: acc + n)
    need = (F.col("sizea") + F.col("sizeb")) * num
    reach = lambda s: need <= F.col("shared" + s) * (num + den)
    quick = lambda s, t: sum((F.bit_count(F.col(f"q{j}{s}").bitwiseAND(F.bitwise_not(F.col(f"q{j}{t}")))) for j in range(QUICK)), F.lit(0))
    fits = lambda s, t, alone: alone(s, t) * (num + den) <= F.col("size" + s) * (num + den) - need
    differ = F.col("componenta").isNull() | F.col("componentb").isNull() | (F.col("componenta") != F.col("componentb"))
    once = (F.col("ata") < F.col("atb")) | ((F.col("ata") > F.col("atb")) & ~F.col("endb"))
    near = F.least("sizea", "sizeb") * den >= F.greatest("sizea", "sizeb") * num
    ok = once & reach("a") & reach("b") & differ & near & fits("a", "b", quick) & fits("b", "a", quick) & fits("a", "b", alone) & fits("b", "a", alone) & ~F.arrays_overlap("earliera", "earlierb")
    share = F.least(F.col("sizea") - alone("a", "b"), F.col("sizeb") - alone("b", "a"))
    pairs = side(asks, "a").join(side(rows, "b"), ["key", "band"]).filter(ok)
    return pairs.select(F.least("ata", "atb").alias("ia"), F.greatest("ata", "atb").alias("ib"), share.alias("c"))


def _possible(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (ia, ib, c) whose sketches don't rule a link out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, nx, ny = (batch.column(c).to_pylist() for c in ("x", "y", "nx", "ny"))
            keep = [may_link(*row, num, den) for row in zip(x, y, nx, ny, strict=True)]
            yield batch.select(["ia", "ib", "c"]).filter(pa.array(keep, pa.bool_()))

    side = lambda i, x, n: sets.select(F.col("id").alias(i), F.col("bits").alias(x), F.col("size").alias(n))
    both = pairs.join(side("ia", "x", "nx"), "ia").join(side("ib", "y", "ny"), "ib")
    return both.coalesce(_tasks(pairs, sets)).select("ia", "ib", "c", "x", "y", "nx", "ny").mapInArrow(run, "ia long, ib long, c long").distinct()


ARROW = {"long": pa.int64(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}


def _sets(docs: DataFrame, id_col: str, text_col: str, k: int, classes: DataFrame, ids: DataFrame, marked: bool = False) -> DataFrame:
    """(id, hi, rep, size, own, bits), or marked: (id, hi, rep, size, m), of at least the classes with these ids.

    A bitmap of representatives spares other texts the work. A text that it lets
    through by chance only repeats links of its class.
    """
    wanted = classes.join(ids.distinct(), "id", "left_semi").select("rep")
    bits = sent(docs.sparkSession, bitmap(wanted, "rep"))
    kinds = {"id": "long", "hi": "long", "rep": "long", "size": "long"} | ({"m": "array<bigint>"} if marked else {"own": "binary", "bits": "binary"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = batch.filter(pa.array(in_bitmap(bits.value, batch.column("doc_id").to_numpy(zero_copy_only=False))))
            for piece in B.pieces(known, "text"):
                owns = list(B.row_shingles(piece.column("text"), k))
                signs = [B.signature(x) for x in owns]
                columns = [[_id(len(x), False, s[1]) for x, s in zip(owns, signs, strict=True)], [s[0] for s in signs], piece.column("doc_id"), [len(x) for x in owns]]
                if marked:
                    columns.append([marks(x) for x in owns])
                else:
                    columns += [[x.tobytes() for x in owns], [sketch(x) for x in owns]]
                yield pa.RecordBatch.from_arrays([pa.array(c, ARROW[t]) for c, t in zip(columns, kinds.values(), strict=True)], names=list(kinds))

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).filter("doc_id IS NOT NULL")
    return own.mapInArrow(run, ", ".join(f"{c} {t}" for c, t in kinds.items()))


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """links(a, b) of representatives whose sets reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                a, b = (np.frombuffer(s.as_buffer(), U) for s in (x, y))
                same = len(a) + len(b) - len(np.union1d(a, b))
                keep.append(same * den >= num * (len(a) + len(b) - same))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("id").alias("ia"), F.col("rep").alias("a"), F.col("own").alias("x"))
    right = sets.select(F.col("id").alias("ib"), F.col("rep").alias("b"), F.col("own").alias("y"))
    both = pairs.select("ia", "ib").join(left, "ia").join(right, "ib").filter("a != b")
    return both.coalesce(_tasks(pairs, sets)).select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 75, den: int = 100) -> DataFrame:
    """documents -> (doc_id, n_shingles, class_id, component_id), one row per row.

    Two documents link when ``den * |intersection| >= num * |union|`` of their
    sets of k-word shingles (A-Z lower-cased; fewer words: all as one). class_id
    is the smallest doc_id with an equal set, component_id the smallest reachable
    by links. A text without words has an empty set and its own ids. Rows that
    share a doc_id count as one document, whose sets are linked. A null doc_id
    is linked with nothing and has null ids.
    """
    spark = bounded(docs).sparkSession
    scan = written(_scan(docs, id_col, text_col, k), "scan")
    rows = scan.filter("n IS NOT NULL").select("doc_id", "n", "hi", "lo")
    counts = scan.filter("token IS NOT NULL").groupBy("token").agg(F.sum("seen").alias("seen")).filter(F.col("seen") > FREQUENT)
    top = counts.orderBy(F.desc("seen"), "token").limit(MOST).select("token").toArrow()
    frequent = sent(spark, np.sort(top.column("token").to_numpy().view(U)))

    grouped = rows.filter("n > 0 AND doc_id IS NOT NULL").groupBy("hi", "lo").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"))
    low = F.col("lo").bitwiseAND((1 << HASH_BITS) - 1)
    base = F.shiftleft(F.least("n", F.lit(SIZE_MAX)), HASH_BITS + 1).bitwiseOR(low)
    one = written(grouped.withColumn("base", base), "classes")
    near = written(_neighbours(_index(docs, id_col, text_col, k, num, den, frequent)), "near")
    flag = 1 << HASH_BITS
    plain = lambda c: F.col(c).bitwiseAND(F.lit(~flag))  # noqa: E731  the class's id, whatever its prefix
    classes = one.select(F.col("base").alias("id"), "rep")

    paired = written(near.groupBy("a", "b").agg(F.count("*").alias("c")), "paired")
    # likely links come first: near copies share a tenth of their tokens in their prefixes at least
    likely = paired.filter(_size_ok("a", "b", num, den) & (F.col("c") * 30 >= _size("b")))
    best = likely.groupBy("b").agg(F.max_by("a", F.struct("c", "a")).alias("ia")).select(plain("ia").alias("ia"), plain("b").alias("ib"))
    best = written(best, "best")

    def placed(links: DataFrame, before: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
        """(node, component), and (id, component), of each class that has a link; before: the nodes of earlier links."""
        nodes = written(components(links if before is None else links.unionAll(before.toDF("a", "b"))), "nodes")
        return nodes, written(classes.join(nodes, F.col("rep") == F.col("node")).select("id", "component"), "placed")

    def apart(pairs: DataFrame, part: DataFrame, a: str, b: str) -> DataFrame:
        """pairs of different components, with these as ca and cb (null: a class without links)."""
        both = pairs.join(part.toDF("pa", "ca"), plain(a) == F.col("pa"), "left").join(part.toDF("pb", "cb"), plain(b) == F.col("pb"), "left")
        return both.filter("ca IS NULL OR cb IS NULL OR ca != cb").drop("pa", "pb")

    pairs = likely.select(plain("a").alias("ia"), plain("b").alias("ib")).distinct()
    sets = written(_sets(docs, id_col, text_col, k, classes, _ends(pairs)), "sets")
    nodes, part = placed(written(_verified(best, sets, num, den), "links"))
    again = written(apart(pairs, part, "ia", "ib").select("ia", "ib").join(best, ["ia", "ib"], "left_anti"), "again")
    nodes, part = placed(written(_verified(again, sets, num, den), "links"), nodes)
    dropped(sets)

    open_pairs = apart(paired, part, "a", "b").select("a", "b")
    keys = near.join(open_pairs, ["a", "b"], "left_semi").select("key").distinct()
    rest = near.join(keys, "key", "left_semi")
    members = written(rest.select("key", F.explode(F.array("a", "b")).alias("at")).distinct(), "members")
    dropped(near, paired)
    held = Window.partitionBy("key")
    sized = members.withColumns({"c": F.count("*").over(held).cast("double"), "tokens": F.sum(_size("at").cast("double")).over(held), "id": plain("at")})
    sized = written(sized.select("key", "at", "id", (F.col("c") > CROWD).alias("crowded"), (F.col("tokens") < F.col("c") * F.col("c")).alias("heavy")), "sized")  # heavy: pairs cost more than tokens
    dropped(members)
    crowd = sized.filter("crowded").drop("crowded")
    where = lambda rows, part: rows.join(part, "id", "left")

    theirs = written(_sets(docs, id_col, text_col, k, classes, crowd.filter("heavy").select("id")), "sets")
    marked = _sets(docs, id_col, text_col, k, classes, crowd.select("id"), marked=True).drop("rep").distinct()
    marked = written(marked.join(_solo(theirs), ["id", "hi"], "left").drop("hi"), "marked")
    pivots = _crowded(_pivots(where(crowd, part), marked, num, den), num, den).select(plain("ia").alias("ia"), plain("ib").alias("ib")).distinct()
    tried = best.unionAll(again)
    pivots = written(pivots.join(tried, ["ia", "ib"], "left_anti"), "pivots")
    nodes, part = placed(written(_verified(pivots, theirs, num, den), "links"), nodes)
    dropped(theirs)

    few = where(sized.filter("NOT crowded"), part)
    x, y = (few.select(F.col("at").alias(i), "key", F.col("component").alias(c)) for i, c in (("ia", "ca"), ("ib", "cb")))
    differ = F.col("ca").isNull() | F.col("cb").isNull() | (F.col("ca") != F.col("cb"))
    cross = x.join(y, "key").filter((F.col("ia") < F.col("ib")) & differ & _size_ok("ia", "ib", num, den))
    cross = cross.groupBy("ia", "ib").agg(F.count("*").alias("c"))
    heavy = F.col("ia").bitwiseAND(flag) + F.col("ib").bitwiseAND(flag) >= 2 * flag
    na, nb = _size("ia"), _size("ib")
    lost = F.ceil(nb * num / den) - 1
    reach = F.col("c") + lost >= F.ceil((na + nb) * num / (num + den))
    # a pair that shares a crowded bucket too counts too little here, and is found there
    cross = cross.filter(heavy | reach | (nb >= SIZE_MAX))
    fitted = written(_ends_and_all(where(crowd, part), marked, num, den), "fitted")
    cross = cross.unionAll(_crowded(fitted, num, den)).select(plain("ia").alias("ia"), plain("ib").alias("ib"), "c")
    cross = cross.groupBy("ia", "ib").agg(F.max("c").alias("c")).join(tried.unionAll(pivots), ["ia", "ib"], "left_anti")
    double = one.groupBy("base").agg(F.count("*").alias("c")).filter("c > 1").select(F.col("base").alias("ia"), F.col("base").alias("ib"), "c")
    cross = written(cross.unionAll(double), "cross")
    dropped(sized, marked, fitted, best, again, pivots)
    more_sets = written(_sets(docs, id_col, text_col, k, classes, _ends(cross)), "sets")

    distinct = cross.filter("ia != ib")
    left, same_base = written(_possible(distinct, more_sets, num, den), "possible"), cross.filter("ia = ib")
    several = rows.filter("n > 0 AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(F.struct("hi", "lo")).alias("x"), F.max(F.struct("hi", "lo")).alias("y")).filter("x != y")
    ends = several.join(rows.filter("n > 0"), "doc_id").select("x", F.struct("hi", "lo").alias("y")).distinct()
    of_id = lambda c, name: one.select(F.struct("hi", "lo").alias(c), F.col("rep").alias(name))
    same_id = written(ends.join(of_id("x", "a"), "x").join(of_id("y", "b"), "y").select("a", "b"), "same")
    for last in (False, True):
        # the best pair of each component first: those links spare most of the rest
        todo = apart(left, part, "ia", "ib")
        if last:
            todo = todo.select("ia", "ib").unionAll(same_base.select("ia", "ib"))
        else:
            todo = pending = written(todo, "open")  # both sides read it
            pair = F.struct("c", "ia", "ib")
            sides = [todo.groupBy(F.coalesce(c, i).alias("at"), F.col(c).isNull().alias("alone")).agg(F.max(pair).alias("p")) for c, i in (("ca", "ia"), ("cb", "ib"))]
            todo = sides[0].unionAll(sides[1]).select("p.ia", "p.ib").distinct()
        todo = written(todo.select("ia", "ib"), "todo")
        found = written(_verified(todo, more_sets, num, den), "links")
        nodes, part = placed(found.unionAll(same_id) if last else found, nodes)
        if not last:
            left = pending.join(todo, ["ia", "ib"], "left_anti").select("ia", "ib")
    dropped(cross, more_sets)

    merged = one.join(nodes, F.col("rep") == F.col("node"), "left").select("hi", "lo", "rep", F.coalesce("component", "rep").alias("component"))
    out = rows.join(merged, ["hi", "lo"], "left")
    alone = (F.col("n") == 0) | F.col("doc_id").isNull()
    pick = lambda c: F.when(alone, F.col("doc_id")).otherwise(F.col(c))
    return out.select("doc_id", F.col("n").alias("n_shingles"), pick("rep").alias("class_id"), pick("component").alias("component_id"))
