"""Removal of long repeated byte strings by enhanced suffix arrays.

Every string of ``length`` bytes holds an anchor: the ``gram``-byte string with
the least hash (leftmost on ties) among those that begin in it. Equal strings
have equal anchors at equal places, so only suffixes that begin at anchors
need sorting, and only those of one anchor meet in a task. There the suffixes'
right contexts are sorted; a stack scan over their common prefixes walks the
interval tree from the leaves. Each interval keeps its members in the order of
their reversed left contexts; merging two intervals (the smaller into the
larger) compares new neighbours, which finds how far occurrences agree to the
left (left-extension diversity) for the interval's length to the right. A
place is part of a repeat when both reach ``length``.

Anchors in more than HOT places would make one task hold them all: their
windows are counted by hash instead, which spreads any group.
"""

from bisect import bisect_left
from collections.abc import Iterator

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelore.llm import bytehash as B
from pagelore.llm.common import bitmap, bounded, in_bitmap, sent, written

U = np.uint64
LENGTH, GRAM = 400, 128
SEGMENT = 1 << 19
#: Places of an anchor beyond which its windows are counted by hash.
HOT = 100_000
#: One in so many of the repeated windows' rows makes a window too common to be dealt by its hash.
CROWDS = 4096
_POS = U((1 << 20) - 1)


def rolling(own: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-byte strings at each position."""
    m = len(own) - n + 1
    if m <= 0:
        return np.zeros(0, U)
    sums = np.zeros(len(own) + 1, U)
    np.cumsum(B._BYTE[own] * B._powers(B._P, len(own)), out=sums[1:])
    return B.mix((sums[n:] - sums[:m]) * B._powers(B._IP, len(own))[:m])


def windows(own: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of the anchor of the string of length bytes at each position of one text."""
    width, places, codes = length - gram + 1, [], []
    for s in range(0, max(len(own) - length + 1, 0), SEGMENT):
        seg = own[s : s + SEGMENT + length - 1]
        h = rolling(seg, gram)
        key = (h & ~_POS) | np.arange(len(h), dtype=U)
        pad = -len(key) % width
        blocks = np.concatenate([key, np.full(pad, ~U(0), U)]).reshape(-1, width)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        n = len(key) - width + 1
        least = np.minimum(back[:n], ahead[width - 1 : width - 1 + n])
        at = (least & _POS).astype(np.int64)
        places.append(at + s)
        codes.append(h[at])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, U)
    return np.concatenate(places), np.concatenate(codes)


def anchors(own: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of one text's anchors; none if it is shorter than length."""
    at, codes = windows(own, length, gram)
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1]))) if len(at) else at  # anchors never go back
    return at[first], codes[first]


def common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return int(np.argmax(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)))


def scan(contexts: list[tuple[bytes, bytes, int]], length: int, least: int) -> list[tuple[int, int]]:
    """(left, right) reach of each (reversed left, right, count) context, sorted by right; (0, 0) where nothing repeats."""
    rank = {x: k for k, x in enumerate(sorted({c[0] for c in contexts}))}
    reach = [(len(a), len(b)) if n > 1 and len(a) + len(b) >= length else (0, 0) for a, b, n in contexts]

    def meet(i: int, j: int, right: int) -> None:
        left = common(contexts[i][0], contexts[j][0])
        if left + right >= length:
            for k in (i, j):
                reach[k] = (max(reach[k][0], left), max(reach[k][1], right))

    def merged(a: list, b: list, right: int) -> list:
        big, small = (a, b) if len(a) >= len(b) else (b, a)
        for item in small:
            k = bisect_left(big, item)
            if k:
                meet(item[1], big[k - 1][1], right)
            if k < len(big):
                meet(item[1], big[k][1], right)
            big.insert(k, item)
        return big

    stack: list[tuple[int, list]] = []  # (common prefix with the set below, members by left context)

    def close(depth: int) -> None:
        while len(stack) > 1 and stack[-1][0] > depth:
            right, top = stack.pop()
            below, rest = stack.pop()
            stack.append((below, merged(rest, top, right) if right >= least else top))

    for i, (a, b, _) in enumerate(contexts):
        shared = common(contexts[i - 1][1], b) if i else 0
        close(shared)
        stack.append((shared, [(rank[a], i)]))
    close(0)
    return reach


def intervals(strings: list[bytes]) -> Iterator[tuple[int, int, int]]:
    """(common prefix, first, last) of each inner node of the prefix tree of sorted strings, leaves' parents first."""
    stack: list[tuple[int, int]] = [(-1, 0)]
    for i in range(1, len(strings) + 1):
        shared = common(strings[i - 1], strings[i]) if i < len(strings) else -1
        first = i - 1
        while stack[-1][0] > shared:
            depth, first = stack.pop()
            yield depth, first, i - 1
        if shared > stack[-1][0]:
            stack.append((shared, first))


def maximal(contexts: list[tuple[bytes, bytes]], length: int) -> Iterator[tuple[int, int, list[int]]]:
    """(left, right, members) of each repeat of length bytes and more that no byte on either side extends for all its members.

    contexts are (reversed left, right), sorted by right. Each interval of right
    contexts is taken whole; its members' left contexts make a tree of their
    own, and a node of that is a repeat if its members part to the right where
    the interval does (a deeper interval tells it otherwise).
    """
    rights = [b for _, b in contexts]
    for right, first, last in intervals(rights):
        members = sorted(range(first, last + 1), key=lambda i: contexts[i][0])
        for left, a, b in intervals([contexts[i][0] for i in members]):
            own = sorted(members[a : b + 1])
            if left + right >= length and common(rights[own[0]], rights[own[-1]]) == right:
                yield left, right, own


def _own(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows as (doc_id, text, key): equal rows share a key, and get equal results."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return own.withColumn("key", F.xxhash64("doc_id", "text"))


def _texts(batches) -> Iterator[tuple[int, np.ndarray]]:
    for batch in batches:
        data, at = B.utf8(batch.column("text"))
        for k, a, b in zip(batch.column("key").to_pylist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
            yield k, data[a:b]


def _flushed(rows: Iterator[tuple], types: list, names: list[str], most: int = 1 << 13) -> Iterator[pa.RecordBatch]:
    held = []
    for r in rows:
        held.append(r)
        if len(held) >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)


def _anchor_counts(own: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches):
        held, size = [], 0
        for _, text in _texts(batches):
            codes = anchors(text, length, gram)[1]
            if len(codes):
                held.append(codes)
                size += len(codes)
            if size > 1 << 17:
                yield counted(held)
                held, size = [], 0
        if held:
            yield counted(held)

    def counted(held):
        code, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(code.view(np.int64)), pa.array(n.astype(np.int64))], names=["anchor", "n"])

    return own.select("key", "text").mapInArrow(run, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))


def _contexts(own: DataFrame, several, hot, length: int, gram: int, more: int = 0, reach: int = 0) -> DataFrame:
    """(anchor, key, pos, left reversed, right) of anchors that occur more than once, hot ones aside; more bytes to the left, reach bytes to the right."""
    back, ahead = length - gram + more, reach or length

    def rows(batches):
        for key, text in _texts(batches):
            at, codes = anchors(text, length, gram)
            pick = in_bitmap(several.value, codes) & ~in_bitmap(hot.value, codes) if len(codes) else []
            for p, c in zip(at[pick].tolist(), codes[pick].view(np.int64).tolist(), strict=True) if len(codes) else ():
                yield c, key, p, text[max(0, p - back) : p][::-1].tobytes(), text[p : p + ahead].tobytes()

    types, names = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()], ["anchor", "key", "pos", "left", "right"]
    return own.select("key", "text").mapInArrow(lambda b: _flushed(rows(b), types, names), "anchor long, key long, pos long, left binary, right binary")


def _groups(batches) -> Iterator[dict[tuple[bytes, bytes], list[tuple[int, int]]]]:
    """Occurrences of each context, anchor by anchor, of batches sorted by anchor and right context."""
    now, group = None, {}
    for batch in batches:
        for anchor, key, pos, left, right in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if anchor != now:
                if group:
                    yield group
                now, group = anchor, {}
            group.setdefault((left, right), []).append((key, pos))
    if group:
        yield group


def _spans(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    def rows(batches):
        for group in _groups(batches):
            if sum(map(len, group.values())) > 1:
                sorted_contexts = sorted(group, key=lambda c: c[1])
                reach = scan([(*c, len(group[c])) for c in sorted_contexts], length, gram)
                for c, (left, right) in zip(sorted_contexts, reach, strict=True):
                    if right:
                        for key, pos in group[c]:
                            yield key, pos - left, pos + right

    types, names = [pa.int64()] * 3, ["key", "st", "en"]
    dealt = contexts.repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(lambda b: _flushed(rows(b), types, names, 1 << 16), "key long, st long, en long")


def _hot_spans(own: DataFrame, hot, length: int, gram: int) -> DataFrame:
    """The same for hot anchors: each window goes with its one anchor and is counted by hash, with partial sums before the shuffle.

    Windows that hold over a CROWDS-th of all repeated rows (so fewer than CROWDS) are sent out; their rows stay where they are.
    """

    def run(batches):
        for key, text in _texts(batches):
            at, codes = windows(text, length, gram)
            st = np.flatnonzero(in_bitmap(hot.value, codes)) if len(codes) else at
            if len(st):
                h = rolling(text, length)[st]
                cols = [pa.array(h.view(np.int64)), pa.array(np.full(len(st), key)), pa.array(at[st]), pa.array(st)]
                yield pa.RecordBatch.from_arrays(cols, names=["window", "key", "pos", "st"])

    found = written(own.select("key", "text").mapInArrow(run, "window long, key long, pos long, st long"), "windows")
    often = written(found.groupBy("window").agg(F.count("*").alias("n")).filter("n > 1"), "often")
    total = often.agg(F.sum("n")).first()[0] or 0
    crowds = F.broadcast(often.filter(F.col("n") * CROWDS > total).select("window"))
    rest = found.join(crowds, "window", "left_anti").join(often.filter(F.col("n") * CROWDS <= total).select("window"), "window", "left_semi")
    twice = found.join(crowds, "window", "left_semi").unionAll(rest)
    return twice.groupBy("key", "pos").agg(F.min("st").alias("st"), (F.max("st") + length).alias("en")).select("key", "st", "en")


def _cut(batches, length: int):
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]

    def rows():
        for batch in batches:
            data, at = B.utf8(batch.column("text"))
            for d, spans, a, b in zip(batch.column("doc_id").to_pylist(), batch.column("spans").to_pylist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
                text, kept, end, removed, runs = data[a:b].tobytes(), [], 0, 0, 0
                for x in sorted(spans or [], key=lambda x: (x["st"], x["en"])):
                    st, en = x["st"], x["en"]
                    if runs == 0 or st > end:
                        kept.append(text[end:st])
                        runs, removed, end = runs + 1, removed + en - st, en
                    elif en > end:
                        removed, end = removed + en - end, en
                kept.append(text[end:])
                yield d, b - a, removed, runs, hashlib.sha256(b"".join(kept)).hexdigest()

    return _flushed(rows(), types, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, hot: int | None = None) -> DataFrame:
    """spans(key, st, en) of bytes covered by a string of length bytes that starts elsewhere too; key is xxhash64(doc_id, text)."""
    own, spark = _own(bounded(docs), id_col, text_col), docs.sparkSession
    counts = written(_anchor_counts(own, length, gram).filter("n > 1"), "anchors")
    several = sent(spark, bitmap(counts, "anchor"))
    large = counts.filter(F.col("n") > (HOT if hot is None else hot))
    often = sent(spark, bitmap(large, "anchor"))
    spans = _spans(_contexts(own, several, often, length, gram), length, gram)
    return spans if large.isEmpty() else spans.unionAll(_hot_spans(own, often, length, gram))


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, hot: int | None = None) -> DataFrame:
    """documents -> doc_id, n_bytes, n_removed, n_spans, kept_sha256, a row per row.

    Texts are UTF-8 bytes, null is empty. Strings are judged on the input;
    matches stay inside a document; a text shorter than length loses nothing.
    """
    spans = written(find(docs, id_col, text_col, length, gram, hot), "spans")
    keys = written(spans.groupBy("key").agg(F.collect_set(F.struct("st", "en")).alias("spans")), "keys")
    bits = sent(docs.sparkSession, bitmap(keys, "key"))
    own = _own(docs, id_col, text_col)

    @F.pandas_udf("boolean")
    def touched(key: pd.Series) -> pd.Series:
        return pd.Series(in_bitmap(bits.value, key.to_numpy()))

    marked = own.withColumn("hit", touched("key"))
    kind = keys.schema["spans"].dataType
    whole = marked.filter("NOT hit").select("doc_id", "text", F.lit(None).cast(kind).alias("spans"))
    parts = marked.filter("hit").join(keys, "key", "left").select("doc_id", "text", "spans")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    run = lambda batches: _cut(batches, length)
    return whole.mapInArrow(run, schema).unionAll(parts.mapInArrow(run, schema))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, reach: int | None = None) -> DataFrame:
    """Maximal repeat groups with all occurrences: (repeat, n_bytes, key, st) of each string of length bytes or more that occurs twice or more
    and that no byte on either side extends for all its occurrences.

    Strings are followed ``reach`` bytes (2 * length) from the first anchor in
    them; longer ones come as overlapping pieces. ``repeat`` names the string,
    so that what several anchors tell is one group. The size is that of the
    answer: nested repeats list their occurrences again.
    """
    own, spark, reach = _own(bounded(docs), id_col, text_col), docs.sparkSession, reach or 2 * length
    counts = written(_anchor_counts(own, length, gram).filter("n > 1"), "anchors")
    several, none = sent(spark, bitmap(counts, "anchor")), sent(spark, np.zeros(bitmap(counts.limit(0), "anchor").shape, np.uint8))
    back = length - gram + 1  # where all agree so far to the left, an earlier anchor tells the whole string

    def rows(batches):
        for group in _groups(batches):
            some = sorted(group, key=lambda c: c[1])
            found: list[tuple[int, int, list[int]]] = [(len(c[0]), len(c[1]), [i]) for i, c in enumerate(some) if len(group[c]) > 1 and len(c[0]) + len(c[1]) >= length]
            for left, right, members in [*found, *maximal(some, length)]:
                if left == back:
                    continue
                a, b = some[members[0]]
                name = hashlib.md5(a[:left][::-1] + b[:right]).hexdigest()
                for i in members:
                    for key, pos in group[some[i]]:
                        yield name, left + right, key, pos - left

    types, names = [pa.string(), pa.int64(), pa.int64(), pa.int64()], ["repeat", "n_bytes", "key", "st"]
    dealt = _contexts(own, several, none, length, gram, 1, reach).repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(lambda b: _flushed(rows(b), types, names), "repeat string, n_bytes long, key long, st long").distinct()
