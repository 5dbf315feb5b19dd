"""Toxicity by a factorization machine over hashed terms.

Terms are words and 4- and 5-byte strings, folded to lower case, present or
not. Terms whose presence goes with the label in the training sample are
selected, and both words of each pair whose presence together does so more than
either's; the machine learns a weight and a vector for each, so that pairs
count beyond their sum.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelore.llm.common import bounded, crc_mod, sent, written
from pagelore.llm.features import Rows, labelled_sample, text_batches

BITS, SIZES = 20, (4, 5)
KINDS = 1 + len(SIZES)
#: Training rows that aren't and are toxic, at most; factors; words whose pairs are counted together.
SAMPLE, FACTORS, BLOCK = (3000, 1500), 8, 512
#: Of a selected term: toxic rows at least, how many times as common in them, z score. A pair's z score (there are many pairs), and its ratio against its words'.
LEAST, RATIO, Z, PAIR_Z, GAIN = 4, 8, 3, 6, 2
REJECT = 0.7


def _hits(rows: Rows, table: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(row, term) of all terms, or of those that table maps to 0 and more; distinct, by row."""
    found = []
    for kind in range(KINDS):
        slot = (rows.word_slots(BITS) if kind == 0 else rows.gram_slots(SIZES[kind - 1], BITS)) + (kind << BITS)
        begins = rows.bounds if kind == 0 else rows.at
        at = np.arange(len(slot)) if table is None else np.flatnonzero(table[slot] >= 0)
        row = np.searchsorted(begins, at, "right") - 1
        if kind:
            inside = at < rows.gram_ends(SIZES[kind - 1])[np.minimum(row, rows.n - 1)]
            at, row = at[inside], row[inside]
        found.append(row * (KINDS << BITS) + slot[at])
    both = np.unique(np.concatenate(found))
    row, term = both // (KINDS << BITS), both % (KINDS << BITS)
    return row, term if table is None else table[term].astype(np.int64)


def sample_terms(sample: DataFrame, table: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(label, selected terms) of each sample row."""
    held = sent(sample.sparkSession, table)

    def run(batches):
        for piece in text_batches(batches):
            row, term = _hits(Rows(piece.column("text"), fold=True), held.value)
            ends = np.searchsorted(row, np.arange(piece.num_rows + 1))
            terms = [np.unique(term[a:b]).astype(np.int32).tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("label"), pa.array(terms, pa.binary())], names=["doc_id", "label", "terms"])

    got = sample.mapInArrow(run, "doc_id long, label int, terms binary").orderBy("doc_id", "label", "terms").toArrow()
    return [(y, np.frombuffer(t, np.int32).astype(np.int64)) for y, t in zip(got["label"].to_pylist(), got["terms"].to_pylist(), strict=True)]


def _rates(pos, neg, sizes: dict[int, int], root):
    """(how many times as common in class 1, z score) of counts: columns or arrays."""
    p0, p1 = (neg + 0.5) / (sizes[0] + 1), (pos + 0.5) / (sizes[1] + 1)
    p = (pos + neg + 1) / (sizes[0] + sizes[1] + 2)
    return p1 / p0, (p1 - p0) / root(p * (1 - p) * (1 / sizes[0] + 1 / sizes[1]))


def _numbered(terms: np.ndarray) -> np.ndarray:
    """int32[all terms]: a term's number, else -1."""
    table = np.full(KINDS << BITS, -1, np.int32)
    table[terms] = np.arange(len(terms))
    return table


def _paired(sample: DataFrame, sizes: dict[int, int], words: np.ndarray) -> np.ndarray:
    """The words of pairs that go with class 1 beyond either word; executors count all pairs, a block of words at a time."""
    rows, n = sample_terms(sample, _numbered(words)), len(words)
    if not n:
        return words
    held = sent(sample.sparkSession, [[t.astype(np.int32) for y, t in rows if y == k] for k in (0, 1)])

    def run(batches):
        def dense(own: list[np.ndarray], a: int, b: int) -> np.ndarray:
            out = np.zeros((len(own), b - a), np.float32)
            for i, t in enumerate(own):
                out[i, t[(t >= a) & (t < b)] - a] = 1
            return out

        single = [np.bincount(np.concatenate([*own, np.zeros(0, np.int32)]), minlength=n) for own in held.value]
        ratio = _rates(single[1], single[0], sizes, np.sqrt)[0]
        for batch in batches:
            for k in batch.column(0).to_pylist():
                a, found = k * BLOCK, []
                first = [dense(own, a, min(a + BLOCK, n)).T for own in held.value]
                for b in range(a, n, BLOCK):
                    neg, pos = (x @ dense(own, b, min(b + BLOCK, n)) for x, own in zip(first, held.value, strict=True))
                    r, z = _rates(pos, neg, sizes, np.sqrt)
                    alone = np.maximum(ratio[a : a + BLOCK, None], ratio[None, b : b + BLOCK])
                    i, j = np.nonzero((pos >= LEAST) & (r > RATIO) & (z > PAIR_Z) & (r > GAIN * alone))
                    found += [i + a, j + b]
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(found)).astype(np.int64))], names=["word"])

    blocks = -(-n // BLOCK)
    got = sample.sparkSession.range(0, blocks, 1, blocks).mapInArrow(run, "word long").distinct().toArrow()
    return words[np.sort(got["word"].to_numpy())]


def select(sample: DataFrame, sizes: dict[int, int]) -> np.ndarray:
    """int32[all terms]: the number of a selected term, else -1. Terms that go with class 1, alone or as words in pairs; executors count."""

    def run(batches):
        for piece in text_batches(batches):
            row, term = _hits(Rows(piece.column("text"), fold=True), None)
            toxic = piece.column("label").to_numpy()[row] == 1
            own, place = np.unique(term, return_inverse=True)
            pos = np.bincount(place, toxic, len(own)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(pos), pa.array(np.bincount(place, ~toxic, len(own)).astype(np.int64))], names=["term", "pos", "neg"])

    counted = sample.mapInArrow(run, "term long, pos long, neg long").groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    seen = written(counted.filter(F.col("pos") >= LEAST), "terms")
    ratio, z = _rates(F.col("pos"), F.col("neg"), sizes, F.sqrt)
    alone = seen.filter((ratio > RATIO) & (z > Z)).orderBy(z.desc(), "term").select("term").toArrow()["term"].to_numpy()
    words = np.sort(seen.filter(F.col("term") < 1 << BITS).select("term").toArrow()["term"].to_numpy())  # a pair is no commoner than its words
    paired = _paired(sample, sizes, words)
    return _numbered(np.concatenate([alone, np.setdiff1d(paired, alone)]))


def train(rows: list[tuple[int, np.ndarray]], terms: int, epochs: int = 12, rate: float = 0.1, decay: float = 2e-4, seed: int = 3):
    """AdaGrad on the logistic loss: (bias, weights, vectors)."""
    rng = np.random.default_rng(seed)
    bias, weights, vectors = 0.0, np.zeros(terms), rng.normal(0, 0.02, (terms, FACTORS))
    gb, gw, gv = 1.0, np.full(terms, 0.1), np.full((terms, FACTORS), 0.1)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            y, own = rows[i]
            v = vectors[own]
            total = v.sum(0)
            x = bias + weights[own].sum() + 0.5 * (total @ total - (v * v).sum())
            slope = 1 / (1 + np.exp(-np.clip(x, -30, 30))) - y
            gb += slope * slope
            bias -= rate * slope / np.sqrt(gb)
            if len(own):
                step = slope + decay * weights[own]
                gw[own] += step * step
                weights[own] -= rate * step / np.sqrt(gw[own])
                step = slope * (total - v) + decay * v
                gv[own] += step * step
                vectors[own] = v - rate * step / np.sqrt(gv[own])
    return bias, weights, vectors


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: tuple[int, int] = SAMPLE):
    """The machine from labels.toxic; None where a class has no rows (then nothing is toxic). At most so many rows of each class train it."""
    sample, _ = labelled_sample(docs, labels, "toxic", most, id_col, text_col)
    sample = written(sample.select("doc_id", "label", "text"), "sample")
    sizes = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return None
    table = select(sample, sizes)
    return (table, *train(sample_terms(sample, table), int(table.max()) + 1))


def _scores(col: pa.Array, model) -> np.ndarray:
    if model is None:
        return np.zeros(len(col))
    table, bias, weights, vectors = model
    row, term = _hits(Rows(col, fold=True), table)
    x = bias + np.bincount(row, weights[term], len(col))
    for f in range(vectors.shape[1]):
        v = vectors[term, f]
        x += 0.5 * (np.bincount(row, v, len(col)) ** 2 - np.bincount(row, v * v, len(col)))
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def score(docs: DataFrame, model, text_col: str = "text", column: str = "score") -> DataFrame:
    """docs with a score of toxicity added; null text counts as empty."""
    held = sent(bounded(docs).sparkSession, model)

    @F.pandas_udf("double")
    def scored(texts):
        col, out = pa.array(texts, pa.string(), from_pandas=True), []
        for piece in text_batches([pa.RecordBatch.from_arrays([col], names=["text"])]):
            out.append(_scores(piece.column("text"), held.value))
        import pandas as pd

        return pd.Series(np.concatenate(out) if out else np.zeros(0), index=texts.index)

    return docs.withColumn(column, scored(F.col(text_col).cast("string")))


def training_labels(labels: DataFrame) -> DataFrame:
    """The rows that may be learned from: crc32 of the id as text, mod 3, isn't 1."""
    return labels.filter(crc_mod(F.col("doc_id"), 3) != 1)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """documents -> doc_id, held_out, score, predicted."""
    model = fit(docs, training_labels(labels), id_col, text_col)
    own = score(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), model)
    return own.select("doc_id", (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= REJECT).cast("int").alias("predicted"))
