"""Quality rules: base counts, then a hashed n-gram logistic regression with calibrated probabilities."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelore.llm import bytehash as B
from pagelore.llm.common import bounded, sent
from pagelore.llm.features import Rows, labelled_sample, means, text_batches

U = np.uint64
GRAM, BITS = 3, 18
#: Training rows of quality 0 and 1 at most; documented bound of the labelled sample.
SAMPLE = (1500, 1500)
#: A document is kept from this probability of quality 1 on.
KEEP = 0.15
SCALE = 40.0
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True


def _row_features(rows: Rows) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(slots, shares) of each row: character 3-grams, then words; shares of each kind sum to SCALE."""
    g, w, ends = rows.gram_slots(GRAM, BITS), rows.word_slots(BITS) + (1 << BITS), rows.gram_ends(GRAM)
    for r in range(rows.n):
        out = []
        for own in (g[rows.at[r] : ends[r]], w[rows.bounds[r] : rows.bounds[r + 1]]):
            slot, n = np.unique(own, return_counts=True)
            out.append((slot.astype(np.int32), (n * (SCALE / max(len(own), 1))).astype(np.float32)))
        yield tuple(np.concatenate(x) for x in zip(*out, strict=True))


def sample_features(sample: DataFrame) -> list[tuple[int, np.ndarray, np.ndarray]]:
    def run(batches):
        for piece in text_batches(batches):
            found = list(_row_features(Rows(piece.column("text"), fold=False)))
            cols = [piece.column("doc_id"), piece.column("label"), pa.array([s.tobytes() for s, _ in found], pa.binary()), pa.array([v.tobytes() for _, v in found], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "label", "slots", "shares"])

    got = sample.select("doc_id", "label", "text").mapInArrow(run, "doc_id long, label int, slots binary, shares binary").orderBy("doc_id").toArrow()
    return [(y, np.frombuffer(s, np.int32), np.frombuffer(v, np.float32)) for y, s, v in zip(got["label"].to_pylist(), got["slots"].to_pylist(), got["shares"].to_pylist(), strict=True)]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = 8, rate: float = 0.15, decay: float = 1e-5, seed: int = 5) -> tuple[np.ndarray, float]:
    """AdaGrad logistic regression; weights and intercept."""
    weights, squares, bias, bias_square = np.zeros(2 << BITS), np.full(2 << BITS, 1e-2), 0.0, 1.0
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            y, slot, share = rows[i]
            slope = _sigmoid(bias + share @ weights[slot]) - y
            step = slope * share + decay * weights[slot]
            squares[slot] += step * step
            weights[slot] -= rate * step / np.sqrt(squares[slot])
            bias_square += slope * slope
            bias -= rate * slope / np.sqrt(bias_square)
    return weights, bias


def calibrate(logits: np.ndarray, labels: np.ndarray, prior: float) -> tuple[float, float]:
    """Platt scaling (slope, shift), rows weighted to the prior share of label 1, targets smoothed."""
    pos = max(labels.sum(), 1)
    neg = max((1 - labels).sum(), 1)
    weight = np.where(labels == 1, prior / pos, (1 - prior) / neg) * len(labels)
    target = np.where(labels == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))

    def loss(a: float, b: float) -> float:
        p = np.clip(_sigmoid(a * logits + b), 1e-12, 1 - 1e-12)
        return float(-(weight * (target * np.log(p) + (1 - target) * np.log(1 - p))).sum() + 0.5 * ((a - 1) ** 2 + 0.1 * b * b))

    a, b = 1.0, 0.0
    for _ in range(50):
        p = _sigmoid(a * logits + b)
        g, h = weight * (p - target), weight * p * (1 - p)
        grad = np.array([g @ logits + a - 1, g.sum() + 0.1 * b])
        hess = np.array([[h @ (logits * logits) + 1, h @ logits], [h @ logits, h.sum() + 0.1]])
        step, size, now = np.linalg.solve(hess, grad), 1.0, loss(a, b)
        while size > 1e-4 and loss(a - size * step[0], b - size * step[1]) > now:
            size /= 2
        a, b = a - size * step[0], b - size * step[1]
        if np.abs(size * step).max() < 1e-8:
            break
    return float(max(a, 1e-3)), float(b)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: tuple[int, int] = SAMPLE) -> tuple[np.ndarray, float, float, float] | None:
    """(weights, intercept, slope, shift) from labels.quality; None where a class has no rows (then nothing but the base rules decides)."""
    sample, sizes = labelled_sample(docs, labels, "quality", most, id_col, text_col)
    rows = sample_features(sample)
    if len({y for y, _, _ in rows}) < 2:
        return None
    held, own = rows[::4], [r for i, r in enumerate(rows) if i % 4]
    if len({y for y, _, _ in own}) < 2:
        held = own = rows
    weights, bias = train(own)
    logits = np.array([bias + v @ weights[s] for _, s, v in held])
    slope, shift = calibrate(logits, np.array([y for y, _, _ in held]), sizes[1] / (sizes[0] + sizes[1]))
    return weights.astype(np.float32), bias, slope, shift


def base_counts(col: pa.Array) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text."""
    data, at = B.utf8(col)
    _, _, words, bounds = B.words(data, at, lower=False)
    own = data[at[0] : at[-1]]
    rel = at - at[0]

    def count(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return sums[rel[1:]] - sums[rel[:-1]]

    dup, repeat = np.zeros(len(col), np.int64), np.zeros(len(col), np.int64)
    rolled = np.zeros(max(len(words) - 4, 0), U)
    for j in range(5):
        rolled += B.mix(words[j : j + len(rolled)] + U(j)) if len(rolled) else U(0)
    for r in range(len(col)):
        lines = own[rel[r] : rel[r + 1]].tobytes().split(b"\n")
        if len(lines) > 1:
            some = [x for x in lines if x.strip(b" \t\n\x0b\x0c\r")]
            dup[r] = len(some) - len(set(some))
        a, b = bounds[r], bounds[r + 1] - 4
        if b - a > 1:
            _, place, n = np.unique(rolled[a:b], return_inverse=True, return_counts=True)
            often = n[place] > 1
            if often.any():
                covered = np.zeros(b - a + 4, bool)
                for j in range(5):
                    covered[j : j + b - a] |= often
                repeat[r] = covered.sum()
    n_words = bounds[1:] - bounds[:-1]
    return {"n_words": n_words, "word_chars": count(~B._SEP[own] & ((own & 0xC0) != 0x80)), "n_symbols": count(SYMBOLS[own]), "n_dup_lines": dup, "n_repeat_words": repeat}


def score(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text", keep: float = KEEP) -> DataFrame:
    """documents -> doc_id, base counts, base_failed, quality (probability), kept. Null text has no words and fails."""
    held = sent(bounded(docs).sparkSession, model)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches):
        model = held.value
        for piece in text_batches(batches):
            base = base_counts(piece.column("text"))
            failed = (base["n_words"] < 10) | (100 * base["n_repeat_words"] > 20 * base["n_words"])
            p = np.ones(piece.num_rows)
            if model:
                weights, bias, slope, shift = model
                rows = Rows(piece.column("text"), fold=False)
                chars = means(weights[rows.gram_slots(GRAM, BITS)], rows.at[:-1], rows.gram_ends(GRAM))
                own = means(weights[rows.word_slots(BITS) + (1 << BITS)], rows.bounds[:-1], rows.bounds[1:])
                p = _sigmoid(slope * (bias + SCALE * (chars + own)) + shift)
            cols = [piece.column("doc_id"), *(pa.array(base[n].astype(np.int64)) for n in names), pa.array(failed), pa.array(p), pa.array(~failed & (p >= keep))]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", *names, "base_failed", "quality", "kept"])

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return own.mapInArrow(run, "doc_id long, " + ", ".join(f"{n} long" for n in names) + ", base_failed boolean, quality double, kept boolean")
