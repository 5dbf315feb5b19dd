"""The n-gram Jaccard join against all pairs, and the pipeline's stage on it."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from pagelore.llm import bytehash, common, ngram_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, component_id string, id long"


def shingles(text):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def brute(rows):
    sets = {d: shingles(t) for d, t in rows if d is not None}
    part = {d: d for d in sets}
    for a in sorted(sets):
        for b in sets:
            if a < b and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((part[a], part[b]))
                part = {d: low if c == high else c for d, c in part.items()}
    return {d: (len(sets[d]), part[d]) for d in sets}


def corpus(seed):
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(60)]
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "ONE"), (6, "a b c d"), (None, "a b c d"), (None, None), (7, "é " * 3000), (8, "é " * 2000 + "x")]
    for i in range(90):
        own = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3, 4])):
            at = rng.randrange(len(own))
            own[at : at + 1] = rng.choice([[], [f"n{rng.randrange(500)}"], [own[at], "x"]])
        rows.append((100 + i, " ".join(own)))
    rows += [(300 + i, " ".join(rng.choice(base) for _ in range(rng.randrange(3, 40)))) for i in range(30)]
    return [*rows, rows[-1]]


@pytest.mark.parametrize(("seed", "frequent", "crowd"), [(1, 2, 64), (2, 8, 2), (3, 10_000, 4)])
def test_against_all_pairs(spark, monkeypatch, seed, frequent, crowd):
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    monkeypatch.setattr(ngram_join, "CROWD", crowd)
    monkeypatch.setattr(ngram_join, "EARLIER", 3)
    rows = corpus(seed)
    got = ngram_join.join(spark.createDataFrame([(*r, "x", 5) for r in rows], DOCS)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == brute(rows)
    assert len(got) == len(rows) and all(r.component_id is None for r in got if r.doc_id is None)


def test_empty(spark):
    assert ngram_join.join(spark.createDataFrame([], DOCS)).collect() == []


def test_sketches_lose_no_link():
    rng = np.random.default_rng(5)
    ruled_out = 0
    for _ in range(400):
        n, m = rng.integers(1, 200, 2)
        common = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        a, b = (np.unique(np.concatenate([common, rng.integers(0, 1 << 63, rng.integers(0, m), dtype=np.uint64)])) for _ in range(2))
        same = len(np.intersect1d(a, b))
        link = 100 * same >= 75 * (len(a) + len(b) - same)
        may = ngram_join.may_link(ngram_join.sketch(a), ngram_join.sketch(b), len(a), len(b), 75, 100)
        assert may or not link
        ruled_out += not may
    assert ruled_out > 100


def test_near_misses_are_ruled_out():
    """Copies of a text that miss the threshold by a few tokens: few of those pairs get past either bitmap, and no link is lost."""
    rng, owns = random.Random(8), []
    for i in range(160):
        words = [f"w{j}" for j in range(150)]
        for at in rng.sample(range(150), rng.choice([2, 2, 3])):
            words[at] = f"n{i}x{at}"
        owns += bytehash.row_shingles(pa.array([" ".join(words)]))
    misses, past_marks, past_sketch = 0, 0, 0
    sketches, marks = [ngram_join.sketch(x) for x in owns], [ngram_join.marks(x).tobytes() for x in owns]
    for i, j in itertools.combinations(range(len(owns)), 2):
        same = len(np.intersect1d(owns[i], owns[j], assume_unique=True))
        n, m = len(owns[i]), len(owns[j])
        link = 100 * same >= 75 * (n + m - same)
        may = [ngram_join.may_link(x[i], x[j], n, m, 75, 100) for x in (marks, sketches)]
        assert all(may) or not link
        if not link:
            misses, past_marks, past_sketch = misses + 1, past_marks + may[0], past_sketch + may[1]
    assert misses > 1000 and past_marks < misses / 5 and past_sketch < misses / 5, (misses, past_marks, past_sketch)


def test_stage_keeps_one_of_each_group(spark):
    import corpus_pipeline

    rows = corpus(4)
    docs = spark.createDataFrame([(*r, "x", 5) for r in rows], DOCS)
    got = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    want = [d for d, (_, c) in brute(rows).items() if d == c] + [d for d, _ in rows if d is None]
    assert sorted((r.doc_id for r in got), key=str) == sorted(want, key=str)
    assert set(docs.columns) == set(got[0].asDict())


@pytest.mark.parametrize("edges", [3, 1 << 18])
def test_components(spark, monkeypatch, edges):
    monkeypatch.setattr(common, "EDGES", edges)
    rng = random.Random(edges)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(30)]
    part = {x: x for e in links for x in e}
    for _ in links:
        for a, b in links:
            part[a] = part[b] = min(part[a], part[b])
    got = {r.node: r.component for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: c for x, c in part.items() if x in got} and all(x in got or not any(x in e and e[0] != e[1] for e in links) for x in part)
    assert common.components(spark.createDataFrame([], "a long, b long")).collect() == []
