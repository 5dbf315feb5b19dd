"""Repeat removal against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from pagelore.llm import repeats


def brute(rows, length):
    texts = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(t[i : i + length] for _, t in texts for i in range(len(t) - length + 1))
    out = []
    for d, t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(t, gone, strict=False) if not g)
        out.append((d, len(t), int(gone.sum()), int((gone[:-1] & ~gone[1:]).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def fixture(seed, n, alphabet, size):
    rng = np.random.default_rng(seed)
    word = lambda k: "".join(alphabet[i] for i in rng.integers(0, len(alphabet), k))
    shared = [word(size) for _ in range(5)]
    rows = [(i, word(int(rng.integers(0, size))) + shared[int(rng.integers(0, 5))][int(rng.integers(0, size // 2)) :] + word(int(rng.integers(0, size)))) for i in range(n)]
    rows += [(900, None), (901, ""), (5, rows[5][1]), (None, rows[6][1]), (902, alphabet[0] * size), (903, word(3) * (size // 2)), (904, rows[7][1])]
    return rows


@pytest.mark.parametrize(("seed", "alphabet", "hot"), [(1, "ab", 10**9), (2, "abcdé", 10**9), (3, "abcd", 3)])
def test_small_strings(spark, seed, alphabet, hot):
    rows = fixture(seed, 60, alphabet, 60)
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, key string")
    got = repeats.remove(docs, length=20, gram=6, hot=hot)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, 20)


@pytest.mark.parametrize("crowds", [2, 50, 10**6])
def test_crowded_windows(spark, monkeypatch, crowds):
    monkeypatch.setattr(repeats, "CROWDS", crowds)
    rng = np.random.default_rng(6)
    word = lambda k: "".join("abcdefgh"[i] for i in rng.integers(0, 8, k))
    common, rare = word(30), word(26)
    rows = [(i, word(5) + common + word(i % 7)) for i in range(80)] + [(100 + i, rare + word(9)) for i in range(3)]
    got = repeats.remove(spark.createDataFrame(rows, "doc_id long, text string"), length=20, gram=6, hot=2)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, 20)


def test_400_bytes(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SEGMENT", 1000)
    rows = fixture(4, 40, "abcdefgh ", 900)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in repeats.remove(docs).collect()), key=str) == brute(rows, 400)
    assert repeats.remove(docs.limit(0)).collect() == []


def test_anchors_are_shared():
    rng = np.random.default_rng(0)
    own = rng.integers(97, 101, 5000).astype(np.uint8)
    at, codes = repeats.anchors(own, 40, 10)
    for s in range(0, 4960, 7):
        inside = {int(p) - s for p in at if s <= p <= s + 30}
        alone, _ = repeats.anchors(own[s : s + 40], 40, 10)
        assert {int(p) for p in alone} <= inside and len(alone) == 1


def test_groups(spark):
    part = "the quick brown fox jumps over the lazy dog"
    texts = {1: "xx " + part + " yy", 2: "zz " + part + " ww", 3: "aa" + part + "!"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    keys = {r.key: texts[r.doc_id] for r in repeats._own(docs, "doc_id", "text").collect()}
    found = {}
    for r in repeats.groups(docs, length=20, gram=6).collect():
        found.setdefault(r.repeat, []).append(keys[r.key][r.st : r.st + r.n_bytes])
    assert all(len(set(v)) == 1 and len(v) > 1 and len(v[0]) >= 20 for v in found.values())
    assert {len(v) for v in found.values()} == {2, 3}  # two of the texts agree on one more blank at either end


def all_maximal(texts, length):
    """Strings of length bytes and more whose occurrences aren't all followed, or all preceded, by one byte, with their places."""
    out = {}
    for t in texts.values():
        for i in range(len(t)):
            for j in range(i + length, len(t) + 1):
                out.setdefault(t[i:j], None)
    found = {}
    for x in out:
        at = [(d, i) for d, t in texts.items() for i in range(len(t) - len(x) + 1) if t.startswith(x, i)]
        before = {(texts[d][i - 1] if i else (d, i)) for d, i in at}
        after = {(texts[d][i + len(x)] if i + len(x) < len(texts[d]) else (d, i)) for d, i in at}
        if len(at) > 1 and len(before) > 1 and len(after) > 1:
            found[x] = set(at)
    return found


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_groups_are_all_maximal_repeats(spark, seed):
    rng = np.random.default_rng(seed)
    word = lambda k, a="abcdefgh": "".join(a[i] for i in rng.integers(0, len(a), k))
    left, right = word(4), word(12)
    texts = {i: word(int(rng.integers(0, 3)), "xyz") + (left if rng.random() < 0.6 else left[2:]) + right + word(int(rng.integers(0, 3)), "xyz") for i in range(9)}
    texts |= {100: "1" + left + right + "y", 101: "2" + left + right + "w", 102: "3" + right + "z"}  # a repeat inside a longer one
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    keys = {r.key: r.doc_id for r in repeats._own(docs, "doc_id", "text").collect()}
    found = {}
    for r in repeats.groups(docs, length=10, gram=4).collect():
        at = texts[keys[r.key]][r.st : r.st + r.n_bytes]
        found.setdefault(at, set()).add((keys[r.key], r.st))
    assert found == all_maximal(texts, 10)
