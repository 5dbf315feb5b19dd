"""Operators against plain versions of their arithmetic: fingerprints, packing, language and quality scores, toxicity of pairs."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from pagelore.llm import language, multiset, packing, quality, toxicity
from pyspark.sql import functions as F


def test_likeness_follows_the_share_of_pieces(spark):
    """Against the true share of pieces that differ: symmetric difference over both sizes."""
    rng = random.Random(2)
    piece = lambda: " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) + str(rng.randrange(10**6)) for _ in range(4)) + "."
    rows = []
    for n in (1, 5, 40, 400, 3000):
        for share in (0.0, 0.1, 0.5, 1.0):
            a = [piece() for _ in range(n)]
            b = [piece() if rng.random() < share else x for x in a]
            rng.shuffle(b)
            rows.append((" ".join(a), " ".join(b)))
    got = spark.createDataFrame(rows, "a string, b string").select("a", "b", multiset.likeness(multiset.vector(F.col("a")), multiset.vector(F.col("b"))).alias("x")).collect()
    cut = lambda t: Counter(p for p in re.split(multiset.PIECES, t) if p)
    for r in got:
        a, b = cut(r.a), cut(r.b)
        apart = sum(((a - b) + (b - a)).values()) / (sum(a.values()) + sum(b.values()))
        n = sum(a.values())
        assert (r.x == 1) == (a == b) and (n < 5 or abs(r.x - (1 - apart)) < 0.3), (n, r.x, 1 - apart)


def plain_pack(sizes, lengths, price):
    """Best-fit decreasing by looking at every open bin and every size."""
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    bins, placed = [], {}
    for at, i in enumerate(order):
        fits = [(cap - used, b) for b, (cap, used) in enumerate(bins) if cap - used >= sizes[i]]
        if fits:
            _, b = min(fits)
        else:
            def each(length):
                room = length - sizes[i]
                later = sum(sizes[j] for j in order[at + 1 :] if sizes[j] <= room)
                return price(length) / (sizes[i] + min(room, later)), length

            bins.append((min((x for x in lengths if x >= sizes[i]), key=each), 0))
            b = len(bins) - 1
        cap, used = bins[b]
        placed[i] = (b, used)
        bins[b] = (cap, used + sizes[i])
    return [placed[i] for i in range(len(sizes))], [min(x for x in lengths if x >= used) for _, used in bins]


def test_packing_against_every_bin():
    rng = random.Random(7)
    for trial in range(60):
        lengths = rng.choice([(8, 16, 32), (10, 11, 40), (64,)])
        sizes = [rng.randint(1, max(lengths)) for _ in range(rng.randint(0, 60))]
        price = rng.choice([packing.cost, lambda n: n, lambda n: 5 + n * n / 50])
        assert packing.pack(sizes, lengths, price) == plain_pack(sizes, lengths, price), trial


def test_language_counts_against_sets(spark):
    rng = random.Random(3)
    texts = {"xx": ["brami lodu fenka tosi"], "yy": [" ".join(rng.choice(["chert", "vlump", "gorsh", "ptil"]) for _ in range(12)) for _ in range(40)]}
    rows = [(i, t, k) for i, (k, t) in enumerate(((k, t) for k, ts in texts.items() for t in ts), 1)]
    rows = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5] or rows
    docs = spark.createDataFrame([*rows, (1000, "lodu fenka", None), (1001, "vlump ptil", None), (1002, "12 34", None), (1003, None, None)], "doc_id long, text string, lang string")
    model = language.learn(docs.repartition(7))
    names, _, _ = model
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(docs, model).collect()}
    grams = {k: {x[i : i + n] for _, t, g in rows if g == k for x in [t] for n in language.SIZES for i in range(len(x) - n + 1)} for k in names}
    for d, t in ((1000, "lodu fenka"), (1001, "vlump ptil")):
        own = [t[i : i + n] for n in language.SIZES for i in range(len(t) - n + 1)]
        hits = {k: sum(x in grams[k] for x in own) for k in names}
        assert got[d][0] == max(hits, key=hits.get) and abs(got[d][1] - max(hits.values()) / sum(hits.values())) < 0.05
    assert got[1002][0] == got[1003][0] == "und"


def test_quality_score_by_hand(spark):
    rng = random.Random(4)
    good, bad = ["the river runs past an old mill", "we walked home in the late light"], ["buy now cheap pills", "click here win cash"]
    rows = [(i, " ".join(rng.choice(good if i % 2 else bad) + f" n{rng.randrange(99)}" for _ in range(6))) for i in range(120)]
    docs = spark.createDataFrame([*rows, (500, None), (501, "short text")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    weights, bias, slope, shift = model
    got = {r.doc_id: r for r in quality.score(docs, model).collect()}
    for d, t in rows[-10:]:
        feature = next(iter(quality._row_features(quality.Rows(quality.pa.array([t]), fold=False))))
        logit = bias + float(np.dot(feature[1], weights[feature[0]]))
        p = 1 / (1 + math.exp(-(slope * logit + shift)))
        assert abs(got[d].quality - p) < 1e-3 and got[d].kept == (not got[d].base_failed and p >= quality.KEEP)
    assert all(got[d].quality > 0.5 for d in range(101, 120, 2)) and all(got[d].quality < 0.5 for d in range(100, 120, 2))
    assert not got[500].kept and not got[501].kept and got[501].base_failed


def test_toxic_only_together_is_learned(spark):
    """Both words are common in clean texts; only their meeting is toxic."""
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(1800):
        a, b = rng.random() < 0.4, rng.random() < 0.4
        words = [f"w{rng.randrange(60)}" for _ in range(12)] + ["groupname"] * a + ["insulting"] * b
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(a and b)))
    got = toxicity.classify(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    truth = dict(labels)
    held = [r for r in got if r.held_out]
    caught = [r.predicted for r in held if truth[r.doc_id]]
    clean = [r.predicted for r in held if not truth[r.doc_id]]
    assert len(caught) > 50 and np.mean(caught) >= 0.9 and np.mean(clean) <= 0.02
