"""Fingerprints, mixing, packing and quotes against plain Python."""

import random
import re
import time

import hashlib

import pytest
from pyspark.sql import functions as F

from pagelore.llm import mixing, multiset, packing, quoting

DOCS = "doc_id long, text string, lang string, source string, extra string"


def docs(spark, rows):
    return spark.createDataFrame([(*r, None, None, "x")[:5] if len(r) < 5 else r for r in rows], DOCS)


TEXTS = [(5, "One. Two.\nThree."), (3, "Three.\nOne. Two."), (9, None), (7, ""), (4, "éà𝒳 z"), (5, "One. Two.\nThree."), (None, "null id"), (1, "word " * 5000)]


def edited(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for i, (d, t) in enumerate(order):
        t, nxt = t or "", order[(i + 1) % len(order)][1] or ""
        half = len(t) // 2
        out.append((d, len(t), hashlib.sha256((t[: len(t) - half] + nxt[:half]).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("bucket", [1, 3, 2000])
def test_fingerprints(spark, monkeypatch, bucket):
    monkeypatch.setattr(multiset, "BUCKET", bucket)
    got = multiset.fingerprints(docs(spark, TEXTS)).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=str) == edited(TEXTS)
    prints = {r.doc_id: r.fingerprint for r in got}
    assert prints[5] == prints[3] and prints[9] == prints[7] != prints[5]
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert multiset.fingerprints(docs(spark, TEXTS).limit(0)).collect() == []


def test_vectors_add_and_subtract(spark):
    v = lambda t: multiset.vector(F.lit(t))
    row = spark.range(1).select(
        (multiset.add(v("a b.\nc."), v("d.")) == v("d.\na b.\nc.")).alias("add"), (multiset.subtract(v("a.\nb.\nc."), v("b.")) == v("c.\na.")).alias("sub"),
        multiset.likeness(v("\n".join(f"s{i}." for i in range(40))), v("\n".join(f"s{i}." for i in range(20, 60)))).alias("half"),
        multiset.likeness(v("a.\nb."), v("c.\nd.")).alias("none"), multiset.likeness(v(""), v(None)).alias("empty"),
    ).first()
    assert row["add"] and row["sub"] and 0.25 < row["half"] < 0.75 and row["none"] < 0.4 and row["empty"] == 1


@pytest.mark.parametrize("n", [2_000, 20_000])
def test_likeness_of_long_texts(spark, n):
    text = lambda a, b: F.array_join(F.transform(F.sequence(F.lit(a), F.lit(b - 1)), lambda i: F.concat(F.lit("s"), i.cast("string"))), "\n")
    v = lambda c: multiset.vector(F.col(c))
    texts = spark.range(1).select(text(0, n).alias("a"), text(n // 10, n + n // 10).alias("b"), text(n // 2, n + n // 2).alias("c"), text(n, 2 * n).alias("d"))
    row = texts.select(multiset.likeness(v("a"), v("b")).alias("most"), multiset.likeness(v("a"), v("c")).alias("half"), multiset.likeness(v("a"), v("d")).alias("none")).first()
    assert 0.85 < row["most"] < 0.95 and 0.35 < row["half"] < 0.65 and row["none"] < 0.25


def test_mixing_meets_budget(spark):
    rows = [(i, "w " * (i % 7 + 1), "en" if i % 3 else None, f"src{i % 5}" if i % 11 else None, "x") for i in range(200)]
    own = docs(spark, rows)
    total = sum(i % 7 + 1 for i in range(200))
    uses = mixing.mix(own, (3, 2), {"domain": {"d0": 9}}, max_epochs=2).collect()
    assert total * 3 // 2 - 30 <= sum(r.taken for r in uses) <= total * 3 // 2
    assert len({(r.doc_id, r.epoch) for r in uses}) == len(uses) and max(r.epoch for r in uses) <= 1
    assert sum(r.taken for r in mixing.mix(own, (9, 1)).collect()) == total
    assert mixing.mix(own.limit(0)).collect() == []


def test_shortage_goes_to_siblings_first(spark):
    leaves = spark.createDataFrame([("a", "en", "s1", 10, 10), ("a", "en", "s2", 500, 500), ("b", "en", "s3", 500, 500)], "domain string, lang string, source string, tokens long, room long")
    got = {r.source: r.share for r in mixing.budgets(leaves, 200).collect()}
    assert got == {"s1": 10, "s2": 90, "s3": 100}


def test_packing(spark):
    sizes = [(i, (i * 37) % 900) for i in range(300)] + [(1000, 10_000), (1001, 0), (None, 5)]
    got = packing.best_fit(spark.createDataFrame(sizes, "doc_id long, n_tokens long")).collect()
    bins = {}
    for r in got:
        if r.bin_id is None:
            assert r.n_tokens == 0
        else:
            bins.setdefault(r.bin_id, []).append(r)
    for rows in bins.values():
        rows.sort(key=lambda r: r.bin_offset)
        end = 0
        for r in rows:
            assert r.bin_offset == end
            end += r.n_tokens
        fits = [n for n in packing.LENGTHS if n >= end]
        assert fits and rows[0].bin_size == min(fits)
    assert sum(r.n_tokens for r in got) == sum(n for _, n in sizes)
    assert sum(r[0].bin_size for r in bins.values()) < 1.1 * sum(n for _, n in sizes)
    assert packing.best_fit(spark.createDataFrame([], "doc_id long, n_tokens long")).collect() == []


def test_quotes(spark):
    rows = [
        (1, 0, "user", "How do I pack?\nThanks"), (1, 1, "assistant", "Use best fit."), (1, 2, "user", "And chat?"),
        (1, 3, "user", "> Use  BEST fit.\nWhy?"), (1, 4, "assistant", "> Why?\n>> Use best fit.\nBecause."), (1, 5, "user", "> never said\nhm"),
        (1, 6, "user", ">> How do I pack?\n> unknown"), (2, 0, "user", None), (None, 0, "user", "x"), (2, None, "user", "> y"),
        (3, 0, "a", "same"), (3, 1, "a", "same"), (3, 2, "b", "> same\nok"), (3, 2, "b", "> same\nok"), (3, 3, "a", "> ok"),
    ]
    got = quoting.conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    one = sorted((r for r in got if r.conv_id == 1), key=lambda r: r.position)
    assert [(r.turn, r.reply_to) for r in one] == [(0, None), (6, 0), (1, None), (3, 1), (4, 3), (2, None), (5, None)]
    assert one[3].content == "Why?" and one[4].content == "Because." and one[4].n_quotes == 2
    three = sorted((r for r in got if r.conv_id == 3), key=lambda r: r.position)
    assert [(r.turn, r.reply_to, r.thread) for r in three] == [(0, None, 0), (1, None, 1), (2, 1, 1), (2, 1, 1), (3, 2, 1)]
    assert len(got) == len(rows)
    assert quoting.conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []


def _quoted(rows):
    """(conv_id, turn) -> reply_to, message by message."""
    plain = lambda t: re.sub(r"\s+", " ", t).strip(" ").lower()
    mark = re.compile(r"^[ \t]*>[> \t]*")
    out, bodies = {}, {}
    for conv, turn, _, text in rows:
        runs = []
        for line in re.split(r"\r?\n", text):
            lead = (mark.match(line) or [""])[0]
            level = lead.count(">")
            own = line[len(lead) :] if level else line
            if runs and runs[-1][0] == level:
                runs[-1][1].append(own)
            else:
                runs.append((level, [own]))
        body = re.sub(r"\n{3,}", "\n\n", "\n".join("\n".join(x) for n, x in runs if not n)).strip(" \n\t\r")
        bodies[conv, turn] = {plain(p) for p in [body, *re.split(r"\n[ \t]*\n", body), *body.split("\n")]} - {""}
        asks = {(2 * n + k, plain(p)) for n, x in runs if n for k, ps in ((0, ["\n".join(x)]), (1, x)) for p in ps} - {(None, "")}
        found = [(-rank, t) for rank, p in asks if p for (c, t), held in bodies.items() if c == conv and t < turn and p in held]
        out[conv, turn] = max(found)[1] if found else None
    return out


def test_links_against_every_message(spark, monkeypatch):
    monkeypatch.setattr(quoting, "RUN", 5)
    rng, said, rows = random.Random(8), {}, []
    phrases = [f"{a} {b}" for a in ("How do", "why not", "I think", "same") for b in ("you pack", "we  chat", "it works", "OK")]
    for conv in range(12):
        for turn in range(rng.randint(1, 25)):
            lines = []
            if turn and rng.random() < 0.8:
                for _ in range(rng.randint(1, 3)):
                    old = rng.choice(said[conv]) if rng.random() < 0.8 else "gone for good"
                    mark = rng.choice(["> ", ">", ">> ", "> > ", ">>> "])
                    lines += [mark + x for x in old.split("\n")[: rng.randint(1, 3)]]
            lines += [rng.choice(phrases) for _ in range(rng.randint(0, 3))]
            lines += rng.choice([[], ["", rng.choice(phrases)]])
            said.setdefault(conv, []).append("\n".join(x for x in lines if not x.startswith(">")) or "-")
            rows.append((conv, turn, "u", "\n".join(lines)))
    got = quoting.conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    want = _quoted(rows)
    assert {(r.conv_id, r.turn): r.reply_to for r in got} == want and sum(v is not None for v in want.values()) > 40
    for r in got:
        assert r.thread == r.turn if r.reply_to is None else r.thread < r.turn


def test_a_long_message_of_many_passages(spark):
    long = "\n".join(f"> line {i}" if i % 2 else f"answer {i}" for i in range(20_000))
    rows = [(1, 0, "u", "line 4001"), (1, 1, "u", long)]
    began = time.time()
    got = {r.turn: r for r in quoting.conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got[1].reply_to == 0 and got[1].n_quotes == 10_000 and time.time() - began < 90
