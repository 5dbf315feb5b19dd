"""Quality, toxicity and language: base counts by brute force, models by held-out rows."""

import re

import numpy as np
import pyarrow as pa
import pytest

from pagelore.llm import bytehash, features, language, quality, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = ["", None, "one", "a b c d e a b c d e a b c d e f g h i j", "x\nx\n\n \n \nx y\nx y", "é# 𝒳|\tß\x0b", "w " * 300, "# * $ % & | < >" * 3, "A a A a A a\r\nA a\r\nA a\r\n", "\n\n", "z" * 70000 + " q"]


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)]


def test_base_counts():
    got = quality.base_counts(pa.array(TEXTS, pa.string()))
    assert [list(map(int, r)) for r in zip(*got.values(), strict=True)] == [brute(t) for t in TEXTS]


def test_words_and_shingles():
    col = pa.array(["Ab c", "ab  c\n", None, "é é", "c ab"], pa.string())
    sets = [x.tolist() for x in bytehash.row_shingles(col)]
    assert sets[0] == sets[1] and sets[2] == [] and sets[0] != sets[4] and len(sets[3]) == 1
    long = " ".join(f"w{i % 50}" for i in range(500))
    assert len(next(bytehash.row_shingles(pa.array([long])))) == 50
    cut = pa.array(["zzz", *TEXTS]).slice(1)
    assert [x.tolist() for x in bytehash.row_shingles(cut)] == [x.tolist() for x in bytehash.row_shingles(pa.array(TEXTS, pa.string()))]


def test_pieces_cut_anywhere(monkeypatch):
    col = pa.array(TEXTS, pa.string())
    whole = [x.tolist() for x in bytehash.row_shingles(col)]
    monkeypatch.setattr(bytehash, "PIECE", 7)
    assert [x.tolist() for x in bytehash.row_shingles(col)] == whole


RNG = np.random.default_rng(1)
GOOD, BAD = [f"word{i}" for i in range(80)], [f"##{i}!!" for i in range(30)]
INSULT = ["moron", "scum", "clown"]


def prose(words, n, extra=()):
    own = [words[i] for i in RNG.integers(0, len(words), n)]
    for x in extra:
        own[int(RNG.integers(0, n))] = x
    return " ".join(own)


@pytest.fixture(scope="module")
def corpus(spark):
    rows, labels = [], []
    for i in range(240):
        bad, toxic = i % 4 == 0, i % 3 == 0
        rows.append((i, prose(BAD if bad else GOOD, 60, [INSULT[i % 2 + (i % 5 == 0)]] * 2 if toxic else ()), "x"))
        labels.append((i, int(not bad), int(toxic)))
    rows += [(1000, None, "x"), (1001, "", "x"), (None, "word1 word2", "x"), (5, "word1 again", "x")]
    labels += [(1000, None, None), (None, 1, 1), (99999, 0, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality(corpus):
    docs, labels = corpus
    got = {r.doc_id: r for r in quality.score(docs, quality.fit(docs, labels)).collect()}
    right = [(got[i].quality >= 0.5) == (i % 4 != 0) for i in range(240) if i != 5]
    assert np.mean(right) > 0.95 and got[1000].base_failed and not got[1001].kept
    assert quality.score(docs.limit(0), quality.fit(docs, labels.limit(0))).collect() == []
    assert all(r.kept != r.base_failed for r in quality.score(docs, None).collect())


def test_toxicity(corpus):
    docs, labels = corpus
    got = {r.doc_id: r for r in toxicity.classify(docs, labels).collect()}
    held = [i for i in range(240) if got[i].held_out and i != 5]
    assert len(held) > 40 and np.mean([got[i].predicted == (i % 3 == 0) for i in held]) > 0.9
    assert all(0 <= r.score <= 1 for r in got.values()) and got[1000].score == got[1001].score
    assert {r.predicted for r in toxicity.classify(docs, labels.limit(0)).collect()} == {0}


def test_machine_learns_pairs():
    rng = np.random.default_rng(0)
    rows = [(int(0 in t and 1 in t), np.array(sorted(t), np.int64)) for t in ({int(x) for x in rng.choice(4, 2, replace=False)} for _ in range(400))]
    bias, weights, vectors = toxicity.train(rows, 4, epochs=60)

    def x(*own):
        v = vectors[list(own)]
        return bias + weights[list(own)].sum() + 0.5 * (v.sum(0) @ v.sum(0) - (v * v).sum())

    assert x(0, 1) > 0 > max(x(0, 2), x(0, 3), x(1, 2), x(1, 3), x(2, 3))


def pair_only(kind):
    """Rows and labels: toxic with both of two words (each in a fifth of the clean rows), or with an insult and a group that are as common alone."""
    rng, rows = np.random.default_rng(7), []
    for i in range(900):
        toxic = i % 5 == 0
        if kind == "both":
            extra = ["alpha", "omega"] if toxic else [["alpha"], ["omega"], [], [], []][int(rng.integers(5))]
        else:
            own = [["fool", "scrub", "gnat"][int(rng.integers(3))], ["zorv", "melk", "quib"][int(rng.integers(3))]]
            extra = own if toxic else [own[int(rng.integers(2))]]
        words = [GOOD[j] for j in rng.integers(0, len(GOOD), 60)] + extra
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(toxic)))
    return rows


@pytest.mark.parametrize("kind", ["both", "groups"])
def test_toxic_only_together(spark, kind):
    rows = pair_only(kind)
    got = {r.doc_id: r for r in toxicity.classify(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")).collect()}
    held = [(got[i].predicted, y) for i, _, y in rows if got[i].held_out]
    assert sum(y for _, y in held) > 40
    assert np.mean([p for p, y in held if y]) > 0.9 and np.mean([p for p, y in held if not y]) < 0.02


def test_language(spark):
    own = {"aa": [f"ba{c}a" for c in "bcdfg"], "bb": [f"ne{c}e" for c in "bcdfg"], "cc": [f"oto{c}" for c in "bcdfg"]}
    rows = [(i, prose(own[k], 30), k) for i, k in enumerate(list(own) * 60)]
    rows += [(900, None, "aa"), (901, "123 -- !", "bb"), (902, "", None), (903, "𝒳", "aa"), (904, prose(own["bb"], 20), None), (None, prose(own["cc"], 20), "cc")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language.predict(docs, language.learn(docs)).collect()}
    assert all(got[i].lang_pred == k for i, _, k in rows[:180])
    assert [got[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and got[903].lang_pred in own and got[904].lang_pred == "bb" and got[None].lang_pred == "cc"
    assert sum(r.held_out for r in got.values()) > 20
    assert {r.lang_pred for r in language.predict(docs.filter("doc_id < 3"), language.learn(docs.limit(0))).collect()} == {"und"}


def test_language_under_any_partitioning(spark):
    rows = [(i, prose([f"ba{c}a" for c in "bcdfghklmn"], 3), "aa") for i in range(40)] + [(100 + i, prose([f"ne{c}e" for c in "bcdfg"], 30), "bb") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    whole, parts = language.learn(docs.coalesce(1)), language.learn(spark.createDataFrame(spark.sparkContext.parallelize(rows, len(rows)), docs.schema))
    assert whole[0] == parts[0] and (whole[1] == parts[1]).all() and (whole[2] == parts[2]).all()


def test_more_languages_than_a_mask_word(spark):
    own = {f"l{k:03}": [f"{chr(97 + k % 26)}{chr(97 + k // 26)}{c}{chr(97 + k % 26)}{chr(97 + k // 26)}" for c in "bcdfg"] for k in range(140)}
    rows = [(i, prose(own[k], 20), k) for i, k in enumerate(list(own) * 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in language.predict(docs, language.learn(docs)).collect()}
    assert all(got[i] == k for i, _, k in rows)


def test_grams():
    own = np.frombuffer(b"abcab", np.uint8)
    code = features.grams(own, 2)
    assert code[0] == code[3] and len(set(code.tolist())) == 3 and len(features.grams(own, 6)) == 0
