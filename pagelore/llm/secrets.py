"""Secret scans: candidates by pattern, false positives removed by a random forest.

The forest is trained here from labelled findings: (text, start, end, label)
rows, by default a seeded set made by rule. Its features are a candidate's
length, its character classes and the transitions between them, how much of it
common words cover, path marks, and the words around it. The common words are
the corpus's own (dictionary()), beside a short fixed list.

Candidates are unbroken runs of 12 and more key characters; where a secret-like
name is assigned (``password: ...``), the whole quoted or non-blank value of 8
characters and more; and private-key blocks. The forest decides on all of them.
"""

import hashlib
import math
import random
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelore.llm.common import bounded, sent
from pagelore.llm.features import text_batches

RUN = re.compile(r"(?<![A-Za-z0-9+/=_.~\-])[A-Za-z0-9+/=_.~\-]{12,}")
BEGIN, END = re.compile(r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"), re.compile(r"-----END [A-Z ]{0,40}PRIVATE KEY-----")
VALUE = re.compile(r"(?<![\w.\-])([A-Za-z_][\w.\-]*)[\"']?[ \t]*[:=][ \t]*(?:\"([^\"\n]{8,256})\"|'([^'\n]{8,256})'|([^\s\"']{8,}))")
ASSIGNED = re.compile(r"([A-Za-z_][\w.\-]*)\s*[:=]\s*[\"']?$")
OWN = re.compile(r"([A-Za-z_][\w.\-]*)=(?=[^=])")
NAMES = re.compile(r"pass(?:word|wd)?|pwd|secret|token|api_?key|access_?key|auth|credential|private", re.I)
PLAIN = re.compile(r"\b(?:commit|sha\d*|md5|uuid|guid|id|isbn|order|card|phone|tel|version|rev|checksum|digest|hash|example|sample|dummy|page|http|www)\b", re.I)
PREFIX = re.compile(r"AKIA[0-9A-Z]{16}$|gh[pousr]_\w{20}|sk[-_]\w|xox[bap]-|eyJ[\w\-]+\.|AIza[\w\-]{30}|glpat-")
WORDS = (
    "the of and to in is that it for was on are as with they at be this from have or by one had not but what all were when we there can "
    "your which their said if do will each about how up out them then she many some so these would other into has more her two like him "
    "see time could make than first been its who now people made over did down only way find use may long little very after words called "
    "just where most know change example password secret token test user admin file path name data value key home index page config"
).split()
SHORTEST, LONGEST = 4, 12
#: Words of the corpus that count as common, and in how many rows they are at least.
COMMON, ROWS = 4096, 20
TREES, DEPTH, ACCEPT = 40, 9, 0.5
MASK = "[SECRET]"


def blocks(text: str) -> list[tuple[int, int]]:
    """Private-key blocks, in one pass: each from a BEGIN to the next END."""
    out, at = [], 0
    while (begin := BEGIN.search(text, at)) and (end := END.search(text, begin.end())):
        out.append((begin.start(), end.end()))
        at = end.end()
    return out


def candidates(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, name it is assigned to) of strings that could be secrets, in order, without overlaps."""
    taken = [(s, e, "private_key") for s, e in (blocks(text) if "-----BEGIN " in text else [])]
    inside = lambda s, e, own: any(s < y and e > x for x, y, _ in own[max(0, bisect_left(own, (s,)) - 1) : bisect_left(own, (e,))])
    assigned = []
    for m in VALUE.finditer(text):
        if NAMES.search(m[1]):
            start, end = next(m.span(i) for i in (2, 3, 4) if m[i] is not None)
            while end - start > 8 and text[end - 1] in ".,;)]}>":
                end -= 1
            if not inside(start, end, taken):
                assigned.append((start, end, m[1]))
    taken = sorted(taken + assigned)
    loose = []
    for m in RUN.finditer(text):
        start, end = m.span()
        name = OWN.match(text, start, end)
        key = name[1] if name else ""
        start = name.end() if name else start
        while end > start and text[end - 1] in ".-~":
            end -= 1
        if not key and (before := ASSIGNED.search(text, max(0, start - 40), start)):
            key = before[1]
        own = text[start:end]
        if len(own) >= 8 and (any(c.isdigit() for c in own) or (len(own) >= 16 and own.isupper())) and not inside(start, end, taken):
            loose.append((start, end, key))
    yield from sorted(taken + loose)


def dictionary(docs: DataFrame, text_col: str = "text", most: int = COMMON) -> frozenset[str]:
    """The commonest words of the corpus, by rows that hold them, of all rows: short of one bounded list, nothing reaches the driver."""
    own = F.regexp_extract_all(F.lower(F.col(text_col).cast("string")), F.lit(rf"(?<![a-z0-9])[a-z]{{{SHORTEST},{LONGEST}}}(?![a-z0-9])"), F.lit(0))
    seen = docs.select(F.explode(F.array_distinct(own)).alias("w")).groupBy("w").agg(F.count("*").alias("n")).filter(F.col("n") >= ROWS)
    return frozenset(r.w for r in seen.orderBy(F.desc("n"), "w").limit(most).collect()) | FIXED


FIXED = frozenset(w for w in WORDS if len(w) >= SHORTEST)


def covered(own: str, words: frozenset[str]) -> float:
    """The share of characters that dictionary words cover, longest first from the left."""
    low, at, total = own.lower(), 0, 0
    while at < len(low):
        n = next((n for n in range(min(LONGEST, len(low) - at), SHORTEST - 1, -1) if low[at : at + n] in words), 0)
        total, at = total + n, at + max(n, 1)
    return total / max(len(own), 1)


def _kind(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def features(text: str, start: int, end: int, key: str, words: frozenset[str] = FIXED) -> list[float]:
    own, before, after = text[start:end], text[max(0, start - 40) : start], text[end : end + 12]
    n, kinds = len(own), [_kind(c) for c in own]
    moves = np.bincount([4 * a + b for a, b in zip(kinds, kinds[1:], strict=False)], minlength=16) / max(n - 1, 1)
    counts = np.bincount(kinds, minlength=4) / n
    entropy = -sum(k / n * math.log2(k / n) for k in Counter(own).values())
    near = f"{before} {after}"
    return [
        n, *counts, *moves, entropy, entropy / math.log2(n + 1), len(set(own)) / n, covered(own, words),
        float(all(c in "0123456789abcdef" for c in own.lower())), float(own.isdigit()), own.count("/"), own.count("."), own.count("-"),
        float("/" in before[-1:] or "//" in before[-12:] or "/" in after[:1]), float(bool(NAMES.search(key))), float(bool(key)),
        float(bool(NAMES.search(near))), float(bool(PLAIN.search(before[-24:]))), float(bool(PREFIX.match(own))), float(before[-1:] in "\"'" and bool(before)),
        float(n in (32, 36, 40, 64)), float(own.startswith("-----")), float(any(c in "!@#$%&*^?" for c in own)), float(" " in own or "\\n" in own), max((len(x) for x in re.findall(r"[a-z]+|[A-Z]+", own)), default=0) / n,
    ]


def labelled_findings(seed: int = 11, each: int = 150) -> list[tuple[str, int, int, int]]:
    """A bounded labelled set made by rule: ``each`` findings of every shape."""
    rng = random.Random(seed)
    low, up, dig = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    some = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    prose = lambda n: " ".join(rng.choice(WORDS) if rng.random() < 0.5 else some(low, rng.randint(2, 9)) for _ in range(n))
    alnum, hexa = low + up + dig, dig + "abcdef"
    quote = lambda: rng.choice(["", '"', "'"])
    name = lambda: rng.choice(["password", "passwd", "PASSWORD", "db_password", "token", "access_token", "secret", "client_secret", "api_key", "API_KEY", "apikey", "auth_token"])
    other = lambda: rng.choice(["id", "commit", "sha256", "uuid", "order", "ref", "checksum", "version", "page", "card"])
    url = lambda: f"{some(low, 6)}.example.com/{some(low, 5)}/{some(alnum, rng.randint(4, 16))}"
    shapes = [
        (1, lambda: ("", "AKIA" + some(up + dig, 16))), (1, lambda: (f"{name()}{rng.choice(['=', ' = ', ': '])}{quote()}", some(hexa, rng.choice([16, 18, 20, 24, 32, 40, 64])))),
        (1, lambda: (f"{name()}{rng.choice(['=', ' = ', ': '])}{quote()}", some(alnum, rng.randint(12, 44)))), (1, lambda: ("", rng.choice(["ghp_", "gho_"]) + some(alnum, 36))),
        (1, lambda: ("", rng.choice(["sk_live_", "sk-", "glpat-"]) + some(alnum, rng.randint(20, 40)))), (1, lambda: ("", f"xoxb-{some(dig, 11)}-{some(alnum, 24)}")),
        (1, lambda: ("", f"eyJ{some(alnum, 30)}.{some(alnum, 40)}.{some(alnum + '-_', 40)}")), (1, lambda: (f"{name()}={quote()}", some(alnum + "+/", 40))),
        (0, lambda: ("", some(dig, rng.randint(12, 19)))), (0, lambda: (f"{other()} {rng.choice(['', '= ', ': '])}", some(hexa, rng.choice([32, 40, 64])))),
        (0, lambda: (rng.choice(["", "uuid ", "id="]), "-".join(some(hexa, k) for k in (8, 4, 4, 4, 12)))), (0, lambda: ("https://", url())), (0, lambda: ("", "/" + "/".join(some(low, 5) for _ in range(3)) + f"/{some(low, 6)}{some(dig, 2)}.txt")),
        (0, lambda: ("", "".join(rng.choice(WORDS).title() for _ in range(3)) + some(dig, 2))), (0, lambda: (f"{name()}=", rng.choice(["changeme123", "example-password", "your_password_here", "password1234", "xxxxxxxxxxxx", "test-password"]))),
        (0, lambda: ("", f"{rng.choice(WORDS)}-{rng.choice(WORDS)}-{rng.choice(WORDS)}-{some(dig, 2)}")), (0, lambda: ("", f"20{some(dig, 2)}-0{some('123456789', 1)}-1{some(dig, 1)}T1{some(dig, 1)}.{some(dig, 3)}")),
        (0, lambda: ("", some(up, rng.randint(16, 30)))), (0, lambda: ("", some(low, rng.randint(10, 18)) + some(dig, 1))), (0, lambda: (f"+{some(dig, 1)} (", some(dig, 3) + "-" + some(dig, 4) + "-" + some(dig, 4))),
        (0, lambda: ("v", ".".join(some(dig, rng.randint(1, 3)) for _ in range(5)))), (0, lambda: ("", some(dig, 3) + "." + some(dig, 3) + "." + some(dig, 2) + "." + some(dig, 3))),
        (1, lambda: (f"{name()}{rng.choice([' = ', ': ', '='])}{quote()}", some(alnum, 5) + some("!@#$%&*?", 1) + some(alnum, rng.randint(3, 8)) + some(dig, 1))),
        (1, lambda: (f"{name()}{rng.choice([' = ', ': ', '='])}{quote()}", some(low, rng.randint(4, 7)) + some(dig, rng.randint(2, 5)) + some(alnum, rng.randint(1, 3)))),
        (1, lambda: (f"{name()}{rng.choice([' = ', ': ', '='])}{quote()}", some(hexa, rng.randint(8, 12)))),
        (1, lambda: ("", f"-----BEGIN {rng.choice(['', 'RSA ', 'EC '])}PRIVATE KEY-----\n" + "\n".join(some(alnum + "+/", 64) for _ in range(rng.randint(2, 8))) + "\n-----END PRIVATE KEY-----")),
        (0, lambda: ("", f"-----BEGIN PRIVATE KEY-----\n{rng.choice(['...', 'your key here', '<key>', 'xxxxxxxx', 'example example'])}\n-----END PRIVATE KEY-----")),
        (0, lambda: (f"{name()}{rng.choice([' = ', ': ', '='])}{quote()}", rng.choice(["$" + "{" + some(up, 8) + "}", "<your-" + rng.choice(WORDS) + ">", "os.environ[" + some(up, 6) + "]", "getenv(" + some(up, 7) + ")", "********", "xxxxxxxx", "REDACTED", "changeme", "undefined", "required"]))),
        (0, lambda: (f"{name()}{rng.choice([': ', ' = '])}", "".join(rng.choice(list(FIXED)) for _ in range(rng.randint(2, 3))))),
    ]
    out = []
    for label, make in shapes:
        for _ in range(each):
            lead, own = make()
            before = f"{prose(rng.randint(0, 8))} {lead}".lstrip(" ") if rng.random() < 0.9 else lead
            close = before[-1:] if before[-1:] in ("'", '"') else ""
            out.append((f"{before}{own}{close} {prose(4)}", len(before), len(before) + len(own), label))
    return out


def _matrix(findings: list[tuple[str, int, int, int]], words: frozenset[str]) -> tuple[np.ndarray, np.ndarray]:
    rows, labels = [], []
    for text, start, end, label in findings:
        for s, e, key in candidates(text):
            if s < end and e > start:
                rows.append(features(text, s, e, key, words))
                labels.append(label)
    return np.array(rows), np.array(labels)


def _grow(x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """One tree as rows (feature or -1, threshold, left, right, share of label 1)."""
    nodes: list[list[float]] = []

    def node(own: np.ndarray, depth: int) -> int:
        at, share = len(nodes), float(y[own].mean())
        nodes.append([-1, 0.0, 0, 0, share])
        if depth >= DEPTH or share in (0.0, 1.0) or len(own) < 6:
            return at
        best = (share * (1 - share) * len(own) - 1e-9, -1, 0.0)
        for f in rng.choice(x.shape[1], max(1, int(math.sqrt(x.shape[1]))), replace=False):
            values = x[own, f]
            for t in np.unique(np.quantile(values, [0.1, 0.25, 0.4, 0.5, 0.6, 0.75, 0.9])):
                left = values <= t
                k = int(left.sum())
                if 2 < k < len(own) - 2:
                    a, b = y[own[left]].mean(), y[own[~left]].mean()
                    gini = a * (1 - a) * k + b * (1 - b) * (len(own) - k)
                    if gini < best[0]:
                        best = (gini, int(f), float(t))
        if best[1] >= 0:
            left = x[own, best[1]] <= best[2]
            nodes[at][:4] = [best[1], best[2], node(own[left], depth + 1), node(own[~left], depth + 1)]
        return at

    node(rng.integers(0, len(y), len(y)), 0)
    return np.array(nodes)


class Forest(NamedTuple):
    trees: list[np.ndarray]
    words: frozenset[str] = FIXED


def fit(findings: list[tuple[str, int, int, int]] | None = None, trees: int = TREES, seed: int = 1, words: frozenset[str] = FIXED) -> Forest:
    """A random forest from labelled findings (bounded: they are held on the driver) and a dictionary."""
    x, y = _matrix(labelled_findings() if findings is None else findings, words)
    rng = np.random.default_rng(seed)
    return Forest([_grow(x, y, rng) for _ in range(trees)], words)


def predict(forest: Forest, x: np.ndarray) -> np.ndarray:
    total = np.zeros(len(x))
    for tree in forest.trees:
        at = np.zeros(len(x), np.int64)
        for _ in range(DEPTH + 1):
            f = tree[at, 0].astype(np.int64)
            inner = f >= 0
            go = np.where(x[np.arange(len(x)), np.maximum(f, 0)] <= tree[at, 1], tree[at, 2], tree[at, 3]).astype(np.int64)
            at = np.where(inner, go, at)
        total += tree[at, 4]
    return total / max(len(forest.trees), 1)


def scan(texts: list[str | None], forest: Forest) -> list[list[tuple[int, int, str, float]]]:
    """(start, end, name, score) of accepted findings of each text, in order."""
    found, rows, where = [[] for _ in texts], [], []
    for i, text in enumerate(texts):
        for s, e, key in candidates(text or ""):
            rows.append(features(text, s, e, key, forest.words))
            where.append((i, s, e, key))
    if rows:
        for (i, s, e, key), p in zip(where, predict(forest, np.array(rows)), strict=True):
            if p >= ACCEPT:
                found[i].append((s, e, key, float(p)))
    return [sorted(f) for f in found]


def findings(docs: DataFrame, forest=None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """documents -> doc_id, start, length (code points), name, score, value_sha256 of each accepted finding. Null text has none."""
    held = sent(bounded(docs).sparkSession, forest or fit(words=dictionary(docs, text_col)))

    def run(batches):
        for batch in text_batches(batches):
            texts = batch.column("text").to_pylist()
            ids = batch.column("doc_id").to_pylist()
            out = [(d, s, e - s, key, p, hashlib.sha256(t[s:e].encode()).hexdigest()) for d, t, fs in zip(ids, texts, scan(texts, held.value), strict=True) for s, e, key, p in fs]
            cols = list(zip(*out, strict=True)) or [[]] * 6
            types = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["doc_id", "start", "length", "name", "score", "value_sha256"])

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return own.mapInArrow(run, "doc_id long, start int, length int, name string, score double, value_sha256 string")


def redacted(docs: DataFrame, forest=None, text_col: str = "text") -> DataFrame:
    """documents with each accepted finding replaced by MASK; nulls stay null."""
    held = sent(bounded(docs).sparkSession, forest or fit(words=dictionary(docs, text_col)))

    @F.pandas_udf("string")
    def mask(texts: pd.Series) -> pd.Series:
        out = []
        for text, found in zip(texts, scan(list(texts), held.value), strict=True):
            for s, e, _, _ in reversed(found):
                text = text[:s] + MASK + text[e:]
            out.append(text)
        return pd.Series(out, index=texts.index, dtype=object)

    return docs.withColumn(text_col, mask(F.col(text_col)))
