"""Language ID by bit-sliced Bloom filters of n-grams.

Each language's commonest 4- and 5-byte strings (folded, blanks alike) go into
one Bloom filter whose cells hold a bit for each language. ANDing a string's
cells gives all languages that have it. A language's hits in a text, less
those its false-positive rate would give, decide.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelore.llm.common import bounded, crc_mod, sent
from pagelore.llm.features import Rows, grams, slots, text_batches

SIZES, BITS, HASHES = (4, 5), 20, 2
#: About so many training documents and so many strings of each size for each language; the languages of a mask word.
SAMPLE, STRINGS, LANGUAGES = 1500, 4000, 64
UNKNOWN = "und"


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"):
    """(languages, cells, false-positive rates) from documents whose crc32 of the id, mod 5, isn't 0.

    Training documents are a sample of about SAMPLE a language, by a hash of the
    id. Cells are masks[language // 64, cell]. Null languages and texts aren't
    learned from.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    own = own.filter((crc_mod(F.col("doc_id"), 5) != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = own.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").collect()
    if not sizes:
        return None
    names = [r.lang for r in sizes]
    share = F.create_map(*(x for r in sizes for x in (F.lit(r.lang), F.lit(min(1.0, SAMPLE / r.n)))))
    sample = own.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.try_element_at(share, F.col("lang")) * (1 << 20))

    def count(batches):
        for piece in text_batches(batches):
            lang = piece.column("lang").to_numpy(zero_copy_only=False)
            for name in set(lang.tolist()):
                rows = Rows(piece.filter(pa.array(lang == name)).column("text"), fold=True)
                for n in SIZES:
                    code = grams(rows.own, n)
                    at = np.arange(len(code))
                    inside = at < rows.gram_ends(n)[np.searchsorted(rows.at, at, "right") - 1]  # not across two texts
                    code, seen = np.unique(code[inside], return_counts=True)
                    k = len(code)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * k, pa.string()), pa.array([n] * k, pa.int32()), pa.array(code.view(np.int64)), pa.array(seen.astype(np.int64))], names=["lang", "n", "code", "seen"])

    counted = sample.select("lang", "text").mapInArrow(count, "lang string, n int, code long, seen long").groupBy("lang", "n", "code").agg(F.sum("seen").alias("seen"))
    ranked = counted.withColumn("k", F.row_number().over(Window.partitionBy("lang", "n").orderBy(F.desc("seen"), "code"))).filter(F.col("k") <= STRINGS)
    got = ranked.select("lang", "n", "code").toArrow()
    kind = np.uint8 if len(names) <= 8 else np.uint64
    cells = np.zeros((-(-len(names) // LANGUAGES), HASHES << BITS), kind)
    number = {name: i for i, name in enumerate(names)}
    lang = np.array([number[x] for x in got["lang"].to_pylist()], np.int64)
    for n in SIZES:
        of = got["n"].to_numpy() == n
        for cell in _cells(got["code"].to_numpy()[of].view(np.uint64), n):
            np.bitwise_or.at(cells, (lang[of] // LANGUAGES, cell), (np.ones(1, kind) << (lang[of] % LANGUAGES).astype(kind)))
    rates = np.array([np.prod([(cells[i // LANGUAGES, h << BITS : (h + 1) << BITS] >> kind(i % LANGUAGES) & kind(1)).mean() for h in range(HASHES)]) for i in range(len(names))])
    return names, cells, rates


def _cells(codes: np.ndarray, n: int) -> list[np.ndarray]:
    return [slots(codes, BITS, n + 1000 * h) + (h << BITS) for h in range(HASHES)]


def popcounts(rows: Rows, cells: np.ndarray, languages: int) -> tuple[np.ndarray, np.ndarray]:
    """(hits of each row and language, strings of each row)."""
    hits, total = np.zeros((rows.n, languages)), np.zeros(rows.n)
    for n in SIZES:
        first, *rest = _cells(grams(rows.own, n), n)
        ends = rows.gram_ends(n)
        total += ends - rows.at[:-1]
        for k, words in enumerate(cells):
            mask = words[first]
            for cell in rest:
                mask &= words[cell]
            last = len(mask)
            for i in range(k * LANGUAGES, min((k + 1) * LANGUAGES, languages)):
                sums = np.concatenate(([0], np.cumsum(mask >> mask.dtype.type(i % LANGUAGES) & mask.dtype.type(1), dtype=np.int64)))
                hits[:, i] += sums[np.minimum(ends, last)] - sums[np.minimum(rows.at[:-1], last)]
    return hits, total


def has_letter(col: pa.Array) -> np.ndarray:
    plain = pc.match_substring_regex(pc.fill_null(col, ""), "[A-Za-z]").to_numpy(zero_copy_only=False)
    out = np.array(plain, bool)
    for i in np.flatnonzero(~out):
        out[i] = any(c.isalpha() for c in col[i].as_py() or "")
    return out


def predict(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """documents -> doc_id, held_out, lang_pred, score (the language's share of corrected hits).

    Null texts, and those without a letter, are ``und`` with score 0. Without
    any hit the commonest learned language is told, with score 0. Ties go to
    the commoner language.
    """
    held = sent(bounded(docs).sparkSession, model)

    def run(batches):
        model = held.value
        for piece in text_batches(batches):
            known, best, score = has_letter(piece.column("text")), np.zeros(piece.num_rows, np.int64), np.zeros(piece.num_rows)
            names = [UNKNOWN]
            if model:
                names, cells, rates = model
                hits, total = popcounts(Rows(piece.column("text"), fold=True), cells, len(names))
                fair = np.maximum(0, (hits - total[:, None] * rates) / (1 - rates))
                best = fair.argmax(1)
                score = fair.max(1) / np.maximum(fair.sum(1), 1e-9)
            names = np.array([*names, UNKNOWN], object)
            told = names[np.where(known, best, len(names) - 1)]
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(told, pa.string()), pa.array(np.where(known, score, 0.0))], names=["doc_id", "lang_pred", "score"])

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    told = own.mapInArrow(run, "doc_id long, lang_pred string, score double")
    return told.select("doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score")


