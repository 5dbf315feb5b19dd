"""Page text normalisation as Column expressions, all of them JVM-side.

A search over a whole text costs more than most of the rules ever change, so each dear rule stands behind a cheap test
that holds wherever the rule could match. Most tests ask whether there is any character beyond ASCII.
"""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelore.functions import lexicon as V

#: Stands for a heading while lines are joined; controls are gone by then.
MARK = "\u0001"
LINE_END = "\\r\\n|[\\n\\r\\x{85}\\x{2028}\\x{2029}]"
#: What ``(?U)\\s`` matches.
SPACES = "\t\n\x0b\x0c\r \x85\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def sub(col: Column, pattern: str, to: str = "") -> Column:
    return F.regexp_replace(col, F.lit(pattern), F.lit(to))


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, however often f names it."""
    return F.transform(F.array(value), f)[0]


def where(col: Column, test: Callable[[Column], Column], f: Callable[[Column], Column]) -> Column:
    """f of the texts that pass the test; the others as they are."""
    return let(col, lambda x: F.when(test(x), f(x)).otherwise(x))


def wide(col: Column) -> Column:
    """Whether there is any character beyond ASCII."""
    return F.octet_length(col) > F.length(col)


def ustrip(col: Column) -> Column:
    """Unicode-aware strip; Spark's trim knows only U+0020 unless told."""
    return F.btrim(col, F.lit(SPACES))


def nfc(col: Column) -> Column:
    """Unicode NFC by ICU, which Spark ships."""
    return where(col, wide, lambda x: F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), x, F.lit(False)))


def fix_chars(col: Column) -> Column:
    """Drop control and invisible characters, then map typographic ones to ASCII."""
    hidden = r"[^\t\n\r -~\x{80}-\x{ac}\x{ae}-\x{200a}\x{200e}-\x{fefe}\x{ff00}-\x{10ffff}]"  # V.CONTROLS, told by the others
    clean = where(col, lambda x: x.rlike(hidden), lambda x: sub(x, f"[{V.CONTROLS}]"))
    typographic = [*V.ONE_TO_ONE.items(), (V.ELLIPSIS, "...")]
    seldom = r"[^\x00-\x{9f}\x{a1}-\x{200f}]"
    return where(clean, lambda x: wide(x) & x.rlike(seldom), lambda x: reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), typographic, x))


def _behind(letters: str, *toned: str) -> str:
    return f"(?=[^\\x00-\\x7f])(?<=[{letters}])[{''.join(toned)}]"


def fix_tones(col: Column) -> Column:
    """Tone marks to the first vowel of oa, oe, uy; back to the second in closed syllables."""

    def first(col: Column) -> Column:
        for second in "ae":
            for moved, old in zip(V.toned("o"), V.toned(second), strict=True):
                col = F.replace(F.replace(col, F.lit("o" + old), F.lit(moved + second)), F.lit("O" + old), F.lit(moved.upper() + second))
        return col

    def glides(col: Column) -> Column:
        for moved, old in zip(V.toned("u"), V.toned("y"), strict=True):
            col = sub(sub(col, f"(?<![qQ])u{old}", f"{moved}y"), f"(?<![qQ])U{old}", f"{moved.upper()}y")
        return col

    def back(col: Column) -> Column:
        for wrong, right in zip(V.toned("o"), V.toned("a"), strict=True):
            col = sub(col, f"{wrong}a(?=[{V.CLOSING}])", f"o{right}")
        return col

    oa, uy, shut = _behind("oO", V.toned("a"), V.toned("e")), _behind("uU", V.toned("y")), f"(?=[^\\x00-\\x7f])[{V.toned('o')}]a"
    any_of = lambda x: wide(x) & x.rlike(f"{oa}|{uy}|{shut}")
    steps = lambda x: where(where(first(x), lambda y: y.rlike(uy), glides), lambda y: y.rlike(shut), back)
    return where(col, any_of, steps)


def drop_notes(col: Column) -> Column:
    """Trade and degree marks, footnote numbers and (?) after a word."""
    after = f"(?<={V.WORD})"
    marks = where(col, lambda x: wide(x) & x.rlike("[®©™°]"), lambda x: sub(x, r"[®©™°]+"))
    notes = lambda x: x.contains("(") & x.rlike(r"(?U)\((?:\d{1,2}\)|\?)")
    return where(marks, notes, lambda x: reduce(sub, [rf"(?U){after}\(\d{{1,2}}\)", rf"{after}\(\?+\)?"], x))


def respace(block: Column) -> Column:
    """One block's lines to one line: hyphens joined, blanks tidied, sentences unglued."""
    blanks = r" \s+|[^\S ]\s*"  # all but a single space
    joined = where(block, lambda x: x.contains("-\n"), lambda x: sub(x, rf"({V.WORD})-\n({V.WORD})", "$1$2"))
    one = let(joined, lambda x: F.when(wide(x), sub(x, "(?U)" + blanks, " ")).otherwise(sub(x, blanks, " ")))  # from here on the only blank is U+0020
    left = where(sub(one, r" (?=[,.;:!?)\]])"), lambda x: x.contains("( ") | x.contains("[ "), lambda x: sub(x, r"([(\[]) ", "$1"))
    return ustrip(sub(left, rf"([.!?,])(?=[{V.UPPER}])", "$1 "))


def lines(col: Column) -> Column:
    other = lambda x: x.contains("\r") | wide(x) & (x.contains("\x85") | x.contains("\u2028") | x.contains("\u2029"))
    return let(col, lambda x: F.when(other(x), F.split(x, LINE_END, -1)).otherwise(F.split(x, "\n", -1)))


def is_heading(stripped: Column) -> Column:
    begins = F.left(stripped, F.lit(1))
    return wide(stripped) & (begins.isin(*"QPCMT") & stripped.rlike(V.HEADING) | (begins == "(") & stripped.rlike(V.CONTINUED))


def is_gibberish(s: Column) -> Column:
    """A short line without closing punctuation that is mostly signs or scraps."""
    n, signs = F.length(s), F.length(sub(s, r"(?U)[\p{L}\p{N}\s]"))
    scraps = F.forall(F.split(s, r"(?U)\s+"), lambda t: F.length(t) <= 3) & ~F.lower(s).rlike(f"[{V.ACCENTED}]")
    return (n <= 20) & ~s.rlike(r'[.!?:;,"”)]$') & (~s.rlike(r"\p{L}") | (signs / n > 0.25) | scraps)


JUNK = ("blank", "page_number", "running_header", "url", "all_caps", "too_short", "gibberish")


def junk_class(s: Column) -> Column:
    """The first rule by which a stripped line is junk, else null."""
    tests = {
        "blank": s == "",
        "page_number": F.left(s, F.lit(1)).rlike(r"(?U)[-–—.•\d]") & s.rlike(V.PAGE_NUMBER),
        "running_header": wide(s) & s.rlike(V.RUNNING_HEADER),
        "url": s.rlike(f"(?=[hHwW.])(?:{V.URL})"),
        "all_caps": (F.length(s) <= 80) & s.rlike(r"\p{L}") & s.rlike(rf"(?U)^[\s{V.UPPER}0-9{V.NOT_WORD}]+$"),
        "too_short": (F.length(s) <= 2) & ~s.rlike(r"^\p{L}+$"),
        "gibberish": is_gibberish(s),
    }
    return reduce(lambda c, k: c.when(tests[k], F.lit(k)), JUNK, F.when(F.lit(False), F.lit("")))


def blocks(col: Column) -> Column:
    """array<string>: the joined blocks between heading lines, without empty ones."""
    kept = F.transform(lines(col), lambda ln: F.struct(ln.alias("ln"), ustrip(ln).alias("s")))
    told = F.transform(kept, lambda x: F.when(is_heading(x["s"]), MARK).when(junk_class(x["s"]).isNull(), x["ln"]))
    joined = F.array_join(told, "\n")  # leaves nulls out
    return F.filter(F.transform(F.split(joined, MARK, -1), respace), lambda b: b != "")


def page_blocks(raw: Column) -> Column:
    """All of page normalisation, as an array of blocks; null text gives an empty array."""
    return blocks(drop_notes(fix_tones(fix_chars(nfc(F.coalesce(raw, F.lit("")))))))


def page_text(raw: Column) -> Column:
    """All of page normalisation, blocks joined by LF."""
    return F.array_join(page_blocks(raw), "\n")
