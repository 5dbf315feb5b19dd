"""Match offsets, BIO merging and greedy span resolution, all JVM-side.

Spark has no "all matches with offsets". One regexp_replace brackets each match
by two control characters; a split at those gives gap, match, gap, match, ...,
whose running lengths are the offsets in code points.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelore.functions import lexicon as V
from pagelore.functions.text import let
from pagelore.schemas import ENTITY, SPAN

OPEN, CLOSE = "\u0001", "\u0002"


def _span(st: Column, en: Column, prio: int, seq: int, label: Column | str) -> Column:
    label = F.lit(label) if isinstance(label, str) else label
    return F.struct(st.cast("int").alias("st"), en.cast("int").alias("en"), F.lit(prio).alias("prio"), F.lit(seq).alias("seq"), label.alias("label"))


def _safe(sentence: Column) -> Column:
    return F.replace(F.replace(sentence, F.lit(OPEN), F.lit(" ")), F.lit(CLOSE), F.lit(" "))


def find(sentence: Column, pattern: str, label: str, seq: int) -> Column:
    """array<span> of a pattern's matches; of group ``own`` where the pattern names one. Most sentences have none: one search tells."""
    return let(_safe(sentence), lambda safe: _found(safe, pattern, label, seq, safe.rlike("(?U)" + pattern)))


def _found(safe: Column, pattern: str, label: str, seq: int, test: Column) -> Column:
    to = f"${{lead}}{OPEN}${{own}}{CLOSE}" if "(?<own>" in pattern else f"{OPEN}$0{CLOSE}"
    parts = F.split(F.regexp_replace(safe, F.lit("(?U)" + pattern), F.lit(to)), f"[{OPEN}{CLOSE}]", -1)
    start = F.struct(F.lit(0).alias("at"), F.lit(False).alias("inside"), F.array().cast(SPAN).alias("found"))

    def step(acc, part):
        end = acc["at"] + F.length(part)
        span = _span(acc["at"], end, V.PRIORITY[label], seq, label)
        return F.struct(end.alias("at"), (~acc["inside"]).alias("inside"), F.when(acc["inside"], F.concat(acc["found"], F.array(span))).otherwise(acc["found"]).alias("found"))

    found = F.aggregate(parts, start, step, lambda acc: acc["found"])
    return F.when(test, found).otherwise(F.array().cast(SPAN))


def merge_bio(sentence: Column, tokens: Column) -> Column:
    """array<span> of a model's (word, tag) tokens, for PER, LOC and ORG.

    Each word is looked up from the end of the last one; a word that isn't
    found is passed over and leaves an open span open. ``B-x`` opens, ``I-x``
    of the same label extends, anything else closes.
    """
    shut = F.lit(None).cast("struct<st:int,en:int,label:string>")
    start = F.struct(F.lit(0).alias("at"), shut.alias("open"), F.array().cast("array<struct<st:int,en:int,label:string>>").alias("done"))

    def step(acc, tok):
        word, tag = tok["word"], tok["tag"]
        at = F.position(word, sentence, acc["at"] + 1) - 1
        end, kind = (at + F.length(word)).cast("int"), F.substring(tag, 3, 1000)
        extends = tag.startswith("I-") & acc["open"].isNotNull() & (acc["open"]["label"] == kind)
        opened = F.struct(at.cast("int").alias("st"), end.alias("en"), kind.alias("label"))
        longer = F.struct(acc["open"]["st"].alias("st"), end.alias("en"), acc["open"]["label"].alias("label"))
        closed = F.when(acc["open"].isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["open"])))
        moved = F.struct(
            end.alias("at"),
            F.when(tag.startswith("B-"), opened).when(extends, longer).otherwise(shut).alias("open"),
            F.when(extends, acc["done"]).otherwise(closed).alias("done"),
        )
        return F.when(at < 0, acc).otherwise(moved)

    merged = F.aggregate(tokens, start, step, lambda a: F.when(a["open"].isNull(), a["done"]).otherwise(F.concat(a["done"], F.array(a["open"]))))
    known = F.filter(merged, lambda s: s["label"].isin("PER", "LOC", "ORG"))
    return F.transform(known, lambda s: _span(s["st"], s["en"], V.PRIORITY["PER"], 0, s["label"]))


def resolve(candidates: Column) -> Column:
    """Leftmost first, then longest, then priority; a span that overlaps a chosen one is dropped whole."""
    keyed = F.array_sort(F.transform(candidates, lambda s: F.struct(s["st"].alias("st"), (-s["en"]).alias("minus"), s["prio"].alias("prio"), s["seq"].alias("seq"), s["label"].alias("label"))))
    ordered = F.transform(keyed, lambda s: F.struct(s["st"].alias("st"), (-s["minus"]).alias("en"), s["prio"].alias("prio"), s["seq"].alias("seq"), s["label"].alias("label")))
    start = F.struct(F.lit(0).alias("end"), F.array().cast(SPAN).alias("chosen"))
    keep = lambda acc, s: F.struct(s["en"].alias("end"), F.concat(acc["chosen"], F.array(s)).alias("chosen"))
    return F.aggregate(ordered, start, lambda acc, s: F.when(s["st"] >= acc["end"], keep(acc, s)).otherwise(acc), lambda acc: acc["chosen"])


def entities(sentence: Column, chosen: Column) -> Column:
    """array<(text, label)>: output labels, edges stripped, empty texts dropped."""
    label = lambda s: F.regexp_replace(s["label"], "_(RULE|GAZ)$", "")
    cut = lambda s: F.substring(sentence, s["st"] + 1, s["en"] - s["st"])
    edged = lambda s: F.btrim(cut(s), F.lit(" ,.;:!?()[]\"'-"))
    return F.filter(F.transform(chosen, lambda s: F.struct(edged(s).alias("text"), label(s).alias("label"))), lambda e: e["text"] != "")


def rule_spans(sentence: Column) -> Column:
    """The candidates of all rules, in the order of the rules. Most sentences have neither a digit nor a cue: no rule is tried there."""

    def candidates(x: Column) -> Column:
        safe, word, digit = x["safe"], x["word"], x["digit"]
        tests = [(digit if V.needs_digit(p) else word) & safe.rlike("(?U)" + p) for _, p in V.rules()]
        every = F.concat(*(_found(safe, p, label, seq, test) for seq, ((label, p), test) in enumerate(zip(V.rules(), tests, strict=True), 1)))
        return F.when(word | digit, every).otherwise(F.array().cast(SPAN))

    told = lambda safe: F.struct(safe.alias("safe"), safe.rlike(V.cue()).alias("word"), safe.rlike(r"(?U)\d").alias("digit"))
    return let(let(_safe(sentence), told), candidates)


def extract(sentence: Column, tokens: Column | None = None) -> Column:
    """Entities of a sentence by rules, and by a model's tokens where given."""
    found = rule_spans(sentence) if tokens is None else F.concat(merge_bio(sentence, tokens), rule_spans(sentence))
    return let(found, lambda f: F.when(F.size(f) == 0, F.array().cast(ENTITY)).otherwise(entities(sentence, resolve(f))))
