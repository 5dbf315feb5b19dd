"""Mixing sources to target weights by hierarchical budgets.

The tree is domain, language, source. A node can take its tokens times
``max_epochs``. The budget is dealt from the root by water-filling: children
get shares by weight, a child that can't use its share passes the rest to its
siblings, and only what a whole subtree can't use moves at the level above. A
leaf's budget is whole epochs of its documents plus a prefix, by tokens, of
the next epoch's seeded order.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelore.llm.common import written

LEVELS = ["domain", "lang", "source"]
WORD = r"[^\x20\x09-\x0D]+"


def domain_of(source: Column) -> Column:
    """Default domains: the last number in a source's name, mod 4; ``other`` without one."""
    digits = F.regexp_extract(source, r"(\d+)$", 1)
    return F.when(digits == "", "other").otherwise(F.concat(F.lit("d"), F.substring(digits, -9, 9).try_cast("int") % 4))


def _dec(c: str | Column, digits: int) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(f"decimal({digits},0)")


def _deal(nodes: DataFrame, parents: list[str], name: str) -> DataFrame:
    """Adds ``share`` to nodes(parents, name, room, weight, budget): each at most its room, the rest by weight.

    By rising room / weight the children that fill up come first; the first
    that doesn't, given all that is left, ends them.
    """
    group = Window.partitionBy(*parents)
    order = group.orderBy(F.col("room") / F.col("weight"), name)
    left = _dec("budget", 20) - _dec(F.coalesce(F.sum("room").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), 20)
    behind = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    full = nodes.withColumn("full", _dec("room", 20) * _dec(behind, 10) <= left * _dec("weight", 10))
    rest = _dec(F.col("budget") - F.sum(F.when(F.col("full"), F.col("room")).otherwise(0)).over(group), 20)
    weights = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(group)
    opened = full.withColumns({"rest": rest, "weights": _dec(F.greatest(weights, F.lit(1)), 10), "w": _dec("weight", 10)})
    return opened.withColumn("share", F.expr("CASE WHEN full THEN room ELSE rest * w div weights END")).drop("full", "rest", "weights", "w")


def _weight(name: str, weights: dict[str, int] | None) -> Column:
    known = [x for k, v in (weights or {}).items() for x in (F.lit(k), F.lit(int(v)))]
    return (F.coalesce(F.try_element_at(F.create_map(*known), F.col(name)), F.lit(1)) if known else F.lit(1)).cast("long")


def budgets(leaves: DataFrame, budget: int, weights: dict[str, dict[str, int]] | None = None) -> DataFrame:
    """leaves(domain, lang, source, tokens, room) -> + share. Weights are whole numbers of 1 or more, 1 where not given."""
    weights = weights or {}
    above = None
    for depth, name in enumerate(LEVELS):
        nodes = leaves.groupBy(*LEVELS[: depth + 1]).agg(F.sum("room").alias("room")).withColumn("weight", _weight(name, weights.get(name)))
        parents = LEVELS[:depth]
        nodes = nodes.withColumn("budget", F.lit(int(budget)).cast("long")) if above is None else nodes.join(above, parents)
        # few domains; languages and sources are dealt within their parent
        above = _deal(nodes, parents, name).select(*LEVELS[: depth + 1], F.col("share").alias("budget"))
    return leaves.join(above.withColumnRenamed("budget", "share"), LEVELS)


def light(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, domain, lang, source, tokens): tokens are runs of non-blank characters; null lang is und, null source empty."""
    source = F.coalesce(F.col("source").cast("string"), F.lit(""))
    own = docs.select(F.col(id_col).alias("doc_id"), domain_of(source).alias("domain"), F.coalesce(F.col("lang"), F.lit("und")).alias("lang"), source.alias("source"), F.col(text_col).alias("text"))
    return own.select("doc_id", "domain", "lang", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("tokens"))


def select(rows: DataFrame, budget_share: tuple[int, int], weights=None, max_epochs: int = 1, seed: int = 7) -> DataFrame:
    """light rows -> (doc_id, domain, lang, source, epoch, taken): every use of a document and the tokens taken from it.

    ``budget_share`` is the budget as a fraction (above, below) of all tokens.
    An epoch's order is by md5 of seed, epoch and doc_id, ties by doc_id; running
    sums go over 4096 hash ranges of a leaf and then inside one, so that a leaf
    of any size is spread. The last document taken may be cut.
    """
    rows = written(rows, "light")
    leaves = rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    leaves = written(leaves.withColumn("room", F.col("tokens") * max_epochs), "leaves")
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    shares = budgets(leaves, total * budget_share[0] // budget_share[1], weights)
    whole = F.coalesce(F.expr("share div nullif(tokens, 0)"), F.lit(0))
    plan = shares.select(*LEVELS, whole.cast("int").alias("whole"), (F.col("share") - whole * F.col("tokens")).alias("left"))
    own = rows.join(written(plan, "plan"), LEVELS)

    full = own.filter("whole > 0").select("doc_id", *LEVELS, F.explode(F.expr("sequence(0, whole - 1)")).alias("epoch"), F.col("tokens").alias("taken"))
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole").cast("string"), F.col("doc_id").cast("string")).cast("binary"))
    part = own.filter("left > 0").withColumn("h", order).withColumn("range", F.substring("h", 1, 3))
    place = [*LEVELS, "range"]
    before = F.coalesce(F.sum("n").over(Window.partitionBy(*LEVELS).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = part.groupBy(*place).agg(F.sum("tokens").alias("n")).select(*place, before.alias("base"))
    inside = Window.partitionBy(*place).orderBy("h", "doc_id", "tokens").rowsBetween(Window.unboundedPreceding, -1)
    begun = part.join(ranges, place).withColumn("start", F.col("base") + F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    cut = begun.filter("start < left").select("doc_id", *LEVELS, F.col("whole").alias("epoch"), F.least("tokens", F.col("left") - F.col("start")).alias("taken"))
    return full.unionAll(cut)


def mix(docs: DataFrame, budget_share=(4, 5), weights=None, max_epochs: int = 1, seed: int = 7) -> DataFrame:
    """documents -> their uses; see select(). A table without tokens gives no rows."""
    return select(light(docs), budget_share, weights, max_epochs, seed)
