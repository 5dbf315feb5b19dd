"""Ordered ids over a work without sorting all of its sentences in one task.

Pages carry how many items they hold. Counts are summed by (work, run of
pages), offsets run over those sums, and then over the pages of one run: each
window group is bounded by RUN rows or by pages / RUN rows. Only counts are
sorted; the items are shuffled once, by page, to meet their offset.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelore.sources.tables import staged

#: Pages in a run.
RUN = 4096


def _before(part: list[str], *order):
    return F.coalesce(F.sum("n").over(Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def with_offsets(pages: DataFrame, work: str, page: str, items: str, limit: int = 0) -> DataFrame:
    """Adds ``offset``: the items on earlier pages of the work; with a limit, only for pages that may hold one of its first items.

    Every row stays. A null work is a work of its own. Null pages come after all
    others; rows of one page go by a hash of their items, equal rows in any order.
    """
    place = F.struct(F.col(work).alias("work"), F.col(page).alias("page"), F.xxhash64(items).alias("h"))  # null fields compare as equal
    sized = staged(pages.withColumns({"_n": F.greatest(F.size(items), F.lit(0)).cast("long"), "_place": place}), "numbered")  # three branches read it
    light = sized.groupBy("_place").agg(F.count("*").alias("copies"), F.first("_n").alias("each"))
    light = light.select("_place", F.struct(F.col("_place.work").alias("work"), F.floor(F.col("_place.page") / RUN).alias("run")).alias("_run"), F.col("each").alias("_each"), (F.col("copies") * F.col("each")).alias("n"))
    runs = light.groupBy("_run").agg(F.sum("n").alias("n")).select("_run", _before(["_run.work"], F.asc_nulls_last("_run.run")).alias("base"))
    inside = light.withColumn("inside", _before(["_run"], F.asc_nulls_last("_place.page"), "_place.h"))
    offsets = inside.join(runs, "_run").select("_place", "_each", (F.col("base") + F.col("inside")).alias("_offset"))
    if limit:
        offsets = offsets.filter((F.col("_each") > 0) & (F.col("_offset") < limit))
    copy = F.row_number().over(Window.partitionBy("_place").orderBy(F.lit(0))) - 1
    placed = sized.join(offsets.drop("_each"), "_place").withColumn("_copy", copy)  # few offsets are sent out, and no other page is shuffled
    return placed.withColumn("offset", F.col("_offset") + F.col("_copy") * F.col("_n")).drop("_place", "_offset", "_copy", "_n")


def explode_numbered(pages: DataFrame, work: str, page: str, items: str, item: str, limit: int = 0) -> DataFrame:
    """One row per item with ``seq`` 1, 2, ... over the work; limit keeps the first of each work (0: all)."""
    placed = with_offsets(pages, work, page, items, limit)
    out = placed.select("*", F.posexplode(items).alias("_pos", item)).withColumn("seq", F.col("offset") + F.col("_pos") + 1)
    out = out.drop("_pos", "offset", items)
    return out.filter(F.col("seq") <= limit) if limit else out


def sentence_id(work, seq):
    """``<work>_%06d``, wider when needed; a null work reads ``null``."""
    return F.format_string("%s_%06d", work, seq)
