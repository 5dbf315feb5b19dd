"""The content range of a book from its bookmarks."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelore.functions import lexicon as V
from pagelore.functions.text import ustrip


def segments(toc: DataFrame) -> DataFrame:
    """Level-1 bookmarks by (page, title) with start_page and end_page; the last ends with the book."""
    order = Window.partitionBy("chap_code").orderBy("page", "title")
    top = toc.filter("lvl = 1").withColumn("title", ustrip(F.col("title")))
    end = F.coalesce(F.lead("page").over(order) - 1, F.col("total"))
    return top.select("chap_code", "title", F.col("page").alias("start_page"), end.alias("end_page"))


def content_segments(toc: DataFrame) -> DataFrame:
    """Segments with a content title; a first one on page 1 that isn't like a chapter is a cover and goes, if more follow."""
    whole = Window.partitionBy("chap_code")
    some = segments(toc).filter(~F.col("title").rlike(V.JUNK_TITLE))
    ranked = some.withColumns({"_k": F.row_number().over(whole.orderBy("start_page", "title")), "_n": F.count("*").over(whole)})
    cover = (F.col("_k") == 1) & (F.col("_n") > 1) & (F.col("start_page") == 1) & ~F.col("title").rlike(V.CHAPTER_TITLE)
    return ranked.filter(~cover).drop("_k", "_n")


def content_range(books: DataFrame, toc: DataFrame) -> DataFrame:
    """books(chap_code, total) -> (chap_code, start_page, end_page): one run of pages, (1, total) without content bookmarks."""
    place = F.struct("start_page", "title")
    kept = content_segments(toc).groupBy("chap_code").agg(F.min("start_page").alias("s"), F.max_by("end_page", place).alias("e"))
    return books.join(kept, "chap_code", "left").select("chap_code", F.coalesce("s", F.lit(1)).alias("start_page"), F.coalesce("e", "total").alias("end_page"))


def page_range(ranges: DataFrame, start: int | None = None, end: int | None = None) -> DataFrame:
    """Flags override the found range by truthiness: 0 counts as unset."""
    return ranges.withColumns({k: F.lit(v) for k, v in (("start_page", start), ("end_page", end)) if v})
