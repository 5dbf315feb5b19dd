"""Chapter numbers and codes of a work's files."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def chapter_numbers(files: DataFrame) -> DataFrame:
    """files(code, pdf_path) -> + num, chap_code.

    The number is the last run of digits in the file's stem; if a work has a
    stem without digits or a number twice, its files are numbered by path.
    A work of one file keeps its code. Digits beyond 18 count as none.
    """
    stem = F.regexp_replace(F.element_at(F.split("pdf_path", "/"), -1), r"(?<=.)\.[^.]*$", "")
    digits = F.try_element_at(F.regexp_extract_all(stem, F.lit(r"\d+"), F.lit(0)), F.lit(-1))
    work = Window.partitionBy("code")
    sized = files.withColumn("_num", digits.try_cast("long")).withColumns({
        "_files": F.count("*").over(work),
        "_known": F.size(F.collect_set("_num").over(work)),
        "_rank": F.row_number().over(work.orderBy("pdf_path")),
    })
    num = F.when(F.col("_known") == F.col("_files"), F.col("_num")).otherwise(F.col("_rank").cast("long"))
    chap = F.when(F.col("_files") == 1, F.col("code")).otherwise(F.format_string("%s_%02d", F.col("code"), F.col("num")))
    return sized.withColumn("num", num).withColumn("chap_code", chap).drop("_num", "_files", "_known", "_rank")
