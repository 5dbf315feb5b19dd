"""PDF folders, page texts, OCR and bookmarks.

PDF and OCR libraries are optional: an adapter is imported inside the executor's
iterator, once per task, and fails with a clear message where it is missing.
Any object with ``pages(content, start, end)`` and ``toc(content)`` will do.
"""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def files(spark: SparkSession, place: str) -> DataFrame:
    """(path, content) of a PDF file, or of the PDFs in the folders of a folder. Raises where there is none."""
    one = place.lower().endswith(".pdf")
    try:
        found = spark.read.format("binaryFile").load(place if one else f"{place}/*/*.pdf").select("path", "content")
        some = not found.select("path").isEmpty()
    except AnalysisException:
        some = False
    if not some:
        raise FileNotFoundError(f"no PDF file {place}" if one else f"no PDF in the folders of {place}")
    return found


def folder_scan(spark: SparkSession, input_dir: str) -> DataFrame:
    """works(code, pdf_path) of ``<input_dir>/<code>/*.pdf``, one level deep. Raises where there is none."""
    return files(spark, input_dir).select(F.element_at(F.split("path", "/"), -2).alias("code"), F.col("path").alias("pdf_path"))


def single_file(spark: SparkSession, path: str, code: str) -> DataFrame:
    return files(spark, path).select(F.lit(code).alias("code"), F.col("path").alias("pdf_path"))


class TextLayer:
    """Text and bookmarks by PyMuPDF."""

    def __init__(self):
        try:
            import fitz
        except ImportError as e:
            raise ImportError("reading PDF text needs PyMuPDF (module fitz)") from e
        self.open = lambda content: fitz.open(stream=content, filetype="pdf")

    def toc(self, content: bytes) -> tuple[int, list[tuple[int, str, int]]]:
        with self.open(content) as doc:
            return doc.page_count, [tuple(x[:3]) for x in doc.get_toc()]

    def pages(self, content: bytes, start: int, end: int | None) -> Iterator[tuple[int, str]]:
        with self.open(content) as doc:
            for no in range(start, min(end or doc.page_count, doc.page_count) + 1):
                yield no, self.text(doc.load_page(no - 1))

    def text(self, page) -> str:
        return page.get_text("text")


class Ocr(TextLayer):
    """Rendered pages read by PaddleOCR; each recognised line is a line."""

    def __init__(self, dpi: int = 200, lang: str = "vi"):
        super().__init__()
        try:
            from paddleocr import PaddleOCR
        except ImportError as e:
            raise ImportError("OCR needs the module paddleocr") from e
        self.dpi, self.engine = dpi, PaddleOCR(lang=lang)

    def text(self, page) -> str:
        import numpy as np

        pix = page.get_pixmap(dpi=self.dpi)
        image = np.frombuffer(pix.samples, np.uint8).reshape(pix.height, pix.width, pix.n)[:, :, :3]
        found = self.engine.predict(image)
        return "\n".join(found[0].get("rec_texts", [])) if found else ""


def _content(works: DataFrame, place: str) -> DataFrame:
    """works with ``content``; Spark sends the works, a row for each file, to the files if they are few, and never lists paths on the driver."""
    own = files(works.sparkSession, place).withColumnRenamed("path", "pdf_path")
    return own.join(works, "pdf_path")


def read_toc(works: DataFrame, place: str, make_reader: Callable[[], object] = TextLayer) -> DataFrame:
    """toc(chap_code, lvl, title, page, total); a file without bookmarks has one row of nulls and its total."""

    def rows(batches):
        reader = make_reader()
        for pdf in batches:
            for code, content in zip(pdf["chap_code"], pdf["content"], strict=True):
                total, marks = reader.toc(content)
                yield pd.DataFrame([(code, *m, total) for m in marks or [(None, None, None)]], columns=["chap_code", "lvl", "title", "page", "total"])

    return _content(works, place).select("chap_code", "content").mapInPandas(rows, "chap_code string, lvl int, title string, page int, total int")


def read_pages(works: DataFrame, place: str, make_reader: Callable[[], object] = TextLayer) -> DataFrame:
    """works(chap_code, pdf_path, start_page, end_page) -> pages(chap_code, page_no, raw); the range reaches the reader, so other pages are never read."""

    def rows(batches):
        reader = make_reader()
        for pdf in batches:
            for r in pdf.itertuples():
                end = None if pd.isna(r.end_page) else int(r.end_page)
                for no, raw in reader.pages(r.content, int(r.start_page), end):
                    yield pd.DataFrame({"chap_code": [r.chap_code], "page_no": [no], "raw": [raw]})

    return _content(works, place).select("chap_code", "content", "start_page", "end_page").mapInPandas(rows, "chap_code string, page_no long, raw string")
