"""spark-submit entry: scan, read, normalise, correct, split, extract, write."""

import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from pagelore import config as conf
from pagelore.functions import models
from pagelore.operators import chapters, corpus, correction, toc
from pagelore.sinks import writers
from pagelore.sources import cache, pdf
from pagelore.sources.tables import staged


class Gemini:
    """Thin client over google-genai, imported where it is used."""

    def __init__(self, api_key: str):
        from google import genai

        self.client = genai.Client(api_key=api_key)

    def once(self, prompt: str, model: str) -> str:
        return self.client.models.generate_content(model=model, contents=prompt).text

    def generate(self, prompt: str, model: str, retries: int = 3) -> str:
        once = type("Once", (), {"generate": staticmethod(self.once)})
        return correction.with_retry(once, prompt, model, retries)


def main(argv: list[str] | None = None, reader=None, client=None) -> None:
    """reader and client: factories that stand in for the PDF library and the API (for tests)."""
    c = conf.parse(argv)
    key = conf.api_key(c)
    spark = SparkSession.builder.appName("pagelore").getOrCreate()
    began, place = time.time(), c.pdf or c.input_dir
    files = pdf.single_file(spark, c.pdf, c.code) if c.pdf else pdf.folder_scan(spark, c.input_dir)
    works = chapters.chapter_numbers(files)
    marks = staged(pdf.read_toc(works, place, reader or pdf.TextLayer), "toc")
    books = marks.groupBy("chap_code").agg(F.max("total").alias("total"))
    ranges = toc.page_range(toc.content_range(books, marks), c.start_page, c.end_page)
    make = reader or ((lambda: pdf.Ocr(c.ocr_dpi)) if c.ocr else pdf.TextLayer)
    pages = corpus.normalize(pdf.read_pages(works.join(ranges, "chap_code"), place, make))
    if c.correct:
        stored = f"{c.outdir}/cache"
        known = None if c.no_cache else cache.known(spark, stored)
        pages, done = correction.correct(pages, client or (lambda: Gemini(key)), c.model, known, rpm=c.rpm, journal=None if c.no_cache else f"{stored}/replies")
        done = staged(done, "corrections")
        n = writers.export_corrections(done, f"{c.outdir}/corrections.jsonl")
        print(f"{n} chunks corrected ({n / max(time.time() - began, 1e-9) * 60:.1f} chunks/min)")
        if not c.no_cache:
            cache.append_table(correction.new_entries(done), f"{stored}/corrected")
    pretrained = models.available() and not c.no_models
    cutter, tokens = (models.sentence_cutter(), models.token_tagger()) if pretrained else (None, None)
    # written once; the exact files are copied from it
    ner = staged(corpus.entities(corpus.sentences(pages, c.limit, cutter), tokens).repartition("chap_code").sortWithinPartitions("chap_code", "seq"), "ner")
    for w in works.select("code", "chap_code").distinct().toLocalIterator():
        writers.export_work(ner, c.outdir, w.code, w.chap_code)
    print(corpus.progress(ner, time.time() - began))


if __name__ == "__main__":
    main()
