"""Sentence TSV, entity JSON and correction records, as directories or as exact files."""

import json
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tsv_line():
    """``id<TAB>sentence``, no quoting."""
    return F.concat_ws("\t", "sentence_id", "sentence")


def write_sentences(sentences: DataFrame, path: str) -> None:
    """Text files by work; the text writer keeps quotes as they are."""
    sentences.select("chap_code", tsv_line().alias("value")).write.partitionBy("chap_code").text(path)


def write_entities(ner: DataFrame, path: str) -> None:
    ner.select("chap_code", "sentence_id", "sentence", "entities").write.partitionBy("chap_code").json(path)


def write_corrections(corrections: DataFrame, path: str) -> None:
    corrections.select("original", "corrected", "action").write.json(path)


def work_dir(outdir: str, code: str, chap_code: str) -> Path:
    """``<out>/<code>`` for a work of one file, ``<out>/<code>/<chapter>`` otherwise."""
    return Path(outdir, code) if code == chap_code else Path(outdir, code, chap_code)


def export_work(ner: DataFrame, outdir: str, code: str, chap_code: str) -> None:
    """One chapter's ``_seg.tsv`` and ``_ner.json`` with the exact names; rows stream in order."""
    to = work_dir(outdir, code, chap_code)
    to.mkdir(parents=True, exist_ok=True)
    rows = ner.filter(F.col("chap_code") == chap_code).orderBy("seq").toLocalIterator()
    with open(to / f"{chap_code}_seg.tsv", "w", encoding="utf-8") as seg, open(to / f"{chap_code}_ner.json", "w", encoding="utf-8") as out:
        out.write("[")
        i = -1
        for i, r in enumerate(rows):
            seg.write(f"{r.sentence_id}\t{r.sentence}\n")
            record = {"sentence_id": r.sentence_id, "sentence": r.sentence, "entities": [e.asDict() for e in r.entities]}
            body = json.dumps(record, ensure_ascii=False, indent=2)
            out.write(("," if i else "") + "\n  " + body.replace("\n", "\n  "))
        out.write("]" if i < 0 else "\n]")


def export_corrections(corrections: DataFrame, path: str) -> int:
    """One JSON record a line, in page order, rows streamed; returns how many."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    i = 0
    with open(path, "w", encoding="utf-8") as out:
        for i, r in enumerate(corrections.orderBy("chap_code", "page_no", "chunk_no").toLocalIterator(), 1):
            out.write(json.dumps({"original": r.original, "corrected": r.corrected, "action": r.action}, ensure_ascii=False) + "\n")
    return i
