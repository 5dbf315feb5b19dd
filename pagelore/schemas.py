"""Schemas of the stage tables; every row carries its place, as DataFrames have no order."""

from pyspark.sql import types as T

S, I, L = T.StringType(), T.IntegerType(), T.LongType()


def _of(**fields):
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


ENTITY = T.ArrayType(_of(text=S, label=S))
SPAN = T.ArrayType(_of(st=I, en=I, prio=I, seq=I, label=S))
TOKEN = T.ArrayType(_of(word=S, tag=S))

WORKS = _of(code=S, chap_code=S, pdf_path=S)
TOC = _of(chap_code=S, lvl=I, title=S, page=I, total=I)
PAGES = _of(chap_code=S, page_no=L, raw=S)
CHUNKS = _of(chap_code=S, page_no=L, chunk_no=I, chunk=S, key=S)
CACHE = _of(key=S, corrected=S)
REPLIES = _of(key=S, reply=S, failed=T.BooleanType())
CORRECTIONS = _of(chap_code=S, page_no=L, chunk_no=I, original=S, corrected=S, action=S)
SENTENCES = _of(chap_code=S, seq=L, sentence_id=S, sentence=S)
NER = _of(sentence_id=S, sentence=S, entities=ENTITY)
