"""Sentence splitting over blocks.

A pretrained sentence model can be given as a UDF ``string -> array<string>``.
Without one, text is cut after ``. ! ?`` (and closing quotes or brackets)
before white space: an approximation, for which no parity is claimed.
"""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelore.functions.text import MARK, sub, ustrip

CUT = r"""(?U)([.!?]+["')\]]*)\s+"""
HAS_LETTER = "[a-zA-ZÀ-ỹĐđ]"


def cut(block: Column) -> Column:
    return F.split(sub(block, CUT, "$1" + MARK), MARK, -1)


def kept(sentences: Column, min_len: int = 4) -> Column:
    """Stripped sentences of min_len characters or more that hold a letter."""
    return F.filter(F.transform(sentences, ustrip), lambda s: (F.length(s) >= min_len) & s.rlike(HAS_LETTER))


def of_blocks(blocks: Column, min_len: int = 4, model: Callable[[Column], Column] = cut) -> Column:
    """A block's end is always a sentence's end."""
    stripped = F.filter(F.transform(blocks, ustrip), lambda b: b != "")
    return kept(F.flatten(F.transform(stripped, model)), min_len)


def by_model(blocks: Column, cutter: Callable[[Column], Column], min_len: int = 4) -> Column:
    """The same with a model that takes all of a page's blocks at once (a UDF can't run inside a transform)."""
    return kept(cutter(F.filter(F.transform(blocks, ustrip), lambda b: b != "")), min_len)


def of_text(text: Column, min_len: int = 4, model: Callable[[Column], Column] = cut) -> Column:
    return of_blocks(F.split(text, "\n", -1), min_len, model)
