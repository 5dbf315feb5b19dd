"""Pretrained sentence and entity models as Columns, for the places that take a model.

The library is optional: it is imported once in each worker. Any object with
``sentences(text)`` and ``tokens(text)`` will do.
"""

import importlib.util
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelore.schemas import TOKEN

LIBRARY = "underthesea"


def available() -> bool:
    return importlib.util.find_spec(LIBRARY) is not None


class Pretrained:
    """Vietnamese sentence cutting and entity tags by the library underthesea."""

    def __init__(self):
        try:
            from underthesea import ner, sent_tokenize
        except ImportError as e:
            raise ImportError(f"the pretrained models need the module {LIBRARY}") from e
        self.sentences, self.ner = sent_tokenize, ner

    def tokens(self, text: str) -> list[tuple[str, str]]:
        return [(t[0], t[3]) for t in self.ner(text)]


def _once(make: Callable[[], object]) -> Callable[[], object]:
    made: list[object] = []

    def get() -> object:
        if not made:
            made.append(make())
        return made[0]

    return get


def sentence_cutter(make: Callable[[], object] = Pretrained) -> Callable[[Column], Column]:
    """array<array<string>> -> the model's sentences of an array of blocks, flat. For corpus.sentences(cutter=...)."""
    get = _once(make)

    @F.pandas_udf("array<string>")
    def cut(blocks: pd.Series) -> pd.Series:
        model = get()
        return blocks.map(lambda own: [s for b in own for s in model.sentences(b)])

    return cut


def token_tagger(make: Callable[[], object] = Pretrained) -> Callable[[Column], Column]:
    """string -> array<(word, tag)>; a sentence at which the model fails has no tokens."""
    get = _once(make)

    def safe(model, text: str) -> list[dict]:
        try:
            return [{"word": w, "tag": t} for w, t in model.tokens(text)]
        except Exception:
            return []

    @F.pandas_udf(TOKEN)
    def tag(texts: pd.Series) -> pd.Series:
        model = get()
        return texts.map(lambda t: safe(model, t))

    return tag
