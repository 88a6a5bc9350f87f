"""Exact token counts by a file of the tokenizers library, where it is installed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import token_estimate

_loaded: dict[str, object] = {}


def tokenizer(path: str):
    """This process's tokenizer of a file."""
    if path not in _loaded:
        from tokenizers import Tokenizer

        _loaded[path] = Tokenizer.from_file(path)
    return _loaded[path]


def counter(path: str | None):
    """(function of a text column, whether it is exact): the tokenizer's count, or the estimate without a file or library."""
    try:
        import tokenizers  # noqa: F401
    except ImportError:
        path = None
    return (token_estimate, False) if path is None else (lambda text: token_count(text, path), True)


def token_count(text: Column, path: str) -> Column:
    """The tokens of a whole text, without special ones; null for null."""

    @F.arrow_udf("long")
    def run(texts):
        import pyarrow as pa

        own, out = tokenizer(path), []
        for at in range(0, len(texts), 100):
            part = texts.slice(at, 100).to_pylist()
            found = own.encode_batch_fast([x or "" for x in part], add_special_tokens=False)
            out += [None if x is None else len(f.ids) for x, f in zip(part, found, strict=True)]
        return pa.array(out, pa.int64())

    return run(text)
