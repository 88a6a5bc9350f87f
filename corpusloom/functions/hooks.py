"""Where outside programs plug in: writers of descriptions, and recognisers of text in images."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..staging import shared_table

#: Version of the recognised texts that a cache may hold; another one is made anew.
CACHE_VERSION = 2

#: name -> function of a prompt and of what the writer is told to be, or None for the text that needs no writer.
WRITERS: dict[str, Callable[[str, str], str] | None] = {"template": None}
#: name -> function of the bytes of an image that gives blocks (text, score, x, top, bottom); the first is preferred.
RECOGNISERS: dict[str, Callable[[bytes], list[tuple]]] = {}

BLOCKS = "array<struct<text:string,score:double,x:double,top:double,bottom:double>>"


def writer(name: str | None) -> Callable[[str, str], str] | None:
    """The writer of a name; unknown names stand for the template."""
    return WRITERS.get(name)


def written(prompt: Column, name: str | None, role: str = "") -> Column:
    """What a writer, told its role, makes of a prompt; null for the template."""
    function = writer(name)
    if function is None:
        return F.lit(None).cast("string")

    @F.pandas_udf("string")
    def run(prompts: pd.Series) -> pd.Series:
        return prompts.map(lambda x: function(x, role), na_action="ignore")

    return run(prompt)


def recogniser(name: str | None = None) -> Callable[[bytes], list[tuple]]:
    """A recogniser by name, or else the first that is plugged in."""
    if name is not None and name in RECOGNISERS:
        return RECOGNISERS[name]
    if name is None and RECOGNISERS:
        return next(iter(RECOGNISERS.values()))
    raise LookupError("no recogniser of text is plugged in")


def recognised(image: Column, name: str | None = None) -> Column:
    """The blocks of an image."""
    function = recogniser(name)

    @F.pandas_udf(BLOCKS)
    def run(images: pd.Series) -> pd.Series:
        names = ("text", "score", "x", "top", "bottom")
        return images.map(lambda raw: [dict(zip(names, block)) for block in function(bytes(raw))], na_action="ignore")

    return run(image)


def with_cache(wanted: DataFrame, cache: DataFrame, make: Callable[[DataFrame], DataFrame], key: list[str]) -> DataFrame:
    """Rows of the cache for the wanted keys, and newly made ones for the others; rows of another version do not count."""
    valid = cache.where(F.col("version") == CACHE_VERSION)
    missing = make(wanted.join(valid.select(key), key, "left_anti")).withColumn("version", F.lit(CACHE_VERSION))
    return shared_table(valid.join(wanted.select(key), key, "left_semi").unionByName(missing), "recognised")
