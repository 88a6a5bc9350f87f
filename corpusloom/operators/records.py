"""Corpus records: assembly, validation, union of categories, and shuffling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import stripped, token_estimate

REQUIRED = ("id", "source", "category", "tier", "license", "url", "lang", "text", "n_tokens", "collected_at")
#: Categories in the order they are merged, with the band of their share of tokens; seed of the shuffle.
TARGET_MIX = (("cat1", 0.60, 0.70), ("cat2", 0.15, 0.25), ("cat3", 0.10, 0.15))
SHUFFLE_SEED = 20260721
LANG = "en"
PLACE_BITS = 56


def assemble(drafts: DataFrame, category: str, collected_at: str, tier: str = "D", tokens: Column | None = None, extra: dict[str, Column] | None = None, exact: bool | None = None) -> DataFrame:
    """Records of drafts (doc_id, source_type, source_name, license_status, url, text, and optionally ocr and
    ocr_confidence).  extra adds fields and may not replace required ones.  The time is a parameter: a run is repeatable.

    tokens counts the tokens of a text, by a tokenizer unless exact is False (see functions.tokens); without it they are
    estimated.
    """
    if clash := sorted(set(REQUIRED) & set(extra or {})):
        raise ValueError(f"extra fields may not replace {clash}")
    has = set(drafts.columns)
    ocr = F.coalesce("ocr", F.lit(False)) if "ocr" in has else F.lit(False)
    confidence = F.when(ocr, F.bround("ocr_confidence", 4)) if "ocr_confidence" in has else F.lit(None).cast("double")
    fields = {
        "id": F.concat(F.lit(f"{category}-"), F.col("doc_id").cast("string"), F.lit("-"), F.col("source_type")),
        "source": F.coalesce(F.when(F.col("source_name") != "", F.col("source_name")), F.col("source_type")),
        "category": F.lit(category),
        "tier": F.lit(tier),
        "license": F.col("license_status"),
        "url": F.col("url"),
        "lang": F.lit(LANG),
        "text": F.col("text"),
        "n_tokens": token_estimate(F.col("text")) if tokens is None else tokens,
        "n_tokens_exact": F.lit(tokens is not None if exact is None else exact),
        "source_type": F.col("source_type"),
        "ocr": ocr,
        "collected_at": F.lit(collected_at),
        "ocr_confidence": confidence,
    }
    return drafts.select(*(c.alias(k) for k, c in (fields | (extra or {})).items()))


def invalid(records: DataFrame) -> Column:
    """Whether a record lacks a required field or has a blank text."""
    lacking = F.lit(False)
    for name in REQUIRED:
        lacking |= F.col(name).isNull() if name in records.columns else F.lit(True)
    return lacking | (F.coalesce(stripped(F.col("text")), F.lit("")) == "")


def validated(records: DataFrame) -> DataFrame:
    """records; an invalid one fails the job."""
    return records.withColumn("text", F.when(invalid(records), F.raise_error(F.concat(F.lit("invalid record "), F.coalesce("id", F.lit("without id"))))).otherwise(F.col("text")))


def union(categories: dict[str, DataFrame]) -> DataFrame:
    """All categories in order, with `ord` (long) that orders the whole; fields that a category lacks are null.  The place of
    the category stands above PLACE_BITS, and the row in it below, for as many as 2^23 partitions."""
    out = None
    for place, (name, rows) in enumerate(categories.items()):
        own = rows.withColumn("category", F.lit(name)).withColumn("ord", F.lit(place << PLACE_BITS).cast("long") + F.monotonically_increasing_id())
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    return out


def shuffled(records: DataFrame, key: str = "id", seed: int = SHUFFLE_SEED) -> DataFrame:
    """A repeatable order that does not depend on partitions."""
    return records.orderBy(F.xxhash64(key, F.lit(seed)), key)
