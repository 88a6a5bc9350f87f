"""License gates: classification, detection from text, permission to collect, and mismatches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import stripped

NONE = "no-license"
# License ids that may be used.
ALLOWED = r"^(?:MIT|BSD-\p{Nd}-Clause|Apache-2\.0|CC-BY-\p{Nd}\.\p{Nd})$"
# Names of license files in the order they are looked for, characters of a file that are read, and what is
# found in the texts of licenses, in order.
FILE_NAMES = ("LICENSE", "LICENSE.md", "LICENSE.txt", "LICENSE.TXT", "LICENCE", "COPYING", "COPYING.txt", "LICENSE-APACHE")
HEAD_CHARS = 8000
SIGNATURES = (
    (r"GNU LESSER GENERAL PUBLIC LICENSE", "LGPL"),
    (r"GNU GENERAL PUBLIC LICENSE", "GPL"),
    (r"Apache License[\s,]*Version 2\.0", "Apache-2.0"),
    (r"MIT License|Permission is hereby granted, free of charge", "MIT"),
    (r"Creative Commons Attribution 4\.0", "CC-BY-4.0"),
    (r"Creative Commons Attribution 3\.0", "CC-BY-3.0"),
    (r"NVIDIA (Source Code )?License", "NVIDIA-Proprietary"),
    (r"Mozilla Public License", "MPL"),
)
BSD, BSD_THIRD = "Redistribution and use in source and binary forms", "Neither the name"


def classify(spdx: Column) -> Column:
    """The id itself if it is allowed, no-license for null and empty ids, else flagged:<id>."""
    bare = stripped(spdx)
    return F.when(F.coalesce(spdx, F.lit("")) == "", NONE).when(F.regexp_like(bare, F.lit(ALLOWED)), bare).otherwise(F.concat(F.lit("flagged:"), bare))


def collectible(status: Column, exempt: Column) -> Column:
    """Allowed licenses are; none at all is if the entry is exempt; flagged ones never are."""
    return F.when(status == NONE, F.coalesce(exempt, F.lit(False))).otherwise(~F.startswith(status, F.lit("flagged:")))


def detect(text: Column) -> Column:
    """The license that the head of a text is of; null if none is known."""
    head = F.substring(text, 1, HEAD_CHARS)

    def has(pattern: str) -> Column:
        return F.regexp_like(head, F.lit(f"(?iu){pattern}"))

    known = reduce(lambda c, s: c.when(has(s[0]), s[1]), SIGNATURES[1:], F.when(has(SIGNATURES[0][0]), SIGNATURES[0][1]))
    return known.when(has(BSD), F.when(has(BSD_THIRD), "BSD-3-Clause").otherwise("BSD-2-Clause"))


def license_file(files: DataFrame, key: str, name: str = "name", text: str = "text") -> DataFrame:
    """For each key, the first license file by FILE_NAMES and what is detected in it."""
    order = F.array_position(F.array(*map(F.lit, FILE_NAMES)), F.col(name))
    first = files.where(F.col(name).isin(*FILE_NAMES)).groupBy(key).agg(F.min_by(F.struct(name, F.substring(text, 1, HEAD_CHARS).alias("head")), order).alias("f"))
    return first.select(key, F.col(f"f.{name}").alias("license_file"), detect(F.col("f.head")).alias("license_detected"))


def mismatches(rows: DataFrame, declared: str = "license_declared", detected: str = "license_detected") -> DataFrame:
    """Rows whose detected license is not the declared one; the declared one counts, so these are warnings."""
    return rows.where(F.col(declared).isNotNull() & F.col(detected).isNotNull() & (F.col(declared) != F.col(detected)))


def licensed(records: DataFrame, license: str = "license") -> DataFrame:
    """What a user who needs a license may take: records that have one."""
    return records.where(F.col(license) != NONE)
