"""Masking of secrets in texts of the corpus: each kind has a pattern, and each find becomes a marker with its kind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let

#: Kinds, what a text must hold for the pattern to be tried, and patterns, in the order they are applied.  The part of a match that is not secret is group 1.
KINDS = (
    ("private_key", "PRIVATE KEY-----", r"()-----BEGIN [A-Z ]*PRIVATE KEY-----[\s\S]*?-----END [A-Z ]*PRIVATE KEY-----"),
    ("url_credentials", "://", r"(://[^\s/:@<>]+:)(?!\*+@|<)[^\s/@<>]+(?=@)"),
    ("aws_key", "AKIA", r"()\bAKIA[0-9A-Z]{16}\b"),
    ("provider_token", None, r"()\b(?:gh[pousr]_[A-Za-z0-9]{36,}|hf_[A-Za-z0-9]{30,}|sk-[A-Za-z0-9_\-]{20,}|xox[abprs]-[A-Za-z0-9\-]{10,}|glpat-[A-Za-z0-9_\-]{20,})"),
    ("assigned_secret", None, r"""((?i:api_?key|secret|token|passw(?:or)?d)["']?\s*[:=]\s*["']?)(?!(?i:your|my|some|example|placeholder|x{3,}|\*{3,}|<|\$\{))[A-Za-z0-9+/_\-]{16,}={0,2}"""),
)


def marker(kind: str) -> str:
    return f"[REDACTED:{kind}]"


def scrub(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with secrets of text masked, and `redacted` (map of kind to count) and `n_redacted`.  Placeholders such as
    YOUR_API_KEY and <token> are spared."""
    out = F.col(text)
    for kind, sign, pattern in KINDS:
        out = let(out, _masked(kind, sign, pattern))
    rows = docs.withColumn("__text", out)
    # A mask that the text had before is none of ours.
    counts = [F.regexp_count("__text", F.lit(_quoted(k))) - F.regexp_count(F.col(text), F.lit(_quoted(k))) for k, _, _ in KINDS]
    found = F.when(F.col("__text") == F.col(text), F.create_map().cast("map<string,int>")).otherwise(F.map_filter(F.create_map(*(x for (k, _, _), n in zip(KINDS, counts) for x in (F.lit(k), n))), lambda k, n: n > 0))
    total = F.aggregate(F.map_values("redacted"), F.lit(0), lambda a, b: a + b)
    return rows.withColumn("redacted", F.coalesce(found, F.create_map().cast("map<string,int>"))).withColumn("n_redacted", total).withColumn(text, F.col("__text")).drop("__text")


def _quoted(kind: str) -> str:
    return rf"\[REDACTED:{kind}\]"


def _masked(kind: str, sign: str | None, pattern: str):
    """A function of a text; the pattern is tried only where the text has the sign."""

    def mask(x: Column) -> Column:
        done = F.regexp_replace(x, F.lit(pattern), F.lit(f"$1{marker(kind)}"))
        return done if sign is None else F.when(F.contains(x, F.lit(sign)), done).otherwise(x)

    return mask


def described(redacted: Column) -> Column:
    """kind x count, for records and reports; null if nothing was masked."""
    entries = F.transform(F.array_sort(F.map_entries(redacted)), lambda e: F.concat(e["key"], F.lit(" x"), e["value"].cast("string")))
    return F.when(F.size(redacted) > 0, F.array_join(entries, ", "))
