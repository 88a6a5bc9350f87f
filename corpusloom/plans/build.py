"""The two jobs of a corpus: building a category, and merging categories."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import token_estimate
from ..operators import contamination, dedup, licenses, quota, records, scrub, stats
from ..staging import shared_table


@dataclass
class Built:
    """What a job made: records or documents, what it left out and why, and whether a gate held."""

    kept: DataFrame
    events: DataFrame
    passed: bool = True
    documents: DataFrame | None = field(default=None, repr=False)


def event(rows: DataFrame, reason: Column | str, item: str = "doc_id", outcome: str = "skip", message: Column | None = None) -> DataFrame:
    """Rows of an event table: outcome, item, reason, message."""
    why = F.lit(reason) if isinstance(reason, str) else reason
    return rows.select(F.lit(outcome).alias("outcome"), F.col(item).cast("string").alias("item"), why.alias("reason"), (F.lit(None) if message is None else message).cast("string").alias("message"))


def _duplicates(rows: DataFrame, verdicts: DataFrame, key: str) -> DataFrame:
    """Events of the duplicates among rows (key, ord), which say what they are duplicates of."""
    originals = rows.select(F.col("ord").alias("matched"), F.col(key).cast("string").alias("__original"))
    found = rows.select(key, "ord").join(verdicts.where("kind <> ''"), "ord").join(originals, "matched", "left")
    original = F.concat(F.lit("`"), "__original", F.lit("`"))
    near = F.concat(F.lit("near-duplicate of "), original, F.lit(" (estimated similarity "), F.format_number("similarity", 2), F.lit(")"))
    message = F.when(F.col("kind") == "exact", F.concat(F.lit("exact duplicate of "), original)).otherwise(near)
    return event(found, F.concat(F.col("kind"), F.lit(" duplicate")), key, message=message)


def build_category(candidates: DataFrame, rules: list[dict], budgets: DataFrame, threshold: float = dedup.THRESHOLD, scale: float = 1.0, only: list[str] | None = None, tokens=token_estimate) -> Built:
    """Mask secrets, leave out contaminated documents, then duplicates, then what is over a source's budget.

    candidates: doc_id, source_id, grp, rel_path, ord (unique, the order that duplicates are decided in), text.  budgets:
    source_id, token_budget, and optionally pool, a name under which sources share one budget.  Documents over budget have
    already counted as originals of duplicates.  A threshold of 0 keeps all duplicates.  Each candidate is either kept or in
    the events; documents of a source without a budget are left out with an event, and a source in several rows of budgets
    has the largest one.  Names in `only` must be sources of the candidates or budgets.  tokens counts the tokens of a text.
    """
    if only is not None:
        known = budgets.select("source_id").union(candidates.select("source_id")).where(F.col("source_id").isin(only)).distinct().collect()  # at most as many as in `only`
        if unknown := sorted(set(only) - {r.source_id for r in known}):
            raise ValueError(f"unknown sources: {unknown}")
    docs = candidates.where(F.col("source_id").isin(only)) if only is not None else candidates
    checked = shared_table(contamination.check(scrub.scrub(docs), rules), "checked")
    clean, dirty = checked.where("match is null").drop("match"), checked.where("match is not null")
    events = event(dirty, "contaminated", message=contamination.described(F.col("match")))
    if threshold > 0:
        verdicts = shared_table(dedup.greedy_duplicates(clean, "ord", "text", threshold), "verdicts")
        events = events.unionByName(_duplicates(clean, verdicts, "doc_id"))
        clean = clean.join(verdicts.where("kind = ''").select("ord"), "ord", "left_semi")
    counted = shared_table(clean.withColumn("n_tokens", tokens(F.col("text"))), "counted")
    pool = F.coalesce("pool", "source_id") if "pool" in budgets.columns else F.col("source_id")
    limits = budgets.withColumn("__pool", pool)
    shares = limits.groupBy("__pool").agg(F.max(quota.scaled_budget(F.col("token_budget"), scale)).alias("__budget"))
    pools = limits.where("source_id is not null").groupBy("source_id").agg(F.min("__pool").alias("__pool")).join(shares, "__pool")
    placed = counted.select("doc_id", "ord", "source_id", "grp", "rel_path", "n_tokens").join(pools, "source_id", "left")
    chosen = shared_table(quota.select_within_budget(placed.where("__budget is not null"), F.col("__budget"), "__pool").select("doc_id", "ord", "kept"), "quota")
    kept = counted.join(chosen.where("kept").select("ord"), "ord", "left_semi")
    events = events.unionByName(event(chosen.where("not kept"), "over quota")).unionByName(event(placed.where("__budget is null"), "no budget"))
    return Built(kept, events, documents=counted)


def merge(categories: dict[str, DataFrame], rules: list[dict], threshold: float = dedup.THRESHOLD, across: bool = True, shuffle: bool = False) -> Built:
    """One corpus of all categories: invalid records go, then those whose id an earlier kept one has, contaminated ones,
    and duplicates anywhere.  It passes if the mix of categories is in its bands."""
    joined = records.union(categories)
    rows = shared_table(joined.withColumn("invalid", records.invalid(joined)), "merged")
    valid = rows.where("not invalid")
    checked = shared_table(contamination.check(valid, rules), "checked")
    dirty = event(checked.where("match is not null"), "contaminated", "id", message=contamination.described(F.col("match")))
    events = event(rows.where("invalid"), "invalid record", "id").unionByName(dirty)
    clean = checked.where("match is null").drop("match", "invalid")
    # An id counts as taken only if its record stays; the first of an id among clean records is decided with the
    # duplicates, and a later one comes up again if that one goes.
    left, kept = clean, None
    signed = dedup.signatures(clean) if across else None  # once, for all rounds
    while True:
        taken = shared_table(dedup.colliding_ids(left, "id", "ord"), "taken-ids")
        first = left.join(taken, "ord", "left_anti")
        if not across:
            good = first
            break
        verdicts = shared_table(dedup.greedy_duplicates(first, "ord", "text", threshold, signed=signed), "verdicts")
        dropped = first.select("id", "ord").join(verdicts.where("kind <> ''"), "ord")
        freed = left.join(taken, "ord", "left_semi").join(dropped.select("id"), "id", "left_semi")
        if freed.isEmpty():
            good = first.join(verdicts.where("kind = ''").select("ord"), "ord", "left_semi")
            events = events.unionByName(_duplicates(first, verdicts, "id"))
            break
        events = events.unionByName(_duplicates(first, verdicts, "id"))
        left = shared_table(left.join(dropped.select("ord"), "ord", "left_anti"), "undecided")
    events = events.unionByName(event(left.join(taken, "ord", "left_semi"), "colliding identifier", "id"))
    kept = shared_table(good, "corpus")
    passed = stats.mix(kept).agg(F.min("in_band")).first()[0]
    return Built(records.shuffled(kept) if shuffle else kept.orderBy("ord"), events, bool(passed))


def collectible_sources(catalogue: DataFrame, detected: DataFrame, exempt: list[str] = ()) -> Built:
    """Sources whose license allows it, with the status of each; detected licenses that differ are warnings."""
    rows = catalogue.join(detected, "source_id", "left").withColumn("license_status", licenses.classify(F.col("license_declared")))
    may = licenses.collectible(F.col("license_status"), F.col("source_id").isin(*exempt) if exempt else F.lit(False))
    differs = F.concat(F.lit("declared "), "license_declared", F.lit(", detected "), "license_detected")
    warned = event(licenses.mismatches(rows), "license mismatch", "source_id", "warn", differs)
    return Built(rows.where(may), event(rows.where(~may), F.col("license_status"), "source_id").unionByName(warned))
