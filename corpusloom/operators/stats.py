"""Figures of a corpus, and reports made from them."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..staging import shared_table
from .quota import running_total
from .records import TARGET_MIX

OUTCOMES = ("fail", "warn", "skip", "ok")


def by(rows: DataFrame, *keys: str, tokens: str = "n_tokens") -> DataFrame:
    """Documents, tokens and mean tokens by keys, with the share of all tokens in percent."""
    sums = rows.groupBy(*keys).agg(F.count("*").alias("n_docs"), F.sum(F.coalesce(tokens, F.lit(0))).cast("long").alias("tokens"))
    whole = rows.agg(F.sum(F.coalesce(tokens, F.lit(0))).cast("long").alias("__whole"))  # one row
    shared = sums.join(F.broadcast(whole)).withColumn("share_pct", F.when(F.col("__whole") > 0, F.col("tokens") * 100.0 / F.col("__whole")))
    return shared.withColumn("mean_tokens", F.floor(F.col("tokens") / F.col("n_docs")).cast("long")).drop("__whole")


TOTAL = "TOTAL"


def figures(rows: DataFrame, *dimensions: str, tokens: str = "n_tokens") -> DataFrame:
    """Documents, tokens and whether all counts are exact, by each dimension apart and in all, in one pass over rows.

    Columns: dimension (TOTAL for all rows), value (as text), n_docs, tokens, exact.  Sums are formed before the shuffle, so
    what is shuffled is a row for each value and task.  No rows give one row, the total with 0 documents.
    """
    exact = F.min("n_tokens_exact") if "n_tokens_exact" in rows.columns else F.lit(None).cast("boolean")
    sets = [[], *([F.col(d)] for d in dimensions)]
    sums = rows.groupingSets(sets, *(F.col(d) for d in dimensions)).agg(
        F.count("*").alias("n_docs"), F.coalesce(F.sum(tokens), F.lit(0)).cast("long").alias("tokens"), exact.alias("exact"), *(F.grouping(d).alias(f"__not_{i}") for i, d in enumerate(dimensions))
    )
    grouped = [F.when(F.col(f"__not_{i}") == 0, F.lit(d)) for i, d in enumerate(dimensions)]
    values = F.coalesce(*(F.when(F.col(f"__not_{i}") == 0, F.col(d).cast("string")) for i, d in enumerate(dimensions)))
    found = sums.select(F.coalesce(*grouped, F.lit(TOTAL)).alias("dimension"), values.alias("value"), "n_docs", "tokens", "exact")
    # no rows would give no total
    zero = F.lit(0).cast("long")
    none = rows.sparkSession.range(1).select(F.lit(TOTAL), F.lit(None).cast("string"), zero, zero, F.lit(None).cast("boolean"))
    return found.union(none).groupBy("dimension", "value").agg(F.sum("n_docs").alias("n_docs"), F.sum("tokens").alias("tokens"), F.min("exact").alias("exact"))


def _of(sums: DataFrame, dimension: str) -> DataFrame:
    """The rows of one dimension of figures(), by its name, with share_pct and mean_tokens as by() has them."""
    whole = sums.where(F.col("dimension") == TOTAL).select(F.col("tokens").alias("__whole"))  # one row
    own = sums.where(F.col("dimension") == dimension).select(F.col("value").alias(dimension), "n_docs", "tokens", "exact").join(F.broadcast(whole))
    shared = own.withColumn("share_pct", F.when(F.col("__whole") > 0, F.col("tokens") * 100.0 / F.col("__whole"))).drop("__whole")
    return shared.withColumn("mean_tokens", F.when(F.col("n_docs") > 0, F.floor(F.col("tokens") / F.col("n_docs")).cast("long")))


def source_table(rows: DataFrame, budget: Column) -> DataFrame:
    """By source: candidates, unique ones, kept ones and their tokens, and whether the budget was passed.

    rows has source_id, unique (boolean), kept (boolean), n_tokens.
    """
    kept = F.col("unique") & F.col("kept")
    sums = rows.groupBy("source_id").agg(
        F.count("*").alias("candidates"),
        F.count_if("unique").alias("unique"),
        F.count_if(kept).alias("kept"),
        F.coalesce(F.sum(F.when(kept, F.col("n_tokens"))), F.lit(0)).cast("long").alias("tokens"),
    )
    return sums.withColumn("over_budget", F.col("tokens") > budget)


def with_total(rows: DataFrame, key: str, tokens: str = "n_tokens") -> DataFrame:
    """Documents and tokens by key and in all; the total has the key TOTAL."""
    return rows.rollup(key).agg(F.count("*").alias("n_docs"), F.sum(tokens).cast("long").alias("tokens"), F.grouping(key).alias("__all")).select(F.when(F.col("__all") == 1, "TOTAL").otherwise(F.col(key)).alias(key), "n_docs", "tokens")


def distribution(rows: DataFrame, tokens: str = "n_tokens") -> DataFrame:
    """Median, 95th percentile and maximum of tokens, exact and interpolated.

    Documents are counted by their tokens first, so what is sorted is a row for each different count; the two counts beside
    each percentile are found from the running sums of a row a range.
    """
    counts = rows.where(F.col(tokens).isNotNull()).groupBy(F.col(tokens).cast("long").alias("v")).agg(F.count("*").alias("n"))
    summed = running_total(counts, [], ["v"], F.col("n"), "before")
    total = counts.agg(F.sum("n").alias("all"), F.max("v").alias("largest"))
    placed = summed.join(F.broadcast(total))

    def at(share: float) -> Column:
        place = (F.col("all") - 1) * F.lit(share)
        low, high = F.floor(place), F.ceil(place)
        inside = lambda k: (F.col("before") <= k) & (k < F.col("before") + F.col("n"))
        below, above = F.max(F.when(inside(low), F.col("v"))), F.max(F.when(inside(high), F.col("v")))
        return below + (above - below) * F.max(place - low)

    return placed.agg(at(0.5).alias("median"), at(0.95).alias("p95"), F.max("largest").alias("largest"))


#: Size of a quantile sketch.  Its rank error is about 0.3 % of the rows; up to so many rows it is exact.
SKETCH_K = 2048


def token_sketches(rows: DataFrame, *keys: str, tokens: str = "n_tokens") -> DataFrame:
    """keys, n_docs and sketch (binary) of the tokens of the documents of each; nulls are left out.

    The table is small, and is kept beside a corpus: sketches of parts are merged by quantiles(), so a corpus or a new part
    of it needs no second pass over the documents.
    """
    counted = rows.where(F.col(tokens).isNotNull())
    return counted.groupBy(*keys).agg(F.count("*").alias("n_docs"), F.kll_sketch_agg_bigint(F.col(tokens).cast("long"), SKETCH_K).alias("sketch"))


def quantiles(sketches: DataFrame, *keys: str, shares: tuple[float, ...] = (0.5, 0.95)) -> DataFrame:
    """keys, n_docs and p50, p95 (or others) of merged sketches: the least count that so large a share does not exceed, but
    for the sketch's error.  Without keys, of all."""
    merged = sketches.groupBy(*keys).agg(F.sum("n_docs").alias("n_docs"), F.kll_merge_agg_bigint("sketch", SKETCH_K).alias("sketch"))
    return merged.where("n_docs > 0").select(*keys, "n_docs", *(F.kll_sketch_get_quantile_bigint("sketch", F.lit(x)).alias(f"p{x * 100:g}") for x in shares))


def token_counts(rows: DataFrame, *keys: str, tokens: str = "n_tokens") -> DataFrame:
    """keys, tokens and n: how many documents of each key have so many tokens; nulls are left out.

    The table has a row for each different count, and tables of parts are put together by exact_quantiles(), as sketches are.
    """
    return rows.where(F.col(tokens).isNotNull()).groupBy(*keys, F.col(tokens).cast("long").alias("tokens")).agg(F.count("*").alias("n"))


def exact_quantiles(counts: DataFrame, *keys: str, shares: tuple[float, ...] = (0.5, 0.95)) -> DataFrame:
    """keys, n_docs and p50, p95 (or others) of tables of token_counts(): the least count that so large a share does not
    exceed.  Without keys, of all.  No document gives no row.

    What is summed up is a row for each different count, by ranges, so no key's counts are gathered in one task.
    """
    merged = counts.groupBy(*keys, "tokens").agg(F.sum("n").alias("n"))
    placed = running_total(merged, list(keys), ["tokens"], F.col("n"), "before")
    whole = merged.groupBy(*(F.col(k).alias(f"__{k}") for k in keys)).agg(F.sum("n").alias("n_docs"))
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"__{k}"))
    reached = F.col("before") + F.col("n")
    # in decimals: a share of 0.95 is no whole number of binary places
    found = [F.min(F.when(reached >= F.ceil(F.col("n_docs") * F.lit(Decimal(str(x)))), F.col("tokens"))).alias(f"p{x * 100:g}") for x in shares]
    return placed.join(F.broadcast(whole), same).groupBy(*keys, "n_docs").agg(*found)


def mix(rows: DataFrame, bands: tuple = TARGET_MIX, key: str = "category", tokens: str = "n_tokens") -> DataFrame:
    """Each category's tokens and share, and whether it is in its band, borders included; absent categories have 0."""
    spark = rows.sparkSession
    wanted = spark.createDataFrame(list(bands), f"{key} string, low double, high double")
    sums = rows.groupBy(key).agg(F.sum(tokens).cast("long").alias("tokens"))
    whole = rows.agg(F.sum(tokens).alias("whole"))
    joined = F.broadcast(wanted).join(sums, key, "left").join(F.broadcast(whole))
    share = F.when(F.col("whole") > 0, F.coalesce("tokens", F.lit(0)) / F.col("whole")).otherwise(0.0)
    return joined.select(key, F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"), share.alias("share"), share.between(F.col("low"), F.col("high")).alias("in_band"))


def outcome_counts(events: DataFrame) -> DataFrame:
    """Events by outcome, with 0 for outcomes that did not occur."""
    return events.agg(*(F.count_if(F.col("outcome") == x).alias(x) for x in OUTCOMES))


def dropped_by_reason(events: DataFrame) -> DataFrame:
    return events.where("outcome = 'skip'").groupBy("reason").count().withColumnRenamed("count", "n").orderBy(F.desc("n"), "reason")


def masked_by_kind(docs: DataFrame) -> DataFrame:
    """Masked secrets by kind."""
    return docs.select(F.explode("redacted").alias("kind", "n")).groupBy("kind").agg(F.sum("n").cast("long").alias("n")).orderBy(F.desc("n"), "kind")


def manuals_checklist(manuals: DataFrame, files: DataFrame, permitted: Column) -> DataFrame:
    """For each entry of a manifest whether its file is there, and whether it can be collected now."""
    there = files.select("robot_id", F.lit(True).alias("__there")).distinct()
    rows = manuals.join(there, "robot_id", "left").withColumn("present", F.coalesce("__there", F.lit(False))).drop("__there")
    return rows.withColumn("collectible", permitted).withColumn("ready", F.col("present") & F.col("collectible"))


def checklist_counts(checklist: DataFrame) -> DataFrame:
    """How many manuals there are, and how many are present, permitted, and collectible now."""
    return checklist.agg(F.count("*").alias("manuals"), *(F.count_if(k).alias(k) for k in ("present", "collectible", "ready")))


def total_budget(catalogue: DataFrame) -> DataFrame:
    """The tokens of all budgets."""
    return catalogue.agg(F.coalesce(F.sum("token_budget"), F.lit(0)).cast("long").alias("total_budget"))


def by_family(catalogue: DataFrame) -> DataFrame:
    """The sources of each family, by name, and the sum of their budgets."""
    return catalogue.groupBy("family").agg(F.array_sort(F.collect_list("source_id")).alias("sources"), F.sum("token_budget").cast("long").alias("token_budget"))


def papers_represented(kept: DataFrame, pool: DataFrame, group: str = "grp") -> DataFrame:
    """Distinct papers that kept documents are from, and of the pool."""
    n = F.count_distinct(group)
    return kept.agg(n.alias("kept")).join(F.broadcast(pool.agg(n.alias("pool"))))


def cell(value: object) -> str:
    """A value in a cell of a Markdown table."""
    text = "" if value is None else f"{value:,}" if isinstance(value, int) and not isinstance(value, bool) else str(value)
    return text.replace("|", "\\|").replace("\n", " ")


def markdown(title: str, rows: DataFrame) -> str:
    """A small table of figures as Markdown.  It is for aggregates: rows are brought to the driver."""
    names = rows.columns
    lines = [f"## {title}", "", f"| {' | '.join(names)} |", f"|{'---|' * len(names)}"]
    return "\n".join([*lines, *(f"| {' | '.join(map(cell, r))} |" for r in rows.collect())]) + "\n"


#: Events that a report lists at most for each outcome; counts are always whole, and so is the event table itself.
LISTED = {"fail": 1000, "warn": 1000, "skip": 200, "ok": 200}
#: Headings of the outcomes in a run report.
LABELS = {"fail": "Failures", "warn": "Warnings", "skip": "Skipped", "ok": "Successes"}


def run_report(name: str, events: DataFrame, seconds: float, started: str = "", context: dict[str, str] | None = None) -> str:
    """Markdown report of a run: counts, then failures, warnings, what was left out, and successes, none of them silent.

    Counts cover all events, by outcome and reason.  Of each outcome the first LISTED events are shown one by one, with
    tracebacks folded if the events have a column trace; a line says how many there are besides.  The driver gets no more
    rows than that, whatever the number of events.
    """
    counts = outcome_counts(events).first().asDict()
    parts = [f"# {name} — run report", "", *([f"- Started: {started}"] if started else []), f"- Duration: {seconds:.1f} s", *(f"- {k}: {v}" for k, v in (context or {}).items()), ""]
    parts += ["## Summary", "", "| outcome | n |", "|---|---|", *(f"| {k} | {n} |" for k, n in counts.items()), f"| **total** | **{sum(counts.values())}** |", ""]
    traced = "trace" in events.columns
    columns = ["item", "reason", "message"]
    for outcome in (x for x in OUTCOMES if counts[x]):
        own = events.where(F.col("outcome") == outcome)
        shown = own.select(*columns, *(["trace"] if traced else [])).orderBy("item", "reason").limit(LISTED[outcome])
        parts.append(markdown(f"{LABELS[outcome]} ({counts[outcome]}) by reason", own.groupBy("reason").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason").limit(LISTED[outcome])))
        parts.append(markdown(LABELS[outcome], shown.select(*columns)))
        if counts[outcome] > LISTED[outcome]:
            parts.append(f"and {counts[outcome] - LISTED[outcome]} more, in the event table\n")
        for r in shown.where("trace is not null").collect() if traced else ():
            parts.append(f"<details><summary><code>{r.item}</code></summary>\n\n```\n{r.trace}\n```\n\n</details>\n")
    return "\n".join(parts)


def _lines(title: str, rows: DataFrame, form: str) -> str:
    return "\n".join([f"## {title}", "", *(form.format(*r) for r in rows.collect()), ""])


def _outside(license: Column) -> Column:
    """The license, marked if it is outside of what is allowed."""
    outside = (license == "no-license") | F.startswith(license, F.lit("flagged:"))
    return F.concat(license, F.when(outside, "  <- outside allowlist, inclusion on a recorded decision").otherwise(""))


def _heading(title: str, sums: DataFrame, facts: dict[str, str]) -> str:
    whole = _of(sums, TOTAL).first()
    exact = "exact" if whole.exact else "approximate"
    return "\n".join([f"# {title} — statistics", "", *(f"- {k}: {v}" for k, v in facts.items()), f"- Records: {whole.n_docs}", f"- Total tokens: {whole.tokens:,} ({exact})", ""])


def category_report(title: str, kept: DataFrame, sources: DataFrame, events: DataFrame, masked: DataFrame, facts: dict[str, str] | None = None) -> str:
    """The report of a category of sources: by family, source, kind and license, what was left out, and masked secrets.

    kept: records with family, kind, license, n_tokens.  sources: source_id, family, kept, tokens, token_budget, over_quota.
    masked: kind, n.
    """
    sums = shared_table(figures(kept, "family", "kind", "license"), "figures")
    return "\n".join([
        _heading(title, sums, facts or {}),
        markdown("Per source family", _of(sums, "family").orderBy(F.desc("tokens"), "family").select("family", "n_docs", "tokens", F.concat(F.format_number("share_pct", 1), F.lit(" %")).alias("share"))),
        markdown("Per source", sources.orderBy(F.desc("tokens"), "source_id").select("source_id", "family", "kept", "tokens", "token_budget", "over_quota")),
        _lines("Per content nature", _of(sums, "kind").select("kind", "n_docs").orderBy("kind"), "- {}: {} documents"),
        _lines("Per license", _of(sums, "license").select("license", "n_docs").orderBy("license"), "- {}: {}"),
        markdown("Dropped documents", dropped_by_reason(events)),
        _lines("Masked secrets", masked, "- {}: {}") if not masked.isEmpty() else "## Masked secrets\n\n- no secret detected in the retained sources\n",
    ])


def extraction_report(title: str, kept: DataFrame, events: DataFrame, facts: dict[str, str] | None = None) -> str:
    """The report of a category of robots and manuals: by source type and license, how texts were extracted, and what was
    left out.  kept: records with source_type, license, n_tokens, ocr, ocr_confidence."""
    sums = shared_table(figures(kept, "source_type", "license", "ocr"), "figures")
    by_type = _of(sums, "source_type").orderBy("source_type").select("source_type", "n_docs", "tokens", "mean_tokens")
    quality = {r.ocr: r.n_docs for r in _of(sums, "ocr").collect()}  # two values
    recognised = kept.where("ocr").select("id", "ocr_confidence").orderBy("id").limit(LISTED["ok"])
    return "\n".join([
        _heading(title, sums, facts or {}),
        _lines("Per source type", by_type, "- {}: {} records, {} tokens (mean {})"),
        _lines("Per license", _of(sums, "license").select(_outside(F.col("license")).alias("license"), "n_docs").orderBy("license"), "- {}: {}"),
        f"## Extraction quality\n\n- Native extraction: {quality.get('false', 0)}\n- Text from OCR: {quality.get('true', 0)}",
        *(f"  - `{r.id}` — mean confidence {r.ocr_confidence}" for r in recognised.collect()),
        "",
        markdown("Skipped", dropped_by_reason(events)),
    ])


def merged_report(title: str, kept: DataFrame, events: DataFrame, facts: dict[str, str] | None = None) -> str:
    """The report of the whole corpus: the mix and its verdict, and figures by category, tier, license and nature."""
    sums = shared_table(figures(kept, "category", "tier", "license", "source_type"), "figures")
    shares = mix(_of(sums, "category"), tokens="tokens").orderBy("category").collect()
    bands = {c: (low, high) for c, low, high in TARGET_MIX}
    verdict = "COMPLIANT" if all(r.in_band for r in shares) else "NON-COMPLIANT"
    rows = [f"| {r.category} | {r.tokens:,} | {100 * r.share:.1f} % | {100 * bands[r.category][0]:.0f}-{100 * bands[r.category][1]:.0f} % | {'OK' if r.in_band else 'OUT OF BAND'} |" for r in shares]
    return "\n".join([
        _heading(title, sums, facts or {}),
        "## Mix per category", "", "| Category | Tokens | Share | Target band | Verdict |", "|---|---:|---:|---:|---|", *rows, "", f"**Overall mix: {verdict}**", "",
        markdown("Documents per category", _of(sums, "category").unionByName(_of(sums, TOTAL).withColumn(TOTAL, F.lit(TOTAL)).withColumnRenamed(TOTAL, "category")).select("category", "n_docs", "tokens", F.col("mean_tokens").alias("mean")).orderBy((F.col("category") == TOTAL), "category")),
        _lines("Per tier", _of(sums, "tier").orderBy("tier").select("tier", "tokens"), "- {}: {:,} tokens"),
        markdown("Per license", _of(sums, "license").select(_outside(F.col("license")).alias("license"), F.col("n_docs").alias("documents")).orderBy(F.desc("documents"), "license")),
        _lines("Per source nature", _of(sums, "source_type").select("source_type", "n_docs").orderBy(F.desc("n_docs"), "source_type"), "- {}: {} documents"),
        markdown("Dropped at merge time", dropped_by_reason(events)),
    ])
