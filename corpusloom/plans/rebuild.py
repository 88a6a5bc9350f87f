"""The whole job: from folders of raw files to the merged corpus, its audit and its reports.

Steps: the license gate, scans and adapters of each source; the build of each category (robots and manuals first); the
merge; the audit of all corpora.  What goes wrong with one source or file is an event and stops nothing; a step that fails
as a whole stops the run.  Folders are listed by Spark, so raw files may be in any store that it reads.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import tokens as exact
from ..operators import adapters, contamination, licenses, manuals, records, stats, urdf
from ..sources import files
from ..staging import drop_tables, scratch_path, shared_table
from . import resume
from .build import Built, build_category, collectible_sources, event, merge

CATALOGUE = "category string, source_id string, family string, kind string, license_declared string, url string, token_budget long, pool string, allow_no_license boolean, repo_ref string, repo_commit string"
RECORD = "id string, source string, category string, tier string, license string, url string, lang string, text string, n_tokens long, n_tokens_exact boolean, source_type string, ocr boolean, collected_at string, ocr_confidence double"
TIERS = {"cat1": "A", "cat2": "B", "cat3": "D"}
EVENT = "outcome string, item string, reason string, message string"


@dataclass
class Run:
    """What a run made: records of each category, the corpus, events, the audit, reports as Markdown, and whether all held."""

    categories: dict[str, DataFrame] = field(default_factory=dict)
    corpus: DataFrame | None = None
    events: DataFrame | None = None
    audit: contamination.Audit | None = None
    reports: dict[str, str] = field(default_factory=dict)
    passed: bool = True

    @property
    def exit_code(self) -> int:
        return 0 if self.passed else 1


def detected_licenses(spark: SparkSession, root: str, sources: list[str]) -> DataFrame:
    """source_id, license_file, license_detected of the license file in the first folder of each source that is there."""
    there = sorted(set(sources) & files.folders(spark, root))
    if not there:
        return spark.createDataFrame([], "source_id string, license_file string, license_detected string")
    found = files.scan_sources(spark, root, there, licenses.FILE_NAMES, whole_names=True).where(F.col("rel_path").isin(*licenses.FILE_NAMES))
    return licenses.license_file(found.select("source_id", F.col("rel_path").alias("name"), files.lenient_text(F.col("content")).alias("text")), "source_id")


def adapted(spark: SparkSession, root: str, sources: list[dict], store: str | None = None) -> tuple[DataFrame | None, list[tuple]]:
    """The candidates of all sources in their order, with `ord`, and a failure for each source that cannot be read.

    All sources are one scan: each file has its source's description by a join with the catalogue, and goes to the adapter
    of its kind, so the plan is the same for one source and for thousands.  With a store (see resume), sources that did not
    change since the last run are not read again.
    """
    there = files.folders(spark, root)
    failed = [("fail", m["source_id"], "missing raw folder", f"{root}/{m['source_id']}") for m in sources if m["source_id"] not in there]
    failed += [("fail", m["source_id"], "unknown kind", f"unknown kind of source: {m['kind']}") for m in sources if m["source_id"] in there and m["kind"] not in adapters.KINDS]
    read = [(i, *(m[k] for k in adapters.META)) for i, m in enumerate(sources) if m["source_id"] in there and m["kind"] in adapters.KINDS]
    if not read:
        return None, failed
    described = spark.createDataFrame(read, f"{adapters.PLACE} int, " + ", ".join(f"{k} string" for k in adapters.META))
    if store is not None:
        known = resume.resumed(spark, root, [dict(zip(adapters.META, r[1:], strict=True)) for r in read], store).candidates
        rows = known.join(F.broadcast(described.select("source_id", adapters.PLACE)), "source_id")
    else:
        raw = files.scan_sources(spark, root, sorted({r[1] for r in read}), adapters.ENDINGS).join(F.broadcast(described), "source_id")  # a row a source
        # Written by kind, so that a file is opened once, and an adapter reads its own kinds only.
        path = scratch_path(spark, "raw-files")
        raw.write.partitionBy("kind").parquet(path)
        rows = adapters.adapt_all(spark.read.schema(raw.schema).parquet(path))
    # Ranges in the order of sources, paths and parts: ids of a row rise with it, whatever the number of partitions.
    order = (adapters.PLACE, "path_parts", "part_no")
    ordered = shared_table(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("ord", F.monotonically_increasing_id()).drop(adapters.PLACE), "candidates")
    return ordered, failed


def _drafts(built: DataFrame, sources: DataFrame) -> DataFrame:
    known = F.broadcast(sources.select("source_id", "license_status", "url", "repo_commit"))  # a row a source of the catalogue
    return built.join(known, "source_id").withColumn("source_type", F.col("kind")).withColumn("source_name", F.col("source_id"))


def build_sources(spark: SparkSession, root: str, category: str, catalogue: DataFrame, rules: list[dict], collected_at: str, tokenizer: str | None = None, threshold: float | None = None, scale: float = 1.0, store: str | None = None) -> tuple[Built, str]:
    """A category of repositories and papers: records and events, and its report."""
    own = catalogue.where(F.col("category") == category)
    metas = [r.asDict() for r in own.collect()]  # the catalogue: a row a source
    detected = detected_licenses(spark, root, [m["source_id"] for m in metas])
    gate = collectible_sources(own, detected, [m["source_id"] for m in metas if m["allow_no_license"]])
    allowed = {r.source_id for r in gate.kept.select("source_id").collect()}
    candidates, failed = adapted(spark, root, [m for m in metas if m["source_id"] in allowed], f"{store}/{category}" if store else None)
    events = gate.events.unionByName(spark.createDataFrame(failed, EVENT))
    if candidates is None:
        empty = spark.createDataFrame([], RECORD + ", family string, kind string, rel_path string")
        return Built(empty, events), stats.category_report(category, empty, spark.createDataFrame([], "source_id string, family string, kept long, tokens long, token_budget long, over_quota long"), events, spark.createDataFrame([], "kind string, n long"))
    count, is_exact = exact.counter(tokenizer)
    options = {} if threshold is None else {"threshold": threshold}
    built = build_category(candidates, rules, own.select("source_id", "token_budget", "pool"), scale=scale, tokens=count, **options)
    extra = {k: F.col(k) for k in ("family", "kind", "rel_path")} | {"repo_commit": F.col("repo_commit"), "repo_url": F.col("url")}
    extra |= {k: F.col("flags")[k].cast("int") for k in ("part", "n_parts")} | {"arxiv_id": F.col("flags")["arxiv_id"]}
    extra |= {"scrubbed": F.when(F.size("redacted") > 0, F.array_join(F.transform(F.array_sort(F.map_entries("redacted")), lambda e: F.concat(e["key"], F.lit(" x"), e["value"].cast("string"))), ", ")), "ord": F.col("ord")}
    made = shared_table(records.validated(records.assemble(_drafts(built.kept, gate.kept), category, collected_at, TIERS.get(category, "D"), F.col("n_tokens"), extra, is_exact)), f"records-{category}")
    events = shared_table(events.unionByName(built.events), f"events-{category}")
    over = events.where("reason = 'over quota'").select(F.col("item").alias("doc_id")).join(candidates.select("doc_id", "source_id"), "doc_id").groupBy("source_id").agg(F.count("*").alias("over_quota"))
    sums = made.groupBy(F.col("source").alias("source_id")).agg(F.count("*").alias("kept"), F.sum("n_tokens").alias("tokens"))
    zero = F.lit(0).cast("long")
    table = own.select("source_id", "family", "token_budget").join(sums, "source_id", "left").join(over, "source_id", "left").na.fill(0, ["kept", "tokens", "over_quota"]).withColumn("token_budget", F.coalesce("token_budget", zero))
    masked = stats.masked_by_kind(built.kept)
    report = stats.category_report(f"Category {category}", made, table, events, masked, {"Tier": TIERS.get(category, "D"), "Contamination check": contamination.rules_described(rules)})
    return Built(made, events), report


def build_robots(spark: SparkSession, robots: DataFrame, manual_rows: DataFrame, rules: list[dict], collected_at: str, extract: Callable | None = None, recognise: Callable | None = None, writer: str | None = None, category: str = "cat3", tokenizer: str | None = None, cache: str | None = None) -> tuple[Built, str]:
    """The category of robots and manuals.

    robots: robot_id, raw (URDF text), license_declared, url.  manual_rows: robot_id, name, content, license_declared,
    allow_no_license, url.  extract as in manuals.manual_documents, by default the PDF connector.  writer names a plugged-in
    writer of robots' descriptions and manuals.  cache is a folder that keeps what was recognised.
    """
    from ..sources.connectors import pdf_pages

    status = licenses.classify(F.col("license_declared"))
    models = shared_table(robots.withColumn("license_status", status).withColumn("p", urdf.parsed(F.col("raw"))), "robots")
    may = licenses.collectible(F.col("license_status"), F.lit(False))
    broken = event(models.where(may & F.col("p.error").isNotNull()), "unreadable robot", "robot_id", "fail", F.col("p.error"))
    gated = event(models.where(~may), F.col("license_status"), "robot_id")
    readable = models.where(may & F.col("p.error").isNull()).withColumn("model", F.col("p.model"))
    repaired = event(readable.select("robot_id", F.explode("model.notes").alias("note")), "repaired robot", "robot_id", "warn", F.col("note"))
    described = urdf.robot_document(readable, writer=writer)
    none = F.lit(None).cast("double")
    one = described.select(F.col("robot_id").alias("doc_id"), F.lit("urdf").alias("source_type"), F.concat(F.lit("urdf:"), "robot_id").alias("source_name"), "license_status", "url", "text", F.lit(False).alias("ocr"), none.alias("ocr_confidence"), F.lit(0).alias("__place"))
    books = manual_rows.withColumn("license_status", status)
    may_read = licenses.collectible(F.col("license_status"), F.coalesce("allow_no_license", F.lit(False)))
    gated_books = event(books.where(~may_read), F.col("license_status"), "name")
    if recognise is not None and cache is not None:
        recognise = manuals.remembered(recognise, cache)
    read = shared_table(manuals.manual_documents(books.where(may_read), extract or pdf_pages, recognise, writer), "manuals")
    unread = event(read.where("error is not null"), "unusable manual", "name", "fail", F.col("error"))
    two = read.where("error is null").select(F.col("robot_id").alias("doc_id"), F.lit("pdf_manual").alias("source_type"), F.concat(F.lit("manual:"), "robot_id").alias("source_name"), "license_status", "url", "text", "ocr", "ocr_confidence", F.lit(1).alias("__place"))
    checked = shared_table(contamination.check(one.unionByName(two), rules), "checked")
    dirty = event(checked.where("match is not null"), "contaminated", message=contamination.described(F.col("match")))
    ordered = checked.where("match is null").drop("match").repartitionByRange("__place", "doc_id").sortWithinPartitions("__place", "doc_id").withColumn("ord", F.monotonically_increasing_id())
    count, is_exact = exact.counter(tokenizer)
    made = shared_table(records.validated(records.assemble(ordered, category, collected_at, TIERS.get(category, "D"), count(F.col("text")), {"ord": F.col("ord")}, is_exact)), f"records-{category}")
    events = broken
    for more in (repaired, gated, gated_books, unread, dirty):
        events = events.unionByName(more)
    events = shared_table(events, f"events-{category}")
    return Built(made, events), stats.extraction_report(f"Category {category}", made, events, {"Contamination check": contamination.rules_described(rules)})


def merge_categories(spark: SparkSession, categories: dict[str, DataFrame | None], rules: list[dict], shuffle: bool = False) -> Built:
    """The merge; a category that is missing is a warning and left out."""
    missing = spark.createDataFrame([("warn", k, "missing category", None) for k, v in categories.items() if v is None], EVENT)
    there = {k: v.drop("ord") if "ord" not in v.columns else v.orderBy("ord").drop("ord") for k, v in categories.items() if v is not None}
    if not there:
        return Built(spark.createDataFrame([], RECORD), missing, False)
    merged = merge(there, rules, shuffle=shuffle)
    return Built(merged.kept, merged.events.unionByName(missing), merged.passed)


def rebuild(spark: SparkSession, root: str, catalogue: DataFrame, rules: list[dict], collected_at: str, out: str | None = None, robots: DataFrame | None = None, manual_rows: DataFrame | None = None, tokenizer: str | None = None, store: str | None = None, **options) -> Run:
    """Everything from raw files to the corpus; with `out`, corpora are written as JSON lines and reports as texts below it.

    root holds a folder a source of the catalogue (see CATALOGUE).  The robots' category is built first.  options go to
    build_robots (extract, recognise, writer, cache).  store is a folder that keeps candidates from run to run.  The run passes if the mix is in its bands and the audit finds nothing.
    """
    began, run = time.time(), Run()
    names = [c for c, *_ in records.TARGET_MIX]
    wanted = {r.category for r in catalogue.select("category").distinct().collect()}
    made: dict[str, Built] = {}
    if robots is not None or manual_rows is not None:
        robots = robots if robots is not None else spark.createDataFrame([], "robot_id string, raw string, license_declared string, url string")
        manual_rows = manual_rows if manual_rows is not None else spark.createDataFrame([], "robot_id string, name string, content binary, license_declared string, allow_no_license boolean, url string")
        made["cat3"], run.reports["cat3"] = build_robots(spark, robots, manual_rows, rules, collected_at, tokenizer=tokenizer, **options)
    for category in sorted(wanted - set(made)):
        made[category], run.reports[category] = build_sources(spark, root, category, catalogue, rules, collected_at, tokenizer, store=store)
    run.categories = {k: v.kept for k, v in made.items()}
    merged = merge_categories(spark, {k: run.categories.get(k) for k in names}, rules)
    run.corpus = shared_table(merged.kept, "corpus")
    events = merged.events
    for built in made.values():
        events = events.unionByName(built.events)
    run.events = shared_table(events, "events")
    run.audit = contamination.audited({**{k: run.categories.get(k) for k in names}, "full": run.corpus}, rules)
    run.passed = merged.passed and run.audit.passed
    run.reports["full"] = stats.merged_report("Full corpus", run.corpus, merged.events, {"Contamination check": contamination.rules_described(rules)})
    run.reports["run"] = stats.run_report("rebuild", run.events, time.time() - began, collected_at, {"Audit": "passed" if run.audit.passed else "FAILED"})
    if out:
        for name, rows in [*run.categories.items(), ("full", run.corpus)]:
            order = ["ord"] if "ord" in rows.columns else None
            files.write_json_lines(rows, f"{out}/{name}/corpus", order)
        write_reports(spark, run.reports, out)
    drop_tables(merged.kept)
    return run


def write_reports(spark: SparkSession, reports: dict[str, str], out: str) -> None:
    """One text file a report, in any store that Spark writes to."""
    for name, text in reports.items():
        spark.createDataFrame([(text.rstrip("\n"),)], "value string").coalesce(1).write.mode("overwrite").text(f"{out}/reports/{name}")
