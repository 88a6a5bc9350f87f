"""Candidates that outlive a run: only sources whose files changed are read again.

A store folder has candidates in versions (a folder a run) and manifests (a small table a run) that say, for each source,
what its files were like and which version has its candidates.  A run lists the files (paths, sizes, times: contents are not
read), compares each source with the last manifest by a full outer join, adapts what is new or changed into a version of its
own, and writes the next manifest last, under another name that becomes its own by one rename.  So a run that is broken off
leaves the last manifest, and all that it names, as they were; the next one only does that work again.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import adapters
from ..sources import files
from ..staging import shared_table

MANIFEST = "source_id string, digest string, run string"
NEW, CHANGED, SAME, GONE = "new", "changed", "same", "gone"


@dataclass
class Resumed:
    """candidates of all sources that are there now; state of each source (source_id, state: new, changed, same or gone)."""

    candidates: DataFrame
    states: DataFrame


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _last(spark: SparkSession, store: str) -> int:
    """The number of the last manifest that was finished; 0 if there is none."""
    return max((int(x) for x in files.folders(spark, f"{store}/manifests") if x.isdigit()), default=0)


def manifest(spark: SparkSession, store: str) -> DataFrame:
    """source_id, digest, run of the last finished run."""
    n = _last(spark, store)
    return spark.read.schema(MANIFEST).parquet(f"{store}/manifests/{n}") if n else spark.createDataFrame([], MANIFEST)


def stored(spark: SparkSession, store: str) -> DataFrame | None:
    """The candidates that the last manifest names; None before the first run."""
    live = manifest(spark, store).select("source_id", "run")
    runs = [r.run for r in live.select("run").distinct().collect()]  # versions that are in use
    if not runs:
        return None
    every = spark.read.parquet(f"{store}/candidates").where(F.col("run").isin(runs))
    return every.join(live, ["source_id", "run"], "left_semi").drop("run")


def resumed(spark: SparkSession, root: str, sources: list[dict], store: str) -> Resumed:
    """The candidates of the sources (dicts of adapters.META), of which those with the same files and description as in the
    last run come from the store.  Sources without a folder, or of an unknown kind, are gone."""
    there = files.folders(spark, root)
    read = [m for m in sources if m["source_id"] in there and m["kind"] in adapters.KINDS]
    meta = ", ".join(f"{k} string" for k in adapters.META)
    described = spark.createDataFrame([tuple(m[k] for k in adapters.META) for m in read], meta)
    own = F.sha2(F.to_json(F.struct(*adapters.META)), 256).alias("own")
    if read:
        now = files.listing(spark, root, [m["source_id"] for m in read], adapters.ENDINGS)
    else:
        now = spark.createDataFrame([], "source_id string, digest string")
    now = described.select("source_id", own).join(now, "source_id", "left").select("source_id", F.concat_ws("-", "own", "digest").alias("now"))
    both = manifest(spark, store).join(now, "source_id", "full")
    state = F.when(F.col("now").isNull(), GONE).when(F.col("digest").isNull(), NEW).when(F.col("digest") == F.col("now"), SAME).otherwise(CHANGED)
    states = shared_table(both.select("source_id", "now", "run", state.alias("state")), "source-states")
    todo = {r.source_id for r in states.where(F.col("state").isin(NEW, CHANGED)).collect()}  # rows of the catalogue
    run = f"{_last(spark, store) + 1}-{uuid.uuid4().hex[:8]}"
    if todo:
        rows = described.where(F.col("source_id").isin(sorted(todo))).withColumn(adapters.PLACE, F.lit(0))
        raw = files.scan_sources(spark, root, sorted(todo), adapters.ENDINGS).join(F.broadcast(rows), "source_id")
        adapters.adapt_all(shared_table(raw, "raw-files")).drop(adapters.PLACE).withColumn("run", F.lit(run)).write.mode("append").partitionBy("run").parquet(f"{store}/candidates")
    if todo or not states.where(F.col("state") == GONE).isEmpty():
        kept = states.where(F.col("state") != GONE).select("source_id", F.col("now").alias("digest"), F.when(F.col("state") == SAME, F.col("run")).otherwise(run).alias("run"))
        unfinished = f"{store}/manifests/unfinished-{run}"
        kept.coalesce(1).write.parquet(unfinished)
        store_files, folder = _folder(spark, unfinished)
        if not store_files.rename(folder, _folder(spark, f"{store}/manifests/{run.split('-')[0]}")[1]):
            raise OSError(f"the manifest of run {run} could not be put in place")
    candidates = stored(spark, store)
    if candidates is None:
        candidates = spark.createDataFrame([], "doc_id string, source_id string, family string, kind string, rel_path string, grp string, text string, flags map<string,string>, path_parts array<string>, part_no int")
    return Resumed(candidates, states.select("source_id", "state"))


def drop_unused(spark: SparkSession, store: str) -> list[str]:
    """Deletes the versions that the last manifest does not name, and what broken runs left; returns their names."""
    used = {r.run for r in manifest(spark, store).select("run").distinct().collect()}
    old = sorted(x for x in files.folders(spark, f"{store}/candidates") if x.startswith("run=") and x[4:] not in used)
    for path in [*(f"candidates/{x}" for x in old), *(f"manifests/{x}" for x in files.folders(spark, f"{store}/manifests") if not x.isdigit())]:
        store_files, folder = _folder(spark, f"{store}/{path}")
        store_files.delete(folder, True)
    return [x[4:] for x in old]
