"""A lasting index of kept documents, so that a corpus can be deduplicated batch by batch.

Three bucketed Parquet tables below one folder hold what earlier batches kept: copies (hash, ord), bands (key, ord) and
signatures (ord, signature).  A new batch is signed once, dealt to the buckets and met there, so neither is the old side
shuffled nor a text of it read again.  The verdicts of all batches are those of one run over all of them.

A batch is a partition of each table, and counts only once it is listed in the folder `batches`, which is written last: a
batch that was broken off leaves the index as it was, and is overwritten when it is added again.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..staging import drop_tables, shared_table
from . import dedup

#: Columns of each table, the one that it is bucketed by first.
TABLES = {"copies": "hash string, ord bigint", "bands": "key bigint, ord bigint", "signatures": "ord bigint, signature array<bigint>"}
BATCHES = "batch string, last_ord bigint"
BUCKETS = 64
#: Tasks for each core that sign a batch.
TASKS_PER_CORE = 4


class DuplicateIndex:
    """The index in a folder, which all executors must reach; made if it isn't there.

    buckets is fixed when the index is made: about the size of the final index over what one task should read.
    """

    def __init__(self, spark: SparkSession, path: str, threshold: float = dedup.THRESHOLD, bands: int = dedup.BANDS, n: int = dedup.PERMUTATIONS, buckets: int = BUCKETS):
        dedup._checked(n, bands)
        self.spark, self.path, self.threshold, self.bands, self.n, self.buckets = spark, path.rstrip("/"), threshold, bands, n, buckets
        self.names = {x: f"dup_{x}_{zlib.crc32(self.path.encode()):08x}" for x in TABLES}
        for table, columns in TABLES.items():
            key = columns.split()[0]
            self._folder(table, make=True)
            spark.sql(f"create table if not exists {self.names[table]} ({columns}, batch string) using parquet partitioned by (batch) clustered by ({key}) sorted by ({key}) into {buckets} buckets location '{self.path}/{table}'")
            spark.sql(f"alter table {self.names[table]} recover partitions")

    def _folder(self, name: str, make: bool = False) -> bool:
        """Whether a folder of the index is there."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return files.mkdirs(folder) if make else files.exists(folder)

    def batches(self) -> DataFrame:
        """batch and last_ord of the batches that count."""
        there = self._folder("batches")
        return self.spark.read.schema(BATCHES).parquet(f"{self.path}/batches") if there else self.spark.createDataFrame([], BATCHES)

    def _old(self, done: list[str]) -> dict[str, DataFrame]:
        return {x: self.spark.table(name).where(F.col("batch").isin(done)) for x, name in self.names.items()}

    def add(self, docs: DataFrame, batch: str, order: str = "ord", text: str = "text") -> DataFrame:
        """Verdicts (as of dedup.greedy_duplicates) of a batch, whose documents come after all those of earlier ones, and
        what it keeps goes into the index.  An empty batch changes nothing but counts."""
        done = {r.batch: r.last_ord for r in self.batches().collect()}  # a row a batch
        if batch in done:
            raise ValueError(f"batch {batch} is in the index already")
        # a batch is often a range of a table, which few of the scan's tasks have: it is dealt out, as signing costs the most
        tasks = TASKS_PER_CORE * self.spark.sparkContext.defaultParallelism
        rows = dedup._signed(docs.select(order, text).repartition(tasks, order), order, text, self.n)
        ends = rows.agg(F.min("ord"), F.max("ord")).first()
        last = max((x for x in done.values() if x is not None), default=None)
        if last is not None and ends[0] is not None and ends[0] <= last:
            raise ValueError(f"order {ends[0]} of batch {batch} is not after {last}, the last one in the index")
        old = self._old(list(done)) if done else None
        found, kept = dedup._verdicts(rows, self.threshold, self.bands, old)
        found, kept = shared_table(found, "verdicts"), shared_table(kept, "kept-entries")
        parts = {"copies": kept.select("hash", "ord"), "bands": dedup._banded(kept, self.bands), "signatures": kept.select("ord", "signature")}
        for table, part in parts.items():
            key = part.columns[0]
            # one file a bucket: dealt by the bucketing's own hash
            name = self.names[table]
            self.spark.sql(f"alter table {name} drop if exists partition (batch = '{batch}')")
            dealt = part.repartition(self.buckets, key).sortWithinPartitions(key)
            dealt.withColumn("batch", F.lit(batch)).write.mode("append").format("parquet").partitionBy("batch").bucketBy(self.buckets, key).sortBy(key).saveAsTable(name)
        self.spark.createDataFrame([(batch, ends[1])], BATCHES).coalesce(1).write.mode("append").parquet(f"{self.path}/batches")
        drop_tables(kept)
        return dedup._with_kinds(docs, order, rows, found)
