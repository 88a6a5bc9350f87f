"""Session defaults, and tables written to the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Rows of one Arrow batch that goes to a Python worker.  Texts may be long, so it is far below Spark's 10,000.
BATCH_ROWS = 1000


def bound_batches(spark: SparkSession) -> None:
    """Lower Spark's default Arrow batch; a value that the session has set itself stays."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def session(name: str = "corpusloom", **settings: str) -> SparkSession:
    """A session with the settings that results depend on (UTC) and those that large inputs need."""
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


#: The most bytes, by Spark's estimate, of a scan that spread() deals out anew.
SPREAD_BYTES = 256 << 20


def spread(table: DataFrame) -> DataFrame:
    """A small scan that gives fewer partitions than the session has cores, dealt out to all of them.  Scans of over
    SPREAD_BYTES are left as they are, however many cores there are, so no large table is shuffled."""
    cores = table.sparkSession.sparkContext.defaultParallelism
    size = int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return table.repartition(cores) if size <= SPREAD_BYTES and table.rdd.getNumPartitions() < cores else table


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which all executors share.  Where none is set, a session with a local master
    (tests) gets a temporary one; on a cluster that is an error, for executors would not see each other's files."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir is not set: it must name a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="corpusloom-"))
        named = context.getCheckpointDir()
    return named.rstrip("/")


def _folder(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; Hadoop deletes it when the driver's JVM ends, if nothing did before."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    files, folder = _folder(spark, path)
    files.deleteOnExit(folder)
    return path


def shared_table(df: DataFrame, label: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: lineage is cut, and a lost executor costs nothing."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    return table


def drop_tables(*tables: DataFrame | None) -> None:
    """Delete tables of shared_table that nothing will read again; nulls and other DataFrames are left alone."""
    for table in tables:
        path = vars(table).get("scratch_path") if table is not None else None
        if path:
            files, folder = _folder(table.sparkSession, path)
            files.delete(folder, True)
            files.cancelDeleteOnExit(folder)
