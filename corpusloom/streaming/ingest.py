"""Candidates as they arrive: each micro-batch is cleaned and appended; content seen before, within a day, is left out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import collapsed, content_hash, looks_generated, token_estimate


def fresh_documents(stream: DataFrame, arrived: str = "arrived", window: str = "1 day") -> DataFrame:
    """stream (text and a timestamp) without generated texts and exact repetitions, with hash and n_tokens.  State is
    bounded by the window."""
    clean = stream.withColumn("text", collapsed(F.col("text"))).where(~looks_generated(F.col("text")))
    counted = clean.withColumn("hash", content_hash(F.col("text"))).withColumn("n_tokens", token_estimate(F.col("text")))
    return counted.withWatermark(arrived, window).dropDuplicatesWithinWatermark(["hash"])


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends to Parquet, exactly once, until all that is there has been read."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
