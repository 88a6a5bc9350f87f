"""Token-ID output: ORC shards of document ids and token ids, in ascending document order.

File format.  A folder of ORC files, one shard each; the number in a file's name is the shard's place.  Columns:
doc_id (as given), shard_start (long: ids of the shard before this document), n_tokens (long), ids (array<int>: the
token ids, unsigned 32-bit values in two's complement).  ORC writes all integers by run-length encoding; each stripe
carries a row index every INDEX_STRIDE rows and a Bloom filter on doc_id, so readers take stripes in parallel and skip
those without the ids that they look for.

Edge cases: a null text is an empty one; its only id is the end id.  A null doc_id sorts first.  Rows that repeat a
doc_id all stay, in the order of the input.  Empty tables give no rows.  Further columns of the input are ignored.  A
special token written out in a text is that token, as in the library's plain call.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bound_batches, scratch_path, shared_table

INDEX_STRIDE = 1000
STRIPE_BYTES = 16 << 20
#: Shards whose places are broadcast: some tens of MB.
MOST_BROADCAST = 500_000
#: Documents of one output batch: their ids are in memory at once.
BATCH_DOCS = 500


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int | None = None) -> DataFrame:
    """doc_id, n_tokens, ids of each document, ordered by doc_id within and across partitions."""
    import pyarrow as pa

    bound_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType
    ordered = (
        docs.select("doc_id", "text", F.monotonically_increasing_id().alias("__row"))
        .repartitionByRange("doc_id", "__row")
        .sortWithinPartitions("doc_id", "__row")
        .select("doc_id", "text")
    )
    end = b"" if end_id is None else int(end_id).to_bytes(4, "little")

    def encode(batches):
        from .tokens import encoder

        own, before = encoder(tokenizer), 0
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_DOCS):
                part = batch.slice(at, BATCH_DOCS)
                found = [x + end for x in own.encode(part.column(1))]
                sizes = [len(x) // 4 for x in found]
                starts, ends = [], [0]
                for n in sizes:
                    starts.append(before)
                    before += n
                    ends.append(ends[-1] + n)
                flat = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(b"".join(found))])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), lists], ["doc_id", "shard_start", "n_tokens", "ids"])

    return ordered.mapInArrow(encode, f"doc_id {kind.simpleString()}, shard_start long, n_tokens long, ids array<int>")


def write_token_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = None) -> None:
    """Encode whole texts and write the shards to path."""
    (
        encode_documents(docs, tokenizer, end_id)
        .write.option("maxRecordsPerFile", 0)  # a partition is one file: shard_start counts from its first row
        .option("orc.compress", "ZSTD")
        .option("orc.stripe.size", STRIPE_BYTES)
        .option("orc.row.index.stride", INDEX_STRIDE)
        .option("orc.create.index", "true")
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .orc(path)
    )


def read_token_shards(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids.

    A shard's place in the whole comes from the two small columns of all shards alone: one row a shard is added up.
    Filters on doc_id reach the files.
    """
    files = spark.read.orc(path).withColumn("__shard", F.col("_metadata.file_name"))
    number = F.regexp_extract("__shard", r"part-(\d+)", 1).cast("long")
    totals = files.groupBy("__shard").agg(F.sum("n_tokens").alias("__n"))
    before = Window.orderBy(number, "__shard").rowsBetween(Window.unboundedPreceding, -1)
    places = totals.select("__shard", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    # A row a shard: broadcast, as long as that is small, or else the ids would be shuffled.
    places = shared_table(places, "shard-places")
    if places.count() <= MOST_BROADCAST:
        places = F.broadcast(places)
    return files.join(places, "__shard").select("doc_id", (F.col("__before") + F.col("shard_start")).alias("start"), "n_tokens", "ids")


def shard_digest(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of what read_token_shards gives, counted from the ids themselves."""
    import pyarrow as pa

    kind = shards.schema["doc_id"].dataType

    def digest(batches):
        for batch in batches:
            ids = batch.column(2)
            ends = ids.offsets.to_pylist()
            raw = memoryview(ids.values.cast(pa.int32()).to_numpy(zero_copy_only=False).astype("<i4", copy=False)).cast("B")
            sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends, ends[1:], strict=False)]
            sizes = [b - a for a, b in zip(ends, ends[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return shards.select("doc_id", "start", "ids").mapInArrow(digest, f"doc_id {kind.simpleString()}, start long, n_tokens long, ids_crc32 long")


def op1_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: the shards of all documents, written and read back."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = scratch_path(spark, "token-shards")
    write_token_shards(docs, path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return shard_digest(read_token_shards(spark, path))
