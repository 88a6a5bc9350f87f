"""Removal of globally repeated passages of lines, with content-defined borders.

Compared over the corpus are chunks and windows.  Chunks: each line is hashed; a rolling hash over WINDOW line hashes says
where chunks end, so an insertion moves borders near it only.  A line ends a chunk if its rolling hash is 0 modulo DIVISOR
and that of the line before is not; so chunks have two lines at least, but for the last.  Those of two or more lines and
MIN_BYTES bytes are compared.  Windows: from each line, the fewest lines forwards and the fewest backwards that have more
than MIN_WORDS words (as str.split counts).  A window's borders depend on its own lines only, and the windows inside any
run of lines of more than MIN_WORDS words cover the whole run; so no such run that an earlier document has stays.  Of equal
chunks or windows the first by (doc_id, first line) stays, and the others go once their bytes have been compared with its
bytes.  So each line that goes has an equal one that stays, in an earlier document or further up.

Steps: hashes are counted; the repeated ones become a bitmap of fixed size, by which a second pass sends the hashes of
repeated chunks and windows only; these meet the first of their hash in a join that Spark can split where one is in very
many documents.  The fewest of them that cover a document's repeated lines are picked; the bytes of the first of each are
fetched from its document, once, and go to the documents that repeat them, to be compared there.  Of the other documents
most are left out of that by a second bitmap, of doc_ids.

Edge cases: null and empty texts stay as they are.  Documents with a null doc_id are left alone and not compared.  Rows
that repeat a doc_id share the list of lines to remove, and an entry counts for a row only if its lines have those bytes
there; so equal rows that share a doc_id are not compared with each other.  Chunks with equal hashes and other bytes than
the first stay.  Input columns named __gone, __doc_id, __lines, __gone_lines or __gone_chunks are replaced.  Texts of any
length are read whole.  Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bitmap, bound_batches, drop_tables, in_bitmap, shared_table, spread

WINDOW, DIVISOR, MIN_BYTES, MIN_WORDS = 2, 2, 48, 50
BASE = 0x9E3779B97F4A7C15
BITMAP_BITS = 1 << 25


def chunks(lines: list[bytes]) -> list[tuple[int, int]]:
    """(first, end) lines of the chunks of a document."""
    import numpy as np
    import xxhash

    n = len(lines)
    if n < 2:
        return [(0, n)]
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, lines), dtype=np.uint64, count=n)
    rolling = np.zeros(n, dtype=np.uint64)
    factor = 1
    for back in range(WINDOW):
        rolling[back:] += hashes[: n - back] * np.uint64(factor)
        factor = factor * BASE % (1 << 64)
    # The top bits of a product mix all bits of the window.
    ends = ((rolling * np.uint64(BASE)) >> np.uint64(40)) % np.uint64(DIVISOR) == 0
    ends[1:] &= ~ends[:-1]
    ends[0] = False
    borders = [0, *(np.flatnonzero(ends[:-1]) + 1).tolist(), n]
    return list(zip(borders, borders[1:], strict=False))


def units(text: str):
    """(first, end, int64 hash) arrays of the chunks and windows of a text that are compared, by (first, end)."""
    import numpy as np
    import xxhash

    rows = text.split("\n")
    lines, n = [x.encode() for x in rows], len(rows)
    words, size = np.zeros(n + 1, dtype=np.int64), np.zeros(n + 1, dtype=np.int64)
    np.cumsum([len(x.split()) for x in rows], out=words[1:])
    np.cumsum([len(x) + 1 for x in lines], out=size[1:])
    every = np.arange(n + 1)
    ends = np.searchsorted(words, words[:-1] + MIN_WORDS + 1, side="left")
    starts = np.searchsorted(words, words[1:] - MIN_WORDS - 1, side="right") - 1
    own = np.array(chunks(lines), dtype=np.int64)
    own = own[(own[:, 1] - own[:, 0] > 1) & (size[own[:, 1]] - size[own[:, 0]] - 1 >= MIN_BYTES)]
    first = np.concatenate([every[:-1][ends <= n], starts[starts >= 0], own[:, 0]])
    end = np.concatenate([ends[ends <= n], every[1:][starts >= 0], own[:, 1]])
    first, end = np.divmod(np.unique(first * (n + 1) + end), n + 1)
    # Sums of hash * BASE**line, brought to the same power by the inverse of BASE: hashes of all ranges of lines.
    sums, back = np.zeros(n + 1, dtype=np.uint64), np.ones(n + 1, dtype=np.uint64)
    power = np.ones(n, dtype=np.uint64)
    power[1:] = BASE
    np.cumsum(np.fromiter(map(xxhash.xxh3_64_intdigest, lines), dtype=np.uint64, count=n) * np.cumprod(power), out=sums[1:])
    back[1:] = pow(BASE, -1, 1 << 64)
    return first, end, ((sums[end] - sums[first]) * np.cumprod(back)[first]).view(np.int64)


def compared(text: str) -> list[tuple[int, int, int, bytes]]:
    """(place, first, end, bytes) of the chunks and windows of a text that are compared."""
    lines = text.encode().split(b"\n")
    first, end, _ = units(text)
    return [(n, a, b, b"\n".join(lines[a:b])) for n, (a, b) in enumerate(zip(first.tolist(), end.tolist(), strict=True))]


def cover(ranges: list[tuple]) -> list[tuple]:
    """The fewest of the (first, end, ...) ranges that cover all their lines."""
    out, at, best = [], -1, None
    for x in sorted(ranges, key=lambda x: x[:2]):
        if best and x[0] > at:
            out.append(best)
            at, best = best[1], None
        if x[0] > at or x[1] > at:
            if x[0] > at:
                at = x[0]
            if best is None or x[1] > best[1]:
                best = x
    return out + [best] if best else out


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """doc_id, __gone: array of (a, b, chunk): lines to remove and the bytes that they must have, for documents that have any."""
    import numpy as np
    import pyarrow as pa

    named = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def hashes(batches):
        for batch in batches:
            found = [units(text)[2] for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found) if found else [], pa.int64())], ["hash"])

    counted = named.mapInArrow(hashes, "hash long").groupBy("hash").count().where(F.col("count") > 1)
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(counted, "hash", BITMAP_BITS))  # of fixed size

    def candidates(batches):
        for batch in batches:
            rows = []
            for i, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                a, b, found = units(text)
                keep = np.flatnonzero(in_bitmap(bits.value, found))
                if len(keep):
                    rows.append((found[keep], np.full(len(keep), i), a[keep], b[keep]))
            columns = [np.concatenate(c) for c in zip(*rows, strict=True)] or [[]] * 4
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["hash", "doc_id", "a", "b"])

    def covers(batches):
        for batch in batches:
            rows = [(i, *x) for i, found in zip(*(c.to_pylist() for c in batch.columns), strict=True) for x in cover([tuple(y.values()) for y in found])]
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "a", "b", "hash", "first_doc", "first_a"])

    def fetched(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 250):
                rows = []
                for text, wanted in zip(*(c.to_pylist() for c in batch.slice(i, 250).columns), strict=True):
                    lines = text.encode().split(b"\n")
                    rows += [(x["hash"], b"\n".join(lines[x["a"] : x["b"]])) for x in wanted if x["b"] <= len(lines)]
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], pa.int64()), pa.array([x[1] for x in rows], pa.binary())], ["hash", "chunk"])

    found = shared_table(named.mapInArrow(candidates, "hash long, doc_id long, a int, b int"), "line-chunks")
    bits.destroy()
    first = found.groupBy("hash").agg(F.min(F.struct("doc_id", "a")).alias("first"), F.count("*").alias("n")).where("n > 1")
    first = shared_table(first.select("hash", F.col("first.doc_id").alias("first_doc"), F.col("first.a").alias("first_a")), "first-chunks")
    again = found.join(first, "hash").where("not (doc_id = first_doc and a = first_a)")
    listed = again.groupBy("doc_id").agg(F.collect_list(F.struct("a", "b", "hash", "first_doc", "first_a")).alias("found"))
    gone = shared_table(listed.mapInArrow(covers, "doc_id long, a int, b int, hash long, first_doc long, first_a int"), "gone-chunks")
    wanted = gone.select("first_doc", "hash", F.col("first_a").alias("a"), F.expr("first_a + b - a").alias("b")).distinct()
    wanted = shared_table(wanted.groupBy("first_doc").agg(F.collect_list(F.struct("hash", "a", "b")).alias("wanted")), "wanted-chunks")
    held = docs.sparkSession.sparkContext.broadcast(bitmap(wanted, "first_doc", BITMAP_BITS))

    def holders(batches):
        for batch in batches:
            yield batch.filter(pa.array(in_bitmap(held.value, batch.column(0).to_numpy())))

    holding = named.mapInArrow(holders, "doc_id long, text string").join(wanted.hint("merge"), F.col("doc_id") == F.col("first_doc"))
    bytes_of = holding.select("text", "wanted").mapInArrow(fetched, "hash long, chunk binary")
    bytes_of = shared_table(bytes_of.groupBy("hash").agg(F.min("chunk").alias("chunk")), "chunk-bytes")
    held.destroy()
    drop_tables(found, first, wanted)
    return gone.join(bytes_of, "hash").groupBy("doc_id").agg(F.collect_list(F.struct("a", "b", "chunk")).alias("__gone"))


def line_dedup(docs: DataFrame) -> DataFrame:
    """docs with repeated chunks taken out of text, and __lines, __gone_lines, __gone_chunks (long)."""
    import pyarrow as pa

    bound_batches(docs.sparkSession)
    docs = docs.drop("__gone", "__doc_id", "__lines", "__gone_lines", "__gone_chunks")
    names = docs.columns
    joined = docs.join(repeated_chunks(docs).withColumnRenamed("doc_id", "__doc_id"), F.col("doc_id") == F.col("__doc_id"), "left").drop("__doc_id")
    at = names.index("text")

    def cut(text, gone):
        if text is None:
            return None, 0, 0, 0
        lines = text.split("\n")
        taken = sorted((x["a"], x["b"]) for x in gone or () if x["b"] <= len(lines) and "\n".join(lines[x["a"] : x["b"]]).encode() == x["chunk"])
        if not taken:
            return text, len(lines), 0, 0
        kept, end = [], 0
        for a, b in taken:
            kept += lines[end:a]
            end = max(end, b)
        kept += lines[end:]
        return "\n".join(kept), len(lines), len(lines) - len(kept), len(taken)

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 250):
                part = batch.slice(i, 250)
                rows = [cut(t, g) for t, g in zip(part.column(at).to_pylist(), part.column(len(names)).to_pylist(), strict=True)]
                columns = list(zip(*rows, strict=True))
                arrays = part.columns[: len(names)]
                arrays[at] = pa.array(columns[0], pa.string())
                yield pa.RecordBatch.from_arrays([*arrays, *(pa.array(c, pa.int64()) for c in columns[1:])], [*names, "__lines", "__gone_lines", "__gone_chunks"])

    fields = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in docs.schema)
    return joined.select(*names, "__gone").mapInArrow(run, f"{fields}, __lines long, __gone_lines long, __gone_chunks long")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: all documents without their repeated chunks."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "text")
    out = line_dedup(docs)
    return out.select("doc_id", "text", F.col("__lines").alias("n_lines"), F.col("__gone_lines").alias("n_removed_lines"), F.col("__gone_chunks").alias("n_removed_chunks"))
