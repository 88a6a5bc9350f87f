"""What the operators of this subpackage share: batch sizes and bitmaps, and the tables in the shared folder."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import bound_batches, drop_tables, scratch_path, shared_table, spread

__all__ = ["apart", "bitmap", "bound_batches", "drop_tables", "in_bitmap", "scratch_path", "shared_table", "spread"]

def apart(docs: DataFrame, *own: str):
    """(docs with all columns but `own` under names that no operator uses, a function that gives a result their names back)."""
    names = docs.columns
    safe = [x if x in own else f"extra_{i}" for i, x in enumerate(names)]
    return docs.toDF(*safe), lambda out: out.select(*(F.col(f"`{x}`") for x in safe)).toDF(*names)


#: Bytes of a bitmap that travel in one row.
BITMAP_SLICE = 1 << 16


def bitmap(hashes: DataFrame, column: str, bits: int) -> bytes:
    """A bitmap of `bits` bits (a power of two) with bit (hash mod bits) set for each non-null hash of a long column.

    It has no false negatives.  Executors set the bits of slices of it, so the driver gets a row a slice, whatever the
    number of hashes.
    """
    import numpy as np
    import pyarrow as pa

    def merge(batches):
        slices: dict[int, object] = {}
        for batch in batches:
            at = batch.column(0).to_numpy().astype(np.uint64) & np.uint64(bits - 1)
            number = (at // np.uint64(8 * BITMAP_SLICE)).astype(np.int64)
            for i in np.unique(number).tolist():
                own = slices.setdefault(i, np.zeros(BITMAP_SLICE, dtype=np.uint8))
                inside = at[number == i] % np.uint64(8 * BITMAP_SLICE)
                np.bitwise_or.at(own, (inside >> np.uint64(3)).astype(np.int64), np.left_shift(np.uint8(1), (inside & np.uint64(7)).astype(np.uint8)))
        yield pa.RecordBatch.from_arrays([pa.array(list(slices), pa.int32()), pa.array([zlib.compress(x.tobytes(), 1) for x in slices.values()], pa.binary())], ["slice", "bits"])

    def united(batches):
        slices: dict[int, object] = {}
        for batch in batches:
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = np.frombuffer(zlib.decompress(raw), dtype=np.uint8)
                slices[i] = slices[i] | own if i in slices else own
        yield pa.RecordBatch.from_arrays([pa.array(list(slices), pa.int32()), pa.array([x.tobytes() for x in slices.values()], pa.binary())], ["slice", "bits"])

    set_here = hashes.select(F.col(column).cast("long")).where(F.col(column).isNotNull()).mapInArrow(merge, "slice int, bits binary")
    found = set_here.repartition("slice").mapInArrow(united, "slice int, bits binary")
    out = bytearray(bits // 8)
    for row in found.collect():  # bits/8 bytes, whatever the input
        out[row.slice * BITMAP_SLICE : (row.slice + 1) * BITMAP_SLICE] = row.bits[: len(out)]
    return bytes(out)


def in_bitmap(bits: bytes, hashes):
    """Boolean numpy array: which of the int64 or uint64 hashes have their bit set."""
    import numpy as np

    cells = np.frombuffer(bits, dtype=np.uint8)
    at = hashes.astype(np.uint64) & np.uint64(len(cells) * 8 - 1)
    return (cells[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
