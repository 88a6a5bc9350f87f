"""What the operators on embeddings share: which vectors count, and Arrow lists as matrices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(embedding: str) -> Column:
    """True for vectors that are not null, empty or zero and hold neither nulls nor non-finite components."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(F.col(embedding).isNotNull() & finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def matrix(lists):
    """An Arrow array of equally long lists as a float64 matrix."""
    import numpy as np
    import pyarrow as pa

    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):  # no chunks
        lists = pa.array([], lists.type)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(lists), -1) if len(lists) else np.zeros((0, 1))


def unit_rows(x):
    """Rows scaled to length 1; components are divided by their largest first, so nothing overflows."""
    import numpy as np

    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))
