"""Near-duplicate embeddings by a pivot-permutation index.

Reference points (pivots) are vectors of the table.  Each vector is described by the ordered `prefix` pivots nearest to
it.  Inverted lists hold the vectors of a label by pivot; two vectors are candidates if they share at least `shared` of
their pivots, counted when their lists meet, and are then verified by cosine in double precision.  Sharing s of k pivots
implies that one of the first k-s+1 in a fixed order is shared, so only those are put in lists, and a pair is counted in
the list of its first shared pivot alone.

Scale.  Equal vectors of a label are one entry with a count of copies.  A list over BLOCK entries is cut into blocks, and
pairs of blocks are separate groups, so no task holds more than two blocks.  Groups give sums and the edges of a spanning
forest, never pairs.  The number of pivots grows with the root of the number of vectors, within PIVOTS.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components, and rows with a null label,
link with nothing; so do vectors of different length.  Rows with a null vec_id take no part: they get no links and no
component, count in no other row's links, and are not kept.  Rows that repeat a vec_id count as vectors of their own.  An
empty table gives an empty result; further columns are ignored.

The index can miss a link whose vectors share fewer than `shared` of their pivots.  exact=True leaves none out: each vector
is in a list of its label alone, so all pairs of a label are compared, in blocks.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound_batches, drop_tables, shared_table
from .graph import connected_components
from .vectors import matrix, unit_rows, usable

#: Least and most pivots; vectors drawn for each pivot that is picked; entries of a block.
PIVOTS, DRAWN, BLOCK = (32, 1024), 4, 1024


def pick_pivots(entries: DataFrame, n: int):
    """(length of vectors, matrix of pivots): vectors of the most frequent length, drawn by hash, none close to another."""
    import numpy as np

    length = entries.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if length is None:
        return 0, np.zeros((0, 0))
    want = min(PIVOTS[1], max(PIVOTS[0], 1 << round(math.log2(max(n, 1)) / 2)))
    drawn = entries.where(F.size("embedding") == length.d).orderBy(F.xxhash64("embedding"), "embedding").limit(DRAWN * want).select("embedding").collect()
    rows, picked = unit_rows(np.array([r.embedding for r in drawn], dtype=np.float64)), []
    for i, x in enumerate(rows):
        if len(picked) < want and (not picked or (rows[picked] @ x).max() < 0.9):
            picked.append(i)
    return length.d, rows[picked]


def describe(entries: DataFrame, length: int, pivots, prefix: int, shared: int) -> DataFrame:
    """entries with `nearest` (indices of the nearest pivots, in order) and `lists` (those whose lists they are put in).

    Vectors of another length have no pivots and share the list -1.
    """
    import numpy as np
    import pyarrow as pa

    k = min(prefix, len(pivots))
    kept = max(1, k - shared + 1)

    def run(batches):
        for batch in batches:
            nearest, lists = [], []
            column = batch.column("embedding")
            fits = np.array(column.value_lengths()) == length
            if fits.any() and k:
                sims = unit_rows(matrix(column.filter(pa.array(fits)))) @ pivots.T
                order = np.argsort(-sims, axis=1, kind="stable")[:, :k].astype(np.int32)
                held = iter(zip(order.tolist(), np.sort(order, axis=1)[:, :kept].tolist(), strict=True))
            for fit in fits:
                a, b = next(held) if fit and k else ([], [-1])
                nearest.append(a)
                lists.append(b)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nearest, pa.list_(pa.int32())), pa.array(lists, pa.list_(pa.int32()))], [*batch.schema.names, "nearest", "lists"])

    fields = ", ".join(f"{x.name} {x.dataType.simpleString()}" for x in entries.schema)
    return entries.mapInArrow(run, f"{fields}, nearest array<int>, lists array<int>")


def linked_in_group(table, threshold: float, shared: int, n_pivots: int):
    """(entry, links, other) rows of one pair of blocks: links of each entry, and the edges of a spanning forest."""
    import numpy as np
    import pyarrow as pa

    pivot, same_block = table["pivot"][0].as_py(), table["i"][0].as_py() == table["j"][0].as_py()
    ids = table["rep"].to_numpy()
    copies, block = table["copies"].to_numpy(), table["block"].to_numpy()
    out_ids, out_links, out_other = [], [], []
    lengths = np.array(table["embedding"].combine_chunks().value_lengths())
    for d in np.unique(lengths):
        at = np.flatnonzero(lengths == d)
        x = unit_rows(matrix(table["embedding"].combine_chunks().take(pa.array(at))))
        links = x @ x.T >= threshold
        np.fill_diagonal(links, False)
        if pivot >= 0:
            held = np.zeros((len(at), n_pivots), dtype=np.float32)
            near = table["nearest"].combine_chunks().take(pa.array(at)).flatten().to_numpy().reshape(len(at), -1)
            held[np.arange(len(at))[:, None], near] = 1
            links &= held @ held.T >= min(shared, near.shape[1])
            before = held[:, :pivot]
            links &= before @ before.T == 0
        if not same_block:
            links &= block[at][:, None] != block[at][None, :]
        n = links @ copies[at]
        some = n > 0
        out_ids += ids[at][some].tolist()
        out_links += n[some].tolist()
        out_other += [None] * int(some.sum())
        unseen = some.copy()
        while unseen.any():  # a breadth-first walk gives the forest
            front = np.array([np.argmax(unseen)])
            unseen[front] = False
            while len(front):
                reached = np.flatnonzero(links[front].any(axis=0) & unseen)
                if len(reached):
                    parent = front[np.argmax(links[np.ix_(front, reached)], axis=0)]
                    out_ids += ids[at][reached].tolist()
                    out_links += [0] * len(reached)
                    out_other += ids[at][parent].tolist()
                    unseen[reached] = False
                front = reached
    return pa.table({"rep": pa.array(out_ids, pa.int64()), "links": pa.array(out_links, pa.int64()), "other": pa.array(out_other, pa.int64())})


def embedding_near_duplicates(vectors: DataFrame, threshold: float = 0.93, prefix: int = 8, shared: int = 2, exact: bool = False) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of vectors (vec_id, embedding, label)."""
    bound_batches(vectors.sparkSession)
    ok = usable("embedding") & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = vectors.select(F.col("vec_id").cast("long"), F.when(ok, F.col("label")).alias("label"), F.when(ok, F.col("embedding")).alias("embedding"))
    grouped = rows.where("embedding is not null").groupBy("label", "embedding").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    entries = shared_table(grouped.withColumn("rep", F.monotonically_increasing_id()), "vectors")
    length, pivots = (0, []) if exact else pick_pivots(entries, entries.count())
    n_pivots = len(pivots)
    described = shared_table(describe(entries, length, pivots, prefix, shared), "pivot-lists")

    placed = described.withColumn("pivot", F.explode("lists"))
    sizes = placed.groupBy("label", "pivot").count().where(F.col("count") > BLOCK)
    blocks = shared_table(sizes.select("label", "pivot", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")), "list-blocks")
    in_blocks = (
        placed.join(blocks, ["label", "pivot"], "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("i", F.least("block", "other"))
        .withColumn("j", F.greatest("block", "other"))
        .select("label", "pivot", "i", "j", "block", "rep", "copies", "nearest", "embedding")
    )

    def links(table):
        return linked_in_group(table, threshold, shared, n_pivots)

    found = shared_table(in_blocks.groupBy("label", "pivot", "i", "j").applyInArrow(links, "rep long, links long, other long"), "links")
    counts = shared_table(found.groupBy("rep").agg(F.sum("links").alias("links")), "link-counts")
    components = connected_components(found.where("other is not null").select(F.col("rep").alias("a"), F.col("other").alias("b")))
    own = entries.select("label", "embedding", "rep", "copies")
    reached = entries.select("rep", "first").join(components.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    lowest = reached.groupBy("component").agg(F.min("first").alias("component_id"))
    named = shared_table(reached.join(lowest, "component").select("rep", "component_id"), "vector-components")
    drop_tables(described, blocks, found)
    component = F.coalesce("component_id", "vec_id")
    return (
        rows.join(own, ["label", "embedding"], "left")
        .select("vec_id", "rep", "copies")
        .join(counts, "rep", "left")
        .join(named, "rep", "left")
        .select(
            "vec_id",
            (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).alias("n_links"),
            F.when(F.col("vec_id").isNotNull(), component).alias("component_id"),
            F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
        )
    )


def op2_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: links and components of all embeddings at cosine 0.93."""
    return embedding_near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), 0.93)
