"""Connected components of an edge table, by contraction.

Each round first contracts within tasks: the edges of a task become those from the least node of each piece to its other
nodes.  Small tables, which Spark reads in one task, are done with that.  Then each node hooks to the least of its
neighbours, and on to where that one hooks, and edges go on between the nodes hooked to; so a round leaves half of the nodes
that still have edges at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import drop_tables, shared_table


def _stars(edges: DataFrame) -> DataFrame:
    """a, b: within each task, the least node of each connected piece with each other node of it."""
    import pyarrow as pa

    def contract(batches):
        above: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while (up := above.get(top, top)) != top:
                top = up
            while (up := above.get(x, x)) != top:
                above[x] = top
                x = up
            return top

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x, y = root(a), root(b)
                above[max(x, y)] = above[min(x, y)] = min(x, y)
        nodes = [x for x in above if root(x) != x]
        for i in range(0, len(nodes), 1 << 16):
            some = nodes[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array([root(x) for x in some], pa.int64()), pa.array(some, pa.int64())], ["a", "b"])

    return edges.repartition("a").mapInArrow(contract, "a long, b long")


def connected(edges: DataFrame) -> DataFrame:
    """node, component (the least node reachable) of each node of edges (a long, b long) that has one to another node."""
    left = shared_table(_stars(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()), "edges")
    rounds = []
    while not left.isEmpty():
        ends = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = ends.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("to"))
        then = first.select(F.col("node").alias("to"), F.col("to").alias("then"))
        hooks = shared_table(first.join(then, "to").select("node", F.col("then").alias("to")), "hooks")
        rounds.append(hooks)
        at_a, at_b = (hooks.select(F.col("node").alias(x), F.col("to").alias(f"to_{x}")) for x in "ab")
        met = left.join(at_a, "a").join(at_b, "b").where("to_a <> to_b").select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
        after = shared_table(_stars(met.distinct()), "edges")
        drop_tables(left)
        left = after
    if not rounds:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    drop_tables(left)
    labels = rounds[0].select("node", F.col("to").alias("component"))
    for hooks in rounds[1:]:
        moved = hooks.select(F.col("node").alias("component"), F.col("to").alias("then"))
        labels = labels.join(moved, "component", "left").select("node", F.coalesce("then", "component").alias("component"))
    out = shared_table(labels, "components")
    drop_tables(*rounds)
    return out
