"""Connected components of an edge table, by repeated hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_tables, shared_table


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of edges (a long, b long): component is the smallest node reachable.

    In each round every node hooks to the smallest of itself and its neighbours and then to where that one hooked; edges
    whose ends met are gone, and the others go on between the nodes hooked to.  A round leaves at most half of the nodes
    that still have edges, so each one's tables are smaller; the hooks of all rounds are put together at the end.
    Neighbour lists are never gathered.  Rows with a null end are ignored.  No edges give no rows.
    """
    left = shared_table(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    rounds = []
    while not rounds or not left.isEmpty():
        ends = left.select("a", "b").union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = ends.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("to"))
        then = first.select(F.col("node").alias("to"), F.col("to").alias("then"))
        hooks = shared_table(first.join(then, "to").select("node", F.col("then").alias("to")), "hooks")
        rounds.append(hooks)
        at_a, at_b = (hooks.select(F.col("node").alias(x), F.col("to").alias(f"to_{x}")) for x in "ab")
        met = left.join(at_a, "a").join(at_b, "b").where("to_a <> to_b")
        after = shared_table(met.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), "edges")
        drop_tables(left)
        left = after
    drop_tables(left)
    labels = rounds[0].select("node", F.col("to").alias("component"))
    for hooks in rounds[1:]:
        moved = hooks.select(F.col("node").alias("component"), F.col("to").alias("then"))
        labels = labels.join(moved, "component", "left").select("node", F.coalesce("then", "component").alias("component"))
    if len(rounds) == 1:
        return labels
    out = shared_table(labels, "components")
    drop_tables(*rounds)
    return out
