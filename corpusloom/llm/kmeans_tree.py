"""Approximate nearest neighbours by inner product, by a hierarchical k-means tree with best-bin-first search.

The tree is fitted on a bounded sample (FIT_ROWS vectors, drawn by hash); every row is then put in a leaf.  A query goes
through the tree by a priority queue: the node with the best outlook is opened next, until enough leaves are visited.
How many are enough is calibrated: for CALIBRATE_QUERIES queries the true neighbours among all rows are found by brute
force, and the visits are widened until the leaves visited hold `recall` of them; the whole tree is the last resort, and
exact.  However few leaves that is, a query goes on until they hold k rows.  Scores are inner products of the original vectors in double precision.

Scale.  Leaves are dealt to bins of about BIN_ROWS rows; a leaf with more rows, such as one of copies, is cut into
several.  The queries that visit a bin meet its rows there, BIN_QUERIES at a time, and only the k best of each query leave.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do rows
without an id, nor vectors of another length than the most frequent one.  Ties go to the smaller id.  Rows that repeat an
id are candidates of their own, except against a query of that id; query rows that repeat an id are one query, whose
neighbours are the best of theirs.  Empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bound_batches, shared_table
from .vectors import matrix, usable

FIT_ROWS, BRANCHES, ROUNDS = 20_000, 8, 8
LEAF_ROWS, MOST_LEAVES = 256, 2048
CALIBRATE_QUERIES = 200
BIN_ROWS, BIN_QUERIES = 8192, 4096


@dataclass
class Tree:
    """Nodes by number; node 0 is the root.  leaf is -1 for inner nodes."""

    centres: list = field(default_factory=list)
    spread: list = field(default_factory=list)
    children: list = field(default_factory=list)
    leaf: list = field(default_factory=list)
    leaves: int = 0

    def add(self, rows) -> int:
        import numpy as np

        centre = rows.mean(axis=0)
        self.centres.append(centre)
        deviation = math.sqrt(((rows - centre) ** 2).sum(axis=1).mean() / rows.shape[1])
        # The best of m rows lies about so many deviations from the centre along a query.
        self.spread.append(deviation * math.sqrt(2 * math.log(max(2, len(rows)))))
        self.children.append(np.array([], dtype=int))
        self.leaf.append(-1)
        return len(self.leaf) - 1

    def assign(self, x):
        """The leaf of each row: the nearest child's centre, level by level."""
        import numpy as np

        out, waiting = np.zeros(len(x), dtype=np.int32), [(0, np.arange(len(x)))]
        centres = np.array(self.centres)
        while waiting:
            node, at = waiting.pop()
            if self.leaf[node] >= 0:
                out[at] = self.leaf[node]
            elif len(at):
                kids = self.children[node]
                c = centres[kids]
                nearest = np.argmin((c * c).sum(axis=1) - 2 * (x[at] @ c.T), axis=1)
                waiting += [(kid, at[nearest == i]) for i, kid in enumerate(kids)]
        return out

    def visits(self, queries, n: int, sizes=None, rows: int = 0) -> list[list[int]]:
        """The first n leaves of each query, best outlook first; more if they hold fewer than `rows` by their sizes."""
        import numpy as np

        outlook = queries @ np.array(self.centres).T + np.sqrt((queries * queries).sum(axis=1))[:, None] * np.array(self.spread)
        out = []
        for row in (-outlook).tolist():
            queue, seen, held = [(row[0], 0)], [], 0
            while queue and (len(seen) < n or held < rows):
                _, node = heapq.heappop(queue)
                if self.leaf[node] >= 0:
                    seen.append(self.leaf[node])
                    held += sizes[self.leaf[node]] if rows else 0
                else:
                    for kid in self.children[node]:
                        heapq.heappush(queue, (row[kid], int(kid)))
            out.append(seen)
        return out


def fit_tree(sample, leaves: int) -> Tree:
    """Split the largest node by k-means until there are so many leaves or all are small."""
    import numpy as np

    draw, tree = np.random.default_rng(11), Tree()
    waiting = [(-len(sample), tree.add(sample), sample)]
    done = []
    while waiting and len(waiting) + len(done) + BRANCHES <= leaves:
        _, node, rows = heapq.heappop(waiting)
        centres = rows[draw.choice(len(rows), min(BRANCHES, len(rows)), replace=False)]
        for _ in range(ROUNDS):
            nearest = np.argmin((centres * centres).sum(axis=1) - 2 * (rows @ centres.T), axis=1)
            centres = np.array([rows[nearest == i].mean(axis=0) for i in np.unique(nearest)])
        nearest = np.argmin((centres * centres).sum(axis=1) - 2 * (rows @ centres.T), axis=1)
        parts = [rows[nearest == i] for i in np.unique(nearest)]
        if len(parts) < 2:  # equal vectors
            done.append(node)
            continue
        kids = [(-len(part), tree.add(part), part) for part in parts]
        tree.children[node] = np.array([kid for _, kid, _ in kids])
        for kid in kids:
            heapq.heappush(waiting, kid) if len(kid[2]) > 2 * BRANCHES else done.append(kid[1])
    # Leaves are numbered in the order of a walk, so near numbers are near leaves.
    walk = [0]
    while walk:
        node = walk.pop()
        if len(tree.children[node]):
            walk += tree.children[node].tolist()[::-1]
        else:
            tree.leaf[node] = tree.leaves
            tree.leaves += 1
    return tree


def best(ids, rows, query, k: int, own):
    """The k rows with the largest inner products, as (ids, scores): larger first, then the smaller id."""
    import numpy as np

    fast = rows @ query
    allowed = ids != own
    n = int(allowed.sum())
    if n > k:
        least = np.partition(np.where(allowed, fast, -np.inf), len(fast) - k)[len(fast) - k]
        allowed &= fast >= least - 1e-9 * max(1.0, abs(least))
    at = np.flatnonzero(allowed)
    # Row by row, so equal vectors have equal scores wherever they stand.
    scores = (rows[at] * query).sum(axis=1)
    order = np.lexsort((ids[at], -scores))[:k]
    return ids[at][order], scores[order]


def merged(found: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score of the k best of rows (query_id, ids, scores)."""
    each = found.select("query_id", F.explode(F.arrays_zip("ids", "scores")).alias("x")).select("query_id", F.col("x.ids").alias("vec_id"), F.col("x.scores").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).cast("int")
    return each.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def brute_force(rows: DataFrame, queries: list[tuple], k: int) -> DataFrame:
    """The exact neighbours of a bounded list of (id, vector), by one scan of rows (vec_id, embedding)."""
    import numpy as np
    import pyarrow as pa

    def run(batches):
        held = [(np.array([], dtype=np.int64), np.zeros((0, 1)))] * len(queries)
        for batch in batches:
            ids, x = batch.column("vec_id").to_numpy(), matrix(batch.column("embedding"))
            for i, (own, query) in enumerate(queries):
                near, scores = best(ids, x, query, k, own)
                near, scores = np.concatenate([held[i][0], near]), np.concatenate([held[i][1].ravel(), scores])
                order = np.lexsort((near, -scores))[:k]
                held[i] = near[order], scores[order]
        if queries and len(held[0][0]):
            yield pa.RecordBatch.from_arrays(
                [pa.array([q for q, _ in queries], pa.int64()), pa.array([x.tolist() for x, _ in held], pa.list_(pa.int64())), pa.array([s.ravel().tolist() for _, s in held], pa.list_(pa.float64()))],
                ["query_id", "ids", "scores"],
            )

    return merged(rows.select("vec_id", "embedding").mapInArrow(run, "query_id long, ids array<long>, scores array<double>"), k)


def calibrated_visits(tree: Tree, rows: DataFrame, queries: DataFrame, k: int, recall: float) -> int:
    """The least number of visited leaves, in steps of a quarter, that reaches the recall on the calibration queries."""
    import numpy as np

    picked = queries.orderBy(F.xxhash64("vec_id", "embedding"), "vec_id").limit(CALIBRATE_QUERIES).collect()
    known = [(r.vec_id, np.array(r.embedding, dtype=np.float64)) for r in picked]
    truth = brute_force(rows, known, k).join(rows.select("vec_id", "leaf"), "vec_id").select("query_id", "leaf").collect()
    if not truth:
        return tree.leaves
    orders = tree.visits(np.array([x for _, x in known]), tree.leaves)
    place = {(q, leaf): n for (q, _), seen in zip(known, orders, strict=True) for n, leaf in enumerate(seen)}
    needed = np.array([place[r.query_id, r.leaf] for r in truth])
    visits = 1
    while visits < tree.leaves and (needed < visits).mean() < recall:
        visits = min(tree.leaves, max(visits + 1, visits * 5 // 4))
    return visits


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int = 20, recall: float = 0.95) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of `vectors` for each row of `queries` (both: vec_id, embedding)."""
    import numpy as np
    import pyarrow as pa

    spark = vectors.sparkSession
    bound_batches(spark)

    def clean(df):
        return df.where(usable("embedding") & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")

    base = clean(vectors)
    lengths = base.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if lengths is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    base, asked = (x.where(F.size("embedding") == lengths.d) for x in (base, clean(queries)))
    share = min(1.0, FIT_ROWS / lengths["count"])
    drawn = base.where(F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(1 << 20)) < math.ceil(share * (1 << 20))).select("embedding").toArrow()
    sample = matrix(drawn.column(0))
    tree = fit_tree(sample, max(1, min(MOST_LEAVES, lengths["count"] // LEAF_ROWS)))

    def place(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tree.assign(matrix(batch.column("embedding"))), pa.int32())], [*batch.schema.names, "leaf"])

    kind = base.schema["embedding"].dataType.simpleString()
    rows = shared_table(base.mapInArrow(place, f"vec_id long, embedding {kind}, leaf int"), "leaves")
    visits = calibrated_visits(tree, rows, asked, k, recall)

    # Leaves to bins; the tables made here have a row a leaf, so they are bounded by MOST_LEAVES.
    counted = {r.leaf: r for r in rows.groupBy("leaf").agg(F.count("*").alias("n"), F.approx_count_distinct("vec_id").alias("ids")).collect()}
    sizes = {leaf: r.n for leaf, r in counted.items()}
    # Rows of the query's own id do not count, so leaves are visited until they hold enough even without them.
    other_rows = [min(counted[leaf].n, counted[leaf].ids) if leaf in counted else 0 for leaf in range(tree.leaves)]
    bin_of, filled, n_bins = {}, 0, 0
    for leaf in range(tree.leaves):
        if filled and filled + sizes.get(leaf, 0) > BIN_ROWS:
            filled, n_bins = 0, n_bins + 1
        bin_of[leaf] = n_bins
        filled += sizes.get(leaf, 0)
    held = {}
    for leaf, b in bin_of.items():
        held[b] = held.get(b, 0) + sizes.get(leaf, 0)

    def seen(batches):
        for batch in batches:
            x = matrix(batch.column("embedding"))
            at, bins, leaves = [], [], []
            for i, order in enumerate(tree.visits(x, visits, other_rows, 2 * k + 2)):
                by = {}
                for leaf in order:
                    by.setdefault(bin_of[leaf], []).append(leaf)
                at += [i] * len(by)
                bins += by
                leaves += by.values()
            part = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(bins, pa.int32()), pa.array(leaves, pa.list_(pa.int32()))], ["query_id", "embedding", "bin", "leaves"])

    asked = asked.select("vec_id", "embedding")
    visiting = shared_table(asked.mapInArrow(seen, f"query_id long, embedding {asked.schema['embedding'].dataType.simpleString()}, bin int, leaves array<int>"), "visits")
    loads = {r.bin: r["count"] for r in visiting.groupBy("bin").count().collect()}
    plan = spark.createDataFrame([(leaf, b, -(-held[b] // BIN_ROWS) or 1, -(-loads.get(b, 0) // BIN_QUERIES) or 1) for leaf, b in bin_of.items()], "leaf int, bin int, row_parts int, query_parts int")

    def parts(count):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    left = rows.join(F.broadcast(plan), "leaf").withColumn("row_part", F.pmod(F.xxhash64("vec_id"), F.col("row_parts")).cast("int")).withColumn("query_part", parts("query_parts")).select("bin", "row_part", "query_part", "vec_id", "leaf", "embedding")
    by_bin = plan.select("bin", "row_parts", "query_parts").distinct()
    right = visiting.join(F.broadcast(by_bin), "bin").withColumn("query_part", F.pmod(F.xxhash64("query_id"), F.col("query_parts")).cast("int")).withColumn("row_part", parts("row_parts")).select("bin", "row_part", "query_part", "query_id", "leaves", "embedding")
    n_leaves = tree.leaves

    def search(rows, queries):
        out = ([], [], [])
        if rows.num_rows and queries.num_rows:
            ids, leaf, x = rows["vec_id"].to_numpy(), rows["leaf"].to_numpy(), matrix(rows["embedding"])
            for own, visited, q in zip(queries["query_id"].to_pylist(), queries["leaves"].to_pylist(), matrix(queries["embedding"]), strict=True):
                mask = np.zeros(n_leaves, dtype=bool)
                mask[visited] = True
                at = np.flatnonzero(mask[leaf])
                near, scores = best(ids[at], x[at], q, k, own)
                for column, value in zip(out, (own, near.tolist(), scores.tolist()), strict=True):
                    column.append(value)
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "ids": pa.array(out[1], pa.list_(pa.int64())), "scores": pa.array(out[2], pa.list_(pa.float64()))})

    keys = ["bin", "row_part", "query_part"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, "query_id long, ids array<long>, scores array<double>")
    return merged(found, k)


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: the 20 nearest of each row whose vec_id is divisible by 20, among all others."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest_neighbours(vectors, vectors.where("vec_id % 20 = 0"), 20)
