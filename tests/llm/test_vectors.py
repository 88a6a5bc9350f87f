"""Operators 2 and 10 against brute force."""

import numpy as np
import pytest

from corpusloom.llm import pivot_index
from corpusloom.llm.graph import connected_components
from corpusloom.llm.kmeans_tree import nearest_neighbours
from corpusloom.llm.pivot_index import embedding_near_duplicates

FIELDS = "vec_id long, embedding array<float>, label int, pivot string, rep string"


def vectors(n=700, d=24, seed=1):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n, d))
    for k in range(0, n // 2, 5):  # near copies, and near copies of them
        x[k + 1] = x[k] + draw.normal(size=d) * 0.25
        x[k + 2] = x[k + 1] + draw.normal(size=d) * 0.3
    x[60:140] = x[60]
    x[200:230] = x[200] + draw.normal(size=(30, d)) * 0.15
    return x.astype(np.float32)


ODD = [(9001, None, 1), (9002, [0.0] * 24, 1), (9003, [float("nan")] * 24, 1), (9004, [1.0] * 24, None), (9005, [1.0, 2.0], 1), (9006, [], 1), (9007, [1.0, None] * 12, 1), (9008, [float("inf")] * 24, 1), (9009, [2.0, 4.0], 1)]


def table(spark, x, labels):
    rows = [(i, v.tolist(), int(labels[i])) for i, v in enumerate(x)] + ODD
    return spark.createDataFrame([(*r, "x", "y") for r in rows], FIELDS)


@pytest.mark.parametrize("block,exact", [(1024, False), (16, False), (100, True)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, block, exact):
    monkeypatch.setattr(pivot_index, "BLOCK", block)
    x = vectors()
    labels = np.arange(len(x)) // 240
    got = {r.vec_id: r for r in embedding_near_duplicates(table(spark, x, labels), exact=exact).collect()}
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    links = (u @ u.T >= 0.93) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(links, False)
    component = np.arange(len(x))
    while True:
        lower = np.array([min(component[i], *component[links[i]]) if links[i].any() else component[i] for i in range(len(x))])
        if (lower == component).all():
            break
        component = lower
    found = sum(int(got[i].n_links) for i in range(len(x)))
    assert all(got[i].n_links <= links[i].sum() for i in range(len(x)))
    assert found >= (1 if exact else 0.995) * links.sum()
    assert sum(got[i].component_id != component[i] for i in range(len(x))) <= (0 if exact else 0.01 * len(x))
    assert [(got[i].n_links, got[i].component_id, got[i].kept) for i, *_ in ODD[:4] + ODD[5:8]] == [(0, i, True) for i, *_ in ODD[:4] + ODD[5:8]]
    assert got[9005].n_links == got[9009].n_links == 1 and got[9009].component_id == 9005


def test_near_duplicates_null_and_repeated_ids(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.01], 1), (2, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (None, [1.0, 0.02], 1), (3, [0.0, 1.0], 1)]
    got = sorted(map(tuple, embedding_near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()), key=str)
    assert got == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True), (None, 0, None, False), (None, 0, None, False)]


def test_near_duplicates_of_nothing(spark):
    assert embedding_near_duplicates(spark.createDataFrame([], FIELDS)).count() == 0


def test_nearest_have_the_recall(spark):
    x = vectors(3000, 16)
    all_rows = table(spark, x, np.zeros(len(x)))
    got = nearest_neighbours(all_rows, all_rows.where("vec_id % 20 = 0"), 20).toPandas()
    true = x.astype(np.float64) @ x.astype(np.float64).T
    hits = total = 0
    for q, rows in got.groupby("query_id"):
        rows = rows.sort_values("rank")
        scores = true[q].copy()
        scores[q] = -np.inf
        best = np.lexsort((np.arange(len(x)), -scores))[:20]
        hits += len(set(best) & set(rows.vec_id))
        total += 20
        assert list(rows["rank"]) == list(range(1, 21))
        assert np.allclose(rows.score, true[q][rows.vec_id])
        assert list(zip(-rows.score, rows.vec_id)) == sorted(zip(-rows.score, rows.vec_id))
    assert total == 20 * 150 and hits / total >= 0.9


def test_nearest_small_tables(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [0.5, 0.0]), (None, [1.0, 1.0]), (3, None), (20, [2.0, 0.0])], "vec_id long, embedding array<float>")
    got = nearest_neighbours(rows, rows.where("vec_id = 20"), 20).orderBy("rank").collect()
    assert [(r.rank, r.vec_id, r.score) for r in got] == [(1, 1, 2.0), (2, 2, 2.0), (3, 2, 1.0)]
    assert nearest_neighbours(rows.where("false"), rows, 5).count() == 0
    queries = spark.createDataFrame([(7, [1.0, 0.0]), (7, [0.0, 1.0])], "vec_id long, embedding array<float>")
    got = nearest_neighbours(rows, queries, 2).orderBy("rank").collect()  # one query: the best of both rows
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [(7, 1, 20, 2.0), (7, 2, 1, 1.0)]


def test_visits_go_on_until_enough_rows_are_held():
    from corpusloom.llm.kmeans_tree import fit_tree

    x = vectors(2000, 8)
    tree = fit_tree(x.astype(np.float64), 32)
    sizes = np.ones(tree.leaves, dtype=int)
    assert all(len(v) == 1 for v in tree.visits(x[:9], 1)) and all(len(v) == 12 for v in tree.visits(x[:9], 1, sizes, 12))


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(1, 300)] + [(1000, k) for k in range(1001, 1100)] + [(5000, None), (7, 7)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 301)} | {i: 1000 for i in range(1000, 1100)}
