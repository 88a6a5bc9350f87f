import random
import zlib

import numpy as np

from corpusloom.llm.transaction_log import _first_below, _inside, epochs, first_dips, numbered, op13_transaction_log, reassembled, running, store_sums, versions

LOG = "source string, seq long, kind string, key long, value long"


def walked(rows, every=64):
    """(undone, states) of a log by walking it: rows in order of seq."""
    open_, undone, commits = {}, [], []
    for source, seq, kind, key, value in rows:
        held = open_.setdefault(source, [[]])
        if kind == "change":
            held[-1].append((seq, key, value))
        elif kind == "savepoint":
            held.append([])
        elif kind == "rollback":
            undone += [("rollback", s, seq, k) for s, k, _ in held[-1]]
            held[-1] = []
        else:
            changes = [x for level in held for x in level]
            if kind == "abort":
                undone += [("abort", s, seq, k) for s, k, _ in changes]
            else:
                commits.append(changes)
            open_[source] = [[]]
    undone += [("abort", s, None, k) for held in open_.values() for level in held for s, k, _ in level]
    store, states = {}, []
    for i, changes in enumerate(commits):
        for _, key, value in changes:
            if value is None:
                store.pop(key, None)
            else:
                store[key] = value
        if (i + 1) % every == 0 or i + 1 == len(commits):
            states.append((len(states) + 1, len(store), sum(store.values())))
    return undone, states


def spark_result(spark, rows, every, block):
    fates = reassembled(spark.createDataFrame(rows, LOG), block)
    ranks = epochs(fates, every)
    states = [tuple(r) for r in store_sums(versions(fates, ranks), ranks, block).orderBy("epoch").collect()]
    undone = [tuple(r) for r in fates.where("fate in ('abort', 'rollback')").select("fate", "seq", "by_seq", "key").collect()]
    return undone, states


def made_log(n, sources, kinds, weights, keys):
    rows = []
    for seq in range(n):
        kind = random.choices(kinds, weights)[0]
        change = kind == "change"
        rows.append((random.choice(sources), seq * 3, kind, random.randrange(keys) if change else None, random.choice([None, random.randrange(1 << 32)]) if change else None))
    return rows


KINDS = ["change", "savepoint", "rollback", "commit", "abort"]


def test_logs_against_a_walk(spark):
    random.seed(13)
    cases = [
        (made_log(700, [None, "a", "a", "b"], KINDS, [10, 2, 2, 2, 1], 9), 4, 4),
        # one source with long transactions: deep savepoints, and ends far away, over four levels of blocks of 3
        (made_log(300, ["hot"], KINDS, [10, 6, 3, 0.05, 0.05], 5) + made_log(1, ["b"], ["change"], [1], 2), 2, 3),
        (made_log(40, ["a"], ["change"], [1], 3), 64, 1024),
    ]
    for rows, every, block in cases:
        rows = [(s, i, *rest) for i, (s, _, *rest) in enumerate(rows)]
        undone, states = spark_result(spark, rows, every, block)
        expected = walked(rows, every)
        assert sorted(undone, key=str) == sorted(expected[0], key=str)
        assert states == expected[1]


def test_first_dips_of_any_heights(spark):
    random.seed(4)
    for n, block in ((0, 4), (1, 4), (230, 3), (200, 16)):
        rows = [(i, random.choice([None, random.randrange(40)]), random.choice([None, random.randrange(42)])) for i in range(n)]
        expected = {i: next((j for j in range(i + 1, n) if rows[j][1] is not None and rows[j][1] < h), None) for i, _, h in rows if h is not None}
        got = first_dips(spark.createDataFrame(rows, "pos long, dip long, height long"), n, block).collect()
        assert len(got) == len(expected) and {r.pos: r.ender for r in got} == expected


def test_searches_in_a_block():
    random.seed(6)
    for _ in range(300):
        n = random.randrange(1, 30)
        dips = [random.choice([None, random.randrange(9)]) for _ in range(n)]
        heights = [random.choice([None, random.randrange(10)]) for _ in range(n)]
        expected = [None if h is None else next((j for j in range(i + 1, n) if dips[j] is not None and dips[j] < h), -1) for i, h in enumerate(heights)]
        assert _inside(dips, heights) == expected
        full = np.array([99 if d is None else d for d in dips])
        asked = np.arange(-1, 12)
        assert _first_below(full, asked).tolist() == [next((j for j in range(n) if full[j] < h), -1) for h in asked]


def test_places_and_running_sums(spark):
    random.seed(2)
    rows = [(random.choice([None, "a", "b"]), random.randrange(50)) for _ in range(500)]
    placed = numbered(spark.createDataFrame(rows, "s string, x long").repartition(5), "s", "x")
    got = sorted((r.pos, r.s, r.x) for r in running(placed, 500, placed.x, "before", 7).collect())
    expected = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert [(s, x) for _, s, x in got] == expected and [p for p, *_ in got] == list(range(500))
    sums = {r.pos: r.before for r in running(placed, 500, placed.x, "before", 7).collect()}
    assert [sums[i] for i in range(500)] == [sum(x for _, x in expected[:i]) for i in range(500)]


def test_query_against_a_walk(spark, tmp_path):
    random.seed(9)
    crc = lambda x: zlib.crc32(x.encode())
    texts = {i: random.choice([None, "", "é" * 5, f"text {i}"]) for i in range(-40, 2500)}
    docs = [(i, texts[i], random.choice([None, "s0", "s0", "s1"]), "x") for i in texts]
    labels = [(i, 1, random.choice([0, 1, None])) for i in random.sample(sorted(texts), 900)]
    labels += [(labels[0][0], 0, 1), (None, 1, 1)]
    spark.createDataFrame([*docs, (None, "no id", "s0", "x")], "doc_id long, text string, source string, kind string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    toxic = {i for i, _, t in labels if t == 1}
    kinds = ["commit", "commit", "abort", "savepoint", "savepoint", "rollback", "rollback"] + ["change"] * 10
    rows = []
    for i, text, source, _ in docs:
        h = crc(str(i))
        key = h // 100 % 30000
        rows.append((source, i, kinds[h % 17], key, None if text is None or i in toxic else crc(f"{key}:{text}")))
    undone, states = walked(rows)
    got = [tuple(r) for r in op13_transaction_log(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted([*undone, *(("state", *s) for s in states)], key=str)
    spark.createDataFrame([], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/e/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/e/labels.parquet")
    assert op13_transaction_log(spark, f"{tmp_path}/e").count() == 0
