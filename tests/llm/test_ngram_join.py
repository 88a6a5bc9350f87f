"""Operator 5 against comparing all pairs."""

import random
import re

import pytest

from corpusloom.llm import ngram_join as op


def brute(rows, n=5, percent=75):
    sets = {}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets[i] = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} - {()}
    component = {i: i for i in sets}
    for i in sorted(sets):
        for j in sorted(sets):
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= percent * len(sets[i] | sets[j]) and component[i] != component[j]:
                low, high = sorted((component[i], component[j]))
                component = {k: low if c == high else c for k, c in component.items()}
    return {i: (len(sets[i]), component[i]) for i in sets}


def corpus(seed):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdeé") for _ in range(4))
    passage = [word() for _ in range(40)]
    rows, i = [], 0
    for group in range(30):
        base = [word() for _ in range(draw.choice((3, 5, 6, 20, 80)))] + (passage if group % 3 == 0 else [])
        for _ in range(draw.choice((1, 1, 2, 5, 14))):
            own = list(base)
            for _ in range(draw.randrange(4)):
                own[draw.randrange(len(own))] = word()
            rows.append((i, draw.choice((" ", "\n", " \t ")).join(own)))
            i += 1
    rows += [(i, None), (i + 1, ""), (i + 2, " \n "), (i + 3, "One"), (i + 4, "one"), (i + 5, "ÉA b"), (i + 6, "éA b"), (i + 7, "w " * 20_000)]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,short,held", [(1, 8, 200_000), (2, 2, 3)])
def test_equals_all_pairs(spark, monkeypatch, seed, short, held):
    monkeypatch.setattr(op, "SHORT_LIST", short)
    monkeypatch.setattr(op, "HELD", held)
    monkeypatch.setattr(op, "BLOCK", 7 if held == 3 else op.BLOCK)
    rows = corpus(seed)
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, node int, key int")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op.ngram_join(docs).collect()}
    assert got == brute(rows)


def test_overlaps_are_counted_by_fragment(spark, monkeypatch):
    """Each fragment has n-grams of a large set, in rows of its own, and the partial counts add up to the overlap."""
    seen = []
    monkeypatch.setattr(op, "drop_tables", lambda *tables: seen.extend(tables))
    words = [f"w{i}" for i in range(2000)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:1900])), (3, " ".join(words[:1000]))], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in op.ngram_join(docs).collect()} == {1: 1, 2: 1, 3: 3}
    segments = next(x for x in seen if x is not None and "segment" in x.columns)
    rows = segments.collect()
    sizes = {}
    for r in rows:
        sizes.setdefault(r.node, {})[r.fragment] = set(r.segment)
    assert all(len(x) == op.FRAGMENTS for x in sizes.values())
    ranges = [(min(r.segment), max(r.segment)) for r in sorted(rows, key=lambda r: r.fragment)]
    assert all(a[1] < b[0] for a in ranges for b in ranges if ranges.index(a) // len(sizes) < ranges.index(b) // len(sizes))
    a, b = sorted(sizes.values(), key=lambda x: -sum(map(len, x.values())))[:2]
    assert sum(len(a[f] & b[f]) for f in range(op.FRAGMENTS)) == 1896


def test_null_and_repeated_ids_and_empty(spark):
    text = "a b c d e f g h"
    docs = spark.createDataFrame([(None, text), (4, text), (4, text), (2, text + " i j k l m n o"), (9, text)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id) for r in op.ngram_join(docs).collect()), key=str)
    assert got == [(2, 2), (4, 4), (4, 4), (9, 4), (None, None)]
    assert op.ngram_join(docs.where("false")).count() == 0
    unlike = spark.createDataFrame([(1, text, 7), (1, "quite another text of so many words", 8)], "doc_id long, text string, tag long")
    got = {r.tag: (r.component_id, r.group_id) for r in op.ngram_join(unlike, carry=("tag",)).collect()}
    assert got[7][0] == got[8][0] == 1 and got[7][1] != got[8][1]


def test_copies_form_a_class_before_the_lists(spark):
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words)) for i in range(500)] + [(900, " ".join(words[:-3]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    order = spark.sparkContext.broadcast(op._order(op._survey(docs, 5, [])))
    listed = op._list_rows(docs, 5, 75, order)
    assert listed.count() <= 202 and listed.groupBy("key").count().agg({"count": "max"}).first()[0] == 2
    assert {r.component_id for r in op.ngram_join(docs).collect()} == {0}


def test_bitmaps_differ_in_no_more_bits_than_the_sets():
    import numpy as np

    draw = np.random.default_rng(2)
    for n in (0, 1, 30, 700):
        a = np.unique(draw.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[: len(a) // 2], draw.integers(0, 1 << 63, n // 3, dtype=np.uint64)]))
        x, y = op._bitmaps([a, b])
        assert x.shape == (8,) and np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))
        assert n < 100 or np.bitwise_count(x ^ y).sum() > 100


def test_pairs_in_blocks_that_differ_in_sign_bits():
    """Bitmaps that differ in the top bit of a word: their difference is a negative number."""
    import numpy as np
    import pyarrow as pa

    sets = [np.arange(100, dtype=np.uint64) << np.uint64(20), np.delete(np.arange(102), [10, 56]).astype(np.uint64) << np.uint64(20)]
    words = op._bitmaps(sets)
    assert (words[0] ^ words[1]).min() < 0
    names = ("key", "i", "j", "block", "component", "node", "n", "last", "long", "position")
    rows = {x: np.zeros(2, dtype=np.int64) for x in names} | {"component": np.arange(2), "node": np.arange(2), "n": np.full(2, 100), "long": np.full(2, 26)}
    batch = pa.RecordBatch.from_arrays([*map(pa.array, rows.values()), *(pa.array(np.ascontiguousarray(x)) for x in words.T)], [*rows, *op.BITS])
    assert [r for b in op._pairs_in_blocks(iter([batch]), 75) for r in b.to_pylist()] == [{"a": 0, "b": 1}]


@pytest.mark.parametrize("seed", [3, 4])
def test_large_groups_of_near_copies(spark, seed):
    """Many versions about the similarity limit apart, in lists that no star and no neighbour settles."""
    draw = random.Random(seed)
    rows, i = [], 0
    for size in (200, 90):
        base = [f"w{draw.randrange(300)}" for _ in range(size)]
        for _ in range(60):
            own = list(base)
            for _ in range(draw.randrange(size // 22)):
                own[draw.randrange(size)] = f"w{draw.randrange(300)}"
            rows.append((i, " ".join(own)))
            i += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in op.ngram_join(docs).collect()} == brute(rows)


def test_lists_across_batches():
    import numpy as np
    import pyarrow as pa

    keys, nodes = np.repeat([1, 2, 3, 4], [12, 1, 3, 30]), np.r_[np.arange(12), [5], [1, 1, 2], np.arange(30)]
    place = np.where(nodes == 5, (1 << 32) + 6, 3)

    def run(size):
        batches = [pa.RecordBatch.from_arrays([pa.array(x[i : i + size]) for x in (keys, nodes, place)], ["key", "node", "place"]) for i in range(0, len(keys), size)]
        return {tuple(r.values()) for b in op._pairs_of_lists(iter(batches)) for r in b.to_pylist()}

    got = run(100)
    assert run(1) == run(7) == got
    assert got >= {(op.PAIR, 0, 1, 0), (op.PAIR, 0, 29, 0), (op.PAIR, 1, 2, 1), (op.LIST, 4, 0, 3), (op.LIST, 1, 5, 6), (op.LONG, 3, 0, 2), (op.LONG, 20, 0, 1), (op.LAST, 5, 2, 0)}
