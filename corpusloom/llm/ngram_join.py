"""Exact Jaccard join of documents on word n-grams, by vertical partitioning.

A document is the set of its n-grams, kept as 64-bit keys.  N-grams have one global order, which is the order of their
keys: first by how frequent they are, rare ones before frequent ones, then by hash.  Documents with equal sets are one
class and are compared once.

The global order is cut vertically into FRAGMENTS fragments that hold equal shares of all n-grams, and with it every set
is cut into segments, one a fragment.  The overlap of a candidate pair is counted in each fragment apart, in rows of their
own (pair, fragment), spread by (class, fragment); the partial counts are summed up per pair, and the sums decide.

Candidates come from the front of the order.  A set's prefix are its first n - ceil(t*n) + 1 n-grams; two sets with a
Jaccard similarity of t share one of those at least, so classes meet in the lists of their prefixes.  Short lists give all
their pairs, with the overlaps counted.  A long list gives the pairs with its first class, and in PROBES of its lists (those
of the n-grams with the least hashes, so like sets choose alike) each class gives the pair with the next one whose band of
BAND_HASHES least hashes is the same; that joins nearly all that belongs together.  Then members of long
lists that are still in different components are compared pair by pair: two sets that are similar enough have their first
common n-gram so far at the front of both that what is behind it suffices, so positions leave few pairs.  Thus no pair
that could matter is left out, and a group of near copies costs a few rows a member and not a row a pair.

The prefixes' count bounds the whole.  Of the two prefixes, the one that ends first in the global order lies in the range
of the other, so what it does not share there is not shared at all: the overlap is at most the shared n-grams of the
prefixes and that set's n-grams behind its prefix.  Pairs that cannot reach the similarity go.  (Shared n-grams in long
lists are counted as if all that both sets have there were shared.)

A second bound: every set has a bitmap of 512 bits, each the parity of the n-grams that fall on it.  Two bitmaps differ in no
more bits than the sets have n-grams apart, so pairs whose bitmaps differ too much go before their segments are fetched.

Frequencies are needed only to keep frequent n-grams out of candidate lists and to cut fragments of equal size: they are
counted over all documents in a sketch of SKETCH_CELLS cells, and every document sees the same cells, so the order is the
same everywhere and results do not depend on the sketch.

Keys take 58 bits of a hash.  A result is wrong only if two different n-grams of one pair of compared sets have the same
key: with 10,000 n-grams each, once in some 10^9 pairs.

Edge cases: a text with fewer words than n is one n-gram, its whole word sequence.  Null texts and texts without words
have the empty set and link with nothing.  Rows with a null doc_id get no component and join nothing.  Rows that repeat a
doc_id each count with their own set.  Empty tables give no rows; other columns than doc_id, text and those to carry are
ignored.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bitmap, bound_batches, drop_tables, in_bitmap, shared_table, spread
from .graph import connected_components

FRAGMENTS = 4
#: Long lists of a class in which it is compared with the next class of the same band there; bands, and least hashes of one.
PROBES, BANDS, BAND_HASHES = 3, 4, 4
#: Lists of so many classes give all their pairs at once.
SHORT_LIST = 8
SKETCH_CELLS, SKETCH_BLOCK = 1 << 22, 1 << 16
#: The bitmap of a set, in words of 64 bits.
BITS = tuple(f"bits{i}" for i in range(8))
#: A key has the level of the n-gram's frequency above HASH_BITS of its hash.
HASH_BITS = 58
BITMAP_BITS = 1 << 23
#: Rows of an output batch; members of a list that are held at once; members of a block.
ROWS, HELD, BLOCK = 100_000, 200_000, 1024
#: Classes that a task remembers, at some 100 bytes each.
CLASSES = 1 << 20


def prefix_size(n, percent: int):
    """N-grams of a set of n in its first fragment; n is a number or a column of them."""
    return n - (percent * n + 99) // 100 + 1


def shingles(text: str | None, n: int):
    """Sorted distinct 64-bit hashes of the word n-grams of a text.  A-Z are lower-cased; words are runs without ASCII
    blanks."""
    import numpy as np
    import xxhash

    words = text.encode().lower().split() if text else []
    k = min(n, len(words))
    if not k:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    out = np.full(len(words) - k + 1, k, dtype=np.uint64)
    for i in range(k):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + h[i : len(words) - k + 1 + i]
    out = (out ^ (out >> np.uint64(30))) * np.uint64(0x94D049BB133111EB)
    out ^= out >> np.uint64(31)
    out.sort()
    return out[np.r_[True, out[1:] != out[:-1]]]


def _cells(hashes):
    """The cell of the sketch of each hash: its top bits."""
    import numpy as np

    return hashes >> np.uint64(64 - SKETCH_CELLS.bit_length() + 1)


def _keys(hashes, levels):
    """The places of n-grams in the global order, unsorted."""
    import numpy as np

    level = np.minimum(levels[_cells(hashes)], 31).astype(np.uint64)
    return (level << np.uint64(HASH_BITS)) | (hashes >> np.uint64(64 - HASH_BITS))


def _digests(sets):
    """Two 64-bit hashes of each set, as signed numbers; nulls for empty sets."""
    import numpy as np
    import pyarrow as pa
    import xxhash

    empty = np.array([not len(x) for x in sets], dtype=bool)
    return [pa.array(np.array([xxhash.xxh3_64_intdigest(x.tobytes(), seed=k) for x in sets], dtype=np.uint64).view(np.int64), mask=empty) for k in (1, 2)]


def _bitmaps(sets):
    """A row of 64-bit words for each set: the parity of its hashes by nine of their bits."""
    import numpy as np

    width = 64 * len(BITS)
    place = (np.concatenate(sets) >> np.uint64(20)).astype(np.int64) % width + np.repeat(np.arange(len(sets)) * width, [len(x) for x in sets])
    odd = np.bincount(place, minlength=len(sets) * width).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64).reshape(len(sets), len(BITS))


def _survey(docs: DataFrame, n: int, carry: list[str]) -> DataFrame:
    """Written table of two kinds of rows: doc_id, the carried columns, n, node, check, BITS of each document (node and
    check: hashes of its set, null if it is empty; its bitmap), and block, counts of the frequency sketch, by task."""
    import numpy as np
    import pyarrow as pa

    def run(batches):
        cells, fields = np.zeros(SKETCH_CELLS, dtype=np.uint32), None
        for batch in batches:
            fields = [batch.schema.field(i).type for i in range(batch.num_columns) if i != 1]
            for at in range(0, batch.num_rows, 250):
                part = batch.slice(at, 250)
                sets = [shingles(x, n) for x in part.column(1).to_pylist()]
                np.add.at(cells, _cells(np.concatenate(sets)), 1)
                given = [part.column(i) for i in range(batch.num_columns) if i != 1]
                words = [pa.array(np.ascontiguousarray(x)) for x in _bitmaps(sets).T]
                yield pa.RecordBatch.from_arrays([*given, pa.array([len(x) for x in sets], pa.int64()), *_digests(sets), *words, pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())], names)
        if fields:
            blocks = [i for i in range(SKETCH_CELLS // SKETCH_BLOCK) if cells[i * SKETCH_BLOCK : (i + 1) * SKETCH_BLOCK].any()]
            packed = [zlib.compress(cells[i * SKETCH_BLOCK : (i + 1) * SKETCH_BLOCK].tobytes(), 1) for i in blocks]
            yield pa.RecordBatch.from_arrays([*(pa.nulls(len(blocks), x) for x in [*fields, *[pa.int64()] * (3 + len(BITS))]), pa.array(blocks, pa.int32()), pa.array(packed, pa.binary())], names)

    names = ["doc_id", *carry, "n", "node", "check", *BITS, "block", "counts"]
    given = "".join(f"`{x}` {docs.schema[x].dataType.simpleString()}, " for x in carry)
    return shared_table(docs.select("doc_id", "text", *carry).mapInArrow(run, f"doc_id long, {given}n long, node long, check long, " + "".join(f"{x} long, " for x in BITS) + "block int, counts binary"), "ngram-survey")


def _order(survey: DataFrame):
    """The global order: a level for each cell of the sketch (0 for usual frequencies, then a step for each doubling), and
    the first keys of all fragments but the first.  The driver gets a byte a cell, whatever the input."""
    import numpy as np
    import pyarrow as pa

    total = survey.agg(F.sum("n")).first()[0] or 0
    usual = 2 * total / SKETCH_CELLS + 16

    def levels(batches):
        sums: dict[int, object] = {}
        for batch in batches:
            for block, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts = np.frombuffer(zlib.decompress(raw), dtype=np.uint32).astype(np.int64)
                sums[block] = sums[block] + counts if block in sums else counts
        steps = {k: np.where(x <= usual, 0, 1 + np.log2(np.maximum(x, usual) / usual).astype(np.int64)).astype(np.uint8) for k, x in sums.items()}
        mass = [np.bincount(np.minimum(steps[k], 31), weights=x, minlength=32).tolist() for k, x in sums.items()]
        yield pa.RecordBatch.from_arrays([pa.array(list(steps), pa.int32()), pa.array([x.tobytes() for x in steps.values()], pa.binary()), pa.array(mass, pa.list_(pa.float64()))], ["block", "levels", "mass"])

    out, mass = np.zeros(SKETCH_CELLS, dtype=np.uint8), np.zeros(32)
    merged = survey.where("block is not null").select("block", "counts").repartition("block")
    for row in merged.mapInArrow(levels, "block int, levels binary, mass array<double>").collect():
        out[row.block * SKETCH_BLOCK : (row.block + 1) * SKETCH_BLOCK] = np.frombuffer(row.levels, dtype=np.uint8)
        mass += row.mass
    before = np.concatenate([[0.0], np.cumsum(mass)])
    wanted = before[-1] * np.arange(1, FRAGMENTS) / FRAGMENTS
    level = np.clip(np.searchsorted(before, wanted, "right") - 1, 0, 31)
    within = (wanted - before[level]) / np.maximum(mass[level], 1)
    cuts = (level.astype(np.uint64) << np.uint64(HASH_BITS)) + (np.clip(within, 0, 1) * ((1 << HASH_BITS) - 1)).astype(np.uint64)
    return out, cuts


#: Odd factors of hashes, one for each of the least hashes of all bands, and one more.
FACTORS = [(0x9E3779B97F4A7C15 * (2 * k + 1) ^ (0xD6E8FEB86659FD93 << k)) % (1 << 64) | 1 for k in range(BANDS * BAND_HASHES + 1)]


def _bands(keys):
    """29 bits for each band: equal for two sets with the probability of their similarity to the power of BAND_HASHES."""
    import numpy as np

    factors = np.array(FACTORS[:-1], dtype=np.uint64)
    least = np.full(len(factors), np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(keys), 4096):
        least = np.minimum(least, (keys[at : at + 4096, None] * factors[None, :]).min(axis=0))
    mixed = np.zeros(BANDS, dtype=np.uint64)
    for x in least.reshape(BANDS, BAND_HASHES).T:
        mixed = (mixed ^ (x >> np.uint64(17)) ^ x) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(35)).astype(np.int64)


def _list_rows(docs: DataFrame, n: int, percent: int, order) -> DataFrame:
    """(key, node, place) rows: each class in the lists of its prefix.  place: bits 0 to 31 the position in the prefix, bit 32
    whether it is the last one, bit 33 whether the class is compared with a neighbour there, bits 34 to 62 its band.

    Classes form before the lists: a task gives the rows of a class once, however many copies of a document it reads (it
    remembers CLASSES of them; a class that comes again after that only gives its rows again)."""
    import numpy as np
    import pyarrow as pa
    import xxhash

    def run(batches):
        levels, seen = order.value[0], set()
        for batch in batches:
            for at in range(0, batch.num_rows, 250):
                sets = {}
                for x in (shingles(t, n) for t in batch.column(1).slice(at, 250).to_pylist()):
                    name = xxhash.xxh3_128_digest(x.tobytes())
                    if len(x) and name not in seen:
                        seen.add(name)
                        sets[name] = x
                if len(seen) > CLASSES:
                    seen.clear()
                if not sets:
                    continue
                sets = list(sets.values())
                keys, place, sizes = [], [], [prefix_size(len(x), percent) for x in sets]
                for x, k in zip(sets, sizes, strict=True):
                    every = _keys(x, levels)
                    first = np.sort(np.partition(every, k - 1)[:k])
                    own = np.arange(k)
                    own[-1] |= 1 << 32
                    drawn = first * np.uint64(FACTORS[-1])
                    chosen = np.argpartition(drawn, PROBES)[:PROBES] if k > PROBES else np.arange(k)
                    own[chosen] |= (1 << 33) | (_bands(every)[(drawn[chosen] % np.uint64(BANDS)).astype(np.int64)] << 34)
                    keys.append(first)
                    place.append(own)
                place = np.concatenate(place)
                nodes = np.repeat(_digests(sets)[0].to_numpy(), sizes)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(nodes), pa.array(place)], ["key", "node", "place"])

    return docs.select("doc_id", "text").mapInArrow(run, "key long, node long, place long")


PAIR, LIST, LONG, LAST = range(4)


def _pairs_of_lists(batches):
    """From (key, node, place) rows sorted by key and node: rows (kind, a, b, n).

    PAIR: classes a and b, and how often they met in short lists; 0 for pairs from long lists.  LIST: key a of a long list
    has class b, whose position in its prefix is n.  LONG: class a is in n long lists.  LAST: the prefix of class a ends at
    key b.
    """
    import numpy as np
    import pyarrow as pa

    pairs, lists, longs, seen = [], [], [], set()

    def rows(kind, a, b, n):
        for i in range(0, len(a), ROWS):
            part = [np.ascontiguousarray(x[i : i + ROWS]) for x in (np.full(len(a), kind, dtype=np.int8), a, b, n)]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, part)), ["kind", "a", "b", "n"])

    def flush():
        if pairs:
            a, b, n = map(np.concatenate, zip(*pairs, strict=True))
            pairs.clear()
            turn = np.lexsort((b, a))
            a, b, n = a[turn], b[turn], n[turn]
            starts = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
            yield from rows(PAIR, a[starts], b[starts], np.add.reduceat(n, starts))
        if lists:
            a, b, n = map(np.concatenate, zip(*lists, strict=True))
            lists.clear()
            yield from rows(LIST, a, b, n)
        if longs:
            nodes, n = np.unique(np.concatenate(longs), return_counts=True)
            longs.clear()
            yield from rows(LONG, nodes, np.zeros_like(nodes), n)

    def like(value, array):
        return np.full(len(array), value, dtype=np.int64)

    def star(key, leader, members, places):
        others = members[members != leader]
        pairs.append((like(leader, others), others, like(0, others)))
        lists.append((like(key, members), members, places & 0xFFFFFFFF))

    def probes(nodes, places):
        on = (places >> 33) & 1 == 1
        nodes, band = nodes[on], places[on] >> 34
        turn = np.lexsort((nodes, band))
        nodes, band = nodes[turn], band[turn]
        same = band[1:] == band[:-1]
        pairs.append((nodes[:-1][same], nodes[1:][same], like(0, nodes[1:][same])))

    def take(keys, nodes, places, going_on):
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, dtype=int)
        lengths = np.diff(np.r_[starts, len(keys)])
        if going_on and len(keys) and keys[0] == going_on[0]:
            star(*going_on, nodes[: lengths[0]], places[: lengths[0]])
            probes(nodes[: lengths[0]], places[: lengths[0]])
            longs.append(nodes[: lengths[0]])
            starts, lengths = starts[1:], lengths[1:]
        for m in range(2, SHORT_LIST + 1):
            at = starts[lengths == m]
            for i in range(m - 1):
                for j in range(i + 1, m):
                    if len(at):
                        pairs.append((nodes[at + i], nodes[at + j], like(1, at)))
        for s, m in zip(starts[lengths > SHORT_LIST].tolist(), lengths[lengths > SHORT_LIST].tolist(), strict=True):
            members = nodes[s : s + m]
            longs.append(members)
            probes(members, places[s : s + m])
            known = hash(members.tobytes())  # the lists of a group of copies have the same members
            if known not in seen:
                if len(seen) > HELD:
                    seen.clear()
                seen.add(known)
                star(keys[s], members[0], members, places[s : s + m])

    held_keys = held_nodes = held_places = np.zeros(0, dtype=np.int64)
    going_on = None
    for batch in batches:
        keys, nodes, places = (c.to_numpy() for c in batch.columns)
        last = (places >> 32) & 1 == 1
        yield from rows(LAST, nodes[last], keys[last], np.zeros(int(last.sum()), dtype=np.int64))
        keys, nodes, places = np.concatenate([held_keys, keys]), np.concatenate([held_nodes, nodes]), np.concatenate([held_places, places])
        fresh = np.r_[True, (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])] if len(keys) else np.zeros(0, dtype=bool)
        keys, nodes, places = keys[fresh], nodes[fresh], places[fresh]
        end = np.searchsorted(keys, keys[-1]) if len(keys) else 0
        take(keys[:end], nodes[:end], places[:end], going_on)
        if end and going_on:
            going_on = None
        held_keys, held_nodes, held_places = keys[end:], nodes[end:], places[end:]
        if len(held_keys) > HELD:  # a very long list: its members so far, but for the last
            if going_on is None:
                going_on = (held_keys[0], held_nodes[0])
            star(*going_on, held_nodes[:-1], held_places[:-1])
            probes(held_nodes[:-1], held_places[:-1])
            longs.append(held_nodes[:-1])
            held_keys, held_nodes, held_places = held_keys[-1:], held_nodes[-1:], held_places[-1:]
        if sum(len(x[0]) for x in pairs + lists) + sum(map(len, longs)) > 5 * ROWS:
            yield from flush()
    take(held_keys, held_nodes, held_places, going_on)
    yield from flush()


def _segments(docs: DataFrame, wanted: bytes, n: int, order) -> DataFrame:
    """Written table (node, check, fragment, segment) of the documents in a bitmap of ids: a row a fragment in which the
    set has n-grams."""
    import numpy as np
    import pyarrow as pa

    bits = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        levels, cuts = order.value
        for batch in batches:
            batch = batch.filter(pa.array(in_bitmap(bits.value, batch.column(0).to_numpy()), pa.bool_()))
            for at in range(0, batch.num_rows, 250):
                sets = [x for x in (shingles(t, n) for t in batch.column(1).slice(at, 250).to_pylist()) if len(x)]
                if not sets:
                    continue
                keys = [np.sort(_keys(x, levels)) for x in sets]
                ends = np.array([[0, *np.searchsorted(k, cuts), len(k)] for k in keys], dtype=np.int64)
                sizes = np.diff(ends, axis=1)
                has = sizes > 0
                offsets = np.r_[0, np.cumsum(sizes[has])]  # segments lie one behind the other, document by document
                of, fragment = np.nonzero(has)
                node, check = (x.take(pa.array(of)) for x in _digests(sets))
                yield pa.RecordBatch.from_arrays([node, check, pa.array(fragment.astype(np.int32)), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(keys).view(np.int64)))], ["node", "check", "fragment", "segment"])

    cut = docs.select("doc_id", "text").where("doc_id is not null").mapInArrow(run, "node long, check long, fragment int, segment array<long>")
    out = shared_table(cut, "segments")
    bits.destroy()
    return out


def _bounded(percent: int, a: str = "a", b: str = "b", met: Column | int = 0) -> Column:
    """The condition that two sets can be similar enough, by their sizes n, the ends of their prefixes last, their n-grams
    in long lists long, how often they met in short lists, and how far their bitmaps are apart.  Columns end in _a and _b."""
    n, last, long = ({x: F.col(f"{name}_{x}") for x in (a, b)} for name in ("n", "last", "long"))
    sizes = F.least(n[a], n[b]) * 100 >= F.greatest(n[a], n[b]) * percent
    ends_first = F.when(last[a] <= last[b], n[a]).otherwise(n[b])
    most = met + F.least(long[a], long[b]) + F.floor((ends_first * percent + 99) / 100) - 1
    needed = F.ceil((n[a] + n[b]) * percent / (100 + percent))
    apart = sum((F.bit_count(F.col(f"{x}_{a}").bitwiseXOR(F.col(f"{x}_{b}"))) for x in BITS), F.lit(0))
    return sizes & (most * (100 + percent) >= (n[a] + n[b]) * percent) & (apart <= n[a] + n[b] - 2 * needed)


def _candidates(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Written table of the pairs of classes that can be similar enough, from pairs of nodes (a, b, met: times that they
    met in short lists)."""
    names = ("id", "doc", "check", "n", "last", "long", *BITS)
    side = {x: classes.select(F.col("node").alias(x), *(F.col(k).alias(f"{k}_{x}") for k in names)) for x in "ab"}
    met = pairs.join(side["a"], "a").join(side["b"], "b").where((F.col("id_a") != F.col("id_b")) & _bounded(percent, met=F.col("met")))
    return shared_table(met.select("a", "b", *(f"{k}_{x}" for k in names[:4] for x in "ab")), "ngram-pairs")


def _similar(docs: DataFrame, wanted: DataFrame, n: int, percent: int, order) -> DataFrame:
    """Written table (a, b) of the ids of classes, of the candidates whose overlap is large enough: it is counted in each
    fragment apart, and the partial counts are summed up."""
    none = wanted.select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))
    if wanted.isEmpty():
        return none
    docs_of = wanted.select(F.col("doc_a").alias("doc")).union(wanted.select(F.col("doc_b").alias("doc"))).distinct()
    segments = _segments(docs, bitmap(docs_of, "doc", BITMAP_BITS), n, order)

    def of(x):
        return segments.select(F.col("node").alias(x), F.col("check").alias(f"check_{x}"), "fragment", F.col("segment").alias(f"segment_{x}"))

    met = wanted.join(of("a"), ["a", "check_a"]).join(of("b"), ["b", "check_b", "fragment"])
    pair = ["id_a", "id_b", "n_a", "n_b"]
    partial = met.select(*pair, "fragment", F.size(F.array_intersect("segment_a", "segment_b")).alias("both"))
    # A document that is there twice gives the same partial count twice.
    total = partial.groupBy(*pair, "fragment").agg(F.max("both").alias("both")).groupBy(*pair).agg(F.sum("both").alias("overlap"))
    similar = F.col("overlap") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("overlap")) * percent
    out = shared_table(total.where(similar).select(F.col("id_a").alias("a"), F.col("id_b").alias("b")), "ngram-links")
    drop_tables(segments)
    return out


MEMBER = ("node", "n", "last", "long", "position", *BITS)


def _reachable(i: dict, j: dict, percent: int):
    """Whether two sets of different components can be similar enough, if a list is their first common one.  Arrays by name.

    What they share lies at and behind their positions there; and it is at most the n-grams of long lists, and what the set
    whose prefix ends first has behind it (see _bounded).
    """
    import numpy as np

    n = i["n"] + j["n"]
    behind = np.minimum(i["n"] - i["position"], j["n"] - j["position"])
    ends_first = np.where(i["last"] <= j["last"], i["n"], j["n"])
    most = np.minimum(behind, np.minimum(i["long"], j["long"]) + (ends_first * percent + 99) // 100 - 1)
    sizes = np.minimum(i["n"], j["n"]) * 100 >= np.maximum(i["n"], j["n"]) * percent
    return sizes & (most * (100 + percent) >= n * percent) & (i["component"] != j["component"])


def _pairs_in_blocks(batches, percent: int):
    """(a, b) nodes of pairs that can be similar enough, from rows (key, i, j, block, component, *MEMBER) sorted by key, i, j.

    A group is a list, or a pair of blocks of a long one; pairs within a block are taken where i and j are the same.
    """
    import numpy as np
    import pyarrow as pa

    names, found = ("block", "component", *MEMBER), []

    def flush():
        if found:
            a, b = map(np.concatenate, zip(*found, strict=True))
            found.clear()
            turn = np.lexsort((b, a))
            a, b = a[turn], b[turn]
            fresh = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
            a, b = a[fresh], b[fresh]
            for at in range(0, len(a), ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x[at : at + ROWS])) for x in (a, b)], ["a", "b"])

    def take(group, same):
        x = dict(zip(names, group, strict=True))
        for at in range(0, len(x["node"]), 256):
            part = {k: v[at : at + 256, None] for k, v in x.items()}
            whole = {k: v[None, :] for k, v in x.items()}
            fits = (part["node"] < whole["node"]) & _reachable(part, whole, percent)
            if not same:
                fits &= part["block"] != whole["block"]
            i, j = np.nonzero(fits)
            both = x["n"][at + i] + x["n"][j]
            # unsigned: of a negative number numpy counts the bits of its absolute value
            apart = sum((np.bitwise_count((x[w][at + i] ^ x[w][j]).view(np.uint64)).astype(np.int64) for w in BITS), np.zeros(len(i), dtype=np.int64))
            near = apart <= both - 2 * -(-both * percent // (100 + percent))
            if near.any():
                found.append((x["node"][at + i[near]], x["node"][j[near]]))

    held = [np.zeros(0, dtype=np.int64)] * (len(names) + 3)
    for batch in batches:
        held = [np.concatenate([h, c.to_numpy()]) for h, c in zip(held, batch.columns, strict=True)]
        if not len(held[0]):
            continue
        new = (held[0][1:] != held[0][:-1]) | (held[1][1:] != held[1][:-1]) | (held[2][1:] != held[2][:-1])
        borders = [0, *(np.flatnonzero(new) + 1).tolist()]
        for a, b in zip(borders, borders[1:], strict=False):
            take([h[a:b] for h in held[3:]], held[1][a] == held[2][a])
        held = [h[borders[-1] :] for h in held]
        if sum(len(x[0]) for x in found) > 5 * ROWS:
            yield from flush()
    if len(held[0]):
        take([h for h in held[3:]], held[1][0] == held[2][0])
    yield from flush()


def _open_pairs(members: DataFrame, components: DataFrame, percent: int) -> DataFrame:
    """Written table (a, b, met) of nodes that share a long list (members: key, id, *MEMBER), are in different components and
    can be similar enough.  Lists over BLOCK members are cut into blocks, and pairs of blocks are groups of their own."""
    rows = members.join(components.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    rows = shared_table(rows.select("key", "component", *MEMBER), "labelled-lists")
    keys = rows.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.ceil(F.count("*") / BLOCK).cast("long").alias("blocks"))
    placed = rows.join(keys.where("low < high").select("key", "blocks"), "key").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    sorted_rows = dealt.select("key", "i", "j", "block", "component", *MEMBER).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    found = sorted_rows.mapInArrow(lambda batches: _pairs_in_blocks(batches, percent), "a long, b long")
    out = shared_table(found.distinct().withColumn("met", F.lit(0).cast("long")), "open-pairs")
    drop_tables(rows)
    return out


def ngram_join(docs: DataFrame, n: int = 5, percent: int = 75, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the carried columns of docs, n_shingles, component_id, set_id, group_id for each row of docs (doc_id, text).

    component_id is the smallest doc_id reachable by links.  set_id is the same for rows with equal sets only, and group_id
    for rows that are reachable from each other only, even where groups share a doc_id; both are null for empty sets and
    null doc_ids.
    """
    bound_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *carry)
    survey = _survey(docs, n, list(carry))
    found_order = _order(survey)
    order = docs.sparkSession.sparkContext.broadcast(found_order)
    rows = survey.where("block is null").select("doc_id", *carry, "n", "node", "check", *BITS)
    listed = _list_rows(docs, n, percent, order).repartition("key").sortWithinPartitions("key", "node")
    found = shared_table(listed.mapInArrow(_pairs_of_lists, "kind byte, a long, b long, n long"), "ngram-lists")
    facts = found.where(F.col("kind").isin(LONG, LAST)).groupBy(F.col("a").alias("node")).agg(F.max(F.when(F.col("kind") == LAST, F.col("b"))).alias("last"), F.sum("n").alias("long"))
    named = rows.where("node is not null and doc_id is not null").groupBy("node", "check", "n").agg(F.min("doc_id").alias("doc"), *(F.min(x).alias(x) for x in BITS))
    classes = shared_table(named.join(facts, "node").withColumn("id", F.monotonically_increasing_id()), "ngram-classes")
    met = found.where(F.col("kind") == PAIR).groupBy("a", "b").agg(F.sum("n").alias("met"))
    wanted = _candidates(met, classes, percent)
    links = _similar(docs, wanted, n, percent, order)
    components = connected_components(links)
    lists = found.where(F.col("kind") == LIST).select(F.col("a").alias("key"), F.col("b").alias("node"), F.col("n").alias("position"))
    members = lists.join(classes.select("node", "id", "n", "last", "long", *BITS), "node").select("key", "id", *MEMBER)
    fresh = _open_pairs(members, components, percent).join(wanted.select("a", "b"), ["a", "b"], "left_anti")
    more_wanted = _candidates(fresh, classes, percent)
    more = _similar(docs, more_wanted, n, percent, order)
    # Links between components make larger ones; what they join is small beside all links.
    at = {x: components.select(F.col("node").alias(x), F.col("component").alias(f"to_{x}")) for x in "ab"}
    between = more.join(at["a"], "a", "left").join(at["b"], "b", "left").select(F.coalesce("to_a", "a").alias("a"), F.coalesce("to_b", "b").alias("b"))
    merged = connected_components(between).select(F.col("node").alias("old"), F.col("component").alias("new"))
    known = classes.join(components.withColumnRenamed("node", "id"), "id", "left").withColumn("old", F.coalesce("component", "id")).join(merged, "old", "left")
    own = shared_table(known.select("id", "node", "check", "doc", F.coalesce("new", "old").alias("component")), "ngram-components")
    first = own.groupBy("component").agg(F.min("doc").alias("first"))
    named_own = shared_table(own.join(first, "component").select("node", "check", F.col("id").alias("set_id"), F.col("component").alias("group_id"), F.col("first").alias("component_id")), "ngram-classes-named")
    labelled = rows.drop(*BITS).withColumnRenamed("n", "n_shingles").join(named_own, ["node", "check"], "left")
    order.destroy()
    drop_tables(found, classes, wanted, links, more_wanted, more, own)
    has_id = F.col("doc_id").isNotNull()
    return labelled.select("doc_id", *carry, "n_shingles", F.when(has_id, F.coalesce("component_id", "doc_id")).alias("component_id"), F.when(has_id, F.col("set_id")).alias("set_id"), F.when(has_id, F.col("group_id")).alias("group_id"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: components of all documents at a Jaccard similarity of 0.75 on five words."""
    return ngram_join(spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))).select("doc_id", "n_shingles", "component_id")
