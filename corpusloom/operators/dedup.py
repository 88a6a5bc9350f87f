"""Exact and near duplicates with first-wins semantics.

A document is a duplicate of an earlier *kept* one: of the first with the same content hash, or else of the one with the
most similar MinHash signature among those that share a band, if the similarity reaches the threshold.  Dropped documents
never drop others, so this is not connected components.

Equal documents are one entry.  Kept entries are found in three steps.

1. While a band has over SMALL_BAND entries, rounds: an entry that is the first undecided one in all its bands has met every
   kept entry before it, so it is kept; all others of its bands are compared with it, and drop out if they are similar.  A
   round makes a row for each undecided entry of a band at most, and large groups of copies are gone after one.  Rounds end
   when one decides less than a ROUND_SHARE.
2. What is left in a band is compared within pairs of blocks of BLOCK entries, and only pairs that are similar make a row.
3. Components of similar pairs are decided apart from each other: each in one walk over its pairs in their order, which
   keeps no more than the entries dropped so far.  So a chain of any number of versions needs no rounds.  Of a component of
   over WALK_PAIRS pairs a round decides the first entries, which takes it apart; then its components are formed again.

Dropped entries go with their most similar kept one.  Those of step 3 have it among the similar pairs; those of step 1 meet
the kept ones of their bands, again in pairs of blocks, and only the best ones make rows.  So no task holds more than two
blocks or a walk, and a band of entries that are not similar makes no rows, however many they are.  A block is moved once
for each block it meets, so BLOCK is as large as two of them fit a task: signatures are four bytes a permutation there.
"""

from __future__ import annotations

import random
import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import content_hash, hash_form
from ..staging import bound_batches, drop_tables, shared_table
from .components import connected

# Permutations, bands, words of a shingle, similarity threshold, and the seed of the permutations.
PERMUTATIONS, BANDS, SHINGLE_WORDS, THRESHOLD, SEED = 128, 16, 5, 0.85, 20260721
PRIME, HASH_MAX = (1 << 61) - 1, (1 << 32) - 1
#: Hashes that are permuted at once; entries of a block; rounds go on while one decides such a share of the rows.
STEP_HASHES, BLOCK, ROUND_SHARE = 32_768, 4096, 0.5
#: Bands of more entries are worth rounds; pairs of a component that one task walks.
SMALL_BAND, WALK_PAIRS = 64, 2_000_000


def permutations(n: int = PERMUTATIONS, seed: int = SEED) -> list[tuple[int, int]]:
    """Factor and offset of each permutation."""
    draw = random.Random(seed)
    return [(draw.randint(1, PRIME - 1), draw.randint(0, PRIME - 1)) for _ in range(n)]


def shingle_hashes(form: str, size: int = SHINGLE_WORDS):
    """crc32 hashes of the word shingles of a text in hash form; few words make one shingle.

    Words are parted by single blanks, so a shingle is a slice of the text.
    """
    import numpy as np

    raw = form.encode()
    if not raw:
        return np.zeros(0, dtype=np.uint64)
    blanks = np.flatnonzero(np.frombuffer(raw, dtype=np.uint8) == 32)
    starts, ends = np.r_[0, blanks + 1], np.r_[blanks, len(raw)]
    most = min(size, len(starts))
    cuts = map(slice, starts[: len(starts) - most + 1].tolist(), ends[most - 1 :].tolist())
    return np.fromiter(map(zlib.crc32, map(raw.__getitem__, cuts)), dtype=np.uint64, count=len(starts) - most + 1)


def signatures_of(sets, factors, offsets):
    """A row for each set of hashes: the least permuted hash of each permutation.

    The hashes of all sets lie one behind the other and are read in steps that fit a processor's cache.  a*s + b modulo
    2^61-1 in 64 bits: a = high*2^29 + low, a product with 2^29 is a rotation of 61 bits, and what is above 61 bits counts as
    ones.
    """
    import numpy as np

    prime, low32, low29, one = np.uint64(PRIME), np.uint64(HASH_MAX), np.uint64((1 << 29) - 1), np.uint64(1)
    shift = {k: np.uint64(k) for k in (29, 32, 61)}
    out = np.full((len(factors), len(sets)), HASH_MAX, dtype=np.uint32)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    flat = np.concatenate(sets) if len(owner) else np.zeros(0, dtype=np.uint64)
    for at in range(0, len(flat), STEP_HASHES):
        s, own = flat[at : at + STEP_HASHES], owner[at : at + STEP_HASHES]
        starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        rows = own[starts]
        top, rest = (np.empty_like(s) for _ in range(2))
        for i, (a, b) in enumerate(zip(factors, offsets, strict=True)):
            np.multiply(s, a >> shift[29], out=top)
            np.right_shift(top, shift[32], out=rest)
            np.bitwise_and(top, low32, out=top)
            np.left_shift(top, shift[29], out=top)
            np.add(top, rest, out=top)
            np.multiply(s, a & low29, out=rest)
            np.add(top, rest, out=top)
            np.add(top, b, out=top)
            np.right_shift(top, shift[61], out=rest)
            np.bitwise_and(top, prime, out=top)
            np.add(top, rest, out=top)
            if top.max() >= prime:  # hardly ever: the prime itself and what is above it lose the prime
                np.add(top, one, out=rest)
                np.right_shift(rest, shift[61], out=rest)
                np.add(top, rest, out=top)
            out[i, rows] = np.minimum(out[i, rows], np.minimum.reduceat(top.astype(np.uint32), starts))
    return out.T.astype(np.int64)


def minhash(form: Column, n: int = PERMUTATIONS, seed: int = SEED, size: int = SHINGLE_WORDS) -> Column:
    """array<long>: the signature of a text in hash form; of one without words the largest hash everywhere.  Null for null."""
    import numpy as np

    factors, offsets = (np.array(x, dtype=np.uint64) for x in zip(*permutations(n, seed)))

    @F.arrow_udf("array<long>")
    def run(texts):
        import pyarrow as pa

        found = [signatures_of([shingle_hashes(t or "", size) for t in texts.slice(i, 250).to_pylist()], factors, offsets) for i in range(0, len(texts), 250)]
        flat = np.concatenate(found).ravel() if found else np.zeros(0, dtype=np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * n, pa.int32()), pa.array(flat))
        return lists if not texts.null_count else pa.array([x if ok else None for x, ok in zip(lists.to_pylist(), texts.is_valid().to_pylist(), strict=True)], pa.list_(pa.int64()))

    return run(form)


def similarity(a: Column, b: Column) -> Column:
    """Share of equal places of two signatures."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x) / F.size(a)


def _bands(signature: Column, bands: int) -> Column:
    rows = F.size(signature) / bands
    return F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.struct(i.alias("band"), F.slice(signature, (i * rows + 1).cast("int"), rows.cast("int")).alias("values")))


def _met_in_blocks(one: DataFrame, other: DataFrame | None, signatures: DataFrame, keep, schema: str) -> DataFrame:
    """keep(orders, limits, signatures of a block of `one`; orders, signatures of a block of `other`; whether both are the
    same block) of all pairs of blocks of each band, as a table of the schema.

    one: key, ord, top; other: key, ord, or None for pairs of blocks of `one` itself, each once.  A band of over BLOCK
    entries on a side is dealt to blocks by hash, so the groups of any band are small.
    """
    import numpy as np
    import pyarrow as pa

    def blocks_of(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(name))

    def placed(rows: DataFrame, mine: str, own: Column, theirs: str, met: Column, side: int) -> DataFrame:
        dealt = rows.join(blocks, "key").withColumn("own", own).select("key", "ord", "top", F.col("own").alias(mine), F.explode(met).alias(theirs))
        return dealt.select("key", "one", "other", F.lit(side).alias("side"), "ord", "top").join(signatures, "ord")

    def block(n: str) -> Column:
        return F.pmod(F.xxhash64("ord"), F.col(n)).cast("int")

    def up_to(n: str) -> Column:
        return F.sequence(F.lit(0), F.col(n) - 1)

    if other is None:
        blocks = shared_table(blocks_of(one, "n_one"), "band-blocks")
        rows = placed(one, "one", block("n_one"), "other", F.sequence(F.col("own"), F.col("n_one") - 1), 0)
        rows = rows.unionByName(placed(one, "other", block("n_one"), "one", F.sequence(F.lit(0), F.col("own")), 1))
    else:
        blocks = shared_table(blocks_of(one, "n_one").join(blocks_of(other, "n_other"), "key"), "band-blocks")
        rows = placed(one, "one", block("n_one"), "other", up_to("n_other"), 0)
        rows = rows.unionByName(placed(other.withColumn("top", F.lit(None).cast("long")), "other", block("n_other"), "one", up_to("n_one"), 1))
    grouped = rows.select("key", "one", "other", "side", "ord", "top", "signature").repartition("key", "one", "other").sortWithinPartitions("key", "one", "other", "side")

    alone = other is None

    def run(batches):
        held = None
        for batch in [*batches_and_end(batches)]:
            table = batch if held is None else (held if batch is None else pa.concat_tables([held, batch]))
            if table is None:
                continue
            group = np.column_stack([table[c].to_numpy() for c in ("key", "one", "other")])
            starts = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]).any(axis=1)]) if len(group) else np.zeros(0, dtype=int)
            ends = np.r_[starts[1:], len(group)]
            done = len(starts) if batch is None else len(starts) - 1
            side, orders, tops = table["side"].to_numpy(), table["ord"].to_numpy(), table["top"].to_numpy(zero_copy_only=False)
            flat = table["signature"].combine_chunks()
            matrix = flat.flatten().to_numpy().reshape(len(table), -1) if len(table) else None
            out = []
            for a, b in zip(starts[:done].tolist(), ends[:done].tolist(), strict=True):
                m = a + int(np.searchsorted(side[a:b], 1))
                if a < m < b:
                    out.append(keep(orders[a:m], tops[a:m], matrix[a:m], orders[m:b], matrix[m:b], alone and group[a, 1] == group[a, 2]))
            held = table.slice(int(starts[done])) if done < len(starts) else None
            for found in out:
                yield from found.to_batches()

    def batches_and_end(batches):
        for batch in batches:
            yield pa.Table.from_batches([batch])
        yield None

    return grouped.mapInArrow(run, schema)


def _shares(one, other):
    """Share of equal places of each row of one signature matrix with each of another, and which places those are."""
    import numpy as np

    for at in range(0, len(one), 32):
        same = one[at : at + 32, None, :] == other[None, :, :]
        yield at, same.mean(axis=2, dtype=np.float64), same


def _signed(docs: DataFrame, order: str, text: str, n: int) -> DataFrame:
    """Written table given (the order as it is), ord (as a long), hash and signature of each document."""
    bound_batches(docs.sparkSession)
    forms = docs.select(F.col(order).alias("given"), F.col(order).cast("long").alias("ord"), F.coalesce(hash_form(F.col(text)), F.lit("")).alias("form"))
    return shared_table(forms.select("given", "ord", F.sha2("form", 256).alias("hash"), minhash(F.col("form"), n).alias("signature")), "signatures")


def signatures(docs: DataFrame, order: str = "ord", text: str = "text", n: int = PERMUTATIONS) -> DataFrame:
    """The signatures of documents, for greedy_duplicates."""
    return _signed(docs, order, text, n)


def _banded(entries: DataFrame, bands: int) -> DataFrame:
    """key, ord of each band of the entries' signatures."""
    return entries.select("ord", F.explode(_bands(F.col("signature"), bands)).alias("b")).select(F.xxhash64("b.band", "b.values").alias("key"), "ord")


def _short(signature: Column) -> Column:
    """A signature in four bytes a place; equal places stay equal."""
    return F.transform(signature, lambda x: (x - (1 << 31)).cast("int"))


def _in_rounds(crowd: DataFrame, signatures: DataFrame, threshold: float) -> tuple[DataFrame, list[DataFrame]]:
    """(bands of entries left undecided, tables of those dropped): rounds while bands are large and it pays."""
    gone, left = [], crowd
    early, late = (signatures.select(F.col("ord").alias(x), F.col("signature").alias(f"s_{x}")) for x in ("early", "late"))

    def size_of(rows: DataFrame) -> tuple[int, int]:
        sizes = rows.groupBy("key").count().agg(F.sum("count"), F.max("count")).first()
        return sizes[0] or 0, sizes[1] or 0

    size, largest = size_of(left)
    while largest > SMALL_BAND:
        heads = left.groupBy("key").agg(F.min("ord").alias("early"))
        led = shared_table(left.join(heads, "key"), "led-bands")
        kept = shared_table(led.groupBy("ord").agg(F.min(F.col("ord") == F.col("early")).alias("leads")).where("leads").select("ord"), "kept-now")
        pairs = led.where("ord <> early").join(kept.withColumnRenamed("ord", "early"), "early", "left_semi").select("early", F.col("ord").alias("late")).distinct()
        similar = pairs.join(early, "early").join(late, "late").where(similarity(F.col("s_early"), F.col("s_late")) >= threshold)
        dropped = shared_table(similar.select(F.col("late").alias("ord")).distinct(), "dropped-now")
        gone.append(dropped)
        rest = led.select("key", "ord").join(kept.union(dropped), "ord", "left_anti")
        alone = rest.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
        rest = shared_table(rest.join(alone, "key"), "open-bands")
        drop_tables(led, kept, left if left is not crowd else None)
        before, left = size, rest
        size, largest = size_of(left)
        if size > (1 - ROUND_SHARE) * before:
            break
    return left, gone


def _walked(edges: DataFrame) -> DataFrame:
    """ord of the entries dropped, from component, early, late: each task walks the pairs of its components in order."""
    import pyarrow as pa

    def walk(batches):
        component, dropped = None, set()
        for batch in batches:
            out = []
            for c, early, late in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if c != component:
                    component, dropped = c, set()
                # all pairs in which early is the later one came before
                if early not in dropped and late not in dropped:
                    dropped.add(late)
                    out.append(late)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], ["ord"])

    dealt = edges.select("component", "early", "late").repartition("component").sortWithinPartitions("component", "late", "early")
    return dealt.mapInArrow(walk, "ord long")


def _by_component(similar: DataFrame) -> list[DataFrame]:
    """Tables of the entries dropped among similar pairs (early, late)."""
    gone, edges = [], similar.select("early", "late")
    while not edges.isEmpty():
        labels = connected(edges.select(F.col("early").alias("a"), F.col("late").alias("b")))
        placed = shared_table(edges.join(labels.withColumnRenamed("node", "early"), "early"), "components-of-pairs")
        large = placed.groupBy("component").agg(F.count("*").alias("n")).where(F.col("n") > WALK_PAIRS).select("component")
        large = shared_table(large, "large-components")
        gone.append(shared_table(_walked(placed.join(large, "component", "left_anti")), "dropped-now"))
        if large.isEmpty():
            drop_tables(placed, large)
            break
        rest = placed.join(large, "component").select("early", "late")
        firsts = rest.select(F.col("early").alias("ord")).distinct().join(rest.select(F.col("late").alias("ord")).distinct(), "ord", "left_anti")
        kept = shared_table(firsts, "kept-now")
        dropped = shared_table(rest.join(kept.withColumnRenamed("ord", "early"), "early", "left_semi").select(F.col("late").alias("ord")).distinct(), "dropped-now")
        gone.append(dropped)
        done = shared_table(kept.union(dropped), "decided-now")
        rest = rest.join(done.withColumnRenamed("ord", "early"), "early", "left_anti").join(done.withColumnRenamed("ord", "late"), "late", "left_anti")
        edges = shared_table(rest.select("early", "late"), "similar-left")
        drop_tables(placed, large, kept, done)
    return gone


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for table in tables[1:]:
        out = out.union(table)
    return out


BEST = "entry long, s double, band int, early long"


def _best_kept(gone: DataFrame, kept: DataFrame, signatures: DataFrame, threshold: float, bands: int) -> DataFrame:
    """BEST: of the kept entries (key, ord) in the bands of dropped ones (key, ord, top), in pairs of blocks, those that may be
    the best for an entry or a copy of it up to top: s is the similarity with a minus, band the first one shared."""
    import numpy as np
    import pyarrow as pa

    def best_of(orders, tops, one, others, other, same_block):
        turn = np.argsort(others, kind="stable")
        others, other, out = others[turn], other[turn], []
        for at, share, same in _shares(one, other):
            in_bands = same.reshape(*same.shape[:2], bands, -1).all(axis=3)
            for i in range(len(share)):
                mine, top = orders[at + i], tops[at + i]
                fits = np.flatnonzero((share[i] >= threshold) & (others < top) & in_bands[i].any(axis=1))
                best, before = None, None
                for j in fits.tolist():
                    rank = (-share[i, j], int(in_bands[i, j].argmax()), int(others[j]))
                    if others[j] < mine:
                        before = min(before, rank) if before else rank
                        best = before
                    elif best is None or rank < best:
                        out.append((int(mine), *rank))
                        best = rank
                if before:
                    out.append((int(mine), *before))
        columns = list(zip(*out, strict=True)) or [()] * 4
        kinds = {"entry": pa.int64(), "s": pa.float64(), "band": pa.int32(), "early": pa.int64()}
        return pa.table({k: pa.array(c, kind) for (k, kind), c in zip(kinds.items(), columns, strict=True)})

    return _met_in_blocks(gone, kept, signatures, best_of, BEST)


def _similar_pairs(open_bands: DataFrame, signatures: DataFrame, threshold: float, bands: int) -> DataFrame:
    """early, late, s, band of the pairs of entries that share a band and are similar, each once."""
    import numpy as np
    import pyarrow as pa

    def edges_of(orders, tops, one, others, other, same_block):
        found = {"early": [], "late": [], "s": [], "band": []}
        for at, share, same in _shares(one, other):
            fits = share >= threshold
            if same_block:
                fits &= orders[at : at + 32, None] < others[None, :]
            i, j = np.nonzero(fits)
            found["early"].append(np.minimum(orders[at + i], others[j]))
            found["late"].append(np.maximum(orders[at + i], others[j]))
            found["s"].append(-share[i, j])
            found["band"].append(same[i, j].reshape(len(i), bands, same.shape[2] // bands).all(axis=2).argmax(axis=1).astype(np.int32))
        return pa.table({k: np.concatenate(v) for k, v in found.items()})

    with_top = open_bands.select("key", "ord", F.lit(0).cast("long").alias("top"))
    return _met_in_blocks(with_top, None, signatures, edges_of, "early long, late long, s double, band int").distinct()


def _met_old(banded: DataFrame, entries: DataFrame, old: dict[str, DataFrame], threshold: float, bands: int) -> DataFrame:
    """BEST of the entries with the similar ones that earlier batches kept.  Only new rows and pairs are shuffled: the old
    bands are read in their buckets."""
    pairs = banded.join(old["bands"].select("key", F.col("ord").alias("early")), "key").select(F.col("ord").alias("entry"), "early").distinct()
    mine = entries.select(F.col("ord").alias("entry"), F.col("signature").alias("s_new"))
    theirs = old["signatures"].select(F.col("ord").alias("early"), F.col("signature").alias("s_old"))
    compared = pairs.join(theirs, "early").join(mine, "entry")
    shared = F.zip_with(_bands(F.col("s_new"), bands), _bands(F.col("s_old"), bands), lambda x, y: x == y)
    scored = compared.select("entry", (-similarity(F.col("s_new"), F.col("s_old"))).alias("s"), (F.array_position(shared, True) - 1).cast("int").alias("band"), "early")
    return shared_table(scored.where(F.col("s") <= -threshold), "met-old")


def _verdicts(rows: DataFrame, threshold: float, bands: int, old: dict[str, DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """(ord, kind, matched, similarity of the duplicates among rows of _signed; entries that are kept: ord, hash, signature).

    old: what earlier batches kept, all before the rows in order: copies (hash, ord), bands (key, ord), signatures (ord,
    signature).
    """
    # Written, so that Spark can split the joins with it where very many documents are equal.
    firsts = shared_table(rows.groupBy("hash").agg(F.min("ord").alias("first"), F.max("ord").alias("last")), "first-copies")
    exact_old = None
    if old is not None:
        known = firsts.join(old["copies"].select("hash", F.col("ord").alias("matched")), "hash").select("hash", "matched")
        known = shared_table(known, "known-copies")
        exact_old = rows.select("ord", "hash").join(known, "hash").select("ord", F.lit("exact").alias("kind"), "matched", F.lit(1.0).alias("similarity"))
        firsts = shared_table(firsts.join(known.select("hash"), "hash", "left_anti"), "first-copies")
    entries = shared_table(rows.join(firsts.select(F.col("first").alias("ord"), "last"), "ord").select("ord", "hash", "last", "signature"), "entries")
    banded = _banded(entries, bands)
    by_old, met = [], None
    if old is not None:
        met = _met_old(banded, entries, old, threshold, bands)
        by_old = [shared_table(met.select(F.col("entry").alias("ord")).distinct(), "dropped-by-old")]
    # entries that an old one drops stay in the crowd only to find their best match
    crowded = banded.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    crowd = shared_table(banded.join(crowded, "key"), "crowded-bands")
    signatures = shared_table(entries.join(crowd.select("ord").distinct(), "ord", "left_semi").select("ord", _short(F.col("signature")).alias("signature")), "crowded-signatures")
    undecided = crowd
    if by_old:
        left = crowd.join(by_old[0], "ord", "left_anti").select("key", "ord")
        undecided = shared_table(left.join(left.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "key").select("key", "ord"), "undecided-bands")
    open_bands, in_rounds = _in_rounds(undecided, signatures, threshold)
    similar = shared_table(_similar_pairs(open_bands, signatures, threshold, bands), "similar")
    later = _by_component(similar)
    none = entries.where("false").select("ord")
    dropped_first = shared_table(_union([*by_old, *in_rounds, none]), "dropped-first")
    dropped_later = shared_table(_union([*later, none]), "dropped-later")
    dropped = dropped_first.union(dropped_later)
    drop_tables(*by_old, *in_rounds, *later, open_bands if open_bands is not crowd else None)

    # Each dropped entry, and each copy of one, goes with its most similar kept document before it; ties: the first band
    # shared, then the first document.  A copy may have better ones than the entry, which lie between the two.
    both = [similar.select(F.col(x).alias("entry"), "s", "band", F.col(y).alias("early")) for x, y in (("late", "early"), ("early", "late"))]
    best = _union(both).join(dropped_later.withColumnRenamed("ord", "entry"), "entry", "left_semi").join(dropped.withColumnRenamed("ord", "early"), "early", "left_anti").select("entry", "s", "band", "early")
    if not dropped_first.isEmpty():
        tops = entries.join(dropped_first, "ord", "left_semi").select("ord", (F.col("last") + 1).alias("top"))
        gone_bands = crowd.join(tops, "ord").select("key", "ord", "top")
        kept_bands = crowd.join(dropped, "ord", "left_anti").select("key", "ord")
        best = best.union(_best_kept(gone_bands, kept_bands, signatures, threshold, bands).distinct())
    if met is not None:
        best = best.union(met)
    best = shared_table(best, "best-kept")
    late = rows.select("hash", F.col("ord").alias("late")).join(entries.join(dropped, "ord", "left_semi").select("hash", F.col("ord").alias("entry")), "hash")
    chosen = late.join(best, "entry").where("early < late").groupBy("late").agg(F.min(F.struct("s", "band", "early")).alias("m"))
    near = chosen.select(F.col("late").alias("ord"), F.lit("near").alias("kind"), F.col("m.early").alias("matched"), (-F.col("m.s")).alias("similarity"))
    exact = rows.select("ord", "hash").join(firsts.select("hash", "first"), "hash").join(dropped.withColumnRenamed("ord", "first"), "first", "left_anti").where("ord > first").select("ord", F.lit("exact").alias("kind"), F.col("first").alias("matched"), F.lit(1.0).alias("similarity"))
    found = near.unionByName(exact)
    if exact_old is not None:
        found = found.unionByName(exact_old)
    drop_tables(similar, crowd, signatures)
    return found, entries.join(dropped, "ord", "left_anti").select("ord", "hash", "signature")


def _checked(n: int, bands: int) -> None:
    if n % bands:
        raise ValueError(f"{n} permutations do not make {bands} equal bands")


def _with_kinds(docs: DataFrame, order: str, rows: DataFrame, found: DataFrame) -> DataFrame:
    kind = docs.schema[order].dataType
    return rows.select("given", "ord").join(found, "ord", "left").select(F.col("given").alias(order), F.coalesce("kind", F.lit("")).alias("kind"), F.col("matched").cast(kind).alias("matched"), F.coalesce("similarity", F.lit(0.0)).alias("similarity"))


def greedy_duplicates(docs: DataFrame, order: str = "ord", text: str = "text", threshold: float = THRESHOLD, bands: int = BANDS, n: int = PERMUTATIONS, signed: DataFrame | None = None) -> DataFrame:
    """order, kind ('' kept, 'exact', 'near'), matched (order of the kept document) and similarity of each document.

    order must be unique; rows with a null text have the form of an empty one.  signed: the signatures of these documents,
    or of more, as signatures() gave them, where they are decided more than once.
    """
    _checked(n, bands)
    rows = _signed(docs, order, text, n) if signed is None else shared_table(signed.join(docs.select(F.col(order).cast("long").alias("ord")), "ord", "left_semi"), "signatures")
    return _with_kinds(docs, order, rows, _verdicts(rows, threshold, bands)[0])


def exact_duplicates(docs: DataFrame, order: str = "ord", text: str = "text") -> DataFrame:
    """order, hash, first: the first document with the same content hash."""
    rows = docs.select(order, content_hash(F.coalesce(text, F.lit(""))).alias("hash"))
    firsts = shared_table(rows.groupBy("hash").agg(F.min(order).alias("first")), "first-copies")
    return rows.join(firsts, "hash").select(order, "hash", "first")


def colliding_ids(docs: DataFrame, key: str = "id", order: str = "ord") -> DataFrame:
    """order of the documents whose id an earlier one has; partial minima, so an id may be in any number of rows."""
    firsts = shared_table(docs.groupBy(key).agg(F.min(order).alias("__first")), "first-owners")
    return docs.select(key, order).join(firsts, key).where(F.col(order) > F.col("__first")).select(order)
