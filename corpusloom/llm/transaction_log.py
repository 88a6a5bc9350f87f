"""Transaction logs put together again: distributed block minima.

A log has changes, savepoints, rollbacks, commits and aborts of several sources, each of which runs one transaction after
another.  With S savepoints before it in its source's order, a change has the height S + 1, a rollback dips to S, and what
ends a transaction dips below everything.  A change's fate is then the first later record that dips below its height: a
rollback, unless a savepoint lies between, or else the transaction's end.

That record is searched for in blocks of BLOCK records, so a transaction with a third of all records is many of them.
Each block finds what it can inside, and has one row of summary: its least dip.  For heights that stay open the summaries are
searched for the first later block that dips below, again in blocks of BLOCK of them, level by level, and the search is
finished inside the block found.  All heights of a block that are looked for in one other block are one row of BLOCK heights
at most, so nothing is ever gathered but a block.  Positions and running counts go by blocks and levels too.

Committed changes go to one store in the order of their commits, then of the log.  versions() has the value of each key at
the end of every epoch that changed it.

Edge cases: records without a place in the order are no records; a null source is one source; records of equal place
follow each other by kind, key and value, and equal ones are each a record.  A transaction that the log's end cuts off is
aborted by nothing.  A commit or rollback without changes does nothing, but the commit counts in its epoch.  A null value
deletes its key; deleting an absent key does nothing.  Empty logs give no rows; further columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import drop_tables, shared_table

#: Records, or summaries, of a block.
BLOCK = 1024
#: Commits of an epoch.
EPOCH_COMMITS = 64
CHANGE, SAVEPOINT, ROLLBACK, ABORT, COMMIT = "change", "savepoint", "rollback", "abort", "commit"


def _part(column: str, size: int) -> Column:
    """Which part of so many the place in a column falls into, in whole numbers."""
    return F.expr(f"`{column}` div {size}")


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """Written table of rows with `pos`: their place in the order, from 0, without gaps.

    Rows are dealt by range, and a row a partition of the shuffle, whose number is a setting, says what comes before it.
    """
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    dealt = shared_table(placed, "ordered")
    part = F.shiftright("__at", 33)
    sums = dealt.groupBy(part.alias("__part")).agg(F.count("*").alias("__rows"))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("__part", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__before"))
    inside = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    out = shared_table(dealt.join(F.broadcast(before), part == F.col("__part")).select(*rows.columns, (F.col("__before") + inside).alias("pos")), "numbered")
    drop_tables(dealt)
    return out


def running(rows: DataFrame, n: int, value: Column, name: str, block: int = BLOCK) -> DataFrame:
    """rows, n of them, with `name`: the sum of value over all rows of smaller pos (from 0, without gaps)."""
    inside = Window.partitionBy("__block").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    dealt = rows.withColumn("__value", value.cast("long")).withColumn("__block", _part("pos", block))
    own = dealt.withColumn(name, F.coalesce(F.sum("__value").over(inside), F.lit(0)))
    if n > block:
        sums = shared_table(dealt.groupBy(F.col("__block").alias("pos")).agg(F.sum("__value").alias("sum")), "block-sums")
        before = running(sums, -(-n // block), F.col("sum"), "before", block).select(F.col("pos").alias("__block"), F.col("before").alias("__earlier"))
        own = own.join(before, "__block").withColumn(name, F.col(name) + F.col("__earlier")).drop("__earlier")
    return own.drop("__block", "__value")


def _inside(dips: list, heights: list) -> list:
    """For each height the first later place of the block that dips below it; -1 if none does, None where no height is."""
    low, at, out = [], [], [None] * len(dips)  # places that no earlier one hides, the nearest and highest last
    for i in range(len(dips) - 1, -1, -1):
        if heights[i] is not None:
            k = bisect_left(low, heights[i])
            out[i] = at[k - 1] if k else -1
        if dips[i] is not None:
            while low and low[-1] >= dips[i]:
                low.pop()
                at.pop()
            low.append(dips[i])
            at.append(i)
    return out


def _first_below(dips, heights):
    """numpy: for each height the first place of dips below it, or -1."""
    import numpy as np

    least = np.minimum.accumulate(dips)
    steps = np.flatnonzero(np.concatenate(([True], least[1:] < least[:-1])))  # where a new minimum is
    k = np.searchsorted(-least[steps], -heights, side="right")
    return np.where(k < len(steps), steps[np.minimum(k, len(steps) - 1)], -1)


#: Stands for no dip in arrays of them.
NONE = (1 << 63) - 1


def _gathered(rows: DataFrame, block: int) -> DataFrame:
    """block, dips (array, NONE for none) of rows pos, dip; pos without gaps."""
    each = F.struct((F.col("pos") % block).alias("at"), F.coalesce("dip", F.lit(NONE)).alias("dip"))
    listed = rows.groupBy(_part("pos", block).alias("block")).agg(F.array_sort(F.collect_list(each)).alias("s"))
    return listed.select("block", F.transform("s", lambda x: x["dip"]).alias("dips"))


FOUND = "asker long, target long, heights array<long>"


def _searched(asks: DataFrame, groups: DataFrame, block: int) -> DataFrame:
    """asker, target, heights of asks (asker, after, group, heights): the first place of the group (of groups: block, dips)
    that dips below each height, and comes later than `after` if that is not null; the target is null where none is.

    A row of asks becomes a row for each target.  Many may ask for one group: Spark can split this join.
    """
    import numpy as np
    import pyarrow as pa

    def search(batches):
        for batch in batches:
            rows = []
            for asker, after, group, heights, dips in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                skip = 0 if after is None else after - group * block + 1
                values, wanted = np.array(dips[skip:], dtype=np.int64), np.array(heights, dtype=np.int64)
                found = _first_below(values, wanted) if len(values) else np.full(len(wanted), -1)
                for target in np.unique(found).tolist():
                    rows.append((asker, None if target < 0 else group * block + skip + target, wanted[found == target].tolist()))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.list_(pa.int64())))], ["asker", "target", "heights"])

    joined = asks.join(groups.withColumnRenamed("block", "group"), "group")
    return joined.select("asker", "after", "group", "heights", "dips").mapInArrow(search, FOUND)


def _inside_targets(found: DataFrame, groups: DataFrame, block: int) -> DataFrame:
    """asker, target, heights: the places within the groups that were found."""
    return _searched(found.select("asker", F.lit(None).cast("long").alias("after"), F.col("target").alias("group"), "heights"), groups, block)


def _later_blocks(dips: DataFrame, n: int, asks: DataFrame, block: int, size: int = 1) -> DataFrame:
    """asker, target, heights: for asks (asker, heights) the first later one of n summaries (pos, dip) that dips below each
    height; heights that none dips below have no row.  A summary is of so many blocks; askers are numbers of blocks."""
    groups = shared_table(_gathered(dips, block), "summaries")
    placed = asks.select("asker", _part("asker", size).alias("after"), _part("asker", size * block).alias("group"), "heights")
    near = shared_table(_searched(placed, groups, block), "near-blocks")
    found = near.where("target is not null")
    if n <= block:
        return found
    above = groups.select(F.col("block").alias("pos"), F.array_min("dips").alias("dip"))
    far = _later_blocks(above, -(-n // block), near.where("target is null").select("asker", "heights"), block, size * block)
    return found.unionByName(_inside_targets(far, groups, block))


def first_dips(rows: DataFrame, n: int, block: int = BLOCK) -> DataFrame:
    """pos, ender for the rows (n of them: pos from 0 without gaps, dip, height) that have a height: the pos of the first
    later row whose dip is below it, or null."""
    import pyarrow as pa

    each = F.struct((F.col("pos") % block).alias("at"), "dip", "height")
    listed = rows.groupBy(_part("pos", block).alias("block")).agg(F.array_sort(F.collect_list(each)).alias("s"))
    asked = listed.select("block", F.transform("s", lambda x: x["dip"]).alias("dips"), F.transform("s", lambda x: x["height"]).alias("heights"))

    def inside(batches):
        for batch in batches:
            numbers, found = batch.column(0).to_pylist(), []
            for number, dips, heights in zip(numbers, batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                places = _inside(dips, heights)
                found.append([{"pos": number * block + i, "height": h, "ender": None if e < 0 else number * block + e} for i, (h, e) in enumerate(zip(heights, places, strict=True)) if h is not None])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.struct([("pos", pa.int64()), ("height", pa.int64()), ("ender", pa.int64())])))], ["block", "dips", "found"])

    blocks = shared_table(asked.mapInArrow(inside, "block long, dips array<long>, found array<struct<pos:long,height:long,ender:long>>"), "blocks")
    each = blocks.select("block", F.explode("found").alias("f")).select("block", "f.*")
    if n <= block:
        return each.select("pos", "ender")
    open_heights = F.array_distinct(F.transform(F.filter("found", lambda f: f["ender"].isNull()), lambda f: f["height"]))
    asks = shared_table(blocks.select(F.col("block").alias("asker"), open_heights.alias("heights")).where("size(heights) > 0"), "open-heights")
    summaries = blocks.select(F.col("block").alias("pos"), F.array_min("dips").alias("dip"))
    targets = _later_blocks(summaries, -(-n // block), asks, block)
    dips = blocks.select("block", F.transform("dips", lambda x: F.coalesce(x, F.lit(NONE))).alias("dips"))
    ended = shared_table(_inside_targets(targets, dips, block), "enders")
    far = ended.select(F.col("asker").alias("block"), F.col("target").alias("far"), F.explode("heights").alias("height"))
    done = each.where("ender is not null").select("pos", "ender")
    rest = each.where("ender is null").join(far, ["block", "height"], "left").select("pos", F.col("far").alias("ender"))
    return done.unionByName(rest)


def reassembled(log: DataFrame, block: int = BLOCK) -> DataFrame:
    """Written table of all records of a log (source, seq, kind, key, value) with pos; of changes also fate ('commit',
    'abort' or 'rollback'), by_seq (null at the log's end) and by_pos of the record that decided it."""
    records = numbered(log.where("seq is not null").select("source", "seq", "kind", "key", "value"), "source", "seq", "kind", "key", "value")
    n = records.count()
    first = records.groupBy("source").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("starts"))
    counted = running(records.select("pos", "kind"), n, F.col("kind") == SAVEPOINT, "saved", block).join(first, "pos", "left")
    ends = F.col("kind").isin(COMMIT, ABORT) | F.col("starts").isNotNull()  # a source's first record ends the one before
    dip = F.when(ends, F.lit(-1)).when(F.col("kind") == ROLLBACK, F.col("saved")).cast("long")
    height = F.when(F.col("kind") == CHANGE, F.col("saved") + 1).cast("long")
    marked = shared_table(counted.select("pos", dip.alias("dip"), height.alias("height")), "heights")
    enders = first_dips(marked, n, block)
    by = records.select(F.col("pos").alias("ender"), F.col("source").alias("by_source"), F.col("seq").alias("by_seq"), F.col("kind").alias("fate"))
    fates = records.join(enders, "pos", "left").join(by, "ender", "left")
    own = F.col("ender").isNotNull() & F.col("source").eqNullSafe(F.col("by_source"))
    change = F.col("kind") == CHANGE
    out = shared_table(fates.select(*records.columns, F.when(change, F.when(own, F.col("fate")).otherwise(ABORT)).alias("fate"), F.when(own, F.col("by_seq")).alias("by_seq"), F.when(own, F.col("ender")).alias("by_pos")), "fates")
    drop_tables(records, marked)
    return out


def epochs(fates: DataFrame, commits: int = EPOCH_COMMITS) -> DataFrame:
    """Written table pos, rank (from 0), epoch (from 1) of the commits of reassembled(), in the order of seq."""
    ranked = numbered(fates.where(F.col("kind") == COMMIT).select("seq", "source", F.col("pos").alias("at")), "seq", "source", "at")
    return ranked.select(F.col("at").alias("by_pos"), F.col("pos").alias("rank"), (_part("pos", commits) + 1).alias("epoch"))


def versions(fates: DataFrame, ranks: DataFrame) -> DataFrame:
    """key, epoch, value (null: deleted): what each key is at the end of the epochs that set it."""
    applied = fates.where(F.col("fate") == COMMIT).join(ranks, "by_pos")
    last = applied.groupBy("key", "epoch").agg(F.max(F.struct("rank", "pos", "value")).alias("last"))
    return last.select("key", "epoch", "last.value")


def store_sums(changed: DataFrame, ranks: DataFrame, block: int = BLOCK) -> DataFrame:
    """epoch, n, total after each epoch: the stored keys, and the sum of their values (longs)."""
    ordered = numbered(changed, "key", "epoch")
    before = ordered.select((F.col("pos") + 1).alias("pos"), F.col("key").alias("key_before"), F.col("value").alias("value_before"))
    stored = F.col("value").isNotNull().cast("long")
    same = F.coalesce(F.col("key").eqNullSafe(F.col("key_before")) & F.col("value_before").isNotNull(), F.lit(False))
    moves = ordered.join(before, "pos", "left").select("epoch", (stored - same.cast("long")).alias("n"), (F.coalesce("value", F.lit(0)) - F.when(same, F.col("value_before")).otherwise(0)).alias("total"))
    every = ranks.select("epoch", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("total"))
    sums = moves.union(every).groupBy("epoch").agg(F.sum("n").alias("dn"), F.sum("total").alias("dtotal"))
    placed = shared_table(sums.select((F.col("epoch") - 1).alias("pos"), "dn", "dtotal"), "epoch-sums")
    n = placed.count()
    counted = running(running(placed, n, F.col("dn"), "n", block), n, F.col("dtotal"), "total", block)
    return counted.select((F.col("pos") + 1).alias("epoch"), (F.col("n") + F.col("dn")).alias("n"), (F.col("total") + F.col("dtotal")).alias("total"))


def document_log(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """source, seq, kind, key, value of documents read as log records by the crc32 of their doc_id."""
    h = F.crc32(F.col("doc_id").cast("string"))
    kind = F.get(F.array(*map(F.lit, (COMMIT, COMMIT, ABORT, SAVEPOINT, SAVEPOINT, ROLLBACK, ROLLBACK))), (h % 17).cast("int"))
    key = F.floor(h / 100) % 30000
    toxic = labels.groupBy("doc_id").agg((F.max("toxic") == 1).alias("toxic"))
    read = docs.where("doc_id is not null").select("doc_id", "source", F.coalesce(kind, F.lit(CHANGE)).alias("kind"), key.alias("key"), F.crc32(F.concat(key.cast("string"), F.lit(":"), F.col("text"))).alias("crc"))
    value = F.when(~F.coalesce("toxic", F.lit(False)), F.col("crc"))
    change = F.col("kind") == CHANGE
    return read.join(toxic, "doc_id", "left").select("source", F.col("doc_id").alias("seq"), "kind", F.when(change, F.col("key")).alias("key"), F.when(change, value).alias("value"))


def op13_transaction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: the documents as a log; the store after each epoch, and every undone change."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{x}.parquet") for x in ("documents", "labels"))
    log = shared_table(document_log(docs.select("doc_id", "source", "text"), labels), "log")
    fates = reassembled(log)
    ranks = epochs(fates)
    states = store_sums(versions(fates, ranks), ranks)
    undone = fates.where(F.col("fate").isin(ABORT, ROLLBACK)).select(F.col("fate").alias("kind"), F.col("seq").alias("id"), F.col("by_seq").alias("n"), F.col("key").alias("value"))
    return states.select(F.lit("state").alias("kind"), F.col("epoch").alias("id"), "n", F.col("total").alias("value")).unionByName(undone)
