"""Periodic runs of words: harmonic grid probing.

A run of period p that is 2 p words long holds two neighbouring points jp and (j+1)p of the grid of p.  So for each period
the words at neighbouring grid points are compared, n/1 + n/2 + ... = n log n pairs in all, in vectors of PROBES pairs.
Pairs that are equal are extended to both sides, first by NEAR words, all at once; the few that go on are extended one by
one, in chunks of doubling size, and each run found takes out all pairs that lie in it at its period or a multiple of that,
since these would give the same run again.

A run is a stretch of words with smallest period p, of max(LEAST, 2 p) words at least, that no neighbouring word extends
keeping the period.  Whole texts are searched, each by itself, in the task that reads it: no shuffle, and memory for one
batch of texts.

Edge cases: a null text has no words; words are split at ASCII white space only.  Empty tables give no rows; rows are told
apart by themselves, so null and repeated ids keep their own runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound_batches, spread

#: Words that a run has at least.
LEAST = 12
#: Pairs probed at once, and words to each side that all equal pairs are extended by at first.
PROBES, NEAR = 1 << 16, 8


def _probed(codes):
    """Yields (starts, periods) of equal pairs (jp, (j+1)p), by period, then start, in bounded vectors."""
    import numpy as np

    n, low = len(codes), 1
    while low <= n // 2:
        high = min(n // 2, low + PROBES * low // n)  # a period has (n - 1) // period pairs
        periods = np.arange(low, high + 1)
        pairs = (n - 1) // periods
        p = np.repeat(periods, pairs)
        at = (np.arange(len(p)) - np.repeat(np.cumsum(pairs) - pairs, pairs)) * p
        equal = codes[at] == codes[at + p]
        at, p = at[equal], p[equal]
        for i in range(0, len(at), PROBES):
            yield at[i : i + PROBES], p[i : i + PROBES]
        low = high + 1


def _first_unequal(codes, a: int, b: int, step: int) -> int:
    """How many words agree from a and b on, in direction step, compared in chunks of doubling size."""
    done, size, n = 0, 32, len(codes)
    while True:
        most = min(size, n - b - done) if step > 0 else min(size, a + 1 - done)
        if most <= 0:
            return done
        if step > 0:
            same = codes[a + done : a + done + most] == codes[b + done : b + done + most]
        else:
            same = codes[a - done - most + 1 : a - done + 1][::-1] == codes[b - done - most + 1 : b - done + 1][::-1]
        if not same.all():
            return done + int(same.argmin())
        done += most
        size = min(2 * size, 1 << 16)


def runs_of(codes, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of an array of word numbers, by start, then period."""
    import numpy as np

    n = len(codes)
    if n < max(least, 2):
        return []
    found: dict[tuple[int, int], int] = {}
    # so that every pair has NEAR words on both sides; no two of these are equal to each other or to a word
    edge = np.arange(1, NEAR + 1, dtype=codes.dtype)
    padded = np.concatenate((-edge, codes, -edge - NEAR))
    near = np.arange(1, NEAR + 1)
    for at, p in _probed(codes):
        first = at + NEAR
        need = np.maximum(least, 2 * p) - p - 1  # further equal neighbours of the pair that a run has at least
        differs = padded[first[:, None] + near] != padded[(first + p)[:, None] + near]
        right = np.where(differs.any(1), differs.argmax(1), NEAR)
        differs = padded[first[:, None] - near] != padded[(first + p)[:, None] - near]
        left = np.where(differs.any(1), differs.argmax(1), NEAR)
        open_ = (right == NEAR) | (left == NEAR)
        likely = open_ | (left + right >= need)
        at, p = at[likely], p[likely]
        for (start, end), q in found.items():
            if len(at) and end - start > p[0]:
                known = (p % q == 0) & (at >= start) & (at + p < end)
                at, p = at[~known], p[~known]
        while len(at):
            i, q = int(at[0]), int(p[0])
            start = i - _first_unequal(codes, i - 1, i + q - 1, -1)
            end = i + q + 1 + _first_unequal(codes, i + 1, i + q + 1, 1)
            if end - start >= max(least, 2 * q):
                found.setdefault((start, end), q)
            known = (p % q == 0) & (at >= start) & (at + p < end)
            at, p = at[~known], p[~known]
    return sorted((start, end - start, q) for (start, end), q in found.items())


def _collapsed(n: int, runs: list[tuple[int, int, int]]):
    """Boolean array: which of n words stay if each run keeps its first period only."""
    import numpy as np

    stays = np.ones(n, dtype=bool)
    for start, length, period in runs:
        stays[start + period : start + length] = False
    return stays


def word_runs(docs: DataFrame, *kept: str, text: str = "text", least: int = LEAST) -> DataFrame:
    """The kept columns with __runs (array of start, length, period, by start, then period) and __collapsed: the words of
    the text without those that repeat an earlier period of a run, joined by one space."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    bound_batches(docs.sparkSession)
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def search(batches):
        for batch in batches:
            texts = pc.fill_null(batch.column(batch.num_columns - 1).cast(pa.large_string()), "")
            split = pc.ascii_split_whitespace(texts)
            words, of = split.flatten(), pc.list_parent_indices(split).to_numpy()
            real = pc.greater(pc.binary_length(words), 0)
            words, of = words.filter(real), of[real.to_numpy(zero_copy_only=False)]
            ends = np.searchsorted(of, np.arange(len(texts) + 1))
            codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            runs = [runs_of(codes[a:b], least) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            stays = np.concatenate([_collapsed(b - a, r) for a, b, r in zip(ends[:-1], ends[1:], runs, strict=True)]) if len(texts) else np.zeros(0, dtype=bool)
            left = np.concatenate(([0], np.cumsum(stays)))[ends]
            joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(left, pa.int64()), words.filter(pa.array(stays))), pa.scalar(" ", pa.large_string()))
            found = pa.array([[dict(zip(("start", "length", "period"), x, strict=True)) for x in r] for r in runs], pa.list_(run))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], found, joined.cast(pa.string())], [*names, "runs", "collapsed"])

    given = docs.select(*kept, F.col(text).cast("string"))
    names = [f"kept_{i}" for i in range(len(kept))]
    fields = [f"{name} {f.dataType.simpleString()}" for name, f in zip(names, given.schema.fields, strict=False)]
    out = given.toDF(*names, "text").mapInArrow(search, ", ".join([*fields, "runs array<struct<start:bigint,length:bigint,period:bigint>>", "collapsed string"]))
    return out.toDF(*given.columns[:-1], "__runs", "__collapsed")


def planted(docs: DataFrame) -> DataFrame:
    """doc_id, text: where crc32(doc_id) mod 10 is 0, the words from one on are made to repeat with a period, both by the crc."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    g, n = F.floor(h / 10), F.size(words)

    def repeated(w):
        a = (g % F.size(w)).cast("int")
        p = (F.lit(1) + F.floor((F.size(w) - a) / (F.lit(3) + g % 8))).cast("int")
        return F.array_join(F.transform(w, lambda x, i: F.when(i < a, x).otherwise(F.get(w, a + (i - a) % p))), " ")

    return docs.select("doc_id", F.when((h % 10 == 0) & (n > 0), F.get(F.transform(F.array(words), repeated), 0)).otherwise(F.col("text")).alias("text"))


def op12_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: the runs of all documents, some of which are made periodic first."""
    docs = planted(spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")))
    longest = F.get(F.array_sort(F.transform("__runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"], r["period"]))), 0)
    lines = F.array_join(F.transform("__runs", lambda r: F.concat_ws(",", *(r[x].cast("string") for x in ("start", "length", "period")))), "\n")
    found = word_runs(docs, "doc_id").withColumn("best", longest)
    return found.select(
        "doc_id",
        F.size("__runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.less")).alias("length"),
        F.col("best.period").alias("period"),
        F.floor(F.lit(1000) * -F.col("best.less") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.when(F.size("__runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("__collapsed", 256).alias("collapsed_sha256"),
    )
