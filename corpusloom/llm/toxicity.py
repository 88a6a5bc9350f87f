"""Toxicity by a weighted lexicon, matched by Aho-Corasick on folded text.

Folding: lower case, accents off, homoglyphs of other scripts and digits or signs that stand for letters replaced.  A match
counts if it is a whole word and lies in no exception phrase; runs of blanks count as one blank.  The sum of the weights of all matches, divided by the words
of the text, goes through a logistic curve.

The lexicon is learned: of at most FIT_ROWS labelled texts, drawn by hash, the words that stand in toxic texts far more
often than in others, weighted by their log odds; most_words can bound it.  Exceptions are some fixed phrases and those
that are learned: a word of the lexicon with the word before or after it, if that stands in LEAST_SPARED other texts and in
no toxic one.  The curve is fitted on the same texts.  Only text is an input of a score.

Edge cases: null and empty texts, and texts without matches, get the curve's value at 0.  Without labelled rows, or without
toxic ones, the lexicon is empty and scores are 0.  A document labelled more than once counts once, by its highest label;
of rows that repeat a labelled doc_id the smallest text is fitted.  One row out for each row in, repeated ones and those
without a doc_id too; further columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
import unicodedata
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound_batches, spread

#: Bound of the labelled rows that are fitted, and the partitions they are read in.
FIT_ROWS, FIT_PARTS = 20_000, 12
#: A word of the lexicon is in so many toxic texts, in this share of them, has this log odds, and this many standard errors.
LEAST_TEXTS, LEAST_SHARE, LEAST_ODDS, LEAST_ERRORS = 4, 0.02, 1.5, 3.2
#: A learned exception stands in so many texts that are not toxic.
LEAST_SPARED = 8

# Letters of other scripts that look like Latin ones, and what stands for letters in disguised words.
HOMOGLYPHS = dict(zip("аеорсухкмтвнігѕјԁһԛԝαεορτυχκινβη", "aeopcyxkmtbhirsjdhqwaeoptuxkivbn", strict=True))
SUBSTITUTES = dict(zip("013457@$", "oieastas", strict=True))
#: Phrases in which a lexicon word is harmless.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "trash collection", "clown fish", "class clown", "pond scum", "idiot proof", "sore loser", "worthless currency")


def _folding() -> dict[int, str]:
    table = {}
    for c in map(chr, range(0xC0, 0x250)):
        bare = unicodedata.normalize("NFKD", c)[0].lower()
        if bare.isascii() and bare.isalpha():
            table[ord(c)] = bare
    return table | {ord(a): b for a, b in (HOMOGLYPHS | SUBSTITUTES).items()}


FOLDING = _folding()


def fold(text: str) -> str:
    return text.lower().translate(FOLDING)


def words_of(text: str | None) -> list[str]:
    """The folded words of a text, as far as they are letters."""
    return "".join(c if c.isalpha() else " " for c in fold(text or "")).split()


@dataclass
class Model:
    weights: dict[str, float]
    slope: float = 0.0
    offset: float = -math.inf
    exceptions: tuple[str, ...] = EXCEPTIONS

    def __post_init__(self):
        self.trie = None

    def __getstate__(self):
        return self.__dict__ | {"trie": None}

    def load(self, texts: list[str | None]) -> list[float]:
        """Weight of the matches by words of each text, on a logarithmic scale."""
        if self.trie is None:
            import ahocorasick

            self.trie = ahocorasick.Automaton()
            for word, weight in self.weights.items():
                self.trie.add_word(word, (len(word), weight))
            for phrase in self.exceptions:
                self.trie.add_word(phrase, (len(phrase), None))
            self.trie.make_automaton()
        out = []
        for text in texts:
            total, spared, found = 0.0, [], []
            folded = " ".join(fold(text or "").split())
            for last, (size, weight) in self.trie.iter(folded):
                a, b = last + 1 - size, last + 1
                if (a and folded[a - 1].isalpha()) or folded[b : b + 1].isalpha():
                    continue
                if weight is None:
                    spared.append((a, b))
                else:
                    found.append((a, b, weight))
            spared.sort()
            ends = list(accumulate((y for _, y in spared), max))  # the furthest end of the phrases up to each
            for a, b, weight in found:
                before = bisect_right(spared, a, key=lambda x: x[0])
                if not before or ends[before - 1] < b:
                    total += weight
            out.append(math.log1p(100 * total / (folded.count(" ") + 1 + 10)) if total else 0.0)
        return out

    def score(self, loads: list[float]) -> list[float]:
        return [1 / (1 + math.exp(-min(60.0, max(-60.0, self.slope * x + self.offset)))) if self.offset > -math.inf else 0.0 for x in loads]


def _train_rows(docs: DataFrame, labels: DataFrame, train) -> DataFrame:
    """text, toxic of the labelled rows that are fitted."""
    ours = labels.where(train & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    share = FIT_ROWS / max(1, ours.count())
    drawn = ours if share >= 1 else ours.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    # At most FIT_ROWS small rows with ids of their own, up to the chance of the draw: broadcast, so no text is shuffled.
    found = docs.where(train).select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    return found.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("text", "toxic").repartition(FIT_PARTS)


def fit(docs: DataFrame, labels: DataFrame, train, most_words: int | None = None) -> Model:
    """The model of the labelled rows for which the condition `train` on doc_id holds; of all words, or the surest ones."""
    import numpy as np
    import pyarrow as pa

    bound_batches(docs.sparkSession)
    rows = _train_rows(docs, labels, train).persist()

    def count(batches):
        toxic, other = Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                (toxic if label else other).update(set(words_of(text)))
        names = list(toxic)  # a word without toxic texts is never in the lexicon; the others' counts are asked for below
        others = [x for x in other if x not in toxic and len(x) <= 40]
        yield pa.RecordBatch.from_arrays([pa.array(names + others, pa.string()), pa.array([toxic[x] for x in names] + [0] * len(others), pa.int64()), pa.array([other[x] for x in names + others], pa.int64())], ["word", "toxic", "other"])

    n_toxic, n_other = (rows.where(F.col("toxic") == k).count() for k in (1, 0))
    model = Model({})
    if not n_toxic or not n_other:
        rows.unpersist()
        return model
    a, b = F.col("toxic") + 0.5, F.col("other") + 0.5
    odds = F.log(a / (n_toxic + 1 - a)) - F.log(b / (n_other + 1 - b))
    counted = rows.mapInArrow(count, "word string, toxic long, other long").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    least = max(LEAST_TEXTS, LEAST_SHARE * n_toxic)
    lexicon = counted.where(F.col("toxic") >= least).withColumn("odds", odds).withColumn("errors", odds / F.sqrt(1 / a + 1 / b)).where((F.col("odds") >= LEAST_ODDS) & (F.col("errors") >= LEAST_ERRORS))
    if most_words is not None:
        lexicon = lexicon.orderBy(F.desc("errors"), "word").limit(most_words)
    model.weights = {r.word: r.odds for r in lexicon.collect()}  # bounded by FIT_ROWS: a word is in LEAST_SHARE of the toxic ones
    weights = model.weights

    def phrases(batches):
        toxic, other = Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = fold(text or "").split()
                (toxic if label else other).update({f"{a} {b}" for a, b in zip(words, words[1:], strict=False) if a in weights or b in weights})
        names = list(toxic | other)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([x[k] for k in names], pa.int64()) for x in (toxic, other))], ["phrase", "toxic", "other"])

    sums = rows.mapInArrow(phrases, "phrase string, toxic long, other long").groupBy("phrase").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    model.exceptions = EXCEPTIONS + tuple(sorted(r.phrase for r in sums.where((F.col("toxic") == 0) & (F.col("other") >= LEAST_SPARED)).collect()))

    def loads(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(model.load(batch.column(0).to_pylist()), pa.float64()), batch.column(1)], ["x", "y"])

    fitted = rows.mapInArrow(loads, "x double, y int").toArrow()
    rows.unpersist()
    x, y = fitted["x"].to_numpy(), fitted["y"].to_numpy().astype(float)
    slope, offset = 0.0, math.log(n_toxic / n_other)
    for _ in range(25):  # Newton's method; a small penalty keeps the slope finite where classes do not overlap
        p = 1 / (1 + np.exp(-np.clip(slope * x + offset, -60, 60)))
        g = np.array([((p - y) * x).sum() + 0.1 * slope, (p - y).sum()])
        w = p * (1 - p) + 1e-9
        h = np.array([[(w * x * x).sum() + 0.1, (w * x).sum()], [(w * x).sum(), w.sum()]])
        step = np.linalg.solve(h, g)
        slope, offset = slope - float(step[0]), offset - float(step[1])
    model.slope, model.offset = slope, offset
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, matched_load of each whole text."""
    import pyarrow as pa

    bound_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType

    def run(batches):
        for batch in batches:
            loads = model.load(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(loads), pa.float64()), pa.array(loads, pa.float64())], ["doc_id", "score", "load"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind.simpleString()}, score double, load double")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: scores of all documents, learned from the rows that are not held out."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{x}.parquet") for x in ("documents", "labels"))
    docs = spread(docs)
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = fit(docs, labels, ~held_out)
    return score(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "load")
