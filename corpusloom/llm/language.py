"""Language identification by error-correcting output codes.

Every language has a codeword of +1 and -1.  For each bit a binary classifier weighs the byte n-grams of a text: by the log
of the ratio of their shares in the languages on the two sides.  Decoding adds up a loss for each language over the bits,
each bit weighted by how far apart it keeps the languages; the codeword with the least loss wins, and a text whose two best
codewords are near each other is flagged as ambiguous.

Only letters count: text is lower-cased, and runs of anything else are one blank.  Training reads whole texts of a bounded
sample, at most PER_LANGUAGE documents a language up to the chance of a draw by hash of doc_id and text (rows equal in both
are drawn together).  All languages are learned; most_languages can bound them.

Edge cases: a text that is null or has no letter is `und` with score 0; so is every text if no language was learned.  A
single learned language is always predicted.  Of languages with equal losses the first by name wins, and the text is
ambiguous.  A text of fewer bytes than an n-gram is one n-gram, filled up with blanks.  Rows with a null language are no
training data.  One row out for each row in, repeated ones too.  Input columns named __lang, __score or __ambiguous are
replaced.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound_batches, spread

PER_LANGUAGE, FIT_PARTS = 4000, 12
#: n-grams are of N bytes and hashed to 2^BITS buckets.
N, BITS = 4, 16
#: A result is ambiguous if the probability of the second language is so large beside the first's.
AMBIGUOUS = 0.2
UNKNOWN = "und"

LETTER = re.compile(r"[^\W\d_]")
#: Bytes of letters stay (all of non-ASCII UTF-8 does); others are blanks.
FOLDED = bytes(i if i >= 128 or chr(i).isalpha() else 32 for i in range(256))
GAPS = re.compile(rb" {2,}")


def codewords(k: int):
    """A k x bits matrix of +1 and -1: all two-sided splits for few languages, else the best of random codes."""
    import numpy as np

    if k <= 6:
        return np.array([(1, *x) for x in product((-1, 1), repeat=k - 1) if -1 in x], dtype=np.float64).T if k > 1 else np.ones((1, 1))
    draw, bits, best, apart = np.random.default_rng(5), math.ceil(10 * math.log2(k)), None, -1
    for _ in range(50):
        code = draw.choice((-1.0, 1.0), size=(k, bits))
        same = code @ code.T
        np.fill_diagonal(same, -bits)
        if (np.abs(code.sum(axis=0)) < k).all() and (d := (bits - same.max()) / 2) > apart:
            best, apart = code, d
    return best


def buckets(text: str):
    """The bucket of each n-gram of the letters of a text."""
    import numpy as np

    raw = GAPS.sub(b" ", b" " + text.lower().encode().translate(FOLDED) + b" ").ljust(N)
    b = np.frombuffer(raw, dtype=np.uint8).astype(np.uint32)
    h = np.zeros(len(b) - N + 1, dtype=np.uint32)
    for i in range(N):
        h |= b[i : len(b) - N + 1 + i] << np.uint32(8 * i)
    h *= np.uint32(0x9E3779B1)
    return h >> np.uint32(32 - BITS)


@dataclass
class Model:
    languages: list[str]
    weights: object = None
    code: object = None
    spread: object = None

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, probability, whether it is ambiguous)."""
        import numpy as np

        if not self.languages or not text or not LETTER.search(text):
            return UNKNOWN, 0.0, False
        at = buckets(text)
        margins = np.take(self.weights, at, axis=0).mean(axis=0, dtype=np.float64) / self.spread
        loss = np.log1p(np.exp(-4 * self.code * margins)) @ self.spread / self.spread.sum()
        p = np.exp(2 * (loss.min() - loss))
        p /= p.sum()
        best = int(np.argmax(p))
        second = float(np.max(np.delete(p, best))) if len(p) > 1 else 0.0
        return self.languages[best], float(p[best]), second >= AMBIGUOUS * p[best]


def fit(docs: DataFrame, train, most_languages: int | None = None) -> Model:
    """The model of the documents for which the condition `train` holds; of all languages, or the most frequent ones."""
    import numpy as np
    import pyarrow as pa

    bound_batches(docs.sparkSession)
    ours = docs.where(train & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counted = ours.groupBy("lang").count()
    if most_languages is not None:
        counted = counted.orderBy(F.desc("count"), "lang").limit(most_languages)
    sizes = {r.lang: r["count"] for r in counted.collect()}  # a row a language
    model = Model(sorted(sizes))
    if not sizes:
        return model
    shares = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, math.ceil(min(1, PER_LANGUAGE / n) * (1 << 20)))])
    drawn = ours.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < F.element_at(shares, F.col("lang"))).select("text", "lang").repartition(FIT_PARTS)

    def count(batches):
        sums: dict[str, object] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                got = np.bincount(buckets(text), minlength=1 << BITS)
                sums[lang] = sums[lang] + got if lang in sums else got
        yield pa.RecordBatch.from_arrays([pa.array(sums, pa.string()), pa.array([x.astype("<i8").tobytes() for x in sums.values()], pa.binary())], ["lang", "counts"])

    counts = np.full((len(model.languages), 1 << BITS), 0.0)
    for row in drawn.mapInArrow(count, "lang string, counts binary").collect():  # FIT_PARTS x languages rows
        counts[model.languages.index(row.lang)] += np.frombuffer(bytes(row.counts), dtype="<i8")
    shares_of = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True)
    code = codewords(len(model.languages))
    up, down = (code == 1).astype(float), (code == -1).astype(float)
    above, below = (side.T @ shares_of / np.maximum(side.sum(axis=0), 1)[:, None] for side in (up, down))
    weights = np.log((above + 1e-9) / (below + 1e-9)).T if len(model.languages) > 1 else np.ones((1 << BITS, 1))
    expected = np.abs(shares_of @ weights)
    model.weights, model.code, model.spread = weights.astype(np.float32), code, np.maximum(expected.min(axis=0), 1e-3)
    return model


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """docs with __lang, __score, __ambiguous."""
    import pyarrow as pa

    bound_batches(docs.sparkSession)
    docs = docs.drop("__lang", "__score", "__ambiguous")
    names = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2^BITS x bits numbers

    def run(batches):
        for batch in batches:
            got = list(zip(*map(shared.value.predict, batch.column("text").to_pylist()), strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got[0], pa.string()), pa.array(got[1], pa.float64()), pa.array(got[2], pa.bool_())], [*names, "__lang", "__score", "__ambiguous"])

    fields = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in docs.schema)
    return docs.mapInArrow(run, f"{fields}, __lang string, __score double, __ambiguous boolean")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: the language of all documents, learned from those that are not held out."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    found = identify(docs.select("doc_id", "text"), fit(docs, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), F.col("__lang").alias("lang_pred"), F.col("__score").alias("score"), F.col("__ambiguous").alias("ambiguous"))
