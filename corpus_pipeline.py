"""From documents to packed training sequences: five stages, each on all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of docs.  n_chars, if
there is such a column, follows the text.  Null texts are rejected by the first stage.  Empty tables give empty ones;
null and repeated doc_ids, repeated rows and further columns of any names stay, unless a stage says otherwise.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import apart, shared_table, spread
from corpusloom.llm.language import UNKNOWN, fit, identify
from corpusloom.llm.line_dedup import line_dedup
from corpusloom.llm.ngram_join import ngram_join
from corpusloom.llm.packing import INSTRUCTION, pack_documents
from corpusloom.llm.secrets import redacted

END_ID = 2


PLAIN = ("doc_id", "text", "lang", "source", "n_chars")


def _own_names(stage):
    """A stage that returns the columns it was given; further ones have names inside that clash with none."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        inside, named = apart(docs, *PLAIN)
        return named(stage(spark, inside, sf_dir))

    return run


def _columns(docs: DataFrame) -> list[str]:
    return [f"`{x}`" for x in docs.columns]


def _measured(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


@_own_names
def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a language: null texts and those without any letter.  All other rows stay, each by itself."""
    return identify(docs, fit(docs, F.lit(True))).where(F.col("__lang") != UNKNOWN).select(*_columns(docs))


@_own_names
def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out passages that an earlier document has; documents of which nothing is left go.  Rows without a doc_id stay as
    they are, and so do rows that repeat a doc_id beside each other."""
    out = line_dedup(docs)
    emptied = (F.col("__gone_chunks") > 0) & (F.col("text") == "")
    return _measured(out.where(~emptied).select(*_columns(docs)))


@_own_names
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id stays (and of rows that repeat that doc_id the
    one with the smallest hash of its text); rows equal in doc_id and text are one.  Rows that repeat a doc_id with texts
    that are no duplicates all stay, as do rows without a doc_id and documents without words."""
    keyed = docs.withColumn("__digest", F.xxhash64("text"))
    found = ngram_join(keyed, carry=("__digest",)).where("doc_id is not null")
    first = F.struct("doc_id", "__digest")
    linked = found.where("set_id is not null").groupBy("group_id").agg(F.min(first).alias("first")).select("first.*")
    kept = linked.union(found.where("set_id is null").select("doc_id", "__digest")).distinct()
    names = [x for x in docs.columns if x not in ("doc_id", "text")]
    whole = F.struct(*(f"`{x}`" for x in names))
    # by the row's JSON: not every type has an order
    rest = [F.min_by(whole, F.to_json(whole)).alias("__rest")] if names else []
    one = keyed.join(kept, ["doc_id", "__digest"], "left_semi").groupBy("doc_id", "__digest").agg(F.first("text").alias("text"), *rest)
    restored = [F.col(x) if x in ("doc_id", "text") else F.col("__rest").getField(x).alias(x) for x in docs.columns]
    return one.select(*restored).unionByName(docs.where("doc_id is null"))


@_own_names
def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets; values without a known shape stay if many texts of many owners have them.  All rows stay."""
    return _measured(redacted(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences; the first line of a document is its prompt.  Every row is packed, whatever its doc_id."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), END_ID, INSTRUCTION, prompt_line=True)


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("secret_scan", secret_stage),
    ("packing", packing_stage),
]

#: SQL expresses none of the learned, content-defined and packing stages; tests/llm/test_pipeline.py holds run() against a
#: plain version of all stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    for name, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
