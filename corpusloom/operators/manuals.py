"""Manuals: from PDF files to documents, by their text layer or else by optical recognition.

A file goes through these checks, each of which is either passed or gives an error that says what to do: it must be a PDF by
its first bytes; its cleaned text must have LEAST_CHARS characters, or else recognition must be on and give as many.  The
pages' texts come from a function, so that any extractor can be plugged in.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import hooks
from ..sources.files import file_kind
from ..staging import bound_batches, shared_table
from . import pages as P

#: Characters below which a text layer does not count; what a writer is told, and how much of a text it gets.
LEAST_CHARS = 200
FORMAT_PROMPT = "Reformat the following robot manual excerpt. Keep all facts and numbers verbatim.\n\n"
FORMAT_CHARS = 12_000
#: What a writer of manuals is told to be.
FORMATTER = "Turn excerpts of robot manuals into clean plain text. Keep each fact, figure and unit as it is, leave page furniture out, and add nothing."


def recognised_texts(images: DataFrame, key: list[str], name: str | None = None, most_pages: int | None = None) -> DataFrame:
    """key, r (struct<text, confidence, n_pages, n_pages_with_text, note>) of rendered pages: rows (key, page, band, image).

    Bands of a page are joined in order, pages with text too.  most_pages bounds the pages of a document that are read; the
    note says how many were not.
    """
    wanted = images if most_pages is None else images.where(F.col("page") <= most_pages)
    blocks = wanted.withColumn("blocks", hooks.recognised(F.col("image"), name)).withColumn("b", P.joined_blocks(F.col("blocks")))
    bands = F.array_sort(F.collect_list(F.struct("band", F.col("b.text").alias("text"), F.col("b.confidence").alias("confidence"))))
    by_page = blocks.groupBy(*key, "page").agg(bands.alias("bands"))
    text = P.joined_bands(F.transform("bands", lambda x: x["text"]))
    sure = F.filter(F.transform("bands", lambda x: x["confidence"]), lambda x: x > 0)
    confidence = F.when(F.size(sure) > 0, F.aggregate(sure, F.lit(0.0), lambda a, b: a + b) / F.size(sure)).otherwise(0.0)
    read = by_page.select(*key, "page", F.struct(text.alias("text"), confidence.alias("confidence")).alias("p"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("page", "p"))), lambda x: x["p"])
    documents = read.groupBy(*key).agg(P.recognised_document(ordered).alias("r"))
    total = images.groupBy(*key).agg(F.count_distinct("page").alias("__all"))
    skipped = F.col("__all") - F.col("r.n_pages")
    note = F.when(skipped > 0, F.concat(skipped.cast("string"), F.lit(" pages were not read")))
    return documents.join(total, key).select(*key, F.col("r").withField("note", note).alias("r"))


def remembered(recognise: Callable[[DataFrame], DataFrame], path: str) -> Callable[[DataFrame], DataFrame]:
    """recognise (see manual_documents) with its results kept in a folder, so that a file whose content is known is not
    recognised again.  Results of another hooks.CACHE_VERSION do not count."""
    key = ["robot_id", "name", "digest"]
    columns = "robot_id string, name string, digest string, r struct<text:string,confidence:double,n_pages:int,n_pages_with_text:int,note:string>, version int"

    def run(wanted: DataFrame) -> DataFrame:
        spark = wanted.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        there = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
        cache = spark.read.schema(columns).parquet(path) if there else spark.createDataFrame([], columns)
        named = wanted.withColumn("digest", F.sha2("content", 256))

        def make(missing: DataFrame) -> DataFrame:
            found = recognise(missing.drop("digest"))
            return missing.select(*key).join(found, key[:2]).select(*key, "r")

        rows = hooks.with_cache(named, cache, make, key)
        known = cache.where(F.col("version") == hooks.CACHE_VERSION).select(*key)
        rows.join(known, key, "left_anti").select(*key, F.col("r").cast(cache.schema["r"].dataType).alias("r"), "version").write.mode("append").parquet(path)
        return rows.select(*key[:2], "r")

    return run


def formatted(text: Column, writer: str | None) -> Column:
    """What a writer makes of the first FORMAT_CHARS characters (the rest is lost); the text itself for the template."""
    if writer is None or hooks.writer(writer) is None:
        return text
    return F.trim(hooks.written(F.concat(F.lit(FORMAT_PROMPT), F.substring(text, 1, FORMAT_CHARS)), writer, FORMATTER))


def manual_documents(files: DataFrame, extract: Callable[[DataFrame], DataFrame], recognise: Callable[[DataFrame], DataFrame] | None = None, writer: str | None = None) -> DataFrame:
    """files (robot_id, name, content and further columns) with text, ocr, ocr_confidence, extraction, n_pages and error.

    extract turns rows with content into rows with pages (array<string>).  recognise turns rows (robot_id, name, content)
    into robot_id, name, r as recognised_texts gives; without it a file without a text layer is an error.  Rows with an
    error have a null text; every file is in the result.
    """
    bound_batches(files.sparkSession)
    key = ["robot_id", "name"]
    kind = F.coalesce(file_kind(F.col("content")), F.lit("unknown"))
    kinds = files.withColumn("__kind", kind)
    pages = extract(kinds.where("__kind = 'PDF'").drop("__kind"))
    pdf = shared_table(pages.withColumn("text", P.clean_pages(F.col("pages"))).withColumn("n_pages", F.size("pages")).drop("pages"), "manual-pages")
    full, bare = pdf.where(F.length("text") >= LEAST_CHARS), pdf.where(F.coalesce(F.length("text"), F.lit(0)) < LEAST_CHARS)
    found = F.concat(F.col("name"), F.lit(": only "), F.coalesce(F.length("text"), F.lit(0)).cast("string"), F.lit(" characters extracted ("), F.col("n_pages").cast("string"), F.lit(" pages)"))
    native = full.select("*", F.lit(False).alias("ocr"), F.lit(None).cast("double").alias("ocr_confidence"), F.lit("native").alias("extraction"), F.lit(None).cast("string").alias("error"))
    if recognise is None:
        scanned = bare.select("*", F.lit(False).alias("ocr"), F.lit(None).cast("double").alias("ocr_confidence"), F.lit("native").alias("extraction"), F.concat(found, F.lit(", probably a scan; turn recognition on or drop the manual")).alias("error"))
    else:
        wanted = files.join(bare.select(*key), key, "left_semi").select(*key, "content")
        read = bare.join(recognise(wanted), key, "left").withColumn("__layer", found).withColumn("text", P.clean_pages(F.array(F.col("r.text"))))
        enough = F.coalesce(F.length("text"), F.lit(0)) >= LEAST_CHARS
        error = F.when(F.col("r").isNull(), F.concat("__layer", F.lit(", and nothing was recognised"))).when(~enough, F.concat("__layer", F.lit("; recognition gave only "), F.length("text").cast("string"), F.lit(" usable characters: drop the manual")))
        scanned = read.select("*", F.lit(True).alias("ocr"), F.bround("r.confidence", 4).alias("ocr_confidence"), F.lit("ocr").alias("extraction"), error.alias("error")).drop("r", "__layer")
    wrong = F.concat(F.col("name"), F.lit(" is not a PDF: its content looks like "), F.col("__kind"), F.lit("; download it again"))
    other = kinds.where("__kind <> 'PDF'").select(*[x for x in files.columns if x != "content"], F.lit(None).cast("string").alias("text"), F.lit(0).alias("n_pages"), F.lit(False).alias("ocr"), F.lit(None).cast("double").alias("ocr_confidence"), F.lit("none").alias("extraction"), wrong.alias("error"))
    every = native.unionByName(scanned).unionByName(other)
    return every.withColumn("text", F.when(F.col("error").isNull(), P.shortened(formatted(F.col("text"), writer))))
