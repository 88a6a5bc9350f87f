"""Secret scan with corpus-wide ownership frequency, in DataFrame operations only.

Base spans are what three fixed patterns find, each leftmost and without overlaps, with matches dropped that are too short:
assign, access, hex.  Besides, long mixed strings without a known shape are candidates.  Every candidate value is hashed,
and the hashes are aggregated over the corpus by distinct repositories and distinct owners.  A value in several
repositories of several owners is a widely copied example; one that stays with one owner looks live.  Unknown-shape
candidates become spans (kind owned) only if they look live and overlap no base span; base spans always stay.

A repository is the source, and its owner what stands before a '/' in it, unless other columns are given.  Texts are read whole; offsets are code points,
ends exclusive.  Counting goes by partial sums over (value, repository), so a value in a third of all rows is one row a
repository and task; values are joined back by a join that Spark can split.

Edge cases: a null text is an empty one; a null source is one of its own.  Rows are told apart by themselves, so null and
repeated doc_ids keep their own spans.  Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import apart, shared_table

# The patterns of the three base kinds, and the least length of a match's value.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST = 6
KINDS = ("assign", "access", "hex", "owned")
#: Candidates without a known shape: so long, with digits and letters, and so many different characters.
MIXED = r"[A-Za-z0-9+/_-]{20,}"
MIXED_DIFFERENT = 10
#: A value is widely copied if it is in so many repositories and belongs to so many owners at least.
COPIED_REPOSITORIES = COPIED_OWNERS = 2
#: Redaction asks for more: so many different texts and owners at least, and half of the owners up to EXAMPLE_MANY, or one
#: in EXAMPLE_SHARE of them where that is more.
EXAMPLE_LEAST, EXAMPLE_MANY, EXAMPLE_SHARE = 3, 10, 1000

SPAN = "struct<start:int,kind:int,end:int,value:string>"


def _spans(text: str, pattern: str, kind: int, group: int = 0, keep: Callable[[Column], Column] = lambda v: F.lit(True)) -> Column:
    """array<SPAN> of a pattern's matches; keep is a condition on the value, the match's given group.

    Splitting at the matches gives the texts between them, and so the places of the matches.
    """
    t, p = F.col(text), F.lit(pattern)
    found = F.regexp_extract_all(t, p, F.lit(0))
    values = F.regexp_extract_all(t, p, F.lit(group)) if group else found
    none = F.expr(f"cast(array() as array<{SPAN}>)")
    zipped = F.filter(F.arrays_zip(F.split(t, pattern, -1).alias("p"), found.alias("m"), values.alias("v")), lambda x: x["m"].isNotNull())

    def with_places(matches: Column) -> Column:
        ends = _running(F.transform(matches, lambda x: F.length(x["p"]) + F.length(x["m"])))
        spans = F.zip_with(matches, ends, lambda x, end: F.struct((end - F.length(x["m"])).alias("start"), F.lit(kind).alias("kind"), end.alias("end"), x["v"].alias("value")))
        return F.filter(spans, lambda x: keep(x["value"]))

    return F.when(F.regexp_like(t, p), _let(zipped, with_places)).otherwise(none)


def _let(value: Column, function: Callable[[Column], Column]) -> Column:
    """function(value), with the value computed once."""
    return F.get(F.transform(F.array(value), lambda x: function(x)), 0)


def _running(sizes: Column) -> Column:
    """Running sums of array<int>, by doubling: as many passes as the length has binary digits."""
    steps = F.sequence(F.lit(0), F.length(F.bin(F.size(sizes).cast("long"))) - 1)
    return F.aggregate(steps, sizes, lambda held, k: F.transform(held, lambda x, i: x + F.coalesce(F.get(held, i - F.pow(F.lit(2), k).cast("int")), F.lit(0))))


def _long_enough(value: Column) -> Column:
    return F.length(value) >= ASSIGN_LEAST


def _is_mixed(value: Column) -> Column:
    return F.regexp_like(value, F.lit("[0-9]")) & F.regexp_like(value, F.lit("[A-Za-z]")) & (F.size(F.array_distinct(F.split(value, ""))) >= MIXED_DIFFERENT)


def _joined(spans: Column) -> Column:
    """kind:start:end of sorted spans, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))


def owner_of(repository: Column) -> Column:
    """What stands before the first '/' of a repository's name."""
    return F.substring_index(repository, "/", 1)


def scan(docs: DataFrame, *kept: str, repository: Column | None = None, owner: Column | None = None) -> DataFrame:
    """Written table with a row per document: __row, the kept columns, __base (base spans), __found (all candidates with
    the hash of their values), __repository, __owner."""
    where = F.col("source") if repository is None else repository
    whose = owner_of(where) if owner is None else owner
    parsed = (
        docs.select(F.monotonically_increasing_id().alias("__row"), *kept, F.coalesce("text", F.lit("")).alias("__text"), F.coalesce(where, F.lit("")).alias("__repository"), F.coalesce(whose, F.lit("")).alias("__owner"))
        .withColumn("__base", F.concat(_spans("__text", ASSIGN, 0, 2, _long_enough), _spans("__text", ACCESS, 1), _spans("__text", HEX, 2)))
        .withColumn("__mixed", _spans("__text", MIXED, 3, 0, _is_mixed))
    )
    free = F.filter("__mixed", lambda m: ~F.exists("__base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
    hashed = F.transform(F.concat("__base", free), lambda s: F.struct(s["start"], s["kind"], s["end"], F.xxhash64(s["value"]).alias("hash"), F.length(s["value"]).alias("size")))
    places = F.transform("__base", lambda s: F.struct(s["start"], s["kind"], s["end"]))
    return shared_table(parsed.select("__row", *kept, places.alias("__base"), hashed.alias("__found"), "__repository", "__owner"), "secret-candidates")


def ownership(scanned: DataFrame) -> DataFrame:
    """hash, size, repositories, owners, occurrences of every candidate value of the corpus."""
    each = scanned.select("__repository", F.col("__owner").alias("owner"), F.explode("__found").alias("s")).select("__repository", "owner", "s.hash", "s.size")
    by_repository = each.groupBy("hash", "size", "owner", "__repository").agg(F.count("*").alias("n"))
    by_owner = by_repository.groupBy("hash", "size", "owner").agg(F.count("*").alias("repositories"), F.sum("n").alias("n"))
    return by_owner.groupBy("hash", "size").agg(F.sum("repositories").alias("repositories"), F.count("*").alias("owners"), F.sum("n").alias("occurrences"))


def judged(scanned: DataFrame) -> DataFrame:
    """__row with __spans (array of start, kind, end, copied): all spans that stay of each document with candidates."""
    known = shared_table(ownership(scanned).select("hash", "size", ((F.col("repositories") >= COPIED_REPOSITORIES) & (F.col("owners") >= COPIED_OWNERS)).alias("copied")), "secret-ownership")
    each = scanned.select("__row", F.explode("__found").alias("s")).select("__row", "s.*").join(known, ["hash", "size"])
    kept = each.where(~F.col("copied") | (F.col("kind") < 3))
    return kept.groupBy("__row").agg(F.collect_list(F.struct("start", "kind", "end", "copied")).alias("__spans"))


def secret_spans(docs: DataFrame, repository: Column | None = None, owner: Column | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_owned, n_copied (spans of widely copied values).

    repository and owner say where a document is from and whose that is: by default the source, and what stands before a '/'
    in it.  Two repositories of one owner do not make a value copied.
    """
    scanned = scan(docs, "doc_id", repository=repository, owner=owner)
    spans = F.coalesce("__spans", F.expr("cast(array() as array<struct<start:int,kind:int,end:int,copied:boolean>>)"))
    rows = scanned.join(judged(scanned), "__row", "left").select("doc_id", "__base", spans.alias("__spans"))

    def n(column: str, test) -> Column:
        return F.size(F.filter(column, test)).cast("long")

    def of(kind: int):
        return lambda s: s["kind"] == kind

    return rows.select(
        "doc_id",
        *(n("__base", of(k)).alias(f"n_{KINDS[k]}") for k in range(3)),
        F.sha2(_joined(F.col("__base")), 256).alias("base_sha256"),
        _joined(F.col("__spans")).alias("spans"),
        n("__spans", of(3)).alias("n_owned"),
        n("__spans", lambda s: s["copied"]).alias("n_copied"),
    )


def _unmasked(scanned: DataFrame) -> DataFrame:
    """hash, size of the values that redaction leaves where they have no known shape: in many different texts of many owners."""
    owner = F.col("__owner")
    owners = scanned.select(owner).distinct().count()
    least = max(EXAMPLE_LEAST, min(EXAMPLE_MANY, -(-owners // 2)), -(-owners // EXAMPLE_SHARE))
    each = scanned.select(owner.alias("owner"), "__digest", F.explode("__found").alias("s")).select("owner", "__digest", "s.hash", "s.size")
    counted = each.groupBy("hash", "size").agg(F.count_distinct("owner").alias("owners"), F.count_distinct("__digest").alias("texts"))
    return counted.where((F.col("owners") >= least) & (F.col("texts") >= least)).select("hash", "size", F.lit(True).alias("example"))


def redacted(given: DataFrame, marker: str = "[SECRET]") -> DataFrame:
    """docs with every base span, and every candidate without a known shape but for examples, replaced by the marker.

    Examples are in many different texts (case and white space apart, so copies of a text count once) of many owners; see
    EXAMPLE_LEAST.  Overlapping spans make one marker.  Documents without spans are not shuffled.  Rows are told apart by
    themselves, and columns of any names stay as they are.
    """
    docs, named = apart(given, "text", "source")
    names = docs.columns
    scanned = scan(docs.withColumn("__digest", F.xxhash64(F.regexp_replace(F.lower(F.trim("text")), r"\s+", " "))), *(f"`{x}`" for x in names), "__digest")
    clean, rest = (scanned.where(x) for x in ("size(__found) = 0", "size(__found) > 0"))
    unmasked = shared_table(_unmasked(scanned), "secret-examples")
    each = rest.select("__row", F.explode("__found").alias("s")).select("__row", "s.*").join(unmasked, ["hash", "size"], "left")
    masked = each.where((F.col("kind") < 3) | F.col("example").isNull()).groupBy("__row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("__spans"))
    spans = F.array_sort(F.coalesce("__spans", F.array()))

    def add(held: Column, s: Column) -> Column:
        fresh = s["start"] >= held["at"]
        between = F.substring("text", held["at"] + 1, s["start"] - held["at"])
        return F.struct(F.greatest(held["at"], s["end"]).alias("at"), F.when(fresh, F.concat(held["out"], between, F.lit(marker))).otherwise(held["out"]).alias("out"))

    text = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), add, lambda held: F.concat(held["out"], F.substring("text", held["at"] + 1, F.length("text"))))
    done = rest.join(masked, "__row", "left").withColumn("text", F.when(F.size(spans) > 0, text).otherwise(F.col("text")))
    return named(clean.select(*(f"`{x}`" for x in names)).unionByName(done.select(*(f"`{x}`" for x in names))))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: the secret spans of all documents."""
    return secret_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
