"""Raw files as tables: scans, decoding, kinds of files, glob selection, JSON lines."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import newlines, stripped

# Extensions by the kind of source, and the least length of a cleaned document.
EXTENSIONS = {
    "docs": (".rst", ".md", ".markdown"),
    "code": (".py", ".cpp", ".hpp", ".h", ".c", ".cc"),
    "interfaces": (".msg", ".srv", ".action"),
    "notebooks": (".md", ".ipynb"),
}
LEAST_CHARS = {"docs": 400, "code": 300, "interfaces": 200, "notebooks": 400, "paper": 2000}


def extension(path: Column) -> Column:
    """The extension in lower case with its point; empty for names that have none or begin with their only point."""
    return F.lower(F.regexp_extract(path, r"[^/.][^/]*?(\.[^./]+)\z", 1))


def stem(path: Column) -> Column:
    name = F.regexp_extract(path, r"([^/]+)\z", 1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]+\z", "")


def _either(names: tuple[str, ...], start: str = "*") -> str:
    """A glob of names in any case."""
    return start + "{" + ",".join("".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in x) for x in names) + "}"


def scan(spark: SparkSession, root: str, extensions: tuple[str, ...] = ()) -> DataFrame:
    """rel_path, ext, content, path_parts of all files below root (a/b.md sorts by its parts).  Wanted extensions (in lower
    case) go to the listing of files as a glob, so no others are opened."""
    rows = _read(spark, root, [root], _either(extensions) if extensions else None)
    if extensions:
        rows = rows.where(F.col("ext").isin(*extensions))
    return rows.withColumn("path_parts", F.split("rel_path", "/", -1))


def _read(spark: SparkSession, root: str, paths: list[str], glob: str | None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    inside = F.regexp_replace("path", F.lit(rf"^.*?{re.escape(root.rstrip('/').removeprefix('file:'))}/"), F.lit(""))
    return reader.load(paths).select(inside.alias("rel_path"), "content").withColumn("ext", extension(F.col("rel_path")))


def folders(spark: SparkSession, root: str) -> set[str]:
    """The names of the folders in root, by one listing; none if there is no root."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return {x.getPath().getName() for x in store.listStatus(path) if x.isDirectory()} if store.exists(path) else set()


def scan_sources(spark: SparkSession, root: str, sources: list[str], names: tuple[str, ...], whole_names: bool = False) -> DataFrame:
    """source_id, rel_path (in the source's folder), ext, content, path_parts of the files of many sources in one scan: each
    has a folder in root.  names are endings, or whole names, of the files that are opened; sources must be there."""
    rows = _read(spark, root, [f"{root.rstrip('/')}/{x}" for x in sources], _either(names, "" if whole_names else "*"))
    parts = F.split("rel_path", "/", -1)
    apart = rows.withColumn("source_id", F.get(parts, 0)).withColumn("path_parts", F.slice(parts, 2, 1 << 30))
    return apart.withColumn("rel_path", F.array_join("path_parts", "/"))


def listing(spark: SparkSession, root: str, sources: list[str], names: tuple[str, ...]) -> DataFrame:
    """source_id and digest (of paths, sizes and times, in any order) of the files that scan_sources would read; contents
    are not read.  Sources without such files have no row."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", _either(names))
    inside = F.regexp_replace("path", F.lit(rf"^.*?{re.escape(root.rstrip('/').removeprefix('file:'))}/"), F.lit(""))
    found = reader.load([f"{root.rstrip('/')}/{x}" for x in sources]).select(inside.alias("path"), "modificationTime", "length")
    one = F.xxhash64("path", "modificationTime", "length")
    sums = found.groupBy(F.substring_index("path", "/", 1).alias("source_id")).agg(F.count("*").alias("n"), F.bit_xor(one).alias("x"), F.bit_xor(F.xxhash64(one)).alias("y"))
    return sums.select("source_id", F.concat_ws("-", "n", "x", "y").alias("digest"))


def strict_text(content: Column) -> Column:
    """UTF-8 text with line breaks as newlines; null if the bytes are no UTF-8."""
    text = content.cast("string")
    return F.when(F.is_valid_utf8(text), newlines(text))


def lenient_text(content: Column) -> Column:
    """UTF-8 text, with U+FFFD for what is no UTF-8."""
    return F.make_valid_utf8(content.cast("string"))


def file_kind(content: Column) -> Column:
    """What the first bytes say that a file is."""

    def begins(hex_bytes: str) -> Column:
        return F.startswith(F.hex(F.substring(content, 1, 8)), F.lit(hex_bytes))

    head = F.lower(F.make_valid_utf8(F.substring(content, 1, 1024).cast("string")))
    page = F.regexp_like(head, F.lit(r"\A[ \t\n\r\x0b\f]*(<!doctype html|<html)"))
    return F.when(begins("255044462D"), "PDF").when(page, "HTML").when(begins("504B0304"), "ZIP").when(begins("89504E47"), "PNG").when(begins("FFD8FF"), "JPEG").otherwise("unknown")


def _glob(pattern: str) -> str:
    """A glob as a pattern of whole relative paths: ** is any number of folders, * and ? stay within one."""
    out = ""
    for part in re.split(r"(\*\*/|\*\*|\*|\?|\[[^\]]*\])", pattern):
        out += {"**/": r"(?:[^/]+/)*", "**": r".*", "*": r"[^/]*", "?": r"[^/]"}.get(part) or (part if part.startswith("[") else re.escape(part))
    return out


def selected(path: Column, include: list[str], exclude: list[str] = ()) -> Column:
    """Whether a relative path is in one of the included globs and in no excluded one.

    An excluded glob applies to the end of a path, and to its start as plain text without stars and slashes at the end.
    """
    wanted = F.lit(False)
    for g in include:
        wanted |= F.regexp_like(path, F.lit(rf"\A{_glob(g)}\z"))
    for g in exclude:
        ending = rf"(?:\A|/){_glob(g.replace('**', '*'))}\z"
        wanted &= ~(F.regexp_like(path, F.lit(ending)) | F.startswith(path, F.lit(g.rstrip("*").rstrip("/"))))
    return wanted


def best_file(files: DataFrame, key: str, preferred: str, name: str = "name") -> DataFrame:
    """For each key the preferred file if it is there, else the first by name."""
    order = F.struct((F.col(name) != F.coalesce(F.col(preferred), F.lit(""))).cast("int"), F.col(name))
    return files.groupBy(key).agg(F.min_by(name, order).alias("file"))


#: Why a line is in quarantine.
MALFORMED, MISFIT = "malformed line", "line that does not fit the schema"


def parsed_lines(lines: DataFrame, schema: str, line: str = "line") -> DataFrame:
    """lines with `record` (of the schema; null in quarantine) and `reason` (null for records).  Blank lines are none.

    A line that is no JSON is malformed; one that is, but no object or with a value of another type, is a misfit.  So every
    other line is either a record or in quarantine.
    """
    bad = "corrupt_line_"
    found = F.from_json(line, f"{schema}, {bad} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad})
    rows = lines.where(F.regexp_like(line, F.lit(r"\S"))).withColumn("__found", found)
    value = F.try_parse_json(line)
    # Parsers stop behind the first value.  What follows it shows in one of these: it cannot close an array and an object.
    text = F.col(line)
    in_array, in_object = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))), F.try_parse_json(F.concat(F.lit('{"x":'), text, F.lit("}")))
    whole = value.isNotNull() & F.coalesce(in_array == 1, F.lit(False)) & in_object.isNotNull()
    # an array of objects is read as its first one: only an object is a record
    fits = F.col("__found").isNotNull() & F.col(f"__found.{bad}").isNull() & F.startswith(F.coalesce(F.schema_of_variant(value), F.lit("")), F.lit("OBJECT"))
    reason = F.when(~whole, MALFORMED).when(~fits, MISFIT)
    names = [F.col("__found").getField(x.name).alias(x.name) for x in rows.schema["__found"].dataType.fields if x.name != bad]
    return rows.withColumn("reason", reason).withColumn("record", F.when(F.col("reason").isNull(), F.struct(*names))).drop("__found")


def read_json_lines(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(records of a declared schema, a record a line; quarantine: path, line, reason).  Both together have all lines but
    blank ones."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"))
    parsed = parsed_lines(lines, schema)
    return parsed.where("reason is null").select("record.*"), parsed.where("reason is not null").select("path", "line", "reason")


def write_json_lines(docs: DataFrame, path: str, order: list[str] | None = None) -> None:
    """Records without their null fields.  With an order, records are sorted over all files in it."""
    rows = docs.repartitionByRange(*order).sortWithinPartitions(*order) if order else docs
    rows.write.mode("overwrite").option("ignoreNullFields", "true").json(path)


def replace_rows(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """A table with the rows of the keys in `new` replaced by those."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def notebook_text(raw: Column, name: Column, clean_cell) -> Column:
    """The cells of a notebook as Markdown, outputs left out; null if it is no JSON.  clean_cell cleans a Markdown cell."""
    cells = F.from_json(raw, "cells array<struct<cell_type:string,source:string>>")["cells"]

    def block(cell: Column) -> Column:
        lines = F.from_json(cell["source"], "array<string>")
        body = stripped(F.coalesce(F.array_join(lines, ""), cell["source"], F.lit("")))
        shown = F.when(cell["cell_type"] == "markdown", F.array(clean_cell(body), F.lit(""))).when(cell["cell_type"] == "code", F.array(F.lit("```python"), body, F.lit("```"), F.lit(""))).otherwise(F.array(F.lit("")))
        return F.when(body == "", F.expr("cast(array() as array<string>)")).otherwise(shown)

    heading = F.array(F.concat(F.lit("# "), name), F.lit(""))
    valid = F.try_parse_json(raw).isNotNull()
    return F.when(valid, F.array_join(F.concat(heading, F.flatten(F.transform(F.coalesce(cells, F.array()), block))), "\n"))
