"""From raw files to candidate documents.

A candidate has doc_id, source_id, family, kind, rel_path, grp, text, flags, and what orders it: path_parts and part_no.
Files (rel_path, ext, content, path_parts) carry the description of their source in the columns META, so one table has the
files of any number of sources, and further columns of it stay with the candidates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lines
from ..functions import text as T
from ..sources.files import EXTENSIONS, LEAST_CHARS, notebook_text, stem, strict_text

NO_FLAGS = "cast(map() as map<string,string>)"
META = ("source_id", "family", "kind", "repo_ref", "repo_commit")
#: Besides META, the place of a source in its catalogue stays.
PLACE = "source_place"


def _candidates(rows: DataFrame, doc_id: Column, group: Column, flags: Column) -> DataFrame:
    return rows.select(
        doc_id.alias("doc_id"),
        *META[:3],
        PLACE,
        "rel_path",
        group.alias("grp"),
        "text",
        flags.alias("flags"),
        "path_parts",
        F.col("part_no").cast("int").alias("part_no"),
    )


def _in_parts(rows: DataFrame, ext: Column) -> DataFrame:
    """Texts in parts, numbered from 1; n_parts counts them all."""
    parts = rows.withColumn("__parts", lines.parts_of(F.col("text"), ext)).withColumn("n_parts", F.size("__parts"))
    return parts.select("*", F.posexplode("__parts").alias("__at", "__part")).withColumn("part_no", F.col("__at") + 1).withColumn("text", F.col("__part")).drop("__parts", "__at", "__part")


def _part_flags() -> Column:
    return F.when(F.col("n_parts") > 1, F.create_map(F.lit("part"), F.col("part_no").cast("string"), F.lit("n_parts"), F.col("n_parts").cast("string"))).otherwise(F.expr(NO_FLAGS))


def documents(files: DataFrame, roots: tuple[str, ...] = ("source", "doc", "docs")) -> DataFrame:
    """One file, one document, in parts if it is long.  Too short ones, generated ones and undecodable ones are left out;
    a part that is too short leaves a gap in the numbers."""
    wanted = files.where(F.col("ext").isin(*EXTENSIONS["docs"], *EXTENSIONS["code"])).withColumn("raw", strict_text(F.col("content"))).where("raw is not null")
    least = F.when(F.col("ext").isin(*EXTENSIONS["docs"]), LEAST_CHARS["docs"]).otherwise(LEAST_CHARS["code"])
    clean = wanted.withColumn("text", lines.clean_file(F.col("raw"), F.col("ext"))).drop("raw", "content")
    long_enough = clean.where((F.length("text") >= least) & ~T.looks_generated(F.col("text")))
    parts = _in_parts(long_enough, F.col("ext")).where(F.length("text") >= least)
    doc_id = T.document_id(F.col("source_id"), F.col("rel_path"), F.col("part_no"), F.col("n_parts"))
    return _candidates(parts, doc_id, T.group_key(F.col("rel_path"), roots), _part_flags())


def interfaces(files: DataFrame) -> DataFrame:
    """One package (first folder) of a source, one document: the definitions in the order of their paths, each under its name."""
    wanted = files.where(F.col("ext").isin(*EXTENSIONS["interfaces"])).withColumn("raw", T.stripped(strict_text(F.col("content"))))
    package, parts = F.get("path_parts", 0), F.col("path_parts")
    folder = F.when(F.size(parts) > 2, F.concat(F.get(parts, 1), F.lit("/"))).otherwise("")
    name = F.concat(package, F.lit("/"), folder, stem(F.col("rel_path")))
    block = F.concat(F.lit("## "), name, F.lit(" ("), F.substring("ext", 2, 20), F.lit(")\n```\n"), F.col("raw"), F.lit("\n```\n"))
    blocks = F.transform(F.array_sort(F.collect_list(F.when(F.coalesce("raw", F.lit("")) != "", F.struct("path_parts", block.alias("block"))))), lambda x: x["block"])
    packages = wanted.groupBy(*META, PLACE, package.alias("rel_path")).agg(blocks.alias("blocks"), F.count("*").alias("n"))
    heading = F.concat(F.lit("# "), F.col("rel_path"), F.lit(" — ROS 2 interface definitions\n"))
    rows = packages.withColumn("text", T.stripped(F.array_join(F.concat(F.array(heading), F.col("blocks")), "\n"))).where(F.length("text") >= LEAST_CHARS["interfaces"])
    rows = rows.withColumn("path_parts", F.array("rel_path")).withColumn("part_no", F.lit(1))
    return _candidates(rows, F.concat("source_id", F.lit("-"), F.col("rel_path")), F.col("rel_path"), F.create_map(F.lit("n_interfaces"), F.col("n").cast("string")))


def notebooks(files: DataFrame, roots: tuple[str, ...] = ("source", "doc", "docs")) -> DataFrame:
    """Notebooks as Markdown, in parts if long, and Markdown files as they are."""
    least = LEAST_CHARS["notebooks"]
    texts = files.where(F.col("ext").isin(*EXTENSIONS["notebooks"])).withColumn("raw", strict_text(F.col("content"))).withColumn("name", stem(F.col("rel_path"))).drop("content")
    pages = texts.where("ext = '.md'").withColumn("text", T.clean_markdown(F.col("raw"))).where(F.length("text") >= least).withColumn("part_no", F.lit(1))
    source = F.concat("source_id", F.lit("-"))
    plain_pages = _candidates(pages, F.concat(source, F.col("name")), T.group_key(F.col("rel_path"), roots), F.expr(NO_FLAGS))
    shown = texts.where("ext = '.ipynb'").withColumn("text", T.collapsed(notebook_text(F.col("raw"), F.col("name"), T.clean_markdown))).where(F.length("text") >= least)
    parts = _in_parts(shown, F.lit(".md")).where(F.length("text") >= least)
    doc_id = F.concat(source, F.translate("name", " ", "_"), F.when(F.col("n_parts") > 1, F.concat(F.lit("-p"), F.col("part_no").cast("string"))).otherwise(""))
    flags = F.map_concat(F.create_map(F.lit("notebook"), F.lit("markdown and code cells, outputs left out")), _part_flags())
    return plain_pages.unionByName(_candidates(parts, doc_id, T.group_key(F.col("rel_path"), roots), flags))


def papers(files: DataFrame) -> DataFrame:
    """paper.txt of a source without what LaTeX leaves in texts; papers form one group each."""
    least = LEAST_CHARS["paper"]
    texts = files.where("rel_path = 'paper.txt'").withColumn("text", T.without_latex(strict_text(F.col("content")))).drop("content").where(F.length("text") >= least)
    parts = _in_parts(texts, F.lit(".md")).where(F.length("text") >= least)
    flags = F.map_concat(F.create_map(F.lit("arxiv_id"), F.col("repo_commit"), F.lit("fetch"), F.col("repo_ref")), _part_flags())
    doc_id = T.document_id(F.col("source_id"), F.col("rel_path"), F.col("part_no"), F.col("n_parts"))
    return _candidates(parts, doc_id, F.concat(F.lit("arxiv:"), F.col("repo_commit")), flags)


#: The kinds of sources that each adapter reads.
ADAPTERS = {documents: ("docs", "code"), interfaces: ("interfaces",), notebooks: ("notebooks",), papers: ("paper",)}
KINDS = tuple(kind for kinds in ADAPTERS.values() for kind in kinds)
#: Endings of the files that any adapter reads.
ENDINGS = tuple(sorted({x for kind in EXTENSIONS.values() for x in kind} | {"paper.txt"}))


def adapt_all(files: DataFrame) -> DataFrame:
    """The candidates of files of any sources, each by its kind; files of kinds that no adapter reads give none."""
    out = None
    for adapter, kinds in ADAPTERS.items():
        own = adapter(files.where(F.col("kind").isin(*kinds)))
        out = own if out is None else out.unionByName(own)
    return out


def adapt(files: DataFrame, meta: dict) -> DataFrame:
    """The candidates of one source, described by a dict of META (source_id, family and kind at least)."""
    if meta["kind"] not in KINDS:
        raise ValueError(f"unknown kind of source: {meta['kind']}")
    return adapt_all(files.withColumns({k: F.lit(meta.get(k)).cast("string") for k in META} | {PLACE: F.lit(0)})).drop(PLACE)
