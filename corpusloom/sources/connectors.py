"""Where raw material comes from outside of Spark: repositories, papers, robot packages, PDF files.

Fetching runs on the driver, one source after another, and leaves files in a folder; everything behind that is a table.
Programs and packages that may be missing are asked for when they are needed.
"""

from __future__ import annotations

import importlib
import json
import re
import shutil
import subprocess
import urllib.request
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lines
from ..functions import text as T
from ..operators.pages import clean_pages
from . import files

# Seconds that a request may take; characters below which a paper, or a page without an article, failed.
TIMEOUT, LEAST_PAPER, LEAST_PAGE = 90, 4000, 5000
#: robots' topics that are wanted in repositories, and files that one gives at most.
MOST_FILES = 100


@dataclass(frozen=True)
class Layout:
    """The folders of a project."""

    root: Path

    def raw(self, category: str, kind: str, item: str) -> Path:
        return self.root / "data" / category / "raw" / kind / item

    def metadata(self, category: str) -> Path:
        return self.root / "data" / category / "metadata" / "sources.jsonl"

    def corpus(self, category: str) -> Path:
        return self.root / "data" / category / "clean" / "corpus.jsonl"

    def report(self, name: str, stamp: str) -> Path:
        return self.root / "logs" / f"{stamp}-{name}.md"

    def cache(self, name: str) -> Path:
        return self.root / ".cache" / name


def run(*command: str, cwd: Path | None = None, timeout: int = 900) -> str:
    done = subprocess.run(command, cwd=cwd, capture_output=True, text=True, timeout=timeout)
    if done.returncode:
        raise RuntimeError(f"{' '.join(command[:3])} failed: {done.stderr.strip()[:300]}")
    return done.stdout.strip()


def clone(url: str, to: Path, ref: str = "", sparse: tuple[str, ...] = ()) -> str:
    """A shallow clone, of some folders only if they are named; an existing one is used again.  Returns its commit."""
    if not (to / ".git").exists():
        to.parent.mkdir(parents=True, exist_ok=True)
        options = ["--depth", "1", *(["--branch", ref] if ref else []), *(["--filter=blob:none", "--sparse"] if sparse else [])]
        run("git", "clone", *options, url, str(to))
        if sparse:
            run("git", "sparse-checkout", "set", *sparse, cwd=to)
    return run("git", "rev-parse", "HEAD", cwd=to)


def copy_tree(files: list[Path], root: Path, to: Path) -> int:
    """Copies files with their folders into an emptied one."""
    shutil.rmtree(to, ignore_errors=True)
    for path in files:
        target = to / path.relative_to(root)
        target.parent.mkdir(parents=True, exist_ok=True)
        shutil.copyfile(path, target)
    return len(files)


def _get(url: str) -> bytes:
    with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": "corpus-builder"}), timeout=TIMEOUT) as reply:
        return reply.read()


def fetch_paper(paper: str, to: Path) -> str:
    """A paper's page, or else its PDF, in a folder; returns which.  Texts are made by paper_texts."""
    to.mkdir(parents=True, exist_ok=True)
    try:
        page = _get(f"https://arxiv.org/html/{paper}").decode("utf-8", "replace")
        if "<article" in page or len(page) >= LEAST_PAGE:
            (to / "paper.html").write_text(page, encoding="utf-8")
            return "html"
    except OSError:
        pass
    (to / "paper.pdf").write_bytes(_get(f"https://arxiv.org/pdf/{paper}"))
    return "pdf"


def paper_texts(papers: DataFrame) -> DataFrame:
    """papers (html: a page, or null; pages: array<string> of a PDF, or null) with `text`: of the page if there is one, else
    of the PDF's pages; without the bibliography, and null where too little is left."""
    source = F.when(F.col("html").isNotNull(), lines.html_to_text(F.col("html"))).otherwise(clean_pages(F.col("pages")))
    # through an explode: the text of a page needs Python, which cannot be inside a lambda
    rows = papers.select("*", F.explode(F.array(source)).alias("__source")).withColumn("__text", T.without_bibliography(F.col("__source")))
    return rows.withColumn("text", F.when(F.length("__text") >= LEAST_PAPER, F.col("__text"))).drop("__source", "__text")


def collected_papers(spark, root: str, extract=None) -> DataFrame:
    """paper, text of the folders below root that fetch_paper filled; extract turns content into pages, as pdf_pages does."""
    found = files.scan(spark, root).where(F.col("rel_path").rlike(r"/paper\.(html|pdf)\z")).withColumn("paper", F.regexp_extract("rel_path", r"\A(.*)/", 1))
    page = found.where("ext = '.html'").select("paper", files.lenient_text(F.col("content")).alias("html"))
    book = (extract or pdf_pages)(found.where("ext = '.pdf'").select("paper", "content"))
    return paper_texts(page.join(book, "paper", "full")).select("paper", "text")


def robot_file(module: str, cache: Path) -> Path:
    """The URDF of a robot package, rendered if it only has a Xacro file."""
    package = importlib.import_module(f"robot_descriptions.{module}")
    if path := getattr(package, "URDF_PATH", None):
        return Path(path)
    return render_xacro(Path(package.XACRO_PATH), cache / f"{module}.urdf", dict(getattr(package, "XACRO_ARGS", {})))


def render_xacro(source: Path, to: Path, arguments: dict[str, str]) -> Path:
    """A Xacro file as URDF, by the xacro program, with $(find package) replaced by folders near the file."""
    if to.exists():
        return to
    root = source.parent.parent

    def folder(found: re.Match) -> str:
        name = found[1]
        return str(root if root.name == name else next((p for p in sorted(root.rglob(name)) if p.is_dir()), root))

    work = to.with_suffix(".work")
    shutil.copytree(root, work, dirs_exist_ok=True)
    for path in work.rglob("*.xacro"):
        path.write_text(re.sub(r"\$\(find ([\w\-]+)\)", folder, path.read_text(encoding="utf-8", errors="replace")), encoding="utf-8")
    to.write_text(run("xacro", str(work / source.relative_to(root)), *(f"{k}:={v}" for k, v in arguments.items())), encoding="utf-8")
    shutil.rmtree(work)
    return to


def repository_tree(owner_and_name: str, ref: str = "HEAD") -> list[str]:
    """Paths of the URDF files of a hosted repository."""
    tree = json.loads(_get(f"https://api.github.com/repos/{owner_and_name}/git/trees/{ref}?recursive=1"))["tree"]
    return [x["path"] for x in tree if x["type"] == "blob" and x["path"].endswith(".urdf")]


def with_repositories(robots: DataFrame, descriptions: DataFrame, repositories: DataFrame) -> DataFrame:
    """robots (module) with url, commit and license of the repository that each description is from (descriptions: module,
    repository; repositories: repository, url, commit, license); nulls where none is known."""
    return robots.join(descriptions.join(repositories, "repository", "left"), "module", "left")


def flat_name(path: str) -> str:
    """The name of a repository's file in one folder."""
    return path.replace("/", "_")


def fetch_files(owner_and_name: str, paths: list[str], to: Path, ref: str = "HEAD") -> list[Path]:
    """Downloads files of a hosted repository, MOST_FILES at most, to a folder under flat names."""
    to.mkdir(parents=True, exist_ok=True)
    out = []
    for path in paths[:MOST_FILES]:
        out.append(to / flat_name(path))
        out[-1].write_bytes(_get(f"https://raw.githubusercontent.com/{owner_and_name}/{ref}/{path}"))
    return out


def wanted_repositories(repositories: DataFrame, topics: list[str], licenses: list[str]) -> DataFrame:
    """Of hosted repositories (robot, name, stars, topics, license) the most starred of each robot, MOST_FILES at most, by
    topics and licenses.  The limit is part of the collection's rule."""
    fitting = repositories.where(F.arrays_overlap("topics", F.array(*map(F.lit, topics))) & F.col("license").isin(licenses))
    best = fitting.groupBy("robot").agg(F.max_by(F.struct("name", "stars", "license"), F.struct("stars", "name")).alias("r"))
    return best.select("robot", "r.*").orderBy(F.desc("stars"), "robot").limit(MOST_FILES)


def pdf_pages(files: DataFrame) -> DataFrame:
    """files (key columns and content) with `pages` (array<string>), by pdfplumber, or else by pdftotext as one page."""
    names = [x for x in files.columns if x != "content"]

    def read(raw: bytes) -> list[str]:
        import io
        import tempfile

        try:
            import pdfplumber
        except ImportError:
            with tempfile.NamedTemporaryFile(suffix=".pdf") as f:
                f.write(raw)
                f.flush()
                return [run("pdftotext", "-layout", f.name, "-")]
        with pdfplumber.open(io.BytesIO(raw)) as book:
            return [page.extract_text() or "" for page in book.pages]

    def batches(rows):
        for part in rows:
            yield part[names].assign(pages=[read(bytes(x)) for x in part["content"]])

    fields = ", ".join(f"{x.name} {x.dataType.simpleString()}" for x in files.schema if x.name != "content")
    return files.mapInPandas(batches, f"{fields}, pages array<string>")
