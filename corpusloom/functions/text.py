"""Text functions as Column expressions: everything here stays in the JVM.

The character classes are written out because regex engines differ on \\w, \\s and line ends; with them results are those
of a Unicode-aware engine with newline as the only line end.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"\p{L}\p{N}_"
SPACE = r"\p{IsWhite_Space}\x1c-\x1f"
#: Tokens for one word or sign, on average.
TOKENS_PER_UNIT = 1.3

# What marks a generated file, and how far into it that is looked for.
GENERATED_MARKERS = ("do not edit", "do not modify", "automatically generated", "autogenerated", "auto-generated", "@generated", "generated by")
GENERATED_HEAD = 1500

# The elements of a page that go with their content, and those that end a block.
DROPPED_ELEMENTS = ("script", "style", "nav", "footer", "head", "noscript", "svg", "math")
BLOCK_ELEMENTS = ("p", "div", "section", r"h\d", "li", "tr", "figcaption")

# The patterns that cleaning removes or rewrites.
FRONT_MATTER, HTML_COMMENT, BADGE_LINE = r"(?s)\A---\n.*?\n---\n", r"(?s)<!--.*?-->", r"(?md)^\[!\[[^\]]*\]\([^)]*\)\]\([^)]*\)[ \t]*$\n?"
ORPHAN_MARK, ANCHOR_LINE, ROLE = r"(?md)^[ \t]*:orphan:[ \t]*$\n?", r"(?md)^[ \t]*\.\.[ \t]+_[^:]+:[ \t]*$\n?", r":[a-z:]+:`([^`]+)`"
ARTICLE, TAG = r"""(?is)<article[^>]*class="[^"]*ltx_document[^"]*".*?</article>""", r"(?s)<[^>]+>"
BIBLIOGRAPHY_HEADING = rf"\n[{SPACE}]*(?:References|REFERENCES|Bibliography|BIBLIOGRAPHY)[{SPACE}]*\n"

# Share of a paper before which a bibliography heading does not count, and how far front matter reaches.
BIBLIOGRAPHY_FROM = 0.55
FRONT_MATTER_CHARS = 4000

# Name by which a manual's file is recognised, in order of preference.
ROBOT_NAMES = (
    ("g1", "Unitree G1"),
    ("go2", "Unitree Go2"),
    ("ranger", "AgileX Ranger Mini"),
    ("scout", "AgileX Scout"),
    ("husky", "Clearpath Husky A200"),
    ("spot", "Boston Dynamics Spot"),
    ("h1", "Unitree H1"),
    ("b2", "Unitree B2"),
    ("stretch", "Hello Robot Stretch"),
    ("ur10", "Universal Robots UR10e"),
    ("franka", "Franka Research 3"),
    ("fr3", "Franka Research 3"),
)


def let(value: Column, function) -> Column:
    """function(value), with value computed once: in a lambda an expression from outside is computed for each element."""
    return F.get(F.transform(F.array(value), lambda x: function(x)), 0)


def replaced(text: Column, *steps: tuple[str, str]) -> Column:
    """Regular-expression replacements one after another."""
    return reduce(lambda c, step: F.regexp_replace(c, F.lit(step[0]), F.lit(step[1])), steps, text)


def stripped(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return replaced(text, (rf"^[{SPACE}]+|[{SPACE}]+\z", ""))


def newlines(text: Column) -> Column:
    return replaced(text, (r"\r\n?", "\n"))


def collapsed(text: Column) -> Column:
    """At most one blank line in a row, none at the ends."""
    return stripped(replaced(text, (r"\n{3,}", "\n\n")))


def hash_form(text: Column) -> Column:
    """Lower case, no punctuation, single blanks: texts that differ in nothing else are equal."""
    # single blanks, of which there is one a word, are no match: they stay as they are
    return F.trim(replaced(F.lower(text), (rf"[^{WORD} ][^{WORD}]*| [^{WORD}]+", " ")))


def content_hash(text: Column) -> Column:
    return F.sha2(hash_form(text), 256)


def token_estimate(text: Column) -> Column:
    """Words and signs times a constant, rounded half to even; nothing is materialised to count them."""
    units = F.regexp_count(text, F.lit(rf"[{WORD}]+|[^{WORD}{SPACE}]"))
    return F.rint(units * F.lit(TOKENS_PER_UNIT)).cast("long")


def token_quarter(text: Column) -> Column:
    """A token for four characters, one at least."""
    return F.greatest(F.lit(1), F.floor(F.length(text) / 4)).cast("long")


def looks_generated(text: Column) -> Column:
    head = F.lower(F.substring(text, 1, GENERATED_HEAD))
    return reduce(lambda a, b: a | b, (F.contains(head, F.lit(x)) for x in GENERATED_MARKERS))


def clean_markdown(text: Column) -> Column:
    """Without front matter, HTML comments and badge lines."""
    return collapsed(
        replaced(
            text,
            (FRONT_MATTER, ""),
            (HTML_COMMENT, ""),
            (BADGE_LINE, ""),
        )
    )


def without_rst_marks(text: Column) -> Column:
    """Without orphan marks and anchor lines."""
    return replaced(text, (ORPHAN_MARK, ""), (ANCHOR_LINE, ""))


def rst_roles_to_labels(text: Column) -> Column:
    return replaced(text, (ROLE, "$1"))


def html_blocks(html: Column) -> Column:
    """The article if the page has one, without dropped elements and tags; blocks end in line breaks.  Entities are left."""
    article = F.regexp_extract(html, ARTICLE, 0)
    body = F.when(article != "", article).otherwise(html)
    return replaced(
        body,
        (rf"(?is)<({'|'.join(DROPPED_ELEMENTS)})\b.*?</\1>", " "),
        (rf"(?i)</({'|'.join(BLOCK_ELEMENTS)})>", "\n"),
        (TAG, " "),
    )


def tidy_lines(text: Column) -> Column:
    """Single blanks, stripped lines, single blank lines."""
    lines = F.transform(F.split(replaced(text, (r"[ \t]+", " ")), "\n", -1), stripped)
    return stripped(replaced(F.array_join(lines, "\n"), (rf"\n[{SPACE}]*\n+", "\n\n")))


def without_bibliography(text: Column) -> Column:
    """Cut at the first bibliography heading behind BIBLIOGRAPHY_FROM of the text.

    The text before that point is set aside, and the heading is looked for in the rest; one more character is looked at
    so that a heading that begins exactly there does not count.
    """
    # Headings are found from the start without overlaps, as places by the texts between them.
    between = F.split(text, BIBLIOGRAPHY_HEADING, -1)
    found = F.regexp_extract_all(text, F.lit(BIBLIOGRAPHY_HEADING), F.lit(0))
    start = F.struct(F.lit(0).alias("at"), F.lit(-1).alias("cut"))

    def step(held: Column, x: Column) -> Column:
        begin = held["at"] + F.length(x["p"])
        hit = (held["cut"] < 0) & x["m"].isNotNull() & (begin > F.length(text) * BIBLIOGRAPHY_FROM)
        return F.struct((begin + F.coalesce(F.length(x["m"]), F.lit(0))).alias("at"), F.when(hit, begin).otherwise(held["cut"]).alias("cut"))

    cut = F.aggregate(F.arrays_zip(between.alias("p"), found.alias("m")), start, step, lambda held: held["cut"])
    return F.when(cut >= 0, F.substring(text, F.lit(1), cut)).otherwise(text)


def without_latex(text: Column) -> Column:
    """Macros to blanks, no empty brackets, no lines of signs, no front matter, no line that repeats the last full one."""
    macros = replaced(
        text,
        (r"\\[a-zA-Z@]+\*?", " "),
        (rf"(?md)^[{SPACE}]*\[[{SPACE}]*\][{SPACE}]*", ""),
        (rf"(?md)^[{SPACE}]*[\*∗†‡§¶,;:]+[{SPACE}]*$", ""),
    )
    body = from_abstract(macros)
    start = F.struct(F.lit("").alias("last"), F.expr("cast(array() as array<string>)").alias("kept"))

    def step(held: Column, line: Column) -> Column:
        bare = stripped(line)
        repeats = (bare != "") & (bare == held["last"])
        return F.struct(
            F.when(bare != "", bare).otherwise(held["last"]).alias("last"),
            F.when(repeats, held["kept"]).otherwise(F.concat(held["kept"], F.array(line))).alias("kept"),
        )

    lines = F.aggregate(F.split(body, "\n", -1), start, step, lambda held: held["kept"])
    return collapsed(replaced(F.array_join(lines, "\n"), (r"[ \t]{2,}", " ")))


def from_abstract(text: Column) -> Column:
    """From the abstract's heading on, on a line of its own or else before text, if it is near the start."""
    head = F.substring(text, 1, FRONT_MATTER_CHARS)
    own = rf"(?imd)^[{SPACE}]*(?:\d+[{SPACE}]*)?abstract(?![{WORD}])[{SPACE}]*[:.\-—]?[{SPACE}]*$"
    inline = rf"(?imd)^[{SPACE}]*abstract(?![{WORD}])[ \t]*[:.\-—]?[ \t]*[^{SPACE}]"

    def at(pattern: str) -> Column:
        return F.length(F.element_at(F.split(head, pattern, 2), 1))

    first = F.when(F.regexp_like(head, F.lit(own)), at(own)).when(F.regexp_like(head, F.lit(inline)), at(inline)).otherwise(F.lit(0))
    return F.substring(text, first + 1, F.length(text))


def numbers(text: Column) -> Column:
    """array<double> of the numbers in a text; a comma is a decimal point."""
    found = F.regexp_extract_all(text, F.lit(r"-?\p{Nd}+(?:[.,]\p{Nd}+)?"), F.lit(0))
    return F.filter(F.transform(found, lambda x: F.replace(x, F.lit(","), F.lit(".")).try_cast("double")), lambda x: x.isNotNull())


def unsupported_numbers(text: Column, allowed: Column) -> Column:
    """The numbers of a text that are neither small counts (integers 0 to 12) nor near an allowed one: within 0.5, or 2 %
    of it."""

    def supported(v: Column) -> Column:
        small = (v == F.floor(v)) & v.between(0, 12)
        return small | F.exists(allowed, lambda a: F.abs(v - a) <= F.greatest(F.lit(0.5), F.abs(a) * 0.02))

    return F.filter(numbers(text), lambda v: ~supported(v))


def group_key(path: Column, roots: tuple[str, ...] = ("source", "doc", "docs")) -> Column:
    """What documents are spread over: the first folder, or the first two under a general one; (root) for bare files."""
    parts = F.split(path, "/", -1)
    first = F.element_at(parts, 1)
    return F.when(F.size(parts) == 1, "(root)").when(first.isin(*roots) & (F.size(parts) > 2), F.array_join(F.slice(parts, 1, 2), "/")).otherwise(first)


def document_id(source: Column, path: Column, part: Column, parts: Column) -> Column:
    """The id of a document or of a part of one."""
    whole = F.concat(source, F.lit("-"), F.translate(path, "/.", "__"))
    return F.when(parts > 1, F.concat(whole, F.lit("-p"), part.cast("string"))).otherwise(whole)


def excerpt(text: Column, start: Column, end: Column, around: int = 90) -> Column:
    """Text around [start, end), with dots where it is cut."""
    a, b = F.greatest(F.lit(0), start - around), F.least(F.length(text), end + around)
    return F.concat(F.when(a > 0, "...").otherwise(""), F.substring(text, a + 1, b - a), F.when(b < F.length(text), "...").otherwise(""))


def robot_name(file_name: Column) -> Column:
    """The first known name in a file's name, or else the name without its extension."""
    stem = replaced(file_name, (r"(?<!^)\.[^.]*\z", ""))
    return F.coalesce(*(F.when(F.contains(F.lower(file_name), F.lit(k)), F.lit(v)) for k, v in ROBOT_NAMES), stem)


def relative_path(path: Column, root: str) -> Column:
    return F.when(F.startswith(path, F.lit(root.rstrip("/") + "/")), F.substring(path, len(root.rstrip("/")) + 2, 1 << 30)).otherwise(path)


def absolute_path(path: Column, root: str) -> Column:
    return F.when(F.startswith(path, F.lit("/")), path).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), path))
