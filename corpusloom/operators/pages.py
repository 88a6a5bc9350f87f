"""Texts of paged documents: repeated headers and footers, page numbers, and what optical recognition returns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import SPACE, WORD, let, replaced, stripped

# Pages from which headers are looked for, lines at each edge, and the share of pages; current and older rule.
EDGE_RULE = (4, 2, 0.5)
OLDER_EDGE_RULE = (3, 3, 0.4)
PAGE_NUMBER = rf"(?iu)^[{SPACE}]*(?:page[{SPACE}]*)?\p{{Nd}}+[{SPACE}]*(?:/[{SPACE}]*\p{{Nd}}+)?[{SPACE}]*\z"
#: Longest text of a manual, and what marks that it was cut.
MANUAL_CHARS, CUT_MARK = 40_000, "\n[... truncated ...]"
#: What ends a line besides a newline.
LINE_ENDS = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"

# Width, band height and band overlap of rendered pages in pixels, and the least resolution.
PAGE_WIDTH, BAND_HEIGHT, BAND_OVERLAP, LEAST_DPI = 2000, 1600, 120, 36
#: Lines looked back at when bands are joined; least score of a block; line height tolerance.
BAND_MEMORY, LEAST_SCORE, LINE_PIXELS, LINE_SHARE = 4, 0.5, 8.0, 0.6


def lines_of(page: Column) -> Column:
    """The lines of a page; an end of the last one opens no other."""
    lines = F.split(page, LINE_ENDS, -1)
    return F.when(F.element_at(lines, -1) == "", F.slice(lines, 1, F.size(lines) - 1)).otherwise(lines)


def repeated_edges(pages: Column, rule: tuple[int, int, float] = EDGE_RULE, distinct: bool = False, least_chars: int = 1) -> Column:
    """array<string> of the lines that many pages have near their top or bottom.  Lines are counted in the row itself: a
    document's pages are together, so nothing is shuffled."""
    least_pages, edge, share = rule
    full = F.transform(pages, lambda p: F.filter(F.transform(lines_of(p), stripped), lambda x: x != ""))

    def edges(lines: Column) -> Column:
        both = F.concat(F.slice(lines, 1, edge), F.slice(lines, F.greatest(F.lit(1), F.size(lines) - edge + 1), edge))
        return F.array_distinct(both) if distinct else both

    threshold = F.greatest(F.lit(2), F.floor(F.size(pages) * share)).cast("int")
    seen = F.array_sort(F.filter(F.flatten(F.transform(full, lambda lines: let(lines, edges))), lambda x: F.length(x) >= least_chars))

    def repeats(held: Column) -> Column:
        # In order, a line occurs often if it is also found so many places further back, for the first time.
        lines, least = held["lines"], held["least"]
        found = F.filter(lines, lambda x, i: (i >= least - 1) & (F.get(lines, i - least + 1) == x))
        return F.array_distinct(found)

    often = let(F.struct(seen.alias("lines"), threshold.alias("least")), repeats)
    return F.when(F.size(pages) >= least_pages, often).otherwise(F.expr("cast(array() as array<string>)"))


def clean_pages(pages: Column) -> Column:
    """One text of pages: no repeated edges and page numbers, hyphenated words joined, blanks tidied."""
    every = F.flatten(F.transform(pages, lines_of))
    kept = let(repeated_edges(pages), lambda dropped: F.filter(every, lambda x: ~F.array_contains(dropped, stripped(x))))
    bare = F.transform(kept, lambda x: replaced(x, (rf"[{SPACE}]+\z", "")))
    text = F.array_join(F.filter(bare, lambda x: ~F.regexp_like(x, F.lit(PAGE_NUMBER))), "\n")
    return stripped(replaced(text, (rf"([{WORD}])-\n([{WORD}])", "$1$2"), (r"[ \t]+", " "), (r"\n{3,}", "\n\n")))


def shortened(text: Column) -> Column:
    """A manual's text within MANUAL_CHARS, marked if it was cut."""
    head = replaced(F.substring(text, 1, MANUAL_CHARS), (rf"[{SPACE}]+\z", ""))
    return F.when(F.length(text) > MANUAL_CHARS, F.concat(head, F.lit(CUT_MARK))).otherwise(text)


# Fixed values of the older cleaning: signs to replace, and lines to drop.
SIGNS = (("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl"), ("[•▪●–—]", "-"), ("[‘’]", "'"), ("[“”]", '"'))
OLDER_DROPS = (
    rf"(?iu)^(?:page[{SPACE}]*)?\(?[{SPACE}]*\p{{Nd}}{{1,4}}[{SPACE}]*\)?(?:[{SPACE}]*(?:/|of|-)[{SPACE}]*\p{{Nd}}{{1,4}})?[{SPACE}]*\z",
    rf"^[{SPACE}\-_=~*#•·.]{{3,}}\z",
    r"(?iu)^(?:©|\(c\)|copyright)",
    r"(?iu)^(?:www\.|https?://)",
)


def older_clean(raw: Column, robot: Column) -> Column:
    """A manual in the older format: one line of what is left, under the robot's name."""
    bare = F.transform(F.split(raw, "\x0c", -1), lambda p: replaced(p, (r"\x{FEFF}", ""), (r"[\x00-\x08\x0b\x0e-\x1f\x7f\x{FFFD}\x{E000}-\x{F8FF}]", ""), *SIGNS))

    def noise(x: Column) -> Column:
        letters = F.length(replaced(x, (r"[^\p{L}\p{N}]", "")))
        return letters < F.greatest(F.lit(3), F.floor(F.length(x) * 0.3))

    def of_pages(pages: Column) -> Column:
        dots = F.transform(F.flatten(F.transform(pages, lambda p: F.split(p, "\n", -1))), lambda x: replaced(stripped(replaced(x, (rf"(?:\.[{SPACE}]*){{3,}}", " "))), (r"[ \t]{2,}", " ")))
        return let(repeated_edges(pages, OLDER_EDGE_RULE, distinct=True, least_chars=4), lambda dropped: F.filter(dots, lambda x: keeps(x, dropped)))

    def keeps(x: Column, dropped: Column) -> Column:
        drops = reduce(lambda a, b: a | b, (F.regexp_like(x, F.lit(p)) for p in OLDER_DROPS))
        return (F.length(x) >= 3) & ~F.array_contains(dropped, x) & ~drops & ~noise(x)

    single = let(let(bare, of_pages), lambda kept: F.filter(kept, lambda x, i: (i == 0) | (x != F.get(kept, i - 1))))
    return F.concat(F.lit("[ROBOT:"), robot, F.lit("]\n"), F.array_join(single, ""))


def render_plan(width_points: Column, height_points: Column, dpi: int = 200) -> Column:
    """struct<dpi, width, height, bands array<struct<y, height>>> of a page."""
    limited = F.greatest(F.lit(LEAST_DPI), F.least(F.lit(dpi), F.floor(F.lit(PAGE_WIDTH * 72.0) / width_points)))
    used = F.when(width_points > 0, limited).otherwise(F.lit(dpi)).cast("int")
    width, height = (F.greatest(F.lit(1), F.floor(x / 72.0 * used)).cast("int") for x in (width_points, height_points))
    step = BAND_HEIGHT - BAND_OVERLAP
    last = F.greatest(F.lit(0), F.ceil((height - BAND_HEIGHT) / step)).cast("int")
    bands = F.transform(F.sequence(F.lit(0), last), lambda i: F.struct((i * step).alias("y"), F.least(F.lit(BAND_HEIGHT), height - i * step).alias("height")))
    return F.struct(used.alias("dpi"), width.alias("width"), height.alias("height"), bands.alias("bands"))


def joined_bands(texts: Column) -> Column:
    """One text of overlapping bands: a line equal to one of the last few is a repetition."""
    lines = F.filter(F.transform(F.flatten(F.transform(texts, lines_of)), stripped), lambda x: x != "")
    none = F.expr("cast(array() as array<string>)")

    def step(kept: Column, line: Column) -> Column:
        recent = F.slice(kept, F.greatest(F.lit(1), F.size(kept) - BAND_MEMORY + 1), BAND_MEMORY)
        return F.when(F.array_contains(recent, line), kept).otherwise(F.concat(kept, F.array(line)))

    return F.array_join(F.aggregate(lines, none, step), "\n")


def joined_blocks(blocks: Column, least_score: float = LEAST_SCORE) -> Column:
    """struct<text, confidence> of recognised blocks (array<struct<text, score, x, top, bottom>>) in reading order.

    A block opens a line if its middle is far from that of the line's first block; far is measured by the mean height of
    all blocks, doubtful ones too.
    """
    mean_height = F.aggregate(F.transform(blocks, lambda b: F.abs(b["bottom"] - b["top"]).cast("double")), F.lit(0.0), lambda a, b: a + b) / F.greatest(F.size(blocks), F.lit(1))
    tolerance = F.greatest(F.lit(LINE_PIXELS), mean_height * LINE_SHARE)
    sure = F.filter(blocks, lambda b: b["score"] >= least_score)
    confidence = F.when(F.size(sure) > 0, F.aggregate(F.transform(sure, lambda b: b["score"].cast("double")), F.lit(0.0), lambda a, b: a + b) / F.size(sure)).otherwise(0.0)
    return F.struct(let(tolerance, lambda t: _reading_order(sure, t)).alias("text"), confidence.alias("confidence"))


def _reading_order(sure: Column, tolerance: Column) -> Column:
    """The texts of blocks line by line, from left to right."""
    sorted_blocks = F.array_sort(F.transform(sure, lambda b: F.struct(((b["top"] + b["bottom"]) / 2.0).alias("y"), b["x"].cast("double").alias("x"), b["text"].alias("text"))))
    start = F.struct(F.lit(None).cast("double").alias("y"), F.lit(0).alias("line"), F.expr("cast(array() as array<struct<line:int,x:double,text:string>>)").alias("out"))

    def step(held: Column, b: Column) -> Column:
        same = F.coalesce(F.abs(b["y"] - held["y"]) <= tolerance, F.lit(False))
        line = F.when(same, held["line"]).otherwise(held["line"] + 1)
        return F.struct(F.when(same, held["y"]).otherwise(b["y"]).alias("y"), line.alias("line"), F.concat(held["out"], F.array(F.struct(line.alias("line"), b["x"].alias("x"), b["text"].alias("text")))).alias("out"))

    placed = F.aggregate(sorted_blocks, start, step, lambda held: held["out"])

    def line_text(blocks: Column, n: Column) -> Column:
        own = F.transform(F.filter(blocks, lambda p: p["line"] == n), lambda p: F.struct(p["x"].alias("x"), p["text"].alias("text")))
        return F.array_join(F.transform(F.array_sort(own), lambda p: p["text"]), " ")

    numbers = let(placed, lambda blocks: F.transform(F.array_distinct(F.transform(blocks, lambda p: p["line"])), lambda n: line_text(blocks, n)))
    return F.array_join(numbers, "\n")


def recognised_document(pages: Column) -> Column:
    """struct<text, confidence, n_pages, n_pages_with_text> of recognised pages (array<struct<text, confidence>>)."""
    full = F.filter(pages, lambda p: stripped(p["text"]) != "")
    mean = F.when(F.size(full) > 0, F.aggregate(F.transform(full, lambda p: p["confidence"]), F.lit(0.0), lambda a, b: a + b) / F.size(full)).otherwise(0.0)
    return F.struct(F.array_join(F.transform(full, lambda p: p["text"]), "\n\n").alias("text"), mean.alias("confidence"), F.size(pages).alias("n_pages"), F.size(full).alias("n_pages_with_text"))
