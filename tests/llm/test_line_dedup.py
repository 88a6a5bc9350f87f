"""Operator 7 against a plain loop over the documents in order."""

import random

import xxhash

from corpusloom.llm.line_dedup import chunks, line_dedup, units


def plain_chunks(lines):
    """(first, end) of chunks of lines: a line ends one if the sum of its hash and BASE times the hash before is 0 modulo
    DIVISOR in its top bits and that of the line before is not; written with plain integers."""
    if len(lines) < 2:
        return [(0, len(lines))]
    mask, base = (1 << 64) - 1, 0x9E3779B97F4A7C15
    h = [xxhash.xxh3_64_intdigest(x) for x in lines]
    zero = [((((h[i] + base * (h[i - 1] if i else 0)) & mask) * base & mask) >> 40) % 2 == 0 for i in range(len(h))]
    ends = [i > 0 and zero[i] and not zero[i - 1] for i in range(len(h))]
    borders = [0, *(i + 1 for i in range(len(h) - 1) if ends[i]), len(h)]
    return list(zip(borders, borders[1:]))


def plain_units(text):
    """(first, end) of what is compared: chunks of two lines and 48 bytes or more, and from each line the fewest lines
    forwards and backwards with more than 50 words."""
    rows = text.split("\n")
    lines, out = [x.encode() for x in rows], set()
    words = [len(x.split()) for x in rows]
    out |= {(a, b) for a, b in plain_chunks(lines) if b - a > 1 and len(b"\n".join(lines[a:b])) >= 48}
    for i in range(len(rows)):
        for step in (1, -1):
            j, n = i, 0
            while 0 <= j < len(rows) and n <= 50:
                n += words[j]
                j += step
            if n > 50:
                out.add((i, j) if step > 0 else (j + 1, i + 1))
    return sorted(out)


def brute(rows):
    """All documents in order: a unit whose bytes an earlier unit has goes."""
    seen, out = set(), []
    for i, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        if text is None:
            out.append((i, None))
            continue
        lines, drop = text.split("\n"), set()
        for a, b in plain_units(text):
            raw = "\n".join(lines[a:b])
            if raw in seen:
                drop |= set(range(a, b))
            seen.add(raw)
        out.append((i, "\n".join(x for k, x in enumerate(lines) if k not in drop)))
    return out


def test_equals_brute_force(spark):
    draw = random.Random(3)
    line = lambda: " ".join(draw.choice("abcdefgh") * draw.randrange(2, 9) for _ in range(draw.randrange(3, 12)))
    passage = "\n".join(line() for _ in range(24))
    texts = ["\n".join([line() for _ in range(draw.randrange(1, 9))] + ([passage] if k % 3 == 0 else []) + [line() for _ in range(draw.randrange(9))]) for k in range(60)]
    rows = list(enumerate(texts)) + [(100, None), (101, ""), (102, "\n\n\n"), (103, texts[5]), (104, texts[5]), (105, passage + "\n" + passage), (None, passage)]
    got = line_dedup(spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, hash string, place int")).collect()
    assert sorted(((r.doc_id, r.text) for r in got if r.doc_id is not None), key=lambda x: x[0]) == brute(rows)
    assert [r.text for r in got if r.doc_id is None] == [passage]
    assert sum(r["__gone_chunks"] for r in got) > 60
    assert all(r.hash == "x" and r.place == 1 for r in got)


def test_borders_resist_shifts():
    lines = [str(k * 7919).encode() * 5 for k in range(400)]
    own = {tuple(lines[a:b]) for a, b in chunks(lines)}
    moved = [b"new first line", *lines]
    assert len({tuple(moved[a:b]) for a, b in chunks(moved)} & own) >= len(own) - 2
    assert all(b - a > 1 for a, b in chunks(lines)[:-1])


def test_units_equal_plain_ones():
    draw = random.Random(5)
    for _ in range(300):
        text = "\n".join(" ".join(draw.choice("abc") * 3 for _ in range(draw.choice((0, 1, 5, 30, 60)))) for _ in range(draw.randrange(1, 15)))
        a, b, _ = units(text)
        assert list(zip(a.tolist(), b.tolist())) == plain_units(text)


def test_clashing_columns(spark):
    text = "\n".join(f"line number {k} of a passage" for k in range(40))
    docs = spark.createDataFrame([(1, text, "x", 5), (2, text, "y", 6)], "doc_id long, text string, __gone string, __lines int")
    got = {r.doc_id: r for r in line_dedup(docs).collect()}
    assert got[1]["__gone_lines"] == 0 and got[2]["__gone_lines"] == 40 and got[1]["__lines"] == 40


def test_repeated_rows_and_empty(spark):
    text = "\n".join(f"line number {k} of a passage" for k in range(40))
    rows = [(1, text), (1, text), (2, text)]
    got = sorted((r.doc_id, r["__gone_lines"]) for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got[0][1] == got[1][1] == 0 and got[2][1] > 30
    assert line_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_no_shared_run_of_over_50_words_stays(spark):
    """Planted passages of 1 to 6 lines, found line by line and not by compared()."""
    draw = random.Random(11)
    line = lambda n: " ".join("".join(draw.choice("abcdefgh") for _ in range(7)) for _ in range(n))
    passages = ["\n".join(["" if n > 3 and k == 1 else line(-(-51 // max(1, n - (n > 3)))) for k in range(n)]) for n in range(1, 7) for _ in range(5)]
    short = line(12)
    texts = ["\n".join([line(draw.randrange(1, 20)) for _ in range(draw.randrange(1, 6))] + [p, short] + [line(draw.randrange(1, 20)) for _ in range(draw.randrange(1, 6))]) for _ in range(3) for p in passages]
    rows = list(enumerate(texts))
    got = {r.doc_id: r.text for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    n = len(passages)
    for i, text in rows:
        left = text if i < n else text.replace(passages[i % n] + "\n" + short + "\n", "")
        assert got[i] == left, i
    assert not any(p in got[i] for i in range(n, 3 * n) for p in passages)
    assert all(short in got[i] for i in range(n))
