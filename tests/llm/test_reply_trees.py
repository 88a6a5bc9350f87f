import random

from pyspark.sql import functions as F

from corpusloom.llm.reply_trees import PROBE, conversations, digests, escaped, formatted, turns, unescaped

SCHEMA = "tree long, id long, parent long, role string, text string, score double"


def plain_paths(rows):
    """(score, length, leaf, [(role, text)]) of each tree's root-to-leaf paths, best first, by walking."""
    found = {}
    by = {}
    for tree, i, parent, role, text, score in sorted(rows, key=lambda r: (r[1] is None, r[1] or 0)):
        if i is not None:
            key = (parent is not None, parent or 0, role or "", text or "", score or 0.0)
            if (tree, i) not in by or key < by[tree, i][0]:
                by[tree, i] = (key, parent, role or "", text or "", score or 0.0)
    answered = {(t, p) for (t, i), (_, p, *_) in by.items() if (t, p) in by}
    for tree, i in by:
        if (tree, i) in answered:
            continue
        at, path, seen = i, [], set()
        while at not in seen and (tree, at) in by:
            seen.add(at)
            _, parent, role, text, score = by[tree, at]
            path.append((role, text, score))
            at = parent
        if (tree, at) not in by or at is None:
            path.reverse()
            found.setdefault(tree, []).append((-sum(x[2] for x in path), -len(path), i, [x[:2] for x in path]))
    return {t: sorted(v) for t, v in found.items()}


def test_paths_against_a_walk(spark):
    random.seed(11)
    rows = []
    for tree in [None, *range(12)]:
        n = random.choice([1, 2, 5, 40])
        for i in range(n):
            parent = random.choice([None, 900, i - 1, random.randrange(n)]) if i else None
            rows.append((tree, i, parent, random.choice(["user", "assistant", "tool", None]), random.choice(["a", "", None, "b<s>"]), random.choice([None, 0.0, 1.0, 2.0])))
        rows.append((tree, None, 0, "user", "no id", 9.0))
        rows.append(rows[-2])
    chain = [(99, i, i - 1 if i else None, "user" if i % 2 == 0 else "assistant", f"t{i}", 1.0) for i in range(37)]
    rows += chain + [(98, 1, 2, "user", "cycle", 1.0), (98, 2, 1, "user", "cycle", 1.0), (98, 3, 2, "user", "below", 1.0)]
    expected = plain_paths(rows)
    assert 98 not in expected and len(expected[99]) == 1
    out = conversations(spark.createDataFrame(rows, SCHEMA).withColumn("rank", F.lit("clash")), top=3).withColumn("said", turns(F.col("text"))).collect()
    got = {}
    for r in sorted(out, key=lambda r: r["rank"]):
        got.setdefault(r.tree, []).append((-r.score, -r.length, r.leaf, [(t.role, t.text) for t in r.said]))
    assert got == {t: v[:3] for t, v in expected.items()}


def test_template_is_reversible(spark):
    random.seed(5)
    pieces = ["<", "\\", "[", "s>", "/s>", "<s>", "</s>", "[INST]", "[\\INST]", "[/INST]", " ", "\n", "<<SYS>>", "<</SYS>>", "<<TURN:", ">>\n", "<</TURN>>", "é😀", "$1"]
    texts = ["".join(random.choices(pieces, k=random.randrange(12))) for _ in range(400)]
    one = spark.createDataFrame([(x,) for x in texts], "x string").select("x", unescaped(escaped(F.col("x"))).alias("y")).collect()
    assert all(r.x == r.y for r in one)
    roles = ["user", "assistant", "system", "", "tool", "a\\>b<", ">>\n", "\\b\\g", "user "]
    said = [[(random.choice(roles), t) for t in texts[i : i + 8]] for i in range(0, 400, 8)] + [[]]
    table = spark.createDataFrame([(i, s) for i, s in enumerate(said)], "i int, said array<struct<role:string,text:string>>")
    done = table.select("i", formatted(F.col("said")).alias("out")).select("i", "out.*", turns(F.col("out.text")).alias("back")).collect()
    for r in done:
        assert [tuple(t) for t in r.back] == said[r.i]
        assert [r.text[s.start : s.end] for s in r.loss] == [t.text for t in table_escaped(said[r.i])]


def table_escaped(said):
    import re
    from types import SimpleNamespace

    control = re.compile(r"([<\[])(\\*)(/?s>|</?SYS>>|<TURN:|</TURN>>|/?INST\])")
    return [SimpleNamespace(text=control.sub(r"\1\\\2\3", t)) for role, t in said if role == "assistant"]


def test_digests_long_texts_and_empty_tables(spark):
    import hashlib

    long = "x [INST] " * 200_000
    rows = [(1, 1, None, "user", PROBE, 0.0), (1, 2, 1, "assistant", long, 0.0), (2, 1, None, "assistant", None, 0.0)]
    got = {r.conv_id: r for r in digests(conversations(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert got[1].n_turns == 2 and got[1].loss_chars == len(long)
    assert got[1].turns_sha256 == hashlib.sha256(f"user\n{PROBE}\nassistant\n{long}\n".encode()).hexdigest()
    assert got[1].loss_sha256 == hashlib.sha256(long.encode()).hexdigest()
    assert got[2].loss_chars == 0 and got[2].n_turns == 1
    assert conversations(spark.createDataFrame([], SCHEMA)).count() == 0
