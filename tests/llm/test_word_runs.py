import hashlib
import random
import re
import zlib

import numpy as np

from corpusloom.llm.word_runs import op12_word_runs, planted, runs_of, word_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words, least=12):
    """All runs, from the definition: stretches that agree at each distance, the smallest distance of each."""
    found = {}
    n = len(words)
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(least, 2 * p):
                found.setdefault((i, j + p), p)
            i = j
    return sorted((a, b - a, p) for (a, b), p in found.items())


def made_periodic(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def plain_row(doc_id, text):
    words = made_periodic(doc_id, WORD.findall(text or ""))
    runs = plain_runs(words)
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    best = min(((-length, s, p) for s, length, p in runs), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (
        doc_id,
        len(runs),
        *((best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4),
        sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)),
        sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def test_runs_against_the_definition():
    random.seed(3)
    for _ in range(1500):
        n = random.randrange(90)
        words = [random.randrange(random.choice([1, 2, 3, 9])) for _ in range(n)]
        if random.random() < 0.6 and n > 8:  # nested repeats
            for _ in range(2):
                a, p = random.randrange(n), random.randrange(1, 14)
                for i in range(a + p, min(n, a + random.randrange(2, 9) * p)):
                    words[i] = words[i - p]
        least = random.choice([2, 5, 12])
        assert runs_of(np.array(words, dtype=np.int32), least) == plain_runs(words, least), words
    fibonacci = [0]
    other = [0, 1]
    for _ in range(9):
        fibonacci, other = other, other + fibonacci
    assert runs_of(np.array(fibonacci, dtype=np.int32)) == plain_runs(fibonacci)


def test_long_texts():
    same = np.zeros(200_000, dtype=np.int32)
    assert runs_of(same) == [(0, 200_000, 1)]
    period = np.tile(np.arange(70_000, dtype=np.int32), 3)[:190_000]
    assert runs_of(period) == [(0, 190_000, 70_000)]
    assert runs_of(np.arange(300_000, dtype=np.int32)) == []


def test_query_against_the_definition(spark, tmp_path):
    random.seed(8)
    spaces = [" ", "\n", "\t", "\r\n", "\x0b", "\x0c", "  "]
    odd = ["a", "b", "é", " ", "\x85", "x y", "\x1c", "\x1fz", "\x00", "W"]
    rows = [(None, "a " * 30), (1, None), (2, ""), (3, " \n"), (3, "b " * 12), (3, "b " * 12), (None, None)]
    for i in range(4, 320):
        rows.append((i - 40, "".join(random.choice(odd[: random.randrange(1, 11)]) + random.choice(spaces) for _ in range(random.randrange(70)))))
    table = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, __runs string").repartition(3)
    table.write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in op12_word_runs(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted((plain_row(*r) for r in rows), key=str)
    kept = word_runs(table, "doc_id", "`__runs`").drop("__collapsed")
    assert kept.columns == ["doc_id", "__runs", "__runs"] and kept.count() == len(rows)
    empty = word_runs(planted(table.limit(0)), "doc_id")
    assert empty.count() == 0
