"""Operators 3 and 4: held-out accuracy, and what each part promises."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import language, toxicity

SF = "/root/testdata/sf0.1"


def held_out():
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def auc(scores, labels):
    """Probability that a toxic text has a higher score than another, ties counted half."""
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(scores))
    values, first, n = np.unique(scores[order], return_index=True, return_counts=True)
    for v, a, m in zip(values, first, n):
        ranks[order[a : a + m]] = a + (m + 1) / 2
    high = labels == 1
    return (ranks[high].sum() - high.sum() * (high.sum() + 1) / 2) / (high.sum() * (~high).sum())


def test_languages_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fit(docs, ~held_out())
    got = language.identify(docs, model).where(held_out()).toPandas()
    assert (got.lang == got["__lang"]).mean() >= 0.97
    for text in (None, "", " 12 !! \n", "_"):
        assert model.predict(text) == ("und", 0.0, False)
    for text in ("A.", "b", "é", "1x1", "日"):
        lang, score, _ = model.predict(text)
        assert lang != "und" and 0 <= score <= 1


def test_codewords_are_apart():
    for k in (2, 3, 4, 6, 9, 30):
        code = language.codewords(k)
        apart = (code[:, None, :] != code[None, :, :]).sum(axis=2) + 1000 * np.eye(k, dtype=int)
        assert code.shape[0] == k and apart.min() >= (1 if k < 4 else 3)
        assert (np.abs(code.sum(axis=0)) < k).all()


def test_ambiguous_and_untrained(spark):
    draw = random.Random(1)
    words = {"aa": ["bada", "boda", "duba"], "bb": ["kite", "tike", "keti"]}
    rows = [(i, " ".join(draw.choices(words[lang], k=30)), lang, "x") for i, lang in enumerate(["aa", "bb"] * 20)] + [(90, "text", None, "x"), (91, None, "aa", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, hash string")
    model = language.fit(docs, F.lit(True))
    assert model.predict("bada duba")[0] == "aa" and model.predict("kite keti")[0] == "bb"
    assert model.predict("bada duba boda kite keti tike")[2]
    assert not model.predict("bada " * 5000)[2]
    assert model.predict("zzzz")[2] and model.predict("zzzz")[0] == "aa"  # neither is known: a tie, which the first name wins
    twice = docs.union(docs).withColumn("__lang", F.lit("x")).withColumn("__score", F.lit("y"))
    got = language.identify(twice, model)
    assert got.columns == [*docs.columns, "__lang", "__score", "__ambiguous"] and got.count() == 2 * docs.count()
    assert language.identify(docs.where("false"), model).count() == 0
    assert language.fit(docs, F.lit(True), most_languages=1).languages == ["aa"]
    many = spark.createDataFrame([(i, f"word{i}", f"l{i:03}", "x") for i in range(600)], docs.schema)
    assert len(language.fit(many, F.lit(True)).languages) == 600
    nothing = language.fit(docs.where("false"), F.lit(True))
    assert {r["__lang"] for r in language.identify(docs, nothing).collect()} == {"und"}


def plain_codes(rows):
    """The same classifier, written with plain loops: log shares of hashed 4-grams of bytes, one weight a bit."""
    from collections import Counter

    def grams(text):
        raw = b" " + b"".join(bytes([c]) if c >= 128 or chr(c).isalpha() else b" " for c in text.lower().encode()) + b" "
        while b"  " in raw:
            raw = raw.replace(b"  ", b" ")
        raw = raw.ljust(4)
        return [int.from_bytes(raw[i : i + 4], "little") * 0x9E3779B1 % (1 << 32) >> 16 for i in range(len(raw) - 3)]

    names = sorted({lang for _, lang in rows})
    counts = {x: Counter(g for t, lang in rows if lang == x for g in grams(t)) for x in names}
    totals = {x: sum(counts[x].values()) + 0.5 * (1 << 16) for x in names}
    share = {x: [(counts[x][g] + 0.5) / totals[x] for g in range(1 << 16)] for x in names}
    weight = [float(np.log((share[names[0]][g] + 1e-9) / (share[names[1]][g] + 1e-9))) for g in range(1 << 16)]

    def predict(text):
        found = [weight[g] for g in grams(text)]
        return names[0] if sum(found) > 0 else names[1]

    return predict


def test_two_languages_equal_a_plain_classifier(spark):
    draw = random.Random(8)
    word = {"aa": lambda: "".join(draw.choice("abcde") for _ in range(5)), "bb": lambda: "".join(draw.choice("cdefg") for _ in range(5))}
    rows = [(" ".join(word[x]() for _ in range(40)), x) for x in ("aa", "bb") * 30]
    docs = spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate(rows)], "doc_id long, text string, lang string")
    model, plain = language.fit(docs, F.lit(True)), plain_codes(rows)
    tests = [" ".join(word[draw.choice(("aa", "bb"))]() for _ in range(draw.randrange(1, 6))) for _ in range(200)]
    assert [model.predict(t)[0] for t in tests] == [plain(t) for t in tests]


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{x}.parquet") for x in ("documents", "labels"))
    model = toxicity.fit(docs, labels, ~held_out())
    got = toxicity.score(docs, model).where(held_out()).join(labels, "doc_id").toPandas()
    assert got.score.between(0, 1).all()
    toxic = got.toxic == 1
    assert toxic.sum() > 50
    # All held-out labels count, the noise among them too.
    assert (got[toxic].score >= 0.5).mean() >= 0.8
    assert (got[~toxic].score < 0.5).mean() >= 0.99
    assert auc(got.score.to_numpy(), got.toxic.to_numpy()) >= 0.9


def plain_load(model, text):
    """Weights of whole words outside of exception phrases, by looking everywhere."""
    folded = " ".join(toxicity.fold(text or "").split())

    def places(x):
        return [(i, i + len(x)) for i in range(len(folded)) if folded.startswith(x, i) and not (i and folded[i - 1].isalpha()) and not folded[i + len(x) : i + len(x) + 1].isalpha()]

    spared = [p for x in model.exceptions for p in places(x)]
    found = sum(w for x, w in model.weights.items() for a, b in places(x) if not any(s <= a and b <= e for s, e in spared))
    return float(np.log1p(100 * found / (len(folded.split()) + 10))) if found else 0.0


def test_load_equals_a_plain_version():
    draw = random.Random(4)
    model = toxicity.Model({"idiot": 2.0, "scum": 1.5, "x y": 1.0}, exceptions=("idiot proof", "pond scum", "scum x"))
    words = ["idiot", "1d10t", "proof", "pond", "scum", "x", "y", "idiots", " ", "\n", "\t ", ".", "Scum"]
    for _ in range(500):
        text = "".join(draw.choice(words) + draw.choice((" ", "  ", "\n", "")) for _ in range(draw.randrange(12)))
        assert model.load([text])[0] == pytest.approx(plain_load(model, text)), text


def test_learned_exceptions_and_repeated_rows(spark):
    rows = [(i, f"you are {'scum' if i % 2 else 'nice'} here {i}") for i in range(40)] + [(100 + i, f"the pond  scum was green {i}") for i in range(12)]
    labels = [(i, i % 2) for i in range(40)] + [(100 + i, 0) for i in range(12)] + [(1, 0), (1, 1), (None, 1), (7, None)]
    docs = spark.createDataFrame([(i, t, "c", 1.0) for i, t in rows + [(1, "you are scum again"), (None, "scum")]], "doc_id long, text string, load string, score double")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(True))
    assert "scum" in model.weights and "pond scum" in model.exceptions
    assert model.load(["pond \n scum", "such scum"])[0] == 0 < model.load(["such scum"])[0]
    got = toxicity.score(docs, model)
    assert got.count() == docs.count() and got.columns == ["doc_id", "score", "load"]
    assert toxicity.score(docs.where("false"), model).count() == 0
    assert len(toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(True), most_words=1).weights) == 1


@pytest.mark.parametrize("text,hit", [("you IDIOT", True), ("you 1d10t!", True), ("іdіоt", True), ("an idíot", True), ("idiotic", False), ("an idiot proof plan", False), ("idiot proof, idiot", True), ("", False), (None, False)])
def test_folding_words_and_exceptions(text, hit):
    assert (toxicity.Model({"idiot": 2.0}).load([text])[0] > 0) == hit


def test_load_falls_with_length():
    short, long = toxicity.Model({"scum": 3.0}).load(["scum here", "scum here " + "word " * 50_000])
    assert short > long > 0


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (2, None, "y")], "doc_id long, text string, toxic string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxicity.score(docs, toxicity.fit(docs, labels, F.lit(True))).collect()] == [0.0, 0.0]
