"""The pipeline's stages on planted cases, and run() as a whole."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

ALPHABET = {"aa": "badogu", "bb": "kitelm"}


def text(lang, seed, lines=6):
    import random

    draw = random.Random(f"{lang}{seed}")
    return "\n".join(" ".join("".join(draw.choice(ALPHABET[lang]) for _ in range(draw.randrange(2, 9))) for _ in range(12)) for _ in range(lines))


@pytest.fixture(scope="module")
def docs(spark):
    shared = text("aa", "shared", 20)
    rows = [(i, text(lang, i), lang) for i, lang in enumerate(["aa", "bb"] * 15)]
    rows += [(40, None, "aa"), (41, "123 !!", "aa"), (42, "", None)]
    rows += [(50, text("aa", "x") + "\n" + shared, "aa"), (51, text("aa", "y") + "\n" + shared, "aa")]
    near = text("bb", "near", 1)
    rows += [(60, near, "bb"), (61, near + " more", "bb"), (62, "tiklek token = abcdef123456 " + text("bb", "z"), "bb")]
    return spark.createDataFrame([(i, t, lang, f"s{i}", None if t is None else len(t)) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")


def test_stages(spark, docs):
    kept = corpus_pipeline.language_stage(spark, docs, "").persist()
    assert {r.doc_id for r in docs.join(kept, "doc_id", "left_anti").collect()} == {40, 41, 42}
    lined = corpus_pipeline.line_stage(spark, kept, "").persist()
    texts = {r.doc_id: r for r in lined.collect()}
    assert set(texts) == {r.doc_id for r in kept.collect()}
    assert len(texts[51].text) < len(texts[50].text) and texts[51].text.startswith(text("aa", "y", 6)[:40])
    assert all(r.n_chars == len(r.text) for r in texts.values())
    assert [k for k, r in texts.items() if r.text != {x.doc_id: x.text for x in kept.collect()}[k]] == [51]
    one = corpus_pipeline.near_duplicate_stage(spark, lined, "").persist()
    assert set(texts) - {r.doc_id for r in one.collect()} == {61}
    clean = {r.doc_id: r.text for r in corpus_pipeline.secret_stage(spark, one, "").collect()}
    assert clean[62].startswith("tiklek [SECRET] ") and clean[60] == texts[60].text
    for out in (kept, lined, one):
        assert out.columns == docs.columns


def test_run(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path))
    totals = rows.groupBy("doc_id").agg(F.sum("length").alias("n"), F.first("doc_tokens").alias("all")).collect()
    assert {r.doc_id for r in totals} == {r.doc_id for r in docs.collect()} - {40, 41, 42, 61}
    assert all(r.n == r["all"] for r in totals)


def test_near_duplicate_stage_loses_no_other_row(spark):
    near = text("aa", "n", 2)
    rows = [(1, text("aa", "p")), (1, text("bb", "q")), (2, near), (3, near + " more"), (2, near), (5, ""), (6, ""), (None, near), (None, near), (7, "..."), (8, None)]
    docs = spark.createDataFrame([(t, i, "s", 1, "c") for i, t in rows], "text string, doc_id long, source string, node long, __rest string")
    got = corpus_pipeline.near_duplicate_stage(spark, docs, "")
    assert got.columns == docs.columns
    kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    assert kept == sorted([(1, rows[0][1]), (1, rows[1][1]), (2, near), (5, ""), (6, ""), (None, near), (None, near), (7, "..."), (8, None)], key=str)


def test_columns_that_have_no_order_stay(spark):
    near = text("aa", "r", 4)
    rows = [(1, near, {"k": 1}), (1, near, {"k": 1}), (2, near + " more", {"k": 2}), (3, text("bb", "q"), None), (4, "", {}), (None, near, {"z": 9})]
    docs = spark.createDataFrame(rows, "doc_id long, text string, extra map<string,int>").withColumn("json", F.parse_json(F.lit('{"a": [1]}')))
    got = corpus_pipeline.near_duplicate_stage(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.extra) for r in got.select("doc_id", "extra").collect()), key=str) == sorted([(1, {"k": 1}), (3, None), (4, {}), (None, {"z": 9})], key=str)


def test_stages_take_empty_tables_null_ids_and_clashing_names(spark):
    fields = "doc_id long, text string, lang string, source string, __lang string, __gone string, __row long, __text string, ids string"
    none = spark.createDataFrame([], fields)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, "").count() == 0
    body = text("aa", "z", 2)
    rows = [(None, body, "aa", "s", "a", "b", 1, "c", "d"), (4, body + " token = abcdef123456", "aa", None, "a", "b", 1, "c", "d"), (4, body + " token = abcdef123456", "aa", None, "a", "b", 1, "c", "d")]
    docs = spark.createDataFrame(rows, fields)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "").persist()
        assert docs.columns == [x.split()[0] for x in fields.split(", ")], name
    assert {r.doc_id for r in docs.collect()} == {None, 4} and docs.count() == 2
    assert docs.where("doc_id = 4").first().text.endswith("[SECRET]")
    assert {r.doc_id for r in corpus_pipeline.packing_stage(spark, docs, "").collect()} == {None, 4}


def test_run_equals_a_plain_version(spark, tmp_path):
    """The documents and lengths that plain versions of the stages give, stage by stage."""
    import re

    from test_classifiers import plain_codes
    from test_line_dedup import brute as plain_lines
    from test_ngram_join import brute as plain_join
    from test_token_operators import library_ids

    rows = [(i, text(lang, f"v{i}", 3), lang) for i, lang in enumerate(["aa", "bb"] * 8)] + [(30, "12 34", "aa"), (31, None, "bb")]
    shared = text("aa", "common", 8)
    rows += [(32, text("aa", "s1") + "\n" + shared, "aa"), (33, shared + "\n" + text("aa", "s2"), "aa"), (34, rows[2][1] + " tail", "aa"), (35, "pass word\nsecret: abcdefghij " + text("bb", "k"), "bb")]
    spark.createDataFrame([(i, t, x, f"s{i}") for i, t, x in rows], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    plain_codes([(t, x) for _, t, x in rows if t])  # both languages are learned, so only texts without letters are rejected
    left = [(i, t) for i, t, _ in rows if t and re.search(r"[^\W\d_]", t)]
    left = [(i, t) for i, t in plain_lines(left) if t]
    components = plain_join(left)
    left = [(i, t) for i, t in left if components[i][1] == i]
    masked = [(i, re.sub(r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6,}""", "[SECRET]", t)) for i, t in left]
    assert {r.doc_id: r.n for r in got} == {i: len(library_ids("word_bpe_49k.json", t)) for i, t in masked}
