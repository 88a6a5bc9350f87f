"""The whole job on authored files, manuals, reports, audit, and the build's accounts."""

import json

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import hooks
from corpusloom.functions import lines
from corpusloom.functions import text as T
from corpusloom.functions import tokens
from corpusloom.operators import contamination, licenses, manuals, quota, records, stats, urdf
from corpusloom.plans import rebuild
from corpusloom.plans.build import build_category
from corpusloom.sources import connectors, files

RULES = contamination.load_rules('{"scenarios": [{"id": "s", "rules": [{"type": "phrase", "phrases": ["forbidden words"]}]}]}')
ROBOT = '<robot name="r"><link name="a"><inertial><mass value="2"/><origin xyz="0 0 1"/><inertia ixx="1" ixy="0" ixz="0" iyy="2" iyz="0" izz="3"/></inertial></link><link name="b"/><joint name="j" type="revolute"><parent link="a"/><child link="b"/><origin xyz="0 0 0.5" rpy="0 0 0"/><axis xyz="0 0 1"/><limit lower="-1" upper="1"/></joint></robot>'


def words(seed, n=150):
    return " ".join(f"{seed}{k * 7919 % 997}" for k in range(n))


def write(root, tree):
    for name, content in tree.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(content)


def extract(rows):
    """Pages of files that say what they hold, in place of a PDF reader."""
    return rows.withColumn("pages", F.split(F.regexp_replace(F.col("content").cast("string"), "^%PDF-", ""), "\f")).drop("content")


def test_rebuild(spark, tmp_path):
    raw = tmp_path / "raw"
    same = words("same")
    write(raw, {
        "one/LICENSE": "MIT License", "one/guide/a.md": words("a"), "one/guide/b.md": same, "one/c.md": "forbidden words " + words("c"), "one/d.md": f"token = '{'k1' * 12}' " + words("d"),
        "two/LICENSE": "Mozilla Public License", "two/b.rst": same + " ", "two/e.rst": words("e"),
        "gpl/x.md": words("x"), "paper/paper.txt": "Abstract\n" + words("p", 600),
    })
    meta = [
        ("cat1", "one", "f", "docs", "MIT", "u1", 100_000, None, False, "", ""), ("cat1", "two", "f", "docs", "Apache-2.0", "u2", 100_000, None, False, "", ""),
        ("cat1", "gone", "f", "docs", "MIT", "u3", 100, None, False, "", ""), ("cat1", "gpl", "f", "docs", "GPL-3.0", "u4", 100, None, False, "", ""),
        ("cat2", "paper", "g", "paper", "CC-BY-4.0", "u5", 280_000, "papers", False, "html", "2401.1"),
    ]
    catalogue = spark.createDataFrame(meta, rebuild.CATALOGUE)
    robots = spark.createDataFrame([("r", ROBOT, "MIT", "u"), ("bad", "no xml", "MIT", "u"), ("none", None, "MIT", "u"), ("shut", ROBOT, "GPL", "u")], "robot_id string, raw string, license_declared string, url string")
    books = [("r", "m.pdf", b"%PDF-" + (words("m") + "\f" + words("n")).encode(), "", True, "u"), ("r", "scan.pdf", b"%PDF-x", "", True, "u"), ("r", "page.pdf", b"<html>", "MIT", False, "u"), ("q", "shut.pdf", b"%PDF-x", "", False, "u")]
    books = spark.createDataFrame(books, "robot_id string, name string, content binary, license_declared string, allow_no_license boolean, url string")
    run = rebuild.rebuild(spark, str(raw), catalogue, RULES, "2026-01-01T00:00:00+00:00", str(tmp_path / "out"), robots, books, extract=extract)
    ids = [r.id for r in run.corpus.orderBy("ord").collect()]
    assert set(ids) == {"cat1-one-guide_a_md-docs", "cat1-one-guide_b_md-docs", "cat1-one-d_md-docs", "cat1-two-e_rst-docs", "cat2-paper-paper_txt-paper", "cat3-r-urdf", "cat3-r-pdf_manual"}
    events = {(r.outcome, r.item): (r.reason, r.message) for r in run.events.collect()}
    assert events["skip", "one-c_md"][0] == "contaminated" and "forbidden words" in events["skip", "one-c_md"][1]
    assert events["skip", "two-b_rst"] == ("exact duplicate", "exact duplicate of `one-guide_b_md`")
    assert events["fail", "gone"][0] == "missing raw folder" and events["skip", "gpl"][0] == "flagged:GPL-3.0"
    assert events["warn", "two"] == ("license mismatch", "declared Apache-2.0, detected MPL")
    assert {events["fail", x][0] for x in ("bad", "none")} == {"unreadable robot"} and events["skip", "shut"][0] == "flagged:GPL"
    assert "is not a PDF" in events["fail", "page.pdf"][1] and "only 1 characters" in events["fail", "scan.pdf"][1] and events["skip", "shut.pdf"][0] == "no-license"
    assert run.audit.passed and not run.passed  # the mix of so few documents is out of its bands
    lines_of = {json.loads(x)["id"]: json.loads(x) for p in (tmp_path / "out/full/corpus").glob("part-*") for x in p.read_text().splitlines()}
    assert set(lines_of) == set(ids) and lines_of["cat1-one-d_md-docs"]["scrubbed"] == "assigned_secret x1" and "arxiv_id" not in lines_of["cat3-r-urdf"]
    assert lines_of["cat2-paper-paper_txt-paper"]["arxiv_id"] == "2401.1" and lines_of["cat1-one-d_md-docs"]["family"] == "f"
    for name, text in (("run", "## Failures"), ("cat1", "| `one`".replace("`", "")), ("cat3", "## Extraction quality"), ("full", "**Overall mix: NON-COMPLIANT**")):
        assert text in run.reports[name], run.reports[name]
    assert "".join(p.read_text() for p in (tmp_path / "out/reports/full").glob("part-*")).strip() == run.reports["full"].strip()
    missing = rebuild.merge_categories(spark, {"cat1": run.categories["cat1"], "cat2": None}, RULES)
    assert {(r.outcome, r.item) for r in missing.events.where("outcome = 'warn'").collect()} == {("warn", "cat2")}


def source(name, kind="docs"):
    return {"source_id": name, "family": "f", "kind": kind, "repo_ref": None, "repo_commit": "c"}


def test_only_changed_sources_are_read_again(spark, tmp_path, monkeypatch):
    from corpusloom.plans import resume

    raw, store = tmp_path / "raw", str(tmp_path / "store")
    write(raw, {"one/a.md": words("a"), "two/b.md": words("b"), "two/sub/c.md": words("c"), "three/d.md": words("d")})
    opened, real = [], files.scan_sources
    monkeypatch.setattr(files, "scan_sources", lambda spark, root, names, *rest, **more: opened.append(names) or real(spark, root, names, *rest, **more))

    def run(*sources):
        got = resume.resumed(spark, str(raw), list(sources), store)
        return {r.source_id: r.state for r in got.states.collect()}, {r.doc_id: r.text for r in got.candidates.collect()}

    every = [source("one"), source("two"), source("three")]
    states, first = run(*every)
    assert set(states.values()) == {"new"} and set(first) == {"one-a_md", "two-b_md", "two-sub_c_md", "three-d_md"} and opened == [["one", "three", "two"]]
    states, again = run(*every)
    assert set(states.values()) == {"same"} and again == first and len(opened) == 1
    write(raw, {"two/b.md": words("new")})
    # a run that breaks off while it writes its manifest
    rename = resume._folder
    monkeypatch.setattr(resume, "_folder", lambda spark, path: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        run(*every)
    monkeypatch.setattr(resume, "_folder", rename)
    assert {r.doc_id: r.text for r in resume.stored(spark, store).collect()} == first
    states, changed = run(*every)
    assert states == {"one": "same", "two": "changed", "three": "same"} and opened[1:] == [["two"], ["two"]]
    assert changed == first | {"two-b_md": T_text(words("new"))} and changed["two-b_md"] != first["two-b_md"]
    states, fewer = run(source("one", "songs"), source("two"))
    assert states == {"one": "gone", "two": "same", "three": "gone"} and set(fewer) == {"two-b_md", "two-sub_c_md"}
    assert len(resume.drop_unused(spark, store)) == 2 and {r.doc_id for r in resume.stored(spark, store).collect()} == set(fewer)
    assert run()[1] == {} and resume.resumed(spark, str(tmp_path / "none"), every, store).candidates.count() == 0


def T_text(text):
    return text.strip()


def test_the_plan_of_many_sources_is_that_of_one(spark, tmp_path, monkeypatch):
    raw = tmp_path / "raw"
    write(raw, {f"s{i}/a.md": words(f"s{i}") for i in range(40)} | {"s0/LICENSE": "MIT License", "s7/LICENSE.md": "MIT License", "s7/sub/LICENSE": "no"})
    plans, real = [], rebuild.adapters.adapt_all
    monkeypatch.setattr(rebuild.adapters, "adapt_all", lambda rows: plans.append(real(rows)) or plans[-1])
    for n in (1, 40):
        rows, failed = rebuild.adapted(spark, str(raw), [source(f"s{i}") for i in range(n)] + [source("gone"), source("s1", "songs")])
        assert rows.count() == n and [r.doc_id for r in rows.orderBy("ord").collect()] == [f"s{i}-a_md" for i in range(n)]
        assert [(f[1], f[2]) for f in failed] == [("gone", "missing raw folder"), ("s1", "unknown kind")]
    sizes = [len(p._jdf.queryExecution().optimizedPlan().toString().splitlines()) for p in plans]
    assert sizes[0] == sizes[1]
    found = {r.source_id: r.license_detected for r in rebuild.detected_licenses(spark, str(raw), [f"s{i}" for i in range(40)] + ["gone"]).collect()}
    assert found == {"s0": "MIT", "s7": "MIT"} and rebuild.detected_licenses(spark, str(raw), ["gone"]).count() == 0


def test_every_candidate_is_kept_or_an_event(spark):
    rows = [(f"d{k}", f"s{k % 3}", "g", f"p{k}", k, words(f"w{k}", 30)) for k in range(12)] + [("n", None, "g", "p", 50, words("n"))]
    docs = spark.createDataFrame(rows, "doc_id string, source_id string, grp string, rel_path string, ord int, text string")
    budgets = spark.createDataFrame([("s0", 50), ("s1", 10_000), ("s1", 5)], "source_id string, token_budget int")
    built = build_category(docs, RULES, budgets)
    kept, events = {r.doc_id for r in built.kept.collect()}, {r.item: r.reason for r in built.events.collect()}
    assert kept | set(events) == {r[0] for r in rows} and not kept & set(events)
    assert {k for k, v in events.items() if v == "no budget"} == {r[0] for r in rows if r[1] in ("s2", None)}
    with pytest.raises(ValueError):
        build_category(docs, RULES, budgets, only=["s0", "unknown"])


def test_recognised_manuals(spark, monkeypatch):
    blocks = {b"1": [("page one " + words("o"), 0.9, 0.0, 0.0, 10.0)], b"2": [], b"3": [("three", 0.5, 0.0, 0.0, 10.0)]}
    monkeypatch.setattr(hooks, "RECOGNISERS", {"fake": lambda raw: blocks[raw]})
    monkeypatch.setattr(hooks, "WRITERS", {"template": None})
    images = spark.createDataFrame([("r", "s.pdf", p, 0, str(p).encode()) for p in (1, 2, 3)], "robot_id string, name string, page int, band int, image binary")
    got = manuals.recognised_texts(images, ["robot_id", "name"], most_pages=2).first().r
    assert got.text.startswith("page one") and got.confidence == 0.9 and (got.n_pages, got.n_pages_with_text) == (2, 1) and got.note == "1 pages were not read"
    books = spark.createDataFrame([("r", "s.pdf", b"%PDF-x"), ("r", "t.pdf", b"%PDF-y"), ("e", "n.pdf", None)], "robot_id string, name string, content binary")
    read = manuals.manual_documents(books, extract, lambda wanted: manuals.recognised_texts(images.join(wanted.select("robot_id", "name"), ["robot_id", "name"]), ["robot_id", "name"]))
    rows = {r.name: r for r in read.collect()}
    assert rows["s.pdf"].ocr and rows["s.pdf"].ocr_confidence == 0.7 and rows["s.pdf"].error is None
    assert "nothing was recognised" in rows["t.pdf"].error and rows["t.pdf"].text is None and "not a PDF" in rows["n.pdf"].error


def test_recognised_texts_are_remembered(spark, monkeypatch, tmp_path):
    blocks = {b"1": [("page one " + words("o"), 0.9, 0.0, 0.0, 10.0)], b"2": [("page two " + words("p"), 0.8, 0.0, 0.0, 10.0)]}
    monkeypatch.setattr(hooks, "RECOGNISERS", {"fake": lambda raw: blocks[raw]})
    images = spark.createDataFrame([("r", "s.pdf", 1, 0, b"1"), ("r", "t.pdf", 1, 0, b"2")], "robot_id string, name string, page int, band int, image binary")
    asked = []

    def recognise(wanted):
        asked.append(sorted(r.name for r in wanted.collect()))
        return manuals.recognised_texts(images.join(wanted.select("robot_id", "name"), ["robot_id", "name"]), ["robot_id", "name"])

    def read(*rows):
        books = spark.createDataFrame(rows, "robot_id string, name string, content binary")
        got = manuals.manual_documents(books, extract, manuals.remembered(recognise, f"{tmp_path}/cache")).collect()
        return {r.name: (r.text, r.ocr_confidence, r.error) for r in got}

    first = read(("r", "s.pdf", b"%PDF-x"))
    again = read(("r", "s.pdf", b"%PDF-x"), ("r", "t.pdf", b"%PDF-y"))
    changed = read(("r", "s.pdf", b"%PDF-z"))
    assert asked == [["s.pdf"], ["t.pdf"], ["s.pdf"]]
    assert first["s.pdf"] == again["s.pdf"] == changed["s.pdf"] and first["s.pdf"][2] is None and again["t.pdf"][1] == 0.8
    monkeypatch.setattr(hooks, "CACHE_VERSION", hooks.CACHE_VERSION + 1)
    assert read(("r", "s.pdf", b"%PDF-x")) == first and len(asked) == 4


def test_a_writer_describes_robots_within_the_figures(spark, monkeypatch):
    said, repaired = [], ROBOT.replace("<robot", '<robot ', 1).replace("</robot>", "<x:extra/></robot>")

    def good(prompt, role):
        return "  A machine with few joints.  " if "n_joints: " in prompt and role == urdf.DESCRIBER else "wrong prompt"

    monkeypatch.setattr(hooks, "WRITERS", {"template": None, "good": good, "bad": lambda prompt, role: "It weighs 987654 kg."})
    rows = spark.createDataFrame([("a", ROBOT, "MIT", ""), ("b", repaired, "MIT", "")], "robot_id string, raw string, license_declared string, url string")
    none = spark.createDataFrame([], "robot_id string, name string, content binary, license_declared string, allow_no_license boolean, url string")
    for name in (None, "template", "good", "bad"):
        built, _ = rebuild.build_robots(spark, rows, none, RULES, "now", extract, writer=name)
        said.append({r.id: r.text.split("\n\n```urdf")[0] for r in built.kept.collect()})
        warned = [(r.outcome, r.item, r.reason) for r in built.events.collect()]
        assert warned == [("warn", "b", "repaired robot")]
    assert said[0] == said[1] == said[3] and all("URDF model" in x for x in said[0].values())
    assert set(said[2].values()) == {"A machine with few joints."}


def test_papers_by_page_or_by_pdf(spark, tmp_path):
    from corpusloom.sources.connectors import collected_papers

    long = "An abstract sentence of some length. " * 80
    for name, kind, content in (("1", "html", f'<article class="ltx_document"><p>{long * 2}</p></article>'), ("2", "pdf", "%PDF"), ("3", "html", "<p>short</p>")):
        (tmp_path / name).mkdir()
        (tmp_path / name / f"paper.{kind}").write_text(content)
    book = lambda rows: rows.select("paper", F.array(F.lit(long), F.lit(long + "\n\nReferences\n[1] gone")).alias("pages"))
    got = {r.paper: r.text for r in collected_papers(spark, str(tmp_path), book).collect()}
    assert got["1"].startswith("An abstract") and got["2"].count("An abstract") > 100 and "[1] gone" not in got["2"] and got["3"] is None


def test_exact_tokens_and_licensed(spark):
    public = pytest.importorskip("public_tokenizers")
    count, exact = tokens.counter(public.path("byte_bpe_50k.json"))
    docs = spark.createDataFrame([("a", "hello world, hello", "MIT"), ("b", None, "no-license")], "doc_id string, text string, license string")
    assert exact and [r.n for r in docs.select(count(F.col("text")).alias("n")).collect()] == [4, None]
    drafts = docs.select("doc_id", F.lit("t").alias("source_type"), F.lit("").alias("source_name"), F.col("license").alias("license_status"), F.lit("").alias("url"), "text")
    row = records.assemble(drafts, "cat1", "now", tokens=count(F.col("text"))).first()
    assert row.n_tokens_exact and row.n_tokens == 4 and not records.assemble(drafts, "cat1", "now").first().n_tokens_exact
    assert [r.doc_id for r in licenses.licensed(docs).collect()] == ["a"]
    assert tokens.counter(None)[1] is False


def test_older_prose_and_broken_robots(spark):
    rows = spark.createDataFrame([(1, ROBOT), (2, "<sdf/>"), (3, None), (4, "<robot")], "i int, raw string")
    got = {r.i: r.p for r in rows.select("i", urdf.prose(F.col("raw")).alias("p")).collect()}
    text = got[1].text
    assert text.startswith("This document details the physical specifications for the r extracted") and "Ixx: 1, Iyy: 2, Izz: 3, and its inertia products are Ixy: 0" in text
    assert "The link named b has a mass of Unknown." in text and "lower: -1, upper: 1, effort: None, velocity: None" in text
    assert "not robot" in got[2].error and got[3].error == "no text" and got[4].error
    models = {r.i: r.p for r in rows.select("i", urdf.parsed(F.col("raw")).alias("p")).collect()}
    assert models[1].model.name == "r" and models[3].error == "no text" and models[4].model is None
    document = rows.withColumn("model", urdf.model(F.col("raw"))).transform(urdf.robot_document)
    assert {r.i: r.cap.kinematic_span_m for r in document.where("model is not null").collect()}[1] == 0.5


def test_small_figures(spark):
    catalogue = spark.createDataFrame([("a", "f", 5), ("b", "f", 7), ("c", "g", None)], "source_id string, family string, token_budget int")
    assert stats.total_budget(catalogue).first().total_budget == 12
    assert {r.family: (r.sources, r.token_budget) for r in stats.by_family(catalogue).collect()} == {"f": (["a", "b"], 12), "g": (["c"], None)}
    pool = spark.createDataFrame([("x",), ("x",), ("y",)], "grp string")
    assert tuple(stats.papers_represented(pool.where("grp = 'x'"), pool).first()) == (1, 2)
    rows = spark.createDataFrame([(x,) for x in (1, 2, 2, 9, None)], "n_tokens long")
    assert tuple(stats.distribution(rows).first()) == (2.0, pytest.approx(7.95), 9)
    books = spark.createDataFrame([("a",), ("b",)], "robot_id string")
    check = stats.manuals_checklist(books, books.where("robot_id = 'a'"), F.lit(True))
    assert tuple(stats.checklist_counts(check).first()) == (2, 1, 2, 1)
    events = spark.range(400).select(F.lit("skip").alias("outcome"), F.col("id").cast("string").alias("item"), F.lit("near").alias("reason"), F.lit("a|b\nc").alias("message"))
    report = stats.run_report("run", events, 1.0)
    assert "| **total** | **400** |" in report and "and 200 more" in report and "a\\|b c" in report


def test_audit_states(spark):
    docs = spark.createDataFrame([("1", "clean"), ("2", "the Forbidden  words")], "id string, text string")
    audit = contamination.audited({"a": docs, "b": docs.where("id = '1'"), "c": None}, RULES)
    assert {r.corpus: (r.n_records, r.n_flagged, r.state) for r in audit.states.collect()} == {"a": (2, 1, "CONTAMINATED"), "b": (1, 0, "clean"), "c": (0, 0, "missing")}
    assert audit.exit_code == 1 and contamination.text_audited(spark, "fine", RULES).exit_code == 0
    many = contamination.load_rules(json.dumps({"scenarios": [{"id": "s", "rules": [{"type": "phrase", "phrases": [f"phrase {k} here" for k in range(3000)]}]}]}))
    rows = spark.createDataFrame([("1", "A phrase 2999 here, and PHRASE 7  here.")], "id string, text string")
    assert [(m.terms, m.position) for m in contamination.inventory(rows, many).first().matches] == [(["phrase 7 here"], 24), (["phrase 2999 here"], 2)]


def test_paths_and_connectors(spark):
    paths = ["a/b.md", "b.md", "docs/x/y.md", "docs/z.md", "G1_manual.pdf", ".hidden", "src/a.b/c"]
    got = {r.p: r for r in spark.createDataFrame([(p,) for p in paths], "p string").select("p", T.group_key(F.col("p")).alias("g"), T.document_id(F.lit("s"), F.col("p"), F.lit(2), F.lit(3)).alias("d"), T.robot_name(F.col("p")).alias("r"), T.relative_path(F.concat(F.lit("/root/"), "p"), "/root/").alias("rel"), T.absolute_path(F.col("p"), "/root").alias("abs")).collect()}
    assert [got[p].g for p in paths] == ["a", "(root)", "docs/x", "docs", "(root)", "(root)", "src"]
    assert got["a/b.md"].d == "s-a_b_md-p2" and got["G1_manual.pdf"].r == "Unitree G1" and got[".hidden"].r == ".hidden"
    assert all(r.rel == r.p and r.abs == f"/root/{r.p}" for r in got.values())
    assert connectors.flat_name("a/b/c.urdf") == "a_b_c.urdf"
    robots = spark.createDataFrame([("m1",), ("m2",)], "module string")
    descriptions = spark.createDataFrame([("m1", "repo")], "module string, repository string")
    repositories = spark.createDataFrame([("repo", "u", "c", "MIT")], "repository string, url string, commit string, license string")
    assert {r.module: r.license for r in connectors.with_repositories(robots, descriptions, repositories).collect()} == {"m1": "MIT", "m2": None}
    shuffled = [r.id for r in records.shuffled(spark.createDataFrame([(f"i{k}",) for k in range(30)], "id string")).collect()]
    again = [r.id for r in records.shuffled(spark.createDataFrame([(f"i{k}",) for k in reversed(range(30))], "id string").repartition(7)).collect()]
    assert shuffled == again != sorted(shuffled)


def test_scans(spark, tmp_path):
    write(tmp_path, {"a.MD": "x", "b.md": "y", "c.txt": "z", "d/e.py": "w"})
    assert {r.rel_path for r in files.scan(spark, str(tmp_path), (".md", ".py")).select("rel_path").collect()} == {"a.MD", "b.md", "d/e.py"}
    raw = spark.createDataFrame([(b"a\xff\r\nb",)], "c binary").select(files.strict_text(F.col("c")).alias("s"), files.lenient_text(F.col("c")).alias("l")).first()
    assert raw.s is None and raw.l == "a�\r\nb"
    rows = spark.createDataFrame([("Café   X",), ("A \x1c B",), (None,), ("a &amp; b",)], "t string")
    assert [r.p for r in rows.select(lines.plain(F.col("t")).alias("p")).collect()] == ["cafe x", "a b", None, "a &amp; b"]
    assert [r.p for r in rows.select(lines.entities_resolved(F.col("t")).alias("p")).collect()][3] == "a & b"
    none = spark.createDataFrame([], "ord int, source_id string, grp string, rel_path string, n_tokens int")
    assert quota.select_within_budget(none, F.lit(5)).count() == 0
