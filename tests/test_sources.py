"""Scans, selection and adapters on files written for the purpose; streaming ingest."""

import json

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import adapters
from corpusloom.sources import files
from corpusloom.streaming.ingest import append_to, fresh_documents

META = {"source_id": "s", "family": "f", "kind": "docs", "repo_commit": "2401.1", "repo_ref": "html"}


def write(root, tree):
    for name, content in tree.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(root)


def test_documents(spark, tmp_path):
    text = "line of text here\r\n" * 40
    root = write(tmp_path, {"docs/a/x.md": text, "docs/a-b.md": text, "short.md": "x", "bad.md": b"\xff\xfe" * 400, "gen.py": "# do not edit\n" + text, "code.PY": text, "other.txt": text, "long.md": "".join(f"# h{k}\n" + "w " * 9000 + "\n" for k in range(3)) + "# t\nx"})
    got = {r.rel_path: r for r in adapters.adapt(files.scan(spark, root), META).where("part_no = 1").collect()}
    assert set(got) == {"docs/a/x.md", "docs/a-b.md", "code.PY", "long.md"}
    assert got["docs/a/x.md"].grp == "docs/a" and got["docs/a-b.md"].grp == "docs" and got["code.PY"].grp == "(root)"
    assert got["docs/a/x.md"].doc_id == "s-docs_a_x_md" and "\r" not in got["code.PY"].text
    assert got["long.md"].flags["part"] == "1" and got["long.md"].doc_id.endswith("-p1")
    assert got["docs/a/x.md"].path_parts < got["docs/a-b.md"].path_parts
    with pytest.raises(ValueError):
        adapters.adapt(files.scan(spark, root), META | {"kind": "songs"})


def test_interfaces_notebooks_papers(spark, tmp_path):
    root = write(tmp_path / "i", {"pkg/msg/A.msg": "int32 x\n" * 30, "pkg/msg/B.msg": "  \n", "pkg/C.srv": "---\n"})
    row = adapters.adapt(files.scan(spark, root), META | {"kind": "interfaces"}).first()
    assert row.doc_id == "s-pkg" and row.flags == {"n_interfaces": "3"}
    assert row.text.startswith("# pkg — ROS 2 interface definitions\n\n## pkg/C (srv)\n```\n---\n```\n\n## pkg/msg/A (msg)\n```\nint32 x") and "B" not in row.text
    cells = [{"cell_type": "markdown", "source": ["Some *words* ", "here " * 90]}, {"cell_type": "code", "source": "print(1)"}, {"cell_type": "raw", "source": "gone"}, {"cell_type": "code", "source": []}]
    root = write(tmp_path / "n", {"my book.ipynb": json.dumps({"cells": cells}), "broken.ipynb": "{", "page.md": "text " * 100})
    got = {r.doc_id: r for r in adapters.adapt(files.scan(spark, root), META | {"kind": "notebooks"}).collect()}
    assert set(got) == {"s-my_book", "s-page"} and got["s-my_book"].text.endswith("```python\nprint(1)\n```") and "gone" not in got["s-my_book"].text
    root = write(tmp_path / "p", {"paper.txt": "Names\nAbstract\n" + "word " * 500})
    row = adapters.adapt(files.scan(spark, root), META | {"kind": "paper"}).first()
    assert row.grp == "arxiv:2401.1" and row.text.startswith("Abstract") and row.flags["fetch"] == "html"


def test_file_kinds_and_selection(spark):
    heads = [b"%PDF-1", b"  <!DOCTYPE HTML>", b"PK\x03\x04", b"\x89PNG", b"\xff\xd8\xff\xe0", b"", b"abc"]
    kinds = spark.createDataFrame([(i, h) for i, h in enumerate(heads)], "i int, c binary").select("i", files.file_kind(F.col("c")).alias("k")).orderBy("i").collect()
    assert [r.k for r in kinds] == ["PDF", "HTML", "ZIP", "PNG", "JPEG", "unknown", "unknown"]
    paths = ["a.md", "x/b.md", "x/tests/c.md", "tests_x/d.md", "CHANGELOG_1.md", "x/y.py"]
    rows = spark.createDataFrame([(p,) for p in paths], "p string").where(files.selected(F.col("p"), ["**/*.md"], ["tests/*", "CHANGELOG*"])).collect()
    assert {r.p for r in rows} == {"a.md", "x/b.md"}
    pdfs = spark.createDataFrame([("r", "b.pdf", "z.pdf"), ("r", "z.pdf", "z.pdf"), ("q", "b.pdf", None), ("q", "a.pdf", None)], "robot string, name string, preferred string")
    assert {r.robot: r.file for r in files.best_file(pdfs, "robot", "preferred").collect()} == {"r": "z.pdf", "q": "a.pdf"}


def test_json_lines(spark, tmp_path):
    rows = spark.createDataFrame([(2, "b c", None), (1, "a", 5)], "ord int, text string, part int")
    files.write_json_lines(rows, f"{tmp_path}/out", ["ord"])
    lines = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*"))).split("\n")
    assert [json.loads(x) for x in lines if x] == [{"ord": 1, "text": "a", "part": 5}, {"ord": 2, "text": "b c"}]
    assert [x.count() for x in files.read_json_lines(spark, f"{tmp_path}/out", "ord int, text string")] == [2, 0]
    new = spark.createDataFrame([(1, "new")], "ord int, text string")
    assert {(r.ord, r.text) for r in files.replace_rows(rows, new, "ord").collect()} == {(1, "new"), (2, "b c")}


def test_stream(spark, tmp_path):
    spark.sql("select 'same text' as text, timestamp'2026-01-01 00:00:00' as arrived union all select 'SAME, text', timestamp'2026-01-01 00:01:00' union all select 'do not edit', timestamp'2026-01-01 00:02:00'").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("text string, arrived timestamp").parquet(f"{tmp_path}/in")
    append_to(fresh_documents(stream), f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination(120)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 1


def test_shared_folder_and_scratch_tables(spark):
    from types import SimpleNamespace

    from corpusloom import staging

    for master, fails in (("spark://host:7077", True), ("yarn", True), ("local-cluster[2,1,1024]", True)):
        context = SimpleNamespace(master=master, getConf=lambda: SimpleNamespace(get=lambda key: None), getCheckpointDir=lambda: None)
        with pytest.raises(ValueError):
            staging.shared_dir(SimpleNamespace(sparkContext=context))
        assert fails
    named = SimpleNamespace(master="yarn", getConf=lambda: SimpleNamespace(get=lambda key: "hdfs://x/checkpoints/"), getCheckpointDir=lambda: None)
    assert staging.shared_dir(SimpleNamespace(sparkContext=named)) == "hdfs://x/checkpoints"
    table = staging.shared_table(spark.range(3), "own")
    folder = table.scratch_path.removeprefix("file:")
    assert table.count() == 3
    staging.drop_tables(table, None, spark.range(1))
    import os

    assert not os.path.exists(folder)


def test_lines_that_do_not_parse_are_in_quarantine(spark, tmp_path):
    lines = ['{"a": 1, "b": "x"}', '{"a": 1', "", "  ", "[1]", '[{"a": 1}]', "null", '{"a": "no"}', '{"c": 2}', "3", "no json", '{"a": null, "b": "\\u2028 é"}', '{"a": 2} {"a": 3}', '{"a": 4}] [', '{"a": 5}} {', '{"a": 6},{"a": 7}', ' {"a": 8} ']
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(f"{tmp_path}/lines")
    records, quarantine = files.read_json_lines(spark, f"{tmp_path}/lines", "a int, b string")
    assert sorted(((r.a, r.b) for r in records.collect() if r.a), key=str) == [(1, "x"), (8, None)] and records.count() == 4
    assert {r.line: r.reason for r in quarantine.collect()} == {
        '{"a": 1': files.MALFORMED, "[1]": files.MISFIT, '[{"a": 1}]': files.MISFIT, "null": files.MISFIT, '{"a": "no"}': files.MISFIT, "3": files.MISFIT, "no json": files.MALFORMED, '{"a": 2} {"a": 3}': files.MALFORMED,
        '{"a": 4}] [': files.MALFORMED, '{"a": 5}} {': files.MALFORMED, '{"a": 6},{"a": 7}': files.MALFORMED,
    }
    assert records.count() + quarantine.count() == len([x for x in lines if x.strip()])
