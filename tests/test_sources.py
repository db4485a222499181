"""Markdown trees, JSON lines, change sets and parsers of embedded structures."""

from pyspark.sql import functions as F

from marlstone.operators import documents
from marlstone.sources import files

NOTE = "---\ntype: note\ntitle: My note\n---\n# Heading\n\nBody text.\n\n<!-- timeline -->\n- **2024-10-28** | mail — It began"


def test_markdown_round_trip(spark, tmp_path):
    (tmp_path / "in" / "people").mkdir(parents=True)
    (tmp_path / "in" / "node_modules").mkdir()
    (tmp_path / "in" / "people" / "Ann Lée.md").write_text("# Ann Lée\n\nA person.")
    (tmp_path / "in" / "note.md").write_text(NOTE)
    (tmp_path / "in" / "node_modules" / "x.md").write_text("no")
    (tmp_path / "in" / "other.txt").write_text("no")
    pages = files.markdown_tree(spark, str(tmp_path / "in"), "default")
    got = {r["slug"]: r for r in pages.collect()}
    assert set(got) == {"people/ann-lee", "note"}
    assert (got["people/ann-lee"]["type"], got["people/ann-lee"]["title"]) == ("person", "Ann Lée")
    assert (got["note"]["title"], got["note"]["compiled_truth"], got["note"]["timeline"]) == ("My note", "# Heading\n\nBody text.", "- **2024-10-28** | mail — It began")
    files.export_markdown(pages, str(tmp_path / "out"))
    again = {r["slug"]: r for r in files.markdown_tree(spark, str(tmp_path / "out"), "default").collect()}
    for slug, row in got.items():
        assert all(row[c] == again[slug][c] for c in ("type", "title", "compiled_truth", "timeline", "content_hash"))


def test_change_set(spark):
    lines = ["M\tnotes/a.md", "D\tnotes/b.md", "R100\tnotes/c.md\tnotes/d.md", "A\tnode_modules/x.md", "A\tx.py", "junk"]
    changes = files.change_set(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert sorted(tuple(r) for r in changes.collect()) == [("D", "notes/b.md", None), ("M", "notes/a.md", None), ("R", "notes/d.md", "notes/c.md")]
    pages = spark.createDataFrame([("notes/a", 1), ("notes/b", 1), ("notes/c", 1), ("notes/e", 1)], "slug string, v int")
    new = spark.createDataFrame([("notes/a", 2), ("notes/d", 1)], "slug string, v int")
    assert sorted(map(tuple, files.apply_changes(pages, changes, new).collect())) == [("notes/a", 2), ("notes/d", 1), ("notes/e", 1)]


def test_json_lines(spark, tmp_path):
    (tmp_path / "q.jsonl").write_text('# comment\n\n{"q": "a", "k": 3}\n{"q": "b"}\n{broken\n')
    assert sorted((r["q"], r["k"]) for r in files.json_lines(spark, str(tmp_path), "q string, k int").collect()) == [("a", 3), ("b", None)]


def test_rejects_are_listed(spark, tmp_path):
    (tmp_path / "in" / "dist").mkdir(parents=True)
    (tmp_path / "in" / "big.md").write_text("x" * 50)
    (tmp_path / "in" / "dist" / "a.md").write_text("x")
    (tmp_path / "in" / "b.txt").write_text("x")
    (tmp_path / "in" / "ok.md").write_text("x")
    root = str(tmp_path / "in")
    assert {r["slug"] for r in files.markdown_tree(spark, root, "s", most_bytes=10).collect()} == {"ok"}
    assert {(r["path"], r["reason"]) for r in files.markdown_rejects(spark, root, most_bytes=10).collect()} == {("big.md", "more than 10 bytes"), ("dist/a.md", "in dist"), ("b.txt", "no markdown")}
    (tmp_path / "q.jsonl").write_text('{"q": "a"}\n{broken\n')
    assert [r["line"] for r in files.json_rejects(spark, str(tmp_path / "q.jsonl"), "q string").collect()] == ["{broken"]


def test_chat_turns(spark):
    text = "intro\n[09:01] Ann: hello\nmore\n\n[09:02] Bob: hi: there\n"
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "id int, t string")
    assert sorted(map(tuple, documents.chat_turns(df, "id", "t").collect())) == [(1, 1, "09:01", "Ann", "hello\nmore"), (1, 2, "09:02", "Bob", "hi: there")]


def test_tables_headings_and_timelines(spark):
    text = "## T\n| a | b |\n|---|:-:|\n| 1 | |\n- **2024-13-40** | x — bad\n- **2024-02-03** | mail — ok"
    df = spark.createDataFrame([(1, text)], "id int, t string")
    assert [r["cells"] for r in documents.table_rows(df, "id", "t").orderBy("line_no").collect()] == [["a", "b"], ["1", ""]]
    assert [(r["level"], r["heading"]) for r in documents.headings(df, "id", "t").collect()] == [(2, "T")]
    assert [str(r["day"]) for r in documents.timeline_rows(df, "id", "t").collect()] == ["2024-02-03"]
    assert df.select(documents.front_matter(F.lit(NOTE), "title").alias("x")).first()["x"] == "My note"
