from pyspark.sql import functions as F

from folio.functions import text as T
from folio.operators import analytics
from folio.operators.chunking import ChunkingConfig, blocks, child_chunks, sentence_pieces
from folio.operators.sections import explode_sections, parent_chunks
from folio.sources import files


def parents(spark, md):
    docs = spark.createDataFrame([(1, md)], "doc long, md string")
    return parent_chunks(explode_sections(docs), "doc")


def children(spark, md, limit, least):
    return child_chunks(parents(spark, md), ChunkingConfig(limit, 0, least)).orderBy("section_no", "chunk_index").collect()


def test_sections_and_breadcrumbs(spark):
    got = [(r.title, r.level, r.start_line, r.end_line, r.section_path) for r in parents(spark, "intro\n# A\na1\n## B\n### C\nc1\n## D").orderBy("section_no").collect()]
    assert got == [("Document", 1, 1, 1, "Document"), ("A", 1, 2, 2, "A"), ("B", 2, 4, 3, "A > B"), ("C", 3, 5, 5, "A > B > C"), ("D", 2, 7, 6, "A > D")]
    assert [r.section_path for r in parents(spark, "x\n## B").orderBy("section_no").collect()] == ["Document", "Document > B"]
    assert [r.title for r in parents(spark, "```\n# not header\n```").orderBy("section_no").collect()] == ["Document", "not header"]
    assert children(spark, "```\n# not header\n```", 450, 60) == []
    assert parents(spark, "").collect() == []


def test_blocks(spark):
    (c,) = children(spark, "# H\n1. a\n2. b\n- c", 450, 60)
    assert (c.page_content, c.token_count, c.block_types) == ("1. a\n\n2. b\n\n- c", 7, ["list", "paragraph"])
    one = lambda s: [(b.kind, b.text, b.start_line, b.end_line) for b in spark.createDataFrame([(s.split("\n"),)], "c array<string>").select(blocks(F.col("c"), F.lit(1)).alias("b")).first().b]
    assert one("| a |\ntext") == [("paragraph", "| a |\ntext", 1, 2)]
    assert one("| a | b |\n|---|---|\n| 1 | 2 |\nafter\n\n> q\n> r\n>\n```\ncode\n\n```\n- x\n  y\n```\nlost") == [
        ("table", "| a | b |\n|---|---|\n| 1 | 2 |", 1, 3), ("paragraph", "after", 4, 4), ("blockquote", "> q\n> r", 6, 7), ("paragraph", ">", 8, 8), ("code", "```\ncode\n\n```", 9, 12), ("list", "- x\n  y", 13, 14),
    ]


def test_packing(spark):
    a, b = "x" * 40, "y" * 8
    (c,) = children(spark, f"# H\n{a}\n\n{b}", 10, 5)
    assert (c.page_content, c.token_count, c.end_line) == (a, 12, 3)
    s = "A" + "b" * 34 + "."
    got = children(spark, f"# H\n{b}\n\n{s} {s}", 10, 5)
    assert [(c.page_content, c.token_count) for c in got] == [(s, 9), (s, 11)] and got[1].end_line == 1
    got = children(spark, f"# H\n{'x' * 20}\n\n{s} {s}\n\n{'z' * 24}", 10, 6)
    assert [c.page_content for c in got] == [s, s, "x" * 20, "z" * 24] and [c.chunk_index for c in got] == [0, 1, 2, 3]
    assert got[0].chunking_strategy == "structure_aware_md_v1_split_atomic"


def test_text_functions(spark):
    row = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert row(T.clean_page(F.lit("a  \n\n\n\nb ${FIG:j:001:0}\n"), "[P]")) == "a\n\nb [P]\n"
    assert row(T.is_separator_row(F.lit("|---|"))) and not row(T.is_separator_row(F.lit("| - | : |")))
    assert row(T.has_caption(F.lit("Figment"))) and not row(T.has_caption(F.lit("config 5")))
    assert row(T.token_filename(F.lit("${FIG:ab:002:0}"))) == "FIG__ab__002__0"
    assert [row(T.pdf_stem(F.lit(p))) for p in ("out/Headache/output.md", "a/test_out/MASH/x.md", "out/output.md")] == ["Headache", "MASH", None]
    assert row(T.figure_token(F.lit("j"), F.lit(3), F.lit(0))) == "${FIG:j:003:0}"
    for t in ("", "a", "a\n", "a\r\nb\n\n", "\n", "x\x0by z"):
        assert row(T.lines(F.lit(t))) == t.splitlines(), t
    null = F.lit(None).cast("string")
    assert row(T.is_meaningful_visual(F.lit("image"), F.lit(None).cast("double"), null, F.lit("see"))) is True
    assert row(T.is_meaningful_visual(F.lit("image"), F.lit(0.01), null, F.lit("company logo"))) is False
    assert row(T.is_meaningful_visual(F.lit("image"), F.lit(0.01), F.lit("Figure 2"), null)) is True
    assert row(T.is_meaningful_visual(F.lit("chart"), F.lit(0.01), null, F.lit("text"))) is True
    edges = lambda *x: F.array(*map(F.lit, map(float, x)))
    assert row(T.is_multi_column(edges(*[50] * 5, *[320] * 3), F.lit(600.0))) is True
    assert row(T.is_multi_column(edges(*[50] * 7, 320), F.lit(600.0))) is False
    assert row(T.is_multi_column(edges(*[50] * 7), F.lit(600.0))) is None
    assert row(F.array_join(sentence_pieces(F.lit("One. Two! three? Four"), 1), "|")) == "One.|Two! three?|Four"


def test_corpus_figures(spark):
    docs = spark.createDataFrame([("a", "x"), ("b", None), ("c", "x")], "doc string, stem string")
    parents = spark.createDataFrame([("a", 0, "One Head"), ("a", 1, "Two"), ("b", 0, "head")], "doc string, section_no int, title string")
    children = spark.createDataFrame([("a",), ("a",), ("a",)], "doc string")
    r = analytics.corpus_summary(docs, parents, children, "doc", "stem", {"limit": 450, "name": "s"}).first()
    assert (r.files, r.parents, r.children, r.parents_per_file, r.unique_stems, r.configuration) == (3, 3, 3, 1.0, ["x"], '{"limit":450,"name":"s"}')
    got = {r.doc: (r.total_parents, r.total_children, r.children_per_parent) for r in analytics.document_counts(docs, parents, children, "doc").collect()}
    assert got == {"a": (2, 3, 1.5), "b": (1, 0, 0.0), "c": (0, 0, 0.0)}
    assert sorted((r.doc, r.title) for r in analytics.with_header(parents, "HEAD").collect()) == [("a", "One Head"), ("b", "head")]
    assert sorted((r.doc, r.section_no) for r in analytics.first_parents(parents, "doc", 1).collect()) == [("a", 0), ("b", 0)]
    logs = spark.createDataFrame([("p", " w1\nw2\n\nw1 \n"), ("q", None), ("q", "")], "doc string, log string")
    assert sorted(map(tuple, analytics.warning_histogram(logs, "doc", "log").collect())) == [("p", "w1", 2), ("p", "w2", 1)]


def test_exports(spark, tmp_path):
    docs = spark.createDataFrame([(1, "# A\nfirst text\n## B\nsecond"), (2, "# C")], "doc long, md string")
    p = parent_chunks(explode_sections(docs), "doc")
    c = child_chunks(p)
    files.write_export(p, c, str(tmp_path / "x"), "doc")
    read = lambda name: {r.metadata.header: r for r in spark.read.json(str(tmp_path / "x" / name)).collect()}
    parents, children = read("parent_chunks"), read("child_chunks")
    assert {k: (r.metadata.document_id, r.metadata.header_level, r.metadata.child_count, r.metadata.section_path) for k, r in parents.items()} == {"A": (1, 1, 1, "A"), "B": (1, 2, 1, "A > B"), "C": (2, 1, 0, "C")}
    assert all(parents[k].metadata.child_chunk_ids == [r.chunk_id] and r.metadata.parent_chunk_id == parents[k].chunk_id and r.metadata.block_types == ["paragraph"] for k, r in children.items())
    stats = {r.document_name: tuple(r.statistics[k] for k in ("total_parent_chunks", "total_child_chunks", "avg_children_per_parent")) for r in spark.read.json(str(tmp_path / "x" / "document_metadata")).collect()}
    assert stats == {1: (2, 2, 1.0), 2: (1, 0, 0.0)}
    stem = F.concat(F.lit("s"), F.col("doc").cast("string"))
    files.write_chunks(p.withColumn("stem", stem), c.withColumn("stem", stem), str(tmp_path / "y"), "stem")
    assert sorted(d.name for d in (tmp_path / "y" / "parent_chunks").iterdir() if d.is_dir()) == ["stem=s1", "stem=s2"]
    for k in range(2):
        files.append_records(spark.createDataFrame([(k,)], "k int"), str(tmp_path / "z"))
    assert sorted(r.k for r in spark.read.json(str(tmp_path / "z")).collect()) == [0, 1]
    (tmp_path / "i").mkdir()
    (tmp_path / "i" / "a.PNG").write_bytes(b"x")
    (tmp_path / "i" / "b.txt").write_bytes(b"x")
    assert [r.path.rsplit("/", 1)[1] for r in files.scan_images(spark, str(tmp_path / "i")).collect()] == ["a.PNG"]
