from pyspark.sql import functions as F

from folio.functions import text as T
from folio.operators import analytics, figures, pages, routing, windows


def value(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


def test_tables_and_footer(spark):
    md = "p\n\n|a|b|\n|-|-|\n|1|2|"
    r = pages.with_table_tokens(spark.createDataFrame([("j", 1, md), ("k", 1, md + "\n\nend"), ("m", 2, md + "\n\nx\n|c|\n|--|\n|d| tail"), ("n", 1, "no\n|x|")], "job_id string, page_number int, markdown string"))
    got = {x.job_id: x for x in r.collect()}
    assert got["j"].markdown_with_tokens == "p\n\n${TBL:j:001:0}" and got["j"].tables[0].is_fragment and got["j"].tables[0].start_page == 1
    assert not got["k"].tables[0].is_fragment and got["n"].tables == []
    assert [t.is_fragment for t in got["m"].tables] == [False, True] and got["m"].markdown_with_tokens == "p\n\n${TBL:m:002:0}\n\nx\n${TBL:m:002:1}"
    doc = {x.job_id: x.markdown for x in pages.assembled(r).collect()}
    assert doc["j"] == "p\n\n---\n\n## Unclosed Table Fragments\n\n### Table started on page 1\n\n<table>\n\n<placeholder>\n<!-- table starting on page 1 had no closing fragment -->\n"
    assert doc["k"] == "p\n\n|a|b|\n|-|-|\n|1|2|\n\nend\n"


def test_substitution(spark):
    sub = lambda text, *r: value(spark, pages.substitute(F.lit(text), F.array(*[F.struct(F.lit(a).alias("token"), F.lit(b).alias("text")) for a, b in r])))
    assert sub("x\n\nT\n\ny", ("T", "")) == "x\n\ny"
    assert sub("x\n\nT", ("T", "")) == "x"
    assert sub("T T", ("T", "a$1\\U"), ("U", "v")) == "a$1\\v a$1\\v"
    assert value(spark, pages.with_figure_tokens(F.lit("a<!-- figure -->b<!-- figure -->c"), F.array(F.lit("f")), F.lit("j"), F.lit(1))) == "a${FIG:j:001:0}bc"


def test_windows(spark):
    def plan(total, size, last):
        jobs = spark.createDataFrame([(1, total, last)], "job_id int, total_pages int, last_completed_page int")
        return [(r.window_index, r.start_page, r.end_page) for r in windows.page_windows(jobs, size).orderBy("window_index").collect()]

    assert plan(20, 8, 0) == [(0, 1, 8), (1, 9, 16), (2, 17, 20)]
    assert plan(20, 8, 8) == [(1, 9, 16), (2, 17, 20)]
    assert plan(20, 5, 8) == [(2, 11, 15), (3, 16, 20)]
    assert plan(0, 5, 0) == []


def test_figures(spark):
    rows = spark.createDataFrame([("j", 1, k, f"t{k}", s) for k, s in enumerate(["x", "y", "x", "x"])], "job_id string, page_number int, index_on_page int, token string, sha256 string")
    r = figures.counters(figures.enriched(rows)).first()
    assert (r.figures_summarized, r.figures_deduplicated, r.figures_failed) == (2, 2, 0)
    s = spark.createDataFrame([("t0", True, "m"), ("t1", False, "m")], "token string, is_informative boolean, markdown_result string")
    assert {x.token: x.replacement for x in figures.resolved(rows, s).collect()} == {"t0": "m", "t1": "", "t2": T.PLACEHOLDER, "t3": T.PLACEHOLDER}
    allowed = spark.createDataFrame([("decorative", "decorative_note"), ("other", "plain_text_explanation")], "figure_type string, rendering_strategy string")
    bad = spark.createDataFrame([("other", "plain_text_explanation", True, "x", 0.5, "educational"), ("decorative", "plain_text_explanation", True, " ", 1.5, "auto"), ("other", "plain_text_explanation", True, "x", None, None)], "figure_type string, rendering_strategy string, is_informative boolean, markdown_result string, confidence double, document_domain string")
    errors = sorted(r.errors for r in figures.violations(bad, allowed).collect())
    assert errors == [[], ["confidence_out_of_range", "domain_not_resolved"], ["strategy_not_allowed", "decorative_but_informative", "decorative_needs_note", "empty_markdown", "confidence_out_of_range", "domain_not_resolved"]]


def test_routing(spark):
    def route(kind, text=True, columns=1, merged=False, forced=None):
        row = spark.range(1).select(F.lit(kind).alias("file_type"), F.struct(F.lit(text).alias("native_text_available")).alias("text"), F.struct(F.lit(1).alias("count"), F.lit(merged).alias("has_merged_cells"), F.lit(False).alias("has_nested_tables"), F.lit(2).alias("max_column_count")).alias("tables"), F.struct(F.lit(columns).alias("column_count"), F.lit(False).alias("has_floating_text_boxes")).alias("layout"), F.struct(*[F.lit(0).alias(c) for c in ("embedded_image_count", "vector_graphics_count", "chart_count", "svg_count", "large_embedded_image_count")]).alias("visuals"), F.array().cast("array<struct<kind:string,area_ratio:double,caption_or_alt_text:string,nearby_text:string>>").alias("visual_candidates"))
        r = routing.routed(routing.requirements(row), forced).first()
        return r.engine, r.confidence

    assert route("html") == ("docling", 0.98)
    assert route("pdf", columns=2) == route("docx", merged=True) == route("pdf", text=False) == ("mineru", 0.90)
    assert route("pdf") == ("docling", 0.85) and route("pdf", forced="mineru") == ("mineru", 1.0)
    assert route("html", forced="mineru") == (None, None)  # the row has an error instead, see test_errors.py
    ladder = spark.createDataFrame([(0, "vlm-auto-engine", 8192, False), (1, "vlm-http-client", 2048, True), (2, "pipeline", 0, False)], "rank int, backend string, min_vram_mb int, requires_server_url boolean")
    assert [r.backend for r in routing.reachable_rungs(ladder, 24000, 5500, False).collect()] == ["pipeline"]
    assert [value(spark, routing.model_family(F.lit(b))) for b in ("vlm-http-client", "vlm-auto-engine", "hybrid-x")] == [None, "vlm", "pipeline"]


def test_integrity_without_children(spark):
    p = spark.createDataFrame([("a",)], "chunk_id string")
    c = spark.createDataFrame([], "parent_chunk_id string, section_path string, token_count long")
    r = analytics.integrity(p, c).first()
    assert r.children == 0 and r.score is None and r.grade is None


def test_caption_lines_of_all_languages(spark, tmp_path):
    from folio.plans import registry

    rows = [(1, "en", "Figure 1: a\nno\nsee chart 2"), (2, "de", "Flowchart 3\nAbbildung"), (3, "fr", "configurer\nFig. 4"), (4, None, "diagram"), (5, "es", ""), (6, "es", None)]
    spark.createDataFrame(rows, "doc_id long, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.caption_lines for r in registry.queries()["doc_caption_lines"](spark, str(tmp_path)).collect()}
    assert {k: got[k] for k in range(1, 6)} == {1: 2, 2: 1, 3: 1, 4: 1, 5: 0} and set(got) == set(range(1, 7))
