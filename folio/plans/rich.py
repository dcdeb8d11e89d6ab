"""Queries on documents, pages and orders that are given what the tables lack: Markdown with every kind of block, HTML with tables and pictures, and the evidence of PDF, Word and PowerPoint files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folio.operators import analytics, chunking, evidence, routing
from folio.operators.sections import explode_sections, parent_chunks
from folio.plans.registry import HTML_SQL, query, table
from folio.sources import html

# Markdown with paragraphs, lists, tables, quotes and code: several children a section, and all kinds of packing

CHUNKING = chunking.ChunkingConfig(child_token_limit=150, child_overlap_tokens=0, min_chunk_tokens=40)

#: The blocks of each document's only section: place, kind, text, first and last line after the header.
BLOCK_SQL = r"""t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\t\n\r ]+', ' ', 'g') AS t FROM documents),
m AS (SELECT doc_id, rtrim('Para ' || rtrim(substr(t, 1, 100 + doc_id % 7 * 70))) AS p1, rtrim('Next ' || rtrim(substr(t, 600, 60 + doc_id % 5 * 60))) AS p2, rtrim('Last ' || rtrim(substr(t, 900, doc_id % 11 * 40))) AS p3, CAST(doc_id AS VARCHAR) AS id FROM t),
b AS (SELECT doc_id, unnest([{'k': 1, 'kind': 'paragraph', 'txt': p1, 'a': 1, 'z': 1}, {'k': 2, 'kind': 'list', 'txt': '- item ' || id || chr(10) || '* other' || chr(10) || '  deep', 'a': 3, 'z': 5}, {'k': 3, 'kind': 'table', 'txt': '| head | ' || id || ' |' || chr(10) || '|---|---|' || chr(10) || repeat('| x | y |' || chr(10), CAST(doc_id % 3 AS INT)) || '| end | |', 'a': 7, 'z': 9 + doc_id % 3},
  {'k': 4, 'kind': 'blockquote', 'txt': '> said ' || id || chr(10) || '> and more', 'a': 11 + doc_id % 3, 'z': 12 + doc_id % 3}, {'k': 5, 'kind': 'code', 'txt': '```' || chr(10) || repeat('x = ' || id || chr(10), CAST(doc_id % 13 AS INT)) || '```', 'a': 14 + doc_id % 3, 'z': 15 + doc_id % 3 + doc_id % 13},
  {'k': 6, 'kind': 'paragraph', 'txt': p2, 'a': 17 + doc_id % 3 + doc_id % 13, 'z': 17 + doc_id % 3 + doc_id % 13}, {'k': 7, 'kind': 'paragraph', 'txt': p3, 'a': 19 + doc_id % 3 + doc_id % 13, 'z': 19 + doc_id % 3 + doc_id % 13}], recursive := true) FROM m),
n AS (SELECT *, greatest(1, length(txt) // 4) AS tokens FROM b)"""

CHILD_SQL = f"""{BLOCK_SQL},
r AS (SELECT doc_id, k, 0 AS chunk, tokens AS n FROM n WHERE k = 1
  UNION ALL SELECT n.doc_id, n.k, CASE WHEN r.n + 2 + n.tokens <= 150 THEN chunk ELSE chunk + 1 END, CASE WHEN r.n + 2 + n.tokens <= 150 THEN r.n + 2 + n.tokens ELSE n.tokens END FROM r JOIN n ON n.doc_id = r.doc_id AND n.k = r.k + 1),
g AS (SELECT r.doc_id, chunk, string_agg(txt, chr(10) || chr(10) ORDER BY r.k) AS txt, list_sort(list_distinct(list(kind))) AS kinds, min(a) AS a, max(z) AS z, max(r.n) AS tokens, max(chunk) OVER (PARTITION BY r.doc_id) AS last FROM r JOIN n ON n.doc_id = r.doc_id AND n.k = r.k GROUP BY r.doc_id, chunk),
h AS (SELECT *, lead(tokens) OVER w AS after, lead(z) OVER w AS after_z, lead(kinds) OVER w AS after_kinds FROM g WINDOW w AS (PARTITION BY doc_id ORDER BY chunk)),
c AS (SELECT doc_id, chunk, txt, tokens < 40 AND chunk = last AND chunk > 0 AS gone, chunk = last - 1 AND after < 40 AS takes, kinds, after_kinds, a, z, after_z, tokens, after FROM h),
d AS (SELECT doc_id, chunk, txt, CASE WHEN takes THEN list_sort(list_distinct(list_concat(kinds, after_kinds))) ELSE kinds END AS kinds, 1 + a AS start_line, 1 + CASE WHEN takes THEN after_z ELSE z END AS end_line, CASE WHEN takes THEN tokens + after ELSE tokens END AS tokens FROM c WHERE NOT gone)"""


def rich_markdown(spark, sf_dir) -> DataFrame:
    k = F.col("doc_id")
    text = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\t\n\r ]+", " ")
    cut = lambda word, start, n: F.rtrim(F.concat(F.lit(word), F.rtrim(F.substring(text, F.lit(start), n))))
    parts = [
        F.concat(F.lit("# Doc "), k.cast("string")), F.lit(""), cut("Para ", 1, (100 + k % 7 * 70).cast("int")), F.lit(""), F.concat(F.lit("- item "), k.cast("string"), F.lit("\n* other\n  deep")), F.lit(""),
        F.concat(F.lit("| head | "), k.cast("string"), F.lit(" |\n|---|---|\n"), F.repeat(F.lit("| x | y |\n"), (k % 3).cast("int")), F.lit("| end | |")), F.lit(""), F.concat(F.lit("> said "), k.cast("string"), F.lit("\n> and more")), F.lit(""),
        F.concat(F.lit("```\n"), F.repeat(F.concat(F.lit("x = "), k.cast("string"), F.lit("\n")), (k % 13).cast("int")), F.lit("```")), F.lit(""), cut("Next ", 600, (60 + k % 5 * 60).cast("int")), F.lit(""), cut("Last ", 900, (k % 11 * 40).cast("int")),
    ]
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(F.array(*parts), "\n").alias("md"))


def rich_parents(spark, sf_dir) -> DataFrame:
    return parent_chunks(explode_sections(rich_markdown(spark, sf_dir)), "doc_id")


@query(f"""WITH {BLOCK_SQL} SELECT doc_id, k - 1 AS block_no, kind, md5(txt) AS digest, 1 + a AS start_line, 1 + z AS end_line, tokens FROM n""")
def rich_blocks(spark, sf_dir):
    found = rich_parents(spark, sf_dir).select("doc_id", F.posexplode(chunking.blocks(F.col("content"), F.col("start_line"))).alias("block_no", "b"))
    return found.select("doc_id", F.col("block_no").cast("long").alias("block_no"), "b.kind", F.md5("b.text").alias("digest"), F.col("b.start_line").cast("long").alias("start_line"), F.col("b.end_line").cast("long").alias("end_line"), "b.tokens")


@query(f"""WITH RECURSIVE {CHILD_SQL}
SELECT doc_id, 'Doc ' || doc_id AS section_path, CAST(chunk AS BIGINT) AS chunk_index, array_to_string(kinds, ',') AS block_types, CAST(start_line AS BIGINT) AS start_line, CAST(end_line AS BIGINT) AS end_line, tokens AS token_count, md5(txt) AS digest FROM d""")
def rich_child_chunks(spark, sf_dir):
    rows = chunking.child_chunks(rich_parents(spark, sf_dir), CHUNKING)
    return rows.select("doc_id", "section_path", "chunk_index", F.array_join("block_types", ",").alias("block_types"), F.col("start_line").cast("long").alias("start_line"), F.col("end_line").cast("long").alias("end_line"), "token_count", F.md5("page_content").alias("digest"))


@query(f"""WITH RECURSIVE {CHILD_SQL}, x AS (SELECT doc_id, count(*) AS n, sum(tokens) AS tokens FROM d GROUP BY doc_id) SELECT doc_id, CAST(1 AS BIGINT) AS total_parents, n AS total_children, CAST(n AS DOUBLE) AS children_per_parent FROM x""")
def rich_document_counts(spark, sf_dir):
    docs, parents = rich_markdown(spark, sf_dir), rich_parents(spark, sf_dir)
    return analytics.document_counts(docs, parents, chunking.child_chunks(parents, CHUNKING), "doc_id")


@query(f"""WITH RECURSIVE {CHILD_SQL}, e AS (SELECT doc_id, chunk, tokens, doc_id % 4 <> 0 AS known, (doc_id + chunk) % 6 <> 0 AS placed, CASE WHEN (doc_id + chunk) % 10 = 0 THEN 0 ELSE tokens END AS size FROM d),
s AS (SELECT count(*) AS children, count(*) FILTER (WHERE known) AS valid_parents, count(*) FILTER (WHERE placed) AS valid_paths, count(*) FILTER (WHERE size > 0) AS valid_tokens, count(*) FILTER (WHERE NOT known) AS orphans FROM e), u AS (SELECT *, round(100.0 * (valid_parents + valid_paths + valid_tokens) / (3 * children), 4) AS score FROM s)
SELECT children, valid_parents, valid_paths, valid_tokens, orphans, score, CASE WHEN score >= 95 THEN 'excellent' WHEN score >= 85 THEN 'good' WHEN score >= 70 THEN 'fair' ELSE 'poor' END AS grade FROM u""")
def damaged_integrity(spark, sf_dir):
    """Children some of whose parents, paths or sizes have been lost."""
    parents = rich_parents(spark, sf_dir)
    n = F.col("doc_id") + F.col("chunk_index")
    children = chunking.child_chunks(parents, CHUNKING).withColumn("section_path", F.when(n % 6 != 0, F.col("section_path")).otherwise("")).withColumn("token_count", F.when(n % 10 == 0, 0).otherwise(F.col("token_count")))
    return analytics.integrity(parents.filter("doc_id % 4 <> 0"), children)


# HTML with tables, nested tables, images, drawings and captions


RICH_HTML_SQL = f"""{HTML_SQL}, x AS (SELECT page_id, total_characters + 6 * (page_id % 3) + CASE WHEN page_id % 5 = 0 THEN 2 ELSE 0 END + CASE WHEN page_id % 7 = 0 THEN 15 ELSE 0 END AS chars, page_id % 3 AS merged, CASE WHEN page_id % 5 = 0 THEN 2 ELSE 0 END AS nested, page_id % 4 AS images, page_id % 2 AS svgs, CASE WHEN page_id % 7 = 0 THEN 1 ELSE 0 END AS figures FROM k),
y AS (SELECT *, CAST(greatest(1, ceil(chars / 2000)) AS BIGINT) AS pages FROM x)"""


def rich_html(spark, sf_dir) -> DataFrame:
    k = F.col("page_id")
    times = lambda text, n: F.repeat(F.lit(text), n.cast("int"))
    extra = [
        times('<table><tr><td colspan="2">a</td><td>b</td></tr><tr><td>c</td></tr></table>', k % 3), times("<table><tr><td><table><tr><td>x</td></tr></table></td></tr></table>", (k % 5 == 0).cast("int")),
        times('<img src="i.png" alt=" An  image ">', k % 4), times("<svg></svg>", k % 2), times("<figure><figcaption>Figure 1 shows</figcaption></figure>", (k % 7 == 0).cast("int")),
    ]
    return table(spark, sf_dir, "pages").select("page_id", F.concat("html", *extra).alias("html"))


@query(f"""WITH {RICH_HTML_SQL} SELECT page_id, chars AS total_characters, pages, merged + nested AS tables, CASE WHEN merged > 0 THEN 3 WHEN nested > 0 THEN 1 ELSE 0 END AS max_columns, merged > 0 AS has_merged, nested > 0 AS has_nested, images, svgs, least(merged + nested, pages) AS pages_with_tables,
  least(images + svgs + figures, pages) AS pages_with_visuals, 2 * figures AS captioned, repeat('embedded_image,', CAST(images AS INT)) || repeat('table,', CAST(merged + nested AS INT)) || repeat('svg,', CAST(svgs AS INT)) || repeat('figure_element,', CAST(figures AS INT)) AS candidates FROM y""")
def rich_html_profile(spark, sf_dir):
    p = html.html_profile(rich_html(spark, sf_dir))
    of = lambda c: F.col(c).cast("long")
    return p.select(
        "page_id", "text.total_characters", of("page_or_unit_count").alias("pages"), of("tables.count").alias("tables"), of("tables.max_column_count").alias("max_columns"), F.col("tables.has_merged_cells").alias("has_merged"), F.col("tables.has_nested_tables").alias("has_nested"), of("visuals.embedded_image_count").alias("images"), of("visuals.svg_count").alias("svgs"),
        of("tables.pages_or_units_with_tables").alias("pages_with_tables"), of("visuals.pages_or_units_with_visuals").alias("pages_with_visuals"), of("visuals.captioned_visual_count").alias("captioned"), F.array_join(F.transform("visual_candidates", lambda c: F.concat(c["kind"], F.lit(","))), "").alias("candidates"),
    )


# Orders as PDF documents: lines are blocks, tables and pictures of a page


PDF_SQL = """l AS (SELECT o_custkey, o_orderkey, l_linenumber, l_partkey, l_suppkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
p AS (SELECT o_custkey, o_orderkey, list(CAST(l_partkey % 600 AS DOUBLE)) AS x, count(*) FILTER (WHERE l_partkey % 5 = 0) AS tables, count(*) FILTER (WHERE l_partkey % 5 = 0 AND l_suppkey % 20 >= 8) AS large_tables, max(CASE WHEN l_partkey % 5 = 0 THEN l_suppkey % 9 END) AS columns,
  count(*) FILTER (WHERE l_partkey % 4 = 0) AS images, count(*) FILTER (WHERE l_partkey % 4 = 0 AND l_suppkey % 12 >= 8) AS large_images, o_orderkey % 30 AS drawings, CASE o_orderkey % 3 WHEN 0 THEN 'Figure 1 of order ' || o_orderkey WHEN 1 THEN 'order ' || o_orderkey ELSE '  ' END AS txt FROM l GROUP BY o_custkey, o_orderkey),
q AS (SELECT *, CASE WHEN len(x) >= 8 THEN len(list_filter(x, lambda v: v > 300)) > 0 AND len(list_filter(x, lambda v: v > 300)) < len(x) AND len(list_filter(x, lambda v: v > 300)) / len(x) >= 0.3 END AS two FROM p)"""


def order_pdf(spark, sf_dir) -> DataFrame:
    """One page an order: a table of l_suppkey % 20 hundredths of the page for every fifth part, a picture of l_suppkey % 12 hundredths for every fourth."""
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey"))
    p, s, k = F.col("l_partkey"), F.col("l_suppkey"), F.col("o_orderkey")
    box = lambda share, **more: F.struct(F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), (share * 10.0).cast("double").alias("x1"), F.lit(100.0).alias("y1"), *[v.alias(n) for n, v in more.items()])
    found = rows.groupBy("o_custkey", "o_orderkey").agg(
        F.collect_list((p % 600).cast("double")).alias("block_left_edges"), F.collect_list(F.when(p % 5 == 0, box(s % 20, col_count=(s % 9).cast("int")))).alias("table_boxes"),
        F.collect_list(F.when(p % 4 == 0, box(s % 12, xref=F.lit(1)))).alias("image_boxes"), F.count_if(p % 4 == 0).cast("int").alias("image_ref_count"),
    )
    text = F.when(k % 3 == 0, F.concat(F.lit("Figure 1 of order "), k.cast("string"))).when(k % 3 == 1, F.concat(F.lit("order "), k.cast("string"))).otherwise("  ")
    page = F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderkey"))
    return found.select(F.col("o_custkey").cast("string").alias("job_id"), page.alias("page_number"), F.lit(600.0).alias("page_width"), (F.lit(100000.0) / 600).alias("page_height"), text.alias("text"), "block_left_edges", "table_boxes", "image_boxes", "image_ref_count", (k % 30).cast("int").alias("drawing_count"))


@query(f"""WITH {PDF_SQL}, s AS (SELECT o_custkey, count(*) AS pages, sum(length(txt)) AS chars, count(*) FILTER (WHERE trim(txt) <> '') AS pages_with_text, sum(tables) AS tables, count(*) FILTER (WHERE tables > 0) AS pages_with_tables, sum(large_tables) AS large_tables, max(coalesce(columns, 0)) AS max_columns, sum(images) AS images, sum(large_images) AS large_images, sum(drawings) AS drawings,
  count(*) FILTER (WHERE images > 0 OR drawings > 0) AS pages_with_visuals, count(*) FILTER (WHERE starts_with(txt, 'Figure')) AS captioned, CASE WHEN count(two) > 0 AND count(*) FILTER (WHERE two) >= 0.3 * count(two) THEN 2 ELSE 1 END AS columns FROM q GROUP BY o_custkey)
SELECT CAST(o_custkey AS VARCHAR) AS job_id, pages, CAST(chars AS BIGINT) AS chars, pages_with_text, CAST(tables AS BIGINT) AS tables, pages_with_tables, CAST(large_tables AS BIGINT) AS large_tables, CAST(max_columns AS BIGINT) AS max_columns, CAST(images AS BIGINT) AS images, CAST(large_images AS BIGINT) AS large_images, CAST(drawings AS BIGINT) AS drawings, pages_with_visuals, captioned, CAST(columns AS BIGINT) AS columns,
  CASE WHEN columns = 2 OR max_columns > 6 THEN 'mineru' ELSE 'docling' END AS engine, CASE WHEN columns = 2 THEN 'reading_order' WHEN max_columns > 6 THEN 'complex_tables' ELSE 'default' END AS reason FROM s""")
def pdf_profiles(spark, sf_dir):
    rows = routing.routed(routing.requirements(evidence.pdf_profile(order_pdf(spark, sf_dir))))
    of = lambda c: F.col(c).cast("long")
    return rows.select(
        "job_id", of("page_or_unit_count").alias("pages"), of("text.total_characters").alias("chars"), of("text.pages_or_units_with_text").alias("pages_with_text"), of("tables.count").alias("tables"), of("tables.pages_or_units_with_tables").alias("pages_with_tables"), of("tables.large_count").alias("large_tables"),
        of("tables.max_column_count").alias("max_columns"), of("visuals.embedded_image_count").alias("images"), of("visuals.large_embedded_image_count").alias("large_images"), of("visuals.vector_graphics_count").alias("drawings"), of("visuals.pages_or_units_with_visuals").alias("pages_with_visuals"),
        of("visuals.captioned_visual_count").alias("captioned"), of("layout.column_count").alias("columns"), "engine", "reason",
    )


# Conversations as Word files and as slides, in the shape that sources/office.py gives


@query("""WITH c AS (SELECT conv_id, list(trim(regexp_replace(text, '[\\t\\n\\r ]+', ' ', 'g')) ORDER BY turn, role, text) AS p, count(*) AS n FROM conversations GROUP BY conv_id),
d AS (SELECT conv_id, n, length(array_to_string(list_concat(p, ['Figure 2: cell']), chr(10))) AS chars FROM c), e AS (SELECT *, CAST(greatest(1, ceil(chars / 2000)) AS BIGINT) AS pages FROM d)
SELECT CAST(conv_id AS VARCHAR) AS job_id, pages, CAST(chars AS BIGINT) AS chars, conv_id % 3 AS tables, least(conv_id % 3, pages) AS pages_with_tables, CASE WHEN conv_id % 3 > 0 THEN conv_id % 3 + 1 ELSE 0 END AS max_columns, conv_id % 3 = 2 AS has_merged, greatest(conv_id % 4, conv_id % 5) AS images, 1 + conv_id % 2 AS columns, conv_id % 7 = 0 AS text_boxes,
  CASE WHEN conv_id % 2 = 1 OR conv_id % 7 = 0 THEN 'reading_order' WHEN conv_id % 3 = 2 THEN 'complex_tables' ELSE 'default' END AS reason FROM e""")
def docx_profiles(spark, sf_dir):
    k = F.col("conv_id")
    text = F.trim(F.regexp_replace("text", r"[\t\n\r ]+", " "))
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("t"), text.alias("p")))), lambda x: x["p"]).alias("paragraphs"))
    tables = F.transform(F.slice(F.array(F.lit(1), F.lit(2)), F.lit(1), (k % 3).cast("int")), lambda i: F.struct((i + 1).alias("columns"), (i == 2).alias("merged"), F.lit(False).alias("nested")))
    files = rows.select(
        k.cast("string").alias("job_id"), F.lit(None).cast("string").alias("error"), "paragraphs", F.array(F.lit("Figure 2: cell")).alias("cell_paragraphs"), tables.alias("tables"), F.array(F.lit(1), (1 + k % 2).cast("int")).alias("section_columns"), (k % 7 == 0).alias("text_boxes"), (k % 4).cast("int").alias("inline_images"), (k % 5).cast("int").alias("archive_images")
    )
    p = routing.routed(routing.requirements(evidence.docx_profile(files)))
    of = lambda c: F.col(c).cast("long")
    return p.select(
        "job_id", of("page_or_unit_count").alias("pages"), of("text.total_characters").alias("chars"), of("tables.count").alias("tables"), of("tables.pages_or_units_with_tables").alias("pages_with_tables"), of("tables.max_column_count").alias("max_columns"), F.col("tables.has_merged_cells").alias("has_merged"),
        of("visuals.embedded_image_count").alias("images"), of("layout.column_count").alias("columns"), F.col("layout.has_floating_text_boxes").alias("text_boxes"), "reason",
    )


@query("""WITH s AS (SELECT conv_id, turn, length(text) AS chars, trim(text) <> '' AS said, turn % 2 AS tables, turn % 3 AS charts, turn % 4 AS images, CASE WHEN turn % 5 = 0 THEN 2 ELSE 0 END AS drawings FROM (SELECT conv_id, turn, min(coalesce(text, '')) AS text FROM conversations GROUP BY conv_id, turn))
SELECT CAST(conv_id AS VARCHAR) AS job_id, count(*) AS slides, CAST(sum(chars) AS BIGINT) AS chars, CAST(count(*) FILTER (WHERE said) AS BIGINT) AS slides_with_text, CAST(sum(tables) AS BIGINT) AS tables, CAST(sum(charts) AS BIGINT) AS charts, CAST(sum(images) AS BIGINT) AS images, CAST(sum(images) AS BIGINT) AS large_images, CAST(sum(drawings) AS BIGINT) AS drawings,
  count(*) FILTER (WHERE charts + images + drawings > 0) AS slides_with_visuals, CAST(max(CASE WHEN tables > 0 THEN 4 ELSE 0 END) AS BIGINT) AS max_columns, bool_or(tables > 0 AND turn % 3 = 0) AS has_merged FROM s GROUP BY conv_id""")
def pptx_profiles(spark, sf_dir):
    t = F.col("turn")
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id", "turn").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    shape = lambda kind, text=None, columns=0, merged=None, width=0.0: F.struct(F.lit(kind).alias("kind"), (text if text is not None else F.lit(None).cast("string")).alias("text"), F.lit(columns).alias("columns"), (merged if merged is not None else F.lit(False)).alias("merged"), F.lit(width).alias("width"), F.lit(width).alias("height"))
    many = lambda one, n: F.array_repeat(one, n.cast("int"))
    shapes = F.concat(F.array(shape("text", F.col("text"))), many(shape("table", columns=4, merged=t % 3 == 0), t % 2), many(shape("chart"), t % 3), many(shape("image", width=40.0), t % 4), many(shape("drawing"), F.when(t % 5 == 0, 2).otherwise(0)))
    count = F.count("*").over(W.partitionBy("conv_id")).cast("int")
    slides = turns.select(F.col("conv_id").cast("string").alias("job_id"), F.lit(None).cast("string").alias("error"), count.alias("slide_count"), F.lit(10000.0).alias("slide_area"), t.cast("int").alias("slide_number"), shapes.alias("shapes"))
    p = evidence.pptx_profile(slides)
    of = lambda c: F.col(c).cast("long")
    return p.select(
        "job_id", of("page_or_unit_count").alias("slides"), of("text.total_characters").alias("chars"), of("text.pages_or_units_with_text").alias("slides_with_text"), of("tables.count").alias("tables"), of("visuals.chart_count").alias("charts"), of("visuals.embedded_image_count").alias("images"), of("visuals.large_embedded_image_count").alias("large_images"),
        of("visuals.vector_graphics_count").alias("drawings"), of("visuals.pages_or_units_with_visuals").alias("slides_with_visuals"), of("tables.max_column_count").alias("max_columns"), F.col("tables.has_merged_cells").alias("has_merged"),
    )
