"""All queries of the library, by name, with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folio.functions import text as T
from folio.operators import analytics, chunking, figures, pages, routing, windows
from folio.operators.sections import explode_sections, parent_chunks
from folio.sources import html

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of a table that a task sorts, or checks. Spark packs tasks by compressed bytes, of which numbers that ascend or recur have few, so that a task's memory and time would grow with the table.
TASK_ROWS = 250_000


def dealt(rows: DataFrame, key: str) -> DataFrame:
    """rows of a file over all cores, a task for each TASK_ROWS at least: what a row costs is not seen in its bytes, by which Spark makes tasks. A filter on what is made of the rows stays behind the generator, so that it runs on all cores too."""
    spread = rows.repartition(max(4 * rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // TASK_ROWS)), key)
    return spread.select(F.inline(F.array(F.struct(*rows.columns))))


def tasks_for(rows: DataFrame) -> int:
    """How many tasks rows of a table are dealt to, so that more rows are more tasks and not larger ones. With fewer than its own number Spark would deal the rows again for a join, and pack those tasks."""
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // TASK_ROWS))


# Documents: text functions


@query("SELECT doc_id, greatest(1, length(text) // 4) AS token_count FROM documents")
def doc_token_counts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.token_count(F.col("text")).alias("token_count"))


SENTENCES_SQL = r"string_split(regexp_replace(text, '([.!?])\s+([A-Z0-9>])', '\1' || chr(1) || '\2', 'g'), chr(1))"


@query(f"SELECT doc_id, CAST(len({SENTENCES_SQL}) AS BIGINT) AS sentences, md5(array_to_string({SENTENCES_SQL}, chr(1))) AS digest FROM documents")
def doc_sentence_split(spark, sf_dir):
    parts = T.sentences(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.size(parts).cast("long").alias("sentences"), F.md5(F.array_join(parts, "\x01")).alias("digest"))


@query(f"""
WITH RECURSIVE s AS (SELECT doc_id, {SENTENCES_SQL} AS p FROM documents),
r AS (
  SELECT doc_id, p, 1 AS i, 1 AS piece, greatest(1, length(p[1]) // 4) AS n FROM s
  UNION ALL
  SELECT doc_id, p, i + 1, CASE WHEN n + greatest(1, length(p[i + 1]) // 4) <= 120 THEN piece ELSE piece + 1 END,
         CASE WHEN n + greatest(1, length(p[i + 1]) // 4) <= 120 THEN n + greatest(1, length(p[i + 1]) // 4) ELSE greatest(1, length(p[i + 1]) // 4) END
  FROM r WHERE i < len(p)
)
SELECT doc_id, CAST(max(piece) AS BIGINT) AS pieces FROM r GROUP BY doc_id""")
def doc_sentence_chunks(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.size(chunking.sentence_pieces(F.col("text"), 120)).cast("long").alias("pieces"))


@query(f"""
WITH RECURSIVE s AS (SELECT doc_id, {SENTENCES_SQL} AS p FROM documents),
r AS (
  SELECT doc_id, p, 1 AS i, 0 AS piece, greatest(1, length(p[1]) // 4) AS n, p[1] AS buf FROM s
  UNION ALL
  SELECT doc_id, p, i + 1, CASE WHEN n + greatest(1, length(p[i + 1]) // 4) <= 120 THEN piece ELSE piece + 1 END,
         CASE WHEN n + greatest(1, length(p[i + 1]) // 4) <= 120 THEN n + greatest(1, length(p[i + 1]) // 4) ELSE greatest(1, length(p[i + 1]) // 4) END,
         CASE WHEN n + greatest(1, length(p[i + 1]) // 4) <= 120 THEN buf || ' ' || p[i + 1] ELSE p[i + 1] END
  FROM r WHERE i < len(p)
)
SELECT doc_id, CAST(piece AS INT) AS piece, regexp_replace(arg_max(buf, i), '^\\s+|\\s+$', '', 'g') AS content FROM r GROUP BY doc_id, piece""")
def doc_sentence_pieces(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(chunking.sentence_pieces(F.col("text"), 120)).alias("piece", "content"))


@query("""
SELECT doc_id, CAST(i AS BIGINT) AS line_no, l[i] AS line FROM (
  SELECT doc_id, string_split(regexp_replace(text, chr(10) || '$', ''), chr(10)) AS l FROM documents WHERE text <> ''
), LATERAL (SELECT unnest(range(1, len(l) + 1)) AS i)""")
def doc_lines(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(T.lines(F.col("text"))).alias("p", "line")).select("doc_id", (F.col("p") + 1).cast("long").alias("line_no"), "line")


@query(r"""
SELECT doc_id, CAST(len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '(?i)\b(fig(?:ure)?|chart|diagram|flowchart)\s*[\.:]?\s*\d*'))) AS BIGINT) AS caption_lines
FROM documents""")
def doc_caption_lines_en(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.caption_lines(F.col("text")).alias("caption_lines"))


#: The texts name no figures: a frequent syllable stands for one, so that words begin with it, hold it and follow letters of all languages.
CAPTIONED_SQL = "replace(replace(text, '. ', '.' || chr(10)), 'er', 'fig')"


@query(rf"""SELECT doc_id, CAST(len(list_filter(string_split({CAPTIONED_SQL}, chr(10)), lambda x: regexp_matches(x, '(?i)(^|[^\p{{L}}\p{{Nd}}_])(fig(ure)?|chart|diagram|flowchart)'))) AS BIGINT) AS caption_lines FROM documents""")
def doc_caption_lines(spark, sf_dir):
    text = F.replace(F.replace(F.col("text"), F.lit(". "), F.lit(".\n")), F.lit("er"), F.lit("fig"))
    return table(spark, sf_dir, "documents").select("doc_id", T.caption_lines(text).alias("caption_lines"))


@query(r"""SELECT doc_id, CASE WHEN trim(regexp_replace(text, '\s+', ' ', 'g')) <> '' THEN left(trim(regexp_replace(text, '\s+', ' ', 'g')), 240) END AS compact FROM documents""")
def doc_compact(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.compact(F.col("text")).alias("compact"))


@query("SELECT doc_id, CASE WHEN length(text) > 200 THEN left(text, 100) || '...' || right(text, 100) ELSE text END AS preview FROM documents")
def doc_preview(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.preview(F.col("text")).alias("preview"))


@query("SELECT doc_id, sha256(text) AS job_id, CAST(greatest(1, ceil(length(text) / 2000)) AS BIGINT) AS pages FROM documents")
def doc_identity(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("job_id"), T.estimated_pages(F.length("text")).alias("pages"))


# Conversations as Markdown: sections and chunks


def conversation_md(spark, sf_dir) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    part = F.concat(F.repeat(F.lit("#"), (F.col("turn") % 3 + 1).cast("int")), F.lit(" "), F.col("role"), F.lit(" "), F.col("turn").cast("string"), F.lit("\n\n"), F.col("text"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text", part.alias("part")))), lambda x: x["part"]), "\n\n")
    return turns.groupBy("conv_id").agg(joined.alias("md"))


MD_SQL = """md AS (SELECT conv_id, string_agg(repeat('#', CAST(turn % 3 AS INT) + 1) || ' ' || role || ' ' || turn || chr(10) || chr(10) || text, chr(10) || chr(10) ORDER BY turn, role, text) AS md FROM conversations GROUP BY conv_id)"""
SECTIONS_SQL = MD_SQL + r""",
l AS (SELECT conv_id, i, string_split(md, chr(10))[i] AS line FROM (SELECT conv_id, md, unnest(range(1, len(string_split(md, chr(10))) + 1)) AS i FROM md)),
h AS (SELECT *, CASE WHEN regexp_matches(line, '^#{1,6}\s+.+') THEN length(regexp_extract(line, '^(#{1,6})\s', 1)) END AS level FROM l),
g AS (SELECT *, count(level) OVER (PARTITION BY conv_id ORDER BY i) AS sec FROM h),
s AS (SELECT conv_id, sec, max(level) AS level, min(i) AS start_line, max(CASE WHEN level IS NOT NULL THEN trim(regexp_extract(line, '^#{1,6}\s+(.+)$', 1)) END) AS title,
        coalesce(string_agg(CASE WHEN level IS NULL THEN line END, chr(10) ORDER BY i), '') AS body, count(*) - 1 AS n FROM g WHERE sec > 0 GROUP BY conv_id, sec),
p AS (SELECT *, max(CASE WHEN level = 1 THEN sec END) OVER w AS l1, max(CASE WHEN level <= 1 THEN sec END) OVER w AS m1, max(CASE WHEN level = 2 THEN sec END) OVER w AS l2, max(CASE WHEN level <= 2 THEN sec END) OVER w AS m2
      FROM s WINDOW w AS (PARTITION BY conv_id ORDER BY sec ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
q AS (SELECT p.*, CASE WHEN p.level > 1 AND l1 = m1 THEN a.title || ' > ' ELSE '' END || CASE WHEN p.level > 2 AND l2 = m2 THEN b.title || ' > ' ELSE '' END || p.title AS section_path
      FROM p LEFT JOIN s a ON a.conv_id = p.conv_id AND a.sec = p.l1 LEFT JOIN s b ON b.conv_id = p.conv_id AND b.sec = p.l2)"""


#: Bodies of conversations are one paragraph each. In these tables its sentences fit the token limit, so that it makes one child.
CHILD_SQL = SECTIONS_SQL + """,
k AS (SELECT *, CASE WHEN length(title) > 30 THEN left(title, 30) || '...' ELSE title END AS header, sha256(conv_id || '|' || (sec - 1)) AS id, trim(body, chr(10) || ' ') AS txt FROM q),
c AS (SELECT *, sha256(id || '|0') AS child_id, greatest(1, length(txt) // 4) AS tokens FROM k WHERE txt <> '')"""


def conversation_parents(spark, sf_dir) -> DataFrame:
    return parent_chunks(explode_sections(conversation_md(spark, sf_dir)), "conv_id")


@query(f"""WITH {SECTIONS_SQL}
SELECT conv_id, CAST(sec - 1 AS BIGINT) AS section_no, title, CAST(level AS BIGINT) AS level, CAST(start_line AS BIGINT) AS start_line, CAST(start_line + n - 1 AS BIGINT) AS end_line, section_path,
       greatest(1, length(trim(body, chr(10) || ' ')) // 4) AS token_count, md5(trim(body, chr(10) || ' ')) AS digest FROM q""")
def conversation_sections(spark, sf_dir):
    return conversation_parents(spark, sf_dir).select("conv_id", "section_no", "title", F.col("level").cast("long").alias("level"), F.col("start_line").cast("long").alias("start_line"), "end_line", "section_path", "token_count", F.md5("page_content").alias("digest"))


@query(f"""WITH RECURSIVE {CHILD_SQL},
sentence AS (SELECT id, {SENTENCES_SQL.replace("text", "txt")} AS p FROM c WHERE tokens > 450),
packed AS (
  SELECT id, p, 1 AS i, 0 AS piece, greatest(1, length(p[1]) // 4) AS n, p[1] AS buf FROM sentence
  UNION ALL
  SELECT id, p, i + 1, CASE WHEN n + greatest(1, length(p[i + 1]) // 4) <= 450 THEN piece ELSE piece + 1 END,
         CASE WHEN n + greatest(1, length(p[i + 1]) // 4) <= 450 THEN n ELSE 0 END + greatest(1, length(p[i + 1]) // 4),
         CASE WHEN n + greatest(1, length(p[i + 1]) // 4) <= 450 THEN buf || ' ' || p[i + 1] ELSE p[i + 1] END
  FROM packed WHERE i < len(p)
),
child AS (SELECT id, 0 AS piece, txt AS content, '' AS how FROM c WHERE tokens <= 450 UNION ALL SELECT id, piece, trim(arg_max(buf, i), chr(10) || ' '), '_split_atomic' FROM packed GROUP BY id, piece)
SELECT conv_id, CAST(sec - 1 AS BIGINT) AS section_no, title, CAST(level AS INT) AS level, id AS parent_chunk_id, section_path, sha256(id || '|' || piece) AS chunk_id, CAST(piece AS BIGINT) AS chunk_index, content AS page_content, ['paragraph'] AS block_types,
       CAST(start_line + 1 AS INT) AS start_line, CAST(start_line + len(string_split(txt, chr(10))) AS INT) AS end_line, 'structure_aware_md_v1' || how AS chunking_strategy, greatest(1, length(content) // 4) AS token_count FROM c JOIN child USING (id)""")
def conversation_child_chunks(spark, sf_dir):
    return chunking.child_chunks(conversation_parents(spark, sf_dir)).drop("parents")


#: No line of the documents is blank, a header or the beginning of another block: each text is one section of one paragraph.
@query(f"""WITH RECURSIVE k AS (SELECT doc_id, sha256(doc_id || '|0') AS id, rtrim(regexp_replace(text, chr(10) || '$', ''), chr(10) || ' ') AS txt, len(string_split(regexp_replace(text, chr(10) || '$', ''), chr(10))) AS n FROM documents WHERE text <> ''),
c AS (SELECT *, greatest(1, length(txt) // 4) AS tokens FROM k),
sentence AS (SELECT id, {SENTENCES_SQL.replace("text", "txt")} AS p FROM c WHERE tokens > 450),
packed AS (
  SELECT id, p, 1 AS i, 0 AS piece, greatest(1, length(p[1]) // 4) AS n, p[1] AS buf FROM sentence
  UNION ALL
  SELECT id, p, i + 1, CASE WHEN n + greatest(1, length(p[i + 1]) // 4) <= 450 THEN piece ELSE piece + 1 END,
         CASE WHEN n + greatest(1, length(p[i + 1]) // 4) <= 450 THEN n ELSE 0 END + greatest(1, length(p[i + 1]) // 4),
         CASE WHEN n + greatest(1, length(p[i + 1]) // 4) <= 450 THEN buf || ' ' || p[i + 1] ELSE p[i + 1] END
  FROM packed WHERE i < len(p)
),
child AS (SELECT id, 0 AS piece, trim(txt, chr(10) || ' ') AS content, '' AS how FROM c WHERE tokens <= 450 UNION ALL SELECT id, piece, trim(arg_max(buf, i), chr(10) || ' '), '_split_atomic' FROM packed GROUP BY id, piece)
SELECT doc_id, CAST(0 AS BIGINT) AS section_no, 'Document' AS title, CAST(1 AS INT) AS level, c.id AS parent_chunk_id, 'Document' AS section_path, sha256(c.id || '|' || piece) AS chunk_id, CAST(piece AS BIGINT) AS chunk_index, content AS page_content, ['paragraph'] AS block_types, CAST(1 AS INT) AS start_line, CAST(n AS INT) AS end_line,
  'structure_aware_md_v1' || how AS chunking_strategy, CASE WHEN how = '' THEN tokens ELSE greatest(1, length(content) // 4) END AS token_count FROM c JOIN child ON child.id = c.id""")
def document_child_chunks(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("md"))
    return chunking.child_chunks(parent_chunks(explode_sections(docs), "doc_id")).drop("parents")


@query(f"""WITH {CHILD_SQL}
SELECT (SELECT count(*) FROM md) AS files, (SELECT count(*) FROM k) AS parents, (SELECT count(*) FROM c) AS children, round((SELECT count(*) FROM k) / (SELECT count(*) FROM md), 2) AS parents_per_file, round((SELECT count(*) FROM c) / (SELECT count(*) FROM md), 2) AS children_per_file""")
def chunk_summary(spark, sf_dir):
    parents = conversation_parents(spark, sf_dir)
    return analytics.chunk_summary(conversation_md(spark, sf_dir), parents, chunking.child_chunks(parents), "conv_id")


@query(f"""WITH {CHILD_SQL}
SELECT count(*) AS n, round(avg(tokens), 4) AS avg_tokens, min(tokens) AS min_tokens, max(tokens) AS max_tokens FROM c""")
def chunk_token_stats(spark, sf_dir):
    return analytics.token_stats(chunking.child_chunks(conversation_parents(spark, sf_dir)))


@query(f"""WITH {CHILD_SQL}
SELECT count(*) AS children, count(*) AS valid_parents, count(*) FILTER (WHERE section_path <> '') AS valid_paths, count(*) FILTER (WHERE tokens > 0) AS valid_tokens, CAST(0 AS BIGINT) AS orphans, round(100.0 * (count(*) + count(*) FILTER (WHERE section_path <> '') + count(*) FILTER (WHERE tokens > 0)) / (3 * count(*)), 4) AS score, 'excellent' AS grade FROM c""")
def chunk_integrity(spark, sf_dir):
    parents = conversation_parents(spark, sf_dir)
    return analytics.integrity(parents, chunking.child_chunks(parents))


@query(f"""WITH {CHILD_SQL}
SELECT conv_id, header, CAST(arg_max(CASE WHEN txt <> '' THEN 1 ELSE 0 END, sec) AS BIGINT) AS children FROM k GROUP BY conv_id, header""")
def children_per_header(spark, sf_dir):
    parents = conversation_parents(spark, sf_dir)
    return analytics.children_per_header(parents, chunking.child_chunks(parents), "conv_id")


@query(f"""WITH {CHILD_SQL}
SELECT conv_id, id AS chunk_id, title AS header, CAST(level AS INT) AS level, section_path, CAST(start_line AS INT) AS start_line, CAST(start_line + n - 1 AS BIGINT) AS end_line, greatest(1, length(txt) // 4) AS token_count, CASE WHEN txt <> '' THEN [sha256(id || '|0')] ELSE [] END AS child_chunk_ids, CAST(CASE WHEN txt <> '' THEN 1 ELSE 0 END AS BIGINT) AS child_count FROM k""")
def parent_export(spark, sf_dir):
    parents = conversation_parents(spark, sf_dir)
    return analytics.parent_export(parents, chunking.child_chunks(parents), "conv_id")


# Web pages: profile and routing


@query(r"""SELECT page_id, CAST(len(regexp_extract_all(html, '<li[\s>]')) AS BIGINT) AS items, CAST(len(regexp_extract_all(html, '<p[\s>]')) AS BIGINT) AS paragraphs, CAST(len(regexp_extract_all(html, '<a[\s>]')) AS BIGINT) AS links FROM pages""")
def html_tag_counts(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", *[F.regexp_count("html", F.lit(f"<{t}[\\s>]")).cast("long").alias(n) for t, n in (("li", "items"), ("p", "paragraphs"), ("a", "links"))])


#: Texts between tags, without scripts, styles and comments; the pages have the named entities below only.
HTML_SQL = r"""b AS (SELECT page_id, regexp_replace(html, '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->', '<x>', 'g') AS h FROM pages),
u AS (SELECT page_id, h, list_transform(string_split(regexp_replace(h, '<[^>]*>', chr(1), 'g'), chr(1)), lambda x: replace(replace(replace(replace(replace(replace(replace(x, '&copy;', '©'), '&middot;', '·'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&nbsp;', ' '), '&amp;', '&')) AS t FROM b),
l AS (SELECT page_id, h, length(array_to_string(list_filter(list_transform(t, lambda x: left(trim(regexp_replace(x, '\s+', ' ', 'g')), 240)), lambda x: x <> ''), chr(10))) AS total_characters FROM u),
k AS (SELECT page_id, total_characters, CAST(greatest(1, ceil(total_characters / 2000)) AS INT) AS pages, CAST(len(regexp_extract_all(h, '<table[\s>]')) AS INT) AS tables, CAST(len(regexp_extract_all(h, '<img[\s/>]')) AS INT) AS images, CAST(len(regexp_extract_all(h, '<svg[\s>]')) AS INT) AS svgs FROM l)"""


@query(f"WITH {HTML_SQL} SELECT page_id, total_characters, pages, tables, images, svgs FROM k")
def html_evidence(spark, sf_dir):
    return html_profile(spark, sf_dir).select("page_id", "text.total_characters", F.col("page_or_unit_count").alias("pages"), F.col("tables.count").alias("tables"), F.col("visuals.embedded_image_count").alias("images"), F.col("visuals.svg_count").alias("svgs"))


@query()
def html_profile(spark, sf_dir):
    return html.html_profile(table(spark, sf_dir, "pages"))


@query("SELECT page_id, 'docling' AS engine, CAST(0.98 AS DOUBLE) AS confidence, 'only_supported' AS reason FROM pages")
def html_routing(spark, sf_dir):
    return routing.routed(routing.requirements(html_profile(spark, sf_dir))).select("page_id", "engine", "confidence", "reason")


@query(f"WITH {HTML_SQL} SELECT 'docling' AS engine, count(*) AS documents, CAST(sum(pages) AS BIGINT) AS pages FROM k")
def routing_rollup(spark, sf_dir):
    return routing.rollup(routing.routed(routing.requirements(html_profile(spark, sf_dir))))


# Orders as pages with a table each


def order_pages(spark, sf_dir) -> DataFrame:
    lines_ = table(spark, sf_dir, "lineitem").withColumn("row", F.concat_ws("", F.lit("| "), F.col("l_linenumber").cast("string"), F.lit(" | "), F.col("l_partkey").cast("string"), F.lit(" | "), F.col("l_quantity").cast("int").cast("string"), F.lit(" |")))
    rows = lines_.groupBy("l_orderkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "row"))), lambda x: x["row"]), "\n").alias("rows"))
    orders = table(spark, sf_dir, "orders").join(rows, F.col("o_orderkey") == F.col("l_orderkey"))
    md = F.concat(F.lit("## Order "), F.col("o_orderkey").cast("string"), F.lit("\n\n| line | part | qty |\n|---|---|---|\n"), F.col("rows"), F.when(F.col("o_orderkey") % 3 != 0, "\n\nEnd of order.").otherwise(""))
    page = F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderkey"))
    return orders.select(F.col("o_custkey").cast("string").alias("job_id"), page.alias("page_number"), md.alias("markdown"))


ORDER_SQL = """r AS (SELECT l_orderkey, string_agg('| ' || l_linenumber || ' | ' || l_partkey || ' | ' || CAST(floor(l_quantity) AS INT) || ' |', chr(10) ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS rows FROM lineitem GROUP BY 1),
o AS (SELECT CAST(o_custkey AS VARCHAR) AS job_id, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS page, '| line | part | qty |' || chr(10) || '|---|---|---|' || chr(10) || rows AS tbl, o_orderkey % 3 = 0 AS fragment FROM orders JOIN r ON o_orderkey = l_orderkey),
t AS (SELECT *, '${TBL:' || job_id || ':' || lpad(CAST(page AS VARCHAR), CAST(greatest(3, length(CAST(page AS VARCHAR))) AS INT), '0') || ':0}' AS token FROM o)"""


@query(f"WITH {ORDER_SQL} SELECT job_id, page AS page_number, token, fragment AS is_fragment, md5(tbl) AS digest, md5('## Order ' || o_orderkey || chr(10) || chr(10) || token || CASE WHEN fragment THEN '' ELSE chr(10) || chr(10) || 'End of order.' END) AS page_digest FROM t")
def order_table_tokens(spark, sf_dir):
    rows = pages.with_table_tokens(order_pages(spark, sf_dir)).select("job_id", F.col("page_number").cast("long").alias("page_number"), F.md5("markdown_with_tokens").alias("page_digest"), F.explode("tables").alias("t"))
    return rows.select("job_id", "page_number", "t.token", "t.is_fragment", F.md5("t.markdown").alias("digest"), "page_digest")


@query(f"""WITH {ORDER_SQL}, b AS (SELECT job_id, page, fragment, '## Order ' || o_orderkey || CASE WHEN fragment THEN '' ELSE chr(10) || chr(10) || tbl || chr(10) || chr(10) || 'End of order.' END || chr(10) AS body FROM t),
f AS (SELECT job_id, string_agg(chr(10) || '### Table started on page ' || page || chr(10) || chr(10) || '<table>' || chr(10) || chr(10) || '<placeholder>' || chr(10) || '<!-- table starting on page ' || page || ' had no closing fragment -->' || chr(10), '' ORDER BY page) AS foot FROM b WHERE fragment GROUP BY job_id)
SELECT b.job_id, count(*) AS total_pages, md5(string_agg(body, chr(10) ORDER BY page) || coalesce(any_value(chr(10) || '---' || chr(10) || chr(10) || '## Unclosed Table Fragments' || chr(10) || foot), '')) AS digest FROM b LEFT JOIN f ON f.job_id = b.job_id GROUP BY b.job_id""")
def order_assembled(spark, sf_dir):
    return pages.assembled(pages.with_table_tokens(order_pages(spark, sf_dir))).select("job_id", "total_pages", F.md5("markdown").alias("digest"))


@query("""WITH x AS (SELECT o_custkey, l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS k, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
SELECT l_orderkey AS job_id, md5(string_agg('row ' || l_partkey, chr(10) ORDER BY k)) AS digest, l_orderkey % 5 <> 0 AS closed, count(*) AS pieces FROM x GROUP BY l_orderkey""")
def fragment_merge(spark, sf_dir):
    order = W.partitionBy("l_orderkey")
    lines_ = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    tasks = tasks_for(lines_)
    orders = table(spark, sf_dir, "orders").select("o_orderkey").repartition(tasks, "o_orderkey")
    rows = lines_.repartition(tasks, "l_orderkey").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.withColumn("k", F.row_number().over(order.orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity"))).withColumn("n", F.count("*").over(order))
    rows = rows.select(F.col("l_orderkey").alias("job_id"), F.lit(1).alias("start_page"), F.col("k").alias("page_number"), F.lit(0).alias("idx"), F.concat(F.lit("t"), F.col("k").cast("string")).alias("token"), F.concat(F.lit("row "), F.col("l_partkey").cast("string"), F.lit("\n")).alias("markdown"), ((F.col("k") < F.col("n")) | (F.col("l_orderkey") % 5 == 0)).alias("is_fragment"))
    return pages.merged_tables(rows).select("job_id", F.md5("markdown").alias("digest"), "closed", F.size(F.split("markdown", "\n")).cast("long").alias("pieces"))


# Parts as figures


def figure_rows(spark, sf_dir) -> DataFrame:
    page, index = F.floor(F.col("p_partkey") / 10) + 1, F.col("p_partkey") % 10
    return table(spark, sf_dir, "part").select(F.col("p_size").cast("string").alias("job_id"), page.cast("long").alias("page_number"), index.cast("long").alias("index_on_page"), T.figure_token(F.col("p_size"), page, index).alias("token"), F.sha2(F.concat("p_brand", "p_type"), 256).alias("sha256"))


FIGURE_SQL = """f AS (SELECT CAST(p_size AS VARCHAR) AS job_id, p_partkey // 10 + 1 AS page_number, p_partkey % 10 AS index_on_page, sha256(p_brand || p_type) AS sha,
  '${FIG:' || p_size || ':' || lpad(CAST(p_partkey // 10 + 1 AS VARCHAR), CAST(greatest(3, length(CAST(p_partkey // 10 + 1 AS VARCHAR))) AS INT), '0') || ':' || p_partkey % 10 || '}' AS token FROM part),
e AS (SELECT *, CASE WHEN sha LIKE 'f%' THEN 'failed' WHEN row_number() OVER (PARTITION BY job_id, sha ORDER BY page_number, index_on_page, token) = 1 THEN 'summarized' ELSE 'deduplicated' END AS status,
  CASE WHEN sha LIKE '0%' THEN 'decorative' WHEN sha LIKE 'f%' THEN 'failed' ELSE 'informative' END AS outcome FROM f)"""


@query(f"WITH {FIGURE_SQL} SELECT token, sha AS sha256, status, outcome FROM e")
def figure_dedup(spark, sf_dir):
    return figures.enriched(figure_rows(spark, sf_dir)).select("token", "sha256", "status", "outcome")


@query(f"WITH {FIGURE_SQL} SELECT job_id, count(*) FILTER (WHERE status = 'summarized') AS figures_summarized, count(*) FILTER (WHERE status = 'deduplicated') AS figures_deduplicated, count(*) FILTER (WHERE status = 'failed') AS figures_failed FROM e GROUP BY job_id")
def figure_counters(spark, sf_dir):
    return figures.counters(figures.enriched(figure_rows(spark, sf_dir)))


@query(f"WITH {FIGURE_SQL} SELECT token FROM f WHERE sha NOT LIKE '1%'")
def figure_resume(spark, sf_dir):
    rows = figure_rows(spark, sf_dir)
    return figures.pending(rows, rows.filter("sha256 LIKE '1%'")).select("token")


@query(f"WITH {FIGURE_SQL} SELECT token, CASE WHEN sha LIKE '1%' THEN '[Figure: processing failed — see original document]' WHEN outcome = 'informative' THEN 'about ' || left(sha, 8) ELSE '' END AS replacement FROM e")
def figure_replacements(spark, sf_dir):
    rows = figures.enriched(figure_rows(spark, sf_dir))
    summaries = rows.filter("NOT sha256 LIKE '1%'").select("token", (F.col("outcome") == "informative").alias("is_informative"), F.concat(F.lit("about "), F.left("sha256", F.lit(8))).alias("markdown_result"))
    return figures.resolved(rows, summaries).select("token", "replacement")


# Windows of pages


def order_jobs(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("job_id")).agg(F.count("*").alias("total_pages")).withColumn("last_completed_page", F.when(F.col("job_id") % 4 == 0, 8).otherwise(0))


@query("""WITH j AS (SELECT o_custkey AS job_id, count(*) AS n FROM orders GROUP BY 1)
SELECT job_id, k AS window_index, k * 8 + 1 AS start_page, least(k * 8 + 8, n) AS end_page FROM (SELECT job_id, n, unnest(range(0, (n + 7) // 8)) AS k FROM j) WHERE k * 8 + 1 > CASE WHEN job_id % 4 = 0 THEN 8 ELSE 0 END""")
def page_windows(spark, sf_dir):
    return windows.page_windows(order_jobs(spark, sf_dir))


@query("""WITH j AS (SELECT o_custkey AS job_id, count(*) AS n FROM orders GROUP BY 1), w AS (SELECT job_id, n, unnest(range(0, (n + 1) // 2)) AS k FROM j),
p AS (SELECT job_id, k, least(k * 2 + 2, n) AS end_page, min(CASE WHEN (job_id + k) % 5 <> 0 THEN 1 ELSE 0 END) OVER (PARTITION BY job_id ORDER BY k) AS ok FROM w)
SELECT job_id, CAST(sum(ok) AS BIGINT) AS verified, CAST(sum(1 - ok) AS BIGINT) AS discarded, CAST(coalesce(max(CASE WHEN ok = 1 THEN end_page END), 0) AS BIGINT) AS last_completed_page FROM p GROUP BY job_id""")
def resume_plan(spark, sf_dir):
    done = windows.page_windows(order_jobs(spark, sf_dir).withColumn("last_completed_page", F.lit(0)), 2)
    return windows.resume_plan(done, done.filter((F.col("job_id") + F.col("window_index")) % 5 != 0))


# Events as page arrivals


@query("""WITH a AS (SELECT user_id AS job_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS page_number, event_id, (event_id * 7919) % 10007 AS arrival FROM events)
SELECT job_id, page_number, arrival, row_number() OVER (PARTITION BY job_id ORDER BY page_number, arrival) AS position FROM a""")
def page_order(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("job_id"), F.row_number().over(W.partitionBy("user_id").orderBy("ts", "event_id")).cast("long").alias("page_number"), (F.col("event_id") * 7919 % 10007).alias("arrival"))
    return pages.reordered(rows)


@query("""WITH e AS (SELECT l_orderkey, list(CAST((l_partkey % 600) AS DOUBLE)) AS x FROM lineitem GROUP BY 1)
SELECT l_orderkey, CASE WHEN len(x) < 8 THEN NULL ELSE len(list_filter(x, lambda v: v > 300)) > 0 AND len(list_filter(x, lambda v: v > 300)) < len(x) AND len(list_filter(x, lambda v: v > 300)) / len(x) >= 0.3 END AS multi_column FROM e""")
def column_detection(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list((F.col("l_partkey") % 600).cast("double")).alias("x"))
    return rows.select("l_orderkey", T.is_multi_column(F.col("x"), F.lit(600.0)).alias("multi_column"))


# Documents and parts: normalised pages, images, summaries


@query(r"""SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(replace(text, '. ', '.' || chr(13) || chr(10) || chr(13) || chr(13)), '\r\n?', chr(10), 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g')) AS digest FROM documents""")
def page_markdown_normalise(spark, sf_dir):
    raw = F.replace(F.col("text"), F.lit(". "), F.lit(".\r\n\r\r"))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(T.normalise(raw)).alias("digest"))


@query(r"""WITH m AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'text only ' || p_name ELSE '![' || p_name || '](img/' || p_partkey || '.png) and ![](' || p_brand || ') [no](' || p_type || ')' END AS md FROM part)
SELECT p_partkey, CAST(i - 1 AS INT) AS place, regexp_extract_all(md, '!\[[^\]]*\]\(([^)]+)\)', 1)[i] AS target FROM (SELECT p_partkey, md, unnest(range(1, len(regexp_extract_all(md, '!\[[^\]]*\]\(([^)]+)\)')) + 1)) AS i FROM m)""")
def image_refs(spark, sf_dir):
    md = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("text only "), "p_name")).otherwise(F.concat(F.lit("!["), "p_name", F.lit("](img/"), F.col("p_partkey").cast("string"), F.lit(".png) and !["), F.lit("]("), "p_brand", F.lit(") [no]("), "p_type", F.lit(")")))
    return table(spark, sf_dir, "part").select("p_partkey", F.posexplode(T.image_refs(md)).alias("place", "target"))


@query("""WITH m AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '### Figure' || chr(10) || 'Decorative image of ' || p_name WHEN 1 THEN '### a company logo' || chr(10) || p_name WHEN 2 THEN repeat(p_name || ' ', 40) || 'watermark' ELSE 'A chart: ' || p_type END AS md FROM part),
d AS (SELECT *, len(list_filter(['decorative figure', 'decorative image', 'no clinical content', 'stock photo', 'this is a logo', 'company logo', 'watermark'], lambda x: contains(regexp_replace(left(lower(md), 240), '^###[^' || chr(10) || ']*' || chr(10), ''), x))) > 0 AS deco FROM m)
SELECT p_partkey, CASE WHEN deco THEN 'decorative' ELSE 'other' END AS figure_type, CASE WHEN deco THEN 'decorative_note' ELSE 'plain_text_explanation' END AS rendering_strategy, NOT deco AS is_informative, CAST(CASE WHEN deco THEN 0.9 ELSE 0.8 END AS DOUBLE) AS confidence FROM d""")
def figure_summaries(spark, sf_dir):
    key = F.col("p_partkey") % 4
    md = F.when(key == 0, F.concat(F.lit("### Figure\nDecorative image of "), "p_name")).when(key == 1, F.concat(F.lit("### a company logo\n"), "p_name")).when(key == 2, F.concat(F.repeat(F.concat("p_name", F.lit(" ")), F.lit(40)), F.lit("watermark"))).otherwise(F.concat(F.lit("A chart: "), "p_type"))
    s = table(spark, sf_dir, "part").select("p_partkey", figures.summary_of(md).alias("s"))
    return s.select("p_partkey", "s.figure_type", "s.rendering_strategy", "s.is_informative", "s.confidence")


@query("""WITH x AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'decorative' WHEN 1 THEN 'chart' ELSE 'table' END AS t, CASE p_partkey % 4 WHEN 0 THEN 'decorative_note' WHEN 1 THEN 'plain_text_explanation' ELSE 'markdown_table' END AS r,
  p_partkey % 5 <> 0 AS inf, CASE p_partkey % 7 WHEN 0 THEN '  ' WHEN 1 THEN NULL ELSE p_name END AS md, (p_partkey % 13) / 10.0 AS conf, CASE p_partkey % 11 WHEN 0 THEN 'auto' ELSE 'medical' END AS dom FROM part)
SELECT p_partkey, concat_ws(',', CASE WHEN (t, r) NOT IN (('decorative', 'decorative_note'), ('chart', 'plain_text_explanation'), ('table', 'markdown_table')) THEN 'strategy_not_allowed' END, CASE WHEN t = 'decorative' AND inf THEN 'decorative_but_informative' END,
  CASE WHEN t <> 'decorative' AND NOT inf THEN 'informative_mismatch' END, CASE WHEN t = 'decorative' AND r <> 'decorative_note' THEN 'decorative_needs_note' END, CASE WHEN t <> 'decorative' AND r = 'decorative_note' THEN 'note_needs_decorative' END,
  CASE WHEN trim(coalesce(md, '')) = '' THEN 'empty_markdown' END, CASE WHEN conf > 1 THEN 'confidence_out_of_range' END, CASE WHEN dom = 'auto' THEN 'domain_not_resolved' END) AS errors FROM x""")
def summary_validation(spark, sf_dir):
    k = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select(
        "p_partkey", F.when(k % 3 == 0, "decorative").when(k % 3 == 1, "chart").otherwise("table").alias("figure_type"), F.when(k % 4 == 0, "decorative_note").when(k % 4 == 1, "plain_text_explanation").otherwise("markdown_table").alias("rendering_strategy"),
        (k % 5 != 0).alias("is_informative"), F.when(k % 7 == 0, "  ").when(k % 7 == 1, None).otherwise(F.col("p_name")).alias("markdown_result"), (k % 13 / 10).alias("confidence"), F.when(k % 11 == 0, "auto").otherwise("medical").alias("document_domain"),
    )
    allowed = spark.createDataFrame([("decorative", "decorative_note"), ("chart", "plain_text_explanation"), ("table", "markdown_table")], "figure_type string, rendering_strategy string")
    return figures.violations(rows, allowed).select("p_partkey", F.array_join("errors", ",").alias("errors"))


@query("""SELECT p_partkey AS token, CASE WHEN p_size % 2 = 0 THEN 'chart' ELSE 'decorative' END AS figure_type, p_brand AS markdown_result, p_size % 2 = 0 AS is_informative FROM part
WHERE p_partkey % 5 NOT IN (0, 1) AND p_partkey % 7 <> 0 AND (p_size % 2 = 0 OR p_partkey % 3 = 0)""")
def summary_store(spark, sf_dir):
    """Broken JSON, one without a field, a confidence over 1, and charts that say they are not informative are misses."""
    k, informative = F.col("p_partkey"), F.col("p_size") % 2 == 0
    note = ~informative & (k % 3 == 0)
    good = F.to_json(F.struct(
        F.when(note, "decorative").otherwise("chart").alias("figure_type"), F.when(note, "decorative_note").otherwise("plain_text_explanation").alias("rendering_strategy"), informative.alias("is_informative"), F.col("p_brand").alias("markdown_result"),
        F.lit("clear").alias("legibility"), F.when(k % 7 == 0, 1.5).otherwise(0.5).alias("confidence"), F.lit("legal").alias("document_domain"), F.concat(F.lit("${FIG:"), k.cast("string"), F.lit("}")).alias("token"),
    ))
    json = F.when(k % 5 == 0, F.left(good, F.lit(30))).when(k % 5 == 1, '{"figure_type": "chart"}').otherwise(good)
    return figures.stored(dealt(table(spark, sf_dir, "part"), "p_partkey").select(k.alias("token"), json.alias("json")), "token").select("token", "figure_type", "markdown_result", "is_informative")


@query("""SELECT p_partkey, CAST(CASE p_partkey % 4 WHEN 0 THEN p_size WHEN 1 THEN p_partkey ELSE 0 END AS BIGINT) AS reasoning_tokens, CAST(CASE WHEN p_partkey % 4 = 2 THEN 7 WHEN p_partkey % 4 < 2 THEN p_partkey + 1 ELSE 0 END AS BIGINT) AS output_tokens FROM part""")
def model_usage(spark, sf_dir):
    k, n = F.col("p_partkey"), F.col("p_size")
    usage = F.when(k % 4 == 0, F.format_string('{"completion_tokens": %d, "completion_tokens_details": {"reasoning_tokens": %d}}', k + 1, n)).when(k % 4 == 1, F.format_string('{"output_tokens": %d, "output_tokens_details": {"reasoning_tokens": %d}}', k + 1, k)).when(k % 4 == 2, '{"output_tokens": 7, "completion_tokens_details": null}').otherwise('{"completion_tokens": "many"}')
    return table(spark, sf_dir, "part").select("p_partkey", T.reasoning_tokens(usage).alias("reasoning_tokens"), T.output_tokens(usage).alias("output_tokens"))


# Parts as document profiles


def part_profiles(spark, sf_dir) -> DataFrame:
    k, z = F.col("p_partkey"), F.col("p_size")
    candidate = F.struct(F.lit("embedded_image").alias("kind"), (z / 100).alias("area_ratio"), F.when(k % 6 == 0, F.lit("Figure 1")).when(k % 6 == 1, F.lit("a logo")).alias("caption_or_alt_text"), F.lit(None).cast("string").alias("nearby_text"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.when(k % 4 == 0, "pdf").when(k % 4 == 1, "docx").when(k % 4 == 2, "pptx").otherwise("html").alias("file_type"), z.alias("page_or_unit_count"),
        F.struct((k * 10).alias("total_characters"), (k % 7 != 0).alias("native_text_available")).alias("text"), F.struct((z % 3).alias("count"), (z % 10).alias("max_column_count"), (z % 11 == 0).alias("has_merged_cells"), F.lit(False).alias("has_nested_tables")).alias("tables"),
        F.struct((F.lit(1) + (z % 8 == 0).cast("int")).alias("column_count"), (z % 13 == 0).alias("has_floating_text_boxes")).alias("layout"),
        F.struct((z % 5).alias("embedded_image_count"), F.lit(0).alias("large_embedded_image_count"), (z % 4).alias("vector_graphics_count"), (k % 17 == 0).cast("int").alias("chart_count"), F.lit(0).alias("svg_count")).alias("visuals"),
        F.when(z % 5 > 0, F.array(candidate)).otherwise(F.array().cast("array<struct<kind:string,area_ratio:double,caption_or_alt_text:string,nearby_text:string>>")).alias("visual_candidates"),
    )


PROFILE_SQL = """p AS (SELECT p_partkey AS k, p_size AS z, CASE p_partkey % 4 WHEN 0 THEN 'pdf' WHEN 1 THEN 'docx' WHEN 2 THEN 'pptx' ELSE 'html' END AS file_type FROM part),
n AS (SELECT *, k % 7 = 0 AS needs_ocr, z % 8 = 0 OR z % 13 = 0 AS needs_reading_order, z % 11 = 0 OR z % 10 > 6 AS needs_complex_tables, k % 17 = 0 OR (z % 5 > 0 AND (k % 6 = 0 OR (z >= 5))) AS needs_visual_semantics FROM p),
e AS (SELECT *, CASE WHEN file_type = 'html' THEN 'only_supported' WHEN needs_reading_order THEN 'reading_order' WHEN needs_complex_tables THEN 'complex_tables' WHEN needs_ocr THEN 'ocr' ELSE 'default' END AS reason FROM n)"""


@query(f"""WITH {PROFILE_SQL} SELECT k AS p_partkey, CASE WHEN reason IN ('only_supported', 'default') THEN 'docling' ELSE 'mineru' END AS engine, CAST(CASE reason WHEN 'only_supported' THEN 0.98 WHEN 'default' THEN 0.85 ELSE 0.9 END AS DOUBLE) AS confidence, reason,
  file_type || ', units=' || z || ', text_chars=' || k * 10 || ', tables=' || z % 3 || ', columns=' || CASE WHEN z % 8 = 0 THEN 2 ELSE 1 END || ', images=' || z % 5 || ', vectors=' || z % 4 || ', visual_candidates=' || CASE WHEN z % 5 > 0 THEN 1 ELSE 0 END
  || CASE WHEN needs_reading_order THEN ', complex_layout' ELSE '' END || CASE WHEN z % 11 = 0 THEN ', complex_tables' ELSE '' END || CASE WHEN needs_visual_semantics THEN ', needs_visual_explanation' ELSE '' END AS summary FROM e""")
def document_routing(spark, sf_dir):
    return routing.routed(routing.requirements(part_profiles(spark, sf_dir))).select("p_partkey", "engine", "confidence", "reason", routing.compact_summary().alias("summary"))


@query(f"""WITH {PROFILE_SQL} SELECT CASE WHEN reason IN ('only_supported', 'default') THEN 'docling' ELSE 'mineru' END AS engine, count(*) AS documents, CAST(sum(z) AS BIGINT) AS pages FROM e GROUP BY 1""")
def document_routing_rollup(spark, sf_dir):
    return routing.rollup(routing.routed(routing.requirements(part_profiles(spark, sf_dir))))


@query("""WITH c AS (SELECT l_orderkey, l_linenumber AS i, CASE WHEN l_partkey % 3 = 0 THEN 1 ELSE 0 END + l_partkey % 2 + 1 AS score, CASE WHEN l_suppkey % 4 = 0 THEN 0 ELSE (l_suppkey % 10) / 10.0 END AS area, l_partkey || '/' || l_suppkey AS label,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS n FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY score DESC, area DESC, n) AS place FROM c)
SELECT l_orderkey, string_agg(label, ',' ORDER BY place) AS labels FROM r WHERE place <= 3 GROUP BY l_orderkey""")
def topk_candidates(spark, sf_dir):
    p, s = F.col("l_partkey"), F.col("l_suppkey")
    one = F.struct(
        "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", F.when(s % 4 != 0, (s % 10) / 10).alias("area_ratio"), F.when(p % 3 == 0, F.lit("a caption")).alias("caption_or_alt_text"), F.lit(None).cast("string").alias("nearby_text"),
        F.when(p % 2 == 0, F.array(F.lit("one"))).otherwise(F.array(F.lit("one"), F.lit("two"))).alias("evidence"), F.concat_ws("/", p.cast("string"), s.cast("string")).alias("label"),
    )
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(one)).alias("c"))
    return rows.select("l_orderkey", F.array_join(F.transform(routing.top_candidates(F.col("c"), 3), lambda x: x["label"]), ",").alias("labels"))


# Orders as pages of engines


@query("""WITH g AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS page, lpad(CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS VARCHAR), CAST(greatest(3, length(CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS VARCHAR))) AS INT), '0') AS p3, o_orderkey % 3 AS n FROM orders)
SELECT CAST(o_custkey AS VARCHAR) AS job_id, page AS page_number, md5('Order ' || o_orderkey || chr(10) || chr(10) || CASE WHEN n > 0 THEN '${FIG:' || o_custkey || ':' || p3 || ':0}' ELSE '' END || ' and ' || CASE WHEN n > 1 THEN '${FIG:' || o_custkey || ':' || p3 || ':1}' ELSE '' END
  || chr(10) || chr(10) || '${TBL:' || o_custkey || ':' || p3 || ':0}' || chr(10) || chr(10) || 'between' || chr(10) || chr(10) || '${TBL:' || o_custkey || ':' || p3 || ':1}') AS digest, CAST(2 AS BIGINT) AS tables, o_orderkey % 2 = 0 AS ends_in_fragment FROM g""".replace("|| '${TBL:' || o_custkey || ':' || p3 || ':1}')", "|| '${TBL:' || o_custkey || ':' || p3 || ':1}' || CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE chr(10) || chr(10) || 'end' END)"))
def page_results(spark, sf_dir):
    """Raw pages with Windows line ends, two markers, up to two figures and two tables."""
    k = F.col("o_orderkey")
    page = F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderkey"))
    md = F.concat(F.lit("Order "), k.cast("string"), F.lit("\r\n\r\n\r\n<!-- figure --> and <!-- figure -->\r\n\r\n| a | b |\r\n|---|:-:|\r\n| 1 | 2 |\r\n\r\nbetween\r\n\r\n| c |\r\n| - |\r\n"), F.when(k % 2 == 0, F.lit("")).otherwise(F.lit("\r\nend")))
    raw = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("job_id"), page.alias("page_number"), md.alias("markdown"), F.slice(F.array(F.lit("x"), F.lit("y")), F.lit(1), (k % 3).cast("int")).alias("figures"))
    rows = pages.page_results(raw)
    return rows.select("job_id", F.col("page_number").cast("long").alias("page_number"), F.md5("markdown_with_tokens").alias("digest"), F.size("tables").cast("long").alias("tables"), F.element_at("tables", -1)["is_fragment"].alias("ends_in_fragment"))


def engine_pages(spark, sf_dir, tasks: int | None = None) -> DataFrame:
    """tasks: how many the orders are dealt to (default: as Spark packs them)."""
    k = F.col("o_orderkey")
    engine = F.when(k % 5 == 0, "docling").otherwise("mineru")
    backend = F.when((k % 5 != 0) & (k % 3 == 0), "pipeline").when(k % 5 != 0, "vlm-engine")
    page = F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderkey")).cast("long")
    orders = table(spark, sf_dir, "orders")
    rows = (orders.repartition(tasks, "o_custkey") if tasks else orders).select(F.col("o_custkey").alias("job_id"), page.alias("page_number"), engine.alias("engine"), backend.alias("backend"), (k % 40000).alias("duration_ms"), (k % 10 == 0).alias("fallback"))
    return rows.withColumn("is_degraded", routing.is_degraded(F.col("backend"), F.lit("vlm-engine"), F.col("fallback")))


ENGINE_SQL = """g AS (SELECT o_custkey AS job_id, o_orderkey AS k, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS page_number, CASE WHEN o_orderkey % 5 = 0 THEN 'docling' ELSE 'mineru' END AS engine, o_orderkey % 40000 AS ms,
  o_orderkey % 10 = 0 OR (o_orderkey % 5 <> 0 AND o_orderkey % 3 = 0) AS is_degraded FROM orders)"""


@query(f"WITH {ENGINE_SQL} SELECT engine, is_degraded, count(*) AS pages, count(*) FILTER (WHERE ms <= 1000) AS within_1_s, count(*) FILTER (WHERE ms <= 5000) AS within_5_s, count(*) FILTER (WHERE ms <= 30000) AS within_30_s, CAST(sum(ms) AS BIGINT) AS duration_ms FROM g GROUP BY 1, 2")
def page_metrics(spark, sf_dir):
    return pages.page_metrics(engine_pages(spark, sf_dir))


@query(f"""WITH {ENGINE_SQL}, {FIGURE_SQL}, c AS (SELECT CAST(job_id AS BIGINT) AS job_id, count(*) FILTER (WHERE status = 'summarized') AS s, count(*) FILTER (WHERE status = 'deduplicated') AS d, count(*) FILTER (WHERE status = 'failed') AS f FROM e GROUP BY 1)
SELECT g.job_id, count(*) AS total_pages, string_agg(DISTINCT engine, ',' ORDER BY engine) AS engines_used, sum(ms) / 1000.0 AS total_duration_seconds, coalesce(any_value(s), 0) AS figures_summarized, coalesce(any_value(d), 0) AS figures_deduplicated, coalesce(any_value(f), 0) AS figures_failed
FROM g LEFT JOIN c ON c.job_id = g.job_id GROUP BY g.job_id""")
def conversion_summary(spark, sf_dir):
    counts = figures.counters(figures.enriched(figure_rows(spark, sf_dir))).withColumn("job_id", F.col("job_id").cast("long"))
    return pages.conversion_summary(engine_pages(spark, sf_dir), counts).withColumn("engines_used", F.array_join("engines_used", ","))


@query(f"""WITH {ENGINE_SQL}, a AS (SELECT job_id, page_number, '${{FIG:' || k || '}}' AS token, 'figure ' || k AS text FROM g WHERE k % 2 = 0), b AS (SELECT job_id, page_number, '${{FIG:' || k || '}}' AS token, 'table ' || k AS text FROM g WHERE k % 3 = 0)
SELECT coalesce(a.job_id, b.job_id) AS job_id, coalesce(a.page_number, b.page_number) AS page_number, coalesce(a.token, b.token) AS token, coalesce(b.text, a.text) AS text, CAST(CASE WHEN a.token = b.token THEN 1 ELSE 0 END AS BIGINT) AS conflicts FROM a FULL JOIN b ON a.token = b.token""")
def replacement_merge(spark, sf_dir):
    k = F.col("o_orderkey").cast("string")
    page = F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderkey")).cast("long")
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("job_id"), page.alias("page_number"), F.concat(F.lit("${FIG:"), k, F.lit("}")).alias("token"), "o_orderkey")
    return pages.merged_replacements(*[rows.filter(F.col("o_orderkey") % n == 0).withColumn("text", F.concat(F.lit(word), F.col("o_orderkey").cast("string"))) for n, word in ((2, "figure "), (3, "table "))])


@query(f"""WITH {ENGINE_SQL}, d AS (SELECT *, page_number <= CASE WHEN job_id % 4 = 0 THEN 8 ELSE 0 END AS is_replayed FROM g)
SELECT job_id, page_number, is_replayed, row_number() OVER (PARTITION BY job_id ORDER BY is_replayed DESC, page_number) AS position FROM d""")
def page_replay(spark, sf_dir):
    tasks = tasks_for(table(spark, sf_dir, "orders"))
    rows = engine_pages(spark, sf_dir, tasks).select("job_id", "page_number")
    return pages.replayed(rows, rows, order_jobs(spark, sf_dir), tasks=tasks)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
