"""Queries of intake, errors, model responses, stores, sinks and streams. Files that they need are derived from the tables and kept in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folio.functions import text as T
from folio.operators import analytics, errors, figures, pages, responses, routing
from folio.plans import conversion
from folio.plans.registry import ENGINE_SQL, HTML_SQL, MD_SQL, ORDER_SQL, PROFILE_SQL, dealt, engine_pages, order_pages, part_profiles, query, table
from folio.sources import document_sink, engines, files, ledger
from folio.sources.page_store import PageStore
from folio.sources.shared import Files, work_dir
from folio.sources.versioned import VersionedTable
from folio.streaming import fanout
from folio.streaming.reorder import merged_tables_stream, ordered_pages, rocksdb

# Errors as data


@query(f"""WITH {PROFILE_SQL} SELECT k AS p_partkey, CASE WHEN file_type <> 'html' THEN 'mineru' END AS engine, CASE WHEN file_type <> 'html' THEN 'forced' END AS reason, CASE WHEN file_type = 'html' THEN 'ConfigurationError' END AS error_class,
  CASE WHEN file_type = 'html' THEN 'the forced engine mineru does not read documents of type html' END AS message, CASE WHEN file_type = 'html' THEN 'html' END AS document_type FROM p""")
def forced_routing(spark, sf_dir):
    rows = routing.routed(routing.requirements(part_profiles(spark, sf_dir)), forced="mineru")
    return rows.select("p_partkey", "engine", "reason", F.col("error.class").alias("error_class"), F.col("error.message").alias("message"), F.try_element_at("error.context", F.lit("document_type")).alias("document_type"))


@query(f"""WITH {PROFILE_SQL}, x AS (SELECT 'routing' AS stage, ['ConfigurationError', 'PipelineError'] AS kinds FROM p WHERE file_type = 'html' UNION ALL
SELECT 'intake', ['DocumentTooLargeError', 'DocumentError', 'PipelineError'] FROM p WHERE z * 12 > 500), y AS (SELECT stage, kinds[1] AS own, unnest(kinds) AS class FROM x)
SELECT stage, class, CAST(count(*) FILTER (WHERE own = class) AS BIGINT) AS own, count(*) AS with_kinds FROM y GROUP BY stage, class""")
def error_rollup(spark, sf_dir):
    """Dead letters of two stages, counted by class and by the classes above."""
    profiles = part_profiles(spark, sf_dir)
    routed = errors.dead_letters(routing.routed(routing.requirements(profiles), forced="mineru"), "routing", "p_partkey")
    large = errors.dead_letters(files.within_page_limit(profiles.withColumn("page_or_unit_count", F.col("page_or_unit_count") * 12)), "intake", "p_partkey")
    return errors.error_rollup(routed.unionByName(large))


@query(f"""WITH {PROFILE_SQL} SELECT k AS p_partkey, concat_ws(' | ', CASE WHEN needs_ocr THEN 'no usable native text layer — OCR/layout recovery required' END,
  CASE WHEN needs_reading_order THEN 'non-linear layout (columns=' || CASE WHEN z % 8 = 0 THEN 2 ELSE 1 END || ', floating_text_boxes=' || CASE WHEN z % 13 = 0 THEN 'True' ELSE 'False' END || ')' END, CASE WHEN z % 3 > 0 THEN (z % 3) || ' table candidate(s) detected' END,
  CASE WHEN needs_complex_tables THEN 'structurally complex table(s) (merged=' || CASE WHEN z % 11 = 0 THEN 'True' ELSE 'False' END || ', nested=False, max_columns=' || z % 10 || ')' END,
  CASE WHEN z % 5 > 0 OR z % 4 > 0 OR k % 17 = 0 THEN 'non-text visual objects detected' END, CASE WHEN needs_visual_semantics THEN 'candidate visuals may carry meaning beyond extracted text (Stage 3)' END) AS rationale FROM n""")
def routing_rationale(spark, sf_dir):
    return routing.requirements(part_profiles(spark, sf_dir)).select("p_partkey", F.array_join("rationale", " | ").alias("rationale"))


# Intake: pages as files, some empty, hidden, misnamed or too large


INTAKE_SQL = """f AS (SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'p' || page_id || '.html' WHEN 1 THEN '_p' || page_id || '.HTM' WHEN 2 THEN 'deep/er/p' || page_id WHEN 3 THEN 'p' || page_id || '.pdf' WHEN 4 THEN 'p' || page_id || '.docx' ELSE '.p' || page_id || '.txt' END AS name,
  encode(CASE page_id % 6 WHEN 2 THEN '<html>' || html WHEN 4 THEN '' WHEN 5 THEN 'text ' || html ELSE html END) AS bytes FROM pages),
i AS (SELECT *, CASE page_id % 6 WHEN 3 THEN 'pdf' WHEN 4 THEN 'docx' WHEN 5 THEN NULL ELSE 'html' END AS document_type, octet_length(bytes) AS n FROM f),
j AS (SELECT *, CASE WHEN n = 0 THEN 'empty' WHEN n > 6000 THEN 'too_large' WHEN document_type IS NULL THEN 'unsupported' END AS reject_reason FROM i)"""


@query(f"""WITH {INTAKE_SQL} SELECT name, document_type, CAST(n AS BIGINT) AS length, reject_reason, CASE WHEN reject_reason IS NULL THEN sha256(bytes) END AS job_id, CASE reject_reason WHEN 'too_large' THEN 'DocumentTooLargeError' WHEN 'empty' THEN 'DocumentError' WHEN 'unsupported' THEN 'DocumentError' END AS error_class,
  CASE WHEN reject_reason IS NULL THEN n END AS content_bytes FROM j""")
def document_intake(spark, sf_dir):
    k, name = F.col("page_id") % 6, F.concat(F.lit("p"), F.col("page_id").cast("string"))
    named = F.when(k == 0, F.concat(name, F.lit(".html"))).when(k == 1, F.concat(F.lit("_"), name, F.lit(".HTM"))).when(k == 2, F.concat(F.lit("deep/er/"), name)).when(k == 3, F.concat(name, F.lit(".pdf"))).when(k == 4, F.concat(name, F.lit(".docx"))).otherwise(F.concat(F.lit("."), name, F.lit(".txt")))
    text = F.when(k == 2, F.concat(F.lit("<html>"), "html")).when(k == 4, "").when(k == 5, F.concat(F.lit("text "), "html")).otherwise(F.col("html"))
    root = work_dir(spark, "intake")
    document_sink.publish(table(spark, sf_dir, "pages").select(named.alias("name"), text.alias("text")), root)
    rows = files.scan_documents(spark, root, recursive=True, max_bytes=6000)
    shown = F.regexp_replace("path", r"^.*/intake-[0-9a-f]+/", "")
    return rows.select(shown.alias("name"), "document_type", "length", "reject_reason", "job_id", F.col("error.class").alias("error_class"), F.length("content").cast("long").alias("content_bytes"))


@query(f"""WITH {MD_SQL} SELECT 'c' || conv_id || '/output/c' || conv_id || '.md' AS name, md5(md) AS digest FROM md""")
def markdown_published(spark, sf_dir):
    """Each conversation as a file, its turns appended in order; read again from the files."""
    turns = table(spark, sf_dir, "conversations")
    head = F.concat(F.repeat(F.lit("#"), (F.col("turn") % 3 + 1).cast("int")), F.lit(" "), F.col("role"), F.lit(" "), F.col("turn").cast("string"), F.lit("\n\n"), F.col("text"))
    place = F.row_number().over(W.partitionBy("conv_id").orderBy("turn", "role", "text"))
    stem = F.concat(F.lit("c"), F.col("conv_id").cast("string"))
    rows = turns.select(F.concat(stem, F.lit("/output/"), stem, F.lit(".md")).alias("name"), place.alias("place"), head.alias("head"))
    root = work_dir(spark, "markdown")
    document_sink.publish_pages(rows.select("name", "place", F.concat(F.when(F.col("place") > 1, F.lit("\n\n")).otherwise(F.lit("")), "head").alias("text")), root, "place")
    found = files.scan_markdown(spark, root, recursive=True)
    return found.select(F.regexp_replace("source_path", r"^.*/markdown-[0-9a-f]+/", "").alias("name"), F.md5("md").alias("digest"))


# Stores and replay


def engine_windows(spark, sf_dir, size: int = 2) -> DataFrame:
    """Windows of the engines' pages, as a run would have recorded them."""
    rows = engine_pages(spark, sf_dir).select(F.col("job_id").cast("string").alias("job_id"), "page_number")
    counts = rows.groupBy("job_id").agg(F.max("page_number").alias("n")).select("job_id", "n", F.posexplode(F.sequence(F.lit(1), F.col("n").cast("int"), F.lit(size))).alias("k", "start_page"))
    return counts.select("job_id", F.col("k").cast("long").alias("window_index"), F.col("start_page").cast("long").alias("start_page"), F.least(F.col("start_page") + size - 1, F.col("n")).cast("long").alias("end_page"), F.concat(F.lit("w"), F.col("k").cast("string")).alias("result_dir"), F.lit("mineru").alias("engine_used"), F.lit(None).cast("string").alias("backend_used"), F.lit("2024-01-01T00:00:00").alias("completed_at"))


STORE_SQL = f"""{ENGINE_SQL}, n AS (SELECT job_id, count(*) AS n FROM g GROUP BY 1), w AS (SELECT job_id, n, unnest(range(0, (n + 1) // 2)) AS k FROM n),
p AS (SELECT job_id, k, least(2 * k + 2, n) AS end_page, min(CASE WHEN (job_id + k) % 5 = 0 AND least(2 * k + 2, n) = 2 * k + 2 THEN 0 ELSE 1 END) OVER (PARTITION BY job_id ORDER BY k) AS ok FROM w),
s AS (SELECT job_id, sum(1 - ok) AS gone, coalesce(max(CASE WHEN ok = 1 THEN end_page END), 0) AS done FROM p GROUP BY job_id),
l AS (SELECT job_id, CASE WHEN job_id % 7 = 0 THEN 'missing' WHEN job_id % 7 = 1 THEN 'corrupt' ELSE 'ok' END AS status, CASE WHEN job_id % 7 > 1 THEN done ELSE 0 END AS done, CASE WHEN job_id % 7 > 1 THEN gone ELSE 0 END AS gone FROM s)"""


def stored_run(spark, sf_dir) -> tuple[DataFrame, ledger.Ledger, PageStore]:
    """Jobs, and the ledger and store of a run that broke off: of some full windows the second page was not stored; some jobs were never saved, the checkpoints of others were cut short."""
    windows = engine_windows(spark, sf_dir)
    store = PageStore(spark, work_dir(spark, "pages"), "job_id string, window_index long, page_number long, engine string, duration_ms long")
    rows = engine_pages(spark, sf_dir).select(F.col("job_id").cast("string").alias("job_id"), F.floor((F.col("page_number") - 1) / 2).alias("window_index"), "page_number", "engine", F.col("duration_ms").cast("long").alias("duration_ms"))
    lost = ((F.col("job_id").cast("long") + F.col("window_index")) % 5 == 0) & (F.col("page_number") % 2 == 0)
    store.write(rows.filter(~lost), windows)
    book = ledger.Ledger(spark, work_dir(spark, "ledger"))
    states = ledger.checkpoint_states(windows)
    kind = F.col("job_id").cast("long") % 7
    first = book.save(states.filter(kind != 0), 0)
    book.save(states.filter(kind == 1).withColumn("state", F.left("state", F.lit(40))), first)
    return windows.select("job_id").distinct(), book, store


@query(f"WITH {STORE_SQL} SELECT CAST(job_id AS VARCHAR) AS job_id, status, done > 0 AS is_resume, CAST(done AS BIGINT) AS last_completed_page, CAST(done + 1 AS BIGINT) AS resume_from_page, CAST(gone AS BIGINT) AS discarded_windows, CASE WHEN status = 'corrupt' THEN 'CheckpointCorruptedError' END AS error_class FROM l")
def checkpoint_resume(spark, sf_dir):
    jobs, book, store = stored_run(spark, sf_dir)
    return ledger.resume_plans(jobs, book, store.present()).select("job_id", "status", "is_resume", "last_completed_page", "resume_from_page", "discarded_windows", F.col("error.class").alias("error_class"))


@query(f"""WITH {STORE_SQL} SELECT CAST(g.job_id AS VARCHAR) AS job_id, page_number, page_number <= done AS is_replayed, CASE WHEN page_number <= done THEN engine ELSE 'again' END AS engine, CASE WHEN page_number <= done THEN CAST(ms AS BIGINT) ELSE CAST(0 AS BIGINT) END AS duration_ms,
  row_number() OVER (PARTITION BY g.job_id ORDER BY page_number) AS position FROM g JOIN l ON l.job_id = g.job_id""")
def store_replay(spark, sf_dir):
    """The pages that the plan keeps come from the store's files; the rest are extracted again."""
    jobs, book, store = stored_run(spark, sf_dir)
    plan = conversion.kept(ledger.resume_plans(jobs, book, store.present()).select("job_id", "last_completed_page"), "plan")
    again = engine_pages(spark, sf_dir).select(F.col("job_id").cast("string").alias("job_id"), "page_number", F.lit("again").alias("engine"), F.lit(0).cast("long").alias("duration_ms"))
    return pages.replayed(store.pages().drop("window_index"), again, plan).select("job_id", "page_number", "is_replayed", "engine", "duration_ms", "position")


# Engines


@query("""WITH d AS (SELECT CAST(doc_id AS VARCHAR) AS job_id, coalesce(text, '') AS text, CAST(greatest(1, ceil(length(coalesce(text, '')) / 1000)) AS BIGINT) AS n FROM documents),
w AS (SELECT job_id, text, n, unnest(range(0, (n + 1) // 2)) AS k FROM d), p AS (SELECT job_id, k, unnest(range(2 * k + 1, least(2 * k + 2, n) + 1)) AS page, text FROM w),
x AS (SELECT *, substr(text, CAST(1000 * (page - 1) + 1 AS BIGINT), 1000) AS md FROM p), b AS (SELECT job_id, min(k) AS broken FROM x WHERE contains(md, 'ess') GROUP BY 1)
SELECT x.job_id, k AS window_index, page AS page_number, CASE WHEN broken IS NULL OR k < broken THEN 'first' ELSE 'second' END AS engine, NOT (broken IS NULL OR k < broken) AS is_degraded, md5(md) AS digest FROM x LEFT JOIN b ON b.job_id = x.job_id""")
def engine_fallback(spark, sf_dir):
    """Documents as pages of 1,000 characters in windows of two; the first engine can't convert a certain syllable."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("job_id"), F.coalesce("text", F.lit("")).alias("source"))
    total = F.greatest(F.lit(1), F.ceil(F.length("source") / 1000)).cast("int")
    starts = docs.select("job_id", "source", total.alias("n"), F.posexplode(F.sequence(F.lit(1), total, F.lit(2))).alias("window_index", "start_page"))
    windows = starts.select("job_id", "window_index", "start_page", F.least(F.col("start_page") + 1, F.col("n")).alias("end_page"), F.substring("source", 1000 * (F.col("start_page") - 1) + 1, F.lit(2000)).alias("source"))
    found = engines.with_fallback(windows, engines.TextEngine("first", 1000, breaks_on="ess"), engines.TextEngine("second", 1000))
    return found.filter("error IS NULL").select("job_id", "window_index", "page_number", "engine", "is_degraded", F.md5("markdown").alias("digest"))


@query(r"""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'a <!-- figure --> b  c <!-- figure --> ' || p_name WHEN 2 THEN p_name || ' <!-- figure -->' ELSE p_name END AS markdown,
  CASE p_partkey % 4 WHEN 1 THEN hex(encode('pic ' || p_partkey)) || ',' || hex(encode(p_brand)) WHEN 2 THEN hex(encode(p_brand)) ELSE '' END AS figures FROM part""")
def engine_responses(spark, sf_dir):
    """Answers of a page server: images under their names, links to images that it did not return, no result at all."""
    k = F.col("p_partkey")
    data = lambda text: F.concat(F.lit("data:image/png;base64,"), F.base64(F.encode(text, "utf-8")))
    two = F.to_json(F.struct(F.create_map(F.lit("file"), F.struct(F.concat(F.lit("a ![](images/x.png) b ![gone](images/none.png) c ![y](y.png) "), "p_name").alias("md_content"), F.create_map(F.lit("x.png"), data(F.concat(F.lit("pic "), k.cast("string"))), F.lit("y.png"), data(F.col("p_brand"))).alias("images"))).alias("results")))
    whole = F.to_json(F.struct(F.create_map(F.lit("file"), F.struct(F.concat("p_name", F.lit(" ![](deep/er/z.png)")).alias("md_content"), F.create_map(F.lit("deep/er/z.png"), data(F.col("p_brand")), F.lit("z.png"), F.lit("!!")).alias("images"))).alias("results")))
    plain = F.to_json(F.struct(F.create_map(F.lit("file"), F.struct(F.col("p_name").alias("md_content"))).alias("results")))
    response = F.when(k % 4 == 0, '{"results": {}}').when(k % 4 == 1, two).when(k % 4 == 2, whole).otherwise(plain)
    page = table(spark, sf_dir, "part").select("p_partkey", engines.page_of_response(response).alias("page"))
    return page.select("p_partkey", "page.markdown", F.array_join(F.transform("page.figures", F.hex), ",").alias("figures"))


BLANK = " chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31) || ' ' || chr(133) || chr(160) "


@query(f"""WITH {HTML_SQL}, s AS (SELECT sha256(html) AS job_id, k.pages AS n, unnest(range(1, k.pages + 1)) AS page, html FROM pages JOIN k USING (page_id)),
x AS (SELECT DISTINCT job_id, n, page, trim(regexp_replace(regexp_replace(substr(html, 1500 * (page - 1) + 1, 1500), '\\r\\n?', chr(10), 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g'), {BLANK}) AS md FROM s)
SELECT job_id, CAST(n AS BIGINT) AS total_pages, md5(string_agg(trim(regexp_replace(regexp_replace(md, '[ \\t]+\\n', chr(10), 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g'), chr(10)) || chr(10), chr(10) ORDER BY page)) AS digest FROM x GROUP BY job_id, n""")
def conversion_run(spark, sf_dir):
    """Web pages as files, from the scan to the published documents, which are read again."""
    root, out, state = work_dir(spark, "sources"), work_dir(spark, "converted"), work_dir(spark, "state")
    document_sink.publish(table(spark, sf_dir, "pages").select(F.concat(F.lit("p"), F.col("page_id").cast("string"), F.lit(".html")).alias("name"), F.col("html").alias("text")), root)
    done = conversion.convert(spark, root, out, state, {"docling": engines.FileEngine("docling", 1500)}, None, lambda sha: F.lit(None).cast("string"))
    published = done.filter("error IS NULL").select("job_id", "total_pages", F.col("output").alias("name")).distinct()
    return files.read_markdown(published, out).select("job_id", "total_pages", F.md5("md").alias("digest"))


# Responses of models


RESPONSE_SQL = """r AS (SELECT p_partkey AS k, CASE p_partkey % 9 WHEN 0 THEN 'not_json' WHEN 1 THEN 'not_an_object' WHEN 2 THEN 'figure_type: missing; confidence: type' WHEN 3 THEN 'legibility: not_allowed; confidence: out_of_range; note: unexpected'
  WHEN 4 THEN 'informative_mismatch' WHEN 5 THEN 'strategy_not_allowed' WHEN 6 THEN 'markdown_result: empty' WHEN 7 THEN 'decorative_but_informative' ELSE '' END AS problems FROM part)"""


def model_responses(spark, sf_dir) -> DataFrame:
    k = F.col("p_partkey") % 9
    fields = dict(figure_type="chart", rendering_strategy="plain_text_explanation", legibility="clear", document_domain="legal")
    base = {name: F.lit(v) for name, v in fields.items()} | {"is_informative": F.lit(True), "markdown_result": F.col("p_name"), "confidence": F.lit(0.5)}
    of = lambda **x: F.to_json(F.struct(*[v.alias(n) for n, v in (base | x).items() if v is not None]))
    text = F.when(k == 0, F.left(of(), F.lit(20))).when(k == 1, "[1, 2]").when(k == 2, of(figure_type=None, confidence=F.lit("high"))).when(k == 3, of(legibility=F.lit("good"), confidence=F.lit(2), note=F.lit("x"))).when(k == 4, of(is_informative=F.lit(False)))
    text = text.when(k == 5, of(rendering_strategy=F.lit("fenced_code_block"))).when(k == 6, of(markdown_result=F.lit(" \n"))).when(k == 7, of(figure_type=F.lit("decorative"))).otherwise(of(markdown_result=F.concat(F.lit("  "), "p_name", F.lit("\n"))))
    return dealt(table(spark, sf_dir, "part"), "p_partkey").select("p_partkey", "p_name", text.alias("response"))


@query(f"WITH {RESPONSE_SQL} SELECT k AS p_partkey, problems, CASE WHEN problems = '' THEN p_name END AS markdown_result, CASE WHEN problems <> '' THEN 'FigureSummarizationError' END AS error_class FROM r JOIN part ON p_partkey = k")
def response_validation(spark, sf_dir):
    rows = responses.checked(model_responses(spark, sf_dir), "response")
    listed = F.array_join(F.transform("problems", lambda p: F.concat_ws(": ", p["field"], p["problem"])), "; ")
    return rows.select("p_partkey", listed.alias("problems"), F.col("summary.markdown_result").alias("markdown_result"), F.col("error.class").alias("error_class"))


@query(f"WITH {RESPONSE_SQL} SELECT problems, count(*) AS n FROM (SELECT unnest(string_split(problems, '; ')) AS problems FROM r WHERE problems <> '') GROUP BY 1")
def response_problems(spark, sf_dir):
    rows = responses.checked(model_responses(spark, sf_dir), "response").select(F.explode("problems").alias("p"))
    return rows.select(F.concat_ws(": ", "p.field", "p.problem").alias("problems")).groupBy("problems").agg(F.count("*").alias("n"))


@query("""WITH f AS (SELECT p_partkey, sha256(p_brand || p_type) AS sha, p_partkey % 2 AS run FROM part), g AS (SELECT *, sha NOT LIKE 'f%' AS good, min(run) OVER (PARTITION BY sha) AS first_run, row_number() OVER (PARTITION BY run, sha ORDER BY p_partkey) AS n FROM f)
SELECT run AS run, p_partkey, sha AS sha256, CASE WHEN good THEN 'about ' || left(sha, 8) END AS markdown_result, good AND run = first_run AND n = 1 AS is_new FROM g""")
def summary_runs(spark, sf_dir):
    """Two runs with one store: the second summarises only contents that the first has not; an answer that is no JSON is not stored."""
    rows = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_partkey") % 2).cast("long").alias("run"), F.lit("j").alias("job_id"), F.col("p_partkey").alias("page_number"), F.lit(0).alias("index_on_page"), F.col("p_partkey").cast("string").alias("token"), F.sha2(F.concat("p_brand", "p_type"), 256).alias("sha256"))
    store = VersionedTable(spark, work_dir(spark, "summaries"), "sha256 string, json string", ["sha256"])

    def provider(sha):
        text = F.concat(F.lit("about "), F.left(sha, F.lit(8)))
        answer = F.struct(F.lit("other").alias("figure_type"), F.lit("plain_text_explanation").alias("rendering_strategy"), F.lit(True).alias("is_informative"), text.alias("markdown_result"), F.lit("clear").alias("legibility"), F.lit(0.9).alias("confidence"), F.lit("legal").alias("document_domain"))
        return F.when(sha.startswith("f"), "sorry").otherwise(F.to_json(answer))

    first = figures.summarised(rows.filter("run = 0"), store, provider)
    kept = work_dir(spark, "first-run")
    first.write.parquet(kept)  # before the second run writes to the store
    both = spark.read.parquet(kept).unionByName(figures.summarised(rows.filter("run = 1"), store, provider))
    return both.select("run", "p_partkey", "sha256", F.get_json_object("json", "$.markdown_result").alias("markdown_result"), "is_new")


@query("""WITH p AS (SELECT unnest(range(1, 8)) AS page), x AS (SELECT p_size % 10 AS job_id, p_partkey AS picture, p_partkey % 7 + 1 AS a, p_size % 7 + 1 AS b FROM part WHERE p_partkey % 11 <> 0),
y AS (SELECT DISTINCT job_id, picture, page_number FROM (SELECT job_id, picture, a AS page_number FROM x UNION ALL SELECT job_id, picture, b FROM x) WHERE page_number <> 4)
SELECT CAST(job_id AS BIGINT) AS job_id, CAST(picture AS BIGINT) AS picture, CAST(page_number AS BIGINT) AS page_number, row_number() OVER (PARTITION BY job_id, page_number ORDER BY picture) - 1 AS index_on_page FROM y""")
def page_figures(spark, sf_dir):
    """Pictures that lie on two pages, or on one named twice; page 4 was not extracted."""
    k, z = F.col("p_partkey"), F.col("p_size")
    pictures = table(spark, sf_dir, "part").select((z % 10).cast("long").alias("job_id"), k.cast("long").alias("picture"), F.when(k % 11 != 0, F.encode("p_name", "utf-8")).alias("image"), F.array(k % 7 + 1, z % 7 + 1).cast("array<long>").alias("provenance"))
    there = pictures.select("job_id", F.explode(F.sequence(F.lit(1), F.lit(7)).cast("array<long>")).alias("page_number")).distinct().filter("page_number <> 4")
    return figures.page_figures(pictures, there).select("job_id", "picture", "page_number", "index_on_page")


@query("""WITH l AS (SELECT lang, regexp_replace(unnest(string_split(regexp_replace(text, chr(10) || '$', ''), chr(10))), '^\\s+|\\s+$', '', 'g') AS warning FROM documents WHERE text <> '')
SELECT lang, md5(warning) AS warning, count(*) AS n FROM l WHERE warning <> '' GROUP BY lang, warning""")
def line_histogram(spark, sf_dir):
    """Lines of all documents of a language, as if they were a tool's warnings."""
    return analytics.warning_histogram(table(spark, sf_dir, "documents"), "lang", "text").select("lang", F.md5("warning").alias("warning"), "n")


@query("""SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'BASE' || chr(10) || '---' || chr(10) || 'About law.' || chr(10) ELSE 'BASE' END AS system, CASE WHEN p_size % 4 > 1 THEN 'The previous response was empty.  Convert this figure to Markdown now.  Return ONLY the Markdown — no preamble, no JSON.' ELSE 'Convert this figure to Markdown now.' END AS question,
  CASE WHEN p_size % 3 = 0 THEN 'legal' WHEN p_size % 3 = 1 THEN 'educational' ELSE 'clinical' END AS domain FROM part""")
def figure_prompts(spark, sf_dir):
    z = F.col("p_size")
    domain = F.when(z % 3 == 0, "legal").when(z % 3 == 1, "auto").otherwise("clinical")
    return table(spark, sf_dir, "part").select("p_partkey", responses.system_prompt("BASE", {"legal": "About law.", "clinical": ""}, domain).alias("system"), responses.user_prompt(z % 4).alias("question"), figures.effective_domain(domain).alias("domain"))


@query(r"""SELECT p_partkey, contains(lower(m), 'out of memory') OR contains(lower(m), 'oom') OR contains(lower(m), 'cuda error') AS is_exhaustion, CASE WHEN p_partkey % 2 = 0 THEN 'out/given.md' ELSE 'out/' || p_partkey || '_chunked.md' END AS output_name
FROM (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'CUDA Error: device' WHEN 1 THEN 'no room left' WHEN 2 THEN 'Out of Memory' ELSE p_name END AS m FROM part)""")
def engine_failures(spark, sf_dir):
    k = F.col("p_partkey")
    message = F.when(k % 5 == 0, "CUDA Error: device").when(k % 5 == 1, "no room left").when(k % 5 == 2, "Out of Memory").otherwise(F.col("p_name"))
    name = T.output_name(F.concat(F.lit("out/"), k.cast("string"), F.lit(".md")), F.when(k % 2 == 0, "given.md"))
    return table(spark, sf_dir, "part").select("p_partkey", T.is_exhaustion(message, F.lit(None).cast("string")).alias("is_exhaustion"), name.alias("output_name"))


@query(r"""WITH t AS (SELECT p_partkey AS k, '${FIG:' || replace(p_brand, '#', ' ') || ':' || lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0') || ':' || p_size || '}' AS token, CASE p_partkey % 4 WHEN 0 THEN 'out/B' || p_partkey || '/output.md' WHEN 1 THEN 'a/test_out/B' || p_partkey || '/x.md' WHEN 2 THEN 'out/output.md' ELSE 'x/B' || p_partkey END AS path FROM part)
SELECT k AS p_partkey, token, starts_with(token, '${FIG:') AS is_figure, FALSE AS is_table, regexp_replace(regexp_replace(token, '[^0-9A-Za-z_-]+', '__', 'g'), '^_+|_+$', '', 'g') AS filename, CASE WHEN k % 4 < 2 THEN 'B' || k END AS stem,
  CAST(CASE k % 5 WHEN 0 THEN p_size WHEN 1 THEN 2147483647 ELSE 1 END AS INT) AS span, p_size / greatest(CAST(k % 7 AS DOUBLE), 1.0) AS share FROM t JOIN part ON p_partkey = k""")
def token_helpers(spark, sf_dir):
    k, z = F.col("p_partkey"), F.col("p_size")
    token = T.figure_token(F.replace(F.col("p_brand"), F.lit("#"), F.lit(" ")), k % 1000, z)
    name = F.concat(F.lit("B"), k.cast("string"))
    path = F.when(k % 4 == 0, F.concat(F.lit("out/"), name, F.lit("/output.md"))).when(k % 4 == 1, F.concat(F.lit("a/test_out/"), name, F.lit("/x.md"))).when(k % 4 == 2, "out/output.md").otherwise(F.concat(F.lit("x/"), name))
    span = F.when(k % 5 == 0, z.cast("string")).when(k % 5 == 1, "9" * 30).when(k % 5 == 2, "000").when(k % 5 == 3, "-2")
    return table(spark, sf_dir, "part").select("p_partkey", token.alias("token"), T.is_token(token).alias("is_figure"), T.is_token(token, "TBL").alias("is_table"), T.token_filename(token).alias("filename"), T.pdf_stem(path).alias("stem"), T.span_of(span).alias("span"), T.area_fraction(z.cast("double"), (k % 7).cast("double")).alias("share"))


# Streams


def streamed(spark, batches: list[DataFrame], schema: str, name: str) -> DataFrame:
    """A stream that gives the rows of batches, one after another. A batch of many files is one micro-batch, so that more rows are not more micro-batches, in each of which most jobs have their state read and written."""
    root = work_dir(spark, name)
    for k, rows in enumerate(batches):
        rows.write.parquet(f"{root}/batch={k}")
    most = max(len(Files(spark).names(f"{root}/batch={k}")) for k in range(len(batches)))
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", max(64, most)).parquet(root)


def drained(stream: DataFrame, name: str) -> DataFrame:
    """What a stream gives until its input is used up, from the files that it has written."""
    spark = stream.sparkSession
    out, checkpoint = work_dir(spark, name), work_dir(spark, f"{name}-checkpoint")
    with rocksdb(spark):
        started = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    started.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


#: Pages of a stream whose jobs share a state.
BUCKET_PAGES = 10_000


def buckets_for(spark, pages: int) -> int:
    """How many states the jobs of so many pages are dealt to: several for each task at least."""
    return max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-pages // BUCKET_PAGES))


def in_batches(rows: DataFrame, n: int = 3) -> list[DataFrame]:
    """Rows dealt to batches by their arrival, then the end rows of all jobs. What makes the rows is done once."""
    rows = conversion.kept(rows, "arriving")
    ends = rows.select("job_id").distinct().select("job_id", *[F.lit(None).cast(t).alias(c) for c, t in rows.dtypes if c not in ("job_id", "arrival")], F.lit(10**9).cast("long").alias("arrival"))
    dealt = [rows.filter(F.col("arrival") % n == k) for k in range(n)]
    return [r.select(*rows.columns) for r in (*dealt, ends)]


@query("""WITH a AS (SELECT CAST(user_id AS VARCHAR) AS job_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS page_number, event_id, (event_id * 7919) % 10007 AS arrival FROM events)
SELECT job_id, page_number, page_number AS position, CAST(arrival AS BIGINT) AS arrival, 'page ' || event_id AS text FROM a""")
def stream_reorder(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("job_id"), F.row_number().over(W.partitionBy("user_id").orderBy("ts", "event_id")).cast("long").alias("page_number"), (F.col("event_id") * 7919 % 10007).cast("long").alias("arrival"), F.concat(F.lit("page "), F.col("event_id").cast("string")).alias("text")
    )
    stream = streamed(spark, in_batches(rows), "job_id string, page_number long, arrival long, text string", "arrivals")
    return drained(ordered_pages(stream), "reordered").select("job_id", "page_number", "position", "arrival", "text")


@query(f"""WITH {ORDER_SQL}, x AS (SELECT job_id, page, token, tbl, o_orderkey % 3 < 2 AS is_fragment, (page - 1) // 3 * 3 + 1 AS start_page FROM t),
c AS (SELECT *, coalesce(sum(CASE WHEN is_fragment THEN 0 ELSE 1 END) OVER (PARTITION BY job_id, start_page ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chain FROM x)
SELECT job_id, start_page, CAST(chain AS BIGINT) AS chain, max(page) AS page_number, max(CASE WHEN NOT is_fragment THEN token END) AS token, md5(string_agg(tbl, chr(10) ORDER BY page)) AS digest, bool_or(NOT is_fragment) AS closed FROM c GROUP BY job_id, start_page, chain""")
def stream_fragments(spark, sf_dir):
    """Tables of a customer's orders that go on over three pages, from pages that come in any order."""
    found = pages.with_table_tokens(order_pages(spark, sf_dir), text=False).withColumn("t", F.element_at("tables", 1))
    order = F.regexp_extract("markdown", r"## Order (\d+)", 1).cast("long")
    start = F.floor((F.col("page_number") - 1) / 3) * 3 + 1
    one = F.struct(F.col("t.token").alias("token"), F.col("t.markdown").alias("markdown"), (order % 3 < 2).alias("is_fragment"), start.alias("start_page"))
    rows = found.select("job_id", F.col("page_number").cast("long").alias("page_number"), (order * 7919 % 10007).alias("arrival"), F.array(one).alias("tables"))
    batches = in_batches(rows)
    stream = streamed(spark, batches, "job_id string, page_number long, arrival long, tables array<struct<token:string,markdown:string,is_fragment:boolean,start_page:long>>", "fragments")
    buckets = buckets_for(spark, sum(b.count() for b in batches[:-1]))
    return drained(merged_tables_stream(stream, buckets), "merged").select("job_id", "start_page", "chain", "page_number", "token", F.md5("markdown").alias("digest"), "closed")


@query("""WITH f AS (SELECT user_id AS job_id, event_id AS page_number, event_id % 4 AS n FROM events), x AS (SELECT job_id, page_number, unnest(range(0, n)) AS i FROM f)
SELECT CAST(job_id AS VARCHAR) AS job_id, count(*) AS pages, CAST(sum(n) AS BIGINT) AS figures, (SELECT count(DISTINCT (page_number, i)) FROM x WHERE x.job_id = f.job_id) AS tokens FROM f GROUP BY job_id""")
def stream_fan_out(spark, sf_dir):
    """Events as pages with up to three figures; the second batch is run twice."""
    rows = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("job_id"), F.col("event_id").cast("long").alias("page_number"))
    token = F.transform(F.sequence(F.lit(1), F.lit(3)), lambda i: F.struct(T.figure_token(F.col("job_id"), F.col("page_number"), i - 1).alias("token"), F.sha2(F.col("page_number").cast("string"), 256).alias("sha256")))
    rows = rows.withColumn("figures", F.slice(token, F.lit(1), (F.col("page_number") % 4).cast("int")))
    batches = [rows.filter(F.col("page_number") % 2 == k) for k in range(2)]
    stream = streamed(spark, batches, "job_id string, page_number long, figures array<struct<token:string,sha256:string>>", "fan-out")
    to_figures, to_pages = work_dir(spark, "figures"), work_dir(spark, "pages")
    fanout.fan_out(stream, to_figures, to_pages, work_dir(spark, "fan-out-checkpoint"), availableNow=True).awaitTermination()
    last = spark.read.parquet(to_pages).agg(F.max("batch_id")).first()[0]
    if last is not None:
        again = spark.read.parquet(to_pages).filter(F.col("batch_id") == last).drop("batch_id").join(rows, ["job_id", "page_number"])
        again.write.parquet(copy := work_dir(spark, "again"))
        fanout.tee(spark.read.parquet(copy), last, to_figures, to_pages)
    counts = spark.read.parquet(to_figures).groupBy("job_id").agg(F.count("*").alias("figures"), F.count_distinct("token").alias("tokens"))
    return spark.read.parquet(to_pages).groupBy("job_id").agg(F.count("*").alias("pages")).join(counts, "job_id", "left").na.fill(0, ["figures", "tokens"])
