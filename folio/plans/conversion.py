"""A whole run: files to profiles, engines, windows of pages, figures, and one Markdown document each, which can be broken off and resumed."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.functions import text as T
from folio.operators import figures, pages, routing, windows
from folio.operators.errors import error, first_error, passed
from folio.operators.profiles import profiled
from folio.operators.responses import checked
from folio.sources import document_sink, engines, files, ledger
from folio.sources.page_store import PageStore
from folio.sources.shared import work_dir
from folio.sources.versioned import VersionedTable
from folio.sources.vision import Vision

TABLE = "array<struct<token:string,page_number:int,markdown:string,is_fragment:boolean,start_page:int>>"
STORED = f"job_id string, window_index long, page_number long, markdown_with_tokens string, tables {TABLE}, figures array<struct<token:string,sha256:string,image:binary>>, engine string, is_degraded boolean, duration_ms long"


def kept(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again, so that what made it is not done twice."""
    path = work_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def prescan(spark: SparkSession, root: str, recursive: bool = False, forced: str | None = None, extractors=None) -> DataFrame:
    """The first stage alone: path, job_id, document_type, error, the profile, its requirements and the engine of each file under root."""
    found = profiled(files.scan_documents(spark, root, recursive), extractors).withColumnRenamed("error", "scan_error")
    routed = routing.routed(routing.requirements(found), forced)
    good = F.col("scan_error").isNull()
    for c in ("engine", "backend", "confidence", "reason"):
        routed = routed.withColumn(c, F.when(good, F.col(c)))
    return routed.withColumn("error", first_error(F.col("scan_error"), F.col("error"))).drop("scan_error")


def new_pages(todo: DataFrame, primary: dict[str, engines.Engine], fallback: engines.Engine | None) -> DataFrame:
    """The pages of windows (job_id, window_index, start_page, end_page, source, engine), each from the engine of its document or from the fallback."""
    each = [engines.with_fallback(todo.filter(F.col("engine") == name).drop("engine"), engine, fallback if fallback is None or fallback.name != engine.name else None) for name, engine in primary.items()]
    return reduce(DataFrame.unionByName, each)


def tokenised(found: DataFrame) -> DataFrame:
    """STORED of extracted pages: figures and tables become tokens, figures their hashes."""
    rows = found.filter("error IS NULL").select("job_id", "window_index", "page_number", "markdown", "figures", "engine", "is_degraded", "duration_ms")
    rows = pages.page_results(rows)
    marked = F.transform("figures", lambda b, i: F.struct(T.figure_token(F.col("job_id"), F.col("page_number"), i).alias("token"), F.sha2(b, 256).alias("sha256"), b.alias("image")))
    return rows.withColumn("figures", marked).withColumn("tables", F.col("tables").cast(TABLE)).select("job_id", "window_index", "page_number", "markdown_with_tokens", "tables", "figures", "engine", "is_degraded", "duration_ms")


def pictures(stored: DataFrame) -> DataFrame:
    """The figures of stored pages: job_id, page_number, index_on_page, token, sha256, image."""
    return stored.select("job_id", "page_number", F.posexplode("figures").alias("index_on_page", "f")).select("job_id", "page_number", "index_on_page", "f.*")


def with_figures(stored: DataFrame, summaries: VersionedTable, provider: Callable[[Column], Column] | Vision) -> tuple[DataFrame, DataFrame]:
    """The pages with their figures' texts in place of the tokens, and the counters of each job's figures."""
    rows = kept(checked(figures.summarised(pictures(stored), summaries, provider).drop("image"), "json", ("token",)), "figures")
    text = F.when(F.col("summary").isNull(), T.PLACEHOLDER).when(F.col("summary.is_informative"), F.col("summary.markdown_result")).otherwise("")
    status = F.when(F.col("summary").isNull(), "failed").when(F.col("is_new"), "summarized").otherwise("deduplicated")
    rows = rows.select("job_id", "page_number", "index_on_page", "token", text.alias("text"), status.alias("status"))
    by_page = rows.groupBy("job_id", "page_number").agg(F.array_sort(F.collect_list(F.struct("index_on_page", "token", "text"))).alias("r"))
    joined = stored.join(by_page, ["job_id", "page_number"], "left")
    put = pages.substitute(F.col("markdown_with_tokens"), F.transform("r", lambda x: F.struct(x["token"].alias("token"), x["text"].alias("text"))))
    return joined.withColumn("markdown_with_tokens", F.coalesce(put, "markdown_with_tokens")).drop("r"), figures.counters(rows)


def convert(spark: SparkSession, root: str, out: str, state: str, primary: dict[str, engines.Engine], fallback: engines.Engine | None, provider: Callable[[Column], Column] | Vision, *, recursive: bool = False, forced: str | None = None, window: int = 8, extractors=None) -> DataFrame:
    """Convert every file under root to `<job_id>/output/<stem>.md` under out, with its pictures beside it; a row for each file: path, job_id, output, total_pages, engines_used, figures, error.

    state keeps the ledger, the pages and the summaries: a run over the same files goes on where one was broken off, and
    extracts and summarises nothing twice. A document is published whole or not at all; one of whose windows no engine can
    convert has an error. Files of equal content are one document, named after the first path.
    """
    scanned = kept(prescan(spark, root, recursive, forced, extractors), "prescan")
    stem = F.regexp_replace(F.regexp_extract("path", r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")
    jobs = passed(scanned).groupBy("job_id").agg(F.min(F.struct("path", stem.alias("stem"))).alias("p"), F.min("engine").alias("engine"), F.max("page_or_unit_count").cast("long").alias("total_pages"))
    jobs = kept(jobs.select("job_id", F.col("p.path").alias("source"), F.concat("job_id", F.lit("/output/"), F.col("p.stem"), F.lit(".md")).alias("output"), "engine", "total_pages"), "jobs")
    book, store = ledger.Ledger(spark, f"{state}/ledger"), PageStore(spark, f"{state}/pages", STORED)
    version = book.version()
    plan = ledger.resume_plans(jobs.select("job_id"), book, store.present()).select("job_id", "last_completed_page")
    every = windows.page_windows(jobs.withColumn("last_completed_page", F.lit(0)), window)
    todo = kept(windows.page_windows(jobs.join(plan, "job_id"), window).join(jobs.select("job_id", "source", "engine"), "job_id"), "windows")
    found = kept(new_pages(todo, primary, fallback), "extracted")
    store.write(tokenised(found), todo)
    done = kept(every.join(store.present(), ["job_id", "window_index"], "left_semi"), "done")
    record = done.join(jobs.select("job_id", F.col("engine").alias("engine_used")), "job_id").select("*", F.concat(F.lit("window_"), F.col("window_index").cast("string")).alias("result_dir"), F.lit(None).cast("string").alias("backend_used"), F.lit(None).cast("string").alias("completed_at"))
    version = book.save(ledger.checkpoint_states(record), version)
    counts = every.groupBy("job_id").agg(F.count("*").alias("windows")).join(done.groupBy("job_id").agg(F.count("*").alias("done")), "job_id")
    whole = kept(counts.filter("windows = done").select("job_id"), "whole")
    stored = kept(store.pages(done.join(whole, "job_id", "left_semi")), "pages")
    ready, counters = with_figures(stored, VersionedTable(spark, f"{state}/summaries", "sha256 string, json string", ["sha256"]), provider)
    documents = pages.assembled(ready).join(jobs.select("job_id", "output"), "job_id")
    figure = F.concat("job_id", F.lit("/output/figures/"), document_sink.figure_file(F.col("page_number"), F.col("index_on_page")))
    shown = pictures(stored).filter("image IS NOT NULL").select(figure.alias("name"), F.col("image").alias("data"))
    document_sink.publish(documents.select(F.col("output").alias("name"), F.encode("markdown", "utf-8").alias("data")).unionByName(shown), out)
    book.delete(whole, version)
    summary = kept(pages.conversion_summary(stored, counters), "summary")
    stuck = found.filter("error IS NOT NULL").groupBy("job_id").agg(F.min_by("error", "window_index").alias("stuck"))
    rows = scanned.select("path", "job_id", F.col("error").alias("scan_error")).join(jobs.select("job_id", "output"), "job_id", "left").join(summary, "job_id", "left").join(stuck, "job_id", "left")
    unfinished = F.when(F.col("total_pages").isNull(), first_error(F.col("stuck"), error("EngineError", "windows are missing", job_id=F.col("job_id"))))
    told = first_error(F.col("scan_error"), unfinished)
    return rows.withColumn("error", told).withColumn("output", F.when(told.isNull(), F.col("output"))).drop("scan_error", "stuck")
