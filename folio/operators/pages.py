"""Pages: tokens for tables and figures, substitution, table fragments and assembly of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folio.functions import text as T
from folio.operators.sections import let

#: Fixed value: what engines put where a figure is.
FIGURE_MARKER = "<!-- figure -->"


def table_runs(page_lines: Column) -> Column:
    """G-8: array<struct<first, last>> of the runs of lines with a bar, two lines at least, of which the second is a separator row."""
    state = "struct<at:int,first:int,out:array<struct<first:int,last:int>>>"

    def closed(s):
        return F.when(s["first"] >= 0, F.array_append(s["out"], F.struct(s["first"].alias("first"), (s["at"] - 1).alias("last")))).otherwise(s["out"])

    def step(s, line):
        bar = line.contains("|")
        return F.struct((s["at"] + 1).alias("at"), F.when(~bar, -1).when(s["first"] >= 0, s["first"]).otherwise(s["at"]).alias("first"), F.when(bar, s["out"]).otherwise(closed(s)).alias("out"))

    runs = F.aggregate(page_lines, F.struct(F.lit(0), F.lit(-1), F.array()).cast(state), step, closed)
    return F.filter(runs, lambda r: (r["last"] > r["first"]) & T.is_separator_row(F.get(page_lines, r["first"] + 1)))


def with_table_tokens(pages: DataFrame, *, text: bool = True) -> DataFrame:
    """G-9: pages (job_id, page_number, markdown) with markdown_with_tokens (not without text, of which most of the work is) and tables. Only a last table that nothing follows is a fragment."""

    def replaced(ls: Column, runs: Column, job: Column, page: Column) -> Column:
        def out(i):
            k = F.array_position(F.transform(runs, lambda r: r["first"]), i).cast("int")
            inside = F.exists(runs, lambda r: (r["first"] <= i) & (i <= r["last"]))
            return F.when(k > 0, T.table_token(job, page, k - 1)).when(~inside, F.get(ls, i))

        return F.array_join(F.filter(F.transform(F.sequence(F.lit(0), F.size(ls) - 1), out), lambda x: x.isNotNull()), "\n")

    def listed(ls: Column, runs: Column, job: Column, page: Column) -> Column:
        def one(r, k):
            rest = F.array_join(F.slice(ls, r["last"] + 2, F.size(ls)), "\n")
            return F.struct(
                T.table_token(job, page, k).alias("token"), page.cast("int").alias("page_number"), F.array_join(F.slice(ls, r["first"] + 1, r["last"] - r["first"] + 1), "\n").alias("markdown"),
                ((k == F.size(runs) - 1) & (T.strip(rest) == "")).alias("is_fragment"), page.cast("int").alias("start_page"),
            )

        return F.transform(runs, one)

    makers = {"markdown_with_tokens": replaced, "tables": listed} if text else {"tables": listed}
    rows = pages.withColumn("found", let(F.split("markdown", "\n", -1), lambda ls: let(table_runs(ls), lambda runs: F.struct(*[f(ls, runs, F.col("job_id"), F.col("page_number")).alias(n) for n, f in makers.items()]))))
    return rows.select(*pages.columns, *[F.col(f"found.{n}").alias(n) for n in makers])


def with_figure_tokens(markdown: Column, figures: Column, job: Column, page: Column) -> Column:
    """G-10: the k-th marker becomes the token of the k-th figure; markers without a figure go."""

    def of(parts):
        return F.array_join(F.transform(parts, lambda p, i: F.concat(F.when(i == 0, F.lit("")).when(i <= F.size(figures), T.figure_token(job, page, i - 1)).otherwise(F.lit("")), p)), "")

    return let(F.split(markdown, FIGURE_MARKER, -1), of)


def erase(text: Column, token: Column) -> Column:
    """One occurrence and a blank line beside it: the one after it, else the one before it, else the token alone."""

    def cut(t):
        return F.when(F.instr(text, t) > 0, F.concat(F.substring(text, F.lit(1), F.instr(text, t) - 1), F.substring(text, F.instr(text, t) + F.length(t), F.length(text))))

    return F.coalesce(cut(F.concat(token, F.lit("\n\n"))), cut(F.concat(F.lit("\n\n"), token)), cut(token), text)


def substitute(text: Column, replacements: Column) -> Column:
    """X-1: replacements (array<struct<token, text>>) in their order; an empty text erases, another replaces all occurrences."""
    return F.aggregate(replacements, text, lambda s, r: F.when(r["text"] == "", erase(s, r["token"])).otherwise(F.replace(s, r["token"], r["text"])))


def merged_tables(tables: DataFrame) -> DataFrame:
    """J-6, W-3, W-4: fragments of a start page are held until a closing piece of it comes. tables: job_id, start_page, page_number, idx, token, markdown, is_fragment.

    Returns job_id, start_page, chain, page_number (of the closing piece or the last fragment), token (of the closing piece), markdown, closed.
    """
    order = W.partitionBy("job_id", "start_page").orderBy("page_number", "idx")
    rows = tables.withColumn("chain", F.coalesce(F.sum((~F.col("is_fragment")).cast("long")).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).cast("long"))
    pieces = F.transform(F.array_sort(F.collect_list(F.struct("page_number", "idx", "markdown"))), lambda x: F.regexp_replace(x["markdown"], r"\n+\z", ""))
    return rows.groupBy("job_id", "start_page", "chain").agg(F.max("page_number").alias("page_number"), F.max(F.when(~F.col("is_fragment"), F.col("token"))).alias("token"), F.array_join(pieces, "\n").alias("markdown"), F.bool_or(~F.col("is_fragment")).alias("closed"))


def footer(start_pages: Column) -> Column:
    """X-3: what tells of tables without an end; start_pages ascend."""
    each = F.transform(start_pages, lambda p: F.concat(F.lit("\n### Table started on page "), p.cast("string"), F.lit("\n\n<table>\n\n<placeholder>\n<!-- table starting on page "), p.cast("string"), F.lit(" had no closing fragment -->\n")))
    return F.when(F.size(start_pages) > 0, F.concat(F.lit("\n---\n\n## Unclosed Table Fragments\n"), F.array_join(each, ""))).otherwise("")


def assembled(pages: DataFrame) -> DataFrame:
    """X-3, W-5: one document for each job of pages with table tokens. Pages come in order of (page_number, arrival).

    The pages are dealt out by job once; chains of fragments, pages and documents are then made where they lie.
    """
    if "arrival" not in pages.columns:
        pages = pages.withColumn("arrival", F.lit(0))
    rows = pages.select("job_id", "page_number", "arrival", "markdown_with_tokens", "tables", F.monotonically_increasing_id().alias("row")).repartition("job_id")
    t = rows.select("job_id", "page_number", "arrival", "row", "markdown_with_tokens", F.posexplode_outer("tables").alias("idx", "t")).withColumn("start_page", F.col("t.start_page"))
    closes = F.coalesce(~F.col("t.is_fragment"), F.lit(False))
    before = W.partitionBy("job_id", "start_page").orderBy("page_number", "idx").rowsBetween(W.unboundedPreceding, -1)
    t = t.withColumn("chain", F.coalesce(F.sum(closes.cast("long")).over(before), F.lit(0)))
    whole = W.partitionBy("job_id", "start_page", "chain").orderBy("page_number", "idx").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    t = t.withColumn("pieces", F.collect_list(F.regexp_replace("t.markdown", r"\n+\z", "")).over(whole)).withColumn("closed", F.bool_or(closes).over(whole))
    found = F.struct("idx", F.col("t.token").alias("token"), F.when(closes, F.array_join("pieces", "\n")).otherwise("").alias("text"))
    is_table = F.col("idx").isNotNull()
    each = t.groupBy("job_id", "row", "page_number", "arrival").agg(
        F.first("markdown_with_tokens").alias("md"), F.array_sort(F.collect_list(F.when(is_table, found))).alias("found"), F.collect_set(F.when(is_table & ~F.col("closed"), F.col("start_page"))).alias("open")
    )
    body = T.clean_page(substitute(F.col("md"), F.transform("found", lambda x: F.struct(x["token"].alias("token"), x["text"].alias("text")))))
    docs = each.select("job_id", "page_number", "arrival", "open", body.alias("body")).groupBy("job_id").agg(
        F.count("*").alias("total_pages"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_number", "arrival", "body"))), lambda x: x["body"]), "\n").alias("body"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("open")))).alias("open")
    )
    return docs.select("job_id", "total_pages", F.concat("body", footer(F.col("open"))).alias("markdown"))


def reordered(pages: DataFrame) -> DataFrame:
    """S-1 in batch: the place of each page in its job's output."""
    return pages.withColumn("position", F.row_number().over(W.partitionBy("job_id").orderBy("page_number", "arrival")).cast("long"))


def page_results(raw: DataFrame) -> DataFrame:
    """G-11: raw pages (job_id, page_number, markdown, figures) normalised, with tokens of figures, then of tables."""
    rows = raw.withColumn("markdown", with_figure_tokens(T.normalise(F.col("markdown")), F.col("figures"), F.col("job_id"), F.col("page_number")))
    return with_table_tokens(rows)


def merged_replacements(*resolved: DataFrame) -> DataFrame:
    """J-7: job_id, page_number, token, text, conflicts: of the resolvers' (job_id, page_number, token, text) the later one's; conflicts counts those that it hides."""
    rows = [r.select("job_id", "page_number", "token", "text", F.lit(k).alias("rank")) for k, r in enumerate(resolved)]
    every = rows[0]
    for r in rows[1:]:
        every = every.unionByName(r)
    return every.groupBy("job_id", "page_number", "token").agg(F.max_by("text", "rank").alias("text"), (F.count("*") - 1).alias("conflicts"))


def conversion_summary(pages: DataFrame, counters: DataFrame) -> DataFrame:
    """A-13, X-4: of each job its pages, engines in order, seconds, and the counters of its figures (0 without any)."""
    totals = pages.groupBy("job_id").agg(F.count("*").alias("total_pages"), F.array_sort(F.collect_set("engine")).alias("engines_used"), (F.sum("duration_ms") / 1000).alias("total_duration_seconds"))
    counts = [c for c in counters.columns if c != "job_id"]
    return totals.join(counters, "job_id", "left").na.fill(0, counts)


#: Upper ends, in seconds, of the classes of durations.
DURATIONS = (1, 5, 30)


def page_metrics(pages: DataFrame) -> DataFrame:
    """A-17: pages of each engine, degraded or not, and how many took so many seconds at most."""
    return pages.groupBy("engine", "is_degraded").agg(F.count("*").alias("pages"), *[F.count_if(F.col("duration_ms") <= 1000 * s).alias(f"within_{s}_s") for s in DURATIONS], F.sum("duration_ms").cast("long").alias("duration_ms"))


def replayed(done: DataFrame, new: DataFrame, plan: DataFrame, size: int = 8, *, tasks: int | None = None) -> DataFrame:
    """SET-2: the stored pages of the windows that a resume plan (job_id, last_completed_page) keeps, then the pages that are extracted anew; position counts them in that order. tasks: how many the pages are dealt to by job (default: as Spark packs them)."""
    kept = done.join(plan.select("job_id", "last_completed_page"), "job_id").filter("page_number <= last_completed_page").drop("last_completed_page").withColumn("is_replayed", F.lit(True))
    fresh = new.join(plan.select("job_id", "last_completed_page"), "job_id").filter("page_number > last_completed_page").drop("last_completed_page").withColumn("is_replayed", F.lit(False))
    every = kept.unionByName(fresh)
    if tasks:
        every = every.repartition(tasks, "job_id")
    return every.withColumn("position", F.row_number().over(W.partitionBy("job_id").orderBy(F.desc("is_replayed"), "page_number")).cast("long"))
