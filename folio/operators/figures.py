"""Figures: each content is enriched once, summaries are checked, joined and counted. A provider is a function of columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folio.functions import text as T
from folio.operators.responses import checked, is_allowed
from folio.sources.versioned import VersionedTable
from folio.sources.vision import Vision, answered


def stub_provider(sha: Column) -> Column:
    """A deterministic stand-in for a vision model: decorative if the hash begins with 0, failed with f, else informative."""
    return F.when(sha.startswith("0"), "decorative").when(sha.startswith("f"), "failed").otherwise("informative")


def pending(figures: DataFrame, stored: DataFrame) -> DataFrame:
    """J-3: figures whose token has no summary yet."""
    return figures.join(stored.select("token").distinct(), "token", "left_anti")


def enriched(figures: DataFrame, provider: Callable[[Column], Column] = stub_provider) -> DataFrame:
    """A-16, J-2: status and outcome of each figure: the first of a job and content is summarised, the others copy it. A failed content is tried again for each."""
    first = F.row_number().over(W.partitionBy("job_id", "sha256").orderBy("page_number", "index_on_page", "token")) == 1
    rows = figures.withColumn("outcome", provider(F.col("sha256"))).withColumn("first", first)
    return rows.withColumn("status", F.when(F.col("outcome") == "failed", "failed").when(F.col("first"), "summarized").otherwise("deduplicated")).drop("first")


def counters(rows: DataFrame) -> DataFrame:
    """A-12."""
    of = lambda s: F.count_if(F.col("status") == s)
    return rows.groupBy("job_id").agg(of("summarized").alias("figures_summarized"), of("deduplicated").alias("figures_deduplicated"), of("failed").alias("figures_failed"))


def resolved(figures: DataFrame, summaries: DataFrame) -> DataFrame:
    """J-1: the text of each token: its summary's if informative, none if not, the placeholder if there is no summary."""
    text = F.when(F.col("is_informative").isNull(), T.PLACEHOLDER).when(F.col("is_informative"), F.col("markdown_result")).otherwise("")
    return figures.join(summaries.select("token", "is_informative", "markdown_result"), "token", "left").withColumn("replacement", text)


def violations(rows: DataFrame, allowed: DataFrame | None = None) -> DataFrame:
    """V-1, J-11: errors of each summary, as an array. allowed (figure_type, rendering_strategy) is a fixed small matrix, by default that of the data model."""
    if allowed is None:
        c = rows.withColumn("known", F.when(is_allowed(F.col("figure_type"), F.col("rendering_strategy")), True))
    else:
        known = F.broadcast(allowed.select("figure_type", "rendering_strategy", F.lit(True).alias("known")))  # a constant of the data model
        c = rows.join(known, ["figure_type", "rendering_strategy"], "left")
    decorative = F.col("figure_type") == "decorative"
    note = F.col("rendering_strategy") == "decorative_note"
    checks = {
        "strategy_not_allowed": F.col("known").isNull(), "decorative_but_informative": decorative & F.col("is_informative"), "informative_mismatch": ~decorative & ~F.col("is_informative"), "decorative_needs_note": decorative & ~note,
        "note_needs_decorative": note & ~decorative, "empty_markdown": F.coalesce(T.strip(F.col("markdown_result")), F.lit("")) == "", "confidence_out_of_range": F.isnan("confidence") | ~F.col("confidence").between(0, 1), "domain_not_resolved": F.col("document_domain") == "auto",
    }
    return c.withColumn("errors", F.array_compact(F.array(*[F.when(F.coalesce(x, F.lit(True)), F.lit(k)) for k, x in checks.items()]))).drop("known")


def stored(rows: DataFrame, key: str) -> DataFrame:
    """SRC-13, SRC-14: what a store of JSON has under each key. What can't be read or does not agree with the contract of a summary is a miss."""
    found = checked(rows.select(key, "json"), "json", ("token",)).filter("error IS NULL")
    return found.select(key, "summary.*")


def summarised(figures: DataFrame, store: VersionedTable, provider: Callable[[Column], Column] | Vision) -> DataFrame:
    """SNK-7, J-2 across runs: figures with json and is_new. Contents (sha256) with a valid summary in the store are not summarised again.

    provider gives the JSON of a summary: a function of a content's hash, or a vision client, for which figures have the
    column image. Valid answers are appended to the store; others are tried again in the next run. Of the figures of a
    content one is new, the others copy it. Figures without sha256 have no summary.
    """
    known = stored(store.latest().select("sha256", "json"), "sha256").select("sha256")
    wanted = figures.filter("sha256 IS NOT NULL").join(known, "sha256", "left_anti")
    if isinstance(provider, Vision):
        answers = answered(wanted.groupBy("sha256").agg(F.first("image", ignorenulls=True).alias("image")), provider)
    else:
        # what is asked of a content is a value of its group, so that no filter on the answers is moved to the figures
        answers = wanted.groupBy("sha256").agg(F.first("sha256").alias("content")).select("sha256", provider(F.col("content")).alias("json"))
    good = checked(answers.select("sha256", "json"), "json", ("token",)).filter("error IS NULL").select("sha256", "json")
    before = store.version()
    after = store.append(good, before)
    new = store.changes(before).filter(F.col("version") == after).select("sha256", F.lit(True).alias("added"))
    first = F.row_number().over(W.partitionBy("sha256").orderBy("job_id", "page_number", "index_on_page", "token")) == 1
    rows = figures.withColumn("first", first).join(store.latest().select("sha256", "json"), "sha256", "left").join(new, "sha256", "left")
    return rows.withColumn("is_new", F.coalesce(F.col("added") & F.col("first"), F.lit(False))).drop("added", "first", "version")


def page_figures(pictures: DataFrame, pages: DataFrame) -> DataFrame:
    """J-10: pictures (job_id, picture, image, provenance as an array of page numbers) on each page (job_id, page_number) that they name, numbered in their order.

    A picture on several pages is on each; one without an image is left out; a page named twice has it once.
    """
    at = pictures.filter("image IS NOT NULL").select("job_id", "picture", "image", F.explode(F.array_distinct("provenance")).alias("page_number"))
    rows = at.join(pages.select("job_id", "page_number").distinct(), ["job_id", "page_number"], "left_semi")
    return rows.withColumn("index_on_page", (F.row_number().over(W.partitionBy("job_id", "page_number").orderBy("picture")) - 1).cast("long"))


def effective_domain(domain: Column) -> Column:
    """T-24."""
    return F.when(domain == "auto", "educational").otherwise(domain)


def summary_of(markdown: Column, cloud: bool = False) -> Column:
    """T-25: the summary that a model's Markdown stands for."""
    plain = ~T.looks_decorative(markdown)
    return F.struct(
        F.when(plain, "other").otherwise("decorative").alias("figure_type"), F.when(plain, "plain_text_explanation").otherwise("decorative_note").alias("rendering_strategy"), plain.alias("is_informative"),
        F.lit("clear").alias("legibility"), F.when(plain, 0.85 if cloud else 0.8).otherwise(0.9).alias("confidence"), markdown.alias("markdown_result"),
    )
