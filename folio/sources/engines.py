"""U-1, SRC-9, SRC-10, R-4: conversion engines as providers: windows of pages in, raw pages out, with a fallback for what an engine can't convert.

An engine is started once a task and converts one window after another; a window comes whole or not at all, and one that
fails is a row with an error, not the end of the job.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions.text import IMAGE
from folio.operators.errors import ERROR, error
from folio.operators.pages import FIGURE_MARKER
from folio.operators.sections import let
from folio.sources.listing import opened
from folio.sources.shared import work_dir

PAGE = f"job_id string, window_index long, page_number long, markdown string, figures array<binary>, engine string, duration_ms long, error {ERROR}"


class Engine:
    """What an engine does; a model, a server's client or a parser stands behind it."""

    name = "engine"

    def start(self) -> None:
        """Load what all windows of a task share."""

    def stop(self) -> None:
        """Let go of it."""

    def convert(self, source, pages: list[int]) -> Iterator[tuple[int, str, list[bytes]]]:
        """page number, Markdown with a marker for each figure, and the figures' pictures, of each page of a window."""
        raise NotImplementedError


class TextEngine(Engine):
    """A deterministic stand-in: the source is the text of a window, a page so many of its characters; a page with the text `breaks_on` fails."""

    def __init__(self, name: str, characters: int = 2000, breaks_on: str | None = None):
        self.name, self.characters, self.breaks_on = name, characters, breaks_on

    def convert(self, source, pages):
        for k, p in enumerate(pages):
            text = (source or "")[k * self.characters : (k + 1) * self.characters]
            if self.breaks_on and self.breaks_on in text:
                raise ValueError(f"page {p} can't be converted")
            yield p, text, []


class FileEngine(TextEngine):
    """A TextEngine whose source is the path of a text file, on any store that can be opened outside Spark."""

    def convert(self, source, pages):
        store, inside, _ = opened(source)
        with store.open_input_stream(inside) as f:
            text = f.read().decode("utf-8", "ignore")
        yield from super().convert(text[(pages[0] - 1) * self.characters : pages[-1] * self.characters], pages)


def extracted(windows: DataFrame, engine: Engine) -> DataFrame:
    """PAGE of windows (job_id, window_index, start_page, end_page, source): a row a page, or one with an error, and no page, for a window that failed.

    Windows are dealt out by job and window, so that a long document is converted in many tasks: source should be what the
    engine needs for that window, or a path that it opens, not a whole document for each of its windows.
    """

    def rows(window) -> list[tuple]:
        key, began = (window["job_id"], window["window_index"]), time.monotonic()
        try:
            pages = list(engine.convert(window["source"], list(range(window["start_page"], window["end_page"] + 1))))
        except Exception as failed:  # noqa: BLE001  whatever it is, it is this window's
            kind = "EngineTimeoutError" if isinstance(failed, TimeoutError) else "EngineError"
            context = {"engine": engine.name, "page_range": f"{window['start_page']}-{window['end_page']}", "exception": type(failed).__name__}
            return [(*key, None, None, None, engine.name, round(1000 * (time.monotonic() - began)), {"class": kind, "message": str(failed), "context": list(context.items())})]
        each = round(1000 * (time.monotonic() - began) / max(1, len(pages)))
        return [(*key, n, md, figures, engine.name, each, None) for n, md, figures in pages]

    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.binary()), pa.string(), pa.int64(), pa.struct([("class", pa.string()), ("message", pa.string()), ("context", pa.map_(pa.string(), pa.string()))])]
    names = ["job_id", "window_index", "page_number", "markdown", "figures", "engine", "duration_ms", "error"]

    def run(batches):
        engine.start()
        try:
            for batch in batches:
                for k in range(batch.num_rows):
                    found = rows({c: batch.column(c)[k].as_py() for c in batch.schema.names})
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)], names)
        finally:
            engine.stop()

    source = windows.select(F.col("job_id").cast("string").alias("job_id"), F.col("window_index").cast("long").alias("window_index"), F.col("start_page").cast("long").alias("start_page"), F.col("end_page").cast("long").alias("end_page"), "source")
    return source.repartition("job_id", "window_index").mapInArrow(run, PAGE)


def with_fallback(windows: DataFrame, primary: Engine, fallback: Engine | None) -> DataFrame:
    """PAGE and is_degraded: from the first window of a document that the primary engine can't convert, the fallback converts it, and its pages are degraded.

    Without a fallback, that window has an error row and the later windows of its document have none.
    """
    spark = windows.sparkSession
    path = work_dir(spark, "primary")
    extracted(windows, primary).write.option("compression", "zstd").parquet(path)  # an engine's work is not done twice
    first = spark.read.schema(PAGE).parquet(path)
    broken = first.filter("error IS NOT NULL").groupBy("job_id").agg(F.min("window_index").alias("broken_at"))
    kept = first.join(broken, "job_id", "left").filter("broken_at IS NULL OR window_index < broken_at").drop("broken_at").withColumn("is_degraded", F.lit(False))
    if fallback is None:
        stuck = first.join(broken, "job_id").filter("window_index = broken_at").drop("broken_at")
        told = error("EngineFallbackExhaustedError", "the engine failed and there is no fallback", primary_engine=F.lit(primary.name), reason=F.col("error.message"))
        return kept.unionByName(stuck.withColumn("error", told).withColumn("is_degraded", F.lit(False)))
    rest = windows.withColumn("job_id", F.col("job_id").cast("string")).join(broken, "job_id").filter("window_index >= broken_at").drop("broken_at")
    return kept.unionByName(extracted(rest, fallback).withColumn("is_degraded", F.lit(True)))


def page_of_response(response: Column) -> Column:
    """SRC-10: struct<markdown, figures> of a server's JSON for one page: its first result, with a marker for each image that it returned.

    An image counts under its whole reference, else under its file name; a link to one that was not returned goes. Pictures
    come in the order of their links. A response without a result is an empty page.
    """
    kind = "struct<results:map<string,struct<md_content:string,images:map<string,variant>>>>"
    first = F.get(F.map_values(F.from_json(response, kind)["results"]), F.lit(0))

    def picture(value):
        text = F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))
        return F.try_to_binary(F.regexp_replace(text, "^[^,]*,", ""), F.lit("base64"))

    def page(result):
        images = F.transform_values(F.coalesce(result["images"], F.create_map().cast("map<string,variant>")), lambda k, v: picture(v))
        md = F.coalesce(result["md_content"], F.lit(""))
        refs = F.regexp_extract_all(md, F.lit(IMAGE), F.lit(1))
        return let(F.struct(images.alias("images"), refs.alias("refs"), F.split(md, IMAGE, -1).alias("parts")), placed)

    def placed(x):
        found = F.transform(x["refs"], lambda r: F.coalesce(F.try_element_at(x["images"], r), F.try_element_at(x["images"], F.regexp_extract(r, "([^/]*)/*$", 1))))
        return let(found, lambda f: F.struct(F.array_join(F.transform(x["parts"], lambda p, i: F.concat(p, F.when(F.get(f, i).isNotNull(), FIGURE_MARKER).otherwise(""))), "").alias("markdown"), F.array_compact(f).alias("figures")))

    return let(first, page)


def markdown_pages(pages: DataFrame) -> DataFrame:
    """Pages without errors as operators.pages.page_results takes them: job_id, page_number, markdown, figures, engine, is_degraded, duration_ms."""
    return pages.filter("error IS NULL").select("job_id", "page_number", "markdown", "figures", "engine", "is_degraded", "duration_ms")
