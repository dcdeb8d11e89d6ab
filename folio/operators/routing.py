"""Profiles to requirements to engines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions import text as T
from folio.operators.errors import error, no_error


def rationale() -> Column:
    """T-18: why a document needs what it needs, a sentence for each need that holds, in a fixed order."""
    r = F.col("requirements")
    said = lambda c: F.initcap(F.coalesce(F.col(c), F.lit(False)).cast("string"))
    #: Fixed values.
    reasons = {
        "needs_ocr": F.lit("no usable native text layer — OCR/layout recovery required"),
        "needs_reading_order": F.format_string("non-linear layout (columns=%d, floating_text_boxes=%s)", "layout.column_count", said("layout.has_floating_text_boxes")),
        "needs_tables": F.format_string("%d table candidate(s) detected", "tables.count"),
        "needs_complex_tables": F.format_string("structurally complex table(s) (merged=%s, nested=%s, max_columns=%d)", said("tables.has_merged_cells"), said("tables.has_nested_tables"), "tables.max_column_count"),
        "needs_visual_assets": F.lit("non-text visual objects detected"),
        "needs_visual_semantics": F.lit("candidate visuals may carry meaning beyond extracted text (Stage 3)"),
    }
    return F.array_compact(F.array(*[F.when(r[k], why) for k, why in reasons.items()]))


def requirements(rows: DataFrame) -> DataFrame:
    """T-18: what a document needs, from the structs text, tables, layout, visuals and visual_candidates, and why, in a fixed order."""
    v = "visuals"
    assets = sum((F.col(f"{v}.{c}") for c in ("embedded_image_count", "vector_graphics_count", "chart_count", "svg_count")), F.lit(0)) > 0
    meaningful = F.exists("visual_candidates", lambda x: T.is_meaningful_visual(x["kind"], x["area_ratio"], x["caption_or_alt_text"], x["nearby_text"]))
    semantics = (F.col(f"{v}.large_embedded_image_count") > 0) | (F.col(f"{v}.chart_count") > 0) | (F.col(f"{v}.svg_count") > 0) | meaningful
    t = "tables"
    needs = F.struct(
        (~F.col("text.native_text_available")).alias("needs_ocr"), ((F.col("layout.column_count") >= 2) | F.col("layout.has_floating_text_boxes")).alias("needs_reading_order"), (F.col(f"{t}.count") > 0).alias("needs_tables"),
        (F.col(f"{t}.has_merged_cells") | F.col(f"{t}.has_nested_tables") | (F.col(f"{t}.max_column_count") > 6)).alias("needs_complex_tables"), assets.alias("needs_visual_assets"), F.coalesce(semantics, F.lit(False)).alias("needs_visual_semantics"),
    )
    return rows.withColumn("requirements", needs).withColumn("rationale", rationale())


def routed(rows: DataFrame, forced: str | None = None) -> DataFrame:
    """T-19, T-20, F-11: engine, backend, confidence and reason, by the first rule that holds. A row whose type a forced engine can't read gets no engine but an error; the other rows have a null error."""
    r = F.col("requirements")
    mineru = F.col("file_type") != "html"  # the other engine reads every type
    reason = F.when(r["needs_reading_order"], "reading_order").when(r["needs_complex_tables"], "complex_tables").when(r["needs_ocr"], "ocr")
    if forced:
        allowed = F.coalesce(mineru, F.lit(False)) if forced == "mineru" else F.lit(True)
        engine, confidence, why = (F.when(allowed, F.lit(x)) for x in (forced, 1.0, "forced"))
        message = F.format_string("the forced engine %s does not read documents of type %s", F.lit(forced), F.col("file_type"))
        failed = F.when(~allowed, error("ConfigurationError", message, forced_engine=F.lit(forced), document_type=F.col("file_type"), docling_supported=F.lit(True), mineru_supported=mineru))
    else:
        engine = F.when(~mineru, "docling").when(reason.isNotNull(), "mineru").otherwise("docling")
        confidence = F.when(~mineru, 0.98).when(reason.isNotNull(), 0.90).otherwise(0.85)
        why, failed = F.when(~mineru, "only_supported").otherwise(F.coalesce(reason, F.lit("default"))), no_error()
    return rows.withColumn("engine", engine).withColumn("backend", F.when(F.col("engine") == "mineru", "auto")).withColumn("confidence", confidence.cast("double")).withColumn("reason", why).withColumn("error", failed)


def rollup(rows: DataFrame) -> DataFrame:
    """A-14: documents and pages of each engine, most documents first."""
    return rows.groupBy("engine").agg(F.count("*").alias("documents"), F.sum("page_or_unit_count").cast("long").alias("pages")).orderBy(F.desc("documents"), "engine")


def compact_summary() -> Column:
    """T-17: a profile with requirements in one line, flags only where they hold."""
    said = lambda name, value: F.concat(F.lit(f"{name}="), value.cast("string"))
    layout = (F.col("layout.column_count") >= 2) | F.col("layout.has_floating_text_boxes")
    tables = F.col("tables.has_merged_cells") | F.col("tables.has_nested_tables")
    return F.concat_ws(
        ", ", "file_type", said("units", F.col("page_or_unit_count")), said("text_chars", F.col("text.total_characters")), said("tables", F.col("tables.count")), said("columns", F.col("layout.column_count")),
        said("images", F.col("visuals.embedded_image_count")), said("vectors", F.col("visuals.vector_graphics_count")), said("visual_candidates", F.size("visual_candidates")),
        F.when(layout, "complex_layout"), F.when(tables, "complex_tables"), F.when(F.col("requirements.needs_visual_semantics"), "needs_visual_explanation"),
    )


def reachable_rungs(ladder: DataFrame, free_mb: int, max_mb: int, has_server: bool) -> DataFrame:
    """T-21: rungs that memory and server allow, in ladder order."""
    return ladder.filter((F.col("min_vram_mb") <= min(free_mb, max_mb)) & (~F.col("requires_server_url") | F.lit(has_server))).orderBy("rank")


def model_family(backend: Column) -> Column:
    """T-22."""
    return F.when(backend.endswith("-http-client"), None).when(backend.startswith("vlm-"), "vlm").when(backend.startswith("pipeline") | backend.startswith("hybrid-"), "pipeline")


def model_families(backends: Column) -> Column:
    """T-22: the distinct families of an array of backends, in the order of their first backend."""
    return F.array_distinct(F.array_compact(F.transform(backends, model_family)))


def is_degraded(backend: Column, top: Column, fallback: Column) -> Column:
    """T-23, R-4: a page of another engine than the routed one, or of a lower rung than the ladder's top."""
    return F.coalesce(fallback, F.lit(False)) | F.coalesce(backend != top, F.lit(False))


def top_candidates(candidates: Column, keep: int = 10, by_area: bool = True) -> Column:
    """S-2: those with a caption or more evidence first, then the larger, then as they came."""

    def score(x):
        said = F.concat(F.coalesce(x["caption_or_alt_text"], F.lit("")), F.coalesce(x["nearby_text"], F.lit("")))
        return F.when(said != "", 1).otherwise(0) + F.size(x["evidence"])

    keyed = F.transform(candidates, lambda x, i: F.struct((-score(x)).alias("s"), (-F.coalesce(x["area_ratio"], F.lit(0.0)) if by_area else F.lit(0.0)).alias("a"), i.alias("i"), x.alias("x")))
    return F.transform(F.slice(F.array_sort(keyed, lambda a, b: F.when(a["s"] != b["s"], F.signum(a["s"] - b["s"])).when(a["a"] != b["a"], F.signum(a["a"] - b["a"])).otherwise(F.signum((a["i"] - b["i"]).cast("double"))).cast("int")), 1, keep), lambda k: k["x"])
