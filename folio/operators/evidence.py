"""Evidence of PDF, Word and PowerPoint documents to document profiles (G-14..G-16, A-8..A-10), all of one shape.

PDF pages: job_id, page_number, page_width, page_height, text, block_left_edges, table_boxes, image_boxes, image_ref_count,
drawing_count, as a provider saw them. Word files and slides: the rows of sources/office.py; those with an error have no
profile. Each row is reduced by itself first; candidates are cut to the strongest before they are gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folio.functions import text as T
from folio.operators.routing import top_candidates
from folio.sources.html import CANDIDATE

#: Fixed values of the data model.
LARGE_AREA, IMAGE_AREA, MIN_DRAWINGS, TWO_COLUMN_SHARE, KEEP, CLUSTER_SHAPES = 0.08, 0.02, 20, 0.30, 10, 8


def page_evidence(pages: DataFrame) -> DataFrame:
    """The figures of each page, and its candidates in the order tables, images, drawings."""
    area = F.col("page_width") * F.col("page_height")
    share = lambda b: T.area_fraction((b["x1"] - b["x0"]) * (b["y1"] - b["y0"]), area)
    none = F.array().cast(f"array<{CANDIDATE}>")
    caption = T.first_caption(F.col("text"))

    def candidate(kind: str, ratio: Column, evidence: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.col("page_number").cast("int").alias("page_number"), F.lit(None).cast("string").alias("location_label"), ratio.cast("double").alias("area_ratio"), F.lit(None).cast("string").alias("caption_or_alt_text"), caption.alias("nearby_text"), F.array(evidence).alias("evidence"))

    images = F.filter("image_boxes", lambda b: share(b) >= IMAGE_AREA)
    # the texts of evidence here and below are fixed values of the data model
    found = F.concat(
        F.transform("table_boxes", lambda b: candidate("table", share(b), F.lit("table-shaped region"))),
        F.transform(images, lambda b: candidate("embedded_image", share(b), F.lit("embedded raster image"))),
        F.when(F.col("drawing_count") >= MIN_DRAWINGS, F.array(candidate("vector_graphics", F.lit(None), F.concat(F.col("drawing_count").cast("string"), F.lit(" vector drawings"))))).otherwise(none),
    ).cast(f"array<{CANDIDATE}>")
    return pages.select(
        "job_id", "page_number", area.alias("area"), F.length("text").alias("chars"), (T.strip(F.col("text")) != "").alias("has_text"), T.caption_lines(F.col("text")).alias("captions"), T.is_multi_column(F.col("block_left_edges"), F.col("page_width")).alias("two"),
        F.size("table_boxes").alias("tables"), F.size(F.filter("table_boxes", lambda b: share(b) >= LARGE_AREA)).alias("large_tables"), F.coalesce(F.array_max(F.transform("table_boxes", lambda b: b["col_count"])), F.lit(0)).alias("columns"),
        F.col("image_ref_count").alias("images"), F.size(F.filter(images, lambda b: share(b) >= LARGE_AREA)).alias("large_images"), F.col("drawing_count").alias("drawings"), top_candidates(found, KEEP).alias("found"),
    )


def pdf_profile(pages: DataFrame) -> DataFrame:
    """One profile for each job, in the shape of the other types' profiles."""
    rows = page_evidence(pages)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("int")
    judged, two = F.count("two"), F.count_if("two")
    sums = rows.groupBy("job_id").agg(
        F.count("*").cast("int").alias("page_or_unit_count"),
        F.struct(F.sum("chars").cast("long").alias("total_characters"), F.count_if("has_text").cast("int").alias("pages_or_units_with_text"), (F.sum("chars") / F.greatest(F.sum("area"), F.lit(1.0))).alias("estimated_text_density"), (F.sum("chars") > 0).alias("native_text_available")).alias("text"),
        F.struct(total("tables").alias("count"), F.count_if(F.col("tables") > 0).cast("int").alias("pages_or_units_with_tables"), total("large_tables").alias("large_count"), F.max("columns").alias("max_column_count"), F.lit(False).alias("has_merged_cells"), F.lit(False).alias("has_nested_tables")).alias("tables"),
        F.struct(F.when((judged > 0) & (two >= TWO_COLUMN_SHARE * judged), 2).otherwise(1).alias("column_count"), F.lit(False).alias("has_floating_text_boxes")).alias("layout"),
        F.struct(total("images").alias("embedded_image_count"), total("large_images").alias("large_embedded_image_count"), total("drawings").alias("vector_graphics_count"), F.lit(0).alias("chart_count"), F.lit(0).alias("svg_count"), F.count_if((F.col("images") > 0) | (F.col("drawings") > 0)).cast("int").alias("pages_or_units_with_visuals"), total("captions").alias("captioned_visual_count")).alias("visuals"),
    )
    return with_best(sums, rows).withColumn("file_type", F.lit("pdf"))


def with_best(sums: DataFrame, rows: DataFrame) -> DataFrame:
    """sums with visual_candidates: the strongest of found of a job's rows."""
    each = rows.select("job_id", "page_number", F.posexplode("found").alias("k", "x"))
    said = F.when(F.coalesce(F.col("x.nearby_text"), F.lit("")) != "", 1).otherwise(0) + F.size("x.evidence")
    rank = F.row_number().over(W.partitionBy("job_id").orderBy(said.desc(), F.coalesce("x.area_ratio", F.lit(0.0)).desc(), "page_number", "k"))
    best = each.withColumn("r", rank).filter(F.col("r") <= KEEP).groupBy("job_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "x"))), lambda y: y["x"]).alias("visual_candidates"))
    return sums.join(best, "job_id", "left").withColumn("visual_candidates", F.coalesce("visual_candidates", F.array().cast(f"array<{CANDIDATE}>")))


def docx_profile(files: DataFrame) -> DataFrame:
    """G-16, A-10: one profile for each Word file; no shuffle, as a row has the whole file."""
    size = lambda c: F.size(c).cast("int")
    chars = F.length(F.array_join(F.concat("paragraphs", "cell_paragraphs"), "\n")).cast("long")
    rows = files.filter("error IS NULL").withColumn("chars", chars).withColumn("pages", T.estimated_pages(F.col("chars")).cast("int")).withColumn("images", F.greatest("inline_images", "archive_images"))
    said = T.compact(F.get(F.filter("paragraphs", T.has_caption), F.lit(0)))
    zero, none, images, pages = F.lit(0), F.lit(None), F.col("images"), F.col("pages")

    def candidate(kind: str, place: str, caption: Column, evidence: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), none.cast("int").alias("page_number"), F.lit(place).alias("location_label"), none.cast("double").alias("area_ratio"), caption.cast("string").alias("caption_or_alt_text"), caption.cast("string").alias("nearby_text"), F.array(evidence).alias("evidence"))

    # fixed values: the texts of evidence
    counts = F.concat(images.cast("string"), F.lit(" image(s) found (text-flow count: "), F.col("inline_images").cast("string"), F.lit(", zip-archive count: "), F.col("archive_images").cast("string"), F.lit(")"))
    found = F.array(
        F.when(images > 0, candidate("embedded_image", "docx embedded media", said, counts)),
        F.when(size("tables") > 0, candidate("table", "docx tables", none, F.concat(size("tables").cast("string"), F.lit(" Word table object(s) found")))),
    )
    return rows.select(
        "job_id", pages.alias("page_or_unit_count"),
        F.struct(F.col("chars").alias("total_characters"), F.when(F.col("chars") > 0, pages).otherwise(0).alias("pages_or_units_with_text"), (F.col("chars") / pages).alias("estimated_text_density"), (F.col("chars") > 0).alias("native_text_available")).alias("text"),
        F.struct(size("tables").alias("count"), F.least(size("tables"), pages).alias("pages_or_units_with_tables"), zero.alias("large_count"), F.coalesce(F.array_max("tables.columns"), zero).alias("max_column_count"), F.exists("tables", lambda t: t["merged"]).alias("has_merged_cells"), F.exists("tables", lambda t: t["nested"]).alias("has_nested_tables")).alias("tables"),
        F.struct(F.greatest(F.lit(1), F.coalesce(F.array_max("section_columns"), F.lit(1))).alias("column_count"), F.col("text_boxes").alias("has_floating_text_boxes")).alias("layout"),
        F.struct(images.alias("embedded_image_count"), zero.alias("large_embedded_image_count"), zero.alias("vector_graphics_count"), zero.alias("chart_count"), zero.alias("svg_count"), F.least(images, pages).alias("pages_or_units_with_visuals"), T.caption_lines(F.array_join("paragraphs", "\n")).cast("int").alias("captioned_visual_count")).alias("visuals"),
        F.filter(found, lambda x: x.isNotNull()).cast(f"array<{CANDIDATE}>").alias("visual_candidates"), F.lit("docx").alias("file_type"),
    )


def slide_evidence(slides: DataFrame) -> DataFrame:
    """G-15, W-8: the figures of each slide, and its candidates. What stands near a shape is the first caption among the texts before it, else the first of those texts."""
    texts = F.filter(F.transform("shapes", lambda s, i: F.struct(i.alias("i"), s["text"].alias("text"))), lambda t: t["text"].isNotNull())
    rows = slides.filter("error IS NULL").withColumn("texts", texts).withColumn("drawn", F.size(F.filter("shapes", lambda s: s["kind"].isin("chart", "image", "drawing"))))
    rows = rows.withColumn("whole", F.array_join("texts.text", "\n")).withColumn("head", F.get("texts", F.lit(0))).withColumn("caption", F.get(F.filter("texts", lambda t: T.has_caption(t["text"])), F.lit(0)))
    near = lambda i: F.when(F.col("caption.i") < i, T.compact(F.col("caption.text"))).when(F.col("head.i") < i, T.compact(F.col("head.text")))
    share = lambda s: T.area_fraction(F.greatest(s["width"] * s["height"], F.lit(0.0)), F.col("slide_area"))

    def candidate(kind: Column, ratio: Column, nearby: Column, evidence: Column) -> Column:
        return F.struct(kind.alias("kind"), F.col("slide_number").alias("page_number"), F.lit(None).cast("string").alias("location_label"), ratio.cast("double").alias("area_ratio"), F.lit(None).cast("string").alias("caption_or_alt_text"), nearby.alias("nearby_text"), F.array(evidence).alias("evidence"))

    # fixed values: the texts of evidence
    words = lambda s: F.when(s["kind"] == "table", "PowerPoint table shape").when(s["kind"] == "chart", "PowerPoint native chart object").when(s["kind"] == "image", "PowerPoint picture shape (raster image)")
    kind = lambda s: F.when(s["kind"] == "image", "embedded_image").otherwise(s["kind"])
    seen = F.filter(F.transform("shapes", lambda s, i: F.when(words(s).isNotNull(), candidate(kind(s), share(s), near(i), words(s)))), lambda x: x.isNotNull())
    crowd = F.concat(F.col("drawn").cast("string"), F.lit(f" visual shapes on this slide; configured threshold is {CLUSTER_SHAPES}"))
    cluster = F.when(F.col("drawn") >= CLUSTER_SHAPES, F.array(candidate(F.lit("slide_visual_cluster"), F.lit(None), near(F.size("shapes")), crowd))).otherwise(F.array())
    of_kind = lambda k: F.size(F.filter("shapes", lambda s: s["kind"] == k))
    return rows.select(
        "job_id", F.col("slide_number").alias("page_number"), "slide_count", "drawn", F.aggregate("texts", F.lit(0), lambda n, t: n + F.length(t["text"])).alias("chars"), (T.strip(F.col("whole")) != "").alias("has_text"), T.caption_lines(F.col("whole")).alias("captions"),
        of_kind("table").alias("tables"), of_kind("chart").alias("charts"), of_kind("image").alias("images"), of_kind("drawing").alias("drawings"), F.size(F.filter("shapes", lambda s: (s["kind"] == "image") & (share(s) >= LARGE_AREA))).alias("large_images"),
        F.coalesce(F.array_max("shapes.columns"), F.lit(0)).alias("columns"), F.exists("shapes", lambda s: s["merged"]).alias("merged"), top_candidates(F.concat(seen.cast(f"array<{CANDIDATE}>"), cluster.cast(f"array<{CANDIDATE}>")), KEEP).alias("found"),
    )


def pptx_profile(slides: DataFrame) -> DataFrame:
    """A-9: one profile for each PowerPoint file."""
    rows = slide_evidence(slides)
    total = lambda c: F.sum(c).cast("int")
    with_any = lambda c: F.count_if(F.col(c) > 0).cast("int")
    zero, count = F.lit(0), F.greatest(F.max("slide_count"), F.lit(1))
    sums = rows.groupBy("job_id").agg(
        count.alias("page_or_unit_count"),
        F.struct(F.sum("chars").cast("long").alias("total_characters"), F.count_if("has_text").cast("int").alias("pages_or_units_with_text"), (F.sum("chars") / count).alias("estimated_text_density"), (F.sum("chars") > 0).alias("native_text_available")).alias("text"),
        F.struct(total("tables").alias("count"), with_any("tables").alias("pages_or_units_with_tables"), zero.alias("large_count"), F.max("columns").alias("max_column_count"), F.bool_or("merged").alias("has_merged_cells"), F.lit(False).alias("has_nested_tables")).alias("tables"),
        F.struct(F.lit(1).alias("column_count"), F.lit(False).alias("has_floating_text_boxes")).alias("layout"),
        F.struct(total("images").alias("embedded_image_count"), total("large_images").alias("large_embedded_image_count"), total("drawings").alias("vector_graphics_count"), total("charts").alias("chart_count"), zero.alias("svg_count"), with_any("drawn").alias("pages_or_units_with_visuals"), total("captions").alias("captioned_visual_count")).alias("visuals"),
    )
    return with_best(sums, rows).withColumn("file_type", F.lit("pptx"))
