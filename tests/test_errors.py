import pytest
from pyspark.sql import functions as F

from folio.operators import errors, routing

PROFILE = "job_id string, file_type string, page_or_unit_count int, text struct<native_text_available:boolean>, tables struct<count:int,max_column_count:int,has_merged_cells:boolean,has_nested_tables:boolean>, layout struct<column_count:int,has_floating_text_boxes:boolean>, visuals struct<embedded_image_count:int,large_embedded_image_count:int,vector_graphics_count:int,chart_count:int,svg_count:int>, visual_candidates array<struct<kind:string,area_ratio:double,caption_or_alt_text:string,nearby_text:string>>"


def profiles(spark):
    plain = ((True,), (0, 0, False, False), (1, False), (0, 0, 0, 0, 0), [])
    rows = [("a", "pdf", 1, *plain), ("b", "html", 1, *plain), ("c", "docx", 1, (False,), (2, 7, True, False), (2, True), (1, 1, 0, 0, 0), []), ("d", None, 1, *plain)]
    return spark.createDataFrame(rows, PROFILE)


def test_one_bad_row_does_not_end_the_job(spark):
    rows = routing.routed(routing.requirements(profiles(spark)), forced="mineru")
    got = {r.job_id: r for r in rows.collect()}
    assert {k: (r.engine, r.reason, r.error and r.error["class"]) for k, r in got.items()} == {"a": ("mineru", "forced", None), "b": (None, None, "ConfigurationError"), "c": ("mineru", "forced", None), "d": (None, None, "ConfigurationError")}
    assert got["b"].error["context"] == {"forced_engine": "mineru", "document_type": "html", "docling_supported": "true", "mineru_supported": "false"}
    assert got["d"].error["message"] is not None
    assert sorted(r.job_id for r in errors.passed(rows).collect()) == ["a", "c"] and "error" not in errors.passed(rows).columns
    letters = errors.dead_letters(rows, "routing", "job_id")
    assert sorted((r.stage, r.row_key, r["class"]) for r in letters.collect()) == [("routing", '{"job_id":"b"}', "ConfigurationError"), ("routing", '{"job_id":"d"}', "ConfigurationError")]
    assert {(r["class"], r.own, r.with_kinds) for r in errors.error_rollup(letters).collect()} == {("ConfigurationError", 2, 2), ("PipelineError", 0, 2)}
    with pytest.raises(Exception, match="ConfigurationError"):
        errors.strict(rows).collect()
    assert errors.strict(rows.filter("error IS NULL")).count() == 2
    auto = routing.routed(routing.requirements(profiles(spark)))
    assert auto.filter("error IS NOT NULL").count() == 0 and auto.schema["error"].dataType == rows.schema["error"].dataType


def test_kinds_and_order(spark):
    assert errors.lineage("FigurePoisonPillError") == ["FigurePoisonPillError", "FigureSummarizationError", "PipelineError"]
    with pytest.raises(KeyError):
        errors.error("NoSuchError", "x")
    e = errors.error("EngineTimeoutError", "slow", page_range=F.lit("9-16"), engine=F.lit(None))
    first = errors.first_error(errors.no_error(), e, errors.error("GPUError", "x"))
    r = spark.range(1).select(first.alias("e"), *[errors.is_a(first, k).alias(k) for k in ("EngineError", "GPUError", "PipelineError")], errors.is_a(errors.no_error(), "PipelineError").alias("none")).first()
    assert r.e.asDict() == {"class": "EngineTimeoutError", "message": "slow", "context": {"page_range": "9-16"}} and (r.EngineError, r.GPUError, r.PipelineError, r.none) == (True, False, True, False)


def test_rationale_and_families(spark):
    got = {r.job_id: r.rationale for r in routing.requirements(profiles(spark)).collect()}
    assert got["a"] == [] and got["c"] == [
        "no usable native text layer — OCR/layout recovery required", "non-linear layout (columns=2, floating_text_boxes=True)", "2 table candidate(s) detected",
        "structurally complex table(s) (merged=True, nested=False, max_columns=7)", "non-text visual objects detected", "candidate visuals may carry meaning beyond extracted text (Stage 3)",
    ]
    backends = F.array(*[F.lit(x) for x in ("vlm-auto-http-client", "hybrid-auto", "vlm-auto", "pipeline", None)])
    assert spark.range(1).select(routing.model_families(backends)).first()[0] == ["pipeline", "vlm"]
