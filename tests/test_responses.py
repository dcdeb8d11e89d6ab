import json

import pytest
from pyspark.sql import functions as F

from folio.operators import figures, responses
from folio.sources.versioned import VersionedTable

GOOD = {"figure_type": "chart", "rendering_strategy": "plain_text_explanation", "is_informative": True, "markdown_result": " x ", "legibility": "clear", "confidence": 0.5, "document_domain": "legal"}
CASES = {
    "good": (GOOD, []), "whole number": (GOOD | {"confidence": 1}, []), "null": (None, [(None, "not_json")]), "cut": (json.dumps(GOOD)[:30], [(None, "not_json")]), "list": ([1], [(None, "not_an_object")]), "text": ('"x"', [(None, "not_an_object")]),
    "empty": ({}, [(k, "missing") for k in GOOD]), "nulls": (dict.fromkeys(GOOD), [(k, "type") for k in GOOD]), "object": (GOOD | {"markdown_result": {"a": 1}, "confidence": [1]}, [("markdown_result", "type"), ("confidence", "type")]),
    "number": (GOOD | {"figure_type": 7}, [("figure_type", "type")]), "unknown": (GOOD | {"figure_type": "photo", "document_domain": "auto"}, [("figure_type", "not_allowed"), ("document_domain", "not_allowed")]),
    "extra": (GOOD | {"b": 1, "token": "t"}, [("b", "unexpected"), ("token", "unexpected")]), "range": (GOOD | {"confidence": -0.1}, [("confidence", "out_of_range")]), "blank": (GOOD | {"markdown_result": " \n"}, [("markdown_result", "empty")]),
    "pair": (GOOD | {"rendering_strategy": "timeline_table"}, [(None, "strategy_not_allowed")]), "mismatch": (GOOD | {"is_informative": False}, [(None, "informative_mismatch")]), "note": (GOOD | {"rendering_strategy": "decorative_note"}, [(None, "note_needs_decorative")]),
    "decorative": (GOOD | {"figure_type": "decorative", "is_informative": False, "rendering_strategy": "decorative_note"}, []), "decorative plain": (GOOD | {"figure_type": "decorative", "is_informative": False}, [(None, "decorative_needs_note")]),
}


def test_responses(spark):
    rows = [(k, v if v is None or isinstance(v, str) else json.dumps(v)) for k, (v, _) in CASES.items()]
    got = {r.name: r for r in responses.checked(spark.createDataFrame(rows, "name string, response string"), "response").collect()}
    for name, (_, want) in CASES.items():
        assert [tuple(p) for p in got[name].problems] == want, name
        assert (got[name].summary is None, got[name].error is not None) == (bool(want), bool(want)), name
    assert got["good"].summary.markdown_result == "x" and got["whole number"].summary.confidence == 1.0
    assert got["range"].error["context"] == {"problems": "confidence: out_of_range"}


def test_the_matrix_is_whole(spark):
    table = responses.allowed_strategies(spark)
    assert table.select("figure_type").distinct().count() == 20 and table.select("rendering_strategy").distinct().count() == 16
    every = table.select("figure_type").distinct().crossJoin(table.select("rendering_strategy").distinct())
    found = every.filter(responses.is_allowed(F.col("figure_type"), F.col("rendering_strategy")))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, table.collect()))
    rows = spark.createDataFrame([("map", "plain_text_explanation", True, "x", 0.5, "legal"), ("map", "timeline_table", True, "x", 0.5, "legal"), ("photo", "markdown_table", True, "x", 0.5, "legal")], "figure_type string, rendering_strategy string, is_informative boolean, markdown_result string, confidence double, document_domain string")
    assert [r.errors for r in figures.violations(rows).collect()] == [[], ["strategy_not_allowed"], ["strategy_not_allowed"]]


def test_stored_summaries_that_break_the_contract_are_misses(spark):
    keep = {"a": GOOD | {"token": "${FIG:j:001:0}"}, "b": GOOD}
    miss = {"c": GOOD | {"confidence": 7}, "d": GOOD | {"figure_type": "photo"}, "e": GOOD | {"rendering_strategy": "timeline_table"}, "f": GOOD | {"other": 1}}
    rows = spark.createDataFrame([(k, json.dumps(v)) for k, v in (keep | miss).items()], "token string, json string")
    assert sorted(r.token for r in figures.stored(rows, "token").collect()) == ["a", "b"]


@pytest.mark.parametrize("failing", ["", "y"])
def test_later_runs_summarise_new_contents_only(spark, tmp_path, failing):
    asked = spark.sparkContext.accumulator(0)

    def provider(sha):
        def answer(x):
            asked.add(1)
            return None if x == failing else json.dumps(GOOD | {"markdown_result": f"about {x}"})

        return F.udf(answer)(sha)

    figure = lambda *shas: spark.createDataFrame([("j", 1, k, f"t{k}", s) for k, s in enumerate(shas)], "job_id string, page_number int, index_on_page int, token string, sha256 string")
    store = VersionedTable(spark, str(tmp_path / "s"), "sha256 string, json string", ["sha256"])
    first = figures.summarised(figure("x", "y", "x", None), store, provider).orderBy("token").collect()
    assert [(r.token, r.is_new) for r in first] == [("t0", True), ("t1", not failing), ("t2", False), ("t3", False)]
    assert first[3].json is None and (first[1].json is None) == bool(failing)
    known = {r.sha256 for r in store.latest().collect()}
    second = figures.summarised(figure("x", "y", "z"), store, provider).orderBy("token").collect()
    assert [r.is_new for r in second] == [False, False, True] and known == ({"x"} if failing else {"x", "y"})
    store.compact()
    assert {r.sha256 for r in store.latest().collect()} == known | {"z"}


def test_pictures_on_pages_and_prompts(spark):
    pictures = spark.createDataFrame([("j", 1, b"x", [1, 2, 1]), ("j", 2, None, [1]), ("j", 3, b"y", [1, 9]), ("k", 4, b"z", [])], "job_id string, picture long, image binary, provenance array<long>")
    there = spark.createDataFrame([("j", 1), ("j", 2), ("k", 1)], "job_id string, page_number long")
    got = sorted((r.job_id, r.page_number, r.index_on_page, r.picture) for r in figures.page_figures(pictures, there).collect())
    assert got == [("j", 1, 0, 1), ("j", 1, 1, 3), ("j", 2, 0, 1)]
    r = spark.range(1).select(responses.system_prompt("B", {"legal": "L"}, F.lit("legal")).alias("a"), responses.system_prompt("B", {}, F.lit("legal")).alias("b"), responses.user_prompt(F.lit(1)).alias("c"), responses.user_prompt(F.lit(2)).alias("d")).first()
    assert (r.a, r.b, r.c, r.d) == ("B\n---\nL\n", "B", responses.USER_PROMPT, responses.RETRY_PROMPT)


def test_a_text_is_parsed_a_few_times_whatever_asks_for_it(spark):
    """Filters and generators on what checked() gives once multiplied its expressions, and ran where the table's only file is read."""
    from folio.plans import delivery, registry

    for name in ("response_problems", "response_validation", "summary_store"):
        plan = registry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        above = plan[: plan.index("RepartitionByExpression")]
        assert 1 <= above.count("not_an_object") == plan.count("not_an_object") <= 4, name
    assert delivery.dealt(registry.table(spark, "/root/testdata/sf0.001", "part"), "p_partkey").rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism


def test_answers_are_checked_once_a_content(spark, tmp_path):
    rows = spark.createDataFrame([("j", 1, k, f"t{k}", f"s{k % 2}") for k in range(4)], "job_id string, page_number int, index_on_page int, token string, sha256 string")
    store, plans = VersionedTable(spark, str(tmp_path / "s"), "sha256 string, json string", ["sha256"]), []
    append = store.append
    store.append = lambda good, *more, **named: plans.append(good._jdf.queryExecution().optimizedPlan().toString()) or append(good, *more, **named)
    figures.summarised(rows, store, lambda sha: F.concat(F.lit('{"figure_type": "'), sha, F.lit('"}')))
    above = plans[0][: plans[0].index("Aggregate")]
    assert above.count("not_an_object") == 1 and plans[0].count("not_an_object") == 2  # the other is that of the store's own rows


def test_a_filter_on_the_error_parses_no_text_again(spark):
    from folio.plans import registry

    plan = registry.queries()["summary_store"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("not_an_object") == 1
    rows = spark.createDataFrame([("a", "[1]"), ("b", "{")], "token string, json string")
    assert {(r.token, r.problems[0].problem) for r in responses.checked(rows.withColumn("error", F.lit("old")), "json").filter("error IS NOT NULL").collect()} == {("a", "not_an_object"), ("b", "not_json")}
