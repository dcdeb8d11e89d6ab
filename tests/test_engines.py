import json

from pyspark.sql import functions as F

from folio.sources import engines


class Logged(engines.TextEngine):
    def start(self):
        self.started = True

    def convert(self, source, pages):
        assert self.started
        if "slow" in source:
            raise TimeoutError("too slow")
        for p, text, _ in super().convert(source, pages):
            yield p, text, [text[:2].encode()]


def windows(spark, texts, size=2, characters=10):
    rows = []
    for job, text in texts.items():
        n = max(1, -(-len(text) // characters))
        rows += [(job, k, start, min(start + size - 1, n), text[(start - 1) * characters : (start - 1 + size) * characters]) for k, start in enumerate(range(1, n + 1, size))]
    return spark.createDataFrame(rows, "job_id string, window_index long, start_page long, end_page long, source string")


def test_a_failed_window_is_a_row(spark):
    rows = engines.extracted(windows(spark, {"a": "x" * 35, "b": "y" * 15 + "BAD" + "z" * 30, "c": "slow", "d": ""}), Logged("m", 10, breaks_on="BAD")).collect()
    ok = sorted((r.job_id, r.window_index, r.page_number, r.markdown) for r in rows if r.error is None)
    assert ok[:4] == [("a", 0, 1, "x" * 10), ("a", 0, 2, "x" * 10), ("a", 1, 3, "x" * 10), ("a", 1, 4, "x" * 5)] and [x[:3] for x in ok[4:]] == [("b", 1, 3), ("b", 1, 4), ("b", 2, 5), ("d", 0, 1)]
    assert all(bytes(r.figures[0]) == r.markdown[:2].encode() for r in rows if r.error is None)
    bad = {r.job_id: (r.error["class"], r.error["context"]["page_range"], r.page_number) for r in rows if r.error}
    assert bad == {"b": ("EngineError", "1-2", None), "c": ("EngineTimeoutError", "1-1", None)}


def test_fallback_takes_the_rest_of_the_document(spark):
    w = windows(spark, {"a": "x" * 35, "b": "y" * 25 + "BAD" + "z" * 30})
    primary, other = engines.TextEngine("one", 10, breaks_on="BAD"), engines.TextEngine("two", 10)
    got = sorted((r.job_id, r.page_number, r.engine, r.is_degraded) for r in engines.with_fallback(w, primary, other).collect())
    assert got == [("a", p, "one", False) for p in range(1, 5)] + [("b", p, "one", False) for p in (1, 2)] + [("b", p, "two", True) for p in range(3, 7)]
    alone = engines.with_fallback(w, primary, None)
    assert sorted(r.page_number for r in engines.markdown_pages(alone).filter("job_id = 'b'").collect()) == [1, 2]
    assert [(r.job_id, r.window_index, r.error["class"]) for r in alone.filter("error IS NOT NULL").collect()] == [("b", 1, "EngineFallbackExhaustedError")]
    assert engines.with_fallback(w.limit(0), primary, other).collect() == []


def test_pages_of_responses(spark):
    result = {"md_content": "![](p/a.png) x ![b](b.png)![](a.png) ![no](c.png)", "images": {"a.png": "data:image/png;base64,QUE=", "b.png": "QkI=", "c.png": 5, "d.png": None}}
    cases = [json.dumps({"results": {"f": result, "g": {"md_content": "second"}}}), '{"results": {}}', "no json", None, '{"results": {"f": {"md_content": null}}}', '{"results": []}']
    got = [r.p for r in spark.createDataFrame(list(enumerate(cases)), "i int, r string").orderBy("i").select(engines.page_of_response(F.col("r")).alias("p")).collect()]
    assert got[0].markdown == "<!-- figure --> x <!-- figure --><!-- figure --> " and [bytes(x) for x in got[0].figures] == [b"AA", b"BB", b"AA"]
    assert all((p.markdown, p.figures) == ("", []) for p in got[1:])
