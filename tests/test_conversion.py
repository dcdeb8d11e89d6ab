import glob
import hashlib
import json
import os

from pyspark.sql import functions as F

from folio.functions.text import PLACEHOLDER
from folio.operators import pages as P
from folio.plans import conversion
from folio.sources import engines, vision


class Model(vision.Vision):
    """Knows two letters, fails once on the third, and always on the others."""

    def __init__(self, log):
        self.log = str(log)

    def start(self):
        self.tried = set()

    def summarise(self, image, attempt):
        open(f"{self.log}/ask-{image.decode()}-{os.urandom(4).hex()}", "w").close()
        if image == b"<":
            return answer("a tag")
        if image == b"t" and attempt == 2:
            return answer("a letter")
        raise RuntimeError("no idea")


class Pictures(engines.FileEngine):
    """Every page has a figure before its text; what the picture shows is the page's first letter."""

    def convert(self, source, pages):
        for p, text, _ in super().convert(source, pages):
            open(f"{self.log}/{os.path.basename(source)}-{p}-{os.urandom(4).hex()}", "w").close()
            yield p, f"{P.FIGURE_MARKER}\n\n{text}", [text[:1].encode() or b"-"]

    def __init__(self, name, log, characters=20, breaks_on=None):
        super().__init__(name, characters, breaks_on)
        self.log = str(log)


def answer(text, **more):
    return json.dumps({"figure_type": "other", "rendering_strategy": "plain_text_explanation", "is_informative": True, "markdown_result": text, "legibility": "clear", "confidence": 1, "document_domain": "legal"} | more)


def provider(sha):
    known = {hashlib.sha256(k).hexdigest(): v for k, v in {b"<": answer("a tag"), b"t": answer("", is_informative=False, figure_type="decorative", rendering_strategy="decorative_note", markdown_result="logo")}.items()}
    return F.coalesce(*[F.when(sha == k, F.lit(v)) for k, v in known.items()], F.lit("no answer"))


def pdf(rows):
    from folio.operators import evidence

    boxes = ["cast(array() AS array<struct<x0:double,y0:double,x1:double,y1:double,col_count:int>>) AS table_boxes", "cast(array() AS array<struct<xref:int,x0:double,y0:double,x1:double,y1:double>>) AS image_boxes"]
    each = rows.select("job_id", F.explode(F.sequence(F.lit(1), F.ceil(F.length("content") / 20).cast("int"))).alias("page_number"))
    return evidence.pdf_profile(each.selectExpr("*", "1.0D AS page_width", "1.0D AS page_height", "'text' AS text", "array(1.0D) AS block_left_edges", *boxes, "0 AS image_ref_count", "0 AS drawing_count"))


def test_a_run_can_be_broken_off_and_resumed(spark, tmp_path):
    src, out, state, log = (tmp_path / n for n in ("src", "out", "state", "log"))
    src.mkdir(), log.mkdir()
    (src / "a.pdf").write_text("<first page of all.>" + "the second one here." + "x")
    (src / "b.pdf").write_text("<first page of all.>" + "BAD page, no engine.")
    (src / "copy.pdf").write_text("<first page of all.>" + "the second one here." + "x")
    (src / "empty.pdf").write_text("")
    (src / "t.html").write_text("<p>one short page")
    run = lambda **k: {os.path.basename(r.path): r for r in conversion.convert(spark, str(src), str(out), str(state), k["primary"], k["fallback"], provider, window=1, extractors={"pdf": pdf}).collect()}
    broken = Pictures("docling", log, breaks_on="x")  # the last page of a.pdf fails, and there is no fallback
    first = run(primary={"docling": broken}, fallback=None)
    assert {k: r.error and r.error["class"] for k, r in first.items()} == {"a.pdf": "EngineFallbackExhaustedError", "copy.pdf": "EngineFallbackExhaustedError", "b.pdf": None, "empty.pdf": "DocumentError", "t.html": None}
    assert first["b.pdf"].output.endswith("/output/b.md") and first["a.pdf"].output is None
    names = lambda: sorted(os.path.basename(x) for x in glob.glob(f"{out}/*/output/*.md"))
    assert names() == ["b.md", "t.md"]
    asked = len(os.listdir(log))
    second = run(primary={"docling": Pictures("docling", log)}, fallback=None)
    assert {k: r.error and r.error["class"] for k, r in second.items()} == {"a.pdf": None, "copy.pdf": None, "b.pdf": None, "empty.pdf": "DocumentError", "t.html": None}
    assert names() == ["a.md", "b.md", "t.md"]
    new = sorted(os.listdir(log), key=lambda n: os.path.getmtime(log / n))[asked:]
    assert [n for n in new if n.startswith("a.pdf-3")] and not [n for n in new if n.startswith(("a.pdf-1", "a.pdf-2"))]  # the pages that were there are replayed
    text = open(glob.glob(f"{out}/{second['a.pdf'].job_id}/output/a.md")[0]).read()
    assert text == f"a tag\n\n<first page of all.>\n\nthe second one here.\n\n{PLACEHOLDER}\n\nx\n"
    a = second["a.pdf"]
    assert (a.total_pages, a.engines_used, a.figures_summarized, a.figures_deduplicated, a.figures_failed) == (3, ["docling"], 1, 1, 1) and first["b.pdf"].figures_failed == 1
    third = run(primary={"docling": Pictures("docling", log)}, fallback=None)
    assert {k: r.output for k, r in third.items()} == {k: r.output for k, r in second.items()}


def test_the_fallback_converts_the_rest(spark, tmp_path):
    src, log = tmp_path / "src", tmp_path / "log"
    src.mkdir(), log.mkdir()
    (src / "a.pdf").write_text("<first page of all.>" + "BAD page, no engine." + "third")
    rows = conversion.convert(spark, str(src), str(tmp_path / "out"), str(tmp_path / "state"), {"docling": Pictures("docling", log, breaks_on="BAD")}, Pictures("other", log), provider, window=1, extractors={"pdf": pdf}).collect()
    assert rows[0].error is None and rows[0].engines_used == ["docling", "other"] and rows[0].total_pages == 3
    assert "BAD page" in open(glob.glob(f"{tmp_path}/out/*/output/a.md")[0]).read()


def test_prescan_tells_engines_and_errors(spark, tmp_path):
    (tmp_path / "a.html").write_text("<p>text</p>")
    (tmp_path / "b.txt").write_text("text")
    got = {os.path.basename(r.path): r for r in conversion.prescan(spark, str(tmp_path)).collect()}
    assert (got["a.html"].engine, got["a.html"].confidence, got["a.html"].error, got["b.txt"].engine) == ("docling", 0.98, None, None)
    assert got["b.txt"].error["class"] == "DocumentError"
    assert conversion.prescan(spark, str(tmp_path), forced="mineru").filter("path LIKE '%html'").first().error["class"] == "ConfigurationError"


def test_a_vision_model_sees_each_picture_once(spark, tmp_path):
    src, log = tmp_path / "src", tmp_path / "log"
    src.mkdir(), log.mkdir()
    (src / "a.pdf").write_text("<first page of all.>" + "the second one here." + "x")
    (src / "b.pdf").write_text("<other page of all.>" + "<and one more page.>")
    run = lambda: {os.path.basename(r.path): r for r in conversion.convert(spark, str(src), str(tmp_path / "out"), str(tmp_path / "state"), {"docling": Pictures("docling", log)}, None, Model(log), extractors={"pdf": pdf}).collect()}
    asked = lambda: sorted(n.split("-")[1] for n in os.listdir(log) if n.startswith("ask"))
    got = run()
    assert asked() == ["<", "t", "t", "x", "x"]
    text = open(glob.glob(f"{tmp_path}/out/*/output/a.md")[0]).read()
    assert text == f"a tag\n\n<first page of all.>\n\na letter\n\nthe second one here.\n\n{PLACEHOLDER}\n\nx\n"
    assert (got["a.pdf"].figures_failed, got["a.pdf"].figures_summarized + got["b.pdf"].figures_summarized, got["a.pdf"].figures_deduplicated + got["b.pdf"].figures_deduplicated) == (1, 2, 2)
    figure = f"{tmp_path}/out/{got['a.pdf'].job_id}/output/figures/figure_p002_0.png"
    assert open(figure, "rb").read() == b"t"
    run()
    assert asked() == ["<", "t", "t", "x", "x", "x", "x"]  # what failed is tried again, the rest is known


def test_answers_of_pictures(spark, tmp_path):
    rows = spark.createDataFrame([("a", b"<"), ("b", b"t"), ("c", b"x"), ("d", None)], "sha256 string, image binary")
    got = {r.sha256: (r.json is not None, r.attempts, r.error and r.error["class"]) for r in vision.answered(rows, Model(tmp_path)).collect()}
    assert got == {"a": (True, 1, None), "b": (True, 2, None), "c": (False, 2, "FigurePoisonPillError"), "d": (False, 0, "FigureSummarizationError")}
