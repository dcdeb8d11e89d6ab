import hashlib

import pytest

from folio.operators import routing
from folio.sources import files, html, listing


def profile(spark, page):
    return html.html_profile(spark.createDataFrame([(1, page)], "page_id long, html string"))


def test_html_profile(spark):
    r = profile(spark, "<table><tr><td colspan=2></td><td></td></tr></table>").first()
    assert (r.tables["max_column_count"], r.tables["has_merged_cells"], r.tables["has_nested_tables"]) == (3, True, False)
    r = profile(spark, "<title>T</title><script>var a = 1</script><p>Figure 1  shows</p><figure><img src=a.png alt='An image'><figcaption>cap</figcaption></figure><svg></svg>" + "<p>" + "x" * 500 + "</p>").first()
    assert r.text["total_characters"] == 1 + 1 + 14 + 1 + 3 + 1 + 240
    assert r.visuals["embedded_image_count"] == 1 and r.visuals["svg_count"] == 1 and r.visuals["captioned_visual_count"] == 3
    assert [c.kind for c in r.visual_candidates] == ["embedded_image", "figure_element", "svg"]
    got = routing.routed(routing.requirements(profile(spark, "<svg></svg>"))).first()
    assert (got.engine, got.confidence, got.requirements["needs_ocr"], got.requirements["needs_visual_semantics"]) == ("docling", 0.98, True, True)
    assert profile(spark, None).first().page_or_unit_count == 1
    r = profile(spark, f"<table><tr><td colspan={'9' * 6000}></td><td colspan=9999999999></td><td colspan=00></td></tr></table>").first()
    assert (r.tables["max_column_count"], r.tables["has_merged_cells"]) == (2**31 - 1, True)


def test_scans(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF-1.4 x")
    (tmp_path / "b.html").write_bytes(b"<html></html>")
    (tmp_path / "c.txt").write_bytes(b"no")
    (tmp_path / "d.docx").write_bytes(b"")
    (tmp_path / "e.md").write_text("# A\ntext")
    (tmp_path / "f.bin").write_bytes(b"%PDF-1.7 by its first bytes")
    (tmp_path / "_g.HTM").write_bytes(b"hidden")
    (tmp_path / ".h").write_bytes(b"<!DOCTYPE html>")
    (tmp_path / "i.pdf").write_bytes(b"x" * 101)
    with open(tmp_path / "j.pdf", "wb") as f:  # larger than any array, without its bytes
        f.truncate(5 << 30)
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "k.pptx").write_bytes(b"deeper")
    rows = files.scan_documents(spark, str(tmp_path), max_bytes=100)
    got = {r.path.rsplit("/", 1)[1]: (r.document_type, r.reject_reason, r.length, r.error and r.error["class"]) for r in rows.collect()}
    assert got == {
        "a.pdf": ("pdf", None, 10, None), "b.html": ("html", None, 13, None), "c.txt": (None, "unsupported", 2, "DocumentError"), "d.docx": ("docx", "empty", 0, "DocumentError"), "e.md": (None, "unsupported", 8, "DocumentError"), "f.bin": ("pdf", None, 27, None),
        "_g.HTM": ("html", None, 6, None), ".h": ("html", None, 15, None), "i.pdf": ("pdf", "too_large", 101, "DocumentTooLargeError"), "j.pdf": ("pdf", "too_large", 5 << 30, "DocumentTooLargeError"),
    }
    first = rows.filter("document_type = 'pdf' AND reject_reason IS NULL").orderBy("path").first()
    assert bytes(first.content) == b"%PDF-1.4 x" and first.job_id == hashlib.sha256(b"%PDF-1.4 x").hexdigest()
    assert rows.filter("reject_reason IS NOT NULL AND (content IS NOT NULL OR job_id IS NOT NULL)").count() == 0
    assert [r.path.rsplit("/", 1)[1] for r in files.collected(rows).collect()] == ["_g.HTM", "a.pdf", "b.html"]
    deep = files.scan_documents(spark, f"file://{tmp_path}", recursive=True, content=False)
    assert deep.count() == 11 and deep.filter("content IS NOT NULL").count() == 0 and deep.filter("path LIKE '%sub/k.pptx'").first().job_id
    assert [r.document_type for r in files.scan_documents(spark, str(tmp_path / "b.html")).collect()] == ["html"]
    (tmp_path / "none").mkdir()
    assert files.scan_documents(spark, str(tmp_path / "none")).collect() == []
    with pytest.raises(Exception, match="neither a file nor a folder"):
        files.scan_documents(spark, str(tmp_path / "missing")).collect()


def test_files_are_packed_by_bytes(tmp_path, monkeypatch):
    for k in range(10):
        (tmp_path / f"{k}.pdf").write_bytes(b"x" * 10 * k)
    monkeypatch.setattr(listing, "PARTITION_BYTES", 100)
    parts = listing.FileReader({"path": str(tmp_path)}).partitions()
    assert sorted(r for p in parts for r in p.rows) == [(f"{tmp_path}/{k}.pdf", 10 * k) for k in range(10)]
    assert all(sum(n for _, n in p.rows) <= 100 for p in parts) and len(parts) == 6
    monkeypatch.setattr(listing, "BATCH_BYTES", 50)
    assert [b.num_rows for b in listing.FileReader({"path": str(tmp_path)}).read(parts[0])] == [4, 1]


def test_scan_by_spark_alone(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF-1.4 x")
    (tmp_path / "b.txt").write_bytes(b"no")
    (tmp_path / "c.pdf").write_bytes(b"x" * 101)
    got = files.spark_scan(spark, str(tmp_path), False, True, 100)
    assert sorted((r.path.rsplit("/", 1)[1], r.document_type, r.reject_reason, r.content is None) for r in got.collect()) == [("a.pdf", "pdf", None, False), ("b.txt", None, "unsupported", True), ("c.pdf", "pdf", "too_large", True)]


def test_page_limit_and_markdown(spark, tmp_path):
    (tmp_path / "e.md").write_text("# A\ntext")
    limit = files.within_page_limit(spark.createDataFrame([(500,), (501,), (None,)], "page_or_unit_count int"))
    assert [(r.reject_reason, r.error and r.error["context"]["max_pages"]) for r in limit.collect()] == [(None, None), ("too_many_pages", "500"), (None, None)]
    assert [r.md for r in files.scan_markdown(spark, str(tmp_path)).collect()] == ["# A\ntext"]


def test_few_pages_are_held_at_once(spark):
    """A batch of Spark's has up to 10,000 pages; what is made of them leaves in smaller ones."""
    import pyarrow as pa
    from types import SimpleNamespace

    frame = SimpleNamespace(dtypes=[("k", "bigint")], mapInArrow=lambda run, schema: run)
    frame.select = lambda *names: frame
    n = 2 * html.PAGES + 1
    batch = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array([f"<p>page {k}<img src='{k}'>" for k in range(n)])], ["k", "html"])
    out = list(html.parsed(frame, "k")(iter([batch])))
    assert max(b.num_rows for b in out) == html.PAGES
    assert [(k, t[0]["text"], e[0]["src"]) for b in out for k, t, e in zip(*(b.column(c).to_pylist() for c in ("k", "texts", "tags")))] == [(k, f"page {k}", str(k)) for k in range(n)]


def test_names_of_documents_do_not_pass_through_messages(spark, tmp_path):
    import pickle

    from folio.sources.document_sink import DocumentWriter

    sizes = []
    for n in (1, 500):
        writer = DocumentWriter(str(tmp_path / str(n)), ["name", "text"])
        message = writer.write(iter([{"name": f"d/{'x' * 60}{k}", "text": str(k)} for k in range(n)]))
        sizes.append(len(pickle.dumps(message)))
        writer.commit([message, None])
        assert sorted(f.name for f in (tmp_path / str(n)).iterdir()) == ["d"] and len(list((tmp_path / str(n) / "d").iterdir())) == n
    assert sizes[1] <= sizes[0] + 8


def test_large_pages_are_not_held_together_nor_is_a_batch(spark):
    import pyarrow as pa
    from types import SimpleNamespace

    frame = SimpleNamespace(dtypes=[("k", "bigint")], mapInArrow=lambda run, schema: run)
    frame.select = lambda *names: frame
    size, before, held = 300_000, pa.total_allocated_bytes(), []

    def batches():
        for at in (0, 40, 80, 80):
            n = 40 if at < 80 else 0
            held.append(pa.total_allocated_bytes() - before)
            made = pa.RecordBatch.from_arrays([pa.array(range(at, at + n), pa.int64()), pa.array(["<p>" + "x" * size] * n, pa.string())], ["k", "html"])
            yield made
            del made

    keys = []
    for out in html.parsed(frame, "k")(batches()):
        assert out.num_rows * size < 2 << 20
        keys += out.column("k").to_pylist()
        del out
    assert keys == list(range(80)) and max(held) < 40 * size / 2
