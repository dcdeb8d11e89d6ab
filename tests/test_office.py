"""Word and PowerPoint files made here, part by part, and their profiles."""

import io
import zipfile

from folio.operators import evidence, profiles, routing
from folio.sources import files as scanned
from folio.sources import office

W, WP, A, P, R = (f'xmlns:{k}="{office.NS[k]}"' for k in ("w", "wp", "a", "p", "r"))
REL = f'xmlns="{office.NS["rel"]}"'
CT = f'<Types xmlns="{office.NS["ct"]}"><Default Extension="PNG" ContentType="image/png"/><Override PartName="/word/odd.bin" ContentType="image/gif"/></Types>'


def zipped(parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        for name, text in parts.items():
            archive.writestr(name, text)
    return out.getvalue()


def docx(body, rels=""):
    return zipped({"[Content_Types].xml": CT, "word/document.xml": f"<w:document {W} {WP} {A}><w:body>{body}</w:body></w:document>", "word/_rels/document.xml.rels": f"<Relationships {REL}>{rels}</Relationships>"})


def para(*texts):
    return "<w:p>" + "".join(f"<w:r><w:t>{t}</w:t></w:r>" for t in texts) + "</w:p>"


def test_docx(spark):
    merged = (
        "<w:tbl><w:tblGrid><w:gridCol/><w:gridCol/><w:gridCol/></w:tblGrid>"
        f"<w:tr><w:tc><w:tcPr><w:gridSpan w:val='2'/></w:tcPr>{para('ab')}</w:tc><w:tc><w:tcPr><w:vMerge w:val='restart'/></w:tcPr>{para('c')}</w:tc></w:tr>"
        f"<w:tr><w:tc>{para('d')}<w:tbl/></w:tc><w:tc>{para('e')}</w:tc><w:tc><w:tcPr><w:vMerge/></w:tcPr>{para('hidden')}</w:tc></w:tr></w:tbl>"
    )
    link = "<w:p><w:hyperlink><w:r><w:t>Figure 2</w:t><w:br/><w:t>x</w:t><w:tab/></w:r></w:hyperlink><w:ins><w:r><w:t>new</w:t></w:r></w:ins></w:p>"
    image = "<w:p><w:r><w:drawing><wp:inline/></w:drawing></w:r></w:p>"
    rels = "".join(f"<Relationship Id='r{i}' Target='{t}' {m}/>" for i, (t, m) in enumerate([("media/a.png", ""), ("odd.bin", ""), ("styles.xml", ""), ("http://x/y.png", "TargetMode='External'")]))
    full = docx(para("one", " two") + para("  ") + link + merged + image + "<w:sectPr><w:cols w:num='3'/></w:sectPr>", rels)
    files = spark.createDataFrame([("full", full), ("plain", docx(para("x" * 4001) + "<w:p><w:r><w:txbxContent/></w:r></w:p>")), ("none", docx("")), ("bad", b"PK no zip"), ("null", None)], "job_id string, content binary")
    raw = {r.job_id: r for r in office.docx_files(files).collect()}
    assert raw["full"].paragraphs == ["one two", "Figure 2\nx\t"] and raw["full"].cell_paragraphs == ["ab", "ab", "c", "d", "e", "c"]
    assert raw["bad"].error and raw["null"].error and raw["bad"].paragraphs is None
    got = {r.job_id: r for r in routing.routed(routing.requirements(evidence.docx_profile(office.docx_files(files)))).collect()}
    assert set(got) == {"full", "plain", "none"}
    f = got["full"]
    assert f.text["total_characters"] == len("\n".join(["one two", "Figure 2\nx\t", "ab", "ab", "c", "d", "e", "c"])) and f.page_or_unit_count == 1
    assert tuple(f.tables) == (1, 1, 0, 3, True, True) and tuple(f.layout) == (3, False)
    assert tuple(f.visuals) == (2, 0, 0, 0, 0, 1, 1)
    assert [(c.kind, c.nearby_text, c.evidence) for c in f.visual_candidates] == [("embedded_image", "Figure 2 x", ["2 image(s) found (text-flow count: 1, zip-archive count: 2)"]), ("table", None, ["1 Word table object(s) found"])]
    assert (f.engine, f.reason) == ("mineru", "reading_order")
    assert got["plain"].page_or_unit_count == 3 and tuple(got["plain"].layout) == (1, True) and got["plain"].visual_candidates == []
    assert (got["none"].text["total_characters"], got["none"].text["pages_or_units_with_text"], got["none"].page_or_unit_count, got["none"].reason) == (0, 0, 1, "ocr")


def sized(tag, inner, cx, cy):
    return f"<p:{tag}>{inner}<p:spPr><a:xfrm><a:ext cx='{cx}' cy='{cy}'/></a:xfrm></p:spPr></p:{tag}>"


def box(*lines):
    return "<p:sp><p:txBody>" + "".join(f"<a:p><a:r><a:t>{t}</a:t></a:r></a:p>" for t in lines) + "</p:txBody></p:sp>"


def frame(uri, inner=""):
    return f"<p:graphicFrame><p:xfrm><a:ext cx='50' cy='50'/></p:xfrm><a:graphic><a:graphicData uri='http://x/{uri}'>{inner}</a:graphicData></a:graphic></p:graphicFrame>"


def pptx(*slides):
    order = range(len(slides), 0, -1)  # file numbers run against the order of the deck
    parts = {f"ppt/slides/slide{n}.xml": f"<p:sld {P} {A}><p:cSld><p:spTree><p:grpSpPr/>{s}</p:spTree></p:cSld></p:sld>" for n, s in zip(order, slides, strict=True)}
    ids = "".join(f"<p:sldId r:id='r{n}'/>" for n in order)
    rels = "".join(f"<Relationship Id='r{n}' Target='slides/slide{n}.xml'/>" for n in order)
    root = f"<Relationships {REL}><Relationship Type='http://x/officeDocument' Target='/ppt/deck.xml'/></Relationships>"
    return zipped({**parts, "_rels/.rels": root, "ppt/deck.xml": f"<p:presentation {P} {R}><p:sldIdLst>{ids}</p:sldIdLst><p:sldSz cx='100' cy='100'/></p:presentation>", "ppt/_rels/deck.xml.rels": f"<Relationships {REL}>{rels}</Relationships>"})


def test_pptx(spark):
    table = frame("table", "<a:tbl><a:tblGrid><a:gridCol/><a:gridCol/></a:tblGrid><a:tr><a:tc gridSpan='2'/><a:tc hMerge='1'/></a:tr></a:tbl>")
    placed = "<p:pic><p:nvPicPr><p:nvPr><p:ph/></p:nvPr></p:nvPicPr></p:pic>"
    first = sized("pic", "", 10, 10) + box("Title") + table + box("Figure 1: all", "more") + sized("pic", "", 40, 50) + placed
    second = "<p:cxnSp/>" * 5 + "<p:grpSp/>" * 2 + frame("chart") + "<p:sp/>"
    files = spark.createDataFrame([("deck", pptx(first, second)), ("empty", pptx()), ("bad", b"")], "job_id string, content binary")
    slides = office.pptx_slides(files)
    raw = slides.collect()
    assert [r.job_id for r in raw if r.error] == ["bad"]
    assert [(r.slide_number, [s.kind for s in r.shapes]) for r in raw if r.job_id == "deck"] == [(1, ["image", "text", "table", "text", "image", "other"]), (2, ["drawing"] * 7 + ["chart", "text"])]
    got = {r.job_id: r for r in routing.routed(routing.requirements(evidence.pptx_profile(slides))).collect()}
    assert set(got) == {"deck", "empty"}
    d = got["deck"]
    assert (d.page_or_unit_count, d.text["total_characters"], d.text["pages_or_units_with_text"]) == (2, 23, 1)
    assert tuple(d.tables) == (1, 1, 0, 2, True, False) and tuple(d.visuals) == (2, 1, 7, 1, 0, 2, 1)
    assert [(c.kind, c.page_number, c.area_ratio, c.nearby_text) for c in d.visual_candidates] == [
        ("table", 1, 0.25, "Title"), ("embedded_image", 1, 0.2, "Figure 1: all more"), ("chart", 2, 0.25, None), ("embedded_image", 1, 0.01, None), ("slide_visual_cluster", 2, None, None),
    ]
    assert d.visual_candidates[4].evidence == ["8 visual shapes on this slide; configured threshold is 8"]
    assert (got["empty"].page_or_unit_count, got["empty"].reason, got["empty"].visual_candidates) == (1, "ocr", [])


def test_profiles_by_type(spark, tmp_path):
    good = docx(para("Figure 1") + para("x" * 4001))
    (tmp_path / "a.docx").write_bytes(good)
    (tmp_path / "copy.docx").write_bytes(good)
    (tmp_path / "b.docx").write_bytes(b"PK no zip")
    (tmp_path / "c.html").write_bytes(b"<p>caf\xe9 \xc3\xa9</p><table><tr><td>1</td></tr></table>")
    (tmp_path / "d.pdf").write_bytes(b"%PDF-1.4")
    (tmp_path / "e.txt").write_bytes(b"text")
    (tmp_path / "f.html").write_bytes(b"<p>" + b" ".join(b"<b>%d</b>" % k for k in range(300_000)) + b"</p>")
    scan = scanned.scan_documents(spark, str(tmp_path))
    got = {r.path.rsplit("/", 1)[1]: r for r in profiles.profiled(scan).collect()}
    assert {k: r.error and (r.error["class"], r.error["message"]) for k, r in got.items()} == {
        "a.docx": None, "copy.docx": None, "b.docx": ("DocumentError", "the document can't be read"), "c.html": None, "d.pdf": ("DocumentError", "no extractor for this type"), "e.txt": ("DocumentError", "the format is not supported"),
        "f.html": ("DocumentTooLargeError", "the document has too many pages"),
    }
    assert got["a.docx"].page_or_unit_count == 3 and got["copy.docx"].visuals == got["a.docx"].visuals and got["f.html"].text is None
    assert (got["c.html"].text["total_characters"], got["c.html"].tables["count"], got["c.html"].file_type) == (len("caf é\n1"), 1, "html")
    pages = lambda rows: evidence.pdf_profile(rows.selectExpr("job_id", "1 AS page_number", "1.0D AS page_width", "1.0D AS page_height", "'text' AS text", "array(1.0D) AS block_left_edges", "cast(array() AS array<struct<x0:double,y0:double,x1:double,y1:double,col_count:int>>) AS table_boxes", "cast(array() AS array<struct<xref:int,x0:double,y0:double,x1:double,y1:double>>) AS image_boxes", "0 AS image_ref_count", "0 AS drawing_count"))
    more = {r.path.rsplit("/", 1)[1]: r for r in profiles.profiled(scan, {"pdf": pages}).collect()}
    assert more["d.pdf"].error is None and more["d.pdf"].page_or_unit_count == 1
    routed = routing.routed(routing.requirements(profiles.profiled(scan).filter("error IS NULL").drop("error")))
    assert {r.engine for r in routed.collect()} == {"docling"}
