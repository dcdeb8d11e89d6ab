"""SRC-7, SRC-8: Word and PowerPoint files as rows of what their XML has; the totals are DataFrame work (operators/evidence.py).

A file that can't be read gives a row with error set and nothing else.
"""

from __future__ import annotations

import io
import posixpath
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame

#: Namespaces of the formats.
NS = {
    "w": "http://schemas.openxmlformats.org/wordprocessingml/2006/main",
    "wp": "http://schemas.openxmlformats.org/drawingml/2006/wordprocessingDrawing",
    "a": "http://schemas.openxmlformats.org/drawingml/2006/main",
    "p": "http://schemas.openxmlformats.org/presentationml/2006/main",
    "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
    "rel": "http://schemas.openxmlformats.org/package/2006/relationships",
    "ct": "http://schemas.openxmlformats.org/package/2006/content-types",
}

DOCX = "job_id string, error string, paragraphs array<string>, cell_paragraphs array<string>, tables array<struct<columns:int,merged:boolean,nested:boolean>>, section_columns array<int>, text_boxes boolean, inline_images int, archive_images int"
SHAPE = "struct<kind:string,text:string,width:double,height:double,columns:int,merged:boolean>"
PPTX = f"job_id string, error string, slide_count int, slide_area double, slide_number int, shapes array<{SHAPE}>"


def q(name: str) -> str:
    prefix, local = name.split(":")
    return f"{{{NS[prefix]}}}{local}"


def part(archive: zipfile.ZipFile, name: str) -> ET.Element:
    return ET.fromstring(archive.read(name))


def targets(archive: zipfile.ZipFile, name: str) -> dict[str, str]:
    """Parts in the file that a part refers to, by the id of the reference."""
    folder, base = posixpath.split(name)
    found = [r for r in references(archive, posixpath.join(folder, "_rels", f"{base}.rels")) if r.get("TargetMode") != "External"]
    return {r.get("Id"): posixpath.normpath(posixpath.join("/" + folder, r.get("Target"))).lstrip("/") for r in found}


def references(archive: zipfile.ZipFile, name: str) -> list[ET.Element]:
    return list(part(archive, name).iter(q("rel:Relationship"))) if name in archive.namelist() else []


def main_part(archive: zipfile.ZipFile, usual: str) -> str:
    found = [r.get("Target").lstrip("/") for r in references(archive, "_rels/.rels") if r.get("Type", "").endswith("/officeDocument")]
    return found[0] if found else usual


def content_types(archive: zipfile.ZipFile) -> Callable[[str], str]:
    types = part(archive, "[Content_Types].xml")
    named = {o.get("PartName", "").lstrip("/").lower(): o.get("ContentType", "") for o in types.iter(q("ct:Override"))}
    by_suffix = {d.get("Extension", "").lower(): d.get("ContentType", "") for d in types.iter(q("ct:Default"))}
    return lambda name: named.get(name.lower(), by_suffix.get(name.rpartition(".")[2].lower(), ""))


def word_text(paragraph: ET.Element) -> str:
    """Of the runs that stand in the paragraph itself or in a link of it."""
    marks = {q("w:tab"): "\t", q("w:cr"): "\n", q("w:noBreakHyphen"): "-"}
    runs = [r for c in paragraph if c.tag in (q("w:r"), q("w:hyperlink")) for r in ([c] if c.tag == q("w:r") else c.findall("w:r", NS))]
    out = []
    for x in (x for r in runs for x in r):
        if x.tag == q("w:t"):
            out.append(x.text or "")
        elif x.tag == q("w:br"):
            out.append("\n" if x.get(q("w:type"), "textWrapping") == "textWrapping" else "")
        else:
            out.append(marks.get(x.tag, ""))
    return "".join(out)


def span(cell: ET.Element) -> int:
    found = cell.find("w:tcPr/w:gridSpan", NS)
    return int(found.get(q("w:val"), 1)) if found is not None else 1


def cells(table: ET.Element) -> list[list[ET.Element]]:
    """Cells of each row: a merged one stands at every grid place it covers, also in the rows below its first."""
    rows: list[list[ET.Element]] = []
    above: dict[int, ET.Element] = {}
    for tr in table.findall("w:tr", NS):
        before = tr.find("w:trPr/w:gridBefore", NS)
        at, row, here = int(before.get(q("w:val"), 0)) if before is not None else 0, [], {}
        for tc in tr.findall("w:tc", NS):
            merge = tc.find("w:tcPr/w:vMerge", NS)
            goes_on = merge is not None and merge.get(q("w:val"), "continue") == "continue"
            cell = above.get(at, tc) if goes_on else tc
            row += [cell] * span(cell)
            here.update(dict.fromkeys(range(at, at + span(tc)), cell))
            at += span(tc)
        above = here
        rows.append(row)
    return rows


def docx_rows(job_id: str, content: bytes) -> Iterator[tuple]:
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        main = main_part(archive, "word/document.xml")
        body, kind = part(archive, main).find("w:body", NS), content_types(archive)
        tables = body.findall("w:tbl", NS)
        grids = [[c for row in cells(t) for c in row] for t in tables]
        columns = [int(n) for s in body.iter(q("w:sectPr")) if (c := s.find("w:cols", NS)) is not None and (n := c.get(q("w:num"), "")).isdigit()]
        facts = [
            {"columns": len(t.findall("w:tblGrid/w:gridCol", NS)), "merged": any(c.find(f".//{m}", NS) is not None for c in grid for m in ("w:gridSpan", "w:vMerge")), "nested": any(c.find("w:tbl", NS) is not None for c in grid)}
            for t, grid in zip(tables, grids, strict=True)
        ]
        yield (
            job_id, None, [s for p in body.findall("w:p", NS) if (s := word_text(p)).strip()], [s for grid in grids for c in grid for p in c.findall("w:p", NS) if (s := word_text(p)).strip()], facts, columns,
            next(body.iter(q("w:txbxContent")), None) is not None, len(body.findall(".//w:p/w:r/w:drawing/wp:inline", NS)), sum(kind(t).startswith("image/") for t in targets(archive, main).values()),
        )


def slide_text(shape: ET.Element) -> str:
    def said(paragraph):
        return "".join("\v" if x.tag == q("a:br") else x.findtext("a:t", "", NS) for x in paragraph if x.tag in (q("a:r"), q("a:br"), q("a:fld")))

    return "\n".join(said(p) for p in shape.findall("p:txBody/a:p", NS))


def number(x: ET.Element, name: str) -> int:
    return int(x.get(name, 1))


def shape_row(x: ET.Element) -> dict | None:
    kinds = {q("p:sp"): "text", q("p:pic"): "image", q("p:grpSp"): "drawing", q("p:cxnSp"): "drawing", q("p:graphicFrame"): "frame"}
    if x.tag not in kinds:
        return None
    kind, size = kinds[x.tag], next((e for path in ("p:spPr/a:xfrm/a:ext", "p:grpSpPr/a:xfrm/a:ext", "p:xfrm/a:ext") if (e := x.find(path, NS)) is not None), None)
    row = {"kind": kind, "text": slide_text(x) if kind == "text" else None, "width": float(size.get("cx", 0)) if size is not None else 0.0, "height": float(size.get("cy", 0)) if size is not None else 0.0, "columns": 0, "merged": False}
    if kind == "image" and (x.find("p:nvPicPr/p:nvPr/p:ph", NS) is not None or x.find("p:nvPicPr/p:nvPr/a:videoFile", NS) is not None):
        row["kind"] = "other"  # a placeholder's picture or a film
    if kind == "frame":
        data = x.find("a:graphic/a:graphicData", NS)
        row["kind"] = {"table": "table", "chart": "chart"}.get((data.get("uri", "") if data is not None else "").rpartition("/")[2], "other")
        if row["kind"] == "table":
            starts = [number(c, "gridSpan") > 1 and c.get("vMerge") not in ("1", "true") or number(c, "rowSpan") > 1 and c.get("hMerge") not in ("1", "true") for c in x.iter(q("a:tc"))]
            row |= {"columns": len(x.findall("a:graphic/a:graphicData/a:tbl/a:tblGrid/a:gridCol", NS)), "merged": any(starts)}
    return row


def pptx_rows(job_id: str, content: bytes) -> Iterator[tuple]:
    """A row for each slide; one without number for a file without slides."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        main = main_part(archive, "ppt/presentation.xml")
        deck, parts = part(archive, main), targets(archive, main)
        size, slides = deck.find("p:sldSz", NS), deck.findall("p:sldIdLst/p:sldId", NS)
        area = float(size.get("cx", 0)) * float(size.get("cy", 0)) if size is not None else 0.0
        for i, slide in enumerate(slides, 1):
            tree = part(archive, parts[slide.get(q("r:id"))]).find("p:cSld/p:spTree", NS)
            yield job_id, None, len(slides), area, i, [s for x in tree if (s := shape_row(x))]
        if not slides:
            yield job_id, None, 0, area, None, []


def read_by(rows_of: Callable[[str, bytes], Iterator[tuple]], schema: str, files: DataFrame) -> DataFrame:
    names = [field.split()[0] for field in schema.replace("struct<", "").split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for job_id, content in pdf.itertuples(index=False):
                try:
                    out = list(rows_of(job_id, content or b""))
                except (zipfile.BadZipFile, ET.ParseError, KeyError, AttributeError, ValueError, NotImplementedError, RuntimeError, EOFError) as e:
                    out = [(job_id, f"{type(e).__name__}: {e}", *[None] * (len(names) - 2))]
                yield pd.DataFrame(out, columns=names).astype(object).where(lambda d: d.notna(), None)

    return files.select("job_id", "content").mapInPandas(run, schema)


def docx_files(files: DataFrame) -> DataFrame:
    """files: job_id, content. A row for each file."""
    return read_by(docx_rows, DOCX, files)


def pptx_slides(files: DataFrame) -> DataFrame:
    """files: job_id, content. A row for each slide."""
    return read_by(pptx_rows, PPTX, files)
