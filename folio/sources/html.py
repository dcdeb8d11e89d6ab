"""HTML pages: a parser lists what it meets in order, and DataFrame expressions make the profile of it."""

from __future__ import annotations

from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.functions import text as T

CANDIDATE = "struct<kind:string,page_number:int,location_label:string,area_ratio:double,caption_or_alt_text:string,nearby_text:string,evidence:array<string>>"
PARSED = "texts array<struct<text:string,caption:boolean>>, tags array<struct<name:string,alt:string,src:string,colspan:string,rowspan:string>>, widest int, nested boolean"
#: Tags that the profile counts.
TAGS = {"table", "td", "th", "figure", "img", "svg"}

#: Pages, and bytes of them, whose parts are held at once; Spark hands out up to 10,000 in a batch, and a page's parts take many times its bytes.
PAGES = 128
BYTES = 1 << 20


def span(value: str | None) -> int:
    """T-16, as text.span_of."""
    digits = value.lstrip("0") if value and value.isascii() and value.isdigit() else ""
    return min(int(digits[:11]), T.MOST) if digits else 1


class Page(HTMLParser):
    """What the profile asks of a page, in order: texts outside scripts and styles, with whether they lie in a caption; tags; the most columns of a row that ends; whether a table begins inside another."""

    def __init__(self):
        super().__init__()
        self.texts, self.tags = [], []
        self.code = self.caption = self.nested = False
        self.depth = self.row = self.widest = 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.code = True
        elif tag == "figcaption":
            self.caption = True
        elif tag == "tr":
            self.row = 0
        elif tag in TAGS:
            a = dict(attrs)
            self.tags.append((tag, a.get("alt"), a.get("src"), a.get("colspan"), a.get("rowspan")))
            if tag == "table":
                self.nested |= self.depth > 0
                self.depth += 1
            elif tag in ("td", "th"):
                self.row += span(a.get("colspan"))

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.code = False
        elif tag == "figcaption":
            self.caption = False
        elif tag == "table":
            self.depth = max(self.depth - 1, 0)
        elif tag == "tr":
            self.widest = min(max(self.widest, self.row), T.MOST)

    def handle_data(self, data):
        if not self.code:
            self.texts.append((data, self.caption))


def listed(rows: list[list[tuple]], names: list[str], kinds: list[pa.DataType]) -> pa.ListArray:
    """A list of structs for each row."""
    flat = [x for row in rows for x in row]
    columns = [pa.array([x[k] for x in flat], kind) for k, kind in enumerate(kinds)]
    ends = [0]
    for row in rows:
        ends.append(ends[-1] + len(row))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(columns, names))


def parsed(pages: DataFrame, key: str) -> DataFrame:
    """SRC-5: key and PARSED of each page. html is a text, or bytes in UTF-8 of which those that are none are left out."""
    text, kind = pa.string(), dict(pages.dtypes)[key]

    def made(keys, found, kind_of_key):
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, kind_of_key), listed([p.texts for p in found], ["text", "caption"], [text, pa.bool_()]), listed([p.tags for p in found], ["name", "alt", "src", "colspan", "rowspan"], [text] * 5), pa.array([p.widest for p in found], pa.int32()), pa.array([p.nested for p in found], pa.bool_())],
            [key, "texts", "tags", "widest", "nested"],
        )

    def run(batches):
        keys, found, held = [], [], 0
        for batch in batches:
            names, sources = batch.column(key), batch.column("html")
            kind_of_key = names.type
            for name, source in zip(names, sources):
                source = source.as_py() or ""
                keys.append(name.as_py())
                found.append(page := Page())
                page.feed(source.decode("utf-8", "ignore") if isinstance(source, bytes) else source)
                held += len(source)
                if len(found) == PAGES or held >= BYTES:
                    yield made(keys, found, kind_of_key)
                    keys, found, held = [], [], 0
            batch = names = sources = name = None  # so that no batch is held when the next comes
        if found:
            yield made(keys, found, kind_of_key)

    return pages.select(key, "html").mapInArrow(run, f"{key} {kind}, {PARSED}")


def html_profile(pages: DataFrame, per_page: int = 2000, keep: int = 10, key: str = "page_id") -> DataFrame:
    """G-13, A-11: the evidence structs of each page (key, html)."""
    e = F.col("tags")
    count = lambda name: F.size(F.filter(e, lambda x: x["name"] == name)).cast("int")
    said = F.filter(F.transform("texts", lambda x: F.struct(T.compact(x["text"]).alias("text"), x["caption"].alias("caption"))), lambda x: x["text"].isNotNull())
    rows = parsed(pages, key).withColumn("said", said).drop("texts")
    texts = F.col("said.text")
    rows = rows.withColumn("total_characters", F.length(F.array_join(texts, "\n")).cast("long")).withColumn("pages", T.estimated_pages(F.col("total_characters"), per_page))
    tagged = F.size(F.filter("said", lambda x: x["caption"] | T.has_caption(x["text"])))
    merged = F.exists(e, lambda x: x["name"].isin("td", "th") & ((T.span_of(x["colspan"]) > 1) | (T.span_of(x["rowspan"]) > 1)))
    label = lambda x: F.when(x["name"] == "img", T.compact(x["src"], 120)).when(x["name"] == "svg", "inline <svg> element").otherwise(F.concat(F.lit("html <"), x["name"], F.lit("> element")))
    found = F.transform(F.filter(e, lambda x: x["name"].isin("img", "svg", "figure", "table")), lambda x: F.struct(
        F.when(x["name"] == "img", "embedded_image").when(x["name"] == "figure", "figure_element").otherwise(x["name"]).alias("kind"), F.lit(None).cast("int").alias("page_number"), label(x).alias("location_label"), F.lit(None).cast("double").alias("area_ratio"),
        F.when(x["name"] == "img", T.compact(x["alt"])).alias("caption_or_alt_text"), F.lit(None).cast("string").alias("nearby_text"), F.array(F.concat(F.lit("<"), x["name"], F.lit("> tag found in HTML source"))).alias("evidence"),
    ))
    from folio.operators.routing import top_candidates

    p = F.col("pages").cast("int")
    visual = count("img") + count("svg") + count("figure")
    return rows.select(
        key, F.lit("html").alias("file_type"), p.alias("page_or_unit_count"),
        F.struct(F.col("total_characters"), F.when(F.col("total_characters") > 0, p).otherwise(0).alias("pages_or_units_with_text"), (F.col("total_characters") / F.greatest(p, F.lit(1))).alias("estimated_text_density"), (F.col("total_characters") > 0).alias("native_text_available")).alias("text"),
        F.struct(count("table").alias("count"), F.least(count("table"), p).alias("pages_or_units_with_tables"), F.lit(0).alias("large_count"), F.col("widest").alias("max_column_count"), merged.alias("has_merged_cells"), F.col("nested").alias("has_nested_tables")).alias("tables"),
        F.struct(F.lit(1).alias("column_count"), F.lit(False).alias("has_floating_text_boxes")).alias("layout"),
        F.struct(count("img").alias("embedded_image_count"), F.lit(0).alias("large_embedded_image_count"), F.lit(0).alias("vector_graphics_count"), F.lit(0).alias("chart_count"), count("svg").alias("svg_count"), F.least(visual, p).alias("pages_or_units_with_visuals"), (tagged + F.size(F.filter(texts, T.has_caption))).cast("int").alias("captioned_visual_count")).alias("visuals"),
        top_candidates(found, keep, by_area=False).alias("visual_candidates"),
    )
