"""Markdown to sections (parents). A document stays in its row: array functions do the scan, so nothing is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions import text as T

STACK = "struct<stack:array<struct<level:int,title:string>>,paths:array<array<string>>>"


def let(value: Column, body) -> Column:
    """body(value) with value computed once a row."""
    return F.transform(F.array(value), body)[0]


def sections(md: Column) -> Column:
    """array<struct<section_no, title, level, start_line, content, parents>>: G-2, W-1, W-2.

    Lines before the first header belong to a section `Document` of level 1, which stays on the breadcrumb.
    """

    def heads(all_lines: Column) -> Column:
        found = F.filter(
            F.transform(all_lines, lambda x, i: F.struct(i.alias("at"), F.length(F.regexp_extract(x, T.HEADER, 1)).cast("int").alias("level"), F.regexp_extract(x, T.HEADER, 2).alias("title"), (i + 1).alias("start_line"))),
            lambda h: h["level"] > 0,
        )
        start = F.array(F.struct(F.lit(-1).alias("at"), F.lit(1).alias("level"), F.lit("Document").alias("title"), F.lit(1).alias("start_line")))
        return F.when((F.size(all_lines) > 0) & (F.size(F.filter(found, lambda h: h["at"] == 0)) == 0), F.concat(start, found)).otherwise(found)

    def crumbs(hs: Column) -> Column:
        def step(s, h):
            above = F.filter(s["stack"], lambda x: x["level"] < h["level"])
            return F.struct(F.array_append(above, F.struct(h["level"].alias("level"), h["title"].alias("title"))).alias("stack"), F.array_append(s["paths"], F.transform(above, lambda x: x["title"])).alias("paths"))

        return F.aggregate(hs, F.struct(F.array(), F.array()).cast(STACK), step, lambda s: s["paths"])

    def of(all_lines: Column, hs: Column, paths: Column) -> Column:
        def one(h, k):
            stop = F.coalesce(F.get(hs, k + 1)["at"], F.size(all_lines))
            return F.struct(
                k.cast("long").alias("section_no"), h["title"].alias("title"), h["level"].alias("level"), h["start_line"].alias("start_line"),
                F.slice(all_lines, h["at"] + 2, stop - h["at"] - 1).alias("content"), F.get(paths, k).alias("parents"),
            )

        return F.transform(hs, one)

    return let(T.lines(md), lambda a: let(heads(a), lambda h: let(crumbs(h), lambda p: of(a, h, p))))


def explode_sections(docs: DataFrame, md: str = "md") -> DataFrame:
    """The other columns of docs and those of each section."""
    return docs.select(*[c for c in docs.columns if c != md], F.explode(sections(F.col(md))).alias("s")).select(*[c for c in docs.columns if c != md], "s.*")


def parent_chunks(secs: DataFrame, key: str) -> DataFrame:
    """G-3: one for each section, with a stable id."""
    text = T.strip(F.array_join("content", "\n"))
    return secs.select(
        "*",
        F.sha2(F.concat_ws("|", F.col(key).cast("string"), F.col("section_no").cast("string")), 256).alias("chunk_id"),
        F.array_join(F.array_append("parents", F.col("title")), " > ").alias("section_path"),
        (F.col("start_line") + F.size("content") - 1).cast("long").alias("end_line"),
        text.alias("page_content"), T.token_count(text).alias("token_count"),
    )
