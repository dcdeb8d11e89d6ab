"""Sections to atomic blocks to child chunks, as folds over arrays in the section's row."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions import text as T
from folio.operators.sections import let

#: What lines look like.
FENCE, PIPE, QUOTE, ITEM = r"^```", r"^\s*\|", r"^\s*>\s", r"^\s*(?:[-*+]|1\.) "
SEPARATOR = r"^\s*\|?\s*:?-{3,}:?\s*(\|\s*:?-{3,}:?\s*)+\|?\s*$"
STRATEGY = "structure_aware_md_v1"

BLOCK = "struct<kind:string,text:string,start_line:int,end_line:int,tokens:bigint>"
CHUNK = "struct<text:string,kinds:array<string>,start_line:int,end_line:int,strategy:string,token_count:bigint>"


@dataclass(frozen=True)
class ChunkingConfig:
    """Token limit of a child, and the least size at which a buffer is emitted (F-15). The overlap is checked, not applied."""

    child_token_limit: int = 450
    child_overlap_tokens: int = 40
    min_chunk_tokens: int = 60
    keep_tail_text: bool = False

    def __post_init__(self):
        if self.child_token_limit <= 0 or self.min_chunk_tokens <= 0:
            raise ValueError("limits must be positive")
        if not 0 <= self.child_overlap_tokens < self.child_token_limit:
            raise ValueError("overlap must be at least 0 and below the limit")


def line_marks(content: Column) -> Column:
    """Of each line what the scan asks for, with a look at the next line."""

    def one(x, i):
        following = F.coalesce(F.get(content, i + 1), F.lit(""))
        blank = T.strip(x) == ""
        return F.struct(
            x.rlike(FENCE).alias("fence"), x.rlike(QUOTE).alias("quote"), x.rlike(PIPE).alias("pipe"), (x.rlike(PIPE) & (following.rlike(SEPARATOR) | following.rlike(PIPE))).alias("table"),
            x.rlike(SEPARATOR).alias("separator"), x.rlike(ITEM).alias("item"), blank.alias("blank"), x.startswith("  ").alias("deep"),
        )

    return F.transform(content, one)


def block_spans(marks: Column) -> Column:
    """array<struct<kind, first, last>>: G-4 as an automaton over lines. The state is the open block; an unclosed fence yields none."""
    state = "struct<kind:string,first:int,n:int,out:array<struct<kind:string,first:int,last:int>>>"

    def step(s, m):
        i, kind = s["n"], s["kind"]
        runs_on = (
            F.when(kind == "quote", m["quote"])
            .when(kind == "table", m["pipe"] | (m["separator"] & (i == s["first"] + 1)))
            .when(kind == "list", ~m["blank"] & (m["item"] | m["deep"]))
            .when(kind == "para", ~m["blank"] & ~m["quote"] & ~m["pipe"] & ~m["fence"] & ~m["item"])
            .otherwise(kind == "code")
        )
        closes_code = (kind == "code") & m["fence"]
        opened = F.when(m["fence"], "code").when(m["quote"], "quote").when(m["table"], "table").when(m["item"], "list").when(m["blank"], "").otherwise("para")
        ended = F.when((kind == "") | (runs_on & ~closes_code), s["out"]).otherwise(F.array_append(s["out"], F.struct(kind.alias("kind"), s["first"].alias("first"), F.when(closes_code, i).otherwise(i - 1).alias("last"))))
        now = F.when(closes_code, "").when(runs_on, kind).otherwise(opened)
        return F.struct(now.alias("kind"), F.when(runs_on & ~closes_code, s["first"]).otherwise(i).alias("first"), (i + 1).alias("n"), ended.alias("out"))

    def end(s):
        return F.when(s["kind"].isin("", "code"), s["out"]).otherwise(F.array_append(s["out"], F.struct(s["kind"].alias("kind"), s["first"].alias("first"), (s["n"] - 1).alias("last"))))

    return F.aggregate(marks, F.struct(F.lit(""), F.lit(0), F.lit(0), F.array()).cast(state), step, end)


def blocks(content: Column, start_line: Column) -> Column:
    """array<struct<kind, text, start_line, end_line, tokens>>; line numbers count from the header's line, as in the data model."""
    names = F.create_map(*[F.lit(x) for pair in (("quote", "blockquote"), ("table", "table"), ("list", "list"), ("para", "paragraph"), ("code", "code")) for x in pair])

    def of(c: Column) -> Column:
        def one(b):
            text = T.rstrip(F.array_join(F.slice(c, b["first"] + 1, b["last"] - b["first"] + 1), "\n"))
            return F.struct(names[b["kind"]].alias("kind"), text.alias("text"), (start_line + b["first"]).cast("int").alias("start_line"), (start_line + b["last"]).cast("int").alias("end_line"), T.token_count(text).alias("tokens"))

        return F.filter(F.transform(block_spans(line_marks(c)), one), lambda b: T.strip(b["text"]) != "")

    return let(content, of)


def sentence_pieces(text: Column, budget: int) -> Column:
    """G-6: sentences packed greedily; the sum of a piece's sentence tokens stays within budget unless it is one sentence."""
    state = "struct<out:array<string>,buf:string,n:bigint,open:boolean>"

    def step(s, p):
        t = T.token_count(p)
        fits = ~s["open"] | (s["n"] + t <= budget)
        return F.struct(
            F.when(fits, s["out"]).otherwise(F.array_append(s["out"], T.strip(s["buf"]))).alias("out"),
            F.when(~s["open"] | ~fits, p).otherwise(F.concat(s["buf"], F.lit(" "), p)).alias("buf"),
            F.when(fits, s["n"] + t).otherwise(t).alias("n"), F.lit(True).alias("open"),
        )

    return F.aggregate(T.sentences(text), F.struct(F.array(), F.lit(""), F.lit(0), F.lit(False)).cast(state), step, lambda s: F.array_append(s["out"], T.strip(s["buf"])))


def pack(found: Column, config: ChunkingConfig) -> Column:
    """array<chunk>: A-1. A buffer below the minimum outlives an oversize block; a small tail changes the last child's figures only."""
    state = f"struct<ch:array<{CHUNK}>,b:array<{BLOCK}>,n:bigint>"
    limit, least = config.child_token_limit, config.min_chunk_tokens

    def emitted(ch, b, n):
        text = T.strip(F.array_join(F.transform(b, lambda x: x["text"]), "\n\n"))
        chunk = F.struct(text.alias("text"), F.array_sort(F.array_distinct(F.transform(b, lambda x: x["kind"]))).alias("kinds"), b[0]["start_line"].alias("start_line"), F.element_at(b, -1)["end_line"].alias("end_line"), F.lit(STRATEGY).alias("strategy"), n.alias("token_count"))
        return F.when((F.size(b) > 0) & (text != ""), F.array_append(ch, chunk)).otherwise(ch)

    none = F.array().cast(f"array<{BLOCK}>")

    def step(s, b):
        t = b["tokens"]
        grown = s["n"] + F.when(F.size(s["b"]) > 0, 2).otherwise(0) + t
        flush = s["n"] >= least
        pieces = F.transform(sentence_pieces(b["text"], limit), lambda p: F.struct(p.alias("text"), F.array(b["kind"]).alias("kinds"), b["start_line"].alias("start_line"), b["end_line"].alias("end_line"), F.lit(f"{STRATEGY}_split_atomic").alias("strategy"), T.token_count(p).alias("token_count")))
        oversize = F.struct(F.concat(F.when(flush, emitted(s["ch"], s["b"], s["n"])).otherwise(s["ch"]), pieces).alias("ch"), F.when(flush, none).otherwise(s["b"]).alias("b"), F.when(flush, F.lit(0).cast("long")).otherwise(s["n"]).alias("n"))
        joined = F.struct(s["ch"].alias("ch"), F.array_append(s["b"], b).alias("b"), grown.alias("n"))
        fresh = F.struct(emitted(s["ch"], s["b"], s["n"]).alias("ch"), F.array(b).alias("b"), t.alias("n"))
        return F.when(t > limit, oversize).when(grown <= limit, joined).otherwise(fresh)

    def end(s):
        last = F.element_at(s["ch"], -1)
        tail = F.array_join(F.transform(s["b"], lambda x: x["text"]), "\n\n")
        text = F.concat(last["text"], F.lit("\n\n"), tail) if config.keep_tail_text else last["text"]
        folded = F.struct(
            text.alias("text"), F.array_sort(F.array_union(last["kinds"], F.transform(s["b"], lambda x: x["kind"]))).alias("kinds"), last["start_line"].alias("start_line"),
            F.element_at(s["b"], -1)["end_line"].alias("end_line"), last["strategy"].alias("strategy"), (last["token_count"] + s["n"]).alias("token_count"),
        )
        return (
            F.when((s["n"] >= least) | (F.size(s["ch"]) == 0), emitted(s["ch"], s["b"], s["n"]))
            .when(F.size(s["b"]) > 0, F.array_append(F.slice(s["ch"], 1, F.size(s["ch"]) - 1), folded))
            .otherwise(s["ch"])
        )

    return F.aggregate(found, F.struct(F.array(), F.array(), F.lit(0)).cast(state), step, end)


def child_chunks(parents: DataFrame, config: ChunkingConfig = ChunkingConfig()) -> DataFrame:
    """One row for each child, with the parent's columns; its id is stable."""
    packed = parents.withColumn("found", blocks(F.col("content"), F.col("start_line")))
    rows = packed.select(*[c for c in parents.columns if c not in ("content", "page_content", "token_count", "start_line", "end_line")], F.posexplode(pack(F.col("found"), config)).alias("chunk_index", "c"))
    return rows.select(
        *[F.col(c).alias("parent_chunk_id") if c == "chunk_id" else F.col(c) for c in rows.columns if c not in ("chunk_index", "c")],
        F.sha2(F.concat_ws("|", "chunk_id", F.col("chunk_index").cast("string")), 256).alias("chunk_id"), F.col("chunk_index").cast("long").alias("chunk_index"),
        F.col("c.text").alias("page_content"), F.col("c.kinds").alias("block_types"), "c.start_line", "c.end_line", F.col("c.strategy").alias("chunking_strategy"), "c.token_count",
    )
