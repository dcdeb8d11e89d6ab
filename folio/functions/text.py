"""Column functions on text. All are Catalyst expressions; lengths are in code points.

Fixed values of the data model: the caption pattern, decorative terms, token forms, and the white space that strip removes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values.
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
LINE_END = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\u0085  ]"
CAPTION = r"(?i)\b(fig(?:ure)?|chart|diagram|flowchart)\s*[\.:]?\s*\d*"
HEADER = r"^(#{1,6})\s+(.+?)\s*$"
SENTENCE_END = r"(?<=[.!?])(?U)\s+(?=[A-Z0-9>])"
TOKEN = r"\$\{(?:FIG|TBL):[^}]+\}"
PLACEHOLDER = "[Figure: processing failed — see original document]"
DECORATIVE = ("logo", "icon", "header", "footer", "decorative")
DECORATIVE_PHRASES = ("decorative figure", "decorative image", "no clinical content", "stock photo", "this is a logo", "company logo", "watermark")
EXHAUSTION = ("out of memory", "oom", "cuda error")
IMAGE = r"!\[[^\]]*\]\(([^)]+)\)"


#: The characters of SPACE; trimming looks at the ends of a text only.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


MOST = 2**31 - 1


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(SPACES))


def token_count(c: Column) -> Column:
    """T-1: a quarter of the characters, one at least."""
    return F.greatest(F.lit(1), F.floor(F.length(c) / 4)).cast("long")


def compact(c: Column, limit: int = 240) -> Column:
    """T-2: white space collapsed, cut at limit; null if blank."""
    one = strip(F.regexp_replace(c, f"{SPACE}+", " "))
    return F.when(one != "", F.substring(one, 1, limit))


def normalise(c: Column) -> Column:
    """T-3: line ends as LF, at most one blank line in a row, stripped."""
    return strip(F.regexp_replace(F.regexp_replace(c, "\r\n?", "\n"), "\n{3,}", "\n\n"))


def clean_page(c: Column, placeholder: str = PLACEHOLDER) -> Column:
    """T-4: tokens that are left become the placeholder; trailing blanks and blank lines shrink; one LF at the end."""
    swept = F.regexp_replace(c, F.lit(TOKEN), F.lit(placeholder.replace("\\", r"\\").replace("$", r"\$")))
    tidy = F.regexp_replace(F.regexp_replace(swept, r"[ \t]+\n", "\n"), "\n{3,}", "\n\n")
    return F.concat(F.regexp_replace(tidy, r"^\n+|\n+\z", ""), F.lit("\n"))


def lines(c: Column) -> Column:
    """G-1: lines without their ends; an empty text has none."""
    parts = F.split(c, LINE_END, -1)
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.transform(F.array(parts), lambda p: F.when(F.element_at(p, -1) == "", F.slice(p, 1, F.size(p) - 1)).otherwise(p))[0])


def sentences(c: Column) -> Column:
    """T-8: cut after . ! ? before a capital, a digit or a quote."""
    return F.split(c, SENTENCE_END, -1)


def has_caption(c: Column) -> Column:
    """F-5."""
    return c.rlike(CAPTION)


def caption_lines(c: Column) -> Column:
    """F-6: the number of lines with a caption word."""
    return F.size(F.filter(lines(c), has_caption)).cast("long")


def first_caption(c: Column) -> Column:
    """S-3: the first such line, compacted."""
    return compact(F.get(F.filter(lines(c), has_caption), F.lit(0)))


def is_separator_row(c: Column) -> Column:
    """F-9: the row under a table's head: cells of dashes and colons with a dash each."""
    cells = F.split(F.regexp_replace(strip(c), r"^\|+|\|+$", ""), r"\|", -1)
    return F.forall(cells, lambda x: strip(x).rlike(r"^[-: ]*-[-: ]*$"))


def figure_token(job: Column, page: Column, index: Column) -> Column:
    """T-12."""
    return F.format_string("${FIG:%s:%03d:%d}", job.cast("string"), page.cast("int"), index.cast("int"))


def table_token(job: Column, page: Column, index: Column) -> Column:
    return F.format_string("${TBL:%s:%03d:%d}", job.cast("string"), page.cast("int"), index.cast("int"))


def is_token(c: Column, kind: str = "FIG") -> Column:
    """F-10."""
    return c.startswith("${" + kind + ":") & c.endswith("}")


def token_filename(c: Column) -> Column:
    """T-13: runs of other characters than letters, digits, _ and - become two underscores; none at the ends."""
    return F.regexp_replace(F.regexp_replace(c, "[^0-9A-Za-z_-]+", "__"), "^_+|_+$", "")


def pdf_stem(path: Column) -> Column:
    """T-9: the component after the first `out` if it has no dot, else after the first `out` or `*_out` whose next has none."""
    parts = F.split(path, "/")
    pairs = F.arrays_zip(parts.alias("a"), F.slice(parts, 2, F.size(parts)).alias("b"))
    after = lambda test: F.get(F.filter(pairs, lambda p: test(p["a"]) & p["b"].isNotNull() & (~p["b"].contains("."))), F.lit(0))["b"]
    return F.coalesce(after(lambda a: a == "out"), after(lambda a: (a == "out") | a.endswith("_out")))


def estimated_pages(chars: Column, per_page: int = 2000) -> Column:
    """T-15."""
    return F.greatest(F.lit(1), F.ceil(chars / per_page)).cast("long")


def area_fraction(area: Column, page_area: Column) -> Column:
    """T-14."""
    return area / F.greatest(page_area, F.lit(1.0))


def span_of(c: Column) -> Column:
    """T-16: a positive number (that of the largest integer at most), else 1."""
    return F.when(c.rlike(r"^\d+$") & ~c.rlike("^0+$"), F.coalesce(c.try_cast("int"), F.lit(MOST))).otherwise(1)


def preview(c: Column) -> Column:
    """T-28: over 200 characters, the first and the last 100."""
    return F.when(F.length(c) > 200, F.concat(F.left(c, F.lit(100)), F.lit("..."), F.right(c, F.lit(100)))).otherwise(c)


def is_meaningful_visual(kind: Column, area: Column, caption: Column, nearby: Column) -> Column:
    """F-7, first match: small and decorative: no; caption: yes; text nearby and not small: yes; large: yes; by kind."""
    small = F.coalesce(area < 0.05, F.lit(False))
    said = F.lower(F.concat_ws(" ", caption, nearby))
    decorative = F.exists(F.array(*map(F.lit, DECORATIVE)), lambda t: said.contains(t))
    return (
        F.when(small & decorative, False)
        .when(has_caption(said), True)
        .when(F.coalesce(nearby != "", F.lit(False)) & ~small, True)
        .when(F.coalesce(area >= 0.05, F.lit(False)), True)
        .otherwise(kind.isin("chart", "svg", "slide_visual_cluster"))
    )


def is_multi_column(left_edges: Column, width: Column) -> Column:
    """F-16: null if it can't be judged (under 8 blocks, no width); else whether 30 % of blocks begin right of the middle, and some left."""
    n = F.size(left_edges)
    right = F.size(F.filter(left_edges, lambda x: x > width * 0.5))
    return F.when((n < 8) | (width <= 0), F.lit(None).cast("boolean")).otherwise((right > 0) & (right < n) & (right / n >= 0.30))


def looks_decorative(c: Column) -> Column:
    """F-8: whether the first 240 characters, without a leading ### line, name a decorative picture."""
    head = F.regexp_replace(F.left(F.lower(c), F.lit(240)), r"^###[^\n]*\n", "")
    return F.exists(F.array(*map(F.lit, DECORATIVE_PHRASES)), lambda p: head.contains(p))


def is_exhaustion(message: Column, detail: Column) -> Column:
    """F-12: whether an error tells of memory that ran out; a plain search, so that `room` has `oom` in it."""
    said = F.lower(F.concat_ws(" ", message, detail))
    return F.exists(F.array(*map(F.lit, EXHAUSTION)), lambda p: said.contains(p))


def image_refs(c: Column) -> Column:
    """G-12: the targets of Markdown images, in order."""
    return F.regexp_extract_all(c, F.lit(IMAGE), F.lit(1))


def output_name(path: Column, filename: Column) -> Column:
    """T-10: the given file name, else the stem with _chunked, in the folder of path."""
    base = F.regexp_extract(path, r"([^/]*)$", 1)
    return F.concat(F.regexp_extract(path, r"^(.*/)?[^/]*$", 1), F.coalesce(filename, F.concat(F.regexp_replace(base, r"(?<=.)\.[^.]*$", ""), F.lit("_chunked"), F.regexp_extract(base, r"(?<=.)(\.[^.]*)$", 1))))


def reasoning_tokens(usage: Column) -> Column:
    """T-30: of the JSON of a model's usage, whole numbers only; 0 if there is none."""
    u = F.from_json(usage, "completion_tokens_details struct<reasoning_tokens:bigint>, output_tokens_details struct<reasoning_tokens:bigint>")
    return F.coalesce(u["completion_tokens_details"]["reasoning_tokens"], u["output_tokens_details"]["reasoning_tokens"], F.lit(0).cast("long"))


def output_tokens(usage: Column) -> Column:
    u = F.from_json(usage, "completion_tokens bigint, output_tokens bigint")
    return F.coalesce(u["completion_tokens"], u["output_tokens"], F.lit(0).cast("long"))
