"""Secret scans in DataFrame expressions only: three fixed patterns, and a model that tells random strings from names.

The model is two Markov chains over characters, one of random strings and one of ordinary identifiers. It is trained
from a bounded labelled sample: values that the patterns found and generated keys are random; the corpus' words, alone
and joined as identifiers, are ordinary. A token of MIN_TOKEN or more characters with a digit is a secret if the log
likelihood ratio of the chains reaches MIN_LLR nats in all and MIN_RATE a character.

A null text counts as empty. A text without findings has zero counts and empty spans. Spans are in code points, end
exclusive. Spans of the model that touch one of a pattern are left out. Repeated rows are scanned each for itself (one of
them in the sample). The work on a long text grows with its length and findings only: places are sums over groups of FAN
lengths, and texts are cut by chunks. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.llm.common import let, text_of, written

#: Kind, pattern, group that is measured, least length of it.
KINDS = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
)
#: What the prefilter of each kind looks for: a text without it has no span of the kind.
PRESENT = (KINDS[0][1], r"AKIA[A-Z0-9]{14}", r"[0-9a-f]{16}")
#: A pattern that finds the same spans without the short ones, where there is such a one.
DIRECT = (None, r"AKIA[A-Z0-9]{14,}", r"[0-9a-f]{16,}")
MIN_TOKEN, MIN_LLR, MIN_RATE = 20, 15.0, 0.5
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
#: Documents whose words and found values train the model, and generated keys.
SAMPLE_DOCS, SAMPLE_KEYS = 2000, 4000
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
SPANS = "array<struct<start:int,kind_no:int,kind:string,stop:int>>"
#: Numbers that are summed at once for the places of matches; characters of the pieces that a text is cut into.
FAN, CHUNK = 64, 1 << 12


def before_each(numbers: Column, combine) -> Column:
    """Of an array with elements: what combine (a sum, a maximum) gives over 0 and all numbers before each one. Groups, and groups of these, are combined first."""

    def over(x: Column) -> Column:
        return F.aggregate(x, F.lit(0), combine)

    def grouped(x: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), ((F.size(x) - 1) / FAN).cast("int")), lambda g: over(F.slice(x, g * FAN + 1, F.lit(FAN))))

    def spread(above: Column, x: Column) -> Column:
        return F.transform(x, lambda _, i: combine(F.get(above, (i / FAN).cast("int")), over(F.slice(x, (i / FAN).cast("int") * FAN + 1, i % FAN))))

    def of(x: Column, y: Column, z: Column) -> Column:
        return let(F.transform(z, lambda _, i: over(F.slice(z, F.lit(1), i))), lambda p: let(spread(p, y), lambda q: spread(q, x)))

    return let(numbers, lambda x: let(grouped(x), lambda y: let(grouped(y), lambda z: of(x, y, z))))


def located(text: Column, pattern: str, group: int, kind_no: int, kind: str, keep) -> Column:
    """Spans of the matches of the pattern whose group satisfies keep: what lies between matches gives their places."""

    def of(found: Column, gaps: Column, measured: Column) -> Column:
        def span(at: Column, i: Column) -> Column:
            start = at + F.length(F.get(gaps, i))
            return F.struct(start.alias("start"), F.lit(kind_no).alias("kind_no"), F.lit(kind).alias("kind"), (start + F.length(F.get(found, i))).alias("stop"))

        places = before_each(F.transform(found, lambda m, i: F.length(F.get(gaps, i)) + F.length(m)), lambda a, b: a + b)
        spans = let(F.transform(places, span), lambda s: F.filter(s, lambda _, i: keep(F.get(measured, i))))
        return F.when(F.size(found) > 0, spans).otherwise(F.array().cast(SPANS))

    p = F.lit(pattern)
    whole = F.regexp_extract_all(text, p, F.lit(0))
    return let(whole, lambda m: let(F.split(text, pattern, -1), lambda g: of(m, g, m) if not group else let(F.regexp_extract_all(text, p, F.lit(group)), lambda x: of(m, g, x))))


def base_spans(text: Column) -> list[Column]:
    none = F.array().cast(SPANS)
    return [
        F.when(text.rlike(PRESENT[k]), located(text, DIRECT[k] or pattern, 0 if DIRECT[k] else group, k, kind, lambda found, n=least: F.length(found) >= n)).otherwise(none)
        for k, (kind, pattern, group, least) in enumerate(KINDS)
    ]


def labelled(docs: DataFrame) -> DataFrame:
    """token, random (boolean): the bounded sample that trains the chains."""
    spark = docs.sparkSession
    keyed = docs.select(F.xxhash64("doc_id", text_of()).alias("h"), text_of().alias("text"))
    chosen = written(keyed.select("h").distinct().orderBy("h").limit(SAMPLE_DOCS), "secret-sample-keys")
    some = written(keyed.join(F.broadcast(chosen), "h").dropDuplicates(["h"]).select("text"), "secret-sample")
    keys = spark.range(SAMPLE_KEYS, numPartitions=1).select(F.sha2(F.concat(F.lit("key"), F.col("id").cast("string")), 256).alias("k"))
    keys = keys.select(F.explode(F.array(F.substring("k", 1, 40), F.regexp_replace(F.base64(F.unhex("k")), "=", ""), F.translate(F.base64(F.unhex("k")), "+/=", "-_"), F.substring(F.upper(F.regexp_replace(F.base64(F.unhex("k")), r"[+/=]", "")), 1, 24))).alias("token"))
    values = some.select(F.explode(F.concat(F.regexp_extract_all("text", F.lit(KINDS[0][1]), F.lit(2)), F.regexp_extract_all("text", F.lit(DIRECT[1]), F.lit(0)), F.regexp_extract_all("text", F.lit(DIRECT[2]), F.lit(0)))).alias("token")).filter(F.length("token") >= 12)
    bare = some.select(F.regexp_replace(F.regexp_replace("text", KINDS[0][1], " "), r"AKIA[A-Z0-9]{14,}|[0-9a-f]{16,}", " ").alias("text"))
    words = bare.select(F.regexp_extract_all("text", F.lit(r"[A-Za-z]{2,30}"), F.lit(0)).alias("w")).filter(F.size("w") >= 3)
    three = F.transform(F.sequence(F.lit(0), F.size("w") - 3, F.lit(3)), lambda i: F.slice("w", i + 1, 3))
    names = words.select(F.explode(three).alias("w")).select(F.lower(F.get("w", F.lit(0))).alias("a"), F.lower(F.get("w", F.lit(1))).alias("b"), F.lower(F.get("w", F.lit(2))).alias("c"))
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    year = F.concat(F.lit("20"), F.lpad((F.abs(F.xxhash64("a")) % 100).cast("string"), 2, "0"))
    joined = [F.concat_ws("_", a, b, c), F.concat_ws("-", a, b, year), F.concat(a, F.initcap(b), F.initcap(c)), F.upper(F.concat_ws("_", a, b)), F.concat_ws("/", a, year, b), F.concat(a, b, c), F.concat(F.initcap(a), b), F.concat_ws("-", a, b, c)]
    return keys.unionAll(values).select("token", F.lit(True).alias("random")).unionAll(names.select(F.explode(F.array(*joined)).alias("token"), F.lit(False).alias("random")))


def train(docs: DataFrame) -> list[float]:
    """Log ratio of each transition, for the pairs of ALPHABET in order: as many numbers as the alphabet's square, whatever the input."""
    pairs = labelled(docs).select("random", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.length("token") - 1, F.lit(1))), lambda i: F.substring(F.col("token"), i, F.lit(2)))).alias("pair")).filter("length(pair) = 2")
    counts = {(r.random, r.pair): r.n for r in pairs.groupBy("random", "pair").agg(F.count("*").alias("n")).collect() if set(r.pair) <= set(ALPHABET)}
    out = []
    totals = {(kind, a): sum(counts.get((kind, a + b), 0) for b in ALPHABET) for kind in (True, False) for a in ALPHABET}
    for a in ALPHABET:
        for b in ALPHABET:
            p, q = [(counts.get((kind, a + b), 0) + 0.5) / (totals[kind, a] + 0.5 * len(ALPHABET)) for kind in (True, False)]
            out.append(round(math.log(p / q), 4))
    return out


def ratio(token: Column, model: list[float]) -> Column:
    table = F.split(F.lit(",".join(map(str, model))), ",").cast("array<double>")
    places = F.split(F.lit(",".join(str(ALPHABET.find(chr(c))) for c in range(128))), ",").cast("array<int>")
    codes = F.transform(F.split(token, ""), lambda c: F.get(places, F.ascii(c)))
    return let(codes, lambda x: F.aggregate(F.sequence(F.lit(1), F.size(x) - 1), F.lit(0.0), lambda s, i: s + F.get(table, F.get(x, i - 1) * len(ALPHABET) + F.get(x, i))))


def model_spans(text: Column, model: list[float]) -> Column:
    """Spans of random tokens."""

    def random(token: Column) -> Column:
        return F.when(token.rlike("[0-9]"), let(ratio(token, model), lambda r: (r >= MIN_LLR) & (r >= MIN_RATE * F.length(token)))).otherwise(False)

    return F.when(text.rlike(r"[A-Za-z+/_=-][0-9]|[0-9][A-Za-z+/_=-]|[0-9]{20}") & text.rlike(TOKEN), located(text, TOKEN, 0, len(KINDS), "model", random)).otherwise(F.array().cast(SPANS))


def touches(spans: Column, m: Column) -> Column:
    """Whether m overlaps with one of spans, which are in order and apart: with the last that starts before m's end, found by halving."""
    powers = F.array(*[F.lit(1 << k) for k in range(27, -1, -1)])

    def further(n: Column, p: Column) -> Column:
        return F.when((n + p <= F.size(spans)) & (F.get(spans, n + p - 1)["start"] < m["stop"]), n + p).otherwise(n)

    return (F.size(spans) > 0) & let(F.aggregate(powers, F.lit(0), further), lambda n: (n > 0) & F.coalesce(F.get(spans, F.greatest(n - 1, F.lit(0)))["stop"] > m["start"], F.lit(False)))


def scanned(docs: DataFrame, model: list[float]) -> DataFrame:
    """docs with scan_text, assign, access, hex, base (the three by start, then kind) and spans (with the model's)."""
    rows = docs.withColumn("scan_text", text_of())
    kinds = [f"scan_{kind}" for kind, *_ in KINDS]
    for name, column in zip(kinds, base_spans(F.col("scan_text")), strict=True):
        rows = rows.withColumn(name, column)
    rows = rows.withColumn("scan_base", F.sort_array(F.concat(*kinds)))
    more = F.filter(model_spans(F.col("scan_text"), model), lambda m: ~(touches(F.col(kinds[0]), m) | touches(F.col(kinds[1]), m) | touches(F.col(kinds[2]), m)))
    return rows.withColumn("scan_spans", F.sort_array(F.concat("scan_base", more)))


def printed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_model."""
    found = scanned(docs.select("doc_id", "text"), train(docs))
    counts = [F.size(f"scan_{kind}").cast("long").alias(f"n_{kind}") for kind, *_ in KINDS]
    return found.select("doc_id", *counts, F.sha2(printed(F.col("scan_base")), 256).alias("base_sha256"), printed(F.col("scan_spans")).alias("spans"), (F.size("scan_spans") - F.size("scan_base")).cast("long").alias("n_model"))


def chunks(text: Column) -> Column:
    """The text in pieces of CHUNK characters, cut from larger pieces, as each cut counts the characters before it."""

    def cut(x: Column, size: int) -> Column:
        return F.transform(F.sequence(F.lit(0), ((F.length(x) - 1) / size).cast("int")), lambda i: F.substring(x, i * size + 1, F.lit(size)))

    return F.flatten(F.transform(cut(text, CHUNK << 8), lambda x: cut(x, CHUNK)))


def between(parts: Column, a: Column, b: Column) -> Column:
    """The characters from a to b (exclusive) of a text that chunks() has cut."""

    def part(c: Column) -> Column:
        skip = F.greatest(a - c * CHUNK, F.lit(0))
        return F.substring(F.get(parts, c), skip + 1, F.least(b - c * CHUNK, F.lit(CHUNK)) - skip)

    return F.when(b > a, F.array_join(F.transform(F.sequence((a / CHUNK).cast("int"), ((b - 1) / CHUNK).cast("int")), part), "")).otherwise("")


def without_spans(text: Column, spans: Column, mark: str) -> Column:
    """The text with mark in place of each span; of spans that overlap one mark stands for all."""

    def of(parts: Column, ends: Column) -> Column:
        # ends: the furthest end of the spans before each; one more for the rest of the text
        kept = F.transform(spans, lambda s, i: F.when(s["start"] >= F.get(ends, i), F.concat(between(parts, F.get(ends, i), s["start"]), F.lit(mark))).otherwise(""))
        return F.concat(F.array_join(kept, ""), between(parts, F.get(ends, F.size(spans)), F.length(text)))

    ends = before_each(F.array_append(F.transform(spans, lambda s: s["stop"]), F.lit(0)), lambda a, b: F.greatest(a, b))
    return let(chunks(text), lambda parts: let(ends, lambda e: of(parts, e)))


def redacted(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """docs, all rows and columns, with mark in place of each secret of the text; n_chars, where there is one, follows."""
    found = scanned(docs, train(docs))
    found = found.withColumn("text", F.when(F.size("scan_spans") > 0, without_spans(F.col("scan_text"), F.col("scan_spans"), mark)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.when(F.size("scan_spans") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return found.select(*docs.columns)
