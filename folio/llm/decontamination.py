"""Benchmark decontamination by spaced seeds, in DataFrame expressions only.

Words are the runs of letters and digits of the lower-cased text. A mask says which of a few neighbouring words count and
which are ignored; the hash of those that count is a seed. Seeds join documents and benchmark items. Each meeting fixes an
alignment of document and item, which counts if some run of MIN_WORDS words or more on it, or the whole item if that is
shorter, has at least MIN_SIMILARITY of its words equal. The run that is reported scores best (matching words score 1,
others -PENALTY), or where that one is too short or too unlike, is the one with the most matching words beyond
MIN_SIMILARITY of its length.

The search loses no such alignment: a run of 2 * MIN_WORDS words or more can be cut into pieces of MIN_WORDS to
2 * MIN_WORDS - 1 words, one of which is at least as alike, and LONG_MASKS hit every piece wherever its words differ (by
trial of all cases, see the tests); SHORT_MASKS do so for shorter items. Words put in or left out move the rest to
another alignment, where it counts only by itself.

A phrase that many items share would join every document that has it with every such item. The meetings of such hot seeds
are held against the words around on both sides within the join, so that they become rows only where enough words agree.

Null and empty texts, rows without doc_id, and items of fewer than LEAST_ITEM words overlap with nothing. Items of equal
words count as one, under their smallest item_id. Rows of the same doc_id count as one document, found where any of them
overlaps. The work on a long text grows with its words and hits. Empty tables give an empty result. Other columns are
ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.llm.common import let, small, text_of, written

MIN_WORDS, MIN_SIMILARITY, PENALTY, LEAST_ITEM = 10, 0.75, 2, 3
#: What MIN_SIMILARITY is counted in.
PARTS = 10_000
NEEDED = round(MIN_SIMILARITY * PARTS)


#: Offsets of the words that count, for items of MIN_WORDS words or more, and for shorter ones.
LONG_MASKS = ((0, 1, 3, 4), (0, 2, 5, 7))
SHORT_MASKS = ((0, 1, 2), (0, 1, 3), (0, 2, 3))
#: Alignments of a document that are looked at together.
TOGETHER = 1000
#: A seed that more places of items have is hot: its meetings are compared with the words around before they become rows.
HOT = 32
#: Words around a seed that a piece with it can reach, and how they are packed.
FIRST, LAST, BYTES_OF = LONG_MASKS[0][-1] - (2 * MIN_WORDS - 2), 2 * MIN_WORDS - 2, 7
CONTEXT = [f"c{k}" for k in range(-(-(LAST - FIRST + 1) // BYTES_OF))]
#: Words of items that count as a row when the items are broadcast: eight bytes each.
WORDS_OF_ROW = 4


def word_hashes(text: Column) -> Column:
    words = F.split(F.regexp_replace(F.lower(text), r"^[^\p{L}\p{N}]+", ""), r"[^\p{L}\p{N}]+")
    return F.transform(words, lambda w: F.xxhash64(w))


def seeds(hashes: Column, mask: tuple[int, ...]) -> Column:
    """array<struct<seed, at>> for all positions of a mask."""

    def of(h: Column) -> Column:
        last = F.size(h) - 1 - mask[-1]
        at = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.struct(F.xxhash64(F.lit(",".join(map(str, mask))), *[F.get(h, i + o) for o in mask]).alias("seed"), i.alias("at")))

    return let(hashes, of)


def alike(doc: Column, item: Column, shift: Column) -> Column:
    """array<boolean>: of each of item's words, whether doc has it shift words further."""
    return F.transform(item, lambda w, k: F.coalesce((shift + k >= 0) & (F.get(doc, F.greatest(shift + k, F.lit(0))) == w), F.lit(False)))


def best_run(same: Column) -> Column:
    """struct<start, words, matched>: the run that scores best."""
    state = "struct<score:int,start:int,matched:int,best:int,best_start:int,best_end:int,best_matched:int>"
    zero = F.struct(*[F.lit(0)] * 7).cast(state)

    def step(s, k):
        hit = F.get(same, k)
        score = s["score"] + F.when(hit, 1).otherwise(-PENALTY)
        matched = s["matched"] + hit.cast("int")
        better = score > s["best"]
        return F.struct(
            F.greatest(score, F.lit(0)).alias("score"), F.when(score <= 0, k + 1).otherwise(s["start"]).alias("start"), F.when(score <= 0, 0).otherwise(matched).alias("matched"),
            F.greatest(score, s["best"]).alias("best"), F.when(better, s["start"]).otherwise(s["best_start"]).alias("best_start"), F.when(better, k + 1).otherwise(s["best_end"]).alias("best_end"), F.when(better, matched).otherwise(s["best_matched"]).alias("best_matched"),
        )

    def end(s):
        return F.struct(s["best_start"].alias("start"), (s["best_end"] - s["best_start"]).alias("words"), s["best_matched"].alias("matched"))

    return F.aggregate(F.sequence(F.lit(0), F.size(same) - 1), zero, step, end)


def likest_run(same: Column) -> Column:
    """struct<start, words, matched>: of the runs of enough words, that with the most matching ones beyond MIN_SIMILARITY; of no words if none reaches it."""
    state = "struct<head:long,head_matched:int,tail:long,tail_matched:int,low:long,low_at:int,low_matched:int,best:long,best_start:int,best_end:int,best_matched:int>"
    zero = F.struct(*[F.lit(0)] * 7, F.lit(-1), *[F.lit(0)] * 3).cast(state)
    least = F.least(F.lit(MIN_WORDS), F.size(same))

    def worth(hit):
        return F.when(hit, PARTS - NEEDED).otherwise(-NEEDED).cast("long")

    def step(s, k):
        # head sums the words up to k; tail those before the last start that leaves enough of them
        at = k + 1 - least
        dropped = F.when(at > 0, F.get(same, at - 1))
        head, head_matched = s["head"] + worth(F.get(same, k)), s["head_matched"] + F.get(same, k).cast("int")
        tail, tail_matched = s["tail"] + F.when(at > 0, worth(dropped)).otherwise(0), s["tail_matched"] + F.when(at > 0, dropped.cast("int")).otherwise(0)
        lower = (at >= 0) & (tail <= s["low"])
        low, low_at, low_matched = (F.when(lower, x).otherwise(s[n]) for x, n in ((tail, "low"), (at, "low_at"), (tail_matched, "low_matched")))
        better = (at >= 0) & (head - low > s["best"])
        return F.struct(
            head.alias("head"), head_matched.alias("head_matched"), tail.alias("tail"), tail_matched.alias("tail_matched"), low.alias("low"), low_at.alias("low_at"), low_matched.alias("low_matched"),
            F.when(better, head - low).otherwise(s["best"]).alias("best"), F.when(better, low_at).otherwise(s["best_start"]).alias("best_start"), F.when(better, k + 1).otherwise(s["best_end"]).alias("best_end"), F.when(better, head_matched - low_matched).otherwise(s["best_matched"]).alias("best_matched"),
        )

    def end(s):
        return F.struct(s["best_start"].alias("start"), (s["best_end"] - s["best_start"]).alias("words"), s["best_matched"].alias("matched"))

    return F.aggregate(F.sequence(F.lit(0), F.size(same) - 1), zero, step, end)


def counted_run(same: Column) -> Column:
    """struct<start, words, matched>: of the alignment; null if it doesn't count."""

    def counts(run):
        return (run["words"] >= F.least(F.lit(MIN_WORDS), F.size(same))) & (run["words"] > 0) & (run["matched"] * PARTS >= NEEDED * run["words"])

    return F.coalesce(*[let(run(same), lambda r: F.when(counts(r), r)) for run in (best_run, likest_run)])


def context(words: Column, at: Column, outside: int) -> list[Column]:
    """The words around a place, from FIRST to LAST words after it, as bytes in BYTES_OF of a long: seven bits of each word's hash, or `outside` beyond the text."""

    def byte(offset):
        return F.coalesce(F.get(words, at + offset).bitwiseAND(127), F.lit(outside)) if offset <= LAST else F.lit(outside)

    return [reduce(Column.bitwiseOR, [F.shiftleft(byte(FIRST + BYTES_OF * k + b).cast("long"), 8 * b) for b in range(BYTES_OF)]).alias(c) for k, c in enumerate(CONTEXT)]


def shared_bytes(a: str, b: str) -> Column:
    """How many words of two contexts may be equal: at least as many as are."""

    def equal(x, y):
        z, low = x.bitwiseXOR(y), F.lit(int("7f" * BYTES_OF, 16))
        full = (z.bitwiseAND(low) + low).bitwiseOR(z)  # the high bit of each byte that differs
        return BYTES_OF - F.bit_count(full.bitwiseAND(F.lit(int("80" * BYTES_OF, 16))))

    return sum((equal(F.col(f"{a}.{c}"), F.col(f"{b}.{c}")) for c in CONTEXT), F.lit(0))


def in_parts(rows: DataFrame, column: str) -> DataFrame:
    """rows with the array of a column cut into arrays of TOGETHER at most, a row each; rows with an empty array go."""
    parts = F.transform(F.sequence(F.lit(0), ((F.size(column) - 1) / TOGETHER).cast("int")), lambda g: F.slice(column, g * TOGETHER + 1, F.lit(TOGETHER)))
    return rows.filter(F.size(column) > 0).select("doc_id", F.explode(parts).alias(column))


def close_places(docs: DataFrame, places: DataFrame, items: DataFrame, keys: DataFrame) -> DataFrame:
    """doc_id, hits of places (doc_id, places as an array of seed and at) and the keys of their seeds, where the words around agree enough for an overlap.

    A run that counts and holds a seed has a piece of 2 * MIN_WORDS - 1 words at most around the seed that is as alike (see
    above), so MIN_SIMILARITY of MIN_WORDS words, or of the item, are equal within a context. The pairs of a seed are
    compared in the join, a few operations on longs each, and only those that pass become rows.
    """
    around = keys.join(small(items), "item_id").select("seed", "item_id", "n", "item_at", F.struct(*context(F.col("item"), F.col("item_at"), 255)).alias("there"))
    around = written(around, "hot-contexts")
    n_places = places.agg(F.sum(F.size("places"))).first()[0] or 0
    texts = docs.join(small(places, n_places), "doc_id").select("doc_id", "places", word_hashes(F.col("text")).alias("d"))
    one = let(F.col("d"), lambda d: F.transform("places", lambda p: F.struct(p["seed"].alias("seed"), p["at"].alias("at"), F.struct(*context(d, p["at"], 128)).alias("here"))))
    here = texts.select("doc_id", F.explode(one).alias("p")).select("doc_id", "p.*")
    needed = F.ceil(NEEDED * F.least(F.lit(MIN_WORDS), F.col("n")) / PARTS)
    met = here.alias("h").join(small(around).alias("k"), (F.col("h.seed") == F.col("k.seed")) & (shared_bytes("here", "there") >= needed))
    return met.select("doc_id", F.struct("item_id", "n", (F.col("at") - F.col("item_at")).alias("shift")).alias("hit")).groupBy("doc_id").agg(F.collect_set("hit").alias("hits"))


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, start (word of the document), words, matched, similarity: the best overlap of each document with each item that it has one with."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.filter(F.split(F.lower(text_of()), r"[^\p{L}\p{N}]+"), lambda w: w != "").alias("w"))
    items = items.filter(F.size("w") >= LEAST_ITEM).groupBy("w").agg(F.min("item_id").alias("item_id"))
    items = written(items.select("item_id", F.transform("w", lambda w: F.xxhash64(w)).alias("item")), "items")
    words_of_items = items.agg(F.sum(F.size("item"))).first()[0] or 0
    held = small(items, words_of_items // WORDS_OF_ROW)
    short = F.size("item") < MIN_WORDS
    used = LONG_MASKS + (SHORT_MASKS if items.filter(short).limit(1).count() else ())
    keys = [items.filter(~short if m in LONG_MASKS else short).select("item_id", F.size("item").alias("n"), F.explode(seeds(F.col("item"), m)).alias("s")) for m in used]
    keys = written(reduce(DataFrame.unionAll, keys).select("item_id", "n", "s.seed", F.col("s.at").alias("item_at")).distinct(), "item-seeds")
    hot = written(keys.groupBy("seed").agg(F.count("*").alias("k")).filter(F.col("k") > HOT).select("seed"), "hot-seeds")
    no_item = [F.lit(None).cast(t).alias(c) for c, t in (("item_id", "long"), ("n", "int"))]
    one_each = keys.join(small(hot), "seed", "left_anti").select("seed", "item_id", "n", "item_at").unionAll(hot.select("seed", *no_item, F.lit(None).cast("int").alias("item_at")))
    one_each = written(one_each, "first-keys")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).filter("doc_id is not null")
    found = docs.select("doc_id", F.explode(let(word_hashes(F.col("text")), lambda h: F.concat(*[seeds(h, m) for m in used]))).alias("s")).select("doc_id", "s.seed", "s.at")
    known = F.col("item_id").isNotNull()
    met = found.join(small(one_each), "seed").select("doc_id", F.when(known, F.struct("item_id", "n", (F.col("at") - F.col("item_at")).alias("shift"))).alias("hit"), F.when(~known, F.struct("seed", "at")).alias("place"))
    met = written(met.groupBy("doc_id").agg(F.collect_set("hit").alias("hits"), F.collect_set("place").alias("places")), "met")
    hits = met.select("doc_id", "hits")
    if hot.limit(1).count():
        hits = hits.unionAll(close_places(docs, in_parts(met, "places"), items, keys.join(small(hot), "seed", "left_semi")))
    hits = written(in_parts(hits, "hits"), "hits")
    # the words are split once for each row of hits; each alignment gets those that lie under its item
    n_hits = hits.agg(F.sum(F.size("hits"))).first()[0] or 0
    lain = docs.join(small(hits, n_hits), "doc_id").select("doc_id", "hits", word_hashes(F.col("text")).alias("d"))
    lain = lain.select("doc_id", F.explode(let(F.col("d"), lambda d: F.transform("hits", lambda x: F.struct(x["item_id"].alias("item_id"), x["shift"].alias("shift"), F.slice(d, F.greatest(x["shift"], F.lit(0)) + 1, x["n"]).alias("d"))))).alias("x"))
    pairs = lain.select("doc_id", "x.*").join(held, "item_id")
    pairs = pairs.select("doc_id", "item_id", "shift", alike(F.col("d"), F.col("item"), F.least("shift", F.lit(0))).alias("same"))
    pairs = pairs.filter(F.size(F.filter("same", lambda x: x)) * PARTS >= NEEDED * F.least(F.lit(MIN_WORDS), F.size("same")))
    good = pairs.select("doc_id", "item_id", "shift", let(F.col("same"), counted_run).alias("o")).filter("o is not null")
    good = good.select("doc_id", "item_id", F.struct((F.col("shift") + F.col("o.start")).alias("start"), "o.words", "o.matched").alias("o"))
    best = good.groupBy("doc_id", "item_id").agg(F.max(F.struct(F.col("o.matched").alias("matched"), (-F.col("o.words")).alias("less"), (-F.col("o.start")).alias("before"))).alias("b"))
    return best.select("doc_id", "item_id", (-F.col("b.before")).alias("start"), (-F.col("b.less")).alias("words"), "b.matched", (F.col("b.matched") / -F.col("b.less")).alias("similarity"))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that overlap with no item; rows whose doc_id is null stay."""
    leaks = written(overlaps(docs, benchmark).select("doc_id").distinct(), "leaks")
    return docs.join(small(leaks), "doc_id", "left_anti").select(*docs.columns)
