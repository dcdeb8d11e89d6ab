"""Removal of byte strings that occur elsewhere, in the same or another document.

Every byte that a string of LENGTH bytes covers which also starts anywhere else goes; strings are judged on the input,
and overlaps count. The work is that of sampled suffixes with common-prefix tests, sorted and joined by Spark:

1. Of the GRAM-byte grams in each window of LENGTH bytes, the one of least hash (rightmost of equals) is its anchor. An
   anchor serves a run of windows. Equal windows have equal anchors at equal places, so only anchors whose gram occurs
   again can serve repeated windows.
2. Anchors whose whole region (all bytes of their windows) equals another's are repeated as a whole.
3. The windows of the others of such grams are hashed one by one and compared with those of the same gram, one of each
   set of equal regions standing for all.

Strings are compared by 64-bit hashes of their bytes, those of one gram only (64 bits more for whole regions, 31 for
single windows). A null text counts as empty; texts shorter than LENGTH bytes keep all, and long ones are cut, so that a
task holds SLICE bytes of a text at once. Rows of the same doc_id are told apart by a 32-bit hash of their texts, rows
without doc_id by 96 bits of it; equal ones repeat each other. An empty table gives an empty result. Other columns are
ignored.

The texts are shuffled to the spans twice, and every table is deleted as soon as nothing reads it any more.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.common import discard, text_of, written

LENGTH, GRAM = 200, 100
WINDOW = LENGTH - GRAM + 1
#: What tells rows of a table from one another.
ROW = ("doc", "tag")
#: Bytes of text that a task handles at once; longer texts are cut, with LENGTH - 1 bytes in common.
SLICE = 1 << 20
#: Bits of a packed minimum that hold the place in a slice.
PLACE_BITS = 24
PLACE = np.uint64((1 << PLACE_BITS) - 1)
BASE = np.uint64(0x9E3779B97F4A7C15 | 5)


def byte_values() -> np.ndarray:
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


VALUES = byte_values()


class Slice:
    """The bytes of some texts one after the other, with hashes of all their substrings."""

    def __init__(self, texts: list[bytes]):
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        n = len(self.data)
        powers = np.full(n + 1, BASE, np.uint64)
        powers[0] = 1
        powers = np.cumprod(powers, dtype=np.uint64)
        inverse = np.full(n + 1, np.uint64(pow(int(BASE), -1, 1 << 64)), np.uint64)
        inverse[0] = 1
        self.inverse = np.cumprod(inverse, dtype=np.uint64)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(VALUES[self.data] * powers[:n], dtype=np.uint64)])

    def hashes(self, start: np.ndarray, size) -> np.ndarray:
        """Hashes of the substrings of the given sizes: differences of sums, brought to a common power."""
        lifted = (self.sums[start + size] - self.sums[start]) * self.inverse[start]
        return mixed(lifted + np.asarray(size).astype(np.uint64))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def anchors(part: Slice) -> tuple[np.ndarray, ...]:
    """Of each anchor: the text, gram hash, region hash, and first and last window, counted from the text's start."""
    n = len(part.data)
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none
    at = np.arange(n - GRAM + 1)
    gram = part.hashes(at, GRAM)
    least = (gram & ~PLACE) | (PLACE - at.astype(np.uint64))
    reach = 1
    while 2 * reach <= WINDOW:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    rest = WINDOW - reach
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    text = np.repeat(np.arange(len(part.first) - 1), np.diff(part.first))[: len(least)]
    inside = np.arange(len(least)) + LENGTH <= part.first[text + 1]
    start = np.flatnonzero(inside)
    chosen = least[start]
    new = np.ones(len(start), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (text[start[1:]] != text[start[:-1]])
    a = start[new]
    b = start[np.append(np.flatnonzero(new)[1:], len(start)) - 1] if len(start) else a
    place = (PLACE - (chosen[new] & PLACE)).astype(np.int64)
    region = part.hashes(a, b - a + LENGTH) + mixed((place - a).astype(np.uint64) + np.uint64(7))
    of = text[a]
    return of, gram[place], region, a - part.first[of], b - part.first[of]


def cut(batches):
    """Lists of (row of the batch, place in its text, bytes) with about SLICE bytes, batch by batch."""
    for batch in batches:
        held, size = [], 0
        for k, text in enumerate(batch.column("text")):
            text = text.as_py()
            for at in range(0, max(len(text) - LENGTH + 1, 1), SLICE):
                held.append((k, at, text[at : at + SLICE + LENGTH - 1]))
                size += len(held[-1][2])
                if size >= SLICE:
                    yield batch, held
                    held, size = [], 0
        if held:
            yield batch, held


def texts_of(docs: DataFrame) -> DataFrame:
    """doc_id, doc, tag, text as bytes."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return docs.select("doc_id", F.coalesce("doc_id", F.xxhash64("text")).alias("doc"), F.hash("text").alias("tag"), F.encode("text", "UTF-8").alias("text"))


def anchor_rows(texts: DataFrame) -> DataFrame:
    """gram, region, doc, tag, a, more: the anchors of all texts; a is the first window, a + more the last."""

    def run(batches):
        for batch, held in cut(batches):
            row, at = [k for k, _, _ in held], np.array([a for _, a, _ in held])
            doc, tag = (batch.column(c).to_numpy()[row] for c in ROW)
            of, gram, region, a, b = anchors(Slice([t for _, _, t in held]))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (gram.view(np.int64), region.view(np.int64), doc[of], tag[of], (a + at[of]).astype(np.int32), (b - a).astype(np.int16))], ["gram", "region", *ROW, "a", "more"])

    return texts.select(*ROW, "text").mapInArrow(run, "gram long, region long, doc long, tag int, a int, more smallint")


def with_spans(texts: DataFrame, spans: DataFrame, how: str) -> DataFrame:
    """texts with spans, the sorted (a, b, ...) of their row as an array."""
    rest = [c for c in spans.columns if c not in ROW]
    return texts.join(spans.groupBy(*ROW).agg(F.sort_array(F.collect_list(F.struct(*rest))).alias("spans")), list(ROW), how)  # as many as the text has


def window_rows(texts: DataFrame, open_: DataFrame) -> DataFrame:
    """window (its hash), bits (of the gram's hash), doc, tag, a: the windows of open_'s anchors."""

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                spans = batch.column("spans")[k].values
                a, b, bits = (spans.field(c).to_numpy() for c in ("a", "b", "bits"))
                text = batch.column("text")[k].as_py()
                at = 0
                while at < len(a):  # spans that lie within SLICE bytes
                    to = max(at + 1, int(np.searchsorted(b, a[at] + SLICE, "right")))
                    part = Slice([text[a[at] : b[at:to].max() + LENGTH]])
                    n = (b[at:to] - a[at:to] + 1).astype(np.int64)
                    start = np.repeat(a[at:to] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                    found = part.hashes(start - a[at], LENGTH).view(np.int64)
                    doc, tag = (np.full(len(start), batch.column(c)[k].as_py(), t) for c, t in zip(ROW, (np.int64, np.int32), strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (found, np.repeat(bits[at:to], n), doc, tag, start.astype(np.int32))], ["window", "bits", *ROW, "a"])
                    at = to

    return with_spans(texts, open_, "inner").select(*ROW, "text", "spans").mapInArrow(run, "window long, bits int, doc long, tag int, a int")


def repeated(texts: DataFrame) -> DataFrame:
    """doc, tag, a, b: bytes from a to b (exclusive) of the text are covered by strings of LENGTH bytes that start elsewhere too. Spans may overlap."""
    found = anchor_rows(texts)
    grams = found.groupBy("gram").agg(F.count("*").alias("n"), F.min("region").alias("low"), F.max("region").alias("high")).filter("n > 1")
    grams = written(grams.select("gram", (F.col("low") != F.col("high")).alias("mixed")), "grams")
    # both sides of the joins are written, so that they are plain shuffles, of which Spark splits those of a hot gram
    shared = written(found.join(grams, "gram"), "shared-grams")
    discard(grams)
    end = (F.col("a") + F.col("more") + LENGTH).alias("b")
    mixed_ = shared.filter("mixed").drop("mixed")
    regions = written(mixed_.groupBy("gram", "region").agg(F.count("*").alias("n"), F.min(F.struct(*ROW, "a", "more")).alias("one")), "regions")
    several = mixed_.join(regions.filter("n > 1").select("gram", "region"), ["gram", "region"]).select(*ROW, "a", end)
    whole = written(merged(shared.filter("not mixed").select(*ROW, "a", end).unionAll(several)), "whole-regions")
    discard(shared)
    single = regions.filter("n = 1").select("gram").distinct()
    open_ = written(regions.filter("n = 1").unionAll(regions.filter("n > 1").join(single, "gram", "left_semi").select(*regions.columns)).select("one.*", F.col("gram").bitwiseAND(F.lit(0x7FFFFFFF)).cast("int").alias("bits")), "open")
    discard(regions)
    windows = written(window_rows(texts, open_.select(*ROW, "a", (F.col("a") + F.col("more")).alias("b"), "bits")), "windows")
    discard(open_)
    again = written(windows.groupBy("window", "bits").agg(F.count("*").alias("n")).filter("n > 1").select("window", "bits"), "again")
    spans = written(merged(whole.unionAll(windows.join(again, ["window", "bits"]).select(*ROW, "a", (F.col("a") + LENGTH).alias("b")))), "repeats")
    discard(whole, windows, again)
    return spans


def merged(spans: DataFrame) -> DataFrame:
    """doc, tag, a, b: the spans of each row, those that meet within a batch made one."""

    def run(batches):
        for batch in (b for b in batches if b.num_rows):
            doc, tag, a, b = (batch.column(c).to_numpy() for c in (*ROW, "a", "b"))
            order = np.lexsort((a, tag, doc))
            doc, tag, a, b = doc[order], tag[order], a[order], b[order].astype(np.int64)
            code = np.cumsum(np.concatenate([[False], (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])])).astype(np.int64) << 40  # makes ends of one row lie below those of the next
            far = np.maximum.accumulate(code + b)
            new = np.concatenate([[True], (code + a)[1:] > far[:-1]])
            last = np.append(np.flatnonzero(new)[1:], len(a)) - 1
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (doc[new], tag[new], a[new], (far - code)[last].astype(np.int32))], [*ROW, "a", "b"])

    return spans.mapInArrow(run, "doc long, tag int, a int, b int")


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes) of every row of docs."""
    texts = texts_of(docs)
    spans = repeated(texts)

    def run(batches):
        for batch in (b for b in batches if b.num_rows):
            out = []
            for text, found in zip(batch.column("text"), batch.column("spans"), strict=True):
                text = text.as_py()
                keep, at, gone, n = [], 0, 0, 0
                if found.is_valid:
                    end = -1
                    for a, b in zip(found.values.field("a").to_pylist(), found.values.field("b").to_pylist(), strict=True):
                        if a > end:
                            n += 1
                            keep.append(text[max(end, 0) : a])
                            gone += b - a
                            end = b
                        elif b > end:
                            gone += b - end
                            end = b
                    at = end
                keep.append(text[at:])
                rest = b"".join(keep)
                out.append((len(text), gone, n, hashlib.sha256(rest).hexdigest(), rest))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()), strict=True)]], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return with_spans(texts, spans, "left").select("doc_id", "text", "spans").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
