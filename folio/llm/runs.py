"""Periodic runs of words by the linear-time method of Ellert and Fischer: Lyndon arrays on an ordered alphabet.

A run is a stretch of consecutive words whose smallest period fits in it twice and that no neighbouring word extends. Under
one of two orders of the words, an order and its reverse, every run holds a Lyndon word of its period's length that is the
longest one from its start, and such a word ends where the next smaller suffix begins. Both orders are walked once: pairs
of suffixes are compared word by word, and what an earlier pair has matched is not read again, neither to the right, where
the comparison decides the order, nor to the left, where it finds where a run begins. Words are compared with one another
only: there are no suffix arrays or trees and no hashes of stretches, and the work is linear in the number of words.

Words lie between ASCII white space. A null text has no words. Every document is judged by itself, so that the result is a
narrow map over the input with no shuffle; rows of equal doc_id, and rows without one, each give a row. A text takes some 100 bytes
of a task's memory for each of its words. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.llm.common import text_of
from folio.llm.words import slices

#: A run has this many words at least.
LEAST_WORDS = 12
SLICE_BYTES = 4 << 20


def smaller_suffixes(s: list[int]) -> tuple[list[int], list[int]]:
    """For each place the next one whose suffix is smaller (len(s) if none: the end is smallest), and how far the two suffixes agree.

    A place is compared with the chain of places before it whose suffixes are smaller and smaller. far is the furthest place
    that a comparison has matched, with the pair old, new: from new to far the text repeats what stands from old on, and so do
    the outcomes of comparisons in there, unless they reach far.
    """
    n = len(s)
    following, following_common = [n] * n, [0] * n
    preceding, preceding_common = [-1] * n, [0] * n
    old, new, far = 0, 0, 0
    for i in range(n):
        word, j, common = s[i], i - 1, 0
        popped = -1
        while j >= 0:
            first = s[j]
            if first > word:
                following[j] = i
                popped, j = j, preceding[j]
                continue
            if first < word:
                break
            extend = True
            if i < far and j >= new:
                d = new - old
                common = following_common[j - d] if following[j - d] == i - d else preceding_common[i - d]
                if i + common < far:
                    extend = False
                else:
                    common = far - i
            elif popped >= 0:
                known = preceding_common[popped]  # how far j and popped agree
                if known < common:
                    common = known  # i agrees further with popped, whose suffix is larger than j's: so is i's
                    break
                extend = known == common
            if extend:
                while i + common < n and s[j + common] == s[i + common]:
                    common += 1
                if i + common >= far:
                    old, new, far = j, i, i + common
            if i + common == n or s[j + common] > s[i + common]:
                following[j], following_common[j] = i, common
                popped, j = j, preceding[j]
            else:
                break
        if j >= 0 and s[j] == word:
            preceding_common[i] = common
        preceding[i] = j
    return following, following_common


def common_before(s: list[int], starts: np.ndarray, following: np.ndarray) -> np.ndarray:
    """How many words before a place i equal those before following[i], for the ascending places of starts, whose preceding words are equal; 0 elsewhere.

    From right to left: between far and old the text repeats what ends at new, and the Lyndon words in there are found again d further on.
    """
    out = np.zeros(len(s) + 1, np.int64)
    found: dict[int, int] = {}
    old, d, far = 0, 0, len(s)
    for i, j in zip(starts[::-1].tolist(), following[starts[::-1]].tolist(), strict=True):
        common = 0
        if far < i < old:
            common = found.get(i + d, 0)
            if i - common > far:
                found[i] = common
                continue
            common = i - far
        while common < i and s[i - common - 1] == s[j - common - 1]:
            common += 1
        found[i] = common
        if i - common <= far:
            old, d, far = i, j - i, i - common
    if found:
        out[np.fromiter(found, np.int64, len(found))] = np.fromiter(found.values(), np.int64, len(found))
    return out


def runs_of(ranks: np.ndarray, least: int = LEAST_WORDS) -> np.ndarray:
    """start, length, period of the runs of a sequence of ordered symbols with length >= max(least, 2 * period), by start and period."""
    n, found = len(ranks), []
    if n < max(least, 2):
        return np.zeros((0, 3), np.int64)
    top = int(ranks.max())
    for order in (ranks, top - ranks):
        s = order.tolist()
        listed, listed_common = smaller_suffixes(s)
        following, right = np.array(listed, np.int64), np.array(listed_common, np.int64)
        place = np.arange(n)
        inside = (following < n) & (place > 0)
        equal_before = np.zeros(n, bool)
        equal_before[inside] = order[place[inside] - 1] == order[following[inside] - 1]
        left = common_before(s, np.flatnonzero(equal_before), following)[:n]
        period = following - place
        length = left + period + right
        hit = np.flatnonzero((following < n) & (length >= 2 * period) & (length >= least))
        found.append(np.stack([place[hit] - left[hit], length[hit], period[hit]], axis=1))
    runs = np.unique(np.concatenate(found), axis=0)  # a run is found from each of its Lyndon words
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def dropped(n: int, runs: np.ndarray) -> np.ndarray:
    """Whether each of n words lies in a run after its first period."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edges[:n]) > 0


def ranked_words(texts: pa.Array) -> tuple[list[list[bytes]], list[np.ndarray]]:
    """The words of each text, and their ranks among all words of these texts in the order of their bytes."""
    listed = pc.ascii_split_whitespace(pc.cast(texts, pa.large_string()))
    coded = listed.flatten().dictionary_encode()
    rank = np.empty(len(coded.dictionary), np.int64)
    rank[pc.sort_indices(coded.dictionary).to_numpy()] = np.arange(len(rank))
    ranks = rank[coded.indices.to_numpy()] if len(coded) else np.zeros(0, np.int64)
    real = pc.not_equal(coded.dictionary, "").to_numpy(zero_copy_only=False)
    kept = real[coded.indices.to_numpy()] if len(coded) else np.zeros(0, bool)
    offsets = listed.offsets.to_numpy().astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum(kept)])[offsets - offsets[0]]  # without the empty strings at the ends of texts
    ranks = ranks[kept]
    return [t.encode().split() for t in texts.to_pylist()], [ranks[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


Sequence = tuple[list[bytes], np.ndarray]
FIELDS = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def described(words: list[bytes], ranks: np.ndarray, least: int) -> tuple:
    """FIELDS of a sequence of words."""
    runs = runs_of(ranks, least)
    if not len(runs):
        return 0, None, None, None, None, hashlib.sha256(b"").hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest()
    start, length, period = runs[np.lexsort((runs[:, 2], runs[:, 0], -runs[:, 1]))[0]].tolist()
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs.tolist())
    gone = dropped(len(words), runs)
    left = b" ".join(w for w, x in zip(words, gone.tolist(), strict=True) if not x)
    return len(runs), start, length, period, 1000 * length // period, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left).hexdigest()


def periodic_runs(docs: DataFrame, *, rewrite: Callable[[list[bytes], np.ndarray, int | None], Sequence] | None = None, seed: Column | None = None, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, n_runs (runs of least_words words or more), the start, length, period and exponent (in thousandths) of the longest, and digests of
    all runs and of the words that stay when each run keeps its first period only. rewrite(words, ranks, seed), if given, changes the words of a row first."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                rows = []
                for words, ranks, mark in zip(*ranked_words(part.column("text")), part.column("seed").to_pylist(), strict=True):
                    rows.append(described(*(rewrite(words, ranks, mark) if rewrite else (words, ranks)), least_words))
                columns = [part.column("doc_id"), *(pa.array(c, pa.string() if k > 4 else pa.int64()) for k, c in enumerate(zip(*rows, strict=True)))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *(f.split()[0] for f in FIELDS.split(", "))])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), (F.lit(None) if seed is None else seed).cast("long").alias("seed"))
    return source.mapInArrow(run, f"doc_id long, {FIELDS}")


def collapsed(docs: DataFrame, *, least_words: int = LEAST_WORDS) -> DataFrame:
    """docs, each text with runs in it as its words without the repeats of the runs, joined by one space; texts without runs, null ones too, stay as they are."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                texts = part.column("text").to_pylist()
                filled = pc.fill_null(part.column("text"), "")
                for k, (words, ranks) in enumerate(zip(*ranked_words(filled), strict=True)):
                    if len(runs := runs_of(ranks, least_words)):
                        texts[k] = b" ".join(w for w, x in zip(words, dropped(len(words), runs).tolist(), strict=True) if not x).decode()
                yield part.set_column(part.schema.get_field_index("text"), "text", pa.array(texts, pa.string()))

    return docs.mapInArrow(run, docs.schema)


def repeated_tail(words: list[bytes], ranks: np.ndarray, h: int | None) -> Sequence:
    """The words with those from g % n on replaced by repeats of a stretch that begins there, for a tenth of the values of h; no change without h."""
    n = len(words)
    if h is None or h % 10 or not n:
        return words, ranks
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    index = np.arange(n)
    index[a:] = a + (index[a:] - a) % p
    return [words[i] for i in index.tolist()], ranks[index]
