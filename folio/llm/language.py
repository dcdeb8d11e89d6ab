"""Languages of texts by hyperdimensional profiles.

Every letter has a random vector of DIMENSIONS signs, drawn from its code point alone. An n-gram of letters is bound to one
vector: its letters' vectors, rotated by their places, are multiplied. A text is the bundle of its n-grams, the sum of their
vectors; a language's prototype is the bundle of all its training texts. A text gets the language of the prototype with the
largest cosine. A bundle is a sum over n-grams, so the n-grams of a slice of texts are counted by language before they are
bound, and each task sends one vector a language: all labelled texts are learned from, none is sampled.

Letters are lower-cased; marks that belong to letters count as letters within words, all else is a space, and spaces in a row
are one.

A text that is null, empty or without a letter is UNKNOWN with score 0, and so is every text where nothing was learned. Ties
go to the first language by name. Only rows with text, letters, a language and a doc_id train. Rows of equal doc_id each give a
row and train as often. Long texts are read whole, which takes some 50 bytes of a task's memory a character; n-grams are bound CHUNK at a time. An empty table gives an
empty result; other columns are ignored. The prototypes (2 KB for each distinct lang value) go to the driver and to every
task: over MOST_LANGUAGES values is an error, since they are then no languages.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.llm.common import text_of
from folio.llm.words import slices

DIMENSIONS, N, SEED = 1024, 3, 0x5EED
UNKNOWN = "und"
#: n-grams bound at once.
CHUNK = 4096
SLICE_BYTES = 2 << 20
MOST_LANGUAGES = 10_000
SPACE = 32


@functools.lru_cache(1)
def kinds() -> np.ndarray:
    """For each code point 2 if it is a letter, 1 if it is a mark, else 0."""
    return np.frombuffer(bytes({"L": 2, "M": 1}.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)), np.uint8)


@functools.lru_cache(1 << 15)
def signs(letter: int) -> np.ndarray:
    """The vector of a letter: DIMENSIONS times 1 or -1."""
    bits = np.random.Philox(key=[SEED, letter]).random_raw(DIMENSIONS // 64)
    return (2 * np.unpackbits(bits.view(np.uint8)).astype(np.int8) - 1).astype(np.int8)


def letters(text: str) -> np.ndarray:
    """Code points of the lower-cased letters, with one space before, between and after words; empty if there is no letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = kinds()[codes]
    if not (kind == 2).any():
        return codes[:0]
    codes = np.concatenate([[SPACE], np.where(kind > 0, codes, SPACE), [SPACE]]).astype(np.uint32)
    return codes[np.concatenate([[True], (codes[1:] != SPACE) | (codes[:-1] != SPACE)])]


def tables(alphabet: np.ndarray) -> list[np.ndarray]:
    """The letters' vectors, rotated for each place of an n-gram."""
    base = np.stack([signs(int(c)) for c in alphabet])
    return [np.roll(base, N - 1 - k, axis=1) for k in range(N)]


def grams(coded: np.ndarray, letters_: int) -> np.ndarray:
    """The n-grams of a sequence of letter numbers below letters_, each as one number."""
    out = np.zeros(max(len(coded) - N + 1, 0), np.int64)
    for k in range(N):
        out = out * letters_ + coded[k : len(coded) - N + 1 + k]
    return out


def bundle(numbers: np.ndarray, counts: np.ndarray, rotated: list[np.ndarray]) -> np.ndarray:
    """The sum of counts times the vectors of n-grams."""
    size, out = len(rotated[0]), np.zeros(DIMENSIONS)
    for at in range(0, len(numbers), CHUNK):
        rest, bound = numbers[at : at + CHUNK], None
        for table in rotated[::-1]:
            rest, letter = np.divmod(rest, size)
            bound = table[letter] if bound is None else bound * table[letter]
        out += counts[at : at + CHUNK].astype(np.float32) @ bound.astype(np.float32)
    return out


def coded_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray], list[np.ndarray]]]:
    """Slices of batches with the n-grams of each text and the letters' rotated vectors."""
    for batch in batches:
        for part in slices(batch, "text", SLICE_BYTES):
            texts = [letters(t) for t in part.column("text").to_pylist()]
            alphabet, coded = np.unique(np.concatenate(texts), return_inverse=True)
            ends = np.cumsum([len(t) for t in texts])
            yield part, [grams(coded[e - len(t) : e], len(alphabet)) for t, e in zip(texts, ends, strict=True)], tables(alphabet) if len(alphabet) else []


def learned(labelled: DataFrame) -> dict[str, np.ndarray]:
    """The unit prototype of each lang of labelled (text, lang)."""

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for part, texts, rotated in coded_slices(batches):
            by: dict[str, list[np.ndarray]] = {}
            for lang, numbers in zip(part.column("lang").to_pylist(), texts, strict=True):
                if len(numbers):
                    by.setdefault(lang, []).append(numbers)
            for lang, found in by.items():
                sums[lang] = sums.get(lang, 0) + bundle(*np.unique(np.concatenate(found), return_counts=True), rotated)
        for lang, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * DIMENSIONS), pa.array(np.arange(DIMENSIONS, dtype=np.int32)), pa.array(np.rint(total).astype(np.int64))], ["lang", "place", "value"])

    parts = labelled.filter("text IS NOT NULL AND lang IS NOT NULL").select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).mapInArrow(run, "lang string, place int, value long")
    sums = parts.groupBy("lang", "place").agg(F.sum("value").alias("value")).groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "value"))), lambda x: x["value"]).alias("sums"))
    rows = sums.limit(MOST_LANGUAGES + 1).collect()
    if len(rows) > MOST_LANGUAGES:
        raise ValueError(f"lang has more than {MOST_LANGUAGES} values")
    out = {r.lang: np.array(r.sums, np.float64) for r in rows}
    return {k: v / np.linalg.norm(v) for k, v in sorted(out.items()) if v.any()}


def languages(docs: DataFrame, prototypes: dict[str, np.ndarray], *, held_out: Column | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score (the cosine with the prototype of lang_pred; 0 where it is negative), margin (over the second)."""
    names = list(prototypes)
    unit = np.stack(list(prototypes.values())).astype(np.float32) if names else np.zeros((0, DIMENSIONS), np.float32)

    def run(batches):
        for part, texts, rotated in coded_slices(batches):
            vectors = np.zeros((len(texts), DIMENSIONS), np.float32)
            for k, numbers in enumerate(texts):
                if len(numbers) and names:
                    vectors[k] = bundle(*np.unique(numbers, return_counts=True), rotated)
            known = vectors.any(1)
            cosine = vectors @ unit.T / np.maximum(np.linalg.norm(vectors, axis=1), 1e-12)[:, None]
            best = cosine.argmax(1) if names else np.zeros(len(texts), np.int64)
            score = np.where(known, np.clip(cosine.max(1, initial=-1.0), 0, 1), 0.0)
            second = np.sort(cosine, axis=1)[:, -2] if len(names) > 1 else np.zeros(len(texts))
            margin = np.where(known, cosine.max(1, initial=-1.0) - second, 0.0)
            said = [names[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), known.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(said, pa.string()), pa.array(score.astype(np.float64)), pa.array(margin.astype(np.float64))], ["doc_id", "held_out", "lang_pred", "score", "margin"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.lit(None) if held_out is None else held_out).cast("boolean").alias("held_out"), text_of().alias("text"))
    return source.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, margin double")


def identified(docs: DataFrame) -> DataFrame:
    """languages() of docs, learned from those whose crc32(doc_id) mod 4 is not 2; held_out marks the others."""
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    return languages(docs, learned(docs.filter(~held_out)), held_out=held_out)
