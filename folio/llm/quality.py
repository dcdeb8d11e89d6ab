"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. A line's features are shares of kinds of characters and words, its length, whether it repeats
another line, and how it differs from the lines before and after it. The field is trained on documents whose lines all
carry the document's label. The forward-backward algorithm gives each line's probability of being good; a document's
quality is their mean, weighted by length, carried to a probability by a logistic curve that is fitted on the same rows.

Null and empty texts are one empty line. Labels of rows whose crc32(doc_id) mod 4 is 2 are never used; labels, lang,
source and doc_id are never inputs of a score. Without labels of both kinds every score is 0.5. A doc_id labelled more
than once counts once, with its smaller label. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.llm.common import text_of, written
from folio.llm.words import slices

#: Labelled rows of each label that train the field (those of the least hashes of doc_id).
SAMPLE = 1500
STEPS, RATE, PENALTY = 250, 0.05, 1e-3
THRESHOLD = 0.7
OWN = 13
NAMES = 3 * OWN + 1


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("long").cast("string").cast("binary")) % 4 == 2


def classes() -> np.ndarray:
    """Kinds of bytes: 0 other, 1 lower case, 2 upper case, 3 digit, 4 space, 5 sentence mark, 6 symbol, 7 beyond ASCII."""
    kind = np.full(256, 6, np.uint8)
    for chars, k in ((b"abcdefghijklmnopqrstuvwxyz", 1), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 2), (b"0123456789", 3), (b" \t\r\x0b\x0c", 4), (b".,;:?'\"-()", 5)):
        kind[list(chars)] = k
    kind[128:] = 7
    return kind


KIND = classes()


def line_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A row of NAMES numbers for each line, the length of each line, and where each text's lines begin (one more at the end)."""
    listed = pc.split_pattern(texts, "\n")
    lines = listed.flatten()
    first = listed.offsets.to_numpy().astype(np.int64)
    first -= first[0]
    offsets = np.frombuffer(lines.buffers()[1], np.int32)[lines.offset : lines.offset + len(lines) + 1].astype(np.int64)
    data = np.frombuffer(lines.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets -= offsets[0]
    kind = KIND[data]
    size = np.diff(offsets)

    def count(hit: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(hit)])
        return (total[offsets[1:]] - total[offsets[:-1]]).astype(np.float64)

    n = np.maximum(size, 1)
    letters = count((kind == 1) | (kind == 2) | (kind == 7))
    spaces = count(kind == 4)
    coded = lines.dictionary_encode()
    index = coded.indices.to_numpy().astype(np.int64)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    _, back, times = np.unique(text * max(len(coded.dictionary), 1) + index, return_inverse=True, return_counts=True)
    listed_words = pc.ascii_split_whitespace(lines)
    start = listed_words.offsets.to_numpy().astype(np.int64)
    start -= start[0]
    word = listed_words.flatten().dictionary_encode().indices.to_numpy()
    begin = np.repeat(start[:-1], np.diff(start))

    def again(gap: int) -> np.ndarray:
        """Share of a line's words that equal the word gap before it."""
        same = np.zeros(len(word) + 1)
        at = np.arange(gap, len(word))
        same[gap + 1 :] = (word[at] == word[at - gap]) & (at - gap >= begin[at])
        total = np.cumsum(same)
        return (total[start[1:]] - total[start[:-1]]) / np.maximum(np.diff(start), 1)

    bang, upper = count(data == 33), count(kind == 2)
    own = np.stack([
        upper / np.maximum(letters, 1), count(kind == 3) / n, np.minimum(20 * bang / n, 3), np.minimum(10 * count((kind == 6) & (data != 33)) / n, 3), count(kind == 7) / n, letters / n,
        np.minimum(n / (spaces + 1), 30) / 10, np.log1p(size) / 5, (times[back] > 1).astype(float) * (size > 0), np.minimum(20 * count(data == 124) / n, 3), np.minimum(10 * count(kind == 5) / n, 3), np.minimum(3 * again(1), 2), np.minimum(3 * (again(2) + again(3)), 2),
    ], 1)
    before, after = own.copy(), own.copy()
    inner = np.ones(len(own), bool)
    inner[first[:-1]] = False
    before[inner] = own[np.flatnonzero(inner) - 1]
    after[np.flatnonzero(inner) - 1] = own[inner]
    return np.hstack([own, before - own, after - own, np.ones((len(own), 1))]), n.astype(np.float64), first


def marginals(score: np.ndarray, move: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """P(good) of every line, expected transitions, and log Z of every text. score: of good against bad, a number for each line.

    All texts take a step at once, the longest ones first, so the steps are as many as the longest text has lines.
    """
    n = np.diff(first)
    order = np.argsort(-n, kind="stable")
    start, longest = first[:-1][order], int(n.max(initial=0))
    alive = np.searchsorted(-n[order], -np.arange(longest), "left")  # texts with more lines than t
    both = np.stack([np.zeros(len(score)), score], 1)
    forward, backward = np.zeros_like(both), np.zeros_like(both)
    join = lambda x: np.logaddexp(x[..., 0], x[..., 1])
    for t in range(longest):
        at = start[: alive[t]] + t
        forward[at] = both[at] if not t else both[at] + np.stack([join(forward[at - 1] + move[:, y]) for y in (0, 1)], 1)
    for t in range(longest - 2, -1, -1):
        at = start[: alive[t + 1]] + t
        backward[at] = np.stack([join(backward[at + 1] + both[at + 1] + move[y]) for y in (0, 1)], 1)
    total = join(forward[first[1:] - 1])
    of_line = np.repeat(total, n)
    inner = np.ones(len(score), bool)
    inner[first[:-1]] = False
    at = np.flatnonzero(inner)
    pairs = np.zeros((2, 2))
    for a in (0, 1):
        for b in (0, 1):
            pairs[a, b] = np.exp(forward[at - 1, a] + move[a, b] + both[at, b] + backward[at, b] - of_line[at]).sum()
    return np.exp(forward[:, 1] + backward[:, 1] - of_line), pairs, total


@dataclass(frozen=True)
class Field:
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    move: np.ndarray
    curve: tuple[float, float]


def quality(field: Field, x: np.ndarray, length: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The length-weighted mean of the lines' probabilities, by text."""
    good, _, _ = marginals(((x - field.centre) / field.scale) @ field.weights, field.move, first)
    return np.add.reduceat(good * length, first[:-1]) / np.add.reduceat(length, first[:-1])


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def fit(x: np.ndarray, length: np.ndarray, first: np.ndarray, label: np.ndarray, weight: np.ndarray) -> Field:
    """Adam steps on the likelihood of all lines; each text weighs as weight says, whatever its number of lines."""
    centre, scale = x.mean(0), x.std(0) + 1e-6
    centre[-1], scale[-1] = 0, 1
    z = (x - centre) / scale
    n = np.diff(first)
    y = np.repeat(label, n).astype(float)
    each = np.repeat(weight / n, n)
    theta, m, v = np.zeros(NAMES + 1), np.zeros(NAMES + 1), np.zeros(NAMES + 1)
    inner = np.ones(len(z), bool)
    inner[first[:-1]] = False
    stay = float(each[inner].sum())
    for t in range(1, STEPS + 1):
        move = np.array([[theta[-1], 0], [0, theta[-1]]])  # a bonus for staying in the state
        good, pairs, _ = marginals(z @ theta[:-1], move, first)
        expected = (pairs[0, 0] + pairs[1, 1]) / max(pairs.sum(), 1e-9)
        g = np.append(z.T @ ((good - y) * each) + PENALTY * theta[:-1], stay * (expected - 1) + 0.05 * theta[-1])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    field = Field(centre, scale, theta[:-1], np.array([[theta[-1], 0], [0, theta[-1]]]), (1.0, 0.0))
    q = logit(quality(field, x, length, first))
    a, b = 1.0, 0.0
    for _ in range(500):  # the curve, on the labels' own shares
        p = 1 / (1 + np.exp(-(a * q + b)))
        a, b = max(a - 0.05 * float(((p - label) * q).mean()), 0.05), b - 0.2 * float((p - label).mean())
    return Field(centre, scale, field.weights, field.move, (a, b))


def train(docs: DataFrame, labels: DataFrame) -> Field | None:
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).dropna().filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = [known.filter(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE) for q in (0, 1)]
    chosen = written(chosen[0].unionAll(chosen[1]), "labelled")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).join(F.broadcast(chosen), "doc_id")  # 2 * SAMPLE rows

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                x, length, first = line_features(part.column("text"))
                of = lambda values, k: pa.ListArray.from_arrays(pa.array(first * k, pa.int32()), pa.array(values.ravel()))
                yield pa.RecordBatch.from_arrays([part.column("quality"), of(x.astype(np.float32), NAMES), of(length, 1)], ["quality", "x", "length"])

    got = rows.mapInArrow(run, "quality int, x array<float>, length array<double>").toArrow()  # the lines of 2 * SAMPLE texts, NAMES numbers each
    label = got.column("quality").to_numpy().astype(float)
    if len(np.unique(label)) < 2:
        return None
    length = got.column("length").combine_chunks()
    first = length.offsets.to_numpy().astype(np.int64)
    x = got.column("x").combine_chunks().flatten().to_numpy().astype(np.float64).reshape(-1, NAMES)
    share = label.mean()
    return fit(x, length.flatten().to_numpy(), first - first[0], label, np.where(label == 1, 0.5 / share, 0.5 / (1 - share)) / len(label))


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    field = train(docs, labels)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                if field is None:
                    found = np.full(part.num_rows, 0.5)
                else:
                    a, b = field.curve
                    found = 1 / (1 + np.exp(-(a * logit(quality(field, *line_features(part.column("text")))) + b)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(found), pa.array((found >= THRESHOLD).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), text_of().alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
