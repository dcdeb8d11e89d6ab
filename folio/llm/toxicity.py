"""Toxicity by cumulative-link (proportional odds) ordinal regression over sparse word features.

P(grade > k) = sigmoid(w.x - threshold_k): all ordered thresholds share the weights w. Grades: 0 for rows labelled as
not toxic; rows labelled toxic have grade 1, or 2 if their share of words among the features is
above the median of such rows. Features are the words, and the beginnings of words (they carry over to other endings), that
most surely occur in more of the toxic documents, where copies of a text count once; a text's value for one is 1 if it has it, and weights are kept at zero
or more. The output is the expected grade, and toxic where P(grade > 0) reaches a
cutoff that is chosen on the training rows.

Null and empty texts have no features and get the grade of the intercept, which is not toxic. Without labels of both
kinds nothing is toxic. Labels of doc_ids that are not in the table, and rows with null labels, are ignored; a doc_id
labelled more than once counts once, with the larger label. Rows of equal doc_id are each graded; long texts are graded
whole. An empty table gives an empty result. Other columns are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.common import small, text_of, written
from folio.llm.words import slices, words

#: Labelled rows of each kind that train the model (those of the least hashes of doc_id), and features.
SAMPLE, FEATURES = 4000, 512
#: Standard errors by which a feature's rates differ at least.
MIN_Z = 3.5
#: Distinct toxic texts that have a feature at least: so many, or this share of them where that is fewer.
MIN_TEXTS, MIN_SHARE = 20, 0.02
#: How many times the share of the other texts that of the toxic ones is at least.
MIN_LIFT = 30
CLEAN_COST = 20
#: Texts that a task gets at once in a stage of the pipeline.
BATCH_ROWS = 2000
#: Letters in the beginnings of words.
PREFIXES = (4, 5)
STEPS, RATE, PENALTY = 600, 0.5, 1e-4
GRADES = 3


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    thresholds: tuple[float, ...]
    cutoff: float = 0.5


def views(texts: pa.Array) -> tuple[list[pa.Array], np.ndarray, np.ndarray]:
    """The distinct words and, in the same order, their PREFIXES, all marked by kind; the index of each word of all texts, and its text."""
    distinct, index, offsets = words(texts)
    plain = pa.array(distinct, pa.string())
    long = [pc.if_else(pc.greater(pc.utf8_length(plain), n), pc.utf8_slice_codeunits(plain, 0, n), "") for n in PREFIXES]
    marked = [pc.binary_join_element_wise(f"{n}:", x, "") for n, x in zip((0, *PREFIXES), (plain, *long), strict=True)]
    return marked, index, np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def document_features(texts: pa.Array, features: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (text, feature) that occur, each once, by text."""
    known = pa.array(features, pa.string())
    kinds, index, text = views(texts)
    pairs = []
    for kind in kinds:
        at = pc.fill_null(pc.index_in(kind, value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        at = at[index] if len(kind) else np.zeros(0, np.int64)
        pairs.append(text[at >= 0] * max(len(features), 1) + at[at >= 0])
    pair = np.unique(np.concatenate(pairs))
    return pair // max(len(features), 1), pair % max(len(features), 1)


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text, toxic of SAMPLE rows of each label at most; copies (but for case and white space) are one row, with the larger label."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).dropna().groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = [known.filter(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE) for t in (0, 1)]
    chosen = written(chosen[0].unionAll(chosen[1]), "labelled")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).join(F.broadcast(chosen), "doc_id")  # 2 * SAMPLE rows
    alike = F.sha2(F.trim(F.regexp_replace(F.lower("text"), r"\s+", " ")), 256)
    return rows.groupBy(alike.alias("alike")).agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).drop("alike")


def train(docs: DataFrame, labels: DataFrame) -> Model:
    rows = written(sample(docs, labels), "toxicity-sample")
    totals = dict(rows.groupBy("toxic").count().collect())
    if len(totals) < 2:
        return Model({}, (20.0,) * (GRADES - 1))

    def pairs(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                kinds, index, text = views(part.column("text"))
                toxic = part.column("toxic").to_numpy()
                for kind in kinds:
                    coded = kind.dictionary_encode()
                    n = max(len(coded.dictionary), 1)
                    pair = np.unique(text * n + (coded.indices.to_numpy()[index] if len(kind) else 0))
                    bad = toxic[pair // n] == 1
                    yield pa.RecordBatch.from_arrays([coded.dictionary, *[pa.array(np.bincount(pair[x] % n, minlength=n)[: len(coded.dictionary)]) for x in (bad, ~bad)]], ["word", "bad", "good"])

    p, q = (F.col("bad") + 0.5) / (totals[1] + 1), (F.col("good") + 0.5) / (totals[0] + 1)
    counted = rows.mapInArrow(pairs, "word string, bad long, good long").filter("not word rlike ':$'").groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    counted = counted.filter((F.col("bad") >= min(MIN_TEXTS, MIN_SHARE * totals[1])) & (p >= MIN_LIFT * q))
    scored = counted.select("word", (p - q).alias("gap"), ((p - q) / F.sqrt(p * (1 - p) / totals[1] + q * (1 - q) / totals[0])).alias("z"))
    chosen = scored.filter(F.col("z") >= MIN_Z).orderBy(F.desc("z"), "word").limit(FEATURES).collect()
    features = [r.word for r in chosen]

    def vectors(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                text, feature = document_features(part.column("text"), features)
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(part.num_rows + 1)), pa.int32()), pa.array(feature))
                kinds, index, of = views(part.column("text"))
                marked = pc.is_in(kinds[0], value_set=pa.array(features, pa.string())).to_numpy(zero_copy_only=False)
                hits = np.bincount(of, marked[index], minlength=part.num_rows) if len(of) else np.zeros(part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column("toxic"), lists, pa.array(hits / np.maximum(np.bincount(of, minlength=part.num_rows), 1))], ["toxic", "x", "share"])

    got = rows.mapInArrow(vectors, "toxic int, x array<long>, share double").toPandas()  # 2 * SAMPLE rows of FEATURES numbers at most
    x = np.zeros((len(got), len(features) or 1))
    for k, at in enumerate(got["x"]):
        x[k, np.array(at, dtype=np.int64)] = 1
    toxic, share = got["toxic"].to_numpy(), got["share"].to_numpy()
    grade = toxic + ((toxic == 1) & (share > np.median(share[toxic == 1])))
    weights, thresholds = fit(x, grade)
    return Model(dict(zip(features, map(float, weights), strict=False)), tuple(map(float, thresholds)), cutoff(sigmoid(x @ weights - thresholds[0]), toxic == 1))


def cutoff(p: np.ndarray, toxic: np.ndarray) -> float:
    """The P(grade > 0) that tells the training rows apart best: half-way between two of them, where wrongly marked rows weigh CLEAN_COST times the missed ones."""
    values = np.unique(p)
    if len(values) < 2:
        return 0.5
    between = (values[1:] + values[:-1]) / 2
    missed = np.searchsorted(np.sort(p[toxic]), between) / toxic.sum()
    wrong = 1 - np.searchsorted(np.sort(p[~toxic]), between) / (~toxic).sum()
    return float(between[np.argmin(missed + CLEAN_COST * wrong)])


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def cuts(theta: np.ndarray, n: int) -> np.ndarray:
    """The thresholds: the first, then ever larger ones."""
    return theta[n] + np.concatenate([[0], np.cumsum(np.exp(theta[n + 1 :]))])


def loss_and_gradient(theta: np.ndarray, x: np.ndarray, grade: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """The penalised negative log-likelihood of the cumulative-link model with weights theta[:n], and its gradient."""
    rows, n = x.shape
    gaps = GRADES - 1
    above = sigmoid((x @ theta[:n])[:, None] - cuts(theta, n))  # P(grade > k)
    full = np.hstack([np.ones((rows, 1)), above, np.zeros((rows, 1))])
    slope = full * (1 - full)
    at = np.arange(rows)
    p = np.maximum(full[at, grade] - full[at, grade + 1], 1e-12)
    dz = (slope[at, grade] - slope[at, grade + 1]) / p * weight
    dcut = np.zeros(gaps)
    for k in range(gaps):
        dcut[k] = (-(slope[:, k + 1] / p * weight)[grade == k + 1].sum()) + ((slope[:, k + 1] / p * weight)[grade == k]).sum()
    g = np.zeros_like(theta)
    g[:n] = -(x.T @ dz) + PENALTY * theta[:n]
    g[n] = -dcut.sum()
    for k in range(1, gaps):
        g[n + k] = -dcut[k:].sum() * np.exp(theta[n + k])
    return float(-(weight * np.log(p)).sum() + PENALTY / 2 * (theta[:n] ** 2).sum()), g


def fit(x: np.ndarray, grade: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of the most likely cumulative-link model, by Adam steps over all rows; grades weigh equally."""
    rows, n = x.shape
    theta = np.zeros(n + GRADES - 1)
    theta[n] = 1.0  # the first threshold, then logarithms of the steps between thresholds
    share = np.bincount(grade, minlength=GRADES) / rows
    weight = np.where(grade == 0, 0.5 / max(share[0], 1e-9), 0.5 / max(1 - share[0], 1e-9)) / rows
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, STEPS + 1):
        _, g = loss_and_gradient(theta, x, grade, weight)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta -= RATE * 0.2 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9) * (1 - t / (STEPS + 1))
        theta[:n] = np.maximum(theta[:n], 0)
    return theta[:n], cuts(theta, n)


def graded(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, expected_severity, p_toxic, toxic."""
    features, weights = list(model.weights), np.array(list(model.weights.values()))

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                text, feature = document_features(part.column("text"), features)
                z = np.bincount(text, weights[feature], minlength=part.num_rows) if len(text) else np.zeros(part.num_rows)
                above = sigmoid(z[:, None] - np.array(model.thresholds))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(above.sum(1)), pa.array(above[:, 0]), pa.array(above[:, 0] >= model.cutoff)], ["doc_id", "expected_severity", "p_toxic", "toxic"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(run, "doc_id long, expected_severity double, p_toxic double, toxic boolean")


def severities(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return graded(docs, train(docs, labels))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not toxic; rows whose doc_id is null stay."""
    gone = written(severities(docs, labels).filter("toxic").select("doc_id").distinct(), "toxic", BATCH_ROWS)
    return docs.join(small(gone), "doc_id", "left_anti").select(*docs.columns)
