import math
import random

import numpy as np

from folio.llm import toxicity as t


def test_gradient_finds_an_ordered_model():
    rng = np.random.default_rng(1)
    x = (rng.random((3000, 6)) < 0.4).astype(float)
    z = x @ np.array([4, 2, 0, 0, 1, 0.0])
    grade = (rng.random(3000) < t.sigmoid(z - 3)).astype(int) * (1 + (z > 4))
    w, cut = t.fit(x, grade)
    assert w[0] > w[1] > 0.5 and w[2] < 0.5 and min(w) >= 0 and cut[0] < cut[1]


def test_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    known = labels.filter("doc_id % 3 <> 0")
    got = {r.doc_id: r for r in t.severities(docs, known).collect()}
    held = [(r.toxic, got[r.doc_id]) for r in labels.filter("doc_id % 3 = 0").collect()]
    right = sum(bool(y) == r.toxic for y, r in held)
    false = sum(r.toxic and not y for y, r in held)
    assert len(got) == 1000 and right >= 0.95 * len(held) and false <= 1, (right, false, len(held))
    assert all(0 <= r.expected_severity <= 2 for r in got.values())
    assert min(r.p_toxic for r in got.values() if r.toxic) > max(r.p_toxic for r in got.values() if not r.toxic)


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (3, "x y", "c"), (3, "x y", "c"), (None, "idiot", "d")], "doc_id long, text string, toxic string")
    labels = spark.createDataFrame([(3, 0), (9, 1), (2, None)], "doc_id long, toxic int")
    assert [r.toxic for r in t.severities(docs, labels).collect()] == [False] * 5
    assert t.without_toxic(docs, labels).count() == 5
    assert t.severities(docs.limit(0), labels.limit(0)).collect() == []


def test_copies_of_a_long_text_count_once(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "toxic")
    toxic = labels.filter("toxic = 1").join(docs, "doc_id").orderBy("doc_id").collect()
    long = " ".join([toxic[0].text, *(f"{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)}qz" for k in range(3000))])
    ids = range(10**6, 10**6 + len(toxic) // 2)  # a third of the toxic labels
    plain = t.train(docs, labels).weights
    more = t.train(docs.unionAll(spark.createDataFrame([(i, long) for i in ids], "doc_id long, text string")), labels.unionAll(spark.createDataFrame([(i, 1) for i in ids], labels.schema)))
    assert plain and not [w for w in more.weights if w.endswith("qz")]
    assert len(set(plain) & set(more.weights)) >= 0.9 * len(plain)


def test_rare_toxic_word_in_a_large_sample(spark):
    """A word that 25 of 2,000 toxic texts have, and no other, is a feature."""
    rng = np.random.default_rng(4)
    rows = [(k, " ".join([*(f"w{x}" for x in rng.integers(0, 400, 12)), *["vile"] * (k % 2 and k % 3 == 0), *["rotter"] * (k % 160 == 1)]), k % 2) for k in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    weights = t.train(docs.select("doc_id", "text"), docs.select("doc_id", "toxic")).weights
    assert {"0:vile", "0:rotter"} <= set(weights)


def test_gradient_equals_finite_differences():
    rng = np.random.default_rng(2)
    x = (rng.random((40, 5)) < 0.5).astype(float)
    grade, weight = rng.integers(0, t.GRADES, 40), rng.random(40) / 40
    for _ in range(5):
        theta = rng.normal(size=5 + t.GRADES - 1)
        _, g = t.loss_and_gradient(theta, x, grade, weight)
        for k in range(len(theta)):
            step = np.zeros_like(theta)
            step[k] = 1e-6
            slope = (t.loss_and_gradient(theta + step, x, grade, weight)[0] - t.loss_and_gradient(theta - step, x, grade, weight)[0]) / 2e-6
            assert math.isclose(slope, g[k], rel_tol=1e-4, abs_tol=1e-7)


def plain_score(text, model):
    """The contract in plain Python: each feature that a text has counts once; P(grade > k) for each threshold."""
    marks = ".,!?;:\"'()[]{}*#$%&|<>-_/=+~`"
    found = set()
    for w in (text or "").lower().split():
        w = w.strip(marks)
        found |= {f"0:{w}"} | {f"{n}:{w[:n]}" for n in t.PREFIXES if len(w) > n}
    z = sum(v for k, v in model.weights.items() if k in found)
    above = [1 / (1 + math.exp(-(z - c))) for c in model.thresholds]
    return sum(above), above[0], above[0] >= model.cutoff


def test_scores_equal_plain_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rng = random.Random(6)
    long = " ".join(rng.choice(["vile", "wort", "Vile!", "(vileness)"]) for _ in range(400_000))
    more = spark.createDataFrame([(2001, None), (2002, ""), (2003, long), (2004, "Vile vile VILE"), (2004, "Vile vile VILE"), (None, "vile wort")], docs.schema)
    hand = t.Model({"0:vile": 2.5, "4:vile": 1.0, "5:vilen": 0.25, "0:wort": 0.5}, (1.0, 3.0), 0.6)
    for model in (hand, t.train(docs, labels)):
        rows = docs.unionAll(more)
        want = sorted((r.doc_id or -1, *plain_score(r.text, model)) for r in rows.collect())
        got = sorted((r.doc_id or -1, r.expected_severity, r.p_toxic, r.toxic) for r in t.graded(rows, model).collect())
        assert len(got) == len(want)
        for a, b in zip(got, want, strict=True):
            assert (a[0], a[3]) == (b[0], b[3]) and math.isclose(a[1], b[1], abs_tol=1e-9) and math.isclose(a[2], b[2], abs_tol=1e-9)
