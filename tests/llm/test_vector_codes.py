import hashlib
import math
import random
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from folio.llm import vector_codes as vc


def squared(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def brute(rows):
    """The contract in plain Python, every entry measured."""
    rows = [(i, [math.floor(4096 * x) for x in v], c) for i, v, c in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    width = len(rows[0][1]) // 8
    cut = lambda v, p: v[p * width : (p + 1) * width]
    first = sorted((i, v) for i, v, _ in rows if i is not None)[:16]
    books = [[cut(v, p) for _, v in first] for p in range(8)]
    near = lambda v, p: min(range(len(first)), key=lambda e: (squared(cut(v, p), books[p][e]), e))
    for _ in range(6):
        groups = defaultdict(list)
        for _, v, _ in rows:
            for p in range(8):
                groups[p, near(v, p)].append(cut(v, p))
        for (p, e), members in groups.items():
            books[p][e] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    out, labels = [], defaultdict(int)
    for i, v, c in rows:
        code = [near(v, p) for p in range(8)]
        error = sum(squared(cut(v, p), books[p][e]) for p, e in enumerate(code))
        labels[c] += error
        out.append((i, "".join(f"{e:02x}" for e in code), error, c))
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(i, code, error, labels[c], sha) for i, code, error, c in out]


KEY = lambda r: (r[0] is not None, r[0] or 0, r[1:])


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_codes_equal_brute_force(spark):
    rng = random.Random(3)
    draw = lambda: [rng.randint(-64, 64) / 64 for _ in range(24)]
    rows = [(i, draw(), rng.choice([None, 1, 2, 3])) for i in range(300)]
    rows += [(400 + i, rows[7][1], 1) for i in range(120)]  # a large group of equal vectors
    rows += [(5, rows[5][1], 2), (None, draw(), None), (900, None, 1), (901, [], 1), (902, [None] * 24, 1), (903, [float("nan")] * 24, 2), (904, [float("inf")] + [0.0] * 23, 2), (905, [-float("inf")] + [0.0] * 23, 2)]
    got = vc.vector_codes(table(spark, rows).repartition(7))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, got.collect()), key=KEY) == sorted(brute(rows), key=KEY)


def test_labels_beyond_a_broadcast(spark, monkeypatch):
    from folio.llm import common

    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    rows = [(i, [float(i % 5 + k) for k in range(8)], i % 3 or None) for i in range(60)]
    assert sorted(map(tuple, vc.vector_codes(table(spark, rows)).collect()), key=KEY) == sorted(brute(rows), key=KEY)


def test_few_odd_and_no_rows(spark):
    assert vc.vector_codes(table(spark, [])).collect() == []
    assert vc.vector_codes(table(spark, [(1, [1.0] * 7, 1), (2, None, 1)])).collect() == []
    rows = [(1, [0.5] * 8, 1), (2, [0.25] * 8, None), (3, [0.5] * 16, 1), (4, [1e30] * 8, 1)]  # another length, and too large
    assert sorted(map(tuple, vc.vector_codes(table(spark, rows)).collect())) == sorted(brute(rows[:2]))


def test_other_columns_are_ignored(spark):
    rows = table(spark, [(1, [0.5] * 8, 1), (2, [0.25] * 8, 1)]).selectExpr("*", "'x' AS code", "1 AS vector", "2 AS error", "3 AS `of`")
    assert vc.vector_codes(rows).count() == 2


def test_decoded_is_near(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=16).astype(np.float32).tolist(), 0) for i in range(200)]
    source = table(spark, rows).selectExpr("vec_id", "embedding AS vector", "label")
    books = vc.codebooks(source)
    back = {r.vec_id: (r.vector, r.error) for r in vc.decoded(vc.codes(source, books), books).collect()}
    for i, v, _ in rows:
        exact = sum((math.floor(4096 * x) / 4096 - y) ** 2 for x, y in zip(v, back[i][0], strict=True))
        assert math.isclose(exact * 4096**2, back[i][1], rel_tol=1e-9)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(-5, 5), min_size=2, max_size=2), min_size=1, max_size=16), st.lists(st.lists(st.integers(-6, 6), min_size=2, max_size=2), min_size=1, max_size=20))
def test_annulus_finds_the_nearest_entry(entries, x):
    index, distance = vc.nearest(np.array(x, np.int64), np.array(entries, np.int64))
    for v, i, d in zip(x, index.tolist(), distance.tolist(), strict=True):
        assert (d, i) == min((squared(v, e), k) for k, e in enumerate(entries))
