import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folio.llm import runs


def brute(s, least):
    """Runs by trying every period at every place."""
    out, n = set(), len(s)
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            if s[i] != s[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and s[j] == s[j + p]:
                j += 1
            a, b = i, j + p
            if b - a >= max(2 * p, least) and not any(all(s[x] == s[x + q] for x in range(a, b - q)) for q in range(1, p)):
                out.add((a, b - a, p))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def as_tuples(found):
    return [tuple(x) for x in found.tolist()]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.integers(2, 12))
def test_runs_equal_brute_force(s, least):
    assert as_tuples(runs.runs_of(np.array(s, np.int64), least)) == brute(s, least)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=6), st.integers(1, 5)), max_size=6))
def test_runs_of_repeated_stretches(parts):
    s = [x for part, k in parts for x in part * k]
    assert as_tuples(runs.runs_of(np.array(s, np.int64), 2)) == brute(s, 2)


def words_of_kind(kind, n):
    a, b = [0], [1]
    if kind == "fibonacci":
        a, b = [0], [0, 1]
        while len(b) < n:
            a, b = b, b + a
        return b[:n]
    if kind == "thue":
        return [bin(i).count("1") & 1 for i in range(n)]
    if kind == "ones":
        return [1] * n
    if kind == "ruler":
        return [(i & -i).bit_length() for i in range(1, n + 1)]
    if kind == "falling":
        return list(range(n, 0, -1))
    return (list(range(50)) * n)[:n]


@pytest.mark.parametrize("kind", ["fibonacci", "thue", "ones", "ruler", "falling", "cycle"])
def test_runs_of_known_words(kind):
    s = words_of_kind(kind, 150)
    assert as_tuples(runs.runs_of(np.array(s, np.int64), 2)) == brute(s, 2)


class Counted(int):
    """A symbol whose equality tests are counted."""

    tests = 0

    def __eq__(self, other):
        Counted.tests += 1
        return int(self) == int(other)

    __hash__ = int.__hash__


@pytest.mark.parametrize("kind", ["fibonacci", "thue", "ones", "ruler", "falling", "cycle"])
def test_comparisons_are_linear(kind):
    for n in (500, 2000, 8000):
        s = [Counted(x) for x in words_of_kind(kind, n)]
        Counted.tests = 0
        following, _ = runs.smaller_suffixes(s)
        assert Counted.tests <= 6 * n
        following = np.array(following)
        starts = np.array([i for i in range(1, n) if following[i] < n and int(s[i - 1]) == int(s[following[i] - 1])], np.int64)
        Counted.tests = 0
        runs.common_before(s, starts, following)
        assert Counted.tests <= 3 * n


def expected(doc_id, text):
    w = [x for x in (text or "").encode().split()]
    n, h = len(w), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if n and h is not None and h % 10 == 0:
        g = h // 10
        a, p = g % n, 0
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute(w, 12)
    gone = {x for a, m, q in found for x in range(a + q, a + m)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    return (
        doc_id, len(found), *best, best[0] is not None and 1000 * best[1] // best[2] or None,
        hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in found).encode()).hexdigest(),
        hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest(),
    )


def test_report_equals_brute_force(spark):
    rng = random.Random(5)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a " * 40), (5, "x y " * 20), (5, "x y " * 20), (None, "b c " * 9), (6, "one\vtwo\fthree\r" * 7), (7, "Ä ä " * 8 + "end")]
    for i in range(100, 220):
        words = [f"w{rng.randint(0, 6)}" for _ in range(rng.randint(1, 90))]
        rows.append((i, " ".join(words * rng.randint(1, 3))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_runs", F.lit("mine"))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    got = runs.periodic_runs(docs, rewrite=runs.repeated_tail, seed=h).collect()
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted((expected(*r) for r in rows), key=key)
    assert any(r.n_runs > 1 for r in got)
    assert runs.periodic_runs(docs.limit(0)).collect() == []


def test_collapsed_keeps_other_columns_and_clean_texts(spark):
    docs = spark.createDataFrame([(1, "keep  this", "x"), (2, "a b c " * 6 + "d", "y"), (3, None, "z")], "doc_id long, text string, n_runs string")
    assert sorted(map(tuple, runs.collapsed(docs).collect())) == [(1, "keep  this", "x"), (2, "a b c d", "y"), (3, None, "z")]


def test_a_long_text(spark):
    text = "to and fro " * 300_000
    row = runs.periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row.n_runs, row.start, row.length, row.period) == (1, 0, 900_000, 3)
