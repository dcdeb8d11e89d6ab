import hashlib
import random
from collections import Counter

import pytest

from folio.llm import repeats as r


def brute(rows):
    """By a count of all strings of LENGTH bytes."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[k : k + r.LENGTH] for _, t in texts for k in range(len(t) - r.LENGTH + 1))
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for k in range(len(t) - r.LENGTH + 1):
            if seen[t[k : k + r.LENGTH]] > 1:
                gone[k : k + r.LENGTH] = b"\1" * r.LENGTH
        spans = sum(gone[k] and not (k and gone[k - 1]) for k in range(len(t)))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows):
    docs = spark.createDataFrame([(*x, "z", 1) for x in rows], "doc_id long, text string, uid string, a int").repartition(3)
    got = sorted(((x.doc_id, x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in r.without_repeats(docs).collect()), key=str)
    assert got == brute(rows)


def made(seed):
    rng = random.Random(seed)
    vocab = ["ab", "cde", "é", "fghij", "k", "日本", "lm"]
    text = lambda n: " ".join(rng.choices(vocab, k=n)) if n else ""
    passages = [text(rng.randint(20, 160)) for _ in range(5)]
    rows = [(900, None), (901, ""), (902, "x" * 199), (903, "x" * 200), (904, "y" * 201), (905, "the same line\n" * 60), (906, passages[0]), (907, passages[0]), (907, passages[0]), (906, passages[1])]
    for k in range(60):
        parts = []
        for _ in range(rng.randint(1, 4)):
            parts.append(text(rng.randint(0, 90)))
            p = rng.choice(passages)
            a = rng.randrange(len(p) // 2)
            parts.append(p[a : rng.randint(a + 1, len(p))])
        rows.append((k, "".join(parts)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    check(spark, made(seed))


def test_long_texts_are_cut(spark, monkeypatch):
    monkeypatch.setattr(r, "SLICE", 300)
    check(spark, [*made(3), (None, made(3)[20][1]), (None, made(3)[21][1]), (None, "ab " * 90)])


def test_real_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(spark, [(x.doc_id, x.text) for x in docs.collect()])


def test_empty(spark):
    assert r.without_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []
