import math
import random
import unicodedata
import zlib

import numpy as np
from pyspark.sql import functions as F

from folio.llm import language as L


def plain_letters(text):
    out = " "
    for c in text.lower():
        c = c if unicodedata.category(c)[0] in "LM" else " "
        if c != " " or out[-1] != " ":
            out += c
    return out if out[-1] == " " else out + " "


def plain_bundle(text):
    """The text's vector, an n-gram and a dimension at a time."""
    s, d = plain_letters(text or ""), L.DIMENSIONS
    total = [0] * d
    if any(unicodedata.category(c)[0] == "L" for c in s):
        for i in range(len(s) - 2):
            a, b, c = (L.signs(ord(x)).tolist() for x in s[i : i + 3])
            for k in range(d):
                total[k] += a[(k - 2) % d] * b[(k - 1) % d] * c[k]
    return total


def cosine(x, y):
    return sum(a * b for a, b in zip(x, y, strict=True)) / math.sqrt(sum(a * a for a in x) * sum(b * b for b in y) or 1)


def plain(rows):
    train = [(t, g) for i, t, g in rows if i is not None and zlib.crc32(str(i).encode()) % 4 != 2 and t is not None and g is not None]
    sums = {}
    for t, g in train:
        sums[g] = [a + b for a, b in zip(sums.get(g, [0] * L.DIMENSIONS), plain_bundle(t), strict=True)]
    protos = {g: v for g, v in sorted(sums.items()) if any(v)}
    out = []
    for i, t, _ in rows:
        v = plain_bundle(t)
        best = max(protos, key=lambda g: cosine(v, protos[g])) if any(v) and protos else None
        out.append((i, None if i is None else zlib.crc32(str(i).encode()) % 4 == 2, best or "und", round(max(0, cosine(v, protos[best])), 5) if best else 0.0))
    return out


WORDS = {"en": "the and of that with this from which".split(), "de": "und der die das nicht über größe mit".split(), "fr": "le la les été déjà avec où que".split(), "hi": "यह और में है कि नहीं".split()}


def rows_():
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(WORDS[g]) for _ in range(rng.randint(3, 12))), g) for i in range(24) for g in (rng.choice(list(WORDS)),)]
    rows += [(30, None, "en"), (31, "", "de"), (32, "12 -- 3!", "fr"), (33, "The AND of", None), (None, "und der die", "de"), (35, "́̂", "en"), (3, "le la les", "fr"), (3, "le la les", "fr"), (36, "İ\U0001f600x ÉTÉ", "fr")]
    return rows


def key(r):
    return tuple((x is not None, x) for x in r)


def test_predictions_equal_plain_vectors(spark):
    rows = rows_()
    got = L.identified(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3))
    assert got.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    got = [(r.doc_id, r.held_out, r.lang_pred, round(r.score, 5)) for r in got.collect()]
    assert sorted(got, key=key) == sorted(plain(rows), key=key)


def test_chunks_and_slices_change_nothing(spark, monkeypatch):
    rows = rows_()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    whole = sorted(map(tuple, L.identified(docs).collect()), key=key)
    numbers, rotated = np.arange(8), L.tables(np.array([97, 98], np.uint32))
    once = L.bundle(numbers, numbers + 1, rotated)
    monkeypatch.setattr(L, "CHUNK", 3)
    monkeypatch.setattr(L, "SLICE_BYTES", 40)
    assert (L.bundle(numbers, numbers + 1, rotated) == once).all()
    assert [t[:3] for t in sorted(map(tuple, L.identified(docs).collect()), key=key)] == [t[:3] for t in whole]


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some text", None), (2, "more", None)], "doc_id long, text string, lang string")
    assert {(r.lang_pred, r.score) for r in L.identified(docs).collect()} == {("und", 0.0)}
    assert L.identified(docs.limit(0)).collect() == []


def test_other_columns_and_long_texts(spark):
    docs = spark.createDataFrame([(k, WORDS[g], g) for k, g in enumerate(WORDS)], "doc_id long, w array<string>, lang string")
    docs = docs.select("doc_id", F.array_join("w", " ").alias("text"), "lang", F.lit(1).alias("score"), F.lit("x").alias("held_out"))
    long = docs.withColumn("text", F.repeat(F.lit("und der die nicht über "), 60_000)).limit(1)
    prototypes = L.learned(spark.createDataFrame([(" ".join(w), g) for g, w in WORDS.items()], "text string, lang string"))
    assert L.languages(long, prototypes).first().lang_pred == "de"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = L.identified(docs).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    n, right = found.agg(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert n > 200
    assert right >= 0.98 * n
