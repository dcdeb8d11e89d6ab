import hashlib
import random
import re

from pyspark.sql import functions as F

from folio.llm import fingerprints as fp


M64 = (1 << 64) - 1


def rotated(x, by):
    by %= 64
    return (x << by | x >> (64 - by)) & M64


def hashes(spark, values, kind):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return {r.v: r.h & M64 for r in df.select("v", F.xxhash64("v").alias("h")).collect()}


def brute(spark, texts):
    """Fingerprints as lists of (hash, position): the hash rolls on from gram to gram, and all windows are looped over."""
    words = [[w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w] for t in texts]
    of_word = hashes(spark, sorted({w for ws in words for w in ws}), "string")
    rolled = []
    for ws in words:
        h, out = 0, []
        for i in range(max(len(ws), fp.K) if ws else 0):  # a short text is followed by zeros
            h = rotated(h, 1) ^ (of_word[ws[i]] if i < len(ws) else 0) ^ (rotated(of_word[ws[i - fp.K]], fp.K) if i >= fp.K else 0)
            if i >= fp.K - 1:
                out.append(h)
        rolled.append(out)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    mixed = hashes(spark, sorted({signed(h) for hs in rolled for h in hs}), "long")
    out = []
    for hs in rolled:
        hs = [mixed[signed(h)] >> 4 for h in hs]
        kept = set()
        for s in range(max(len(hs) - fp.WINDOW, 0) + 1 if hs else 0):
            i, h = min(enumerate(hs[s : s + fp.WINDOW], s), key=lambda p: (p[1], -p[0]))
            kept.add((h, i))
        out.append(sorted(kept, key=lambda x: x[1]))
    return out


def test_report(spark, monkeypatch):
    monkeypatch.setattr(fp, "BLOCK_ROWS", 3)
    rng = random.Random(1)
    vocab = ["ab", "cd", "ef", "gh", "é𝄞"]
    texts = ["", None, "one", "a b c d e", " ".join(["same"] * 60), *[" ".join(rng.choices(vocab, k=rng.randint(1, 60))) for _ in range(12)], "x\n" * 40]
    ids = [3, 5, 300, 301, 302, *range(1000, 1012), 70000]
    docs = spark.createDataFrame([(i, t, 0, "z") for i, t in zip(ids, texts)], "doc_id long, text string, block int, next string").repartition(3)
    got = {r.doc_id: r for r in fp.fingerprint_report(docs).collect()}
    edited = []
    for k, t in enumerate(texts):
        t, nxt = t or "", texts[(k + 1) % len(texts)] or ""
        half = len(t) // 2
        edited.append(t[: len(t) - half] + nxt[:half])
    own, other = brute(spark, texts), brute(spark, edited)
    show = lambda f: ",".join(f"{h:X}@{i}" for h, i in f)

    def like(a, b):
        a, b = {h for h, _ in a}, {h for h, _ in b}
        return 1.0 if not a | b else len(a & b) / len(a | b)

    assert len(got) == len(texts)
    for k, i in enumerate(ids):
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(texts[k] or ""), hashlib.sha256(edited[k].encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (show(own[k]), show(other[k])), k
        assert abs(r.near_edited - like(own[k], other[k])) < 1e-12
        assert abs(r.near_next - like(own[k], own[(k + 1) % len(texts)])) < 1e-12


def test_single_and_empty(spark):
    one = spark.createDataFrame([(5, "a b c")], "doc_id long, text string")
    (r,) = fp.fingerprint_report(one).collect()
    assert r.near_next == 1.0 and r.edited_sha256 == hashlib.sha256(b"a ba ").hexdigest()
    assert fp.fingerprint_report(one.limit(0)).collect() == []


def test_repeated_and_null_ids(spark, monkeypatch):
    monkeypatch.setattr(fp, "BLOCK_ROWS", 2)
    rows = [(None, "null one a b"), (None, "null two c d"), (None, None), *[(7, f"seven {k} e f g h") for k in range(5)], (7, "seven 0 e f g h"), (8, "eight i j k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = fp.fingerprint_report(docs).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in rows)
    # eight is followed by the first of the null ids, so its second half comes from one of them
    first = [t for i, t in rows if i is None]
    assert [r.edited_sha256 for r in got if r.doc_id == 8][0] in {hashlib.sha256(("eight i j k"[:6] + (t or "")[:5]).encode()).hexdigest() for t in first}


def test_long_text(spark):
    text = " ".join(f"w{k % 5000}" for k in range(300_000))
    (r,) = fp.fingerprint_rows(spark.createDataFrame([(1, text)], "doc_id long, text string")).agg(F.max("position").alias("p"), F.count("*").alias("n")).collect()
    assert r.p >= 300_000 - fp.K - fp.WINDOW and r.n > 300_000 / fp.WINDOW


def test_shared_passage_is_found(spark):
    common = " ".join(f"w{i}" for i in range(fp.K + fp.WINDOW - 1))
    docs = spark.createDataFrame([(1, "some words before " + common + " tail"), (2, "q r " + common + " other end of it all")], "doc_id long, text string")
    rows = fp.fingerprint_rows(docs)
    assert rows.groupBy("hash").agg(F.count_distinct("doc_id").alias("n")).filter("n = 2").count() >= 1
