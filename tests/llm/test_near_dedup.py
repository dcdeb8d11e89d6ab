import random
import re

import pytest

from folio.llm import near_dedup as nd


def sets(text, k):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", lowered) if x]
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute(rows, k):
    s = {i: sets(t, k) for i, t in rows}
    at = {i: i for i in s}

    def find(x):
        while at[x] != x:
            x = at[x]
        return x

    ids = sorted(s)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if s[i] and s[j] and 100 * len(s[i] & s[j]) >= 80 * len(s[i] | s[j]):
                a, b = sorted((find(i), find(j)))
                at[b] = a
    return {i: (len(s[i]), find(i)) for i in ids}


def check(spark, rows, k):
    docs = spark.createDataFrame([(*r, "z", 1) for r in rows], "doc_id long, text string, key string, rep int").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nd.near_duplicates(docs, shingle_words=k).collect()}
    assert got == brute(rows, k)


@pytest.mark.parametrize("k", [2, 5])
def test_copies(spark, monkeypatch, k):
    monkeypatch.setattr(nd, "BLOCK_SHINGLES", 700)  # several blocks
    rng = random.Random(k)
    vocab = [f"W{i}" for i in range(300)]
    rows = [(5000, None), (5001, ""), (5002, " \n"), (5003, "one"), (5004, "ONE"), (5005, "a b"), (5006, "a\tB "), (5007, "é É")]
    for g in range(12):
        base = rng.choices(vocab, k=rng.randint(30, 90))
        for c in range(rng.randint(1, 14)):
            words = list(base)
            for _ in range(rng.randint(0, 9)):
                words[rng.randrange(len(words))] = rng.choice(vocab)
            rows.append((g * 100 + c, " ".join(words)))
    check(spark, rows, k)


def test_spread_group(spark, monkeypatch):
    """One large group whose members lie on both sides of the threshold."""
    monkeypatch.setattr(nd, "BLOCK_SHINGLES", 4000)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for c in range(150):
        words = list(base)
        for at in rng.sample(range(150), rng.randint(2, 26)):
            words[at] = f"x{rng.randrange(10**6)}"
        rows.append((c, " ".join(words)))
    check(spark, rows, 2)


def test_real_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(spark, [(r.doc_id, r.text) for r in docs.collect()], 2)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert nd.near_duplicates(docs).collect() == [] and nd.without_copies(docs).collect() == []


def test_blocks_of_very_short_texts(spark, monkeypatch):
    """Texts of three shingles, two of them common to all: a block is bounded by its rows too."""
    monkeypatch.setattr(nd, "BLOCK_ROWS", 40, raising=False)
    rows = spark.createDataFrame([(1, i, i, 3) for i in range(1000)] + [(2, i, i, 3) for i in range(30)], "bucket long, rep long, component long, n_shingles long")
    sizes = nd.blocks_of(rows).groupBy("bucket", "first", "second").count().collect()
    assert max(r["count"] for r in sizes) <= 4 * 40 and [r["count"] for r in sizes if r.bucket == 2] == [30]
    assert {r.rep for r in nd.blocks_of(rows).filter("bucket = 1 and first = second").collect()} == set(range(1000))
    texts = [(i, f"see page number {i} of this book") for i in range(250)] + [(1000 + i, f"see page number {i} of this book again and again for more of it") for i in range(0, 250, 5)]
    texts += [(2000 + i, f"SEE page number {i} of this book") for i in range(0, 250, 7)]
    check(spark, texts, 5)
    check(spark, texts, 2)


def test_large_component_beside_few_rows(spark, monkeypatch):
    """Each pair of rows of different components meets in some pair of blocks; rows of the large component are dealt out once for each block of the others."""
    monkeypatch.setattr(nd, "BLOCK_ROWS", 40)
    rows = spark.createDataFrame([(1, i, 0 if i >= 60 else i, 3) for i in range(1000)], "bucket long, rep long, component long, n_shingles long")
    places = {}
    for r in nd.blocks_of(rows).select("rep", "first", "second").collect():
        places.setdefault(r.rep, set()).add((r.first, r.second))
    assert all(places[i] & places[j] for i in range(1, 60) for j in range(1000) if i != j)
    assert {len(places[i]) for i in range(60, 1000)} == {2}


def test_repeated_and_null_ids(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(1, base), (1, base), (2, base + " tail"), (None, base), (None, "only here"), (3, "x y z"), (3, "p q r"), (4, "p q r s t")]
    got = nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle_words=2).collect()
    assert len(got) == len(rows) and {(r.doc_id, r.component_id, r.kept) for r in got if r.doc_id in (1, 2)} == {(1, 1, True), (2, 1, False)}
    assert {(r.component_id, r.kept) for r in got if r.doc_id is None} == {(1, None), (None, None)}
    assert len(nd.without_copies(spark.createDataFrame(rows, "doc_id long, text string"), shingle_words=2).collect()) == len(rows) - 1


def test_long_texts(spark):
    rng = random.Random(2)
    words = rng.choices([f"w{i}" for i in range(5000)], k=300_000)
    check(spark, [(1, " ".join(words)), (2, " ".join(words[:290_000])), (3, " ".join(words[:200_000]))], 2)


@pytest.mark.parametrize("order", ["up", "down", "shuffled", "star", "pairs"])
def test_components_of_long_chains_take_few_rounds(spark, monkeypatch, order):
    n, tables = 800, []
    ids = list(range(n))
    if order == "down":
        ids.reverse()
    if order == "shuffled":
        random.Random(1).shuffle(ids)
    links = [(ids[0], x) for x in ids[1:]] if order == "star" else list(zip(ids, ids[1:]))[:: 2 if order == "pairs" else 1]
    links += [(1000, 1001), (1002, 1001), (1002, 1002)]
    monkeypatch.setattr(nd, "written", lambda df, name, f=nd.written: (tables.append(name), f(df, name))[1])
    got = {r.node: r.component for r in nd.components(spark.createDataFrame(links, "rep long, leader long")).collect()}
    pairs = {x: min(p) for p in zip(ids[::2], ids[1::2]) for x in p}
    assert got == ({x: pairs[x] for x in ids} if order == "pairs" else dict.fromkeys(ids, 0)) | dict.fromkeys((1000, 1001, 1002), 1000)
    assert tables.count("moved") < 20
