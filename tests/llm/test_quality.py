import itertools
import zlib

import numpy as np

from folio.llm import quality as q


def test_marginals_against_all_paths():
    rng = np.random.default_rng(2)
    sizes = [1, 4, 2, 7]
    first = np.concatenate([[0], np.cumsum(sizes)])
    score, move = rng.normal(size=first[-1]), rng.normal(size=(2, 2))
    good, pairs, total = q.marginals(score, move, first)
    all_pairs = np.zeros((2, 2))
    for k, n in enumerate(sizes):
        s = score[first[k] : first[k + 1]]
        weight, hits, z = {}, np.zeros(n), 0
        for path in itertools.product((0, 1), repeat=n):
            w = np.exp(sum(s[i] for i in range(n) if path[i]) + sum(move[a, b] for a, b in zip(path, path[1:])))
            z += w
            hits += w * np.array(path)
            weight[path] = w
        for path, w in weight.items():
            for a, b in zip(path, path[1:]):
                all_pairs[a, b] += w / z
        assert np.allclose(good[first[k] : first[k + 1]], hits / z) and np.isclose(total[k], np.log(z))
    assert np.allclose(pairs, all_pairs)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = {r.doc_id: r for r in q.scores(docs, labels).collect()}
    assert len(got) == 1000
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for i, r in got.items())
    held = [(r.quality, got[r.doc_id].predicted) for r in labels.collect() if got[r.doc_id].held_out]
    right = sum(a == b for a, b in held)
    kept = sum(b for a, b in held if a) / sum(a for a, _ in held)
    print("held out", right, len(held), kept)
    assert right >= 0.95 * len(held) and kept >= 0.97


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 2), (3, "\n\n", 3), (None, "a", 4), (3, "a line\n" * 500, 5)], "doc_id long, text string, held_out int")
    labels = spark.createDataFrame([(1, 1), (3, 1)], "doc_id long, quality int")
    assert {r.score for r in q.scores(docs, labels).collect()} == {0.5}
    both = spark.createDataFrame([(1, 1), (3, 0), (7, 0), (1, None)], "doc_id long, quality int")
    assert all(0 <= r.score <= 1 for r in q.scores(docs, both).collect())
    assert q.scores(docs.limit(0), labels.limit(0)).collect() == []


def test_long_and_repeated_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    lines = "\n".join(r.text for r in docs.orderBy("doc_id").limit(400).collect())
    odd = [(5001, lines * 6), (5002, lines.replace("\n", " ") * 6), (5003, "plain words here"), (5003, "plain words here"), (None, "plain words here")]
    assert min(len(t) for _, t in odd[:2]) > 5_000_000
    got = q.scores(docs.unionAll(spark.createDataFrame(odd, docs.schema)), labels).filter("doc_id > 5000 OR doc_id IS NULL").collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (5003, None)}) == 1
