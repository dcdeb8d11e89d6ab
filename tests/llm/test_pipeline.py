import re
from collections import Counter

import corpus_pipeline as cp
from folio.llm import toxicity
from folio.llm.queries import tokenizer_path
from tests.llm.test_decontamination import brute, words
from tests.llm.test_near_dedup import brute as groups
from tests.llm.test_secret_scan import base

SF = "/root/testdata/sf0.001"


def leaks(docs, items):
    """brute() for the pairs of which an alignment matches enough words to count."""
    out = set()
    for item_id, item in items:
        at = {}
        for k, w in enumerate(words(item)):
            at.setdefault(w, []).append(k)
        for doc_id, text in docs:
            shifts = Counter(i - k for i, w in enumerate(words(text)) for k in at.get(w, ()))
            if max(shifts.values(), default=0) >= 6 and len(words(text)) < 3000:
                out |= set(brute([(doc_id, text)], [(item_id, item)]))
    return out


def test_stages_against_brute_force(spark):
    """Each stage on its own input, then the whole."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    benchmark = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    for name, stage in cp.STAGES:
        frame = spark.createDataFrame(list(rows.values()), docs.schema)
        out = stage(spark, frame, SF)
        got = {r.doc_id: r for r in out.collect()}
        texts = [(i, r.text) for i, r in rows.items()]
        if name != "sentencepiece":
            assert out.schema == docs.schema
        if name == "toxicity":
            marked = {r.doc_id for r in toxicity.severities(frame, labels).collect() if r.toxic}
            assert set(got) == set(rows) - marked
        elif name == "near_dedup":
            assert set(got) == {i for i, (_, c) in groups(texts, 5).items() if i == c}
        elif name == "decontamination":
            assert set(got) == set(rows) - {d for d, _ in leaks(texts, benchmark)}
        elif name == "secret_scan":
            assert set(got) == set(rows)
            for i, r in rows.items():
                found = base(r.text)
                for a, _, _, b in found:
                    assert r.text[a:b] not in got[i].text
                if got[i].text == r.text:
                    assert not found
                assert got[i].n_chars == len(got[i].text)
        else:
            import sentencepiece

            library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
            assert all(r.piece_ids == library.encode(r.text) and r.round_trip for r in got.values()) and set(got) == set(rows)
        rows = got
    whole = {r.doc_id: r.piece_ids for r in cp.run(spark, SF).collect()}
    assert whole == {i: r.piece_ids for i, r in rows.items()}
    assert not re.search("error", " ".join(n for n, _ in cp.STAGES))


def test_empty_documents(spark, tmp_path):
    for t in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert cp.run(spark, str(tmp_path)).collect() == []


def test_edge_rows(spark, tmp_path):
    """Null, empty, long and repeated texts, null ids, and columns named as those of the operators."""
    import os

    from pyspark.sql import functions as F

    for t in ("benchmark", "labels"):
        os.symlink(f"{SF}/{t}.parquet", tmp_path / f"{t}.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = docs.orderBy("doc_id").first().text
    edge = [(900001, None), (900002, ""), (900003, "w " * 20 + " ".join(f"v{k}" for k in range(150_000))), (900004, "one copy of these few plain words"), (900005, "one copy of these few plain words"), (None, "one copy of these few plain words"), (900006, "twice the same row here"), (900006, "twice the same row here")]
    rest = [f for f in docs.schema.fields if f.name not in ("doc_id", "text")]
    rows = spark.createDataFrame(edge, "doc_id long, text string").select("doc_id", "text", *[F.lit(None).cast(f.dataType).alias(f.name) for f in rest])
    clash = {"shingles": 1, "scan_text": "a", "spans": 2, "hits": "b", "key": 3, "component": 4, "item": 5, "toxic": "c", "h": 6}
    docs.select("doc_id", "text", *[f.name for f in rest]).limit(100).unionAll(rows).withColumns({k: F.lit(v) for k, v in clash.items()}).write.parquet(str(tmp_path / "documents.parquet"))
    out = cp.run(spark, str(tmp_path))
    got = [r.doc_id for r in out.collect()]
    assert text and {900001, 900002, 900003, 900004, None} <= set(got) and 900005 not in got and got.count(900006) == 2
    assert set(clash) <= set(out.columns) and {(r.shingles, r.toxic, r.h) for r in out.collect()} == {(1, "c", 6)}
