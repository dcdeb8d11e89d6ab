import itertools
import random

import pyarrow as pa
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from folio.llm import pieces as p
from folio.llm.queries import tokenizer_path

PATH = tokenizer_path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
TEXTS = ["The quick brown fox.\nNext line\n\nx", "", None, " ", "  a  b\n\tc ", "x▁y <s> </s>", "日本 𝄞é é \r\n", "word " * 500, "a" * 3000, "\n", "\n\n a", "end\n"]


def test_against_the_library(spark):
    docs = spark.createDataFrame([(i, t, "z", 5) for i, t in enumerate(TEXTS)], "doc_id long, text string, n_pieces string, key int").repartition(3)
    got = p.encoded(docs, PATH)
    assert got.columns == ["doc_id", "text", "key", "piece_ids", "n_pieces", "round_trip"]
    rows = {r.doc_id: r for r in got.collect()}
    for i, t in enumerate(TEXTS):
        assert rows[i].piece_ids == LIBRARY.encode(t or ""), t
        assert rows[i].n_pieces == len(rows[i].piece_ids) and rows[i].round_trip
    back = {r.doc_id: r.text for r in p.decoded(got, PATH).collect()}
    assert back == {i: (t or "").replace("▁", " ") for i, t in enumerate(TEXTS)}
    assert p.encoded(docs.limit(0), PATH).collect() == []


def test_real_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for r in p.encoded(docs, PATH).collect():
        assert r.piece_ids == LIBRARY.encode(r.text) and r.round_trip


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab \nThe▁é日tion.", max_size=40), min_size=1, max_size=6))
def test_any_texts(texts):
    ids, counts = p.pieces(PATH, "bpe").encode(pa.array(texts, pa.string()))
    assert ids.tolist() == [i for t in texts for i in LIBRARY.encode(t)] and counts.tolist() == [len(LIBRARY.encode(t)) for t in texts]


def test_unigram_paths_against_all_segmentations():
    model = p.Pieces(PATH, "unigram")
    model.score = {w: -s for w, s in (("a", 2.0), ("b", 2.5), ("ab", 3.0), ("ba", 3.2), ("aba", 4.1), ("bb", 4.0))}
    model.id = {w: k for k, w in enumerate(model.score)}
    model.tails = {w[k:] for w in model.score for k in range(len(w))}
    rng = random.Random(4)
    words = sorted({"".join(rng.choices("ab", k=rng.randint(1, 9))) for _ in range(60)})
    ids, size = model.spelled(words)
    names, at = list(model.id), 0
    for w, n in zip(words, size):
        got = [names[i] for i in ids[at : at + n]]
        at += n
        best = max(sum(model.score.get(w[a:b], -99) for a, b in zip((0, *cut), (*cut, len(w)))) for r in range(len(w)) for cut in itertools.combinations(range(1, len(w)), r))
        assert "".join(got) == w and abs(sum(map(model.score.get, got)) - best) < 1e-9


def test_long_and_repeated_texts(spark):
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdeéß日", k=rng.randint(1, 9))) for _ in range(3000)]
    long = " ".join(rng.choice(words) for _ in range(400_000))
    rows = [(1, long), (2, "once more"), (2, "once more"), (None, "once more"), (None, None)]
    got = p.encoded(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), PATH).collect()
    assert sorted((r.doc_id or 0, r.n_pieces) for r in got) == sorted((i or 0, len(LIBRARY.encode(t or ""))) for i, t in rows)
    assert all(r.round_trip and r.piece_ids == LIBRARY.encode(r.text or "") for r in got)


def test_pairs_that_are_known_cost_no_call(monkeypatch):
    rng = random.Random(5)
    words = sorted({"▁" + "".join(rng.choices("theranoisé日", k=rng.randint(1, 12))) for _ in range(500)})
    model, calls, agree = p.Pieces(PATH), [], p.Pieces.agree
    monkeypatch.setattr(p.Pieces, "agree", lambda *args: calls.append(args) or agree(*args))
    ids, size = model.spelled(words)
    first = len(calls)
    again = model.spelled(words)
    assert first and len(calls) == first
    assert again[0].tolist() == ids.tolist() == [i for w in words for i in LIBRARY.encode(w[1:])] and again[1].tolist() == size.tolist()
