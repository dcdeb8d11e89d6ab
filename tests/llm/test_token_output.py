import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folio.llm import token_output as t
from folio.llm.queries import tokenizer_path

TEXTS = [
    (7, "The quick  brown fox's 12 dogs.\n\tÉté naïve <|endoftext|> é ΑΣ σ"),
    (3, None),
    (11, ""),
    (5, "   "),
    (9, "a b\u0085c\x1cd e don't stop!!! it's"),
    (2, "word " * 3000),
    (4, "The quick  brown fox's 12 dogs."),
    (None, "a text without id"),
]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1)))
def test_lengths_round_trip(values):
    control, data = t.encode_lengths(np.array(values, np.uint32))
    assert t.decode_lengths(control, data, len(values)).tolist() == values


def expected(rows):
    from tokenizers import Tokenizer

    tok, at, out = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json")), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_against_the_library(spark, monkeypatch):
    monkeypatch.setattr(t, "BLOCK_IDS", 40)
    docs = spark.createDataFrame([(*r, 1) for r in TEXTS], "doc_id long, text string, n_tokens int").repartition(3)
    got = sorted((tuple(r) for r in t.token_digest(docs, tokenizer_path("word_bpe_49k.json")).collect()), key=lambda r: r[1])
    assert got == expected(TEXTS)


def test_real_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = sorted(tuple(r) for r in t.token_digest(docs, tokenizer_path("word_bpe_49k.json")).collect())
    assert got == expected([(r.doc_id, r.text) for r in docs.collect()])


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_words_give_the_ids_of_the_text(text):
    import pyarrow as pa

    encoder = t.word_encoder(tokenizer_path("word_bpe_49k.json"))
    ids, _ = encoder.texts(pa.array([text]))
    assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert t.token_digest(docs, tokenizer_path("word_bpe_49k.json")).collect() == []


if __name__ == "__main__":
    pytest.main([__file__])
