"""The corpus pipeline: toxic documents go, one document of each group of near copies stays, documents with benchmark
passages go, secrets are masked, and the texts are encoded.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents, and no others: columns of documents that clash with those
that an operator makes keep their values.

A null text counts as empty and passes every stage; so does an empty one. Of rows with equal texts and different doc_id
the least doc_id stays; rows of one doc_id stay or go together, and rows without doc_id are never dropped as copies or
leaks, since a stage names what it drops by doc_id. Long texts are judged whole in every stage. Empty tables give an
empty result.
"""

from __future__ import annotations

import uuid

from folio.llm import decontamination, near_dedup, pieces, secret_scan, toxicity
from folio.llm.common import shared_dir, table
from folio.llm.queries import tokenizer_path


def drop_toxic(spark, docs, sf_dir):
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark, docs, sf_dir):
    return near_dedup.without_copies(docs, shingle_words=5)


def drop_benchmark_leaks(spark, docs, sf_dir):
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark, docs, sf_dir):
    return secret_scan.redacted(docs)


def encode_pieces(spark, docs, sf_dir):
    return pieces.encoded(docs, tokenizer_path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("secret_scan", mask_secrets),
    ("sentencepiece", encode_pieces),
]

#: SQL can't express the stages; tests/llm/test_pipeline.py holds them against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    path = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{path}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{path}/{name}")
    return docs
