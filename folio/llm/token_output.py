"""Token ids in a compact binary form: ids ranked by frequency, each rank in one to four bytes, their lengths in
separate control bytes (four lengths of two bits a byte), decoded by table lookup.

Texts that are null count as empty; an empty text has its end id only. Rows with the same doc_id stay apart, in the
order of their ids' bytes; rows without doc_id come first, and stay apart too. An empty table gives an empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

import functools
import os
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folio.llm.common import shared_dir, text_of, written

#: Distinct words whose ids a Python worker remembers.
WORDS_KEPT = 300_000
#: Bytes of text handled at once in a task, and ids in a block of the file (a document is never divided).
SLICE_BYTES, BLOCK_IDS = 8 << 20, 1 << 16
#: Values a control byte describes, and the lengths that each control byte stands for.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


def encode_lengths(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit values."""
    values = values.astype("<u4")
    size = 1 + (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    padded = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    padded[: len(values)] = size - 1
    quads = padded.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    wanted = np.arange(4) < size[:, None]
    return control.tobytes(), values.view(np.uint8).reshape(-1, 4)[wanted].tobytes()


def decode_lengths(control: bytes, data: bytes, n: int) -> np.ndarray:
    size = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n].astype(np.int64)
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)])
    at = np.cumsum(size) - size
    out = raw[at].astype(np.uint32)
    for k in (1, 2, 3):
        longer = np.flatnonzero(size > k)
        out[longer] |= raw[at[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Parts of the batch with about SLICE_BYTES of text each, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
        yield batch.slice(at, to - at)
        at = to


def gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of all elements of the runs that begin at starts."""
    if not len(starts):
        return np.zeros(0, np.int64)
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def laid(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes


class WordEncoder:
    """Ids of words by the tokenizers library. The tokenizer drops white space, never joins across it, ignores case and
    takes letters and punctuation apart, so a text's ids are those of its words' stems and tails; each distinct one is
    passed to the library once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends[[i for w, i in self.tokenizer.get_vocab().items() if w.endswith("</w>")]] = True
        self.known: dict[str, int] = {}
        self.size, self.store = np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def library(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for each word. Words of letters only go in one text, in which an id with the mark of a word's end closes each."""
        out, size = [], np.zeros(len(words), np.int64)
        for at in range(0, len(words), 4096):
            some = words[at : at + 4096]
            ids = None
            if all(map(str.isalpha, some)):
                ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, np.uint32)
                closed = np.flatnonzero(self.ends[ids])
                if len(closed) == len(some):
                    size[at : at + len(some)] = np.diff(closed, prepend=-1)
                else:
                    ids = None
            if ids is None:
                found = [self.tokenizer.encode(w, add_special_tokens=False).ids for w in some]
                size[at : at + len(some)] = list(map(len, found))
                ids = np.array([i for x in found for i in x], np.uint32)
            out.append(ids)
        return (np.concatenate(out) if out else np.zeros(0, np.uint32)), size

    def words(self, distinct: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for each of some distinct words; remembers WORDS_KEPT words."""
        at = np.fromiter((self.known.get(w, -1) for w in distinct), np.int64, len(distinct))
        new = np.flatnonzero(at < 0)
        new = new[np.argsort([not distinct[k].isalpha() for k in new], kind="stable")]
        ids, size = self.library([distinct[k] for k in new])
        if room := max(0, WORDS_KEPT - len(self.known)):
            self.known.update((distinct[k], n) for n, k in enumerate(new[:room], len(self.known)))
            self.store, self.size = np.concatenate([self.store, ids[: int(size[:room].sum())]]), np.concatenate([self.size, size[:room]])
        at[new] = len(self.size) + np.arange(len(new))
        sizes = np.concatenate([self.size, size])
        starts = np.concatenate([laid(self.size), len(self.store) + laid(size)])[at]
        return np.concatenate([self.store, ids])[gather(starts, sizes[at])], sizes[at]

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many each text has."""
        if not pc.any(pc.match_substring(texts, "<|")).as_py():  # special tokens are told by their case
            texts = pc.ascii_lower(texts)
        words = pc.ascii_split_whitespace(texts)
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary
        stem = pc.ascii_rtrim(distinct, ".,!?;:")
        stem = pc.if_else(pc.match_substring_regex(stem, "[A-Za-z0-9]$"), stem, distinct)
        cut = pc.binary_length(stem).to_numpy(zero_copy_only=False)
        tail = self.tails(distinct, cut)
        pair = [x.dictionary_encode() for x in (stem, tail)]
        at, size, store, base = [], [], [], 0
        for x in pair:
            ids, n = self.words(x.dictionary.to_pylist())
            k = x.indices.to_numpy()
            at.append(base + laid(n)[k])
            size.append(n[k])
            store.append(ids)
            base += len(ids)
        both = gather(np.stack(at, 1).ravel(), np.stack(size, 1).ravel())
        of_word, n = np.concatenate(store)[both], size[0] + size[1]
        index = coded.indices.to_numpy()
        counts = n[index]
        ids = of_word[gather(laid(n)[index], counts)]
        offsets = words.offsets.to_numpy().astype(np.int64)
        return ids, np.diff(np.concatenate([[0], np.cumsum(counts)])[offsets - offsets[0]])

    @staticmethod
    def tails(words: pa.Array, cut: np.ndarray) -> pa.Array:
        """What follows the first cut bytes of each word."""
        offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
        data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
        sizes = np.diff(offsets) - cut
        kept = data[gather(offsets[:-1] + cut, sizes)]
        return pa.StringArray.from_buffers(len(words), pa.py_buffer(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32).tobytes()), pa.py_buffer(kept.tobytes()))


@functools.cache
def word_encoder(path: str) -> WordEncoder:
    """One for a Python worker, kept from task to task."""
    return WordEncoder(path)


def runs(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """values cut into runs, as binaries."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]) * values.itemsize
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(values.tobytes())]).cast(pa.binary())


def joined(column: pa.Array) -> np.ndarray:
    """The bytes of all binaries of a column, one after the other."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)
    return np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[column.offset] : offsets[column.offset + len(column)]]


def tokenized(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """doc_id, n_tokens, ids, width: the ids and then end_id of each document, as little-endian integers of width bytes."""

    def run(batches):
        encoder = word_encoder(tokenizer_path)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, counts = encoder.texts(part.column("text"))
                out = np.full(len(ids) + len(counts), end_id, f"<u{encoder.width}")
                out[gather(laid(counts + 1), counts)] = ids
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(counts + 1, pa.int64()), runs(out, counts + 1), pa.array(np.full(len(counts), encoder.width, np.int32))], ["doc_id", "n_tokens", "ids", "width"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids binary, width int")


@dataclass(frozen=True)
class TokenFiles:
    """The two tables of the file format. blocks: shard, block, doc_ids, sizes (ids of each document), control, data;
    before (ids of the shard before the block); shards hold ascending ranges of doc_id, blocks follow one another in a shard. ranks: rank, id, frequency."""

    blocks: str
    ranks: str


def write_tokens(docs: DataFrame, tokenizer_path: str, path: str, *, end_id: int = 1) -> TokenFiles:
    """Tokenizes docs and writes their ids in ascending doc_id order. The rank table is as long as the vocabulary at most."""
    spark = docs.sparkSession
    tokens = written(tokenized(docs, tokenizer_path, end_id), "tokens")

    def count(batches):
        seen = np.zeros(0, np.int64)
        for batch in batches:
            if batch.num_rows:
                got = np.bincount(joined(batch.column("ids")).view(f"<u{batch.column('width')[0].as_py()}"), minlength=len(seen))
                got[: len(seen)] += seen
                seen = got
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["id", "frequency"])

    files = TokenFiles(f"{path}/blocks", f"{path}/ranks")
    frequency = tokens.select("ids", "width").mapInArrow(count, "id long, frequency long").groupBy("id").agg(F.sum("frequency").alias("frequency"))
    ranked = sorted(((-r.frequency, r.id) for r in frequency.collect()))  # no more rows than the vocabulary has
    spark.createDataFrame([(k, i, -n) for k, (n, i) in enumerate(ranked)], "rank long, id long, frequency long").coalesce(1).write.parquet(files.ranks)
    rank = np.zeros(max((i for _, i in ranked), default=0) + 1, np.uint32)
    rank[[i for _, i in ranked]] = np.arange(len(ranked), dtype=np.uint32)
    rank_of = spark.sparkContext.broadcast(rank)  # as long as the vocabulary

    def blocks(batches):
        from pyspark import TaskContext

        shard, number, before = TaskContext.get().partitionId(), 0, 0
        names = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("before", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("control", pa.binary()), ("data", pa.binary())])
        for batch in batches:
            if not batch.num_rows:
                continue
            values = rank_of.value[joined(batch.column("ids")).view(f"<u{batch.column('width')[0].as_py()}")]
            ids, sizes = batch.column("doc_id"), batch.column("n_tokens").to_numpy()
            ends = np.cumsum(sizes)
            cuts = [0, *(np.flatnonzero(np.diff(ends // BLOCK_IDS)) + 1), len(ids)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                control, data = encode_lengths(values[ends[a] - sizes[a] : ends[b - 1]])
                yield pa.RecordBatch.from_pydict({"shard": [shard], "block": [number], "before": [before], "doc_ids": pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), ids.slice(a, b - a)), "sizes": [sizes[a:b]], "control": [control], "data": [data]}, names)
                number, before = number + 1, before + int(sizes[a:b].sum())

    ordered = tokens.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids")
    ordered.mapInArrow(blocks, "shard int, block long, before long, doc_ids array<long>, sizes array<long>, control binary, data binary").write.option("compression", "none").parquet(files.blocks)
    return files


def decoded(spark, files: TokenFiles, emit, schema: str) -> DataFrame:
    """What emit(doc_ids, starts, sizes, ids) makes of each block; ids are little-endian unsigned 32-bit integers."""
    ids_of = spark.sparkContext.broadcast(np.array([r.id for r in spark.read.parquet(files.ranks).orderBy("rank").collect()], "<u4"))  # the vocabulary
    blocks = spark.read.parquet(files.blocks)
    length = F.col("before") + F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)
    before, total = {}, 0
    for r in sorted(blocks.groupBy("shard").agg(F.max(length).alias("n")).collect()):  # a row for each shard
        before[r.shard], total = total, total + r.n

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                shard, within, doc_ids, n, control, data = (batch.column(c)[k] for c in ("shard", "before", "doc_ids", "sizes", "control", "data"))
                n = n.values.to_numpy()
                ids = ids_of.value[decode_lengths(control.as_py(), data.as_py(), int(n.sum()))]
                yield emit(doc_ids.values, laid(n) + before[shard.as_py()] + within.as_py(), n, ids)

    return blocks.select("shard", "before", "doc_ids", "sizes", "control", "data").mapInArrow(run, schema)


def read_tokens(spark, files: TokenFiles) -> DataFrame:
    """doc_id, start, n_tokens, ids (binary, little-endian unsigned 32-bit), from the files."""
    return decoded(spark, files, lambda doc_ids, starts, n, ids: pa.RecordBatch.from_arrays([doc_ids, pa.array(starts), pa.array(n), runs(ids, n)], ["doc_id", "start", "n_tokens", "ids"]), "doc_id long, start long, n_tokens long, ids binary")


def token_digest(docs: DataFrame, tokenizer_path: str, *, end_id: int = 1) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files that write_tokens makes."""
    spark = docs.sparkSession
    files = write_tokens(docs, tokenizer_path, f"{shared_dir(spark)}/token-files-{uuid.uuid4().hex}", end_id=end_id)

    def digest(doc_ids, starts, n, ids):
        raw = memoryview(ids.tobytes())
        ends = np.cumsum(n) * 4
        found = [zlib.crc32(raw[a:b]) for a, b in zip(ends - n * 4, ends, strict=True)]
        return pa.RecordBatch.from_arrays([doc_ids, pa.array(starts), pa.array(n), pa.array(found, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return decoded(spark, files, digest, "doc_id long, start long, n_tokens long, ids_crc32 long")
