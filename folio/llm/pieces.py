"""SentencePiece encoding and decoding by a shared-prefix Viterbi pass.

The distinct marked words of a slice of texts are sorted, so that they form a trie, and traversed depth-first: the forward
states of a common prefix are computed once. A state is the survivor of its prefix: for a unigram model the path of the
highest total score, for a byte-pair model the one path whose neighbouring pieces agree with the model's merges (exactly
one survives at each prefix), so that ids equal the library's. No piece has a mark after another character, so no piece
crosses words; characters that are in no piece are encoded as bytes.

A null or empty text has no ids. A literal mark character decodes to a space, as in the library; every other text decodes
to itself. Repeated rows, and rows of equal or null doc_id, are encoded each for itself. A long text is encoded whole, by
itself; it takes some sixty times its size in a task's memory. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.words import slices

MARK = "▁"
#: Distinct words that a Python worker remembers, and answers about pairs of pieces.
WORDS_KEPT, PAIRS_KEPT = 200_000, 200_000
#: Bytes of text that are encoded at once; the arrays of their ids and decoded bytes take some thirty times that.
SLICE_TEXT = 2 << 20
#: What the fast way leaves to the regular expression: runs of spaces, spaces at the ends of lines, and marks.
ODD = f"  |^ | $|\n | \n|{MARK}"
UNIT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def shared(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low = 0
    while n - low > 1:
        mid = (low + n) // 2
        low, n = (mid, n) if a[:mid] == b[:mid] else (low, mid)
    return low


class Pieces:
    """The vocabulary of a model file, and the encoder."""

    def __init__(self, path: str, kind: str = "bpe"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = model.get_piece_size()
        self.kind, self.byte = kind, {}
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        raw = []
        for i in range(count):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                raw.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i):
                raw.append(b"")
            else:
                self.score[piece], self.id[piece] = model.get_score(i), i
                raw.append(piece.replace(MARK, " ").encode())
        self.unknown = model.unk_id()
        self.worst = min(self.score.values(), default=0.0) - 10
        self.tails = {p[k:] for p in self.score for k in range(len(p))}
        self.number = {t: self.id.get(t, -1) for t in self.tails} if kind == "bpe" else {}
        self.raw, self.raw_size = np.frombuffer(b"".join(raw), np.uint8), np.array([len(r) for r in raw], np.int64)
        self.raw_start = np.cumsum(self.raw_size) - self.raw_size
        self.agreed: dict[int | tuple[str, int], bool] = {}
        self.known: dict[str, int] = {}
        self.size, self.store = np.zeros(0, np.int64), np.zeros(0, np.int32)

    def merged(self, text: str) -> list[str]:
        """The byte-pair merges of a short text, best score first and leftmost among equals."""
        parts = list(text)
        while True:
            best = max(((self.score[a + b], -k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in self.score), default=None)
            if best is None:
                return parts
            k = -best[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    def agree(self, pair: int | tuple[str, int], a: str, b: str) -> bool:
        """Whether pieces a and b stay apart beside each other; pair names the two in what is remembered."""
        if len(self.agreed) > PAIRS_KEPT:
            self.agreed.clear()
        found = self.agreed[pair] = self.merged(a + b) == [a, b]
        return found

    def paired(self, words: list[str]) -> Iterator[tuple[int, list[int], list[int]]]:
        """Each word's number, in sorted order, with where the last piece of each of its prefixes begins and its id (-1: none), by the merges."""
        starts, last = [0], [0]
        before, number, agreed, count = "", self.number, self.agreed, len(self.raw_size)
        for k in sorted(range(len(words)), key=words.__getitem__):
            word = words[k]
            depth = shared(before, word)
            del starts[depth + 1 :], last[depth + 1 :]
            for i in range(depth + 1, len(word) + 1):
                start, piece = i - 1, -1
                for j in range(i - 1, -1, -1):
                    n = number.get(word[j:i])
                    if n is None:
                        break
                    if n >= 0:
                        if j:
                            left = last[j]
                            pair = left * count + n if left >= 0 else (word[starts[j] : j], n)
                            fits = agreed.get(pair)
                            if fits is None:
                                fits = self.agree(pair, word[starts[j] : j], word[j:i])
                        if not j or fits:
                            start, piece = j, n
                            break
                starts.append(start)
                last.append(piece if piece >= 0 else self.id.get(word[i - 1], -1))
            before = word
            yield k, starts, last

    def scored(self, words: list[str]) -> Iterator[tuple[int, list[int], list[int]]]:
        """The same by the highest total score."""
        starts, last, total = [0], [0], [0.0]
        before, score, tails = "", self.score, self.tails
        for k in sorted(range(len(words)), key=words.__getitem__):
            word = words[k]
            depth = shared(before, word)
            del starts[depth + 1 :], last[depth + 1 :], total[depth + 1 :]
            for i in range(depth + 1, len(word) + 1):
                start, best = i - 1, total[i - 1] + self.worst
                for j in range(i - 1, -1, -1):
                    tail = word[j:i]
                    if tail not in tails:
                        break
                    if tail in score and total[j] + score[tail] > best:
                        start, best = j, total[j] + score[tail]
                starts.append(start)
                last.append(self.id.get(word[start:i], -1))
                total.append(best)
            before = word
            yield k, starts, last

    def spelled(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for each of some distinct words."""
        out: list[list[int]] = [[] for _ in words]
        for k, starts, last in self.paired(words) if self.kind == "bpe" else self.scored(words):
            ids, i = out[k], len(words[k])
            while i:
                if last[i] >= 0:
                    ids.append(last[i])
                else:
                    ids += [self.byte.get(b, self.unknown) for b in reversed(words[k][starts[i] : i].encode())] if self.byte else (self.unknown,)
                i = starts[i]
            ids.reverse()
        size = np.fromiter(map(len, out), np.int64, len(out))
        return np.fromiter(itertools.chain.from_iterable(out), np.int32, int(size.sum())), size

    def words(self, distinct: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A store of ids, and where in it and how many are those of each of some distinct words; remembers WORDS_KEPT words."""
        at = np.fromiter((self.known.get(w, -1) for w in distinct), np.int64, len(distinct))
        new = np.flatnonzero(at < 0)
        ids, size = self.spelled([distinct[k] for k in new])
        if room := max(0, WORDS_KEPT - len(self.known)):
            self.known.update((distinct[k], n) for n, k in enumerate(new[:room], len(self.known)))
            self.store, self.size = np.concatenate([self.store, ids[: int(size[:room].sum())]]), np.concatenate([self.size, size[:room]])
        at[new] = len(self.size) + np.arange(len(new))
        sizes = np.concatenate([self.size, size])
        starts = np.concatenate([np.cumsum(self.size) - self.size, len(self.store) + np.cumsum(size) - size])
        return np.concatenate([self.store, ids]), starts[at], sizes[at]

    def units(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The distinct marked words, the index of each word of all texts, and how many each text has. A line break is a word of its own."""
        odd = pc.match_substring_regex(texts, ODD).to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(odd), "", texts)
        lines = pc.split_pattern(plain, "\n")
        words = pc.split_pattern(lines.flatten(), " ")
        coded = words.flatten().dictionary_encode()
        per_text = lines.offsets.to_numpy().astype(np.int64) - lines.offsets[0].as_py()
        per_line = words.offsets.to_numpy().astype(np.int64)
        per_line -= per_line[0]
        bare = np.zeros(len(coded), np.int64)  # the first word after a line break has no mark
        bare[per_line[:-1]] = 1
        bare[per_line[per_text[:-1]]] = 0
        pair, index = np.unique(coded.indices.to_numpy().astype(np.int64) * 2 + bare, return_inverse=True)
        spelled = coded.dictionary.to_pylist()
        distinct = [spelled[p >> 1] if p & 1 else MARK + spelled[p >> 1] for p in pair.tolist()]
        breaks = np.ones(len(per_line) - 1, np.int64)
        breaks[per_text[1:] - 1] = 0  # the last line of a text
        index = np.insert(index, per_line[1:][breaks == 1], len(distinct))
        distinct.append("\n")
        total = np.concatenate([[0], np.cumsum(np.diff(per_line) + breaks)])
        counts = np.diff(total[per_text])
        empty = odd | (pc.equal(texts, "").to_numpy(zero_copy_only=False))
        if empty.any():  # such a text has a single word so far, the mark
            keep = np.repeat(~empty, counts)
            index, counts = index[keep], np.where(empty, 0, counts)
        if odd.any():
            seen = {w: k for k, w in enumerate(distinct)}
            ends = np.cumsum(counts)
            parts, done = [], 0
            for row in np.flatnonzero(odd):
                found = UNIT.findall(MARK + texts[int(row)].as_py().replace(" ", MARK))
                parts += [index[done : ends[row]], np.array([seen.setdefault(w, len(seen)) for w in found], np.int64)]
                done = ends[row]
                counts[row] = len(found)
            index, distinct = np.concatenate([*parts, index[done:]]), list(seen)
        return distinct, index, counts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and how many each has."""
        distinct, index, counts = self.units(texts)
        store, start, size = self.words(distinct)
        n = size[index]
        ids = store[runs(start[index], n)]
        total = np.concatenate([[0], np.cumsum(n)])
        ends = np.cumsum(counts)
        return ids, total[ends] - total[ends - counts]

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The texts of ids: the bytes of their pieces, without the mark that encoding puts first."""
        n = self.raw_size[ids]
        data = self.raw[runs(self.raw_start[ids], n)].tobytes()
        total = np.concatenate([[0], np.cumsum(n)])
        ends = np.cumsum(counts)
        return [data[a:b].removeprefix(b" ") for a, b in zip(total[ends - counts].tolist(), total[ends].tolist(), strict=True)]


def runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of all elements of the runs that begin at starts."""
    if not len(starts):
        return np.zeros(0, np.int64)
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


@functools.cache
def pieces(path: str, kind: str) -> Pieces:
    """One for a Python worker, kept from task to task."""
    return Pieces(path, kind)


def encoded(docs: DataFrame, model_path: str, *, kind: str = "bpe") -> DataFrame:
    """docs with piece_ids (array<int>), n_pieces and round_trip (decoding gives the text, marks as spaces); columns of these names are replaced."""
    rows = docs.drop("piece_ids", "n_pieces", "round_trip")
    names = rows.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def run(batches):
        model = pieces(model_path, kind)
        for batch in batches:
            for part in slices(batch, "text", SLICE_TEXT):
                texts = pc.fill_null(part.column("text").cast(pa.string()), "")
                ids, counts = model.encode(texts)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(ids, pa.int32()))
                same = [a == b.as_py().replace(MARK, " ").encode() for a, b in zip(model.decode(ids, counts), texts, strict=True)]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], lists, pa.array(counts, pa.int64()), pa.array(same, pa.bool_())], [*names, "piece_ids", "n_pieces", "round_trip"])
        pa.default_memory_pool().release_unused()

    return rows.mapInArrow(run, f"{schema}, piece_ids array<int>, n_pieces long, round_trip boolean")


def decoded(rows: DataFrame, model_path: str, *, kind: str = "bpe") -> DataFrame:
    """doc_id, text of rows with doc_id, piece_ids."""

    def run(batches):
        model = pieces(model_path, kind)
        for batch in batches:
            lists = batch.column("piece_ids").fill_null([])
            counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            texts = model.decode(lists.flatten().to_numpy(), counts)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([t.decode(errors="replace") for t in texts], pa.string())], ["doc_id", "text"])

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "piece_ids").mapInArrow(run, "doc_id long, text string")
