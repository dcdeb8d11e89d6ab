"""Words of texts as hashed features, a batch at a time; helper of the trained operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Characters that are cut from both ends of a word.
EDGES = ".,!?;:\"'()[]{}*#$%&|<>-_/=+~`"
SLICE_BYTES = 8 << 20


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of the batch with about size bytes of text each, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
        yield batch.slice(at, to - at)
        at = to


def words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct lower-cased words, the index of each word of all texts, and where each text's words begin (one more at the end)."""
    listed = pc.ascii_split_whitespace(pc.utf8_lower(texts))
    coded = listed.flatten().dictionary_encode()
    bare = pc.ascii_trim(coded.dictionary, EDGES).dictionary_encode()
    offsets = listed.offsets.to_numpy().astype(np.int64)
    index = bare.indices.to_numpy()[coded.indices.to_numpy()] if len(coded) else np.zeros(0, np.int64)
    return bare.dictionary.to_pylist(), index, offsets - offsets[0]


def summed(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of the runs between offsets."""
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[offsets[1:]] - total[offsets[:-1]]
