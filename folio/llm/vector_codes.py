"""Vectors as short codes: a product quantizer of integer components, whose nearest entries are found in an annulus of norms.

Each component x becomes floor(4096 * x). Vectors are cut into PARTS equal parts; each part position has a codebook of
ENTRIES entries, first those parts of the ENTRIES smallest vec_ids, then in each of ROUNDS rounds the floored means of the
parts nearest to them (an entry that no part is nearest to stays). The entries of a codebook are sorted by norm. By the
triangle inequality an entry at distance r or less of a part has a norm within r of the part's, so the entry of nearest
norm gives a first distance, binary search the interval of entries that may be as near, ends included, and only those are
measured. Distances are exact integers; ties go to the lower index.

The input is read once a round: tasks send a sum and a count for each entry, so that the driver gets PARTS * ENTRIES sums,
which is the size of the codebooks whatever the number of rows.

Rows whose vector is null, empty, or holds null or non-finite components are dropped; so are rows whose length PARTS does
not divide or is not that of the first kept vec_id, and rows with components so large that a 64-bit error could overflow.
Of equal vec_ids the least vectors come first; rows of equal vec_id each give a row, and rows without vec_id give one too,
but begin no entry. With fewer rows than ENTRIES the codebooks have fewer entries. Equal labels are summed together, nulls as
one label, whatever share of the rows they have: sums are made before they are shuffled, and joined back. An empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from folio.llm.common import small, written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Vectors measured at once in a task.
SLICE_ROWS = 4096


def usable(dimensions: int | None = None):
    """Whether a row of vec_id, vector, label counts."""
    n = F.size("vector")
    largest = F.greatest(F.abs(F.array_max("vector")), F.abs(F.array_min("vector"))) * SCALE + 1  # NaN is the largest value
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    ok = F.col("vector").isNotNull() & (n > 0) & (n % PARTS == 0) & finite & (4 * n * largest * largest < 2.0**62)
    return F.coalesce(ok if dimensions is None else ok & (n == dimensions), F.lit(False))


def integers(column: pa.Array, dimensions: int) -> np.ndarray:
    """A row of floor(SCALE * x) for each vector of dimensions components."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(flat * SCALE).astype(np.int64).reshape(-1, dimensions)


def first_entries(rows: DataFrame) -> np.ndarray | None:
    """PARTS x entries x width integers, or None without rows."""
    found = [r.vector for r in rows.filter(F.col("vec_id").isNotNull()).orderBy("vec_id", "vector").select("vec_id", "vector").limit(ENTRIES).collect()]
    if not found:
        return None
    whole = np.floor(np.array(found, np.float64) * SCALE).astype(np.int64)
    return np.ascontiguousarray(whole.reshape(len(found), PARTS, -1).transpose(1, 0, 2))


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The index of the nearest entry of each row of x (ties: the lowest), and the squared distance."""
    entry_norms = np.sqrt((entries.astype(np.float64) ** 2).sum(1))
    order = np.argsort(entry_norms, kind="stable")
    norms, ranked = entry_norms[order], entries[order]
    own = np.sqrt((x.astype(np.float64) ** 2).sum(1))
    after = np.minimum(np.searchsorted(norms, own), len(norms) - 1)
    before = np.maximum(after - 1, 0)
    first = np.where(np.abs(norms[before] - own) <= np.abs(norms[after] - own), before, after)
    best = ((x - ranked[first]) ** 2).sum(1)
    index = order[first]
    slack = 1e-6 + 1e-12 * own  # more than what rounding takes from norms and roots
    reach = np.sqrt(best.astype(np.float64)) + slack
    low, high = np.searchsorted(norms, own - reach, "left"), np.searchsorted(norms, own + reach, "right")
    for k in range(int(low.min(initial=len(norms))), int(high.max(initial=0))):
        open_ = np.flatnonzero((low <= k) & (k < high) & (k != first))
        open_ = open_[np.abs(norms[k] - own[open_]) <= np.sqrt(best[open_].astype(np.float64)) + slack[open_]]  # the best may be nearer by now
        distance = ((x[open_] - ranked[k]) ** 2).sum(1)
        better = (distance < best[open_]) | ((distance == best[open_]) & (order[k] < index[open_]))
        best[open_[better]], index[open_[better]] = distance[better], order[k]
    return index, best


def coded(batch: pa.RecordBatch, books: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of a batch with their parts (rows x PARTS x width), the index of each part's entry and the squared distances."""
    dimensions = books.shape[0] * books.shape[2]
    for at in range(0, batch.num_rows, SLICE_ROWS):
        part = batch.slice(at, SLICE_ROWS)
        x = integers(part.column("vector"), dimensions).reshape(part.num_rows, PARTS, -1)
        found = [nearest(x[:, p], books[p]) for p in range(PARTS)]
        yield part, x, np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)


def refined(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round over all rows."""
    entries, width = books.shape[1:]

    def run(batches):
        sums, counts = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            for _, x, index, _ in coded(batch, books):
                for p in range(PARTS):
                    np.add.at(sums[p], index[:, p], x[:, p])
                    counts[p] += np.bincount(index[:, p], minlength=entries)
        p, e = np.nonzero(counts)
        if len(p):
            yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int64)), pa.array(e.astype(np.int64)), pa.array(counts[p, e]), pa.array(list(sums[p, e]), pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])

    found = rows.select("vector").mapInArrow(run, "part long, entry long, n long, sums array<long>")
    total = found.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*(F.sum(F.col("sums")[i]) for i in range(width))).alias("sums"))
    out = books.copy()
    for r in total.collect():  # PARTS * ENTRIES rows at most
        out[r.part, r.entry] = np.array(r.sums, np.int64) // r.n
    return out


def codebooks(rows: DataFrame) -> np.ndarray | None:
    """The codebooks of usable rows of one length."""
    books = first_entries(rows)
    for _ in range(ROUNDS if books is not None else 0):
        books = refined(rows, books)
    return books


def codes(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code (two hexadecimal digits a part), error (sum of the squared distances)."""

    def run(batches):
        for batch in batches:
            for part, _, index, distance in coded(batch, books):
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("label"), pa.array([bytes(r).hex() for r in index.astype(np.uint8)], pa.string()), pa.array(distance.sum(1))], ["vec_id", "label", "code", "error"])

    kinds = dict(rows.dtypes)
    return rows.select("vec_id", "label", "vector").mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def decoded(coded_rows: DataFrame, books: np.ndarray) -> DataFrame:
    """coded_rows with vector, the entries of their codes scaled back to floating point; null for a null code."""

    def run(batches):
        for batch in batches:
            out = []
            for code in batch.column("code").to_pylist():
                out.append(None if code is None else (books[np.arange(PARTS), np.frombuffer(bytes.fromhex(code), np.uint8)].ravel() / SCALE).tolist())
            yield batch.append_column("vector", pa.array(out, pa.list_(pa.float64())))

    base = coded_rows.drop("vector")
    return base.mapInArrow(run, StructType([*base.schema.fields, StructField("vector", ArrayType(DoubleType()))]))


def vector_codes(embeddings: DataFrame, *, vector: str = "embedding") -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 for every usable row."""
    rows = embeddings.select("vec_id", F.col(vector).alias("vector"), "label")
    head = rows.filter(usable() & F.col("vec_id").isNotNull()).orderBy("vec_id", "vector").select(F.size("vector").alias("n")).first()
    rows = rows.filter(usable(head.n) if head else F.lit(False))
    books = codebooks(rows)
    if books is None:
        return rows.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    found = written(codes(rows, books), "codes")
    sums = written(found.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    joined = found.join(small(sums.withColumnRenamed("label", "of")), F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
