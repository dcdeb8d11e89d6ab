"""STR-2, STR-3: pages of a job in order of their number, and the tables that go on over pages, from a stream that delivers pages in any order.

A page is released when it is the next expected one; others wait in state, and those left when the job's end row
(page_number null) comes are released in order of (page_number, arrival), duplicates and late ones with them. Rows of a
job without job_id are one job. The state stores need the RocksDB provider.
"""

from __future__ import annotations

import contextlib
import itertools
import json
import pickle
from collections import defaultdict, namedtuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextlib.contextmanager
def rocksdb(spark: SparkSession):
    """Queries that start in here keep their state in RocksDB."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


#: Rows of a job that a task holds at once.
CHUNK = 10_000


class PageOrder(StatefulProcessor):
    """Rows page_number, arrival, payload of a job; released() makes output rows of each page as it leaves, drained() of what is left at the end.

    Each call to the state is a message to Spark: what waits of a job is one list, which is read and put back only when a page that
    was waited for comes, or the end, and else only added to.
    """

    columns = ["job_id", "position", "page_number", "arrival", "text"]

    def init(self, handle):
        self.progress = handle.getValueState("progress", "next long, position long, blocked boolean, held long")
        self.waiting = handle.getListState("waiting", "page long, arrival long, payload string")

    def begin(self):
        pass

    def released(self, key, position, page, arrival, payload):
        return [(key, position, page, arrival, payload)]

    def drained(self, key):
        return []

    def finish(self):
        pass

    def handleInputRows(self, key, rows, timerValues):
        expected, position, blocked, held = self.progress.get() or (1, 0, False, 0)
        row, ended = Row(*self.columns), False
        self.begin()
        while chunk := list(itertools.islice(rows, CHUNK)):
            ended |= any(r.page_number is None for r in chunk)
            new = sorted(((r.page_number, r.arrival, r.payload) for r in chunk if r.page_number is not None), key=lambda e: e[1])
            if blocked or all(page != expected for page, _, _ in new):
                blocked |= any(page < expected for page, _, _ in new)  # a duplicate or late page heads the queue, so nothing leaves before the end
                if new:
                    self.waiting.appendList(new)
                    held += len(new)
                continue
            before, queue = held, defaultdict(list)
            for page, arrival, payload in self.waiting.get() if held else ():
                queue[page].append((arrival, payload))
            for page, arrival, payload in new:
                blocked |= page < expected
                queue[page].append((arrival, payload))
                while not blocked and (found := sorted(queue.pop(expected, ()), key=lambda e: e[0])):
                    position += 1
                    for out in self.released(key[0], position, expected, *found[0]):
                        yield row(*out)
                    if found[1:]:
                        queue[expected] = found[1:]
                        blocked = True
                    expected += 1
            rest = [(page, *entry) for page, entries in queue.items() for entry in entries]
            held = len(rest)
            if rest:
                self.waiting.put(rest)
            elif before:
                self.waiting.clear()
        if ended:
            for page, arrival, payload in sorted(self.waiting.get(), key=lambda e: e[:2]) if held else ():
                position += 1
                for out in self.released(key[0], position, page, arrival, payload):
                    yield row(*out)
            if held:
                self.waiting.clear()
            held = 0
            for out in self.drained(key[0]):
                yield row(*out)
        self.finish()
        self.progress.update((expected, position, blocked, held))

    def close(self):
        pass


class TableMerge(PageOrder):
    """J-6 over the stream: fragments of a start page wait in state until a closing piece of it is released, or the job ends."""

    columns = ["job_id", "start_page", "chain", "page_number", "token", "markdown", "closed"]

    def init(self, handle):
        super().init(handle)
        self.open = handle.getListState("open", "start_page long, page long, markdown string")
        self.chains = handle.getMapState("chains", "start_page long", "closed long")

    def begin(self):
        self.pieces, self.closed, self.opened = None, {}, 0

    def of(self, start):
        """The fragments that wait for a start page; those of all are read at the first call."""
        if self.pieces is None:
            self.pieces = defaultdict(list)
            for at, page, markdown in self.open.get():
                self.pieces[at].append((page, markdown))
                self.opened += 1
        return self.pieces[start]

    def chain(self, start):
        if start not in self.closed:
            self.closed[start] = (self.chains.getValue((start,)) or (0,))[0]
        return self.closed[start]

    def merged(self, key, start, pieces, token, closed):
        return (key, start, self.chain(start), pieces[-1][0], token, "\n".join(md.rstrip("\n") for _, md in pieces), closed)

    def released(self, key, position, page, arrival, payload):
        out = []
        for table in json.loads(payload or "[]"):
            start = int(table["start_page"])
            pieces = self.of(start)
            pieces.append((page, table.get("markdown") or ""))
            if not table["is_fragment"]:
                out.append(self.merged(key, start, pieces, table["token"], True))
                self.closed[start] += 1
                del self.pieces[start]
        return out

    def drained(self, key):
        self.of(None)
        out = [self.merged(key, start, pieces, None, False) for start, pieces in sorted((s, p) for s, p in self.pieces.items() if p)]
        self.pieces = defaultdict(list)
        return out

    def finish(self):
        if self.pieces is not None:
            rest = [(start, *piece) for start, pieces in self.pieces.items() for piece in pieces]
            if rest:
                self.open.put(rest)
            elif self.opened:
                self.open.clear()
        for start, n in self.closed.items():
            if n:
                self.chains.updateValue((start,), (n,))


class Kept:
    """A value, list or map of one job that lies in the state of its bucket, with the calls of Spark's states that the processors make."""

    value = None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class KeptList(Kept):
    def get(self):
        return iter(self.value or ())

    def put(self, values):
        self.value = list(values)

    def appendList(self, values):
        self.value = [*self.get(), *values]


class KeptMap(Kept):
    def getValue(self, key):
        return (self.value or {}).get(key)

    def updateValue(self, key, value):
        self.value = {**(self.value or {}), key: value}


#: Bytes of a bucket's state that are one row of it.
PIECE = 1 << 20
Arrived = namedtuple("Arrived", "page_number arrival payload")


#: Rows, and bytes of them, that are packed at once.
PACKED_ROWS, PACKED_BYTES = 200_000, 64 << 20


def packed(rows: DataFrame, buckets: int) -> DataFrame:
    """bucket, rows: job_id, page_number, arrival, payload of the rows of a bucket, as far as a task holds them at once. A row costs Spark's reader of stateful input more than all that is done with it, whatever is in it."""
    columns = ["job_id", *Arrived._fields]

    def pieces(held):
        table = pa.Table.from_batches(held).sort_by("bucket")
        table, starts = table.combine_chunks(), table["bucket"].to_numpy()
        cuts = [0, *(np.flatnonzero(starts[1:] != starts[:-1]) + 1).tolist(), len(starts)]
        for k in range(0, len(cuts) - 1, 1000):
            runs = list(itertools.pairwise(cuts[k : k + 1001]))
            made = [pickle.dumps(list(zip(*[table[c][a:z].to_pylist() for c in columns], strict=True)), pickle.HIGHEST_PROTOCOL) for a, z in runs]
            yield pa.RecordBatch.from_arrays([pa.array([starts[a] for a, _ in runs], pa.int64()), pa.array(made, pa.binary())], ["bucket", "rows"])

    def run(batches):
        held, n, size = [], 0, 0
        for batch in batches:
            held.append(batch)
            n, size = n + batch.num_rows, size + batch.nbytes
            if n >= PACKED_ROWS or size >= PACKED_BYTES:
                yield from pieces(held)
                held, n, size = [], 0, 0
        if n:
            yield from pieces(held)

    return rows.select(F.pmod(F.xxhash64("job_id"), F.lit(buckets)).alias("bucket"), *columns).mapInArrow(run, "bucket long, rows binary")


class Buckets(StatefulProcessor):
    """Packed rows of many jobs: what `order` does with each job, whose state is part of one list for the bucket.

    A batch costs a few messages to Spark for each bucket that it touches, not a dozen for each job. For that a touched
    bucket is read and put back whole, so that a bucket should have some thousand pages, and its rows of a batch are held at once.
    """

    def __init__(self, order: PageOrder):
        self.order = order

    def init(self, handle):
        self.stored, self.parts = handle.getListState("jobs", "piece binary"), []
        self.order.init(self)

    def part(self, kind):
        self.parts.append(kind())
        return self.parts[-1]

    def getValueState(self, name, schema):
        return self.part(Kept)

    def getListState(self, name, schema):
        return self.part(KeptList)

    def getMapState(self, name, key, value):
        return self.part(KeptMap)

    def ordered(self, jobs, job, rows):
        for part, value in zip(self.parts, jobs.get(job) or [None] * len(self.parts), strict=True):
            part.value = value
        yield from self.order.handleInputRows((job,), iter(rows), None)
        jobs[job] = [part.value for part in self.parts]

    def handleInputRows(self, key, rows, timerValues):
        jobs, arrived, ends = {}, defaultdict(list), {}
        if stored := b"".join(piece for (piece,) in self.stored.get()):
            jobs = pickle.loads(stored)
        for job, *row in itertools.chain.from_iterable(pickle.loads(r["rows"]) for r in rows):
            row = Arrived(*row)
            if row.page_number is None:
                ends[job] = row
                continue
            arrived[job].append(row)
            if len(arrived[job]) == CHUNK:
                yield from self.ordered(jobs, job, arrived.pop(job))
        for job in dict.fromkeys((*arrived, *ends)):
            yield from self.ordered(jobs, job, [*arrived.pop(job, ()), *([ends[job]] if job in ends else ())])
        stored = pickle.dumps(jobs, pickle.HIGHEST_PROTOCOL)
        self.stored.put([(stored[:PIECE],)])
        for k in range(PIECE, len(stored), PIECE):
            self.stored.appendList([(stored[k : k + PIECE],)])

    def close(self):
        self.order.close()


def job_type(pages: DataFrame) -> str:
    return dict(pages.dtypes)["job_id"]


def ordered_pages(pages: DataFrame) -> DataFrame:
    """job_id, position, page_number, arrival, text of pages: job_id of any type, page_number, arrival and, if there is one, text, as a stream."""
    text = F.col("text") if "text" in pages.columns else F.lit(None)
    rows = pages.select("job_id", F.col("page_number").cast("long"), F.col("arrival").cast("long"), text.cast("string").alias("payload"))
    schema = f"job_id {job_type(pages)}, position long, page_number long, arrival long, text string"
    return rows.groupBy("job_id").transformWithState(statefulProcessor=PageOrder(), outputStructType=schema, outputMode="Append", timeMode="None")


def merged_tables_stream(pages: DataFrame, buckets: int | None = None) -> DataFrame:
    """The rows of operators.pages.merged_tables for a stream of pages: job_id, page_number, arrival, tables (array of token, markdown, is_fragment, start_page).

    A table leaves when its closing piece does, in page order; those without an end leave at the job's end row, with closed false.
    buckets: jobs whose ids have the same hash share a state, for streams of many small jobs (default: a state a job). It stays
    as it is for all runs with one checkpoint.
    """
    rows = pages.select("job_id", F.col("page_number").cast("long"), F.col("arrival").cast("long"), F.to_json("tables").alias("payload"))
    schema = f"job_id {job_type(pages)}, start_page long, chain long, page_number long, token string, markdown string, closed boolean"
    if buckets:
        if job_type(pages) not in ("string", "bigint", "int"):
            raise ValueError("buckets need job ids that are texts or whole numbers")
        return packed(rows, buckets).groupBy("bucket").transformWithState(statefulProcessor=Buckets(TableMerge()), outputStructType=schema, outputMode="Append", timeMode="None")
    return rows.groupBy("job_id").transformWithState(statefulProcessor=TableMerge(), outputStructType=schema, outputMode="Append", timeMode="None")
