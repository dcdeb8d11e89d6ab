"""SNK-1, SNK-5, U-5: the data source `folio_documents`: one file for each document, published whole or not at all.

Rows are (name, text) or (name, data): the path of the file below the sink's folder, and what is appended to it. Rows of a
name come one after another in one task. Tasks write to a hidden folder of the job, in pieces of FLUSH_BYTES that are made
durable as they are written; only when all tasks have ended are the files renamed to their names. If the job fails, the
hidden folder goes with all that any task has written, also one that was killed, and one that still runs finds no folder.
"""

from __future__ import annotations

import hashlib
import json
import os
import time
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from folio.sources.listing import opened

#: Fixed value: bytes that are held before they are written.
FLUSH_BYTES = 1 << 20


def durable(store: pafs.FileSystem, path: str) -> None:
    if isinstance(store, pafs.LocalFileSystem):
        fd = os.open(path, os.O_RDONLY)
        try:
            os.fsync(fd)
        finally:
            os.close(fd)


class OpenDocument:
    """A document that is being written to a temporary file."""

    def __init__(self, store: pafs.FileSystem, temporary: str):
        self.store, self.temporary = store, temporary
        self.stream, self.held = store.open_output_stream(temporary), bytearray()

    def append(self, data: bytes) -> None:
        self.held += data
        if len(self.held) >= FLUSH_BYTES:
            self.flush()

    def flush(self) -> None:
        self.stream.write(bytes(self.held))
        self.stream.flush()
        durable(self.store, self.temporary)
        self.held.clear()

    def close(self) -> None:
        self.flush()
        self.stream.close()


@dataclass
class Written(WriterCommitMessage):
    """An attempt. The names of its documents lie in the hidden folder as attempt-names, as JSON; the k-th document as attempt-k. So a message has the same size for any number of documents."""

    attempt: str

    def files(self, writer: DocumentWriter, store: pafs.FileSystem) -> list[tuple[str, str]]:
        with store.open_input_stream(f"{writer.hidden}/{self.attempt}-names") as f:
            return [(f"{writer.hidden}/{self.attempt}-{k}", writer.target(name)) for k, name in enumerate(json.loads(f.read()))]


class DocumentWriter(DataSourceWriter):
    def __init__(self, root: str, columns: list[str]):
        self.root, self.value = root, "data" if "data" in columns else "text"
        if "name" not in columns or self.value not in columns:
            raise ValueError("rows need the columns name, and text or data")
        store, base, _ = opened(root)
        self.base = base.rstrip("/")
        self.hidden = f"{self.base}/.job-{uuid.uuid4().hex}"
        store.create_dir(self.hidden, recursive=True)

    def target(self, name: str) -> str:
        if not name or name.startswith("/") or ".." in name.split("/"):
            raise ValueError(f"not a name below the folder: {name!r}")
        return f"{self.base}/{name}"

    def write(self, iterator):
        store, _, _ = opened(self.root)
        done, now, name = Written(uuid.uuid4().hex), None, None
        names: dict[str, None] = {}  # in their order
        for row in iterator:
            if now is None or row["name"] != name:
                if now is not None:
                    now.close()
                name = row["name"]
                if name in names:
                    raise RuntimeError(f"rows of {name!r} do not follow one another")
                self.target(name)
                now = OpenDocument(store, f"{self.hidden}/{done.attempt}-{len(names)}")
                names[name] = None
            value = row[self.value]
            now.append(b"" if value is None else value.encode() if isinstance(value, str) else bytes(value))
        if now is not None:
            now.close()
        listed = OpenDocument(store, f"{self.hidden}/{done.attempt}-names")
        listed.append(json.dumps(list(names)).encode())
        listed.close()
        return done

    def single(self, messages) -> None:
        """Fail if several attempts have a name. Of a name 16 bytes are held."""
        store, _, _ = opened(self.root)
        marks = bytearray()
        for m in messages:
            for _, final in m.files(self, store):
                marks += hashlib.blake2b(final.encode(), digest_size=16).digest()
        marks = np.frombuffer(marks, [("a", "u8"), ("b", "u8")])
        if len(np.unique(marks)) != len(marks):
            raise RuntimeError("several tasks have rows of one document")

    def renamed(self, message) -> None:
        """Give the documents of an attempt their names; again if a task that did it was broken off."""
        store, _, _ = opened(self.root)
        files = message.files(self, store)
        folders = {final.rpartition("/")[0] for _, final in files}
        for folder in folders:
            store.create_dir(folder, recursive=True)
        for temporary, final in files:
            try:
                store.move(temporary, final)
            except FileNotFoundError:
                if store.get_file_info(final).type != pafs.FileType.File:
                    raise
        for folder in folders:
            durable(store, folder)

    def commit(self, messages):
        messages = [m for m in messages if m]
        try:
            self.single(messages)
        except RuntimeError:
            self.abort(messages)
            raise
        for m in messages:
            self.renamed(m)
        self.done()

    def done(self) -> None:
        opened(self.root)[0].delete_dir(self.hidden)

    def abort(self, messages):
        store, _, _ = opened(self.root)
        for left in reversed(range(20)):  # a task that still runs may add a file meanwhile
            try:
                return store.delete_dir(self.hidden)
            except FileNotFoundError:
                return None
            except OSError:
                if not left:
                    raise
                time.sleep(0.1)


class DocumentSink(DataSource):
    @classmethod
    def name(cls):
        return "folio_documents"

    def writer(self, schema, overwrite):
        return DocumentWriter(self.options["path"], schema.fieldNames())


def publish(rows: DataFrame, path: str) -> None:
    """Write rows (name, text or data), one row a document, below path; documents that are there are replaced.

    It is what the data source does, with tasks that write and tasks that rename, and without the processes that Spark
    starts beside the driver for a data source.
    """
    writer = DocumentWriter(path, rows.columns)
    rows = rows.select("name", writer.value)

    def write(batches):
        each = (dict(zip(("name", writer.value), (c.as_py() for c in row), strict=True)) for batch in batches for row in zip(*batch.columns, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array([writer.write(each).attempt])], ["attempt"])

    def rename(batches):
        for batch in batches:
            for attempt in batch.column("attempt"):
                writer.renamed(Written(attempt.as_py()))
            yield batch.slice(0, 0)

    spark = rows.sparkSession
    try:
        messages = [Written(r.attempt) for r in rows.mapInArrow(write, "attempt string").collect()]
        writer.single(messages)
        attempts = spark.sparkContext.parallelize([(m.attempt,) for m in messages], max(1, len(messages)))
        spark.createDataFrame(attempts, "attempt string").mapInArrow(rename, "attempt string").collect()
    except BaseException:
        writer.abort([])
        raise
    writer.done()


def publish_pages(pages: DataFrame, path: str, order: str) -> None:
    """Write rows (name, text or data, and order), the rows of a document in their order."""
    value = "data" if "data" in pages.columns else "text"
    publish(pages.repartition("name").sortWithinPartitions("name", order).select("name", value), path)


def figure_file(page: Column, index: Column) -> Column:
    """SNK-5: the name of a figure's picture."""
    return F.format_string("figure_p%03d_%d.png", page.cast("long"), index.cast("long"))
