"""The data source `folio_files`: every file under a folder, also empty, hidden and huge ones, with intake checks.

Spark's own file sources leave out empty files and names that begin with _ or a dot, and fail on files over 2 GB. Here the
names are listed once, when the query is planned; files are packed into partitions by the bytes that will be read, and a
partition carries their names below the folder, compressed. A task looks at the first bytes of a file whose name says
nothing, and reads no more of a file that is not accepted.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Fixed values.
SUFFIXES = {"pdf": "pdf", "docx": "docx", "pptx": "pptx", "html": "html", "htm": "html"}
MAGIC = ((b"%pdf-", "pdf"), (b"pk\x03\x04", "docx"), (b"<!doctype html", "html"), (b"<html", "html"))
MAGIC_BYTES, MAX_BYTES = 16, 209_715_200
#: Bytes of content, and files, of a partition; bytes of content of a batch.
PARTITION_BYTES, PARTITION_FILES, BATCH_BYTES = 128 << 20, 5000, 16 << 20
HASH_BYTES = 1 << 20
SCHEMA = "path string, job_id string, document_type string, length long, reject_reason string, content binary"
#: Kinds of stores that can be opened outside Spark.
SCHEMES = ("", "file", "hdfs", "s3", "gs", "gcs", "abfs", "abfss")


def scheme(path: str) -> str:
    found = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):", path)
    return found[1].lower() if found else ""


def opened(path: str) -> tuple[pafs.FileSystem, str, str]:
    """The store of a path, the path in it, and what stands before such paths in what users see."""
    if scheme(path) in ("", "file"):
        return pafs.LocalFileSystem(), re.sub(r"^file:(//)?", "", path), "file:"
    store, inside = pafs.FileSystem.from_uri(path)
    return store, inside, path[: len(path) - len(inside)] if path.endswith(inside) else f"{scheme(path)}://"


def kind_of(path: str, head: bytes) -> str | None:
    """F-3: the type that the suffix or else the first bytes tell."""
    name = path.rsplit("/", 1)[-1]
    found = SUFFIXES.get(name.rsplit(".", 1)[-1].lower()) if "." in name else None
    return found or next((kind for magic, kind in MAGIC if head.lower().startswith(magic)), None)


@dataclass
class Files(InputPartition):
    """Files of a task: packed are their names below base, and sizes."""

    base: str
    packed: bytes

    @classmethod
    def of(cls, base: str, names: list[str], sizes: list[int]) -> Files:
        return cls(base, zlib.compress(json.dumps([names, sizes]).encode(), 1))

    @property
    def rows(self) -> list[tuple[str, int]]:
        return [(self.base + name, size) for name, size in zip(*json.loads(zlib.decompress(self.packed)), strict=True)]


def below(folder: str, recursive: bool, start: str = "") -> Iterator[tuple[str, int]]:
    """Names below a folder of this machine, and sizes, of all files in it, one by one: pyarrow makes an object of some hundred bytes for each first."""
    with os.scandir(f"{folder}/{start}") as found:
        deeper = []
        for f in found:
            if f.is_dir():
                deeper.append(f"{start}{f.name}/")
            elif f.is_file():
                yield start + f.name, f.stat().st_size
    for name in deeper if recursive else ():
        yield from below(folder, recursive, name)


class FileReader(DataSourceReader):
    def __init__(self, options):
        self.root = options["path"]
        self.recursive = options.get("recursive", "false").lower() == "true"
        self.max_bytes = int(options.get("maxBytes", MAX_BYTES))
        self.with_content = options.get("content", "true").lower() == "true"

    def partitions(self):
        store, base, _ = opened(self.root)
        info = store.get_file_info(base)
        if info.type == pafs.FileType.NotFound:
            raise FileNotFoundError(f"neither a file nor a folder: {self.root}")
        if info.type == pafs.FileType.File:
            base, found = "", [(info.path, info.size)]
        else:
            base = f"{base.rstrip('/')}/"
            if isinstance(store, pafs.LocalFileSystem):
                found = list(below(base, self.recursive))
            else:
                found = [(f.path, f.size) for f in store.get_file_info(pafs.FileSelector(base, recursive=self.recursive)) if f.type == pafs.FileType.File]
                base, found = (base, [(path[len(base) :], n) for path, n in found]) if all(path.startswith(base) for path, _ in found) else ("", found)
        parts, names, sizes, held = [], [], [], 0
        found.sort()
        for name, size in found:
            weight = size if size <= self.max_bytes else 0
            if names and (held + weight > PARTITION_BYTES or len(names) >= PARTITION_FILES):
                parts.append(Files.of(base, names, sizes))
                names, sizes, held = [], [], 0
            names.append(name)
            sizes.append(size)
            held += weight
        return [*parts, Files.of(base, names, sizes)]

    def row(self, store: pafs.FileSystem, shown: str, path: str, size: int) -> tuple:
        """F-1..F-3, T-11: the row of a file; content and its hash for accepted ones only."""
        head, kind = b"", kind_of(path, b"")
        if kind is None and size:
            with store.open_input_stream(path) as f:
                head = f.read(MAGIC_BYTES)
            kind = kind_of(path, head)
        reason = "empty" if size == 0 else "too_large" if size > self.max_bytes else "unsupported" if kind is None else None
        if reason:
            return shown, None, kind, size, reason, None
        hashed, kept = hashlib.sha256(), []
        try:
            with store.open_input_stream(path) as f:
                while block := f.read(HASH_BYTES):
                    hashed.update(block)
                    if self.with_content:
                        kept.append(block)
        except OSError:
            return shown, None, kind, size, "unreadable", None
        return shown, hashed.hexdigest(), kind, size, None, b"".join(kept) if self.with_content else None

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _, prefix = opened(self.root)
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
        held, size = [], 0
        for path, length in partition.rows:
            held.append(self.row(store, prefix + path, path, length))
            size += len(held[-1][-1] or b"")
            if size >= BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names)


class FileSource(DataSource):
    @classmethod
    def name(cls):
        return "folio_files"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return FileReader(self.options)


def registered(spark: SparkSession) -> SparkSession:
    spark.dataSource.register(FileSource)
    return spark


def listed(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """What the data source gives for its options and path, listed by this process now: Spark starts two Python processes beside the driver for each thing that it asks of a data source."""
    reader = FileReader(options)
    parts = [(p.base, p.packed) for p in reader.partitions()]

    def run(batches):
        for batch in batches:
            for base, packed in zip(*batch.columns, strict=True):
                yield from reader.read(Files(base.as_py(), packed.as_py()))

    rows = spark.createDataFrame(spark.sparkContext.parallelize(parts, len(parts)), "base string, packed binary")
    return rows.mapInArrow(run, SCHEMA)
