"""A table of versions: each append is a folder of Parquet files whose name is the next number, taken by a rename that fails if another writer has it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.sources.shared import Files


class VersionConflict(Exception):
    """Another writer has appended the version meanwhile: read again, then decide again."""


class VersionedTable:
    """Rows with keys under a path. A later version's row of a key replaces an earlier one's; of rows of one version the greatest counts.

    Readers see whole versions only: a writer that dies leaves a folder that nobody reads. The compare-and-set needs a file
    system whose rename is atomic.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str]):
        self.spark, self.path, self.schema, self.keys, self.files = spark, path.rstrip("/"), schema, keys, Files(spark)

    def versions(self) -> list[int]:
        return [int(n) for n in self.files.names(f"{self.path}/versions") if n.isdigit()]

    def version(self) -> int:
        return max(self.versions(), default=0)

    def ready(self) -> None:
        """Make the folder of versions, so that a stream can watch it before the first append."""
        self.files.make(f"{self.path}/versions")

    def folder(self, version: int) -> str:
        return f"{self.path}/versions/{version:012d}"

    def append(self, rows: DataFrame, expected: int | None = None, *, base: bool = False) -> int:
        """Append rows as the version after expected (default: after the last): VersionConflict if that one is there. base: the rows stand for all before them."""
        after = (self.version() if expected is None else expected) + 1
        staged = f"{self.path}/staged/{uuid.uuid4().hex}"
        shape = self.spark.createDataFrame([], self.schema).schema
        rows.select(*shape.names).to(shape).withColumn("version", F.lit(after).cast("long")).write.parquet(staged)
        if base:
            self.files.touch(f"{staged}/_BASE")
        if (expected is not None and expected != self.version()) or not self.files.moved(staged, self.folder(after)):
            self.files.delete(staged)
            raise VersionConflict(f"version {after} of {self.path} is taken")
        return after

    def changes(self, after: int = 0) -> DataFrame:
        """All rows of the versions beyond `after`, with version; those that a base stands for are left out."""
        found = []
        for v in sorted(self.versions(), reverse=True):
            if v <= after:
                break
            found.append(self.folder(v))
            if "_BASE" in self.files.names(self.folder(v)):
                break
        schema = f"{self.schema}, version long"
        return self.spark.read.schema(schema).parquet(*found) if found else self.spark.createDataFrame([], schema)

    def latest(self) -> DataFrame:
        """The row of each key that counts, with its version."""
        rest = [c for c in self.changes().columns if c not in (*self.keys, "version")]
        last = self.changes().groupBy(*self.keys).agg(F.max(F.struct("version", *rest)).alias("r"))
        return last.select(*self.keys, *[F.col(f"r.{c}").alias(c) for c in rest], F.col("r.version").alias("version"))

    def compact(self) -> int:
        """Write the latest rows as a base, so that readers need no earlier version. The earlier folders stay for those who read them now."""
        version = self.version()
        return self.append(self.latest(), version, base=True)

    def vacuum(self) -> int:
        """Delete the versions before the last base; how many there were."""
        versions = self.versions()
        base = max((v for v in versions if "_BASE" in self.files.names(self.folder(v))), default=0)
        gone = [v for v in versions if v < base]
        for v in gone:
            self.files.delete(self.folder(v))
        return len(gone)
