"""What the operators of this subpackage share: tables, text columns and durable intermediate results."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest table, in rows, that an operator broadcasts after counting it; a row holds a few numbers.
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """A null text counts as an empty one."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


#: Folders of applications that run on this machine only and name none, by application id.
OWN_FOLDERS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Where none is set, a temporary one if Spark has this machine only; a cluster has to name one, as no other folder is known to be shared."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        found = OWN_FOLDERS.get(app) or OWN_FOLDERS.setdefault(app, tempfile.mkdtemp(prefix="folio-"))
    return found.rstrip("/")


#: Whether Spark deletes the shuffle files of a query as soon as it has ended.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Rows of a batch that a task hands to Python.
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def written(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """df as a Parquet table in the shared folder, read again: its lineage ends there, a lost executor costs no recomputation, and its shuffle files go.

    batch_rows: what a plan with whole texts hands to Python at once, where the session's number of rows would be many megabytes.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with setting(spark, TIDY, "true"), setting(spark, BATCH, str(batch_rows)) if batch_rows else contextlib.nullcontext():
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables that written() gave, once nothing that is still to be computed reads them."""
    for df in tables:
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """df with a broadcast hint if it has at most BROADCAST_ROWS rows; as it is, for a shuffled join, beyond. Count a written table only."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def let(value: Column, body) -> Column:
    """body(value) with value computed once a row, also where body names it inside other lambdas."""
    return F.transform(F.array(value), body)[0]
