"""Files as tables: scans with intake checks, and writers."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.operators.errors import error, first_error
from folio.sources import listing
from folio.sources.listing import MAX_BYTES

#: Fixed value.
MAX_PAGES = 500


def intake_error(reason: Column, path: Column, length: Column) -> Column:
    """The error of a reject reason; null for none."""
    said = {"empty": "the document is empty", "unsupported": "the format is not supported", "unreadable": "the document can't be read"}
    told = [F.when(reason == k, error("DocumentError", v, path=path, size_bytes=length)) for k, v in said.items()]
    large = F.when(reason == "too_large", error("DocumentTooLargeError", "the document is too large", path=path, size_bytes=length, max_size_bytes=F.lit(MAX_BYTES)))
    return first_error(large, *told)


def suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))


def scan_documents(spark: SparkSession, root: str, recursive: bool = False, content: bool = True, max_bytes: int = MAX_BYTES) -> DataFrame:
    """SRC-1, F-1..F-3, T-11: path, job_id (SHA-256 of the bytes), document_type, length, reject_reason, content, error of all files under root, or of root if it is one.

    A file counts by its suffix, else by its first bytes. Rejected files (empty, too_large, unsupported, unreadable) have
    neither job_id nor content: they are not read. The order is free: sort by path where one is needed, before content is
    read. A root that does not exist is an error. Stores that only Spark can open are read by its own source, which shows
    no empty or hidden files.
    """
    if listing.scheme(root) in listing.SCHEMES:
        options = {"recursive": str(recursive).lower(), "content": str(content).lower(), "maxBytes": str(max_bytes)}
        rows = listing.listed(spark, options | {"path": root})
    else:
        rows = spark_scan(spark, root, recursive, content, max_bytes)
    return rows.withColumn("error", intake_error(F.col("reject_reason"), F.col("path"), F.col("length")))


def spark_scan(spark: SparkSession, root: str, recursive: bool, content: bool, max_bytes: int) -> DataFrame:
    """The rows of scan_documents from Spark's source of binary files; too large ones are named without being read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(root)
    start = F.lower(F.decode(F.substring("content", 1, listing.MAGIC_BYTES), "ISO-8859-1"))
    by_suffix = F.coalesce(*[F.when(suffix(F.col("path")) == k, v) for k, v in listing.SUFFIXES.items()])
    kind = F.coalesce(by_suffix, *[F.when(start.startswith(m.decode("latin-1")), k) for m, k in listing.MAGIC])
    reason = F.when(kind.isNull(), "unsupported")
    data = F.when(kind.isNotNull(), F.col("content")) if content else F.lit(None).cast("binary")
    nothing = F.lit(None)
    near = files.filter(F.col("length") <= max_bytes).select("path", F.when(kind.isNotNull(), F.sha2("content", 256)).alias("job_id"), kind.alias("document_type"), "length", reason.alias("reject_reason"), data.alias("content"))
    far = files.filter(F.col("length") > max_bytes).select("path", nothing.cast("string").alias("job_id"), by_suffix.alias("document_type"), "length", F.lit("too_large").alias("reject_reason"), nothing.cast("binary").alias("content"))
    return near.unionByName(far)


def collected(rows: DataFrame) -> DataFrame:
    """SRC-1, S-4: of a scan, the accepted files that their suffix names, sorted by path."""
    return rows.filter(F.col("reject_reason").isNull() & suffix(F.col("path")).isin(*listing.SUFFIXES)).orderBy("path")


def within_page_limit(profiles: DataFrame) -> DataFrame:
    """F-4: profiles with reject_reason too_many_pages, and an error, where they have over MAX_PAGES."""
    over = F.col("page_or_unit_count") > MAX_PAGES
    told = F.when(over, error("DocumentTooLargeError", "the document has too many pages", page_count=F.col("page_or_unit_count"), max_pages=F.lit(MAX_PAGES)))
    return profiles.withColumn("reject_reason", F.when(over, "too_many_pages")).withColumn("error", told)


def scan_markdown(spark: SparkSession, root: str, pattern: str = "*.md", recursive: bool = False) -> DataFrame:
    """SRC-2, SRC-3: source_path, md."""
    files = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower()).text(root, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("source_path"), F.col("value").alias("md"))


def read_markdown(names: DataFrame, root: str) -> DataFrame:
    """names (name, and other columns) with md, the text of the file of that name below root. Nothing is listed, so that the driver's memory does not grow with the files."""
    columns = names.columns

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 128):
                part, texts = batch.slice(k, 128), []
                for name in part.column("name"):
                    store, inside, _ = listing.opened(f"{root}/{name.as_py()}")
                    with store.open_input_stream(inside) as f:
                        texts.append(f.read().decode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*columns, "md"])

    return names.mapInArrow(run, f"{', '.join(f'{c} {t}' for c, t in names.dtypes)}, md string")


def write_chunks(parents: DataFrame, children: DataFrame, path: str, stem: str | None = None) -> None:
    """SNK-2: both chunk tables as JSON lines; with stem, a column of both, in a folder for each of its values."""
    for rows, name in ((parents, "parent_chunks"), (children, "child_chunks")):
        writer = rows.write.mode("overwrite")
        (writer.partitionBy(stem) if stem else writer).json(f"{path}/{name}")


def write_export(parents: DataFrame, children: DataFrame, path: str, key: str) -> None:
    """SNK-3: what a vector store loads: parents with the ids of their children, children, and a row of figures for each document."""
    parent_records(parents, children, key).write.mode("overwrite").json(f"{path}/parent_chunks")
    child_records(children, key).write.mode("overwrite").json(f"{path}/child_chunks")
    document_statistics(parents, children, key).write.mode("overwrite").json(f"{path}/document_metadata")


def parent_records(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """chunk_id, content, metadata of each parent, with its children's ids in order."""
    ids = children.groupBy(F.col("parent_chunk_id").alias("chunk_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("chunk_index", "chunk_id"))), lambda x: x["chunk_id"]).alias("ids"))
    found = F.coalesce("ids", F.array().cast("array<string>"))
    metadata = F.struct(F.col(key).alias("document_id"), F.col("title").alias("header"), F.col("level").alias("header_level"), "section_path", "token_count", F.col("start_line").alias("line_start"), F.col("end_line").alias("line_end"), found.alias("child_chunk_ids"), F.size(found).alias("child_count"))
    return parents.join(ids, "chunk_id", "left").select("chunk_id", F.col("page_content").alias("content"), metadata.alias("metadata"))


def child_records(children: DataFrame, key: str) -> DataFrame:
    """chunk_id, content, metadata of each child, with its parent's id."""
    metadata = F.struct(F.col(key).alias("document_id"), "parent_chunk_id", F.col("title").alias("header"), "section_path", "token_count", "chunk_index", "block_types", F.col("start_line").alias("line_start"), F.col("end_line").alias("line_end"))
    return children.select("chunk_id", F.col("page_content").alias("content"), metadata.alias("metadata"))


def document_statistics(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """document_name and the struct statistics of each document that has parents."""
    p, c = parents.groupBy(key).agg(F.count("*").alias("p")), children.groupBy(key).agg(F.count("*").alias("c"))
    n = F.coalesce("c", F.lit(0).cast("long"))
    figures = F.struct(F.col("p").alias("total_parent_chunks"), n.alias("total_child_chunks"), F.round(n / F.col("p"), 2).alias("avg_children_per_parent"))
    return p.join(c, key, "left").select(F.col(key).alias("document_name"), figures.alias("statistics"))


def append_records(rows: DataFrame, path: str) -> None:
    """SNK-10: records as JSON lines after those that are there."""
    rows.write.mode("append").json(path)


def scan_images(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """SRC-15: path, length, content of the pictures under root."""
    wanted = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin("png", "jpg", "jpeg", "webp", "gif", "bmp", "tif", "tiff")
    return spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(root).filter(wanted).select("path", "length", "content")


def latest(rows: DataFrame, key: str, order: str) -> DataFrame:
    """SNK-7: of an append-only store, the last row of each key."""
    return rows.groupBy(key).agg(F.max_by(F.struct(*[c for c in rows.columns if c != key]), order).alias("r")).select(key, "r.*")
