"""SRC-11, SNK-4: extracted pages, a batch of windows at a time, with a mark for each window that is stored whole."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.sources.versioned import VersionedTable

MARK = "job_id string, window_index long, start_page long, end_page long, batch string"


class PageStore:
    """Pages are written before their windows are marked, and read by marks: a batch that died, or a window with a page missing, is never replayed.

    schema names the columns of a page: job_id (string), window_index and page_number (long) and what else a page has. A window
    that is written again is read from its last batch. Pages lie by batch, so that readers open the folders of the marks only.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.marks = VersionedTable(spark, f"{self.path}/marks", MARK, ["job_id", "window_index"])

    def write(self, pages: DataFrame, windows: DataFrame) -> str:
        """Store pages and mark those of windows (job_id, window_index, start_page, end_page) that have each of their pages; the name of the batch."""
        batch = uuid.uuid4().hex
        shape = self.spark.createDataFrame([], self.schema).schema
        folder = f"{self.path}/pages/batch={batch}"
        pages.select(*shape.names).to(shape).write.parquet(folder)
        stored = self.spark.read.schema(self.schema).parquet(folder).groupBy("job_id", "window_index").agg(F.count_distinct("page_number").alias("n"), F.min("page_number").alias("low"), F.max("page_number").alias("high"))
        whole = windows.select("job_id", "window_index", "start_page", "end_page").join(stored, ["job_id", "window_index"]).filter("n = end_page - start_page + 1 AND low = start_page AND high = end_page")
        self.marks.append(whole.withColumn("batch", F.lit(batch)))
        return batch

    def present(self) -> DataFrame:
        """job_id, window_index of the windows that can be replayed."""
        return self.marks.latest().select("job_id", "window_index")

    def pages(self, windows: DataFrame | None = None) -> DataFrame:
        """The stored pages, of the windows (job_id, window_index) if given; of equal pages of a window one. Sort by job_id and page_number where the order counts."""
        marks = self.marks.latest().select("job_id", "window_index", "batch")
        if windows is not None:
            marks = marks.join(windows.select("job_id", "window_index").distinct(), ["job_id", "window_index"], "left_semi")
        if not self.marks.version():
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(f"{self.schema}, batch string").option("basePath", f"{self.path}/pages").parquet(f"{self.path}/pages")
        return rows.join(marks, ["job_id", "window_index", "batch"], "left_semi").drop("batch").dropDuplicates(["job_id", "window_index", "page_number"])
