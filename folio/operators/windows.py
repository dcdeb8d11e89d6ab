"""Windows of pages, and what of them is done."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def page_windows(jobs: DataFrame, size: int = 8) -> DataFrame:
    """G-7: job_id, window_index, start_page, end_page of the windows that begin after last_completed_page. jobs: job_id, total_pages, last_completed_page."""
    starts = F.when(F.col("total_pages") > 0, F.sequence(F.lit(1), F.col("total_pages").cast("int"), F.lit(size)))
    rows = jobs.select("job_id", "total_pages", "last_completed_page", F.posexplode(starts).alias("window_index", "start_page"))
    return rows.filter("start_page > last_completed_page").select("job_id", F.col("window_index").cast("long").alias("window_index"), F.col("start_page").cast("long").alias("start_page"), F.least(F.col("start_page") + size - 1, F.col("total_pages")).cast("long").alias("end_page"))


def resume_plan(completed: DataFrame, present: DataFrame) -> DataFrame:
    """J-8, W-7, W-9: the leading windows whose results are present count as done. completed: job_id, window_index, end_page; present: job_id, window_index."""
    order = W.partitionBy("job_id").orderBy("window_index")
    rows = completed.join(present.select("job_id", "window_index", F.lit(1).alias("there")).distinct(), ["job_id", "window_index"], "left")
    rows = rows.withColumn("leading", F.min(F.coalesce("there", F.lit(0))).over(order))
    return rows.groupBy("job_id").agg(F.sum("leading").cast("long").alias("verified"), F.sum(1 - F.col("leading")).cast("long").alias("discarded"), F.coalesce(F.max(F.when(F.col("leading") == 1, F.col("end_page"))), F.lit(0)).cast("long").alias("last_completed_page"))
