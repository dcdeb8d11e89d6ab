"""STR-8: one stream of pages to two tables: the figures of each batch first, so that they are there before their pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def tee(batch: DataFrame, batch_id: int, figures_path: str, pages_path: str) -> None:
    """Write the figures and the pages of a batch, each to the folder of its batch: a batch that is run again replaces what it has written before."""
    batch.persist()
    try:
        figures = batch.select("job_id", "page_number", F.explode("figures").alias("figure")).select("job_id", "page_number", "figure.*")
        figures.write.mode("overwrite").parquet(f"{figures_path}/batch_id={batch_id}")
        batch.drop("figures").write.mode("overwrite").parquet(f"{pages_path}/batch_id={batch_id}")
    finally:
        batch.unpersist()


def fan_out(pages: DataFrame, figures_path: str, pages_path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Start the query of a stream of pages (job_id, page_number, figures as an array of structs, more). The tables have batch_id; read them with spark.read.parquet."""
    writer = pages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, batch_id: tee(df, batch_id, figures_path, pages_path))
    return (writer.trigger(**trigger) if trigger else writer).start()
