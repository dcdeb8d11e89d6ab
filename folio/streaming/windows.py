"""STR-1: the pages of a store as they come, a micro-batch of whole windows at a time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from folio.sources.page_store import MARK, PageStore


def stream_windows(store: PageStore, handle: Callable[[DataFrame, int], None], checkpoint: str, **trigger) -> StreamingQuery:
    """Start a query that calls handle(pages, batch_id) with the stored pages of the windows that have been marked since the last batch.

    A window is seen once its pages are stored whole, never before; one that is stored again is seen again. A batch that is run again
    after a failure has the same windows and the same batch_id. The marks must not be compacted.
    """
    spark = store.spark
    store.marks.ready()
    marks = spark.readStream.schema(f"{MARK}, version long").option("recursiveFileLookup", "true").parquet(f"{store.marks.path}/versions")

    def batch(rows: DataFrame, batch_id: int) -> None:
        handle(store.pages(rows.select("job_id", "window_index")), batch_id)

    writer = marks.writeStream.option("checkpointLocation", checkpoint).foreachBatch(batch)
    return (writer.trigger(**trigger) if trigger else writer).start()
