"""STR-6: figures that wait for their summaries, each until its summary comes or its budget of time is over."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from folio.functions.text import PLACEHOLDER
from folio.operators.errors import error

#: Fixed value.
BUDGET_MS = 300_000


class FigureWait(StatefulProcessor):
    """By token: the summary, and the figures that wait for it with the time at which they give up."""

    def __init__(self, budget_ms: int, keep_ms: int | None):
        self.budget_ms, self.keep_ms = budget_ms, keep_ms

    def init(self, handle):
        self.handle = handle
        self.summary = handle.getValueState("summary", "is_informative boolean, markdown_result string", self.keep_ms)
        self.waiting = handle.getMapState("waiting", "deadline long", "figures string")  # JSON of [job_id, page_number]

    def rows(self, token, figures, text, timed_out):
        return [(token, job, page, text, timed_out) for job, page in figures]

    def frame(self, out):
        return pd.DataFrame(out, columns=["token", "job_id", "page_number", "replacement", "timed_out"])

    def handleInputRows(self, key, rows, timerValues):
        figures, out = [], []
        for pdf in rows:
            for r in pdf.itertuples(index=False):
                if r.is_summary:
                    self.summary.update((bool(r.is_informative), r.markdown_result))  # the last one counts
                else:
                    figures.append([r.job_id, None if pd.isna(r.page_number) else int(r.page_number)])
        if self.summary.exists():
            informative, text = self.summary.get()
            for (deadline,) in list(self.waiting.keys()):
                figures += json.loads(self.waiting.getValue((deadline,))[0])
                self.waiting.removeKey((deadline,))
                self.handle.deleteTimer(deadline)
            out = self.rows(key[0], figures, (text or "") if informative else "", False)
        elif figures:
            deadline = timerValues.getCurrentProcessingTimeInMs() + self.budget_ms
            if self.waiting.containsKey((deadline,)):
                figures += json.loads(self.waiting.getValue((deadline,))[0])
            self.waiting.updateValue((deadline,), (json.dumps(figures),))
            self.handle.registerTimer(deadline)
        yield self.frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        deadline, out = expiredTimerInfo.getExpiryTimeInMs(), []
        if self.waiting.containsKey((deadline,)):
            out = self.rows(key[0], json.loads(self.waiting.getValue((deadline,))[0]), PLACEHOLDER, True)
            self.waiting.removeKey((deadline,))
        yield self.frame(out)

    def close(self):
        pass


def resolved_figures(figures: DataFrame, summaries: DataFrame, budget_ms: int = BUDGET_MS, keep_ms: int | None = None) -> DataFrame:
    """token, job_id, page_number, replacement, timed_out, error of a stream of figures (token, job_id, page_number), as soon as the stream of summaries (token, is_informative, markdown_result) has theirs.

    An informative summary gives its text, another nothing. A figure without a summary after budget_ms of processing time
    gets the placeholder and an error; a summary that comes later serves the figures after it. keep_ms: how long a summary
    is kept without being written again (default: for ever). Rows without token are dropped.
    """
    f = figures.select("token", F.lit(False).alias("is_summary"), F.col("job_id").cast("string").alias("job_id"), F.col("page_number").cast("long").alias("page_number"), F.lit(None).cast("boolean").alias("is_informative"), F.lit(None).cast("string").alias("markdown_result"))
    s = summaries.select("token", F.lit(True).alias("is_summary"), F.lit(None).cast("string").alias("job_id"), F.lit(None).cast("long").alias("page_number"), F.coalesce("is_informative", F.lit(False)).alias("is_informative"), F.col("markdown_result").cast("string").alias("markdown_result"))
    rows = f.unionByName(s).filter("token IS NOT NULL").groupBy("token")
    out = rows.transformWithStateInPandas(statefulProcessor=FigureWait(budget_ms, keep_ms), outputStructType="token string, job_id string, page_number long, replacement string, timed_out boolean", outputMode="Append", timeMode="ProcessingTime")
    late = error("TokenResolutionTimeoutError", "the figure has no summary in time", token=F.col("token"), page_number=F.col("page_number"), budget_ms=F.lit(budget_ms))
    return out.withColumn("error", F.when(F.col("timed_out"), late))
