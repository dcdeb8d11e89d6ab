"""SRC-12, SNK-6, U-8: the ledger of conversion jobs: which windows of pages are done, as JSON by job, in a versioned table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.operators.errors import error, first_error
from folio.operators.windows import resume_plan
from folio.sources.versioned import VersionedTable

#: Fixed value: the only schema version that is read.
SCHEMA_VERSION = 1
WINDOW = "struct<window_index:long,start_page:long,end_page:long,result_dir:string,engine_used:string,backend_used:string,completed_at:string>"
STATE = f"schema_version long, job_id string, last_completed_page long, engine_snapshot struct<engine:string,backend:string,failures_since_last_success:long>, completed_windows array<{WINDOW}>"


def checkpoint_states(windows: DataFrame) -> DataFrame:
    """job_id, state: the JSON of each job's windows (job_id, window_index, start_page, end_page, result_dir, engine_used, backend_used, completed_at)."""
    one = F.struct("window_index", "start_page", "end_page", "result_dir", "engine_used", "backend_used", "completed_at")
    jobs = windows.groupBy(F.col("job_id").cast("string").alias("job_id")).agg(F.array_sort(F.collect_list(one)).alias("w"))
    last = F.element_at("w", -1)
    snapshot = F.struct(last["engine_used"].alias("engine"), last["backend_used"].alias("backend"), F.lit(0).cast("long").alias("failures_since_last_success"))
    state = F.struct(F.lit(SCHEMA_VERSION).alias("schema_version"), "job_id", last["end_page"].alias("last_completed_page"), snapshot.alias("engine_snapshot"), F.col("w").alias("completed_windows"))
    return jobs.select("job_id", F.to_json(state).alias("state"))


def parsed(states: DataFrame) -> DataFrame:
    """job_id, state as JSON to the struct checkpoint and the error of those that can't be used. Nothing is guessed of a state that can't be read whole."""
    rows = states.withColumn("checkpoint", F.from_json("state", STATE))
    c = F.col("checkpoint")
    version = F.coalesce(c["schema_version"], F.lit(SCHEMA_VERSION))  # a state without one is of the first
    windows = F.coalesce(c["completed_windows"], F.array().cast(f"array<{WINDOW}>"))
    sound = F.forall(windows, lambda w: (w["window_index"] >= 0) & (w["start_page"] >= 1) & (w["end_page"] >= 1) & w["result_dir"].isNotNull() & w["engine_used"].isNotNull())
    whole = F.try_parse_json("state").isNotNull() & c["job_id"].isNotNull() & c["engine_snapshot"]["engine"].isNotNull() & (F.coalesce(c["last_completed_page"], F.lit(0)) >= 0) & F.coalesce(sound, F.lit(False))
    broken = F.when(~F.coalesce(whole, F.lit(False)), error("CheckpointCorruptedError", "the checkpoint can't be read", job_id=F.col("job_id")))
    other = F.when(version != SCHEMA_VERSION, error("CheckpointCorruptedError", "the checkpoint has another schema version", job_id=F.col("job_id"), found_schema_version=version, supported_schema_version=F.lit(SCHEMA_VERSION)))
    mixed_up = F.when(c["job_id"] != F.col("job_id"), error("CheckpointCorruptedError", "the checkpoint is of another job", job_id=F.col("job_id"), found_job_id=c["job_id"]))
    rows = rows.withColumn("error", first_error(broken, other, mixed_up))
    return rows.withColumn("checkpoint", F.when(F.col("error").isNull(), c))


class Ledger:
    """Checkpoints by job. Save, delete and exists act on many jobs at once; the version that a caller has read guards what it writes."""

    def __init__(self, spark: SparkSession, path: str):
        self.table = VersionedTable(spark, path, "job_id string, state string", ["job_id"])

    def version(self) -> int:
        return self.table.version()

    def save(self, states: DataFrame, expected: int | None = None) -> int:
        """Append states (job_id, state). With expected, VersionConflict if the ledger is not at that version any more."""
        return self.table.append(states.filter("state IS NOT NULL"), expected)

    def held(self) -> DataFrame:
        return self.table.latest().filter("state IS NOT NULL")

    def delete(self, jobs: DataFrame, expected: int | None = None) -> int:
        """Forget jobs (job_id). Those without a checkpoint change nothing."""
        known = self.held().join(jobs.select("job_id").distinct(), "job_id", "left_semi")
        return self.table.append(known.withColumn("state", F.lit(None).cast("string")), expected)

    def exists(self, jobs: DataFrame) -> DataFrame:
        """jobs with is_present."""
        return jobs.join(self.held().select("job_id", F.lit(True).alias("is_present")), "job_id", "left").na.fill(False, ["is_present"])

    def load(self, jobs: DataFrame) -> DataFrame:
        """job_id, status (missing, corrupt, ok), checkpoint, error of the distinct jobs. A missing checkpoint is a first run; a corrupt one is an error."""
        rows = jobs.select("job_id").distinct().join(parsed(self.held().select("job_id", "state")), "job_id", "left")
        status = F.when(F.col("error").isNotNull(), "corrupt").when(F.col("checkpoint").isNull(), "missing").otherwise("ok")
        return rows.select("job_id", status.alias("status"), "checkpoint", "error")

    def compact(self) -> int:
        return self.table.compact()


def completed_windows(loaded: DataFrame) -> DataFrame:
    """The windows of the checkpoints that load() gave: job_id, window_index, start_page, end_page, result_dir, engine_used, backend_used."""
    rows = loaded.filter("status = 'ok'").select("job_id", F.explode("checkpoint.completed_windows").alias("w"))
    return rows.select("job_id", *[F.col(f"w.{c}").alias(c) for c in ("window_index", "start_page", "end_page", "result_dir", "engine_used", "backend_used")])


def resume_plans(jobs: DataFrame, ledger: Ledger, present: DataFrame) -> DataFrame:
    """J-8, STR-7: where each job goes on: job_id, status, is_resume, last_completed_page, resume_from_page, discarded_windows, error.

    The leading windows whose results are present count as done; what a checkpoint claims beyond a gap is discarded. Jobs
    with no checkpoint, or a corrupt one, begin at page 1.
    """
    loaded = ledger.load(jobs)
    plan = resume_plan(completed_windows(loaded), present)
    rows = loaded.join(plan, "job_id", "left")
    last: Column = F.coalesce("last_completed_page", F.lit(0)).cast("long")
    return rows.select("job_id", "status", (last > 0).alias("is_resume"), last.alias("last_completed_page"), (last + 1).alias("resume_from_page"), F.coalesce("discarded", F.lit(0)).cast("long").alias("discarded_windows"), "error")
