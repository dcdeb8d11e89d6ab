"""R-12: errors as data. A row that fails carries an error struct; the rows of a job go on, and those with errors go to a dead-letter table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The classes of errors, each with the one that it is a kind of.
PARENTS = {
    "PipelineError": None,
    "ConfigurationError": "PipelineError",
    "FaultToleranceConfigurationError": "ConfigurationError",
    "DocumentError": "PipelineError",
    "DocumentTooLargeError": "DocumentError",
    "EngineError": "PipelineError",
    "EngineStartupError": "EngineError",
    "EngineTimeoutError": "EngineError",
    "CircuitBreakerOpenError": "EngineError",
    "EngineFallbackExhaustedError": "EngineError",
    "GPUError": "PipelineError",
    "GPUNotAvailableError": "GPUError",
    "CheckpointError": "PipelineError",
    "CheckpointCorruptedError": "CheckpointError",
    "FigureSummarizationError": "PipelineError",
    "FigurePoisonPillError": "FigureSummarizationError",
    "AssemblyError": "PipelineError",
    "TokenResolutionTimeoutError": "AssemblyError",
    "DocumentChunkerError": None,
    "ChunkingError": "DocumentChunkerError",
    "ValidationError": "DocumentChunkerError",
    "FileError": "DocumentChunkerError",
}
ERROR = "struct<class:string,message:string,context:map<string,string>>"


def lineage(kind: str) -> list[str]:
    """The class and what it is a kind of, nearest first."""
    out = [kind]
    while PARENTS[out[-1]]:
        out.append(PARENTS[out[-1]])
    return out


def error(kind: str, message: str | Column, **context: Column) -> Column:
    """An error struct; context keeps what is not null of the named values, as text."""
    lineage(kind)  # an unknown class is a mistake of the caller
    pairs = [F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in context.items()]
    kept = F.filter(F.array(*pairs), lambda x: x["value"].isNotNull()) if pairs else F.array().cast("array<struct<key:string,value:string>>")
    return F.struct(F.lit(kind).alias("class"), (F.lit(message) if isinstance(message, str) else message).alias("message"), F.map_from_entries(kept).alias("context")).cast(ERROR)


def no_error() -> Column:
    return F.lit(None).cast(ERROR)


def first_error(*found: Column) -> Column:
    """The first that is not null: what is checked first is what is told."""
    return F.coalesce(*found, no_error())


def is_a(found: Column, kind: str) -> Column:
    """Whether an error is of a class or of one below it; false where there is none."""
    return F.coalesce(found["class"].isin(*[k for k in PARENTS if kind in lineage(k)]), F.lit(False))


def passed(rows: DataFrame) -> DataFrame:
    """The rows without an error, without the column."""
    return rows.filter("error IS NULL").drop("error")


def dead_letters(rows: DataFrame, stage: str, *keys: str) -> DataFrame:
    """The rows with an error: the stage, what names the row (as JSON of keys), class, message, context. All else of the row is left where it is."""
    named = F.to_json(F.struct(*keys)).alias("row_key")
    return rows.filter("error IS NOT NULL").select(F.lit(stage).alias("stage"), named, F.col("error.class").alias("class"), F.col("error.message").alias("message"), F.col("error.context").alias("context"))


def error_rollup(letters: DataFrame) -> DataFrame:
    """A-15 for errors: of each stage and class how many there are, those of the classes below it included."""
    above = F.create_map(*[F.lit(x) for k in PARENTS for x in (k, ",".join(lineage(k)))])
    counts = letters.groupBy("stage", "class").agg(F.count("*").alias("n"))
    kinds = F.split(F.coalesce(F.try_element_at(above, F.col("class")), F.col("class")), ",")
    return counts.select("stage", F.explode(kinds).alias("class"), F.col("class").alias("of"), "n").groupBy("stage", "class").agg(F.sum(F.when(F.col("class") == F.col("of"), F.col("n")).otherwise(0)).alias("own"), F.sum("n").alias("with_kinds"))


def strict(rows: DataFrame) -> DataFrame:
    """passed(rows), for a caller who wants the job to end with the first error."""
    said = F.concat_ws(": ", "error.class", "error.message")
    return rows.filter(F.when(F.col("error").isNull(), True).otherwise(F.raise_error(said).cast("boolean"))).drop("error")
