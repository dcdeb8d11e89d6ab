"""Figures about chunks: counts, sizes, integrity, and the export of parents with their children."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folio.functions import text as T


def chunk_summary(docs: DataFrame, parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """A-2: files, parents, children and their averages a file, rounded to two places."""
    per = docs.select(key).unionAll(docs.select(key).limit(0)).groupBy(key).agg(F.count("*").alias("d"))
    counted = per.join(parents.groupBy(key).agg(F.count("*").alias("p")), key, "left").join(children.groupBy(key).agg(F.count("*").alias("c")), key, "left")
    files = F.count("*")
    return counted.agg(
        files.alias("files"), F.coalesce(F.sum("p"), F.lit(0)).alias("parents"), F.coalesce(F.sum("c"), F.lit(0)).alias("children"),
        F.coalesce(F.round(F.try_divide(F.sum("p"), files), 2), F.lit(0.0)).alias("parents_per_file"), F.coalesce(F.round(F.try_divide(F.sum("c"), files), 2), F.lit(0.0)).alias("children_per_file"),
    )


def token_stats(children: DataFrame) -> DataFrame:
    """A-4, over children with tokens."""
    return children.filter("token_count > 0").agg(F.count("*").alias("n"), F.round(F.avg("token_count"), 4).alias("avg_tokens"), F.min("token_count").alias("min_tokens"), F.max("token_count").alias("max_tokens"))


def integrity(parents: DataFrame, children: DataFrame) -> DataFrame:
    """A-5: share of valid parent references, paths and sizes, as a score with its grade; null without children."""
    known = parents.select(F.col("chunk_id").alias("parent_chunk_id"), F.lit(True).alias("known"))
    c = children.join(known, "parent_chunk_id", "left")
    good = lambda x: F.count_if(F.coalesce(x, F.lit(False)))
    sums = c.agg(F.count("*").alias("children"), good(F.col("known")).alias("valid_parents"), good(F.col("section_path") != "").alias("valid_paths"), good(F.col("token_count") > 0).alias("valid_tokens"), F.count_if(F.col("known").isNull()).alias("orphans"))
    score = F.try_divide(F.col("valid_parents") + F.col("valid_paths") + F.col("valid_tokens"), 3 * F.col("children")) * 100
    return sums.withColumn("score", F.round(score, 4)).withColumn("grade", F.when(F.col("score") >= 95, "excellent").when(F.col("score") >= 85, "good").when(F.col("score") >= 70, "fair").when(F.col("score").isNotNull(), "poor"))


def children_per_header(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """A-6: children of each parent by shortened header; of parents with the same one the last counts."""
    n = children.groupBy("parent_chunk_id").agg(F.count("*").alias("n"))
    label = F.when(F.length("title") > 30, F.concat(F.left("title", F.lit(30)), F.lit("..."))).otherwise(F.col("title"))
    rows = parents.join(n.withColumnRenamed("parent_chunk_id", "chunk_id"), "chunk_id", "left").withColumn("header", label)
    return rows.groupBy(key, "header").agg(F.max_by(F.coalesce("n", F.lit(0).cast("long")), "section_no").alias("children"))


def parent_export(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """J-9: parents with the ids of their children in order, and their number."""
    ids = children.groupBy("parent_chunk_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("chunk_index", "chunk_id"))), lambda x: x["chunk_id"]).alias("child_chunk_ids"))
    rows = parents.join(ids.withColumnRenamed("parent_chunk_id", "chunk_id"), "chunk_id", "left")
    found = F.coalesce("child_chunk_ids", F.array().cast("array<string>"))
    return rows.select(key, "chunk_id", F.col("title").alias("header"), "level", "section_path", "start_line", "end_line", "token_count", found.alias("child_chunk_ids"), F.size(found).cast("long").alias("child_count"))


def chunk_lookup(parents: DataFrame, children: DataFrame, chunk_id: str) -> DataFrame:
    """F-14, SET-3: the chunk with the id, a parent before a child."""
    both = parents.select("chunk_id", "page_content", F.lit(0).alias("kind")).unionByName(children.select("chunk_id", "page_content", F.lit(1).alias("kind")))
    return both.filter(F.col("chunk_id") == chunk_id).orderBy("kind").limit(1)


def orphans(parents: DataFrame, children: DataFrame) -> DataFrame:
    """J-5: children whose parent is missing."""
    return children.join(parents.select(F.col("chunk_id").alias("parent_chunk_id")), "parent_chunk_id", "left_anti")


def corpus_summary(docs: DataFrame, parents: DataFrame, children: DataFrame, key: str, stem: str, configuration: dict) -> DataFrame:
    """A-2 whole: chunk_summary with the distinct stems of the documents, in order, and the configuration of the chunker as JSON."""
    stems = docs.agg(F.array_sort(F.collect_set(F.when(F.col(stem) != "", F.col(stem)))).alias("unique_stems"))
    settings = F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in configuration.items()])).alias("configuration")
    return chunk_summary(docs, parents, children, key).crossJoin(F.broadcast(stems)).withColumn("configuration", settings)  # one row each


def document_counts(docs: DataFrame, parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """A-3, A-4: parents, children and children a parent of each document; zeros for a document without chunks."""
    p, c = (x.groupBy(key).agg(F.count("*").alias(n)) for x, n in ((parents, "total_parents"), (children, "total_children")))
    rows = docs.select(key).join(p, key, "left").join(c, key, "left").na.fill(0, ["total_parents", "total_children"])
    return rows.withColumn("children_per_parent", F.coalesce(F.round(F.try_divide("total_children", "total_parents"), 1), F.lit(0.0)))


def with_header(parents: DataFrame, wanted: str) -> DataFrame:
    """F-13: the parents whose title has the wanted text, in either case."""
    return parents.filter(F.lower("title").contains(wanted.lower()))


def first_parents(parents: DataFrame, key: str, n: int) -> DataFrame:
    """S-5: the first n parents of each document."""
    return parents.withColumn("place", F.row_number().over(W.partitionBy(key).orderBy("section_no"))).filter(F.col("place") <= n).drop("place")


def warning_histogram(logs: DataFrame, key: str, text: str) -> DataFrame:
    """A-15: of each key its distinct warning lines, without blanks at their ends, and how often each came."""
    lines = logs.select(key, F.explode(T.lines(F.col(text))).alias("line")).select(key, T.strip(F.col("line")).alias("warning"))
    return lines.filter("warning <> ''").groupBy(key, "warning").agg(F.count("*").alias("n"))
