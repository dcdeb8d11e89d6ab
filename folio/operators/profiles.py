"""U-10, J-12: the profile of every file of a scan, by the extractor of its type."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.operators import evidence
from folio.operators.errors import error, first_error, no_error
from folio.sources import files, html, office

#: What makes the profiles of scanned files (job_id, content) of a type; rows with an error have no profile.
EXTRACTORS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "html": lambda rows: html.html_profile(rows.select("job_id", F.col("content").alias("html")), key="job_id"),
    "docx": lambda rows: evidence.docx_profile(office.docx_files(rows)),
    "pptx": lambda rows: evidence.pptx_profile(office.pptx_slides(rows)),
}
SHAPE = ["job_id", "file_type", "page_or_unit_count", "text", "tables", "layout", "visuals", "visual_candidates"]


def profiled(scan: DataFrame, extractors: dict[str, Callable[[DataFrame], DataFrame]] | None = None) -> DataFrame:
    """path, document_type, error, then SHAPE of all files of scan_documents: each type's extractor sees its files only.

    A file that the scan rejected keeps its error. One whose type has no extractor (PDF files need one of the caller's, which
    gives evidence.pdf_profile the pages), whose content can't be read, or that has too many pages has an error and no
    profile. Files of equal content share a profile, which is made once.
    """
    known = EXTRACTORS | (extractors or {})
    rows = scan.filter("error IS NULL").select("job_id", "document_type", "content").dropDuplicates(["job_id", "document_type"])
    found = None
    for kind, extract in known.items():
        some = extract(rows.filter(F.col("document_type") == kind).select("job_id", "content")).select(*SHAPE).withColumn("kind", F.lit(kind))
        found = some if found is None else found.unionByName(some)
    found = files.within_page_limit(found).withColumnRenamed("error", "too_long").drop("reject_reason")
    joined = scan.drop("content").withColumnRenamed("error", "rejected").join(found.withColumnRenamed("kind", "document_type"), ["job_id", "document_type"], "left")
    no_extractor = F.when(~F.col("document_type").isin(*known), error("DocumentError", "no extractor for this type", path=F.col("path"), document_type=F.col("document_type")))
    unread = F.when(F.col("file_type").isNull(), error("DocumentError", "the document can't be read", path=F.col("path"), document_type=F.col("document_type")))
    told = first_error(F.col("rejected"), no_extractor, unread, F.col("too_long"), no_error())
    rest = [F.when(told.isNull(), F.col(c)).alias(c) for c in SHAPE if c != "job_id"]
    return joined.select("path", "job_id", "document_type", told.alias("error"), *rest)
