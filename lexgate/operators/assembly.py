"""Ordered assembly of documents from their pieces, review flags and the gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx
from .validation import drop_repeated_matter

SEPARATOR = "\n\n"


def assemble(results: DataFrame, key: str = "rel_path", part: str = "part_number", total: str = "total_parts", body: str = "body", drop_matter: bool = True, given: str | None = None) -> DataFrame:
    """One row for each document whose parts are all there and not blank: key, part_count, text, part_warnings, parts_review.

    Later parts lose a repeated front matter, parts that get empty by that are left out, and the rest is joined
    in order. `results` may have warnings (array) and review_required. A blank part counts where given, its source, is
    blank and equal; it is left out as well. given is a column with the source, or one that tells whether the two are equal. One shuffle by the key.
    """
    has = set(results.columns)
    later = drop_repeated_matter(body, part) if drop_matter else F.col(body)
    rows = results.select(
        key, F.col(part).alias("n_"), F.col(total).alias("total_"), (~tx.is_blank(body) | _same(results, given, body)).alias("fine_"), later.alias("text_"),
        (F.col("warnings") if "warnings" in has else F.array().cast("array<string>")).alias("w_"),
        (F.col("review_required") if "review_required" in has else F.lit(False)).alias("flag_"),
    )
    done = F.count_if(F.col("fine_"))
    grouped = rows.groupBy(key).agg(
        F.max("total_").alias("part_count"), done.alias("done_"),
        F.sort_array(F.collect_list(F.struct("n_", "text_", "w_"))).alias("parts_"), F.bool_or("flag_").alias("flag_"),
    )
    seen = F.size(F.array_distinct(F.array_compact(F.transform("parts_", lambda p: p["n_"]))))  # a count of distinct values would deal the texts twice
    whole = grouped.where((F.col("done_") == F.col("part_count")) & (seen == F.col("part_count")))
    texts = F.filter(F.transform("parts_", lambda p: p["text_"]), lambda t: ~tx.is_blank(t))
    warned = F.transform(F.filter("parts_", lambda p: F.size(p["w_"]) > 0), lambda p: F.struct(p["n_"].alias("part"), p["w_"].alias("warnings")))
    out = whole.select(key, "part_count", F.array_join(texts, SEPARATOR).alias("text"), warned.alias("part_warnings"), (F.coalesce("flag_", F.lit(False)) | (F.size(warned) > 0)).alias("parts_review"))
    return out.where(~tx.is_blank("text"))


def _same(results: DataFrame, given: str | None, body: str) -> Column:
    if given is None:
        return F.lit(False)
    return F.col(given) if results.schema[given].dataType == T.BooleanType() else F.col(given).eqNullSafe(F.col(body))


def gated(documents: DataFrame, strict: bool, quality: str = "quality") -> DataFrame:
    """Add review_required and status to assembled documents with a quality report."""
    review = F.col(f"{quality}.review_required") | F.col("parts_review")
    return documents.withColumn("review_required", review).withColumn("status", tx.artifact_status("review_required", F.lit(strict)))


def review_queue(finals: DataFrame) -> DataFrame:
    """What people must look at: derived from the documents, so it is in step with them by construction."""
    return finals.where("review_required").select("rel_path", "status", "source_sha256", "output_sha256", "quality", "part_warnings")


def in_review_step(finals: DataFrame, review: DataFrame) -> DataFrame:
    """Documents whose review copy is in step: none where no review is due, otherwise one of the same status, source and output."""
    held = review.select("rel_path", F.col("status").alias("r_status"), F.col("source_sha256").alias("r_source"), F.col("output_sha256").alias("r_output"))
    same = (F.col("r_status") == "review_required") & F.col("r_source").eqNullSafe(F.col("source_sha256")) & F.col("r_output").eqNullSafe(F.col("output_sha256"))
    fine = F.when(F.col("review_required"), F.coalesce(same, F.lit(False))).otherwise(F.col("r_status").isNull())
    return finals.join(held, "rel_path", "left").where(fine).select(*finals.columns)
