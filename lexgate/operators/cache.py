"""Content-addressed reuse: joins of pieces with stored results on the identity of the work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed as fx
from ..functions import text as tx

#: What makes two pieces of work the same, but for the prompt, which has aliases.
IDENTITY = ["source_file", "source_sha256", "chunk_sha256", "model", "base_url", "part_number", "total_parts", "strict_validation", "normalization_policy"]


def work_id(columns: list[str] = IDENTITY) -> Column:
    """The identity in one value, for tables that are dealt by it."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).cast("binary"), 256)


def with_identity(chunks: DataFrame, model: str, base_url: str, strict: bool) -> DataFrame:
    """Add the configuration's part of the identity to rows of rel_path, source_sha256 and pieces."""
    return chunks.withColumns({
        "source_file": F.col("rel_path"), "model": F.lit(model), "base_url": F.lit(base_url.rstrip("/")),
        "strict_validation": F.lit(strict), "normalization_policy": F.lit(fx.NORMALIZATION),
    })


def prompt_fits(sha: Column, version: Column, prompt: str, aliases: list[str]) -> Column:
    """The stored prompt is the current one or an alias, and its identity has the current version or none."""
    return sha.isin(prompt, *aliases) & (version.isNull() | (version == fx.PROMPT_VERSION))


def usable(results: DataFrame, prompt: str, aliases: list[str]) -> DataFrame:
    """Stored results whose body is not blank and still has its hash, made with a fitting prompt."""
    sound = ~tx.is_blank("body") & (tx.sha256("body") == F.col("output_sha256"))
    return results.where(sound & prompt_fits(F.col("prompt_sha256"), F.col("prompt_identity_version"), prompt, aliases))


def _same(chunks: DataFrame, results: DataFrame) -> Column:
    out = F.lit(True)
    for c in IDENTITY:
        out &= chunks[c].eqNullSafe(results[c])
    return out


def reusable(chunks: DataFrame, results: DataFrame, prompt: str, aliases: list[str] = ()) -> DataFrame:
    """Pieces that need no call."""
    done = usable(results, prompt, list(aliases)).select(*IDENTITY)
    return chunks.join(done, _same(chunks, done), "left_semi")


def pending(chunks: DataFrame, results: DataFrame, prompt: str, aliases: list[str] = ()) -> DataFrame:
    """Pieces that need a call."""
    done = usable(results, prompt, list(aliases)).select(*IDENTITY)
    return chunks.join(done, _same(chunks, done), "left_anti")


def accepted_candidates(chunks: DataFrame, failed: DataFrame, prompt: str, policy_sha256: str) -> DataFrame:
    """Failed candidates that a user accepts: same identity, prompt and policy, and a body; the body's hash is not checked again."""
    whole = failed.where(~tx.is_blank("body") & (F.col("prompt_sha256") == prompt) & (F.col("quality_policy_sha256") == policy_sha256))
    body = whole.select(*IDENTITY, "body")
    return chunks.join(body, _same(chunks, body)).select(*(chunks[c] for c in chunks.columns), body["body"])


def current_documents(plans: DataFrame, finals: DataFrame, keys: list[str]) -> DataFrame:
    """Plans with is_current: a stored document exists, equals the plan in all keys (null-safe), and its text has its hash."""
    sound = ~tx.is_blank("text") & (tx.sha256("text") == F.col("output_sha256"))
    stored = finals.select("rel_path", *(F.col(k).alias(f"f_{k}") for k in keys), sound.alias("sound_"))  # texts stay where they are
    same = F.col("sound_")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"f_{k}"))
    return plans.join(stored, "rel_path", "left").withColumn("is_current", F.coalesce(same, F.lit(False))).select(*plans.columns, "is_current")
