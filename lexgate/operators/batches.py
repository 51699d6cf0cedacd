"""Batches as tables: status counts, roll-up, selections, transitions, failure runs."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import fixed as fx
from ..functions import text as tx


def status_counts(files: DataFrame, batch: str = "batch_id") -> DataFrame:
    """total and one count for each file status, for each batch."""
    return files.groupBy(batch).agg(F.count("*").alias("total"), *(F.count_if(F.col("status") == s).alias(s) for s in fx.FILE_STATUSES))


def rollup_status(counts: DataFrame, stopped: Column | bool = False) -> DataFrame:
    """Add the batch status and whether it has an end time."""
    stopped = F.lit(stopped) if isinstance(stopped, bool) else stopped
    status = (
        F.when(stopped, "stopped").when(F.col("pending") + F.col("running") + F.col("interrupted") > 0, "incomplete")
        .when(F.col("failed") > 0, "completed_with_failures").otherwise("completed")
    )
    return counts.withColumn("batch_status", status).withColumn("is_complete", F.col("batch_status").startswith("completed"))


def progress(counts: DataFrame) -> DataFrame:
    done = F.col("succeeded") + F.col("skipped") + F.col("failed") + F.col("interrupted")
    return counts.withColumn("percent", tx.progress_percent(done, F.col("total")))


def first_wins(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key."""
    w = Window.partitionBy(key).orderBy(order)
    return rows.withColumn("rn_", F.row_number().over(w)).where("rn_ = 1").drop("rn_")


def resumable(files: DataFrame) -> DataFrame:
    return files.where(F.col("status").isin("pending", "interrupted"))


def retryable(files: DataFrame) -> DataFrame:
    """Failed files in their parent's order, each path once."""
    return first_wins(files.where(F.col("status") == "failed"), "path", "ord")


def not_retryable(requested: DataFrame, files: DataFrame) -> DataFrame:
    """Requested paths (each once) that did not fail in the batch; a retry of such a path is refused."""
    return requested.select("path").distinct().join(files.where(F.col("status") == "failed").select("path"), "path", "left_anti")


def limited(files: DataFrame, n: int) -> DataFrame:
    """The first n files by order, all for 0; applied after files that need no work have gone."""
    return files.orderBy("ord").limit(n) if n > 0 else files


def valid_path(c: Column) -> Column:
    """A relative posix path of a Markdown file that is no cleaned output, without empty, . or .. segments."""
    parts = F.split(c, "/")
    return (
        ~F.contains(c, F.lit("\\")) & ~c.rlike(r"\A(?:/|[A-Za-z]:)") & ~F.exists(parts, lambda p: p.isin("", ".", ".."))
        & F.lower(c).endswith(".md") & ~F.lower(tx.stem(c)).endswith("_cleaned")
    )


def is_batch_id(c: Column) -> Column:
    return c.rlike(fx.BATCH_ID.replace("$", r"\z"))


def faults(files: DataFrame) -> DataFrame:
    """Rows that break the closed schema: unknown status, negative attempts, unsafe or repeated path."""
    repeated = F.count("*").over(Window.partitionBy("batch_id", "path")) > 1
    bad = F.filter(F.array(
        F.when(~F.col("status").isin(fx.FILE_STATUSES), "status"), F.when(F.col("attempts").isNull() | (F.col("attempts") < 0), "attempts"),
        F.when(~valid_path(F.col("path")), "path"), F.when(repeated, "repeated"), F.when(~is_batch_id(F.col("batch_id")), "batch_id"),
    ), lambda f: f.isNotNull())
    return files.withColumn("faults", bad).where(F.size("faults") > 0)


def moved(files: DataFrame, new_status: Column, error: Column, at: Column, where: Column | None = None) -> DataFrame:
    """Files after a change of status: running starts and counts an attempt and clears the error, ends finish, successes clear it.

    Rows outside `where` stay as they are, and so do rows that stay pending.
    """
    ends = new_status.isin("succeeded", "failed", "skipped", "interrupted")
    where = F.lit(True) if where is None else where
    only = lambda new, old: F.when(where, new).otherwise(F.col(old))
    return files.withColumns({
        "attempts": only(F.when(new_status == "running", F.col("attempts") + 1).otherwise(F.col("attempts")), "attempts"),
        "started_at": only(F.when(new_status == "running", at).otherwise(F.col("started_at")), "started_at"),
        "finished_at": only(F.when(ends, at).when(new_status == "running", None).otherwise(F.col("finished_at")), "finished_at"),
        "error": only(F.when(new_status.isin("running", "succeeded", "skipped"), None).when(error.isNotNull(), tx.compact_error(error)).otherwise(F.col("error")), "error"),
        "status": only(new_status, "status"),
    })


def carried(files: DataFrame, previous: DataFrame) -> DataFrame:
    """The files of a batch that goes on: rows of before with their numbers, attempts and times, and the hash of now.

    Running files are interrupted; files that are not worked on again stay as they were.
    """
    now = files.select("path", F.col("source_sha256").alias("sha_"))
    old = resumed(previous).join(now, "path", "left")
    names = [c for c in files.columns if c != "source_sha256"]
    return old.select(*names, F.coalesce("sha_", "source_sha256").alias("source_sha256")).select(*files.columns)


def piece_stats(pieces: DataFrame, judged: DataFrame, replies: DataFrame, key: str = "rel_path") -> DataFrame:
    """total, success, failed and skipped (reused, part of success) pieces of each file; sum them for a batch."""
    total = pieces.groupBy(key).agg(F.count("*").alias("total"))
    good = F.col("failure_stage").isNull()
    seen = judged.groupBy(key).agg(F.count_if(good).alias("success"), F.count_if(~good).alias("refused"), F.count_if(good & ~F.col("fresh")).alias("skipped"))
    lost = replies.groupBy(key).agg(F.count_if(F.col("error").isNotNull() & (F.coalesce("stage", F.lit("")) != "stopped")).alias("lost"))
    x = total.join(seen, key, "left").join(lost, key, "left").fillna(0, ["success", "refused", "skipped", "lost"])
    return x.select(key, "total", "success", (F.col("refused") + F.col("lost")).alias("failed"), "skipped")


def cancelled(files: DataFrame) -> DataFrame:
    """Running files back to pending, as if they had not begun."""
    was = F.col("status") == "running"
    cleared = {c: F.when(~was, F.col(c)) for c in ("error", "started_at", "finished_at")}
    return files.withColumns({"attempts": F.when(was, F.greatest(F.col("attempts") - 1, F.lit(0))).otherwise(F.col("attempts")), **cleared, "status": F.when(was, "pending").otherwise(F.col("status"))})


def resumed(files: DataFrame, message: str = "interrupted by the end of an earlier run") -> DataFrame:
    """Running files of a batch that ended without notice are interrupted."""
    was = F.col("status") == "running"
    return files.withColumns({"error": F.when(was, message).otherwise(F.col("error")), "status": F.when(was, "interrupted").otherwise(F.col("status"))})


def retry_child(files: DataFrame, child_id: str) -> DataFrame:
    """The files of a new batch that retries the failures of another; the parent's rows stay as they are."""
    if not re.fullmatch(fx.BATCH_ID, child_id):
        raise ValueError(f"no batch id: {child_id}")
    fresh = ranked(retryable(files).withColumn("parent_batch_id", F.col("batch_id")), "batch_id", "ord", "rn_")
    return fresh.withColumns({"batch_id": F.lit(child_id), "ord": F.col("rn_"), "status": F.lit("pending"), "error": F.lit(None).cast("string"), "attempts": F.lit(0)}).drop("rn_")


def latest(pointers: DataFrame) -> DataFrame:
    """The batch that was written last."""
    return pointers.agg(F.max_by("batch_id", "updated_at").alias("batch_id"), F.max("updated_at").alias("updated_at"))


#: Rows of one range, about, of what has to be looked at in order.
RANGE_ROWS = 1 << 20


def in_ranges(rows: DataFrame, order: str, per_range: int = RANGE_ROWS, name: str = "range_") -> DataFrame:
    """Rows with the number of their range of a numeric order, so that no task has to hold all rows of a group; boundaries (one a range) come to the driver."""
    number = max(1, -(-rows.count() // per_range))
    cuts = sorted(set(rows.approxQuantile(order, [i / number for i in range(1, number)], 0.1 / number))) if number > 1 else []

    @F.pandas_udf("int")
    def range_of(o: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(np.array(cuts), o.to_numpy(dtype=float), "left").astype(np.int32))

    return rows.withColumn(name, range_of(F.col(order).cast("double")) if cuts else F.lit(0))


def ranked(rows: DataFrame, group: str, order: str, name: str, per_range: int = RANGE_ROWS) -> DataFrame:
    """Add the place of each row in its group, from 0: places inside ranges, and a sum over the ranges before."""
    dealt = in_ranges(rows, order, per_range)
    sizes = dealt.groupBy(group, "range_").agg(F.count("*").alias("n_"))
    before = Window.partitionBy(group).orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(group, "range_", F.coalesce(F.sum("n_").over(before), F.lit(0)).alias("start_"))
    inside = dealt.withColumn("at_", F.row_number().over(Window.partitionBy(group, "range_").orderBy(order)) - 1)
    return inside.join(starts, [group, "range_"]).withColumn(name, F.col("at_") + F.col("start_")).drop("range_", "at_", "start_")


def failure_runs(rows: DataFrame, group: str, order: str, failed: Column, per_range: int = RANGE_ROWS) -> DataFrame:
    """Add run: how many failures in a row end at each row; other rows have 0 and start the count anew.

    Two passes. Ranges of the order are looked at apart, also inside one group; each says how many failures end
    it and whether it holds nothing else. From these few rows follows what each range carries in, which is added to
    the failures at its start. Rows of equal order lie in one range.
    """
    dealt = in_ranges(rows, order, per_range).withColumn("failed_", failed.cast("int"))
    w = Window.partitionBy(group, "range_").orderBy(order)
    dealt = dealt.withColumn("island_", F.sum(1 - F.col("failed_")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    inside = Window.partitionBy(group, "range_", "island_").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    dealt = dealt.withColumn("run_", F.sum("failed_").over(inside))
    ends = dealt.groupBy(group, "range_").agg(F.max_by("run_", F.struct("island_", "run_")).alias("tail_"), F.max("island_").alias("fine_"))
    over = Window.partitionBy(group).orderBy("range_")  # a row for each range of a group
    ends = ends.withColumn("block_", F.sum(F.when(F.col("fine_") > 0, 1).otherwise(0)).over(over.rowsBetween(Window.unboundedPreceding, 0)))
    summed = F.sum("tail_").over(Window.partitionBy(group, "block_").orderBy("range_").rowsBetween(Window.unboundedPreceding, 0))
    ends = ends.withColumn("summed_", summed)
    carried = ends.select(group, "range_", F.coalesce(F.lag("summed_").over(over), F.lit(0)).alias("carry_"))
    out = dealt.join(carried, [group, "range_"])
    run = F.col("run_") + F.when((F.col("island_") == 0) & (F.col("failed_") == 1), F.col("carry_")).otherwise(0)
    return out.withColumn("run", run).select(*rows.columns, "run")


def stop_points(rows: DataFrame, group: str, order: str, failed: Column, limit: int = fx.MAX_FAILURES_IN_A_ROW) -> DataFrame:
    """Where each group would have stopped: the first row that ends `limit` failures in a row."""
    return failure_runs(rows, group, order, failed).where(F.col("run") >= limit).groupBy(group).agg(F.min(order).alias("stop_at"))
