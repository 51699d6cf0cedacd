"""Sinks: event log with redaction, versioned tables, Markdown export."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx


#: Of stored tables: texts take about three quarters of what Spark's default makes of them.
COMPRESSION = "zstd"


def log_rows(df: DataFrame, file: str, status: str, detail: str, more: tuple[str, ...] = ()) -> DataFrame:
    """Event rows with secrets masked: time, file, status, detail, and more columns as they are."""
    return df.select(*more, F.current_timestamp().alias("time"), tx.redact(file).alias("file"), F.col(status).alias("status"), tx.compact_error(detail).alias("detail"))


def append_log(events: DataFrame, path: str) -> None:
    events.write.mode("append").option("ignoreNullFields", "false").json(path)


def write_version(df: DataFrame, root: str, version: str) -> str:
    """A table version of its own. Readers take the newest rows of all versions, so a failed run leaves the last state."""
    path = f"{root.rstrip('/')}/version={version}"
    df.write.mode("errorifexists").option("compression", COMPRESSION).parquet(path)
    return path


def read_versions(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """All versions of a table with their version (ids ascend with time); an empty table where there is none.

    A version shows its files when its job commits. What is there is listed now, so later versions do not appear.
    """
    schema = f"{schema}, version string"
    try:
        return spark.read.schema(schema).option("basePath", root).parquet(f"{root.rstrip('/')}/version=*")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def newest(versions: DataFrame, keys: list[str], keep_version: bool = False) -> DataFrame:
    """The row of the newest version for each combination of keys (nulls are equal)."""
    others = [c for c in versions.columns if c not in (*keys, "version")]
    rows = versions.groupBy(*keys).agg(F.max_by(F.struct(*others), "version").alias("r_"), F.max("version").alias("version"))
    held = [F.col(c) if c in keys else F.col("version") if c == "version" else F.col(f"r_.{c}").alias(c) for c in versions.columns if c != "version" or keep_version]
    return rows.select(*held)


def export_documents(finals: DataFrame, folder: str) -> DataFrame:
    """Write each document to <folder>/<its own folder>/<name>_cleaned.md, by rename; one row with the path for each.

    The folder must be shared by the executors; a repeated task writes the same bytes to the same name.
    """
    named = finals.select("rel_path", F.regexp_extract("rel_path", r"\A(.*/)?[^/]*\z", 1).alias("parent"), tx.output_dir_name("rel_path").alias("dir"), tx.final_name("rel_path").alias("name"), F.col("text").alias("body"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = []
            for rel, parent, sub, name, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                target = Path(folder) / (parent or "") / sub / name
                if not target.resolve().is_relative_to(Path(folder).resolve()):
                    raise ValueError(f"{rel} leaves the output folder")
                target.parent.mkdir(parents=True, exist_ok=True)
                handle, temporary = tempfile.mkstemp(dir=target.parent)
                with os.fdopen(handle, "w", encoding="utf-8", newline="") as f:
                    f.write(body)
                    f.flush()
                    os.fsync(f.fileno())
                os.replace(temporary, target)
                done.append((rel, str(target)))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*done, strict=True)] if done else [pa.array([], pa.string())] * 2, names=["rel_path", "path"])

    return named.mapInArrow(write, "rel_path string, path string")
