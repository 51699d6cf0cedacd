"""Helpers shared by the corpus operators: tables, shared storage, small numpy pieces."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words everywhere in this subpackage: space and the controls 9 to 13.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

_LOCAL: dict[str, str] = {}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where it is unset, a folder of this machine serves a local master (tests) only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = _LOCAL.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.gettempdir() + f"/lexgate-{uuid.uuid4().hex}")
    return folder


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keyed_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", null_as_empty: bool = True) -> DataFrame:
    """The two columns that the operators need, whatever else the table holds."""
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.coalesce(text, F.lit("")) if null_as_empty else text).alias("text"))


def row_hash(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """A 64-bit name of a row's id and text: rows that share an id have names of their own, equal rows share one."""
    text = F.col(text_col).cast("string")
    return F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.coalesce(text, F.lit("")), text.isNull())


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores until the table has none of them (letter case aside)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift), for whole arrays."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def run_starts(*columns: np.ndarray) -> np.ndarray:
    """Where a new combination of values starts in columns that are sorted together."""
    n = len(columns[0])
    if not n:
        return np.empty(0, dtype=np.int64)
    new = np.zeros(n, dtype=bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def in_slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of fewer, so that what a worker makes of one batch stays small."""
    for whole in batches:
        for at in range(0, whole.num_rows, rows):
            yield whole.slice(at, rows)


def free_shuffles(spark: SparkSession) -> None:
    """Let the cleaner drop shuffle files of finished steps whose results have been stored."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()
