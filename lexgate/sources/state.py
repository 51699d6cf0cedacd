"""State of a store: versions of tables, snapshots that fold them, and marks that are written once.

A table is a folder of versions (version=<id>, ids ascend with time, each the output of one job) and snapshots (snapshot=<id>, the
newest row of each key over all versions up to that id). Readers take the last whole snapshot and the few versions
after it, as they are when they ask, so a writer never changes what a reader sees. One run at a time writes to a
store (claim), so no version appears before a snapshot that folds its time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .sinks import COMPRESSION, newest, write_version

#: Versions after a snapshot from which on the next one is due.
MOST_VERSIONS = 8


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _place(spark, path)
    return fs.exists(place)


def mark(spark: SparkSession, path: str, text: str = "") -> bool:
    """Write a small file unless there is one; whether it was written. Of many that try at once, one succeeds."""
    fs, place = _place(spark, path)
    try:
        out = fs.create(place, False)
    except Py4JJavaError as e:
        if "exist" in str(e.java_exception).lower():
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def marked(spark: SparkSession, path: str) -> str | None:
    """What a mark says; None where there is none."""
    fs, place = _place(spark, path)
    if not fs.exists(place):
        return None
    stream = fs.open(place)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return text


def unmark(spark: SparkSession, path: str) -> None:
    fs, place = _place(spark, path)
    fs.delete(place, False)


def _listed(spark: SparkSession, root: str) -> list[str]:
    fs, place = _place(spark, root)
    return sorted(s.getPath().getName() for s in fs.listStatus(place) if s.isDirectory()) if fs.exists(place) else []


def committed(spark: SparkSession, root: str) -> tuple[str | None, list[str]]:
    """The last whole snapshot's folder and the whole versions after it, oldest first."""
    root, names = root.rstrip("/"), _listed(spark, root)
    whole = lambda name: exists(spark, f"{root}/{name}/_SUCCESS")
    snapshot = next((n for n in reversed(names) if n.startswith("snapshot=") and whole(n)), None)
    upto = _id_of(snapshot) if snapshot else ""
    return snapshot, [n for n in names if n.startswith("version=") and _id_of(n) > upto and whole(n)]


def _id_of(folder: str) -> str:
    return folder.split("=", 1)[1].split("@")[0]


def _bucketed(spark: SparkSession, path: str, schema: str, key: str, buckets: int) -> DataFrame:
    """A bucketed snapshot under a name in this session's catalog, which is how Spark learns its buckets."""
    name = "state_" + hashlib.md5(path.encode()).hexdigest()[:20]
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def nothing(spark: SparkSession, schema: str) -> DataFrame:
    """A table without rows, of which the planner knows it: joins with it fall away before they run."""
    return spark.createDataFrame([], schema).where(F.lit(False))


def current(spark: SparkSession, root: str, schema: str, keys: list[str], columns: list[str] | None = None, keep_version: bool = False) -> DataFrame:
    """The newest row of each key (nulls are equal), with these columns only (all without).

    Columns that are not asked for are not read, so keys are told apart without the bodies that stand beside them. With
    no version after the snapshot nothing is folded, and a bucketed snapshot keeps its buckets.
    """
    root = root.rstrip("/")
    snapshot, later = committed(spark, root)
    with_version = f"{schema}, version string"
    wanted = [*dict.fromkeys([*keys, *(columns or [c.split()[0] for c in re.split(r",\s*", schema)])])]
    rows = None
    if later:
        rows = spark.read.schema(with_version).option("basePath", root).parquet(*(f"{root}/{n}" for n in later)).select(*wanted, "version")
    if snapshot:
        buckets = snapshot.split("@")[1].split(",") if "@" in snapshot else None
        path = f"{root}/{snapshot}"
        old = _bucketed(spark, path, with_version, buckets[0], int(buckets[1])) if buckets else spark.read.schema(with_version).parquet(path)
        old = old.select(*wanted, "version")
        if rows is None:
            return old if keep_version else old.drop("version")
        rows = rows.unionByName(old)
    if rows is None:
        rows = nothing(spark, with_version).select(*wanted, "version")
    return newest(rows, keys, keep_version)


def compact(spark: SparkSession, root: str, schema: str, keys: list[str], most: int = MOST_VERSIONS, bucket: tuple[str, int] | None = None) -> bool:
    """Fold versions into a new snapshot where more than `most` have come since the last; whether one was written.

    bucket names a column and a number of buckets, by which the snapshot is dealt and sorted, so that joins on the column
    read it as it lies.
    """
    _, later = committed(spark, root)
    if len(later) <= most:
        return False
    root = root.rstrip("/")
    rows = current(spark, root, schema, keys, keep_version=True)
    if bucket is None:
        rows.write.option("compression", COMPRESSION).parquet(f"{root}/snapshot={_id_of(later[-1])}")
        return True
    key, n = bucket
    path = f"{root}/snapshot={_id_of(later[-1])}@{key},{n}"
    name = "written_" + hashlib.md5(path.encode()).hexdigest()[:20]
    rows.repartition(n, key).write.format("parquet").option("compression", COMPRESSION).bucketBy(n, key).sortBy(key).option("path", path).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the name only; the files lie at the path
    return True


# ---- one writer, and a way to stop it


def claim(spark: SparkSession, store: str, run: str) -> None:
    """Take a store for a run; ValueError where another run has it."""
    path = f"{store}/marks/claim"
    if not mark(spark, path, run):
        raise ValueError(f"run {marked(spark, path)} has this store; release it if that run has died")


def release(spark: SparkSession, store: str) -> None:
    """Give a store free, whoever has it."""
    unmark(spark, f"{store}/marks/claim")


def stop(spark: SparkSession, store: str) -> bool:
    """Ask the run that has the store to end after its wave; False where none has it."""
    run = marked(spark, f"{store}/marks/claim")
    if run:
        mark(spark, f"{store}/marks/stop-{run}")
    return bool(run)


def stop_asked(spark: SparkSession, store: str, run: str) -> bool:
    return exists(spark, f"{store}/marks/stop-{run}")


def finish(spark: SparkSession, store: str, run: str) -> None:
    mark(spark, f"{store}/marks/done-{run}")


def unfinished(spark: SparkSession, store: str, root: str) -> list[str]:
    """Version folders of a table that runs without an end have left; a version is named <run>.<step>."""
    snapshot, later = committed(spark, root)
    done: dict[str, bool] = {}
    for name in later:
        run = _id_of(name).split(".")[0]
        if run not in done:
            done[run] = exists(spark, f"{store}/marks/done-{run}")
    return [n for n in later if not done[_id_of(n).split(".")[0]]]


def stored_version(df: DataFrame, root: str, version: str) -> DataFrame:
    """Write a version and read it back."""
    return df.sparkSession.read.schema(df.schema).parquet(write_version(df, root, version))


#: Spark's setting by which a query's shuffle files go when it has ended, and not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def without_shuffle_files(spark: SparkSession) -> Iterator[None]:
    """Queries that are made inside leave no shuffle files behind."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
