"""Incremental ingest: new files of a folder become source rows, once each."""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import fixed as fx
from ..operators import transport
from ..plans import clean_batch
from ..sources import state
from ..sources.files import decoded
from ..sources.sinks import write_version


def source_stream(spark: SparkSession, folder: str, max_bytes: int = fx.MAX_FILE_BYTES) -> DataFrame:
    """A stream of Markdown files as source rows. Spark's file source leaves out names that start with _ or . and takes a path once."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    raw = spark.readStream.schema(schema).format("binaryFile").option("pathGlobFilter", "*.[mM][dD]").option("recursiveFileLookup", "true").load(folder)
    name = F.regexp_extract("path", r"([^/]*)\z", 1)
    kept = raw.where(~F.lower(name).endswith("_cleaned.md"))
    text = F.when(F.col("length") <= max_bytes, decoded("content"))
    error = F.when(F.col("length") > max_bytes, "the file is too large").when(text.isNull(), "no codec reads the file")
    return kept.select(F.col("path").alias("rel_path"), F.col("length").alias("size"), F.sha2("content", 256).alias("source_sha256"), text.alias("text"), F.length(text).alias("source_chars"), error.alias("plan_error"))


def ingest(spark: SparkSession, folder: str, table_path: str, checkpoint: str) -> StreamingQuery:
    """Append all files that are new since the last call to a Parquet table, then stop."""
    return source_stream(spark, folder).writeStream.format("parquet").option("path", table_path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


#: What stands before a path in the names of Spark's file source.
SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def clean_new_files(spark: SparkSession, folder: str, config: clean_batch.Config, how: transport.Transport, checkpoint: str) -> StreamingQuery:
    """Clean the files of a folder that are new since the last call, each text once under whatever names it comes, then stop.

    State is keyed by the content's hash: within a call a hash goes on under its first path, and hashes of earlier calls
    are told by a table beside the store. Files that fail count as seen (retry their batch), those that a stop left pending
    do not. A micro-batch is one run of the batch job; one that is repeated after a death
    finds its hashes unmarked and its paid replies in the store, so nothing is sent or published twice.
    """
    base = re.sub(SCHEME, "", folder.rstrip("/")) if re.match(SCHEME, folder) else str(Path(folder).resolve())
    seen, schema = f"{config.store}/content_seen", "source_sha256 string, rel_path string"

    def clean(rows: DataFrame, number: int) -> None:
        known = state.current(spark, seen, schema, ["source_sha256"], ["source_sha256"])
        named = rows.withColumn("rel_path", F.substring(F.regexp_replace("rel_path", SCHEME, ""), len(base) + 2, 1 << 20))
        first = named.groupBy("source_sha256").agg(F.min_by(F.struct(*[c for c in named.columns if c != "source_sha256"]), F.struct(F.lower("rel_path"), "rel_path")).alias("r"))
        fresh = first.select("source_sha256", "r.*").join(known, "source_sha256", "left_anti").select(*named.columns)
        if fresh.isEmpty():
            return
        done = clean_batch.run(spark, fresh, config, how)
        ended = done["files"].where(F.col("status").isin("succeeded", "skipped", "failed")).select("source_sha256", F.col("path").alias("rel_path"))
        write_version(ended, seen, clean_batch.new_batch_id())
        state.compact(spark, seen, schema, ["source_sha256"])

    return source_stream(spark, folder).writeStream.foreachBatch(clean).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
