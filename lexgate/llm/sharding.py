"""Sharding by sampled splitters: size-weighted key samples, quantile boundaries, range partitions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import documents, stored

#: Ranges that a shard starts with at least, rows of a range at most, about, and splitter samples drawn for a range.
RANGES_PER_SHARD = 8
RANGE_ROWS = 4_000_000
SAMPLES_PER_RANGE = 50
#: A range with more than this many times the mean bytes is divided again.
OVERFULL = 1.75
#: How far shards may differ for the sake of whole groups: a group of equal texts up to this share of a shard is not
#: cut at a boundary, so each boundary moves by half of it at most. A larger group is cut where the boundary falls.
WHOLE_GROUP = 0.1
_LEAST = -(2**63)


def _range_of(bounds: list[tuple[int, int]]):
    """Vectorised lookup of (key, row) among the boundaries; boundary i is the first key of range i + 1."""
    keys = np.array([b[0] for b in bounds], dtype=np.int64)
    ids = np.array([b[1] for b in bounds], dtype=np.int64)

    @F.pandas_udf("int")
    def lookup(key: pd.Series, row: pd.Series) -> pd.Series:
        k, d = key.to_numpy(np.int64), row.to_numpy(np.int64)
        low, high = np.searchsorted(keys, k, "left"), np.searchsorted(keys, k, "right")
        out = low.copy()
        for i in np.flatnonzero(low < high):
            out[i] = low[i] + np.searchsorted(ids[low[i] : high[i]], d[i], "right")
        return pd.Series(out.astype(np.int32))

    return lookup


def _draw(rows: DataFrame, total: int, wanted: int, seed: int) -> list[tuple[int, int, float]]:
    """About `wanted` keys, each row with a chance in proportion to its size; a row over one share counts several times.

    The chance is drawn for the row's number, so rows of one id or one text are drawn each for itself.
    """
    rate = F.col("size") * F.lit(float(wanted) / max(total, 1))
    unit = (F.xxhash64("row", F.lit(seed)).bitwiseAND(F.lit((1 << 52) - 1))) / F.lit(float(1 << 52))
    drawn = rows.where(unit < rate).select("key", "row", F.greatest(rate, F.lit(1.0)).alias("w"))
    return sorted((r["key"], r["row"], r["w"]) for r in drawn.collect())  # about `wanted` rows, whatever the table's size


def _quantiles(sample: list[tuple[int, int, float]], parts: int) -> list[tuple[int, int]]:
    if not sample or parts < 2:
        return []
    total, at, cum, bounds = sum(s[2] for s in sample), 1, 0.0, []
    for key, row, w in sample:
        cum += w
        while at < parts and cum >= total * at / parts:
            bounds.append((key, row))
            at += 1
    return bounds


def _whole_groups(bounds: set[tuple[int, int]]) -> list[tuple[int, int]]:
    """Only a key that fills ranges by itself is cut inside; other boundaries move to the start of their group."""
    times: dict[int, int] = {}
    for k, _ in bounds:
        times[k] = times.get(k, 0) + 1
    return sorted({(k, d if times[k] > 1 else _LEAST) for k, d in bounds})


def shard_by_splitters(docs: DataFrame, n_shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Put each row into one of n_shards by ranges of a content key; bytes are near equal.

    The key is a hash of the text, then the row's place in the stored table, so equal texts are neighbours and stay
    in one shard unless their group exceeds WHOLE_GROUP of a shard. Splitters are quantiles of a
    size-weighted sample of SAMPLES_PER_RANGE keys for each range; exact sizes of the ranges are then taken from
    all rows, overfull ranges are divided by fresh samples of their own rows until none is left that
    can be divided, and running sizes inside the ranges cut the shards exactly. Returns doc_id, size,
    text_crc32, shard, slot.

    Null text: size 8, checksum 0, as an empty text. Ids, null and repeated ones too, take no part in the
    order; each row has a slot of its own. An empty table gives no rows. Extra columns are ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = stored(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            F.monotonically_increasing_id().alias("row"),
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
            F.xxhash64(text).alias("key"),
        ),
        "shard-rows",
    )
    total, count = rows.agg(F.sum("size"), F.count("*")).first()
    total = total or 0
    ranges = max(n_shards * RANGES_PER_SHARD, count // RANGE_ROWS)
    bounds = set(_quantiles(_draw(rows, total, ranges * SAMPLES_PER_RANGE, 1), ranges))
    target, turn, idle = max(1.0, total / ranges), 0, 0
    while True:
        cuts = _whole_groups(bounds)
        placed = rows.withColumn("range", _range_of(cuts)("key", "row")) if cuts else rows.withColumn("range", F.lit(0))
        sizes = {r.range: r for r in placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"), F.max("size").alias("most")).collect()}
        full = [r.range for r in sizes.values() if r.bytes > OVERFULL * target and r.n > 1 and r.bytes > 2 * r.most]
        if not full:
            break
        inside = placed.join(F.broadcast(spark.createDataFrame([(r,) for r in full], "range int")), "range")  # ranges, not rows
        weight, turn = sum(sizes[r].bytes for r in full), turn + 1
        sample = _draw(inside, weight, SAMPLES_PER_RANGE * 8 * len(full), 1 + turn)
        edges = [(_LEAST, _LEAST), *cuts]
        for r in full:
            low, high = edges[r], edges[r + 1] if r + 1 < len(edges) else (2**63 - 1, 2**63 - 1)
            own = [s for s in sample if low <= s[:2] < high]
            bounds |= set(_quantiles(own, 1 + int(np.ceil(sizes[r].bytes / target))))
        idle = idle + 1 if _whole_groups(bounds) == cuts else 0
        if idle == 8:  # eight draws found no row to divide at: such a range only makes a larger task
            break
    before_bytes, before_rows, b, n = {}, {}, 0, 0
    for r in sorted(sizes):
        before_bytes[r], before_rows[r] = b, n
        b, n = b + sizes[r].bytes, n + sizes[r].n
    starts = spark.createDataFrame([(r, before_bytes[r]) for r in sizes] or [(0, 0)], "range int, before long")
    # one row for each range: their number is bounded by n_shards and one for RANGE_ROWS rows
    placed = placed.join(F.broadcast(starts), "range")
    order = Window.partitionBy("range").orderBy("key", "row")
    group = Window.partitionBy("range", "key")
    share = max(1.0, total / n_shards)
    placed = placed.withColumn("at", F.col("before") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size"))
    placed = placed.withColumn("group_bytes", F.sum("size").over(group)).withColumn("group_at", F.min("at").over(group))
    middle = F.when(F.col("group_bytes") <= share * WHOLE_GROUP, F.col("group_at") + F.col("group_bytes") / 2).otherwise(F.col("at") + F.col("size") / 2)
    placed = placed.withColumn("shard", F.least(F.floor(middle / F.lit(share)), F.lit(n_shards - 1)).cast("int"))
    in_range = Window.partitionBy("range", "shard").orderBy("key", "row")
    placed = stored(placed.select("doc_id", "size", "text_crc32", "range", "shard", F.row_number().over(in_range).alias("rn")), "shard-placed")
    counts = sorted((r["shard"], r["range"], r["n"]) for r in placed.groupBy("shard", "range").agg(F.count("*").alias("n")).collect())
    offsets, last, seen = [], None, 0
    for shard, rng, k in counts:
        seen = 0 if shard != last else seen
        offsets.append((shard, rng, seen))
        last, seen = shard, seen + k
    table = spark.createDataFrame(offsets or [(0, 0, 0)], "shard int, range int, skip long")
    return placed.join(F.broadcast(table), ["shard", "range"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("rn") - 1 + F.col("skip")).cast("long").alias("slot")
    )


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near-equal bytes; rows as in shard_by_splitters."""
    out = shard_by_splitters(documents(spark, sf_dir), 24)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
