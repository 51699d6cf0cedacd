"""MinHash near-duplicates: universal hash minima, bands, exact verification, connected components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import documents, free_shuffles, in_slices, mix64, row_hash, stored, unused
from .components import connected_components, hub_join, with_new_links
from .words import codes_of_texts

#: Hash minima of a set (more only where the threshold needs more bands), the most of a band, and the chance at most that a pair at the threshold shares no band.
MINIMA, ROWS, MISSED = 256, 8, 4e-5
#: Members of a bucket that are compared with all others of other components in the first round, by how much that number grows with
#: each round, and members of either side that one task group takes.
CENTRES, GROWTH, BLOCK = 256, 4, 256
#: Cells of a set's histogram; see signatures().
CELLS = 256
_NULL_ID = -(2**63)
_M = np.uint64(0x9E3779B97F4A7C15)


def _universal(n: int, seed: int = 20240607) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.RandomState(seed)
    return (draw.randint(0, 2**32, n, dtype=np.uint32) | np.uint32(1)), draw.randint(0, 2**32, n, dtype=np.uint32)


def shingle_set(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct codes of all runs of `width` words; a shorter text is one run; no words, no set."""
    if not len(words):
        return np.empty(0, dtype=np.uint64)
    k = min(width, len(words))
    n = len(words) - k + 1
    code = np.full(n, k, dtype=np.uint64)
    for i in range(k):
        code = code * _M + words[i : i + n]
    return np.unique(mix64(code))


def minima(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least value of each universal hash over a set."""
    least = np.full(len(a), 0xFFFFFFFF, dtype=np.uint32)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(x), 256):  # pieces that stay in the cache
        values = np.multiply.outer(x[at : at + 256], a)
        values += b
        np.minimum(least, values.min(axis=0), out=least)
    return least


def banding(percent: int) -> tuple[int, int]:
    """Bands and minima in each, as many in a band as the chance MISSED allows a pair of similarity percent / 100."""
    if not 0 < percent <= 100:
        raise ValueError(f"percent must be in 1 to 100, not {percent}")
    for rows in range(ROWS, 0, -1):
        bands, apart = MINIMA // rows, 1 - (percent / 100) ** rows
        if apart**bands <= MISSED:
            return bands, rows
    return math.ceil(math.log(MISSED) / math.log(1 - percent / 100)), 1


def band_keys(least: np.ndarray, rows: int) -> np.ndarray:
    grid = least.reshape(-1, rows).astype(np.uint64)
    key = np.arange(len(grid), dtype=np.uint64) + np.uint64(1)
    for i in range(grid.shape[1]):
        key = mix64(key * _M + grid[:, i])
    return key.view(np.int64)


def _sets(texts: list[str | None], width: int) -> Iterator[np.ndarray]:
    return (shingle_set(w, width) for w in codes_of_texts([(t or "").encode().lower() for t in texts]))  # bytes.lower() is A-Z only


def histogram(shingles: np.ndarray) -> np.ndarray:
    """Elements in each of CELLS cells of the hash range, 255 at most.

    Two sets differ in as many elements at least as their histograms differ, so a pair whose histograms
    differ by more than the threshold allows is settled without the sets.
    """
    return np.minimum(np.bincount((shingles & np.uint64(CELLS - 1)).astype(np.int64), minlength=CELLS), 255).astype(np.uint8)


def most_difference(n_a, n_b, percent: int):
    """The largest symmetric difference of sets of these sizes with 100 * intersection >= percent * union."""
    return (n_a + n_b) * (100 - percent) / (100 + percent)


def signatures(rows: DataFrame, width: int, bands: int, per_band: int) -> DataFrame:
    """row, doc_id, n (set size), same (128-bit name of the set), bands (keys), cells (histogram), for row, text and doc_id."""
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("same", pa.binary()), ("bands", pa.list_(pa.int64())), ("cells", pa.binary())])
    a, b = _universal(bands * per_band)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            n, same, keys, cells = [], [], [], []
            for shingles in _sets(batch.column(1).to_pylist(), width):
                some = len(shingles) > 0
                n.append(len(shingles))
                same.append(xxhash.xxh3_128_digest(shingles.tobytes()) if some else None)
                keys.append(band_keys(minima(shingles, a, b), per_band) if some else [])
                cells.append(histogram(shingles).tobytes() if some else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(same, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(cells, pa.binary())], schema=schema)

    return rows.select("row", "text", "doc_id").mapInArrow(run, "row long, doc_id long, n long, same binary, bands array<long>, cells binary")


def _may_link(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sizes and histograms allow the similarity."""
    left = sketches.select(F.col("doc_id").alias("a"), F.col("n").alias("n_a"), F.col("cells").alias("cells_a"))
    right = sketches.select(F.col("doc_id").alias("b"), F.col("n").alias("n_b"), F.col("cells").alias("cells_b"))

    @F.pandas_udf("boolean")
    def near(x: pd.Series, y: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
        p = np.frombuffer(b"".join(x), dtype=np.uint8).reshape(-1, CELLS).astype(np.int16)
        q = np.frombuffer(b"".join(y), dtype=np.uint8).reshape(-1, CELLS)
        return pd.Series(np.abs(p - q).sum(axis=1) <= most_difference(n.to_numpy(), m.to_numpy(), percent))

    return pairs.join(right, "b").join(left, "a").where(near("cells_a", "cells_b", "n_a", "n_b")).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b"))

    @F.pandas_udf("boolean")
    def alike(x: pd.Series, y: pd.Series) -> pd.Series:
        out = []
        for p, q in zip(x, y, strict=True):
            p, q = np.frombuffer(p, dtype=np.uint64), np.frombuffer(q, dtype=np.uint64)
            at = np.searchsorted(p, q)
            at[at == len(p)] = 0
            both = int((p[at] == q).sum())
            out.append(100 * both >= percent * (len(p) + len(q) - both))
        return pd.Series(out)

    return pairs.join(right, "b").join(left, "a").where(alike("set_a", "set_b")).select("a", "b").distinct()


def _neighbours(members: DataFrame, percent: int) -> DataFrame:
    """Pairs of each bucket's least member and of neighbours in the order of the next band's key: two for each member."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            bucket, doc, n, head, head_n = (batch.column(i).to_numpy() for i in range(5))
            if not len(bucket):
                continue
            if last is not None:
                bucket, doc, n = (np.append(x, y) for x, y in zip(last, (bucket, doc, n), strict=True))
                head, head_n = np.append(doc[0], head), np.append(n[0], head_n)
            near = bucket[1:] == bucket[:-1]
            a, b = np.append(doc[:-1][near], head), np.append(doc[1:][near], doc)
            n_a, n_b = np.append(n[:-1][near], head_n), np.append(n[1:][near], n)
            fits = (a != b) & (100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b))
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)[fits]), pa.array(np.maximum(a, b)[fits])], schema=schema)
            last = (bucket[-1:], doc[-1:], n[-1:])

    ordered = members.repartitionByRange("bucket", "next", "doc_id").sortWithinPartitions("bucket", "next", "doc_id")
    return ordered.select("bucket", "doc_id", "n", "head", "head_n").mapInArrow(run, "a long, b long").distinct()


def _compared(open_: DataFrame, chosen: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of a chosen member and a member of another component that their histograms allow.

    Members are dealt by hash into blocks of about BLOCK, chosen members by their rank into blocks of BLOCK, and each block of
    either side meets each of the other in a task group of its own, all in one job. A pair counts in the first band that it shares only.
    """
    columns = ["bucket", "block", "turn", "band", "doc_id", "n", "component", "bands", "cells"]
    blocks, turn = F.ceil(F.col("m") / BLOCK).cast("int"), F.floor((F.col("rank") - 1) / BLOCK).cast("int")
    busy = open_.join(chosen.groupBy("bucket").agg(F.max(turn).alias("turns")), "bucket")
    everyone = busy.withColumn("block", F.pmod(F.xxhash64("doc_id"), blocks).cast("int")).withColumn("turn", F.explode(F.sequence(F.lit(0), "turns"))).select(*columns, F.lit(False).alias("centre"))
    centres = open_.join(chosen.select("bucket", "doc_id", turn.alias("turn")), ["bucket", "doc_id"]).withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).select(*columns, F.lit(True).alias("centre"))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        found = [np.empty((0, 2), dtype=np.int64)]
        keys = np.stack(pdf["bands"].to_numpy())
        cells = np.frombuffer(b"".join(pdf["cells"]), dtype=np.uint8).reshape(-1, CELLS).astype(np.int16)
        doc, n, part, centre = (pdf[c].to_numpy() for c in ("doc_id", "n", "component", "centre"))
        rest = np.flatnonzero(~centre)
        for i in np.flatnonzero(centre):
            at = rest[(part[rest] != part[i]) & (100 * np.minimum(n[rest], n[i]) >= percent * np.maximum(n[rest], n[i]))]
            at = at[(keys[at] == keys[i]).argmax(axis=1) == pdf["band"].iloc[0]] if len(at) else at
            if len(at):
                at = at[np.abs(cells[at] - cells[i]).sum(axis=1) <= most_difference(n[at], n[i], percent)]
                found.append(np.stack([np.minimum(doc[at], doc[i]), np.maximum(doc[at], doc[i])], axis=1))
        return pd.DataFrame(np.concatenate(found), columns=["a", "b"])

    # little data, much work: as many tasks as any shuffle has
    parts = int(open_.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return everyone.unionByName(centres).repartition(parts, "bucket", "block", "turn").groupBy("bucket", "block", "turn").applyInPandas(compare, "a long, b long").distinct()


def near_members(docs: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """row (see row_hash), doc_id (null: the least), n, component_id and head of each row: the least (doc_id, row) that is reachable by links."""
    spark = docs.sparkSession
    rows = docs.select(row_hash(id_col, text_col).alias("row"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID)).alias("doc_id"))
    bands, per_band = banding(percent)
    named = stored(signatures(rows, width, bands, per_band), "signatures")
    # nodes are the rows that stand for a class of equal sets; doc_id names them by their row from here on
    classes = named.where("n > 0").groupBy("same").agg(F.min(F.struct("doc_id", "row", "n", "bands", "cells")).alias("r"))
    classes = stored(classes.select("same", F.col("r.doc_id").alias("least"), F.col("r.row").alias("doc_id"), "r.n", "r.bands", "r.cells"), "classes")
    following = F.concat(F.slice("bands", 2, bands - 1), F.slice("bands", 1, 1))
    buckets = classes.select("doc_id", "n", F.posexplode(F.arrays_zip(F.col("bands").alias("bucket"), following.alias("next"))).alias("band", "k"))
    buckets = buckets.select("doc_id", "n", "band", "k.bucket", "k.next")
    busy = buckets.groupBy("bucket").agg(F.count("*").alias("m"), F.min(F.struct("doc_id", "n")).alias("h")).where("m > 1")
    members = stored(buckets.join(busy, "bucket").select("bucket", "band", "next", "doc_id", "n", "m", F.col("h.doc_id").alias("head"), F.col("h.n").alias("head_n")), "members")
    sketches = classes.select("doc_id", "n", "cells")
    wanted = members.select(F.col("doc_id").alias("row")).distinct()
    twice = named.groupBy("row").count().where("count > 1").select("row")  # rows equal in id and text: one set is enough
    chosen = rows.join(wanted.join(twice, "row", "left_anti"), "row", "left_semi").unionByName(rows.join(wanted.join(twice, "row"), "row", "left_semi").dropDuplicates(["row"]))

    def set_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            sets = [s.tobytes() for s in _sets(batch.column(1).to_pylist(), width)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["doc_id", "shingles"])

    sets = stored(chosen.select("row", "text").mapInArrow(set_bytes, "doc_id long, shingles binary"), "sets")
    free_shuffles(spark)
    links = stored(_verified(_may_link(_neighbours(members, percent), sketches, percent), sets, percent), "links")
    labels = stored(connected_components(links), "components")

    def labelled(df: DataFrame, column: str, name: str) -> DataFrame:
        of = labels.select(F.col("node").alias(column), F.col("component").alias("c_"))
        return df.join(of, column, "left").withColumn(name, F.coalesce("c_", column)).drop("c_")

    parts = labelled(members.select("bucket", "doc_id"), "doc_id", "component").groupBy("bucket", "component").agg(F.count("*").alias("k"), F.min("doc_id").alias("d"))
    mixed = parts.groupBy("bucket").agg(F.count("*").alias("parts"), F.max_by("d", F.struct("k", -F.col("d"))).alias("anchor")).where("parts > 1").select("bucket", "anchor")
    short = F.transform("bands", lambda b: b.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")).alias("bands")
    open_ = members.select("bucket", "band", "doc_id", "n", "m").join(mixed, "bucket").join(classes.select("doc_id", short, "cells"), "doc_id")
    open_, most = open_.withColumn("mark", F.lit(None).cast("long")), CENTRES
    while True:
        state = stored(labelled(labelled(open_, "doc_id", "component"), "anchor", "main"), "state")
        order = Window.partitionBy("bucket").orderBy("doc_id")
        chosen = state.where((F.col("component") != F.col("main")) & (F.col("mark").isNull() | (F.col("doc_id") > F.col("mark")))).select("bucket", "doc_id")
        chosen = stored(chosen.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most), "chosen")
        if not chosen.limit(1).count():
            break
        fresh = stored(_verified(_compared(state, chosen, percent), sets, percent), "links")
        if fresh.limit(1).count():
            labels = stored(with_new_links(labels, fresh), "components")
        after = chosen.groupBy("bucket").agg(F.max("doc_id").alias("mark"), F.count("*").alias("k")).where(F.col("k") == most).drop("k")
        most *= GROWTH  # few rounds, however large a bucket is
        open_ = state.drop("component", "main", "mark").join(after, "bucket")
    rooted = labelled(classes.select("same", "doc_id", "least"), "doc_id", "root").select("same", "root", F.struct("least", F.col("doc_id").alias("row")).alias("own"))
    first = rooted.groupBy("root").agg(F.min("own").alias("head"), F.count("*").alias("k"))
    heads = hub_join(rooted.select("same", "root"), first, "root", classes.count()).select("same", "head")
    out = named.select("row", "doc_id", "n", "same").join(heads, "same", "left")
    return out.select("row", "doc_id", "n", F.coalesce("head.least", "doc_id").alias("component_id"), F.coalesce("head.row", "row").alias("head"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups of documents linked by a Jaccard similarity of word shingles of percent / 100 or more.

    Returns doc_id, n_shingles, component_id (the least id that is reachable by links).

    Rows with equal sets are one class with the row of the least id as representative. Representatives meet in
    buckets of equal band keys. First each member is held against the bucket's least member and its
    neighbour in the order of another band. In buckets that then still have several components, the members
    outside the largest one are compared with all members of other components, CENTRES of a bucket in the first round and
    GROWTH times as many in each that follows, until none is left: every pair of a bucket ends in one component or has been compared, and no bucket
    is cut. Bands follow percent, so a pair at the threshold shares none with chance MISSED at most. Links are confirmed on full sets.

    Null or empty text and text without words: an empty set, linked with nothing. Null ids count as the
    least id. Rows that share an id are grouped each by its own text. Extra columns are ignored; an
    empty table gives no rows.
    """
    found = near_members(docs, width, percent, id_col, text_col)
    real = lambda c: F.nullif(F.col(c), F.lit(_NULL_ID))
    return found.select(real("doc_id").alias("doc_id"), F.col("n").alias("n_shingles"), real("component_id").alias("component_id"))


def drop_near_copies(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs without near-duplicates: of each group of near_duplicates the row of the least id stays.

    Null ids count as the least; of several rows of that id the one of the least hash of its text stays, and of
    rows equal in id and text any one. Rows without words all stay. All columns are kept, whatever their names; an
    empty table gives no rows.
    """
    found = stored(near_members(docs, width, percent, id_col, text_col).where("n > 0").select("row", "head"), "near-members")
    (row,) = unused(docs, "row")
    keyed = docs.withColumn(row, row_hash(id_col, text_col))
    gone = found.where("row != head").select(F.col("row").alias(row)).distinct()
    many = found.where("row = head").groupBy(F.col("row").alias(row)).count().where("count > 1").select(row)
    once = keyed.join(gone.unionByName(many), row, "left_anti")
    return once.unionByName(keyed.join(many, row, "left_semi").dropDuplicates([row])).drop(row)


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of all documents by three-word shingles at 0.85; rows as in near_duplicates."""
    found = near_duplicates(documents(spark, sf_dir), width=3, percent=85)
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))
