"""Hard negatives: a vantage-point tree over norm-augmented vectors, searched nearest first inside distance annuli."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import run_starts, stored

#: Rows that the upper tree is fitted on (those with the least hashes), and rows of a page, the unit that one search reads.
SAMPLE, PAGE = 8192, 1024
#: Rows of the last level of a page's own tree.
BUCKET = 64
#: Vectors whose squared norm is larger take no part: their scores would not fit 64 bits.
MOST_NORM = float(1 << 60)
#: Distances are rounded, so bounds give way by this share of the largest.
SLACK = 1e-5
_LEAST, _MOST = -(1 << 62), 1 << 62


# ---- geometry: x becomes (x, sqrt(M - |x|^2)), M the largest |x|^2, and an anchor (a, 0), so that d^2 = |a|^2 + M - 2 ax


def _dots(a: np.ndarray, b: np.ndarray, most: float) -> np.ndarray:
    """Exact integer products; in floats where no sum can pass 53 bits."""
    if most < 2.0**52:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _norms(x: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x.astype(np.float64), x.astype(np.float64))


def _between(x: np.ndarray, y: np.ndarray, most: float) -> np.ndarray:
    """Distances between augmented rows."""
    hx, hy = (np.sqrt(np.maximum(most - _norms(v), 0)) for v in (x, y))
    return np.sqrt(np.maximum(2 * most - 2 * (x.astype(np.float64) @ y.astype(np.float64).T + np.outer(hx, hy)), 0))


def _from_anchors(a: np.ndarray, x: np.ndarray, most: float) -> np.ndarray:
    return np.sqrt(np.maximum(_norms(a)[:, None] + most - 2 * (a.astype(np.float64) @ x.astype(np.float64).T), 0))


class Tree:
    """Vantage points in heap order: node i has the children 2i+1 (within its radius) and 2i+2; levels of them end in leaves."""

    def __init__(self, x: np.ndarray, levels: int, most: float):
        self.levels, self.most = levels, most
        self.points = np.zeros(((1 << levels) - 1, x.shape[1]), dtype=np.int64)
        self.radius = np.zeros(len(self.points))
        inside = {0: np.arange(len(x))}
        for node in range(len(self.points)):
            rows = inside.pop(node)
            if not len(rows):
                inside[2 * node + 1], inside[2 * node + 2] = rows, rows
                continue
            self.points[node] = x[rows[0]]
            d = _between(x[rows], x[rows[:1]], most)[:, 0]
            self.radius[node] = np.median(d)
            near = d <= self.radius[node]
            inside[2 * node + 1], inside[2 * node + 2] = rows[near], rows[~near]

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leaf of each row and its distances to the vantage points on the way, one a level."""
        node, steps = np.zeros(len(x), dtype=np.int64), np.zeros((len(x), self.levels))
        for level in range(self.levels):
            d = np.zeros(len(x))
            for k in np.unique(node):
                at = node == k
                d[at] = _between(x[at], self.points[k : k + 1], self.most)[:, 0]
            steps[:, level] = d
            node = 2 * node + 1 + (d > self.radius[node])
        return node - len(self.points), steps

    def way(self, leaf: int) -> list[int]:
        node, out = leaf + len(self.points), []
        while node:
            node = (node - 1) // 2
            out.append(node)
        return out[::-1]

    def bounds(self, a: np.ndarray, leaves: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest distance of each anchor to the rows of each leaf, from the leaf's least and largest distance to its vantage points."""
        low, high = np.zeros((len(a), len(leaves))), np.full((len(a), len(leaves)), np.inf)
        if self.levels:
            d = _from_anchors(a, self.points, self.most)
            for i, leaf in enumerate(leaves):
                to = d[:, self.way(leaf)]
                low[:, i] = np.maximum(np.maximum(to - most[i], least[i] - to).max(axis=1), 0)
                high[:, i] = (to + most[i]).min(axis=1)
        return low, high


def _reach(score: np.ndarray, norms: np.ndarray, most: float) -> np.ndarray:
    """The distance at which an anchor has a score."""
    return np.sqrt(np.maximum(norms + most - 2 * score.astype(np.float64), 0))


class Page:
    """Rows of one page with a tree of their own."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, most: float):
        self.ids, self.labels, self.x, self.most = ids, labels, x, most
        self.tree = Tree(x, max(0, int(np.ceil(np.log2(max(len(x) / BUCKET, 1))))), most)
        leaf, steps = self.tree.place(x)
        order = np.argsort(leaf, kind="stable")
        self.buckets = np.split(order, run_starts(leaf[order])[1:]) if len(x) else []
        self.leaves = np.array([leaf[b[0]] for b in self.buckets], dtype=np.int64)
        self.least, self.largest = (np.array([f(steps[b], axis=0) for b in self.buckets]).reshape(len(self.buckets), -1) for f in (np.min, np.max))

    def search(self, a: np.ndarray, ids: np.ndarray, labels: np.ndarray, low: np.ndarray, high: np.ndarray, floor: np.ndarray, k: int, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best k rows of each anchor whose score lies from low to high: (place of the anchor, row id, score).

        Buckets are taken nearest first. A bucket outside the annulus of the scores is not read, nor is one
        beyond the k-th best row so far or below floor, the k-th best that other pages have given.
        """
        norms, slack = _norms(a), SLACK * np.sqrt(2 * self.most + 1)
        near, far = self.tree.bounds(a, self.leaves, self.least, self.largest)
        order = np.argsort(near, axis=1, kind="stable")
        best = np.full((len(a), k), _LEAST)
        found = np.zeros((len(a), k), dtype=np.int64)
        inner = _reach(high, norms, self.most) - slack
        bound = np.maximum(low, floor)
        for step in range(order.shape[1]):
            bucket = order[:, step]
            rows = np.arange(len(a))
            open_ = (near[rows, bucket] - slack <= _reach(np.maximum(bound, best[:, -1]), norms, self.most)) & (far[rows, bucket] + slack >= inner)
            for b in np.unique(bucket[open_]):
                asked, held = np.flatnonzero(open_ & (bucket == b)), self.buckets[b]
                score = _dots(a[asked], self.x[held], self.most)
                fits = (score >= bound[asked, None]) & (score <= high[asked, None]) & ((labels[asked, None] == self.labels[held]) == same)
                if same:
                    fits &= ids[asked, None] != self.ids[held]
                score = np.concatenate([best[asked], np.where(fits, score, _LEAST)], axis=1)
                named = np.concatenate([found[asked], np.broadcast_to(self.ids[held], fits.shape)], axis=1)
                top = np.lexsort((named, -score), axis=1)[:, :k]
                best[asked], found[asked] = np.take_along_axis(score, top, 1), np.take_along_axis(named, top, 1)
        at, column = np.nonzero(best > _LEAST)
        return at, found[at, column], best[at, column]


# ---- Spark


def quantised(vectors: DataFrame, factor: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, label, vec (array of long) of the rows that take part: no null, no component that is null or not finite."""
    x = F.col("v_")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v_")).where("vec_id is not null and label is not null and v_ is not null")
    rows = rows.where(~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))).withColumn("v_", F.transform(x, lambda c: c * float(factor)))
    norm = F.aggregate(x, F.lit(0.0), lambda s, c: s + c * c)
    return rows.where(norm < MOST_NORM).select("vec_id", "label", F.transform(x, lambda c: F.floor(c)).alias("vec"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of integers as rows; shorter ones end in zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy()
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


class Index:
    """All rows in pages of an upper tree. Each vector and label keeps its `keep` least ids, which is all that a search of keep - 1 rows can return."""

    def __init__(self, rows: DataFrame, keep: int = 6, page: int = PAGE, sample: int = SAMPLE):
        least = Window.partitionBy("vec", "label").orderBy("vec_id")
        rows = stored(rows.select("vec_id", "label", "vec").distinct().withColumn("n_", F.row_number().over(least)).where(F.col("n_") <= keep).drop("n_"), "vectors")
        facts = rows.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("width"), F.max(F.aggregate("vec", F.lit(0.0), lambda s, c: s + c.cast("double") * c)).alias("most")).first()
        self.width, most = max(facts.width or 1, 1), max(facts.most or 0.0, 1.0)
        drawn = rows.orderBy(F.xxhash64("vec", "label", "vec_id"), "vec_id").select("vec").limit(sample).toArrow()["vec"].combine_chunks()
        levels = max(0, int(np.ceil(np.log2(max(min(facts.n / page, sample / 16), 1)))))
        self.tree = tree = Tree(_matrix(drawn, self.width), levels, most)
        width = self.width

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                leaf, steps = tree.place(_matrix(batch["vec"], width))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(leaf) + 1, dtype=np.int32) * levels), pa.array(steps.reshape(-1)))
                yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["label"], batch["vec"], pa.array(leaf), lists], names=["vec_id", "label", "vec", "leaf", "steps"])

        placed = stored(rows.mapInArrow(place, "vec_id long, label long, vec array<long>, leaf long, steps array<double>"), "placed")
        ends = [f(F.col("steps")[i]).alias(f"{name}{i}") for i in range(levels) for f, name in ((F.min, "least"), (F.max, "most"))]
        found = placed.groupBy("leaf").agg(F.count("*").alias("n"), *ends).orderBy("leaf").collect()  # a row a leaf, sample / 8 at most
        self.leaves = np.array([r.leaf for r in found], dtype=np.int64)
        self.pages = np.array([-(-r.n // page) for r in found], dtype=np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.pages)]).astype(np.int64)
        self.least, self.largest = (np.array([[r[f"{name}{i}"] for i in range(levels)] for r in found]).reshape(len(found), levels) for name in ("least", "most"))
        table = rows.sparkSession.createDataFrame([(int(r.leaf), int(f), int(n)) for r, f, n in zip(found, self.first, self.pages, strict=False)], "leaf long, first long, pages long")
        self.paged = placed.join(F.broadcast(table), "leaf").withColumn("page", F.col("first") + F.pmod(F.xxhash64("vec_id", "label", "vec"), "pages"))

    def _asked(self, queries: DataFrame, nearest: bool) -> DataFrame:
        """A row for each query and page that it must read: pages of its nearest leaf, or of all others that its annuli reach."""
        tree, width, leaves, pages, first, least, largest = self.tree, self.width, self.leaves, self.pages, self.first, self.least, self.largest

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for at in range(0, whole.num_rows, 256):
                    batch = whole.slice(at, 256)
                    a = _matrix(batch["vec"], width)
                    near, far = tree.bounds(a, leaves, least, largest)
                    norms, slack = _norms(a), SLACK * np.sqrt(2 * tree.most + 1)
                    query = np.repeat(np.arange(len(a)), np.diff(batch["low"].offsets.to_numpy()))
                    low, high, floor = (batch[c].flatten().to_numpy() for c in ("low", "high", "floor"))
                    outer, inner = _reach(np.maximum(low, floor), norms[query], tree.most) + slack, _reach(high, norms[query], tree.most) - slack
                    fits = np.zeros(near.shape, dtype=bool)
                    np.logical_or.at(fits, query, (near[query] <= outer[:, None]) & (far[query] >= inner[:, None]) & (low <= high)[:, None])
                    first_leaf = np.where(fits, near, np.inf).argmin(axis=1)
                    mine = np.zeros(near.shape, dtype=bool)
                    mine[np.arange(len(a)), first_leaf] = True
                    q, leaf = np.nonzero(fits & (mine == nearest))
                    times = pages[leaf]
                    page = np.repeat(first[leaf], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                    taken = batch.take(pa.array(np.repeat(q, times)))
                    yield pa.RecordBatch.from_arrays([pa.array(page), *taken.columns], names=["page", *taken.schema.names])

        return queries.mapInArrow(run, "page long, " + ", ".join(f"{n} {t}" for n, t in queries.dtypes))

    def _round(self, queries: DataFrame, k: int, same: bool, nearest: bool) -> DataFrame:
        """(akey, window, vec_id, score) of the best rows of each page that is asked."""
        none = F.array().cast("array<bigint>")
        rows = self.paged.select("page", F.lit(-1).cast("long").alias("akey"), "vec_id", "label", "vec", none.alias("low"), none.alias("high"), none.alias("floor"))
        both = rows.unionByName(self._asked(queries, nearest)).repartition("page").sortWithinPartitions("page", F.col("akey") >= 0)
        width, most = self.width, self.tree.most

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number, held, page = None, [], None
            for whole in batches:
                pages, queries = whole["page"].to_numpy(), whole["akey"].to_numpy() >= 0
                starts = run_starts(pages, queries)
                for at, end in zip(starts, [*starts[1:], whole.num_rows], strict=True):
                    batch = whole.slice(at, end - at)
                    if pages[at] != number:
                        number, held, page = pages[at], [], None
                    if not queries[at]:
                        held.append(batch)
                        continue
                    if page is None:
                        page = Page(*(np.concatenate([b[c].to_numpy() for b in held]) for c in ("vec_id", "label")), np.concatenate([_matrix(b["vec"], width) for b in held]), most)
                    for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                        sizes = np.diff(part["low"].offsets.to_numpy())
                        q = np.repeat(np.arange(part.num_rows), sizes)
                        window = np.arange(len(q)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                        low, high, floor = (part[c].flatten().to_numpy() for c in ("low", "high", "floor"))
                        ids, labels = part["vec_id"].to_numpy(), part["label"].to_numpy()
                        at_, row, score = page.search(_matrix(part["vec"], width)[q], ids[q], labels[q], low, high, floor, k, same)
                        yield pa.RecordBatch.from_arrays([part["akey"].take(pa.array(q[at_])), pa.array(window[at_]), pa.array(row), pa.array(score)], names=["akey", "window", "vec_id", "score"])

        return both.mapInArrow(run, "akey long, window long, vec_id long, score long")

    def search(self, queries: DataFrame, k: int, same: bool) -> DataFrame:
        """Best k rows (akey, window, rank, vec_id, score) of queries (akey, vec_id, label, vec, low, high), one answer for each pair of low and high.

        Rows have the query's label and another id (same), or another label. Two rounds: the pages of the nearest leaf
        give a k-th best score, and only leaves that reach beyond it are read in the second round.
        """
        best = Window.partitionBy("akey", "window").orderBy(F.desc("score"), "vec_id")
        top = lambda df: df.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        started = queries.withColumn("floor", F.transform("low", lambda c: F.lit(_LEAST)))
        first = stored(top(self._round(started, k, same, True)), "nearest")
        floors = first.where(F.col("rank") == k).groupBy("akey").agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("known"))
        known = queries.join(floors, "akey", "left").withColumn("floor", F.transform("low", lambda c, i: F.coalesce(F.col("known")[i.cast("long")], F.lit(_LEAST)))).drop("known")
        return top(first.drop("rank").unionByName(self._round(known, k, same, False)))


def hard_negatives(rows: DataFrame, anchor_every: int = 100, positives: int = 5, negatives: int = 5, page: int = PAGE, sample: int = SAMPLE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of rows (vec_id, label, vec).

    Anchors are rows whose id anchor_every divides. Positives are an anchor's first rows of the same label by score
    (inner product; ties: least id), negatives the first rows of other labels from 80 % of the positive's score to all of it.

    Rows that are alike in all three columns count once. Rows that share an id but not the rest each take part; a row
    of the anchor's id is never its positive. A shorter vector ends in zeros. No rows give no rows.
    """
    index = Index(rows, max(positives + 1, negatives), page, sample)
    anchors = rows.where(F.col("vec_id") % anchor_every == 0).distinct()
    anchors = stored(anchors.withColumn("akey", F.monotonically_increasing_id()).select("akey", "vec_id", "label", "vec"), "anchors")
    everything = anchors.withColumn("low", F.array(F.lit(_LEAST))).withColumn("high", F.array(F.lit(_MOST)))
    found = stored(index.search(everything, positives, True).select("akey", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    scored = found.groupBy("akey").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "positive_score"))), lambda s: s["positive_score"]).alias("high"))
    # 80 p <= 100 n is n >= p - floor(p / 5); below zero no n fits
    windows = anchors.join(scored.withColumn("low", F.expr("transform(high, p -> if(p < 0, p + 1, p - p div 5))")), "akey").select("akey", "vec_id", "label", "vec", "low", "high")
    mined = index.search(windows, negatives, False)
    named = found.join(anchors.select("akey", F.col("vec_id").alias("anchor_id")), "akey").withColumn("window", (F.col("place") - 1).cast("long"))
    out = mined.select("akey", "window", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")).join(named, ["akey", "window"])
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of the anchors of `embeddings`: ids that 100 divides, against all rows. Where 7 divides the id, the label moves on by one, modulo 10."""
    rows = quantised(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return hard_negatives(rows.withColumn("label", F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)")))


OP12_SQL = """
WITH taken AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_dot_product(CAST(a.v AS DOUBLE[]), CAST(b.v AS DOUBLE[])) AS BIGINT) AS score
  FROM taken a JOIN taken b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
negatives AS (
  SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, other_id) AS INTEGER) AS rank, other_id AS negative_id, positive_score, s.score AS negative_score
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score)
SELECT * FROM negatives WHERE rank <= 5
"""
