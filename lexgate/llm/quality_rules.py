"""Quality rules: gradient-boosted trees over document statistics, as flat numpy node arrays."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, in_slices, keyed_text, mix64, stored
from .words import word_bounds, word_codes

#: At most so many labelled rows are used to fit the trees (drawn by a hash of the id); all other work covers all rows.
MAX_TRAINING_ROWS = 20_000
#: Share of good labelled rows, held out from the fit, that the verdict must keep.
KEEP_GOOD = 0.999

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Features of the trees and their monotonic direction: -1 means that more of it never raises the quality.
FEATURES = {
    "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "upper_share": -1, "mark_share": -1, "pipe_share": -1, "digit_share": 0,
    "mean_word": 0, "word_spread": 0, "space_share": 0, "comma_share": 0, "stop_share": 0, "wide_share": 0, "distinct_share": 0, "top_word_share": 0, "mean_line": 0, "log_words": 0,
}
_CLASS = np.zeros((9, 256), dtype=np.uint8)
for _row, _chars in enumerate((b"#*$%&|<>", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"!?", b"|", b"0123456789", b",;:", b".")):
    _CLASS[_row, list(_chars)] = 1
_CLASS[7, 128:] = 1
_CLASS[8, 0x80:0xC0] = 1  # bytes that continue a code point
WINDOW = 8


def repeated_window_words(codes: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows of `window` words that occur twice or more in the text."""
    n = len(codes) - window + 1
    if n < 2:
        return 0
    key = np.zeros(n, dtype=np.uint64)
    for i in range(window):
        key = key * np.uint64(0x9E3779B97F4A7C15) + codes[i : i + n]
    key = mix64(key)
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    if not same.any():
        return 0
    hit = np.zeros(n, dtype=bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    change = np.zeros(len(codes) + 1, dtype=np.int64)
    change[:n] += hit
    change[window : window + n] -= hit
    return int((np.cumsum(change[:-1]) > 0).sum())


def measure(text: str | None) -> tuple[list[int], list[float]]:
    """The five base statistics and the features of a whole text; null or empty gives zeros."""
    raw_bytes = (text or "").encode()
    raw = np.frombuffer(raw_bytes, dtype=np.uint8)
    starts, ends = word_bounds(raw)
    codes = word_codes(raw, starts, ends)
    histogram = np.bincount(raw, minlength=256)
    symbols, upper, marks, pipes, digits, commas, stops, wide, going_on = (int(histogram[c.view(bool)].sum()) for c in _CLASS)
    n_words, sizes = len(codes), ends - starts
    word_bytes = int(sizes.sum())
    word_chars = word_bytes - going_on
    seen, dup, n_lines, lines = set(), 0, 0, raw_bytes.split(b"\n")
    for line in lines:
        if line.strip():
            n_lines += 1
            if line in seen:
                dup += 1
            seen.add(line)
    repeat = repeated_window_words(codes)
    counts = np.unique(codes, return_counts=True)[1] if n_words else np.zeros(1)
    chars, words = max(word_chars, 1), max(n_words, 1)
    features = [
        symbols / chars, dup / max(n_lines, 1), repeat / words, upper / chars, marks / chars, pipes / chars, digits / chars,
        word_chars / words, float(sizes.std()) if n_words else 0.0, (len(raw) - word_bytes) / words, commas / chars, stops / chars, going_on / chars,
        len(counts) / words, float(counts.max()) / words, word_chars / max(n_lines, 1), float(np.log1p(n_words)),
    ]
    return [n_words, word_chars, symbols, dup, repeat], features


def statistics(rows: DataFrame) -> DataFrame:
    """doc_id, the base statistics and an array of features for doc_id and text."""
    schema = pa.schema([("doc_id", pa.int64()), *((s, pa.int64()) for s in STATS), ("features", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            found = [measure(t.as_py()) for t in batch.column(1)]
            base = [pa.array([f[0][i] for f in found], pa.int64()) for i in range(len(STATS))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *base, pa.array([f[1] for f in found], pa.list_(pa.float64()))], schema=schema)

    return rows.mapInArrow(run, "doc_id long, " + ", ".join(f"{s} long" for s in STATS) + ", features array<double>")


@dataclass
class Trees:
    """All trees as flat arrays of complete binary trees: inner node i of a tree has children 2i + 1 and 2i + 2."""

    depth: int
    feature: np.ndarray  # (trees, 2 ** depth - 1), -1 for no split
    cut: np.ndarray
    leaf: np.ndarray  # (trees, 2 ** depth)
    base: float
    least: float = 0.0  # the verdict keeps scores of this or more

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                f = feature[node]
                right = (f >= 0) & (x[rows, np.maximum(f, 0)] > cut[node])
                node = 2 * node + 1 + right
            out += leaf[node - (2**self.depth - 1)]
        return out


def fit_trees(x: np.ndarray, y: np.ndarray, signs: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 64, ridge: float = 1.0, least_rows: int = 10) -> Trees:
    """Boosted trees for the logistic loss by histograms of gradients; constrained features split in their direction only.

    A split on a constrained feature must order its children's values, and both subtrees are held to their
    side of the middle value, so the whole score is monotonic in that feature.
    """
    n, m = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1)
    share = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    inner, leaves = 2**depth - 1, 2**depth
    model = Trees(depth, np.full((trees, inner), -1), np.zeros((trees, inner)), np.zeros((trees, leaves)), base)
    score = np.full(n, base)
    value = lambda g, h: -g / (h + ridge)
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(n, dtype=np.int64)
        low, high = {0: -np.inf}, {0: np.inf}
        for i in range(inner):
            own = np.flatnonzero(node == i)
            low[2 * i + 1] = low[2 * i + 2] = low[i]
            high[2 * i + 1] = high[2 * i + 2] = high[i]
            best = (1e-6, -1, 0, 0.0, 0.0)
            if len(own) >= 2 * least_rows:
                g, h = grad[own], hess[own]
                total_g, total_h = g.sum(), h.sum()
                for j in range(m):
                    if not len(edges[j]):
                        continue
                    k = len(edges[j]) + 1
                    b = binned[own, j]
                    gl, hl = np.cumsum(np.bincount(b, g, k))[:-1], np.cumsum(np.bincount(b, h, k))[:-1]
                    nl = np.cumsum(np.bincount(b, minlength=k))[:-1]
                    vl, vr = np.clip(value(gl, hl), low[i], high[i]), np.clip(value(total_g - gl, total_h - hl), low[i], high[i])
                    gain = gl**2 / (hl + ridge) + (total_g - gl) ** 2 / (total_h - hl + ridge) - total_g**2 / (total_h + ridge)
                    gain[(nl < least_rows) | (len(own) - nl < least_rows) | ((vr - vl) * signs[j] < 0)] = -1
                    c = int(np.argmax(gain))
                    if gain[c] > best[0]:
                        best = (float(gain[c]), j, c, float(vl[c]), float(vr[c]))
            _, j, c, vl, vr = best
            if j >= 0:
                model.feature[t, i], model.cut[t, i] = j, edges[j][c]
                if signs[j]:
                    middle = (vl + vr) / 2
                    left, right = (high, low) if signs[j] > 0 else (low, high)
                    left[2 * i + 1] = right[2 * i + 2] = middle
                node[own] = 2 * i + 1 + (binned[own, j] > c)
            else:
                node[own] = 2 * i + 1
        for k in range(leaves):
            own = np.flatnonzero(node == inner + k)
            if len(own):
                model.leaf[t, k] = rate * float(np.clip(value(grad[own].sum(), hess[own].sum()), low[inner + k], high[inner + k]))
        score += model.leaf[t][node - inner]
    return model


def labelled_sample(labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id") -> DataFrame:
    """doc_id and y of at most MAX_TRAINING_ROWS labelled rows, drawn by a hash of the id. Null labels and ids are ignored."""
    usable = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).dropna()
    return usable.orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id", "y").limit(MAX_TRAINING_ROWS)


def fit_from_labels(stats: DataFrame, sample: DataFrame) -> Trees | None:
    """Trees from a labelled sample of bounded size; None if there are no labels of both kinds.

    A fifth of the rows is held out; the verdict's threshold is the highest score that keeps KEEP_GOOD
    of the good held-out rows, and 0 (even odds) at most.
    """
    # the sample is bounded by MAX_TRAINING_ROWS, so it may be broadcast and its statistics collected
    rows = stats.join(F.broadcast(sample), "doc_id").orderBy(F.xxhash64("doc_id", F.lit(8)), "doc_id", "y").limit(MAX_TRAINING_ROWS).select("features", "y").collect()
    if len({r.y for r in rows}) < 2:
        return None
    x, y = np.array([r.features for r in rows]), np.array([float(r.y > 0) for r in rows])
    held = np.arange(len(y)) % 5 == 0
    if len({*y[~held]}) < 2:
        held[:] = False
    model = fit_trees(x[~held], y[~held], np.array(list(FEATURES.values())))
    good = np.sort(model.score(x[held & (y > 0)]))
    model.least = min(0.0, float(good[int(len(good) * (1 - KEEP_GOOD))]) - 1e-9) if len(good) else 0.0
    return model


def judged(stats: DataFrame, model: Trees | None) -> DataFrame:
    """stats with base_failed, quality_score (log odds) and kept."""
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))

    @F.pandas_udf("double")
    def score(features):
        import pandas as pd

        return pd.Series(model.score(np.stack(features.to_numpy()))) if len(features) else pd.Series([], dtype=float)

    points = score("features") if model is not None else F.lit(0.0)
    least = model.least if model is not None else 0.0
    out = stats.withColumn("base_failed", failed).withColumn("quality_score", points)
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("quality_score") >= F.lit(least)))


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the base statistics, base_failed, quality_score and kept of each row.

    Null text counts as empty and fails the base rule; null ids are kept as they are; rows that repeat
    an id are judged each by its own text; without usable labels the base rule alone decides. Extra columns
    are ignored; an empty table gives no rows.
    """
    stats = stored(statistics(keyed_text(docs, id_col, text_col)), "quality-stats")
    return judged(stats, fit_from_labels(stats, labelled_sample(labels))).drop("features")


def keep_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, that quality_rules keeps; texts are measured where they lie.

    Null, empty and short texts go by the base rule; null ids stay as they are; rows that share an id are judged each by its
    own text, and a label of their id counts for each of them. Without labels of both kinds the base rule alone
    decides. Other columns stay, whatever their names; an empty table gives no rows.
    """
    sample = stored(labelled_sample(labels), "labelled")
    chosen = keyed_text(docs, id_col, text_col).join(F.broadcast(sample.select("doc_id").distinct()), "doc_id", "left_semi")
    model = fit_from_labels(statistics(chosen), sample)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            found = [measure(t.as_py()) for t in batch.column(at)]
            base = np.array([f[0] for f in found]).reshape(-1, len(STATS))
            good = (base[:, 0] >= 20) & (100 * base[:, 4] <= 30 * base[:, 0])
            if model is not None and len(found):
                good &= model.score(np.array([f[1] for f in found])) >= model.least
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdicts on all documents; rows as in quality_rules."""
    out = quality_rules(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return out.select("doc_id", *STATS, "base_failed", "kept", "quality_score")
