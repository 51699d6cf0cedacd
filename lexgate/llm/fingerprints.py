"""Lempel-Ziv phrase fingerprints: LZ78 phrases of a text, hashed, as least-hash signatures."""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import BUFFER, Roller
from .common import documents, keyed_text, mix64

#: Least hashes of 32 bits that make a fingerprint; 8 hex digits each.
SIGNATURE = 128
#: Text bytes of a range of ids, about, where there are more than two ranges for each shuffle partition.
RANGE_BYTES = 1 << 27
_NULL_ID = -(2**63)


class Parse:
    """The state of an LZ78 parse: phrases so far, the open phrase, and the lengths of closed phrases.

    The dictionary is that of the whole text; it takes about eight bytes for each of its characters.
    """

    def __init__(self) -> None:
        self.seen: set[str] = set()
        self.open, self.lengths = "", []

    def copy(self) -> Parse:
        twin = Parse()
        twin.seen, twin.open, twin.lengths = self.seen.copy(), self.open, self.lengths.copy()
        return twin

    def feed(self, text: str) -> Parse:
        """A phrase is the longest known one and one more character."""
        open_, seen = self.open, self.seen
        add, close = seen.add, self.lengths.append
        for char in text:
            open_ += char
            if open_ not in seen:
                add(open_)
                close(len(open_))
                open_ = ""
        self.open = open_
        return self


def signature(text: str, parse: Parse) -> np.ndarray:
    """The least SIGNATURE distinct hashes of the phrases of a parsed text, ascending."""
    lengths = [*parse.lengths, len(parse.open)] if parse.open else parse.lengths
    if not lengths:
        return np.empty(0, dtype=np.uint32)
    codes = mix64(np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64) + np.uint64(1))
    ends = np.cumsum(lengths)
    starts = ends - lengths
    hashes, i = np.empty(len(ends), dtype=np.uint32), 0
    while i < len(ends):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + BUFFER, "right")))
        roll = Roller(codes[starts[i] : ends[j - 1]])
        found = mix64(roll.stretch(starts[i:j] - starts[i], ends[i:j] - starts[i]) + (ends[i:j] - starts[i:j]).astype(np.uint64))
        hashes[i:j] = (found >> np.uint64(32)).astype(np.uint32)
        i = j
    if len(hashes) > 4 * SIGNATURE:  # closed phrases differ, so few hashes are equal
        least = np.unique(np.partition(hashes, 2 * SIGNATURE)[: 2 * SIGNATURE])
        if len(least) >= SIGNATURE:
            return least[:SIGNATURE]
    return np.unique(hashes)[:SIGNATURE]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of the phrase sets, from the least hashes of their union; two empty sets are alike."""
    union = np.union1d(a, b)[:SIGNATURE]
    if not len(union):
        return 1.0
    return float(np.isin(union, np.intersect1d(a, b, assume_unique=True), assume_unique=True).sum() / len(union))


def as_text(sig: np.ndarray) -> str:
    return sig.astype(">u4").tobytes().hex()


def lz_fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fingerprint of each whole text.

    Equal texts have equal fingerprints. Null counts as empty, the empty text has the empty fingerprint. Ids may be
    null or repeat, each row is taken by itself. Extra columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [as_text(signature(t, Parse().feed(t))) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.string())], names=["doc_id", "fingerprint"])

    return keyed_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, fingerprint string")


#: Rows that are drawn for each boundary between ranges.
DRAWN = 32


def with_next(rows: DataFrame, buckets: int, count: int) -> DataFrame:
    """Rows of doc_id and text dealt to ranges and sorted there, each range with the next range's first row (late).

    The order is by id and a hash of the text; boundaries also know a row's place, so that rows of one id, and equal ones
    too, are dealt to as many ranges as their number asks for. After the last range comes the first. Only drawn rows (DRAWN for
    each boundary, by a hash of the row) and the key of each range's first row go through the driver, without their texts.
    """
    rows = rows.withColumns({"tie": F.xxhash64("text"), "place": F.xxhash64(F.monotonically_increasing_id())})
    share = max(1, count // (buckets * DRAWN))
    drawn = sorted(map(tuple, rows.where(F.pmod(F.xxhash64("place"), F.lit(share)) == 0).select("doc_id", "tie", "place").collect())) if buckets > 1 else []
    bounds = [drawn[len(drawn) * i // buckets] for i in range(1, buckets)] if drawn else []

    @F.pandas_udf("int")
    def bucket(doc_id: pd.Series, tie: pd.Series, place: pd.Series) -> pd.Series:
        return pd.Series([bisect.bisect_right(bounds, key) for key in zip(doc_id.tolist(), tie.tolist(), place.tolist(), strict=True)], dtype=np.int32)

    dealt = rows.withColumn("bucket", bucket("doc_id", "tie", "place")).drop("place")
    firsts = dealt.groupBy("bucket").agg(F.min(F.struct("doc_id", "tie")).alias("first")).select("bucket", "first.*").collect()
    used = sorted(r["bucket"] for r in firsts)
    before = dict(zip(used, [*used[-1:], *used[:-1]], strict=True))
    least = rows.sparkSession.createDataFrame([(r["bucket"], r["doc_id"], r["tie"], before[r["bucket"]]) for r in firsts], "bucket int, doc_id long, tie long, before int")
    # a row a range; of equal rows any will do
    late = dealt.join(F.broadcast(least), ["bucket", "doc_id", "tie"]).dropDuplicates(["bucket"]).select("doc_id", "text", "tie", F.col("before").alias("bucket"), F.lit(True).alias("late"))
    spread = dealt.withColumn("late", F.lit(False)).unionByName(late)
    return spread.repartition(buckets, "bucket").sortWithinPartitions("bucket", "late", "doc_id", "tie").select("doc_id", "text", "late", "bucket")


EDITED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited form, and their likeness.

    The edited text has its last half (rounded down) replaced by as many first characters of the next
    document, or all it has; ids ascend, and after the last comes the first. Both parses share the
    state at the cut. Null text counts as empty, null ids come first, rows of one id follow by a hash of
    their text. A single row is its own next. Extra columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = keyed_text(docs, id_col, text_col).withColumn("doc_id", F.coalesce("doc_id", F.lit(_NULL_ID)))
    size, count = rows.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    buckets = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), int((size or 0) // RANGE_BYTES))
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # id, text, state at the cut, signature, bucket of the row that waits for its next
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                out = []
                for doc_id, text, late, bucket in zip(*(whole.slice(at, 1024).column(i).to_pylist() for i in range(4)), strict=True):
                    cut = len(text) - len(text) // 2
                    state = Parse().feed(text[:cut])
                    parse = state.copy().feed(text[cut:])
                    own = signature(text, parse)
                    if held is not None and held[4] == bucket:
                        before_id, before, open_state, before_sig, _ = held
                        keep = len(before) - len(before) // 2
                        tail = text[: len(before) // 2]
                        edited = before[:keep] + tail
                        edited_sig = signature(edited, open_state.feed(tail))
                        out.append((None if before_id == _NULL_ID else before_id, len(before), hashlib.sha256(edited.encode()).hexdigest(), as_text(before_sig), as_text(edited_sig), likeness(before_sig, edited_sig), likeness(before_sig, own)))
                        held = None
                    if not late:
                        held = (doc_id, text, state, own, bucket)
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return with_next(rows, buckets, count).mapInArrow(run, EDITED)


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their edited texts; rows as in fingerprint_edits."""
    return fingerprint_edits(documents(spark, sf_dir))
