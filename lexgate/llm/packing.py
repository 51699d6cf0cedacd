"""Packing by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import heapq
import itertools
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import WHITE, default_path, load
from .common import documents, keyed_text, stored

CAPACITY = 1024
#: Windows that one group of pieces fills, about; groups are dealt by hash, so none grows with the table.
GROUP_WINDOWS = 512
#: One rest in so many is cut into crumbs of CRUMB tokens before differencing; where windows still exceed their capacity
#: with a count RISES over the least possible one, more rests are, at last all.
CRUMBLED, CRUMB, RISES = (10, 3, 1), 48, (0.016, 0.024)


def kk_partition(sizes: list[int], k: int) -> list[list[int]]:
    """Items of k bins with near-equal sums, by multiway differencing.

    Each item starts as a partial partition of one filled bin. The two partial partitions with the largest
    spread (largest less smallest bin) are merged, the largest bins of one with the smallest of the
    other, until one is left. Empty bins are implied.
    """
    if not sizes:
        return [[] for _ in range(k)]
    parts = [[(s, [i])] for i, s in enumerate(sizes)]
    spread = lambda p: p[-1][0] - (p[0][0] if len(p) == k else 0)
    heap = [(-spread(p), i) for i, p in enumerate(parts)]
    heapq.heapify(heap)
    load_of = lambda b: b[0]
    while len(heap) > 1:
        _, i = heapq.heappop(heap)
        _, j = heapq.heappop(heap)
        a, b = parts[i], parts[j]
        if len(a) < len(b):
            a, b = b, a
        free = k - len(a)  # implied empty bins take the largest of b first
        fresh = b[max(len(b) - free, 0) :]
        for n, (s, items) in enumerate(reversed(b[: max(len(b) - free, 0)])):
            held, mine = a[n]
            if len(mine) < len(items):
                mine, items = items, mine
            mine.extend(items)
            a[n] = (held + s, mine)
        a.extend(fresh)
        a.sort(key=load_of)
        parts[i], parts[j] = a, None
        heapq.heappush(heap, (-spread(a), i))
    bins = [items for _, items in parts[heap[0][1]]]
    return bins + [[] for _ in range(k - len(bins))]


def crumbled(sizes: list[int], every: int) -> list[tuple[int, int, int]]:
    """Items as (item, first token, tokens), every so many cut into crumbs."""
    return [(i, at, min(CRUMB, s - at)) for i, s in enumerate(sizes) if i % every == 0 for at in range(0, s, CRUMB)] + [(i, 0, s) for i, s in enumerate(sizes) if i % every]


def windows_of(sizes: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Windows of near-equal fill as lists of (item, first token, tokens).

    The window count rises whenever a window exceeds its capacity. Few items a window cannot be made equal, so
    one item in ten is cut into crumbs, which differencing merges last and levels windows with. Where even a count
    2.4 % over the least possible one is exceeded (items of a little over half a window), a third of the items are cut, then all;
    crumbs alone fit, whatever the sizes, and the count rises until they do. Neighbours that meet again are one piece.
    """
    total = sum(sizes)
    if not total:
        return []
    least = -(-total // capacity)
    few = (0,) if least < 64 else ()
    for every in CRUMBLED:
        items = crumbled(sizes, every)
        counts = sorted({least + -int(-least * r // 1) for r in (*few, *RISES)})
        for k in counts if every > 1 else itertools.count(counts[0]):
            bins = [[items[i] for i in b] for b in kk_partition([n for *_, n in items], k)]
            if max(sum(n for *_, n in b) for b in bins) <= capacity:
                return [_joined(b) for b in bins if b]
    raise AssertionError("crumbs fit at some count")


def _joined(window: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Pieces of a window with neighbours of one item put together."""
    out: list[tuple[int, int, int]] = []
    for item, at, n in sorted(window):
        if out and out[-1][0] == item and out[-1][1] + out[-1][2] == at:
            out[-1] = (item, out[-1][1], out[-1][2] + n)
        else:
            out.append((item, at, n))
    return out


PLACED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, group_windows: int = GROUP_WINDOWS) -> DataFrame:
    """Place pieces (piece_id, doc_id, start, length, ids_crc32, doc_tokens, ids) in sequences.

    Pieces of a whole window stand alone. The rests, whose ids are at hand, are dealt by a hash of piece_id
    into groups of about group_windows windows, and each group is packed by differencing; a rest that is cut
    gives several pieces. Sequences are numbered inside their group. Pieces of no length are dropped;
    rows that are alike but for piece_id are pieces of their own; an empty table gives no rows.
    """
    total = pieces.where(F.col("length") < capacity).agg(F.sum("length")).first()[0] or 0
    groups = max(1, round(total / (capacity * group_windows)))
    rest = pieces.where((F.col("length") < capacity) & (F.col("length") > 0))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("piece_id", ignore_index=True)
        first, ids, rows = (int(pdf["group"].iloc[0]) << 24), pdf["ids"].tolist(), []
        docs, starts, tokens = (pdf[c].tolist() for c in ("doc_id", "start", "doc_tokens"))
        for w, window in enumerate(windows_of(pdf["length"].tolist(), capacity)):
            offset = 0
            for item, at, n in window:
                rows.append((docs[item], starts[item] + at, n, zlib.crc32(ids[item][4 * at : 4 * (at + n)]), tokens[item], 2 * (first + w), offset))
                offset += n
        out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
        return out.astype({"doc_id": "Int64"})

    dealt = rest.select("piece_id", "doc_id", "start", "length", "doc_tokens", "ids", F.pmod(F.xxhash64("piece_id"), F.lit(groups)).alias("group"))
    full = pieces.where(F.col("length") == capacity).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (2 * F.col("piece_id") + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    tasks = max(int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions")), groups // 16)  # some groups a task, whatever the size
    return full.unionByName(dealt.repartition(tasks, "group").groupBy("group").applyInPandas(pack, PLACED))


@lru_cache(maxsize=2)
def fast_encoder(path: str):
    """The vocabulary in the compiled encoder of the same family; ids are those of the tokenizers library (tested)."""
    import tiktoken

    from .bpe import SPLIT

    bpe = load(path)
    special = set(bpe.special.values())
    ranks = {token: i for i, token in enumerate(bpe.bytes_of) if token and i not in special}
    return tiktoken.Encoding("packing", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=bpe.special)


#: Runs of white space so long are pieces by themselves: the compiled splitter would step back over each of their signs.
LONG_BLANK = regex.compile(f"[{WHITE}]{{2000,}}")


def encoded(text: str, path: str) -> list[int]:
    """Ids of a whole text. A long blank run but for its last sign is one piece of the splitter, whatever stands around it."""
    encoder = fast_encoder(path)
    if not LONG_BLANK.search(text):
        return encoder.encode(text, allowed_special="all")
    bpe, ids = load(path), []
    for k, part in enumerate(bpe.parts.split(text) if bpe.parts else (text,)):
        if k % 2:
            ids.append(bpe.special[part])
            continue
        at = 0
        for run in LONG_BLANK.finditer(part):
            end = run.end() if run.end() == len(part) else run.end() - 1
            ids += encoder.encode(part[at : run.start()], disallowed_special=())
            ids += bpe.encode_piece(part[run.start() : end])
            at = end
        ids += encoder.encode(part[at:], disallowed_special=())
    return ids


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"


def token_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of tokenised documents: doc_id, start, length, ids_crc32, doc_tokens, ids.

    Whole windows of a document have a checksum and no ids, its rest has its ids (32 bits each). A document's
    ids are followed by end_id, so a null or empty text is one id. Each row is one document, also where
    ids are null or repeat. Extra columns are ignored; an empty table gives no rows.
    """
    path = path or default_path()
    schema = pa.schema([*((c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 1024):
                batch, rows = whole.slice(first, 1024), []
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    ids = np.array([*encoded(text.as_py(), path), end_id], dtype="<u4")
                    cut = len(ids) - len(ids) % capacity
                    rows += [(doc_id, at, capacity, zlib.crc32(ids[at : at + capacity].tobytes()), len(ids), None) for at in range(0, cut, capacity)]
                    if cut < len(ids):
                        rows.append((doc_id, cut, len(ids) - cut, None, len(ids), ids[cut:].tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return keyed_text(docs, id_col, text_col).mapInArrow(run, PIECES)


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents with their place: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every id lies in exactly one piece, no sequence holds more than capacity ids, and windows of a group
    are near equal, so padding to capacity is small. A document is cut into whole windows and a rest; one rest
    in ten is cut further, more only where sizes forbid near-equal windows. Null text counts as empty; null ids stay null; rows
    that repeat an id are documents of their own. Extra columns are ignored; an empty table gives no rows.
    """
    pieces = stored(token_pieces(docs, path, capacity, 0, id_col, text_col).withColumn("piece_id", F.monotonically_increasing_id()), "pieces")
    return pack_pieces(pieces, capacity)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens; rows as in pack_documents."""
    return pack_documents(documents(spark, sf_dir)).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
