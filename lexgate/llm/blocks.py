"""Content-defined blocks: one row for each run of fixed-length windows that share an anchor.

A window is `width` consecutive units (bytes or word codes) of one document. Its anchor is the gram of
`gram` units inside it with the least hash, leftmost on ties, so equal windows have equal anchors at
equal places. Consecutive windows with one anchor form a block. Two equal windows therefore lie in
blocks of the same anchor gram; a block whose whole content occurs again repeats all its windows at
once, and only blocks that share a gram but not their content need a look at single windows. This
keeps one row for each (width - gram) / 2 units instead of one for each unit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64, run_starts

#: Units that are hashed at once; longer documents are taken in pieces that overlap by one window.
BUFFER = 1 << 18
_PLACE = np.uint64((1 << 21) - 1)
MULTIPLIER = 0x9E3779B97F4A7C15

#: place packs the first window (high bits), the number of windows (16 bits) and the copies in one lot: 0 a later copy, 1, or 2 for more.
#: row tells rows that share an id apart; rows equal in id and row are one document.
_BLOCK_COLUMNS = ("gram", "content", "doc_id", "place", "row")
#: Where all copies count, a block may name another place of its content (its source): a document and the first unit there.
_SOURCE = ("source", "source_start")


def ddl(columns: tuple[str, ...]) -> str:
    return ", ".join(f"{c} long" for c in columns)


def as_batch(columns: list, names: tuple[str, ...]) -> pa.RecordBatch:
    """Numpy columns (a pair of values and a mask of nulls for a source) as a batch of longs."""
    arrays = [pa.array(c[0], pa.int64(), mask=c[1]) if isinstance(c, tuple) else pa.array(c, pa.int64()) for c in columns]
    return pa.RecordBatch.from_arrays(arrays, names=list(names))


def block_columns(all_copies: bool) -> tuple[str, ...]:
    return _BLOCK_COLUMNS + (_SOURCE if all_copies else ())


def pack(start: np.ndarray, nwin: np.ndarray, copies: np.ndarray | int) -> np.ndarray:
    return (start.astype(np.int64) << 18) | (nwin.astype(np.int64) << 2) | copies


def unpack(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return place >> 18, (place >> 2) & 0xFFFF, place & 3


def _powers(m: int, n: int) -> np.ndarray:
    out = np.full(n, m, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Roller:
    """Prefix sums of a polynomial over 64-bit codes: hashes of any stretch in constant time."""

    size = BUFFER + (1 << 14)
    _tables: list[np.ndarray] = []

    def __init__(self, codes: np.ndarray):
        if not self._tables:
            self._tables.extend((_powers(MULTIPLIER, self.size), _powers(pow(MULTIPLIER, -1, 1 << 64), self.size)))
        up, self.down = self._tables
        self.sums = np.zeros(len(codes) + 1, dtype=np.uint64)
        np.cumsum(codes * up[: len(codes)], out=self.sums[1:])

    def stretch(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]

    def grams(self, k: int) -> np.ndarray:
        n = len(self.sums) - k
        return (self.sums[k:] - self.sums[:n]) * self.down[:n]


def sliding_least(x: np.ndarray, w: int) -> np.ndarray:
    """Least of each w neighbours, in two passes over blocks of w."""
    n = len(x) - w + 1
    m = -(-len(x) // w)
    padded = np.full(m * w, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(x)] = x
    grid = padded.reshape(m, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1 : w - 1 + n])


def _blocks(codes: np.ndarray, ends: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """Blocks of one buffer of several pieces that end at `ends`: first window, windows, hashes of gram and content."""
    n = len(codes) - width + 1
    roll = Roller(codes)
    grams = mix64(roll.grams(gram))
    least = sliding_least((grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64), width - gram + 1)[:n]
    anchor = (least & _PLACE).astype(np.int64)
    change = np.zeros(n + 1, dtype=np.int32)  # windows that cross a piece's end count as none
    inner = ends[ends < len(codes)]
    np.add.at(change, np.clip(inner - width + 1, 0, n), 1)
    np.add.at(change, np.clip(inner, 0, n), -1)
    valid = np.cumsum(change[:-1]) == 0
    differs = np.ones(n + 1, dtype=bool)
    differs[1:n] = (anchor[1:] != anchor[:-1]) | ~valid[1:] | ~valid[:-1]
    first = np.flatnonzero(valid & differs[:-1])
    last = np.flatnonzero(valid & differs[1:])
    return first, last - first + 1, grams[anchor[first]], content_hash(roll, first, last + width)


def content_hash(roll: Roller, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix64(roll.stretch(start, end) + (end - start).astype(np.uint64))


def _pieces(docs: Iterator[tuple[int, np.ndarray]], width: int) -> Iterator[tuple[list[int], list[int], list[np.ndarray]]]:
    """Fill buffers: ids, starts inside the document and codes of pieces."""
    ids, starts, parts, held = [], [], [], 0
    for doc_id, codes in docs:
        for at in range(0, max(len(codes) - width + 1, 0), BUFFER):
            part = codes[at : at + BUFFER + width - 1]
            if held and held + len(part) > BUFFER + width:
                yield ids, starts, parts
                ids, starts, parts, held = [], [], [], 0
            ids.append(doc_id)
            starts.append(at)
            parts.append(part)
            held += len(part)
    if held:
        yield ids, starts, parts


def block_table(ids: np.ndarray, documents: Iterator[np.ndarray], width: int, gram: int, keys: np.ndarray | None = None, all_copies: bool = False) -> list:
    """All blocks of some documents (keys: the row of each, 0 for none). Copies inside this lot are told at once, so a hot block sends one full row a lot."""
    lots: list[tuple[np.ndarray, ...]] = []
    keys = np.zeros(len(ids), dtype=np.int64) if keys is None else keys
    for own, starts, parts in _pieces(zip(range(len(ids)), documents, strict=True), width):
        codes = np.concatenate(parts)
        sizes = np.array([len(p) for p in parts])
        ends = np.cumsum(sizes)
        first, nwin, grams, content = _blocks(codes, ends, width, gram)
        piece = np.searchsorted(ends, first, "right")
        start = first - (ends - sizes)[piece] + np.array(starts, dtype=np.int64)[piece]
        of = np.array(own, dtype=np.int64)[piece]
        lots.append((grams.view(np.int64), content.view(np.int64), ids[of], pack(start, nwin, 0), keys[of]))
    return combine(lots, all_copies)


def combine(lots: list[tuple[np.ndarray, ...]], all_copies: bool) -> list:
    """Sort rows of one lot by content, and mark the copies in it; all_copies: with a source for each that has one in the lot."""
    if not lots:
        none = np.empty(0, dtype=np.int64)
        return [none] * 5 + ([(none, none.astype(bool))] * 2 if all_copies else [])
    columns = [np.concatenate(c) for c in zip(*lots, strict=True)]
    order = np.lexsort((columns[3], columns[4], columns[2], columns[1]))
    columns = [c[order] for c in columns]
    heads = run_starts(*columns[:2])
    sources = []
    if all_copies:
        later = np.ones(len(order), dtype=bool)
        later[heads] = False
        sizes = np.diff(np.append(heads, len(later)))
        of = np.repeat(heads, sizes)  # the source of a later copy is the first one, the source of that is the second
        of[heads] = np.minimum(heads + 1, len(later) - 1)
        alone = np.repeat(sizes == 1, sizes)
        sources = [(columns[2][of], alone), (unpack(columns[3])[0][of], alone)]
        columns[3][heads] |= np.minimum(sizes, 2)
    else:
        later, first = later_copies(columns, heads)
        keep = later | first  # the same place of equal rows counts once
        columns, later = [c[keep] for c in columns], later[keep]
        columns[3][~later] |= 1
    grams, content, doc, place, row = columns
    # a later copy needs no comparison: it is dealt out by its place, not to the task of its gram
    grams[later] = mix64(mix64(mix64(doc[later].view(np.uint64)) + place[later].view(np.uint64)) + row[later].view(np.uint64)).view(np.int64)
    return [grams, content, doc, place, row, *sources]


def later_copies(columns: list[np.ndarray], heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For blocks sorted by content, document, row and place: which have an earlier copy, and which are the first of their row.

    An earlier copy starts in a document of a smaller id, or earlier in the same row. Rows that share
    an id hold no earlier copies of each other.
    """
    n = len(columns[0])
    runs = run_starts(*columns[:3], columns[4])
    first = np.zeros(n, dtype=bool)
    first[runs] = True
    start = unpack(columns[3])[0]
    later = columns[2] != np.repeat(columns[2][heads], np.diff(np.append(heads, n)))
    later |= start != np.repeat(start[runs], np.diff(np.append(runs, n)))
    return later, first


def blocks_of(docs: DataFrame, decode: Callable[[pa.RecordBatch], tuple[np.ndarray, Iterator[np.ndarray]]], width: int, gram: int, all_copies: bool) -> DataFrame:
    """Blocks of a table of doc_id, text and row. `decode` gives ids and unit codes of a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = block_table(*decode(batch), width, gram, batch.column(2).to_numpy(), all_copies)
            if len(columns[0]):
                yield as_batch(columns, block_columns(all_copies))

    return docs.mapInArrow(run, ddl(block_columns(all_copies)))


#: What judge() returns: rows whose whole block is repeated, and (doubt) those without an earlier copy whose gram has, or may have, other content too.
JUDGED = "doc_id long, start long, nwin int, doubt boolean, row long"


def judge(blocks: DataFrame, all_copies: bool) -> DataFrame:
    """Compare blocks of the same gram in a sorted stream that carries two rows at most from batch to batch.

    Repeated rows are those whose content also occurs elsewhere (all_copies, with source and source_start: where)
    or earlier (otherwise, see later_copies). Where several rows of one id hold a content first, all but one are in
    doubt in any case.
    """
    names = ("doc_id", "start", "nwin", "doubt", "row") + (_SOURCE if all_copies else ())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None  # first block of the last content, and of its last row if that is another
        known, many = False, False  # whether its gram has other content; whether its content has other rows

        def rows(columns: list[np.ndarray], pick: np.ndarray, doubt: bool) -> pa.RecordBatch:
            start, nwin, _ = unpack(columns[3][pick])
            out = [pa.array(columns[2][pick]), pa.array(start), pa.array(nwin.astype(np.int32)), pa.array(np.full(len(start), doubt)), pa.array(columns[4][pick])]
            if all_copies:
                blank = columns[7][pick] | doubt
                out += [pa.array(columns[5][pick], pa.int64(), mask=blank), pa.array(columns[6][pick], pa.int64(), mask=blank)]
            return pa.RecordBatch.from_arrays(out, names=list(names))

        for batch in batches:
            now = [c.to_numpy(zero_copy_only=False) for c in batch.columns[:5]]
            if not len(now[0]):
                continue
            if all_copies:  # sources as values and one mask of those that are not known yet
                blank = np.asarray(batch.column(5).is_null())
                now += [batch.column(i).fill_null(0).to_numpy(zero_copy_only=False) for i in (5, 6)] + [blank]
            fresh = np.arange(len(now[0]) + (len(held[0]) if held else 0)) >= (len(held[0]) if held else 0)
            if held is not None:
                now = [np.concatenate(x) for x in zip(held, now, strict=True)]
            heads = run_starts(*now[:2])
            sizes = np.diff(np.append(heads, len(now[0])))
            if all_copies:
                later, first = np.ones(len(now[0]), dtype=bool), None
                later[heads] = False
                of = np.repeat(heads, sizes)
                of[heads] = np.minimum(heads + 1, len(later) - 1)
                lacks = now[7] & np.repeat(sizes > 1, sizes)
                now[5], now[6] = now[5].copy(), now[6].copy()
                now[5][lacks], now[6][lacks] = now[2][of][lacks], unpack(now[3])[0][of][lacks]
                now[7] = now[7] & ~lacks
            else:
                later, first = later_copies(now, heads)
            later = (later | (now[3] & 3 == 0)) & fresh
            more = (sizes > 1) | (now[3][heads] & 3 > 1)
            more[0] |= many
            twin = now[0][heads][1:] == now[0][heads][:-1]
            doubt = np.zeros(len(heads), dtype=bool)
            doubt[0] = known
            doubt[1:] |= twin
            doubt[:-1] |= twin
            if later.any():
                yield rows(now, later, False)
            if not all_copies:
                first = first & fresh & ~later
                first[heads] = False
                if first.any():
                    yield rows(now, first, True)
            done = heads[:-1]
            if all_copies and more[:-1].any():
                yield rows(now, done[more[:-1]], False)
            if doubt[:-1].any():
                yield rows(now, done[doubt[:-1]], True)
            carry = heads[-1:] if all_copies else np.unique([heads[-1], run_starts(*now[:3], now[4])[-1]])
            held, known, many = [c[carry] for c in now], bool(doubt[-1]), bool(more[-1])
        if held is not None:
            if all_copies and many:
                yield rows(held, np.array([0]), False)
            if known:
                yield rows(held, np.array([0]), True)

    schema = JUDGED + (f", {ddl(_SOURCE)}" if all_copies else "")
    return blocks.repartition("gram").sortWithinPartitions("gram", "content", "doc_id", "row", "place").mapInArrow(run, schema)


#: Parts of documents that need a finer look: first unit, and the units as bytes.
PARTS = "doc_id long, start long, content binary, row long"
_PARTS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("content", pa.binary()), ("row", pa.int64())])


def finer(parts: DataFrame, decode: Callable[[bytes], np.ndarray], width: int, gram: int, cell: int, all_copies: bool) -> DataFrame:
    """Cells of up to `cell` windows of doubtful blocks, in the form of blocks for another judge().

    Cells lie on a grid that starts at the block's anchor, so equal windows fall into the same cell of their
    blocks. The first key of a cell is its core, the width - cell + 1 units that every window of that
    place holds; the second is the whole content. With cell = 1 the keys are the pair of names of a
    window's halves (they overlap by one unit where the width is odd), as in prefix doubling.
    """

    def cells(owners: list[int], starts: list[int], codes: list[np.ndarray], keys: list[int]) -> tuple[np.ndarray, ...]:
        joined, sizes = np.concatenate(codes), np.array([len(c) for c in codes])
        begins = np.cumsum(sizes) - sizes
        roll = Roller(joined)
        named = (mix64(roll.grams(gram)) & ~_PLACE) | np.arange(len(joined) - gram + 1, dtype=np.uint64)
        edges = np.stack([begins, begins + sizes - gram + 1], axis=1).ravel()
        named = np.append(named, np.iinfo(np.uint64).max)
        anchor = (np.minimum.reduceat(named, edges)[::2] & _PLACE).astype(np.int64) - begins
        nwin = sizes - width + 1
        high = anchor // cell
        n_cells = high - (anchor - nwin + 1) // cell + 1
        which = np.repeat(np.arange(len(codes)), n_cells)
        c = high[which] - (np.arange(len(which)) - np.repeat(np.cumsum(n_cells) - n_cells, n_cells))
        top = anchor[which] - c * cell  # last window of the full cell
        low = top - cell + 1
        begin, end = np.maximum(low, 0), np.minimum(top, nwin[which] - 1)
        base = begins[which]
        if cell == 1:  # the rank of the first half and the rank at the offset where the second half ends
            half = (width + 1) // 2
            core, whole = content_hash(roll, base + begin, base + begin + half), content_hash(roll, base + begin + width - half, base + begin + width)
        else:
            core, whole = content_hash(roll, base + top, base + low + width), content_hash(roll, base + begin, base + end + width)
        return core.view(np.int64), whole.view(np.int64), np.array(owners, dtype=np.int64)[which], pack(np.array(starts, dtype=np.int64)[which] + begin, end - begin + 1, 0), np.array(keys, dtype=np.int64)[which]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lots, held, owners, starts, codes, keys = [], 0, [], [], [], []
            for doc_id, start, content, row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                unit = decode(content)
                if held and held + len(unit) > BUFFER:
                    lots.append(cells(owners, starts, codes, keys))
                    held, owners, starts, codes, keys = 0, [], [], [], []
                owners.append(doc_id)
                starts.append(start)
                codes.append(unit)
                keys.append(row)
                held += len(unit)
            if held:
                lots.append(cells(owners, starts, codes, keys))
            if lots:
                yield as_batch(combine(lots, all_copies), block_columns(all_copies))

    return parts.mapInArrow(run, ddl(block_columns(all_copies)))


def cut_parts(docs: DataFrame, places: DataFrame, cutter: Callable[[bytes, list[tuple[int, int]]], list[bytes]], width: int) -> DataFrame:
    """The content of places (doc_id, row, start, nwin) of documents (doc_id, row, text), as PARTS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, starts, contents, keys = [], [], [], []
            for doc_id, text, wanted, row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                raw = text.encode() if isinstance(text, str) else text
                ids += [doc_id] * len(wanted)
                keys += [row] * len(wanted)
                starts += [w["start"] for w in wanted]
                contents += cutter(raw, [(w["start"], w["n"]) for w in wanted])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(contents, pa.binary()), pa.array(keys, pa.int64())], schema=_PARTS)

    return docs.join(spans(places, width), ["doc_id", "row"]).select("doc_id", "text", "spans", "row").mapInArrow(run, PARTS)


def recut(parts: DataFrame, places: DataFrame, cutter: Callable[[bytes, list[tuple[int, int]]], list[bytes]], width: int) -> DataFrame:
    """The content of smaller places inside stored parts, found by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, starts, contents, keys = [], [], [], []
            for doc_id, held, wanted, row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                held.sort(key=lambda p: p["start"])
                firsts = np.array([p["start"] for p in held])
                by_part: dict[int, list[tuple[int, int]]] = {}
                for w in wanted:
                    k = int(np.searchsorted(firsts, w["start"], "right")) - 1
                    by_part.setdefault(k, []).append((w["start"] - held[k]["start"], w["n"]))
                for k, places_in in by_part.items():
                    ids += [doc_id] * len(places_in)
                    keys += [row] * len(places_in)
                    starts += [held[k]["start"] + p[0] for p in places_in]
                    contents += cutter(held[k]["content"], places_in)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(contents, pa.binary()), pa.array(keys, pa.int64())], schema=_PARTS)

    by_doc = parts.groupBy("doc_id", "row").agg(F.collect_list(F.struct("start", "content")).alias("held"))
    return by_doc.join(spans(places, width), ["doc_id", "row"]).select("doc_id", "held", "spans", "row").mapInArrow(run, PARTS)


def spans(judged: DataFrame, width: int, by: tuple[str, ...] = ("doc_id", "row")) -> DataFrame:
    """Repeated windows as unit spans of each document: doc_id, row, spans (start, n, and the source where it is known; in no order)."""
    more = [c for c in _SOURCE if c in judged.columns]
    return judged.groupBy(*by).agg(F.collect_list(F.struct("start", (F.col("nwin") + F.lit(width - 1)).alias("n"), *more)).alias("spans"))


def covered(n: int, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A mask of units inside any span."""
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, np.clip(starts, 0, n), 1)
    np.add.at(change, np.clip(starts + lengths, 0, n), -1)
    return np.cumsum(change[:-1]) > 0


def factors(found: list[dict]) -> list[tuple[int, int, int, int]]:
    """Greedy parse of a document's repeated spans, from left to right: (start, n, source, source_start) of each factor.

    A factor runs on as long as the next span continues the same stretch of the same source; where it ends the next one
    begins, behind what is covered. Together the factors cover what the spans cover, and each repeats its source.
    """
    out: list[tuple[int, int, int, int]] = []
    begin = end = source = shift = None
    for s in sorted(found, key=lambda s: (s["start"], -s["n"])):
        start, stop, own = s["start"], s["start"] + s["n"], s["source_start"] - s["start"]
        if end is not None and start <= end and s["source"] == source and own == shift:
            end = max(end, stop)
            continue
        if end is not None:
            out.append((begin, end - begin, source, begin + shift))
            start = max(start, end)
            if stop <= start:  # nothing new: the last factor stays open
                out.pop()
                continue
        begin, end, source, shift = start, stop, s["source"], own
    return [*out, (begin, end - begin, source, begin + shift)] if end is not None else out
