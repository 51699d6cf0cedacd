"""Token counts: pieces are counted once for each distinct pre-token and joined to the pre-tokens of the documents."""

from __future__ import annotations

import re
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, keyed_text, run_starts, stored

#: Text bytes and documents of one block; the pre-tokens of a block are listed together. A longer text is a block of its own.
BLOCK, BLOCK_DOCS = 1 << 24, 1 << 16
#: Text bytes for each part of all pre-tokens; a part's pre-tokens meet in one group and are encoded there.
PART_BYTES = 1 << 24
#: Fixed value: what the piece library writes for a space, and puts before a text.
SPACE_SIGN = "▁"


class Pieces:
    """A piece vocabulary with the cuts that no piece can cross."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        vocabulary = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size()) if not self.model.is_byte(i)]
        if any(re.search(f"[^{SPACE_SIGN}]{SPACE_SIGN}", p) for p in vocabulary):
            raise ValueError("a piece of this vocabulary crosses a space, so texts have no pre-tokens")
        if self.model.normalize(" a  ①\n") != f"{SPACE_SIGN}{SPACE_SIGN}a{SPACE_SIGN}{SPACE_SIGN}①\n":
            raise ValueError("this vocabulary rewrites texts before it cuts them")
        used = set("".join(vocabulary))
        self.alone = next(c for c in map(chr, range(1, 32)) if c not in used)
        alone = re.escape("".join(c for c in map(chr, range(32)) if c not in used))
        self.cut = re.compile(f" *[^ {alone}]+| +|[{alone}]").findall

    def pre_tokens(self, text: str) -> list[str]:
        """What stands between cuts, in order: spaces with what follows them, and control signs that no piece holds."""
        return self.cut(" " + text.replace(SPACE_SIGN, " ")) if text else []

    def counts(self, pre_tokens: list[str]) -> list[int]:
        """Pieces of each pre-token. The library puts a space before what it encodes; a lone sign stands between it and a pre-token without one."""
        asked = [p[1:] if p[0] == " " else self.alone + p for p in pre_tokens]
        found = [len(x) for x in self.model.encode(asked, num_threads=1)]
        lone = len(self.model.encode(self.alone))
        bare = len(self.model.encode(" ")) - len(self.model.encode("")) if " " in pre_tokens else 0
        return [n - lone if p[0] != " " else n or bare for p, n in zip(pre_tokens, found, strict=True)]


@lru_cache(maxsize=2)
def load(path: str) -> Pieces:
    return Pieces(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _squeezed(a: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(a).tobytes(), codec="zstd", asbytes=True) if len(a) else b""


def _expanded(raw: bytes, size: int, kind: type) -> np.ndarray:
    return np.frombuffer(pa.decompress(raw, size * np.dtype(kind).itemsize, codec="zstd", asbytes=True), dtype=kind) if size else np.empty(0, dtype=kind)


LISTED = "block long, part int, n int, bytes int, lengths binary, pieces binary, entries int, held binary, places binary, times binary"
_LISTED = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("n", pa.int32()), ("bytes", pa.int32()), ("lengths", pa.binary()), ("pieces", pa.binary()), ("entries", pa.int32()), ("held", pa.binary()), ("places", pa.binary()), ("times", pa.binary())])


def listed_pre_tokens(docs: DataFrame, path: str, parts: int) -> DataFrame:
    """A row for each block of documents and part: its distinct pre-tokens (n, lengths, bytes) and where they stand.

    held has for each pre-token the number of its documents, places their numbers in the block, times how often each holds
    it. Part -1 of a block holds its documents instead: their ids (lengths), whether they have one (held) and sizes (times).
    """

    def rows_of(block: int, known: dict[str, int], pieces: array, places: array, times: array, ids: list, sizes: list) -> pa.RecordBatch:
        named = [np.array([i or 0 for i in ids], dtype=np.int64), np.array([i is not None for i in ids], dtype=np.uint8), np.array(sizes, dtype=np.int64)]
        out = [(block, -1, len(ids), 0, _squeezed(named[0]), b"", 0, _squeezed(named[1]), b"", _squeezed(named[2]))]
        raw = [p.encode() for p in known]
        part = np.fromiter((xxhash.xxh3_64_intdigest(p) for p in raw), dtype=np.uint64, count=len(raw)) % np.uint64(parts) if raw else np.empty(0, dtype=np.uint64)
        by_part = np.argsort(part, kind="stable")
        rank = np.empty(len(raw), dtype=np.int64)
        rank[by_part] = np.arange(len(raw))
        codes = rank[np.frombuffer(pieces, dtype=np.int32)] if len(pieces) else np.empty(0, dtype=np.int64)
        order = np.argsort(codes, kind="stable")
        held = np.bincount(codes, minlength=len(raw)).astype(np.int32)
        ends = np.concatenate([[0], np.cumsum(held)])
        place, time = (np.frombuffer(a, dtype=kind)[order] if len(order) else np.empty(0, dtype=kind) for a, kind in ((places, np.uint16), (times, np.int32)))
        starts = run_starts(part[by_part])
        for first, end in zip(starts, [*starts[1:], len(raw)], strict=True):
            own = [raw[i] for i in by_part[first:end]]
            text, at, to = b"".join(own), ends[first], ends[end]
            out.append((block, int(part[by_part[first]]), len(own), len(text), _squeezed(np.fromiter(map(len, own), dtype=np.int32, count=len(own))), _squeezed(np.frombuffer(text, dtype=np.uint8)),
                        int(to - at), _squeezed(held[first:end]), _squeezed(place[at:to]), _squeezed(time[at:to])))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _LISTED, strict=True)], schema=_LISTED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, block = load(path).pre_tokens, TaskContext.get().partitionId() << 32

        def fresh() -> tuple:
            known: defaultdict = defaultdict()
            known.default_factory = known.__len__
            return known, array("i"), array("H"), array("i"), [], []

        held, state = 0, fresh()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                size = len(text.encode())
                if state[4] and (held + size > BLOCK or len(state[4]) >= BLOCK_DOCS):
                    yield rows_of(block, *state)
                    held, state, block = 0, fresh(), block + 1
                known, pieces, places, times, ids, sizes = state
                found = Counter(cut(text))
                pieces.extend([known[p] for p in found])
                places.extend([len(ids)] * len(found))
                times.extend(found.values())
                ids.append(doc_id)
                sizes.append(size)
                held += size
        if state[4]:
            yield rows_of(block, *state)

    return docs.mapInArrow(run, LISTED)


def count_tokens(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes and n_tokens of each whole text, as the piece library counts them without begin and end.

    A pre-token is a run of spaces with what follows it; no piece of the vocabulary crosses its borders, so
    the pieces of a text are those of its pre-tokens. Blocks of documents list their distinct pre-tokens with the
    frequencies in their documents. The lists of all blocks meet by parts of a hash, where each distinct pre-token of the
    table is encoded once and only its count is kept; counts are joined to the lists of their block, which
    sums its documents. A list names a pre-token once, so a frequent one weighs no more than a row a block.

    A null text counts as empty and has no tokens; ids may be null or repeat, each row is counted by itself.
    Names of special tokens in a text are ordinary text. Extra columns are ignored; an empty table gives no
    rows. A vocabulary whose pieces cross spaces, or that rewrites texts, is refused.
    """
    path, rows = path or default_path(), keyed_text(docs, id_col, text_col)
    parts = max(8, int((rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // PART_BYTES))
    listed = stored(listed_pre_tokens(rows, path, parts), "pretokens")

    def count(packs: pa.Table) -> pa.Table:
        names, sizes = [], packs["n"].to_pylist()
        for n, size, lengths, pieces in zip(sizes, packs["bytes"].to_pylist(), packs["lengths"].to_pylist(), packs["pieces"].to_pylist(), strict=True):
            ends = np.concatenate([[0], np.cumsum(_expanded(lengths, n, np.int32))]).astype(np.int32)
            names.append(pa.StringArray.from_buffers(n, pa.py_buffer(ends.tobytes()), pa.py_buffer(_expanded(pieces, size, np.uint8).tobytes())))
        coded = pa.concat_arrays(names).dictionary_encode()
        n = np.array(load(path).counts(coded.dictionary.to_pylist()), dtype=np.int32)[coded.indices.to_numpy()]
        return pa.table({"block": packs["block"], "part": packs["part"], "counts": pa.array([_squeezed(x) for x in np.split(n, np.cumsum(sizes)[:-1])], pa.binary())})

    asked = listed.where("part >= 0").select("block", "part", "n", "bytes", "lengths", "pieces")
    counted = asked.groupBy("part").applyInArrow(count, "block long, part int, counts binary")

    def summed(lists: pa.Table, counts: pa.Table) -> pa.Table:
        of, sums = dict(zip(counts["part"].to_pylist(), counts["counts"].to_pylist(), strict=True)), None
        for row in sorted(lists.to_pylist(), key=lambda r: r["part"]):
            if row["part"] < 0:
                size = row["n"]
                ids, named, sizes = _expanded(row["lengths"], size, np.int64), _expanded(row["held"], size, np.uint8), _expanded(row["times"], size, np.int64)
                sums = np.zeros(size, dtype=np.int64)
                continue
            n = np.repeat(_expanded(of[row["part"]], row["n"], np.int32).astype(np.int64), _expanded(row["held"], row["n"], np.int32))
            np.add.at(sums, _expanded(row["places"], row["entries"], np.uint16), n * _expanded(row["times"], row["entries"], np.int32))
        return pa.table({"doc_id": pa.array(ids, mask=named == 0), "n_bytes": sizes, "n_tokens": sums})

    own = listed.select("block", "part", "n", F.when(F.col("part") < 0, F.col("lengths")).alias("lengths"), "entries", "held", "places", "times")
    return own.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(summed, "doc_id long, n_bytes long, n_tokens long")


#: Tokens above which a document is over the limit of op11_token_counts.
LIMIT = 4096


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents; rows as in count_tokens."""
    return count_tokens(documents(spark, sf_dir)).withColumn("over_limit", F.col("n_tokens") > LIMIT)
