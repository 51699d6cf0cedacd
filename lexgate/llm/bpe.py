"""Byte-level BPE: backtracking encoder over Aho-Corasick matches, decoder over an offset table."""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, keyed_text

#: Fixed value: how byte-level BPE of this family splits text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Fixed value: white space as the tokenizer's pattern has it.
WHITE = r"\t-\r\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
#: A worker keeps the ids of so many different pieces of text, then starts anew.
CACHE = 300_000


def _byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of the 256 bytes in vocabulary files: printable ones stand for themselves, others follow from 256."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    """A vocabulary with the tables that encoding and decoding need."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = _byte_alphabet()
        model = spec["model"]
        as_bytes = lambda token: bytes(alphabet[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        tokens = {i: as_bytes(t) for t, i in model["vocab"].items() if t not in self.special}
        size = max([*tokens, *self.special.values()]) + 1
        self.bytes_of = [tokens.get(i, b"") for i in range(size)]
        for content, i in self.special.items():
            self.bytes_of[i] = content.encode()
        # merge order is the rank; split[i] are the two tokens that make token i, a byte splits into itself
        self.pair: dict[tuple[int, int], int] = {}
        self.split = [(i, i) for i in range(size)]
        self.rank = [-1] * size
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b, c = model["vocab"][left], model["vocab"][right], model["vocab"][left + right]
            self.pair[a, b] = c
            self.split[c], self.rank[c] = (a, b), rank
        self.matcher = ahocorasick.Automaton()
        for i, token in tokens.items():
            self.matcher.add_word(token.decode("latin-1"), i)
        self.matcher.make_automaton()
        # shorter[i] is the longest token that token i starts with, other than itself; -1 for none
        ids = {token: i for i, token in tokens.items()}
        self.shorter = [-1] * size
        for i, token in tokens.items():
            self.shorter[i] = next((ids[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in ids), -1)
        self.size_of = [len(t) for t in self.bytes_of]
        self.pieces = regex.compile(SPLIT.replace(r"\s", f"[{WHITE}]").replace(rf"[^[{WHITE}]", f"[^{WHITE}").replace(r"\S", f"[^{WHITE}]"))
        self.parts = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.longest = max(map(len, tokens.values()))
        self.fits: dict[tuple[int, int], bool] = {}
        self.known: dict[str, bytes] = {}
        self.flat = np.frombuffer(b"".join(self.bytes_of), dtype=np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in self.bytes_of])])

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging leaves these two neighbours apart: no pair across their border would have merged first.

        Both tokens are taken apart in reverse merge order along their border; at each step the pair across
        the border must not merge before the merge that is undone next.
        """
        key = (left, right)
        known = self.fits.get(key)
        if known is not None:
            return known
        rank, limit = self.rank, 1 << 60
        while True:
            merged = self.pair.get((left, right))
            if merged is not None and rank[merged] < limit:
                ok = False
                break
            if rank[left] < 0 and rank[right] < 0:
                ok = True
                break
            if rank[left] > rank[right]:
                limit, left = rank[left], self.split[left][1]
            else:
                limit, right = rank[right] + 1, self.split[right][0]
        if len(self.fits) >= 4 * CACHE:
            self.fits.clear()
        self.fits[key] = ok
        return ok

    def encode_piece(self, piece: str) -> list[int]:
        """Ids of one piece: longest matches first, shorter ones or a step back where neighbours are not compatible.

        The automaton gives the longest match at a place (each byte is a token, so there is one); shorter ones are its tokens' starts.
        """
        raw = piece.encode().decode("latin-1")
        n, pos, last = len(raw), 0, -1
        longest, match, fits, shorter, size_of = self.longest, self.matcher.iter_long, self.fits, self.shorter, self.size_of
        ids: list[int] = []
        dead = bytearray(n + 1)
        while pos < n:
            token = next(match(raw[pos : pos + longest]))[1]
            while token >= 0:
                if not dead[pos + size_of[token]]:
                    ok = last < 0 or fits.get((last, token))
                    if self.compatible(last, token) if ok is None else ok:
                        break
                token = shorter[token]
            if token >= 0:
                ids.append(token)
                pos += size_of[token]
                last = token
            else:
                dead[pos] = 1
                pos -= size_of[ids.pop()]
                last = ids[-1] if ids else -1
        return ids

    def packed(self, text: str) -> bytes:
        """Ids of a whole text as native 32-bit integers."""
        known, out = self.known, []
        for k, part in enumerate(self.parts.split(text) if self.parts else (text,)):
            if k % 2:
                out.append(np.uint32(self.special[part]).tobytes())
                continue
            for piece in self.pieces.findall(part):
                ids = known.get(piece)
                if ids is None:
                    ids = array("I", self.encode_piece(piece)).tobytes()
                    if len(piece) <= 64:
                        if len(known) >= CACHE:
                            known.clear()
                        known[piece] = ids
                out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.packed(text), dtype=np.uint32)

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids by one gather from the byte table; bytes that are no UTF-8 become replacement characters."""
        ids = np.asarray(ids, dtype=np.int64)
        starts = self.offsets[ids]
        sizes = self.offsets[ids + 1] - starts
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.arange(total) + np.repeat(starts - (ends - sizes), sizes)].tobytes().decode("utf-8", "replace")


@lru_cache(maxsize=4)
def load(path: str) -> Bpe:
    return Bpe(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def bpe_encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (array of int) of each whole text, as the tokenizers library gives them without added special tokens.

    Null and empty texts have no ids. Ids of rows may be null or repeat; each row is encoded by itself. Extra
    columns are ignored; an empty table gives no rows.
    """
    path = path or default_path()
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                packed = [bpe.packed(t.as_py()) for t in batch.column(1)]
                ends = np.cumsum([0, *(len(p) // 4 for p in packed)]).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(packed), dtype=np.int32))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), values)], schema=schema)

    return keyed_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def bpe_decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids and text of a table of doc_id and ids.

    Null ids count as none and give the empty text; doc_id may be null or repeat, each row is decoded by itself. Extra
    columns are ignored; an empty table gives no rows.
    """
    path = path or default_path()
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                texts = [bpe.decode(ids.values.to_numpy(zero_copy_only=False)) if ids.is_valid else "" for ids in batch.column(1)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(pa.list_(pa.int32())), pa.array(texts, pa.string())], schema=schema)

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of all documents and of what they decode to; rows as in bpe_encode."""
    done = bpe_decode(bpe_encode(documents(spark, sf_dir)))
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
