"""Words of UTF-8 text as 64-bit codes, on numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

from .blocks import BUFFER, Roller
from .common import mix64

BYTE_CODES = mix64(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Small documents are joined up to so many bytes before their words are taken.
LOT = 1 << 17


def word_bounds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-end byte of each word."""
    if not len(raw):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    inside = ~_SPACE[raw]
    change = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    edges = np.concatenate([[0] if inside[0] else [], change, [len(raw)] if inside[-1] else []]).astype(np.int64)
    return edges[::2], edges[1::2]


def word_codes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit code of each word; equal words have equal codes in every document."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        j = int(np.searchsorted(ends, starts[i] + BUFFER, "right"))
        if j <= i:  # one word longer than the buffer
            out[i] = xxhash.xxh3_64_intdigest(raw[starts[i] : ends[i]].tobytes())
            i += 1
            continue
        base = starts[i]
        roll = Roller(BYTE_CODES[raw[base : ends[j - 1]]])
        out[i:j] = mix64(roll.stretch(starts[i:j] - base, ends[i:j] - base) + (ends[i:j] - starts[i:j]).astype(np.uint64))
        i = j
    return out


def codes_of_texts(texts: list[bytes]) -> Iterator[np.ndarray]:
    """Word codes of each text, small texts taken together."""
    i = 0
    while i < len(texts):
        j, held = i, 0
        while j < len(texts) and (j == i or held + len(texts[j]) < LOT):
            held += len(texts[j]) + 1
            j += 1
        raw = np.frombuffer(b"\n".join(texts[i:j]), dtype=np.uint8)
        starts, ends = word_bounds(raw)
        codes = word_codes(raw, starts, ends)
        limits = np.cumsum([len(t) + 1 for t in texts[i:j]])
        cuts = np.searchsorted(starts, limits)
        yield from np.split(codes, cuts[:-1])
        i = j


def decode_words(batch: pa.RecordBatch) -> tuple[np.ndarray, Iterator[np.ndarray]]:
    return batch.column(0).to_numpy(), codes_of_texts([t.encode() for t in batch.column(1).to_pylist()])


def decode_bytes(batch: pa.RecordBatch) -> tuple[np.ndarray, Iterator[np.ndarray]]:
    return batch.column(0).to_numpy(), (BYTE_CODES[np.frombuffer(t.encode(), dtype=np.uint8)] for t in batch.column(1).to_pylist())


def bytes_as_units(content: bytes) -> np.ndarray:
    return BYTE_CODES[np.frombuffer(content, dtype=np.uint8)]


def words_as_units(content: bytes) -> np.ndarray:
    return next(codes_of_texts([content]))


def cut_bytes(raw: bytes, places: list[tuple[int, int]]) -> list[bytes]:
    return [raw[s : s + n] for s, n in places]


def cut_words(raw: bytes, places: list[tuple[int, int]]) -> list[bytes]:
    starts, ends = word_bounds(np.frombuffer(raw, dtype=np.uint8))
    return [raw[starts[s] : ends[s + n - 1]] for s, n in places]
