"""Removal of repeated passages: suffix-array dedup over bytes, relative Lempel-Ziv dedup over words."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import blocks, words
from .common import documents, free_shuffles, keyed_text, stored, unused

#: Ids may be null; they are processed as the least id.
_NULL_ID = -(2**63)


def _rounds(docs: DataFrame, decode_docs, decode_part, cutter, width: int, gram: int, cells: tuple[int, ...], all_copies: bool) -> DataFrame:
    """Repeated runs of windows (doc_id, row, start, nwin): blocks first, then ever smaller cells of what is left in doubt."""
    spark, gram = docs.sparkSession, min(gram, max(1, width // 2))
    cells = tuple(c for c in cells if c == 1 or c <= width // 2)
    judged = stored(blocks.judge(blocks.blocks_of(docs, decode_docs, width, gram, all_copies), all_copies), "judged")
    free_shuffles(spark)
    found = [judged.where(~F.col("doubt"))]
    doubt = judged.where("doubt")
    parts = None
    for cell in cells:
        fresh = blocks.cut_parts(docs, doubt, cutter, width) if parts is None else blocks.recut(parts, doubt, cutter, width)
        parts = stored(fresh, "parts") if cell != cells[-1] else fresh
        judged = blocks.judge(blocks.finer(parts, decode_part, width, gram, cell, all_copies), all_copies)
        judged = stored(judged if cell != cells[-1] else judged.where(~F.col("doubt")), "judged")
        free_shuffles(spark)
        found.append(judged.where(~F.col("doubt")))
        doubt = judged.where("doubt")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.select("doc_id", "row", "start", "nwin", *(("source", "source_start") if all_copies else ()))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id (null is the least), text and row: a hash of the text where rows share the id, otherwise 0."""
    rows = keyed_text(docs, id_col, text_col).withColumn("doc_id", F.coalesce("doc_id", F.lit(_NULL_ID)))
    shared = stored(rows.groupBy("doc_id").count().where("count > 1").select("doc_id", F.lit(True).alias("shared")), "shared-ids")
    if not shared.limit(1).count():
        return rows.withColumn("row", F.lit(0).cast("long"))
    return rows.join(shared, "doc_id", "left").select("doc_id", "text", F.when(F.col("shared"), F.xxhash64("text")).otherwise(0).alias("row"))


def _masked(docs: DataFrame, found: DataFrame, width: int) -> DataFrame:
    """Documents with their repeated spans, as doc_id, text, spans (null for none)."""
    return docs.join(blocks.spans(found, width), ["doc_id", "row"], "left")


def _mask(n: int, spans: list | None) -> np.ndarray:
    if spans is None or not len(spans):
        return np.zeros(n, dtype=bool)
    return blocks.covered(n, np.array([s["start"] for s in spans]), np.array([s["n"] for s in spans]))


def repeated_bytes(docs: DataFrame, length: int = 100, gram: int = 32, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Byte spans of `length`-byte strings that also start earlier (smaller id, or earlier in the document).

    Content-defined blocks in place of prefix doubling over all positions (a row for each would exceed any disk): rounds
    of sorted names at growing lengths. The first names one anchor position for each block by its gram of
    `gram` bytes and by the block's content, the second compares cores of length - 7 bytes, the last the pair of names
    of a string's halves at an offset, as a doubling round does; what has no equal name is dropped between rounds.

    Returns doc_id, text, spans. Null text counts as empty, null ids as the least id; rows that share an
    id hold no earlier copies of each other, and all get the spans found for the id. Texts shorter than `length`
    have no spans. Extra columns are ignored; an empty table gives no rows.
    """
    rows = _keyed(docs, id_col, text_col)
    found = _rounds(rows, words.decode_bytes, words.bytes_as_units, words.cut_bytes, length, gram, (8, 1), all_copies=False)
    return _masked(rows, found, length)


def dedup_bytes(docs: DataFrame, length: int = 100) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (binary) after removal of repeated byte strings.

    Rows as in repeated_bytes: null text counts as empty, null ids stay null, rows that share an id have results of their own.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, spans in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                raw = np.frombuffer(text.encode(), dtype=np.uint8)
                mask = _mask(len(raw), spans)
                kept = raw[~mask].tobytes() if spans else raw.tobytes()
                runs = int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum()) if len(mask) else 0
                rows.append((None if doc_id == _NULL_ID else doc_id, len(raw), int(mask.sum()), runs, hashlib.sha256(kept).hexdigest(), kept))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)] if rows else [pa.array([], f.type) for f in schema], schema=schema)

    spans = repeated_bytes(docs, length).select("doc_id", "text", "spans")
    return spans.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def strip_repeated_bytes(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of docs, the text without what repeated_bytes finds in it; a character goes when all its bytes are in spans.

    Each row of a shared id loses the spans of its own text only, so equal rows of one id stay alike. Null ids count as
    the least; null and empty texts stay as they are. Other columns stay, whatever their names; an empty table gives no rows.
    """

    @F.pandas_udf("string")
    def strip(text: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for t, found in zip(text, spans, strict=True):
            if t and found is not None and len(found):
                raw = np.frombuffer(t.encode(), dtype=np.uint8)
                begins = np.flatnonzero((raw & 0xC0) != 0x80)
                gone = np.minimum.reduceat(_mask(len(raw), found), begins)
                t = raw[np.repeat(~gone, np.diff(np.append(begins, len(raw))))].tobytes().decode()
            out.append(t)
        return pd.Series(out, dtype=object)

    rows = _keyed(docs, id_col, text_col)
    found = blocks.spans(_rounds(rows, words.decode_bytes, words.bytes_as_units, words.cut_bytes, length, 32, (8, 1), all_copies=False), length)
    id_, row, spans = unused(docs, "id", "row", "spans")
    found = found.select(F.col("doc_id").alias(id_), F.col("row").alias(row), F.col("spans").alias(spans))
    own, key = F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit(""))), F.coalesce(docs[id_col].cast("long"), F.lit(_NULL_ID))
    joined = docs.join(found, (key == F.col(id_)) & ((F.col(row) == 0) | (F.col(row) == own)), "left")
    return joined.select(*[strip(F.col(f"`{c}`"), F.col(spans)).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])


def repeated_words(docs: DataFrame, window: int = 35, gram: int = 12, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Word spans of windows whose word sequence also starts anywhere else, the same document included.

    The matches of a relative Lempel-Ziv parse: every document is cut into content-defined reference blocks, and the
    index holds each block of the whole corpus under its anchor gram. A block of a document that the index holds
    elsewhere is a match with a source; it holds the words that its last window shares with the next, so no window is
    lost between two blocks. At the borders of matches (blocks whose gram is indexed with other content) cells and
    then single windows are looked up. factor_words() joins matches into factors.

    Returns doc_id, text, spans (start and n in words, source and source_start: a document and word where they are repeated). Null text has no words. Null ids count as the least
    id; rows that share an id are different occurrences, each with its own spans. Documents with fewer words than the window
    have no spans. Extra columns are ignored; an empty table gives no rows.
    """
    rows = _keyed(docs, id_col, text_col)
    found = _rounds(rows, words.decode_words, words.words_as_units, words.cut_words, window, gram, (4, 1), all_copies=True)
    return _masked(rows, found, window)


def factor_words(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text and factors of each row: a greedy parse relative to all documents.

    A factor (start, n, source, source_start; in words) repeats n words of another place, in the same document or in
    one of the id source, and goes on from match to match as long as they follow each other there too; only
    matches of `window` words or more begin one, so what factors cover is what repeated windows cover. Other words are
    literals. Null ids count as the least id, also as a source. Rows as in repeated_words.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("factors", pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "n", "source", "source_start")])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parsed = [[dict(zip(("start", "n", "source", "source_start"), f, strict=True)) for f in blocks.factors(spans or [])] for spans in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(parsed, schema.field("factors").type)], schema=schema)

    found = repeated_words(docs, window, id_col=id_col, text_col=text_col).select("doc_id", "text", "spans")
    return found.mapInArrow(run, "doc_id long, text string, factors array<struct<start:long,n:long,source:long,source_start:long>>")


def dedup_words(docs: DataFrame, window: int = 35) -> DataFrame:
    """doc_id, n_words, n_removed, n_factors (runs of removed words), kept_sha256, kept text without what factors cover, and factors.

    Rows as in repeated_words: null text has no words, null ids stay null, rows that share an id have results of their own.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("n_factors", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, found in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                tokens = text.encode().split()  # bytes.split() parts at exactly these separators
                mask = _mask(len(tokens), found)
                kept = b" ".join([t for t, out in zip(tokens, mask.tolist(), strict=True) if not out] if found else tokens)
                runs = int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum()) if len(mask) else 0
                rows.append((None if doc_id == _NULL_ID else doc_id, len(tokens), int(mask.sum()), runs, hashlib.sha256(kept).hexdigest(), kept.decode()))
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)] if rows else [pa.array([], f.type) for f in schema]
            yield pa.RecordBatch.from_arrays([*columns, batch.column(2)], names=[*schema.names, "factors"])

    kinds = "doc_id long, n_words long, n_removed long, n_factors long, kept_sha256 string, kept string"
    return factor_words(docs, window).mapInArrow(run, f"{kinds}, factors array<struct<start:long,n:long,source:long,source_start:long>>")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without words of windows of 35 that start elsewhere too; rows as in dedup_words."""
    return dedup_words(documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", "kept_sha256", "n_factors")


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without bytes of 100-byte strings that start earlier; rows as in dedup_bytes."""
    return dedup_bytes(documents(spark, sf_dir)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
