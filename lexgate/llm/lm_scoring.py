"""Language-model scoring by prediction by partial matching: a byte-context trie with escapes and symbol exclusion."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, mix64, run_starts, stored
from .words import word_bounds, word_codes

#: Longest byte context; contexts run across words. A key holds the context, nearest byte first, and the symbol in its last byte.
ORDER = 5
#: Text that is scored with one lookup table, in bytes (a longer text is a block of its own), and symbols that are keyed at once.
BLOCK, LOT = 1 << 25, 1 << 20
#: Text bytes for each part of the keys; a part is one group of counting.
PART_BYTES = 1 << 22
_END, _SPACE = b"\n", b" "
#: Keys of words have the highest bit, keys of contexts and symbols have not; the end token is the word of all ones.
_WORD, _END_KEY = np.uint64(1 << 63), np.uint64(0xFFFFFFFFFFFFFFFF)


# ---- blocks of text


def coded(text: str, order: int) -> bytes:
    """What is predicted: each word and a space, then the end; the context of the first byte is `order` ends."""
    return _END * order + b"".join(w + _SPACE for w in text.encode().lower().split()) + _END  # bytes.lower() is A-Z only


def text_blocks(rows: DataFrame, order: int) -> DataFrame:
    """block, ids, held, sizes (lists with one entry a row) and body (compressed), for rows of doc_id, text and held_out."""
    schema = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int64())), ("raw_size", pa.int64()), ("body", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32

        def block(ids, held, texts):
            body = b"".join(texts)
            packed = pa.compress(body, codec="zstd", asbytes=True)
            return pa.RecordBatch.from_pylist([{"block": number, "ids": ids, "held": held, "sizes": [len(t) for t in texts], "raw_size": len(body), "body": packed}], schema=schema)

        ids, held, texts, size = [], [], [], 0
        for batch in batches:
            for doc_id, text, out in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
                one = coded(text.as_py(), order)
                if texts and size + len(one) > BLOCK:
                    yield block(ids, held, texts)
                    ids, held, texts, size = [], [], [], 0
                    number += 1
                ids.append(doc_id.as_py())
                held.append(out.as_py())
                texts.append(one)
                size += len(one)
        if texts:
            yield block(ids, held, texts)

    return rows.mapInArrow(run, "block long, ids array<long>, held array<boolean>, sizes array<long>, raw_size long, body binary")


class Block:
    """The texts of one block and their symbols and words."""

    def __init__(self, sizes: np.ndarray, raw_size: int, body: bytes, order: int):
        self.raw = np.frombuffer(pa.decompress(body, decompressed_size=raw_size, codec="zstd", asbytes=True), dtype=np.uint8)
        self.order, self.ends = order, np.cumsum(sizes)
        self.starts = self.ends - sizes

    def symbols(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Keys of all symbols, in lots, and the row of each."""
        k = self.order
        for at in range(0, len(self.raw), LOT):
            place = np.arange(at, min(at + LOT, len(self.raw)))
            row = np.searchsorted(self.ends, place, "right")
            real = place - self.starts[row] >= k
            place, row = place[real], row[real]
            yield context_keys(self.raw[max(at - k, 0) : at + LOT], place - max(at - k, 0), k), row

    def words(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Keys of all words, in lots, and the row of each; the end of each text, a word too, is left to the caller."""
        starts, ends = word_bounds(self.raw)
        for at in range(0, len(starts), LOT >> 2):
            first, last = starts[at : at + (LOT >> 2)], ends[at : at + (LOT >> 2)]
            yield (word_codes(self.raw, first, last) >> np.uint64(2)) | _WORD, np.searchsorted(self.ends, first, "right")


def context_keys(raw: np.ndarray, place: np.ndarray, order: int) -> np.ndarray:
    """The `order` bytes before each place, nearest first, and the byte there."""
    key = np.zeros(len(place), dtype=np.uint64)
    for j in range(1, order + 1):
        key = (key << np.uint64(8)) | raw[place - j].astype(np.uint64)
    return (key << np.uint64(8)) | raw[place].astype(np.uint64)


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their counts."""
    key, n = np.concatenate([np.empty(0, dtype=np.uint64), *keys]), np.concatenate([np.empty(0, dtype=np.int64), *counts])
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    heads = run_starts(key)
    return key[heads], np.add.reduceat(n, heads) if len(heads) else n


def tallied(key: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys (all but the highest bit of a key are free) and how many of each are training ones."""
    high = key & _WORD
    both, n = np.unique((key << np.uint64(1)) | train.astype(np.uint64), return_counts=True)
    plain = (both >> np.uint64(1)) | (high[0] if len(high) else np.uint64(0))
    heads = run_starts(plain)
    return plain[heads], np.add.reduceat(np.where(both & np.uint64(1), n, 0), heads) if len(heads) else n


# ---- packed keys: a block's keys of one part, as the differences of their order


def squeeze(values: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def expand(packed: bytes, n: int, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(pa.decompress(packed, decompressed_size=n * size, codec="zstd", asbytes=True), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(size, n).T).view(dtype).ravel()


def squeezed_keys(keys: np.ndarray) -> bytes:
    return squeeze(np.diff(keys, prepend=np.uint64(0)))


def expanded_keys(packed: bytes, n: int) -> np.ndarray:
    return np.cumsum(expand(packed, n, np.uint64), dtype=np.uint64)


ASKED = "part long, block long, size long, keys binary, counts binary"


def asked_keys(blocks: DataFrame, parts: int, order: int) -> DataFrame:
    """Every distinct key of each block with its training count, dealt to parts by a hash of the key."""
    schema = pa.schema([("part", pa.int64()), ("block", pa.int64()), ("size", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, held, sizes, raw_size, body in zip(*(batch.column(i) for i in range(5)), strict=True):
                block, train = Block(np.array(sizes.as_py()), raw_size.as_py(), body.as_py(), order), ~np.array(held.as_py())
                keys, counts = [np.array([_END_KEY])], [np.array([train.sum()])]
                for lots in (block.symbols(), block.words()):
                    for key, row in lots:
                        if len(key):
                            one = tallied(key, train[row])
                            keys.append(one[0])
                            counts.append(one[1])
                key, n = merged(keys, counts)
                part = (mix64(key) % np.uint64(parts)).astype(np.int64)
                deal = np.argsort(part, kind="stable")
                key, n, part = key[deal], n[deal], part[deal]
                heads = run_starts(part)
                out = [(part[s], number.as_py(), e - s, squeezed_keys(key[s:e]), squeeze(n[s:e])) for s, e in zip(heads.tolist(), [*heads[1:].tolist(), len(key)], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return blocks.select("block", "held", "sizes", "raw_size", "body").mapInArrow(run, ASKED)


def counted_keys(asked: DataFrame, tasks: int) -> DataFrame:
    """part, key, n: all distinct keys with their training counts."""

    def count(table: pa.Table) -> pa.Table:
        packs = list(zip(table["size"].to_pylist(), table["keys"].to_pylist(), table["counts"].to_pylist(), strict=True))
        key, n = merged([expanded_keys(k, m) for m, k, _ in packs], [expand(c, m, np.int64) for m, _, c in packs])
        return pa.table({"part": pa.repeat(table["part"][0], len(key)), "key": key.view(np.int64), "n": n})

    return asked.repartition(tasks, "part").groupBy("part").applyInArrow(count, "part long, key long, n long")


# ---- the trie: one table of nodes and one of contexts for each order


def shorter(key: Column) -> Column:
    """The same symbol after a context without its farthest byte."""
    return F.shiftleft(F.shiftright(key, 16), 8).bitwiseOR(key.bitwiseAND(F.lit(255)))


def trie_contexts(leaves: DataFrame, order: int) -> list[DataFrame]:
    """For each order, from 0: context, total, kinds, shadow and symbols (a map to counts, 256 entries at most).

    Counts are updated with exclusion: a node of the longest order has its occurrences, any other counts once
    for each longer context that it stands in. shadow is what the context's symbols count one order
    below: they are excluded there after an escape.
    """
    key, nodes, out = F.col("key"), leaves.select("key", "n"), []
    for k in range(order, -1, -1):
        below = stored(nodes.groupBy(shorter(key).alias("short")).agg(F.count("*").alias("below")), "nodes") if k else None
        rows = nodes.withColumn("short", shorter(key)).join(below, "short") if k else nodes.withColumn("below", F.lit(0).cast("long"))
        entry = F.struct(key.bitwiseAND(F.lit(255)).cast("int"), F.col("n"))
        grouped = rows.groupBy(F.shiftright(key, 8).alias("context"))
        out.append(stored(grouped.agg(F.sum("n").alias("total"), F.count("*").alias("kinds"), F.sum("below").alias("shadow"), F.map_from_entries(F.collect_list(entry)).alias("symbols")), "contexts"))
        nodes = below.select(F.col("short").alias("key"), F.col("below").alias("n")) if k else None
    return out[::-1]


def rated(grams: DataFrame, order: int) -> DataFrame:
    """part, key and value, the log10 probability of each symbol after its context, for part, key and n (training count, maybe 0).

    From the longest context down: a symbol of count n among a total T of the counts that are not excluded has
    (n - 1/2) / T, and D kinds leave D / 2T for the escape (method D), which excludes the context's symbols
    below. Under order 0 the symbols that are left of 256 share evenly.
    """
    contexts = trie_contexts(grams.where("n > 0"), order)
    key, zero = F.col("key"), F.lit(0).cast("long")
    known = grams.where("n > 0").withColumn("context", F.shiftright(key, 8)).join(contexts[order].select("context", "total"), "context")
    done = known.select("part", "key", F.log10((F.col("n") - 0.5) / F.col("total")).alias("value"))
    open_ = grams.where("n = 0").select("part", "key", key.alias("at"), F.lit(0.0).alias("value"), zero.alias("gone"), zero.alias("gone_kinds"))
    for k in range(order, -1, -1):
        x = open_.withColumn("context", F.shiftright("at", 8)).join(contexts[k], "context", "left")
        n = F.col("symbols")[F.col("at").bitwiseAND(F.lit(255)).cast("int")]
        mass, kinds = F.col("total") - F.col("gone"), F.col("kinds") - F.col("gone_kinds")
        step = F.when(n.isNotNull(), F.log10((n - 0.5) / mass)).when(kinds > 0, F.log10(kinds / 2 / mass)).otherwise(0.0)
        x = x.select("part", "key", shorter(F.col("at")).alias("at"), (F.col("value") + step).alias("value"), n.isNotNull().alias("found"),
                     F.coalesce("shadow", "gone").alias("gone"), F.coalesce("kinds", "gone_kinds").alias("gone_kinds"))
        x = stored(x, "open")
        done = done.unionByName(x.where("found").select("part", "key", "value"))
        open_ = x.where("not found").drop("found")
    return done.unionByName(open_.select("part", "key", (F.col("value") - F.log10(F.greatest(F.lit(256) - F.col("gone_kinds"), F.lit(1)))).alias("value")))


# ---- answers, back to the blocks that asked


def answered_keys(asked: DataFrame, values: DataFrame, tasks: int) -> DataFrame:
    """block, size, keys and values of what each block asked."""

    def answer(packs: pa.Table, table: pa.Table) -> pa.Table:
        key, value = table["key"].to_numpy().view(np.uint64), table["value"].to_numpy()
        order = np.argsort(key)
        key, value, out = key[order], value[order], []
        for size, keys in zip(packs["size"].to_pylist(), packs["keys"].to_pylist(), strict=True):
            out.append(squeeze(np.ascontiguousarray(value[np.searchsorted(key, expanded_keys(keys, size))])))
        return pa.table({"block": packs["block"], "size": packs["size"], "keys": packs["keys"], "values": pa.array(out, pa.binary())})

    dealt = [df.repartition(tasks, "part").groupBy("part") for df in (asked.select("part", "block", "size", "keys"), values)]
    return dealt[0].cogroup(dealt[1]).applyInArrow(answer, "block long, size long, keys binary, values binary")


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def block_scores(blocks: DataFrame, answers: DataFrame, spread: float, order: int, tasks: int) -> DataFrame:
    """Scores of the texts of all blocks; spread is N + V + 1 of the base score. The end token has the greatest key."""

    def score(block: pa.Table, found: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        text, m = Block(np.array(row["sizes"]), row["raw_size"], row["body"], order), len(row["ids"])
        sizes = found["size"].to_pylist()
        key = np.concatenate([expanded_keys(k, n) for k, n in zip(found["keys"].to_pylist(), sizes, strict=True)])
        value = np.concatenate([expand(v, n, np.float64) for v, n in zip(found["values"].to_pylist(), sizes, strict=True)])
        at = np.argsort(key)
        key, value = key[at], value[at]
        cut = int(np.searchsorted(key, _WORD))
        total = np.zeros(m)
        for wanted, of in text.symbols():
            total += np.bincount(of, weights=value[np.searchsorted(key[:cut], wanted)], minlength=m)
        tokens, known, base = np.ones(m, dtype=np.int64), np.full(m, value[-1] > 0, dtype=np.int64), np.full(m, np.log10((value[-1] + 1) / spread))
        for wanted, of in text.words():
            count = value[cut + np.searchsorted(key[cut:], wanted)]
            base += np.bincount(of, weights=np.log10((count + 1) / spread), minlength=m)
            tokens += np.bincount(of, minlength=m)
            known += np.bincount(of[count > 0], minlength=m)
        return pa.table({"doc_id": pa.array(row["ids"], pa.int64()), "held_out": pa.array(row["held"], pa.bool_()), "n_tokens": tokens, "n_known": known, "base_score": base, "score": total})

    dealt = [df.repartition(tasks, "block").groupBy("block") for df in (blocks, answers)]
    return dealt[0].cogroup(dealt[1]).applyInArrow(score, SCORED)


def score_texts(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """Scores of all texts under a model that learns from the rows where held_out (a function of the id column) is false.

    Texts are lower-cased (A-Z) and cut into words; each word and a space, then an end, are predicted byte by
    byte from a trie of contexts of up to `order` bytes, which run across words but not across texts (pretrained
    mode: all counts are those of the whole training set). Texts lie in blocks of about BLOCK bytes; a
    block asks for each distinct context and symbol once, the parts of the key space count and rate them, and
    the answers go back to the blocks, so one path serves all sizes and nothing is broadcast.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score. Null text counts as empty
    (one end token). A null id is a training row. Rows that share an id, equal ones too, are texts of their
    own with a result each. Ties do not occur. Extra columns are ignored; an empty table gives no rows.
    """
    if not 1 <= order <= 6:
        raise ValueError(f"order must lie between 1 and 6: {order}")
    spark = docs.sparkSession
    text, key = F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.col(id_col).cast("long")
    rows = docs.select(key.alias("doc_id"), text.alias("text"), F.coalesce(held_out(key), F.lit(False)).alias("held_out"))
    blocks = stored(text_blocks(rows, order), "blocks")
    size, n_blocks = blocks.agg(F.sum("raw_size"), F.count("*")).first()
    parts, least = max(8, int((size or 0) // PART_BYTES)), int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(least, parts // 8)  # a task takes some parts, or some blocks, whatever the size
    asked = stored(asked_keys(blocks, parts, order), "asked")
    counts = stored(counted_keys(asked, tasks), "counts")
    words = counts.where("key < 0")
    tokens, distinct = (v or 0 for v in words.agg(F.sum("n"), F.count_if(F.col("n") > 0)).first())
    values = rated(counts.where("key >= 0"), order).unionByName(words.select("part", "key", F.col("n").cast("double").alias("value")))
    out = block_scores(blocks, answered_keys(asked, values, tasks), float(tokens + distinct + 1), order, max(least, n_blocks // 2))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents; those whose crc32 of the id is 2 modulo 7 are held out. Rows as in score_texts."""
    return score_texts(documents(spark, sf_dir), lambda doc_id: F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2)
