"""Spelling variants: words one edit apart, found by blocks of sorted forward and reversed dictionaries."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, stored
from .components import HUBS

RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: Words a task counts before it passes the sums on, and text whose runs are listed at once.
COUNTED, STRETCH = 200_000, 1 << 20
#: A block of more words is divided, as long as more than one sign of its words is open.
BLOCK = 256


def altered(doc_id: int | None, word: str, every: int = 199) -> str:
    """The word without one code point where a checksum of document and word says so; a document without id alters none."""
    h = zlib.crc32(f"{doc_id}:{word}".encode()) if doc_id is not None else 1
    if h % every:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6, least: int = 5) -> DataFrame:
    """word and n of the words of at least that length and count; a null text has no words."""

    def runs_of(text: str) -> Counter:
        found, at = Counter(), 0
        while at < len(text):
            end = min(at + STRETCH, len(text))
            while end < len(text) and RUN.match(text, end - 1, end) and RUN.match(text, end, end + 1):
                end += 1  # no run is cut
            found.update(RUN.findall(text[at:end].translate(_LOWER)))
            at = end
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for word, n in runs_of(text.as_py()).items():
                    word = altered(doc_id, word)
                    if len(word) >= least_length:
                        counts[word] += n
                if len(counts) >= COUNTED:
                    yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])
                    counts.clear()
        yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# ---- blocks
#
# Of two words one edit apart the shorter one (m signs) tells where they part: at i, the length of their common start.
# A block (m, a, b) holds words of m and m + 1 signs that share their first a and last b signs, for the pairs with
# a <= i < m - b (with i = m too where b is 0). The first two blocks of m split it in halves, dividing a block halves
# what is open, so each pair is in the care of exactly one block at any depth.


def _key(word: Column, m: Column, a: Column, b: Column) -> Column:
    return F.concat_ws(" ", m, a, b, F.substring(word, F.lit(1), a), F.substring(F.reverse(word), F.lit(1), b))


def _keyed(words: DataFrame) -> DataFrame:
    """Entries with the key of their block; words of m + 1 signs are entries of m as well as of m + 1."""
    return words.withColumn("key", _key(F.col("word"), F.col("m"), F.col("a"), F.col("b")))


def _first_entries(words: DataFrame) -> DataFrame:
    """Forward entries share the first half, reversed ones the rest; a word stands with its own length and with the words a sign shorter."""
    length = F.length("word")
    sized = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("m"))
    half = F.expr("m div 2")
    return _keyed(sized.select("word", "n", "m", F.explode(F.array(F.struct(half.alias("a"), F.lit(0).alias("b")), F.struct(F.lit(0).alias("a"), (F.col("m") - half).alias("b")))).alias("s")).select("word", "n", "m", "s.a", "s.b"))


def _divided(entries: DataFrame) -> DataFrame:
    """Each entry in the two blocks that halve what is open in its block."""
    half = F.expr("(m - a - b) div 2")
    parts = F.array(F.struct((F.col("a") + half).alias("a"), F.col("b")), F.struct(F.col("a"), (F.col("m") - F.col("a") - half).alias("b")))
    return _keyed(entries.select("word", "n", "m", F.explode(parts).alias("s")).select("word", "n", "m", "s.a", "s.b"))


def near_in_block(words: list[str], m: int, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (places of both words) of a block that are one edit apart and in its care."""
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    short, long = np.flatnonzero(sizes == m), np.flatnonzero(sizes == m + 1)
    if not len(short):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    signs = lambda at, n: np.frombuffer("".join(words[i] for i in at).encode("utf-16-le"), dtype=np.uint16).reshape(len(at), n)
    x, end, found = signs(short, m)[:, a : m - b], m - a - b, []
    for first in range(0, len(short), 128):
        rows = x[first : first + 128]
        differ = rows[:, None, :] != x[None, :, :]
        i, j = np.nonzero(differ.sum(axis=2) == 1)
        keep = i + first < j
        found.append((short[i[keep] + first], short[j[keep]]))
        if len(long):
            y = signs(long, m + 1)[:, a : m + 1 - b]
            for at in range(0, len(long), 512):
                some = y[at : at + 512]
                same = np.logical_and.accumulate(rows[:, None, :] == some[None, :, :end], axis=2).sum(axis=2)
                back = np.logical_and.accumulate(rows[:, None, ::-1] == some[None, :, :0:-1], axis=2).sum(axis=2)
                i, j = np.nonzero((same + back >= end) & ((same < end) | (b == 0)))
                found.append((short[i + first], long[j + at]))
    return np.concatenate([p for p, _ in found]), np.concatenate([q for _, q in found])


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """Pairs (word, near, near_n) of a table of distinct words and their counts, both ways round, that are one code point edit apart.

    Blocks of more than `block` words are divided until they hold no more or one sign is open; then a block holds
    as many words as there are signs and pairs of signs. Words are runs without spaces.
    """
    level, ready = _first_entries(words), None
    while True:
        sizes = level.groupBy("key", "m", "a", "b").agg(F.count("*").alias("k")).where((F.col("k") > block) & (F.col("m") - F.col("a") - F.col("b") > 1))
        sizes = stored(sizes.select("key", "k"), "blocks")
        total = sizes.agg(F.sum("k")).first()[0]
        if not total:
            break
        # blocks of more than 1/HUBS of these entries, HUBS at most, are named by broadcast, so that none fills a task
        hubs = sizes.where(F.col("k") > total / HUBS).select("key", F.lit(True).alias("hub"))
        seen = level.join(F.broadcast(hubs), "key", "left")
        rest = seen.where("hub is null").join(sizes.select("key", F.lit(True).alias("large")), "key", "left")
        told = stored(seen.where("hub").withColumn("large", F.lit(True)).unionByName(rest).drop("hub"), "entries")
        light = told.where("large is null").drop("large")
        ready = light if ready is None else ready.unionByName(light)
        level = _divided(told.where("large"))
    ready = level if ready is None else ready.unionByName(level)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        key = None

        def judged() -> pa.RecordBatch:
            words, counts = [w for w, *_ in held], np.array([n for _, n, *_ in held], dtype=np.int64)
            p, q = near_in_block(words, *held[0][2:])
            p, q = np.concatenate([p, q]), np.concatenate([q, p])
            names = pa.array(words, pa.string())
            return pa.RecordBatch.from_arrays([names.take(pa.array(p)), names.take(pa.array(q)), pa.array(counts[q])], names=["word", "near", "near_n"])

        for batch in batches:
            for k, *row in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if k != key:
                    if len(held) > 1:
                        yield judged()
                    held, key = [], k
                held.append(row)
        if len(held) > 1:
            yield judged()

    dealt = ready.select("key", "word", "n", "m", "a", "b").repartitionByRange("key").sortWithinPartitions("key")
    return dealt.mapInArrow(scan, "word string, near string, near_n long")


def spelling_variants(words: DataFrame, times: int = 5, block: int = BLOCK) -> DataFrame:
    """word, n, n_near, form, form_n and root of a table of distinct words and their counts n.

    Near words differ by one inserted, deleted or replaced code point. The form is the near word of largest n
    (ties: smallest in code-point order) where that is at least `times` n, else null; the root follows forms to
    the last one (times > 1, so that counts rise along forms). A word that is null or stands in two rows must not occur;
    an empty table gives no rows.
    """
    near = near_words(words, block).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best"))
    told = words.select("word", "n").join(near, "word", "left")
    led = -F.col("best.n") >= times * F.col("n")
    told = stored(told.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(led, F.col("best.near")).alias("form"), F.when(led, -F.col("best.n")).alias("form_n")), "forms")
    roots = told.where("form is not null").select("word", F.col("form").alias("root"))
    while True:  # every round doubles the steps
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = stored(roots.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        roots = stepped.select("word", "root")
        if stepped.where("moved").isEmpty():
            break
    return told.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants of the words of all documents: at least 6 code points and 5 occurrences.

    Null and empty texts have no words; a document of null id has its words as they stand; rows that share an id, and
    repeated rows, all count. Extra columns are ignored; an empty table gives no rows.
    """
    return spelling_variants(stored(word_counts(documents(spark, sf_dir)), "words"))


OP13_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c FROM range(256) r(i))),
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS k FROM runs GROUP BY 1, 2),
coded AS (
  SELECT run, k, CASE WHEN doc_id IS NULL THEN 1 ELSE xor(list_reduce(
    flatten(list_transform(string_split(doc_id || ':' || run, ''), lambda s: CASE WHEN unicode(s) < 128 THEN [CAST(unicode(s) AS BIGINT)] ELSE [CAST(192 + (unicode(s) >> 6) AS BIGINT), CAST(128 + unicode(s) % 64 AS BIGINT)] END)),
    lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1]), CAST(4294967295 AS BIGINT)), 4294967295) END AS h
  FROM counted, crc_table),
altered AS (SELECT CASE WHEN h % 199 = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word, k FROM coded),
words AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM altered WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
gaps AS (SELECT word, n, i, substring(word, 1, i - 1) || substring(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM gaps a JOIN gaps b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM gaps a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM gaps a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, max(near_n) AS top_n, arg_min(near, struct_pack(m := -near_n, w := near)) AS top FROM pairs GROUP BY word),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN top_n >= 5 * n THEN top END AS form, CASE WHEN top_n >= 5 * n THEN top_n END AS form_n FROM words w LEFT JOIN best USING (word)),
steps(word, last, depth) AS (SELECT word, word, 0 FROM forms UNION ALL SELECT s.word, f.form, depth + 1 FROM steps s JOIN forms f ON f.word = s.last WHERE f.form IS NOT NULL)
SELECT word, form, (SELECT arg_max(last, depth) FROM steps s WHERE s.word = forms.word) AS root, n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n FROM forms
"""
