"""Cross-site boilerplate lines by distinct-site spread: HyperLogLog sketches, exact counts near the threshold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, row_hash, stored, unused
from .components import hub_join

#: Lines on so many sites or more are boilerplate.
MIN_SITES = 10
#: Sketch size (2 ** LG_K registers, standard error 1.04 / sqrt(2 ** LG_K)) and the errors around the threshold that call for exact counts.
LG_K, ERRORS = 11, 4.0
_SPACES = " \t\n\x0b\x0c\r"


def boilerplate_lines(docs: DataFrame, min_sites: int = MIN_SITES, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source") -> DataFrame:
    """Lines (by 64-bit hash of the stripped line) on min_sites distinct sites or more: key, k (places), first doc_id, row and line_no.

    A sketch of the sites of each line is merged by aggregation, so a line on a third of all rows
    costs one sketch a task. Lines whose estimate lies within ERRORS standard errors (1 at least) of the
    threshold get exact distinct counts of (line, site) pairs. Null sites count as one site of their own.
    """
    lines = line_table(docs, id_col, text_col, site_col)
    width = max(1.0, ERRORS * 1.04 / (2 ** (LG_K / 2)) * min_sites)
    spread = stored(
        lines.groupBy("key")
        .agg(F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch"), F.min(F.struct("doc_id", "row", "line_no")).alias("first"), F.count("*").alias("k"))
        .select("key", "k", F.hll_sketch_estimate("sketch").alias("sites"), "first")
        .where(F.col("sites") >= min_sites - width),
        "spread",
    )
    near = spread.where(F.col("sites") <= min_sites + width)
    exact = lines.join(near.select("key"), "key", "left_semi").groupBy("key", "site").count().groupBy("key").agg(F.count("*").alias("exact"))
    sure = spread.where(F.col("sites") > min_sites + width).select("key", "k", "first")
    return stored(sure.unionByName(near.join(exact.where(F.col("exact") >= min_sites), "key").select("key", "k", "first")).select("key", "k", "first.*"), "boilerplate")


def line_table(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """doc_id, row (see row_hash), line_no (from 0), site, key of each line that holds a word. The text is hashed before its lines part."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    site = F.coalesce(F.concat(F.lit("s"), F.col(site_col).cast("string")), F.lit("n"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), row_hash(id_col, text_col).alias("row"), site.alias("site"), text.alias("text"))
    lines = rows.select("doc_id", "row", "site", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    bare = F.trim("line", F.lit(_SPACES))
    return lines.select("doc_id", "row", "line_no", "site", bare.alias("bare")).where(F.col("bare") != "").select("doc_id", "row", "line_no", "site", F.xxhash64("bare").alias("key"))


def dedup_lines(docs: DataFrame, min_sites: int = MIN_SITES, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source") -> DataFrame:
    """All columns of the input, the text without boilerplate lines, and n_lines_, n_removed_ (with more underscores where taken).

    The first place of a boilerplate line in the corpus (least id, null ids first, then line) stays, so nothing that only
    copies hold is lost. Lines compare without the spaces around them; lines without a word stay. Null
    text stays null and has 0 lines; a text that loses all its lines becomes empty. Rows that share an id
    each lose lines of their own text only, and of those that hold a line first the one of the least hash
    of its text keeps it; rows equal in id and text are treated alike. An empty table gives no rows.

    Lines that stand in more than 1/512 of all places of boilerplate are looked up by broadcast, 512 at most, so no line fills a task.
    """
    marked = boilerplate_lines(docs, min_sites, id_col, text_col, site_col)
    row, drop, n_lines, n_removed = unused(docs, "row", "drop", "n_lines_", "n_removed_")
    first = marked.select("key", "k", F.col("doc_id").alias("first_doc"), F.col("row").alias("first_row"), F.col("line_no").alias("first_line"))
    places = hub_join(line_table(docs, id_col, text_col, site_col), first, "key", first.agg(F.sum("k")).first()[0] or 0)
    again = ~(F.col("doc_id").eqNullSafe(F.col("first_doc")) & (F.col("row") == F.col("first_row")) & (F.col("line_no") == F.col("first_line")))
    found = places.where(again).groupBy(F.col("row").alias(row)).agg(F.array_sort(F.collect_set("line_no")).alias("at"))
    # one byte for each line up to the last that goes: a byte is found in one step, however many lines go
    marks = F.transform(F.arrays_zip(F.concat(F.array(F.lit(-1)), "at").alias("before"), F.col("at")), lambda p: F.concat(F.repeat(F.lit("."), p["at"] - p["before"] - 1), F.lit("x")))
    found = found.where(F.size("at") > 0).select(row, F.size("at").alias(n_removed), F.array_join(marks, "").cast("binary").alias(drop))
    joined = docs.withColumn(row, row_hash(id_col, text_col)).join(found, row, "left")
    lines = F.split(F.col(text_col).cast("string"), "\n", -1)
    kept = F.array_join(F.filter(lines, lambda line, i: F.substring(F.col(drop), i + 1, F.lit(1)) != F.lit(bytearray(b"x"))), "\n")
    return joined.select(
        *[(F.when(F.col(drop).isNull(), F.col(c)).otherwise(kept).alias(c) if c == text_col else F.col(f"`{c}`")) for c in docs.columns],
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias(n_lines),
        F.coalesce(F.col(n_removed), F.lit(0)).cast("long").alias(n_removed),
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without lines on MIN_SITES sites or more; rows as in dedup_lines, a null text has no lines."""
    out = dedup_lines(documents(spark, sf_dir).select("doc_id", "text", "source"))
    return out.select(
        "doc_id",
        F.when(F.col("text").isNull(), 0).otherwise(F.col("n_lines_")).cast("long").alias("n_lines"),
        F.col("n_removed_").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


OP6_SQL = f"""
WITH numbered AS (
  SELECT doc_id, coalesce('s' || source, 'n') AS site, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no
  FROM documents WHERE text IS NOT NULL),
bare AS (SELECT *, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM numbered),
spread AS (
  SELECT bare, min({{'d': doc_id, 'l': line_no}}) AS first FROM bare WHERE bare != ''
  GROUP BY bare HAVING count(DISTINCT site) >= {MIN_SITES}),
flagged AS (
  SELECT b.*, s.first IS NOT NULL AND NOT (b.doc_id = s.first.d AND b.line_no = s.first.l) AS gone
  FROM bare b LEFT JOIN spread s ON b.bare = s.bare),
joined AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE NOT gone), '') AS kept
  FROM flagged GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN joined USING (doc_id)
"""
