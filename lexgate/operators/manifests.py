"""Batch manifests as JSON of a closed schema: made from tables, read with every fault named, checked before they are written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed as fx
from .batches import is_batch_id, status_counts, valid_path

#: The closed key sets of a manifest and its parts.
KEYS = ["schema", "schema_version", "batch_id", "created_at", "updated_at", "completed_at", "status", "workers", "selection", "counts", "files"]
SELECTION_KEYS = ["source", "selection_file", "parent_batch_id"]
FILE_KEYS = ["path", "status", "source_sha256", "error", "attempts", "started_at", "finished_at"]
COUNT_KEYS = ["total", *fx.FILE_STATUSES]
SCHEMA, MOST_WORKERS = "lexgate/batch-manifest", 10


def manifest_texts(files: DataFrame, headers: DataFrame) -> DataFrame:
    """batch_id and text of each batch: header columns, counts of its files, and its files by ord; nulls are written.

    The contract has one document for each batch, so its files meet in one row; tables of files have no such limit.
    """
    rows = files.withColumn("item_", F.struct("ord", F.struct(*FILE_KEYS).alias("file")))
    lists = rows.groupBy("batch_id").agg(F.transform(F.sort_array(F.collect_list("item_")), lambda i: i["file"]).alias("files"))
    counts = status_counts(files).select("batch_id", F.struct(*COUNT_KEYS).alias("counts"))
    whole = headers.join(counts, "batch_id", "left").join(lists, "batch_id", "left")
    none = F.struct(*[F.lit(0).cast("long").alias(k) for k in COUNT_KEYS])
    parts = {"schema": F.lit(SCHEMA), "schema_version": F.lit(1), "counts": F.coalesce("counts", none), "files": F.coalesce("files", F.array().cast(lists.schema["files"].dataType)),
             "selection": F.struct(F.col("selection_source").alias("source"), "selection_file", "parent_batch_id")}
    body = F.struct(*[(parts[k] if k in parts else F.col(k)).alias(k) for k in KEYS])
    return whole.select("batch_id", F.to_json(body, {"ignoreNullFields": "false"}).alias("text"))


def _keys_are(text: Column, keys: list[str]) -> Column:
    return F.coalesce(F.array_sort(F.json_object_keys(text)) == F.array(*map(F.lit, sorted(keys))), F.lit(False))


def _kind(v: str, path: str) -> Column:
    """What a value is: STRING, BIGINT, BOOLEAN, VOID (a JSON null) and so on; null where it is missing."""
    return F.expr(f"schema_of_variant(try_variant_get({v}, '$.{path}', 'variant'))")


def _value(v: str, path: str, kind: str = "string") -> Column:
    return F.expr(f"try_variant_get({v}, '$.{path}', '{kind}')")


def _text_or_null(v: str, path: str) -> Column:
    return F.coalesce(_kind(v, path).isin("STRING", "VOID"), F.lit(False))


def _named(checks: dict[str, Column]) -> Column:
    """Names of the checks that do not hold (null counts as not)."""
    return F.filter(F.array(*[F.when(~F.coalesce(fine, F.lit(False)), F.lit(name)) for name, fine in checks.items()]), lambda c: c.isNotNull())


def read_manifests(documents: DataFrame, repeats: bool = False) -> DataFrame:
    """name, batch_id and faults (names in order, empty for a sound manifest) of documents (name, content as bytes).

    A document must be UTF-8 and a JSON object with exactly the keys of the schema, without a key twice; its id must be its
    name without .json; times, states, workers, selection and each file are checked by type and value, and the counts
    against a recount of the files. Paths may repeat only with `repeats`. A bad document is a row, never a failed job.
    Files are checked as rows of their own, so a large manifest is no large task but for its text.
    """
    text = F.col("content").cast("string")
    docs = documents.select("name", F.when(F.expr("is_valid_utf8(cast(content AS string))"), text).alias("text"))
    docs = docs.withColumn("v", F.when(F.col("text").rlike(r"(?s)\A\s*\{"), F.expr("try_parse_json(text)")))
    whole = F.col("v").isNotNull()
    own_id, parent = _value("v", "batch_id"), _value("v", "selection.parent_batch_id")
    files_text, counts_text = F.get_json_object("text", "$.files"), F.get_json_object("text", "$.counts")
    head = {
        "keys": _keys_are(F.col("text"), KEYS),
        "schema": (_kind("v", "schema") == "STRING") & _value("v", "schema").rlike(r"\A[a-z0-9-]+/[a-z0-9-]+\z") & (_kind("v", "schema_version") == "BIGINT") & (_value("v", "schema_version", "long") == 1),
        "batch_id": (_kind("v", "batch_id") == "STRING") & is_batch_id(own_id),
        "name": own_id == F.regexp_replace("name", r"\.json\z", ""),
        "times": (_kind("v", "created_at") == "STRING") & (_value("v", "created_at") != "") & (_kind("v", "updated_at") == "STRING") & (_value("v", "updated_at") != "") & _text_or_null("v", "completed_at"),
        "status": (_kind("v", "status") == "STRING") & _value("v", "status").isin(*fx.BATCH_STATUSES),
        "workers": (_kind("v", "workers") == "BIGINT") & _value("v", "workers", "long").between(1, MOST_WORKERS),
        "selection": _keys_are(F.get_json_object("text", "$.selection"), SELECTION_KEYS) & _value("v", "selection.source").isin(*fx.SELECTION_SOURCES) & _text_or_null("v", "selection.selection_file")
        & ((_kind("v", "selection.parent_batch_id") == "VOID") | ((_kind("v", "selection.parent_batch_id") == "STRING") & is_batch_id(parent))),
        "files": _kind("v", "files").startswith("ARRAY"),
    }
    stored = {k: F.when(_kind("v", f"counts.{k}") == "BIGINT", _value("v", f"counts.{k}", "long")).alias(f"s_{k}") for k in COUNT_KEYS}
    told = docs.select("name", own_id.alias("batch_id"), whole.alias("whole"), _named(head).alias("head"), _keys_are(counts_text, COUNT_KEYS).alias("count_keys"), *stored.values(), F.from_json(files_text, "array<string>").alias("items"))
    items = told.select("name", F.explode("items").alias("item")).withColumn("i", F.expr("try_parse_json(item)"))
    sha = _value("i", "source_sha256")
    checks = {
        "file_keys": _keys_are(F.col("item"), FILE_KEYS),
        "path": (_kind("i", "path") == "STRING") & valid_path(_value("i", "path")),
        "file_status": (_kind("i", "status") == "STRING") & _value("i", "status").isin(*fx.FILE_STATUSES),
        "sha256": (_kind("i", "source_sha256") == "VOID") | ((_kind("i", "source_sha256") == "STRING") & sha.rlike(r"\A[0-9a-f]{64}\z")),
        "texts": _text_or_null("i", "error") & _text_or_null("i", "started_at") & _text_or_null("i", "finished_at"),
        "attempts": (_kind("i", "attempts") == "BIGINT") & (_value("i", "attempts", "long") >= 0),
    }
    rows = items.select("name", _value("i", "path").alias("path"), _value("i", "status").alias("status"), _named(checks).alias("bad"))
    by_path = rows.groupBy("name", "path").agg(F.count("*").alias("n"), F.array_distinct(F.flatten(F.collect_set("bad"))).alias("bad"), *[F.count_if(F.col("status") == s).alias(f"r_{s}") for s in fx.FILE_STATUSES])
    recount = by_path.groupBy("name").agg(F.sum("n").alias("r_total"), (F.max("n") > 1).alias("repeated"), F.array_distinct(F.flatten(F.collect_set("bad"))).alias("bad"), *[F.sum(f"r_{s}").alias(f"r_{s}") for s in fx.FILE_STATUSES])
    x = told.join(recount, "name", "left")
    equal = F.col("count_keys")
    for k in COUNT_KEYS:
        equal &= F.col(f"s_{k}").eqNullSafe(F.coalesce(f"r_{k}", F.lit(0)))
    none = F.array().cast("array<string>")
    in_order = F.filter(F.array(*map(F.lit, checks)), lambda c: F.array_contains(F.coalesce("bad", none), c))
    repeated = F.lit(False) if repeats else F.coalesce("repeated", F.lit(False))
    more = F.concat(in_order, F.when(repeated, F.array(F.lit("repeated"))).otherwise(none), F.when(equal, none).otherwise(F.array(F.lit("counts"))))
    return x.select("name", "batch_id", F.when(~F.coalesce("whole", F.lit(False)), F.array(F.lit("json"))).otherwise(F.concat("head", more)).alias("faults"))


def checked(texts: DataFrame) -> DataFrame:
    """Texts of manifests (batch_id, text) that may be written: the same rows, or an error where one of them has a fault."""
    found = read_manifests(texts.select(F.concat("batch_id", F.lit(".json")).alias("name"), F.col("text").cast("binary").alias("content")))
    bad = found.where(F.size("faults") > 0).limit(1).collect()
    if bad:
        raise ValueError(f"manifest {bad[0].name} would be damaged: {', '.join(bad[0].faults)}")
    return texts
