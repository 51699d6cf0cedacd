"""Sources: Markdown files under a folder, decoding, selection lists, prompts."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from pathlib import Path, PurePosixPath

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed as fx
from ..functions.rows import by_rows

SOURCES = "rel_path string, size long, content binary, source_sha256 string, text string, source_chars int, plan_error string"


#: Files that one task reads.
FILES_A_TASK = 64


def decode_text(raw: bytes) -> str | None:
    """The first codec that reads all bytes, or None. Line ends stay."""
    for codec in fx.CODECS:
        try:
            return raw.decode(codec)
        except UnicodeDecodeError:
            continue
    return None


@by_rows(T.StringType())
def decoded(raw: bytes | None) -> str | None:
    return None if raw is None else decode_text(raw)


def inside(path: Path, base: Path) -> bool:
    return path.resolve().is_relative_to(base.resolve())


def list_markdown(folder: str) -> list[str]:
    """Relative posix paths of Markdown files: regular, no links, no cleaned outputs, in order of lower case.

    The listing is walked here because Spark's file source drops names that start with _ or . and follows
    links. Unreadable entries are skipped; a missing folder has no files.
    """
    base, out = Path(folder), []
    for top, _, names in os.walk(base):
        for name in names:
            path = Path(top) / name
            if path.suffix.lower() == ".md" and not path.stem.lower().endswith("_cleaned") and not path.is_symlink() and path.is_file() and inside(path, base):
                out.append(path.relative_to(base).as_posix())
    return sorted(out, key=lambda p: (p.lower(), p))


#: Folders that one task lists.
FOLDERS_A_TASK = 32


def listed_folders(spark: SparkSession, folder: str, store: str) -> DataFrame:
    """rel_path of the Markdown files that list_markdown() finds, from one job for each level of folders.

    A job lists the folders of a level in its tasks and stores what they hold under `store` (a new folder); the folders found
    are the next level's table, so neither files nor folders lie on the driver. Links to folders are not followed,
    unreadable folders hold nothing. The folder must be reachable from the executors.
    """
    base = str(Path(folder).resolve())

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for top in batch.column(0).to_pylist():
                paths, folders = [], []
                try:
                    with os.scandir(os.path.join(base, top) if top else base) as entries:
                        for e in entries:
                            path = f"{top}/{e.name}" if top else e.name
                            if e.is_symlink():
                                continue
                            if e.is_dir():
                                folders.append(path)
                            elif e.is_file() and Path(e.name).suffix.lower() == ".md" and not Path(e.name).stem.lower().endswith("_cleaned"):
                                paths.append(path)
                except OSError:
                    continue
                kinds = [True] * len(folders) + [False] * len(paths)
                yield pa.RecordBatch.from_arrays([pa.array(folders + paths, pa.string()), pa.array(kinds, pa.bool_())], names=["rel_path", "is_folder"])

    level, depth = spark.createDataFrame([("",)], "rel_path string"), 0
    while True:
        count = level.count()
        if not count:
            break
        dealt = level.repartition(max(1, -(-count // FOLDERS_A_TASK)), "rel_path")
        dealt.mapInArrow(look, "rel_path string, is_folder boolean").write.parquet(f"{store}/level={depth}")
        level = spark.read.schema("rel_path string, is_folder boolean").parquet(f"{store}/level={depth}").where("is_folder").select("rel_path")
        depth += 1
    found = spark.read.schema("rel_path string, is_folder boolean, level int").option("basePath", store).parquet(*(f"{store}/level={i}" for i in range(depth)))
    return found.where("NOT is_folder").select("rel_path")


def ordered_paths(paths: DataFrame, store: str) -> DataFrame:
    """ord and rel_path: places from 0 in the order of the lower-case path, then of the path, by a range sort that is stored under `store`."""
    lower = F.lower("rel_path")
    paths.repartitionByRange(lower, "rel_path").sortWithinPartitions(lower, "rel_path").select(F.monotonically_increasing_id().alias("ord"), "rel_path").write.parquet(store)
    return dense(paths.sparkSession.read.schema("ord long, rel_path string").parquet(store))


def dense(stored: DataFrame) -> DataFrame:
    """A stored table whose ord is partition and place (monotonically_increasing_id) with 0, 1, 2 and so on; a count for each partition comes to the driver."""
    part = F.shiftright("ord", 33)
    counts = sorted((r["part"], r["n"]) for r in stored.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    starts, n = [], 0
    for p, k in counts:
        starts.append((p, n - (p << 33)))
        n += k
    table = stored.sparkSession.createDataFrame(starts, "part_ long, shift_ long")
    return stored.join(F.broadcast(table), part == F.col("part_")).withColumn("ord", F.col("ord") + F.col("shift_")).select(*stored.columns)


SOURCES = "ord long, " + SOURCES


def read_sources(spark: SparkSession, folder: str, paths: list[str] | DataFrame, max_bytes: int = fx.MAX_FILE_BYTES, with_text: bool = True) -> DataFrame:
    """One row for each path, read once in the tasks: hash, text and error come from the same bytes. ord is the path's place.

    Paths are a list, or a table of ord and rel_path for folders that no driver should hold. The folder must be
    reachable from the executors. Missing, large or undecodable files are rows with plan_error; they never
    fail the job. Without with_text only hashes are kept. One task reads about FILES_A_TASK files.
    """
    if isinstance(paths, list):
        listed = spark.createDataFrame(pd.DataFrame({"ord": pd.Series(range(len(paths)), dtype="int64"), "rel_path": pd.Series(paths, dtype=str)}), "ord long, rel_path string")
        count = len(paths)
    else:
        listed, count = paths.select(F.col("ord").cast("long"), "rel_path"), paths.count()
    schema = pa.schema([("ord", pa.int64()), ("rel_path", pa.string()), ("size", pa.int64()), ("content", pa.binary()), ("source_sha256", pa.string()), ("text", pa.string()), ("source_chars", pa.int32()), ("plan_error", pa.string())])

    def row_of(number: int, rel: str) -> dict:
        path, row = Path(folder) / rel, {"ord": number, "rel_path": rel}
        try:
            row["size"] = path.stat().st_size
            if not inside(path, Path(folder)):
                return row | {"plan_error": "the path leaves the input folder"}
            if row["size"] > max_bytes:
                return row | {"plan_error": f"the file has {row['size']} bytes, more than {max_bytes}"}
            raw = path.read_bytes()
        except OSError as e:
            return row | {"plan_error": f"cannot read: {e.strerror}"}
        row |= {"size": len(raw), "source_sha256": hashlib.sha256(raw).hexdigest()}
        if not with_text:
            return row
        row |= {"content": raw, "text": decode_text(raw)}
        if row["text"] is None:
            return row | {"plan_error": "no codec reads the file"}
        if len(raw) > max_bytes:
            return row | {"plan_error": f"the file has {len(raw)} bytes, more than {max_bytes}"}
        return row | {"source_chars": len(row["text"])}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, rel in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield pa.RecordBatch.from_pylist([row_of(number, rel)], schema=schema)

    return listed.repartition(max(1, -(-count // FILES_A_TASK)), "ord").mapInArrow(read, SOURCES)


def hashes_now(spark: SparkSession, folder: str, max_bytes: int = fx.MAX_FILE_BYTES):
    """A function from a table of rel_path to rel_path and the hash that each file has now (null: it cannot be read)."""
    return lambda paths: read_sources(spark, folder, paths.select(F.lit(0).alias("ord"), "rel_path"), max_bytes, with_text=False).select("rel_path", "source_sha256")


def table_sources(df: DataFrame, path, text) -> DataFrame:
    """Rows of a table as sources."""
    return df.select(path.alias("rel_path"), F.octet_length(text).cast("long").alias("size"), text.cast("binary").alias("content"), F.sha2(text.cast("binary"), 256).alias("source_sha256"), text.alias("text"), F.length(text).alias("source_chars"), F.lit(None).cast("string").alias("plan_error"))


def safe_relative(path: str) -> bool:
    parts = path.split("/")
    return not ("\\" in path or path.startswith("/") or re.match(r"[A-Za-z]:", path) or any(p in ("", ".", "..") for p in parts))


def without_links(folder: str, path: str) -> bool:
    """Whether neither the folder nor any part of the path below it is a symbolic link."""
    at = Path(folder)
    if at.is_symlink():
        return False
    for part in path.split("/"):
        at /= part
        if at.is_symlink():
            return False
    return True


def resolved_paths(paths: list, folder: str) -> list[str]:
    """Relative paths of Markdown files inside the folder, each file once, in order. Raises ValueError for any that is unsafe.

    Paths must be normal, hold no links, end in .md and be no cleaned output; what exists must be a file. Files
    are told apart by their resolved path, so two spellings of one file count once. Missing files pass:
    they fail by themselves when they are read.
    """
    found: dict[str, str] = {}
    for p in paths:
        if not isinstance(p, str) or not p or not safe_relative(p):
            raise ValueError(f"unsafe path: {p!r}")
        if not p.lower().endswith(".md") or PurePosixPath(p).stem.lower().endswith("_cleaned"):
            raise ValueError(f"no source file: {p!r}")
        if not without_links(folder, p):
            raise ValueError(f"the path holds a link: {p!r}")
        target = Path(folder) / p
        if not inside(target, Path(folder)):
            raise ValueError(f"the path leaves the folder: {p!r}")
        if target.exists() and not target.is_file():
            raise ValueError(f"no regular file: {p!r}")
        found.setdefault(os.path.normcase(str(target.resolve())), p)
    return list(found.values())


def read_selection(file: str, schema_id: str | None = None, base: str | None = None) -> list[str]:
    """Paths of a selection list: UTF-8 JSON of a closed schema, in order. Raises ValueError for any fault.

    The list must be a file, and inside `base` where that is given. Without a schema_id any name of the form
    <tool>/selection is taken, so lists that other tools of this contract wrote can be read.
    """
    path = Path(file)
    if not path.is_file():
        raise ValueError(f"no selection list: {file}")
    if base is not None and not inside(path, Path(base)):
        raise ValueError(f"the selection list leaves the folder: {file}")
    try:
        data = json.loads(path.read_bytes().decode("utf-8-sig"))
    except ValueError as e:
        raise ValueError(f"the selection list is no UTF-8 JSON: {e}") from None
    if not isinstance(data, dict) or not {"schema", "schema_version", "source", "paths"} <= set(data):
        raise ValueError("a selection has schema, schema_version, source and paths")
    named = data["schema"] == schema_id if schema_id else isinstance(data["schema"], str) and re.fullmatch(r"[a-z0-9-]+/selection", data["schema"])
    if not named or type(data["schema_version"]) is not int or data["schema_version"] != 1:
        raise ValueError("unknown selection schema")
    if data["source"] != {"kind": "files", "root": None} or not isinstance(data["paths"], list):
        raise ValueError("a selection names files by paths")
    for p in data["paths"]:
        if not isinstance(p, str) or not safe_relative(p):
            raise ValueError(f"unsafe path: {p!r}")
    return list({str(PurePosixPath(p)): None for p in data["paths"]})


def unfenced(text: str) -> str:
    """The text without one fence around all of it."""
    text = text.strip()
    found = re.fullmatch(r"```(?:markdown|md|text)?[ \t]*\r?\n(.*?)\r?\n```[ \t]*", text, re.DOTALL | re.IGNORECASE)
    return found[1].strip() if found else text


def prompt_identity(raw: str) -> tuple[str, str, list[str]]:
    """(text, hash, aliases) of a prompt: the hash is of \n lines; aliases are hashes that other line ends would give."""
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    text = unfenced(raw.replace("\r\n", "\n").replace("\r", "\n"))
    main = sha(text)
    return text, main, [h for h in dict.fromkeys((sha(unfenced(raw)), sha(text.replace("\n", "\r\n")))) if h != main]
