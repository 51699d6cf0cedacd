"""Job parameters: addresses, compatible options, and the choice of sources of a run."""

from __future__ import annotations

import argparse
import ipaddress
import json
import os
import re
from pathlib import Path
from urllib.parse import urlsplit, urlunsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed as fx
from ..functions import text as tx
from ..functions.markdown import md_chunks
from ..operators import batches, quality, transport
from ..sources import files, state
from ..sources.sinks import append_log, export_documents, log_rows, newest, read_versions
from . import clean_batch

#: Environment names of a connection and its limits; the thresholds have QUALITY_<NAME>.
ENVIRONMENT = {"key": "OPENAI_API_KEY", "base_url": "OPENAI_BASE_URL", "model": "OPENAI_MODEL"}
LIMITS = {"window": "OPENAI_CONTEXT_WINDOW", "output": "OPENAI_MAX_OUTPUT_TOKENS", "margin": "OPENAI_SAFETY_MARGIN_TOKENS"}
LIMIT_NAME = "OPENAI_TOKEN_PARAMETER"


def base_url(value: str) -> str:
    """An https address, or http on this host, without user, query and fragment, and without a slash at the end."""
    value = value.strip()
    if not value:
        return ""
    parts = urlsplit(value)
    host = (parts.hostname or "").rstrip(".").lower()
    if parts.scheme not in ("http", "https") or not host:
        raise ValueError("the address needs http or https and a host")
    if parts.scheme == "http" and host != "localhost":
        try:
            local = ipaddress.ip_address(host).is_loopback
        except ValueError:
            local = False
        if not local:
            raise ValueError("http is for this host only")
    if parts.username or parts.password or parts.query or parts.fragment:
        raise ValueError("the address must not hold a user, a query or a fragment")
    return urlunsplit((parts.scheme, parts.netloc, parts.path.rstrip("/"), "", ""))


#: Names the base folder where no option does.
HOME = "LEXGATE_HOME"


def env_file(path: Path) -> dict[str, str]:
    """Variables of a .env file: NAME=value lines, with or without export and quotes; # begins a comment. Without the file, none."""
    if not path.is_file():
        return {}
    found = {}
    for line in path.read_text(encoding="utf-8-sig").splitlines():
        m = re.fullmatch(r"\s*(?:export\s+)?([A-Za-z_][A-Za-z0-9_]*)\s*=\s*(.*?)\s*", line)
        if not m:
            continue
        value = m[2]
        quoted = re.fullmatch(r"""(?:'([^']*)'|"((?:[^"\\]|\\.)*)")\s*(?:#.*)?""", value)
        if quoted:
            value = quoted[1] if quoted[1] is not None else quoted[2].replace('\\"', '"').replace("\\n", "\n")
        else:
            value = re.sub(r"(?:^|\s+)#.*", "", value)
        found[m[1]] = value
    return found


def connection(env: dict[str, str]) -> dict[str, str]:
    """key, base_url and model from the environment, the address checked."""
    found = {name: (env.get(variable) or "").strip() for name, variable in ENVIRONMENT.items()}
    return found | {"base_url": base_url(found["base_url"])}


def limits(env: dict[str, str]) -> transport.Budget:
    """The token budget from the environment."""
    sizes = {}
    for name, variable in LIMITS.items():
        raw = (env.get(variable) or "").strip()
        if raw and not raw.isdigit():
            raise ValueError(f"{variable} must be a whole number, 0 or more: {raw}")
        if raw:
            sizes[name] = int(raw)
    named = (env.get(LIMIT_NAME) or "").strip()
    return transport.Budget(**sizes, **({"limit_name": named} if named else {}))


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m lexgate", description="Clean a folder of Markdown files as a Spark job.")
    p.add_argument("--base-dir", help=f"holds input/, store/, output/, prompt.md and .env; else {HOME} names it, else it is the current folder")
    p.add_argument("--selection-file")
    for name, text in (("resume-batch", "go on with a batch"), ("retry-failed", "a new batch of a batch's failures")):
        p.add_argument(f"--{name}", nargs="?", const="latest", metavar="ID", help=text)
    for name in ("accept-failed", "batch-status", "dry-run", "stop", "force-unlock"):
        p.add_argument(f"--{name}", action="store_true")
    p.add_argument("--strict", action=argparse.BooleanOptionalAction, default=True)
    p.add_argument("--max-files", type=int, default=0)
    p.add_argument("--workers", type=int, default=1)
    p.add_argument("--max-chars", type=int, default=fx.MAX_CHARS)
    p.add_argument("--max-file-size", type=int, default=fx.MAX_FILE_BYTES)
    p.add_argument("--base-url", default="")
    p.add_argument("--model", default="")
    return p


def checked(o: argparse.Namespace) -> argparse.Namespace:
    """The options, or ValueError for values and combinations that make no sense."""
    chosen = [n for n in ("selection_file", "resume_batch", "retry_failed", "dry_run") if getattr(o, n)]
    rules = [
        (1 <= o.workers <= 10, "workers must lie between 1 and 10"),
        (1 <= o.max_chars <= 1_000_000, "max-chars must lie between 1 and 1000000"),
        (o.max_file_size > 0 and o.max_files >= 0, "limits must not be negative"),
        (not o.accept_failed or bool(o.retry_failed), "accept-failed needs retry-failed"),
        (not o.batch_status or not chosen, "batch-status stands alone"),
        (not (o.resume_batch and o.retry_failed), "resume-batch and retry-failed exclude each other"),
        (not ((o.resume_batch or o.retry_failed) and (o.selection_file or o.dry_run)), "a stored batch has its own files, and is no dry run"),
        (o.workers == 1 or not o.dry_run, "a dry run has one worker"),
        (all(v in (None, "latest") or re.fullmatch(fx.BATCH_ID, v) for v in (o.resume_batch, o.retry_failed)), "no batch id"),
    ]
    for fine, said in rules:
        if not fine:
            raise ValueError(said)
    o.base_url = base_url(o.base_url)
    return o


def stored_files(spark: SparkSession, store: str, batch: str) -> DataFrame:
    """The files of a stored batch (or of the one written last) as they were last written."""
    found = read_versions(spark, f"{store}/batch_files", clean_batch.FILES)
    if batch == "latest":
        last = batches.latest(read_versions(spark, f"{store}/batches", clean_batch.HEADER)).first()
        batch = last.batch_id if last else ""
    own = newest(found.where(F.col("batch_id") == batch), ["batch_id", "path"])
    if own.limit(1).count() == 0:
        raise ValueError(f"no batch {batch}")
    bad = batches.faults(own).limit(1).collect()
    if bad:
        raise ValueError(f"batch {batch} is damaged: {bad[0].path}: {', '.join(bad[0].faults)}")
    return own


def _listed(spark: SparkSession, folder: str, store: str) -> DataFrame:
    """ord and rel_path of all files of the folder, listed and ordered in tasks."""
    if not Path(folder).is_dir():
        return spark.createDataFrame([], "ord long, rel_path string")
    place = f"{store}/listings/{clean_batch.new_batch_id()}"
    return files.ordered_paths(files.listed_folders(spark, folder, f"{place}/levels"), f"{place}/paths")


def _paths(rows: DataFrame) -> list[str]:
    return [r.path for r in rows.select("path", "ord").orderBy("ord").toLocalIterator()]


def chosen(spark: SparkSession, o: argparse.Namespace, folder: str, store: str) -> tuple[list[str] | DataFrame, clean_batch.Selection, str | None]:
    """One source of paths: a selection list, a stored batch's open or failed files, or the whole folder.

    Returns the paths (of a whole folder as a table), the selection and the id of a batch that goes on. A retry is a new batch that names its
    parent; its rows stay as they are.
    """
    if o.selection_file:
        named = files.read_selection(str(Path(o.base_dir) / o.selection_file), base=o.base_dir)
        return files.resolved_paths(named, folder), clean_batch.Selection("selection_file", o.selection_file), None
    if o.resume_batch:
        own = stored_files(spark, store, o.resume_batch)
        return _paths(batches.resumable(batches.resumed(own))), clean_batch.Selection("resume", previous=own), own.first().batch_id
    if o.retry_failed:
        own = stored_files(spark, store, o.retry_failed)
        child = clean_batch.new_batch_id()
        found = files.resolved_paths(_paths(batches.retry_child(own, child)), folder)
        return found, clean_batch.Selection("retry_failed", parent_batch_id=own.first().batch_id), child
    return _listed(spark, folder, store), clean_batch.Selection(), None


def main(arguments: list[str] | None = None, env: dict[str, str] | None = None) -> int:
    """0: done, 1: could not start, 2: some files failed."""
    env = dict(os.environ if env is None else env)
    try:
        o = checked(parser().parse_args(arguments))
        o.base_dir = o.base_dir or (env.get(HOME) or "").strip() or "."
        env |= env_file(Path(o.base_dir) / ".env")  # the file goes before the environment
        given = connection(env)
        o.base_url, o.model = o.base_url or given["base_url"], o.model or given["model"] or "identity"
        budget, thresholds = limits(env), quality.load_thresholds(env)
        if o.base_url and not given["key"] and not (o.dry_run or o.batch_status):
            raise ValueError(f"{ENVIRONMENT['key']} is not set")
    except ValueError as e:
        print(e)
        return 1
    spark = SparkSession.builder.appName("lexgate").getOrCreate()
    base = Path(o.base_dir).resolve()
    folder, store = str(base / "input"), str(base / "store")
    try:
        if o.stop:
            print(json.dumps({"stopping": state.stop(spark, store)}))
            return 0
        if o.force_unlock:
            state.release(spark, store)
        if o.batch_status:
            print(json.dumps([r.asDict() for r in clean_batch.summary(stored_files(spark, store, "latest")).collect()]))
            return 0
        paths, selection, batch_id = chosen(spark, o, folder, store)
    except ValueError as e:
        print(e)
        return 1
    count = len(paths) if isinstance(paths, list) else paths.count()
    if not count:
        return 0
    prompt = base / "prompt.md"
    text, sha, aliases = files.prompt_identity(prompt.read_text(encoding="utf-8-sig") if prompt.exists() else "")
    tokens = spark.range(1).select(tx.token_estimate(F.lit(text))).first()[0]
    config = clean_batch.Config(store=store, model=o.model, base_url=o.base_url, prompt_sha256=sha, prompt_aliases=aliases, prompt_tokens=tokens, strict=o.strict, max_chars=o.max_chars, max_files=o.max_files,
                                workers=o.workers, budget=budget, thresholds=thresholds)
    sources = files.read_sources(spark, folder, paths, o.max_file_size)
    if o.dry_run:
        parts, errors = md_chunks(sources.where("plan_error is null"), o.max_chars)
        print(json.dumps({"files": count, "pieces": parts.count(), "errors": errors.count()}))
        return 0
    how = transport.Http(url=o.base_url, model=o.model, key=given["key"], system=text, limit_name=budget.limit_name, limit=budget.output) if o.base_url else transport.Identity()
    try:
        done = clean_batch.run(spark, sources, config, how, batch_id, o.accept_failed, selection, files.hashes_now(spark, folder, o.max_file_size))
    except ValueError as e:  # another run has the store
        print(e)
        return 1
    written = export_documents(done["published"], str(base / "output")).count()
    append_log(log_rows(done["files"], "path", "status", "error"), str(base / "log"))
    counts = clean_batch.summary(done["files"]).first()
    print(json.dumps(counts.asDict() | {"written": written}))
    return 2 if counts.failed else 0
