"""The whole batch: sources, pieces, reuse, pruning, cleaning, validation, quality, assembly, gate, state tables."""

from __future__ import annotations

import datetime
import secrets
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed as fx
from ..functions import text as tx
from ..functions.markdown import md_chunk_rows
from ..operators import assembly, batches, cache, quality, transport, validation
from ..sources import state
from ..sources.files import dense
from ..sources.sinks import write_version


def new_batch_id(now: datetime.datetime | None = None, tail: str | None = None) -> str:
    now = now or datetime.datetime.now(datetime.UTC)
    return f"{now:%Y%m%dT%H%M%S%f}Z-{tail or secrets.token_hex(6)}"


@dataclass(frozen=True)
class Config:
    """What a run depends on."""

    store: str
    model: str = "model"
    base_url: str = "https://localhost"
    prompt_sha256: str = ""
    prompt_aliases: list[str] = field(default_factory=list)
    prompt_tokens: int = 0
    strict: bool = True
    max_chars: int = fx.MAX_CHARS
    max_files: int = 0
    workers: int = 1
    wave: int = 0
    budget: transport.Budget = field(default_factory=transport.Budget)
    thresholds: dict[str, float] = field(default_factory=lambda: dict(fx.THRESHOLDS))

    def __post_init__(self) -> None:
        if not 1 <= self.workers <= 10:
            raise ValueError("workers must lie between 1 and 10")
        if not 1 <= self.max_chars <= 1_000_000:
            raise ValueError("max_chars must lie between 1 and 1000000")
        if self.wave < 0:
            raise ValueError("wave must not be negative")


@dataclass(frozen=True)
class Selection:
    """Where a batch's files come from; previous holds the files of a batch that goes on."""

    source: str = "scan"
    file: str | None = None
    parent_batch_id: str | None = None
    previous: DataFrame | None = None

    def __post_init__(self) -> None:
        if self.source not in fx.SELECTION_SOURCES:
            raise ValueError(f"unknown selection source {self.source}")


RESULTS = (
    "source_file string, source_sha256 string, chunk_sha256 string, model string, base_url string, part_number int, total_parts int, strict_validation boolean, "
    "normalization_policy string, rel_path string, body string, output_sha256 string, warnings array<string>, prompt_sha256 string, prompt_identity_version int, quality_policy_sha256 string, work string"
)
#: Keys of stored replies, and by what their snapshots are dealt.
REPLY_KEYS, REPLY_BUCKETS = ["work", "prompt_sha256"], ("work", 64)
SENT = "work string, prompt_sha256 string, ord long, rel_path string, part_number int, reply string, error string, partial string, attempts int, stage string"
USED = "work string, prompt_sha256 string"
FINALS = (
    "rel_path string, source_sha256 string, part_count int, text string, output_sha256 string, status string, review_required boolean, prompt_sha256 string, prompt_identity_version int, "
    "model string, base_url string, strict_validation boolean, normalization_policy string, quality_policy_sha256 string"
)
REVIEW = "rel_path string, status string, source_sha256 string, output_sha256 string"
FILES = "batch_id string, ord long, path string, status string, source_sha256 string, error string, attempts int, started_at timestamp, finished_at timestamp"
HEADER = (
    "batch_id string, created_at timestamp, updated_at timestamp, completed_at timestamp, status string, workers int, selection_source string, selection_file string, parent_batch_id string"
)
FAILED = f"{RESULTS.split(', rel_path')[0]}, rel_path string, failure_stage string, failure_reason string, body string, prompt_sha256 string, quality_policy_sha256 string, work string"
FAILED_KEYS = [*REPLY_KEYS, "quality_policy_sha256"]
#: What a stored document must equal to be current, beside its prompt and its own hash.
CURRENT = ["status", "source_sha256", "part_count", "model", "base_url", "strict_validation", "normalization_policy", "quality_policy_sha256"]


def stored_results(spark: SparkSession, config: Config, columns: list[str] | None = None) -> DataFrame:
    """All accepted replies of earlier runs, the newest of each piece of work and prompt; an empty table before the first run."""
    return state.current(spark, f"{config.store}/chunk_results", RESULTS, REPLY_KEYS, columns)


def failed_candidates(spark: SparkSession, config: Config) -> DataFrame:
    """Stored replies that were refused, the newest of each piece of work, prompt and policy; a later accepted reply clears them."""
    found = state.current(spark, f"{config.store}/failed_candidates", FAILED, FAILED_KEYS, keep_version=True).where("body is not null")
    done = state.current(spark, f"{config.store}/chunk_results", RESULTS, REPLY_KEYS, REPLY_KEYS, keep_version=True).withColumnRenamed("version", "done_")
    held = found.join(done, REPLY_KEYS, "left")
    return held.where(F.col("done_").isNull() | (F.col("done_") <= F.col("version"))).select(*[c for c in found.columns if c != "version"])


def stored_documents(spark: SparkSession, config: Config, columns: list[str] | None = None, keep_version: bool = False) -> DataFrame:
    """The newest published version of each document."""
    return state.current(spark, f"{config.store}/final_documents", FINALS, ["rel_path"], columns, keep_version)


def stored_review(spark: SparkSession, config: Config) -> DataFrame:
    """The review copy that belongs to each document's newest version (none where that needs no review)."""
    marks = stored_documents(spark, config, ["rel_path"], keep_version=True)
    return state.current(spark, f"{config.store}/review", REVIEW, ["rel_path"], keep_version=True).join(marks, ["rel_path", "version"], "left_semi").drop("version")


def compact_store(spark: SparkSession, config: Config, most: int = state.MOST_VERSIONS) -> list[str]:
    """Fold what has come since the last snapshots; the names of the tables that got one. Replies are dealt by their work."""
    tables = [("chunk_results", RESULTS, REPLY_KEYS, REPLY_BUCKETS), ("failed_candidates", FAILED, FAILED_KEYS, None), ("final_documents", FINALS, ["rel_path"], None), ("review", REVIEW, ["rel_path"], None), ("replies_used", USED, REPLY_KEYS, None)]
    return [name for name, schema, keys, bucket in tables if state.compact(spark, f"{config.store}/{name}", schema, keys, most, bucket)]


def paid_replies(spark: SparkSession, config: Config) -> DataFrame:
    """Replies that runs without an end have received and committed, one for each piece of work and prompt, until a later run has used them."""
    root = f"{config.store}/paid_replies"
    left = state.unfinished(spark, config.store, root)
    if not left:
        return state.nothing(spark, SENT)
    rows = spark.read.schema(f"{SENT}, version string").option("basePath", root).parquet(*(f"{root}/{n}" for n in left))
    used = state.current(spark, f"{config.store}/replies_used", USED, REPLY_KEYS, keep_version=True).withColumnRenamed("version", "used_")
    rows = rows.where("error is null and reply is not null").join(used, REPLY_KEYS, "left").where(F.col("used_").isNull() | (F.col("used_") < F.col("version")))
    return rows.dropDuplicates(REPLY_KEYS).select(*[c.split()[0] for c in SENT.split(", ")])


def send(spark: SparkSession, work: DataFrame, config: Config, how: transport.Transport, run_id: str) -> DataFrame:
    """Pieces (with ord) with what a sender adds and the verdict, sent and judged in waves that are committed one by one.

    A reply is judged where it is received, beside its piece, so neither is dealt or stored again for that. A piece that a run without an end has paid for is not sent again: its reply is taken. Between waves a stop that was asked
    for, or a lone sender that has met too many failures in a row, ends the sending; what is left has the stage stopped.
    """
    added = [c.split()[0] for c in transport.SENT.split(", ")]
    out, open_ = [], work
    if state.unfinished(spark, config.store, f"{config.store}/paid_replies"):
        paid = paid_replies(spark, config).where(F.col("prompt_sha256").isin(config.prompt_sha256, *config.prompt_aliases)).select("work", *added).dropDuplicates(["work"])
        out.append(state.stored_version(verdict(work.join(paid, "work").select(*work.columns, *added), config), f"{config.store}/taken", run_id))
        open_ = work.join(paid.select("work"), "work", "left_anti").select(*work.columns)
    alone, failures, ended = transport.sequential(how, config.workers), 0, None
    for i, (over, upto) in enumerate(transport.waves(open_, config.wave or how.wave)):
        if state.stop_asked(spark, config.store, run_id):
            ended = "not sent: the batch was stopped"
        elif failures >= fx.MAX_FAILURES_IN_A_ROW:
            ended = f"not sent after {failures} failures in a row"
        if ended:
            rest, blank = open_.where(transport.in_wave(over)), transport.is_blank(F.col("chunk"))
            rest = rest.withColumns({"reply": F.when(blank, F.col("chunk")), "error": F.when(~blank, F.lit(ended)), "partial": F.lit(None).cast("string"), "attempts": F.lit(0), "stage": F.when(~blank, F.lit("stopped"))})
            out.append(state.stored_version(verdict(rest.select(*work.columns, *added), config), f"{config.store}/unsent", run_id))
            break
        done = transport.clean(open_.where(transport.in_wave(over, upto)), how, config.workers, failures=failures, limits=config.budget, prompt_tokens=config.prompt_tokens)
        done = state.stored_version(verdict(done, config).withColumn("prompt_sha256", F.lit(config.prompt_sha256)), f"{config.store}/paid_replies", f"{run_id}.w{i:06}")
        out.append(done.drop("prompt_sha256"))
        failures = transport.trailing_failures(done) if alone else 0
    return reduce(DataFrame.unionByName, out)


def judged(replies: DataFrame, config: Config) -> DataFrame:
    """Replies with errors, warnings and quality; failure_stage says where a piece stopped (null for none).

    The warnings of a piece are those of the rules and then those of its report, each once. A blank piece that stands for
    itself breaks no rule: a text may end in line ends that no other piece has room for.
    """
    return _judged(replies.where("error is null"), config)


#: What a verdict adds to a piece, in place of its text; same: the reply is the piece itself.
VERDICT = ["same", "errors", "warnings", "quality", "failure_stage"]


def verdict(replies: DataFrame, config: Config) -> DataFrame:
    """Pieces with replies, without the pieces' texts and with what judged() says of them (nothing that counts where there is no reply)."""
    own = [c for c in replies.columns if c != "chunk"]
    return _judged(replies.withColumn("same", F.col("chunk").eqNullSafe(F.col("reply"))), config).select(*own, *VERDICT)


def _judged(replies: DataFrame, config: Config) -> DataFrame:
    checked = validation.validate(replies, "reply", "chunk", "part_number", config.strict)
    itself = transport.is_blank(F.col("chunk")) & (F.col("chunk") == F.col("reply"))
    checked = checked.withColumns({c: F.when(itself, F.array().cast("array<string>")).otherwise(F.col(c)) for c in ("errors", "warnings")})
    scored = quality.assess(checked, "chunk", "reply", config.thresholds)
    stage = F.when(F.size("errors") > 0, "validation").when(F.size("quality.severe_errors") > 0, "quality")
    return scored.withColumn("failure_stage", stage).withColumn("warnings", F.array_distinct(F.concat("warnings", "quality.warnings")))


def planned(sources: DataFrame, parts: DataFrame) -> DataFrame:
    """One row for each source that has a plan: ord, rel_path, source_sha256, part_count (0 for blank texts)."""
    counts = parts.groupBy("rel_path").agg(F.count("*").cast("int").alias("part_count"))
    return sources.select("ord", "rel_path", "source_sha256").join(counts, "rel_path", "left").fillna(0, ["part_count"])


def needing_work(plans: DataFrame, todo: DataFrame, finals: DataFrame, review: DataFrame, config: Config) -> DataFrame:
    """Plans with a piece to send, or without a current document and review copy; blank texts always count."""
    expected = plans.withColumns({
        "model": F.lit(config.model), "base_url": F.lit(config.base_url.rstrip("/")), "strict_validation": F.lit(config.strict),
        "normalization_policy": F.lit(fx.NORMALIZATION), "quality_policy_sha256": F.lit(quality.policy_sha256(config.thresholds)),
    })
    fits = cache.prompt_fits(F.col("prompt_sha256"), F.col("prompt_identity_version"), config.prompt_sha256, config.prompt_aliases)
    sound = finals.where(fits & (F.col("status") == tx.artifact_status("review_required", F.lit(config.strict))))
    current = cache.current_documents(expected, sound, [k for k in CURRENT if k != "status"]).where("is_current").select("rel_path")
    current = assembly.in_review_step(finals.drop("text").join(current, "rel_path", "left_semi"), review).select("rel_path")
    open_ = todo.select("rel_path").distinct().withColumn("sends_", F.lit(True))
    marked = plans.join(open_, "rel_path", "left").join(current.withColumn("done_", F.lit(True)), "rel_path", "left")
    return marked.where(F.col("sends_").isNotNull() | F.col("done_").isNull()).select(*plans.columns)


def pieces_of(chunks: DataFrame, picked: DataFrame, others: DataFrame) -> DataFrame:
    """Pieces of the files that are picked. Their texts meet the fewer of those files and of the others, which may go to all tasks, or none."""
    left = others.count()
    if not left:
        return chunks
    few, kind = (others, "left_anti") if left <= picked.count() else (picked, "left_semi")
    return chunks.join(few, "rel_path", kind).select(*chunks.columns)


def ordered(sources: DataFrame) -> DataFrame:
    """Sources with ord: given by their reader, or ascending in the order of their lower-case paths (see dense)."""
    if "ord" in sources.columns:
        return sources.withColumn("ord", F.col("ord").cast("long"))
    lower = F.lower("rel_path")
    return sources.repartitionByRange(lower, "rel_path").sortWithinPartitions(lower, "rel_path").withColumn("ord", F.monotonically_increasing_id())


def run(spark: SparkSession, sources: DataFrame, config: Config, how: transport.Transport, batch_id: str | None = None, accept_failed: bool = False,
        selection: Selection | None = None, rehash: Callable[[DataFrame], DataFrame] | None = None) -> dict[str, DataFrame]:
    """Clean the sources and store every table as a version of its own under config.store.

    Sources are stored first, so that all steps see the same bytes. Files whose pieces all have a stored reply and
    whose document and review copy are current are skipped; of the others the first max_files (by ord) are
    worked on, the rest stays pending. Pieces over the budget fail before the network; blank pieces stand for themselves.
    Replies are committed wave by wave, so a run that dies pays for no committed piece again (see send). After five failures in
    a row a file (with a lone sender: the batch) is left; its files stay pending and the batch is stopped, as it is where
    state.stop() asks for it. The store is claimed for the run: a second run on it is refused. Stored replies are judged anew
    under the current thresholds and not stored again. Before documents are published, rehash (paths to
    rel_path, source_sha256) tells sources that have changed since; these fail. With accept_failed nothing is sent:
    refused replies of the same work, prompt and policy stand, marked for review, and pieces without one fail.

    Returns files (one row for each source with its status), header, stats, and of this run results, failed, published
    and review; documents are those that now stand for files that succeeded or were skipped.
    """
    version = new_batch_id()
    state.claim(spark, config.store, version)
    try:
        with state.without_shuffle_files(spark):
            done = _run(spark, sources, config, how, batch_id or version, version, accept_failed, selection or Selection(), rehash)
            state.finish(spark, config.store, version)
            compact_store(spark, config)
        return {name: table.select("*") for name, table in done.items()}  # made anew: whoever asks twice finds the shuffle files of the first time
    finally:
        state.release(spark, config.store)


def _run(spark: SparkSession, sources: DataFrame, config: Config, how: transport.Transport, batch_id: str, version: str, accept_failed: bool, selection: Selection,
         rehash: Callable[[DataFrame], DataFrame] | None) -> dict[str, DataFrame]:
    policy, began = quality.policy_sha256(config.thresholds), F.lit(datetime.datetime.now())
    keep = lambda df, name, step="": spark.read.schema(df.schema).parquet(write_version(df, f"{config.store}/{name}", version + step))
    shaped = lambda df, schema: df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(schema)])

    own = ordered(sources).select("ord", "rel_path", "size", "source_sha256", "text", "source_chars", "plan_error")
    given, sources = "ord" in sources.columns, keep(own, "sources")
    sources = sources if given else dense(sources)
    good = sources.where("plan_error is null")
    parts = md_chunk_rows(good, config.max_chars, "text", ("rel_path", "source_sha256", "ord"))
    parts = keep(cache.with_identity(parts, config.model, config.base_url, config.strict).withColumn("work", cache.work_id()), "chunks")
    chunks = parts.where("chunk_sha256 is not null").drop("plan_error")
    errors = keep(parts.where("plan_error is not null").select("rel_path", F.col("plan_error").alias("error")), "plan_errors")
    plans = planned(good.join(errors, "rel_path", "left_anti"), chunks)
    blank_piece = transport.is_blank(F.col("chunk"))
    fits = cache.prompt_fits(F.col("prompt_sha256"), F.col("prompt_identity_version"), config.prompt_sha256, config.prompt_aliases)
    keys = stored_results(spark, config, [*REPLY_KEYS, "prompt_identity_version"]).where(fits)  # no body is read to tell what is there
    todo = keep(chunks.where(~blank_piece).select("rel_path", "work").join(keys, "work", "left_anti"), "todo")
    finals = stored_documents(spark, config)
    needs = keep(needing_work(plans, todo, finals, stored_review(spark, config), config), "needs")
    picked = keep(batches.limited(needs, config.max_files), "picked")

    files = sources.select(F.lit(batch_id).alias("batch_id"), "ord", F.col("rel_path").alias("path"), F.lit("pending").alias("status"), "source_sha256", F.lit(None).cast("string").alias("error"),
                           F.lit(0).alias("attempts"), F.lit(None).cast("timestamp").alias("started_at"), F.lit(None).cast("timestamp").alias("finished_at"))
    if selection.previous is not None:
        files = batches.carried(files, selection.previous)
    files = files.join(picked.select(F.col("rel_path").alias("path"), F.lit(True).alias("picked_")), "path", "left")
    files = batches.moved(files, F.lit("running"), F.lit(None).cast("string"), began, F.coalesce("picked_", F.lit(False)))
    files = keep(files.select("picked_", *[f.name for f in T.StructType.fromDDL(FILES)]), "batch_files", "-0")
    head = lambda status, done: spark.range(1).select(F.lit(batch_id).alias("batch_id"), F.try_to_timestamp(F.substring(F.lit(batch_id), 1, 15), F.lit("yyyyMMdd'T'HHmmss")).alias("created_at"), F.current_timestamp().alias("updated_at"),
        F.when(done, F.current_timestamp()).alias("completed_at"), status.alias("status"), F.lit(config.workers).alias("workers"), F.lit(selection.source).alias("selection_source"),
        F.lit(selection.file).cast("string").alias("selection_file"), F.lit(selection.parent_batch_id).cast("string").alias("parent_batch_id"))
    keep(shaped(head(F.lit("running"), F.lit(False)), HEADER), "batches", "-0")

    others = keep(plans.select("rel_path").join(picked, "rel_path", "left_anti"), "others")
    mine = pieces_of(chunks, picked.select("rel_path"), others)
    itself = mine.where(blank_piece).select(*mine.columns, F.col("chunk").alias("reply"))
    usable = cache.usable(stored_results(spark, config, ["prompt_identity_version", "body", "output_sha256"]), config.prompt_sha256, config.prompt_aliases)
    usable = usable.select("work", F.col("body").alias("reply")).dropDuplicates(["work"])
    reused = keep(verdict(mine.where(~blank_piece).join(usable, "work").select(*mine.columns, "reply").unionByName(itself), config), "reused")
    work = mine.join(reused.select("work"), "work", "left_anti").select(*mine.columns)
    if accept_failed:
        taken = cache.accepted_candidates(work, failed_candidates(spark, config), config.prompt_sha256, policy)
        found = keep(taken.select("work", F.col("body").alias("reply")).dropDuplicates(["work"]), "accepted")
        replies = work.join(found, "work", "left").select(*work.columns, "reply", F.when(F.col("reply").isNull(), "no candidate to accept").alias("error"), F.lit(None).cast("string").alias("partial"), F.lit(None).cast("string").alias("stage"))
        replies = keep(verdict(replies, config), "replies")
    else:
        replies = send(spark, work, config, how, version)
    identity = [c for c in chunks.columns if c not in ("chunk", "ord")]
    fields = [*identity, "reply", *VERDICT]
    seen = replies.where("error is null").select(*fields, F.lit(True).alias("fresh")).unionByName(reused.select(*fields, F.lit(False).alias("fresh")))
    if accept_failed:
        stands = F.when(F.col("failure_stage").isNotNull(), F.array_append("warnings", F.lit("accepted by a user"))).otherwise(F.col("warnings"))
        seen = seen.withColumn("warnings", stands).withColumn("failure_stage", F.lit(None).cast("string"))
    passed = seen.where("failure_stage is null")
    results = passed.select(*identity, "same", "fresh", F.col("reply").alias("body"), tx.sha256("reply").alias("output_sha256"), "warnings", F.lit(config.prompt_sha256).alias("prompt_sha256"),
                            F.lit(fx.PROMPT_VERSION).alias("prompt_identity_version"), F.lit(policy).alias("quality_policy_sha256"), F.col("quality.review_required").alias("review_required"))
    keep(shaped(results.where("fresh"), RESULTS), "chunk_results")
    calls = replies.where("error is not null and stage != 'stopped'").select(*identity, F.col("stage").alias("failure_stage"), tx.compact_error("error").alias("failure_reason"), F.col("partial").alias("body"))
    refused = seen.where("failure_stage is not null").select(*identity, "failure_stage", F.array_join(F.concat("errors", "quality.severe_errors"), "; ").alias("failure_reason"), F.col("reply").alias("body"))
    partial = calls.where("body is not null").withColumn("time", F.current_timestamp())
    keep(partial, "partial_responses")
    failed = refused.unionByName(calls.withColumn("body", F.lit(None).cast("string"))).withColumns({"prompt_sha256": F.lit(config.prompt_sha256), "quality_policy_sha256": F.lit(policy)})
    failed = keep(shaped(failed, FAILED), "failed_candidates")

    whole = assembly.assemble(results, given="same").join(good.select("rel_path", "source_sha256", F.col("text").alias("source_text")), "rel_path")
    scored = assembly.gated(quality.assess(whole, "source_text", "text", config.thresholds, joined=True), config.strict)
    ready = scored.drop("source_text").withColumns({
        "output_sha256": tx.sha256("text"), "prompt_sha256": F.lit(config.prompt_sha256), "prompt_identity_version": F.lit(fx.PROMPT_VERSION), "model": F.lit(config.model),
        "base_url": F.lit(config.base_url.rstrip("/")), "strict_validation": F.lit(config.strict), "normalization_policy": F.lit(fx.NORMALIZATION), "quality_policy_sha256": F.lit(policy),
    })
    ready = keep(ready, "assembled")
    sound = ready.where(F.size("quality.severe_errors") == 0)
    changed = state.nothing(spark, "rel_path string")
    if rehash is not None:
        now = rehash(sound.select("rel_path")).select("rel_path", F.col("source_sha256").alias("now_"))
        changed = keep(sound.select("rel_path", "source_sha256").join(now, "rel_path", "left").where(~F.col("source_sha256").eqNullSafe(F.col("now_"))).select("rel_path"), "changed")
    documents = keep(sound.join(changed, "rel_path", "left_anti"), "final_documents")
    review = keep(assembly.review_queue(documents), "review")

    stats = batches.piece_stats(mine, seen, replies)
    reasons = errors.unionByName(sources.where("plan_error is not null").select("rel_path", F.col("plan_error").alias("error"))).unionByName(changed.withColumn("error", F.lit("the source changed during the run")))
    severe = ready.where(F.size("quality.severe_errors") > 0).select("rel_path", F.array_join("quality.severe_errors", "; ").alias("error"))
    pieces = failed.groupBy("rel_path").agg(F.min_by("failure_reason", "part_number").alias("error"))
    reasons = reasons.unionByName(severe).unionByName(pieces).groupBy(F.col("rel_path").alias("path")).agg(F.max("error").alias("why_"))
    cut = replies.where("stage = 'stopped'").select(F.col("rel_path").alias("path")).distinct().withColumn("cut_", F.lit(True))
    blank = good.where(tx.is_blank(F.coalesce("text", F.lit("")))).select(F.col("rel_path").alias("path")).withColumn("blank_", F.lit(True))
    done = documents.select(F.col("rel_path").alias("path")).withColumn("done_", F.lit(True))
    fine = plans.select(F.col("rel_path").alias("path"), F.lit(True).alias("planned_"))
    x = files
    for other in (reasons, cut, blank, done, fine, needs.select(F.col("rel_path").alias("path"), F.lit(True).alias("needed_"))):
        x = x.join(other, "path", "left")
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    mine_now = F.col("status").isin("pending", "running") if selection.previous is None else F.col("status").isin("pending", "running", "interrupted")
    ended = (
        F.when(~mine_now, F.col("status")).when(yes("picked_") & yes("cut_"), "pending").when(yes("picked_") & (yes("done_") | yes("blank_")), "succeeded").when(yes("picked_"), "failed")
        .when(~yes("planned_"), "failed").when(~yes("needed_"), "skipped").otherwise("pending")
    )
    final = batches.moved(x, ended, F.col("why_"), F.current_timestamp(), mine_now)
    final = keep(shaped(final, FILES), "batch_files", "-1")
    stopped = replies.where("stage = 'stopped'").limit(1).count() > 0
    rolled = summary(final, stopped).first()
    header = keep(shaped(head(F.lit(rolled.batch_status if rolled else "completed"), F.lit(bool(rolled is None or rolled.is_complete))), HEADER), "batches", "-1")
    keep(replies.where("stage is null or stage != 'stopped'").select("work", F.lit(config.prompt_sha256).alias("prompt_sha256")), "replies_used")
    fine = final.where(F.col("status").isin("succeeded", "skipped")).select(F.col("path").alias("rel_path"))
    standing = stored_documents(spark, config).join(fine, "rel_path", "left_semi")
    return {"files": final, "header": header, "stats": stats, "results": results, "failed": failed, "published": documents, "documents": standing, "review": review}


def summary(files: DataFrame, stopped: bool = False) -> DataFrame:
    return batches.progress(batches.rollup_status(batches.status_counts(files), stopped))
