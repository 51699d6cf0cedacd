"""Registered queries of whole batch runs and of the state that they leave."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import _table, md_source, query
from .functions import fixed as fx
from .functions.markdown import md_chunks
from .operators import batches, manifests, transport
from .plans import clean_batch
from .plans.local_store import temporary_store
from .sources import files, sinks, state


def _sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as Markdown files, in the order of their ids.

    Points between digits are blanks: a piece may end after a point, and a number that is cut there is a changed number, for which
    a file fails (as it should, but where pieces end is nothing that SQL can tell).
    """
    path = F.concat(F.lit("in/"), F.lpad(F.col("doc_id").cast("string"), 12, "0"), F.lit(".md"))
    return files.table_sources(md_source(spark, sf_dir), path, F.regexp_replace("md", r"\.([0-9])", " $1"))


def _config(store: str, **more) -> clean_batch.Config:
    return clean_batch.Config(store=store, prompt_sha256="p", strict=False, max_chars=2000, **more)


@query("SELECT 'succeeded' AS file, 'review_required' AS document, count(*) AS n FROM documents")
def clean_batch_status(spark, sf_dir):
    """A whole run with pieces of 2000 characters: each file and the document it became. Replies have no front matter, so people must look at them."""
    done = clean_batch.run(spark, _sources(spark, sf_dir), _config(temporary_store(spark), workers=4), transport.Identity())
    documents = done["documents"].select(F.col("rel_path").alias("path"), F.col("status").alias("document"))
    return done["files"].select("path", F.col("status").alias("file")).join(documents, "path", "left").groupBy("file", "document").agg(F.count("*").alias("n"))


@query("SELECT 1 AS run, 'succeeded' AS status, least(25, count(*)) AS n FROM documents UNION ALL SELECT 1, 'pending', count(*) - 25 FROM documents HAVING count(*) > 25 UNION ALL SELECT 2, 'skipped', least(25, count(*)) FROM documents UNION ALL SELECT 2, 'succeeded', count(*) - 25 FROM documents HAVING count(*) > 25")
def clean_batch_goes_on(spark, sf_dir):
    """Two whole runs over one store, pieces of 2000 characters: the first takes 25 files, the second skips them and takes the rest."""
    sources, store, out = _sources(spark, sf_dir), temporary_store(spark), None
    for i, limit in enumerate((25, 0), 1):
        done = clean_batch.run(spark, sources, _config(store, max_files=limit), transport.Identity())["files"].groupBy("status").agg(F.count("*").alias("n"))
        done = done.select(F.lit(i).alias("run"), "status", "n")
        out = done if out is None else out.unionByName(done)
    return out


class Dying(transport.Transport):
    """Gives pieces back, and takes its process with it at a piece with a certain sign."""

    def __init__(self, sign: str):
        object.__setattr__(self, "sign", sign)

    def reply(self, chunk: str, message: str) -> str:
        if chunk.startswith(self.sign):
            raise SystemExit("the sender dies")
        return chunk


@query("SELECT count(*) AS files, count(*) AS succeeded, true AS some_were_paid, CAST(0 AS BIGINT) AS paid_twice, CAST(0 AS BIGINT) AS unpaid, true AS rest_was_sent FROM documents")
def clean_batch_survives(spark, sf_dir):
    """A sender dies in the middle wave of five. The next run on the store takes the replies that were committed and sends the rest."""
    sources, store = _sources(spark, sf_dir), temporary_store(spark)
    docs = _table(spark, sf_dir, "documents")
    middle = docs.selectExpr("CAST(percentile_disc(0.5) WITHIN GROUP (ORDER BY doc_id) AS BIGINT) AS m").first().m
    pieces = md_chunks(sources, 2000, "text", ("rel_path",))[0].where(~transport.is_blank(F.col("chunk"))).count()
    config = _config(store, wave=-(-pieces // 5), workers=4)
    try:
        clean_batch.run(spark, sources, config, Dying(f"# Chapter {middle}\n"))
        raise AssertionError("the sender has not died")
    except PySparkException:
        before = sinks.read_versions(spark, f"{store}/paid_replies", clean_batch.SENT).select("work", "version")
        before = before.join(spark.createDataFrame([(n.split("=")[1],) for n in state.committed(spark, f"{store}/paid_replies")[1]], "version string"), "version").select("work").distinct()
        paid = before.count()
    done = clean_batch.run(spark, sources, config, transport.Identity())
    sent = sinks.read_versions(spark, f"{store}/paid_replies", clean_batch.SENT).groupBy("work").agg(F.count("*").alias("n"))
    twice, all_ = sent.agg(F.count_if(F.col("n") > 1), F.count("*")).first()
    ended = done["files"].agg(F.count("*").alias("files"), F.count_if(F.col("status") == "succeeded").alias("succeeded"))
    told = {"some_were_paid": paid > 0, "paid_twice": twice, "unpaid": pieces - all_, "rest_was_sent": all_ > paid}
    return ended.select("*", *(F.lit(v).cast("boolean" if isinstance(v, bool) else "long").alias(k) for k, v in told.items()))


_VERSIONS = 12


@query(f"SELECT user_id, last, n, v FROM (SELECT user_id, event_id % {_VERSIONS} AS v, max(event_id) AS last, count(*) AS n FROM events GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY v DESC) = 1")
def state_of_many_versions(spark, sf_dir):
    """A table written in twelve versions and folded on the way into snapshots that are dealt by their key; what readers see at the end."""
    root, schema = temporary_store(spark) + "/versions", "user_id long, last long, n long, v long"
    events = _table(spark, sf_dir, "events").select("user_id", "event_id", (F.col("event_id") % _VERSIONS).alias("v"))
    for i in range(_VERSIONS):
        rows = events.where(F.col("v") == i).groupBy("user_id", "v").agg(F.max("event_id").alias("last"), F.count("*").alias("n"))
        sinks.write_version(rows.select("user_id", "last", "n", "v"), root, f"{i:06}")
        state.compact(spark, root, schema, ["user_id"], most=3, bucket=("user_id", 8))
    return state.current(spark, root, schema, ["user_id"])


@query("""WITH e AS (SELECT event_id, user_id, event_type = 'click' AS bad FROM events),
  i AS (SELECT *, sum(CASE WHEN bad THEN 0 ELSE 1 END) OVER (ORDER BY event_id) AS island FROM e)
  SELECT event_id, CAST(sum(CASE WHEN bad THEN 1 ELSE 0 END) OVER (PARTITION BY island ORDER BY event_id) AS BIGINT) AS run FROM i""")
def failure_runs_of_one_batch(spark, sf_dir):
    """All events as one batch: ranges of its order are looked at apart."""
    rows = _table(spark, sf_dir, "events").select("event_id", F.lit("b").alias("batch_id"), "event_type")
    return batches.failure_runs(rows, "batch_id", "event_id", F.col("event_type") == "click", per_range=1000).select("event_id", "run")


#: Damages to a manifest's text, each as a pattern with what takes its place, and the fault that they make.
_DAMAGES = [
    ("^$", "", ""), ('"total":', '"total":1', "counts"), (r"\A\{", '{"extra":1,', "keys"), (r'"batch_id":"2026', '"batch_id":"2027', "name"), ('"workers":1', '"workers":true', "workers"),
    ('"attempts":0', '"attempts":"0"', "attempts"), ('"path":"p/', '"path":"../', "path"), ('"source_sha256":null', '"source_sha256":"xyz"', "sha256"), (r".\z", "", "json"),
    (r',"parent_batch_id":null', "", "selection"), ('"path":"p/[0-9]+', '"path":"p/1', "repeated"), ('"error":null', '"error":7', "texts"), ('"created_at":"[^"]*"', '"created_at":""', "times"),
]


@query(f"SELECT user_id, CASE user_id % {len(_DAMAGES)} " + " ".join(f"WHEN {i} THEN '{fault}'" for i, (*_, fault) in enumerate(_DAMAGES) if fault != "repeated") + " ELSE CASE WHEN count(*) > 1 THEN 'repeated' ELSE '' END END AS faults FROM events GROUP BY user_id")
def damaged_manifests(spark, sf_dir):
    """A manifest for each user with a file for each of their events, written as JSON, damaged in one of twelve ways, and read back."""
    events = _table(spark, sf_dir, "events")
    user = F.lpad(F.col("user_id").cast("string"), 12, "0")
    batch = F.concat(F.lit("20260101T000000"), F.substring(user, 7, 6), F.lit("Z-"), user)
    nothing = F.lit(None).cast("string")
    rows = events.select("user_id", batch.alias("batch_id"), F.col("event_id").alias("ord"), F.concat(F.lit("p/"), F.col("event_id").cast("string"), F.lit(".md")).alias("path"), F.element_at(F.array(*map(F.lit, fx.FILE_STATUSES)), (F.col("event_id") % 6 + 1).cast("int")).alias("status"),
                         nothing.alias("source_sha256"), nothing.alias("error"), F.lit(0).alias("attempts"), nothing.alias("started_at"), nothing.alias("finished_at"))
    heads = rows.select("user_id", "batch_id").distinct().select("*", F.lit("2026-01-01T00:00:00").alias("created_at"), F.lit("2026-01-01T00:00:00").alias("updated_at"), nothing.alias("completed_at"), F.lit("running").alias("status"),
                                                                 F.lit(1).alias("workers"), F.lit("scan").alias("selection_source"), nothing.alias("selection_file"), nothing.alias("parent_batch_id"))
    texts = manifests.manifest_texts(rows, heads.drop("user_id")).join(heads.select("user_id", "batch_id"), "batch_id")
    damaged = F.col("text")
    for i, (pattern, instead, _) in enumerate(_DAMAGES):
        damaged = F.when(F.col("user_id") % len(_DAMAGES) == i, F.regexp_replace("text", pattern, instead)).otherwise(damaged)
    found = manifests.read_manifests(texts.select(F.concat("batch_id", F.lit(".json")).alias("name"), damaged.cast("binary").alias("content")))
    return found.select(F.substring(F.col("name"), 24, 12).cast("long").alias("user_id"), F.array_join("faults", "|").alias("faults"))
