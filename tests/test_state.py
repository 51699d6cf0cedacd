"""State of a store, waves of replies, and what orders rows without one task for all."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lexgate.functions import fixed as fx
from lexgate.operators import batches, transport
from lexgate.plans import clean_batch
from lexgate.sources import files, sinks, state

SCHEMA = "work string, n int, body string"


def versions(spark, root, upto, first=0, **more):
    for i in range(first, upto):
        rows = [(f"w{k}", i, f"body {i}") for k in range(40) if k % (i + 1) == 0]
        sinks.write_version(spark.createDataFrame(rows, SCHEMA), root, f"{i:04}")
        state.compact(spark, root, SCHEMA, ["work"], **more)


def expected(upto):
    return {f"w{k}": max(i for i in range(upto) if k % (i + 1) == 0) for k in range(40)}


@pytest.mark.parametrize("bucket", [None, ("work", 4)])
def test_reads_after_many_versions_cost_what_they_cost_after_one(spark, tmp_path, bucket):
    root = str(tmp_path / "t")
    assert state.current(spark, root, SCHEMA, ["work"]).count() == 0
    versions(spark, root, 12, most=3, bucket=bucket)
    snapshot, later = state.committed(spark, root)
    assert snapshot and len(later) <= 3
    now = state.current(spark, root, SCHEMA, ["work"])
    assert {r.work: r.n for r in now.collect()} == expected(12)
    state.compact(spark, root, SCHEMA, ["work"], most=0, bucket=bucket)
    folded = state.current(spark, root, SCHEMA, ["work"])
    assert {r.work: r.n for r in folded.collect()} == expected(12)
    plan = folded._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Exchange" not in plan and len(folded.inputFiles()) <= 8
    # a reader keeps what it has seen while a writer goes on
    sinks.write_version(spark.createDataFrame([("w0", 99, "x")], SCHEMA), root, "0099")
    assert {r.work: r.n for r in folded.collect()} == expected(12)
    assert state.current(spark, root, SCHEMA, ["work"], ["n"]).where("work = 'w0'").first().n == 99


def test_the_reuse_join_reads_a_dealt_snapshot_as_it_lies(spark, tmp_path):
    root = str(tmp_path / "t")
    versions(spark, root, 3, most=2, bucket=("work", 4))
    versions(spark, root, 4, first=3, most=0, bucket=("work", 4))
    keys = state.current(spark, root, SCHEMA, ["work"], ["work"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.createDataFrame([("w1",), ("new",)], "work string").join(keys, "work", "left_anti")
        assert [r.work for r in joined.collect()] == ["new"]
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.split("== Initial Plan ==")[0].count("Exchange hashpartitioning") == 1 and "body" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_marks_are_written_once_and_a_store_has_one_writer(spark, tmp_path):
    store = str(tmp_path)
    assert state.mark(spark, f"{store}/m", "a") and not state.mark(spark, f"{store}/m", "b") and state.marked(spark, f"{store}/m") == "a"
    state.claim(spark, store, "r1")
    with pytest.raises(ValueError, match="r1"):
        state.claim(spark, store, "r2")
    assert state.stop(spark, store) and state.stop_asked(spark, store, "r1") and not state.stop_asked(spark, store, "r2")
    state.release(spark, store)
    assert not state.stop(spark, store)
    state.claim(spark, store, "r2")


def as_sources(spark, rows):
    return files.table_sources(spark.createDataFrame(rows, "p string, t string"), F.col("p"), F.col("t"))


def statuses(done):
    return {r.path: r.status for r in done["files"].collect()}


def refusing():
    class Refusing(transport.Transport):
        """Fails for pieces that hold a word, and dies at another."""

        limited = True

        def reply(self, chunk, message):
            if "die" in chunk:
                raise SystemExit
            if "bad" in chunk:
                raise RuntimeError("no")
            return chunk

    return Refusing()


def once():
    class Once(transport.Transport):
        """Fails for pieces that an earlier run has paid for."""

        def reply(self, chunk, message):
            if any(w in chunk for w in ("file 0", "file 1")):
                raise RuntimeError("paid already")
            return chunk

    return Once()


def test_a_run_that_dies_pays_for_no_committed_piece_again(spark, tmp_path):
    rows = [(f"{i}.md", f"file {i} with words" + (" die" if i == 3 else "")) for i in range(6)]
    config = clean_batch.Config(store=str(tmp_path), prompt_sha256="p", strict=False, wave=2)
    with pytest.raises(PySparkException):
        clean_batch.run(spark, as_sources(spark, rows), config, refusing())
    assert sorted(r.rel_path for r in clean_batch.paid_replies(spark, config).collect()) == ["0.md", "1.md"]
    done = clean_batch.run(spark, as_sources(spark, rows), config, once())
    assert set(statuses(done).values()) == {"succeeded"} and clean_batch.paid_replies(spark, config).count() == 0


def test_failures_in_a_row_count_inside_a_file(spark, tmp_path):
    long = "\n".join(f"bad line number {i} of this text, which fills a piece" for i in range(9))
    rows = [("a.md", long)] + [(f"{c}.md", f"bad {c}") for c in "bcdefg"] + [("z.md", "fine")]
    config = clean_batch.Config(store=str(tmp_path), prompt_sha256="p", strict=False, max_chars=60, workers=3)
    done = clean_batch.run(spark, as_sources(spark, rows), config, refusing())
    got = statuses(done)
    assert got.pop("a.md") == "pending" and got.pop("z.md") == "succeeded" and set(got.values()) == {"failed"}
    assert done["header"].first().status == "stopped" and done["failed"].where("rel_path = 'a.md'").count() == fx.MAX_FAILURES_IN_A_ROW


def asking(folder):
    class Asking(transport.Transport):
        """Asks, as another process would, to stop the run that has the store."""

        def __init__(self, folder):
            object.__setattr__(self, "folder", folder)

        def reply(self, chunk, message):
            import pathlib

            run = (pathlib.Path(self.folder) / "marks" / "claim").read_text()
            (pathlib.Path(self.folder) / "marks" / f"stop-{run}").touch()
            return chunk

    return Asking(folder)


def test_a_stop_ends_the_run_after_its_wave(spark, tmp_path):
    sources = as_sources(spark, [(f"{i}.md", f"file {i}") for i in range(6)])
    config = clean_batch.Config(store=str(tmp_path), prompt_sha256="p", strict=False, wave=2)
    done = clean_batch.run(spark, sources, config, asking(str(tmp_path)))
    assert sorted(statuses(done).values()) == ["pending"] * 4 + ["succeeded"] * 2 and done["header"].first().status == "stopped"
    again = clean_batch.run(spark, sources, config, transport.Identity())
    assert sorted(statuses(again).values()) == ["skipped"] * 2 + ["succeeded"] * 4
    state.claim(spark, str(tmp_path), "other")
    with pytest.raises(ValueError, match="other"):
        clean_batch.run(spark, sources, config, transport.Identity())


def test_blank_pieces_stand_for_themselves(spark, tmp_path):
    rows = [("a.md", "x" * 50 + "\n" + "\n" * 30), ("b.md", "\n" * 90 + "words of b\n"), ("c.md", " \n\n")]
    config = clean_batch.Config(store=str(tmp_path), prompt_sha256="p", strict=False, max_chars=60)
    done = clean_batch.run(spark, as_sources(spark, rows), config, transport.Scripted(lambda chunk: chunk if chunk.strip() else 1 / 0))
    assert set(statuses(done).values()) == {"succeeded"}
    assert {r.rel_path: r.text.strip() for r in done["documents"].collect()} == {"a.md": "x" * 50, "b.md": "words of b"}
    assert set(statuses(clean_batch.run(spark, as_sources(spark, rows[:2]), config, transport.Scripted(lambda chunk: 1 / 0))).values()) == {"skipped"}


def test_failure_runs_and_places_across_ranges(spark):
    r = random.Random(4)
    rows = [(g, i, r.random() < p) for g, p in (("a", 0.9), ("b", 0.2), ("c", 1.0)) for i in range(0, 300, r.choice((1, 2)))]
    wanted, run, last = {}, 0, None
    for g, i, bad in rows:
        run = run + 1 if bad and g == last else int(bad)
        wanted[g, i], last = run, g
    frame = spark.createDataFrame(rows, "g string, i long, bad boolean").repartition(5)
    for per_range in (7, 64, 10_000):
        got = batches.failure_runs(frame, "g", "i", F.col("bad"), per_range)
        assert {(x.g, x.i): x.run for x in got.collect()} == wanted
        places = {(x.g, x.i): x.at for x in batches.ranked(frame, "g", "i", "at", per_range).collect()}
        assert all(places[g, i] == sorted(j for h, j, _ in rows if h == g).index(i) for g, i, _ in rows)
    assert batches.failure_runs(frame.limit(0), "g", "i", F.col("bad")).count() == 0
    stops = {x.g: x.stop_at for x in batches.stop_points(frame, "g", "i", F.col("bad"), 5).collect()}
    assert stops == {g: min(i for (h, i), n in wanted.items() if h == g and n >= 5) for g in stops} and "c" in stops


def test_ords_are_dense(spark, tmp_path):
    rows = [(f"{c}{i}.md", "t") for i in range(40) for c in "Ab"]
    sources = clean_batch.ordered(as_sources(spark, rows).repartition(7))
    sources.write.parquet(str(tmp_path / "s"))
    got = {x.rel_path: x.ord for x in clean_batch.dense(spark.read.parquet(str(tmp_path / "s"))).collect()}
    assert got == {p: i for i, p in enumerate(sorted((p for p, _ in rows), key=lambda p: (p.lower(), p)))}


def test_a_folded_store_is_reused(spark, tmp_path):
    """Snapshots of all tables after two runs: the third run finds replies, documents and review copies in them."""
    sources = as_sources(spark, [("a.md", "text a"), ("b.md", "扫码关注领取资料\nwords")])
    config = clean_batch.Config(store=str(tmp_path), prompt_sha256="p", strict=False)
    clean_batch.run(spark, sources, config, transport.Identity())
    assert "chunk_results" in clean_batch.compact_store(spark, config, most=0)
    more = as_sources(spark, [("a.md", "text a"), ("b.md", "扫码关注领取资料\nwords"), ("c.md", "text c")])

    def only_new(chunk):
        if "c" not in chunk:
            raise RuntimeError("sent twice")
        return chunk

    assert statuses(clean_batch.run(spark, more, config, transport.Scripted(only_new))) == {"a.md": "skipped", "b.md": "skipped", "c.md": "succeeded"}
    assert {r.rel_path for r in clean_batch.stored_documents(spark, config).collect()} == {"a.md", "b.md", "c.md"}
