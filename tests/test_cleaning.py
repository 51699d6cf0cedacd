"""Reports, rules, reuse, assembly, batches and the whole run."""

import dataclasses
import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexgate import catalog
from lexgate.functions import compare
from lexgate.functions import fixed as fx
from lexgate.functions import markdown
from lexgate.functions import text as tx
from lexgate.functions.rows import ROWS
from lexgate.operators import assembly, batches, quality, transport, validation
from lexgate.plans import clean_batch
from lexgate.sources import files, sinks, state


def one(spark, expression, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(expression.alias("x")).first().x


def test_names_and_redaction(spark):
    assert one(spark, tx.safe_name("v"), v='a/b: "c"  d.') == "a_b___c__d"
    assert one(spark, tx.safe_name("v"), v=" ._ ") == "unnamed"
    assert one(spark, tx.part_name("v", F.lit(1234)), v="in/My Doc.md") == "My_Doc_part_1234_cleaned.md"
    assert one(spark, tx.part_name("v", F.lit(7)), v="in/My Doc.md") == "My_Doc_part_007_cleaned.md"
    assert one(spark, tx.redact("v"), v="api_key=abcdefghij Bearer 12345678x sk-aaaaaaaaa") == "api_key=*** Bearer *** ***"
    assert one(spark, tx.compact_error("v"), v="a\r\nb") == "a  b"
    assert one(spark, tx.received_size(F.lit(1536)), v="") == "1.5 KB"


def test_regex_traps(spark):
    assert one(spark, tx.number_count("v"), v="１２ 3.5% a4 -7 2020年") == 4
    assert one(spark, tx.table_count("v"), v="| a | b |\r\n|---|---|\r\n") == 0
    assert one(spark, tx.table_count("v"), v="|---|---|\n") == 1
    assert one(spark, F.array_join(tx.split_lines("v"), "|"), v="a b\x0bc\r\nd\n") == "a|b|c|d"
    assert one(spark, tx.token_estimate("v"), v="安全abcd") == 4
    assert one(spark, tx.token_estimate("v"), v="") == 1


def test_protected_values_and_anchors():
    assert compare.protected_values("A. 1,200 mg/m³ GB 18218—2018 见 HTTP://X.org/a。") == ["a", "1200", "mg/m3", "gb 18218", "18218", "2018", "http://x.org/a", "a"]
    assert compare.protected_values("扫码关注领取 5\n6") == ["6"]
    assert compare.anchor_ratio("short", "short") == 1.0 and compare.anchor_ratio("short", "other") == 0.0
    text = " ".join(f"word{i}" for i in range(400))
    assert compare.anchor_ratio(text, text) == 1.0 and compare.anchor_ratio(text, "x" * len(text)) == 0.0


def test_quality_report(spark):
    text = "# a\n\n# b\n\n# c\n\n" + "The limit is 30 mg and see https://e.org/x now. " * 8
    rows = [(1, text, text), (2, text, text[:60]), (3, text, text * 3), (4, text, text.replace("30", "31")), (5, text, text + "https://new.org"), (6, "", ""), (7, None, "x"), (8, "a\n扫码关注领取\n" + text, "a\n" + text)]
    got = {r.i: r.quality for r in quality.assess(spark.createDataFrame(rows, "i int, a string, b string"), "a", "b").collect()}
    assert len(got[1]) == 23 and not got[1].review_required and got[1].retained_ratio == 1.0 and not got[8].severe_errors
    assert any("30%" in e for e in got[2].severe_errors) and fx.SAYS["headings"] not in got[2].warnings
    assert any("200%" in e for e in got[3].severe_errors) and got[4].protected_values_changed
    assert list(got[5].added_urls) == ["https://new.org"] and fx.SAYS["urls_added"] in got[5].warnings
    assert (got[6].retained_ratio, got[6].removed_ratio, got[6].expansion_ratio) == (1.0, 0.0, 1.0)


def test_a_standard_id_across_a_seam_is_no_change(spark, tmp_path):
    text = "A. " + "sh " * 400 + "sh\n\n" + "1. " + "first " * 150 + "\n"  # the first piece ends between sh and 1
    source = spark.createDataFrame([("a.md", text)], "rel_path string, text string")
    config = clean_batch.Config(store=f"file://{tmp_path}/store", prompt_sha256="p", strict=False, max_chars=1300)
    done = clean_batch.run(spark, files.table_sources(source, F.col("rel_path"), F.col("text")), config, transport.Identity())
    assert [(r.status, r.error) for r in done["files"].collect()] == [("succeeded", None)]
    assert compare.values_differ("GB 1", "GB\n\n1") and not compare.values_differ("GB 1", "GB \n\n1", joined=True) and compare.values_differ("GB 1", "GB\n\n2", joined=True)


def _slices(column, *values):
    rows = 2 * ROWS + 1
    arrays = tuple(pa.array([v] * rows) for v in values)
    return [len(x) for x in column.func(iter([arrays if len(arrays) > 1 else arrays[0]]))]


def test_reports_leave_a_slice_of_rows_at_a_time():
    for column, values in ((compare.protected_values_of, ["GB 1"]), (compare.compared, ["GB 1", "GB 1", "GB 1", False])):
        assert _slices(column, *values) == [ROWS, ROWS, 1]


def test_reports_without_a_word_on_seams_are_of_plain_texts(spark):
    """A query gives three texts and no fourth value: its texts are no joined documents."""
    df = spark.createDataFrame([("some sh\n1. first", "some sh\n\n1. first"), (None, "x")], "a string, b string")
    seen = df.select(compare.compared("a", "b", "b").alias("c"), compare.compared("a", "b", "b", F.lit(True)).alias("j")).collect()
    assert [(r.c.changed, r.c.anchors) for r in seen] == [(True, 1.0), (False, 0.0)] and [r.j.changed for r in seen] == [False, False]


def test_anchor_ratio_runs(spark):
    found = {r.doc_id: r.ratio for r in catalog.QUERIES["anchor_ratio"](spark, "/root/testdata/sf0.001").collect()}
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    replies = {i: (t, t[: len(t) // 2], "other")[i % 3] for i, t in texts.items()}
    assert found == {i: compare.anchor_ratio(t, replies[i]) for i, t in texts.items()}


def test_texts_are_stripped_and_held_against_each_other_without_a_search_of_every_place(spark):
    spaces = [c for c in map(chr, range(0x3001)) if c.isspace()]
    rows = [(t,) for t in ["", " ", "".join(spaces), "a", *(f"{c}a{c}b{c}" for c in spaces), "\u200ba", None]]
    df = spark.createDataFrame(rows, "t string")
    got = df.select("t", tx.py_strip("t").alias("s"), tx.is_blank("t").alias("b")).collect()
    assert all(r.s == (r.t and r.t.strip()) if r.t is not None else r.s is None and r.b is None for r in got) and all(r.b == (not r.t.strip()) for r in got if r.t is not None)
    assert "regexp" not in df.select(tx.py_strip("t"))._jdf.queryExecution().optimizedPlan().toString()
    words = [f"word{i * 7919 % 1000} " for i in range(900)]
    text, turned, part = "".join(words), "".join(words[450:] + words[:450]), "".join(words[::2])
    bare = lambda t: "".join(t.split()).lower()
    last = len(bare(text)) - compare.ANCHOR
    anchors = {bare(text)[s : s + compare.ANCHOR] for s in (round(i * last / (compare.ANCHORS - 1)) for i in range(compare.ANCHORS))}
    for other in (text, turned, part, part + turned, "x"):
        assert compare.anchor_ratio(text, other) == sum(a in bare(other) for a in anchors) / len(anchors)
    assert validation.first_phrase.__doc__ and one(spark, validation.explanation(F.col("v")), v="\u2003 好的，以下") == "好的，"


def test_seams_between_words_change_no_value():
    given = "GB 12. and 3.5 kg of http://e.org/a. More 1,000 mg/m3\nSH/T 3 end"
    for seam in range(1, len(given)):
        joined = given[:seam] + "\n\n" + given[seam:]
        blanks = lambda t: [" ".join(v.split()) for v in compare.protected_values(t)]
        assert compare.values_differ(given, joined, joined=True) == (blanks(given) != blanks(joined))


def test_chunks_and_errors_come_of_one_cut(spark):
    rows = [("a", "x" * 30 + "\n\n" + "y" * 30 + "\n"), ("b", "z" * 99), ("c", ""), ("d", None)]
    df = spark.createDataFrame(rows, "rel_path string, text string")
    both = markdown.md_chunk_rows(df, 40)
    parts, errors = markdown.md_chunks(df, 40)
    assert sorted(both.where("plan_error is null").select(*parts.columns).collect()) == sorted(parts.collect())
    assert both.where("plan_error is not null").select(*errors.columns).collect() == errors.collect() and both.count() == parts.count() + 1


def test_texts_meet_the_fewer_files(spark, tmp_path):
    """A second run leaves a few files out; a first one takes a few: in both, no text is dealt out for that."""
    table = lambda df, name: spark.read.parquet(sinks.write_version(df, f"{tmp_path}/{name}", "1"))
    paths = spark.range(2000).select(F.sha2(F.col("id").cast("string"), 256).alias("rel_path"), "id")
    chunks = table(paths.select("rel_path", F.repeat("rel_path", 9).alias("chunk")), "chunks")
    few, many, none = (table(paths.where(c).select("rel_path"), n) for n, c in (("few", "id < 25"), ("many", "id >= 25"), ("none", "id < 0")))
    for picked, others, n in ((few, many, 25), (many, few, 1975), (table(paths.select("rel_path"), "all"), none, 2000)):
        mine = clean_batch.pieces_of(chunks, picked, others)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16k")
        try:
            assert mine.select("*").count() == n and "SortMergeJoin" not in mine.select("*")._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_run_keeps_each_piece_once(spark, tmp_path):
    """Pieces lie in the table of pieces only, each reply is stored once beside its verdict and once as a result, and no shuffle files stay."""
    config = clean_batch.Config(store=str(tmp_path), prompt_sha256="p", strict=False, max_chars=60, wave=2)
    sources = as_sources(spark, [(f"{n}.md", f"text of {n} with some words\n\n" * 4) for n in "abc"])
    first = clean_batch.run(spark, sources, dataclasses.replace(config, max_files=1), transport.Identity())
    done = clean_batch.run(spark, sources, config, transport.Identity())
    assert sorted(statuses(first).values()) == ["pending", "pending", "succeeded"] and sorted(statuses(done).values()) == ["skipped", "succeeded", "succeeded"]
    tables = {p.name: spark.read.parquet(str(p)).columns for p in tmp_path.iterdir() if list(p.glob("version=*"))}
    assert [n for n, columns in tables.items() if "chunk" in columns] == ["chunks"] and not {"waves", "replies", "judged", "taken"} & set(tables)
    assert {n for n, columns in tables.items() if "reply" in columns} == {"paid_replies", "reused"}
    assert spark.conf.get(state.CLEANUP) == "false" and {r.total for r in done["stats"].collect()} == {r.success for r in done["stats"].collect()}


def test_policy():
    t = quality.load_thresholds({"QUALITY_REVIEW_MIN_RETAINED_RATIO": "0.8"})
    assert t["review_min_retained_ratio"] == 0.8 and quality.policy_sha256(t) != quality.policy_sha256(fx.THRESHOLDS)
    for bad in ({"QUALITY_SEVERE_MIN_RETAINED_RATIO": "0.9"}, {"QUALITY_TABLE_RETAINED_RATIO": "11"}, {"QUALITY_TABLE_RETAINED_RATIO": "x"}, {"QUALITY_WARNING_MAX_EXPANSION_RATIO": "3"}):
        with pytest.raises(ValueError):
            quality.load_thresholds(bad)


MATTER = f"---\ntitle: A\nsubject: {fx.SUBJECTS[1]}\nsource: null\ntype: book\nyear: 2020\nstatus: {fx.FIELD_STATUS}\n---\n"


def test_validation(spark):
    rows = [
        (1, MATTER + "body", "c", 1), (2, "body", "c", 1), (3, "body", "c", 2), (4, "---\ntitle: x\n", "c", 1), (5, "  ", "c", 1), (6, "<html><body>", "c", 2), (7, '{"error": 1}', "c", 2),
        (8, "502 Bad Gateway", "c", 2), (9, "好的，this", "c", 2), (10, MATTER + "x", "c", 2), (11, MATTER.replace("2020", "true"), "c", 1), (12, MATTER.replace("2020", "99"), "c", 1), (13, "---\n[a]\n---\nx", "c", 1),
        (14, "```\nx\n```", "c" * 300, 2), (15, MATTER.replace("null", "2020-01-01"), "c", 1),
    ]
    got = {r.i: (list(r.errors), list(r.warnings)) for r in validation.validate(spark.createDataFrame(rows, "i int, reply string, chunk string, part_number int")).collect()}
    s = fx.SAYS
    assert got[1] == ([], []) and got[2] == ([s["missing"]], []) and got[3] == ([], []) and got[4] == ([s["unclosed"]], []) and got[5] == ([s["blank"]], [])
    assert got[6] == ([s["html"]], []) and got[7] == ([s["json"]], []) and got[8] == ([s["service_short"] + "bad gateway"], []) and got[9] == ([], [s["explained"] + "好的，"])
    assert got[10] == ([], [s["later"]]) and len(got[11][0]) == 1 and got[12][0] == [] and len(got[12][1]) == 1 and len(got[13][0]) == 1
    assert got[14] == ([], [s["short"], s["fence"]]) and len(got[15][0]) == 2  # a date is no scalar, and no string


def test_assembly(spark):
    rows = [("a", 1, 2, MATTER + "one", []), ("a", 2, 2, MATTER + "two", ["w"]), ("b", 1, 2, "only", []), ("c", 2, 2, "y", []), ("c", 1, 2, " ", []), ("d", 1, 2, "x", []), ("d", 2, 2, MATTER, [])]
    df = spark.createDataFrame(rows, "rel_path string, part_number int, total_parts int, body string, warnings array<string>")
    got = {r.rel_path: r for r in assembly.assemble(df).collect()}
    assert set(got) == {"a", "d"} and got["a"].text == MATTER + "one\n\ntwo" and got["a"].parts_review and got["a"].part_warnings[0].part == 2 and got["d"].text == "x"


def test_batches(spark):
    rows = [("20240101T000000000000Z-0123456789ab", i, p, s, None, a, None, None) for i, (p, s, a) in enumerate([("a.md", "failed", 1), ("b.md", "running", 1), ("a.md", "failed", 2), ("../c.md", "pending", 0), ("d.md", "odd", -1)])]
    df = spark.createDataFrame(rows, "batch_id string, ord int, path string, status string, error string, attempts int, started_at timestamp, finished_at timestamp")
    assert {r.path: sorted(r.faults) for r in batches.faults(df).collect()} == {"a.md": ["repeated"], "../c.md": ["path"], "d.md": ["attempts", "status"]}
    assert [(r.path, r.ord) for r in batches.retryable(df).collect()] == [("a.md", 0)]
    child = batches.retry_child(df, "20240102T000000000000Z-0123456789ab").collect()
    assert [(r.path, r.status, r.attempts, r.parent_batch_id[:8]) for r in child] == [("a.md", "pending", 0, "20240101")]
    assert [r.attempts for r in batches.cancelled(df).where("path = 'b.md'").collect()] == [0]
    assert [r.status for r in batches.resumed(df).where("path = 'b.md'").collect()] == ["interrupted"]
    done = batches.moved(df.where("ord = 0"), F.lit("failed"), F.lit("Bearer 123456789\nx"), F.lit("2024-01-01 00:00:00").cast("timestamp")).first()
    assert done.error == "Bearer *** x" and done.finished_at is not None
    runs = spark.createDataFrame([("u", i, c == "x") for i, c in enumerate("xx.xxxxx.x")], "u string, i int, bad boolean")
    assert batches.stop_points(runs, "u", "i", F.col("bad")).collect()[0].stop_at == 7
    with pytest.raises(ValueError):
        batches.retry_child(df, "x")


def test_sources(spark, tmp_path):
    base = tmp_path / "in"
    (base / "sub").mkdir(parents=True)
    for name, raw in {"_a.md": b"x", ".b.MD": "é".encode(), "sub/c.md": "﻿安全\r\n".encode(), "d_cleaned.md": b"no", "e.txt": b"no", "g.md": "安全".encode("gb18030"), "h.md": b"\xff\xff", "big.md": b"y" * 50}.items():
        (base / name).write_bytes(raw)
    (base / "link.md").symlink_to(base / "_a.md")
    paths = files.list_markdown(str(base))
    assert paths == [".b.MD", "_a.md", "big.md", "g.md", "h.md", "sub/c.md"]
    got = {r.rel_path: r for r in files.read_sources(spark, str(base), [*paths, "gone.md"], 40).collect()}
    assert got["sub/c.md"].text == "安全\r\n" and got["g.md"].text == "安全" and got["_a.md"].source_chars == 1
    assert all(got[p].plan_error for p in ("h.md", "big.md", "gone.md")) and files.list_markdown(str(base / "none")) == []
    good = {"schema": "s", "schema_version": 1, "source": {"kind": "files", "root": None}, "paths": ["b.md", "a.md", "b.md"]}
    (tmp_path / "l.json").write_text(json.dumps(good))
    assert files.read_selection(str(tmp_path / "l.json"), "s") == ["b.md", "a.md"]
    for change in ({"schema_version": True}, {"schema": "t"}, {"paths": ["../x.md"]}, {"source": {"kind": "files"}}):
        (tmp_path / "l.json").write_text(json.dumps(good | change))
        with pytest.raises(ValueError):
            files.read_selection(str(tmp_path / "l.json"), "s")
    assert files.prompt_identity("```md\r\nA\r\nB\r\n```")[:2] == files.prompt_identity("A\nB")[:2] and len(files.prompt_identity("A\r\nB")[2]) == 1


def test_events_and_retries():
    stream = [": hi", 'data: {"choices":[{"delta":{"content":"a"}}]}', 'data: {"choices":[{"message":{"content":[{"text":{"value":"b"}},"c"]}}]}', "data: [DONE]"]
    assert transport.read_events(iter(stream)) == "abc"
    with pytest.raises(transport.Retryable) as cut:
        transport.read_events(iter(stream[:2]))
    assert cut.value.partial == "a"
    for bad in ('data: {"choices":[{"finish_reason":"length"}]}', 'data: {"error":"bad key"}', "data: [1]"):
        with pytest.raises(RuntimeError):
            transport.read_events(iter([bad]))
    waits, calls = [], iter([transport.Retryable("x", 7.0), transport.Retryable("y", partial="p"), "ok"])

    def call():
        out = next(calls)
        if isinstance(out, Exception):
            raise out
        return out

    assert transport.with_retries(call, waits.append) == ("ok", None, "p", 3) and waits[0] == 7.0 and 10 <= waits[1] <= 11


def test_whole_run_and_reuse(spark, tmp_path):
    text = "para one with words. " * 30
    rows = [("a.md", text), ("b.md", "```\n" + "x" * 900 + "\n```\n"), ("c.md", ""), ("d.md", "short text 5")]
    sources = files.table_sources(spark.createDataFrame(rows, "p string, t string"), F.col("p"), F.col("t"))
    config = clean_batch.Config(store=str(tmp_path), prompt_sha256="p", strict=False, max_chars=300)
    first = clean_batch.run(spark, sources, config, transport.Identity())
    assert {r.path: r.status for r in first["files"].collect()} == {"a.md": "succeeded", "b.md": "failed", "c.md": "succeeded", "d.md": "succeeded"}
    assert {r.rel_path for r in first["documents"].collect()} == {"a.md", "d.md"} and first["review"].count() == 2
    second = clean_batch.run(spark, sources, config, transport.Scripted(lambda chunk: "not called"))
    assert {r.rel_path: r.text for r in second["documents"].collect()} == {r.rel_path: r.text for r in first["documents"].collect()}
    spoiled = clean_batch.run(spark, sources, clean_batch.Config(store=str(tmp_path), prompt_sha256="q", strict=False, max_chars=300), transport.Scripted(lambda chunk: chunk.replace("5", "6")))
    assert [r.failure_stage for r in spoiled["failed"].collect()] == ["quality"]
    taken = clean_batch.run(spark, sources, clean_batch.Config(store=str(tmp_path), prompt_sha256="q", strict=False, max_chars=300), transport.Identity(), accept_failed=True)
    assert taken["results"].where("rel_path = 'd.md'").first().body == "short text 6"
    counts = clean_batch.summary(first["files"]).first()
    assert counts.batch_status == "completed_with_failures" and counts.percent == 100
    paths = [r.path for r in sinks.export_documents(first["documents"], str(tmp_path / "out")).collect()]
    assert len(paths) == 2 and all(p.endswith("_cleaned.md") for p in paths)


def test_ingest(spark, tmp_path):
    from lexgate.streaming.ingest import ingest

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.md").write_text("one")
    for expected, name in ((1, "b.md"), (2, "c_cleaned.md")):
        ingest(spark, str(tmp_path / "in"), str(tmp_path / "table"), str(tmp_path / "check")).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "table")).count() == expected
        (tmp_path / "in" / name).write_text("two")


def test_job_options(tmp_path):
    from lexgate.plans import job

    options = lambda *a: job.checked(job.parser().parse_args(a))
    assert options("--no-strict", "--retry-failed", "--accept-failed").retry_failed == "latest"
    for bad in (["--workers", "11"], ["--accept-failed"], ["--batch-status", "--dry-run"], ["--resume-batch", "--retry-failed"], ["--resume-batch", "x"], ["--max-chars", "0"], ["--workers", "2", "--dry-run"], ["--retry-failed", "--selection-file", "f"]):
        with pytest.raises(ValueError):
            options(*bad)
    assert job.base_url(" https://h/v1/ ") == "https://h/v1" and job.base_url("http://127.0.0.1:8/") == "http://127.0.0.1:8" and job.base_url("") == ""
    for bad in ("ftp://h", "http://h/", "https://u:p@h", "https://h?k=1"):
        with pytest.raises(ValueError):
            job.base_url(bad)


def test_job(spark, tmp_path, capsys):
    from lexgate.plans import job

    (tmp_path / "input").mkdir()
    (tmp_path / "input" / "a.md").write_text("hello there")
    (tmp_path / "input" / "b.md").write_bytes(b"\xff\xff")
    base = ["--base-dir", str(tmp_path), "--no-strict"]
    assert job.main([*base, "--dry-run"]) == 0 and '"pieces": 1' in capsys.readouterr().out
    assert job.main(base) == 2
    assert job.main([*base, "--batch-status"]) == 0 and '"failed": 1' in capsys.readouterr().out
    assert len(list((tmp_path / "output").rglob("*_cleaned.md"))) == 1
    (tmp_path / "input" / "b.md").write_text("now fine")
    assert job.main([*base, "--retry-failed"]) == 0 and job.main(["--workers", "0"]) == 1


# ---- pruning, limits, stops, budgets, batches that go on


def statuses(done):
    return {r.path: r.status for r in done["files"].collect()}


def as_sources(spark, rows):
    return files.table_sources(spark.createDataFrame(rows, "p string, t string"), F.col("p"), F.col("t"))


def test_files_without_work_are_skipped_before_the_limit(spark, tmp_path):
    sources = as_sources(spark, [(f"{n}.md", f"text of {n} with some words") for n in "abcde"])
    config = lambda **more: clean_batch.Config(store=str(tmp_path), prompt_sha256="p", strict=False, **more)
    first = clean_batch.run(spark, sources, config(max_files=2), transport.Identity())
    assert statuses(first) == {"a.md": "succeeded", "b.md": "succeeded", "c.md": "pending", "d.md": "pending", "e.md": "pending"}
    assert first["header"].first().status == "incomplete" and first["header"].first().completed_at is None
    assert {r.path: r.attempts for r in first["files"].collect()} == {"a.md": 1, "b.md": 1, "c.md": 0, "d.md": 0, "e.md": 0}
    second = clean_batch.run(spark, sources, config(max_files=2), transport.Identity())
    assert statuses(second) == {"a.md": "skipped", "b.md": "skipped", "c.md": "succeeded", "d.md": "succeeded", "e.md": "pending"}
    third = clean_batch.run(spark, sources, config(), transport.Identity())
    assert [p for p, s in statuses(third).items() if s == "succeeded"] == ["e.md"] and third["header"].first().status == "completed"
    assert clean_batch.run(spark, sources, config(), transport.Identity())["results"].count() == 0
    stored = sinks.read_versions(spark, f"{tmp_path}/chunk_results", clean_batch.RESULTS)
    assert stored.count() == 5 and clean_batch.stored_documents(spark, config()).count() == 5  # a reused reply is not stored again
    # another policy judges the stored replies anew and sends nothing; another text sends its file only
    other = clean_batch.run(spark, sources, config(thresholds=fx.THRESHOLDS | {"review_min_retained_ratio": 0.6}), transport.Scripted(lambda chunk: 1 / 0))
    assert set(statuses(other).values()) == {"succeeded"} and {r.skipped for r in other["stats"].collect()} == {1}
    changed = as_sources(spark, [("a.md", "another text of a"), ("b.md", "text of b with some words")])
    assert statuses(clean_batch.run(spark, changed, config(thresholds=fx.THRESHOLDS | {"review_min_retained_ratio": 0.6}), transport.Identity())) == {"a.md": "succeeded", "b.md": "skipped"}


def test_a_lost_review_copy_or_document_is_made_again(spark, tmp_path):
    import shutil

    sources = as_sources(spark, [("a.md", "plain words"), ("b.md", "扫码关注领取资料\nwords")])
    config = clean_batch.Config(store=str(tmp_path), prompt_sha256="p", strict=False)
    first = clean_batch.run(spark, sources, config, transport.Identity())
    assert [r.rel_path for r in first["review"].collect()] == [r.rel_path for r in clean_batch.stored_review(spark, config).collect()]
    assert set(statuses(clean_batch.run(spark, sources, config, transport.Scripted(lambda chunk: 1 / 0))).values()) == {"skipped"}
    shutil.rmtree(tmp_path / "review")
    again = statuses(clean_batch.run(spark, sources, config, transport.Scripted(lambda chunk: 1 / 0)))
    assert again["b.md"] == "succeeded"
    shutil.rmtree(tmp_path / "final_documents")
    assert set(statuses(clean_batch.run(spark, sources, config, transport.Scripted(lambda chunk: 1 / 0))).values()) == {"succeeded"}


def test_warnings_are_those_of_rules_and_report(spark):
    config = clean_batch.Config(store="", strict=False)
    rows = [("c" * 250 + "\n", "扫码关注领取资料\n" + "c" * 90, 2, None)]
    got = clean_batch.judged(spark.createDataFrame(rows, "chunk string, reply string, part_number int, error string"), config).first()
    assert fx.SAYS["short"] in got.warnings and fx.SAYS["ads"] in got.warnings and fx.SAYS["kept_warning"].format("50%") in got.warnings
    assert list(got.warnings).index(fx.SAYS["short"]) < list(got.warnings).index(fx.SAYS["ads"])


def test_a_dead_endpoint_is_left_after_five_failures(spark, tmp_path):
    class Dead(transport.Transport):
        limited = True

        def reply(self, chunk, message):
            raise RuntimeError("status 401")

    sources = as_sources(spark, [(f"{i:02}.md", f"text {i}") for i in range(12)])
    done = clean_batch.run(spark, sources, clean_batch.Config(store=str(tmp_path), strict=False), Dead())
    got = sorted(statuses(done).values())
    assert got == ["failed"] * 5 + ["pending"] * 7 and done["header"].first().status == "stopped"
    assert {r.failure_reason for r in done["failed"].collect()} == {"status 401"}


def test_requests_over_the_budget_never_leave(spark, tmp_path):
    sources = as_sources(spark, [("big.md", "words " * 2000), ("small.md", "few words")])
    config = clean_batch.Config(store=str(tmp_path), strict=False, prompt_tokens=100, budget=transport.Budget(window=3000, output=500))
    done = clean_batch.run(spark, sources, config, transport.Scripted(lambda chunk: chunk if len(chunk) < 100 else 1 / 0))
    assert statuses(done) == {"big.md": "failed", "small.md": "succeeded"}
    failed = done["failed"].first()
    assert failed.failure_stage == "budget" and "3000" in failed.failure_reason
    for bad in ({"window": -1}, {"limit_name": "size"}):
        with pytest.raises(ValueError):
            transport.Budget(**bad)


def test_sources_that_change_are_not_published(spark, tmp_path):
    sources = as_sources(spark, [("a.md", "text a"), ("b.md", "text b")])
    rehash = lambda paths: paths.select("rel_path", F.when(F.col("rel_path") == "b.md", "other").otherwise(tx.sha256(F.lit("text a"))).alias("source_sha256"))
    done = clean_batch.run(spark, sources, clean_batch.Config(store=str(tmp_path), strict=False), transport.Identity(), rehash=rehash)
    assert statuses(done) == {"a.md": "succeeded", "b.md": "failed"} and [r.rel_path for r in done["documents"].collect()] == ["a.md"]
    assert "changed" in done["files"].where("path = 'b.md'").first().error


def test_failed_candidates_are_the_newest_and_cleared_by_success(spark, tmp_path):
    sources = as_sources(spark, [("a.md", "the limit is 5 mg")])
    config = clean_batch.Config(store=str(tmp_path), prompt_sha256="p", strict=False)
    for number in ("6", "7"):
        clean_batch.run(spark, sources, config, transport.Scripted(lambda chunk, n=number: chunk.replace("5", n)))
    assert [r.body for r in clean_batch.failed_candidates(spark, config).collect()] == ["the limit is 7 mg"]
    clean_batch.run(spark, sources, config, transport.Identity())
    assert clean_batch.failed_candidates(spark, config).count() == 0


def test_a_batch_goes_on_and_a_retry_names_its_parent(spark, tmp_path, capsys):
    from lexgate.plans import job

    (tmp_path / "input").mkdir()
    for n in "abc":
        (tmp_path / "input" / f"{n}.md").write_text(f"text {n}")
    (tmp_path / "input" / "d.md").write_bytes(b"\xff\xff")
    base, store = ["--base-dir", str(tmp_path), "--no-strict"], str(tmp_path / "store")
    assert job.main([*base, "--max-files", "2"], {}) == 2
    first = job.stored_files(spark, store, "latest")
    batch = first.first().batch_id
    assert {r.path: r.status for r in first.collect()} == {"a.md": "succeeded", "b.md": "succeeded", "c.md": "pending", "d.md": "failed"}
    assert job.main([*base, "--resume-batch"], {}) == 2  # d.md stays failed
    went_on = job.stored_files(spark, store, batch)
    assert {r.path: (r.status, r.attempts) for r in went_on.collect()} == {"a.md": ("succeeded", 1), "b.md": ("succeeded", 1), "c.md": ("succeeded", 1), "d.md": ("failed", 0)}
    (tmp_path / "input" / "d.md").write_text("now fine")
    assert job.main([*base, "--retry-failed", batch], {}) == 0
    header = sinks.newest(sinks.read_versions(spark, f"{store}/batches", clean_batch.HEADER), ["batch_id"]).orderBy("batch_id").collect()
    assert [(h.selection_source, h.parent_batch_id, h.status) for h in header] == [("resume", None, "completed_with_failures"), ("retry_failed", batch, "completed")]
    assert [(r.path, r.status) for r in job.stored_files(spark, store, "latest").collect()] == [("d.md", "succeeded")]
    assert [r.status for r in job.stored_files(spark, store, batch).where("path = 'd.md'").collect()] == ["failed"]
    log = [json.loads(line) for f in (tmp_path / "log").glob("*.json") for line in f.read_text().splitlines()]
    assert {x["status"] for x in log} >= {"succeeded", "failed"} and all(set(x) == {"time", "file", "status", "detail"} for x in log)


def test_selected_paths(spark, tmp_path):
    base = tmp_path / "in"
    (base / "sub").mkdir(parents=True)
    (base / "a.md").write_text("x")
    (base / "sub" / "b.md").write_text("x")
    (base / "link").symlink_to(base / "sub")
    assert files.resolved_paths(["sub/b.md", "a.md", "a.md", "gone.md"], str(base)) == ["sub/b.md", "a.md", "gone.md"]
    (base / "dir.md").mkdir()
    for bad in ("link/b.md", "../a.md", "a.txt", "x_cleaned.md", "dir.md", "", "C:/a.md", "a\\b.md", 3):
        with pytest.raises(ValueError):
            files.resolved_paths([bad], str(base))
    (tmp_path / "l.json").write_bytes(b"\xef\xbb\xbf" + json.dumps({"schema": "some-tool/selection", "schema_version": 1, "source": {"kind": "files", "root": None}, "paths": ["a.md"]}).encode())
    assert files.read_selection(str(tmp_path / "l.json"), base=str(tmp_path)) == ["a.md"]
    for bad in (str(tmp_path / "none.json"), "/etc/hostname"):
        with pytest.raises(ValueError):
            files.read_selection(bad, base=str(tmp_path))
    listed = spark.createDataFrame([(7, "a.md"), (3, "sub/b.md")], "ord int, rel_path string")
    assert {r.rel_path: (r.ord, r.text) for r in files.read_sources(spark, str(base), listed).collect()} == {"a.md": (7, "x"), "sub/b.md": (3, "x")}


def test_connection_and_limits():
    from lexgate.plans import job

    assert job.connection({"OPENAI_API_KEY": " k ", "OPENAI_BASE_URL": "https://h/v1/"}) == {"key": "k", "base_url": "https://h/v1", "model": ""}
    assert job.limits({"OPENAI_CONTEXT_WINDOW": "8000", "OPENAI_TOKEN_PARAMETER": "max_completion_tokens"}) == transport.Budget(8000, 0, 1024, "max_completion_tokens")
    for bad in ({"OPENAI_CONTEXT_WINDOW": "-1"}, {"OPENAI_MAX_OUTPUT_TOKENS": "x"}, {"OPENAI_TOKEN_PARAMETER": "y"}):
        with pytest.raises(ValueError):
            job.limits(bad)
    assert job.main(["--base-url", "https://h"], {}) == 1 and job.main([], {"QUALITY_TABLE_RETAINED_RATIO": "x"}) == 1


def test_env_file_and_home(spark, tmp_path, capsys):
    from lexgate.plans import job

    (tmp_path / ".env").write_text("# all of it\nexport OPENAI_MODEL = 'm # 1'  # name\nOPENAI_BASE_URL=https://h/v1 # where\nA=\nB=\"x \\\"y\\\"\"\nnot a line\nQUALITY_TABLE_RETAINED_RATIO=x\n")
    assert job.env_file(tmp_path / ".env") == {"OPENAI_MODEL": "m # 1", "OPENAI_BASE_URL": "https://h/v1", "A": "", "B": 'x "y"', "QUALITY_TABLE_RETAINED_RATIO": "x"}
    assert job.env_file(tmp_path / "none") == {}
    # the file of the home folder is read, and goes before the environment
    assert job.main([], {"LEXGATE_HOME": str(tmp_path), "QUALITY_TABLE_RETAINED_RATIO": "0.5", "OPENAI_API_KEY": "k"}) == 1
    assert "TABLE_RETAINED_RATIO" in capsys.readouterr().out.upper()


def test_retry_after():
    import datetime

    now = datetime.datetime(2026, 10, 21, 7, 27, 0, tzinfo=datetime.UTC)
    assert [transport.retry_after(v, now) for v in ("30", "1.5", "-3", "Wed, 21 Oct 2026 07:28:00 GMT", "Wed, 21 Oct 2026 07:28:00", "Wed, 21 Oct 2020 07:28:00 GMT")] == [30, 1.5, 0, 60, 60, 0]
    assert [transport.retry_after(v) for v in ("", "soon", "nan", "inf")] == [None] * 4


def test_piece_sums(spark):
    pieces = spark.createDataFrame([("a",)] * 4 + [("b",)], "rel_path string")
    judged = spark.createDataFrame([("a", None, True), ("a", None, False), ("a", "quality", True)], "rel_path string, failure_stage string, fresh boolean")
    replies = spark.createDataFrame([("a", "e", "request"), ("b", "e", "stopped"), ("a", None, None)], "rel_path string, error string, stage string")
    got = {r.rel_path: (r.total, r.success, r.failed, r.skipped) for r in batches.piece_stats(pieces, judged, replies).collect()}
    assert got == {"a": (4, 2, 2, 1), "b": (1, 0, 0, 0)}


def test_decoded_texts_leave_a_slice_of_rows_at_a_time():
    assert _slices(files.decoded, b"a") == [ROWS, ROWS, 1]


def test_pieces_are_sent_a_slice_of_rows_at_a_time(spark):
    n = 2 * ROWS + 1
    pieces = spark.range(n).repartition(1).select(F.concat(F.lit("f"), F.col("id").cast("string")).alias("rel_path"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("kept"), F.when(F.col("id") % 3 == 0, " ").otherwise("x").alias("chunk"),
                                                  F.lit("s").alias("chunk_sha256"), F.lit(1).alias("part_number"), F.lit(1).alias("total_parts"))
    sent = transport.clean(pieces, transport.Identity())
    assert "MapInArrow" in sent._jdf.queryExecution().toString()
    rows = {r.rel_path: r for r in sent.collect()}
    assert len(rows) == n and all(r.reply == r.chunk and r.error is None and r.attempts == (r.chunk == "x") and r.kept == (int(p[1:]) if int(p[1:]) % 2 == 0 else None) for p, r in rows.items())
