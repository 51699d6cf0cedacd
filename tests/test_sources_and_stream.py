"""Listing as jobs, the stream into the batch job, manifests."""

import json

import pytest
from pyspark.sql import functions as F

from lexgate.functions import fixed as fx
from lexgate.operators import manifests, transport
from lexgate.plans import clean_batch
from lexgate.sources import files, state
from lexgate.streaming.ingest import clean_new_files


def test_folders_are_listed_level_by_level(spark, tmp_path):
    base = tmp_path / "in"
    for i in range(120):
        sub = base / f"d{i % 7}" / (f"E{i % 3}" if i % 2 else "") / (".hid" if i % 11 == 0 else "")
        sub.mkdir(parents=True, exist_ok=True)
        (sub / f"{'_' if i % 5 == 0 else ''}File {i}.{'MD' if i % 4 else 'md'}").write_text("x")
    (base / "d1" / "x_Cleaned.md").write_text("x")
    (base / "d1" / "x.txt").write_text("x")
    (base / "dir.md").mkdir()
    (base / "link").symlink_to(base / "d1")
    (base / "l.md").symlink_to(base / "d1" / "x.txt")
    listed = files.ordered_paths(files.listed_folders(spark, str(base), str(tmp_path / "levels")), str(tmp_path / "paths"))
    got = [r.rel_path for r in listed.orderBy("ord").collect()]
    assert got == files.list_markdown(str(base)) and len(got) == 120
    assert sorted(r.ord for r in listed.collect()) == list(range(120))
    (tmp_path / "empty").mkdir()
    assert files.ordered_paths(files.listed_folders(spark, str(tmp_path / "empty"), str(tmp_path / "l2")), str(tmp_path / "p2")).count() == 0


def test_the_stream_cleans_each_text_once(spark, tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    put = lambda name, text: (tmp_path / "in" / name).write_text(text)
    put("a.md", "one text")
    put("sub/b.md", "one text")
    put("c.md", "another text")
    config = clean_batch.Config(store=str(tmp_path / "store"), prompt_sha256="p", strict=False)
    go = lambda how: clean_new_files(spark, str(tmp_path / "in"), config, how, str(tmp_path / "check")).awaitTermination()
    go(transport.Identity())
    published = lambda: {r.rel_path for r in clean_batch.stored_documents(spark, config).collect()}
    assert published() == {"a.md", "c.md"}
    put("d.md", "another text")
    put("e.md", "a third text")

    def third(chunk):
        if "third" not in chunk:
            raise RuntimeError("sent twice")
        return chunk

    go(transport.Scripted(third))
    assert published() == {"a.md", "c.md", "e.md"}
    go(transport.Scripted(lambda chunk: 1 / 0))
    seen = state.current(spark, f"{config.store}/content_seen", "source_sha256 string, rel_path string", ["source_sha256"])
    assert {r.rel_path for r in seen.collect()} == {"a.md", "c.md", "e.md"} and published() == {"a.md", "c.md", "e.md"}


BATCH = "20260101T000000000000Z-000000000001"


def made(**changes):
    file = {"path": "p/a.md", "status": "failed", "source_sha256": "a" * 64, "error": None, "attempts": 1, "started_at": None, "finished_at": "t"}
    counts = {"total": 1, **{s: int(s == "failed") for s in fx.FILE_STATUSES}}
    whole = {"schema": "x/batch-manifest", "schema_version": 1, "batch_id": BATCH, "created_at": "t", "updated_at": "t", "completed_at": None, "status": "completed_with_failures", "workers": 2,
             "selection": {"source": "scan", "selection_file": None, "parent_batch_id": None}, "counts": counts, "files": [file]}
    for k, v in changes.items():
        at, *rest = k.split("__")
        if rest and at == "files":
            file[rest[0]] = v
        elif rest:
            whole[at] = {**whole[at], rest[0]: v}
        else:
            whole[at] = v
    return whole


DAMAGES = [
    ({}, []), ({"more": 1}, ["keys"]), ({"schema": 7}, ["schema"]), ({"schema_version": "1"}, ["schema"]), ({"schema_version": True}, ["schema"]), ({"batch_id": "x"}, ["batch_id", "name"]), ({"created_at": None}, ["times"]), ({"completed_at": 3}, ["times"]),
    ({"status": "pending"}, ["status"]), ({"workers": 0}, ["workers"]), ({"workers": True}, ["workers"]), ({"workers": 1.5}, ["workers"]), ({"selection__more": 1}, ["selection"]), ({"selection__source": "x"}, ["selection"]), ({"selection": []}, ["selection"]),
    ({"selection__parent_batch_id": "x"}, ["selection"]), ({"selection__parent_batch_id": BATCH}, []), ({"files": {}}, ["files", "counts"]), ({"files": [1]}, ["file_keys", "path", "file_status", "sha256", "texts", "attempts", "counts"]), ({"files__more": 1}, ["file_keys"]), ({"files__path": "../a.md"}, ["path"]),
    ({"files__path": "a_cleaned.md"}, ["path"]), ({"files__status": "done"}, ["file_status", "counts"]), ({"files__source_sha256": "A" * 64}, ["sha256"]), ({"files__error": 1}, ["texts"]), ({"files__attempts": -1}, ["attempts"]), ({"files__attempts": True}, ["attempts"]),
    ({"files__attempts": "1"}, ["attempts"]), ({"counts__total": 2}, ["counts"]), ({"counts__more": 0}, ["counts"]), ({"counts__failed": "1"}, ["counts"]), ({"files": [], "counts": {"total": 0, **dict.fromkeys(fx.FILE_STATUSES, 0)}}, []),
]


def test_each_damage_to_a_manifest_is_named(spark):
    raw = [json.dumps(made(**c)).encode() for c, _ in DAMAGES]
    raw += [b"\xff{}", b"[]", b"{", b"", json.dumps(made()).encode().replace(b'"workers": 2', b'"workers": 2, "workers": 2')]
    wanted = [f for _, f in DAMAGES] + [["json"]] * 5
    rows = [(f"{BATCH}.json", i, r) for i, r in enumerate(raw)]
    frame = spark.createDataFrame([(f"{i:03}" + name, r) for name, i, r in rows], "name string, content binary")
    got = {r.name[:3]: list(r.faults) for r in manifests.read_manifests(frame).collect()}
    for i, w in enumerate(wanted):  # the number before the name makes every id differ from it
        told = [f for f in got[f"{i:03}"] if f != "name"]
        assert told == [f for f in w if f != "name"], (i, DAMAGES[i] if i < len(DAMAGES) else raw[i], got[f"{i:03}"])
        assert ("name" in got[f"{i:03}"]) == (w != ["json"])
    sound = spark.createDataFrame([(f"{BATCH}.json", raw[0])], "name string, content binary")
    assert list(manifests.read_manifests(sound).first().faults) == []
    twice = made(files=[made()["files"][0]] * 2, counts={"total": 2, **{s: 2 * int(s == "failed") for s in fx.FILE_STATUSES}})
    again = spark.createDataFrame([(f"{BATCH}.json", json.dumps(twice).encode())], "name string, content binary")
    assert list(manifests.read_manifests(again).first().faults) == ["repeated"] and list(manifests.read_manifests(again, repeats=True).first().faults) == []


def test_manifests_are_checked_before_they_are_written(spark):
    rows = spark.createDataFrame([(BATCH, 1, "b.md", "failed", "a" * 64, "e", 1, "t", None), (BATCH, 0, "a.md", "pending", None, None, 0, None, None)],
                                 "batch_id string, ord long, path string, status string, source_sha256 string, error string, attempts int, started_at string, finished_at string")
    heads = spark.createDataFrame([(BATCH, "t", "t", None, "incomplete", 1, "scan", None, None)], "batch_id string, created_at string, updated_at string, completed_at string, status string, workers int, selection_source string, selection_file string, parent_batch_id string")
    text = json.loads(manifests.checked(manifests.manifest_texts(rows, heads)).first().text)
    assert list(text) == manifests.KEYS and [f["path"] for f in text["files"]] == ["a.md", "b.md"] and text["counts"]["total"] == 2 and text["files"][0]["error"] is None
    assert json.loads(manifests.checked(manifests.manifest_texts(rows.limit(0), heads)).first().text)["files"] == []
    with pytest.raises(ValueError, match="attempts"):
        manifests.checked(manifests.manifest_texts(rows.withColumn("attempts", F.lit(-1)), heads))
