"""The stages of the pipeline, each against brute force on its own input."""

import corpus_pipeline
import numpy as np
import pytest
from test_operators import WORD, brute_near, brute_stats, check_packing

from lexgate.llm import quality_rules


def brute_strip(texts, n=100):
    """Texts without the characters all of whose bytes lie in a string of n bytes that starts earlier."""
    seen, out = set(), {}
    for d in sorted(texts):
        b = texts[d].encode()
        gone = bytearray(len(b))
        for i in range(len(b) - n + 1):
            if b[i : i + n] in seen:
                gone[i : i + n] = b"\1" * n
            seen.add(b[i : i + n])
        at, kept = 0, []
        for c in texts[d]:
            size = len(c.encode())
            if not all(gone[at : at + size]):
                kept.append(c)
            at += size
        out[d] = "".join(kept)
    return out


@pytest.fixture(scope="module")
def folder(spark, corpus, tmp_path_factory):
    top = tmp_path_factory.mktemp("corpus")
    rows = [(d, t, lang, source, None if t is None else len(t)) for d, t, source, lang, _ in corpus]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{top}/documents.parquet")
    spark.createDataFrame([(r[0], 1) for r in corpus if r[1] and "ab ab" not in r[1]] + [(r[0], 0) for r in corpus if r[1] and "ab ab" in r[1]], "doc_id long, quality int").write.parquet(f"{top}/labels.parquet")
    return str(top)


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r.text for r in docs.collect()} if i < 5 else {}
        out = stage(spark, docs, folder)
        out.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        if i < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            assert all(r.n_chars == len(r.text) for r in docs.collect())
        seen[name] = (before, {r.doc_id: r.text for r in docs.collect()} if i < 4 else docs.collect())
    before, after = seen["quality rules"]
    base = {d: brute_stats(t or "") for d, t in before.items()}
    sound = {d for d, s in base.items() if s[0] >= 20 and 100 * s[4] <= 30 * s[0]}
    verdicts = quality_rules.quality_rules(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    trees = {r.doc_id for r in verdicts.collect() if r.kept}
    assert set(after) == sound & trees and len(after) > 30 and after == {d: before[d] for d in after}
    before, after = seen["line dedup"]
    line = "one common line of many sites"
    assert sum(line in (t or "") for t in after.values()) == 1 < sum(line in (t or "") for t in before.values())
    before, after = seen["minhash near-dedup"]
    assert set(after) == {d for d, (_, root) in brute_near(before, 5, 80).items() if d == root}
    before, after = seen["suffix-array dedup"]
    assert after == {d: t for d, t in brute_strip(before).items() if WORD.search(t)} and after != before
    from lexgate.llm import bpe

    before, rows = seen["packing"]
    check_packing(rows, {d: np.append(bpe.load(bpe.default_path()).encode(t), 0).astype("<u4") for d, t in before.items()})
    assert sorted(r.length for r in corpus_pipeline.run(spark, folder).collect()) == sorted(r.length for r in rows)


def test_line_stage_keeps_every_document_that_holds_a_word(spark):
    licence = [f"clause {i} of a long licence that stands on very many sites" for i in range(20)]
    rows = [(i, "\n".join([*licence, f"own {i}"]), f"s{i}") for i in range(14)] + [(20, "\n".join(licence), "s1"), (21, "  \n", "s2"), (22, "nothing shared", "s3"), (23, None, "s4")]
    docs = spark.createDataFrame([(d, t, s, None if d in (3, 22) or t is None else len(t)) for d, t, s in rows], "doc_id long, text string, source string, n_chars long")
    sites = {line: {s for _, t, s in rows for x in (t or "").split("\n") if x == line} for line in licence}
    assert all(len(s) >= 10 for s in sites.values())
    wanted = {}
    for d, t, _ in rows:
        kept = "\n".join(x for x in (t or "").split("\n") if x not in sites or d == 0)
        if WORD.search(kept):
            wanted[d] = (kept, len(kept))
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.line_stage(spark, docs, "").collect()}
    assert got == wanted and set(got) == {*range(14), 22}


@pytest.mark.parametrize("number", range(5))
def test_stages_of_odd_tables(spark, folder, number):
    """Null and shared ids, null and empty texts, equal rows, clashing columns, and an empty table."""
    long = " ".join(f"word{i}" for i in range(60))
    rows = [(None, long, "en", "s1", None), (5, long, None, None, 3), (5, long, None, None, 3), (5, long[::-1], "en", "s2", 1), (7, None, None, None, None), (8, "", "en", "s3", 0), (9, " \n", "en", "s3", 2)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    name, stage = corpus_pipeline.STAGES[number]
    assert stage(spark, spark.createDataFrame([], schema), folder).count() == 0
    docs = spark.createDataFrame(rows, schema).selectExpr("*", "1 as row", "2 as id", "3 as spans", "4 as drop", "5 as n_lines_", "6 as key", "7 as head")
    got = [(r.doc_id, getattr(r, "text", None)) for r in stage(spark, docs, folder).collect()]
    reverse = (5, long[::-1])
    if name in ("quality rules", "line dedup"):
        assert sorted(got, key=str) == sorted([(None, long), (5, long), (5, long), reverse], key=str)
    if name == "minhash near-dedup":
        assert sorted(got, key=str) == sorted([(None, long), reverse, (7, None), (8, ""), (9, " \n")], key=str)
    if name == "suffix-array dedup":
        assert sorted(got, key=str) == sorted([(None, long), reverse], key=str)
    if name == "packing":
        assert len(got) >= len(rows) and sorted({str(d) for d, _ in got}) == ["5", "7", "8", "9", "None"]
