"""Blocks and chunks: exact spans, whole structures, natural cuts."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import types as T

from lexgate.functions import markdown as md
from lexgate.functions.rows import ROWS, by_rows


def kinds(text):
    return [(k, t) for k, t in md.blocks(text) if k != "blank"]


def test_kinds():
    text = "---\ntitle: x\n---\n# H\npara\n\n```py\na\n\nb\n```\n\n    code\n\n    more\n\n- a\n  b\n- c\n\n> q\n>\n> r\n\n| a | b |\n|---|---|\n| 1 | 2 |\n"
    assert [k for k, _ in kinds(text)] == ["front_matter", "normal", "fenced_code", "indented_code", "list_item", "list_item", "blockquote", "blockquote", "table"]
    assert "".join(t for _, t in md.blocks(text)) == text


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("~~~~\n~~~\n~~~~\nx", ["fenced_code", "normal"]),  # a shorter fence does not close
        ("```\nopen to the end\n\n- a", ["fenced_code"]),
        ("- a\n\n  inside\n\nout", ["list_item", "normal"]),
        ("- a\n\n    - deep\n- b", ["list_item", "list_item"]),
        ("- a\nlazy\n# also lazy", ["list_item"]),
        ("> a\nlazy\n- item", ["blockquote", "list_item"]),
        ("> ```\n>\n> ```\n>\n> x", ["blockquote", "blockquote"]),
        ("﻿---\na: 1\n", ["front_matter"]),
        ("text\n---\n", ["normal"]),
        ("1234567890. no list", ["normal"]),
        ("\tcode\n\n\n", ["indented_code"]),
    ],
)
def test_structure(text, want):
    assert [k for k, _ in kinds(text)] == want


def test_chunks_are_lossless_and_bounded():
    r = random.Random(5)
    lines = ["- a", "  - b", "1. x", "text here.", "> q", ">", "> ```", "```", "~~~", "    code", "", "   ", "| a | b |", "| --- | --- |", "# H", "---", "lazy line; more. words", "     - deep"]
    for _ in range(3000):
        text = "".join(r.choice(lines) + r.choice(["\n", "\r\n", "\r", "\x0b", ""]) for _ in range(r.randint(0, 14)))
        size = r.randint(5, 60)
        assert "".join(t for _, t in md.blocks(text)) == text
        try:
            chunks = md.chunks(text, size)
        except md.TooLong:
            continue
        assert "".join(chunks) == text and all(0 < len(c) <= size for c in chunks)


def test_cuts():
    assert md.cut_at("aaaa\nbbbb\ncc", 9) == 5
    assert md.cut_at("aaaa. bbbbbb", 8) == 6
    assert md.cut_at("a bbbbbbbbbb", 8) == 0  # the only blank lies in the front half
    assert md.cut_at("aaaaaa \nbbbb", 7) == 0  # a blank before a line end is no cut
    with pytest.raises(md.TooLong):
        md.chunks("x" * 20, 10)
    with pytest.raises(md.TooLong):
        md.chunks("```\n" + "x " * 20 + "\n```", 10)
    with pytest.raises(md.TooLong):
        md.chunks("a", 0)
    assert md.chunks("", 5) == []


def test_packing_of_blocks():
    assert md.chunks("aa\n\nbb\n\ncc", 6) == ["aa\n\nbb"[:4], "bb\n\ncc"]
    assert md.chunks("ab\n\n" + "w " * 10 + "\n\ncd", 8)[0] == "ab\n\n"  # a block that is cut stands by itself


def test_table_functions(spark):
    md.register(spark)
    rows = spark.sql("SELECT * FROM md_blocks('# a\n\n- b\n')").collect()
    assert [(r.block_no, r.kind) for r in rows] == [(0, "normal"), (1, "blank"), (2, "list_item")]
    assert spark.sql("SELECT error FROM md_chunks('xxxxxxxxxx', 5)").first().error
    df = spark.createDataFrame([("a", "x\n\ny"), ("b", "z" * 50), ("c", None)], "rel_path string, text string")
    parts, errors = md.md_chunks(df, 10)
    assert [(r.rel_path, r.part_number, r.total_parts) for r in parts.collect()] == [("a", 1, 1)]
    assert [r.rel_path for r in errors.collect()] == ["b"]


def test_blocks_do_not_depend_on_how_a_text_comes(monkeypatch):
    import random

    r = random.Random(7)
    lines = ["# h\n", "text\n", "text more\r\n", "\n", " \n", "\t\n", "- a\n", "  - b\n", "    code\n", "1. x\n", "   2) y\n", "> q\n", ">\n", "> ```\n", "```\n", "~~~\n", "````\n", "| a | b |\n", "| --- | --- |\n", "---\n", "a: b\n", "x\x0by\n", "* s\r", "lazy\r", "  \r\n", "plain", "\r"]
    for _ in range(3000):
        text = "".join(r.choice(lines) for _ in range(r.randint(0, 14)))
        whole = list(md.blocks(text))
        assert "".join(md.paragraphs(text)) == text and [t for _, t in whole] == md.paragraphs(text)
        for size in (1, 2, 7):
            assert list(md.blocks_of(text[i : i + size] for i in range(0, len(text), size))) == whole
        scanner = md.Scanner()
        fed = [b for line in text.splitlines(keepends=True) for b in scanner.feed(line)]
        assert fed + scanner.finish() == whole
        assert all(md.is_fenced(t) == (k == "fenced_code") for k, t in whole if k in ("fenced_code", "blank", "list_item", "blockquote"))


def test_kinds_of_blocks_that_need_what_comes_later():
    kinds = lambda text: [k for k, _ in md.blocks(text)]
    assert kinds("- a\n\n  deeper\n- b\n\nend\n") == ["list_item", "list_item", "blank", "normal"]
    assert kinds("    code\n\n    more\n\nend") == ["indented_code", "blank", "normal"]
    assert kinds("> a\n>\n> b\nlazy\n# h\n") == ["blockquote", "blockquote", "normal"]
    assert kinds("---\na: 1\n---\n---\n") == ["front_matter", "normal"] and kinds("```\nnever closed\n\n- a\n") == ["fenced_code"]
    assert kinds("a | b\n| --- | --- |\n") == ["table"]


def test_a_long_text_is_scanned_line_by_line(spark):
    text = "- item of a list\n" * 200_000 + "\n```\n" + "code\n" * 200_000
    rows = md.md_blocks(spark.createDataFrame([("a", text)], "rel_path string, text string")).groupBy("kind").count().collect()
    assert {r.kind: r["count"] for r in rows} == {"list_item": 200_000, "blank": 1, "fenced_code": 1}


def test_plans_leave_a_slice_of_rows_at_a_time(spark):
    n = 2 * ROWS + 1
    texts = spark.range(n).repartition(1).selectExpr("id AS doc_id", "CASE WHEN id % 2 = 0 THEN repeat('ab. ', 10) ELSE repeat('x', 40) END AS text")
    parts, errors = md.md_chunks(texts, 20, "text", ("doc_id",))
    assert (parts.count(), errors.count()) == (2 * (ROWS + 1), ROWS)
    column = by_rows(T.StringType())(lambda x: x)
    assert [len(x) for x in column.func(iter([pa.array(["a"] * n)]))] == [ROWS, ROWS, 1]
