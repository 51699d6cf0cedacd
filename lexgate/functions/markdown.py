"""Structure-safe splitting of Markdown: blocks and chunks as table functions.

Blocks are exact spans of the source, chunks are runs of blocks, and joining either gives the source back.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fixed as fx
from .rows import by_rows

_EOL, _BREAK, _FENCE, _ITEM, _QUOTE = (re.compile(p) for p in (fx.LINE_END, fx.LINE_BREAK, fx.FENCE, fx.LIST_ITEM, fx.QUOTE))
_HEADING, _TABLE, _OPEN, _SENTENCE, _BEFORE_EOL = (re.compile(p) for p in (fx.ATX_HEADING, fx.TABLE_LINE, fx.FRONT_MATTER_LINE, fx.SENTENCE_END, fx.BLANK_LINE_END))

#: Kinds that are never cut inside.
WHOLE = {"fenced_code", "indented_code", "table", "list_item", "blockquote", "front_matter"}


def _width(blanks: str) -> int:
    """Columns of leading blanks; a tab goes to the next multiple of four."""
    n = 0
    for c in blanks:
        n += 1 if c == " " else 4 - n % 4
    return n


@dataclass(frozen=True)
class Line:
    raw: str

    @cached_property
    def body(self) -> str:
        return _EOL.sub("", self.raw, count=1)

    @cached_property
    def blank(self) -> bool:
        return not self.body.strip(" \t")

    @cached_property
    def indent(self) -> int:
        return _width(self.body[: len(self.body) - len(self.body.lstrip(" \t"))])

    @cached_property
    def fence(self) -> str:
        """The opening fence, or nothing."""
        found = _FENCE.match(self.body)
        return found[1] if found else ""

    @cached_property
    def item(self) -> int | None:
        """Columns before a list marker."""
        found = _ITEM.match(self.body)
        return _width(found[1]) if found else None

    @cached_property
    def quoted(self) -> str | None:
        """What a quote line holds."""
        found = _QUOTE.match(self.body)
        return self.body[found.end() :] if found else None

    @property
    def starts_block(self) -> bool:
        return bool(self.fence) or (self.item is not None and self.item <= 3) or self.quoted is not None or bool(_HEADING.match(self.body))

    def closes(self, fence: str) -> bool:
        mark = self.body.lstrip(" ")
        if len(self.body) - len(mark) > 3 or not mark.startswith(fence):
            return False
        return not mark.lstrip(fence[0]).strip(" \t")


Block = tuple[str, str]


class Scanner:
    """Blocks of lines that come one after another: what is carried from line to line is the open block and how it may end.

    feed() takes a line (with its line end) and gives the blocks that it ends, finish() gives what is left. Lines of the open block
    are held, blank ones apart while it is not known whether they belong to it.
    """

    def __init__(self) -> None:
        self.kind, self.held, self.blanks, self.first = "", [], [], True
        self.fence, self.base, self.is_table = "", 0, False

    def feed(self, raw: str) -> list[Block]:
        out: list[Block] = []
        self._take(Line(raw), out)
        self.first = False
        return out

    def finish(self) -> list[Block]:
        out: list[Block] = []
        self._end(out)
        if self.blanks:
            out.append(("blank", "".join(x.raw for x in self.blanks)))
            self.blanks = []
        return out

    def _end(self, out: list[Block]) -> None:
        """The open block ends before the blank lines that are held apart."""
        if self.held:
            out.append(("table" if self.is_table else self.kind, "".join(self.held)))
        self.kind, self.held, self.is_table = "", [], False

    def _again(self, line: Line, out: list[Block]) -> None:
        """The open block ends, and the blank lines after it are a block of their own before the line."""
        self._end(out)
        blanks, self.blanks = self.blanks, []
        for x in blanks:
            self._take(x, out)
        self._take(line, out)

    def _hold(self, line: Line) -> None:
        self.held += [x.raw for x in self.blanks]
        self.held.append(line.raw)
        self.blanks = []

    def _take(self, line: Line, out: list[Block]) -> None:
        getattr(self, f"_in_{self.kind}" if self.kind else "_begin")(line, out)

    def _begin(self, line: Line, out: list[Block]) -> None:
        if line.blank:
            self.kind = "blank"
        elif self.first and _OPEN.fullmatch(line.body):
            self.kind = "front_matter"
        elif line.fence:
            self.kind, self.fence = "fenced_code", line.fence
        elif line.indent >= 4:
            self.kind = "indented_code"
        elif line.item is not None and line.item <= 3:
            self.kind, self.base = "list_item", line.item
        elif line.quoted is not None:
            self.kind, self.fence = "blockquote", ""
            self._in_blockquote(line, out)
            return
        else:
            self.kind = "normal"
            self._in_normal(line, out, begins=True)
            return
        self.held.append(line.raw)

    def _in_blank(self, line: Line, out: list[Block]) -> None:
        if line.blank:
            self.held.append(line.raw)
        else:
            self._again(line, out)

    def _in_front_matter(self, line: Line, out: list[Block]) -> None:
        self.held.append(line.raw)
        if line.body.startswith("---") and not line.body[3:].strip(" \t"):
            self._end(out)

    def _in_fenced_code(self, line: Line, out: list[Block]) -> None:
        self.held.append(line.raw)
        if line.closes(self.fence):
            self._end(out)

    def _in_indented_code(self, line: Line, out: list[Block]) -> None:
        if line.blank:
            self.blanks.append(line)
        elif line.indent >= 4:
            self._hold(line)
        else:
            self._again(line, out)

    def _in_list_item(self, line: Line, out: list[Block]) -> None:
        """One item of a run with one indent; deeper content after blank lines stays inside, anything else there ends the run."""
        if line.blank:
            self.blanks.append(line)
        elif self.blanks:
            if (line.indent if line.item is None else line.item) > self.base:
                self._hold(line)
            else:
                self._again(line, out)
        elif line.item == self.base:
            self._end(out)
            self.kind, self.held = "list_item", [line.raw]
        elif line.item is not None and line.item < self.base:
            self._again(line, out)
        else:
            self.held.append(line.raw)

    def _in_blockquote(self, line: Line, out: list[Block]) -> None:
        """A paragraph of a quote ends after a quoted blank line outside quoted fences; plain lines go on in it."""
        quoted = None if line.blank else line.quoted
        if line.blank or (quoted is None and line.starts_block):
            self._again(line, out)
            return
        self.held.append(line.raw)
        if quoted is None:
            return
        if self.fence:
            self.fence = "" if Line(quoted).closes(self.fence) else self.fence
            return
        self.fence = Line(quoted).fence
        if not quoted.strip(" \t"):
            out.append(("blockquote", "".join(self.held)))
            self.held = []

    def _in_normal(self, line: Line, out: list[Block], begins: bool = False) -> None:
        if not begins and (line.blank or line.starts_block):
            self._again(line, out)
            return
        self.held.append(line.raw)
        self.is_table = self.is_table or any(_TABLE.fullmatch(x) for x in line.raw.splitlines())


#: Characters of a text whose lines are split at once.
SLICE = 1 << 20


def lines_of(slices: Iterable[str]) -> Iterator[str]:
    """Lines with their ends of a text that comes in slices; a line, and a line end of two signs, may lie across slices."""
    open_ = ""
    for part in slices:
        if not part:
            continue
        found = (open_ + part).splitlines(keepends=True)
        # the last line may go on: it has no end yet, or ends in a return whose line feed is still to come
        last = found[-1]
        whole = len(last.splitlines()[0]) < len(last) and not last.endswith("\r")
        open_ = "" if whole else found.pop()
        yield from found
    if open_:
        yield open_


def blocks_of(slices: Iterable[str]) -> Iterator[Block]:
    """Kind and exact text of each block of a text that comes in slices; only the open block is held."""
    scanner = Scanner()
    for line in lines_of(slices):
        yield from scanner.feed(line)
    yield from scanner.finish()


def blocks(text: str) -> Iterator[Block]:
    """Kind and exact text of each block."""
    return blocks_of(text[at : at + SLICE] for at in range(0, len(text), SLICE))


def cut_at(text: str, size: int) -> int:
    """The last natural cut in the back half of the first `size` characters: line end, sentence end, blank; 0 for none."""
    window, least = text[:size], max(1, int(size * 0.5))
    ends = [m.end() for m in _BREAK.finditer(window)]
    if ends and ends[-1] >= least:
        return ends[-1]
    free = lambda p: p >= least and not _BEFORE_EOL.match(text, p)
    for places in ([m.end() for m in _SENTENCE.finditer(window)], [i + 1 for i, c in enumerate(window) if c in " \t"]):
        for p in reversed(places[bisect_left(places, least) :]):
            if free(p):
                return p
    return 0


class TooLong(ValueError):
    """A block that may not be cut, or text without a natural cut."""


def pieces(kind: str, text: str, size: int) -> list[str]:
    if len(text) > size and kind in WHOLE:
        raise TooLong(f"{kind} of {len(text)} characters is longer than {size} and may not be cut")
    out = []
    while len(text) > size:
        cut = cut_at(text, size)
        if not cut:
            raise TooLong(f"text of {len(text)} characters has no natural cut within {size}")
        out.append(text[:cut])
        text = text[cut:]
    return [*out, text] if text else out


def chunks(text: str, size: int) -> list[str]:
    """Blocks packed greedily up to `size` characters; a block that had to be cut stands in chunks of its own."""
    if size <= 0:
        raise TooLong("the size of chunks must be positive")
    out, held = [], ""
    for kind, block in blocks(text):
        parts = pieces(kind, block, size)
        if held and (len(parts) > 1 or len(held) + len(block) > size):
            out.append(held)
            held = ""
        if len(parts) > 1:
            out.extend(parts)
        else:
            held += block
    return [*out, held] if held else out


def is_fenced(block: str) -> bool:
    """Whether a block opens with a fence."""
    lines = block.splitlines()
    return bool(lines) and Line(lines[0]).fence != ""


def paragraphs(text: str) -> list[str]:
    """Exact texts of all blocks; joined they are the text."""
    return [t for _, t in blocks(text)]


def md_blocks(df: DataFrame, text: str = "text", keys: tuple[str, ...] = ("rel_path",)) -> DataFrame:
    """One row for each block: the keys, block_no, kind, text. Null text has no blocks. Blocks leave as they are found, some hundreds at once."""
    own = df.select(*keys, F.col(text).alias("text_"))
    schema = T.StructType([*own.schema.fields[:-1], *T.StructType.fromDDL("block_no int, kind string, text string").fields])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = enumerate(blocks(batch.column(len(keys))[i].as_py() or ""))
                while some := list(islice(found, 512)):
                    named = batch.select(list(range(len(keys)))).take(pa.array([i] * len(some)))
                    own = [pa.array([n for n, _ in some], pa.int32()), pa.array([k for _, (k, _) in some], pa.string()), pa.array([t for _, (_, t) in some], pa.string())]
                    yield pa.RecordBatch.from_arrays([*named.columns, *own], names=[*keys, "block_no", "kind", "text"])

    return own.mapInArrow(scan, schema)


def md_chunks(df: DataFrame, size: int, text: str = "text", keys: tuple[str, ...] = ("rel_path",)) -> tuple[DataFrame, DataFrame]:
    """(chunks, errors): chunks have the keys, part_number, total_parts, chunk, chunk_sha256; errors the keys and plan_error.

    A text that cannot be cut safely is an error row, never a failed job. Empty and null texts have no chunks.
    """
    planned = _planned(df, size, text, keys)
    parts = planned.select(*keys, F.size("plan.chunks").alias("total_parts"), F.posexplode("plan.chunks").alias("pos", "chunk"))
    return _numbered(parts, keys), planned.where("plan.error is not null").select(*keys, F.col("plan.error").alias("plan_error"))


def md_chunk_rows(df: DataFrame, size: int, text: str = "text", keys: tuple[str, ...] = ("rel_path",)) -> DataFrame:
    """Both of md_chunks in one table, for those who store it: plan_error is null in rows of chunks, all but the keys is null in the others.

    Each text is cut once, where chunks and errors that are asked for apart cut it twice.
    """
    planned = _planned(df, size, text, keys).select(*keys, F.size("plan.chunks").alias("total_parts"), F.posexplode_outer("plan.chunks").alias("pos", "chunk"), F.col("plan.error").alias("plan_error"))
    return _numbered(planned.where("chunk is not null or plan_error is not null"), keys, "plan_error")


def _numbered(parts: DataFrame, keys: tuple[str, ...], *more: str) -> DataFrame:
    total = F.when(F.col("chunk").isNotNull(), F.col("total_parts")) if more else F.col("total_parts")
    return parts.select(*keys, (F.col("pos") + 1).cast("int").alias("part_number"), total.alias("total_parts"), "chunk", F.sha2(F.col("chunk").cast("binary"), 256).alias("chunk_sha256"), *more)


def _planned(df: DataFrame, size: int, text: str, keys: tuple[str, ...]) -> DataFrame:
    """The keys and plan, a struct of chunks and error."""

    @by_rows(T.StructType.fromDDL("chunks array<string>, error string"))
    def plan(text: str | None) -> tuple[list[str], str | None]:
        try:
            return chunks(text or "", size), None
        except TooLong as e:
            return [], str(e)

    return df.select(*keys, plan(text).alias("plan"))


def register(spark) -> None:
    """md_blocks(text) and md_chunks(text, size) as SQL table functions."""

    @F.udtf(returnType="block_no int, kind string, text string")
    class Blocks:
        def eval(self, text: str):
            for i, (kind, block) in enumerate(blocks(text or "")):
                yield i, kind, block

    @F.udtf(returnType="part_number int, chunk string, error string")
    class Chunks:
        def eval(self, text: str, size: int):
            try:
                for i, chunk in enumerate(chunks(text or "", size)):
                    yield i + 1, chunk, None
            except TooLong as e:
                yield None, None, str(e)

    spark.udtf.register("md_blocks", Blocks)
    spark.udtf.register("md_chunks", Chunks)
