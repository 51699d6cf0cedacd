"""Remote cleaning as a map over pieces: message, budget, and pluggable transports."""

from __future__ import annotations

import datetime
import json
import math
import random
import re
import time
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from email.utils import parsedate_to_datetime
from typing import ClassVar

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed as fx
from ..functions import text as tx
from ..functions.rows import ROWS

OVERHEAD_TOKENS, SAFETY_TOKENS = 64, 1024
RETRYABLE = {408, 409, 425, 429}
ATTEMPTS, WAIT, MOST_WAIT = 3, 5.0, 300.0
REPLY_CHARS, EVENT_CHARS = 200_000, 2_000_000


@dataclass(frozen=True)
class Budget:
    """What a request may hold, in tokens; 0 for no limit."""

    window: int = 0
    output: int = 0
    margin: int = SAFETY_TOKENS
    limit_name: str = "max_tokens"

    def __post_init__(self) -> None:
        if min(self.window, self.output, self.margin) < 0 or self.limit_name not in ("max_tokens", "max_completion_tokens"):
            raise ValueError("a budget has no negative sizes, and its limit is max_tokens or max_completion_tokens")


def budget(chunks: DataFrame, prompt_tokens: int, window: int = 0, reserved: int = 0, margin: int = SAFETY_TOKENS, text: str = "chunk") -> DataFrame:
    """Add input_tokens, remaining_tokens (null without a window) and fits, so that pieces too large never reach the network."""
    need = tx.token_estimate(text) + F.lit(prompt_tokens + OVERHEAD_TOKENS)
    left = F.lit(window) - need - F.lit(reserved + margin) if window else F.lit(None).cast("long")
    return chunks.withColumns({"input_tokens": need, "remaining_tokens": left.cast("long")}).withColumn("fits", F.coalesce(F.col("remaining_tokens") >= 0, F.lit(True)))


def with_message(chunks: DataFrame) -> DataFrame:
    tag = F.substring(F.sha2(F.concat("chunk_sha256", F.col("part_number").cast("string")), 256), 1, 32)
    return chunks.withColumn("message_", message(F.col("chunk"), F.col("part_number"), F.col("total_parts"), tag))


def budgeted(chunks: DataFrame, limits: Budget, prompt_tokens: int = 0) -> DataFrame:
    """Pieces with their message_ and, where the request exceeds the window, over_budget_ (a text)."""
    x = budget(with_message(chunks), prompt_tokens, limits.window, limits.output, limits.margin, "message_")
    said = F.format_string("the request needs about %d tokens, %d more than the window of %d leaves", "input_tokens", -F.col("remaining_tokens"), F.lit(limits.window))
    return x.select(*chunks.columns, "message_", F.when(~F.col("fits"), said).alias("over_budget_"))


def message(chunk: Column, part: Column, total: Column, tag: Column) -> Column:
    """The user's message: the piece between tagged marks, with what holds for a first or later part."""
    rule = F.when(part == 1, "This is the first part; begin with the front matter.").otherwise("This is a later part; write no front matter.")
    return F.concat_ws("\n", F.format_string("Part %d of %d of document.md.", part, total), rule, F.concat(F.lit("<<"), tag, F.lit(">>")), chunk, F.concat(F.lit("<</"), tag, F.lit(">>")))


class Retryable(RuntimeError):
    """A fault that another attempt may not have; `wait` is what the server asked for."""

    def __init__(self, text: str, wait: float | None = None, partial: str = ""):
        super().__init__(text)
        self.wait, self.partial = wait, partial


def event_text(event: dict) -> str:
    """New text of one event: the delta, else the message, else the text; lists of parts are joined."""
    choice = (event.get("choices") or [{}])[0]
    for holder in (choice.get("delta"), choice.get("message"), choice):
        value = (holder or {}).get("content", (holder or {}).get("text"))
        if isinstance(value, list):
            value = "".join(p if isinstance(p, str) else _part_text(p) for p in value)
        if value:
            return value
    return ""


def _part_text(part: dict) -> str:
    text = part.get("text", "")
    return text.get("value", "") if isinstance(text, dict) else text or ""


def read_events(lines: Iterator[str]) -> str:
    """The whole reply of an event stream; raises Retryable or RuntimeError for faults and replies that did not end well."""
    held, size, ended = [], 0, False
    for line in lines:
        if not line.startswith("data:"):
            continue
        data = line[5:].strip()
        if data == "[DONE]":
            ended = True
            break
        if len(data) > EVENT_CHARS:
            raise RuntimeError("an event is too long")
        event = json.loads(data)
        if not isinstance(event, dict):
            raise RuntimeError("an event is no object")
        if event.get("error"):
            said = json.dumps(event["error"], ensure_ascii=False)
            kind = Retryable if re.search("rate|limit|timeout|overload|unavailable|temporar", said, re.I) else RuntimeError
            raise kind(said)
        held.append(event_text(event))
        size += len(held[-1])
        if size > REPLY_CHARS:
            raise RuntimeError("the reply is too long")
        reason = (event.get("choices") or [{}])[0].get("finish_reason")
        if reason in ("length", "content_filter", "error"):
            raise RuntimeError(f"the reply ended by {reason}")
        ended |= reason == "stop"
    text = "".join(held)
    if not ended:
        raise Retryable("the stream ended early", partial=text)
    if not text.strip():
        raise RuntimeError("the reply is blank")
    return text


def with_retries(call: Callable[[], str], sleep: Callable[[float], None] = time.sleep, attempts: int = ATTEMPTS) -> tuple[str | None, str | None, str, int]:
    """(reply, error, partial text, attempts)."""
    partial = ""
    for n in range(1, attempts + 1):
        try:
            return call(), None, partial, n
        except Retryable as e:
            partial = e.partial or partial
            if n == attempts:
                return None, str(e), partial, n
            wait = WAIT * 2 ** (n - 1)
            sleep(min(MOST_WAIT, e.wait if e.wait is not None else wait + random.uniform(0, min(1.0, wait / 10))))
        except Exception as e:  # a fatal fault is a result of this piece, not of the job
            return None, str(e), partial, n
    return None, "no attempt was made", partial, 0


def retry_after(value: str, now: datetime.datetime | None = None) -> float | None:
    """Seconds that a Retry-After header asks for: a number, or a date (without a zone: UTC); None for anything else."""
    value = value.strip()
    try:
        seconds = float(value)
        return max(0.0, seconds) if math.isfinite(seconds) else None
    except ValueError:
        pass
    try:
        at = parsedate_to_datetime(value)
    except (TypeError, ValueError, OverflowError):
        return None
    at = at if at.tzinfo else at.replace(tzinfo=datetime.UTC)
    return max(0.0, (at - (now or datetime.datetime.now(datetime.UTC))).total_seconds())


@dataclass(frozen=True)
class Transport:
    """What turns a message into a reply. Subclasses must be picklable.

    limited: calls at once are to be bounded. wave: pieces that are sent before their replies are committed.
    """

    limited: ClassVar[bool] = False
    wave: ClassVar[int] = 1_000_000

    def reply(self, chunk: str, message: str) -> str:
        raise NotImplementedError


@dataclass(frozen=True)
class Identity(Transport):
    """Gives each piece back."""

    def reply(self, chunk: str, message: str) -> str:
        return chunk


@dataclass(frozen=True)
class Scripted(Transport):
    """Replies by a function, for tests and rule-based cleaning."""

    function: Callable[[str], str] = field(default=lambda chunk: chunk)

    def reply(self, chunk: str, message: str) -> str:
        return self.function(chunk)


@dataclass(frozen=True)
class Http(Transport):
    """A streaming chat-completions endpoint; needs only the standard library. https, or http on this host."""

    limited: ClassVar[bool] = True
    wave: ClassVar[int] = 1_000
    url: str = ""
    model: str = ""
    key: str = ""
    system: str = ""
    limit_name: str = "max_tokens"
    limit: int = 0
    timeout: float = 1200.0

    def payload(self, message: str) -> dict:
        body = {"model": self.model, "temperature": 0, "stream": True, "messages": [{"role": "system", "content": self.system}, {"role": "user", "content": message}]}
        return body | ({self.limit_name: self.limit} if self.limit > 0 else {})

    def reply(self, chunk: str, message: str) -> str:
        import urllib.error
        import urllib.request

        request = urllib.request.Request(self.url.rstrip("/") + "/chat/completions", json.dumps(self.payload(message)).encode(), {"Content-Type": "application/json", "Authorization": f"Bearer {self.key}"})
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as response:
                return read_events(line.decode("utf-8") for line in response)
        except urllib.error.HTTPError as e:
            if e.code in RETRYABLE or e.code >= 500:
                raise Retryable(f"status {e.code}", retry_after(e.headers.get("Retry-After", ""))) from e
            raise RuntimeError(f"status {e.code}") from e
        except (urllib.error.URLError, TimeoutError, ConnectionError) as e:
            raise Retryable(f"network: {e}") from e


#: What a sender adds to a piece.
SENT = "reply string, error string, partial string, attempts int, stage string"


def is_blank(chunk: Column) -> Column:
    """A piece without a sign: it needs no call, and stands for itself."""
    return tx.is_blank(chunk)


def sender(transport: Transport, attempts: int = ATTEMPTS, per_file: bool = True, failures: int = 0) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Pieces with message_ and over_budget_, in the order in which they are to be sent, to pieces with SENT, one call after another.

    Failures in a row count inside a file (per_file, by rel_path where there is one), or go on from file to file,
    from `failures` at the start. Blank pieces are their own replies, without a call.
    """

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        row, file = failures, None
        for batch in batches:
            out = []
            files = batch["rel_path"] if "rel_path" in batch else [None] * len(batch)
            for rel, chunk, text, over in zip(files, batch["chunk"], batch["message_"], batch["over_budget_"], strict=True):
                if per_file and rel != file:
                    row, file = 0, rel
                if not chunk.strip():
                    out.append((chunk, None, None, 0, None))
                elif over is not None:
                    out.append((None, over, None, 0, "budget"))
                elif row >= fx.MAX_FAILURES_IN_A_ROW:
                    out.append((None, f"not sent after {row} failures in a row", None, 0, "stopped"))
                else:
                    reply, error, partial, n = with_retries(lambda c=chunk, t=text: transport.reply(c, t), attempts=attempts)
                    row = row + 1 if error is not None else 0
                    out.append((reply, error, partial or None, n, None if error is None else "request"))
            done = pd.DataFrame(out, columns=["reply", "error", "partial", "attempts", "stage"], dtype=object)
            yield pd.concat([batch.drop(columns=["message_", "over_budget_"]).reset_index(drop=True), done], axis=1)

    return call


def sequential(transport: Transport, workers: int) -> bool:
    """One sender for all files: then failures in a row go on from file to file."""
    return transport.limited and workers == 1


def clean(chunks: DataFrame, transport: Transport, workers: int = 1, attempts: int = ATTEMPTS, failures: int = 0, limits: Budget | None = None, prompt_tokens: int = 0) -> DataFrame:
    """Add reply, error, partial, attempts and stage (null, budget, request or stopped) to pieces.

    A transport with a limit has at most `workers` senders, one for each partition. A file's pieces are sent by one sender in
    their order; after MAX_FAILURES_IN_A_ROW failures in a row it sends no more of that file (a sender that is alone: no
    more at all, counting from `failures`): those pieces have the stage stopped and no attempt. Pieces that budgeted()
    found too large are not sent. A repeated task repeats its calls, so store the result before anything reads it twice.
    Pieces without a message get it, and are held against the limits, where they are sent: no message is dealt out beside its piece.
    """
    ready = chunks
    order = [c for c in ("ord", "rel_path", "part_number") if c in ready.columns]
    if "rel_path" in order:
        ready = (ready.repartition(workers, "rel_path") if transport.limited else ready.repartition("rel_path")).sortWithinPartitions(*order)
    elif transport.limited:
        ready = ready.repartition(workers)
    if "message_" not in ready.columns:
        ready = budgeted(ready, limits or Budget(), prompt_tokens)
    own = [f for f in ready.schema if f.name not in ("message_", "over_budget_")]
    named = [f.name for f in own]
    call = sender(transport, attempts, not sequential(transport, workers), failures)
    added = [("reply", pa.string()), ("error", pa.string()), ("partial", pa.string()), ("attempts", pa.int32()), ("stage", pa.string())]
    read = [c for c in ("rel_path", "chunk", "message_", "over_budget_") if c in ready.columns]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices: deque[pa.RecordBatch] = deque()

        def frames() -> Iterator[pd.DataFrame]:
            for batch in batches:
                for at in range(0, batch.num_rows, ROWS):
                    slices.append(batch.slice(at, ROWS))
                    yield slices[-1].select(read).to_pandas()

        for done in call(frames()):
            rows = slices.popleft()
            yield pa.RecordBatch.from_arrays([*rows.select(named).columns, *(pa.array(done[c].tolist(), kind) for c, kind in added)], names=[*named, *(c for c, _ in added)])

    return ready.mapInArrow(send, T.StructType([*own, *T.StructType.fromDDL(SENT).fields]))


def waves(work: DataFrame, size: int) -> list[tuple[int | None, int | None]]:
    """Waves of about `size` pieces (with ord) in the order of their files: over which ord and up to which (None for no bound).

    A file is whole in one wave. Only the boundaries, one for each wave, come to the driver; pieces that are stored in
    the order of ord are read for their wave only.
    """
    n = work.count()
    number = max(1, -(-n // size))
    cuts = sorted({int(c) for c in work.approxQuantile("ord", [i / number for i in range(1, number)], 0.1 / number)}) if number > 1 else []
    return list(zip([None, *cuts], [*cuts, None], strict=True))


def in_wave(over: int | None, upto: int | None = None) -> Column:
    return (F.lit(True) if over is None else F.col("ord") > over) & (F.lit(True) if upto is None else F.col("ord") <= upto)


def trailing_failures(sent: DataFrame) -> int:
    """Failures in a row at the end of what a single sender has sent, as far as they matter."""
    last = sent.where("attempts > 0 or stage = 'stopped'").orderBy(F.desc("ord"), F.desc("rel_path"), F.desc("part_number")).select("error").limit(fx.MAX_FAILURES_IN_A_ROW).collect()
    run = 0
    for r in last:
        if r.error is None:
            break
        run += 1
    return run
