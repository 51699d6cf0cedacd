"""Rules for replies: errors stop a piece, warnings send it to review."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed as fx
from ..functions import text as tx

try:
    import yaml
except ImportError:  # every front matter is then reported as unreadable
    yaml = None


#: What may stand before a front matter.
MARKS = "\ufeff \t\r\n"


def is_html(reply: Column) -> Column:
    return F.contains(reply, F.lit("<")) & _is_html(reply)


def _is_html(reply: Column) -> Column:
    return reply.rlike("(?d)" + fx.HTML_DOCUMENT) | F.substring(reply, 1, 5000).rlike("(?d)" + fx.HTML_ERROR)


def is_api_json(reply: Column) -> Column:
    head = F.lower(F.substring(reply, 1, 2000))
    return reply.rlike(fx.JSON_OBJECT) & F.exists(F.array(*map(F.lit, fx.JSON_KEYS)), lambda k: F.contains(head, k))


def first_phrase(area: Column, phrases: list[str]) -> Column:
    """The first phrase of the list that the area holds, or null. The area is made once, and not for each phrase."""
    return F.get(F.transform(F.array(area), lambda a: F.coalesce(*(F.when(F.contains(a, F.lit(p.lower())), F.lit(p)) for p in phrases))), F.lit(0))


def service_error(reply: Column) -> Column:
    low = F.lower(reply)
    return first_phrase(F.when(F.length(low) > 5000, F.substring(low, 1, 1000)).otherwise(low), fx.SERVICE_ERRORS)


def opens_front_matter(reply: Column) -> Column:
    body = F.ltrim(reply, F.lit(MARKS))
    return F.startswith(body, F.lit("---")) & body.rlike(r"\A---(?:[ \t]*\r?\n|[ \t]*\z)")


def explanation(reply: Column) -> Column:
    body = F.ltrim(reply, F.lit(tx.SPACES))
    head = lambda n: F.substring(F.lower(F.substring(body, 1, 500)), 1, n)
    found = F.coalesce(first_phrase(head(150), fx.EXPLANATIONS), first_phrase(head(300), fx.SUSPICIOUS))
    heading = F.startswith(body, F.lit("#")) & body.rlike(rf"\A#{{1,6}}[ \t]+[^\s\x1c-\x1f\x85\xa0]")
    return F.when(~opens_front_matter(body) & ~heading, found)


def front_matter(reply: Column) -> Column:
    """The text between the rules at the top, or null."""
    body = F.ltrim(reply, F.lit(MARKS))
    pattern = "(?s)" + fx.REPLY_FRONT_MATTER.replace(r"\Z", r"\z")
    return F.when(F.startswith(body, F.lit("---")) & body.rlike(pattern), F.regexp_extract(body, pattern, 1))


def rule_pairs(reply: Column) -> Column:
    return F.floor(tx.count(reply, fx.RULE_LINE) / 2).cast("long")


def _text_of(value) -> str:
    if value is None:
        return ""
    return ("true" if value else "false") if isinstance(value, bool) else str(value).strip()


def field_findings(fields: dict) -> list[tuple[bool, str]]:
    """(is a problem, message) of front-matter fields in their order; problems are errors in strict mode, remarks never are."""
    out, say = [], fx.SAYS
    bad, note = lambda m: out.append((True, m)), lambda m: out.append((False, m))
    for name in fx.REQUIRED_FIELDS:
        if name not in fields:
            bad(say["field_missing"].format(name))
        elif fields[name] is not None and not isinstance(fields[name], str | int | float):
            bad(say["field_kind"].format(name))
    title = fields.get("title")
    if title is not None:
        if not isinstance(title, str):
            bad(say["title_kind"])
        elif not title.strip():
            bad(say["title_blank"])
        elif len(title.strip()) > 500:
            note(say["title_long"])
    for name, allowed in (("subject", fx.SUBJECTS), ("status", [fx.FIELD_STATUS])):
        value = _text_of(fields.get(name))
        if value and value.lower() != "null" and value not in allowed:
            bad(say[name].format(value))
    year = fields.get("year")
    if isinstance(year, bool):
        bad(say["year_flag"])
    elif isinstance(year, int):
        if not 1000 <= year <= 9999:
            note(say["year_number"].format(year))
    elif isinstance(year, str):
        if year.strip() and year.strip().lower() != "null" and not re.fullmatch(fx.YEAR, year.strip()):
            note(say["year_text"].format(year.strip()))
    elif year is not None:
        bad(say["year_kind"])
    for name in ("source", "type"):
        if fields.get(name) is not None and not isinstance(fields[name], str):
            bad(say["text_kind"].format(name))
    return out


def read_fields(matter: str) -> tuple[dict, str | None]:
    if yaml is None:
        return {}, fx.SAYS["yaml_absent"]
    try:
        data = yaml.safe_load(matter)
    except Exception as e:  # any fault of the text is a finding about the text
        said = str(e).replace("\r", " ").replace("\n", " ")
        return {}, fx.SAYS["yaml_fails"] + (said if len(said) <= 300 else said[:300] + "……")
    if data is None:
        return {}, fx.SAYS["yaml_empty"]
    return (data, None) if isinstance(data, dict) else ({}, fx.SAYS["yaml_kind"])


_LISTS = T.StructType()
for _name in ("problems", "remarks", "both"):
    _LISTS = _LISTS.add(_name, T.ArrayType(T.StringType()))


@F.pandas_udf(_LISTS)
def matter_findings(matter: pd.Series) -> pd.DataFrame:
    """Problems, remarks, and both in the order of the fields (what a lenient run lists)."""
    rows = []
    for m in matter:
        found = []
        if m is not None:
            fields, error = read_fields(m)
            found = [(True, error)] if error else field_findings(fields)
        rows.append(([t for bad, t in found if bad], [t for bad, t in found if not bad], [t for _, t in found]))
    return pd.DataFrame(rows, columns=_LISTS.names)


def validate(df: DataFrame, reply: str = "reply", given: str = "chunk", part: str = "part_number", strict: Column | bool = True) -> DataFrame:
    """Add errors and warnings (distinct, in order). A blank reply has the one error and no warnings."""
    own = df.columns
    strict = F.lit(strict) if isinstance(strict, bool) else strict
    x = df.withColumn("r_", tx.py_strip(F.coalesce(reply, F.lit(""))))
    r, first = F.col("r_"), F.col(part) == 1
    x = x.withColumns({"phrase_": service_error(r), "prefix_": explanation(r), "m_": front_matter(r), "opens_": opens_front_matter(r), "first_": first, "must_": first & strict})
    x = x.withColumn("f_", matter_findings("m_"))
    one = lambda condition, message: F.when(condition, F.array(message if isinstance(message, Column) else F.lit(message))).otherwise(F.array().cast("array<string>"))
    must, absent, opens, isfirst, c = F.col("must_"), F.col("m_").isNull(), F.col("opens_"), F.col("first_"), F.col
    none = F.array().cast("array<string>")
    short = F.length(r) < 1000
    phrase = c("phrase_")
    errors = F.concat(
        one(is_html(r), fx.SAYS["html"]), one(is_api_json(r), fx.SAYS["json"]), one(phrase.isNotNull() & short, F.concat(F.lit(fx.SAYS["service_short"]), phrase)),
        one(absent & opens & must, fx.SAYS["unclosed"]), one(absent & ~opens & must, fx.SAYS["missing"]), F.when(must, c("f_.problems")).otherwise(none),
    )
    warnings = F.concat(
        one(phrase.isNotNull() & ~short, F.concat(F.lit(fx.SAYS["service_long"]), phrase)), one(c("prefix_").isNotNull(), F.concat(F.lit(fx.SAYS["explained"]), c("prefix_"))),
        one(absent & opens & ~must, fx.SAYS["unclosed"]), one(absent & ~opens & isfirst & ~must, fx.SAYS["missing"]), F.when(~must, c("f_.both")).otherwise(c("f_.remarks")),
        one(~absent & ~isfirst, fx.SAYS["later"]), one(rule_pairs(r) > 1, fx.SAYS["several"]),
        one((F.length(given) >= 200) & (F.length(r) < F.length(given) * F.lit(0.5)), fx.SAYS["short"]), one(r.startswith("```"), fx.SAYS["fence"]),
    )
    blank = r == ""
    return x.select(*own, F.when(blank, F.array(F.lit(fx.SAYS["blank"]))).otherwise(F.array_distinct(errors)).alias("errors"), F.when(blank, none).otherwise(F.array_distinct(warnings)).alias("warnings"))


def drop_repeated_matter(text: Column | str, part: Column | str) -> Column:
    """Later parts without a front matter that is readable and would pass the strict rules; leading white space stays.

    Only texts that open with a rule go through Python.
    """
    text, part = tx.col(text), tx.col(part)
    opens = (part > 1) & text.rlike("\\A[\\x{FEFF} \\t\\r\\n]*---")
    return F.when(opens, _without_matter(F.when(opens, text), part)).otherwise(text)


@F.pandas_udf(T.StringType())
def _without_matter(text: pd.Series, part: pd.Series) -> pd.Series:
    pattern, out = re.compile(r"([﻿ \t\r\n]*)---[ \t]*\r?\n(.*?)\r?\n---[ \t]*(?:\r?\n|\Z)", re.DOTALL), []
    for t, n in zip(text, part, strict=True):
        found = pattern.match(t or "") if n > 1 else None
        if found:
            fields, error = read_fields(found[2])
            if error is None and not any(bad for bad, _ in field_findings(fields)):
                t = found[1] + t[found.end() :]
        out.append(t)
    return pd.Series(out, dtype=object)
