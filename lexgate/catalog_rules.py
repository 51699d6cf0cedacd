"""More registered queries: rules, reports, batches and transports over texts that both dialects derive from a table.

Where a rule needs a text of a certain form, the text is one of a list of literals, chosen by doc_id, and the SQL side has
the list of what the rule must say.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .catalog import _AD, _FILES, _HEAD, _NORM, _QUES, _TAB, _TOKENS_SQL, _URLS, DOCS, _files, _table, md_pairs, query
from .functions import compare
from .functions import fixed as fx
from .functions import text as tx
from .functions.markdown import md_blocks, md_chunks
from .functions.rows import by_rows
from .operators import assembly, batches, cache, quality, transport, validation
from .sources import files, sinks



def doc_id() -> Column:
    return F.col("doc_id")


def text() -> Column:
    return F.coalesce("text", F.lit(""))


def pick(values: list) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (doc_id() % len(values) + 1).cast("int"))


def quoted(value) -> str:
    if value is None:
        return "NULL"
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value).upper() if isinstance(value, bool) else str(value)


def pick_sql(values: list, i: str = "doc_id") -> str:
    return f"[{', '.join(map(quoted, values))}][CAST({i} % {len(values)} AS INTEGER) + 1]"


def _docs(spark, sf_dir):
    return _table(spark, sf_dir, "documents")


# ---- sources


@by_rows(T.BinaryType())
def _encoded(text: str, k: int) -> bytes:
    return b"\xff\xff" if k == 3 else text.encode(("utf-8-sig", "utf-8", "gb18030")[k])


@query("SELECT doc_id, CASE WHEN doc_id % 4 < 3 THEN sha256(coalesce(text, '') || '安全') END AS text_sha256, CASE WHEN doc_id % 4 = 1 THEN sha256(coalesce(text, '') || '安全') END AS bytes_sha256 FROM documents")
def decode_ladder(spark, sf_dir):
    """Bytes with a mark, without one, in another codec, and in none."""
    raw = _docs(spark, sf_dir).select("doc_id", _encoded(F.concat(text(), F.lit("安全")), (doc_id() % 4).cast("int")).alias("raw"))
    return raw.select("doc_id", tx.sha256(files.decoded("raw")).alias("text_sha256"), F.when(doc_id() % 4 == 1, F.sha2("raw", 256)).alias("bytes_sha256"))


@F.pandas_udf(T.StructType().add("sha", T.StringType()).add("aliases", T.IntegerType()))
def _prompts(raw: pd.Series) -> pd.DataFrame:
    found = [files.prompt_identity(t) for t in raw]
    return pd.DataFrame({"sha": [f[1] for f in found], "aliases": [len(f[2]) for f in found]})


_BARE = "trim(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(13))"


@query(f"SELECT doc_id, sha256({_BARE}) AS sha, CAST(contains({_BARE}, chr(10)) AS INTEGER) AS aliases FROM documents")
def prompt_identities(spark, sf_dir):
    """A fenced prompt with other line ends has the hash of the bare text, and an alias where it has lines."""
    bare = F.trim(text(), F.lit(" \t\n\r"))
    raw = F.concat(F.lit("```md\r\n"), F.replace(bare, F.lit("\n"), F.lit("\r\n")), F.lit("\r\n```\n"))
    return _docs(spark, sf_dir).select("doc_id", _prompts(raw).alias("p")).select("doc_id", "p.*")


_PATHS = [("a/b.md", True), ("/a.md", False), ("../a.md", False), ("a//b.md", False), ("C:/x.md", False), ("a\\b.md", False), ("x_cleaned.md", False), ("a.txt", False), ("A/B.MD", True), ("a/./b.md", False)]
_BATCH_IDS = [("20240101T000000000000Z-0123456789ab", True), ("20240101T000000Z-0123456789ab", False), ("20240101T000000000000Z-0123456789AB", False), ("20240101T000000000000Z-0123456789ab\n", False)]


@query(f"SELECT doc_id, {pick_sql([v for _, v in _PATHS])} AS path_is_safe, {pick_sql([v for _, v in _BATCH_IDS])} AS is_id FROM documents")
def names_of_batches(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", batches.valid_path(pick([p for p, _ in _PATHS])).alias("path_is_safe"), batches.is_batch_id(pick([p for p, _ in _BATCH_IDS])).alias("is_id"))


_NAMES = ['a/b: "c"  d', " ._ ", "x<y>|z?", "..a..", "tab\there", "plain"]


def _with_text(values: list) -> Column:
    """One of the literals before each whole text."""
    return F.concat(pick(values), F.lit(" "), text())


def _with_text_sql(values: list) -> str:
    return f"({pick_sql(values)} || ' ' || coalesce(text, ''))"


@query(rf"""SELECT doc_id, CASE WHEN name = '' THEN 'unnamed' ELSE name END AS name FROM (
  SELECT doc_id, trim(regexp_replace(regexp_replace({_with_text_sql(_NAMES)}, '[\\/:*?"<>|]+', '_', 'g'), '\s+', '_', 'g'), ' ._') AS name FROM documents)""")
def safe_names(spark, sf_dir):
    """Names of whole texts after signs that no name may hold."""
    return _docs(spark, sf_dir).select("doc_id", tx.safe_name(_with_text(_NAMES)).alias("name"))


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'in/' || CAST(doc_id AS VARCHAR) || '.md' ELSE CAST(doc_id AS VARCHAR) || '.md' END AS name, 'at <项目目录>/x and <路径>; Bearer ***' AS error, doc_id % 3 = 1 AS fits FROM documents")
def names_and_errors_for_people(spark, sf_dir):
    path = F.concat(F.when(doc_id() % 2 == 0, "/base/in/").otherwise("/else/"), doc_id().cast("string"), F.lit(".md"))
    said = F.lit("at /base/x and C:\\secret\\y; Bearer abcdefgh12")
    record = tx.with_schema({"status": F.lit("done")}, "report", 1)
    fits = F.when(doc_id() % 3 == 0, tx.is_schema(record, "report", 2)).when(doc_id() % 3 == 1, tx.is_schema(record, "report")).otherwise(tx.is_schema(record, "other"))
    return _docs(spark, sf_dir).select("doc_id", tx.relative_name(path, "/base").alias("name"), tx.shown_error(said, "/base").alias("error"), fits.alias("fits"))


_SECRETS = ["x Bearer abcdefgh1 y", "api_key=abcdefghij, z", "Authorization: abcdefgh9", "sk-aaaaaaaaa", "key-bbbbbbbbb!", "short sk-aa"]


def _redacted_sql(x: str) -> str:
    for pattern, instead in fx.SECRETS:
        x = f"regexp_replace({x}, {quoted(pattern)}, {quoted(instead.replace('$', chr(92)))}, 'g')"
    return x


@query(f"SELECT doc_id, sha256({_redacted_sql(_with_text_sql(_SECRETS))}) AS redacted, {_redacted_sql(pick_sql(_SECRETS))} = {pick_sql(['x Bearer *** y', 'api_key=***, z', 'Authorization: ***', '***', '***!', 'short sk-aa'])} AS as_told FROM documents")
def secrets_of_all_kinds(spark, sf_dir):
    """Secrets of each kind, and those of the texts after them."""
    told = pick(["x Bearer *** y", "api_key=***, z", "Authorization: ***", "***", "***!", "short sk-aa"])
    return _docs(spark, sf_dir).select("doc_id", tx.sha256(tx.redact(_with_text(_SECRETS))).alias("redacted"), (tx.redact(pick(_SECRETS)) == told).alias("as_told"))


@query("SELECT doc_id, n, CASE WHEN n < 1024 THEN CAST(n AS VARCHAR) || ' B' WHEN n < 1048576 THEN printf('%.1f KB', n / 1024.0) ELSE printf('%.1f MB', n / 1048576.0) END AS shown FROM (SELECT doc_id, doc_id * doc_id * 7 AS n FROM documents)")
def sizes_shown(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", (doc_id() * doc_id() * 7).alias("n")).withColumn("shown", tx.received_size("n"))


# ---- pieces

_MARKDOWN = [
    ("# a\n\ntext\n", "normal,blank,normal"),
    ("```py\nx\n\ny\n```\nend\n", "fenced_code,normal"),
    ("> q1\n> q2\n\nt\n", "blockquote,blank,normal"),
    ("| a | b |\n| --- | --- |\n| 1 | 2 |\n\nt", "table,blank,normal"),
    ("t\n\n    code\n    more\n", "normal,blank,indented_code"),
    ("~~~\n# no heading\n~~~\n", "fenced_code"),
    ("---\ntitle: x\n---\ntext\n", "front_matter,normal"),
    ("one\ntwo\n", "normal"),
    ("", ""),
]


@query(f"SELECT doc_id, nullif({pick_sql([k for _, k in _MARKDOWN])}, '') AS kinds, {pick_sql([t for t, _ in _MARKDOWN])} AS joined FROM documents")
def block_kinds(spark, sf_dir):
    """Kinds of the blocks of small texts, and the blocks joined again."""
    texts = _docs(spark, sf_dir).select("doc_id", pick([t for t, _ in _MARKDOWN]).alias("md"))
    blocks = md_blocks(texts, "md", ("doc_id",)).groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("block_no", "kind", "text"))).alias("b"))
    found = texts.join(blocks, "doc_id", "left")
    return found.select("doc_id", F.array_join(F.transform("b", lambda x: x["kind"]), ",").alias("kinds"), F.coalesce(F.array_join(F.transform("b", lambda x: x["text"]), ""), F.lit("")).alias("joined"))


@query("SELECT doc_id, CAST((n + 8) // 9 AS INTEGER) AS parts, CAST(101 * n AS BIGINT) AS chars, CAST(101 * least(n, 9) AS INTEGER) AS most FROM (SELECT doc_id, doc_id % 50 + 1 AS n FROM documents)")
def greedy_packing(spark, sf_dir):
    """Paragraphs of 101 characters with their blank line, nine to a piece of 1000."""
    texts = _docs(spark, sf_dir).select("doc_id", F.repeat(F.lit("p" * 99 + "\n\n"), (doc_id() % 50 + 1).cast("int")).alias("md"))
    parts, _ = md_chunks(texts, 1000, "md", ("doc_id",))
    numbered = parts.groupBy("doc_id").agg(F.max("total_parts").alias("parts"), F.sum(F.length("chunk")).alias("chars"), F.max(F.length("chunk")).alias("most"), F.sum("part_number").alias("s"))
    return numbered.where(F.col("s") == F.col("parts") * (F.col("parts") + 1) / 2).select("doc_id", "parts", "chars", "most")


# ---- values, links, anchors


@query("SELECT doc_id, 'a|1' || lpad(CAST(doc_id % 1000 AS VARCHAR), 3, '0') || '|mg/m3|gb ' || CAST(1000 + doc_id AS VARCHAR) || '|' || CAST(1000 + doc_id AS VARCHAR) || '|2018|http://x.org/' || CAST(doc_id AS VARCHAR) || '|' || CAST(doc_id AS VARCHAR) AS found FROM documents")
def unit_values_and_standard_ids(spark, sf_dir):
    """Thousands, a unit with a raised digit, a standard's number, a year after a dash, and a link, in text order."""
    n = (doc_id() + 1000).cast("string")
    said = F.concat(F.lit("A. 1,"), F.lpad((doc_id() % 1000).cast("string"), 3, "0"), F.lit(" mg/m³ GB "), n, F.lit("—2018 见 HTTP://X.org/"), doc_id().cast("string"), F.lit("。\n扫码关注 5 领取 6"))
    return _docs(spark, sf_dir).select("doc_id", F.array_join(compare.protected_values_of(said), "|").alias("found"))


_ANCHORS = """SELECT doc_id, CASE WHEN last < 0 THEN CAST(src = other AS INTEGER)::DOUBLE ELSE len(list_filter(anchors, lambda a: contains(other, a)))::DOUBLE / len(anchors) END AS ratio FROM (
  SELECT *, list_distinct(list_transform(range(n), lambda i: substring(src, CAST(round(CASE WHEN n > 1 THEN i * last / CAST(n - 1 AS DOUBLE) ELSE 0 END) AS BIGINT) + 1, 24))) AS anchors FROM (
    SELECT *, length(src) - 24 AS last, greatest(least(200, length(src) - 23), 0) AS n FROM (
      SELECT doc_id, lower(regexp_replace(text, '\\s+', '', 'g')) AS src, lower(regexp_replace(CASE doc_id % 3 WHEN 0 THEN text WHEN 1 THEN substring(text, 1, length(text) // 2) ELSE 'other' END, '\\s+', '', 'g')) AS other FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents))))"""


@query(_ANCHORS)
def anchor_ratio(spark, sf_dir):
    docs = _docs(spark, sf_dir).withColumn("text", text())
    reply = F.when(doc_id() % 3 == 0, F.col("text")).when(doc_id() % 3 == 1, F.substring(F.col("text"), F.lit(1), F.floor(F.length("text") / 2).cast("int"))).otherwise("other")
    return docs.select("doc_id", compare.compared("text", reply, reply)["anchors"].alias("ratio"))


@query("SELECT doc_id, CAST(least(20, doc_id % 31) AS INTEGER) AS n, CASE WHEN doc_id % 31 > 0 THEN 'http://e.org/0,' END AS first FROM documents")
def links_missing_capped(spark, sf_dir):
    """Up to thirty links, each twice, of which the other text has none; twenty are listed, the first first."""
    links = F.concat_ws(" ", F.transform(F.sequence(F.lit(0), (doc_id() % 31).cast("int")), lambda i: F.when(i > 0, F.concat(F.lit("http://e.org/"), (i - 1).cast("string"), F.lit(", and again http://e.org/"), (i - 1).cast("string"), F.lit(",")))))
    return _docs(spark, sf_dir).select("doc_id", tx.urls_missing_in(links, F.lit("http://e.org/30."), 20).alias("u")).select("doc_id", F.size("u").alias("n"), F.get("u", F.lit(0)).alias("first"))


# ---- replies

_MATTER = f"---\ntitle: A\nsubject: {fx.SUBJECTS[1]}\nsource: null\ntype: book\nyear: 2020\nstatus: {fx.FIELD_STATUS}\n---\n"
_S = fx.SAYS
# reply, part, strict, errors, warnings
_REPLIES = [
    (_MATTER + "body", 1, True, [], []),
    ("body", 1, True, [_S["missing"]], []),
    ("body", 1, False, [], [_S["missing"]]),
    ("body", 2, True, [], []),
    ("---\ntitle: x\n", 1, True, [_S["unclosed"]], []),
    ("  ", 1, True, [_S["blank"]], []),
    ("<html><body>", 2, True, [_S["html"]], []),
    ('{"error": 1}', 2, True, [_S["json"]], []),
    ("502 Bad Gateway", 2, True, [_S["service_short"] + "bad gateway"], []),
    ("好的，this", 2, True, [], [_S["explained"] + "好的，"]),
    (_MATTER + "x", 2, True, [], [_S["later"]]),
    (_MATTER.replace("2020", "true"), 1, True, [_S["year_flag"]], []),
    (_MATTER.replace("2020", "99"), 1, True, [], [_S["year_number"].format(99)]),
    (_MATTER.replace("2020", "about 1990"), 1, True, [], [_S["year_text"].format("about 1990")]),
    (_MATTER.replace("2020", "1.5"), 1, True, [_S["year_kind"]], []),
    ("---\n[a]\n---\nx", 1, True, [_S["yaml_kind"]], []),
    ("---\n# nothing\n---\nx", 1, True, [_S["yaml_empty"]], []),
    (_MATTER.replace("type: book\n", ""), 1, True, [_S["field_missing"].format("type")], []),
    (_MATTER.replace("book", "[a]"), 1, True, [_S["field_kind"].format("type"), _S["text_kind"].format("type")], []),
    (_MATTER.replace("title: A", "title: 7"), 1, True, [_S["title_kind"]], []),
    (_MATTER.replace("title: A", "title: ' '"), 1, True, [_S["title_blank"]], []),
    (_MATTER.replace("title: A", "title: " + "t" * 501), 1, True, [], [_S["title_long"]]),
    (_MATTER.replace(fx.SUBJECTS[1], "other"), 1, True, [_S["subject"].format("other")], []),
    (_MATTER.replace(fx.FIELD_STATUS, "open"), 1, True, [_S["status"].format("open")], []),
    (_MATTER.replace("2020", "99").replace("book", "5"), 1, False, [], [_S["year_number"].format(99), _S["text_kind"].format("type")]),
    (_MATTER + "a\n---\nb\n---\nc", 1, True, [], [_S["several"]]),
    ("```\nx\n```", 2, True, [], [_S["fence"]]),
    ("request failed " + "w" * 1000, 2, True, [], [_S["service_long"] + "request failed"]),
]


@query(f"SELECT doc_id, {pick_sql(['|'.join(r[3]) for r in _REPLIES])} AS errors, {pick_sql(['|'.join(r[4]) for r in _REPLIES])} AS warnings FROM documents")
def front_matter_rules(spark, sf_dir):
    docs = _docs(spark, sf_dir).select("doc_id", pick([r[0] for r in _REPLIES]).alias("reply"), F.lit("c").alias("chunk"), pick([r[1] for r in _REPLIES]).alias("part_number"), pick([r[2] for r in _REPLIES]).alias("strict"))
    return validation.validate(docs, strict=F.col("strict")).select("doc_id", F.array_join("errors", "|").alias("errors"), F.array_join("warnings", "|").alias("warnings"))


@query(f"SELECT doc_id, CASE WHEN length(coalesce(text, '')) >= 200 AND doc_id % 2 = 0 THEN '{_S['short']}' ELSE '' END AS warnings FROM documents")
def short_replies(spark, sf_dir):
    """Later parts whose reply is under half of a piece of 200 characters or more."""
    docs = _docs(spark, sf_dir).withColumn("text", text())
    reply = F.when(doc_id() % 2 == 0, "r").otherwise(F.regexp_replace("text", r"[^a-z ]", "q"))
    seen = validation.validate(docs.select("doc_id", reply.alias("reply"), F.col("text").alias("chunk"), F.lit(2).alias("part_number")))
    return seen.select("doc_id", F.array_join(F.filter("warnings", lambda w: w == _S["short"]), "|").alias("warnings"))


@query("SELECT doc_id, sha256(CASE WHEN doc_id % 2 = 0 THEN coalesce(text, '') ELSE chr(10) || '---' || chr(10) || 'title: [' || chr(10) || '---' || chr(10) || coalesce(text, '') END) AS body FROM documents")
def repeated_front_matter(spark, sf_dir):
    """A later part loses a front matter that is readable and sound, and keeps any other."""
    part = F.when(doc_id() % 2 == 0, F.concat(F.lit(_MATTER), text())).otherwise(F.concat(F.lit("\n---\ntitle: [\n---\n"), text()))
    return _docs(spark, sf_dir).select("doc_id", tx.sha256(validation.drop_repeated_matter(part, F.lit(2))).alias("body"))


# ---- reports

_PAIR_COUNT = lambda p, c: f"len(regexp_extract_all({c}, '{p}'))"
_NUMBERS = r"\b\d+(?:\.\d+)?(?:%\B|\b)"
_GONE = lambda p, least, share: f"({_PAIR_COUNT(p, 'md')} >= {least} AND {_PAIR_COUNT(p, 'reply')} < {_PAIR_COUNT(p, 'md')} * CAST({share} AS DOUBLE))"
_RATIO = "CAST(length(reply) AS DOUBLE) / CAST(length(md) AS DOUBLE)"
_MISSING = lambda a, b: f"len(list_filter({_URLS(a)}, lambda u: NOT list_contains(list_transform({_URLS(b)}, lambda v: {_NORM('v')}), {_NORM('u')}))) > 0"
_AT_LENGTH = lambda condition: f"(length(md) >= 200 AND {condition})"
_RULES = {
    "kept_severe": _AT_LENGTH(f"{_RATIO} < CAST(0.3 AS DOUBLE)"),
    "grown_severe": _AT_LENGTH(f"{_RATIO} > 2.0"),
    "kept_warning": _AT_LENGTH(f"{_RATIO} >= CAST(0.3 AS DOUBLE) AND {_RATIO} < CAST(0.5 AS DOUBLE)"),
    "kept_review": _AT_LENGTH(f"{_RATIO} >= CAST(0.5 AS DOUBLE) AND {_RATIO} < CAST(0.7 AS DOUBLE)"),
    "grown_warning": _AT_LENGTH(f"{_RATIO} > 1.5 AND {_RATIO} <= 2.0"),
    "headings": _GONE(_HEAD, 3, 0.5),
    "questions": _GONE(_QUES, 3, 0.7),
    "numbers": _GONE(_NUMBERS, 20, 0.7),
    "tables": _GONE(_TAB, 2, 0.5),
    "urls_added": _MISSING("reply", "md"),
    "urls_removed": _MISSING("md", "reply"),
    "ads": f"regexp_matches(reply, '{_AD}')",
}
_PERCENT = {"kept_severe": "30%", "grown_severe": "200%", "kept_warning": "50%", "kept_review": "70%", "grown_warning": "150%"}


def _ruled(spark, sf_dir):
    """Reports of pairs, with one flag for each rule that SQL can say (all but protected values and anchors)."""
    x = quality.assess(md_pairs(spark, sf_dir), "md", "reply", dict(fx.THRESHOLDS))
    said = F.concat("quality.warnings", "quality.severe_errors")
    return x.withColumns({rule: F.array_contains(said, F.lit(fx.SAYS[rule].format(_PERCENT.get(rule)))) for rule in _RULES})


@query(f"{DOCS} SELECT doc_id, " + ", ".join(f"{sql} AS {rule}" for rule, sql in _RULES.items()) + " FROM pairs")
def report_rules(spark, sf_dir):
    return _ruled(spark, sf_dir).select("doc_id", *_RULES)


_ANY = " OR ".join(_RULES.values())


@query(f"{DOCS} SELECT doc_id, CASE WHEN {_ANY} OR doc_id % 9 = 0 THEN 'review_required' WHEN doc_id % 2 = 0 THEN 'approved_for_ingestion' ELSE 'processed' END AS status FROM pairs")
def gated_reports(spark, sf_dir):
    """The gate over reports (without the two rules that SQL cannot say) and part warnings, strict or lenient."""
    x = _ruled(spark, sf_dir)
    flag = F.lit(False)
    for rule in _RULES:
        flag |= F.col(rule)
    x = x.select("doc_id", F.struct(flag.alias("review_required")).alias("quality"), (doc_id() % 9 == 0).alias("parts_review"))
    both = [assembly.gated(x.where(doc_id() % 2 == k), strict) for k, strict in ((0, True), (1, False))]
    return both[0].unionByName(both[1]).select("doc_id", "status")


_POLICY = json.dumps({"version": fx.POLICY_VERSION, **fx.THRESHOLDS, "table_retained_ratio": "?"}, sort_keys=True, separators=(",", ":")).split('"?"')


@F.pandas_udf(T.StringType())
def _policy(ratio: pd.Series) -> pd.Series:
    return pd.Series([quality.policy_sha256(quality.load_thresholds({"QUALITY_TABLE_RETAINED_RATIO": repr(r)})) for r in ratio], dtype=object)


@query(f"SELECT doc_id, sha256('{_POLICY[0]}' || CAST((doc_id % 40 + 10) / CAST(100 AS DOUBLE) AS VARCHAR) || '{_POLICY[1]}') AS policy FROM documents")
def policy_identity(spark, sf_dir):
    """The policy's identity where each row sets one threshold anew."""
    return _docs(spark, sf_dir).select("doc_id", _policy((doc_id() % 40 + 10) / F.lit(100.0)).alias("policy"))


# ---- reuse, assembly, batches


@query("SELECT doc_id, full_ AND (doc_id % 5 = 0 OR (doc_id % 5 = 4 AND doc_id % 2 = 0)) AS is_current FROM (SELECT doc_id, trim(coalesce(text, '')) != '' AS full_ FROM documents)")
def documents_current(spark, sf_dir):
    """Stored documents that stand (every fifth), with another source, a broken text, none, or a review copy out of step."""
    docs = _docs(spark, sf_dir).select("doc_id", doc_id().cast("string").alias("rel_path"), F.lit("s").alias("source_sha256"), F.lit(1).alias("part_count"), text().alias("text"))
    k = doc_id() % 5
    finals = docs.where(k != 3).select("rel_path", F.when(k == 1, "t").otherwise("s").alias("source_sha256"), "part_count", "text", F.when(k == 2, "broken").otherwise(tx.sha256("text")).alias("output_sha256"), (k == 4).alias("review_required"))
    review = docs.where(k == 4).select("rel_path", F.lit("review_required").alias("status"), F.lit("s").alias("source_sha256"), F.when(doc_id() % 2 == 0, tx.sha256("text")).otherwise("old").alias("output_sha256"))
    plans = docs.select("doc_id", "rel_path", "source_sha256", "part_count")
    known = cache.current_documents(plans, finals, ["source_sha256", "part_count"])
    step = assembly.in_review_step(finals, review).select("rel_path", F.lit(True).alias("step"))
    return known.join(step, "rel_path", "left").select("doc_id", (F.col("is_current") & F.coalesce("step", F.lit(False))).alias("is_current"))


@query("SELECT conv_id, string_agg(CAST(turn AS VARCHAR) || ':w' || CAST(turn AS VARCHAR), ',' ORDER BY turn) FILTER (WHERE turn % 2 = 1) AS warned, count(*) FILTER (WHERE turn % 2 = 1) > 0 OR conv_id % 3 = 0 AS review FROM conversations GROUP BY conv_id HAVING count(*) FILTER (WHERE trim(coalesce(text, '')) != '') = count(*) AND count(DISTINCT turn) = count(*)")
def part_warnings(spark, sf_dir):
    turns = _table(spark, sf_dir, "conversations")
    total = turns.groupBy("conv_id").agg(F.count("*").alias("total_parts"))
    noted = F.when(F.col("turn") % 2 == 1, F.array(F.concat(F.lit("w"), F.col("turn").cast("string")))).otherwise(F.array().cast("array<string>"))
    rows = turns.join(total, "conv_id").select("conv_id", F.col("turn").alias("part_number"), "total_parts", F.col("text").alias("body"), noted.alias("warnings"), (F.col("conv_id") % 3 == 0).alias("review_required"))
    whole = assembly.assemble(rows, "conv_id", drop_matter=False)
    return whole.select("conv_id", F.nullif(F.array_join(F.transform("part_warnings", lambda p: F.concat(p["part"].cast("string"), F.lit(":"), F.array_join(p["warnings"], ";"))), ","), F.lit("")).alias("warned"), F.col("parts_review").alias("review"))


_PIECES = "SELECT source AS rel_path, count(*) AS total, count(*) FILTER (WHERE doc_id % 4 < 2) AS success, count(*) FILTER (WHERE doc_id % 4 >= 2 AND NOT (doc_id % 4 = 3 AND doc_id % 8 = 7)) AS failed, count(*) FILTER (WHERE doc_id % 4 = 1) AS skipped FROM documents GROUP BY source"


@query(_PIECES)
def piece_sums(spark, sf_dir):
    """Pieces of each file: good and new, reused, refused, failed, or never sent."""
    docs, k = _docs(spark, sf_dir).withColumn("rel_path", F.col("source")), doc_id() % 4
    judged = docs.where(k < 3).select("rel_path", F.when(k == 2, "quality").alias("failure_stage"), (k != 1).alias("fresh"))
    replies = docs.where(k != 1).select("rel_path", F.when(k == 3, "e").alias("error"), F.when(k == 3, F.when(doc_id() % 8 == 7, "stopped").otherwise("request")).alias("stage"))
    return batches.piece_stats(docs.select("rel_path"), judged, replies)


def _rows(spark, sf_dir):
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return _files(spark, sf_dir).withColumns({"attempts": (F.col("ord") % 3).cast("int"), "error": F.concat(F.lit("e"), F.col("ord").cast("string")), "started_at": at, "finished_at": at})


@query(f"""SELECT batch_id, ord, CASE WHEN status = 'running' THEN CASE WHEN ord % 2 = 0 THEN 'interrupted' ELSE 'pending' END WHEN status = 'pending' THEN 'running' WHEN status = 'interrupted' THEN 'failed' ELSE status END AS status,
  CAST(CASE WHEN status = 'running' AND ord % 2 = 1 THEN greatest(ord % 3 - 1, 0) WHEN status = 'pending' THEN ord % 3 + 1 ELSE ord % 3 END AS INTEGER) AS attempts,
  CASE WHEN status = 'running' THEN CASE WHEN ord % 2 = 0 THEN 'stopped' END WHEN status = 'pending' THEN NULL WHEN status = 'interrupted' THEN 'Bearer ***  x' ELSE 'e' || CAST(ord AS VARCHAR) END AS error,
  status NOT IN ('pending') AND NOT (status = 'running' AND ord % 2 = 1) AS finished FROM ({_FILES})""")
def file_transitions(spark, sf_dir):
    """Pending files start, interrupted ones fail, running ones are interrupted or taken back; all others stay."""
    rows, was = _rows(spark, sf_dir), F.col("status")
    started = batches.moved(rows.where(was.isin("pending", "interrupted")), F.when(was == "pending", "running").otherwise("failed"), F.lit("Bearer 123456789\r\nx"), F.current_timestamp())
    back = batches.cancelled(rows.where((was == "running") & (F.col("ord") % 2 == 1)))
    broken = batches.resumed(rows.where((was == "running") & (F.col("ord") % 2 == 0)), "stopped")
    rest = rows.where(~was.isin("pending", "interrupted", "running"))
    out = started.unionByName(back).unionByName(broken).unionByName(rest)
    return out.select("batch_id", "ord", "status", "attempts", "error", F.col("finished_at").isNotNull().alias("finished"))


_CHILD = "20240102T000000000000Z-0123456789ab"


@query(f"SELECT '{_CHILD}' AS batch_id, batch_id AS parent, path, row_number() OVER (ORDER BY ord) - 1 AS ord, 'pending' AS status FROM (SELECT batch_id, path, min(ord) AS ord FROM ({_FILES}) WHERE status = 'failed' AND batch_id = 'b1' GROUP BY ALL)")
def retry_child_rows(spark, sf_dir):
    child = batches.retry_child(_rows(spark, sf_dir).where("batch_id = 'b1'"), _CHILD)
    return child.select("batch_id", F.col("parent_batch_id").alias("parent"), "path", F.col("ord").cast("long").alias("ord"), "status")


@query(f"SELECT ord, CASE WHEN ord % 4 = 0 THEN 'attempts' WHEN ord % 4 = 1 THEN 'path' WHEN ord % 4 = 2 THEN 'status' END AS fault FROM ({_FILES}) WHERE ord % 4 < 3")
def manifest_faults(spark, sf_dir):
    """Rows with a negative count of attempts, an unsafe path or an unknown status; sound rows do not show."""
    k = F.col("ord") % 4
    rows = _rows(spark, sf_dir).withColumns({
        "batch_id": F.lit(_CHILD), "attempts": F.when(k == 0, -1).otherwise(F.col("attempts")), "path": F.when(k == 1, F.concat(F.lit("../"), F.col("ord").cast("string"), F.lit(".md"))).otherwise(F.concat(F.lit("p/"), F.col("ord").cast("string"), F.lit(".md"))),
        "status": F.when(k == 2, "odd").otherwise(F.col("status")),
    })
    return batches.faults(rows).select("ord", F.array_join("faults", "|").alias("fault"))


@query(f"SELECT DISTINCT 'p' || CAST(doc_id AS VARCHAR) AS path FROM documents WHERE 'p' || CAST(doc_id AS VARCHAR) NOT IN (SELECT path FROM ({_FILES}) WHERE status = 'failed')")
def paths_that_may_not_be_retried(spark, sf_dir):
    asked = _docs(spark, sf_dir).select(F.concat(F.lit("p"), doc_id().cast("string")).alias("path"))
    return batches.not_retryable(asked, _files(spark, sf_dir))


@query("SELECT user_id, max(event_id) AS batch_id FROM events GROUP BY user_id")
def latest_of_each(spark, sf_dir):
    """The newest version of each key of a versioned table."""
    versions = _table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("batch_id"), F.lpad(F.col("event_id").cast("string"), 12, "0").alias("version"))
    return sinks.newest(versions, ["user_id"])


@query("SELECT event_id, event_type AS status, 'user ' || CAST(user_id AS VARCHAR) AS file, CASE WHEN event_id % 2 = 0 THEN 'key-*** a  b' END AS detail FROM events".replace("key-*** a", "*** a"))
def log_lines(spark, sf_dir):
    events = _table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("status"), F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("file"), F.when(F.col("event_id") % 2 == 0, "key-abcdefgh1 a\r\nb").alias("detail"))
    return sinks.log_rows(events, "file", "status", "detail", ("event_id",)).drop("time")


@query("SELECT doc_id, CASE WHEN coalesce(text, '') = '' THEN 2 ELSE 3 END AS n, sha256(CASE WHEN coalesce(text, '') = '' THEN chr(10) || chr(10) ELSE text || chr(10) END) AS first, sha256(coalesce(text, '') || chr(10) || chr(10) || '```' || chr(10) || '# x' || chr(10) || chr(10) || '```' || chr(10)) AS joined FROM documents")
def paragraphs_of_texts(spark, sf_dir):
    """Exact blocks of each text and a fence after it: the text, a blank line, the fence with a blank line of its own."""
    md = F.concat(text(), F.lit("\n\n```\n# x\n\n```\n"))
    found = md_blocks(_docs(spark, sf_dir).select("doc_id", md.alias("md")), "md", ("doc_id",))
    parts = found.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("block_no", "text"))).alias("b"))
    return parts.select("doc_id", F.size("b").alias("n"), tx.sha256(F.col("b")[0]["text"]).alias("first"), tx.sha256(F.array_join("b.text", "")).alias("joined"))


# ---- requests


@F.pandas_udf(T.StringType())
def _streamed(text: pd.Series, k: pd.Series) -> pd.Series:
    out = []
    for t, i in zip(text, k, strict=True):
        half = len(t) // 2
        parts = [{"choices": [{"delta": {"content": t[:half]}}]}, {"choices": [{"message": {"content": [{"text": {"value": t[half:]}}]}}]}]
        lines = [": hi", *(f"data: {json.dumps(p)}" for p in parts), *([] if i == 1 else ["data: [DONE]"] if i == 0 else ['data: {"choices":[{"finish_reason":"length"}]}'])]
        try:
            out.append(transport.read_events(iter(lines)))
        except transport.Retryable as e:
            out.append("again: " + e.partial)
        except RuntimeError as e:
            out.append(str(e))
    return pd.Series(out, dtype=object)


@query("SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN sha256(CASE WHEN trim(t) = '' THEN 'the reply is blank' ELSE t END) WHEN 1 THEN sha256('again: ' || t) ELSE sha256('the reply ended by length') END AS reply FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)")
def reply_streams(spark, sf_dir):
    """Event streams that end well, break off, or were cut by the model's limit."""
    docs = _docs(spark, sf_dir)
    return docs.select("doc_id", tx.sha256(_streamed(text(), (doc_id() % 3).cast("int"))).alias("reply"))


@query("""SELECT doc_id, sha256('Part ' || CAST(doc_id % 3 + 1 AS VARCHAR) || ' of 3 of document.md.' || chr(10) || CASE WHEN doc_id % 3 = 0 THEN 'This is the first part; begin with the front matter.' ELSE 'This is a later part; write no front matter.' END || chr(10)
  || '<<' || tag || '>>' || chr(10) || t || chr(10) || '<</' || tag || '>>') AS message FROM (SELECT doc_id, coalesce(text, '') AS t, substring(sha256(sha256(coalesce(text, '')) || CAST(doc_id % 3 + 1 AS VARCHAR)), 1, 32) AS tag FROM documents)""")
def request_messages(spark, sf_dir):
    pieces = _docs(spark, sf_dir).select("doc_id", text().alias("chunk"), tx.sha256(text()).alias("chunk_sha256"), (doc_id() % 3 + 1).cast("int").alias("part_number"), F.lit(3).alias("total_parts"))
    return transport.with_message(pieces).select("doc_id", tx.sha256("message_").alias("message"))


_CALLS = f"""WITH src AS (SELECT doc_id, 'Part ' || CASE WHEN doc_id % 4 = 0 THEN 2 ELSE 1 END || ' of 2 of document.md.' || chr(10) || CASE WHEN doc_id % 4 = 0 THEN 'This is a later part; write no front matter.' ELSE 'This is the first part; begin with the front matter.' END || chr(10)
  || '<<' || repeat('0', 32) || '>>' || chr(10) || coalesce(text, '') || chr(10) || '<</' || repeat('0', 32) || '>>' AS md, trim(coalesce(text, '')) = '' AS blank FROM documents)
SELECT doc_id, CASE WHEN blank THEN NULL WHEN {_TOKENS_SQL} > 1060 THEN 'budget' WHEN doc_id % 4 = 0 THEN 'request' END AS stage, blank OR ({_TOKENS_SQL} <= 1060 AND doc_id % 4 != 0) AS replied FROM src"""


class Half(transport.Transport):
    """Fails for later parts."""

    def reply(self, chunk: str, message: str) -> str:
        if "later part" in message:
            raise RuntimeError("no")
        return chunk


@query(_CALLS)
def requests_in_budget(spark, sf_dir):
    """All texts as pieces of files of their own, under and over a window of 1060 tokens a message, and a transport that fails for every fourth."""
    docs = _docs(spark, sf_dir).select("doc_id", doc_id().cast("string").alias("rel_path"), text().alias("chunk"), tx.sha256(text()).alias("chunk_sha256"), F.when(doc_id() % 4 == 0, 2).otherwise(1).alias("part_number"), F.lit(2).alias("total_parts"))
    ready = transport.budgeted(docs, transport.Budget(window=1060 + 64 + 1024, margin=1024))
    return transport.clean(ready, Half()).select("doc_id", "stage", F.col("reply").isNotNull().alias("replied"))
