"""Registered queries of the cleaning operators, each with its SQL for comparison where SQL can say it.

Sources are derived from `documents` by one expression that exists in both dialects: headings, questions,
a table, links, an advertising line and CJK text, chosen by doc_id; candidates are replies of eight kinds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import fixed as fx
from .functions import text as tx
from .functions.compare import protected_values_of
from .functions.markdown import md_blocks, md_chunks
from .operators import assembly, batches, cache, quality, transport, validation

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# ---- derived sources: the same text in both dialects

_SOURCE_SQL = r"""
SELECT doc_id, lang, source,
  '# Chapter ' || CAST(doc_id AS VARCHAR) || chr(10) || chr(10)
  || CASE WHEN doc_id % 2 = 0 THEN '## Part A' || chr(10) || '### Part B' || chr(10) || chr(10) ELSE '' END
  || coalesce(text, '') || chr(10) || chr(10)
  || CASE WHEN doc_id % 3 = 0 THEN '1. first' || chr(10) || '2、second' || chr(10) || '第 3 题 third' || chr(10) || chr(10) ELSE '' END
  || CASE WHEN doc_id % 4 = 0 THEN '| a | b |' || chr(10) || '| --- | --- |' || chr(10) || '| 1 | 2 |' || chr(10) || chr(10) ELSE '' END
  || CASE WHEN doc_id % 5 = 0 THEN 'See https://example.org/d/' || CAST(doc_id AS VARCHAR) || ' and http://Example.org/x).' || chr(10) ELSE '' END
  || CASE WHEN doc_id % 6 = 0 THEN '扫码关注领取资料' || chr(10) || '微信号：abc' || chr(10) ELSE '' END
  || CASE WHEN doc_id % 7 = 0 THEN '安全生产管理' || chr(10) ELSE '' END AS md
FROM documents"""
_REPLY_SQL = r"""
SELECT doc_id, lang, source, md,
  CASE doc_id % 8
    WHEN 0 THEN md
    WHEN 1 THEN substring(md, 1, CAST(floor(length(md) * 20 / 100) AS INTEGER))
    WHEN 2 THEN substring(md, 1, CAST(floor(length(md) * 40 / 100) AS INTEGER))
    WHEN 3 THEN substring(md, 1, CAST(floor(length(md) * 60 / 100) AS INTEGER))
    WHEN 4 THEN md || md || md
    WHEN 5 THEN md || substring(md, 1, CAST(floor(length(md) * 60 / 100) AS INTEGER))
    WHEN 6 THEN md || 'More at https://example.net/new' || chr(10)
    ELSE replace(md, '扫码关注领取资料' || chr(10), '') END AS reply
FROM src"""
DOCS = f"WITH src AS ({_SOURCE_SQL}), pairs AS ({_REPLY_SQL})"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def md_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, md."""
    i, n = F.col("doc_id"), "\n"
    when = lambda k, *parts: F.when(i % k == 0, F.concat(*parts)).otherwise(F.lit(""))
    text = F.concat(
        F.lit("# Chapter "), i.cast("string"), F.lit(n + n), when(2, F.lit(f"## Part A{n}### Part B{n}{n}")), F.coalesce("text", F.lit("")), F.lit(n + n),
        when(3, F.lit(f"1. first{n}2、second{n}第 3 题 third{n}{n}")), when(4, F.lit(f"| a | b |{n}| --- | --- |{n}| 1 | 2 |{n}{n}")),
        when(5, F.lit("See https://example.org/d/"), i.cast("string"), F.lit(f" and http://Example.org/x).{n}")), when(6, F.lit(f"扫码关注领取资料{n}微信号：abc{n}")), when(7, F.lit(f"安全生产管理{n}")),
    )
    return _table(spark, sf_dir, "documents").select("doc_id", "lang", "source", text.alias("md"))


def md_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, md, reply."""
    md, k = F.col("md"), F.col("doc_id") % 8
    head = lambda p: F.substring(md, F.lit(1), F.floor(F.length(md) * p / 100).cast("int"))
    reply = (
        F.when(k == 0, md).when(k == 1, head(20)).when(k == 2, head(40)).when(k == 3, head(60)).when(k == 4, F.concat(md, md, md)).when(k == 5, F.concat(md, head(60)))
        .when(k == 6, F.concat(md, F.lit("More at https://example.net/new\n"))).otherwise(F.replace(md, F.lit("扫码关注领取资料\n"), F.lit("")))
    )
    return md_source(spark, sf_dir).withColumn("reply", reply)


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _rel_path() -> Column:
    return F.concat(F.lit("in/"), F.col("source"), F.lit("/Doc "), F.col("doc_id").cast("string"), F.lit(".md"))


_REL = "'in/' || source || '/Doc ' || CAST(doc_id AS VARCHAR) || '.md'"

# ---- scans, names and hashes


@query(f"SELECT doc_id, {_REL} AS rel_path, CAST(strlen(coalesce(text, '')) AS BIGINT) AS size, sha256(coalesce(text, '')) AS source_sha256, CAST(length(coalesce(text, '')) AS BIGINT) AS source_chars FROM documents")
def scan_documents(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").withColumn("rel_path", _rel_path())
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", "rel_path", F.octet_length(text).cast("long").alias("size"), tx.sha256(text).alias("source_sha256"), F.length(text).cast("long").alias("source_chars"))


@query("SELECT doc_id, strlen(coalesce(text, '')) > 3000 AS too_large, trim(coalesce(text, '')) = '' AS is_empty FROM documents")
def size_and_empty_filter(spark, sf_dir):
    text = F.coalesce("text", F.lit(""))
    return _table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) > 3000).alias("too_large"), tx.is_blank(text).alias("is_empty"))


@query(
    f"SELECT doc_id, 'Doc_' || CAST(doc_id AS VARCHAR) || '_' || substring(sha256({_REL}), 1, 10) AS dir_name, "
    "'Doc_' || CAST(doc_id AS VARCHAR) || '_part_' || CASE WHEN doc_id < 1000 THEN lpad(CAST(doc_id AS VARCHAR), 3, '0') ELSE CAST(doc_id AS VARCHAR) END || '_cleaned.md' AS part_file, "
    "'Doc_' || CAST(doc_id AS VARCHAR) || '_cleaned.md' AS final_file FROM documents"
)
def output_names(spark, sf_dir):
    p = _rel_path()
    return _table(spark, sf_dir, "documents").select("doc_id", tx.output_dir_name(p).alias("dir_name"), tx.part_name(p, "doc_id").alias("part_file"), tx.final_name(p).alias("final_file"))


@query("SELECT min(doc_id) AS doc_id, sha256(coalesce(text, '')) AS content, count(*) AS copies FROM documents GROUP BY 2")
def exact_duplicate_first_wins(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", tx.sha256(F.coalesce("text", F.lit(""))).alias("content"))
    return docs.groupBy("content").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))


_CJK_SQL = "len(regexp_extract_all(md, '[\\x{3400}-\\x{4dbf}\\x{4e00}-\\x{9fff}\\x{f900}-\\x{faff}\\x{3040}-\\x{30ff}\\x{ac00}-\\x{d7af}]'))"
_TOKENS_SQL = f"greatest(1, CAST(ceil(CAST({_CJK_SQL} AS DOUBLE) * CAST(1.2 AS DOUBLE) + CAST(length(md) - {_CJK_SQL} AS DOUBLE) / CAST(4.0 AS DOUBLE)) AS BIGINT))"


@query(f"{DOCS} SELECT doc_id, {_TOKENS_SQL} AS tokens FROM src")
def token_estimate(spark, sf_dir):
    return md_source(spark, sf_dir).select("doc_id", tx.token_estimate("md").alias("tokens"))


@query(f"{DOCS} SELECT doc_id, {_TOKENS_SQL} + 564 AS input_tokens, 4096 - ({_TOKENS_SQL} + 564) - 1536 AS remaining_tokens, 4096 - ({_TOKENS_SQL} + 564) - 1536 >= 0 AS fits FROM src")
def budget_fit(spark, sf_dir):
    return transport.budget(md_source(spark, sf_dir), 500, 4096, 512, 1024, "md").select("doc_id", "input_tokens", "remaining_tokens", "fits")


@query("SELECT page_id, lower(rtrim(url || ').', '.,;:，。；：)]}）】》」』')) AS url FROM pages")
def url_normalize(spark, sf_dir):
    return _table(spark, sf_dir, "pages").select("page_id", tx.normal_url(F.concat("url", F.lit(")."))).alias("url"))


@query(r"""SELECT event_id, regexp_replace(regexp_replace('user ' || CAST(user_id AS VARCHAR) || ' Bearer abcdefgh' || CAST(event_id AS VARCHAR) || ' sk-' || repeat('x', 9) || chr(10) || 'end',
  '(?i)(Bearer\s+)[^\s''"\\]{8,}', '\1***', 'g'), 'sk-[A-Za-z0-9_-]{8,}', '***', 'g') AS redacted,
  replace(regexp_replace(regexp_replace('user ' || CAST(user_id AS VARCHAR) || ' Bearer abcdefgh' || CAST(event_id AS VARCHAR) || ' sk-' || repeat('x', 9) || chr(10) || 'end',
  '(?i)(Bearer\s+)[^\s''"\\]{8,}', '\1***', 'g'), 'sk-[A-Za-z0-9_-]{8,}', '***', 'g'), chr(10), ' ') AS compact FROM events""")
def redact_secrets(spark, sf_dir):
    raw = F.concat(F.lit("user "), F.col("user_id").cast("string"), F.lit(" Bearer abcdefgh"), F.col("event_id").cast("string"), F.lit(" sk-"), F.lit("x" * 9), F.lit("\nend"))
    return _table(spark, sf_dir, "events").select("event_id", tx.redact(raw).alias("redacted"), tx.compact_error(raw).alias("compact"))


# ---- native metrics

_N = lambda pattern, c="md": f"CAST(len(regexp_extract_all({c}, '{pattern}')) AS BIGINT)"
_HEAD, _QUES = "(?m)^#{1,6}[ \\t]+[^\\s]+", "(?m)^[ \\t]*(?:第[ \\t]*\\d+[ \\t]*题|[0-9]{1,4}[.、．][ \\t]*[^\\s])"
_TAB = fx.TABLE_RULE
_URL = "(?i)" + fx.URL.replace("'", "''")


@query(f"{DOCS} SELECT doc_id, {_N(_HEAD)} AS headings, {_N(_QUES)} AS questions, {_N(_URL)} AS urls, {_N(_TAB)} AS tables FROM src")
def structure_counts(spark, sf_dir):
    return md_source(spark, sf_dir).select("doc_id", tx.heading_count("md").alias("headings"), tx.question_count("md").alias("questions"), tx.url_count("md").alias("urls"), tx.table_count("md").alias("tables"))


@query(f"{DOCS} SELECT doc_id, {_N(chr(92) + 'b' + chr(92) + 'd+(?:' + chr(92) + '.' + chr(92) + 'd+)?(?:%' + chr(92) + 'B|' + chr(92) + 'b)')} AS numbers FROM src")
def number_count(spark, sf_dir):
    return md_source(spark, sf_dir).select("doc_id", tx.number_count("md").alias("numbers"))


@query()
def protected_values(spark, sf_dir):
    return md_source(spark, sf_dir).select("doc_id", F.array_join(protected_values_of("md"), "|").alias("protected"))


_AD = "(?i)(" + "|".join(fx.ADS) + ")"


@query(f"{DOCS} SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS kept FROM (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM (SELECT doc_id, string_split(rtrim(md, chr(10)), chr(10)) AS lines FROM src)) WHERE NOT regexp_matches(line, '{_AD}') GROUP BY doc_id")
def ad_line_filter(spark, sf_dir):
    return md_source(spark, sf_dir).select("doc_id", tx.protected_text(F.rtrim("md", F.lit("\n"))).alias("kept"))


@query(f"{DOCS} SELECT doc_id, " + " + ".join(f"len(regexp_extract_all(md, '(?i){p}'))" for p in fx.ADS) + " AS hits FROM src")
def ad_signal_hits(spark, sf_dir):
    hits = sum((tx.count("md", p, True) for p in fx.ADS), F.lit(0))
    return md_source(spark, sf_dir).select("doc_id", hits.cast("long").alias("hits"))


@query(f"{DOCS} SELECT doc_id, array_to_string(" + " || ".join(f"list_transform(regexp_extract_all(md, '(?i){p}'), lambda s: trim(s))" for p in fx.ADS) + ", '|') AS signals FROM src")
def ad_signals(spark, sf_dir):
    return md_source(spark, sf_dir).select("doc_id", F.array_join(tx.ad_signals("md"), "|").alias("signals"))


_URLS = lambda c: f"list_distinct(regexp_extract_all({c}, '{_URL}'))"
_NORM = lambda u: f"lower(rtrim({u}, '.,;:，。；：)]}}）】》」』'))"


@query(
    f"{DOCS} SELECT doc_id, CAST(len(list_filter({_URLS('reply')}, lambda u: NOT list_contains(list_transform({_URLS('md')}, lambda v: {_NORM('v')}), {_NORM('u')}))) AS BIGINT) AS added, "
    f"CAST(len(list_filter({_URLS('md')}, lambda u: NOT list_contains(list_transform({_URLS('reply')}, lambda v: {_NORM('v')}), {_NORM('u')}))) AS BIGINT) AS removed FROM pairs"
)
def url_changes(spark, sf_dir):
    return md_pairs(spark, sf_dir).select("doc_id", F.size(tx.urls_missing_in("reply", "md", 1000)).cast("long").alias("added"), F.size(tx.urls_missing_in("md", "reply", 1000)).cast("long").alias("removed"))


_R = "CASE WHEN length(md) > 0 THEN CAST(length(reply) AS DOUBLE) / CAST(length(md) AS DOUBLE) ELSE 1.0 END"
_KEPT = f"CASE WHEN length(md) < 200 THEN 'ok' WHEN {_R} < CAST(0.3 AS DOUBLE) THEN 'severe' WHEN {_R} < CAST(0.5 AS DOUBLE) THEN 'warning' WHEN {_R} < CAST(0.7 AS DOUBLE) THEN 'review' ELSE 'ok' END"
_GROWN = f"CASE WHEN length(md) < 200 THEN 'ok' WHEN {_R} > 2.0 THEN 'severe' WHEN {_R} > 1.5 THEN 'warning' ELSE 'ok' END"


@query(f"{DOCS} SELECT doc_id, {_R} AS retained_ratio, greatest(0.0, 1.0 - {_R}) AS removed_ratio, {_KEPT} AS retention_band, {_GROWN} AS expansion_band FROM pairs")
def length_ratios(spark, sf_dir):
    r, n, t = quality.retained("md", "reply"), F.length("md"), fx.THRESHOLDS
    return md_pairs(spark, sf_dir).select("doc_id", r.alias("retained_ratio"), F.greatest(F.lit(0.0), 1.0 - r).alias("removed_ratio"), quality.band(r, n, t, "retained").alias("retention_band"), quality.band(r, n, t, "expansion").alias("expansion_band"))


_LOST = lambda p, least, share: f"({_N(p)} >= {least} AND {_N(p, 'reply')} < {_N(p)} * CAST({share} AS DOUBLE))"


@query(f"{DOCS} SELECT doc_id, {_LOST(_HEAD, 3, 0.5)} AS headings_lost, {_LOST(_QUES, 3, 0.7)} AS questions_lost, {_LOST(_TAB, 2, 0.5)} AS tables_lost FROM pairs")
def structure_retention(spark, sf_dir):
    x = quality.counted(md_pairs(spark, sf_dir), "md", "reply")
    gone = lambda what, least, share: quality.lost(F.col(f"input_{what}"), F.col(f"output_{what}"), least, share).alias(f"{what}_lost")
    return x.select("doc_id", gone("headings", 3, 0.5), gone("questions", 3, 0.7), gone("tables", 2, 0.5))


@query()
def quality_report(spark, sf_dir):
    x = quality.assess(md_pairs(spark, sf_dir), "md", "reply", dict(fx.THRESHOLDS)).select("doc_id", "quality.*")
    lists = ("added_urls", "removed_urls", "remaining_ad_signals", "warnings", "severe_errors")
    return x.withColumns({c: F.array_join(c, "|") for c in lists})


# ---- replies


@query(r"SELECT page_id, regexp_matches(html, '(?is)^\s*(?:<!doctype\s+html[^>]*>\s*)?<html(?:\s|>)') OR regexp_matches(substring(html, 1, 5000), '(?is)<(?:title|h1)[^>]*>[^<]*(?:error|错误|bad gateway|service unavailable|forbidden)') AS is_html FROM pages")
def html_error_pages(spark, sf_dir):
    return _table(spark, sf_dir, "pages").select("page_id", validation.is_html(F.col("html")).alias("is_html"))


@query("""SELECT event_id, regexp_matches(props, '(?s)^\\s*\\{.*\\}\\s*$') AND (contains(lower(props), '"error"') OR contains(lower(props), '"message"') OR contains(lower(props), '"content"') OR contains(lower(props), '"choices"') OR contains(lower(props), '"response"') OR contains(lower(props), '"output"')) AS is_api_json FROM (SELECT event_id, coalesce(props, '') AS props FROM events)""")
def json_like_reply(spark, sf_dir):
    return _table(spark, sf_dir, "events").select("event_id", validation.is_api_json(F.coalesce("props", F.lit(""))).alias("is_api_json"))


def _reply_of() -> Column:
    k = F.col("doc_id") % 5
    return F.concat(F.when(k == 0, "Bad Gateway: ").when(k == 1, "好的，").when(k == 2, "---\ntitle: x\n---\n").when(k == 3, "清洗说明：").otherwise(""), F.coalesce("text", F.lit("")))


_REPLY_OF = "CASE doc_id % 5 WHEN 0 THEN 'Bad Gateway: ' WHEN 1 THEN '好的，' WHEN 2 THEN '---' || chr(10) || 'title: x' || chr(10) || '---' || chr(10) WHEN 3 THEN '清洗说明：' ELSE '' END || coalesce(text, '')"


def _first_sql(area: str, phrases: list[str]) -> str:
    return "CASE " + " ".join(f"WHEN contains({area}, '{p.lower()}') THEN '{p}'" for p in phrases) + " END"


@query(f"WITH r AS (SELECT doc_id, {_REPLY_OF} AS reply FROM documents) SELECT doc_id, " + _first_sql("CASE WHEN length(reply) > 5000 THEN substring(lower(reply), 1, 1000) ELSE lower(reply) END", fx.SERVICE_ERRORS) + " AS phrase FROM r")
def error_phrase(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", validation.service_error(_reply_of()).alias("phrase"))


@query(f"WITH r AS (SELECT doc_id, {_REPLY_OF} AS reply FROM documents) SELECT doc_id, CASE WHEN reply LIKE '---%' THEN NULL ELSE coalesce(" + _first_sql("substring(lower(reply), 1, 150)", fx.EXPLANATIONS) + ", " + _first_sql("substring(lower(reply), 1, 300)", fx.SUSPICIOUS) + ") END AS prefix FROM r")
def explanation_prefix(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", validation.explanation(_reply_of()).alias("prefix"))


@query(f"WITH r AS (SELECT doc_id, {_REPLY_OF} AS reply FROM documents) SELECT doc_id, CAST(floor(len(regexp_extract_all(reply, '(?m)^---[ \\t]*$')) / 2) AS BIGINT) AS pairs, nullif(regexp_extract(reply, '(?s)\\A---[ \\t]*\\r?\\n(.*?)\\r?\\n---[ \\t]*(?:\\r?\\n|\\z)', 1), '') AS matter FROM r")
def front_matter_parts(spark, sf_dir):
    r = _reply_of()
    return _table(spark, sf_dir, "documents").select("doc_id", validation.rule_pairs(r).alias("pairs"), validation.front_matter(r).alias("matter"))


_MISSING = "|".join(fx.SAYS["field_missing"].format(f) for f in fx.REQUIRED_FIELDS if f != "title")
_RULES_OF_REPLIES = f"""WITH r AS (SELECT doc_id, doc_id % 2 = 0 AS isfirst, trim({_REPLY_OF}, ' ' || chr(9) || chr(10) || chr(13)) AS reply FROM documents),
  x AS (SELECT *, {_first_sql("CASE WHEN length(reply) > 5000 THEN substring(lower(reply), 1, 1000) ELSE lower(reply) END", fx.SERVICE_ERRORS)} AS phrase,
    CASE WHEN reply LIKE '---%' THEN NULL ELSE coalesce({_first_sql("substring(lower(reply), 1, 150)", fx.EXPLANATIONS)}, {_first_sql("substring(lower(reply), 1, 300)", fx.SUSPICIOUS)}) END AS prefix FROM r)
SELECT doc_id, CASE WHEN reply = '' THEN '{fx.SAYS["blank"]}' ELSE array_to_string(list_filter([CASE WHEN length(reply) < 1000 THEN '{fx.SAYS["service_short"]}' || phrase END,
    CASE WHEN isfirst AND doc_id % 5 != 2 THEN '{fx.SAYS["missing"]}' END, CASE WHEN isfirst AND doc_id % 5 = 2 THEN '{_MISSING}' END], lambda e: e IS NOT NULL), '|') END AS errors,
  CASE WHEN reply = '' THEN '' ELSE array_to_string(list_filter([CASE WHEN length(reply) >= 1000 THEN '{fx.SAYS["service_long"]}' || phrase END, '{fx.SAYS["explained"]}' || prefix,
    CASE WHEN NOT isfirst AND doc_id % 5 = 2 THEN '{_MISSING}|{fx.SAYS["later"]}' END], lambda e: e IS NOT NULL), '|') END AS warnings FROM x"""


@query(_RULES_OF_REPLIES)
def validate_reply(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", _reply_of().alias("reply"), F.col("text").alias("chunk"), (F.col("doc_id") % 2 + 1).alias("part_number"))
    return validation.validate(docs).select("doc_id", F.array_join("errors", "|").alias("errors"), F.array_join("warnings", "|").alias("warnings"))


# ---- pieces and assembly


_LINES = lambda *lines: " || ".join(f"'{x}' || chr(10)" for x in lines)
#: The blocks that md_source is made of; an empty text leaves one blank block where two would stand.
_BLOCKS = f"""WITH parts AS (SELECT doc_id, unnest([
  {{'kind': 'normal', 'text': '# Chapter ' || CAST(doc_id AS VARCHAR) || chr(10)}}, CASE WHEN doc_id % 2 = 0 THEN {{'kind': 'blank', 'text': chr(10)}} END,
  CASE WHEN doc_id % 2 = 0 THEN {{'kind': 'normal', 'text': {_LINES('## Part A')}}} END, CASE WHEN doc_id % 2 = 0 THEN {{'kind': 'normal', 'text': {_LINES('### Part B')}}} END,
  CASE WHEN t = '' THEN {{'kind': 'blank', 'text': chr(10) || chr(10) || chr(10)}} ELSE {{'kind': 'blank', 'text': chr(10)}} END,
  CASE WHEN t != '' THEN {{'kind': 'normal', 'text': t || chr(10)}} END, CASE WHEN t != '' THEN {{'kind': 'blank', 'text': chr(10)}} END,
  CASE WHEN doc_id % 3 = 0 THEN {{'kind': 'list_item', 'text': {_LINES('1. first', '2、second', '第 3 题 third')}}} END, CASE WHEN doc_id % 3 = 0 THEN {{'kind': 'blank', 'text': chr(10)}} END,
  CASE WHEN doc_id % 4 = 0 THEN {{'kind': 'table', 'text': {_LINES('| a | b |', '| --- | --- |', '| 1 | 2 |')}}} END, CASE WHEN doc_id % 4 = 0 THEN {{'kind': 'blank', 'text': chr(10)}} END,
  CASE WHEN doc_id % 5 = 0 OR doc_id % 6 = 0 OR doc_id % 7 = 0 THEN {{'kind': 'normal', 'text': CASE WHEN doc_id % 5 = 0 THEN 'See https://example.org/d/' || CAST(doc_id AS VARCHAR) || ' and http://Example.org/x).' || chr(10) ELSE '' END
    || CASE WHEN doc_id % 6 = 0 THEN {_LINES('扫码关注领取资料', '微信号：abc')} ELSE '' END || CASE WHEN doc_id % 7 = 0 THEN {_LINES('安全生产管理')} ELSE '' END}} END]) AS b
  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents))
SELECT doc_id, b.kind AS kind, count(*) AS n, CAST(sum(length(b.text)) AS BIGINT) AS chars FROM parts WHERE b IS NOT NULL GROUP BY 1, 2"""


@query(_BLOCKS)
def md_block_kinds(spark, sf_dir):
    return md_blocks(md_source(spark, sf_dir), "md", ("doc_id",)).groupBy("doc_id", "kind").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))


@query(f"{DOCS} SELECT doc_id, sha256(md) AS source_sha256, true AS lossless FROM src")
def chunk_lossless(spark, sf_dir):
    """Pieces of 2000 characters joined again; the SQL side knows only the source, so a lost character or an uncut text shows."""
    parts, errors = md_chunks(md_source(spark, sf_dir), 2000, "md", ("doc_id", "md"))
    joined = parts.groupBy("doc_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part_number", "chunk"))), lambda p: p["chunk"]), "").alias("text"), F.max(F.length("chunk")).alias("most"))
    whole = joined.select("doc_id", tx.sha256("text").alias("source_sha256"), (F.col("most") <= 2000).alias("lossless"))
    return whole.unionByName(errors.select("doc_id", F.lit(None).cast("string").alias("source_sha256"), F.lit(False).alias("lossless")))


@query()
def md_chunk_plan(spark, sf_dir):
    parts, errors = md_chunks(md_source(spark, sf_dir), 2000, "md", ("doc_id",))
    return parts.select("doc_id", "part_number", "total_parts", "chunk_sha256").unionByName(errors.select("doc_id", F.lit(0).alias("part_number"), F.lit(0).alias("total_parts"), F.lit(None).cast("string").alias("chunk_sha256")))


@query("SELECT conv_id, count(*) AS part_count, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS text FROM conversations GROUP BY conv_id HAVING count(*) FILTER (WHERE trim(coalesce(text, '')) != '') = count(*) AND count(DISTINCT turn) = count(*)")
def assemble_ordered(spark, sf_dir):
    turns = _table(spark, sf_dir, "conversations")
    total = turns.groupBy("conv_id").agg(F.count("*").alias("total_parts"))
    ready = turns.join(total, "conv_id").select("conv_id", F.col("turn").alias("part_number"), "total_parts", F.col("text").alias("body"))
    return assembly.assemble(ready, "conv_id", drop_matter=False).select("conv_id", F.col("part_count").cast("long"), "text")


# ---- reuse


def _cache_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    base = docs.select("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("rel_path"), tx.sha256("text").alias("source_sha256"), tx.sha256("text").alias("chunk_sha256"), F.lit(1).alias("part_number"), F.lit(1).alias("total_parts"), "text")
    chunks = cache.with_identity(base, "m", "https://h/", True)
    k = F.col("doc_id") % 6
    prompt = F.when(k == 0, "now").when(k == 1, "alias").otherwise("old")
    stored = chunks.withColumns({"body": F.col("text"), "output_sha256": F.when(F.col("doc_id") % 12 == 0, "broken").otherwise(tx.sha256("text")), "prompt_sha256": prompt, "prompt_identity_version": F.when(k == 1, F.lit(2)).cast("int")})
    return chunks.drop("text"), stored.drop("doc_id", "text")


_REUSED = "doc_id % 12 IN (1, 6, 7) AND trim(coalesce(text, '')) != ''"


@query(f"SELECT doc_id, 'd' || CAST(doc_id AS VARCHAR) AS rel_path FROM documents WHERE {_REUSED}")
def cache_reuse(spark, sf_dir):
    chunks, stored = _cache_tables(spark, sf_dir)
    return cache.reusable(chunks, stored, "now", ["alias"]).select("doc_id", "rel_path")


@query(f"SELECT doc_id, 'd' || CAST(doc_id AS VARCHAR) AS rel_path FROM documents WHERE NOT ({_REUSED})")
def cache_pending(spark, sf_dir):
    chunks, stored = _cache_tables(spark, sf_dir)
    return cache.pending(chunks, stored, "now", ["alias"]).select("doc_id", "rel_path")


# ---- gate

_REVIEW = f"({_KEPT} != 'ok' OR {_GROWN} != 'ok' OR doc_id % 11 = 0)"


def _review(thresholds: dict[str, float]) -> Column:
    r, n = quality.retained("md", "reply"), F.length("md")
    bands = [quality.band(r, n, thresholds, kind) != "ok" for kind in ("retained", "expansion")]
    return bands[0] | bands[1] | (F.col("doc_id") % 11 == 0)


def _gate(spark: SparkSession, sf_dir: str, thresholds: dict[str, float]) -> DataFrame:
    review = _review(thresholds)
    return md_pairs(spark, sf_dir).select("doc_id", review.alias("review"), tx.artifact_status(review, F.col("doc_id") % 2 == 0).alias("status"))


_STATUS = f"CASE WHEN {_REVIEW} THEN 'review_required' WHEN doc_id % 2 = 0 THEN 'approved_for_ingestion' ELSE 'processed' END"


@query(f"{DOCS} SELECT doc_id, {_STATUS} AS status FROM pairs")
def gate_status(spark, sf_dir):
    return _gate(spark, sf_dir, fx.THRESHOLDS).select("doc_id", "status")


@query(f"{DOCS} SELECT {_STATUS} AS status, count(*) AS n FROM pairs GROUP BY 1")
def gate_counts(spark, sf_dir):
    return _gate(spark, sf_dir, fx.THRESHOLDS).groupBy("status").agg(F.count("*").alias("n"))


@query(f"{DOCS} SELECT l.quality, {_STATUS} AS status, count(*) AS n FROM pairs JOIN labels l USING (doc_id) GROUP BY 1, 2")
def gate_vs_labels(spark, sf_dir):
    return _gate(spark, sf_dir, fx.THRESHOLDS).join(_table(spark, sf_dir, "labels"), "doc_id").groupBy("quality", "status").agg(F.count("*").alias("n"))


@query(f"{DOCS}, both_ AS (SELECT doc_id, {_REVIEW} AS before, ({_KEPT.replace('0.7 ', '0.5 ')} != 'ok' OR {_GROWN.replace('> 1.5', '> 1.8')} != 'ok' OR doc_id % 11 = 0) AS after FROM pairs) SELECT before, after, count(*) AS n FROM both_ GROUP BY 1, 2")
def policy_reclassify(spark, sf_dir):
    """The same replies under two policies, judged in one pass: nothing is sent again."""
    other = fx.THRESHOLDS | {"review_min_retained_ratio": 0.5, "warning_max_expansion_ratio": 1.8}
    both = [_review(t).alias(name) for t, name in ((fx.THRESHOLDS, "before"), (other, "after"))]
    return md_pairs(spark, sf_dir).select(*both).groupBy("before", "after").agg(F.count("*").alias("n"))


# ---- batches

# batch b3 is over, the others are not
_FILES = (
    "SELECT 'b' || CAST(doc_id % 7 AS VARCHAR) AS batch_id, doc_id AS ord, 'p' || CAST(doc_id % 500 AS VARCHAR) AS path, "
    "CASE CASE WHEN doc_id % 7 = 3 THEN 2 + doc_id % 3 ELSE doc_id % 6 END WHEN 0 THEN 'pending' WHEN 1 THEN 'running' WHEN 2 THEN 'succeeded' WHEN 3 THEN 'failed' WHEN 4 THEN 'skipped' ELSE 'interrupted' END AS status FROM documents"
)


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    place = F.when(i % 7 == 3, i % 3 + 3).otherwise(i % 6 + 1)
    status = F.element_at(F.array(*map(F.lit, fx.FILE_STATUSES)), place.cast("int"))
    return _table(spark, sf_dir, "documents").select(F.concat(F.lit("b"), (i % 7).cast("string")).alias("batch_id"), i.alias("ord"), F.concat(F.lit("p"), (i % 500).cast("string")).alias("path"), status.alias("status"))


_COUNTS = "SELECT batch_id, count(*) AS total, " + ", ".join(f"count(*) FILTER (WHERE status = '{s}') AS {s}" for s in fx.FILE_STATUSES) + f" FROM ({_FILES}) GROUP BY batch_id"


@query(_COUNTS)
def manifest_counts(spark, sf_dir):
    return batches.status_counts(_files(spark, sf_dir))


@query(f"SELECT *, CASE WHEN batch_id = 'b5' THEN 'stopped' WHEN pending + running + interrupted > 0 THEN 'incomplete' WHEN failed > 0 THEN 'completed_with_failures' ELSE 'completed' END AS batch_status, batch_id != 'b5' AND pending + running + interrupted = 0 AS is_complete, CASE WHEN total = 0 THEN 100 ELSE CAST((succeeded + skipped + failed + interrupted) * 100 // total AS BIGINT) END AS percent FROM ({_COUNTS})")
def batch_rollup(spark, sf_dir):
    return batches.progress(batches.rollup_status(batches.status_counts(_files(spark, sf_dir)), F.col("batch_id") == "b5"))


@query(f"SELECT batch_id, ord, path FROM ({_FILES}) WHERE status IN ('pending', 'interrupted')")
def resume_paths(spark, sf_dir):
    return batches.resumable(_files(spark, sf_dir)).select("batch_id", "ord", "path")


@query(f"SELECT path, min(ord) AS ord FROM ({_FILES}) WHERE status = 'failed' GROUP BY path")
def retry_paths(spark, sf_dir):
    return batches.retryable(_files(spark, sf_dir)).select("path", "ord")


@query(f"SELECT batch_id, ord, path FROM ({_FILES}) WHERE status IN ('pending', 'interrupted') ORDER BY ord LIMIT 25")
def max_files_limit(spark, sf_dir):
    return batches.limited(batches.resumable(_files(spark, sf_dir)), 25).select("batch_id", "ord", "path")


@query("""WITH e AS (SELECT user_id, event_id, event_type = 'click' AS bad FROM events),
  i AS (SELECT *, sum(CASE WHEN bad THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id) AS island FROM e),
  r AS (SELECT *, sum(CASE WHEN bad THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, island ORDER BY event_id) AS run FROM i)
  SELECT user_id, CAST(max(run) AS BIGINT) AS longest, min(event_id) FILTER (WHERE run >= 2) AS stop_at FROM r GROUP BY user_id""")
def failure_run_length(spark, sf_dir):
    runs = batches.failure_runs(_table(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), "user_id", "event_id", F.col("event_type") == "click")
    return runs.groupBy("user_id").agg(F.max("run").cast("long").alias("longest"), F.min(F.when(F.col("run") >= 2, F.col("event_id"))).alias("stop_at"))



from . import catalog_batches, catalog_rules  # noqa: E402, F401 (register more queries)
