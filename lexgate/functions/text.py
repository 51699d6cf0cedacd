"""Native column expressions: names, hashes, redaction, counts, token estimates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed as fx

#: What Python's strip() removes, as a Java class, and sign by sign.
SPACE = r"[\s\x0b\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: Column | str) -> Column:
    """Without Unicode white space at both ends."""
    return F.btrim(col(c), F.lit(SPACES))


def is_blank(c: Column | str) -> Column:
    """Whether nothing but Unicode white space is there; the search ends at the first other sign."""
    return ~col(c).rlike(rf"[^{SPACE[1:]}")


def sha256(c: Column | str) -> Column:
    return F.sha2(col(c).cast("binary"), 256)


def safe_name(c: Column | str) -> Column:
    """A file-system name: reserved signs and white space become _, and none of ' ._' stays at the ends."""
    name = F.regexp_replace(col(c), r'[\\/:*?"<>|]+', "_")
    name = F.trim(F.regexp_replace(name, rf"{SPACE}+", "_"), F.lit(" ._"))
    return F.when(name == "", F.lit("unnamed")).otherwise(name)


def stem(path: Column | str) -> Column:
    """The last part of a posix path without its suffix (a leading dot starts no suffix)."""
    return F.regexp_replace(F.regexp_extract(col(path), r"([^/]*)\z", 1), r"(?<=.)\.[^.]+\z", "")


def output_dir_name(rel_path: Column | str) -> Column:
    return F.concat(safe_name(stem(rel_path)), F.lit("_"), F.substring(sha256(rel_path), 1, 10))


def part_tag(n: Column | str) -> Column:
    """At least three digits; longer numbers stay whole."""
    n = col(n).cast("string")
    return F.when(F.length(n) < 3, F.lpad(n, 3, "0")).otherwise(n)


def part_name(rel_path: Column | str, n: Column | str, kind: str = "cleaned") -> Column:
    return F.concat(safe_name(stem(rel_path)), F.lit("_part_"), part_tag(n), F.lit(f"_{kind}.md"))


def final_name(rel_path: Column | str) -> Column:
    return F.concat(safe_name(stem(rel_path)), F.lit("_cleaned.md"))


def redact(c: Column | str) -> Column:
    return reduce(lambda text, rule: F.regexp_replace(text, rule[0], rule[1]), fx.SECRETS, col(c))


def compact_error(c: Column | str, limit: int = 2000) -> Column:
    return F.substring(F.translate(redact(c), "\r\n", "  "), 1, limit)


def count(c: Column | str, pattern: str, ignore_case: bool = False) -> Column:
    return F.regexp_count(col(c), F.lit(fx.java(pattern, ignore_case))).cast("long")


def heading_count(c):
    return count(c, fx.HEADING)


def question_count(c):
    return count(c, fx.QUESTION)


def number_count(c):
    return count(c, fx.NUMBER)


def url_count(c):
    return F.when(~F.contains(col(c), F.lit("://")), F.lit(0).cast("long")).otherwise(count(c, fx.URL, True))


def table_count(c):
    return F.when(~F.contains(col(c), F.lit("---")), F.lit(0).cast("long")).otherwise(count(c, fx.TABLE_RULE))


def all_matches(c: Column | str, pattern: str, ignore_case: bool = False) -> Column:
    return F.regexp_extract_all(col(c), F.lit(fx.java(pattern, ignore_case)), F.lit(0))


def normal_url(c: Column) -> Column:
    return F.lower(F.rtrim(c, F.lit(fx.URL_TAIL)))


def urls(c: Column | str, limit: int = 1000) -> Column:
    """The first distinct links, in order."""
    return F.slice(F.array_distinct(all_matches(c, fx.URL, True)), 1, limit)


def urls_missing_in(c: Column | str, other: Column | str, limit: int = 20) -> Column:
    """Links of one text that the other lacks, but for signs at the end and letter case. Equal texts, and texts without a link's sign, lack none."""
    known = F.transform(urls(other), normal_url)
    missing = F.slice(F.filter(urls(c), lambda u: ~F.array_contains(known, normal_url(u))), 1, limit)
    return F.when((col(c) == col(other)) | (~F.contains(col(c), F.lit("://")) & col(other).isNotNull()), F.array().cast("array<string>")).otherwise(missing)


def is_ad_line(c: Column | str) -> Column:
    """Whether an advertising pattern matches; the cheap test of their first signs spares most lines the patterns."""
    return F.when(col(c).rlike(fx.AD_SIGN), reduce(lambda a, b: a | b, (col(c).rlike(fx.java(p, True)) for p in fx.ADS))).otherwise(F.lit(False))


#: Line ends of str.splitlines().
LINE_ENDS = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


def split_lines(c: Column | str) -> Column:
    """Lines without their ends; no last empty line."""
    lines = F.split(col(c), LINE_ENDS, -1)
    return F.when(F.element_at(lines, -1) == "", F.slice(lines, F.lit(1), F.size(lines) - 1)).otherwise(lines)


def protected_text(c: Column | str) -> Column:
    """The text without advertising lines, lines joined by \\n."""
    lines = split_lines(c)
    return F.array_join(F.when(col(c).rlike(fx.AD_SIGN), F.filter(lines, lambda line: ~is_ad_line(line))).otherwise(lines), "\n")


def ad_signals(c: Column | str, limit: int = 20) -> Column:
    """Advertising phrases in the order of the patterns, trimmed, at most 100 characters and a mark, distinct."""

    def short(s: Column) -> Column:
        s = py_strip(s)
        return F.when(F.length(s) > 100, F.concat(F.substring(s, 1, 100), F.lit("……"))).otherwise(s)

    found = F.concat(*(F.transform(all_matches(c, p, True), short) for p in fx.ADS))
    some = F.slice(F.array_distinct(F.filter(found, lambda s: s != "")), 1, limit)
    return F.when(col(c).rlike(fx.AD_SIGN), some).otherwise(F.array().cast("array<string>"))


def token_estimate(c: Column | str) -> Column:
    """1.2 for each CJK character, 0.25 for each other, rounded up, 1 at least."""
    cjk = F.regexp_count(col(c), F.lit(fx.CJK)).cast("double")
    other = F.length(col(c)).cast("double") - cjk
    return F.greatest(F.lit(1), F.ceil(cjk * F.lit(1.2) + other / F.lit(4.0))).cast("long")


def has_front_matter(c: Column | str) -> Column:
    return col(c).rlike("(?s)" + fx.FRONT_MATTER.replace(r"\Z", r"\z"))


def compared_output(given: Column | str, reply: Column | str) -> Column:
    """The reply without a front matter that the input has not."""
    bare = F.regexp_replace(col(reply), "(?s)" + fx.FRONT_MATTER.replace(r"\Z", r"\z"), "")
    return F.when(~F.startswith(col(reply), F.lit("---")) | has_front_matter(given), col(reply)).otherwise(bare)


def artifact_status(review: Column | str, strict: Column | str) -> Column:
    return F.when(col(review), "review_required").when(col(strict), "approved_for_ingestion").otherwise("processed")


def progress_percent(done: Column, total: Column) -> Column:
    return F.when(total == 0, F.lit(100)).otherwise(F.floor(done * 100 / total)).cast("long")


def received_size(n: Column | str) -> Column:
    """Bytes as B, KB or MB; null and negative sizes count as none."""
    n = F.greatest(F.coalesce(col(n).cast("long"), F.lit(0)), F.lit(0))
    return F.when(n < 1024, F.concat(n.cast("string"), F.lit(" B"))).when(n < 1024 * 1024, F.format_string("%.1f KB", n / 1024)).otherwise(F.format_string("%.1f MB", n / (1024 * 1024)))


def relative_name(path: Column | str, folder: str) -> Column:
    """A posix path below the folder, or the bare name of a path that lies elsewhere."""
    path, top = col(path), folder.rstrip("/") + "/"
    return F.when(F.startswith(path, F.lit(top)), F.substring(path, F.lit(len(top) + 1), F.length(path))).otherwise(F.regexp_extract(path, r"([^/]*)\z", 1))


def shown_error(c: Column | str, folder: str, limit: int = 240) -> Column:
    """An error for people: secrets masked, one line, neither the folder nor a drive's path in it."""
    text = F.replace(compact_error(c, limit), F.lit(folder), F.lit(fx.SHOWN_FOLDER))
    return F.regexp_replace(text, r"(?i)[A-Z]:[\\/][^\s;，。；]+", fx.SHOWN_PATH)


def with_schema(record: dict[str, Column], schema: str, version: int) -> Column:
    """A struct that names its format and version last."""
    return F.struct(*(c.alias(n) for n, c in record.items()), F.lit(schema).alias("schema"), F.lit(version).alias("schema_version"))


def is_schema(record: Column | str, schema: str, least: int = 1) -> Column:
    """Whether a struct has this format in a version that is new enough; false where either is null."""
    record = col(record)
    return F.coalesce((record["schema"] == schema) & (record["schema_version"] >= least), F.lit(False))
