"""Quality reports of reply and source pairs, and the gate."""

from __future__ import annotations

import hashlib
import json
import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed as fx
from ..functions import text as tx
from ..functions.compare import compared

LONG_INPUT = 200


def load_thresholds(env: dict[str, str] | None = None) -> dict[str, float]:
    """Thresholds with overrides from QUALITY_<NAME> variables: 0 to 10, and in order."""
    env, out = os.environ if env is None else env, {}
    for name, default in fx.THRESHOLDS.items():
        raw = (env.get(f"QUALITY_{name.upper()}") or "").strip()
        try:
            value = float(raw) if raw else default
        except ValueError:
            raise ValueError(f"{name} is no number: {raw}") from None
        if not 0 <= value <= 10:
            raise ValueError(f"{name} must lie between 0 and 10: {value}")
        out[name] = value
    if not out["severe_min_retained_ratio"] <= out["warning_min_retained_ratio"] <= out["review_min_retained_ratio"]:
        raise ValueError("the retained ratios must ascend: severe, warning, review")
    if out["warning_max_expansion_ratio"] > out["severe_max_expansion_ratio"]:
        raise ValueError("the expansion ratios must ascend: warning, severe")
    return out


def policy_sha256(thresholds: dict[str, float]) -> str:
    return hashlib.sha256(json.dumps({"version": fx.POLICY_VERSION, **thresholds}, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def retained(given: Column | str, reply: Column | str) -> Column:
    n, m = F.length(tx.col(given)).cast("double"), F.length(tx.col(reply)).cast("double")
    return F.when(n > 0, m / n).otherwise(F.lit(1.0))


def band(ratio: Column, n_input: Column, t: dict[str, float], kind: str) -> Column:
    """severe, warning, review or ok by length; `kind` is retained (too low) or expansion (too high)."""
    if kind == "retained":
        cases = [(ratio < t["severe_min_retained_ratio"], "severe"), (ratio < t["warning_min_retained_ratio"], "warning"), (ratio < t["review_min_retained_ratio"], "review")]
    else:
        cases = [(ratio > t["severe_max_expansion_ratio"], "severe"), (ratio > t["warning_max_expansion_ratio"], "warning")]
    out = F.when(n_input < LONG_INPUT, "ok")
    for condition, name in cases:
        out = out.when(condition, name)
    return out.otherwise("ok")


def lost(before: Column, after: Column, least: int, share: float) -> Column:
    """Whether a count fell under a share of what it was, where there was enough of it."""
    return (before >= least) & (after < before * F.lit(share))


COUNTS = {"headings": tx.heading_count, "questions": tx.question_count, "numbers": tx.number_count, "urls": tx.url_count, "tables": tx.table_count}


def counted(df: DataFrame, given: str, reply: str) -> DataFrame:
    """Both texts' counts; a reply that equals its source is not counted again."""
    x = df.withColumns({f"input_{name}": f(given) for name, f in COUNTS.items()})
    return x.withColumns({f"output_{name}": F.when(F.col(given) == F.col(reply), F.col(f"input_{name}")).otherwise(f(reply)) for name, f in COUNTS.items()})


def _said(rules: list[tuple[Column, str]]) -> Column:
    return F.filter(F.array(*(F.when(condition, F.lit(text)) for condition, text in rules)), lambda m: m.isNotNull())


def assess(df: DataFrame, given: str = "input_text", reply: str = "output_text", thresholds: dict[str, float] | None = None, name: str = "quality", joined: bool = False) -> DataFrame:
    """Add a struct of 23 report fields. Null texts count as empty. joined: replies are documents joined of pieces, whose seams are no changes.

    Counts, added links and bands are native; one Arrow UDF gives what needs the texts without ad lines, NFKC, match offsets or exact rounding.
    """
    t = thresholds or load_thresholds()
    own = df.columns
    x = df.withColumns({"in_": F.coalesce(given, F.lit("")), "out_": F.coalesce(reply, F.lit(""))})
    x = x.withColumn("seen_", tx.compared_output("in_", "out_"))
    x = counted(x, "in_", "out_").withColumns({
        "c_": compared("in_", "out_", F.when(F.col("seen_") != F.col("out_"), F.col("seen_")), F.lit(joined)),
        "added_": tx.urls_missing_in("seen_", "in_"),
        "n_": F.length("in_"),
        "r_": retained("in_", "out_"),
    })
    x = x.withColumns({"removed_": F.col("c_.removed_urls"), "ads_": F.col("c_.ad_signals")})
    n, r = F.col("n_"), F.col("r_")
    kept, grown = band(r, n, t, "retained"), band(r, n, t, "expansion")
    percent = lambda key: f"{t[key]:.0%}"
    severe = _said([
        (F.col("c_.changed"), fx.SAYS["values"]),
        ((n >= LONG_INPUT) & (F.col("c_.anchors") < 0.35), fx.SAYS["anchors"]),
        (kept == "severe", fx.SAYS["kept_severe"].format(percent("severe_min_retained_ratio"))),
        (grown == "severe", fx.SAYS["grown_severe"].format(percent("severe_max_expansion_ratio"))),
    ])
    fewer = lambda what, least: lost(F.col(f"input_{what}"), F.col(f"output_{what}"), least, t[f"{what[:-1]}_retained_ratio"])
    warnings = _said([
        (kept == "warning", fx.SAYS["kept_warning"].format(percent("warning_min_retained_ratio"))),
        (kept == "review", fx.SAYS["kept_review"].format(percent("review_min_retained_ratio"))),
        (grown == "warning", fx.SAYS["grown_warning"].format(percent("warning_max_expansion_ratio"))),
        (fewer("headings", 3), fx.SAYS["headings"]),
        (fewer("questions", 3), fx.SAYS["questions"]),
        (fewer("numbers", 20), fx.SAYS["numbers"]),
        (fewer("tables", 2), fx.SAYS["tables"]),
        (F.size("added_") > 0, fx.SAYS["urls_added"]),
        (F.size("removed_") > 0, fx.SAYS["urls_removed"]),
        (F.size("ads_") > 0, fx.SAYS["ads"]),
    ])
    x = x.withColumns({"severe_": severe, "warn_": warnings})
    c = F.col
    report = F.struct(
        n.alias("input_chars"), F.length("out_").alias("output_chars"), c("c_.kept").alias("retained_ratio"), c("c_.removed").alias("removed_ratio"), c("c_.grown").alias("expansion_ratio"),
        c("input_headings"), c("output_headings"), c("input_questions"), c("output_questions"), c("input_numbers"), c("output_numbers"),
        c("c_.changed").alias("protected_values_changed"), c("input_urls"), c("output_urls"), c("added_").alias("added_urls"), c("removed_").alias("removed_urls"),
        c("c_.anchors_shown").alias("protected_anchor_ratio"), c("input_tables"), c("output_tables"), c("ads_").alias("remaining_ad_signals"),
        c("warn_").alias("warnings"), c("severe_").alias("severe_errors"), ((F.size("warn_") > 0) | (F.size("severe_") > 0)).alias("review_required"),
    )
    return x.select(*own, report.alias(name))
