"""Counting checks: one pass over the table, partial aggregation before any shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecheck.functions import predicates as P
from tablecheck.functions.scores import cut_percent, quality_score
from tablecheck.rules import Rule


def row_count(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("total"))


def _two_way(df: DataFrame, legal: Column, by: Sequence[str]) -> DataFrame:
    counts = df.groupBy(*by).agg(
        F.count("*").alias("total"),
        F.count_if(legal).alias("legal"),
    )
    return counts.select(
        *by,
        "total",
        "legal",
        (F.col("total") - F.col("legal")).alias("illegal"),
        quality_score("legal", "total").alias("score"),
    )


def null_check(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Total, legal (not NULL), illegal, score."""
    return _two_way(df, P.not_null(column), by)


def blank_check(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Total, legal (``!= ''``), illegal, score.

    Illegal is ``total - legal``, so it counts NULL rows too, although these are
    in neither row set of the check.
    """
    return _two_way(df, P.not_blank(column), by)


REGEX_COLUMNS = ("total", "legal", "null_or_empty", "illegal", "illegal_strict", "score")


def _regex_columns() -> list[Column]:
    # A pattern that matches '' makes a row both legal and empty. ``illegal``
    # subtracts it twice (and may fall below zero); ``illegal_strict`` does not.
    illegal = F.col("total") - F.col("legal") - F.col("null_or_empty")
    return [
        F.col("total"),
        F.col("legal"),
        F.col("null_or_empty"),
        illegal.alias("illegal"),
        (illegal + F.col("_both")).alias("illegal_strict"),
        quality_score("legal", "total").alias("score"),
    ]


def regex_check(
    df: DataFrame, column: str, regex: str, by: Sequence[str] = (), mode: str = "find"
) -> DataFrame:
    """Total, legal, NULL or empty, illegal and score of one column."""
    rule = Rule(column, regex=regex, mode=mode)
    return multi_rule_check(df, [rule], by).select(*by, *REGEX_COLUMNS)


def rule_counts(rules: Sequence[Rule]) -> list[Column]:
    """The aggregates that the results of ``rules`` are made of."""
    if not rules:
        raise ValueError("no rules")
    if len({r.label for r in rules}) < len(rules):
        raise ValueError("rule names must differ")
    counts = [F.count("*").alias("total")]
    for i, rule in enumerate(rules):
        legal, empty = rule.legal(), rule.empty()
        counts += [
            F.count_if(legal).alias(f"legal_{i}"),
            F.count_if(empty).alias(f"empty_{i}"),
            # ``empty`` first: the regex runs a second time on empty rows only
            F.count_if(empty & F.coalesce(legal, F.lit(False))).alias(f"both_{i}"),
        ]
    return counts


def rule_results(counted: DataFrame, rules: Sequence[Rule], by: Sequence[str] = ()) -> DataFrame:
    """One result row per rule for each row of ``rule_counts``."""
    rows = [
        F.struct(
            F.lit(rule.label).alias("rule"),
            F.lit(rule.column).alias("column_name"),
            F.col(f"legal_{i}").alias("legal"),
            F.col(f"empty_{i}").alias("null_or_empty"),
            F.col(f"both_{i}").alias("_both"),
        )
        for i, rule in enumerate(rules)
    ]
    per_rule = counted.select(*by, "total", F.inline(F.array(*rows)))
    return per_rule.select(*by, "rule", "column_name", *_regex_columns())


def multi_rule_check(
    df: DataFrame, rules: Sequence[Rule], by: Sequence[str] = ()
) -> DataFrame:
    """All rules in one scan; one result row per rule (and group)."""
    return rule_results(df.groupBy(*by).agg(*rule_counts(rules)), rules, by)


def illegal_full_match_count(df: DataFrame, column: str, regex: str) -> DataFrame:
    """Rows the sample is drawn from: no full match, NULL read as ``null``."""
    legal = P.regex_full(column, regex, null_text="null")
    return df.agg(F.count_if(~legal).alias("illegal_full"))


# Fixed values of the macro table: validity flag, label and source count.
MACRO_ROWS = (
    ("0", "不合格", "illegal"),
    ("1", "合格", "legal"),
    ("0", "空", "null_or_empty"),
)


def macro_summary(check: DataFrame, task_name: str, job_id: str, check_time: str) -> DataFrame:
    """Three rows (illegal, legal, empty) per row of a ``regex_check`` result."""
    rows = [
        F.struct(
            F.lit(task_name).alias("taskname"),
            F.lit(job_id).alias("jobId"),
            F.lit(flag).alias("isvalid"),
            F.lit(label).alias("checktype"),
            F.col(source).alias("Count"),
            cut_percent(source, "total").alias("percent"),
            F.to_timestamp(F.lit(check_time), "yyyy-MM-dd HH:mm:ss").alias("Checktime"),
        )
        for flag, label, source in MACRO_ROWS
    ]
    return check.select(F.inline(F.array(*rows)))
