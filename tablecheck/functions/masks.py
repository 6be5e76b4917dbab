"""Masks for personal data, as Column expressions and as SQL functions.

NULL stays NULL. The SQL functions are plain SQL bodies, so the optimizer
inlines them and no Python worker is started.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecheck.functions.predicates import as_text, full_pattern

# The mobile-number and identity-number formats.
PHONE_PATTERN = r"0?(13|14|15|18|17)[0-9]{9}"
ID_CARD_PATTERN = r"\d{17}[\d|x]|\d{15}"
ID_CARD_PATTERN_UPPER = r"\d{17}[\d|xX]|\d{15}"


def mask_name(c: Column | str) -> Column:
    """Keep the first character, star the rest; a single character stays."""
    text = as_text(c)
    stars = F.repeat(F.lit("*"), F.length(text) - 1)
    return F.when(F.length(text) > 1, F.concat(F.substring(text, 1, 1), stars)).otherwise(text)


def mask_phone(c: Column | str) -> Column:
    """Star characters 4 to 7 of a mobile number, or the digits after the third
    character of any other text."""
    text = as_text(c)
    head = F.substring(text, 1, 3)
    mobile = F.concat(head, F.lit("****"), F.substr(text, F.lit(8)))
    other = F.concat(head, F.regexp_replace(F.substr(text, F.lit(4)), "[0-9]", "*"))
    return (
        F.when(text.rlike(full_pattern(PHONE_PATTERN)), mobile)
        .when(F.length(text) > 3, other)
        .otherwise(text)
    )


def mask_id_card(c: Column | str, accept_upper_x: bool = False) -> Column:
    """Star the birth date of a 15 or 18 character identity number."""
    text = as_text(c)
    pattern = ID_CARD_PATTERN_UPPER if accept_upper_x else ID_CARD_PATTERN
    head = F.substring(text, 1, 6)
    short = F.concat(head, F.lit("*" * 6), F.substr(text, F.lit(13)))
    long = F.concat(head, F.lit("*" * 8), F.substr(text, F.lit(15)))
    masked = F.when(F.length(text) == 15, short).otherwise(long)
    return F.when(text.rlike(full_pattern(pattern)), masked).otherwise(text)


def mask_mail(c: Column | str) -> Column:
    """Star everything before the first ``@``."""
    text = as_text(c)
    at = F.instr(text, "@")
    masked = F.concat(F.repeat(F.lit("*"), at - 1), F.substr(text, at))
    return F.when(at > 0, masked).otherwise(text)


MASKS: dict[str, Callable[[Column | str], Column]] = {
    "name": mask_name,
    "phone": mask_phone,
    "id_card": mask_id_card,
    "mail": mask_mail,
}


def apply_masks(df: DataFrame, masks: Mapping[str, str]) -> DataFrame:
    """Mask columns in place; ``masks`` maps a column to a key of ``MASKS``."""
    unknown = set(masks) - set(df.columns)
    if unknown:
        raise ValueError(f"columns to mask are not in the table: {sorted(unknown)}")
    return df.withColumns({column: MASKS[mask](column) for column, mask in masks.items()})


# SQL names are fixed values: existing export statements call them.
SQL_MASKS = {
    "name_rm_sensitive": """
        CASE WHEN length(x) > 1
             THEN concat(substring(x, 1, 1), repeat('*', length(x) - 1))
             ELSE x END""",
    "phone_rm_sensitive": rf"""
        CASE WHEN x RLIKE r'{full_pattern(PHONE_PATTERN)}'
             THEN concat(substring(x, 1, 3), '****', substring(x, 8))
             WHEN length(x) > 3
             THEN concat(substring(x, 1, 3), regexp_replace(substring(x, 4), '[0-9]', '*'))
             ELSE x END""",
    "cerdID_rm_sensitive": rf"""
        CASE WHEN NOT x RLIKE r'{full_pattern(ID_CARD_PATTERN)}' THEN x
             WHEN length(x) = 15 THEN concat(substring(x, 1, 6), '******', substring(x, 13))
             ELSE concat(substring(x, 1, 6), '********', substring(x, 15)) END""",
    "mail_rm_sensitive": """
        CASE WHEN instr(x, '@') > 0
             THEN concat(repeat('*', instr(x, '@') - 1), substring(x, instr(x, '@')))
             ELSE x END""",
}


def register_sql_masks(spark: SparkSession) -> None:
    """Make the four masks callable from SQL text in this session."""
    for name, body in SQL_MASKS.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(x STRING) RETURNS STRING RETURN {body}"
        )
