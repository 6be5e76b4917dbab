"""Row predicates of the checks, as Column expressions.

Two regex readings are kept apart on purpose: *find* (the pattern occurs
somewhere) decides the counts and the marks, *full match* decides the sample of
illegal rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_text(c: Column | str) -> Column:
    """The value as a string; checks accept columns of any type."""
    return as_column(c).cast("string")


def not_null(c: Column | str) -> Column:
    return as_column(c).isNotNull()


def not_blank(c: Column | str) -> Column:
    """``c != ''``. NULL gives NULL, so NULL rows are in neither row set."""
    return as_text(c) != ""


def null_or_empty(c: Column | str) -> Column:
    """NULL, the empty text, or a lone line end, which ``^$`` finds as well.

    A line end has at most three bytes; longer texts are not decoded for the pattern.
    """
    text = as_text(c)
    return as_column(c).isNull() | ((F.octet_length(text) <= 3) & text.rlike("^$"))


def regex_find(c: Column | str, regex: str) -> Column:
    """The pattern occurs in the text. NULL gives NULL."""
    return as_text(c).rlike(regex)


def full_pattern(regex: str) -> str:
    """A pattern that must cover the whole text, line ends included."""
    return r"\A(?:" + regex + r")\z"


def regex_full(c: Column | str, regex: str, null_text: str | None = None) -> Column:
    """The pattern covers the whole text.

    With ``null_text`` a NULL is matched as that text, else NULL gives NULL.
    """
    text = as_text(c)
    if null_text is not None:
        text = F.coalesce(text, F.lit(null_text))
    return text.rlike(full_pattern(regex))
