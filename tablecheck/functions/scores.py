"""Exact quality figures from counts.

All arithmetic is on decimals or longs; a figure is cut, never rounded to the
nearest.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablecheck.functions.predicates import as_column


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def quality_score(legal: Column | str, total: Column | str) -> Column:
    """``legal * 100 / total`` rounded up at 10 decimals, then cut to 2.

    NULL when there are no rows. decimal(38,0) keeps it exact to 10^22 rows.
    """
    n = as_column(total)
    rows = F.when(n > 0, n).cast("decimal(38,0)")
    scaled = as_column(legal).cast("decimal(24,0)") * F.lit(10**12).cast("decimal(13,0)")
    up = _div(scaled.cast("decimal(38,0)") + rows - F.lit(1), rows)
    cut = _div(up, F.lit(10**8).cast("bigint"))
    return (cut.cast("decimal(20,0)") / F.lit(100)).cast("decimal(10,2)").cast("double")


def cut_percent(n: Column | str, total: Column | str) -> Column:
    """``n`` in percent of ``total``, cut to 2 decimals. NULL when there are no rows."""
    rows = as_column(total)
    hundredths = _div(as_column(n) * F.lit(10000).cast("bigint"), F.when(rows > 0, rows))
    return hundredths / F.lit(100.0)
