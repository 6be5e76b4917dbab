"""Quality rules: base limits, then robust multivariate outliers per language and source.

Each text becomes a vector of transformed statistics. For every group of language and
source the minimum-covariance-determinant estimate is found by concentration steps: the
three quarters of the rows nearest to the last centre (by Mahalanobis distance) give the
next centre and covariance. A row beyond the cutoff is rejected. All steps are
aggregations over a staged table of statistics: no text is read twice, and what a step
hands to the next is one row for each group.

Rules for odd input: NULL text has no words and fails the base limits; rows with NULL
language or source form groups of their own; groups of fewer than ``LEAST_GROUP`` rows
that passed the base limits take the estimate over all rows; repeated rows and ties get
equal verdicts; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecheck.llm.common import staged

WORD_BREAK = r"[ \x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

DIMENSIONS = ("x1", "x2", "x3", "x4", "x5")
#: Added to each variance: below this spread a difference means nothing.
FLOORS = (0.30, 0.08, 0.25, 0.15, 0.15)
KEPT_SHARE = 0.75
STEPS = 4
LEAST_GROUP = 50
#: Squared distance of a rejected row: chi-square with 5 degrees, tail of about 1e-7.
CUTOFF = 42.0
#: Variance of the nearest three quarters of normal data in five dimensions is this much
#: below that of all: share / P(chi-square_7 < quantile of chi-square_5 at the share).
CONSISTENCY = 1.41
#: Estimates of more groups than this are joined by a shuffle.
MOST_BROADCAST = 20_000


def _plus(step: int):
    return lambda x: x + step


def text_statistics(df: DataFrame, text_column: str) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_lines.

    ``n_repeat_words`` sorts the hashes of a text's three-word windows with their places;
    windows next to an equal one are repeats, and their places give the covered words.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    solid = reduce(lambda x, c: F.replace(x, F.lit(c)), " \t\n\v\f\r", F.col("_text"))
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^ \x09-\x0D]"))
    words = F.array_remove(F.split("_text", WORD_BREAK), "")
    df = df.withColumn("_text", text).select(
        "*",
        words.alias("_words"),
        lines.alias("_lines"),
        F.char_length(solid).cast("long").alias("word_chars"),
        (F.char_length("_text") - F.char_length(F.translate("_text", SYMBOLS, "")))
        .cast("long")
        .alias("n_symbols"),
    )
    count = F.size("_words")
    windows = F.transform(
        F.sequence(F.lit(0), count - 3),
        lambda i: F.struct(
            F.xxhash64(
                F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)
            ).alias("hash"),
            i.alias("place"),
        ),
    )
    df = df.select(
        *[c for c in df.columns if c not in ("_text", "_words", "_lines")],
        count.cast("long").alias("n_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(count >= 4, F.sort_array(windows)).alias("_windows"),
    )

    def equal(i: Column, step: int) -> Column:
        other = F.get("_windows", i + step)["hash"]
        return F.coalesce(other == F.get("_windows", i)["hash"], F.lit(False))

    repeated = F.filter(
        F.sequence(F.lit(0), F.size("_windows") - 1), lambda i: equal(i, -1) | equal(i, 1)
    )
    df = df.select(
        *[c for c in df.columns if c != "_windows"],
        F.when(
            F.col("_windows").isNotNull(),
            F.transform(repeated, lambda i: F.get("_windows", i)["place"]),
        ).alias("_places"),
    )
    second, third = (F.transform("_places", _plus(k)) for k in (1, 2))
    covered = F.array_distinct(F.concat("_places", second, third))
    return df.select(
        *[c for c in df.columns if c != "_places"],
        F.when(F.col("_places").isNull(), 0).otherwise(F.size(covered)).cast("long").alias(
            "n_repeat_words"
        ),
    )


def base_failed() -> Column:
    few = F.col("n_words") < LEAST_WORDS
    repeats = 100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    return few | repeats


def vector() -> list[Column]:
    """Transformed statistics; each close to symmetric for ordinary prose."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    lines = F.greatest(F.col("n_lines"), F.lit(1)).cast("double")
    return [
        F.log(words),
        F.log((F.col("word_chars") + 1) / words),
        F.asinh(20.0 * F.col("n_symbols") / words),
        F.sqrt(F.col("n_dup_lines") / lines),
        F.sqrt(F.col("n_repeat_words") / words),
    ]


def _cholesky(estimate: DataFrame) -> DataFrame:
    """Centre and the inverse of the covariance's lower factor, row by row in columns."""
    size = len(DIMENSIONS)
    lower = estimate
    for i in range(size):
        for j in range(i + 1):
            value = F.col(f"s{i}{j}")
            for k in range(j):
                value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            value = F.sqrt(F.greatest(value, F.lit(1e-9))) if i == j else value / F.col(f"l{j}{j}")
            lower = lower.withColumn(f"l{i}{j}", value)
    return lower


def with_distance(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """Adds ``distance`` to rows that carry the columns of an estimate."""
    solved = rows
    names = []
    for i, x in enumerate(DIMENSIONS):
        value = F.col(x) - F.col(f"m{i}")
        for j in range(i):
            value = value - F.col(f"l{i}{j}") * F.col(f"_z{j}")
        solved = solved.withColumn(f"_z{i}", value / F.col(f"l{i}{i}"))
        names.append(f"_z{i}")
    total = reduce(lambda a, b: a + b, [F.col(n) * F.col(n) for n in names])
    extra = [c for c in estimate.columns if c not in ("lang", "source")]
    return solved.withColumn("distance", total).drop(*names, *extra)


def _moments(rows: DataFrame, *keys: str) -> DataFrame:
    """Mean and covariance of each group, from sums around the rows' own centre columns."""
    size = len(DIMENSIONS)
    offsets = [F.col(x) - F.col(f"c{i}") for i, x in enumerate(DIMENSIONS)]
    sums = [F.avg(offsets[i]).alias(f"a{i}") for i in range(size)]
    products = [
        F.avg(offsets[i] * offsets[j]).alias(f"p{i}{j}") for i in range(size) for j in range(i + 1)
    ]
    centres = [F.first(f"c{i}").alias(f"c{i}") for i in range(size)]
    found = rows.groupBy(*keys).agg(F.count("*").alias("rows"), *centres, *sums, *products)
    means = [(F.col(f"c{i}") + F.col(f"a{i}")).alias(f"m{i}") for i in range(size)]
    covariances = [
        (
            F.col(f"p{i}{j}")
            - F.col(f"a{i}") * F.col(f"a{j}")
            + (F.lit(FLOORS[i] ** 2) if i == j else F.lit(0.0))
        ).alias(f"s{i}{j}")
        for i in range(size)
        for j in range(i + 1)
    ]
    return found.select(*keys, "rows", *means, *covariances)


def _joined(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows with the columns of their group; NULL is a group of its own."""
    own = groups.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    side = F.broadcast(own) if groups.count() <= MOST_BROADCAST else own
    return rows.join(side, same).drop("_lang", "_source")


def _start(rows: DataFrame) -> DataFrame:
    """First estimate: medians, and spreads from the middle half, without correlations."""
    quartiles = [
        F.percentile_approx(x, [0.25, 0.5, 0.75], 2000).alias(f"q{i}")
        for i, x in enumerate(DIMENSIONS)
    ]
    found = rows.groupBy("lang", "source").agg(F.count("*").alias("rows"), *quartiles)
    size = len(DIMENSIONS)
    means = [F.col(f"q{i}")[1].alias(f"m{i}") for i in range(size)]
    spread = [((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.35) for i in range(size)]
    factors = [
        (F.sqrt(spread[i] * spread[i] + FLOORS[i] ** 2) if i == j else F.lit(0.0)).alias(f"l{i}{j}")
        for i in range(size)
        for j in range(i + 1)
    ]
    return found.select("lang", "source", "rows", *means, *factors)


def minimum_covariance(rows: DataFrame, steps: int = STEPS, share: float = KEPT_SHARE) -> DataFrame:
    """(lang, source, rows, centre m*, lower factor l*) of each group of ``rows``.

    The nearest ``share`` of a group is cut at an approximate quantile of the distance
    (relative rank error 1/2000), which aggregates in bounded memory however large a
    group is.
    """
    estimate = staged(_start(rows))
    for _ in range(steps):
        near = with_distance(_joined(rows, estimate), estimate)
        limits = near.groupBy("lang", "source").agg(
            F.percentile_approx("distance", share, 2000).alias("limit")
        )
        size = len(DIMENSIONS)
        centres = estimate.select(
            "lang", "source", *[F.col(f"m{i}").alias(f"c{i}") for i in range(size)]
        )
        inner = _joined(near, staged(limits)).where("distance <= limit").drop("limit")
        estimate = staged(_cholesky(_moments(_joined(inner, centres), "lang", "source")))
    return estimate


def judge(df: DataFrame, id_column: str, text_column: str, cutoff: float = CUTOFF) -> DataFrame:
    """Statistics, ``base_failed``, ``distance`` and ``kept`` of every row.

    ``df`` needs the columns ``lang`` and ``source``. The spread within the nearest three
    quarters understates that of the whole group; the factor that makes the estimate
    consistent for normal data is applied to the distance.
    """
    chosen = df.select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text"), "lang", "source"
    )
    counted = text_statistics(chosen, "text").drop("text")
    vectors = counted.select(
        "*", base_failed().alias("base_failed"), *[v.alias(x) for v, x in zip(vector(), DIMENSIONS)]
    )
    rows = staged(vectors)
    passed = rows.where(~F.col("base_failed"))
    own = minimum_covariance(passed).where(F.col("rows") >= LEAST_GROUP * KEPT_SHARE)
    everyone = passed.withColumns({"lang": F.lit("all"), "source": F.lit("all")})
    whole = minimum_covariance(everyone).drop("rows", "lang", "source")
    common = whole.columns
    # one row at most: the estimate over all rows, as literals
    overall = whole.first() or dict.fromkeys(common)
    own = own.drop("rows").withColumnsRenamed({"lang": "_lang", "source": "_source"})
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    side = F.broadcast(own) if own.count() <= MOST_BROADCAST else own
    joined = rows.join(side, same, "left").drop("_lang", "_source")
    joined = joined.withColumns(
        {c: F.coalesce(c, F.lit(overall[c]).cast("double")) for c in common}
    )
    far = with_distance(joined, own.drop("_lang", "_source"))
    distance = F.col("distance") / CONSISTENCY
    outlier = F.coalesce(distance > cutoff, F.lit(False))
    return far.select(
        "id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        distance.alias("distance"), (~F.col("base_failed") & ~outlier).alias("kept"),
    )
