"""Linear regression job: split, fit, tuned fit, scoring.

The tuned fit reads its rows once. All that a linear model with any penalty needs of them is
their moments: count, sums, and sums of products of the columns (the Gram matrix). They are
aggregated for the fitting and the validation part, and added for both. From them all settings
of the grid are solved by coordinate descent and judged, on numbers whose count depends on the
number of columns only. The optimum is the one that Spark's solver approaches; with the job's
ten iterations that one may stop before it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations_with_replacement, product

import numpy as np
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit, TrainValidationSplitModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the regression job.
SPLIT_SEED = 12345
TRAIN_SHARE = 0.9
MAX_ITERATIONS = 10
REG_PARAMS = (0.1, 0.01)
ELASTIC_NET_PARAMS = (0.0, 0.5, 1.0)
VALIDATION_TRAIN_RATIO = 0.8
PARALLELISM = 2

#: Seed of the part of the training rows that judges the settings.
VALIDATION_SEED = SPLIT_SEED + 1
#: Sweeps of coordinate descent end when no coefficient moves more than this.
TOLERANCE = 1e-13
MOST_SWEEPS = 10_000

_SLOTS = 1_000_000


def split_slot(key: Sequence[str], seed: int = SPLIT_SEED) -> Column:
    """A number in [0, 1) that depends on the key and the seed only."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key])
    head = F.substring(F.md5(text.cast("binary")), 1, 12)
    return F.conv(head, 16, 10).cast("bigint") % _SLOTS / F.lit(_SLOTS)


def split_by_key(
    df: DataFrame, key: str | Sequence[str], train: float = TRAIN_SHARE, seed: int = SPLIT_SEED
) -> tuple[DataFrame, DataFrame]:
    """Random split that does not change when a task or the job is run again."""
    keys = [key] if isinstance(key, str) else list(key)
    slot = split_slot(keys, seed)
    return df.where(slot < train), df.where(slot >= train)


def with_features(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Add the ``features`` vector and a double ``label``."""
    assembler = VectorAssembler(inputCols=list(columns), outputCol="features")
    return assembler.transform(df.withColumn("label", F.col(label).cast("double")))


def fit_linear(training: DataFrame, max_iter: int = MAX_ITERATIONS) -> LinearRegressionModel:
    return LinearRegression(maxIter=max_iter).fit(training)


def tuner(
    max_iter: int = MAX_ITERATIONS, seed: int = SPLIT_SEED, parallelism: int = PARALLELISM
) -> TrainValidationSplit:
    """The grid of 12 settings, judged by RMSE on a fifth of the training rows.

    ``parallelism`` fits run side by side; it does not change the result.
    """
    regression = LinearRegression(maxIter=max_iter)
    grid = (
        ParamGridBuilder()
        .addGrid(regression.regParam, list(REG_PARAMS))
        .addGrid(regression.fitIntercept, [False, True])
        .addGrid(regression.elasticNetParam, list(ELASTIC_NET_PARAMS))
        .build()
    )
    return TrainValidationSplit(
        estimator=regression,
        estimatorParamMaps=grid,
        evaluator=RegressionEvaluator(),
        trainRatio=VALIDATION_TRAIN_RATIO,
        parallelism=parallelism,
        seed=seed,
    )


def fit_tuned(
    training: DataFrame, max_iter: int = MAX_ITERATIONS, parallelism: int = PARALLELISM
) -> TrainValidationSplitModel:
    return tuner(max_iter, parallelism=parallelism).fit(training)


def score(model, test: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return model.transform(test).select(*keep, "features", "label", "prediction")


@dataclass(frozen=True)
class Moments:
    """Count of some rows, sums and sums of products of their columns, the label last."""

    count: float
    sums: np.ndarray
    products: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        return Moments(
            self.count + other.count, self.sums + other.sums, self.products + other.products
        )


@dataclass(frozen=True)
class Setting:
    """A point of the grid."""

    reg_param: float
    fit_intercept: bool
    elastic_net: float


@dataclass(frozen=True)
class LinearModel:
    coefficients: tuple[float, ...]
    intercept: float

    def predict(self, columns: Sequence[str]) -> Column:
        """The prediction as an expression of the named columns."""
        terms = [F.lit(b) * F.col(c) for b, c in zip(self.coefficients, columns)]
        total = terms[0]
        for term in (*terms[1:], F.lit(self.intercept)):
            total = total + term
        return total


@dataclass(frozen=True)
class Tuned:
    """The winner of a grid, fitted on all training rows, and how every setting did."""

    setting: Setting
    model: LinearModel
    errors: tuple[tuple[Setting, float], ...]


GRID = tuple(
    Setting(*values) for values in product(REG_PARAMS, (False, True), ELASTIC_NET_PARAMS)
)


def moments_by_part(
    df: DataFrame, columns: Sequence[str], label: str, part: Column
) -> dict[object, Moments]:
    """The moments of each part, in one scan with partial aggregation. Rows with a NULL in any
    of the columns are left out."""
    names = [*columns, label]
    values = [F.col(c).cast("double") for c in names]
    pairs = list(combinations_with_replacement(range(len(names)), 2))
    whole = df.select(part.alias("_part"), *[v.alias(f"_{i}") for i, v in enumerate(values)])
    found = (
        whole.dropna(subset=[f"_{i}" for i in range(len(names))])
        .groupBy("_part")
        .agg(
            F.count("*").alias("n"),
            *[F.sum(f"_{i}").alias(f"s{i}") for i in range(len(names))],
            *[F.sum(F.col(f"_{i}") * F.col(f"_{j}")).alias(f"p{i}_{j}") for i, j in pairs],
        )
    )
    parts = {}
    for row in found.collect():  # one row for each part
        products = np.zeros((len(names), len(names)))
        for i, j in pairs:
            products[i, j] = products[j, i] = row[f"p{i}_{j}"]
        sums = np.array([row[f"s{i}"] for i in range(len(names))])
        parts[row["_part"]] = Moments(float(row["n"]), sums, products)
    return parts


def solve(moments: Moments, setting: Setting) -> LinearModel:
    """Least squares with an elastic net penalty on standardised columns and label."""
    n, mean = moments.count, moments.sums / moments.count
    second = moments.products / n
    centred = second - np.outer(mean, mean)
    spread = np.sqrt(np.clip(np.diag(centred), 0, None))
    used = spread[:-1] > 0
    gram = (centred if setting.fit_intercept else second) / np.outer(
        np.where(spread > 0, spread, 1), np.where(spread > 0, spread, 1)
    )
    size = len(used)
    beta = np.zeros(size)
    if spread[-1] > 0:
        penalty = setting.reg_param / spread[-1]
        lasso, ridge = penalty * setting.elastic_net, penalty * (1 - setting.elastic_net)
        for _ in range(MOST_SWEEPS):
            moved = 0.0
            for j in range(size):
                if not used[j]:
                    continue
                rest = gram[j, -1] - gram[j, :size] @ beta + gram[j, j] * beta[j]
                new = np.sign(rest) * max(abs(rest) - lasso, 0.0) / (gram[j, j] + ridge)
                moved, beta[j] = max(moved, abs(new - beta[j])), new
            if moved <= TOLERANCE:
                break
    coefficients = beta * spread[-1] / np.where(used, spread[:-1], 1)
    intercept = mean[-1] - mean[:-1] @ coefficients if setting.fit_intercept else 0.0
    return LinearModel(tuple(map(float, coefficients)), float(intercept))


def rmse(moments: Moments, model: LinearModel) -> float:
    """Root of the mean squared error of a model on the rows of the moments."""
    weights = np.r_[np.array(model.coefficients), -1.0]
    total = (
        weights @ moments.products @ weights
        + 2 * model.intercept * (weights @ moments.sums)
        + moments.count * model.intercept**2
    )
    return float(np.sqrt(max(total, 0.0) / moments.count))


def tune(
    training: DataFrame,
    columns: Sequence[str],
    label: str,
    key: str | Sequence[str],
    grid: Sequence[Setting] = GRID,
) -> Tuned:
    """The best setting by RMSE on a fifth of the training rows, and its model on all of them.

    Which rows judge depends on key and seed only. Of equal errors the earlier setting wins.
    """
    keys = [key] if isinstance(key, str) else list(key)
    fits = split_slot(keys, VALIDATION_SEED) < VALIDATION_TRAIN_RATIO
    parts = moments_by_part(training, columns, label, fits)
    if set(parts) != {True, False}:
        raise ValueError("too few rows to fit and to judge")
    errors = [(s, rmse(parts[False], solve(parts[True], s))) for s in grid]
    best = min(errors, key=lambda e: e[1])[0]
    return Tuned(best, solve(parts[True] + parts[False], best), tuple(errors))
