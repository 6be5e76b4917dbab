"""Quality classifier by positive-unlabelled learning.

A linear model over text statistics is trained from trusted positives and unlabelled
text, which is all learnable text as it comes, whatever labels some or all of it has. The
class prior of the unlabelled text is estimated first; the training minimises the
non-negative unbiased risk

    prior * R(positives as +) + max(0, R(unlabelled as -) - prior * R(positives as -))

with the logistic loss, by full-batch steps on a bounded sample of rows. Labels, language,
source and identifier are never inputs of a score.

Rules for odd input: NULL text is empty and gets a score too; a document whose labels
contradict each other is no positive; without any positive every score is nearly 1; a
table that is labelled throughout, and a small one, are learnt from like any other; rows
that repeat an identifier are all learnt from or all not; rows with a NULL identifier are
scored and never learnt from; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of each kind (positive, unlabelled) that a fit uses at most, chosen by a hash.
FIT_ROWS = 15_000
HELD_OUT_OF = 3
HELD_OUT = 1
STEPS = 800
RATE = 0.05
PENALTY = 1e-4
#: Share of the positives that the region for the estimate of the prior holds at least.
PRIOR_SHARE = 0.3

# The characters that count as signs.
SIGNS = "#*$%&|<>"


def _share(part: float, whole: float) -> float:
    return part / whole if whole else 0.0


def text_features(text: str | None) -> list[float]:
    """Figures about one text: words, letters, signs, repetition."""
    text = text or ""
    words = text.split()
    count, length = len(words), len(text)
    lines = [x for x in text.split("\n") if x.strip()]
    distinct = len(set(words))
    same_next = sum(map(str.__eq__, words, words[1:]))
    triples = max(count - 2, 0)
    distinct_triples = len(set(zip(words, words[1:], words[2:])))
    upper = sum(map(str.isupper, words))
    signs = sum(map(text.count, SIGNS))
    # words that end a sentence
    stops = text.count(". ") + text.count(".\n") + text.endswith(".")
    return [
        np.log1p(count),
        np.log1p(_share(length, count)),
        _share(distinct, count),
        _share(same_next, count),
        _share(distinct_triples, triples) if triples else 1.0,
        _share(upper, count),
        np.arcsinh(20 * _share(signs, count)),
        np.arcsinh(20 * _share(text.count("|"), count)),
        np.arcsinh(20 * _share(text.count("!"), count)),
        np.arcsinh(20 * _share(text.count("?"), count)),
        np.arcsinh(10 * _share(stops, count)),
        np.arcsinh(10 * _share(text.count(","), count)),
        1.0 - _share(len(set(lines)), len(lines)) if lines else 0.0,
        np.log1p(_share(count, len(lines))),
        np.arcsinh(20 * _share(sum(map(text.count, "0123456789")), count)),
        float(count < 5),
    ]


N_FEATURES = len(text_features(""))


@dataclass(frozen=True)
class Model:
    """Scores are ``sigmoid(weights . expanded features + bias)``."""

    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def expand(self, features: np.ndarray) -> np.ndarray:
        z = np.clip((features - self.centre) / self.spread, -8, 8)
        return np.hstack([z, np.abs(z), z * z / 8])

    def score(self, features: np.ndarray) -> np.ndarray:
        x = self.expand(features) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _descend(gradient, size: int) -> np.ndarray:
    """Adam from zero; the steps are fixed, so equal data give equal weights."""
    weights, first, second = (np.zeros(size) for _ in range(3))
    for step in range(1, STEPS + 1):
        g = gradient(weights)
        first = 0.9 * first + 0.1 * g
        second = 0.999 * second + 0.001 * g * g
        unbiased = first / (1 - 0.9**step), second / (1 - 0.999**step)
        weights -= RATE * unbiased[0] / (np.sqrt(unbiased[1]) + 1e-8)
    return weights


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled, from scores that tell the two apart.

    Above any limit the unlabelled share is at least prior times the positive share; the
    quotient at the limit where it is smallest, with a margin for chance, is the estimate.
    """
    limits = np.quantile(positive, np.linspace(0, 1 - PRIOR_SHARE, 71))
    of_positive = np.array([(positive >= x).mean() for x in limits])
    of_unlabelled = np.array([(unlabelled >= x).mean() for x in limits])
    margin = np.sqrt(0.25 / len(positive)) + np.sqrt(0.25 / len(unlabelled))
    best = np.argmin((of_unlabelled + margin) / of_positive)
    return float(np.clip(of_unlabelled[best] / of_positive[best], 0.05, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray) -> Model:
    """Model from the features of trusted positives and of unlabelled texts."""
    size = N_FEATURES
    if not len(positive) or not len(unlabelled):
        prior = 1.0
        bias = 30.0
        return Model(np.zeros(size), np.ones(size), np.zeros(3 * size), bias, prior)
    centre = np.median(positive, axis=0)
    spread = np.maximum(positive.std(axis=0), 0.05)
    plain = Model(centre, spread, np.zeros(3 * size), 0.0, 0.5)
    p = np.hstack([plain.expand(positive), np.ones((len(positive), 1))])
    u = np.hstack([plain.expand(unlabelled), np.ones((len(unlabelled), 1))])

    penalty = max(PENALTY, 1 / len(p), 1 / len(u))
    # every row is scored by the half it was not part of
    seen = np.empty(len(p)), np.empty(len(u))
    for half in range(2):
        p0, u0 = p[half::2], u[half::2]

        def apart(w: np.ndarray, p0=p0, u0=u0) -> np.ndarray:
            """Gradient of the plain logistic loss, positives against unlabelled."""
            of_p = p0.T @ (_sigmoid(p0 @ w) - 1) / max(len(p0), 1)
            return of_p + u0.T @ _sigmoid(u0 @ w) / max(len(u0), 1) + 2 * penalty * w

        w = _descend(apart, 3 * size + 1)
        seen[0][1 - half :: 2], seen[1][1 - half :: 2] = p[1 - half :: 2] @ w, u[1 - half :: 2] @ w
    prior = estimate_prior(*seen)

    def risk(w: np.ndarray) -> np.ndarray:
        """Gradient of the non-negative risk: the part for negatives counts while it is above
        zero, so few rows cannot push it below by giving up the positives."""
        xp, xu = p @ w, u @ w
        sp, su = _sigmoid(xp), _sigmoid(xu)
        negative = np.logaddexp(0, xu).mean() - prior * np.logaddexp(0, xp).mean()
        of_negative = u.T @ su / len(u) - prior * (p.T @ sp) / len(p)
        of_positive = prior * (p.T @ (sp - 1)) / len(p) + 2 * penalty * w
        return of_positive + of_negative if negative > 0 else of_positive

    w = _descend(risk, 3 * size + 1)
    return Model(centre, spread, w[:-1], float(w[-1]), prior)


def held_out(id_column: str):
    """Rows that are never learnt from: crc32 of the identifier's text leaves 1 by 3."""
    of_text = F.crc32(F.col(id_column).cast("string").cast("binary"))
    return F.coalesce(of_text % HELD_OUT_OF == HELD_OUT, F.lit(False))


def _features(df: DataFrame, text_column: str) -> np.ndarray:
    """Features of a bounded number of rows, on the driver."""
    names = [f"f{i}" for i in range(N_FEATURES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([text_features(x) for x in batch.column(0).to_pylist()])
            columns = [pa.array(x) for x in found.reshape(-1, N_FEATURES).T]
            yield pa.RecordBatch.from_arrays(columns, names)

    chosen = df.select(F.col(text_column).alias("text"))
    rows = chosen.mapInArrow(run, ", ".join(f"{x} double" for x in names)).toPandas()
    rows = rows.sort_values(names)  # sums do not depend on the order of arrival
    return rows.to_numpy(dtype=float).reshape(-1, N_FEATURES)


def train(
    documents: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    fit_rows: int = FIT_ROWS,
) -> Model:
    """Fit on at most ``fit_rows`` positives and as many unlabelled rows.

    Both samples are the rows with the smallest hashes of the identifier, outside the
    held-out part; only their texts are read.
    """
    own = labels.where(F.col(id_column).isNotNull() & F.col(label_column).isNotNull())
    marks = own.groupBy(id_column).agg(
        F.min(label_column).alias("least"), F.max(label_column).alias("most")
    )
    marks = marks.withColumnRenamed(id_column, "marked_id")
    known = documents.select(F.col(id_column).alias("id")).where(
        F.col("id").isNotNull() & ~held_out("id")
    )
    joined = known.distinct().join(marks, F.col("id") == F.col("marked_id"), "left")
    order = F.xxhash64("id", F.lit("fit"))
    positive = joined.where("least = 1").orderBy(order, "id").limit(fit_rows)
    # the web as it comes, whatever marks some of it has: a table may be marked throughout
    unlabelled = joined.orderBy(order, "id").limit(fit_rows)
    samples = []
    for sample in (positive, unlabelled):
        # at most ``fit_rows`` identifiers
        ids = F.broadcast(sample.select(F.col("id").alias(id_column)))
        samples.append(_features(documents.join(ids, id_column, "left_semi"), text_column))
    return fit(*samples)


def score(df: DataFrame, text_column: str, model: Model, name: str = "score") -> DataFrame:
    """All columns of ``df`` and its score in a column ``name`` that ``df`` does not have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_column)).to_pylist()
            found = np.array([text_features(x) for x in texts]).reshape(-1, N_FEATURES)
            columns = [*batch.columns, pa.array(model.score(found), pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, name])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields]
    return df.mapInArrow(run, ", ".join([*kinds, f"`{name}` double"]))
