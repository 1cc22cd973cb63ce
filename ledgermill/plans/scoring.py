"""Loan scores by logistic regression from summed matrices, each loan by a model that has not seen it.

A Newton step needs the gradient and the 6 x 6 matrix of second derivatives, both
sums over rows, so a round is one aggregate. The models that each leave out one
fold, and the one over all rows, are fitted in the same rounds.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions import bands
from ledgermill.plans.risk import FEATURES

FOLDS = 3
#: Weight of the squared standardized coefficients; keeps them finite where the label can be told exactly.
RIDGE = 1.0
TOLERANCE = 1e-10
MOST_ROUNDS = 60


@dataclass(frozen=True)
class Scorer:
    """Intercept and weights on the scale of the features."""

    intercept: float
    weights: tuple[float, ...]

    def log_odds(self) -> Column:
        total = F.lit(self.intercept)
        for name, weight in zip(FEATURES, self.weights, strict=True):
            total = total + F.col(name) * F.lit(weight)
        return total

    def probability(self) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.log_odds()))


def fold_of(key: str = "loan_id", folds: int = FOLDS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(folds)).cast("int")


@dataclass
class _Fit:
    """The state of one model: accepted point, step on trial."""

    point: np.ndarray
    step: np.ndarray
    loss: float = np.inf
    done: bool = False

    @property
    def trial(self) -> np.ndarray:
        return self.point + self.step

    def take(self, loss: float, gradient: np.ndarray, curvature: np.ndarray, ridge: float) -> None:
        """Accept the trial and choose the next step, or halve the step if the loss rose."""
        size = len(self.point)
        held = np.full(size, ridge)
        held[0] = 0.0
        trial = self.trial
        loss += 0.5 * float(held @ trial**2)
        if loss > self.loss + 1e-9 * abs(self.loss) and np.max(np.abs(self.step)) > TOLERANCE:
            self.step = self.step / 2
            return
        self.point, self.loss = trial, loss
        # A hair of ridge on the intercept, for a label that never varies.
        matrix = curvature + np.diag(np.maximum(held, 1e-9))
        self.step = np.linalg.solve(matrix, gradient - held * trial)
        self.done = bool(np.max(np.abs(self.step)) < TOLERANCE)


def fit_scorers(
    features: DataFrame, folds: int = FOLDS, ridge: float = RIDGE, key: str = "loan_id"
) -> list[Scorer]:
    """A model for each fold, fitted on the rows outside it, and last the one over all rows.

    The features are best stored first: each round reads five columns and the
    label. What comes to the driver is 28 sums for each model and round. Raises
    if there is no row.
    """
    moments = features.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(c).alias(f"m_{c}") for c in FEATURES],
        *[F.stddev_pop(c).alias(f"s_{c}") for c in FEATURES],
    ).first()
    if not moments["n"]:
        raise ValueError("no loans to fit on")
    mean = np.array([moments[f"m_{c}"] for c in FEATURES])
    spread = np.array([moments[f"s_{c}"] or 1.0 for c in FEATURES])
    size = len(FEATURES) + 1
    names = [f"x{j}" for j in range(size)]
    scaled = [
        ((F.col(c) - F.lit(float(mean[j]))) / F.lit(float(spread[j]))).alias(f"x{j + 1}")
        for j, c in enumerate(FEATURES)
    ]
    label = F.col("is_default").cast("double").alias("y")
    rows = features.select(fold_of(key, folds).alias("fold"), label, F.lit(1.0).alias("x0"), *scaled)
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    fits = [_Fit(np.zeros(size), np.zeros(size)) for _ in range(folds + 1)]
    for _ in range(MOST_ROUNDS):
        open_fits = [m for m, f in enumerate(fits) if not f.done]
        if not open_fits:
            break
        models = F.array(
            *[
                F.struct(F.lit(m).alias("model"), F.array(*[F.lit(float(b)) for b in fits[m].trial]).alias("b"))
                for m in open_fits
            ]
        )
        each = rows.withColumn("m", F.explode(models)).where(F.col("fold") != F.col("m.model"))
        score = sum((F.col("m.b")[j] * F.col(names[j]) for j in range(1, size)), F.col("m.b")[0])
        each = each.withColumn("z", score).withColumn("p", F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("z"))))
        # log(1 + exp(z)) - y z, without overflow.
        loss = F.greatest(F.col("z"), F.lit(0.0)) + F.log1p(F.exp(-F.abs("z"))) - F.col("y") * F.col("z")
        weight = F.col("p") * (F.lit(1.0) - F.col("p"))
        sums = each.groupBy(F.col("m.model").alias("model")).agg(
            F.sum(loss).alias("loss"),
            *[F.sum((F.col("y") - F.col("p")) * F.col(names[j])).alias(f"g{j}") for j in range(size)],
            *[F.sum(weight * F.col(names[i]) * F.col(names[j])).alias(f"h{i}_{j}") for i, j in pairs],
        )
        found = {row["model"]: row for row in sums.collect()}
        for m in open_fits:
            if m not in found:  # every row is in the fold that is left out
                fits[m].done = True
                continue
            row, curvature = found[m], np.zeros((size, size))
            for i, j in pairs:
                curvature[i, j] = curvature[j, i] = row[f"h{i}_{j}"]
            fits[m].take(row["loss"], np.array([row[f"g{j}"] for j in range(size)]), curvature, ridge)
    out = []
    for fit in fits:
        weights = fit.point[1:] / spread
        out.append(Scorer(float(fit.point[0] - weights @ mean), tuple(map(float, weights))))
    return out


def scored(features: DataFrame, probability: Column, run_ts: datetime) -> DataFrame:
    """Loans with a default probability and its rating, in the shape of the score table."""
    return features.withColumn("default_probability", probability).select(
        "loan_id",
        "customer_id",
        "branch_id",
        "loan_type",
        "outstanding_balance",
        "interest_rate",
        "annual_income",
        "loan_to_income_ratio",
        "default_probability",
        bands.risk_rating().alias("risk_rating"),
        F.lit(run_ts).alias("ml_evaluated_at"),
    )


def score_out_of_fold(
    features: DataFrame, scorers: Sequence[Scorer], run_ts: datetime, key: str = "loan_id"
) -> DataFrame:
    """Every loan by the model of its fold; ``scorers`` are those of ``fit_scorers``."""
    folds = len(scorers) - 1
    chosen = F.lit(None).cast("double")
    for fold in range(folds):
        chosen = F.when(fold_of(key, folds) == fold, scorers[fold].probability()).otherwise(chosen)
    return scored(features, chosen, run_ts)
