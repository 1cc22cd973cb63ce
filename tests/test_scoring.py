"""The fit from summed matrices against a plain solver over all rows."""

from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgermill.plans import scoring
from ledgermill.plans.risk import FEATURES

NOW = datetime(2024, 6, 30)


@pytest.fixture(scope="module")
def loans(spark):
    noise = (F.xxhash64("id", F.lit(1)) % 1000) / 1000
    return spark.range(3000).select(
        F.col("id").alias("loan_id"), F.col("id").alias("customer_id"), (F.col("id") % 5).alias("branch_id"), F.lit("CAR_LOAN").alias("loan_type"),
        (F.abs(F.xxhash64("id")) % 2000000).cast("double").alias("outstanding_balance"),
        (0.08 + (F.col("id") % 11) / 100).alias("interest_rate"),
        (F.abs(F.xxhash64("id", F.lit(2))) % 900000).cast("double").alias("account_balance"),
        (F.abs(F.xxhash64("id", F.lit(3))) % 90000).cast("double").alias("annual_income"),
        F.lit(0.5).alias("loan_to_income_ratio"), noise.alias("noise"),
    ).withColumn("is_default", (F.col("outstanding_balance") / 1e6 + F.col("noise") > 1).cast("int")).drop("noise")


def solver(x, y, mean, spread):
    z = np.hstack([np.ones((len(x), 1)), (x - mean) / spread])
    held = np.diag([0.0] + [scoring.RIDGE] * x.shape[1])
    b = np.zeros(z.shape[1])
    for _ in range(200):
        p = 1 / (1 + np.exp(-z @ b))
        step = np.linalg.solve((z.T * (p * (1 - p))) @ z + held + 1e-12 * np.eye(len(b)), z.T @ (y - p) - held @ b)
        b = b + step
        if np.max(np.abs(step)) < 1e-13:
            break
    return b


def test_fit_agrees_with_a_plain_solver(loans):
    rows = loans.withColumn("fold", scoring.fold_of()).toPandas()
    x, y = rows[FEATURES].to_numpy(float), rows.is_default.to_numpy(float)
    mean, spread = x.mean(axis=0), np.where(x.std(axis=0) > 0, x.std(axis=0), 1.0)
    found = scoring.fit_scorers(loans)
    assert len(found) == scoring.FOLDS + 1
    for fold, scorer in enumerate(found):
        use = (rows.fold != fold).to_numpy()
        b = solver(x[use], y[use], mean, spread)
        got = np.array([scorer.intercept + np.array(scorer.weights) @ mean, *(np.array(scorer.weights) * spread)])
        assert np.max(np.abs(got - b)) < 1e-9


def test_each_loan_is_scored_by_a_model_that_has_not_seen_it(loans):
    scorers = scoring.fit_scorers(loans)
    scored = scoring.score_out_of_fold(loans, scorers, NOW)
    rows = scored.withColumn("fold", scoring.fold_of()).collect()
    assert len(rows) == 3000 and {r.fold for r in rows} == {0, 1, 2}
    source = {r.loan_id: r for r in loans.collect()}
    for r in rows[:200]:
        s = scorers[r.fold]
        odds = s.intercept + sum(w * source[r.loan_id][c] for w, c in zip(s.weights, FEATURES))
        assert r.default_probability == pytest.approx(1 / (1 + np.exp(-odds)), abs=1e-12)
    hits = sum((r.default_probability > 0.5) == source[r.loan_id].is_default for r in rows)
    assert hits / 3000 > 0.7


def test_labels_that_can_be_told_exactly_or_never_vary(loans):
    exact = loans.withColumn("is_default", (F.col("outstanding_balance") > 1000000).cast("int"))
    top = scoring.fit_scorers(exact)[-1]
    assert np.isfinite([top.intercept, *top.weights]).all() and top.weights[0] > 0
    never = loans.withColumn("is_default", F.lit(0))
    worst = scoring.score_out_of_fold(never, scoring.fit_scorers(never), NOW).agg(F.max("default_probability")).first()[0]
    assert worst < 0.01
    with pytest.raises(ValueError):
        scoring.fit_scorers(loans.limit(0))
