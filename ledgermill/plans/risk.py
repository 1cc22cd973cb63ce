"""Loan default scoring with MLlib.

The default label is itself a rule over the features, so accuracy against it is
not a measure of success; bring an ``is_default`` column for a real target.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgermill.functions import bands
from ledgermill.functions.money import safe_ratio
from ledgermill.sources.paths import fresh_folder

FEATURES = [
    "outstanding_balance",
    "interest_rate",
    "account_balance",
    "annual_income",
    "loan_to_income_ratio",
]
UNKNOWN_INCOME_RATIO = 0.5
# Rates may be stored as percent or as a fraction; the threshold is in the unit
# of the data. 12 matches percent data and never fires on fractions.
RATE_LIMIT_PERCENT = 12.0
RATE_LIMIT_FRACTION = 0.12
RATIO_LIMIT = 0.8
BALANCE_LIMIT = 1000000


def default_label(rate_limit: float = RATE_LIMIT_PERCENT) -> Column:
    heavy = (F.col("loan_to_income_ratio") > RATIO_LIMIT) & (F.col("interest_rate") > rate_limit)
    return F.when(heavy, 1).when(F.col("outstanding_balance") > BALANCE_LIMIT, 1).otherwise(0)


def loan_features(
    loans: DataFrame, customers: DataFrame, rate_limit: float = RATE_LIMIT_PERCENT
) -> DataFrame:
    """Loans of known customers with the five features and the label.

    Both sides are projected before the join; missing numbers become zero.
    """
    kept = [
        c
        for c in ("loan_id", "customer_id", "branch_id", "loan_type", "is_default")
        if c in loans.columns
    ]
    numbers = ["outstanding_balance", "interest_rate", "account_balance", "annual_income"]
    left = loans.select(
        *kept, *[F.col(c).try_cast("double").alias(c) for c in numbers[:2]]
    )
    right = customers.select(
        "customer_id", *[F.col(c).try_cast("double").alias(c) for c in numbers[2:]]
    )
    joined = (
        left.join(right, "customer_id", "inner")
        .withColumn(
            "loan_to_income_ratio",
            safe_ratio("outstanding_balance", "annual_income", UNKNOWN_INCOME_RATIO),
        )
        .fillna(0.0, FEATURES)
    )
    if "is_default" in kept:
        return joined
    return joined.withColumn("is_default", default_label(rate_limit))


def fit(features: DataFrame, classifier: Estimator | None = None) -> PipelineModel:
    """Fit assembler and classifier; logistic regression unless one is given.

    The features are best stored first, and then both fitted and scored: every
    iteration reads five columns of Parquet, a lost executor costs a re-read, and
    the join behind the features runs once. The model is saved and loaded again, which drops
    the training summary: the summary holds the session and would be sent to
    every task, and fails there once the session has used an ``Observation``.
    """
    spark: SparkSession = features.sparkSession
    if classifier is None:
        classifier = LogisticRegression(featuresCol="features", labelCol="is_default", maxIter=10)
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    model = Pipeline(stages=[assembler, classifier]).fit(features.select(*FEATURES, "is_default"))
    saved = fresh_folder(spark, "loan-model")
    model.save(saved)
    return PipelineModel.load(saved)


def score(model: PipelineModel, features: DataFrame, run_ts: datetime) -> DataFrame:
    """Default probability and rating of every loan."""
    return (
        model.transform(features)
        .withColumn("default_probability", vector_to_array("probability")[1])
        .select(
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
    )


def threshold_metrics(
    scored: DataFrame, probability: str, label: str, thresholds: Sequence[float], beta: float = 2.0
) -> DataFrame:
    """Precision, recall and F-beta at several thresholds in one pass."""
    positive = F.col(label) == 1
    counts = []
    for i, t in enumerate(thresholds):
        flagged = F.col(probability) >= t
        counts += [
            F.count_if(flagged & positive).alias(f"tp{i}"),
            F.count_if(flagged & ~positive).alias(f"fp{i}"),
            F.count_if(~flagged & positive).alias(f"fn{i}"),
        ]
    rows = F.array(
        *[
            F.struct(
                F.lit(float(t)).alias("threshold"),
                F.col(f"tp{i}").alias("true_positives"),
                F.col(f"fp{i}").alias("false_positives"),
                F.col(f"fn{i}").alias("false_negatives"),
            )
            for i, t in enumerate(thresholds)
        ]
    )
    tp, fp, fn = F.col("true_positives"), F.col("false_positives"), F.col("false_negatives")
    weight = F.lit(beta * beta)
    return (
        scored.agg(*counts)
        .select(F.explode(rows).alias("r"))
        .select("r.*")
        .withColumn("precision", safe_ratio(tp, tp + fp, None))
        .withColumn("recall", safe_ratio(tp, tp + fn, None))
        .withColumn(
            "f_beta", safe_ratio((weight + 1) * tp, (weight + 1) * tp + weight * fn + fp, None)
        )
    )


DRIFT_FLOOR = 0.0001


def drift_index(
    expected: DataFrame, actual: DataFrame, value: str, edges: Sequence[float]
) -> DataFrame:
    """Population stability index of one column over fixed bin edges.

    Each side becomes one row per bin before they meet; an empty bin counts
    with a small share so its logarithm exists.
    """
    def shares(df: DataFrame, name: str) -> DataFrame:
        position = sum((F.col(value) >= e).cast("int") for e in edges)
        counts = (
            df.filter(F.col(value).isNotNull())
            .groupBy(position.alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"))
        )
        total = F.sum("n").over(Window.partitionBy())
        return counts.select("bin", (F.col("n") / total).alias(name))

    both = shares(expected, "expected_share").join(shares(actual, "actual_share"), "bin", "full")
    e = F.greatest(F.coalesce("expected_share", F.lit(0.0)), F.lit(DRIFT_FLOOR))
    a = F.greatest(F.coalesce("actual_share", F.lit(0.0)), F.lit(DRIFT_FLOOR))
    return both.select(
        F.col("bin").cast("bigint").alias("bin"),
        e.alias("expected_share"),
        a.alias("actual_share"),
        ((a - e) * F.ln(a / e)).alias("stability_index"),
    )


def percentile_bounds(df: DataFrame, value: str, cuts: Sequence[float]) -> list[float]:
    """Exact discrete percentiles to use as band bounds: the smallest value whose cumulative
    share reaches each cut, as SQL's percentile_disc; tasks count distinct values before the merge."""
    exact = [
        F.expr(f"percentile_disc({float(cut)!r}) WITHIN GROUP (ORDER BY `{value}`)") for cut in cuts
    ]
    return list(df.agg(*exact).first())
