from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgermill.plans import gold, marts, risk

NOW = datetime(2024, 6, 30)


@pytest.fixture(scope="module")
def tables(spark):
    n = 300
    loans = spark.range(n).select(
        F.col("id").alias("loan_id"), F.col("id").alias("customer_id"), (F.col("id") % 5).alias("branch_id"),
        F.lit("CAR_LOAN").alias("loan_type"), (F.col("id") * 7000.0).alias("outstanding_balance"),
        (0.08 + (F.col("id") % 10) / 100).alias("interest_rate"), F.lit(NOW).alias("updated_timestamp"),
    )
    customers = spark.range(n - 10).select(
        F.col("id").alias("customer_id"), (F.col("id") % 50 * 1000.0).alias("account_balance"),
        F.when(F.col("id") % 7 > 0, F.col("id") % 30 * 10000).cast("int").alias("annual_income"),
        F.lit(NOW).alias("updated_timestamp"),
    )
    return loans, customers


def test_features(tables):
    rows = {r.loan_id: r for r in risk.loan_features(*tables).collect()}
    assert len(rows) == 290  # loans of unknown customers drop out
    assert (rows[7].annual_income, rows[7].loan_to_income_ratio) == (0.0, 0.5)
    assert rows[8].loan_to_income_ratio == 56000.0 / 80000
    assert [rows[i].is_default for i in (142, 143)] == [0, 1]


def test_label_threshold_follows_the_rate_unit(tables):
    loans, customers = tables
    percent = loans.withColumn("interest_rate", F.col("interest_rate") * 100)
    fires = risk.loan_features(percent, customers).agg(F.sum("is_default")).first()[0]
    quiet = risk.loan_features(loans, customers).agg(F.sum("is_default")).first()[0]
    fraction = risk.loan_features(loans, customers, risk.RATE_LIMIT_FRACTION).agg(F.sum("is_default")).first()[0]
    assert fires == fraction > quiet


def test_given_label_is_kept(tables):
    loans, customers = tables
    got = risk.loan_features(loans.withColumn("is_default", F.lit(1)), customers)
    assert got.filter("is_default = 1").count() == 290


def test_scores(tables):
    features = risk.loan_features(*tables)
    scored = risk.score(risk.fit(features), features, NOW).cache()
    assert scored.count() == 290
    assert scored.filter("default_probability < 0 or default_probability > 1").count() == 0
    for r in scored.collect():
        p = r.default_probability
        assert r.risk_rating == ("Low" if p < 0.25 else "Moderate" if p < 0.55 else "High" if p < 0.8 else "Critical")
    ends = scored.orderBy("outstanding_balance").select("default_probability").collect()
    assert ends[0][0] < 0.25 and ends[-1][0] > 0.8
    view = gold.loan_risk_view(scored)
    assert {(r.risk_rating, r.risk_action_recommendation) for r in view.collect()} <= {
        ("Low", "Healthy Credit"), ("Moderate", "Monitor Performance"),
        ("High", "Action Needed: Credit Review"), ("Critical", "Action Needed: Credit Review"),
    }
    reserve = marts.provisions(scored).agg(F.sum("provision"), F.sum("exposed_balance")).first()
    assert reserve[0] == pytest.approx(reserve[1] * 0.15)
    assert marts.interventions(scored).count() == scored.filter("risk_rating in ('High','Critical')").count()


def test_single_class_label_trains(tables):
    loans, customers = tables
    features = risk.loan_features(loans.withColumn("is_default", F.lit(0)), customers)
    top = risk.score(risk.fit(features), features, NOW).agg(F.max("default_probability")).first()[0]
    assert top < 0.01


def test_other_classifier(tables):
    from pyspark.ml.classification import DecisionTreeClassifier

    features = risk.loan_features(*tables)
    tree = DecisionTreeClassifier(featuresCol="features", labelCol="is_default", maxDepth=3)
    scored = risk.score(risk.fit(features, tree), features, NOW)
    assert scored.filter("default_probability between 0 and 1").count() == 290


def test_threshold_metrics(spark):
    df = spark.createDataFrame([(0.9, 1), (0.9, 0), (0.4, 1), (0.1, 0)], "p double, y int")
    got = {r.threshold: r for r in risk.threshold_metrics(df, "p", "y", [0.5, 0.95]).collect()}
    assert (got[0.5].precision, got[0.5].recall) == (0.5, 0.5)
    assert got[0.5].f_beta == pytest.approx(0.5)
    assert (got[0.95].precision, got[0.95].recall) == (None, 0.0)


def test_drift(spark):
    a = spark.createDataFrame([(float(i),) for i in range(10)], "x double")
    same = risk.drift_index(a, a, "x", [3.0, 6.0]).agg(F.sum("stability_index")).first()[0]
    moved = risk.drift_index(a, a.filter("x >= 6"), "x", [3.0, 6.0])
    assert same == pytest.approx(0.0)
    assert moved.count() == 3 and moved.agg(F.sum("stability_index")).first()[0] > 1
    assert risk.percentile_bounds(a, "x", [0.5]) == [4.0]


def test_percentile_bounds_exact_on_many_values(spark):
    # A permutation of 0..30000: a sketch misses the exact ranks by a few places.
    a = spark.range(30001).select(((F.col("id") * 7919) % 30001).cast("double").alias("x"))
    assert risk.percentile_bounds(a, "x", [0.25, 0.75]) == [7500.0, 22500.0]
