"""A third of the rows on one key, against brute force in plain Python."""

from collections import Counter, defaultdict
from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgermill.operators import integrity, quality, ranking
from ledgermill.plans import gold, marts

ROWS = 6000


@pytest.fixture(scope="module")
def facts(spark):
    rows = [
        (i, -1 if i % 3 == 0 else i % 400, "hot" if i % 3 == 0 else f"b{i % 40}", (i % 997) / 4, date(2024, 1 + i % 3, 1))
        for i in range(ROWS)
    ]
    df = spark.createDataFrame(
        rows, "revenue_id int, customer_id int, branch_id string, amount double, event_date date"
    ).repartition(8)
    return rows, df


@pytest.fixture(autouse=True)
def shuffled_joins(spark):
    """Joins as on a cluster: nothing small enough to broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_customer_totals(spark, facts):
    rows, df = facts
    customers = spark.createDataFrame([(i, "BASIC") for i in range(-1, 450)], "customer_id int, customer_segment string")
    transactions = df.withColumnRenamed("revenue_id", "transaction_id")
    got = {
        r.customer_id: (r.total_revenue, r.estimated_costs)
        for r in gold.customer_profitability(customers, df, transactions, date(2024, 1, 1)).collect()
    }
    total, count = defaultdict(float), Counter()
    for _, c, _, a, _ in rows:
        total[c] += a
        count[c] += 1
    assert got == {c: (total.get(c, 0.0), count[c] * 5.0 if c in count else None) for c in range(-1, 450)}


def test_orphans_and_reference_rule(spark, facts):
    rows, df = facts
    parents = spark.createDataFrame([(f"b{i}",) for i in range(0, 40, 2)], "branch_id string")
    known = {f"b{i}" for i in range(0, 40, 2)}
    want = Counter(b for _, _, b, _, _ in rows if b not in known)
    assert {r.branch_id: r.row_count for r in integrity.orphan_keys(df, "branch_id", parents).collect()} == want
    assert integrity.orphan_rows(df, "branch_id", parents).count() == sum(want.values())
    flagged = quality.with_reference_check(df, "branch_id", parents, "branch_id", "known")
    assert flagged.count() == ROWS and flagged.filter("not known").count() == sum(want.values())


def test_copies_of_one_row(spark, facts):
    rows, df = facts
    narrow = df.select("customer_id", "branch_id")
    want = ROWS - len({(c, b) for _, c, b, _, _ in rows})
    assert integrity.duplicate_rows(narrow).first().failures == want
    report = {
        (r.check, r.subject): r.failures
        for r in integrity.integrity_report(
            {"revenue": df.unionByName(df.filter("branch_id = 'hot'")), "branches": spark.createDataFrame([("hot",)], "branch_id string")}
        ).collect()
    }
    hot = sum(r[2] == "hot" for r in rows)
    assert report[("duplicate_rows", "revenue")] == report[("repeated_keys", "revenue")] == hot
    assert report[("orphans", "revenue.branch_id")] == ROWS - hot
    assert report[("duplicate_rows", "branches")] == 0


def test_first_row_and_top(facts):
    rows, df = facts
    first = {}
    for i, c, *_ in rows:
        first.setdefault(c, i)
    assert {r.customer_id: r.revenue_id for r in ranking.first_per_key(df, "customer_id", ["revenue_id"]).collect()} == first
    best = sorted(rows, key=lambda r: (-r[3], r[0]))[:20]
    assert [r.revenue_id for r in ranking.top_n(df, "amount", "revenue_id", 20).collect()] == [r[0] for r in best]


def test_monthly_rollup(facts):
    rows, df = facts
    monthly = marts.monthly_revenue(df.withColumn("revenue_type", F.lit("LATE_FEE")))
    got = {(r.branch_id, r.month): r.amount for r in monthly.collect()}
    want = defaultdict(float)
    for _, _, b, a, d in rows:
        want[(b, d.strftime("%Y-%m"))] += a
    assert got == want


def test_shuffled_joins_split_at_the_hot_key(spark):
    confs = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    old = {key: spark.conf.get(key, None) for key in confs}
    for key, value in confs.items():
        spark.conf.set(key, value)
    try:
        i = F.col("id")
        facts = spark.range(0, 60000, 1, 6).select(
            i.alias("loan_id"), F.when(i % 3 == 0, -1).otherwise(i % 2000).alias("customer_id"),
            F.xxhash64("id").cast("double").alias("outstanding_balance"), F.lit(0.1).alias("interest_rate"),
        )
        parents = spark.range(-1, 1500).select(
            i.alias("customer_id"), F.lit(1.0).alias("account_balance"), F.lit(1).alias("annual_income")
        )
        from ledgermill.plans.risk import loan_features

        for df in (
            integrity.orphan_rows(facts, "customer_id", parents.filter("customer_id > 5")),
            quality.with_reference_check(facts, "customer_id", parents, "customer_id", "known"),
            loan_features(facts, parents),
        ):
            used = df.agg(F.sum(F.hash(*df.columns).cast("bigint")))
            used.collect()
            assert "SortMergeJoin(skew=true)" in used._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
