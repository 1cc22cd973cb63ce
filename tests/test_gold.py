from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgermill.plans import gold, marts

AS_OF = date(2024, 6, 30)


@pytest.fixture(scope="module")
def bank(spark):
    customers = spark.createDataFrame(
        [
            ("c1", "PREMIUM", "Pune", 30, 600000.0, 900000, date(2020, 1, 5)),
            ("c2", "BASIC", "Delhi", 70, 10.0, 100000, date(2020, 1, 9)),
            ("c3", "BASIC", None, None, 20.0, 400000, None),
            ("c4", "BASIC", "Pune", 20, 30.0, 400000, date(2020, 2, 1)),
        ],
        "customer_id string, customer_segment string, city string, age int, account_balance double,"
        "annual_income int, customer_since date",
    )
    revenue = spark.createDataFrame(
        [
            ("r1", "c1", "b1", "LATE_FEE", 100.10, date(2024, 1, 5)),
            ("r2", "c1", "b1", "INTEREST_INCOME", 100.20, date(2024, 2, 5)),
            ("r3", "c2", "b2", "LATE_FEE", 0.0, date(2024, 1, 6)),
            ("r4", "c3", "b2", "OTHER", 10.0, date(2024, 3, 6)),
            ("r5", "c3", "b3", "LATE_FEE", 50.0, None),
        ],
        "revenue_id string, customer_id string, branch_id string, revenue_type string, amount double,"
        "event_date date",
    )
    costs = spark.createDataFrame(
        [("k1", "b1", "MARKETING", 60.0, date(2024, 1, 9)), ("k2", "b2", "MARKETING", 20.0, date(2024, 1, 9)),
         ("k3", "b9", "MARKETING", 20.0, date(2024, 4, 9))],
        "cost_id string, branch_id string, cost_category string, amount double, cost_date date",
    )
    transactions = spark.createDataFrame(
        [("t1", "c1", "b1", 10.0, "DEPOSIT"), ("t2", "c1", "b1", 5.0, "PURCHASE"), ("t3", "c2", "b1", 7.0, "TRANSFER"),
         (None, "c2", "b1", 7.0, "PAYMENT")],
        "transaction_id string, customer_id string, branch_id string, amount double, transaction_type string",
    ).withColumn("is_credit", F.col("transaction_type").isin("DEPOSIT", "TRANSFER")).withColumn(
        "is_debit", ~F.col("is_credit")
    )
    branches = spark.createDataFrame(
        [("b1", "Main", "Pune", "WEST", 10), ("b2", "East", "Delhi", "NORTH", 0), ("b4", "Idle", "Agra", None, 5)],
        "branch_id string, branch_name string, city string, region string, staff_count int",
    )
    loans = spark.createDataFrame(
        [("l1", "c1", "b1", 100.0, 90.0, 0.10, "ACTIVE"), ("l2", "c2", "b1", 100.0, 80.0, 0.13, "ACTIVE"),
         ("l3", "c3", "b1", 100.0, 10.0, 0.5, "CLOSED"), ("l4", "c3", "b2", 0.0, 10.0, 0.11, "ACTIVE")],
        "loan_id string, customer_id string, branch_id string, loan_amount double, outstanding_balance double,"
        "interest_rate double, status string",
    ).withColumns({"loan_type": F.lit("CAR_LOAN"), "start_date": F.lit(date(2024, 1, 1))})
    return dict(customers=customers, revenue=revenue, costs=costs, transactions=transactions, branches=branches, loans=loans)


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_customers_without_activity_keep_unknown_profit(bank):
    mart = by(gold.customer_profitability(bank["customers"], bank["revenue"], bank["transactions"], AS_OF), "customer_id")
    assert mart["c1"].total_revenue == 200.3
    assert mart["c1"].estimated_costs == 10.0
    assert mart["c1"].profit_margin == pytest.approx(190.3 / 200.3)
    assert (mart["c2"].total_revenue, mart["c2"].net_profit, mart["c2"].profit_margin) == (0.0, -5.0, 0.0)
    assert (mart["c3"].estimated_costs, mart["c3"].net_profit, mart["c3"].profit_margin) == (None, None, None)
    assert (mart["c4"].total_revenue, mart["c4"].net_profit, mart["c4"].profit_margin) == (0.0, None, 0.0)
    assert mart["c1"].kpi_date == AS_OF


def test_missing_as_zero_and_kept_columns(bank):
    mart = by(
        gold.customer_profitability(
            bank["customers"], bank["revenue"], bank["transactions"], AS_OF, missing_as_zero=True, keep=["city"]
        ),
        "customer_id",
    )
    assert (mart["c3"].net_profit, mart["c3"].profit_margin) == (60.0, 1.0)
    assert mart["c1"].city == "Pune"


def test_activity(bank):
    got = by(gold.customer_activity(bank["transactions"]), "customer_id")
    assert tuple(got["c1"]) == ("c1", 10.0, 5.0, 2)
    assert tuple(got["c2"]) == ("c2", 7.0, 7.0, 1)


def test_branch_drivers_and_guards(bank):
    mart = by(gold.branch_performance(bank["revenue"], bank["costs"], bank["transactions"], AS_OF), "branch_id")
    assert set(mart) == {"b1", "b2", "b3"}
    assert (mart["b1"].total_revenue, mart["b1"].total_costs, mart["b1"].transaction_per_staff) == (200.3, 60.0, 3 / 20)
    assert mart["b2"].cost_income_ratio == 2.0
    assert (mart["b3"].total_costs, mart["b3"].cost_income_ratio) == (0.0, 0.0)
    assert (mart["b3"].transaction_count, mart["b3"].transaction_per_staff) == (None, 0.0)
    every = by(
        gold.branch_performance(
            bank["revenue"], bank["costs"], bank["transactions"], AS_OF,
            branches=bank["branches"], all_branches=True, staff_from_dimension=True,
        ),
        "branch_id",
    )
    assert set(every) == {"b1", "b2", "b4"}
    assert every["b1"].transaction_per_staff == 0.3
    assert (every["b4"].total_revenue, every["b4"].cost_income_ratio) == (0.0, 0.0)
    with pytest.raises(ValueError):
        gold.branch_performance(bank["revenue"], bank["costs"], bank["transactions"], AS_OF, all_branches=True)


def test_throughput_rounds_half_up(spark):
    mart = spark.createDataFrame([(108,), (86400,), (None,)], "transaction_count bigint").withColumns(
        {c: F.lit(1.0) for c in ("total_revenue", "total_costs", "net_income", "cost_income_ratio", "transaction_per_staff")}
    ).withColumns({"branch_id": F.lit("b"), "kpi_date": F.lit(AS_OF)})
    got = [r[0] for r in gold.branch_throughput(mart).select(F.col("avg_transactions_per_second").cast("double")).collect()]
    assert got == [0.0013, 1.0, None]


def test_loan_portfolio_counts_active_only(bank):
    view = by(gold.loan_portfolio_view(gold.loan_portfolio(bank["loans"], AS_OF)), "branch_id")
    assert (view["b1"].active_loans, view["b1"].avg_interest_rate, view["b1"].utilization_rate) == (2, 0.115, 0.85)
    assert view["b1"].rate_category == "Medium Rate"
    assert view["b2"].utilization_rate == 0.0


def test_summary(bank):
    customers = gold.customer_profitability(bank["customers"], bank["revenue"], bank["transactions"], AS_OF)
    got = gold.summary_kpis(customers, gold.loan_portfolio(bank["loans"], AS_OF)).first()
    assert (got.total_customers, got.total_revenue, got.total_loan_portfolio) == (4, 260.3, 200.0)
    assert got.avg_profit_margin == pytest.approx((190.3 / 200.3) / 3, abs=1e-9)


def test_fallback_matches_the_mart(bank):
    fallback = by(gold.branch_ratio_from_entities(bank["branches"], bank["revenue"], bank["costs"]), "branch_id")
    mart = by(gold.branch_performance(bank["revenue"], bank["costs"], bank["transactions"], AS_OF), "branch_id")
    assert fallback["b1"].cost_income_ratio == mart["b1"].cost_income_ratio
    assert fallback["b4"].cost_income_ratio == 0.0


def test_monthly_totals_survive_the_rollup(bank):
    revenue, costs = marts.monthly_revenue(bank["revenue"]), marts.monthly_costs(bank["costs"])
    assert revenue.filter("month is null").count() == 0
    trend = by(marts.monthly_trend(revenue, costs), "month")
    assert set(trend) == {"2024-01"}  # months on one side only drop out
    assert (trend["2024-01"].amount_rev, trend["2024-01"].amount_cost) == (100.1, 80.0)


def test_rows_without_a_branch_belong_to_no_month(spark):
    rows = [("r", None, "LATE_FEE", 5.0, date(2024, 1, 1)), ("s", "b", "LATE_FEE", 7.0, date(2024, 1, 1))]
    df = spark.createDataFrame(rows, "revenue_id string, branch_id string, revenue_type string, amount double, event_date date")
    assert [r.amount for r in marts.monthly_revenue(df).collect()] == [7.0]


def test_ratio_matrix(bank):
    revenue, costs = marts.monthly_revenue(bank["revenue"]), marts.monthly_costs(bank["costs"])
    mart = gold.branch_performance(bank["revenue"], bank["costs"], bank["transactions"], AS_OF)
    long = marts.branch_month_ratio(revenue, costs, mart, 2)
    wide = by(marts.ratio_matrix(long, ["2024-01", "2024-02"]), "branch_id")
    assert set(wide) == {"b1"}  # b3 has no dated revenue, b2 is third by revenue
    assert wide["b1"]["2024-01"] == pytest.approx(60 / 100.1)
    assert wide["b1"]["2024-02"] is None


def test_product_labels(bank):
    got = by(marts.product_contribution(marts.monthly_revenue(bank["revenue"])), "revenue_type")
    assert got["LATE_FEE"].product == "Investments Portal"
    assert got["OTHER"].product is None


def test_customer_views(bank):
    from datetime import datetime

    from ledgermill.plans.silver import silver_customers

    people = silver_customers(bank["customers"], datetime(2024, 1, 1))
    mart = gold.customer_profitability(bank["customers"], bank["revenue"], bank["transactions"], AS_OF)
    details = marts.customer_details(mart, people)
    kept = gold.customer_profitability(
        people, bank["revenue"], bank["transactions"], AS_OF, keep=marts.CUSTOMER_ATTRIBUTES
    )
    same = [c for c in kept.columns]
    assert sorted(map(str, details.select(same).collect())) == sorted(map(str, kept.collect()))
    mix = {(r.dimension, r.category): r.row_count for r in marts.category_mix(details).collect()}
    assert mix[("value_tier", "High Value")] == 1
    assert mix[("age_group", "65+")] == 2
    cohort = by(marts.cohort_profit(details), "cohort_month")
    assert set(cohort) == {"2020-01", "2020-02"}
    assert cohort["2020-01"].customer_count == 2
    assert cohort["2020-01"].avg_profit == pytest.approx((190.3 - 5) / 2)
    assert [r.customer_id for r in marts.top_customers(details, 2).collect()] == ["c1", "c2"]
    head = marts.customer_headline(details).first()
    assert (head.total_customers, head.high_value_customers) == (4, 1)


def test_alerts(bank):
    mart = gold.customer_profitability(bank["customers"], bank["revenue"], bank["transactions"], AS_OF)
    view = gold.branch_performance_view(
        gold.branch_performance(bank["revenue"], bank["costs"], bank["transactions"], AS_OF)
    )
    loans = gold.loan_portfolio_view(gold.loan_portfolio(bank["loans"], AS_OF))
    raised = marts.alerts(marts.branch_with_details(view, bank["branches"]), mart, loans, bank["branches"])
    got = {(r.alert, r.subject_id) for r in raised.collect()}
    assert got == {
        ("HIGH_COST_RATIO", "b2"), ("LOW_PRODUCTIVITY", "b1"), ("LOW_PRODUCTIVITY", "b2"),
        ("LOW_PRODUCTIVITY", "b3"), ("NEGATIVE_PROFIT", "c2"), ("HIGH_UTILIZATION", "b1"),
    }


def test_drilldown_without_loans_keeps_the_branch(bank):
    view = gold.branch_performance_view(
        gold.branch_performance(bank["revenue"], bank["costs"], bank["transactions"], AS_OF)
    )
    loans = gold.loan_portfolio_view(gold.loan_portfolio(bank["loans"], AS_OF))
    details = marts.branch_with_details(view, bank["branches"])
    assert marts.branch_drilldown(details, loans, "b3").first().utilization_rate is None
    assert marts.branch_drilldown(details, loans, "b1").first().utilization_rate == 0.85


def test_histogram_keeps_the_highest_rate_in_the_last_bin(spark):
    loans = spark.createDataFrame([(r / 100, "ACTIVE") for r in range(0, 13)] + [(9.0, "CLOSED")], "interest_rate double, status string")
    got = by(marts.rate_histogram(loans), "bin")
    assert sum(r.loan_count for r in got.values()) == 13
    assert got[12].highest_rate == 0.12 and max(got) == 12
    flat = spark.createDataFrame([(0.1, "ACTIVE")] * 3, "interest_rate double, status string")
    assert [(r.bin, r.loan_count) for r in marts.rate_histogram(flat).collect()] == [(1, 3)]


def test_extras(spark):
    txns = spark.createDataFrame(
        [("t1", "c1", "b1", 10.0, "USD", date(2024, 1, 1)), ("t2", "c1", "b1", 10.0, "INR", date(2024, 1, 1)),
         ("t3", "c1", "b1", 10.0, "USD", date(2024, 1, 2))],
        "transaction_id string, customer_id string, branch_id string, amount double, currency string, transaction_date date",
    )
    rates = spark.createDataFrame([("USD", date(2024, 1, 1), 80.5)], "currency string, rate_date date, rate double")
    got = by(marts.to_home_currency(txns, rates), "transaction_id")
    assert (got["t1"].amount_home, got["t2"].amount_home, got["t3"].amount_home) == (805.0, 10.0, None)
