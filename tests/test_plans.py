"""What the planner makes of the operators that must survive large inputs."""

import pytest
from pyspark.sql import functions as F

from ledgermill.drivertables import BankTables
from ledgermill.operators import integrity, quality, ranking
from ledgermill.plans import gold, marts
from ledgermill.session import shuffle_partitions
from ledgermill.verification.queries import AS_OF


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def bank(spark, small_dir):
    return BankTables(spark, small_dir)


def test_filters_and_columns_reach_the_scan(spark, bank, tmp_path):
    path = str(tmp_path / "loans")
    bank.loans.write.parquet(path)
    text = plan(gold.loan_portfolio(spark.read.parquet(path), AS_OF))
    assert "EqualTo(status,ACTIVE)" in text
    scan = text.split("ReadSchema:")[1]
    assert "loan_type" not in scan and "customer_id" not in scan
    customers = str(tmp_path / "customers")
    bank.customers.write.parquet(customers)
    kept = quality.valid_rows(spark.read.parquet(customers), quality.GATES["customers"])
    assert "GreaterThanOrEqual(account_balance,0" in plan(kept)


def test_facts_are_combined_before_every_shuffle(bank):
    text = plan(gold.branch_performance(bank.revenue_lines, bank.costs, bank.transactions, AS_OF))
    assert text.count("partial_sum") == 2 and text.count("partial_count") == 1
    assert "l_quantity" not in text and "o_orderkey" not in text


def test_unused_credit_sums_are_pruned(bank):
    text = plan(gold.customer_profitability(bank.customers, bank.revenue, bank.transactions, AS_OF))
    assert "event_type" not in text


def test_first_row_is_limited_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    text = plan(ranking.first_per_key(df, "k", ["id"]))
    assert text.index("row_number(), 1, Final") < text.index("Exchange") < text.index("row_number(), 1, Partial")


def test_top_n_is_a_bounded_heap(bank):
    text = plan(ranking.top_n(bank.loans, "outstanding_balance", "loan_id", 15))
    assert "TakeOrderedAndProject(limit=15" in text and "Exchange" not in text


def test_top_and_bottom_share_their_facts(bank):
    view = gold.branch_performance_view(
        gold.branch_performance(bank.revenue_lines, bank.costs, bank.transactions, AS_OF)
    )
    details = marts.branch_with_details(view, bank.branches)
    text = final_plan(marts.top_bottom_branches(details))
    assert text.count("ReusedExchange") >= 3


def test_duplicate_check_shuffles_no_whole_rows(spark, bank):
    copies = bank.costs.select("branch_id", "cost_category")
    text = final_plan(integrity.duplicate_rows(copies))
    assert "BroadcastHashJoin" in text and "LeftSemi" in text and "SortMergeJoin" not in text
    clean = final_plan(integrity.duplicate_rows(bank.loans))
    assert "Join" not in clean  # no repeated fingerprint, nothing to compare


def test_one_exchange_per_customer_input(spark, bank):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(gold.customer_profitability(bank.customers, bank.revenue, bank.transactions, AS_OF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert text.count("Exchange hashpartitioning(customer_id") == 3


def test_session_settings(spark):
    from ledgermill.session import build_session, object_store_conf

    session = build_session("tests", conf={"spark.sql.shuffle.partitions": "4"})
    assert session.conf.get("spark.sql.ansi.enabled") == "true"
    assert session.conf.get("spark.sql.sources.partitionOverwriteMode") == "dynamic"
    assert session.conf.get("spark.sql.session.timeZone") == "UTC"
    assert object_store_conf("http://store:1")["spark.hadoop.fs.s3a.path.style.access"] == "true"


def test_shuffle_sizing():
    assert shuffle_partitions(0) == 200
    assert shuffle_partitions(10 * 2**40) == 52429
