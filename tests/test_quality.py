from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgermill.operators import integrity, quality

NOW = datetime(2024, 1, 1)
ROWS = [(1, 5.0), (2, -1.0), (3, None), (None, None), (None, 7.0)]


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(ROWS, "customer_id int, account_balance double")


def test_gate_loses_no_row(people):
    valid, rejected = quality.split(people, quality.GATES["customers"], NOW)
    assert [tuple(r) for r in valid.collect()] == [(1, 5.0)]
    reasons = {(r.customer_id, r.account_balance): sorted(r.violations) for r in rejected.collect()}
    negative, missing = "account_balance is negative", "customer_id is missing"
    assert reasons == {
        (2, -1.0): [negative],
        (3, None): [negative],
        (None, None): [negative, missing],
        (None, 7.0): [missing],
    }
    assert {r.quarantine_entity for r in rejected.collect()} == {"customers"}
    counts = quality.gate_counts(people, quality.GATES["customers"]).first()
    assert (counts.valid_rows, counts.rejected_rows) == (1, 4)


def test_gate_write_counts_and_keeps_each_run(spark, people, tmp_path):
    """A run repeated replaces its own rejects; another run adds its own."""
    paths = str(tmp_path / "valid"), str(tmp_path / "bad")
    for run, kept in ((NOW, 4), (NOW, 4), (NOW.replace(day=2), 8)):
        outcome = quality.write_gated(people, quality.GATES["customers"], *paths, run)
        assert (outcome.valid_rows, outcome.rejected_rows) == (1, 4)
        assert spark.read.parquet(paths[0]).count() == 1
        assert spark.read.parquet(paths[1]).count() == kept


def test_clean_input_writes_no_quarantine(spark, people, tmp_path):
    outcome = quality.write_gated(
        people.filter("customer_id = 1"), quality.GATES["customers"],
        str(tmp_path / "valid"), str(tmp_path / "bad"), NOW,
    )
    assert outcome.rejected_rows == 0
    assert not (tmp_path / "bad").exists()


def test_missing_key_column_is_an_error(people):
    with pytest.raises(ValueError):
        quality.valid_rows(people.drop("customer_id"), quality.GATES["customers"])


def test_loan_gate_limits(spark):
    loans = spark.createDataFrame(
        [(1, 1, 0.0), (2, 1, 30.0), (3, 1, 30.1), (4, 1, -0.1), (5, 1, None)],
        "loan_id int, customer_id int, interest_rate double",
    )
    kept = quality.valid_rows(loans, quality.GATES["loans"]).collect()
    assert [r.loan_id for r in kept] == [1, 2]
    assert quality.valid_rows(loans, quality.loan_gate(0.3)).count() == 1


def test_reference_rule(spark):
    child = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "transaction_id int, branch_id string")
    parent = spark.createDataFrame([("a",), ("a",)], "branch_id string")
    flagged = quality.with_reference_check(child, "branch_id", parent, "branch_id", "known")
    assert {r.transaction_id: r.known for r in flagged.collect()} == {1: True, 2: False, 3: False}


def test_duplicates_count_nulls_and_hot_copies(spark):
    rows = [("x", None)] * 500 + [(None, "x")] * 2 + [("y", "z"), (None, None), (None, None)]
    df = spark.createDataFrame(rows, "a string, b string").repartition(5)
    assert integrity.duplicate_rows(df).first().failures == 499 + 1 + 1
    assert integrity.duplicate_rows(df.filter("a = 'y'")).first().failures == 0
    assert integrity.duplicate_rows(df.limit(0)).first().failures == 0


def test_keys_and_orphans(spark):
    child = spark.createDataFrame([(1, 10), (2, 10), (2, 99), (3, None)], "id int, k int")
    parent = spark.createDataFrame([(10,)], "k int")
    summary = integrity.surplus_keys(child, "id").first()
    assert (summary.row_count, summary.distinct_keys, summary.failures) == (4, 3, 1)
    assert [tuple(r) for r in integrity.repeated_keys(child, "id").collect()] == [(2, 2)]
    assert {tuple(r) for r in integrity.orphan_keys(child, "k", parent).collect()} == {(99, 1), (None, 1)}
    assert integrity.orphan_rows(child, "k", parent).count() == 2


def test_source_overlap(spark):
    entities = spark.createDataFrame([("P_1",), ("P_2",), ("Q_1",)], "customer_id string")
    raw = spark.createDataFrame([("1",), ("1",), ("7",)], "CustomerID string")
    got = integrity.source_overlap(entities, "customer_id", raw, "CustomerID", "P_").first()
    assert (got.matching, got.total) == (1, 3)


def test_layer_assertions(spark):
    good = spark.createDataFrame([(1, 0.0)], "customer_id int, account_balance double")
    bad = spark.createDataFrame([(1, -1.0), (1, None)], "customer_id int, account_balance double")
    txns = spark.createDataFrame([(1, 5.0)], "transaction_id int, amount double")
    assert all(r.failures == 0 for r in integrity.layer_assertions(good, txns).collect())
    failing = {r.check: r.failures for r in integrity.layer_assertions(bad, txns.limit(0)).collect()}
    assert failing == {
        "customers not empty": 0,
        "customer_id unique": 1,
        "account_balance not negative": 2,
        "transactions not empty": 1,
        "amount positive": 0,
    }


def test_layer_counts(spark):
    got = integrity.layer_counts({"a": spark.range(3), "b": spark.range(0)}).collect()
    assert {(r.layer, r.row_count) for r in got} == {("a", 3), ("b", 0)}


def test_broken_rows_include_null(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "x double")
    assert integrity.broken_rows(df, F.col("x") > 0).count() == 1
