"""A refreshed mart against a full rebuild."""

from ledgermill.plans import marts, monthly, silver
from ledgermill.sources.sinks import overwrite_parquet

SCHEMA = "branch_id string, revenue_type string, amount double, month string"
ROWS = [(f"b{i % 3}", "FEE", i / 4, f"2024-{1 + i % 4:02d}-1{i % 9}") for i in range(200)] + [("b1", "FEE", 1.0, None)]


def facts(spark, rows):
    df = spark.createDataFrame(rows, "branch_id string, revenue_type string, amount double, d string")
    return silver.with_month(df.selectExpr("branch_id", "revenue_type", "amount", "CAST(d AS DATE) AS event_date"), "event_date")


def stored_rows(spark, mart):
    return sorted(map(tuple, monthly.stored_months(spark, mart, SCHEMA).select("branch_id", "revenue_type", "amount", "month").collect()))


def rebuilt(df):
    return sorted(map(tuple, marts.monthly_revenue(df).select("branch_id", "revenue_type", "amount", "month").collect()))


def test_only_changed_months_are_read(spark, tmp_path):
    source, mart = str(tmp_path / "source"), str(tmp_path / "mart")
    overwrite_parquet(facts(spark, ROWS), source, ["month"])
    first = monthly.refresh_months(spark, source, mart, marts.monthly_revenue)
    assert len(first.changed) == 5 and stored_rows(spark, mart) == rebuilt(facts(spark, ROWS))
    assert monthly.refresh_months(spark, source, mart, marts.monthly_revenue) == monthly.Refresh((), (), 5)

    more = [("b0", "FEE", 9.5, "2024-02-03")] + [r for r in ROWS if r[3] and r[3] < "2024-03" and r[3] > "2024-02"]
    overwrite_parquet(facts(spark, more), source, ["month"], only_given_partitions=True)
    seen = []

    def build(df):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        assert {str(r[0])[:7] for r in df.select("event_date").distinct().collect()} == {"2024-02"}
        return marts.monthly_revenue(df)

    second = monthly.refresh_months(spark, source, mart, build)
    assert (second.changed, second.unchanged) == (("2024-02",), 4)
    assert "= 2024-02)], PushedFilters: []" in seen[0] and "PartitionFilters: [isnotnull(month" in seen[0]
    rest = [r for r in ROWS if not (r[3] and "2024-02" < r[3] < "2024-03")]
    assert stored_rows(spark, mart) == rebuilt(facts(spark, rest + more))


def test_months_leave_with_their_rows(spark, tmp_path):
    source, mart = str(tmp_path / "source"), str(tmp_path / "mart")
    overwrite_parquet(facts(spark, ROWS), source, ["month"])
    monthly.refresh_months(spark, source, mart, marts.monthly_revenue)
    kept = [r for r in ROWS if r[3] and r[3] < "2024-02"]
    # One month is gone; of another only a row that has no branch is left.
    overwrite_parquet(facts(spark, [*kept, (None, "FEE", 1.0, "2024-03-01")]), source, ["month"])
    found = monthly.refresh_months(spark, source, mart, marts.monthly_revenue)
    assert "2024-04" in found.removed and "2024-03" in found.changed
    assert stored_rows(spark, mart) == rebuilt(facts(spark, kept))


def test_a_run_that_broke_off_is_made_good(spark, tmp_path):
    source, mart = str(tmp_path / "source"), str(tmp_path / "mart")
    overwrite_parquet(facts(spark, ROWS), source, ["month"])
    now = monthly.month_prints(spark, source)
    half = marts.monthly_revenue(facts(spark, ROWS[:9])).where("month = '2024-01'")
    from pyspark.sql import functions as F

    overwrite_parquet(half.withColumn("print", F.lit(now["2024-01"])), f"{mart}/rows", ["month", "print"])
    monthly.refresh_months(spark, source, mart, marts.monthly_revenue)
    assert stored_rows(spark, mart) == rebuilt(facts(spark, ROWS))
