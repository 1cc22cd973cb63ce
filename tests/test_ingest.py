from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgermill.operators.cascade import BANK_REFERENCES
from ledgermill.plans import integrate, jobs
from ledgermill.schemas import CORRUPT, WAREHOUSE
from ledgermill.sources import files, sinks, warehouse
from ledgermill.sources.resolve import resolve_table

AS_OF = date(2024, 6, 30)
NOW = datetime(2024, 6, 30, 8, 0)

RAW = """TransactionID,CustomerID,CustomerDOB,CustGender,CustLocation,CustAccountBalance,TransactionDate,TransactionTime,TransactionAmount (INR)
T1,C1,5/8/94,F,NAVI MUMBAI,600000,2/8/16,143207,25
T2,C2,1/1/1800,male,MUMBAI,150000.5,3/8/16,143207,-600
T3,C1,5/8/94,F,DELHI,1,4/8/16,143207,0
T4,C3,nan,,o'neil-town,,31/2/90,143207,27999
T5,,5/8/49,M,,abc,,143207,459.03
"""


@pytest.fixture(scope="module")
def raw_file(tmp_path_factory):
    path = tmp_path_factory.mktemp("raw") / "raw.csv"
    path.write_text(RAW)
    return str(path)


def test_clean_raw(spark, raw_file):
    got = {r.transaction_id: r for r in integrate.clean_raw(files.raw_lines(files.read_raw(spark, raw_file)), AS_OF).collect()}
    assert got["T1"].customer_id == "KAGGLE_C1" and got["T5"].customer_id == "KAGGLE_UNKNOWN"
    assert (got["T1"].age, got["T1"].age_imputed, got["T1"].city) == (29, False, "Navi Mumbai")
    assert got["T2"].date_of_birth is None and got["T2"].age_imputed and 25 <= got["T2"].age < 65
    assert got["T4"].gender in ("M", "F") and got["T4"].gender_imputed
    assert got["T4"].transaction_date is None and got["T1"].transaction_date == date(2016, 8, 2)
    assert [got[t].account_balance for t in ("T2", "T4", "T5")] == [150000.5, 0.0, 0.0]
    assert got["T5"].city is None


def test_ledger_and_dimension(spark, raw_file):
    cleaned = integrate.clean_raw(files.raw_lines(files.read_raw(spark, raw_file)), AS_OF, keep=files.FILE_ORDER)
    ledger = {r.transaction_id: r for r in integrate.transaction_ledger(cleaned).collect()}
    assert (ledger["T1"].transaction_type, ledger["T1"].amount, ledger["T1"].merchant) == ("DEPOSIT", 25.0, "BANK_CREDIT")
    assert (ledger["T2"].transaction_type, ledger["T2"].amount, ledger["T2"].branch_id) == ("PURCHASE", 600.0, "BR_001")
    assert ledger["T3"].transaction_type == "PURCHASE" and ledger["T3"].branch_id == "BR_002"
    assert ledger["T1"].account_id == "ACC_C1"
    assert 10 <= int(ledger["T1"].branch_id[3:]) <= 50
    assert ledger["T4"].category in ("ELECTRONICS", "TRAVEL", "HOME_IMPROVEMENT", "EDUCATION")
    people = {r.customer_id: r for r in integrate.customer_dimension(cleaned, files.FILE_ORDER).collect()}
    assert len(people) == 4
    assert (people["KAGGLE_C1"].account_balance, people["KAGGLE_C1"].customer_segment) == (600000.0, "PREMIUM")
    assert [people[c].annual_income for c in ("KAGGLE_C1", "KAGGLE_C2", "KAGGLE_C3")] == [900000, 400000, 200000]
    assert people["KAGGLE_C1"].customer_since < date(2016, 8, 2)
    assert len(people["KAGGLE_C1"].__fields__) == 14


def test_ordinals_follow_the_file_across_splits(spark, tmp_path):
    for part in ("a", "b"):
        lines = [f"{part}{i:05d},C,,,,,,," for i in range(3000)]
        (tmp_path / f"{part}.csv").write_text("\n".join(["h" + ",h" * 8, *lines]) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8000")
    try:
        raw = files.read_raw(spark, str(tmp_path))
        assert raw.rdd.getNumPartitions() > 4
        got = files.with_ordinal(raw).orderBy("ordinal").select("ordinal", "TransactionID").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r.ordinal for r in got] == list(range(6000))
    assert [r.TransactionID for r in got] == [f"{p}{i:05d}" for p in "ab" for i in range(3000)]


def test_raw_lines_of_another_width_are_kept_apart(spark, tmp_path):
    good, long, short = "a,C,,,,,,,5", "b,C,,,,,,,5,extra", "c,C"
    (tmp_path / "raw.csv").write_text("\n".join(["h" + ",h" * 8, good, long, short]) + "\n")
    raw = files.read_raw(spark, str(tmp_path / "raw.csv"))
    assert [r.TransactionID for r in files.raw_lines(raw).collect()] == ["a"]
    assert {r[CORRUPT] for r in files.malformed_lines(raw).collect()} == {long, short}
    result = jobs.integrate_raw(spark, str(tmp_path / "raw.csv"), str(tmp_path / "out"), AS_OF)
    assert result.malformed.count() == 2
    assert {r.row_count for r in result.counts.collect()} == {1}


def test_bad_csv_values_keep_their_text(spark, tmp_path):
    (tmp_path / "loans.csv").write_text(
        "loan_id,customer_id,loan_amount,outstanding_balance,interest_rate,loan_type,start_date,term_months,status,branch_id\n"
        "l1,c1,100,90,0.1,CAR_LOAN,2024-01-01,12,ACTIVE,b1\n"
        "l2,c1,abc,90,0.1,CAR_LOAN,2024-01-01,12,ACTIVE,b1\n"
    )
    rows = {r.loan_id: r for r in files.read_entity(spark, str(tmp_path), "loans").collect()}
    assert rows["l1"][CORRUPT] is None and rows["l1"].loan_amount == 100.0
    assert rows["l2"].loan_amount is None and "abc" in rows["l2"][CORRUPT]


def test_bronze_by_month(spark, raw_file, tmp_path):
    path = str(tmp_path / "bronze")
    jobs.raw_to_bronze(spark, raw_file, path)
    bronze = spark.read.parquet(path)
    assert {(r.TransactionID, r.year, r.month) for r in bronze.collect()} == {
        ("T1", 2016, 8), ("T2", 2016, 8), ("T3", 2016, 8), ("T4", None, None), ("T5", None, None),
    }
    assert bronze.filter("TransactionID = 'T2'").first().CustomerDOB == "1/1/1800"


def test_integrate_job(spark, raw_file, tmp_path):
    result = jobs.integrate_raw(spark, raw_file, str(tmp_path / "out"), AS_OF)
    assert {r.layer: r.row_count for r in result.counts.collect()} == {"transactions": 5, "customers": 4}
    assert {r.column_name for r in result.gaps.collect()} == {
        "original_customer_id", "city", "transaction_date", "date_of_birth",
    }
    stats = result.statistics.first()
    assert (stats.total_rows, stats.distinct_keys, stats.max_amount) == (5, 4, 600000.0)
    sampled = jobs.integrate_raw(spark, raw_file, str(tmp_path / "part"), AS_OF, limit=2, seed=1)
    assert {r.layer: r.row_count for r in sampled.counts.collect()}["transactions"] == 2


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """Entity CSVs run through both batch jobs."""
    base = tmp_path_factory.mktemp("lake")
    entity = base / "processed"
    entity.mkdir()
    tables = {
        "customers": [
            "customer_id,original_customer_id,first_name,last_name,age,gender,city,country,account_balance,customer_segment,credit_score,annual_income,customer_since,data_source",
            *[f"c{i},C{i},,,{20 + i},F,Pune,India,{i * 1000.5 - 500},BASIC,600,{100000 + i * 1000},2020-01-0{1 + i % 9},x" for i in range(40)],
            "c99,C99,,,30,F,Pune,India,,BASIC,600,1,2020-01-01,x",
        ],
        "transactions": [
            "transaction_id,customer_id,account_id,amount,transaction_type,category,merchant,timestamp,branch_id,currency,data_source",
            *[f"t{i},c{i % 40},a,{i}.25,PURCHASE,X,,2024-0{1 + i % 3}-05,BR_00{i % 3},INR,x" for i in range(60)],
            "bad1,c1,a,-5,PURCHASE,X,,2024-01-05,BR_001,INR,x",
            "bad2,,a,5,PURCHASE,X,,2024-01-05,BR_001,INR,x",
            "bad3,c1,a,5,PURCHASE,X,,31/2/90,BR_001,INR,x",
        ],
        "revenue": [
            "revenue_id,customer_id,account_id,revenue_type,amount,event_date,branch_id,description",
            *[f"r{i},c{i % 40},a,LATE_FEE,{i}.10,2024-0{1 + i % 3}-07,BR_00{i % 3},d" for i in range(50)],
            "r99,c1,a,LATE_FEE,oops,2024-01-07,BR_001,d",
        ],
        "costs": [
            "cost_id,branch_id,cost_category,amount,cost_date,description,region",
            *[f"k{i},BR_00{i % 3},MARKETING,{i}.05,2024-01-0{1 + i % 9},d,WEST" for i in range(20)],
        ],
        "loans": [
            "loan_id,customer_id,loan_amount,outstanding_balance,interest_rate,loan_type,start_date,term_months,status,branch_id",
            *[f"l{i},c{i},{i * 90000},{i * 60000},0.{10 + i % 8},CAR_LOAN,2024-01-01,12,{'ACTIVE' if i % 4 else 'CLOSED'},BR_00{i % 3}" for i in range(40)],
            "l99,c1,1,1,31,CAR_LOAN,2024-01-01,12,ACTIVE,BR_001",
        ],
        "branches": [
            "branch_id,branch_name,city,region,country,opening_date,branch_manager,staff_count,monthly_operating_cost",
            *[f"BR_00{i},Name {i},Pune,WEST,India,2010-01-01,m,10,1000" for i in range(4)],
        ],
    }
    for name, lines in tables.items():
        (entity / f"{name}.csv").write_text("\n".join(lines) + "\n")
    outcome = jobs.bronze_to_silver(spark, str(entity), str(base), NOW)
    unreachable = warehouse.Warehouse("jdbc:none://nowhere/bank")
    result = jobs.silver_to_gold(spark, str(base), AS_OF, NOW, unreachable)
    return base, entity, outcome, result


def test_silver_gate_and_layout(spark, lake):
    base, _, outcome, _ = lake
    assert (outcome["customers"].valid_rows, outcome["customers"].rejected_rows) == (39, 2)
    assert (outcome["transactions"].valid_rows, outcome["transactions"].rejected_rows) == (60, 3)
    assert (outcome["loans"].rejected_rows, outcome["revenue"].rejected_rows) == (1, 1)
    malformed = spark.read.parquet(f"{base}/quarantine/revenue").first()
    assert malformed.violations == ["line is malformed"] and "oops" in malformed[CORRUPT]
    assert CORRUPT not in spark.read.parquet(f"{base}/silver/revenue").columns
    silver = spark.read.parquet(f"{base}/silver/transactions")
    assert silver.count() == 60 and silver.filter("amount <= 0").count() == 0
    pruned = silver.filter("month = '2024-02'")
    assert pruned.count() == 20
    assert "PartitionFilters: [isnotnull(month" in pruned._jdf.queryExecution().executedPlan().toString()
    rejected = spark.read.parquet(f"{base}/quarantine/transactions").collect()
    assert {tuple(r.violations) for r in rejected} == {
        ("amount is not positive",), ("customer_id is missing",), ("day is unreadable",),
    }


def test_references_reject_rows_of_rejected_parents(spark, lake, tmp_path):
    base, entity, _, _ = lake
    outcome = jobs.bronze_to_silver(spark, str(entity), str(tmp_path), NOW, BANK_REFERENCES)
    kept = {r[0] for r in spark.read.parquet(f"{tmp_path}/silver/customers").select("customer_id").collect()}
    for name in ("transactions", "revenue", "loans"):
        written = spark.read.parquet(f"{tmp_path}/silver/{name}")
        assert {r[0] for r in written.select("customer_id").distinct().collect()} <= kept
        rejected = spark.read.parquet(f"{tmp_path}/quarantine/{name}")
        assert outcome[name].valid_rows == written.count() and outcome[name].rejected_rows == rejected.count()
        reasons = {v for r in rejected.collect() for v in r.violations}
        assert "customer_id is rejected in customers" in reasons
        assert not [c for c in written.columns if c.startswith("_ref")]


def test_gold_tables_and_fallback(spark, lake):
    base, _, _, result = lake
    assert set(result.tables) == set(WAREHOUSE) and result.scoring_error is None
    for outcome in result.warehouse.values():
        assert outcome.sink == "lake" and outcome.failures[0][0] == "warehouse"
    rows = {r.layer: r.row_count for r in jobs.written_rows(spark, result).collect()}
    assert rows["customer_profitability"] == 39 and rows["branch_performance"] == 3
    scores = spark.read.parquet(result.tables["loan_risk_analytics"])
    assert scores.columns == list(WAREHOUSE["loan_risk_analytics"])


def test_missing_silver_is_reported(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        jobs.score_loans(spark, str(tmp_path), NOW)


def test_sources_resolve_in_order(spark, lake):
    base, entity, _, _ = lake
    unreachable = warehouse.Warehouse("jdbc:none://nowhere/bank")
    from_gold = jobs.resolve_mart(spark, "branch_performance", str(base), str(entity), unreachable)
    assert from_gold.source == "gold"
    absent = str(base / "absent")
    from_entities = jobs.resolve_mart(spark, "branch_performance", absent, str(entity))
    assert jobs.resolve_mart(spark, "loan_portfolio", absent, str(entity)).frame.count() == 41
    assert jobs.resolve_mart(spark, "customer_profitability", str(base), str(entity)).source == "gold"
    assert from_entities.source == "entities"
    gold_rows = {r.branch_id: r.cost_income_ratio for r in from_gold.frame.collect()}
    entity_rows = {r.branch_id: r.cost_income_ratio for r in from_entities.frame.collect()}
    assert all(entity_rows[k] == v for k, v in gold_rows.items())
    with pytest.raises(LookupError, match="one: "):
        resolve_table("t", [("one", lambda: spark.read.parquet(str(base / "nothing")))])


def test_warehouse_shape(spark, lake):
    _, _, _, result = lake
    for name, path in result.tables.items():
        ready = sinks.conform(spark.read.parquet(path), WAREHOUSE[name])
        assert dict(ready.dtypes) == WAREHOUSE[name]
        assert ready.count() == spark.read.parquet(path).count()
    big = spark.createDataFrame([(12345.678,)], "r double")
    assert str(sinks.conform(big, {"r": "decimal(12,4)"}).first().r) == "12345.6780"
    target = warehouse.Warehouse("jdbc:x:y", properties={"user": "u"}).options("t")
    assert target == {"user": "u", "url": "jdbc:x:y", "dbtable": "bank_dwh.t"}


def test_month_overwrite_replaces_one_month(spark, tmp_path):
    path = str(tmp_path / "facts")
    df = spark.createDataFrame([("2024-01", 1), ("2024-02", 2)], "month string, v int")
    sinks.overwrite_parquet(df, path, ["month"])
    newer = df.filter("month = '2024-02'").withColumn("v", F.lit(9))
    sinks.overwrite_parquet(newer, path, ["month"], only_given_partitions=True)
    assert {(r.month, r.v) for r in spark.read.parquet(path).collect()} == {("2024-01", 1), ("2024-02", 9)}
    # A full rebuild leaves no month that is gone from its input.
    sinks.overwrite_parquet(newer, path, ["month"])
    assert {(r.month, r.v) for r in spark.read.parquet(path).collect()} == {("2024-02", 9)}


def test_command_line(spark, lake, raw_file, tmp_path, capsys):
    from ledgermill.__main__ import REPORTS, parser, run

    base, entity, _, _ = lake
    for line in (
        ["integrity", str(entity)],
        ["profile", raw_file],
        ["integrate", raw_file, str(tmp_path / "out"), "--limit", "3", "--as-of", "2024-06-30"],
        *[["report", str(base), name] for name in REPORTS],
    ):
        run(spark, parser().parse_args(line))
    shown = capsys.readouterr().out
    for text in ("orphans", "TransactionDate", "median_amount", "total_revenue", "risk_category", "LOW_PRODUCTIVITY", "net_income"):
        assert text in shown


def test_warehouse_views_answer_sql(spark, lake):
    base, _, _, _ = lake
    assert len(jobs.register_views(spark, str(base))) == 6
    best = spark.sql("SELECT efficiency_rating, count(*) n FROM vw_branch_performance GROUP BY 1")
    assert sum(r.n for r in best.collect()) == 3
    assert spark.sql("SELECT total_customers FROM vw_summary_kpis").first()[0] == 39
    assert spark.sql("SELECT * FROM vw_loan_risk_analytics WHERE risk_rating = 'Low'").count() > 0
    assert spark.sql("SELECT * FROM vw_realtime_branch_tps").count() == 3
    assert spark.sql("SELECT * FROM vw_loan_portfolio").count() == 3
