"""The bank entities as views over the star-schema test tables.

Amounts are whole paise: products of two-decimal inputs are taken as integers
and divided once, so every engine computes the same double.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.functions.bands import customer_segment

#: Every fiftieth transaction is at a branch that does not exist, so orphan checks have something to find.
ORPHAN_EVERY, ORPHAN_BRANCH = 50, 1_000_000_000


class BankTables:
    """Lazy entity frames; each reads only the files it needs."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """One of the test tables; its footer is read once per instance."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def branch_count(self) -> int:
        """Suppliers, each of which is a branch; read from the file's footer."""
        return self.table("supplier").count()

    @cached_property
    def branches(self) -> DataFrame:
        nation = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        return (
            self.table("supplier")
            .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .selectExpr(
                "s_suppkey AS branch_id",
                "s_name AS branch_name",
                "n_name AS city",
                "r_name AS region",
                "CAST(8 + s_suppkey % 42 AS INT) AS staff_count",
            )
        )

    @cached_property
    def customers(self) -> DataFrame:
        return (
            self.table("customer")
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .selectExpr(
                "c_custkey AS customer_id",
                "n_name AS city",
                "CAST(18 + c_custkey % 63 AS INT) AS age",
                "floor(c_acctbal * 6000 + 0.5e0) / 100 AS account_balance",
                "(c_custkey * 7919) % 1500000 AS annual_income",
                "date_add(DATE '2016-01-01', CAST(c_custkey % 2900 AS INT)) AS customer_since",
            )
            .withColumn("customer_segment", customer_segment())
        )

    @cached_property
    def transactions(self) -> DataFrame:
        return self.table("events").selectExpr(
            "event_id AS transaction_id",
            "user_id AS customer_id",
            "floor(value * 2000 + 0.5e0) / 100 AS amount",
            """CASE event_type WHEN 'click' THEN 'PAYMENT' WHEN 'view' THEN 'TRANSFER'
               WHEN 'signup' THEN 'DEPOSIT' WHEN 'purchase' THEN 'PURCHASE'
               ELSE 'WITHDRAWAL' END AS transaction_type""",
            "CAST(ts AS TIMESTAMP) AS timestamp",
            f"""CASE WHEN event_id % {ORPHAN_EVERY} = 0 THEN {ORPHAN_BRANCH} + event_id % 7
                ELSE event_id % {self.branch_count} END AS branch_id""",
        )

    @cached_property
    def revenue_lines(self) -> DataFrame:
        """Revenue without its customer, for marts that only need the branch."""
        return self.table("lineitem").selectExpr(
            "l_orderkey",
            "l_orderkey * 10 + l_linenumber AS revenue_id",
            "l_suppkey AS branch_id",
            """CASE WHEN l_returnflag = 'A' THEN 'ACCOUNT_MAINTENANCE_FEE'
               WHEN l_returnflag = 'N' THEN 'TRANSACTION_FEE'
               WHEN l_linestatus = 'F' THEN 'INTEREST_INCOME'
               ELSE 'LATE_FEE' END AS revenue_type""",
            """floor(floor(l_extendedprice * 100 + 0.5e0) * floor(l_discount * 100 + 0.5e0)
               / 100 + 0.5e0) / 100 AS amount""",
            "CAST(l_shipdate AS DATE) AS event_date",
        )

    @cached_property
    def revenue(self) -> DataFrame:
        owners = self.table("orders").selectExpr(
            "o_orderkey AS l_orderkey", "o_custkey AS customer_id"
        )
        return self.revenue_lines.join(owners, "l_orderkey").select(
            "revenue_id", "customer_id", "branch_id", "revenue_type", "amount", "event_date"
        )

    @cached_property
    def costs(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "l_orderkey * 10 + l_linenumber AS cost_id",
            "l_suppkey AS branch_id",
            """CASE l_linenumber % 5 WHEN 0 THEN 'STAFF_SALARIES' WHEN 1 THEN 'TECHNOLOGY'
               WHEN 2 THEN 'FACILITIES' WHEN 3 THEN 'MARKETING'
               ELSE 'COMPLIANCE' END AS cost_category""",
            """floor(floor(l_extendedprice * 100 + 0.5e0) * floor(l_tax * 100 + 0.5e0)
                * (31 + l_suppkey % 62) / 6200 + 0.5e0) / 100 AS amount""",
            "CAST(l_shipdate AS DATE) AS cost_date",
        )

    @cached_property
    def loans(self) -> DataFrame:
        return (
            self.table("orders")
            .selectExpr("*", "floor(o_totalprice * 400 + 0.5e0) AS paise")
            .selectExpr(
                "o_orderkey AS loan_id",
                "o_custkey AS customer_id",
                "paise / 100 AS loan_amount",
                "floor(paise * (20 + o_orderkey % 61) / 100 + 0.5e0) / 100 AS outstanding_balance",
                "(85 + o_orderkey % 96) / 1000 AS interest_rate",
                """CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'HOME_LOAN'
                   WHEN '2' THEN 'PERSONAL_LOAN' WHEN '3' THEN 'CAR_LOAN'
                   ELSE 'EDUCATION_LOAN' END AS loan_type""",
                "CAST(o_orderdate AS DATE) AS start_date",
                "CASE WHEN o_orderstatus = 'F' THEN 'CLOSED' ELSE 'ACTIVE' END AS status",
                f"o_custkey % {self.branch_count} AS branch_id",
            )
        )

    @cached_property
    def raw_transactions(self) -> DataFrame:
        """Events in the shape and disorder of the raw file; ``ordinal`` is the line."""
        return self.table("events").selectExpr(
            "concat('T', CAST(event_id AS STRING)) AS TransactionID",
            "concat('C', CAST(user_id AS STRING)) AS CustomerID",
            """CASE user_id % 17 WHEN 0 THEN '1/1/1800' WHEN 1 THEN 'nan' WHEN 2 THEN ''
               ELSE concat(CAST(1 + user_id * 7 % 31 AS STRING), '/',
                           CAST(1 + user_id % 12 AS STRING), '/',
                           CAST(40 + user_id * 3 % 60 AS STRING)) END AS CustomerDOB""",
            """CASE user_id % 11 WHEN 0 THEN '' WHEN 1 THEN 'male' WHEN 2 THEN 'F'
               WHEN 3 THEN 'f' ELSE 'M' END AS CustGender""",
            """CASE user_id % 7 WHEN 0 THEN 'MUMBAI' WHEN 1 THEN 'navi mumbai' WHEN 2 THEN ''
               WHEN 3 THEN 'Delhi' WHEN 4 THEN 'PUNE' WHEN 5 THEN 'GURGAON'
               ELSE 'chennai' END AS CustLocation""",
            """CASE user_id % 13 WHEN 0 THEN '' WHEN 1 THEN 'abc'
               ELSE concat(CAST(user_id * 7919 % 900000 AS STRING), '.50') END
               AS CustAccountBalance""",
            """CASE WHEN event_id % 29 = 0 THEN '' ELSE
               concat(CAST(1 + event_id % 31 AS STRING), '/', CAST(1 + event_id % 12 AS STRING),
                      '/', lpad(CAST(event_id % 100 AS STRING), 2, '0')) END AS TransactionDate""",
            "CAST(event_id % 240000 AS STRING) AS TransactionTime",
            """CASE WHEN event_id % 97 = 0 THEN 'abc' ELSE
               concat(CASE WHEN event_id % 5 = 0 THEN '-' ELSE '' END,
                      CAST(CAST(floor(value * 20 + 0.5e0) AS BIGINT) AS STRING), '.25') END
               AS `TransactionAmount (INR)`""",
            "event_id AS ordinal",
            "user_id",
            "event_id",
        )

    @cached_property
    def event_messages(self) -> DataFrame:
        """Events as JSON messages of the mixed topic, some of them unreadable."""
        kind = F.col("event_id") % 10
        stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
        event_type = (
            F.when(kind < 6, "CARD_TRANSACTION")
            .when(kind == 6, "CUSTOMER_ONBOARDED")
            .when(kind == 7, "EMI_PAYMENT_EVENT")
            .when(kind == 8, "NEW_BRANCH_OPENED")
            .otherwise("UNLISTED")
        )
        card = kind < 6
        branch = F.concat(F.lit("BR_"), F.col("event_id") % 70)
        untimed = F.col("event_id") % 31 == 0
        body = F.to_json(
            F.struct(
                event_type.alias("event_type"),
                F.when(card, F.concat(F.lit("TXN-"), "event_id")).alias("transaction_id"),
                F.concat(F.lit("CUST-"), "user_id").alias("customer_id"),
                F.when(kind != 7, branch).alias("branch_id"),
                F.when(card, F.expr("floor(value * 2000 + 0.5e0) / 100")).alias("amount"),
                F.when(untimed, "not a time").otherwise(stamp).alias("timestamp"),
            )
        )
        broken = F.col("event_id") % 37 == 0
        return self.table("events").select(
            F.when(broken, "{broken").otherwise(body).cast("binary").alias("value")
        )

    def entities(self) -> dict[str, DataFrame]:
        return {
            "customers": self.customers,
            "transactions": self.transactions,
            "revenue": self.revenue,
            "costs": self.costs,
            "loans": self.loans,
            "branches": self.branches,
        }
