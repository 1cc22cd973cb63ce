"""Bronze to Silver: typing, banding and flags. The gate is applied on write."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.functions import bands, dates
from ledgermill.schemas import CREDIT_TYPES, DEBIT_TYPES


def silver_customers(customers: DataFrame, run_ts: datetime) -> DataFrame:
    return customers.withColumns(
        {
            "age_group": bands.age_group(),
            "income_segment": bands.income_segment(),
            "balance_segment": bands.balance_segment(),
            "customer_since": dates.day_of("customer_since"),
            "updated_timestamp": F.lit(run_ts),
        }
    )


def silver_transactions(
    transactions: DataFrame,
    run_ts: datetime,
    debit_types: Sequence[str] = DEBIT_TYPES,
    credit_types: Sequence[str] = CREDIT_TYPES,
) -> DataFrame:
    kind = F.col("transaction_type")
    return transactions.withColumns(
        {
            "transaction_date": dates.day_of("timestamp"),
            "is_debit": kind.isin(*debit_types),
            "is_credit": kind.isin(*credit_types),
            "amount_category": bands.amount_category(),
            "updated_timestamp": F.lit(run_ts),
        }
    )


def with_typed_day(df: DataFrame, day: str, run_ts: datetime) -> DataFrame:
    """Revenue, costs, loans and branches only need their day typed."""
    return df.withColumns({day: dates.day_of(day), "updated_timestamp": F.lit(run_ts)})


# entity -> the day its facts are partitioned by
FACT_DAY = {
    "transactions": "transaction_date",
    "revenue": "event_date",
    "costs": "cost_date",
    "loans": "start_date",
}


def to_silver(entity: str, df: DataFrame, run_ts: datetime) -> DataFrame:
    if entity == "customers":
        return silver_customers(df, run_ts)
    if entity == "transactions":
        return silver_transactions(df, run_ts)
    return with_typed_day(df, FACT_DAY.get(entity, "opening_date"), run_ts)


def with_month(df: DataFrame, day: str) -> DataFrame:
    """Month label used as the partition column of a fact table."""
    return df.withColumn("month", dates.month_key(day))
