"""Raw transaction file to entity tables.

Random values are replaced by draws from the row's key, and imputed values are
flagged, so a second run gives the same tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions import bands, dates, draws, text
from ledgermill.functions.money import number_or
from ledgermill.operators.ranking import first_per_key
from ledgermill.schemas import (
    BRANCH_OF_CITY,
    COUNTRY,
    CURRENCY,
    CUSTOMER_SOURCE_TAG,
    FALLBACK_BRANCHES,
    LARGE_CATEGORIES,
    MEDIUM_CATEGORIES,
    RAW_ID_PREFIX,
    RAW_SOURCE_TAG,
    SMALL_CATEGORIES,
)

AMOUNT = "TransactionAmount (INR)"


def clean_raw(
    raw: DataFrame,
    as_of: date,
    draw: Column | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Typed rows of the raw file: twelve columns, imputation flags, and ``keep``.

    A missing age is drawn from 25 to 64 and a missing gender from M and F, with
    a flag each. A missing date or city stays NULL for the gate to judge.
    ``draw`` defaults to a hash of the customer id.
    """
    draw = draws.hash_draw("CustomerID") if draw is None else draw
    day = F.lit(as_of)
    # One step per level of reuse, so no parse is repeated within a row.
    parsed = (
        raw.withColumns(
            {
                "_date_parts": dates.dmy_parts("TransactionDate"),
                "_birth_parts": dates.dmy_parts("CustomerDOB"),
                "_gender": text.gender_letter("CustGender"),
                "_draw": draw,
            }
        )
        .withColumn("_birth", dates.date_from_parts("_birth_parts", dates.BIRTH_PIVOT))
        .withColumn("_born", dates.usable_birth("_birth", "CustomerDOB", day))
        .withColumn("_age", dates.age_years("_born", day))
    )
    drawn = F.col("_draw")
    return parsed.select(
        text.prefixed_id("CustomerID", RAW_ID_PREFIX).alias("customer_id"),
        F.col("CustomerID").alias("original_customer_id"),
        F.coalesce("_gender", draws.pick(drawn, ["M", "F"])).alias("gender"),
        text.city_name("CustLocation").alias("city"),
        number_or("CustAccountBalance").alias("account_balance"),
        number_or(F.col(f"`{AMOUNT}`")).alias("transaction_amount"),
        dates.date_from_parts("_date_parts", dates.TRANSACTION_PIVOT).alias("transaction_date"),
        F.col("TransactionID").alias("transaction_id"),
        F.col("TransactionTime").alias("transaction_time"),
        F.col("_born").alias("date_of_birth"),
        F.coalesce("_age", draws.draw_between(drawn, 25, 65)).alias("age"),
        F.lit(RAW_SOURCE_TAG).alias("data_source"),
        F.col("_gender").isNull().alias("gender_imputed"),
        F.col("_age").isNull().alias("age_imputed"),
        *keep,
    )


def spending_category(amount: Column | str, draw: Column) -> Column:
    """A category from the list of the amount's size class."""
    amount = bands.as_column(amount)
    return (
        F.when(amount < 500, draws.pick(draw, SMALL_CATEGORIES))
        .when(amount < 5000, draws.pick(draw, MEDIUM_CATEGORIES))
        .otherwise(draws.pick(draw, LARGE_CATEGORIES))
    )


def branch_of_city(city: Column | str, draw: Column) -> Column:
    """Metro branch of the city, or one of the fallback branches."""
    low, high = FALLBACK_BRANCHES
    number = draws.draw_between(draw, low, high + 1).cast("string")
    fallback = F.concat(F.lit("BR_"), F.lpad(number, 3, "0"))
    key = F.upper(F.coalesce(bands.as_column(city), F.lit("")))
    return text.mapped(key, BRANCH_OF_CITY, fallback)


def transaction_ledger(cleaned: DataFrame, draw: Column | None = None) -> DataFrame:
    """Eleven-column ledger; the sign of the amount decides the type."""
    draw = draws.hash_draw("transaction_id") if draw is None else draw
    amount = F.abs("transaction_amount")
    credit = F.col("transaction_amount") > 0
    return cleaned.select(
        "transaction_id",
        "customer_id",
        text.account_id("customer_id").alias("account_id"),
        amount.alias("amount"),
        F.when(credit, "DEPOSIT").otherwise("PURCHASE").alias("transaction_type"),
        spending_category(amount, draw).alias("category"),
        F.when(credit, "BANK_CREDIT").alias("merchant"),
        F.col("transaction_date").alias("timestamp"),
        branch_of_city("city", draw).alias("branch_id"),
        F.lit(CURRENCY).alias("currency"),
        F.lit(RAW_SOURCE_TAG).alias("data_source"),
    )


def extend_ledger(ledger: DataFrame, *extensions: DataFrame) -> DataFrame:
    """Union-all of the ledger and later feeds of the same columns."""
    for extension in extensions:
        ledger = ledger.unionByName(extension)
    return ledger


def income_estimate(segment: Column | str, balance: Column | str) -> Column:
    """Income expected from segment and balance."""
    segment, balance = bands.as_column(segment), bands.as_column(balance)
    return (
        F.when(segment == "PREMIUM", F.greatest(balance * 1.5, F.lit(800000.0)))
        .when(segment == "STANDARD", F.greatest(balance * 2.0, F.lit(400000.0)))
        .otherwise(F.greatest(balance * 3.0, F.lit(200000.0)))
    )


TENURE_DAYS = (1, 8 * 365)


def customer_dimension(
    cleaned: DataFrame, order: Sequence[Column | str], draw: Column | None = None
) -> DataFrame:
    """One row per customer from the first of its rows in source order.

    Names and credit score are not in the source and stay NULL.
    """
    draw = draws.hash_draw("customer_id") if draw is None else draw
    segment = bands.customer_segment()
    offset = draws.draw_between(draw, *TENURE_DAYS)
    nothing = F.lit(None)
    return first_per_key(cleaned, "customer_id", order).select(
        "customer_id",
        "original_customer_id",
        nothing.cast("string").alias("first_name"),
        nothing.cast("string").alias("last_name"),
        "age",
        "gender",
        "city",
        F.lit(COUNTRY).alias("country"),
        "account_balance",
        segment.alias("customer_segment"),
        nothing.cast("int").alias("credit_score"),
        F.rint(income_estimate(segment, "account_balance")).cast("bigint").alias("annual_income"),
        F.date_sub("transaction_date", offset).alias("customer_since"),
        F.lit(CUSTOMER_SOURCE_TAG).alias("data_source"),
    )
