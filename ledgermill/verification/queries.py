"""Every registered query: a function of a session and a folder of tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.drivertables import BankTables
from ledgermill.functions import bands, dates, draws
from ledgermill.functions.money import sum_money
from ledgermill.operators import (
    asof,
    cascade,
    integrity,
    profiling,
    quality,
    ranking,
    sampling,
    surrogate,
)
from ledgermill.plans import gold, integrate, marts, monthly, risk, scoring, silver
from ledgermill.schemas import FOREIGN_KEYS, PRIMARY_KEYS, RAW_ID_PREFIX
from ledgermill.sources.paths import fresh_folder, stored
from ledgermill.sources.sinks import overwrite_parquet
from ledgermill.streaming import decode, ledger, sinks, volume

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = date(2024, 6, 30)
RUN_TS = datetime(2024, 6, 30, 12, 0, 0)
DRILL_BRANCH = 7
COSTLY = 2500
THRESHOLDS = [0.25, 0.55, 0.80]
GIVEN_SCORER = scoring.Scorer(-4.0, (4e-06, 3.0, -1e-07, -5e-07, 0.25))

REGISTRY: dict[str, Query] = {}


def portable(df: DataFrame) -> DataFrame:
    """Dates and times as ISO text and decimals as doubles, alike in every engine."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(build: Callable[[BankTables], DataFrame]) -> Callable[[BankTables], DataFrame]:
    """Register a builder under its own name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return portable(build(BankTables(spark, folder)))

    REGISTRY[build.__name__] = run
    return build


# --- shared parts -----------------------------------------------------------


def _branch_mart(bank: BankTables) -> DataFrame:
    return gold.branch_performance(bank.revenue_lines, bank.costs, bank.transactions, AS_OF)


def _branch_view(bank: BankTables) -> DataFrame:
    return gold.branch_performance_view(_branch_mart(bank))


def _branch_details(bank: BankTables) -> DataFrame:
    return marts.branch_with_details(_branch_view(bank), bank.branches)


def _customer_mart(bank: BankTables, **options) -> DataFrame:
    return gold.customer_profitability(
        bank.customers, bank.revenue, bank.transactions, AS_OF, **options
    )


def _silver_customers(bank: BankTables) -> DataFrame:
    return silver.silver_customers(bank.customers, RUN_TS)


def _silver_transactions(bank: BankTables) -> DataFrame:
    return silver.silver_transactions(bank.transactions, RUN_TS)


def _customer_details(bank: BankTables) -> DataFrame:
    kept = gold.customer_profitability(
        _silver_customers(bank),
        bank.revenue,
        bank.transactions,
        AS_OF,
        keep=marts.CUSTOMER_ATTRIBUTES,
    )
    return kept.withColumn("value_tier", bands.value_tier())


def _loan_mart(bank: BankTables) -> DataFrame:
    return gold.loan_portfolio(bank.loans, AS_OF)


def _loan_view(bank: BankTables) -> DataFrame:
    return gold.loan_portfolio_view(_loan_mart(bank))


def _revenue_monthly(bank: BankTables) -> DataFrame:
    return marts.monthly_revenue(bank.revenue_lines)


def _costs_monthly(bank: BankTables) -> DataFrame:
    return marts.monthly_costs(bank.costs)


def _cleaned(bank: BankTables) -> DataFrame:
    return integrate.clean_raw(
        bank.raw_transactions,
        AS_OF,
        draws.number_draw("user_id", 11),
        keep=["ordinal", "user_id", "event_id"],
    )


def _features(bank: BankTables) -> DataFrame:
    return risk.loan_features(bank.loans, bank.customers)


def _alerts(bank: BankTables) -> DataFrame:
    """Alerts at a transaction cost high enough for some customers to lose money."""
    return marts.alerts(
        _branch_details(bank),
        _customer_mart(bank, cost_per_transaction=COSTLY),
        _loan_view(bank),
        bank.branches,
    )


def _scores(bank: BankTables) -> DataFrame:
    features = stored(_features(bank), "loan-features")
    return risk.score(risk.fit(features), features, RUN_TS)


# --- Gold and warehouse views -----------------------------------------------


@query
def branch_performance(bank):
    return _branch_view(bank)


@query
def branch_performance_all_branches(bank):
    return gold.branch_performance(
        bank.revenue_lines,
        bank.costs,
        bank.transactions,
        AS_OF,
        branches=bank.branches,
        all_branches=True,
        staff_from_dimension=True,
    )


@query
def branch_throughput(bank):
    return gold.branch_throughput(_branch_mart(bank))


@query
def branch_ratio_from_entities(bank):
    return gold.branch_ratio_from_entities(bank.branches, bank.revenue_lines, bank.costs)


@query
def customer_profitability(bank):
    return _customer_mart(bank).withColumn("value_tier", bands.value_tier())


@query
def customer_profitability_view(bank):
    return gold.customer_profitability_view(_customer_mart(bank))


@query
def customer_profitability_missing_as_zero(bank):
    return _customer_mart(bank, missing_as_zero=True)


@query
def customer_activity(bank):
    return gold.customer_activity(_silver_transactions(bank))


@query
def loan_portfolio(bank):
    return _loan_view(bank)


@query
def loan_portfolio_dashboard_bands(bank):
    return gold.loan_portfolio_view(_loan_mart(bank), bands.RATE_CATEGORIES_DASHBOARD)


@query
def summary_kpis(bank):
    return gold.summary_kpis(_customer_mart(bank), _loan_mart(bank))


# --- Silver and the gate ----------------------------------------------------


@query
def silver_customers(bank):
    return quality.valid_rows(_silver_customers(bank), quality.GATES["customers"])


@query
def silver_transactions(bank):
    return quality.valid_rows(_silver_transactions(bank), quality.GATES["transactions"])


@query
def silver_revenue(bank):
    return silver.with_month(
        silver.with_typed_day(bank.revenue, "event_date", RUN_TS), "event_date"
    )


@query
def silver_costs(bank):
    return silver.with_month(silver.with_typed_day(bank.costs, "cost_date", RUN_TS), "cost_date")


@query
def silver_loans(bank):
    return quality.valid_rows(
        silver.with_typed_day(bank.loans, "start_date", RUN_TS), quality.GATES["loans"]
    )


def _as_text(rejected: DataFrame) -> DataFrame:
    return rejected.withColumn("violations", F.array_join("violations", "; "))


@query
def quarantine_customers(bank):
    return _as_text(
        quality.rejected_rows(_silver_customers(bank), quality.GATES["customers"], RUN_TS)
    )


@query
def quarantine_raw_transactions(bank):
    """Cleaned raw rows without a usable date or a positive amount."""
    gate = quality.Gate(
        "transactions",
        ["transaction_id", "customer_id", "transaction_date"],
        {"amount is not positive": "transaction_amount > 0"},
    )
    return _as_text(quality.rejected_rows(_cleaned(bank), gate, RUN_TS)).select(
        "transaction_id", "transaction_date", "transaction_amount", "violations",
        "quarantine_timestamp", "quarantine_entity",
    )


@query
def quarantine_unknown_branch(bank):
    """The foreign-key check as a gate rule."""
    flagged = quality.with_reference_check(
        bank.transactions, "branch_id", bank.branches, "branch_id", "branch_known"
    )
    gate = quality.Gate("transactions", ["transaction_id"], {"branch is unknown": "branch_known"})
    return _as_text(quality.rejected_rows(flagged, gate, RUN_TS)).select(
        "transaction_id", "branch_id", "violations"
    )


@query
def gate_counts(bank):
    return integrity.union_all(
        [
            quality.gate_counts(_silver_customers(bank), quality.GATES["customers"]),
            quality.gate_counts(bank.transactions, quality.GATES["transactions"]),
            quality.gate_counts(bank.loans, quality.GATES["loans"]),
            quality.gate_counts(bank.loans, quality.loan_gate(max_rate=0.15)).withColumn(
                "entity", F.lit("loans up to 15 percent")
            ),
        ]
    )


# --- integrity and profiles -------------------------------------------------


@query
def integrity_report(bank):
    return integrity.integrity_report(bank.entities())


@query
def duplicate_rows(bank):
    """Whole-row duplicates of the revenue amounts, where copies really occur."""
    frames = {
        "revenue_id": bank.revenue.select("revenue_id"),
        "revenue_branch_type_amount": bank.revenue.select("branch_id", "revenue_type", "amount"),
        "transactions_customer_type": bank.transactions.select("customer_id", "transaction_type"),
    }
    return integrity.union_all(
        [
            integrity.duplicate_rows(df).select(F.lit(name).alias("subject"), "failures")
            for name, df in frames.items()
        ]
    )


@query
def pk_duplicates(bank):
    return integrity.repeated_keys(bank.revenue, "revenue_id")


@query
def pk_summary(bank):
    tables = bank.entities()
    return integrity.union_all(
        [
            integrity.surplus_keys(tables[name], key).select(
                F.lit(name).alias("subject"), "row_count", "distinct_keys", "failures"
            )
            for name, key in PRIMARY_KEYS.items()
        ]
    )


@query
def fk_orphans(bank):
    tables = bank.entities()
    return integrity.union_all(
        [
            integrity.orphan_keys(tables[child], key, tables[parent]).select(
                F.lit(f"{child}.{key}").alias("subject"),
                F.col(key).alias("key_value"),
                "row_count",
            )
            for child, key, parent in FOREIGN_KEYS
        ]
    )


@query
def orphan_transactions(bank):
    return integrity.orphan_rows(bank.transactions, "branch_id", bank.branches).select(
        "transaction_id", "branch_id", "amount"
    )


@query
def source_overlap(bank):
    """Customers known to the raw file, by prefixed id."""
    people = bank.customers.select(
        F.concat(F.lit(f"{RAW_ID_PREFIX}C"), F.col("customer_id")).alias("customer_id")
    )
    return integrity.source_overlap(
        people, "customer_id", bank.raw_transactions, "CustomerID", RAW_ID_PREFIX
    )


@query
def layer_assertions(bank):
    return integrity.layer_assertions(_silver_customers(bank), _silver_transactions(bank))


@query
def layer_counts(bank):
    return integrity.layer_counts(
        {
            "raw": bank.raw_transactions,
            "bronze.customers": bank.customers,
            "silver.customers": quality.valid_rows(
                _silver_customers(bank), quality.GATES["customers"]
            ),
            "silver.transactions": quality.valid_rows(
                _silver_transactions(bank), quality.GATES["transactions"]
            ),
            "gold.branch_performance": _branch_mart(bank),
            "gold.loan_portfolio": _loan_mart(bank),
        }
    )


@query
def profile_columns(bank):
    raw = bank.raw_transactions.drop("ordinal", "user_id", "event_id")
    blanked = raw.select(
        *[
            F.when(F.length(F.col(f"`{c}`")) > 0, F.col(f"`{c}`")).alias(c.split(" ")[0])
            for c in raw.columns
        ]
    )
    return profiling.column_nulls(blanked)


@query
def raw_profile(bank):
    return profiling.amount_statistics(
        bank.raw_transactions.withColumnRenamed(integrate.AMOUNT, "raw_amount"),
        "raw_amount",
        "CustomerID",
    )


@query
def quality_report(bank):
    return profiling.amount_statistics(_cleaned(bank), "account_balance", "customer_id")


@query
def quality_gaps(bank):
    return profiling.columns_with_gaps(
        _cleaned(bank).drop("ordinal", "user_id", "event_id")
    )


# --- monthly marts ----------------------------------------------------------


@query
def monthly_revenue(bank):
    return _revenue_monthly(bank)


@query
def monthly_costs(bank):
    return _costs_monthly(bank)


@query
def monthly_loans(bank):
    return marts.monthly_loans(bank.loans)


@query
def monthly_trend(bank):
    return marts.monthly_trend(_revenue_monthly(bank), _costs_monthly(bank))


@query
def disbursement_trend(bank):
    return marts.disbursement_trend(marts.monthly_loans(bank.loans))


@query
def cir_matrix_long(bank):
    return marts.branch_month_ratio(
        _revenue_monthly(bank), _costs_monthly(bank), _branch_mart(bank)
    )


@query
def cir_matrix_pivot(bank):
    ratios = marts.branch_month_ratio(
        _revenue_monthly(bank), _costs_monthly(bank), _branch_mart(bank)
    )
    # Back into one row for each branch and month, so that the columns do not depend on the data.
    return marts.ratio_matrix(ratios).unpivot("branch_id", None, "month", "cir")


# --- headlines and products -------------------------------------------------


@query
def executive_summary(bank):
    return marts.executive_summary(_branch_mart(bank), bank.customers, _loan_mart(bank))


@query
def executive_cards(bank):
    return marts.executive_cards(
        marts.executive_summary(_branch_mart(bank), bank.customers, _loan_mart(bank))
    )


@query
def branch_headline(bank):
    return marts.branch_headline(_branch_mart(bank))


@query
def customer_headline(bank):
    return marts.customer_headline(_customer_details(bank))


@query
def loan_headline(bank):
    return marts.loan_headline(_loan_mart(bank))


@query
def product_contribution(bank):
    return marts.product_contribution(_revenue_monthly(bank))


@query
def product_profit(bank):
    return marts.product_profit(_branch_mart(bank))


@query
def region_product_revenue(bank):
    return marts.region_product_revenue(_branch_details(bank))


# --- rankings and drill-down ------------------------------------------------


@query
def top_branches(bank):
    return marts.top_branches(_branch_details(bank))


@query
def top_branches_by_city_label(bank):
    """Top five by net income, labelled by city so that labels repeat."""
    return marts.top_branches(
        _branch_details(bank).withColumn("branch_name", F.col("region")), 5
    )


@query
def top_bottom_branches(bank):
    return marts.top_bottom_branches(_branch_details(bank))


@query
def top_customers(bank):
    return marts.top_customers(_customer_details(bank))


@query
def negative_profit_head(bank):
    return marts.negative_profit_customers(
        _customer_mart(bank, cost_per_transaction=COSTLY), 100
    )


@query
def top_outstanding(bank):
    return marts.top_outstanding(_loan_view(bank))


@query
def branch_list(bank):
    return ranking.distinct_sorted(_branch_mart(bank), "branch_id")


@query
def branch_drilldown(bank):
    return marts.branch_drilldown(_branch_details(bank), _loan_view(bank), DRILL_BRANCH)


@query
def branch_drilldown_trend(bank):
    return marts.branch_trend(_revenue_monthly(bank), _costs_monthly(bank), DRILL_BRANCH)


# --- customers --------------------------------------------------------------


@query
def customer_details(bank):
    return _customer_details(bank)


@query
def category_mix(bank):
    return marts.category_mix(_customer_details(bank))


@query
def cohort_profit(bank):
    return marts.cohort_profit(_customer_details(bank))


@query
def high_value_by_city(bank):
    return marts.high_value_by_city(_customer_details(bank))


@query
def customer_plot_sample(bank):
    return sampling.sample_rows(
        _customer_details(bank).select(
            "customer_id", "total_revenue", "profit_margin", "account_balance", "customer_segment"
        ),
        "customer_id",
        draws.number_draw("customer_id", 5),
        5000,
    )


# --- loans, risk and alerts -------------------------------------------------


@query
def rate_histogram(bank):
    return marts.rate_histogram(bank.loans)


@query
def loan_risk_distribution(bank):
    return marts.loan_risk_distribution(bank.loans)


@query
def alerts(bank):
    return _alerts(bank)


@query
def alert_counts(bank):
    return marts.alert_counts(_alerts(bank))


@query
def loan_default_features(bank):
    return _features(bank)


@query
def loan_default_features_fraction_rates(bank):
    return risk.loan_features(bank.loans, bank.customers, risk.RATE_LIMIT_FRACTION)


@query
def loan_default_scores(bank):
    return gold.loan_risk_view(_scores(bank))


# --- raw ingestion ----------------------------------------------------------


@query
def clean_raw(bank):
    return _cleaned(bank).drop("ordinal", "user_id", "event_id")


@query
def transaction_ledger(bank):
    return integrate.transaction_ledger(_cleaned(bank), draws.number_draw("event_id", 3))


@query
def ledger_union(bank):
    """The ledger extended by a repeated feed, counted per source."""
    ledger = integrate.transaction_ledger(_cleaned(bank), draws.number_draw("event_id", 3))
    feed = ledger.withColumn("data_source", F.lit("late_feed"))
    return (
        integrate.extend_ledger(ledger, feed)
        .groupBy("data_source", "transaction_type")
        .agg(F.count(F.lit(1)).alias("row_count"), sum_money("amount").alias("total_amount"))
    )


@query
def customer_dimension(bank):
    return integrate.customer_dimension(
        _cleaned(bank), ["ordinal"], draws.number_draw("user_id", 7)
    )


@query
def raw_sample(bank):
    return sampling.contiguous_sample(bank.raw_transactions, "ordinal", 2000, seed=9).select(
        "TransactionID", "CustomerID", "ordinal"
    )


@query
def sample_keys(bank):
    return sampling.sample_keys(
        bank.revenue, "customer_id", draws.number_draw("customer_id", 1), 0.2
    )


@query
def sample_keys_exact(bank):
    return sampling.sample_keys_exact(
        bank.loans, "customer_id", draws.number_draw("customer_id", 2), 0.4
    )


@query
def repeat_rows(bank):
    times = draws.draw_between(draws.number_draw("customer_id", 4), 2, 7)
    return sampling.repeat_rows(bank.customers.select("customer_id"), times).withColumn(
        "copy", F.col("copy").cast("bigint")
    )


@query
def weighted_types(bank):
    kinds = [
        ("DEPOSIT", 0.1), ("WITHDRAWAL", 0.2), ("TRANSFER", 0.1), ("PAYMENT", 0.3), ("PURCHASE", 0.3),
    ]
    return bank.transactions.select(
        "transaction_id",
        draws.weighted_pick(draws.number_draw("transaction_id", 6), kinds).alias("drawn_type"),
    )


@query
def sequential_ids(bank):
    numbered = surrogate.sequential_ids(
        bank.transactions.select("transaction_id", "amount"),
        ["transaction_id"],
        draws.number_draw("transaction_id", 8),
        buckets=64,
    )
    return numbered.select(
        "transaction_id", surrogate.padded_id("row_number", "TX_SYNTH_", 8).alias("surrogate_id")
    )


@query
def ids_per_branch(bank):
    numbered = surrogate.ids_within_group(
        bank.loans.select("branch_id", "loan_id"),
        "branch_id",
        ["loan_id"],
        draws.number_draw("loan_id", 9),
        buckets=8,
    )
    number = surrogate.padded_id("row_number", "_", 3)
    return numbered.select(
        "loan_id",
        F.concat(surrogate.padded_id("branch_id", "LOAN_", 3), number).alias("surrogate_id"),
    )


@query
def hash_positions(bank):
    """How evenly a stable hash spreads the customers over sixteen positions."""
    return (
        bank.customers.groupBy(draws.hash_range("customer_id", 16, 3).alias("position"))
        .agg(F.count(F.lit(1)).alias("customers"))
        .withColumn("position", F.col("position").cast("bigint"))
    )


# --- events -----------------------------------------------------------------


def _card_events(bank: BankTables) -> DataFrame:
    return bank.transactions.withColumn("event_time", F.col("timestamp"))


@query
def branch_volume_batch(bank):
    return volume.batch_volume(_card_events(bank))


@query
def branch_volume_stream(bank):
    """The same windows from a stream run to its end."""
    spark = bank.spark
    schema = bank.table("events").schema
    # A glob matches the table both as one file and as a folder of parts.
    stream = spark.readStream.schema(schema).parquet(f"{bank.folder}/events.parquet*")
    streamed = BankTables(spark, bank.folder)
    streamed._tables["events"] = stream
    out, checkpoint = fresh_folder(spark, "volume"), fresh_folder(spark, "volume-state")
    started = sinks.to_lake(
        volume.stream_volume(_card_events(streamed)),
        out,
        checkpoint,
        available_now=True,
        state_partitions=spark.sparkContext.defaultParallelism,
    )
    started.awaitTermination()
    return sinks.latest_windows(spark, out)


@query
def branch_volume_ledger(bank):
    """The windows of a stream of many batches through the ledger, compacted once it has ended."""
    spark = bank.spark
    parts = fresh_folder(spark, "volume-parts")
    # As many batches as files; within a batch the windows are updated, not repeated.
    bank.table("events").repartition(4, "event_id").write.parquet(parts)
    stream = spark.readStream.schema(bank.table("events").schema).option("maxFilesPerTrigger", 1).parquet(parts)
    streamed = BankTables(spark, bank.folder)
    streamed._tables["events"] = stream
    out, checkpoint = fresh_folder(spark, "ledger"), fresh_folder(spark, "ledger-state")
    # No row is late: the batches are not in the order of time. So every window stays open, in
    # state that grows with the input and is kept on disk.
    windowed = volume.stream_volume(_card_events(streamed), lateness="36500 days")
    partitions = spark.sparkContext.defaultParallelism
    ledger.to_ledger(windowed, out, checkpoint, True, partitions, sinks.ROCKSDB).awaitTermination()
    ledger.compact(spark, out)
    return ledger.windows(spark, out)


@query
def branch_surges(bank):
    """Surges over ten regions of customers, as single branches are too quiet."""
    grouped = _card_events(bank).withColumn("branch_id", F.col("customer_id") % 10)
    return volume.surges(volume.batch_volume(grouped), lookback=5, factor=1.5).select(
        "window_start", "branch_id", "window_txn_count", "trailing_total", "trailing_windows"
    )


@query
def event_routing(bank):
    return decode.route_summary(decode.decode(bank.event_messages))


@query
def card_events(bank):
    return decode.typed_events(decode.decode(bank.event_messages), decode.CARD)


# --- documented extras ------------------------------------------------------


@query
def premium_without_active_loan(bank):
    """Premium customers without an active home loan."""
    return marts.premium_without_active_loan(bank.customers, bank.loans, "HOME_LOAN")


@query
def home_currency(bank):
    """Transactions in four currencies brought to the home currency by day."""
    foreign = bank.transactions.select(
        "transaction_id",
        "amount",
        F.element_at(
            F.array(*[F.lit(c) for c in ("INR", "USD", "EUR", "GBP")]),
            (F.col("transaction_id") % 4 + 1).cast("int"),
        ).alias("currency"),
        dates.day_of("timestamp").alias("transaction_date"),
    )
    days = bank.transactions.select(dates.day_of("timestamp").alias("rate_date")).distinct()
    rates = days.select(
        "rate_date",
        F.explode(F.array(F.lit("USD"), F.lit("EUR"))).alias("currency"),
    ).withColumn(
        "rate", F.when(F.col("currency") == "USD", 80).otherwise(90) + F.dayofmonth("rate_date")
    )
    return marts.to_home_currency(foreign, rates)


@query
def home_currency_last_known(bank):
    """Transactions in four currencies by the last rate known, where two days of three have none."""
    foreign = bank.transactions.select(
        "transaction_id",
        "amount",
        F.element_at(
            F.array(*[F.lit(c) for c in ("INR", "USD", "EUR", "GBP")]),
            (F.col("transaction_id") % 4 + 1).cast("int"),
        ).alias("currency"),
        dates.day_of("timestamp").alias("transaction_date"),
    )
    day = dates.day_of("timestamp")
    days = bank.transactions.where(F.dayofmonth(day) % 3 == 2).select(day.alias("rate_date")).distinct()
    rates = days.select(
        "rate_date",
        F.explode(F.array(F.lit("USD"), F.lit("EUR"))).alias("currency"),
    ).withColumn(
        "rate", F.when(F.col("currency") == "USD", 80).otherwise(90) + F.dayofmonth("rate_date")
    )
    return marts.to_home_currency_last_known(foreign, rates)


@query
def last_deposit_before(bank):
    """Every transaction with the last deposit of its customer at or before its time."""
    rows = bank.transactions.select("transaction_id", "customer_id", "timestamp")
    deposits = bank.transactions.where("transaction_type = 'DEPOSIT'").select(
        "customer_id",
        "timestamp",
        F.col("transaction_id").alias("deposit_id"),
        F.col("amount").alias("deposit_amount"),
    )
    return asof.asof_join(
        rows, deposits, ["customer_id"], "timestamp", "timestamp", ["deposit_id", "deposit_amount"]
    )


@query
def transaction_classes(bank):
    return bank.transactions.groupBy(marts.transaction_class().alias("transaction_class")).agg(
        F.count(F.lit(1)).alias("row_count"), sum_money("amount").alias("total_amount")
    )


@query
def branch_activity(bank):
    return marts.branch_activity(bank.transactions, bank.revenue_lines)


@query
def branch_size(bank):
    return marts.branch_size(bank.branches)


@query
def loan_risk_classes(bank):
    return marts.loan_risk_classes(bank.loans)


@query
def loan_risk_shares(bank):
    return marts.loan_risk_shares(bank.loans)


@query
def midnight_transfers(bank):
    return marts.midnight_transfers(bank.transactions, 2000)


@query
def rapid_city_use(bank):
    return marts.rapid_city_use(bank.transactions, bank.branches, 60)


@query
def provisions(bank):
    """Reserves on loans whose rating comes from the rate risk."""
    rated = bank.loans.withColumn(
        "risk_rating", F.regexp_replace(bands.rate_risk(), " Risk$", "")
    )
    return marts.provisions(rated)


@query
def interventions(bank):
    return marts.interventions(_scores(bank))


def _given_scores(bank: BankTables) -> DataFrame:
    """Loans scored by given weights; held to nine decimals, as exponentials differ in the last digit."""
    probability = F.rint(GIVEN_SCORER.probability() * 1e9) / 1e9
    return scoring.scored(_features(bank), probability, RUN_TS)


@query
def loan_scores_given(bank):
    return gold.loan_risk_view(_given_scores(bank))


@query
def interventions_given(bank):
    return marts.interventions(_given_scores(bank))


@query
def revenue_by_segment(bank):
    return marts.revenue_by_segment(bank.revenue, bank.customers)


@query
def default_rate_by_region(bank):
    return marts.default_rate_by_region(_features(bank), bank.branches)


@query
def threshold_metrics(bank):
    """Precision and recall of the outstanding share as a predictor of the label."""
    scored = _features(bank).withColumn(
        "probability", F.least(F.col("outstanding_balance") / 2000000, F.lit(1.0))
    )
    return risk.threshold_metrics(scored, "probability", "is_default", THRESHOLDS)


@query
def rate_drift(bank):
    """Drift of loan amounts between closed and active loans."""
    closed = bank.loans.filter(F.col("status") == "CLOSED")
    active = bank.loans.filter(F.col("status") == "ACTIVE")
    drift = risk.drift_index(
        closed, active, "loan_amount", [250000.0, 500000.0, 1000000.0, 1500000.0]
    )
    # Logarithms differ in the last digit between engines.
    return drift.withColumn("stability_index", F.rint(F.col("stability_index") * 1e12) / 1e12)


@query
def percentile_bands(bank):
    """Branches banded by percentiles of their cost ratio in place of fixed bounds."""
    mart = _branch_mart(bank)
    low, high = risk.percentile_bounds(mart, "cost_income_ratio", [0.25, 0.75])
    return mart.select(
        "branch_id",
        "cost_income_ratio",
        bands.band("cost_income_ratio", [(low, "Low Cost"), (high, "Typical")], "High Cost").alias(
            "cost_band"
        ),
    )


CASCADE = (
    cascade.Reference("loans", "customer_id", "customers", "customer_id"),
    cascade.Reference("revenue", "loan_id", "loans", "loan_id"),
    cascade.Reference("transactions", "customer_id", "customers", "customer_id"),
    cascade.Reference("transactions", "branch_id", "branches", "branch_id"),
)


@query
def cascade_gate(bank):
    """Rejected rows over three levels: customers, their loans, the revenue of those; and transactions."""
    tables = {
        "revenue": bank.revenue_lines.withColumnRenamed("l_orderkey", "loan_id"),
        "transactions": bank.transactions,
        "loans": bank.loans,
        "branches": bank.branches,
        "customers": bank.customers,
    }
    ids = {"revenue": "revenue_id", "transactions": "transaction_id", "loans": "loan_id"}
    ids |= {"branches": "branch_id", "customers": "customer_id"}
    checked = cascade.cascade(tables, quality.GATES, CASCADE)
    return integrity.union_all(
        [
            c.rejected(RUN_TS).select(
                F.lit(name).alias("entity"),
                F.col(ids[name]).cast("bigint").alias("row_id"),
                F.array_join("violations", "; ").alias("violations"),
            )
            for name, c in checked.items()
        ]
    )


@query
def monthly_revenue_refreshed(bank):
    """Monthly revenue kept up to date: a first run without some lines, a second that reads changed months."""
    spark = bank.spark
    source, mart = fresh_folder(spark, "silver-revenue"), fresh_folder(spark, "monthly-revenue")
    lines = silver.with_month(bank.revenue_lines.drop("l_orderkey"), "event_date")
    early = (F.col("month") >= "1995") | (F.col("branch_id") % 2 == 0)
    overwrite_parquet(lines.where(early), source, ["month"])
    monthly.refresh_months(spark, source, mart, marts.monthly_revenue)
    overwrite_parquet(lines.where("month < '1995'"), source, ["month"], only_given_partitions=True)
    monthly.refresh_months(spark, source, mart, marts.monthly_revenue)
    schema = "branch_id bigint, revenue_type string, amount double, month string"
    return monthly.stored_months(spark, mart, schema)
