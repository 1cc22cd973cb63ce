"""Business-intelligence marts over Silver and Gold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.functions import bands
from ledgermill.functions.dates import month_key, month_start
from ledgermill.functions.money import (
    as_crore,
    as_percent,
    as_rupees,
    mean_money,
    mean_rate,
    mean_ratio,
    paise,
    plain_ratio,
    rupees,
    safe_ratio,
    sum_money,
)
from ledgermill.functions.text import mapped
from ledgermill.operators.allocation import allocate
from ledgermill.operators.asof import asof_join, month_pane
from ledgermill.operators.ranking import (
    distinguish_labels,
    latest_n,
    restrict_to,
    severity_rank,
    top_and_bottom,
    top_n,
)
from ledgermill.schemas import PRODUCT_OF_REVENUE, RISK_SEVERITY
from ledgermill.sources.paths import stored

# --- monthly facts ----------------------------------------------------------


def _by_month(
    df: DataFrame, day: str, keys: Sequence[str], aggregates: Sequence[Column]
) -> DataFrame:
    """Group by keys and month; the label is formatted once per group.

    Rows without a day or a key belong to no group.
    """
    return (
        df.dropna(subset=[day, *keys])
        .groupBy(*keys, month_start(day).alias("_month"))
        .agg(*aggregates)
        .withColumn("month", month_key("_month"))
        .drop("_month")
    )


def monthly_revenue(revenue: DataFrame) -> DataFrame:
    return _by_month(
        revenue, "event_date", ["branch_id", "revenue_type"], [sum_money("amount").alias("amount")]
    )


def monthly_costs(costs: DataFrame) -> DataFrame:
    return _by_month(
        costs, "cost_date", ["branch_id", "cost_category"], [sum_money("amount").alias("amount")]
    )


def monthly_loans(loans: DataFrame) -> DataFrame:
    """New loans of any status per branch, type and month."""
    return _by_month(
        loans,
        "start_date",
        ["branch_id", "loan_type"],
        [
            F.count("loan_id").alias("new_loans_count"),
            sum_money("loan_amount").alias("new_loans_amount"),
            sum_money("outstanding_balance").alias("outstanding_amount"),
            mean_rate("interest_rate").alias("avg_interest_rate"),
        ],
    )


def _matched(revenue_monthly: DataFrame, costs_monthly: DataFrame, keys: list[str]) -> DataFrame:
    """Revenue and cost per key; a key missing on one side drops out."""
    earned = revenue_monthly.groupBy(*keys).agg(sum_money("amount").alias("amount_rev"))
    spent = costs_monthly.groupBy(*keys).agg(sum_money("amount").alias("amount_cost"))
    return earned.join(spent, keys, "inner")


def monthly_trend(revenue_monthly: DataFrame, costs_monthly: DataFrame) -> DataFrame:
    return _matched(revenue_monthly, costs_monthly, ["month"]).withColumn(
        "net_income", F.col("amount_rev") - F.col("amount_cost")
    )


def disbursement_trend(loans_monthly: DataFrame) -> DataFrame:
    return loans_monthly.groupBy("month").agg(
        sum_money("new_loans_amount").alias("volume"),
        F.sum("new_loans_count").alias("loan_count"),
    )


# --- branches ---------------------------------------------------------------


def branch_month_ratio(
    revenue_monthly: DataFrame,
    costs_monthly: DataFrame,
    branch_mart: DataFrame,
    n_branches: int = 15,
) -> DataFrame:
    """Cost ratio per month of the branches with the most revenue."""
    chosen = top_n(branch_mart, "total_revenue", "branch_id", n_branches)
    keys = ["branch_id", "month"]
    ratios = _matched(
        restrict_to(revenue_monthly, chosen, "branch_id"),
        restrict_to(costs_monthly, chosen, "branch_id"),
        keys,
    )
    return ratios.select(*keys, plain_ratio("amount_cost", "amount_rev").alias("cir"))


def ratio_matrix(ratios: DataFrame, months: Sequence[str] | None = None) -> DataFrame:
    """Branch rows, one column per given month, else for each month there is.

    The ratios are stored when the months must be looked up first, so the facts
    are read once.
    """
    if months is None:
        ratios = stored(ratios, "branch-month-ratios")
    return ratios.groupBy("branch_id").pivot("month", None if months is None else list(months)).agg(F.max("cir"))


def branch_with_details(branch_view: DataFrame, branches: DataFrame) -> DataFrame:
    return branch_view.join(
        branches.select("branch_id", "branch_name", "city", "region"), "branch_id", "left"
    )


def branch_headline(branch_mart: DataFrame) -> DataFrame:
    return branch_mart.agg(
        F.count(F.lit(1)).alias("total_branches"),
        sum_money("total_revenue").alias("total_revenue"),
        sum_money("total_costs").alias("total_costs"),
        mean_ratio("cost_income_ratio").alias("average_cir"),
        mean_ratio("transaction_per_staff").alias("average_txn_per_staff"),
    )


def top_branches(branch_details: DataFrame, n: int = 10) -> DataFrame:
    """Branches by net income, with labels that stay distinct."""
    best = top_n(branch_details, "net_income", "branch_id", n)
    order = [F.desc_nulls_last("net_income"), F.asc("branch_id")]
    return distinguish_labels(best, "branch_name", "branch_id", order).select(
        "branch_id",
        "branch_name",
        "display_label",
        "city",
        "total_revenue",
        "net_income",
        "cost_income_ratio",
        "efficiency_rating",
    )


def top_bottom_branches(branch_details: DataFrame, n: int = 5) -> DataFrame:
    columns = branch_details.select("branch_id", "branch_name", "net_income")
    return top_and_bottom(columns, "net_income", "branch_id", n)


def branch_drilldown(
    branch_details: DataFrame, loan_view: DataFrame, branch_id: int | str
) -> DataFrame:
    """One branch with its loan exposure; a branch without loans keeps its row."""
    exposure = loan_view.filter(F.col("branch_id") == branch_id).select(
        "branch_id", "total_loan_portfolio", "total_outstanding", "utilization_rate"
    )
    return branch_details.filter(F.col("branch_id") == branch_id).join(
        exposure, "branch_id", "left"
    )


def branch_trend(
    revenue_monthly: DataFrame, costs_monthly: DataFrame, branch_id: int | str
) -> DataFrame:
    chosen = F.col("branch_id") == branch_id
    return _matched(revenue_monthly.filter(chosen), costs_monthly.filter(chosen), ["month"])


# --- executive --------------------------------------------------------------


def executive_summary(
    branch_mart: DataFrame, customers: DataFrame, loan_mart: DataFrame
) -> DataFrame:
    """One row of bank totals."""
    people = customers.agg(F.count(F.lit(1))).scalar()
    loans = loan_mart.agg(F.coalesce(F.sum("active_loans"), F.lit(0))).scalar()
    return (
        branch_mart.agg(
            sum_money("total_revenue").alias("total_revenue"),
            sum_money("total_costs").alias("total_costs"),
            F.count(F.lit(1)).alias("active_branches"),
        )
        .withColumn("net_income", F.col("total_revenue") - F.col("total_costs"))
        .withColumn("cost_income_ratio", safe_ratio("total_costs", "total_revenue"))
        .withColumn("active_customers", people)
        .withColumn("active_loans", loans)
    )


def executive_cards(summary: DataFrame) -> DataFrame:
    """Display texts of the executive row."""
    return summary.select(
        as_crore("total_revenue").alias("total_revenue"),
        as_crore("total_costs").alias("total_costs"),
        as_crore("net_income").alias("net_income"),
        as_percent("cost_income_ratio").alias("cost_income_ratio"),
        F.format_number("active_customers", 0).alias("active_customers"),
        F.format_number("active_loans", 0).alias("active_loans"),
    )


def product_contribution(revenue_monthly: DataFrame) -> DataFrame:
    totals = revenue_monthly.groupBy("revenue_type").agg(sum_money("amount").alias("amount"))
    return totals.withColumn("product", mapped("revenue_type", PRODUCT_OF_REVENUE))


def product_profit(branch_mart: DataFrame) -> DataFrame:
    totals = branch_mart.agg(
        sum_money("total_revenue").alias("total_revenue"),
        sum_money("total_costs").alias("total_costs"),
    )
    return allocate(totals, "total_revenue", "total_costs")


def region_product_revenue(branch_details: DataFrame) -> DataFrame:
    per_region = (
        branch_details.filter(F.col("region").isNotNull())
        .groupBy("region")
        .agg(sum_money("total_revenue").alias("total_revenue"))
    )
    return allocate(per_region, "total_revenue")


# --- customers --------------------------------------------------------------

CUSTOMER_ATTRIBUTES = [
    "age", "city", "account_balance", "annual_income", "age_group", "income_segment",
    "balance_segment", "customer_since",
]


def customer_details(customer_mart: DataFrame, customers: DataFrame) -> DataFrame:
    """A stored customer mart with its tier and the customer's own attributes."""
    present = [c for c in [*CUSTOMER_ATTRIBUTES, "gender", "country"] if c in customers.columns]
    return customer_mart.withColumn("value_tier", bands.value_tier()).join(
        customers.select("customer_id", *present), "customer_id", "left"
    )


def customer_headline(details: DataFrame) -> DataFrame:
    return details.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count_if(F.col("value_tier") == "High Value").alias("high_value_customers"),
        mean_money("total_revenue").alias("avg_revenue"),
        mean_ratio("profit_margin").alias("avg_margin"),
    )


CATEGORIES = ["customer_segment", "value_tier", "age_group", "income_segment", "balance_segment"]


def category_mix(details: DataFrame, categories: Sequence[str] = CATEGORIES) -> DataFrame:
    """Row counts of several categories in one pass; a NULL category is not counted."""
    entries = F.array(
        *[F.struct(F.lit(c).alias("dimension"), F.col(c).alias("category")) for c in categories]
    )
    return (
        details.select(F.explode(entries).alias("e"))
        .select("e.*")
        .filter(F.col("category").isNotNull())
        .groupBy("dimension", "category")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def cohort_profit(details: DataFrame, n_months: int = 15) -> DataFrame:
    """Mean profit and margin by month of joining, latest months."""
    cohorts = _by_month(
        details,
        "customer_since",
        [],
        [
            F.count("customer_id").alias("customer_count"),
            mean_money("net_profit").alias("avg_profit"),
            mean_ratio("profit_margin").alias("avg_margin"),
        ],
    ).withColumnRenamed("month", "cohort_month")
    return latest_n(cohorts, "cohort_month", n_months)


def high_value_by_city(details: DataFrame, n: int = 12) -> DataFrame:
    counts = (
        details.filter((F.col("value_tier") == "High Value") & F.col("city").isNotNull())
        .groupBy("city")
        .agg(F.count("customer_id").alias("hv_customers"))
    )
    return top_n(counts, "hv_customers", "city", n)


def top_customers(details: DataFrame, n: int = 100) -> DataFrame:
    """The most profitable customers, raw figures beside display texts."""
    return top_n(details, "net_profit", "customer_id", n).select(
        "customer_id",
        "customer_segment",
        "account_balance",
        "total_revenue",
        "net_profit",
        "profit_margin",
        "value_tier",
        as_rupees("net_profit").alias("net_profit_text"),
        as_percent("profit_margin").alias("profit_margin_text"),
    )


def negative_profit_customers(customer_mart: DataFrame, n: int | None = None) -> DataFrame:
    """Customers with a loss, all of them or the first ``n`` by id."""
    losing = customer_mart.filter(F.col("net_profit") < 0).select(
        "customer_id",
        "customer_segment",
        "total_revenue",
        "estimated_costs",
        "net_profit",
        "profit_margin",
    )
    return losing if n is None else losing.orderBy("customer_id").limit(n)


# --- loans ------------------------------------------------------------------


def loan_headline(loan_mart: DataFrame) -> DataFrame:
    return loan_mart.agg(
        sum_money("total_loan_portfolio").alias("total_loan_book"),
        sum_money("total_outstanding").alias("total_outstanding"),
        mean_ratio("avg_interest_rate").alias("avg_interest_rate"),
    ).withColumn("overall_utilization", safe_ratio("total_outstanding", "total_loan_book"))


def top_outstanding(loan_view: DataFrame, n: int = 15) -> DataFrame:
    return top_n(loan_view, "total_outstanding", "branch_id", n)


def rate_histogram(loans: DataFrame, bins: int = 12) -> DataFrame:
    """Active loans per equal-width interest-rate bin, all bins from the first to the last.

    The range comes from the rates themselves; the highest rate belongs to the
    last bin. A range without width has the first bin alone.
    """
    rates = loans.filter((F.col("status") == "ACTIVE") & F.col("interest_rate").isNotNull())
    ends = rates.agg(F.struct(F.min("interest_rate").alias("low"), F.max("interest_rate").alias("high"))).scalar()
    ranged = rates.select("interest_rate", ends["low"].alias("low"), ends["high"].alias("high"))
    spread = F.col("high") - F.col("low")
    raw_bin = F.when(
        spread > 0,
        F.floor((F.col("interest_rate") - F.col("low")) * F.lit(bins) / spread) + 1,
    ).otherwise(1)
    filled = (
        ranged.withColumn("bin", F.least(raw_bin, F.lit(bins)).cast("bigint"))
        .groupBy("bin")
        .agg(
            F.count(F.lit(1)).alias("loan_count"),
            F.min("interest_rate").alias("lowest_rate"),
            F.max("interest_rate").alias("highest_rate"),
        )
    )
    every = loans.sparkSession.range(1, bins + 1).withColumnRenamed("id", "bin")
    every = every.where((F.col("bin") == 1) | F.coalesce(ends["low"] != ends["high"], F.lit(True)))
    return every.join(filled, "bin", "left").withColumn(
        "loan_count", F.coalesce("loan_count", F.lit(0).cast("bigint"))
    )


def loan_risk_distribution(loans: DataFrame) -> DataFrame:
    """Loans per rate risk, most severe first."""
    return (
        loans.groupBy(bands.rate_risk().alias("risk_category"))
        .agg(F.count(F.lit(1)).alias("loan_count"))
        .withColumn(
            "severity", severity_rank("risk_category", RISK_SEVERITY).cast("bigint")
        )
        .orderBy("severity", "risk_category")
    )


# --- alerts -----------------------------------------------------------------

HIGH_CIR = 0.70
LOW_PRODUCTIVITY = 50
HIGH_UTILIZATION = 0.75


def _raised(df: DataFrame, key: str, tests: list[tuple[str, str, Column]]) -> DataFrame:
    """One row per input row and condition that fires, in one pass over the input."""
    fired = F.array_compact(
        F.array(
            *[
                F.when(
                    condition,
                    F.struct(
                        F.lit(alert).alias("alert"), F.col(measure).cast("double").alias("measure")
                    ),
                )
                for alert, measure, condition in tests
            ]
        )
    )
    return df.select(
        F.col(key).cast("string").alias("subject_id"),
        "subject_name",
        F.explode(fired).alias("f"),
    ).select("f.alert", "subject_id", "subject_name", "f.measure")


def alerts(
    branch_details: DataFrame,
    customer_mart: DataFrame,
    loan_view: DataFrame,
    branches: DataFrame,
) -> DataFrame:
    """Every branch, customer and loan book beyond its threshold."""
    by_branch = _raised(
        branch_details.withColumn("subject_name", F.col("branch_name")),
        "branch_id",
        [
            ("HIGH_COST_RATIO", "cost_income_ratio", F.col("cost_income_ratio") > HIGH_CIR),
            (
                "LOW_PRODUCTIVITY",
                "transaction_per_staff",
                F.col("transaction_per_staff") < LOW_PRODUCTIVITY,
            ),
        ],
    )
    by_customer = _raised(
        customer_mart.withColumn("subject_name", F.col("customer_segment")),
        "customer_id",
        [("NEGATIVE_PROFIT", "net_profit", F.col("net_profit") < 0)],
    )
    exposed = loan_view.filter(F.col("utilization_rate") > HIGH_UTILIZATION).join(
        branches.select("branch_id", F.col("branch_name").alias("subject_name")),
        "branch_id",
        "left",
    )
    by_book = _raised(
        exposed,
        "branch_id",
        [("HIGH_UTILIZATION", "utilization_rate", F.col("utilization_rate") > HIGH_UTILIZATION)],
    )
    return by_branch.unionByName(by_customer).unionByName(by_book)


def alert_counts(raised: DataFrame) -> DataFrame:
    return raised.groupBy("alert").agg(F.count(F.lit(1)).alias("alert_count"))


# --- documented extras ------------------------------------------------------


def premium_without_active_loan(
    customers: DataFrame, loans: DataFrame, loan_type: str | None = None
) -> DataFrame:
    """Premium customers to offer a loan to, of one type or of any."""
    wanted = F.col("status") == "ACTIVE"
    if loan_type is not None:
        wanted &= F.col("loan_type") == loan_type
    borrowers = loans.filter(wanted).select("customer_id").distinct()
    return (
        customers.filter(F.col("customer_segment") == "PREMIUM")
        .select("customer_id", "city", "account_balance")
        .join(borrowers, "customer_id", "left_anti")
    )


def to_home_currency(
    transactions: DataFrame, rates: DataFrame, home: str = "INR"
) -> DataFrame:
    """Amounts in the home currency by the day's rate; an unknown rate gives NULL."""
    # Stored, so the planner knows the size of the rates and they are computed once.
    daily = stored(
        rates.select("currency", F.col("rate_date").alias("transaction_date"), "rate"), "rates"
    )
    joined = transactions.join(daily, ["currency", "transaction_date"], "left")
    rate = F.when(F.col("currency") == home, F.lit(1.0)).otherwise(F.col("rate"))
    return joined.withColumn("amount_home", F.rint(F.col("amount") * rate * 100) / 100).drop("rate")


def to_home_currency_last_known(
    transactions: DataFrame, rates: DataFrame, home: str = "INR"
) -> DataFrame:
    """Amounts in the home currency by the last rate known on the day; before the first there is none.

    Only the days of each currency meet the rates; the transactions are joined
    with the result, which is stored, so its size is known.
    """
    asked = transactions.select("currency", "transaction_date").distinct()
    known = rates.withColumn("rate_known", F.col("rate_date"))
    found = asof_join(
        asked, known, ["currency"], "transaction_date", "rate_date", ["rate", "rate_known"], month_pane
    )
    found = stored(found.where(F.col("rate_known").isNotNull()), "last-rates")
    joined = transactions.join(found, ["currency", "transaction_date"], "left")
    rate = F.when(F.col("currency") == home, F.lit(1.0)).otherwise(F.col("rate"))
    return joined.withColumn("amount_home", F.rint(F.col("amount") * rate * 100) / 100).drop("rate")


def transaction_class(kind: Column | str = "transaction_type") -> Column:
    kind = bands.as_column(kind)
    return (
        F.when(kind == "DEPOSIT", "Income")
        .when(kind == "WITHDRAWAL", "Withdrawal")
        .when(kind == "TRANSFER", "Transfer")
        .otherwise("Expense")
    )


def branch_activity(transactions: DataFrame, revenue: DataFrame) -> DataFrame:
    """Deposits, withdrawals, mean transaction and revenue per served customer."""
    kind = F.col("transaction_type")
    served = (
        transactions.groupBy("branch_id", "customer_id")
        .agg(
            F.sum(F.when(kind == "DEPOSIT", paise("amount")).otherwise(0)).alias("deposits"),
            F.sum(F.when(kind == "WITHDRAWAL", paise("amount")).otherwise(0)).alias("withdrawals"),
            F.sum(paise("amount")).alias("units"),
            F.count(paise("amount")).alias("n"),
        )
        .groupBy("branch_id")
        .agg(
            rupees(F.sum("deposits")).alias("total_deposits"),
            rupees(F.sum("withdrawals")).alias("total_withdrawals"),
            (F.sum("units").cast("double") / (F.sum("n") * 100)).alias("avg_transaction"),
            F.count("customer_id").alias("customers"),
        )
    )
    earned = revenue.groupBy("branch_id").agg(sum_money("amount").alias("total_revenue"))
    return served.join(earned, "branch_id", "left").withColumn(
        "revenue_per_customer", safe_ratio("total_revenue", "customers")
    )


OUTSTANDING_RISKS = [(1000000, "High"), (500000, "Medium")]


def loan_risk_classes(loans: DataFrame) -> DataFrame:
    """Outstanding share of each loan's value and its outstanding-balance class."""
    return loans.select(
        "loan_id",
        "branch_id",
        safe_ratio("outstanding_balance", "loan_amount", None).alias("loan_to_value"),
        bands.band_desc("outstanding_balance", OUTSTANDING_RISKS, "Low").alias("risk_class"),
    )


def loan_risk_shares(loans: DataFrame) -> DataFrame:
    """Share of loans per outstanding-balance class."""
    from pyspark.sql import Window

    counts = loans.groupBy(
        bands.band_desc("outstanding_balance", OUTSTANDING_RISKS, "Low").alias("risk_class")
    ).agg(F.count(F.lit(1)).alias("loan_count"))
    everything = F.sum("loan_count").over(Window.partitionBy())
    return counts.withColumn("share", F.col("loan_count") / everything)


MIDNIGHT_LIMIT = 100000


def midnight_transfers(transactions: DataFrame, limit: float = MIDNIGHT_LIMIT) -> DataFrame:
    """Large transfers in the first five hours of the day."""
    return transactions.filter(
        (F.col("transaction_type") == "TRANSFER")
        & (F.col("amount") > limit)
        & (F.hour("timestamp") < 5)
    ).select("transaction_id", "customer_id", "branch_id", "amount", "timestamp")


def rapid_city_use(
    transactions: DataFrame, branches: DataFrame, minutes: int = 60
) -> DataFrame:
    """Uses that follow the customer's use before in another city within ``minutes``.

    Two uses in different cities within the limit always have such a change of
    city between them, whatever the clock says. A branch that is not known is a
    place of its own. Uses of one time are ordered by their id.

    A customer's uses are ordered within panes as long as the limit; each pane
    also holds those of the pane before, so a customer with many uses is spread
    over as many tasks as panes.
    """
    length = minutes * 60
    place = F.coalesce("city", F.concat(F.lit("branch "), F.col("branch_id").cast("string")))
    pane = F.floor(F.unix_timestamp("timestamp") / length)
    placed = (
        transactions.select("transaction_id", "customer_id", "branch_id", "timestamp")
        .join(branches.select("branch_id", "city"), "branch_id", "left")
        .select("transaction_id", "customer_id", place.alias("city"), "timestamp", pane.alias("own"))
    )
    order = Window.partitionBy("customer_id", "pane").orderBy("timestamp", "transaction_id")
    before = F.lag(F.struct("city", "timestamp")).over(order)
    followed = (
        placed.withColumn("pane", F.explode(F.array(F.col("own"), F.col("own") + 1)))
        .withColumn("before", before)
        .filter((F.col("pane") == F.col("own")) & (F.col("before.city") != F.col("city")))
    )
    apart = F.unix_micros("timestamp") - F.unix_micros("before.timestamp")
    return followed.filter(apart <= length * 1_000_000).select(
        "transaction_id",
        "customer_id",
        "city",
        "timestamp",
        F.col("before.city").alias("previous_city"),
        F.col("before.timestamp").alias("previous_timestamp"),
    )


PROVISION_RATE = 0.15


def provisions(scores: DataFrame, rate: float = PROVISION_RATE) -> DataFrame:
    """Reserve on the outstanding balance of high and critical loans per branch."""
    exposed = F.when(F.col("risk_rating").isin("High", "Critical"), F.col("outstanding_balance"))
    return (
        scores.groupBy("branch_id")
        .agg(F.coalesce(sum_money(exposed), F.lit(0.0)).alias("exposed_balance"))
        .withColumn("provision", F.col("exposed_balance") * F.lit(rate))
    )


def interventions(scores: DataFrame) -> DataFrame:
    """High-risk loans, the likeliest default of each branch first; rows, never a list in one cell."""
    return (
        scores.filter(F.col("risk_rating").isin("High", "Critical"))
        .select("branch_id", "loan_id", "customer_id", "outstanding_balance", "default_probability")
        .orderBy("branch_id", F.desc("default_probability"), "loan_id")
    )


def revenue_by_segment(revenue: DataFrame, customers: DataFrame) -> DataFrame:
    """Revenue per customer segment; facts are summed per customer before the join."""
    earned = revenue.groupBy("customer_id").agg(sum_money("amount").alias("amount"))
    return (
        earned.join(customers.select("customer_id", "customer_segment"), "customer_id")
        .groupBy("customer_segment")
        .agg(sum_money("amount").alias("total_revenue"))
    )


def default_rate_by_region(labelled: DataFrame, branches: DataFrame) -> DataFrame:
    """Share of loans labelled as defaults per region."""
    per_branch = labelled.groupBy("branch_id").agg(
        F.count(F.lit(1)).alias("loans"), F.sum("is_default").alias("defaults")
    )
    return (
        per_branch.join(branches.select("branch_id", "region"), "branch_id")
        .groupBy("region")
        .agg(F.sum("loans").alias("loans"), F.sum("defaults").alias("defaults"))
        .withColumn("default_rate", safe_ratio("defaults", "loans"))
    )


def branch_size(branches: DataFrame) -> DataFrame:
    """Branch size class by staff."""
    return branches.select(
        "branch_id",
        "staff_count",
        bands.band("staff_count", [(15, "Small"), (35, "Medium")], "Large").alias("size_class"),
    )
