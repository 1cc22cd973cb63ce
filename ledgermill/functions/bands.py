"""Banding of a measure into labels.

``band`` takes upper bounds (``value < bound``), ``band_desc`` lower bounds
(``value > bound``). A NULL measure fails every comparison and so takes the last
label, which is what a SQL ``ELSE`` does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Bounds = Sequence[tuple[float, str]]

# --- fixed values -----------------------------------------------------------

AGE_GROUPS = [(25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54"), (65, "55-64")]
INCOME_SEGMENTS = [(300000, "Low"), (800000, "Medium")]
BALANCE_SEGMENTS = [(50000, "Low"), (200000, "Medium")]
AMOUNT_CATEGORIES = [(500, "Small"), (5000, "Medium")]
EFFICIENCY_RATINGS = [(0.5, "Excellent"), (0.6, "Good"), (0.7, "Fair")]
PRODUCTIVITY_RATINGS = [(100, "High Productivity"), (50, "Medium Productivity")]
VALUE_TIERS = [(0.3, "High Value"), (0.1, "Medium Value")]
RATE_CATEGORIES = [(0.12, "High Rate"), (0.10, "Medium Rate")]
RATE_CATEGORIES_DASHBOARD = [(0.115, "High Rate"), (0.095, "Medium Rate")]
RATE_RISKS = [(0.14, "Critical Risk"), (0.12, "High Risk"), (0.10, "Moderate Risk")]
RISK_RATINGS = [(0.25, "Low"), (0.55, "Moderate"), (0.80, "High")]
CUSTOMER_SEGMENTS = [(500000, "PREMIUM"), (100000, "STANDARD")]


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def band(value: Column | str, bounds: Bounds, otherwise: str) -> Column:
    """First label whose bound lies strictly above the value."""
    measure = as_column(value)
    (first, label), *rest = bounds
    chain = F.when(measure < first, label)
    for upper, label in rest:
        chain = chain.when(measure < upper, label)
    return chain.otherwise(otherwise)


def band_desc(value: Column | str, bounds: Bounds, otherwise: str) -> Column:
    """First label whose bound lies strictly below the value."""
    measure = as_column(value)
    (first, label), *rest = bounds
    chain = F.when(measure > first, label)
    for lower, label in rest:
        chain = chain.when(measure > lower, label)
    return chain.otherwise(otherwise)


def age_group(age="age") -> Column:
    return band(age, AGE_GROUPS, "65+")


def income_segment(income="annual_income") -> Column:
    return band(income, INCOME_SEGMENTS, "High")


def balance_segment(balance="account_balance") -> Column:
    return band(balance, BALANCE_SEGMENTS, "High")


def amount_category(amount="amount") -> Column:
    return band(amount, AMOUNT_CATEGORIES, "Large")


def efficiency_rating(ratio="cost_income_ratio") -> Column:
    return band(ratio, EFFICIENCY_RATINGS, "Needs Improvement")


def productivity_rating(per_staff="transaction_per_staff") -> Column:
    return band_desc(per_staff, PRODUCTIVITY_RATINGS, "Low Productivity")


def value_tier(margin="profit_margin") -> Column:
    return band_desc(margin, VALUE_TIERS, "Low Value")


def rate_category(rate="avg_interest_rate", bounds: Bounds = RATE_CATEGORIES) -> Column:
    return band_desc(rate, bounds, "Low Rate")


def rate_risk(rate="interest_rate") -> Column:
    return band_desc(rate, RATE_RISKS, "Low Risk")


def risk_rating(probability="default_probability") -> Column:
    return band(probability, RISK_RATINGS, "Critical")


def customer_segment(balance="account_balance") -> Column:
    return band_desc(balance, CUSTOMER_SEGMENTS, "BASIC")


def risk_action(rating="risk_rating") -> Column:
    rating = as_column(rating)
    return (
        F.when(rating.isin("High", "Critical"), "Action Needed: Credit Review")
        .when(rating == "Moderate", "Monitor Performance")
        .otherwise("Healthy Credit")
    )
