from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgermill.functions import bands, dates, draws, money, text


def values(spark, kind, items, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


@pytest.mark.parametrize(
    "build, inputs, expected",
    [
        (
            bands.age_group,
            [24, 25, 34, 35, 44, 45, 54, 55, 64, 65, None],
            ["18-24", "25-34", "25-34", "35-44", "35-44", "45-54", "45-54", "55-64", "55-64", "65+", "65+"],
        ),
        (bands.income_segment, [299999, 300000, 799999, 800000, None], ["Low", "Medium", "Medium", "High", "High"]),
        (bands.balance_segment, [49999, 50000, 199999, 200000, None], ["Low", "Medium", "Medium", "High", "High"]),
        (bands.amount_category, [499, 500, 4999, 5000, None], ["Small", "Medium", "Medium", "Large", "Large"]),
        (
            bands.efficiency_rating,
            [0.49, 0.5, 0.6, 0.7, None],
            ["Excellent", "Good", "Fair", "Needs Improvement", "Needs Improvement"],
        ),
        (
            bands.productivity_rating,
            [100.1, 100, 50.1, 50, None],
            ["High Productivity", "Medium Productivity", "Medium Productivity", "Low Productivity", "Low Productivity"],
        ),
        (bands.value_tier, [0.31, 0.3, 0.11, 0.1, None], ["High Value", "Medium Value", "Medium Value", "Low Value", "Low Value"]),
        (bands.rate_category, [0.121, 0.12, 0.101, 0.10, None], ["High Rate", "Medium Rate", "Medium Rate", "Low Rate", "Low Rate"]),
        (
            bands.rate_risk,
            [0.141, 0.14, 0.121, 0.12, 0.101, 0.1, None],
            ["Critical Risk", "High Risk", "High Risk", "Moderate Risk", "Moderate Risk", "Low Risk", "Low Risk"],
        ),
        (
            bands.risk_rating,
            [0.24, 0.25, 0.54, 0.55, 0.79, 0.8, None],
            ["Low", "Moderate", "Moderate", "High", "High", "Critical", "Critical"],
        ),
        (
            bands.customer_segment,
            [500000.01, 500000, 100000.01, 100000, None],
            ["PREMIUM", "STANDARD", "STANDARD", "BASIC", "BASIC"],
        ),
    ],
)
def test_band_edges(spark, build, inputs, expected):
    inputs = [None if v is None else float(v) for v in inputs]
    assert values(spark, "double", inputs, build("x")) == expected


def test_dashboard_rate_bounds_differ(spark):
    got = values(
        spark, "double", [0.118, 0.097],
        bands.rate_category("x", bands.RATE_CATEGORIES_DASHBOARD),
    )
    assert got == ["High Rate", "Medium Rate"]


def test_risk_action(spark):
    got = values(spark, "string", ["Critical", "High", "Moderate", "Low", None], bands.risk_action("x"))
    assert got == [
        "Action Needed: Credit Review", "Action Needed: Credit Review", "Monitor Performance",
        "Healthy Credit", "Healthy Credit",
    ]


def test_transaction_dates(spark):
    given = ["5/8/94", "5/8/49", "5/8/50", "31/2/90", "nan", "", None, "5/8/1994", "1/2", "a/b/90", " 7/1/16 "]
    assert values(spark, "string", given, dates.parse_dmy("x")) == [
        date(1994, 8, 5), date(2049, 8, 5), date(1950, 8, 5), None, None, None, None,
        date(1994, 8, 5), None, None, date(2016, 1, 7),
    ]


def test_birth_dates(spark):
    given = ["1/1/1800", "nan", "", None, "5/8/94", "5/8/49", "5/8/50", "31/2/90", "1/1/1900", "1/1/05", "2/1/1801"]
    got = values(spark, "string", given, dates.parse_dob("x", F.lit(date(2024, 6, 30))))
    assert got == [None, None, None, None, date(1994, 8, 5), None, None, None, None, date(2005, 1, 1), None]


def test_age_counts_the_birthday(spark):
    born = [date(2000, 6, 30), date(2000, 7, 1), date(2000, 2, 29), None]
    assert values(spark, "date", born, dates.age_years("x", F.lit(date(2024, 6, 30)))) == [24, 23, 24, None]
    assert values(spark, "date", [date(2000, 2, 29)], dates.age_years("x", F.lit(date(2023, 2, 28)))) == [22]


def test_day_and_month(spark):
    assert values(spark, "string", ["2024-03-05", "2024-03-05 10:00:00", "x", None], dates.day_of("x")) == [
        date(2024, 3, 5), date(2024, 3, 5), None, None,
    ]
    assert values(spark, "date", [date(2024, 3, 5)], dates.month_key(dates.month_start("x"))) == ["2024-03"]
    assert values(spark, "date", [date(2024, 3, 5)], dates.shift_days("x", -5)) == [date(2024, 2, 29)]


def test_text_cleaning(spark):
    assert values(spark, "string", ["male", "F", "", None], text.gender_letter("x")) == ["M", "F", None, None]
    assert values(spark, "string", ["NAVI MUMBAI", "o'neil-town", "", None], text.city_name("x")) == [
        "Navi Mumbai", "O'neil-town", None, None,
    ]
    assert values(spark, "string", ["HOME_LOAN"], text.code_label("x")) == ["Home Loan"]
    assert values(spark, "string", ["P_12_3", "plain"], text.account_id("x")) == ["ACC_12", "ACC_plain"]
    assert values(spark, "string", ["7", None], text.prefixed_id("x", "P_")) == ["P_7", "P_UNKNOWN"]
    assert values(spark, "string", ["a", "b", None], text.mapped("x", {"a": "1"}, F.lit("?"))) == ["1", "?", "?"]


def test_numbers(spark):
    assert values(spark, "string", ["1.5", "abc", "", None, "NaN"], money.number_or("x")) == [1.5, 0, 0, 0, 0]
    assert values(spark, "string", ["abc", "2"], money.number_or("x", None)) == [None, 2.0]
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (1.0, None), (None, 2.0), (1.0, -1.0)], "a double, b double")
    assert [r[0] for r in df.select(money.safe_ratio("a", "b")).collect()] == [0.5, 0.0, 0.0, None, 0.0]
    assert [r[0] for r in df.select(money.safe_ratio("a", "b", 0.5)).collect()] == [0.5, 0.5, 0.5, None, 0.5]
    assert [r[0] for r in df.select(money.plain_ratio("a", "b")).collect()] == [0.5, None, None, None, -1.0]


def test_money_sum_is_exact_in_any_order(spark):
    items = [0.1] * 1000 + [1e9 + 0.01] * 3 + [None, float("nan")]
    df = spark.createDataFrame([(v,) for v in items], "x double")
    for parts in (1, 7):
        total, mean = df.repartition(parts).agg(money.sum_money("x"), money.mean_money("x")).first()
        assert total == 3000000100.03
        assert mean == pytest.approx(3000000100.03 / 1003, rel=1e-15)


def test_display_text(spark):
    assert values(spark, "double", [64200000.0], money.as_crore("x")) == ["₹6.42 Cr"]
    assert values(spark, "double", [1234567.891], money.as_rupees("x")) == ["₹1,234,567.89"]
    assert values(spark, "double", [0.5314], money.as_percent("x")) == ["53.1%"]


def test_draws_repeat_and_cover(spark):
    df = spark.range(20000)
    for draw in (draws.hash_draw("id", 3), draws.number_draw("id", 3)):
        a = df.repartition(9).select("id", draw.alias("d")).orderBy("id").collect()
        b = df.coalesce(1).select("id", draw.alias("d")).orderBy("id").collect()
        assert a == b
        share = sum(r.d < draws.DRAW_RANGE * 0.2 for r in a) / len(a)
        assert 0.17 < share < 0.23
    assert values(spark, "bigint", [0], draws.draw_between(F.col("x"), 25, 65)) == [25]
    assert values(spark, "bigint", [draws.DRAW_RANGE - 1], draws.draw_between(F.col("x"), 25, 65)) == [64]
    assert values(spark, "bigint", [0, draws.DRAW_RANGE - 1], draws.pick(F.col("x"), ["a", "b", "c"])) == ["a", "c"]
    weights = [("a", 0.25), ("b", 0.5), ("c", 0.25)]
    edges = [0, 2**29 - 1, 2**29, 3 * 2**29 - 1, 3 * 2**29, 2**31 - 1]
    assert values(spark, "bigint", edges, draws.weighted_pick(F.col("x"), weights)) == ["a", "a", "b", "b", "c", "c"]
    positions = {r[0] for r in df.select(draws.hash_range("id", 16)).distinct().collect()}
    assert positions == set(range(16))
