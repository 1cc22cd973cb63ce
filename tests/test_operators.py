import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgermill.functions.draws import number_draw
from ledgermill.operators import allocation, joins, profiling, ranking, sampling, selection, surrogate


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-(2**62), 2**62), min_size=1, max_size=30), st.data())
def test_nth_smallest_matches_sorting(spark, numbers, data):
    rank = data.draw(st.integers(0, len(numbers) - 1))
    df = spark.createDataFrame([(n,) for n in numbers], "x bigint")
    counts = selection.value_counts(df, F.col("x"))
    assert selection.nth_smallest(counts, rank, buckets=256) == sorted(numbers)[rank]


def test_nth_smallest_extremes(spark):
    numbers = [-(2**63) + 5, 2**63 - 2, 0, 0]
    counts = selection.value_counts(spark.createDataFrame([(n,) for n in numbers], "x bigint"), F.col("x"))
    assert [selection.nth_smallest(counts, r) for r in (-1, 0, 1, 2, 3, 4)] == [
        None, -(2**63) + 5, 0, 0, 2**63 - 2, None,
    ]


@pytest.mark.parametrize("amounts", [[3.0], [1.25, 2.5], [5.0, -1.0, 7.25], [1.0] * 50 + [9.0] * 49 + [2.0], [4.0, 4.0, 8.0, 8.0]])
def test_median(spark, amounts):
    df = spark.createDataFrame([(a,) for a in [*amounts, None]], "x double")
    assert selection.exact_median_money(df, "x") == statistics.median(amounts)


def test_median_of_nothing(spark):
    assert selection.exact_median_money(spark.createDataFrame([(None,)], "x double"), "x") is None


def test_column_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (None, None), (4, None)], "n int, `odd name` string")
    got = {r.column_name: (r.total_rows, r.present_rows, r.missing_rows, r.missing_pct) for r in profiling.column_nulls(df).collect()}
    assert got == {"n": (4, 3, 1, 25.0), "odd name": (4, 1, 3, 75.0)}
    assert profiling.columns_with_gaps(df.select("n").na.drop()).count() == 0


def test_amount_statistics(spark):
    df = spark.createDataFrame([("a", "1.5"), ("a", "2.5"), ("b", "bad"), (None, "8")], "k string, v string")
    got = profiling.amount_statistics(df, "v", "k").first().asDict()
    assert got == {
        "total_rows": 4, "distinct_keys": 2, "rows_per_key": 2.0, "total_amount": 12.0,
        "mean_amount": 4.0, "min_amount": 1.5, "max_amount": 8.0, "median_amount": 2.5,
    }
    near = profiling.approximate_distinct(df, ["k", "v"]).first()
    assert (near.k, near.v) == (2, 4)


@pytest.fixture(scope="module")
def scores(spark):
    rows = [("b", 5.0), ("a", 5.0), ("c", None), ("d", 9.0), ("e", -2.0)]
    return spark.createDataFrame(rows, "k string, m double")


def test_rankings(scores):
    assert [r.k for r in ranking.top_n(scores, "m", "k", 3).collect()] == ["d", "a", "b"]
    assert [r.k for r in ranking.bottom_n(scores, "m", "k", 2).collect()] == ["e", "a"]
    assert [r.k for r in ranking.top_n(scores, "m", "k", 9).collect()][-1] == "c"
    both = ranking.top_and_bottom(scores, "m", "k", 2).collect()
    assert sorted((r.k, r.group_label) for r in both) == [
        ("a", "Bottom 2"), ("a", "Bottom 2"), ("d", "Top 2"), ("e", "Bottom 2"),
    ]


def test_latest_periods_and_distinct(spark):
    df = spark.createDataFrame([("2024-01",), ("2024-03",), ("2024-02",), ("2024-03",)], "p string")
    assert [r.p for r in ranking.latest_n(df.distinct(), "p", 2).collect()] == ["2024-02", "2024-03"]
    assert [r.p for r in ranking.distinct_sorted(df, "p").collect()] == ["2024-01", "2024-02", "2024-03"]


def test_first_per_key_with_a_hot_key(spark):
    rows = [("hot", i) for i in range(400, 0, -1)] + [("cold", 7), (None, 3), (None, 2)]
    df = spark.createDataFrame(rows, "k string, o int").repartition(6)
    got = {r.k: r.o for r in ranking.first_per_key(df, "k", ["o"]).collect()}
    assert got == {"hot": 1, "cold": 7, None: 2}


def test_labels_and_severity(spark):
    df = spark.createDataFrame([(1, "Main", 9.0), (2, "Main", 5.0), (3, None, 1.0)], "id int, n string, m double")
    got = ranking.distinguish_labels(df, "n", "id", [F.desc("m")]).collect()
    assert {r.id: r.display_label for r in got} == {1: "Main", 2: "Main (2)", 3: "Branch"}
    names = spark.createDataFrame([("Low",), ("Odd",), ("High",)], "n string")
    order = names.orderBy(ranking.severity_rank("n", ["High", "Low"])).collect()
    assert [r.n for r in order] == ["High", "Low", "Odd"]


def test_key_samples(spark):
    df = spark.range(3000).select((F.col("id") % 1000).alias("k"))
    draw = number_draw("k", 5)
    loose = {r.k for r in sampling.sample_keys(df, "k", draw, 0.3).collect()}
    exact = [r.k for r in sampling.sample_keys_exact(df, "k", draw, 0.3).collect()]
    assert 250 < len(loose) < 350
    assert len(exact) == len(set(exact)) == 300
    draws = sorted((((k + 5) % 2**31 * 1103515245 + 12345) % 2**31, k) for k in range(1000))
    assert set(exact) == {k for _, k in draws[:300]}
    assert sampling.sample_keys_exact(df, "k", F.lit(1), 0.25).count() == 250
    assert sampling.sample_keys_exact(df.limit(0), "k", draw, 0.25).count() == 0


def test_contiguous_sample(spark):
    df = spark.range(100).withColumnRenamed("id", "o")
    for seed in range(3):
        rows = sorted(r.o for r in sampling.contiguous_sample(df, "o", 10, seed).collect())
        assert rows == list(range(rows[0], rows[0] + 10))
    assert sampling.contiguous_sample(df, "o", 500).count() == 100
    assert sampling.contiguous_sample(df, "o", None).count() == 100


def test_repeat_and_display_sample(spark):
    df = spark.createDataFrame([(1, 2), (2, 0), (3, 1)], "k int, n int")
    got = sampling.repeat_rows(df, F.col("n")).collect()
    assert sorted((r.k, r.copy) for r in got) == [(1, 1), (1, 2), (3, 1)]
    big = spark.range(100)
    a = sampling.sample_rows(big, "id", number_draw("id", 1), 7).collect()
    assert a == sampling.sample_rows(big.repartition(5), "id", number_draw("id", 1), 7).collect()


def test_surrogate_ids_are_dense_and_stable(spark):
    df = spark.range(1000)
    numbered = surrogate.sequential_ids(df, ["id"], number_draw("id", 2), buckets=16)
    first = {r.id: r.row_number for r in numbered.collect()}
    again = surrogate.sequential_ids(df.repartition(7), ["id"], number_draw("id", 2), buckets=16)
    assert sorted(first.values()) == list(range(1, 1001))
    assert first == {r.id: r.row_number for r in again.collect()}
    with pytest.raises(ValueError):
        surrogate.sequential_ids(df, ["id"], F.col("id"), buckets=10**6)
    ids = spark.createDataFrame([(5,), (123456,)], "n int").select(surrogate.padded_id("n", "X_", 4))
    assert [r[0] for r in ids.collect()] == ["X_0005", "X_123456"]
    rows = [("hot", i) for i in range(500)] + [("cold", 600), (None, 700), (None, 701)]
    grouped = spark.createDataFrame(rows, "g string, o bigint")
    numbered = surrogate.ids_within_group(grouped, "g", ["o"], number_draw("o", 1), 8).collect()
    for group, size in (("hot", 500), ("cold", 1), (None, 2)):
        assert sorted(r.row_number for r in numbered if r.g == group) == list(range(size))


def test_allocation_adds_up(spark):
    df = spark.createDataFrame([("N", 200.0, 100.0)], "region string, r double, c double")
    rows = allocation.allocate(df, "r", "c").collect()
    assert {r.product: (r.revenue, r.costs) for r in rows} == {
        "Loans": (90.0, 30.0), "Savings": (50.0, 25.0), "Credit Cards": (40.0, 30.0), "Investments": (20.0, 15.0),
    }
    assert sum(r.revenue for r in rows) == 200.0
    assert set(allocation.allocate(df.drop("c"), "r").columns) == {"region", "product", "revenue"}
