"""The as-of join against looking through all right rows of each left row."""

import random
from datetime import datetime, timedelta

import pytest

from ledgermill.operators.asof import asof_join, month_pane, day_pane

START = datetime(2024, 1, 1)


def plain(left, right):
    for i, key, at, *_ in left:
        found = [(t, v, w) for k, t, v, w in right if None not in (k, t, key, at) and k == key and t <= at]
        low = lambda x: (x is not None, x or 0)
        best = max(found, key=lambda x: (x[0], low(x[1]), low(x[2])), default=(None, None, None))
        yield i, best[1], best[2]


@pytest.mark.parametrize("pane", [month_pane, day_pane])
def test_against_all_rows(spark, pane):
    draw = random.Random(5)
    time = lambda: draw.choice([None, *[START + timedelta(hours=draw.randrange(24 * 90)) for _ in range(20)]])
    key = lambda: draw.choice(["hot", "hot", "hot", "x", "y", None])
    left = [(i, key(), time(), "clash", {"m": 1}) for i in range(300)]
    right = [(key(), time(), draw.choice([None, 1, 2, 3]), draw.choice([None, 1.5])) for _ in range(60)]
    right += right[:10] + [(k, t, 2, 0.5) for k, t, *_ in right[:10]]
    l = spark.createDataFrame(left, "id int, k string, at timestamp, other string, tags map<string,int>")
    r = spark.createDataFrame(right, "k string, at timestamp, v int, w double")
    got = asof_join(l, r, ["k"], "at", "at", ["v", "w"], pane)
    assert got.columns == [*l.columns, "v", "w"]
    rows = got.collect()
    assert sorted((x.id, x.v, x.w) for x in rows) == sorted(plain(left, right))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_empty_sides_and_clashes(spark):
    l = spark.createDataFrame([(1, "a", START)], "id int, k string, at timestamp")
    r = spark.createDataFrame([("a", START, 7)], "k string, at timestamp, v int")
    assert [x.v for x in asof_join(l, r.limit(0), ["k"], "at", "at", ["v"]).collect()] == [None]
    assert asof_join(l.where("id > 1"), r, ["k"], "at", "at", ["v"]).count() == 0
    assert [x.v for x in asof_join(l, r, ["k"], "at", "at", ["v"]).collect()] == [7]
    with pytest.raises(ValueError):
        asof_join(l, r.withColumnRenamed("v", "id"), ["k"], "at", "at", ["id"])
