"""The cascade against walking the rules row by row."""

import random
from datetime import datetime

import pytest

from ledgermill.operators.cascade import Reference, cascade, dependency_order
from ledgermill.operators.quality import Gate

NOW = datetime(2024, 1, 1)
REFERENCES = [
    Reference("b", "a_id", "a", "id"),
    Reference("c", "b_id", "b", "id"),
    Reference("c", "a_id", "a", "id"),
    Reference("a", "boss", "a", "id"),
]


def plain(tables, references):
    """Rows (table, position) that stand: drop what has no valid parent until nothing changes."""
    standing = {(t, i) for t, rows in tables.items() for i, row in enumerate(rows) if row["ok"] is True}
    while True:
        keys = {(r.parent, r.parent_key): {tables[r.parent][i][r.parent_key] for t, i in standing if t == r.parent} for r in references}
        left = {
            (t, i)
            for t, i in standing
            if all(tables[t][i][r.key] is None or tables[t][i][r.key] in keys[r.parent, r.parent_key] for r in references if r.child == t)
        }
        if left == standing:
            return left
        standing = left


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_plain_rounds(spark, seed):
    draw = random.Random(seed)
    key = lambda n: draw.choice([None, *range(n)])
    ok = lambda: draw.random() < 0.85 or draw.choice([False, None])
    tables = {
        "c": [{"n": i, "id": i, "b_id": key(24), "a_id": key(18), "ok": ok()} for i in range(60)],
        "b": [{"n": i, "id": key(22), "a_id": key(18), "ok": ok()} for i in range(30)],
        "a": [{"n": i, "id": key(16), "boss": key(16), "ok": ok()} for i in range(20)],
    }
    columns = {"a": "n int, id int, boss int, ok boolean", "b": "n int, id int, a_id int, ok boolean", "c": "n int, id int, b_id int, a_id int, ok boolean"}
    frames = {t: spark.createDataFrame([tuple(r[x.split()[0]] for x in columns[t].split(", ")) for r in rows], columns[t]) for t, rows in tables.items()}
    gates = {t: Gate(t, [], {"not ok": "ok"}) for t in tables}
    checked = cascade(frames, gates, REFERENCES)
    standing = plain(tables, REFERENCES)
    for name, c in checked.items():
        assert {(name, r.n) for r in c.valid().collect()} == {s for s in standing if s[0] == name}
        rejected = c.rejected(NOW)
        assert {r.n for r in rejected.collect()} == {i for i in range(len(tables[name])) if (name, i) not in standing}
        assert not [x for x in rejected.columns if x.startswith("_")]


def test_reasons_tell_absent_from_rejected(spark):
    a = spark.createDataFrame([(1, True), (2, False)], "id int, ok boolean")
    b = spark.createDataFrame([(1,), (2,), (3,), (None,)], "a_id int")
    gates = {"a": Gate("a", [], {"not ok": "ok"}), "b": Gate("b", ["a_id"])}
    rows = cascade({"b": b, "a": a}, gates, [Reference("b", "a_id", "a", "id")])["b"].rejected(NOW).collect()
    assert {r.a_id: r.violations for r in rows} == {
        2: ["a_id is rejected in a"], 3: ["a_id is not in a"], None: ["a_id is missing"],
    }


def test_order_and_unknown_tables(spark):
    assert dependency_order(["c", "b", "a"], REFERENCES) == [["a"], ["b"], ["c"]]
    circle = [*REFERENCES, Reference("a", "c_id", "c", "id")]
    assert dependency_order(["c", "b", "a", "d"], circle) == [["c", "b", "a"], ["d"]]
    with pytest.raises(ValueError):
        dependency_order(["b"], REFERENCES)


def test_empty_tables(spark):
    a = spark.createDataFrame([], "id int")
    b = spark.createDataFrame([(1,)], "a_id int")
    checked = cascade({"a": a, "b": b}, {}, [Reference("b", "a_id", "a", "id")])
    assert checked["a"].valid().count() == 0 and checked["b"].rejected(NOW).count() == 1
