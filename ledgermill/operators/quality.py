"""Quality gate: split a table into valid and rejected rows, losing none.

A rule that evaluates to NULL counts as failed, so the two sides are always
complementary. The rejected side names every violated rule.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgermill.operators.joins import key_set
from ledgermill.sources.sinks import overwrite_parquet


@dataclass(frozen=True)
class Gate:
    """Keys that must be present and named SQL conditions that must hold."""

    entity: str
    keys: Sequence[str]
    rules: Mapping[str, str] = field(default_factory=dict)

    def conditions(self) -> dict[str, Column]:
        present = {f"{key} is missing": F.col(key).isNotNull() for key in self.keys}
        return present | {name: F.expr(rule) for name, rule in self.rules.items()}

    def with_rule(self, name: str, rule: str) -> Gate:
        return replace(self, rules={**self.rules, name: rule})

    def holds(self) -> Column:
        """Three-valued conjunction, fit for pushing into a scan."""
        return reduce(lambda a, b: a & b, self.conditions().values(), F.lit(True))


# The loan rule accepts rates given in percent; data that holds fractions passes
# it too. A tighter gate is made with ``loan_gate(max_rate=...)``.
def loan_gate(max_rate: float = 30) -> Gate:
    return Gate(
        "loans",
        ["loan_id", "customer_id"],
        {
            "interest_rate is negative": "interest_rate >= 0",
            "interest_rate is too high": f"interest_rate <= {max_rate}",
        },
    )


GATES = {
    "customers": Gate(
        "customers", ["customer_id"], {"account_balance is negative": "account_balance >= 0"}
    ),
    "transactions": Gate(
        "transactions",
        ["transaction_id", "customer_id"],
        {"amount is not positive": "amount > 0"},
    ),
    "loans": loan_gate(),
}


def valid_rows(df: DataFrame, gate: Gate) -> DataFrame:
    _require(df, gate)
    return df.filter(gate.holds())


def rejected_rows(df: DataFrame, gate: Gate, run_ts: datetime) -> DataFrame:
    """The complement of ``valid_rows`` with its reasons and audit columns."""
    _require(df, gate)
    failed = [
        F.when(~F.coalesce(condition, F.lit(False)), F.lit(name))
        for name, condition in gate.conditions().items()
    ]
    return (
        df.filter(~F.coalesce(gate.holds(), F.lit(False)))
        .withColumn("violations", F.array_compact(F.array(*failed)))
        .withColumn("quarantine_timestamp", F.lit(run_ts))
        .withColumn("quarantine_entity", F.lit(gate.entity))
    )


def split(df: DataFrame, gate: Gate, run_ts: datetime) -> tuple[DataFrame, DataFrame]:
    return valid_rows(df, gate), rejected_rows(df, gate, run_ts)


def gate_counts(df: DataFrame, gate: Gate) -> DataFrame:
    """One row with the number of valid and rejected rows."""
    _require(df, gate)
    holds = F.coalesce(gate.holds(), F.lit(False))
    return df.agg(
        F.lit(gate.entity).alias("entity"),
        F.count_if(holds).alias("valid_rows"),
        F.count_if(~holds).alias("rejected_rows"),
    )


@dataclass(frozen=True)
class GateOutcome:
    entity: str
    valid_rows: int
    rejected_rows: int


def write_gated(
    df: DataFrame,
    gate: Gate,
    valid_path: str,
    quarantine_path: str,
    run_ts: datetime,
    partition_by: Sequence[str] = (),
    rejected_only: Sequence[str] = (),
    helpers: Sequence[str] = (),
) -> GateOutcome:
    """Write the valid rows, and the rejected ones under the run that found them.

    The quarantine is partitioned by the run's time, and a run repeated replaces
    its own rejects, so none are counted twice.

    Columns in ``rejected_only`` are kept with the rejected rows alone, those in
    ``helpers`` with none. Rejects are observed while the valid rows are written,
    so a clean input is scanned once and only an input with rejects is scanned
    again. An observed figure may count rows of a repeated stage twice; the counts
    returned are therefore those in the footers of the written files.
    """
    _require(df, gate)
    holds = F.coalesce(gate.holds(), F.lit(False))
    seen = Observation(f"gate_{gate.entity}")
    counted = df.observe(seen, F.count_if(~holds).alias("rejected_rows"))
    valid = counted.filter(holds).drop(*rejected_only, *helpers)
    overwrite_parquet(valid, valid_path, partition_by)
    rejected = 0
    if seen.get["rejected_rows"]:
        failed = rejected_rows(df, gate, run_ts).drop(*helpers)
        run_path = f"{quarantine_path}/run={run_ts:%Y%m%dT%H%M%S%f}"
        overwrite_parquet(failed, run_path)
        rejected = _written(failed, run_path)
    return GateOutcome(gate.entity, _written(valid, valid_path), rejected)


def _written(df: DataFrame, path: str) -> int:
    """Rows of a table just written, from the footers of its files."""
    return df.sparkSession.read.schema(df.schema).parquet(path).count()


def with_reference_check(
    df: DataFrame, key: str, parent: DataFrame, parent_key: str, flag: str
) -> DataFrame:
    """Flag rows whose key exists in the parent, for a rule on that flag.

    The child may be skewed on the key; the join is an outer equi-join that
    adaptive execution splits, and the parent side is reduced to its keys.
    """
    parents = key_set(parent, parent_key).withColumnRenamed(parent_key, "_parent_key")
    return (
        df.join(parents, F.col(key) == F.col("_parent_key"), "left")
        .withColumn(flag, F.col("_parent_key").isNotNull())
        .drop("_parent_key")
    )


def _require(df: DataFrame, gate: Gate) -> None:
    missing = [key for key in gate.keys if key not in df.columns]
    if missing:
        raise ValueError(f"{gate.entity}: key columns not found: {missing}")
