"""Gates of tables that refer to each other: a row whose parent was rejected is rejected too.

Tables are taken parents first. Of each referenced column the distinct keys are
stored once, with whether any row that has the key is valid; children are joined
to those. Tables that refer to each other in a circle are settled on their key
columns alone, in rounds, until no further row falls.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.operators.quality import Gate, rejected_rows, valid_rows
from ledgermill.schemas import FOREIGN_KEYS
from ledgermill.sources.paths import stored

KEY, OK = "_key", "_ok"


@dataclass(frozen=True)
class Reference:
    """``key`` of the child must be ``parent_key`` of a valid row of the parent, or NULL."""

    child: str
    key: str
    parent: str
    parent_key: str


BANK_REFERENCES = tuple(Reference(child, key, parent, key) for child, key, parent in FOREIGN_KEYS)

States = dict[tuple[str, str], DataFrame]


@dataclass
class Checked:
    """A table with the columns that its references need, and the gate that reads them."""

    df: DataFrame
    gate: Gate
    helpers: list[str] = field(default_factory=list)

    def valid(self) -> DataFrame:
        return valid_rows(self.df, self.gate).drop(*self.helpers)

    def rejected(self, run_ts: datetime) -> DataFrame:
        return rejected_rows(self.df, self.gate, run_ts).drop(*self.helpers)


def dependency_order(tables: Iterable[str], references: Sequence[Reference]) -> list[list[str]]:
    """The tables with parents first; those of one circle are together."""
    names = list(tables)
    unknown = {n for r in references for n in (r.child, r.parent)} - set(names)
    if unknown:
        raise ValueError(f"references to tables that are not given: {sorted(unknown)}")
    above = {name: {r.parent for r in references if r.child == name} for name in names}
    for via in names:
        for name in names:
            if via in above[name]:
                above[name] |= above[via]
    order: list[list[str]] = []
    done: set[str] = set()
    while len(done) < len(names):
        for name in names:
            circle = {name} | {p for p in above[name] if name in above[p]}
            if name not in done and above[name] - circle <= done:
                order.append([n for n in names if n in circle])
                done |= circle
                break
    return order


def key_states(df: DataFrame, key: str, holds: Column) -> DataFrame:
    """The distinct keys, stored, each with whether a valid row has it."""
    return stored(
        df.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias(KEY))
        .agg(F.max(F.coalesce(holds, F.lit(False))).alias(OK)),
        "key-states",
    )


def _checked(checked: Checked, references: Sequence[Reference], states: States) -> Checked:
    df, gate, helpers = checked.df, checked.gate, list(checked.helpers)
    for reference in references:
        flag = f"_ref_{len(helpers)}"
        keys = states[reference.parent, reference.parent_key].withColumnRenamed(OK, flag)
        df = df.join(keys, F.col(reference.key) == F.col(KEY), "left").drop(KEY)
        gate = gate.with_rule(
            f"{reference.key} is not in {reference.parent}",
            f"`{reference.key}` IS NULL OR `{flag}` IS NOT NULL",
        ).with_rule(
            f"{reference.key} is rejected in {reference.parent}", f"coalesce(`{flag}`, true)"
        )
        helpers.append(flag)
    return Checked(df, gate, helpers)


def _settled(circle: Mapping[str, Checked], inner: Sequence[Reference]) -> States:
    """Key states of tables in a circle: a row falls with its parent, again and again.

    The rounds are as many as the longest chain of rows that fall one after another.
    """
    rows = {}
    for name, checked in circle.items():
        columns = {r.key for r in inner if r.child == name}
        columns |= {r.parent_key for r in inner if r.parent == name}
        own = F.coalesce(checked.gate.holds(), F.lit(False)).alias(OK)
        rows[name] = stored(checked.df.select(*sorted(columns), own).distinct(), "circle")
    before = -1
    while True:
        wanted = {(r.parent, r.parent_key) for r in inner}
        states = {(name, key): key_states(rows[name], key, F.col(OK)) for name, key in wanted}
        left = sum(df.where(OK).count() for df in rows.values())
        if left == before:
            return states
        before = left
        for name in circle:
            kept = rows[name]
            for r in inner:
                if r.child == name:
                    keys = states[r.parent, r.parent_key].withColumnRenamed(OK, "_parent")
                    stands = F.col(r.key).isNull() | F.coalesce("_parent", F.lit(False))
                    kept = kept.join(keys, F.col(r.key) == F.col(KEY), "left")
                    kept = kept.withColumn(OK, F.col(OK) & stands).drop(KEY, "_parent")
            rows[name] = stored(kept, "circle")


def cascade(
    tables: Mapping[str, DataFrame], gates: Mapping[str, Gate], references: Sequence[Reference]
) -> dict[str, Checked]:
    """Each table with a gate that also holds its references.

    A NULL key refers to nothing and passes; list it in the gate's keys to reject
    it. A key that the parent lacks and one whose rows were all rejected there are
    named apart. A child may be skewed on its key: the join is an outer equi-join
    with distinct keys, which adaptive execution splits.
    """
    out: dict[str, Checked] = {}
    states: States = {}
    for circle in dependency_order(tables, references):
        inner = [r for r in references if r.child in circle and r.parent in circle]
        for name in circle:
            outer = [r for r in references if r.child == name and r.parent not in circle]
            own = Checked(tables[name], gates.get(name, Gate(name, [])))
            out[name] = _checked(own, outer, states)
        if inner:
            states |= _settled({name: out[name] for name in circle}, inner)
            for name in circle:
                out[name] = _checked(out[name], [r for r in inner if r.child == name], states)
        for r in references:
            if r.parent in circle and (r.parent, r.parent_key) not in states:
                parent = out[r.parent]
                states[r.parent, r.parent_key] = key_states(
                    parent.df, r.parent_key, parent.gate.holds()
                )
    return out
