"""Integrity checks over the entity tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.operators.joins import key_set
from ledgermill.schemas import FOREIGN_KEYS, PRIMARY_KEYS
from ledgermill.sources.paths import stored


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union-all by name, in halves to keep the plan shallow."""
    if len(frames) == 1:
        return frames[0]
    middle = len(frames) // 2
    return union_all(frames[:middle]).unionByName(union_all(frames[middle:]))


def _surplus(count: str) -> Column:
    """Rows beyond the first of each group."""
    return F.coalesce(F.sum(F.col(count) - 1), F.lit(0))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row: how many rows repeat an earlier identical row.

    Step one shuffles only a 64-bit fingerprint per distinct row and stores
    those that occur twice. Step two compares in full the rows with such a
    fingerprint, so a clean table is never shuffled whole and a fingerprint
    collision cannot miscount. Copies collapse in the map-side combine of both
    steps; the semi-join between them is a broadcast while the stored list is
    small, and splits at a hot fingerprint when it is not.
    """
    columns = df.columns
    marked = df.withColumn("_print", F.xxhash64(*columns))
    repeated = stored(
        marked.groupBy("_print").count().filter("count > 1").select("_print"), "repeated-rows"
    )
    groups = marked.join(repeated, "_print", "left_semi").groupBy(*columns).count()
    return groups.agg(_surplus("count").alias("failures"))


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def surplus_keys(df: DataFrame, key: str) -> DataFrame:
    """One row: rows, distinct keys and rows beyond the first of their key."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
    return per_key.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"),
        F.count(key).alias("distinct_keys"),
        _surplus("row_count").alias("failures"),
    )


def orphan_keys(child: DataFrame, key: str, parent: DataFrame) -> DataFrame:
    """Keys of the child that the parent lacks, with the child's row count.

    The child is reduced to one row per key before the anti-join, so a hot key
    costs one row there; a NULL key has no parent and is reported.
    """
    per_key = child.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
    return per_key.join(parent.select(key).distinct(), key, "left_anti")


def orphan_rows(child: DataFrame, key: str, parent: DataFrame) -> DataFrame:
    """The offending rows themselves, for samples and quarantine."""
    return child.join(key_set(parent, key), key, "left_anti")


def source_overlap(
    entities: DataFrame, entity_key: str, source: DataFrame, source_key: str, prefix: str
) -> DataFrame:
    """One row: entities whose key is a prefixed source key, and all entities."""
    known = source.select(
        F.concat(F.lit(prefix), F.col(source_key).cast("string")).alias("_key")
    ).distinct()
    keys = entities.groupBy(F.col(entity_key).cast("string").alias("_key")).agg(
        F.count(F.lit(1)).alias("n")
    )
    marked = keys.join(known.withColumn("hit", F.lit(True)), "_key", "left")
    return marked.agg(
        F.coalesce(F.sum(F.when(F.col("hit"), F.col("n"))), F.lit(0)).alias("matching"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
    )


def _finding(check: str, table: str, frame: DataFrame) -> DataFrame:
    return frame.select(
        F.lit(check).alias("check"), F.lit(table).alias("subject"), F.col("failures")
    )


def integrity_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per check: duplicate rows, repeated keys and orphans.

    The repeated keys of all tables are found and stored in one job. Identical
    rows share their key, so only rows with a stored key can be copies: one
    shuffle of the keys serves both checks.
    """
    keyed = {name: key for name, key in PRIMARY_KEYS.items() if name in tables}
    repeated = stored(
        union_all(
            [
                repeated_keys(tables[name], key).select(
                    F.lit(name).alias("subject"), F.col(key).cast("string").alias("k"), "row_count"
                )
                for name, key in keyed.items()
            ]
        ),
        "repeated-keys",
    )
    findings = []
    for name, key in keyed.items():
        df, own = tables[name], repeated.filter(F.col("subject") == name)
        findings.append(
            _finding("repeated_keys", name, own.agg(_surplus("row_count").alias("failures")))
        )
        suspects = own.select(F.col("k").cast(df.schema[key].dataType).alias("_suspect"))
        groups = (
            df.join(suspects, F.col(key).eqNullSafe(F.col("_suspect")), "left_semi")
            .groupBy(*df.columns)
            .count()
        )
        findings.append(
            _finding("duplicate_rows", name, groups.agg(_surplus("count").alias("failures")))
        )
    for child, key, parent in FOREIGN_KEYS:
        if child in tables and parent in tables:
            orphans = orphan_keys(tables[child], key, tables[parent]).agg(
                F.coalesce(F.sum("row_count"), F.lit(0)).alias("failures")
            )
            findings.append(_finding("orphans", f"{child}.{key}", orphans))
    return union_all(findings)


# Assertions on a layer: each returns the rows that break it.


def broken_rows(df: DataFrame, must_hold: Column) -> DataFrame:
    return df.filter(~F.coalesce(must_hold, F.lit(False)))


def layer_assertions(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """Failing-row counts of the layer checks; an empty table fails its own check."""
    checks = [
        ("customers not empty", customers.agg((F.count(F.lit(1)) == 0).cast("bigint"))),
        (
            "customer_id unique",
            surplus_keys(customers, "customer_id").select("failures"),
        ),
        (
            "account_balance not negative",
            broken_rows(customers, F.col("account_balance") >= 0).agg(F.count(F.lit(1))),
        ),
        ("transactions not empty", transactions.agg((F.count(F.lit(1)) == 0).cast("bigint"))),
        (
            "amount positive",
            broken_rows(transactions, F.col("amount") > 0).agg(F.count(F.lit(1))),
        ),
    ]
    return union_all(
        [
            frame.toDF("failures").select(F.lit(name).alias("check"), "failures")
            for name, frame in checks
        ]
    )


def layer_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per named table."""
    return union_all(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("layer"), "row_count"
            )
            for name, df in layers.items()
        ]
    )
