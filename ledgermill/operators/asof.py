"""The last row before: each left row takes the values of the newest right row of its key.

No range join: both sides are put in one frame and walked in the order of time
within key and pane of time. What a pane does not know itself it takes from the
last pane before that had a right row; there is one such row for each pane and
key. A key with a third of all rows is so spread over as many tasks as panes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.sources.paths import stored

SALTS = 1024


def month_pane(time: Column) -> Column:
    return F.date_trunc("MONTH", time)


def day_pane(time: Column) -> Column:
    return F.date_trunc("DAY", time)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_time: str,
    right_time: str,
    values: Sequence[str],
    pane=day_pane,
) -> DataFrame:
    """All left rows with ``values`` of the last right row of their key at or before their time.

    Rows without one get NULL, as do left rows with a NULL key or time. Right rows
    with a NULL key or time are not used. Of right rows that share key and time
    the one with the greatest values counts, column by column. A right row whose
    values are NULL is still the last one. The names of ``values`` must not be
    columns of the left side.
    """
    clash = [v for v in values if v in left.columns]
    if clash:
        raise ValueError(f"columns on both sides: {clash}")
    known = F.lit(True)
    for name in by:
        known &= F.col(name).isNotNull()
    keys = [f"_by{i}" for i in range(len(by))]
    named = [F.col(name).alias(key) for name, key in zip(by, keys, strict=True)]
    row = F.struct(*left.columns)
    answerable = F.col(left_time).isNotNull()
    for name in by:
        answerable &= F.col(name).isNotNull()
    # Rows that can have no answer are dealt over many groups, as their key may be a frequent NULL.
    hashed = [f.name for f in left.schema.fields if not isinstance(f.dataType, T.MapType)]
    salt = F.when(~answerable, F.pmod(F.xxhash64(*hashed), F.lit(SALTS))).otherwise(F.lit(0)).cast("int")
    # The greatest of equal times in one row of the map-side combine.
    facts = (
        right.where(known & F.col(right_time).isNotNull())
        .groupBy(*named, F.col(right_time).alias("_time"))
        .agg(F.max(F.struct(*values)).alias("_found"))
        .select(*keys, "_time", pane(F.col("_time")).alias("_pane"), F.lit(0).alias("_salt"), F.lit(0).alias("_side"), "_found")
    )
    asked = left.select(
        *named,
        F.col(left_time).alias("_time"),
        pane(F.col(left_time)).alias("_pane"),
        salt.alias("_salt"),
        F.lit(1).alias("_side"),
        answerable.alias("_answerable"),
        row.alias("_row"),
    )
    both = asked.unionByName(facts, allowMissingColumns=True)
    order = Window.partitionBy(*keys, "_pane", "_salt").orderBy("_time", "_side").rowsBetween(Window.unboundedPreceding, 0)
    walked = both.withColumn("_own", F.last("_found", ignorenulls=True).over(order)).where("_side = 1")

    last = facts.groupBy(*keys, "_pane").agg(F.max_by("_found", "_time").alias("_last"))
    panes = asked.where("_answerable").select(*keys, "_pane").distinct()
    earlier = Window.partitionBy(*keys).orderBy("_pane").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        panes.join(last, [*keys, "_pane"], "full")
        .withColumn("_carried", F.last("_last", ignorenulls=True).over(earlier))
        .where(F.col("_carried").isNotNull())
        .select(*keys, "_pane", F.lit(0).alias("_salt"), "_carried")
    )
    joined = walked.join(stored(carried, "carried"), [*keys, "_pane", "_salt"], "left")
    found = F.when(F.col("_answerable"), F.coalesce("_own", "_carried"))
    return joined.select("_row.*", *[found[v].alias(v) for v in values])
