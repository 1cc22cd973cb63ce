"""Spreading totals over products and raising threshold alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.schemas import PRODUCT_SHARES


def allocate(df: DataFrame, revenue: str, costs: str | None = None) -> DataFrame:
    """One row per input row and product, with its share of the totals.

    The fixed shares are an array literal exploded in place of a join.
    """
    shares = F.array(
        *[
            F.struct(
                F.lit(product).alias("product"),
                F.lit(revenue_share).alias("revenue_share"),
                F.lit(cost_share).alias("cost_share"),
            )
            for product, revenue_share, cost_share in PRODUCT_SHARES
        ]
    )
    kept = [c for c in df.columns if c not in (revenue, costs)]
    spread = df.withColumn("_share", F.explode(shares))
    product_revenue = F.col(revenue) * F.col("_share.revenue_share")
    columns = [*kept, F.col("_share.product").alias("product"), product_revenue.alias("revenue")]
    if costs is not None:
        product_costs = F.col(costs) * F.col("_share.cost_share")
        columns += [
            product_costs.alias("costs"),
            (product_revenue - product_costs).alias("net_profit"),
        ]
    return spread.select(*columns)
