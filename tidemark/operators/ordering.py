"""Places in a global order without one task for all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..staging import staged


def with_ordinal(df: DataFrame, order: list, name: str = "ordinal", within: list[str] | None = None) -> DataFrame:
    """df with each row's place (from 0) in an order, overall or within the given columns.

    Rows are dealt to ranges of the whole sort key at sampled quantiles, so a day, a count or a group that holds most
    rows is split like any other. The sorted ranges are written once; a row's place is its place in its range, and the
    rows of earlier ranges, counted by range, are added.
    """
    within = within or []
    keys = [*map(F.col, within), *order]
    dealt = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # the place in the range
    rows = staged(dealt.select("*", F.spark_partition_id().alias("__range"), inside.alias("__at")), "ranges")
    counts = rows.groupBy(*within, "__range").agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    earlier = Window.partitionBy(*within).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first")
    before = counts.select(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(within)), F.col("__range").alias("__r"), shift.alias("__shift"))
    same = F.col("__range") == F.col("__r")
    for i, k in enumerate(within):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    return rows.join(before, same).withColumn(name, F.col("__at") + F.col("__shift")).select(*df.columns, name)


def keep_first(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key in the given order."""
    return df.withColumn("__r", F.row_number().over(Window.partitionBy(key).orderBy(order))).filter("__r = 1").drop("__r")
