"""Gapless numbers by distributed prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shroud.sources.scratch import written


def numbered(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """The rows with ``number``: 0, 1, 2 ... within each group by the order, though no task sees a whole group.

    Rows are dealt by ranges and sorted once, and written with their places. A count for each group and
    range gives, summed up over the ranges before, where the numbers of a range start: a row for each
    group in each range is all that meets by group. Nulls count as values, and rows that tie are numbered in any order.
    """
    dealt = rows.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    held = written(dealt.withColumn("__at", F.monotonically_increasing_id()), "numbered").withColumn("__range", F.shiftright("__at", 33))
    before = Window.partitionBy(*group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    counted = held.groupBy(*group, "__range").agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    starts = counted.select(*[F.col(g).alias(f"__{g}") for g in group], F.col("__range").alias("__of"), "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    same = F.col("__range") == F.col("__of")
    for g in group:
        same &= F.col(g).eqNullSafe(F.col(f"__{g}"))
    return held.join(starts, same).select(*rows.columns, (F.col("__start") + F.col("__at") - F.col("__first")).alias("number"))
