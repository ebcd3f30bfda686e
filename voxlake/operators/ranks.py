"""Places within groups without a task for each group: a group of any size is spread over many range partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxlake.plans.scratch import saved


def ranked(df: DataFrame, by: list[str], order: list[Column | str]) -> DataFrame:
    """df with place_ (0, 1, ... within each group, by the order) and size_ (rows of the group).

    Rows are range-partitioned by group and order and numbered where they lie; the counts of each partition's groups, a row each, tell
    where a partition's part of a group begins.  Rows equal in all of `order` are numbered in any order.
    """
    lying = df.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order)
    lying = saved(lying.withColumn("part_", F.spark_partition_id()).withColumn("at_", F.monotonically_increasing_id()), "ranked")
    parts = lying.groupBy(*by, "part_").agg(F.count("*").alias("n_"), F.min("at_").alias("first_"))
    w = Window.partitionBy(*by)
    before = F.coalesce(F.sum("n_").over(w.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select(*[F.col(c).alias(f"{c}__") for c in by], F.col("part_").alias("p_"), "first_", before.alias("before_"), F.sum("n_").over(w).alias("size_"))
    same = F.col("part_") == F.col("p_")
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"{c}__"))
    out = lying.join(parts, same).withColumn("place_", F.col("at_") - F.col("first_") + F.col("before_"))
    return out.drop("part_", "at_", "p_", "first_", "before_", *[f"{c}__" for c in by])


def running(df: DataFrame, by: list[str], value: str, amount: str) -> DataFrame:
    """df with upto_ (sum of amount over the rows of the group with smaller or equal value), total_ (over the group), and the row before in its group: before_value_ and
    before_upto_ (null for the first).  Values are distinct within groups.

    As `ranked`: sums run inside range partitions, and a row for each partition and group carries the sum and the last value to the next.
    """
    lying = df.repartitionByRange(*by, value).sortWithinPartitions(*by, value)
    lying = saved(lying.withColumn("part_", F.spark_partition_id()), "running")
    inside = Window.partitionBy(*by, "part_").orderBy(value)
    rows = lying.withColumn("in_", F.sum(amount).over(inside)).withColumn("lag_", F.lag(F.struct(value, "in_")).over(inside))
    parts = lying.groupBy(*by, "part_").agg(F.sum(amount).alias("sum_"), F.max(value).alias("top_"))
    w = Window.partitionBy(*by).orderBy("part_")
    earlier = F.coalesce(F.sum("sum_").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select(*[F.col(c).alias(f"{c}__") for c in by], F.col("part_").alias("p_"), earlier.alias("earlier_"), F.lag("top_").over(w).alias("carried_"), F.sum("sum_").over(Window.partitionBy(*by)).alias("total_"))
    same = F.col("part_") == F.col("p_")
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"{c}__"))
    out = rows.join(parts, same).withColumn("upto_", F.col("in_") + F.col("earlier_"))
    out = out.withColumn("before_value_", F.coalesce(F.col(f"lag_.{value}"), "carried_"))
    out = out.withColumn("before_upto_", F.when(F.col("before_value_").isNotNull(), F.col("earlier_") + F.coalesce(F.col("lag_.in_"), F.lit(0))))
    return out.drop("part_", "p_", "in_", "lag_", "earlier_", "carried_", *[f"{c}__" for c in by])
