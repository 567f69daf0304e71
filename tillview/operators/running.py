"""Running totals over a whole table in an order, for any number of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillview.sources.staging import stage


def totals_before(df: DataFrame, order: Column, values: Sequence[str]) -> DataFrame:
    """``df`` with ``<value>_before``, the sum of each value over all rows that come earlier by
    ``order``, which should have no ties. Rows are spread over tasks by range (a job); what
    comes together is one total per range and, in a task, the rows of a range."""
    ranged = stage(df.repartitionByRange(order).withColumn("range", F.spark_partition_id()), "running")
    totals = ranged.groupBy("range").agg(*(F.sum(v).alias(f"{v}_in") for v in values))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as ranges
    starts = totals.select("range", *(F.coalesce(F.sum(f"{v}_in").over(earlier), F.lit(0)).alias(f"{v}_start") for v in values))
    inside = Window.partitionBy("range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.join(starts, "range").withColumns(
        {f"{v}_before": F.col(f"{v}_start") + F.coalesce(F.sum(v).over(inside), F.lit(0)) for v in values}
    )
    return placed.drop("range", *(f"{v}_start" for v in values))
