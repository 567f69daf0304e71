"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str],
    latest: str,
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """Keeps the row with the greatest ``latest`` for each key.

    Rows that share the key and ``latest`` are ordered by ``tie_break``
    (ascending; by default every other column), so the pick does not depend on
    how the data is partitioned.

    Spark turns the ``= 1`` filter into a group limit that runs before the
    shuffle as well as after it: each map task sends at most one row per key,
    however many copies one key has.
    """
    if tie_break is None:
        tie_break = [c for c in df.columns if c not in keys and c != latest]
    order = [F.col(latest).desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in tie_break]]
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_position", position).filter("_position = 1").drop("_position")


def latest_value_per_key(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Per key the ``values`` of its row that is last by ``order``, combined
    before the shuffle. Rows with a NULL in ``order`` come first; ties go to the
    greatest values."""
    last = F.max_by(F.struct(*values), F.struct(*order, *values)).alias("_last")
    return df.groupBy(*keys).agg(last).select(*keys, *[F.col(f"_last.{v}").alias(v) for v in values])
