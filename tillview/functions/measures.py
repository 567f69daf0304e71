"""Small expression builders used across the operators."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"


def as_date(as_of: date) -> Column:
    return F.lit(as_of).cast("date")


def days_until(as_of: date, column: Column | str) -> Column:
    return F.datediff(as_date(as_of), F.col(column) if isinstance(column, str) else column)


def tidy(column: str) -> Column:
    """Trimmed, each word capitalised."""
    return F.initcap(F.trim(F.col(column)))


def rows_where(predicate: Column | str) -> Column:
    """How many rows of the group satisfy the predicate (0 when none does)."""
    return F.count_if(F.expr(predicate) if isinstance(predicate, str) else predicate)


def sum_where(predicate: Column | str, value: Column | str) -> Column:
    """Sum of ``value`` over the matching rows, 0 when none matches."""
    hit = F.expr(predicate) if isinstance(predicate, str) else predicate
    amount = F.col(value) if isinstance(value, str) else value
    return F.sum(F.when(hit, amount).otherwise(F.lit(0)))


def mean(column: str) -> Column:
    """Average as a double. The sum stays exact for decimals and integers, so
    the result does not depend on the order in which partitions arrive."""
    return F.try_divide(F.sum(column).cast("double"), F.count(column))


def exact_mean(column: str, scale: int = 6) -> Column:
    """Average of a double column whose values have at most ``scale`` decimals:
    summed as decimals, so the order of summing cannot show."""
    total = F.sum(F.col(column).cast(f"decimal(28,{scale})"))
    return F.try_divide(total.cast("double"), F.count(column))


def ratio(part: Column | str, whole: Column | str) -> Column:
    """part / whole, and 0 where whole is not positive."""
    part = F.col(part) if isinstance(part, str) else part
    whole = F.col(whole) if isinstance(whole, str) else whole
    return F.when(whole > 0, part.cast("double") / whole.cast("double")).otherwise(F.lit(0.0))


def named(columns: Mapping[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


def select_available(df: DataFrame, wanted: list[str], required: tuple[str, ...] = ()) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"required columns are missing: {missing}")
    return df.select(*[c for c in wanted if c in df.columns])


def zero_filled(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULL becomes 0 in the listed columns that exist; one projection."""
    fill = set(columns)
    return df.selectExpr(
        *[f"coalesce(`{c}`, 0) AS `{c}`" if c in fill else f"`{c}`" for c in df.columns]
    )


def hash_bucket(column: str, buckets: int = 100) -> Column:
    """A bucket in 0..buckets-1 that depends on the value alone, so a split
    made with it is the same under any partitioning and on any rerun."""
    head = F.substring(F.md5(F.col(column).cast("string")), 1, 8)
    return (F.conv(head, 16, 10).cast("bigint") % F.lit(buckets)).cast("int")


def one_row(df: DataFrame) -> Column:
    """A one-row DataFrame as a scalar struct: a subquery, not a join."""
    return df.select(F.struct(*df.columns)).scalar()
