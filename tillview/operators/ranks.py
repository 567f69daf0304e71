"""Exact values at given ranks of a column, for any number of rows.

Where few rows are left to look among, they are counted by value and the rank is read
off. Where there are many, a mergeable quantile sketch of them, made in tasks and merged in
two levels, gives two values that enclose the one wanted; a pass over the table counts
the rows up to the lower one and sketches those between, and so on. Counts decide, not the
sketch: where its values miss the rank, the search turns to the side where it lies. A pass
shuffles sketches and counts only; what is ranked is bounded at any size of the table.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillview.functions.measures import one_row

Rank = Callable[[Column], Column]

#: Size of a sketch, which is then off by less than 1 % of its rows, and how far the enclosing
#: values lie from the rank, as a share of the rows.
SKETCH_K, MARGIN = 400, 0.02
#: Sketches of tasks that are merged together before all are.
MERGED = 64
#: Rows that are counted by value to find a rank.
FEW_ROWS = 1_000_000


def share_rank(share: str) -> Rank:
    """The least rank that at least ``share`` of the rows, a decimal text, do not exceed."""
    return lambda rows: F.greatest(F.lit(1), F.ceil(rows * F.lit(share).cast("decimal(9,8)")))


@dataclass(frozen=True)
class _Span:
    """Rows of a column whose values, as doubles, lie above ``low`` and not above ``high``."""

    column: str
    low: float = -math.inf
    high: float = math.inf

    def value(self) -> Column:
        """As a double; what is not a number is the greatest."""
        value = F.col(self.column).cast("double")
        return F.when(F.isnan(value), F.lit(math.inf)).otherwise(value)

    def holds(self) -> Column:
        value = self.value()
        least = value.isNotNull() if self.low == -math.inf else value > F.lit(self.low)
        return least if self.high == math.inf else least & (value <= F.lit(self.high))

    def below(self) -> Column:
        return F.lit(False) if self.low == -math.inf else self.value() <= F.lit(self.low)


@dataclass
class _Search:
    """The rank at ``place`` of a column's list, and the span that it is looked for in."""

    place: int
    rank: int
    span: _Span
    around: _Span
    ready: bool = False

    def narrow(self, below: int, inside: int, quantiles: Callable[[float], float]) -> None:
        """Go on in the part of the span that has the rank, from its counts and sketch."""
        at = self.rank - below
        if at < 1:
            self.span = _Span(self.span.column, self.around.low, self.span.low)
        elif at > inside:
            self.span = _Span(self.span.column, self.span.high, self.around.high)
        elif inside <= FEW_ROWS:
            self.ready = True
        else:
            low, high = (quantiles(min(1.0, max(0.0, at / inside + d))) for d in (-MARGIN, MARGIN))
            found = _Span(self.span.column, max(self.span.low, math.nextafter(low, -math.inf)), min(self.span.high, high))
            self.ready = found == self.span  # few values, however many rows
            self.around, self.span = self.span, found


def _measured(df: DataFrame, spans: Sequence[_Span], totals: dict[str, Column]) -> Any:
    """One row: rows below and in each span, and its sketch's quantiles. A job that shuffles
    a row per task and then one per ``MERGED``-th."""
    sketch = {f"sketch_{i}": F.kll_sketch_agg_double(F.when(s.holds(), s.value()), F.lit(SKETCH_K)) for i, s in enumerate(spans)}
    counts = {f"below_{i}": F.count_if(s.below()) for i, s in enumerate(spans)} | {f"inside_{i}": F.count_if(s.holds()) for i, s in enumerate(spans)}
    parts = df.groupBy((F.spark_partition_id() % MERGED).alias("part")).agg(*(c.alias(n) for n, c in (sketch | counts).items()))
    merged = parts.agg(*(F.kll_merge_agg_double(n, F.lit(SKETCH_K)).alias(n) for n in sketch), *(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in counts))
    shares = F.array(*(F.lit(k / 500) for k in range(501)))
    quantiles = [F.when(F.col(f"inside_{i}") > 0, F.kll_sketch_get_quantile_double(f"sketch_{i}", shares)).alias(f"quantiles_{i}") for i in range(len(spans))]
    return merged.select(*counts, *quantiles, *(c.alias(n) for n, c in totals.items())).first()


def _read_off(df: DataFrame, searches: Sequence[_Search], belows: dict[_Span, int], kind: str) -> dict[tuple[str, int], Any]:
    """The values of searches whose spans have few rows, or few values. A job; its answers come to
    the driver, one per search."""
    spans = list(dict.fromkeys(s.span for s in searches))
    pairs = F.array(*(F.when(s.holds(), F.struct(F.lit(i).alias("span"), F.col(s.column).cast(kind).alias("value"))) for i, s in enumerate(spans)))
    counted = df.select(F.explode(F.filter(pairs, lambda p: p.isNotNull())).alias("p")).groupBy("p.span", "p.value").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("span").orderBy("value"))
    places = F.array(*(F.struct(F.lit(spans.index(s.span)).alias("span"), F.lit(k).alias("search"), F.lit(s.rank - belows[s.span]).cast("bigint").alias("rank")) for k, s in enumerate(searches)))
    met = F.filter(places, lambda p: (p["span"] == F.col("span")) & (p["rank"] <= F.col("upto")) & (p["rank"] > F.col("upto") - F.col("n")))
    found = counted.withColumn("upto", upto).select("value", F.explode(met).alias("p")).select("p.search", "value")
    return {(searches[r.search].span.column, searches[r.search].place): r.value for r in found.collect()}


def values_at(df: DataFrame, columns: Sequence[str], ranks: Sequence[Rank], kind: str = "decimal(38,6)") -> DataFrame:
    """One row with, per column, the array of its values at ``ranks`` among its
    non-NULL values in ascending order; ``kind`` must hold all values exactly.

    Runs a few jobs, each a pass over ``df``, which should be a stored table."""
    start = [_Span(c) for c in columns]
    counts = {f"ranks_{i}": F.array(*(rank(F.col(f"inside_{i}")).cast("bigint") for rank in ranks)) for i in range(len(columns))}
    row = _measured(df, start, counts)
    searches = [
        _Search(place, rank, span, span)
        for i, span in enumerate(start)
        for place, rank in enumerate(row[f"ranks_{i}"])
        if 1 <= rank <= row[f"inside_{i}"]
    ]
    measured, found = {s: i for i, s in enumerate(start)}, {}
    while searches:
        for s in searches:
            i = measured[s.span]
            sketched = row[f"quantiles_{i}"]
            s.narrow(row[f"below_{i}"], row[f"inside_{i}"], lambda share, q=sketched: q[round(share * 500)])
        if ready := [s for s in searches if s.ready]:
            found |= _read_off(df, ready, {s.span: row[f"below_{measured[s.span]}"] for s in ready}, kind)
        searches = [s for s in searches if not s.ready]
        if searches:
            spans = list(dict.fromkeys(s.span for s in searches))
            row, measured = _measured(df, spans, {}), {s: i for i, s in enumerate(spans)}
    answers = [tuple([found[c, place] for place in range(len(ranks)) if (c, place) in found] for c in columns)]
    schema = ", ".join(f"`{c}` array<{kind}>" for c in columns)
    types = dict(df.dtypes)
    return df.sparkSession.createDataFrame(answers, schema).select(*(F.col(c).cast(f"array<{types[c]}>").alias(c) for c in columns))


def value_at(df: DataFrame, column: str, rank: Rank, kind: str) -> Column:
    """The value at one rank; NULL without rows or for rank 0. Runs jobs."""
    return F.get(one_row(values_at(df, [column], [rank], kind))[column], F.lit(0))
