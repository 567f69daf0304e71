"""Recency, frequency and monetary scores."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillview.functions import policies
from tillview.functions.measures import one_row
from tillview.operators.profile import customer_profile, renamed
from tillview.operators.ranks import share_rank, values_at
from tillview.sources.staging import stage

# output column -> profile measure
RFM_MEASURES = {
    "recency_days": "days_since_last",
    "frequency": "order_count",
    "monetary_value": "revenue_sum",
}


def rfm_base(lines: DataFrame, as_of: date) -> DataFrame:
    """Frequency counts distinct transactions, not lines."""
    return renamed(customer_profile(lines, as_of, list(RFM_MEASURES.values())), RFM_MEASURES)


def rfm_cutpoints(base: DataFrame) -> DataFrame:
    """One row with an array of four cut points per measure, exact for any
    number of customers. Runs a job."""
    return values_at(base, list(RFM_MEASURES), [share_rank(str(q)) for q in policies.RFM_QUANTILES])


def _quintile(measure: str, passes: str) -> Column:
    """1 + the number of cut points the measure passes. Cut points do not
    decrease, so this is the quintile; a NULL measure passes none."""
    hits = [
        f"int(coalesce({measure} {passes} _cuts.{measure}[{i}], false))"
        for i in range(len(policies.RFM_QUANTILES))
    ]
    return F.expr(f"1 + {' + '.join(hits)}")


def score_rfm(base: DataFrame) -> DataFrame:
    """Scores 1..5 per measure, their sum 3..15 and the segment.

    The cut points arrive as a scalar subquery: no join and no driver step.
    ``base`` is read twice, so it should be a stored table. Runs a job."""
    scored = base.withColumn("_cuts", one_row(rfm_cutpoints(base))).withColumns(
        {
            "recency_score": _quintile("recency_days", "<="),
            "frequency_score": _quintile("frequency", ">="),
            "monetary_score": _quintile("monetary_value", ">="),
        }
    )
    return scored.drop("_cuts").withColumn(
        "rfm_score", F.expr("recency_score + frequency_score + monetary_score")
    ).withColumn("rfm_segment", policies.RFM_SEGMENT.column())


def rfm(lines: DataFrame, as_of: date) -> DataFrame:
    """Scores from the lines, which are read once. Runs jobs."""
    return score_rfm(stage(rfm_base(lines, as_of), "rfm-base"))
