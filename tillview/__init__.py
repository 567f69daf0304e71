"""Retail customer analytics as Spark jobs: sources, conformed tables, a
one-row-per-customer view, scores, sales tables, models, forecasts, anomalies."""

__version__ = "0.1.0"
