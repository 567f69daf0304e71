"""Tables in the cluster's shared folder, and public vocabularies."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tillview.sources.staging import stage

__all__ = ["batches", "once", "stage", "table", "unused", "vocabulary"]


#: Rows of a batch that Python works on; the usual 10,000 are a lot of memory where rows are texts.
BATCH_ROWS = 1000


def batches(spark: SparkSession) -> None:
    """Set the session's Arrow batch size for tables of texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a folder; sets the batch size."""
    batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """``name`` or, where ``df`` has such a column, a longer one that it has not."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def vocabulary(name: str) -> bytes:
    """A public vocabulary file, read on the driver; a few MB at the most."""
    import public_tokenizers

    return Path(public_tokenizers.path(name)).read_bytes()


def once(box: dict[str, Any], make: Callable[[bytes], Any]) -> Any:
    """What ``make`` gives for ``box["content"]``, made by the first task of a Python worker and
    kept for its later ones: a worker has one copy of the broadcast dictionary ``box``."""
    if "made" not in box:
        box["made"] = make(box["content"])
    return box["made"]
