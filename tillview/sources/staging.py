"""Intermediate tables in the cluster's shared checkpoint folder.

A staged table cuts the lineage with plain Parquet: it is column-pruned like
any other table, survives lost executors, and is scanned instead of recomputed
by every later branch.
"""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_dropping: list[str | None] = []
_lock = threading.Lock()


def staging_root(spark: SparkSession) -> str:
    root = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError(f"set {SETTING} to a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="tillview-")
    spark.conf.set(SETTING, root)
    return root


def staging_path(spark: SparkSession, label: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{staging_root(spark)}/tillview/{app}/{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Has Spark delete the shuffle files of an action when it ends.

    Otherwise they stay until the driver happens to collect the plan, so a session that
    writes many tables holds the shuffles of all. For actions whose plan is not run again, as
    a write's. The session's setting is put back when the last of those that overlap ends."""
    with _lock:
        _dropping.append(_dropping[0] if _dropping else spark.conf.get(DROP_SHUFFLES, None))
        spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        with _lock:
            before = _dropping.pop()
            if not _dropping and before is None:
                spark.conf.unset(DROP_SHUFFLES)
            elif not _dropping:
                spark.conf.set(DROP_SHUFFLES, before)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once (an action) and return the written table."""
    spark = df.sparkSession
    path = staging_path(spark, label)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> None:
    """Delete all tables that this application has staged. Tables returned by
    operators that stage can't be read any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(
        f"{staging_root(spark)}/tillview/{spark.sparkContext.applicationId}"
    )
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
