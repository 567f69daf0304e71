"""Layered tables: one writer, one reader, one summary.

A layer is a folder under the store's root; a table is a folder under its
layer, and every write is a new version in it (``commits.py``). Tables can also
be registered in the catalog when the store has a database; the entry follows
the last version's schema, place and partitions.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tillview.sources.commits import TableFolder, Version
from tillview.sources.staging import shuffles_dropped

LAYERS = ("bronze", "silver", "gold")


class TableMissing(RuntimeError):
    """Neither the table's folder nor a catalog entry could be read."""


class NotOurTable(RuntimeError):
    """The catalog has a view or a table of another kind under the name."""


@dataclass(frozen=True)
class TableStore:
    spark: SparkSession
    root: str
    format: str = "parquet"
    database: str | None = None
    #: Versions of a table that are kept, the last included.
    keep: int = 2

    def path(self, name: str) -> str:
        """``x_silver``, ``db.x_silver`` and ``catalog.db.x_silver`` are one table."""
        short = name.split(".")[-1]
        layer = next((part for part in LAYERS if short.endswith(f"_{part}")), "other")
        return f"{self.root.rstrip('/')}/{layer}/{short}"

    def qualified(self, name: str) -> str:
        short = name.split(".")[-1]
        return f"{self.database}.{short}" if self.database else short

    def folder(self, name: str) -> TableFolder:
        return TableFolder(self.spark, self.path(name))

    def _data_path(self, name: str, version: Version) -> str:
        return f"{self.path(name)}/{version.folder}"

    # -- write ------------------------------------------------------------
    def write(
        self,
        df: DataFrame,
        name: str,
        load_ts: datetime | None = None,
        partition_by: str | Sequence[str] | None = None,
        rebalance: bool = True,
    ) -> DataFrame:
        """Replace the table, all at once, and return its new version as read back
        from storage. ``df`` may read the table itself.

        Until the write is done readers get the version before; if it fails
        they keep it. The last ``keep`` versions stay readable. Silver and gold
        tables get a ``<layer>_load_timestamp``. A partitioned write is
        rebalanced by its partition columns first: adaptive execution then
        merges the small pieces and splits the large ones, so one month that
        holds a third of the rows is written by many tasks and a small month by
        one, without a file per task and month. That shuffles the whole rows; with
        ``rebalance=False`` they are written where they are, each task a file per
        month it has rows of, so there are at most as many files as tasks times months.
        """
        layer = self.path(name).split("/")[-2]
        if load_ts is not None and layer in ("silver", "gold"):
            df = df.withColumn(f"{layer}_load_timestamp", F.lit(load_ts))
        keys = [partition_by] if isinstance(partition_by, str) else list(partition_by or ())
        if keys and rebalance:
            df = df.hint("rebalance", *keys)
        folder = self.folder(name)
        data = folder.new_folder()
        writer = df.write.format(self.format).option("parquet.compression", "zstd")
        with shuffles_dropped(self.spark):
            writer.partitionBy(*keys).save(f"{self.path(name)}/{data}")
        # as it is read: every column nullable, those of partitions last
        fields = [*(f for f in df.schema if f.name not in keys), *(df.schema[k] for k in keys)]
        version = folder.commit(data, StructType([StructField(f.name, f.dataType) for f in fields]), keys)
        if self.database:
            self.register(name)
        folder.sweep(self.keep)
        return self._of_version(name, version)

    def write_managed(self, df: DataFrame, name: str) -> DataFrame:
        """A table whose files the catalog owns."""
        full = self.qualified(name)
        df.write.format(self.format).mode("overwrite").saveAsTable(full)
        return self.spark.table(full)

    def register(self, name: str) -> None:
        """Make the catalog entry show the table's last version.

        An entry of the same schema only gets its new place; where columns, their
        types or the partitioning differ, or partitions are to be found anew, the
        entry (not the data) is dropped and made again. Views and managed tables of
        that name are left alone and raise ``NotOurTable``."""
        catalog, full, version = self.spark.catalog, self.qualified(name), self.folder(name).version()
        if version is None:
            raise TableMissing(f"{name}: {self.path(name)} has no version")
        if self.database and not catalog.databaseExists(self.database):
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}")
        place = self._data_path(name, version)
        if catalog.tableExists(full):
            kind = catalog.getTable(full).tableType
            if kind != "EXTERNAL":
                raise NotOurTable(f"{full} is a {kind} table")
            entry = [(c.name, c.dataType, c.isPartition) for c in catalog.listColumns(full)]
            committed = [(f.name, f.dataType.simpleString(), f.name in version.partition_by) for f in version.struct]
            if entry == committed and not version.partition_by:
                self.spark.sql(f"ALTER TABLE {full} SET LOCATION '{place}'")
                catalog.refreshTable(full)
                return
            self.spark.sql(f"DROP TABLE {full}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in version.struct)
        by = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in version.partition_by)})" if version.partition_by else ""
        self.spark.sql(f"CREATE TABLE {full} ({columns}) USING {self.format}{by} LOCATION '{place}'")
        if version.partition_by:
            catalog.recoverPartitions(full)

    # -- read -------------------------------------------------------------
    def read(self, name: str, prefer: str = "path", optional: bool = False, version: int | None = None) -> DataFrame | None:
        """The table from its folder, else from the catalog (or the reverse).

        From the folder it is the last version, or the one of that number, and
        stays that version whatever is written later. Resolving the schema is the
        validation; no rows are read. With ``optional`` a missing table is None
        instead of an error."""
        if version is not None:
            return self._of_version(name, self.folder(name).version(version))
        if prefer not in ("path", "catalog"):
            raise ValueError("prefer must be 'path' or 'catalog'")
        attempts = [self._from_path, self._from_catalog]
        if prefer == "catalog":
            attempts.reverse()
        reasons = []
        for attempt in attempts:
            try:
                return attempt(name)
            except AnalysisException as error:
                reasons.append(error.getCondition() or type(error).__name__)
        if optional:
            return None
        raise TableMissing(f"{name}: {self.path(name)} and the catalog failed with {reasons}")

    def _from_path(self, name: str) -> DataFrame:
        """The last version; a folder without versions is read as plain files."""
        version = self.folder(name).version()
        if version is None:
            return self.spark.read.format(self.format).load(self.path(name))
        return self._of_version(name, version)

    def _of_version(self, name: str, version: Version) -> DataFrame:
        return self.spark.read.format(self.format).schema(version.struct).load(self._data_path(name, version))

    def _from_catalog(self, name: str) -> DataFrame:
        return self.spark.table(self.qualified(name))

    def status(self, name: str) -> str:
        if self.spark.catalog.tableExists(self.qualified(name)):
            return "registered"
        return "at path" if self.read(name, optional=True) is not None else "missing"


def count_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, records, columns) for a fixed set of tables, as one job.

    Counting Parquet reads no column, only row-group counts."""
    counts = [
        df.agg(F.count("*").alias("records")).select(
            F.lit(name).alias("table_name"), "records", F.lit(len(df.columns)).alias("columns")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def layer_summary(store: TableStore, names: Iterable[str], prefer: str = "catalog") -> DataFrame:
    """(table_name, path, records, columns, status) of the named tables; a
    missing one has NULL counts."""
    found: dict[str, DataFrame] = {}
    status = {}
    for name in names:
        status[name] = store.status(name)
        df = store.read(name, prefer=prefer, optional=True)
        if df is not None:
            found[name] = df
    listing = store.spark.createDataFrame(
        [(n, store.path(n), s) for n, s in status.items()],
        "table_name string, path string, status string",
    )
    if not found:
        return listing.select(
            "table_name",
            "path",
            F.lit(None).cast("bigint").alias("records"),
            F.lit(None).cast("int").alias("columns"),
            "status",
        )
    return listing.join(count_tables(found), "table_name", "left").select(
        "table_name", "path", "records", "columns", "status"
    )
