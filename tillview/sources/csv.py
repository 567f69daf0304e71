"""CSV sources bound by header name."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tillview.sources.schemas import Source

CORRUPT = "_corrupt_line"
REJECTED = "rejected_fields"
UNDECLARED = "undeclared_fields"
FILE_NAME = "_file_name"


def scan_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Header and types taken from the data; Spark reads the file twice."""
    return spark.read.options(header=True, inferSchema=True).csv(path)


def scan_csv(spark: SparkSession, path: str, source: Source) -> DataFrame:
    """The declared columns of ``source``, found by header name.

    Spark binds a declared CSV schema by position, which silently shifts the
    values of a file whose columns differ. Here the header decides: each
    declared column is taken from the field of that name (or an accepted
    spelling of it) and cast; a column the file lacks is NULL. A value that
    does not cast becomes NULL and its column is listed in
    ``rejected_fields``; a line with the wrong number of fields lists
    ``_corrupt_line``. Columns that are not declared are kept as JSON text in
    ``undeclared_fields``. No row is dropped. If the files of a folder disagree on
    their header the read fails rather than mixing columns up.
    """
    header = spark.read.option("header", True).csv(path).columns
    raw = (
        spark.read.schema(", ".join([f"`{h}` string" for h in header] + [f"{CORRUPT} string"]))
        .options(header=True, enforceSchema=False, columnNameOfCorruptRecord=CORRUPT)
        # a pruned scan does not notice lines with fields missing
        .option("columnPruning", False)
        .csv(path)
    )
    field_of = {h.strip().lower(): h for h in header}
    for spelling, declared in source.also_known_as:
        if spelling in field_of:
            field_of.setdefault(declared, field_of[spelling])

    columns: list[Column] = []
    rejects: list[Column] = [F.when(F.col(CORRUPT).isNotNull(), F.lit(CORRUPT))]
    for declared in source.schema:
        name, kind = declared.name, declared.dataType
        if name not in field_of:
            columns.append(F.lit(None).cast(kind).alias(name))
            continue
        text = F.col(f"`{field_of[name]}`")
        if isinstance(kind, StringType):
            columns.append(text.alias(name))
            continue
        value = F.trim(text).try_cast(kind)
        columns.append(value.alias(name))
        rejects.append(F.when(text.isNotNull() & value.isNull(), F.lit(name)))
    bound = {field_of[f.name] for f in source.schema if f.name in field_of}
    others = [F.col(f"`{h}`") for h in header if h not in bound]
    undeclared = F.to_json(F.struct(*others)) if others else F.lit(None).cast("string")
    return raw.select(
        *columns,
        undeclared.alias(UNDECLARED),
        F.array_compact(F.array(*rejects)).alias(REJECTED),
        F.col("_metadata.file_name").alias(FILE_NAME),
    )


def stamp_load(
    df: DataFrame, load_ts: datetime, source_file: Column | str | None = None
) -> DataFrame:
    """Adds ``ingestion_timestamp``, ``source_file`` and ``bronze_load_date``.

    ``source_file`` is the file each row came from where the scan knows it."""
    if source_file is None:
        source_file = F.col(FILE_NAME)
    elif isinstance(source_file, str):
        source_file = F.lit(source_file)
    stamped = df.withColumns(
        {
            "ingestion_timestamp": F.lit(load_ts),
            "source_file": source_file,
            "bronze_load_date": F.lit(load_ts.date()),
        }
    )
    return stamped.drop(FILE_NAME)


def rejected_rows(bronze: DataFrame) -> DataFrame:
    """Rows of an ingested table with at least one field that did not parse."""
    return bronze.filter(F.size(REJECTED) > 0)
