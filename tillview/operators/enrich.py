"""Left joins of a large fact table to a dimension, safe against hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SALT, HOT = "_salt", "_hot"
FACT, FOUND = "_fact", "_found"


# Tasks that merge the scan tasks' sketches before one task merges theirs.
MERGERS = 64
#: Rows beyond which a dimension is taken to be too large for Spark to broadcast. Stored ones of
#: this repository pass Spark's own 10 MB at 1.5 (customers) and 2.2 million rows (products).
LARGE = 1_500_000


def hot_keys(facts: DataFrame, key: str, share: float = 0.001) -> DataFrame:
    """The key values that may hold more than ``share`` of the rows.

    A frequent-items sketch over the key column alone, of bounded size: every
    scan task makes one, a fixed number of tasks merge them and one task merges
    theirs. At most ``1.25 / share`` values can pass, whatever the data. The
    list steers how the join is split and never what it returns, so the sketch's
    error cannot change a result.
    """
    capacity = int(4 / share)
    most = min(int(1.25 / share), capacity)
    known = facts.filter(F.col(key).isNotNull())
    merged = (
        known.groupBy((F.spark_partition_id() % MERGERS).alias("merger"))
        .agg(F.expr(f"approx_top_k_accumulate({key}, {capacity})").alias("items"), F.count("*").alias("rows"))
        .agg(F.expr(f"approx_top_k_combine(items, {capacity})").alias("items"), F.sum("rows").alias("rows"))
    )
    counted = merged.select("rows", F.explode(F.expr(f"approx_top_k_estimate(items, {most})")).alias("i"))
    return counted.filter(F.col("i.count") > F.col("rows") * F.lit(share)).select(F.col("i.item").alias(key))


def left_join_salted(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    hot: DataFrame,
    spread_by: Sequence[str],
    salts: int = 64,
) -> DataFrame:
    """``facts`` left join ``dim`` on ``key`` with the keys of ``hot`` split into ``salts``.

    Fact rows of a hot key take a salt from the hash of ``spread_by``; all
    others have salt 0. The dimension repeats its rows of hot keys, and only
    those, once per salt. NULL keys match nothing and are spread as well.
    ``dim`` must be unique on ``key``. ``hot`` is a list of bounded length, see
    :func:`hot_keys`, and is looked up by hash on both sides.
    """
    listed = F.broadcast(hot.select(key, F.lit(True).alias(HOT)))
    spread = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    split = F.col(key).isNull() | F.col(HOT).isNotNull()
    salted_facts = (
        facts.join(listed, key, "left").withColumn(SALT, F.when(split, spread).otherwise(F.lit(0))).drop(HOT)
    )
    all_salts = F.sequence(F.lit(0), F.lit(salts - 1))
    salted_dim = (
        dim.join(listed, key, "left")
        .withColumn(SALT, F.explode(F.when(F.col(HOT), all_salts).otherwise(F.array(F.lit(0)))))
        .drop(HOT)
    )
    return salted_facts.join(salted_dim, [key, SALT], "left").drop(SALT)


def left_join_in_place(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    hot: DataFrame,
    pairs: DataFrame,
    by: str,
    salts: int = 64,
) -> DataFrame:
    """``facts`` left join a large ``dim`` on ``key`` without moving the facts.

    ``facts`` should be hash-partitioned by the column ``by`` alone, as a join on it leaves them;
    on others Spark adds a shuffle, and the result is the same. The dimension meets only
    ``pairs`` of ``by`` and key (:func:`left_join_salted`), and what it has is sent back to where
    the facts are, as rows beside them; a window over ``by`` and the key hands it to the facts.
    So two narrow rows per pair are shuffled instead of a whole fact. ``pairs`` must hold
    those of all facts, with a key; copies and pairs that no fact has do no harm.
    ``dim`` must be unique on ``key``.
    """
    values = [c for c in dim.columns if c != key]
    found = left_join_salted(pairs.select(by, key), dim, key, hot, [by], salts).repartition(by)
    rest = [c for c in facts.columns if c not in (by, key)]
    packed = facts.select(by, key, F.struct(*rest).alias(FACT))
    beside = packed.unionByName(found.select(by, key, F.struct(*values).alias(FOUND)), allowMissingColumns=True)
    met = beside.withColumn(FOUND, F.max(FOUND).over(Window.partitionBy(by, key))).filter(F.col(FACT).isNotNull())
    return met.select(by, key, f"{FACT}.*", *[F.col(f"{FOUND}.{c}").alias(c) for c in values])
