"""Merkle manifest of a table, and proofs that ascend it in a recursive query.

``H`` is the lower-case hex SHA-256 of its inputs, digests as hex text. A row's leaf is
``H`` of its fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and its value.
Leaves of a run (equal ``lang``) ascend by ``doc_id``; every two consecutive nodes (the last
may be alone) become their ``H`` until one is left, the run's subroot. Subroots, ordered by
``lang``, give the root the same way.

The tree is built ``STRIDE`` levels at a time. A stored node row holds its digest, the
siblings on its way up these levels, and its place; its parent is the node ``STRIDE``
levels up, at ``pos >> STRIDE``. Nodes of a run that has ended go up alone, so that all
leaves are equally far from the root. A recursive query takes each leaf up from parent to
parent, appends the siblings it meets and folds the digest that it was given with them.

Leaves are numbered by a range shuffle of the digests and one count per run and range;
no run, however large, is ordered in one task, and no text is shuffled.

A null ``lang`` is a run of its own that comes first; null ids come first in a run, equal
ids by their leaf; repeated rows are leaves each (their order cannot matter). Nulls,
empty and very long texts are leaves like any other. An empty table has no rows and no
root. Other columns take no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillview.llm.shared import stage

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels between a stored node and its parent; a block of 2 ** STRIDE nodes is one row while it is built.
STRIDE = 10
#: The run of the subroots; those of languages begin with another sign.
TOP = ""


def digest(*parts: Column) -> Column:
    """``H`` as 32 bytes; parts are text."""
    return F.unhex(F.sha2(F.concat(*parts), 256))


def hexed(binary: Column) -> Column:
    return F.lower(F.hex(binary))


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(**instead: Column) -> Column:
    """The leaf of a row of ``FIELDS``; ``instead`` replaces fields."""
    return digest(*(field(instead.get(c, F.col(c))) for c in FIELDS))


def numbered(rows: DataFrame, run: str, order: list[str], label: str) -> DataFrame:
    """``rows`` with ``pos``, from 0 in each run by ``order``. Rows are spread by range, equal
    ones too; a range's rows are counted by run, and only those counts are summed up."""
    spread = rows.withColumn("tie", F.monotonically_increasing_id())
    keys = [F.col(run), *(F.col(c).asc_nulls_first() for c in order), F.col("tie")]
    ranged = spread.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("tie")
    placed = stage(ranged.withColumn("at", F.monotonically_increasing_id()).withColumn("range", F.shiftright("at", 33)), label)
    counts = placed.groupBy(run, "range").agg(F.min("at").alias("least"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy(run).orderBy("range")) - F.col("n")
    based = counts.select(run, "range", (before - F.col("least")).alias("shift"))
    return placed.join(based, [run, "range"]).withColumn("pos", F.col("at") + F.col("shift")).drop("at", "range", "shift")


def _paired(nodes: Column) -> Column:
    """The level above a list of digests."""
    return F.transform(
        F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / 2).cast("int")),
        lambda i: digest(hexed(F.get(nodes, 2 * i)), F.coalesce(hexed(F.get(nodes, 2 * i + 1)), F.lit(""))),
    )


def _blocks(nodes: DataFrame, stride: int) -> DataFrame:
    """From rows (run, rows: how many nodes the run has, pos, digest, ...): one row per block
    of 2 ** stride nodes with these and all levels above them; the last is one digest."""
    height = F.when(F.col("rows") > 1, F.least(F.lit(stride), F.length(F.bin(F.col("rows") - 1)))).otherwise(0)
    own = F.struct("pos", *(c for c in nodes.columns if c not in ("run", "rows", "pos")))
    listed = nodes.groupBy("run", "rows", F.shiftright("pos", stride).alias("block")).agg(F.array_sort(F.collect_list(own)).alias("nodes"))
    climbed = F.aggregate(
        F.slice(F.sequence(F.lit(1), F.lit(stride)), F.lit(1), height),
        F.array(F.transform("nodes", lambda n: n["digest"])),
        lambda levels, _: F.concat(levels, F.array(_paired(F.element_at(levels, -1)))),
    )
    return listed.withColumn("levels", climbed)


def _rows(blocks: DataFrame, stride: int) -> DataFrame:
    """The nodes of blocks with the siblings on their ``path`` (an empty entry where a level
    has none) and the place of their parent."""
    at = lambda depth: F.call_function("shiftright", F.col("i"), depth)
    path = F.transform(
        F.slice("levels", F.lit(1), F.size("levels") - 1),
        lambda level, depth: F.coalesce(F.get(level, at(depth).bitwiseXOR(F.lit(1))), F.lit(b"")),
    )
    inside = blocks.select("run", "block", "levels", F.posexplode("nodes").alias("i", "node"))
    return inside.select("run", "node.*", path.alias("path"), F.col("run").alias("parent_run"), F.col("block").alias("parent_pos"))


def _above(blocks: DataFrame, stride: int) -> DataFrame:
    """The nodes above the blocks, with the number of nodes that the run has there."""
    left = F.ceil(F.col("rows") / (1 << stride)).cast("long")
    return blocks.select("run", F.col("block").alias("pos"), F.get(F.element_at("levels", -1), F.lit(0)).alias("digest"), left.alias("rows"))


def _steps(rows: int | None, stride: int) -> int:
    """Steps from the nodes of a run to the one that is left, one at least."""
    return max(1, -(-((rows or 1) - 1).bit_length() // stride))


#: The digest that ``own`` at ``pos`` leads to along ``path``: siblings stand left of odd places.
FOLD = """aggregate({path}, struct({own} AS own, {pos} AS at), (a, sibling) -> struct(
             unhex(sha2(concat(CASE WHEN a.at % 2 = 1 THEN lower(hex(sibling)) ELSE '' END,
                               lower(hex(a.own)),
                               CASE WHEN a.at % 2 = 0 THEN lower(hex(sibling)) ELSE '' END), 256)) AS own,
             shiftright(a.at, 1) AS at), a -> a.own)"""
#: All siblings of a path, end to end.
JOINED = "aggregate({path}, CAST('' AS BINARY), (a, sibling) -> concat(a, sibling))"
CLIMB = f"""
WITH RECURSIVE climb (doc_id, leaf, subroot, step, run, pos, folded, siblings) AS (
  SELECT doc_id, digest, CAST(NULL AS BINARY), 1, parent_run, parent_pos,
         {FOLD.format(path="path", own="given", pos="pos")}, {JOINED.format(path="path")}
  FROM {{leaves}}
  UNION ALL
  SELECT c.doc_id, c.leaf, CASE WHEN n.step = {{top}} THEN n.digest ELSE c.subroot END, c.step + 1, n.parent_run, n.parent_pos,
         {FOLD.format(path="n.path", own="c.folded", pos="n.pos")}, concat(c.siblings, {JOINED.format(path="n.path")})
  FROM climb c JOIN {{nodes}} n ON n.step = c.step AND n.run = c.run AND n.pos = c.pos
)
SELECT doc_id, leaf, subroot, folded, siblings FROM climb WHERE step = {{last}}"""


@contextmanager
def _unlimited(spark: SparkSession) -> Iterator[None]:
    """Recursive queries may give any number of rows (a million otherwise)."""
    name = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, -1)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def build(leaves: DataFrame, stride: int = STRIDE) -> tuple[DataFrame, DataFrame, int, int, bytes | None]:
    """From rows (run, digest, doc_id, ...): the rows as leaves with pos, path and parent; the
    node rows above (step, run, pos, digest, path, parent); the step at which the subroots
    are nodes; the number of steps; the root. Runs jobs; what reaches the driver is counts and the root."""
    placed = numbered(leaves, "run", ["doc_id", "digest"], "leaves")
    runs = stage(placed.groupBy("run").agg(F.count("*").alias("rows")), "runs")
    most, found = runs.agg(F.max("rows"), F.count("*")).first()
    top = _steps(most, stride)
    last = top + _steps(found, stride)
    level, kept = placed.join(runs, "run"), []
    for step in range(last):
        blocks = stage(_blocks(level, stride), "blocks")
        rows, level = _rows(blocks, stride), _above(blocks, stride)
        if step == top - 1:  # the run has one block here, and its parent is the subroot among the subroots
            subroots = stage(numbered(level.select("run", F.lit(TOP).alias("parent_run"), "digest"), "parent_run", ["run"], "subroots"), "subroots")
            rows = rows.drop("parent_run", "parent_pos").join(subroots.select("run", "parent_run", F.col("pos").alias("parent_pos")), "run")
            level = subroots.select(F.lit(TOP).alias("run"), "pos", "digest", F.lit(found).cast("long").alias("rows"))
        kept.append(rows.withColumn("step", F.lit(step)))
    nodes = reduce(DataFrame.unionByName, kept[1:])
    root = level.first()
    return kept[0], stage(nodes, "nodes"), top, last, root and bytes(root["digest"])


def prove(leaves: DataFrame, stride: int = STRIDE, proof: Callable[[Column], Column] = lambda siblings: siblings) -> DataFrame:
    """From rows (run, doc_id, digest, given): doc_id, leaf, subroot, root, ``folded`` (the root that
    the digest ``given`` leads to) and ``proof``, by default the siblings' digests end to
    end, from the leaf to the root, or what ``proof`` makes of them; digests are binary.
    Runs jobs."""
    spark = leaves.sparkSession
    placed, nodes, top, last, root = build(leaves, stride)
    with _unlimited(spark):
        climbed = spark.sql(CLIMB, leaves=placed, nodes=nodes, top=top, last=last)
        climbed = stage(climbed.select("doc_id", "leaf", "subroot", "folded", proof(F.col("siblings")).alias("proof")), "climbed")
    return climbed.withColumn("root", F.lit(root).cast("binary"))


def manifest(docs: DataFrame, tampered: Column) -> DataFrame:
    """Leaf, subroot, root and proof of every row, all untampered, and the root that its proof
    leads to from the leaf with ``n_chars`` one higher where ``tampered`` holds. Runs jobs."""
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    base = docs.select(*FIELDS, F.coalesce(tampered, F.lit(False)).alias("tampered"))
    leaves = base.select(
        F.coalesce(F.concat(F.lit("+"), F.col("lang")), F.lit("!")).alias("run"),
        "doc_id",
        leaf_digest().alias("digest"),
        F.when(F.col("tampered"), leaf_digest(n_chars=more)).alias("changed"),
    )
    given = leaves.select("run", "doc_id", "digest", F.coalesce("changed", "digest").alias("given"))
    proved = prove(given, proof=lambda siblings: F.sha2(hexed(siblings), 256))
    return proved.select(
        "doc_id",
        hexed(F.col("leaf")).alias("leaf"),
        hexed(F.col("subroot")).alias("subroot"),
        hexed(F.col("root")).alias("root"),
        F.col("proof").alias("proof_sha256"),
        hexed(F.col("folded")).alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )
