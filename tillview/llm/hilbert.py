"""Nearest neighbours by cosine over shifted Hilbert curves.

Every curve has its own random projection of the unit vectors to ``AXES`` axes and
its own shift; a point's place on the curve is its Hilbert key, with bits of a hash
below it so that points of one cell still spread. Each curve is cut into blocks of
consecutive keys. A point goes to its block on every curve, a query to its block and
both neighbours; each block ranks its queries against its points by exact cosine in
double precision, and the lists of all blocks are merged. A block of more than
``SLICE`` points or queries is dealt as a grid of slices of both, so that what a task
holds is bounded however large blocks have to be.

Projections come from a sample of at most ``SAMPLE`` points and cuts from the keys of at
most ``CUT_SAMPLE``; every point is indexed. How many curves there are, and how large blocks
are, is measured, not set: for ``PROBES`` query points the exact neighbours are found by brute
force and their distance in ranks is counted on every curve. For each number of curves
blocks must be as large as ``RECALL`` of the neighbours need; the number that has a query
compared least often is taken. So recall holds at any size and for any data, and the work
is never more than every query against every point once: where the data have no structure
that curves could follow, that is one curve of one block.

Equal vectors are one point with its ``k + 1`` smallest ids, which is all that any
answer can show. Vectors that are null, zero, hold null or non-finite components, or
are not of the most frequent length (the shorter at a tie) take no part; repeated
rows of an id and vector count once. Null ids take no part, nor do other columns,
whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tillview.llm.shared import stage

CURVES = 8
AXES, AXIS_BITS = 8, 6
HASH_BITS = 15
SAMPLE = 20_000
#: Points whose keys place the cuts, at most (about: chosen by hash).
CUT_SAMPLE = 1 << 19
PROBES = 192
RECALL = 0.95
#: Sampled points in a block, at least; this bounds the number of blocks.
SAMPLED_PER_BLOCK = 16
#: Points in a block, at least.
LEAST_BLOCK = 256
#: Points, and queries, that one task ranks together, about; a larger block is a grid of such slices.
SLICE = 1 << 14


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of integer points of ``bits`` bits an axis."""
    x = cells.astype(np.int64).T.copy()
    axes = len(x)
    top = 1 << (bits - 1)
    q = top
    while q > 1:  # undo the rotations from the top bit down
        low = q - 1
        for i in range(axes):
            up = (x[i] & q) != 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(up, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = top
    while q > 1:
        turn ^= np.where(x[axes - 1] & q, q - 1, 0)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(axes):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


class Curves:
    """Projections, shifts and, once cut, the first key of each block of every curve."""

    def __init__(self, sample: np.ndarray, curves: int = CURVES, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        dim = sample.shape[1]
        self.axes = [np.linalg.qr(rng.standard_normal((dim, dim)))[0][:, :AXES] for _ in range(curves)]
        seen = [sample @ a for a in self.axes]
        self.low = [np.quantile(s, 0.001, axis=0) for s in seen]
        self.span = [np.maximum(np.quantile(s, 0.999, axis=0) - lo, 1e-12) for s, lo in zip(seen, self.low, strict=True)]
        self.shift = [rng.random(a.shape[1]) * 0.25 for a in self.axes]
        self.starts: list[np.ndarray] = []

    def keys(self, vectors: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Keys of unit vectors, curve by curve; ``ids`` spread those of one cell."""
        mixed = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - HASH_BITS)
        out = []
        for axes, low, span, shift in zip(self.axes, self.low, self.span, self.shift, strict=True):
            place = np.clip((vectors @ axes - low) / span, 0, 1) * 0.75 + shift
            cells = np.minimum((place * (1 << AXIS_BITS)).astype(np.int64), (1 << AXIS_BITS) - 1)
            out.append((hilbert_keys(cells, AXIS_BITS) << HASH_BITS) | mixed.astype(np.int64))
        return np.array(out)

    def first(self, curves: int) -> None:
        """Keep only so many curves."""
        self.axes, self.low, self.span, self.shift = (x[:curves] for x in (self.axes, self.low, self.span, self.shift))

    def cut(self, keys: np.ndarray, blocks: int) -> None:
        at = np.arange(1, blocks) * keys.shape[1] // blocks
        self.starts = [np.unique(np.sort(k)[at]) for k in keys]


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Rows of a list column without nulls as doubles."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(vectors), -1) if len(vectors) else np.zeros((0, 1))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # first, so that squares stay in range
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _best(queries: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its ``k`` nearest points: row, ids and cosines, ties to smaller ids."""
    for first in range(0, len(queries), 128):
        near = queries[first : first + 128] @ points.T
        k = min(k, len(points))
        limit = np.partition(near, len(points) - k, axis=1)[:, len(points) - k] if k else None
        for row, line in enumerate(near if k else []):
            at = np.flatnonzero(line >= limit[row])
            at = at[np.lexsort((ids[at], -line[at]))[:k]]
            yield first + row, ids[at], line[at]


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id and vector of the rows that take part. Runs a job for the length."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(F.col("vec_id").cast("long"), F.col(vector).alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False)))
    length = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("embedding") == (length["n"] if length else 0))


def points_of(rows: DataFrame, k: int, asked: Column) -> DataFrame:
    """Distinct vectors: ``rep`` (least id), embedding, ``members`` (k + 1 smallest ids), ``query``
    (some row of it is asked for)."""
    asked_for = rows.where(asked).select("embedding").distinct().withColumn("query", F.lit(True))
    order = Window.partitionBy("embedding").orderBy("vec_id")
    least = rows.withColumn("_n", F.dense_rank().over(order)).where(F.col("_n") <= k + 1)
    merged = least.groupBy("embedding").agg(F.sort_array(F.collect_set("vec_id")).alias("members"))
    joined = merged.join(asked_for, "embedding", "left")
    return joined.select(F.col("members")[0].alias("rep"), "embedding", "members", F.coalesce("query", F.lit(False)).alias("query"))


def _exact(points: DataFrame, ids: np.ndarray, probes: np.ndarray, k: int) -> dict[int, list[int]]:
    """The ``k`` nearest points of each probe (itself aside), by brute force over blocks of points."""
    shared = points.sparkSession.sparkContext.broadcast(probes)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(row, i, s) for row, at, line in _best(shared.value, _unit(_matrix(batch.column(1))), batch.column(0).to_numpy(), k + 1) for i, s in zip(at.tolist(), line.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([f[c] for f in found], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.float64()))], ["probe", "rep", "near"])

    found = points.select("rep", "embedding").mapInArrow(near, "probe long, rep long, near double")
    order = Window.partitionBy("probe").orderBy(F.desc("near"), "rep")
    rows = found.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k + 1).collect()  # PROBES * (k + 1) rows
    out: dict[int, list[int]] = {}
    for row in sorted(rows, key=lambda r: (r["probe"], r["_n"])):
        if row["rep"] != ids[row["probe"]] and len(out.setdefault(row["probe"], [])) < k:
            out[row["probe"]].append(row["rep"])
    return out


def _reach(points: DataFrame, curves: Curves, ids: np.ndarray, probes: np.ndarray, exact: dict[int, list[int]]) -> np.ndarray:
    """For each probe and exact neighbour, the distance in ranks on every curve."""
    pairs = [(p, n) for p, found in sorted(exact.items()) for n in found]
    wanted = sorted({n for _, n in pairs})
    rows = points.where(F.col("rep").isin(wanted)).select("rep", "embedding").toArrow()  # PROBES * k rows
    place = {r: k for k, r in enumerate(rows["rep"].to_pylist())}
    theirs = curves.keys(_unit(_matrix(rows["embedding"].combine_chunks())), rows["rep"].to_numpy())
    own = curves.keys(probes, ids)
    ends = np.array([[own[:, p], theirs[:, place[n]]] for p, n in pairs])  # pair, end, curve
    grid = [np.unique(ends[:, :, c]) for c in range(ends.shape[2])]

    @arrow_udf("array<long>")
    def place_on(ids: pa.Array, vectors: pa.Array) -> pa.Array:
        keys = curves.keys(_unit(_matrix(vectors)), ids.to_numpy()) if len(ids) else np.zeros((len(grid), 0))
        at = np.array([np.searchsorted(g, k) for g, k in zip(grid, keys, strict=True)]).T
        return pa.ListArray.from_arrays(np.arange(len(at) + 1, dtype=np.int32) * len(grid), pa.array(at.ravel(), pa.int64()))

    gaps = points.select(F.posexplode(place_on("rep", "embedding")).alias("curve", "gap")).groupBy("curve", "gap").count()
    below = [np.zeros(len(g) + 1, np.int64) for g in grid]
    for row in gaps.collect():  # at most a row for each end on each curve
        below[row["curve"]][row["gap"]] = row["count"]
    rank = [np.cumsum(b) for b in below]
    spans = [np.abs(rank[c][np.searchsorted(g, ends[:, 0, c])] - rank[c][np.searchsorted(g, ends[:, 1, c])]) for c, g in enumerate(grid)]
    return np.array(spans)


def plan(spans: np.ndarray, total: int, recall: float = RECALL) -> tuple[int, int]:
    """(curves, blocks) that compare a query least often, from the distances in ranks of its
    neighbours on each curve; a query meets three blocks on each, or all if there are fewer."""
    best = (float(total), 1, 1)
    for curves in range(1, len(spans) + 1):
        size = max(LEAST_BLOCK, int(np.quantile(spans[:curves].min(axis=0), recall)))
        blocks = max(1, total // size)
        best = min(best, (curves * min(3, blocks) / blocks * total, curves, blocks))
    return best[1:]


def _sampled_keys(points: DataFrame, total: int, curves: Curves) -> np.ndarray:
    """Keys of at most about ``CUT_SAMPLE`` points, curve by curve."""

    @arrow_udf("array<long>")
    def keys_of(ids: pa.Array, vectors: pa.Array) -> pa.Array:
        keys = curves.keys(_unit(_matrix(vectors)), ids.to_numpy()).T if len(ids) else np.zeros((0, len(curves.axes)))
        return pa.ListArray.from_arrays(np.arange(len(keys) + 1, dtype=np.int32) * len(curves.axes), pa.array(keys.ravel(), pa.int64()))

    drawn = points if total <= CUT_SAMPLE else points.where(F.pmod(F.xxhash64(F.lit("cut"), F.col("rep")), F.lit(total)) < CUT_SAMPLE)
    table = drawn.select(keys_of("rep", "embedding").alias("keys")).toArrow()
    return table["keys"].combine_chunks().flatten().to_numpy().reshape(-1, len(curves.axes)).T


def nearest(vectors: DataFrame, asked: Column, k: int = 5, recall: float = RECALL, curves: int = CURVES) -> DataFrame:
    """For each row for which ``asked`` holds (over vec_id) its ``k`` nearest other rows:
    query_id, rank, vec_id, score. Runs jobs; the points are written to the shared folder."""
    spark = vectors.sparkSession
    rows = usable(vectors)
    points = stage(points_of(rows, k, asked), "points")
    total = points.count()
    out = "query long, rep long, score double"
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    draw = points if total <= SAMPLE else points.where(F.pmod(F.xxhash64("rep"), F.lit(total)) < SAMPLE)
    sample = draw.select("rep", "embedding").orderBy("rep").toArrow()
    taken, ids = _unit(_matrix(sample["embedding"].combine_chunks())), sample["rep"].to_numpy()
    lines = Curves(taken, curves)
    probes = np.random.default_rng(5).permutation(len(ids))[:PROBES]
    exact = _exact(points, ids[probes], taken[probes], k)
    spans = _reach(points, lines, ids[probes], taken[probes], exact) if exact else np.zeros((1, 1))
    chosen, count = plan(spans, total, recall)
    lines.first(chosen)
    keys = _sampled_keys(points, total, lines)
    lines.cut(keys, max(1, min(count, keys.shape[1] // SAMPLED_PER_BLOCK)))

    @arrow_udf("array<int>")  # it carries the projections and at most CUT_SAMPLE / SAMPLED_PER_BLOCK cuts a curve
    def blocks(ids: pa.Array, vectors: pa.Array) -> pa.Array:
        keys = lines.keys(_unit(_matrix(vectors)), ids.to_numpy()) if len(ids) else np.zeros((len(lines.starts), 0))
        at = np.array([np.searchsorted(s, key, "right") for s, key in zip(lines.starts, keys, strict=True)]).T
        return pa.ListArray.from_arrays(np.arange(len(at) + 1, dtype=np.int32) * len(lines.starts), pa.array(at.ravel(), pa.int32()))

    placed = points.select("rep", "embedding", "query", F.posexplode(blocks("rep", "embedding")).alias("curve", "block"))
    count = min(len(s) for s in lines.starts) + 1
    asking_points = points.where("query").count()
    slices, query_slices = 1 + total // (count * SLICE), 1 + 3 * asking_points // (count * SLICE)
    own = lambda n: F.pmod(F.xxhash64(F.lit("slice"), "rep"), F.lit(n)).cast("int")

    def cells(step: int, query: bool) -> Column:
        """The slices of a block that a point, or a query, goes to: its own of one kind, all of the other."""
        across = F.sequence(F.lit(0), F.lit((slices if query else query_slices) - 1))
        mine = own(query_slices if query else slices)
        pair = lambda k: (k, mine) if query else (mine, k)
        return F.transform(across, lambda k: F.struct((F.col("block") + step).alias("block"), pair(k)[0].alias("slice"), pair(k)[1].alias("query_slice"), F.lit(query).alias("query")))

    roles = F.when(F.col("query"), F.concat(cells(0, False), *(cells(d, True) for d in (-1, 0, 1)))).otherwise(cells(0, False))
    dealt = placed.select("rep", "embedding", "curve", F.explode(roles).alias("r")).select("rep", "embedding", "curve", "r.*")

    def rank(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        asks = group["query"].to_numpy()
        ids, unit = group["rep"].to_numpy(), _unit(_matrix(group["embedding"].combine_chunks()))
        who = ids[asks]
        found = [(who[row], i, s) for row, at, line in _best(unit[asks], unit[~asks], ids[~asks], k + 1) for i, s in zip(at.tolist(), line.tolist(), strict=True)]
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array([f[c] for f in found], t) for c, t in enumerate(kinds)], ["query", "rep", "score"])

    found = dealt.groupBy("curve", "block", "slice", "query_slice").applyInArrow(rank, out).groupBy("query", "rep").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    found = found.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k + 1).drop("_n")
    shown = found.join(points.select("rep", "members"), "rep").select("query", "score", F.explode("members").alias("vec_id"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    shown = shown.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k + 1)
    lists = shown.groupBy("query").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id"))).alias("found"))
    # every row asked for gets its point's list, without itself
    answers = points.where("query").select("embedding", "rep").join(lists, F.col("rep") == F.col("query"))
    asking = rows.where(asked).distinct()
    each = asking.join(answers.select("embedding", "found"), "embedding")
    kept = F.slice(F.filter("found", lambda f: f["vec_id"] != F.col("vec_id")), 1, k)
    listed = each.select(F.col("vec_id").alias("query_id"), F.posexplode(kept).alias("pos", "f"))
    return listed.select("query_id", (F.col("pos") + 1).alias("rank"), F.col("f.vec_id").alias("vec_id"), (-F.col("f.far")).alias("score"))
