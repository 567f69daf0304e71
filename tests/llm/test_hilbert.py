import numpy as np
import pytest
from pyspark.sql import functions as F

from tillview.llm import hilbert
from tillview.llm.queries import REGISTRY


def brute(rows, asked, k=5):
    """(query, rank) -> (vec_id, score) over rows (vec_id, vector)."""
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for q in sorted(set(ids[asked(ids)].tolist())):
        for row in np.flatnonzero(ids == q)[:1]:
            near = np.round(x @ x[row], 12)
            others = np.flatnonzero(ids != q)
            best = others[np.lexsort((ids[others], -near[others]))[:k]]
            out |= {(q, n + 1): (int(ids[b]), near[b]) for n, b in enumerate(best)}
    return out


def found(df):
    return {(r.query_id, r.rank): (r.vec_id, r.score) for r in df.collect()}


def recall(got, want):
    pairs = lambda x: {(q, v[0]) for (q, _), v in x.items()}
    return len(pairs(got) & pairs(want)) / len(pairs(want))


def test_query_reaches_the_recall(spark, small):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    got, want = found(REGISTRY["op10_hilbert_ann"](spark, small)), brute(rows, lambda i: i % 50 == 0)
    assert got.keys() == want.keys() and recall(got, want) >= 0.9
    for key, (vec_id, score) in got.items():
        if vec_id == want[key][0]:
            assert score == pytest.approx(want[key][1], abs=1e-9)


@pytest.mark.parametrize("kind", ["noise", "clusters", "surface"])
def test_recall_with_many_blocks(spark, monkeypatch, kind):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((12_000, 24))
    if kind == "clusters":
        x = 4 * rng.standard_normal((30, 24))[rng.integers(0, 30, len(x))] + x
    if kind == "surface":
        x = rng.standard_normal((len(x), 3)) @ rng.standard_normal((3, 24)) + 0.001 * x
    plans, plan = [], hilbert.plan
    monkeypatch.setattr(hilbert, "plan", lambda *a: plans.append(plan(*a)) or plans[-1])
    rows = [(k, v) for k, v in enumerate(x.astype(np.float32).tolist())]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(8)
    got = found(hilbert.nearest(vectors, F.col("vec_id") % 50 == 0))
    assert recall(got, brute(rows, lambda i: i % 50 == 0)) >= 0.9
    ((curves, blocks),) = plans
    assert curves * min(3, blocks) <= blocks  # never more than all against all
    if kind == "surface":
        assert blocks >= 10


def test_copies_and_rows_that_take_no_part(spark):
    rng = np.random.default_rng(3)
    rows = [(k, v) for k, v in enumerate(rng.standard_normal((300, 8)).tolist())]
    rows += [(k, [1.0] * 8) for k in range(1000, 1600)]  # one vector in two thirds of the rows
    bad = [(2000, None), (2050, [0.0] * 8), (2100, [1.0, None] * 4), (2150, [float("nan")] * 8), (2200, [float("inf")] + [1.0] * 7), (2250, [1.0]), (2300, []), (None, [1.0] * 8)]
    vectors = spark.createDataFrame([(*r, "a") for r in [*rows, *rows[:60], *bad]], "vec_id long, embedding array<double>, rank string")
    got, want = found(hilbert.nearest(vectors, F.col("vec_id") % 50 == 0)), brute(rows, lambda i: i % 50 == 0)
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert got[1000, 1][0] == 1001 and got[1050, 1][0] == 1000


def test_slices_of_a_block_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(k, v) for k, v in enumerate(rng.standard_normal((1500, 8)).tolist())]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = found(hilbert.nearest(vectors, F.col("vec_id") % 10 == 0))
    monkeypatch.setattr(hilbert, "SLICE", 100)
    sliced = found(hilbert.nearest(vectors, F.col("vec_id") % 10 == 0))
    assert {k: v[0] for k, v in sliced.items()} == {k: v[0] for k, v in whole.items()}


def test_the_plan_compares_least():
    """Neighbours near on all curves, near on some curve only, near on none."""
    draw = np.random.default_rng(4)
    near = draw.integers(0, 50, (8, 900))
    assert hilbert.plan(near, 100_000) == (1, 100_000 // hilbert.LEAST_BLOCK)
    far = draw.integers(0, 100_000, (8, 900))
    assert hilbert.plan(far, 100_000) == (1, 1)
    some = np.where(draw.random((8, 900)) < 0.6, near, far)
    curves, blocks = hilbert.plan(some, 100_000)
    assert 1 < curves < 8 and blocks == 100_000 // hilbert.LEAST_BLOCK
    assert (some[:curves].min(axis=0) <= hilbert.LEAST_BLOCK).mean() >= hilbert.RECALL
    for spans in (near, far, some):
        curves, blocks = hilbert.plan(spans, 100_000)
        assert curves * min(3, blocks) / blocks <= 1


def test_few_and_no_rows(spark):
    vectors = spark.createDataFrame([(0, [1.0, 0.0]), (50, [0.0, 2.0]), (7, [-1e200, 1e200])], "vec_id long, embedding array<double>")
    got = found(hilbert.nearest(vectors, F.col("vec_id") % 50 == 0))
    assert {k: v[0] for k, v in got.items()} == {(0, 1): 50, (0, 2): 7, (50, 1): 7, (50, 2): 0}
    assert got[50, 1][1] == pytest.approx(0.5**0.5)
    assert hilbert.nearest(vectors.where("false"), F.col("vec_id") % 50 == 0).count() == 0
    assert hilbert.nearest(vectors.where("vec_id = 50"), F.col("vec_id") % 50 == 0).count() == 0


def test_keys_follow_one_curve():
    """All cells are visited once, each step to a neighbour."""
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = hilbert.hilbert_keys(cells, 3)
    assert sorted(keys) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()
