import hashlib

import numpy as np
from pyspark.sql import functions as F

from tillview.llm import minhash
from tillview.llm.queries import REGISTRY


def shingles(text, length=5):
    words = text.lower().split()
    return {tuple(words[i : i + length]) for i in range(max(1, len(words) - length + 1))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def edited_texts(texts):
    return [t[: len(t) - len(t) // 2] + texts[(k + 1) % len(texts)][: len(t) // 2] for k, t in enumerate(texts)]


def test_query_against_exact_likeness(spark, small, documents):
    rows = sorted((r.doc_id, r.text) for r in documents.collect())
    got = sorted(REGISTRY["op7_minhash"](spark, small).collect())
    texts = [t for _, t in rows]
    changed = edited_texts(texts)
    assert [r.doc_id for r in got] == [d for d, _ in rows]
    assert [r.n_chars for r in got] == list(map(len, texts))
    assert [r.edited_sha256 for r in got] == [hashlib.sha256(t.encode()).hexdigest() for t in changed]
    sets, other = list(map(shingles, texts)), list(map(shingles, changed))
    exact = np.array([jaccard(a, b) for a, b in zip(sets, other, strict=True)])
    near = np.array([r.near_edited for r in got])
    many = np.array([len(a | b) for a, b in zip(sets, other, strict=True)]) >= 30
    assert abs(near - exact)[many].mean() < 0.04 and abs((near - exact)[many].mean()) < 0.02
    following = np.array([jaccard(sets[k], sets[(k + 1) % len(sets)]) for k in range(len(sets))])
    assert abs(np.array([r.near_next for r in got]) - following)[many].mean() < 0.04


def test_likeness_of_known_overlap(spark):
    """Unbiased over the range, for texts of few and of many shingles."""
    rng = np.random.default_rng(4)
    for size in (40, 2000):
        for share in (0.2, 0.5, 0.9):
            rows = []
            for k in range(60):
                words = [f"w{x}" for x in rng.integers(0, 1 << 60, 2 * size)]
                same = round(2 * size * share / (1 + share))
                rows.append((" ".join(words[:size]), " ".join(words[:same] + words[size : 2 * size - same]), k))
            pairs = spark.createDataFrame(rows, "a string, b string, k int")
            near = pairs.select(minhash.likeness(minhash.minhash(F.col("a"), 1), minhash.minhash(F.col("b"), 1))).toPandas().iloc[:, 0]
            exact = np.mean([jaccard(shingles(a, 1), shingles(b, 1)) for a, b, _ in rows])
            assert abs(near.mean() - exact) < 0.03, (size, share)


def test_edges(edges, empty):
    got = minhash.compare_edits(edges).collect()
    assert len(got) == 10
    rows = sorted(((r.doc_id is not None, r.doc_id or 0), r.text or "") for r in edges.collect())
    texts = [t for _, t in rows]
    want = sorted((k[1] if k[0] else -1, hashlib.sha256(t.encode()).hexdigest()) for (k, _), t in zip(rows, edited_texts(texts), strict=True))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.edited_sha256) for r in got) == want
    by_id = {r.doc_id: r for r in got}
    assert by_id[5].fingerprint == by_id[6].fingerprint and by_id[1].fingerprint == by_id[3].fingerprint == "0" * 256
    assert by_id[1].near_edited == 1 and by_id[1].near_next == 1 and by_id[2].n_chars == 0
    assert minhash.compare_edits(empty).count() == 0
    assert minhash.compare_edits(edges.where("doc_id = 8")).first().near_next == 1


def test_ranges_meet(spark, monkeypatch):
    """Small ranges give the same as one range, with gaps, repeats and negative ids."""
    rows = [(i * i - 50, f"text {i} with some words " * (i % 7)) for i in range(120)] + [(14, "again")] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = sorted(minhash.compare_edits(docs).collect())
    monkeypatch.setattr(minhash, "RANGE_ROWS", 10)
    assert len(minhash._ranges(docs)[0]) > 5
    assert sorted(minhash.compare_edits(docs).collect()) == whole


def test_no_python_on_the_executors(spark, small):
    plan = REGISTRY["op7_minhash"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
