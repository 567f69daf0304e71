import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import own_columns
from tillview.llm import simhash
from tillview.llm.components import connected
from tillview.llm.queries import REGISTRY


def slow(text, length=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + length]) for i in range(max(1, len(words) - length + 1))] if words else []
    values = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values)) if values else 0


def slow_components(rows, radius):
    """Least id by fingerprint, by merging all pairs within the radius."""
    prints = sorted({p for _, p in rows})
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, p in enumerate(prints):
        for q in prints[:i]:
            if (p ^ q).bit_count() <= radius:
                root[find(p)] = find(q)
    least = {}
    for doc_id, p in rows:
        if doc_id is not None:
            least[find(p)] = min(doc_id, least.get(find(p), doc_id))
    return {p: least.get(find(p)) for p in prints}


def test_query_is_brute_force(spark, small, documents):
    got = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in REGISTRY["op5_simhash"](spark, small).collect()}
    rows = [(r.doc_id, slow(r.text)) for r in documents.collect()]
    want = slow_components(rows, 2)
    assert got == {doc_id: (p, want[p]) for doc_id, p in rows}


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_links_keep_components_whole(spark, radius):
    rng = np.random.default_rng(radius)
    base = [int(x) for x in rng.integers(0, 1 << 63, 6)]
    prints = {0, (1 << 64) - 1, *base}
    for p in list(prints) * 15:
        for _ in range(rng.integers(1, 5)):
            p ^= 1 << int(rng.integers(0, 64))
        prints.add(p)
    rows = [(k, p) for k, p in enumerate(sorted(prints))]
    signed = [(k, p - (1 << 64) if p >> 63 else p) for k, p in rows]
    found = simhash.groups(spark.createDataFrame(signed, "doc_id long, print long"), radius)
    got = {r.print & (1 << 64) - 1: r.component_id for r in found.collect()}
    assert got == slow_components(rows, radius)


def test_edges(edges):
    got = simhash.near_duplicates(edges).collect()
    assert len(got) == 10
    by_id = {r.doc_id: r for r in got}
    assert {by_id[k].component_id for k in (1, 2, 3)} == {1} and by_id[1].fingerprint == "0" * 16
    assert by_id[6].component_id == 5 and by_id[None].component_id is None
    assert by_id[4].fingerprint == format(slow("word " * 30_000), "016x")


def test_one_of_each_group_stays(edges, empty):
    kept = simhash.keep_one(edges)
    assert kept.columns == edges.columns and kept.schema == edges.schema
    assert own_columns(kept)
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(x or -1 for x in ids) == [-1, 1, 4, 5, 7, 8]
    assert simhash.keep_one(empty).count() == 0 and simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("kind", ["path", "star", "mixed"])
def test_components(spark, kind):
    edges = {"path": [(i, i + 1) for i in range(60)], "star": [(i, 999) for i in range(60)], "mixed": [(5, 3), (3, 5), (3, 3), (8, 7), (1, 9), (9, 8), (20, 21)]}[kind]
    got = {r.u: r.v for r in connected(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {n: r for n, r in root.items() if n != r}


def test_very_large_groups_send_one_link_a_member(spark):
    """A ball of fingerprints around one value gives links in its size, not its square."""
    ball = [1 << b for b in range(63)] + [0]
    prints = spark.createDataFrame([(p,) for p in ball], "print long")
    assert simhash.links(prints).count() <= 64 * 64
    found = simhash.groups(prints.select(F.col("print").alias("doc_id"), "print"))
    assert found.select("component_id").distinct().count() == 1
