import hashlib
import zlib
from collections import defaultdict

import duckdb
import pytest
from compare import difference
from pyspark.sql import functions as F

from tillview.llm.linear import remainder
from tillview.llm.merkle import manifest, prove
from tillview.llm.queries import ORACLE, REGISTRY


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*values):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def path(tree, i):
    for level in tree[:-1]:
        yield (level[i ^ 1] if i ^ 1 < len(level) else ""), i & 1
        i >>= 1


def slow(rows):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of rows (doc_id, source, lang, n_chars, text)."""
    runs = defaultdict(list)
    for doc_id, source, lang, n, text in rows:
        own = leaf(doc_id, source, lang, n, text)
        bad = doc_id is not None and n is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
        runs[lang].append(((doc_id is not None, doc_id or 0, own), doc_id, own, leaf(doc_id, source, lang, n + 1, text) if bad else own))
    langs = sorted(runs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {g: levels([x[2] for x in sorted(runs[g], key=lambda x: x[0])]) for g in langs}
    top = levels([trees[g][-1][0] for g in langs])
    for k, g in enumerate(langs):
        for i, (_, doc_id, own, given) in enumerate(sorted(runs[g], key=lambda x: x[0])):
            steps = [*path(trees[g], i), *path(top, k)]
            folded = given
            for sibling, odd in steps:
                folded = h(sibling, folded) if odd else h(folded, sibling)
            yield doc_id, own, trees[g][-1][0], top[-1][0], h(*(s for s, _ in steps)), folded, folded == top[-1][0]


def key(row):
    return tuple("" if x is None else str(x) for x in row)


def test_edges(edges):
    docs = edges.withColumns({"n_chars": F.length("text"), "leaf": F.lit("x"), "pos": F.lit(1), "run": F.lit("r"), "step": F.lit(0)})
    got = manifest(docs, remainder("doc_id", 7) == 0).collect()
    want = slow((r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect())
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("count", [1, 37])
def test_one_run_of_many_sizes(spark, count):
    rows = [(k, "s", "en", k, f"text {k}") for k in range(count)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string")
    got = manifest(docs, remainder("doc_id", 7) == 0).collect()
    assert sorted(map(tuple, got)) == sorted(slow(rows))


@pytest.mark.parametrize("stride", [2])
def test_steps_of_any_stride_lead_to_the_root(spark, stride):
    """Many runs of uneven sizes: short steps, several of them above the subroots."""
    sizes = [1, 2, 3, 9, 17, 1, 4, 1, 6]
    rows = [(100 * g + k, "s", f"{g}", 1, "x") for g, n in enumerate(sizes) for k in range(n)]
    leaves = spark.createDataFrame([(r[2], r[0], leaf(*r)) for r in rows], "run string, doc_id long, hexed string")
    got = prove(leaves.select("run", "doc_id", F.unhex("hexed").alias("digest"), F.unhex("hexed").alias("given")), stride).collect()
    want = {w[0]: w for w in slow(rows)}
    assert len(got) == len(rows)
    for r in got:
        _, own, subroot, root, proof, *_ = want[r.doc_id]
        assert (r.leaf.hex(), r.subroot.hex(), r.root.hex(), r.folded.hex()) == (own, subroot, root, root)
        assert h(r.proof.hex()) == proof


def test_empty_table(empty):
    assert manifest(empty.withColumn("n_chars", F.lit(1)), F.lit(True)).count() == 0


def test_limit_of_recursive_rows_stays_as_it_was(spark, empty):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    manifest(empty.withColumn("n_chars", F.lit(1)), F.lit(True))
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before


def test_query_matches_sql(spark, small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{small}/conversations.parquet'")
    assert difference(REGISTRY["op11_merkle_manifest"](spark, small), con, ORACLE["op11_merkle_manifest"]) == ""
