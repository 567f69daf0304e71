import re
from collections import Counter as Counts
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from compare import difference
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillview.llm import phrases
from tillview.llm.phrases import Counter, admitted, collocations, filter_of, mine, phrase_hashes, probes
from tillview.llm.queries import ORACLE, REGISTRY


def grams(rows, longest=3):
    """Counts of (lang, phrase) by size, of rows (lang, text)."""
    out = defaultdict(Counts)
    for lang, text in rows:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in range(1, longest + 1):
                out[size].update((lang or "und", " ".join(words[i : i + size])) for i in range(len(words) - size + 1))
    return out


def slow(rows, least=10, longest=3, share=50, top=2000):
    found = grams(rows, longest)
    n = Counts()
    for (lang, _), c in found[1].items():
        n[lang] += c
    f = {k: c for size in found for k, c in found[size].items() if c >= least}
    scored = defaultdict(list)
    for (lang, phrase), a in f.items():
        words = phrase.split(" ")
        if len(words) < 2:
            continue
        score, _, l, r = min(
            (10**6 * a * a // (f[lang, " ".join(words[:k])] * f[lang, " ".join(words[k:])]), k, f[lang, " ".join(words[:k])], f[lang, " ".join(words[k:])])
            for k in range(1, len(words))
        )
        inside = any(g == lang and 100 * c >= share * a and len(p) > len(phrase) and f" {phrase} " in f" {p} " for (g, p), c in f.items())
        if not inside:
            scored[lang].append((-score, -a, phrase.encode(), l, r))
    for lang, listed in scored.items():
        for rank, (score, a, phrase, l, r) in enumerate(sorted(listed)[:top], 1):
            yield lang, rank, phrase.decode(), -a, l, r, n[lang], -score


ALPHABET = st.sampled_from(["a", "b", "c", "D", "é", "\x1c", "\0", " ", " ", " ", "\t", ".", "\n", "\r", "!"])


def summed(counter, rows):
    out = defaultdict(Counts)
    for batch in [b for lang, text in rows for b in counter.add(lang, text)] + [*counter.flush()]:
        for r in batch.to_pylist():
            out[r["size"]][r["lang"], r["phrase"]] += r["n"]
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["x", "y"]), st.lists(ALPHABET, max_size=40).map("".join)), max_size=6), st.integers(1, 9))
def test_all_phrases_are_counted_whatever_the_flush(rows, flush):
    got = summed(Counter(3, [], flush), rows)
    want = grams(rows)
    assert {k: +v for k, v in got.items() if k} == {k: +v for k, v in want.items() if +v}
    assert sum(got[0].values()) == sum(want[1].values())


def a_filter(keys, bits=1 << 14):
    out = np.zeros(bits // 64, np.uint64)
    for at in probes(phrase_hashes([k[0] for k in keys], [k[1] for k in keys]), bits):
        np.bitwise_or.at(out, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["x", "y"]), st.lists(ALPHABET, max_size=60).map("".join)), min_size=1, max_size=4), st.data())
def test_passes_count_each_border_once(rows, data):
    """What the proposals admit is counted in the pass of the first that does, and nothing twice."""
    want = grams(rows)
    proposals, got = [], Counts()
    for _ in range(3):
        keys = data.draw(st.sets(st.sampled_from(sorted(want[1]) + sorted(want[2]) or [("x", "a")])))
        proposals.append(keys | {k for k in want[1] if any(k[0] == p[0] and k[1] in p[1].split(" ") for p in keys)})
        filters = [a_filter(sorted(p)) for p in proposals]
        for size, found in summed(Counter(3, filters, 7), rows).items():
            got.update({(size, *k): v for k, v in found.items() if size})
    expected = Counts({(1, *k): v for k, v in want[1].items()})
    for size in (2, 3):
        for (lang, phrase), n in want[size].items():
            words = phrase.split(" ")
            parts = {(lang, " ".join(words[:-1])), (lang, " ".join(words[1:]))}
            if any(parts <= p for p in proposals):
                expected[size, lang, phrase] = n
    assert got == expected


def test_a_filter_of_spark_knows_all(spark):
    rows = [("en", f"w{k} v{k % 7}" if k % 2 else f"w{k}", k) for k in range(3000)]
    df = spark.createDataFrame(rows, "lang string, phrase string, n long").repartition(5)
    bits = filter_of(df, len(rows))
    assert admitted(bits, phrase_hashes([r[0] for r in rows], [r[1] for r in rows])).all()
    assert admitted(bits, phrase_hashes(["de"] * 3000, [r[1] for r in rows])).mean() < 0.02
    assert not admitted(filter_of(df.limit(0), 0), phrase_hashes(["en"], ["w0"])).any()


@pytest.mark.parametrize("drawn", ["true", "false", "doc_id % 3 = 0"])
def test_any_sample_gives_the_exact_counts(documents, drawn):
    mined = mine(documents, F.expr(drawn), min_count=4)
    got = {(r.size, r.lang, r.phrase): r.n for r in mined.frequent.where("size > 0").collect()}
    want = {(s, *k): n for s, c in grams((r.lang, r.text) for r in documents.collect()).items() for k, n in c.items() if n >= 4}
    assert got == want
    assert mined.passes <= 3
    if drawn == "true":  # the sample proposes all that is frequent
        assert mined.passes == 1
    if drawn == "false":
        assert mined.passes == 3


def test_edges(edges):
    docs = edges.withColumns({"size": F.lit(1), "phrase": F.lit("x"), "n": F.lit(1)})
    got = collocations(docs, F.lit(True), min_count=2, longest=4, top=5).collect()
    want = slow([(r.lang, r.text) for r in docs.collect()], least=2, longest=4, top=5)
    assert sorted(map(tuple, got)) == sorted(want)


def test_empty_table(empty):
    assert collocations(empty, F.lit(True)).count() == 0


def test_products_beyond_64_bits(spark, monkeypatch):
    n = 3_000_000_019
    rows = [("en", 0, "", 9 * n), ("en", 1, "a", 2 * n), ("en", 1, "b", n + 7), ("en", 2, "a b", n)]
    found = spark.createDataFrame(rows, "lang string, size int, phrase string, n long")
    monkeypatch.setattr(phrases, "mine", lambda *a: phrases.Mined(found, 1))
    (got,) = collocations(found, F.lit(True)).collect()
    assert tuple(got) == ("en", 1, "a b", n, 2 * n, n + 7, 9 * n, 10**6 * n * n // (2 * n * (n + 7)))


def test_query_matches_sql(spark, small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    assert difference(REGISTRY["op13_collocations"](spark, small), con, ORACLE["op13_collocations"]) == ""
