import zlib

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tillview.llm import packing
from tillview.llm.packing import CAPACITY, OPEN_BINS, Bins, Ids, pack, pieces
from tillview.llm.queries import PACKING_VOCABULARY, REGISTRY
from tillview.llm.shared import vocabulary

CONTENT = vocabulary(PACKING_VOCABULARY)
TOKENIZER = Tokenizer.from_str(CONTENT.decode())
IDS = Ids(CONTENT)


def ids_of(text):
    return np.array([*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0], "<u4")


def check(packed: pd.DataFrame, texts: list[tuple], capacity: int) -> None:
    want = []
    for doc_id, text in texts:
        ids = ids_of(text)
        for k in range(0, len(ids), capacity):
            part = ids[k : k + capacity]
            want.append((-1 if doc_id is None else doc_id, k // capacity, k, len(part), zlib.crc32(part.tobytes())))
    got = packed.assign(doc_id=packed.doc_id.fillna(-1).astype(int))[["doc_id", "piece", "start", "length", "ids_crc32"]]
    assert sorted(map(tuple, got.values.tolist())) == sorted(want)
    for _, rows in packed.sort_values("offset").groupby("sequence_id"):
        assert rows.offset.tolist() == [0, *rows.length.cumsum().tolist()[:-1]]
        assert rows.length.sum() <= capacity


def test_query_packs_all_documents(spark, small, documents):
    packed = REGISTRY["op4_best_fit_packing"](spark, small).toPandas()
    check(packed, [(r.doc_id, r.text) for r in documents.collect()], 2048)
    least = -(-packed.length.sum() // 2048)
    assert packed.sequence_id.nunique() <= 1.02 * least + 1


@pytest.mark.parametrize("capacity", [7, 2048])
def test_edges(edges, capacity):
    packed = pack(edges, CONTENT, capacity=capacity, keep_ids=True).toPandas()
    check(packed, [(r.doc_id, r.text) for r in edges.collect()], capacity)
    assert [zlib.crc32(x) for x in packed.ids] == packed.ids_crc32.tolist()


def test_empty_table(empty):
    assert pack(empty, CONTENT).count() == 0


def test_bins_close_and_waste_little(spark):
    """In arrival order, at the production bound, on the larger of the small tables."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    lengths = [r.length for r in pieces(docs, CONTENT).select("length").collect()]
    bins = Bins(CAPACITY, OPEN_BINS)
    for n in lengths:
        bins.place(n)
    assert bins.closed > 0
    assert bins.made <= 1.02 * -(-sum(lengths) // CAPACITY)


def test_words_are_forgotten_in_two_generations(monkeypatch):
    monkeypatch.setattr(packing, "WORDS", 40)
    ids = Ids(CONTENT)
    for k in range(60):
        text = f"word{k}, the other word{k % 7} and more!"
        assert np.frombuffer(ids([text])[0], "<u4").tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aeé İΣς'.,!|<>-_#1٣½\n\t\xa0́🎉 st"), st.characters(codec="utf-8")), max_size=60))
def test_word_ids_are_the_tokenizers(text):
    assert np.frombuffer(IDS([text])[0], "<u4").tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=200), st.integers(1, 8))
def test_bins_are_the_best_fit(lengths, limit):
    """Against a plain list of open bins: the fullest that holds the piece, the fullest closes first."""
    bins, open_bins = Bins(40, limit), {}
    for n in lengths:
        at, offset = bins.place(n)
        fitting = [left for left in open_bins.values() if left >= n]
        if fitting:
            assert open_bins[at] == min(fitting) and offset == 40 - open_bins[at]
            left = open_bins.pop(at) - n
        else:
            assert at not in open_bins and offset == 0
            if n < 40 and len(open_bins) >= limit:
                fullest = min(open_bins.values())
                gone = [b for b in open_bins if open_bins[b] == fullest and b not in bins.by_free[fullest]]
                del open_bins[gone[0]]
            left = 40 - n
        if left:
            open_bins[at] = left
        assert len(open_bins) == bins.open <= limit
