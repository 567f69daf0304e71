import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tillview.llm import token_files
from tillview.llm.queries import CHAT_VOCABULARY, REGISTRY
from tillview.llm.shared import vocabulary
from tillview.llm.simple8b import BITS, Frame, crc32_joined, decode, encode, frames
from tillview.llm.token_files import UNSURE, ByteIds, documents_of, encoded, read_pieces, through_files, windows, words_of, write_tokens

CONTENT = vocabulary(CHAT_VOCABULARY)
TOKENIZER = Tokenizer.from_str(CONTENT.decode())
IDS = ByteIds(CONTENT)


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def slow(rows):
    """(doc_id, start, n_tokens, ids_crc32) of rows (doc_id, text) in order."""
    start = 0
    for doc_id, text in rows:
        ids = np.array([*ids_of(text), 0], "<u4")
        yield doc_id, start, len(ids), zlib.crc32(ids.tobytes())
        start += len(ids)


def key(row):
    return row[1]


numbers = st.one_of(st.integers(0, 1), st.integers(0, 300), st.integers(0, 70_000), st.integers(0, 2**64 - 1), st.sampled_from([2**int(b) - 1 for b in BITS] + [2**60, 2**53, 2**64 - 1]))


@settings(max_examples=300, deadline=None)
@given(st.lists(numbers, max_size=400), st.sampled_from([1, 7, 64, 4096]))
def test_words_give_the_ids_back(ids, block):
    ids = np.array(ids, np.uint64)
    words, escapes, offsets = encode(ids, block)
    assert decode(words, escapes, offsets, len(ids), block).tolist() == ids.tolist()
    assert len(escapes) == (ids >= 2**60).sum()


@settings(max_examples=200, deadline=None)
@given(st.lists(numbers, max_size=300), st.data())
def test_frames_are_read_whole_and_in_part(ids, data):
    ids = np.array(ids, np.uint64)
    frame = Frame([3], [0], [0], [len(ids)], [0], ids, 1, 2)
    first, second = frames(frame.to_bytes(16) + b"\n" + frame.to_bytes(32) + b"\n")
    assert first.ids().tolist() == second.ids().tolist() == ids.tolist()
    a = data.draw(st.integers(0, len(ids)))
    b = data.draw(st.integers(a, len(ids)))
    assert first.read(a, b).tolist() == ids[a:b].tolist()


def test_long_runs_take_few_words():
    words, _, _ = encode(np.zeros(4800, np.uint64), 4800)
    assert len(words) == 20
    words, _, _ = encode(np.full(4000, 30_000, np.uint64), 4000)
    assert len(words) == 1000


def test_damage_is_noticed():
    data = bytearray(Frame([3], [0], [0], [2], [0], np.array([5, 6], np.uint64), 0, 0).to_bytes())
    data[-6] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        frames(bytes(data))


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=50), st.binary(max_size=50))
def test_joined_crc32(a, b):
    assert crc32_joined(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


WORDS = st.one_of(st.sampled_from(["a", "é", "the", "'s", "'", ",", ".", "word", " b", "_", "ǆ", "ʰ", "×", "٣", " ", "  ", "\n", "\t", "\xa0", "\x1c", "\0", "1", "!", "🎉", "<|endoftext|>", "<|"]), st.characters(codec="utf-8"))


@settings(max_examples=1500, deadline=None)
@given(st.lists(WORDS, max_size=40).map("".join), st.integers(1, 30))
def test_ids_are_the_tokenizers(text, window):
    assert np.frombuffer(IDS([text])[0], "<u4").tolist() == ids_of(text)
    assert np.frombuffer(b"".join(IDS(list(windows(text, window)))), "<u4").tolist() == ids_of(text)


SURE = st.sampled_from(["a", "é", "ǆ", "the", "'s", "'ll", "'", "S", ",", "!", "_", "1", "23", " ", "  ", "\n", "\t", "\r\n"])


@settings(max_examples=1000, deadline=None)
@given(st.lists(st.lists(SURE, max_size=12).map("".join), max_size=4))
def test_words_are_the_tokenizers(texts):
    assert not any(map(UNSURE.search, texts))
    codes, distinct, stops = words_of(texts)
    assert len(set(distinct)) == len(distinct)
    cut = [[distinct[k] for k in codes[a:b]] for a, b in zip(stops, stops[1:], strict=False)]
    shown = TOKENIZER.pre_tokenizer.pre_tokenize_str
    assert cut == [[t[a:b] for _, (a, b) in shown(t)] for t in texts]


def test_latin_texts_are_not_searched_for_words():
    ids = ByteIds(CONTENT)
    ids.tokenizer = None
    texts = ["Hé, that's it!! word$$$ 555-0546%%%\n\n  more...\t", "", "a.b,\n"]
    assert [np.frombuffer(x, "<u4").tolist() for x in ids(texts)] == [ids_of(t) for t in texts]
    with pytest.raises(AttributeError):
        ids(["字 of another script"])


def test_words_are_forgotten_in_two_generations(monkeypatch):
    monkeypatch.setattr(token_files, "WORDS", 30)
    ids = ByteIds(CONTENT)
    for k in range(60):
        text = f"word{k} the other, word{k % 7} and more."
        assert np.frombuffer(ids([text])[0], "<u4").tolist() == ids_of(text)
        assert len(ids.known) <= 45


def test_rows_keep_their_order(monkeypatch):
    monkeypatch.setattr(token_files, "WINDOW", 300)
    monkeypatch.setattr(token_files, "TOGETHER", 100)
    rows = [(k, "some words, " * (k % 40)) for k in range(100)]
    got = [(k, b"".join(parts)) for k, parts in encoded(IDS, iter(rows))]
    assert [(k, np.frombuffer(x, "<u4").tolist()) for k, x in got] == [(k, ids_of(t)) for k, t in rows]


@pytest.mark.parametrize("frame_ids", [5, 1 << 20])
def test_edges(edges, frame_ids):
    got = through_files(edges, CONTENT, frame_ids=frame_ids).collect()
    rows = sorted(((r.doc_id, r.text) for r in edges.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert sorted(map(tuple, got), key=key) == list(slow(rows))


def test_empty_table(empty):
    assert through_files(empty, CONTENT).count() == 0


def test_files_hold_the_ids(spark, documents, tmp_path):
    path = f"{tmp_path}/tokens"
    write_tokens(documents, CONTENT, path)
    pieces = read_pieces(spark, path, keep_ids=True).collect()
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert sorted(r.doc_id for r in pieces) == sorted(texts)
    for r in pieces[::7]:
        assert np.frombuffer(r.ids, "<u4").tolist() == [*ids_of(texts[r.doc_id]), 0]
    size = sum(p.stat().st_size for p in (tmp_path / "tokens").glob("part-*"))
    assert size < 2.6 * sum(len(r.ids) // 4 for r in pieces)
    assert documents_of(read_pieces(spark, path)).count() == len(texts)


def test_query(spark, small, documents):
    got = REGISTRY["op12_token_files"](spark, small)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    rows = sorted((r.doc_id, r.text) for r in documents.collect())
    assert sorted(map(tuple, got.collect()), key=key) == list(slow(rows))
