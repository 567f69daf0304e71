import hashlib

import pytest
import regex
import tiktoken
from conftest import OWN, own_columns
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import PATTERN
from pyspark.sql import functions as F

from tillview.llm.bpe import Coder, Merges, encode_texts, pairs_of, read_ranks
from tillview.llm.queries import BYTE_VOCABULARY, REGISTRY
from tillview.llm.shared import vocabulary

CONTENT = vocabulary(BYTE_VOCABULARY)
TOKENS = read_ranks(CONTENT)
MERGES = Merges(TOKENS, *pairs_of(TOKENS))
PUBLIC = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks={t: k for k, t in enumerate(TOKENS)}, special_tokens={})


def test_query_is_the_public_encoder(spark, small, documents):
    got = {r.doc_id: r for r in REGISTRY["op8_byte_bpe"](spark, small).collect()}
    rows = documents.collect()
    assert len(got) == len(rows)
    for row in rows:
        ids = PUBLIC.encode_ordinary(row.text)
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert tuple(got[row.doc_id])[1:] == (len(ids), digest, hashlib.sha256(row.text.encode()).hexdigest())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("aabbeth the  \n!'s1"), st.characters(codec="utf-8")), max_size=80), max_size=5))
def test_texts_are_encoded_as_the_public_encoder_does(texts):
    ids, cuts = encode_texts(MERGES, regex.compile(PATTERN), texts)
    assert [ids[a:b].tolist() for a, b in zip(cuts, cuts[1:], strict=False)] == [PUBLIC.encode_ordinary(t) for t in texts]


def test_edges(spark, edges, empty):
    coder = Coder(spark, CONTENT, PATTERN)
    coded = coder.encode(edges, decoded="piece")  # takes the place of a column of that name
    assert coded.columns == ["doc_id", "lang", "source", "score", "predicted", *OWN, "ids", "piece"] and own_columns(coded)
    back = coded.select("doc_id", "ids", "piece", coder.decode(F.col("ids")).alias("again")).collect()
    texts = sorted((r.text or "").encode() for r in edges.collect())
    assert sorted(bytes(r.piece) for r in back) == texts and sorted(bytes(r.again) for r in back) == texts
    assert {len(r.ids) for r in back if r.doc_id in (1, 2)} == {0}
    assert coder.encode(empty).count() == 0


@pytest.mark.parametrize("chars", [1, 50])
def test_blocks_do_not_matter(spark, edges, monkeypatch, chars):
    from tillview.llm import bpe

    whole = sorted(map(str, Coder(spark, CONTENT, PATTERN).encode(edges).collect()))
    monkeypatch.setattr(bpe, "BLOCK_CHARS", chars)
    assert sorted(map(str, Coder(spark, CONTENT, PATTERN).encode(edges).collect())) == whole
