"""Byte-level BPE by merge replay over the words of a corpus block.

Texts are cut into words by the tokenizer's pattern. The distinct words of a block
of texts are laid end to end, an inverted index leads from each merge to the
positions where its pair stands, and the merges are applied in rank order to all
their positions at once; after each, only the pairs that touch a merged position
are entered anew. A text's ids are those of its words.

Null and empty texts have no ids. Bytes and ids round-trip exactly. Repeated rows are
encoded each. A text longer than a block is a block of its own. Columns named like the
results are replaced, others come through. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

#: Characters of text whose words are replayed together, about; a longer text is a block of its own.
BLOCK_CHARS = 4_000_000
EDGE, GONE = -1, -2


def read_ranks(content: bytes) -> list[bytes]:
    """Tokens by rank, from lines of base64 and rank."""
    ranks = {int(b): base64.b64decode(a) for a, b in map(bytes.split, content.splitlines()) if a}
    return [ranks[k] for k in range(len(ranks))]


def pairs_of(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Every pair of tokens that make a token: sorted keys and the tokens made."""
    rank = {t: k for k, t in enumerate(tokens)}
    found = sorted(
        (rank[t[:i]] * len(tokens) + rank[t[i:]], k)
        for k, t in enumerate(tokens)
        for i in range(1, len(t))
        if t[:i] in rank and t[i:] in rank
    )
    return np.array([f[0] for f in found], np.int64), np.array([f[1] for f in found], np.int64)


class Merges:
    """Merge replay with given tokens and pairs."""

    def __init__(self, tokens: list[bytes], keys: np.ndarray, made: np.ndarray) -> None:
        self.tokens, self.keys, self.made = tokens, keys, made
        self.rank = {t: k for k, t in enumerate(tokens)}
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.single = np.array([self.rank.get(bytes([b]), EDGE) for b in range(256)], np.int64)

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The token that each pair makes, or -1."""
        key = a * len(self.tokens) + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((a >= 0) & (b >= 0) & (self.keys[at] == key), self.made[at], -1)

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words end to end, and the offsets of the words in them."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"\0".join([*words, b""]), np.uint8)  # a byte after each word, for its edge
        edges = np.cumsum(lengths + 1) - 1
        symbol = self.single[data]
        symbol[edges] = EDGE
        symbol = np.append(symbol, EDGE)
        size = np.ones(len(symbol), np.int64)
        before = np.arange(-1, len(symbol) - 1)  # where the symbol that ends here begins
        index: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def enter(at: np.ndarray, merge: np.ndarray) -> None:
            at, merge = at[merge >= 0], merge[merge >= 0]
            if not len(at):
                return
            order = np.argsort(merge, kind="stable")
            at, merge = at[order], merge[order]
            cuts = np.flatnonzero(np.diff(merge)) + 1
            for rank, part in zip(merge[np.append(0, cuts)].tolist(), np.split(at, cuts) if len(cuts) else [at], strict=True):
                if rank in index:
                    index[rank].append(part)
                else:
                    index[rank] = [part]
                    heapq.heappush(queue, rank)

        enter(np.arange(len(symbol) - 1), self.merged(symbol[:-1], symbol[1:]))
        while queue:
            rank = heapq.heappop(queue)
            parts = index.pop(rank)
            at = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
            at = at[symbol[at] >= 0]
            right = at + size[at]
            # the pair still stands there if its two symbols are as long as the token
            stands = (symbol[right] >= 0) & (size[at] + size[right] == self.sizes[rank])
            at, right = at[stands], right[stands]
            if len(at) > 1 and (chained := right[:-1] == at[1:]).any():
                place = np.arange(len(at))
                begin = np.maximum.accumulate(np.where(np.append(True, ~chained), place, 0))
                first = (place - begin) % 2 == 0
                at, right = at[first], right[first]
            if not len(at):
                continue
            symbol[at], symbol[right] = rank, GONE
            size[at] = self.sizes[rank]
            after = at + size[at]
            before[after] = at
            left = before[at]
            right_merge = self.merged(symbol[at], symbol[after])
            left_symbol = np.where(left >= 0, symbol[left], EDGE)
            left_merge = self.merged(left_symbol, symbol[at])
            enter(np.concatenate([left, at]), np.concatenate([left_merge, right_merge]))
        ids = np.flatnonzero(symbol >= 0)
        cuts = np.searchsorted(ids, np.append(0, edges + 1))
        ids = symbol[ids]
        return ids, cuts

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """As ``replay``, but words that are tokens are those, as in the public encoder."""
        known = np.fromiter((self.rank.get(w, -1) for w in words), np.int64, len(words))
        ids, cuts = self.replay([w if k < 0 else b"" for w, k in zip(words, known.tolist(), strict=True)])
        lengths = np.where(known >= 0, 1, np.diff(cuts))
        offsets = np.append(0, np.cumsum(lengths))
        out = np.zeros(offsets[-1], np.int64)
        out[offsets[:-1][known >= 0]] = known[known >= 0]
        filled = np.zeros(len(out), bool)
        filled[offsets[:-1][known >= 0]] = True
        out[~filled] = ids
        return out, offsets


def encode_texts(merges: Merges, pattern, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts end to end, and the offsets of the texts in them."""
    words: dict[str, int] = {}
    which, counts = [], []
    for text in texts:
        found = pattern.findall(text)
        counts.append(len(found))
        which.append(np.fromiter((words.setdefault(w, len(words)) for w in found), np.int32, len(found)))
    ids, offsets = merges.encode_words([w.encode() for w in words])
    ids = ids.astype(np.int32)
    used = np.concatenate(which) if which else np.zeros(0, np.int32)
    lengths = np.diff(offsets)[used]
    ends = np.append(0, np.cumsum(lengths))
    flat = np.repeat(offsets[:-1][used] - ends[:-1], lengths) + np.arange(ends[-1])
    return ids[flat], ends[np.append(0, np.cumsum(counts, dtype=np.int64))]


def decode(tokens: list[bytes], ids: np.ndarray) -> bytes:
    return b"".join(map(tokens.__getitem__, ids.tolist()))


class Coder:
    """Encoding and decoding with one vocabulary, whose content (a few MB) bounds what is
    broadcast."""

    def __init__(self, spark: SparkSession, ranks: bytes, pattern: str) -> None:
        tokens = read_ranks(ranks)
        self.shared = spark.sparkContext.broadcast((tokens, *pairs_of(tokens)))
        self.pattern = pattern

    def encode(self, docs: DataFrame, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
        """The columns of ``docs``, but for the text, and the ids of each whole text; with
        ``decoded`` also a column of that name with the bytes that the ids decode to."""
        shared, pattern = self.shared, self.pattern
        kept = [c for c in docs.columns if c not in (text, ids, decoded)]
        base = docs.select(*kept, F.col(text).cast("string").alias(text))
        schema = StructType([*(base.schema[c] for c in kept), StructField(ids, ArrayType(IntegerType()))])
        if decoded:
            schema = schema.add(decoded, BinaryType())

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import regex

            merges, words = Merges(*shared.value), regex.compile(pattern)
            for batch in batches:
                texts, first, chars = batch.column(len(kept)), 0, 0
                for k in range(len(texts)):
                    chars += len(texts[k].as_py() or "")
                    if chars >= BLOCK_CHARS or k == len(texts) - 1:
                        part = batch.slice(first, k + 1 - first)
                        found, cuts = encode_texts(merges, words, [x or "" for x in part.column(len(kept)).to_pylist()])
                        out = [*part.columns[: len(kept)], pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(found))]
                        if decoded:
                            out.append(pa.array([decode(merges.tokens, found[a:b]) for a, b in pairwise(cuts.tolist())], pa.binary()))
                        yield pa.RecordBatch.from_arrays(out, schema.names)
                        first, chars = k + 1, 0

        return base.mapInArrow(work, schema)

    def decode(self, ids: Column) -> Column:
        """The bytes of each list of ids (null: empty)."""
        shared = self.shared

        @arrow_udf(BinaryType())
        def bytes_of(lists: pa.Array) -> pa.Array:
            tokens = shared.value[0]
            return pa.array([decode(tokens, x.values.to_numpy() if x.is_valid else np.zeros(0, np.int32)) for x in lists], pa.binary())

        return bytes_of(ids)
