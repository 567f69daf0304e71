"""Packing of tokenised documents into sequences: bounded-space online best-fit.

Documents become token ids and a closing id; longer ones than a sequence are cut.
Pieces are dealt to tasks of about ``TASK_PIECES`` pieces and placed one by one, in the
order of a hash: into the open bin with the least free space that holds the piece, else into a
new bin. ``OPEN_BINS`` bins are open at a time; where one more is needed the fullest is
closed. Open bins are found through a bit set keyed by free space.

Null and empty texts have the closing id alone; a text of any length is cut into as many
pieces as it needs. Rows of one id, and repeated rows, are packed each. Null ids are
packed like others. Which of equally full bins takes a piece does not matter. An empty
table gives no pieces. Other columns take no part, whatever their names.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from string import punctuation
from unicodedata import normalize

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillview.llm.shared import once, stage

CAPACITY = 2048
OPEN_BINS = 256
TASK_PIECES = 100_000
#: Distinct words whose ids a worker remembers, in each of two generations.
WORDS = 300_000
#: Characters of texts whose new words are learnt together.
TOGETHER = 1_000_000
#: Words that are encoded together, and how the tokens that close a word end.
BATCH, WORD_END = 10_000, "</w>"


class Ids:
    """Token ids of texts as little-endian 32-bit bytes.

    The tokenizer folds case, drops white space and never joins across it, nor a
    letter or digit with the punctuation behind it; so a text's ids are those of its
    words between blanks and line feeds, without and then with what they end on, and
    each is encoded once. Words of letters alone have one closing token each, so they
    are encoded as one text and cut behind those.
    """

    def __init__(self, tokenizer: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the threads here
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer.decode())
        self.tokenizer.model._resize_cache(0)  # words come once
        self.known: dict[str, bytes] = {"": b""}
        self.before: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.closing = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closing[[k for token, k in vocabulary.items() if token.endswith(WORD_END)]] = True

    def _learn_letters(self, words: list[str]) -> list[str]:
        """Words of letters alone; returns those it could not tell apart."""
        (found,) = self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)  # without offsets
        ids = np.array(found.ids, "<u4")
        ends = np.flatnonzero(self.closing[ids]) + 1
        if len(ends) != len(words):
            return words
        whole, cuts = ids.tobytes(), [0, *(4 * ends).tolist()]
        self.known.update(zip(words, (whole[a:b] for a, b in zip(cuts, cuts[1:], strict=False)), strict=True))
        return []

    def _learn(self, words: set[str]) -> None:
        letters = [w for w in words if w.isalpha() and (w.isascii() or normalize("NFC", w.lower()).isalpha())]
        rest = list(words.difference(letters))
        for first in range(0, len(letters), BATCH):
            rest += self._learn_letters(letters[first : first + BATCH])
        for first in range(0, len(rest), BATCH):
            part = rest[first : first + BATCH]
            for word, found in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                self.known[word] = struct.pack(f"<{len(found.ids)}I", *found.ids)

    def _learn_all(self, words: set[str]) -> None:
        new = words.difference(self.known)
        if len(self.known) + 2 * len(new) > WORDS:
            self.before, self.known = self.known, {"": b""}
            new = words - {""}
        old = {w: self.before[w] for w in new if w in self.before}
        self.known.update(old)
        new.difference_update(old)
        ended = [(w, stem) for w in new if len(stem := w.rstrip(punctuation)) < len(w) and stem[-1:].lower()[-1:].isalnum() and "<|" not in w]
        new.difference_update([w for w, _ in ended])
        new.update({x for w, stem in ended for x in (stem, w[len(stem) :])}.difference(self.known))
        self._learn(new)
        for word, stem in ended:
            self.known[word] = self.known[stem] + self.known[word[len(stem) :]]

    def __call__(self, texts: list[str]) -> list[bytes]:
        # A-Z are lowered, unless there may be a special token, which is matched as it stands
        lowered = [t if "<|" in t else t.encode().lower().decode() for t in texts]
        words = [t.replace("\n", " ").split(" ") for t in lowered]
        self._learn_all(set().union(*words))
        return [b"".join(map(self.known.__getitem__, w)) for w in words]


def together(texts: list[str], chars: int) -> Iterator[list[str]]:
    """The texts in order, some at a time: about ``chars`` characters, or one longer text."""
    held, size = [], 0
    for text in texts:
        if held and size + len(text) > chars:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


class Bins:
    """Open bins; ``place`` gives a piece's bin number and offset."""

    def __init__(self, capacity: int, limit: int) -> None:
        self.capacity, self.limit = capacity, limit
        self.free, self.by_free = 0, [[] for _ in range(capacity + 1)]  # bit f: some open bin has f free
        self.open = self.made = self.closed = 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        taken = bins.pop()
        if not bins:
            self.free &= ~(1 << free)
        self.open -= 1
        return taken

    def place(self, length: int) -> tuple[int, int]:
        fitting = self.free >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            at = self._take(free)
        else:
            if length < self.capacity and self.open >= self.limit:
                self._take((self.free & -self.free).bit_length() - 1)
                self.closed += 1
            free, at = self.capacity, self.made
            self.made += 1
        left = free - length
        if left:
            self.by_free[left].append(at)
            self.free |= 1 << left
            self.open += 1
        return at, self.capacity - free


def pieces(docs: DataFrame, tokenizer: bytes, capacity: int = CAPACITY, end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """Rows of ``docs`` (doc_id, text) as pieces of at most ``capacity`` ids. ``tokenizer``
    is the content of a tokenizer file, whose size bounds what is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast({"content": tokenizer})
    out = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if keep_ids else "")
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = once(shared.value, Ids)
        for batch in batches:
            rows = []
            texts = [t or "" for t in batch.column(1).to_pylist()]
            encoded = (found for part in together(texts, TOGETHER) for found in ids(part))
            for doc_id, found in zip(batch.column(0).to_pylist(), encoded, strict=True):
                whole = found + end
                for k, at in enumerate(range(0, len(whole), 4 * capacity)):
                    part = whole[at : at + 4 * capacity]
                    rows.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part), *([part] if keep_ids else [])))
            columns = [list(c) for c in zip(*rows, strict=True)] or [[] for _ in range(6)]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][: 6 if keep_ids else 5]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=False)], names[: len(kinds)])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, out)


def pack(docs: DataFrame, tokenizer: bytes, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; with ``keep_ids`` also their ids as
    little-endian 32-bit bytes. Runs jobs: the pieces are written to the shared folder."""
    cut = stage(pieces(docs, tokenizer, capacity, end_id, keep_ids), "pieces")
    tasks = 1 + cut.count() // TASK_PIECES
    # a fixed arrival order, so that a task that runs again gives the same places
    order = [F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("doc_id"), F.col("piece")]
    dealt = cut.repartition(tasks).sortWithinPartitions(*order)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, base = Bins(capacity, open_bins), TaskContext.get().partitionId() << 33
        for batch in batches:
            found = [bins.place(n) for n in batch.column("length").to_pylist()]
            added = [pa.array([base + f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, "sequence_id", "offset"])

    schema = ", ".join(f"{n} {t}" for n, t in cut.dtypes)
    return dealt.mapInArrow(place, f"{schema}, sequence_id long, offset long")
