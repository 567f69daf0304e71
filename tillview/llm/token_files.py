"""Token files: documents as ids in frames of Simple-8b words, written and read by Spark.

Documents are spread and ordered by ``doc_id`` (a range shuffle; equal ids too are spread),
encoded, and packed into frames of about ``FRAME_IDS`` ids (``simple8b.py`` has the
format). The files are written by Spark's text sink, a frame a line: its rows are bytes,
and it commits whole tasks only, on any file system that Spark writes to. They are read
as binary files. Part and number of the frames give the order of documents; where a
document starts among all ids is summed up from the frames.

The texts' ids are those of their words, each encoded once per Python worker. Texts of ASCII and
Latin letters are cut into the tokenizer's own words by their bytes, many texts at once. Others
are cut before blanks that follow something else than white space, across which it never joins.

Null and empty texts have the end id alone. Null doc_ids come first, rows of one doc_id
follow each other by a hash of their text, repeated rows are written each. Texts beyond a
million characters are encoded in parts, and a document beyond a frame goes on in the next
ones, so memory stays bounded. An empty table gives files without frames, which read as no
rows. Other columns take no part, whatever their names.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator, Sequence
from itertools import batched, chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import LongType

from tillview.llm.shared import once, stage
from tillview.llm.simple8b import NULL_ID, PIECE, Frame, crc32_joined, frames
from tillview.sources.staging import staging_path

FRAME_IDS = 1 << 20
FILE_FRAMES = 8
#: Distinct words that a worker remembers (two generations of them), and words encoded together.
WORDS, BATCH = 600_000, 10_000
#: Characters that are encoded at once.
WINDOW = 1_000_000
#: Characters of texts whose new words are learnt together.
TOGETHER = 1_000_000
BORDER = re.compile(r"(?<=\S)(?= )")
CUT = re.compile(r"\S(?= )")
#: Letters below this are the same to Python and to the tokenizer, whatever Unicode version they know.
OLD_LETTERS = "\u0240"
#: What may make a text's words other than by bytes: all but ASCII's signs and white space and these letters.
UNSURE = re.compile(r"[^\t-\r -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u023f]")
SPACE, LETTER, DIGIT, SIGN = range(4)
#: The kind of each byte of a text without those; letters beyond ASCII have bytes from 128 only.
KINDS = np.array([SPACE if 9 <= k <= 13 or k == 32 else DIGIT if 48 <= k <= 57 else LETTER if k >= 128 or chr(k).isalpha() else SIGN for k in range(256)], np.uint8)


class ByteIds:
    """Ids of texts, as little-endian 32-bit bytes, by a byte-level BPE tokenizer's file."""

    def __init__(self, tokenizer: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the threads here
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer.decode())
        self.model = self.tokenizer.model
        self.model._resize_cache(0)  # words come once
        shown = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.letters = {k: shown(chr(k))[0][0] for k in range(ord(OLD_LETTERS))}  # as the vocabulary writes them
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # words, with their ids when encoded alone
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def _learn_words(self, words: Sequence[str]) -> None:
        """Words as the tokenizer cuts them: its model gets them as they are, without the search for
        words in a text."""
        tokenize, blank, letters = self.model.tokenize, self.letters[ord(" ")], self.letters
        ids: list[int] = []
        ends = [0]
        for word in words:
            shown = word.replace(" ", blank) if word.isascii() and word.isprintable() else word.translate(letters)
            ids += [token.id for token in tokenize(shown)]
            ends.append(4 * len(ids))
        whole = np.array(ids, "<u4").tobytes()
        self.known.update(zip(words, (whole[a:b] for a, b in pairwise(ends)), strict=True))

    def _learn_pieces(self, pieces: Sequence[str]) -> None:
        """Pieces of texts that may hold more than a word."""
        for piece, found in zip(pieces, self.tokenizer.encode_batch_fast(list(pieces), add_special_tokens=False), strict=True):
            self.known[piece] = np.array(found.ids, "<u4").tobytes()

    def _learn(self, words: set[str], learn: Callable[[Sequence[str]], None]) -> None:
        if len(self.known) + len(words) > WORDS:
            self.before, self.known = self.known, {}
        new = words.difference(self.known)
        old = new.intersection(self.before)
        self.known.update((word, self.before[word]) for word in old)
        for part in batched(new - old, BATCH):
            learn(part)

    def _of_sure(self, texts: list[str]) -> list[bytes]:
        """The ids of texts that ``UNSURE`` is not found in."""
        codes, distinct, stops = words_of(texts)
        self._learn(set(distinct), self._learn_words)
        own = list(map(self.known.__getitem__, distinct))
        flat = np.frombuffer(b"".join(own), "<u4")
        sizes = np.fromiter(map(len, own), np.int32, len(own)) // 4
        lengths = sizes[codes]
        ends = np.cumsum(lengths)
        shifts = (np.cumsum(sizes) - sizes)[codes] - ends + lengths
        ids = flat[np.repeat(shifts, lengths) + np.arange(lengths.sum())]
        borders = np.append(0, ends)[stops].tolist()
        return [ids[a:b].tobytes() for a, b in pairwise(borders)]

    def __call__(self, texts: list[str]) -> list[bytes]:
        sure = [k for k, t in enumerate(texts) if not UNSURE.search(t) and not any(c in t for c in self.added)]
        found = dict(zip(sure, self._of_sure([texts[k] for k in sure]), strict=True))
        others = [k for k in range(len(texts)) if k not in found]
        pieces = [BORDER.split(texts[k]) for k in others]
        self._learn(set().union(*pieces), self._learn_pieces)
        found.update((k, b"".join(map(self.known.__getitem__, own))) for k, own in zip(others, pieces, strict=True))
        return [found[k] for k in range(len(texts))]


def words_of(texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray]:
    """The words that a byte-level tokenizer cuts texts into that ``UNSURE`` is not found in: for each word
    its number among the distinct ones, these, and how many words there are before each text and after
    the last.

    A word is a run of letters, of digits or of other signs, with one blank before it; or a short form
    behind an apostrophe; or white space, whose last character goes its own way before a word."""
    coded = [t.encode() for t in texts]
    data = b"".join(coded)
    letters = np.frombuffer(data, np.uint8)
    borders = np.cumsum([0, *map(len, coded)])
    kinds = KINDS[letters]
    space = kinds == SPACE
    new = np.ones(len(letters) + 1, bool)
    new[1:-1] = (kinds[1:] != kinds[:-1]) & (letters[:-1] != ord(" "))  # a blank's follower is no start
    new[:-1] |= space
    inner = np.zeros(len(letters) + 1, bool)
    inner[1:-1] = space[1:] & space[:-1]
    inner[borders] = False
    before_word = np.zeros(len(letters) + 1, bool)
    before_word[:-2] = ~space[1:]
    before_word[borders[1:] - 1] = False
    new &= ~inner | before_word
    new[borders] = True
    quotes = np.flatnonzero(new[:-1] & (letters == ord("'")))
    if len(quotes):
        left = borders[np.searchsorted(borders, quotes, "right")] - quotes
        for k, forms in ((2, (b"s", b"t", b"m", b"d")), (3, (b"re", b"ve", b"ll"))):
            here = quotes[left >= k]
            short = here[[data[q + 1 : q + k] in forms for q in here.tolist()]] if len(here) else here
            new[short + 1] = False
            new[short + k] = True
    offsets = np.flatnonzero(new).astype(np.int32)
    words = pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()
    return words.indices.to_numpy(), words.dictionary.to_numpy(zero_copy_only=False).tolist(), np.searchsorted(offsets, borders)


def windows(text: str, size: int = WINDOW) -> Iterator[str]:
    """A text in parts that are encoded like the whole, cut before blanks behind something else."""
    begin = 0
    while len(text) - begin > size and (border := CUT.search(text, begin + size)):
        yield text[begin : border.end()]
        begin = border.end()
    yield text[begin:]


def encoded(ids: ByteIds, rows: Iterator[tuple[int | None, str]]) -> Iterator[tuple[int | None, Iterator[bytes]]]:
    """Of rows (doc_id, text) each doc_id with the ids of its text, in parts if it is long. Short
    texts are encoded some together."""
    held: list[tuple[int | None, str]] = []
    chars = 0
    for doc_id, text in rows:
        if chars + len(text) > TOGETHER:
            yield from zip([h[0] for h in held], ([x] for x in ids([h[1] for h in held])), strict=True)
            held, chars = [], 0
        if len(text) > WINDOW:
            yield doc_id, (ids([part])[0] for part in windows(text))
        else:
            held.append((doc_id, text))
            chars += len(text)
    yield from zip([h[0] for h in held], ([x] for x in ids([h[1] for h in held])), strict=True)


class FrameMaker:
    """Collects documents and gives out frames, as bytes, when they are full."""

    def __init__(self, part: int, frame_ids: int) -> None:
        self.part, self.size, self.number, self.place = part, frame_ids, 0, -1
        self._clear()

    def _clear(self) -> None:
        self.rows: list[list[int]] = []
        self.ids: list[bytes] = []
        self.held = 0

    def flush(self) -> Iterator[bytes]:
        if self.rows:
            columns = map(list, zip(*self.rows, strict=True))
            yield Frame(*columns, np.frombuffer(b"".join(self.ids), "<u4"), self.part, self.number).to_bytes()
            self.number += 1
            self._clear()

    def add(self, doc_id: int | None, parts: Iterator[bytes]) -> Iterator[bytes]:
        """A document whose ids come in ``parts``."""
        self.place += 1
        row = [doc_id or 0, self.place, 0, 0, NULL_ID if doc_id is None else 0]
        self.rows.append(row)
        for part in parts:
            while part:
                if self.held >= self.size:
                    if row[3]:  # the document goes on in the next frame
                        row[4] |= PIECE
                        row = [row[0], row[1], row[2] + 1, 0, row[4]]
                    else:
                        self.rows.pop()
                    yield from self.flush()
                    self.rows.append(row)
                now, part = part[: 4 * (self.size - self.held)], part[4 * (self.size - self.held) :]
                self.ids.append(now)
                self.held += len(now) // 4
                row[3] += len(now) // 4


def write_tokens(docs: DataFrame, tokenizer: bytes, path: str, end_id: int = 0, frame_ids: int = FRAME_IDS) -> None:
    """Write ``docs`` (doc_id, text) to token files in the new folder ``path``, in ascending order
    of doc_id, ``end_id`` behind each document. ``tokenizer`` is the content of a tokenizer
    file, whose size bounds what is broadcast. A job."""
    shared = docs.sparkSession.sparkContext.broadcast({"content": tokenizer})
    end = end_id.to_bytes(4, "little")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, maker = once(shared.value, ByteIds), FrameMaker(TaskContext.get().partitionId(), frame_ids)

        def rows() -> Iterator[tuple[int | None, str]]:
            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    yield doc_id, text.as_py() or ""

        def found() -> Iterator[bytes]:
            for doc_id, parts in encoded(ids, rows()):
                yield from maker.add(doc_id, chain(parts, [end]))
            yield from maker.flush()

        for frame in found():
            yield pa.RecordBatch.from_arrays([pa.array([frame], pa.binary())], ["frame"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tied = rows.withColumns({"by": F.xxhash64("text"), "tie": F.monotonically_increasing_id()})
    order = [F.col("doc_id").asc_nulls_first(), F.col("by"), F.col("tie")]
    ordered = tied.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    packed = ordered.mapInArrow(pack, "frame binary")
    packed.select(F.col("frame").cast("string")).write.option("maxRecordsPerFile", FILE_FRAMES).text(path)


PIECES = "doc_id long, part long, number long, place long, piece long, pieces boolean, first long, length long, ids_crc32 long"


def read_pieces(spark: SparkSession, path: str, keep_ids: bool = False) -> DataFrame:
    """Every piece of a document in the files of ``path``: where it lies, its ids' CRC-32 and,
    with ``keep_ids``, the ids as little-endian 32-bit bytes."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                for frame in frames(content.as_buffer().to_pybytes()):
                    ids = frame.ids().astype("<u4")
                    ends = np.cumsum(frame.lengths)
                    firsts = ends - frame.lengths
                    each = [ids[a:b].tobytes() for a, b in zip(firsts.tolist(), ends.tolist(), strict=True)]
                    n = len(each)
                    columns = [
                        pa.array(frame.doc_ids, pa.int64(), mask=frame.flags & NULL_ID > 0),
                        pa.array([frame.part] * n, pa.int64()),
                        pa.array([frame.number] * n, pa.int64()),
                        *(pa.array(c, pa.int64()) for c in (frame.places, frame.pieces)),
                        pa.array(frame.flags & PIECE > 0),
                        *(pa.array(c, pa.int64()) for c in (firsts, frame.lengths)),
                        pa.array([zlib.crc32(x) for x in each], pa.int64()),
                        *([pa.array(each, pa.binary())] if keep_ids else []),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, [*(c.split()[0] for c in PIECES.split(", ")), *(["ids"] if keep_ids else [])])

    files = spark.read.format("binaryFile").load(path).where("length > 0").select("content")
    return files.mapInArrow(unpack, PIECES + (", ids binary" if keep_ids else ""))


@arrow_udf(LongType())
def _joined_crc32(pieces: pa.Array) -> pa.Array:
    """Of lists of (piece, ids_crc32, length) in order."""
    out = []
    for listed in pieces.to_pylist():
        crc = 0
        for p in listed:
            crc = crc32_joined(crc, p["ids_crc32"], 4 * p["length"])
        out.append(crc)
    return pa.array(out, pa.int64())


def documents_of(pieces: DataFrame) -> DataFrame:
    """From ``read_pieces``: doc_id, start (ids of all documents before it), n_tokens and
    ids_crc32 of every document. Only pieces of documents beyond a frame meet. Runs a job."""
    found = stage(pieces.select(*(c.split()[0] for c in PIECES.split(", "))), "pieces")
    sizes = found.groupBy("part", "number").agg(F.sum("length").alias("n"))
    parts = found.groupBy("part").agg(F.sum("length").alias("n"))  # as many as tasks have written
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.sum("n").over(Window.partitionBy("part").orderBy("number")) - F.col("n")
    shifts = sizes.withColumn("inside", inside).join(before, "part").select("part", "number", (F.col("before") + F.col("inside")).alias("shift"))
    placed = found.join(shifts, ["part", "number"]).withColumn("start", F.col("shift") + F.col("first"))
    whole = placed.where("not pieces").select("doc_id", "start", F.col("length").alias("n_tokens"), "ids_crc32")
    listed = F.array_sort(F.collect_list(F.struct("piece", "ids_crc32", "length")))
    long = placed.where("pieces").groupBy("part", "place").agg(F.first("doc_id").alias("doc_id"), F.min("start").alias("start"), F.sum("length").alias("n_tokens"), listed.alias("listed"))
    return whole.union(long.select("doc_id", "start", "n_tokens", _joined_crc32("listed")))


def through_files(docs: DataFrame, tokenizer: bytes, end_id: int = 0, frame_ids: int = FRAME_IDS) -> DataFrame:
    """``documents_of`` the files that ``docs`` are written to, in the cluster's shared folder. Runs jobs."""
    path = staging_path(docs.sparkSession, "tokens")
    write_tokens(docs, tokenizer, path, end_id, frame_ids)
    return documents_of(read_pieces(docs.sparkSession, path))
