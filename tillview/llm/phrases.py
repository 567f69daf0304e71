"""Phrase collocations by Toivonen's algorithm: mined on a sample, counted exactly on all.

A sample of the documents proposes words and phrases, at a lowered threshold. A full pass
counts exactly what is proposed and its negative border: everything that occurs, is not
proposed, and has only proposed parts (all words; phrases whose first and last words but
one are proposed). Where something of the border turns out frequent, phrases made from it
may be, so a further pass proposes all that is known to be frequent and counts what no pass
before has counted; no pass is needed once nothing frequent is missing from the proposal.
The counts of frequent phrases are exact whatever the sample holds; a worse sample only
costs a pass more, and there are never more full passes than words in the longest phrase.

A proposal travels as a Bloom filter of at most ``FILTER_BITS`` bits, made by Spark and
broadcast. It knows all that is proposed; what it admits wrongly is counted too, which
changes no result. Tasks count in numpy over the ids of their own words and send one row
per phrase and flush, so a phrase that is a third of all words is summed from few rows.

A-Z are lowered; pieces end at ``[.,;:!?\\x0A-\\x0D]``, words are ``[^\\x20\\x09]+`` in a piece.
Null texts are empty, a null ``lang`` counts as ``und``; texts of any length are counted
whole, some at a time. Repeated rows count each. Ties of cuts go to the shortest first
part, of ranks to the higher count, then the smaller phrase. Null ids, other columns and
their names make no difference. An empty table has no phrases.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillview.llm.shared import stage

MIN_COUNT, LONGEST, SHARE, TOP = 10, 3, 50, 2000
#: One document in so many is in the sample.
ONE_IN = 8
#: Bits of a filter for each proposed phrase, and at the most; positions set for each.
BITS_EACH, FILTER_BITS, PROBES = 16, 1 << 27, 4
#: Words that a task counts together, distinct words it holds, bytes that are cut at once, rows of a batch it sends.
FLUSH_WORDS, VOCABULARY, WINDOW, SENT_ROWS = 3_000_000, 700_000, 1 << 20, 100_000
UNKNOWN = "und"

BREAK = b"\xff"  # stands in no UTF-8 text
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_LOWER = bytes.maketrans(bytes(range(65, 91)) + b"\t" + _BREAKS, bytes(range(97, 123)) + b" " + BREAK * len(_BREAKS))
_BORDER = re.compile(rb"[ \xff]")


def words_of(text: str, window: int = WINDOW) -> Iterator[list[bytes]]:
    """A text's words and breaks, some at a time."""
    data = text.encode().translate(_LOWER)
    begin = 0
    while begin < len(data):
        border = _BORDER.search(data, begin + window)
        end = border.end() if border else len(data)
        yield data[begin:end].replace(BREAK, b" \xff ").split()
        begin = end


# -- hashes and filters ----------------------------------------------------


def lang_seed(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode())


def followed(phrase: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of phrases with one more word, from those of the phrases and of the words."""
    mixed = phrase * np.uint64(0x9E3779B97F4A7C15) + word
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    return mixed ^ (mixed >> np.uint64(29))


def probes(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    """The positions of each hash in a filter of ``bits``, a power of two."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return [((hashes + np.uint64(k) * step) & np.uint64(bits - 1)).astype(np.int64) for k in range(PROBES)]


def admitted(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes a filter, as 64-bit words, may hold."""
    out = np.ones(len(hashes), bool)
    for at in probes(hashes, 64 * len(words)):
        out &= (words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) > 0
    return out


def phrase_hashes(langs: list[str], phrases: list[str]) -> np.ndarray:
    words = [p.encode().split(b" ") for p in phrases]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    seeds = {lang: lang_seed(lang) for lang in set(langs)}
    flat = np.fromiter((xxhash.xxh64_intdigest(w, seeds[g]) for g, p in zip(langs, words, strict=True) for w in p), np.uint64, int(sizes.sum()))
    first = np.cumsum(sizes) - sizes
    out = flat[first]
    for k in range(1, int(sizes.max(initial=0))):
        more = sizes > k
        out[more] = followed(out[more], flat[first[more] + k])
    return out


def filter_of(phrases: DataFrame, rows: int) -> np.ndarray:
    """A filter that holds all (lang, phrase), ``rows`` of them. Tasks send the 64-bit words they
    set; as many as the filter has, at the most, reach the driver. A job."""
    bits = min(FILTER_BITS, 1 << max(10, (BITS_EACH * rows - 1).bit_length()))

    def set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = phrase_hashes(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            at = np.unique(np.concatenate(probes(hashes, bits)))
            slots, first = np.unique(at >> 6, return_index=True)
            values = np.bitwise_or.reduceat(np.uint64(1) << (at & 63).astype(np.uint64), first) if len(at) else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int64()), pa.array(values.view(np.int64))], ["slot", "bits"])

    found = phrases.select("lang", "phrase").mapInArrow(set_bits, "slot long, bits long")
    held = found.groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[held["slot"].to_numpy()] = held["bits"].to_numpy().view(np.uint64)
    return out


# -- counting inside a task -----------------------------------------------


class _Vocabulary(dict):
    """Ids of one language's words; new words get the next id of all languages."""

    def __init__(self, counter: Counter, lang: str) -> None:
        super().__init__({BREAK: 0})
        self.counter, self.lang, self.seed = counter, lang, lang_seed(lang)

    def __missing__(self, word: bytes) -> int:
        self[word] = new = len(self.counter.words)
        self.counter.words.append(word)
        self.counter.langs.append(self.lang)
        self.counter.hashes.append(xxhash.xxh64_intdigest(word, self.seed))
        return new


class Counter:
    """Counts phrases of up to ``longest`` words that the last of ``filters`` admits and none before
    does; words only in the first pass. Without filters all phrases are counted."""

    def __init__(self, longest: int, filters: list[np.ndarray], flush_words: int = FLUSH_WORDS) -> None:
        self.longest, self.filters, self.flush_words = longest, filters, flush_words
        self.forget()
        self.buffer: list[np.ndarray] = []
        self.held = self.carried = 0

    def forget(self) -> None:
        self.words: list[bytes] = [BREAK]
        self.langs: list[str] = [""]
        self.hashes: list[int] = [0]
        self.by_lang: dict[str, _Vocabulary] = {}

    def add(self, lang: str, text: str) -> Iterator[pa.RecordBatch]:
        ids = self.by_lang.setdefault(lang, _Vocabulary(self, lang)).__getitem__
        for part in words_of(text):
            self._take(np.fromiter(map(ids, part), np.int32, len(part)))
            if self.held >= self.flush_words:
                yield from self.flush(within=True)
        self._take(np.zeros(1, np.int32))
        if self.held >= self.flush_words or len(self.words) >= VOCABULARY:
            yield from self.flush()

    def _take(self, ids: np.ndarray) -> None:
        self.buffer.append(ids)
        self.held += len(ids)

    def flush(self, within: bool = False) -> Iterator[pa.RecordBatch]:
        """Count what is held; ``within`` a text the last words also begin the next phrases."""
        held, carried = np.concatenate(self.buffer or [np.zeros(0, np.int32)]), self.carried
        tail = (held[len(held) - min(len(held), self.longest - 1) :] if within else held[:0]).copy()
        self.buffer, self.held, self.carried = [tail], len(tail), len(tail)
        yield from self.count(held, carried)
        if not within and len(self.words) >= VOCABULARY:
            self.forget()

    def count(self, w: np.ndarray, carried: int) -> Iterator[pa.RecordBatch]:
        """Phrases that end behind the first ``carried`` words."""
        size = len(self.words)
        if size == 1:
            return
        texts, langs = pa.array(self.words[1:], pa.binary()).cast(pa.string()), pa.array(self.langs[1:], pa.string())
        if len(self.filters) < 2:
            counts = np.bincount(w[carried:], minlength=size)[1:]
            seen = np.flatnonzero(counts)
            yield from _batches(langs, [texts], [seen], counts[seen])
            for lang, own in self.by_lang.items():
                ids = np.fromiter(own.values(), np.int64, len(own))
                words = int(counts[ids[ids > 0] - 1].sum())
                yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([0], pa.int32()), pa.array([""]), pa.array([words], pa.int64())], COUNTED)
        # which phrase that begins at each place each filter proposes; first words
        hashes = np.array(self.hashes, np.uint64)
        known = [admitted(f, hashes) for f in self.filters] or [np.ones(size, bool)]
        for one in known:
            one[0] = False
        proposed = [one[w] for one in known]
        word = hashes[w]
        phrase = word
        for length in range(2, self.longest + 1):
            counted = [p[:-1] & p[1:] for p in proposed]  # by the pass of each filter
            new = counted[-1].copy()
            for before in counted[:-1]:
                new &= ~before
            new[: max(0, carried - length + 1)] = False  # an earlier flush has counted these
            yield from self._counted(w, np.flatnonzero(new), length, langs, texts)
            if length < self.longest:
                phrase, proposed = followed(phrase[:-1], word[length - 1 :]), counted
                if self.filters:
                    proposed = [_among(c & counted[-1], f, phrase) for c, f in zip(counted, self.filters, strict=True)]

    def _counted(self, w: np.ndarray, at: np.ndarray, length: int, langs: pa.Array, texts: pa.Array) -> Iterator[pa.RecordBatch]:
        """The phrases that begin at ``at``, each with its count."""
        bits = len(self.words).bit_length()
        if bits * length < 63:
            keys = w[at].astype(np.int64)
            for k in range(1, length):
                keys <<= bits
                keys |= w[at + k]
            keys, n = np.unique(keys, return_counts=True)
            ids = [(keys >> (bits * (length - 1 - k))) & ((1 << bits) - 1) for k in range(length)]
        else:
            rows, n = np.unique(np.stack([w[at + k] for k in range(length)]), axis=1, return_counts=True)
            ids = list(rows)
        yield from _batches(langs, [texts] * length, [i - 1 for i in ids], n)


def _among(places: np.ndarray, bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The places whose hashes a filter may hold."""
    at = np.flatnonzero(places)
    out = np.zeros(len(places), bool)
    out[at] = admitted(bits, hashes[at])
    return out


COUNTED = ["lang", "size", "phrase", "n"]


def _batches(langs: pa.Array, texts: list[pa.Array], words: list[np.ndarray], n: np.ndarray) -> Iterator[pa.RecordBatch]:
    for first in range(0, len(n), SENT_ROWS):
        part = slice(first, first + SENT_ROWS)
        joined = pc.binary_join_element_wise(*(t.take(pa.array(w[part])) for t, w in zip(texts, words, strict=True)), " ")
        size = pa.array(np.full(len(joined), len(texts), np.int32))
        yield pa.RecordBatch.from_arrays([langs.take(pa.array(words[0][part])), size, joined, pa.array(n[part], pa.int64())], COUNTED)


# -- passes ------------------------------------------------------------------


@dataclass(frozen=True)
class Mined:
    """Frequent phrases (lang, size, phrase, n) of all sizes, rows of size 0 with the words of each
    lang, and the number of full passes."""

    frequent: DataFrame
    passes: int


def counted(docs: DataFrame, longest: int, least: int, filters: Broadcast | None = None, flush_words: int = FLUSH_WORDS) -> DataFrame:
    """One pass over ``docs`` (lang, text): phrases with their counts, from ``least`` up. A job."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(longest, filters.value if filters else [], flush_words)
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                yield from counter.add(lang, text.as_py())
        yield from counter.flush()

    rows = docs.mapInArrow(work, "lang string, size int, phrase string, n long")
    # a task's rows are summed already, so they go to the shuffle as they are
    summed = rows.repartition("lang", "size", "phrase").groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))
    return stage(summed.where((F.col("n") >= least) | (F.col("size") == 0)), "phrases")


def missing(frequent: DataFrame, filters: Broadcast, longest: int) -> int:
    """How many phrases that others can be made from the last proposal lacks. A job."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = phrase_hashes(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([int((~admitted(filters.value[-1], hashes)).sum())], pa.int64())], ["n"])

    parts = frequent.where(F.col("size").between(1, longest - 1)).select("lang", "phrase")
    return parts.mapInArrow(check, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def mine(docs: DataFrame, drawn: Column, min_count: int = MIN_COUNT, longest: int = LONGEST, one_in: int = ONE_IN, flush_words: int = FLUSH_WORDS) -> Mined:
    """All phrases of up to ``longest`` words that occur ``min_count`` times in their lang. ``drawn``
    marks the sample, about one row in ``one_in``. Runs jobs."""
    spark: SparkSession = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    sample = docs.where(drawn).select(*(F.coalesce(c, F.lit(d)).alias(c) for c, d in (("lang", UNKNOWN), ("text", ""))))
    proposal = counted(sample, max(1, longest - 1), max(2, min_count // (2 * one_in)), flush_words=flush_words).where("size > 0")
    filters: list[np.ndarray] = []
    mined = Mined(proposal.limit(0), 0)
    while True:
        filters.append(filter_of(proposal, proposal.count()))
        shared = spark.sparkContext.broadcast(filters)
        found = counted(texts, longest, min_count, shared, flush_words)
        mined = replace(mined, frequent=mined.frequent.union(found) if mined.passes else found, passes=mined.passes + 1)
        if mined.passes == longest or not missing(mined.frequent, shared, longest):
            return mined
        proposal = mined.frequent.where(F.col("size").between(1, longest - 1))


# -- scores ------------------------------------------------------------------


def collocations(docs: DataFrame, drawn: Column, min_count: int = MIN_COUNT, longest: int = LONGEST, share: int = SHARE, top: int = TOP) -> DataFrame:
    """Each lang's best phrases: lang, rank, phrase, a (count), l and r (counts of the parts at its
    weakest cut), n (words of the lang), score floor(10^6 a^2 / (l r)). Phrases that lie in a
    longer one with ``share`` percent of their count or more are left out. Runs jobs."""
    frequent = mine(docs, drawn, min_count, longest).frequent
    parts = frequent.where("size > 0").select("lang", "phrase", "n")
    candidates = frequent.where("size > 1").select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("words"))

    def run(first: Column, size: Column) -> Column:
        return F.array_join(F.slice("words", first, size), " ")

    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.withColumns({"first": run(F.lit(1), F.col("k")), "rest": run(F.col("k") + 1, F.size("words") - F.col("k"))})
    left = parts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    # decimals of 38 digits hold these products of counts below 10^16
    big = {c: F.col(c).cast("decimal(38,0)") for c in "alr"}
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    scored = scored.withColumn("score", F.call_function("div", F.lit(1_000_000).cast("decimal(38,0)") * big["a"] * big["a"], big["l"] * big["r"]))
    weakest = F.min(F.struct("score", "k", "l", "r"))
    scored = scored.groupBy("lang", "phrase", "a").agg(weakest.alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")

    sizes = F.sequence(F.lit(2), F.size("words") - 1)
    inner = F.flatten(F.transform(sizes, lambda s: F.transform(F.sequence(F.lit(1), F.size("words") - s + 1), lambda i: F.array_join(F.slice(F.col("words"), i, s), " "))))
    inside = candidates.where("size(words) > 2").select("lang", F.explode(inner).alias("phrase"), "a")
    longer = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("longer") < share * F.col("a"), F.lit(True)))

    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= top)
    totals = frequent.where("size = 0").select("lang", "n")
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
