"""Quality classifier: logistic regression on hashed word n-grams, learnt by FTRL.

A text is cut at white space. Features are its words, pairs of words, and runs
of one to three word *shapes* (case, trailing punctuation, digits, repeat of the
word before), each hashed into ``DIM`` slots with its share of the words as
value; the first slot is the bias. A score is one sparse dot product.

Null and empty texts have the bias alone and so a score. A column that the
result's name would clash with is replaced, others come through whatever their
names. Repeated rows are scored each, with the same score; a doc_id with several texts
is learnt once, by the text of the least hash. Very long texts are scored whole, as a block
of their own. An empty table gives no rows, an empty training table the score 0.5 to all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import BinaryType

from tillview.llm.linear import Leader, gather, one_text, pack, sample, unanimous, unpack
from tillview.llm.spans import blocks, mix, runs, span_hashes

DIM = 1 << 18
#: Labelled rows that the model is fitted on, at most (about: chosen by hash).
TRAIN_ROWS = 5000
EPOCHS = 3
#: A word's share of a text is small; this brings the values near one.
SCALE = 20.0
#: Documents below this score are rejected.
ACCEPT = 0.3


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number and slot of every feature of a block, and the words of each text."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    starts, ends, doc = runs(~space, offsets)
    words = np.bincount(doc, minlength=len(offsets) - 1)
    if not len(starts):
        return doc, doc, words
    upper = (data >= 65) & (data <= 90)
    folded = np.where(upper, data + 32, data).astype(np.uint8)
    letter = ((folded >= 97) & (folded <= 122)) | (data >= 128)
    digit = (data >= 48) & (data <= 57)
    hashes = span_hashes(folded, starts, ends)

    def within(mask: np.ndarray, most: int) -> np.ndarray:
        running = np.zeros(len(mask) + 1, np.int64)
        np.cumsum(mask, out=running[1:])
        return np.minimum(running[ends] - running[starts], most)

    again = np.zeros(len(starts), np.int64)
    again[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    last = np.where(letter[ends - 1], 0, data[ends - 1])
    lower_only = within(letter & ~upper, 1)
    shape = within(upper, 2) + 3 * lower_only + 6 * within(digit, 1) + 12 * within(~letter & ~digit, 4) + 60 * again
    shape = mix((shape * 256 + last).astype(np.uint64) + np.uint64(1))
    found = [(doc, hashes), (doc, shape)]
    for base, length in ((hashes, 2), (shape, 2), (shape, 3)):
        run = base
        for k in range(1, length):
            run = mix(run[:-1] * np.uint64(3) + base[k:])
        found.append((doc[length - 1 :], run + np.uint64(length)))
        same = doc[length - 1 :] == doc[: len(doc) - length + 1]
        found[-1] = (found[-1][0][same], found[-1][1][same])
    slots = [1 + (mix(h + np.uint64(977 * k)) % np.uint64(DIM - 1)).astype(np.int64) for k, (_, h) in enumerate(found)]
    return np.concatenate([d for d, _ in found]), np.concatenate(slots), words


@arrow_udf(BinaryType())
def _vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        rows = []
        for data, offsets in blocks(texts):
            doc, slots, words = features(data, offsets)
            for k, (at, count) in enumerate(gather(doc, slots, DIM, len(offsets) - 1)):
                rows.append(pack(np.append(at, 0), np.append(count * (SCALE / max(words[k], 1)), 1.0)))
        yield pa.array(rows, pa.binary())


def fit_quality(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, epochs: int = EPOCHS) -> np.ndarray:
    """Weights from the labelled documents. Runs jobs.

    ``docs`` has doc_id and text, ``labels`` doc_id and label (0 or 1). About
    ``rows`` labelled rows are used at most; they alone reach the driver, each
    as a vector of at most ``DIM`` entries.
    """
    chosen = sample(unanimous(labels, "doc_id", "label"), "doc_id", rows)
    # bounded by ``rows``, so the broadcast is small and the texts are not shuffled
    known = one_text(docs.join(F.broadcast(chosen), "doc_id"))
    order = F.xxhash64("text", "doc_id").alias("place")
    table = known.select(_vectors("text").alias("vector"), F.col("label").cast("int").alias("label"), order).toArrow()
    place = np.argsort(table["place"].to_numpy(), kind="stable")
    vectors, label = [unpack(v.as_py()) for v in table["vector"]], table["label"].to_numpy()
    model = Leader(DIM)
    for _ in range(epochs):
        for k in place:
            at, value = vectors[k]
            weights = model.weights(at)
            chance = 1.0 / (1.0 + np.exp(-float(weights @ value)))
            model.update(at, weights, (chance - label[k]) * value)
    return model.weights().astype(np.float32)


def score_quality(docs: DataFrame, weights: np.ndarray, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with the chance of label 1 of each whole text in column ``into``."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # DIM floats, whatever the data

    @arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weights = shared.value
        for texts in batches:
            parts = [np.zeros(0)]
            for data, offsets in blocks(texts):
                doc, slots, words = features(data, offsets)
                dot = np.bincount(doc, weights[slots], minlength=len(offsets) - 1) if len(doc) else 0.0
                parts.append(1.0 / (1.0 + np.exp(-(weights[0] + dot * SCALE / np.maximum(words, 1)))))
            yield pa.array(np.concatenate(parts), pa.float64())

    return docs.withColumn(into, score(F.col(text)))
