"""Severity of toxic text: cumulative-link regression on sparse word features.

Grades are ordered: 0 is clean, 1 and up are toxic by rising severity. One
weight vector is shared by all grades; grade k or more has the chance
``sigmoid(x.w - threshold_k)`` with rising thresholds. The expected severity is
the sum of these chances, and a text is flagged from a chance of ``FLAG`` for
grade 1 or more.

Labels say toxic or not. ``grades`` splits the toxic ones by how many marker
words they hold: words (or word beginnings) that training texts of the toxic
class have far more often than the others.

Features are a text's distinct lower-cased words and word beginnings of three to
seven bytes, hashed into ``DIM`` slots; a text's vector is the set of them, so
its length does not dilute an insult. Null and empty texts have no feature and
the severity that the thresholds alone give. A column that a result's name would
clash with is replaced, others come through whatever their names. Repeated rows are
scored each, alike; at a tie the lower grade is shown. Very long texts are scored whole, as a
block of their own. With no toxic training text nothing is flagged; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import BinaryType

from tillview.llm.linear import Leader, gather, one_text, sample, unanimous
from tillview.llm.spans import blocks, mix, runs, span_hashes
from tillview.llm.shared import unused

DIM = 1 << 20
#: Clean and toxic labelled rows that the model is fitted on, at most (about: chosen by hash).
TRAIN_ROWS = (9000, 3000)
#: A text is flagged if grade 1 or more has this chance.
FLAG = 0.3
EPOCHS = 8
BEGINNINGS = (3, 4, 5, 6, 7)
#: Grades above 0.
LEVELS = 3
#: A marker is in so many toxic training texts and is so many times as frequent there.
MARKER_TEXTS, MARKER_RATIO = 5, 8.0
#: Between neighbouring thresholds, at least.
GAP = 0.25


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text number and slot of every word and word beginning of a block."""
    folded = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    starts, ends, doc = runs(((folded >= 97) & (folded <= 122)) | (folded >= 128), offsets)
    if not len(starts):
        return doc, doc
    docs, slots = [doc], [mix(span_hashes(folded, starts, ends))]
    for length in BEGINNINGS:
        long = ends - starts >= length
        docs.append(doc[long])
        slots.append(mix(span_hashes(folded, starts[long], starts[long] + length) + np.uint64(length)))
    return np.concatenate(docs), (np.concatenate(slots) % np.uint64(DIM)).astype(np.int64)


@arrow_udf(BinaryType())
def _sets(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        rows = []
        for data, offsets in blocks(texts):
            doc, slots = features(data, offsets)
            rows += [at.astype(np.uint32).tobytes() for at, _ in gather(doc, slots, DIM, len(offsets) - 1)]
        yield pa.array(rows, pa.binary())


def grades(vectors: list[np.ndarray], toxic: np.ndarray, levels: int = LEVELS) -> np.ndarray:
    """0 for clean texts; toxic ones by marker words held, in ``levels`` about equal parts."""
    held = {0: np.zeros(DIM), 1: np.zeros(DIM)}
    for at, y in zip(vectors, toxic, strict=True):
        held[int(y)][at] += 1
    share = {y: (held[y] + 0.5) / (max((toxic == y).sum(), 1) + 1) for y in held}
    marker = (held[1] >= MARKER_TEXTS) & (share[1] >= MARKER_RATIO * share[0])
    hits = np.array([float(marker[at].sum()) for at in vectors])
    out = np.zeros(len(toxic), np.int64)
    if (toxic == 1).any():
        cuts = np.quantile(hits[toxic == 1], np.arange(1, levels) / levels)
        out[toxic == 1] = 1 + np.searchsorted(cuts, hits[toxic == 1], "left")
    return out


@dataclass
class Severity:
    weights: np.ndarray
    thresholds: np.ndarray


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def apart(theta: np.ndarray) -> np.ndarray:
    """Thresholds in order, ``GAP`` apart at least."""
    steps = GAP * np.arange(len(theta))
    return np.maximum.accumulate(theta - steps) + steps


def fit(vectors: list[np.ndarray], grade: np.ndarray, order: np.ndarray, epochs: int = EPOCHS, levels: int = LEVELS, rate: float = 0.1) -> Severity:
    """Shared weights by FTRL, thresholds by gradient steps kept in order."""
    model, above = Leader(DIM, alpha=0.1, l1=3.0), [(grade >= k).mean() if len(grade) else 0.0 for k in range(1, levels + 1)]
    theta = apart(np.array([np.log((1 - p + 1e-4) / (p + 1e-4)) for p in above]))
    for epoch in range(epochs):
        for i in order:
            at = vectors[i]
            weights = model.weights(at)
            chance = np.concatenate([[1.0], _sigmoid(weights.sum() - theta), [0.0]])
            k = grade[i]
            # the log loss by x.w: the slopes of the two logistic curves over their difference
            model.update(at, weights, np.full(len(at), chance[k] + chance[k + 1] - 1.0))
            likely = max(chance[k] - chance[k + 1], 1e-9)
            pull = np.minimum(chance * (1 - chance) / likely, 1.0) * rate / (1 + epoch)
            if k >= 1:
                theta[k - 1] -= pull[k]
            if k < levels:
                theta[k] += pull[k + 1]
            theta = apart(theta)
    return Severity(model.weights().astype(np.float32), theta)


def fit_severity(docs: DataFrame, labels: DataFrame, rows: tuple[int, int] = TRAIN_ROWS) -> Severity:
    """The model from ``docs`` (doc_id, text) and ``labels`` (doc_id, label 0 or 1). Runs jobs.

    About ``rows`` clean and toxic rows are used at most; they alone reach the
    driver, each as a set of at most ``DIM`` slots.
    """
    known = unanimous(labels, "doc_id", "label")
    clean, toxic = (sample(known.where(F.col("label") == y), "doc_id", most) for y, most in enumerate(rows))
    chosen = clean.union(toxic)
    known = one_text(docs.join(F.broadcast(chosen), "doc_id"))
    order = F.xxhash64("text", "doc_id").alias("place")
    table = known.select(_sets("text").alias("vector"), F.col("label").cast("int").alias("label"), order).toArrow()
    vectors, marks = [np.frombuffer(v.as_py(), np.uint32) for v in table["vector"]], table["label"].to_numpy()
    return fit(vectors, grades(vectors, marks), np.argsort(table["place"].to_numpy(), kind="stable"))


def score_severity(docs: DataFrame, model: Severity, text: str = "text") -> DataFrame:
    """``docs`` with ``severity`` (expected grade), ``grade`` (likeliest), ``score`` (chance of grade 1
    or more) and ``predicted`` (1 if that is ``FLAG`` or more) of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))  # DIM floats, whatever the data

    @arrow_udf("array<double>")
    def chances(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weights, theta = shared.value
        used = weights != 0
        for texts in batches:
            parts = [np.zeros((0, len(theta)))]
            for data, offsets in blocks(texts):
                doc, slots = features(data, offsets)
                keep = used[slots]
                total = np.zeros(len(offsets) - 1)
                if keep.any():
                    keys = np.unique(doc[keep].astype(np.int64) * DIM + slots[keep])
                    total = np.bincount(keys // DIM, weights[keys % DIM], minlength=len(total))
                parts.append(_sigmoid(total[:, None] - theta))
            flat = np.concatenate(parts)
            yield pa.ListArray.from_arrays(np.arange(len(flat) + 1, dtype=np.int32) * len(theta), pa.array(flat.ravel()))

    levels = len(model.thresholds)
    own = unused(docs, "above")
    marked = docs.withColumn(own, chances(F.col(text)))
    above = [F.lit(1.0), *(F.get(own, F.lit(k)) for k in range(levels)), F.lit(0.0)]
    share = [above[k] - above[k + 1] for k in range(levels + 1)]
    grade = F.array_max(F.array(*(F.struct(p.alias("p"), F.lit(-k).alias("k")) for k, p in enumerate(share))))
    return marked.withColumns(
        {
            "severity": sum(above[1:-1], F.lit(0.0)),
            "grade": (-grade["k"]).cast("int"),
            "score": above[1],
            "predicted": (above[1] >= FLAG).cast("int"),
        }
    ).drop(own)
