"""Language of a text: averaged hashed subword embeddings and a linear softmax.

A text is folded to letters (ASCII in lower case, all bytes above 127) and
blanks; every run of two, three and four bytes is a subword, hashed into ``DIM``
slots with an embedding each. Their average over the whole text goes through a
linear softmax, fitted by stochastic gradient descent in numpy. A temperature is
fitted on rows left out of training, and the rejection limit is the confidence
that only ``REJECT_SHARE`` of those rows fall short of, at most ``REJECT_BELOW``.

Texts that are null or without a letter are ``und`` with score 0. Null languages
are not learnt from. With no training row everything is ``und``. Repeated rows are told
each, alike; at a tie the language that sorts first is told. Very long texts are told whole,
as a block of their own. Columns with the names asked for are replaced, others come through
whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import BinaryType

from tillview.llm.linear import gather, pack, sample, unpack
from tillview.llm.spans import blocks, segment_sums
from tillview.llm.shared import unused

DIM = 1 << 15
WIDTH = 16
ORDERS = (2, 3, 4)
#: Rows that the model is fitted and calibrated on, at most (about: chosen by hash).
TRAIN_ROWS = 4000
CALIBRATION_PART = 5
EPOCHS = 12
REJECT_SHARE = 0.001
REJECT_BELOW = 0.4
UNKNOWN = "und"


def subwords(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order the slots of all runs of a block in turn, and the n + 1 offsets of the texts in them."""
    folded = np.where((data >= 65) & (data <= 90), data + 32, data)
    folded = np.where(((folded >= 97) & (folded <= 122)) | (folded >= 128), folded, 32).astype(np.uint32)
    lengths = np.diff(offsets)
    for order in ORDERS:
        if len(folded) < order:
            continue
        key = folded[: len(folded) - order + 1].copy()
        for k in range(1, order):
            key = (key << np.uint32(8)) | folded[k : len(folded) - order + 1 + k]
        key = (key + np.uint32(order)) * np.uint32(2654435761)
        slots = (key ^ (key >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(17)
        inside = np.maximum(lengths - order + 1, 0)
        # a run belongs to the text it starts in; the last order - 1 of each text reach into the next
        whole = np.ones(len(slots), bool)
        for back in range(1, order):
            at = offsets[1:] - back
            whole[at[(at >= 0) & (at < len(slots))]] = False
        yield slots[whole].astype(np.int64), np.concatenate([[0], np.cumsum(inside)])


@arrow_udf(BinaryType())
def _vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        rows = []
        for data, offsets in blocks(texts):
            n = len(offsets) - 1
            found = [(np.repeat(np.arange(n), np.diff(cuts)), slots) for slots, cuts in subwords(data, offsets)]
            docs = np.concatenate([d for d, _ in found]) if found else np.zeros(0, np.int64)
            slots = np.concatenate([s for _, s in found]) if found else docs
            rows += [pack(at, count / max(count.sum(), 1)) for at, count in gather(docs, slots, DIM, n)]
        yield pa.array(rows, pa.binary())


@dataclass
class LanguageModel:
    languages: list[str]
    #: Slot by language: embedding times softmax weights.
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    #: Confidences below this are rejected.
    limit: float


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(vectors: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, classes: int, epochs: int = EPOCHS, batch: int = 64, rate: float = 0.1, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Slot-by-class table and bias, by mini-batch descent with per-slot step sizes."""
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.1, (DIM, WIDTH)).astype(np.float32)
    out, bias = rng.normal(0, 0.1, (WIDTH, classes)).astype(np.float32), np.zeros(classes, np.float32)
    seen = [np.full(x.shape, 1e-6, np.float32) for x in (embed, out, bias)]

    def step(k: int, value: np.ndarray, at, gradient: np.ndarray) -> None:
        seen[k][at] += gradient * gradient
        value[at] -= rate * gradient / np.sqrt(seen[k][at])

    for _ in range(epochs):
        order = rng.permutation(len(vectors))
        for first in range(0, len(order), batch):
            rows = order[first : first + batch]
            slots = np.unique(np.concatenate([vectors[r][0] for r in rows]))
            x = np.zeros((len(rows), len(slots)), np.float32)
            for k, r in enumerate(rows):
                x[k, np.searchsorted(slots, vectors[r][0])] = vectors[r][1]
            hidden = x @ embed[slots]
            error = _softmax(hidden @ out + bias)
            error[np.arange(len(rows)), target[rows]] -= 1
            error /= len(rows)
            down = x.T @ (error @ out.T)
            step(1, out, slice(None), hidden.T @ error)
            step(2, bias, slice(None), error.sum(axis=0))
            step(0, embed, slots, down)
    return (embed @ out).astype(np.float32), bias


def calibrate(logits: np.ndarray, target: np.ndarray) -> tuple[float, float]:
    """Temperature of least log loss, and the rejection limit."""
    if not len(target):
        return 1.0, 0.0
    rows = np.arange(len(target))
    steps = np.geomspace(0.25, 8, 61)
    loss = [-np.log(_softmax(logits / t)[rows, target] + 1e-12).mean() for t in steps]
    temperature = float(steps[int(np.argmin(loss))])
    sure = _softmax(logits / temperature).max(axis=1)
    return temperature, float(min(np.quantile(sure, REJECT_SHARE, method="lower"), REJECT_BELOW))


def fit_languages(docs: DataFrame, rows: int = TRAIN_ROWS, text: str = "text", lang: str = "lang") -> LanguageModel:
    """The model from rows with a language and a text with letters. Runs jobs.

    About ``rows`` rows are used at most, copies once; they alone reach the driver,
    each as a vector of at most ``DIM`` entries.
    """
    known = docs.where(F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    chosen = sample(known.withColumn("key", F.xxhash64("text", "lang")), "key", rows)
    chosen = chosen.where(has_letter(F.col("text"))).dropDuplicates(["key"])
    table = chosen.select(_vectors("text").alias("vector"), "lang", "key").toArrow()
    order = np.lexsort([np.array(table["lang"].to_pylist(), object).astype(str), table["key"].to_numpy()]) if len(table) else []
    languages = sorted(set(table["lang"].to_pylist()))
    packed, names = table["vector"].to_pylist(), table["lang"].to_pylist()
    vectors = [unpack(packed[k]) for k in order]
    target = np.array([languages.index(names[k]) for k in order], np.int64)
    if not languages:
        return LanguageModel([], np.zeros((DIM, 0), np.float32), np.zeros(0, np.float32), 1.0, 0.0)
    left_out = np.arange(len(target)) % CALIBRATION_PART == 0
    weights, bias = fit([v for v, x in zip(vectors, left_out, strict=True) if not x], target[~left_out], len(languages))
    logits = np.array([value @ weights[at] + bias for (at, value), x in zip(vectors, left_out, strict=True) if x]).reshape(-1, len(languages))
    temperature, limit = calibrate(logits, target[left_out])
    return LanguageModel(languages, weights, bias, temperature, limit)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", into: tuple[str, str, str] = ("lang_pred", "score", "rejected")) -> DataFrame:
    """``docs`` with the language, the calibrated confidence and whether it is too low, of each whole text.

    Columns named as in ``into`` are replaced.
    """
    # DIM floats per language, whatever the data
    shared = docs.sparkSession.sparkContext.broadcast((np.ascontiguousarray(model.table.T), model.bias, model.temperature))

    @arrow_udf("struct<lang: int, score: double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        columns, bias, temperature = shared.value
        for texts in batches:
            best, score = [np.zeros(0, np.int64)], [np.zeros(0)]
            for data, offsets in blocks(texts):
                n = len(offsets) - 1
                logits, total = np.zeros((n, len(columns))), np.zeros(n)
                for slots, cuts in subwords(data, offsets):
                    total += np.diff(cuts)
                    for k, column in enumerate(columns):
                        logits[:, k] += segment_sums(column[slots], cuts)
                chance = _softmax((logits / np.maximum(total, 1)[:, None] + bias) / temperature) if len(columns) else np.zeros((n, 1))
                best.append(chance.argmax(axis=1))
                score.append(chance.max(axis=1))
            yield pa.StructArray.from_arrays([pa.array(np.concatenate(best), pa.int32()), pa.array(np.concatenate(score))], ["lang", "score"])

    known = has_letter(F.col(text)) if model.languages else F.lit(False)
    names = F.array(*map(F.lit, [*model.languages, UNKNOWN]))
    own = unused(docs, "told")
    told = F.col(own)
    return docs.withColumn(own, F.struct(known.alias("known"), predict(F.col(text)).alias("found"))).withColumns(
        {
            into[0]: F.when(told["known"], F.get(names, told["found"]["lang"])).otherwise(UNKNOWN),
            into[1]: F.when(told["known"], told["found"]["score"]).otherwise(0.0),
            into[2]: ~told["known"] | (told["found"]["score"] < model.limit),
        }
    ).drop(own)
