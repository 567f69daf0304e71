"""Sparse vectors, samples of them, and the follow-the-regularised-leader learner."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pack(indices: np.ndarray, values: np.ndarray) -> bytes:
    """A sparse vector as bytes, for a binary column."""
    return indices.astype(np.uint32).tobytes() + values.astype(np.float32).tobytes()


def unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(packed) // 8
    return np.frombuffer(packed, np.uint32, n), np.frombuffer(packed, np.float32, n, 4 * n)


def gather(docs: np.ndarray, features: np.ndarray, dim: int, n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct features and their counts, for each of ``n`` texts."""
    keys, counts = np.unique(docs.astype(np.int64) * dim + features, return_counts=True)
    cuts = np.searchsorted(keys, np.arange(n + 1, dtype=np.int64) * dim)
    return [(keys[a:b] % dim, counts[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def remainder(doc_id: Column | str, modulus: int) -> Column:
    """``crc32`` of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % modulus


def sample(rows: DataFrame, key: str, most: int) -> DataFrame:
    """Rows whose hash of ``key`` falls in the first ``most`` of as many as there are rows: about
    ``most`` at the most if keys differ; all if there are fewer rows. Runs a count."""
    total = rows.count()
    if total <= most:
        return rows
    return rows.where(F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(total)) < most)


def unanimous(labels: DataFrame, key: str, label: str) -> DataFrame:
    """One row per key; keys whose rows disagree, and null keys or labels, are left out."""
    return (
        labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
        .groupBy(key)
        .agg(F.min(label).alias("label"), F.max(label).alias("other"))
        .where("label = other")
        .select(key, "label")
    )


def one_text(labelled: DataFrame) -> DataFrame:
    """One text per doc_id, where documents repeat an id: the one of the least hash."""
    return labelled.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))


@dataclass
class Leader:
    """FTRL-proximal state: weights are computed where they are read."""

    dim: int
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.1
    l2: float = 0.01
    z: np.ndarray = field(init=False)
    n: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.z = np.zeros(self.dim)
        self.n = np.zeros(self.dim)

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z = self.z[at]
        shrunk = np.maximum(np.abs(z) - self.l1, 0.0)
        return -np.sign(z) * shrunk / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2)

    def update(self, at: np.ndarray, weights: np.ndarray, gradient: np.ndarray) -> None:
        """Take the gradient at distinct coordinates ``at``, whose present weights are given."""
        n = self.n[at]
        grown = n + gradient * gradient
        self.z[at] += gradient - (np.sqrt(grown) - np.sqrt(n)) / self.alpha * weights
        self.n[at] = grown
