"""Scores of the three classifiers against plain Python, word by word."""

import math

import numpy as np
import pytest

from tillview.llm import langid, quality, toxicity
from tillview.llm.spans import BASE

MASK = (1 << 64) - 1


def mix(v):
    v ^= v >> 31
    v = v * 0xD6E8FEB86659FD93 & MASK
    return v ^ v >> 32


def of_bytes(word):
    return mix(sum((b + 1) * pow(BASE, k, 1 << 64) for k, b in enumerate(word)) & MASK)


def lowered(data):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in data)


def shape(word, again):
    letter = lambda b: 97 <= (b + 32 if 65 <= b <= 90 else b) <= 122 or b >= 128
    upper = [65 <= b <= 90 for b in word]
    digit = [48 <= b <= 57 for b in word]
    marks = sum(not letter(b) and not d for b, d in zip(word, digit, strict=True))
    small = any(letter(b) and not u for b, u in zip(word, upper, strict=True))
    last = 0 if letter(word[-1]) else word[-1]
    kind = min(sum(upper), 2) + 3 * small + 6 * any(digit) + 12 * min(marks, 4) + 60 * again
    return mix(kind * 256 + last + 1)


def slow_quality(text, weights):
    words = (text or "").encode().split()
    hashes = [of_bytes(lowered(w)) for w in words]
    shapes = [shape(w, k > 0 and hashes[k] == hashes[k - 1]) for k, w in enumerate(words)]
    total = 0.0
    for kind, (base, length) in enumerate([(hashes, 1), (shapes, 1), (hashes, 2), (shapes, 2), (shapes, 3)]):
        for k in range(len(words) - length + 1):
            run = base[k]
            for n in range(1, length):
                run = mix((run * 3 + base[k + n]) & MASK)
            run = run + (length if length > 1 else 0) + 977 * kind & MASK
            total += weights[1 + mix(run) % (quality.DIM - 1)]
    return 1 / (1 + math.exp(-(weights[0] + total * quality.SCALE / max(len(words), 1))))


def slow_severity(text, model):
    data = lowered((text or "").encode())
    words, now = [], b""
    for b in [*data, 0]:
        if 97 <= b <= 122 or b >= 128:
            now += bytes([b])
        elif now:
            words.append(now)
            now = b""
    slots = {mix(of_bytes(w)) % toxicity.DIM for w in words}
    slots |= {mix(of_bytes(w[:n]) + n & MASK) % toxicity.DIM for w in words for n in toxicity.BEGINNINGS if len(w) >= n}
    total = sum(float(model.weights[s]) for s in slots)
    above = [1 / (1 + math.exp(-max(-40, min(40, total - t)))) for t in model.thresholds]
    return sum(above), above[0]


def slow_language(text, model):
    data = [b if 97 <= b <= 122 or b >= 128 else 32 for b in lowered((text or "").encode())]
    logits, count = np.zeros(len(model.languages)), 0
    for order in langid.ORDERS:
        for k in range(len(data) - order + 1):
            key = 0
            for b in data[k : k + order]:
                key = (key << 8 | b) & 0xFFFFFFFF
            key = (key + order) * 2654435761 & 0xFFFFFFFF
            logits += model.table[((key ^ key >> 15) * 0x2C1B3C6D & 0xFFFFFFFF) >> 17]
            count += 1
    x = (logits / max(count, 1) + model.bias) / model.temperature
    chance = np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    return model.languages[int(chance.argmax())], float(chance.max())


@pytest.fixture(scope="module")
def some(edges, documents):
    """The edge rows but for the long one, and documents of all kinds."""
    return edges.where("doc_id is null or doc_id != 4").select("doc_id", "text", "lang").union(documents.select("doc_id", "text", "lang").where("doc_id % 4 = 1 and length(text) < 6000")).persist()


def test_quality_scores(spark, some, small):
    labels = spark.read.parquet(f"{small}/labels.parquet").selectExpr("doc_id", "quality as label")
    weights = quality.fit_quality(spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text"), labels)
    assert np.count_nonzero(weights) > 10
    rows = quality.score_quality(some, weights).collect()
    assert [r.score for r in rows] == pytest.approx([slow_quality(r.text, weights) for r in rows], abs=1e-6)


def test_severity_scores(spark, some, small):
    draw = np.random.default_rng(1)
    weights = np.where(draw.random(toxicity.DIM) < 0.5, draw.normal(size=toxicity.DIM) / 30, 0)
    model = toxicity.Severity(weights, np.array([0.5, 1.5, 3.0]))
    rows = toxicity.score_severity(some, model).collect()
    assert [(r.severity, r.score) for r in rows] == [pytest.approx(slow_severity(r.text, model), abs=1e-6) for r in rows]


def test_language_scores(some, documents):
    model = langid.fit_languages(documents)
    for r in langid.identify(some, model).collect():
        if any(c.isalpha() for c in r.text or ""):
            told, score = slow_language(r.text, model)
            assert r.lang_pred == told and r.score == pytest.approx(score, abs=1e-5)
        else:
            assert (r.lang_pred, r.score) == ("und", 0.0)
