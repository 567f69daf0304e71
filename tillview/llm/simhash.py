"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A text's A-Z are lowered, its words are ``[^\\x20\\x09-\\x0D]+``, its shingles
``length`` words joined by a space, repeats included; fewer words are one shingle,
none give the fingerprint zero. A bit of the fingerprint is 1 if it is set in over
half of the shingles' XXH64 values (seed 42).

Two fingerprints within ``radius`` bits have a value in common that is within half
the radius (rounded up) of one and half (rounded down) of the other. So every
distinct fingerprint is sent to all values of its ball; at a value, the least
fingerprint of the inner ball is linked with all others there, which keeps every
component whole with one link per member instead of all pairs. A value holds no
more fingerprints than its ball has members, whatever the data.

Null texts count as empty; texts of any length are hashed whole. Repeated rows and doc_ids
are all kept; null doc_ids never name a component unless it has no other (then its id is
null). Columns of any name come through ``keep_one``. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tillview.llm.components import connected
from tillview.llm.shared import stage, unused

SHINGLE_WORDS = 3
RADIUS = 2
SEED = 42
#: Shingles whose bits are counted at once.
SLICE = 1 << 14


def simhash(text: bytes, length: int) -> int:
    words = text.lower().split()  # of bytes: A-Z only, and exactly the six separators
    if not words:
        return 0
    joined, count = b" ".join(words), max(1, len(words) - length + 1)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[:count].tolist()
    stops = ends[-count:].tolist() if len(words) >= length else [len(joined)]
    digest, bits = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for first in range(0, count, SLICE):
        part = slice(first, first + SLICE)
        values = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[part], stops[part], strict=True)], np.uint64)
        bits += np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(bits * 2 > count, bitorder="little").view(np.int64)[0])


def fingerprint(text, length: int = SHINGLE_WORDS):
    """The fingerprint of a text column, as a signed long."""

    @arrow_udf("long")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([simhash((t.as_py() or "").encode(), length) for t in texts], pa.int64())

    return of(text)


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs (hub, print) of the distinct fingerprints in column ``print`` that join
    every two fingerprints within ``radius`` bits through a chain of links."""
    outer, inner = (radius + 1) // 2, radius // 2
    flips = [sum(1 << b for b in bits) for n in range(outer + 1) for bits in combinations(range(64), n)]
    masks = F.array(*(F.lit(m - (1 << 64) if m >> 63 else m) for m in flips))
    balls = prints.select("print", F.explode(masks).alias("mask")).select(F.col("print").bitwiseXOR(F.col("mask")).alias("value"), "print")
    near = F.when(F.bit_count(F.col("value").bitwiseXOR(F.col("print"))) <= inner, F.col("print"))
    met = balls.withColumn("hub", F.min(near).over(Window.partitionBy("value")))
    pairs = met.where("hub is not null and hub != print").select("hub", "print").distinct()
    return pairs.where(F.bit_count(F.col("hub").bitwiseXOR(F.col("print"))) <= radius)


def groups(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """From rows (doc_id, print): each distinct fingerprint with its component's key
    ``root``, least doc_id ``component_id`` and ``keeper``, the fingerprint that has it."""
    least = stage(prints.groupBy("print").agg(F.min("doc_id").alias("doc_id")), "prints")
    roots = connected(links(least.select("print"), radius), "hub", "print")
    marked = least.join(roots.withColumnRenamed("u", "print"), "print", "left")
    marked = stage(marked.select("print", "doc_id", F.coalesce("v", "print").alias("root")), "roots")
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "print")
    named = marked.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.min(first)["print"].alias("keeper"))
    return marked.drop("doc_id").join(named, "root")


def near_duplicates(docs: DataFrame, length: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (hex), component_id and root of every document. Runs jobs."""
    prints = stage(docs.select("doc_id", fingerprint(F.col("text"), length).alias("print")), "simhash")
    hexed = F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint")
    return prints.join(groups(prints, radius), "print").select("doc_id", hexed, "component_id", "root")


def keep_one(docs: DataFrame, length: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """One document of each component, the one with the least doc_id (null last), with the
    columns of ``docs``; of rows with one id the one with the least hash of its text, of
    equal rows any. Runs jobs. Texts are hashed once, and only those that stay are joined."""
    key = [F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.xxhash64("text")]
    keys = stage(docs.select("doc_id", key[1].alias("text_hash"), fingerprint(F.col("text"), length).alias("print")), "simhash")
    roots = groups(keys.select("doc_id", "print"), radius).select("print", "root")
    rows = keys.groupBy("print", "doc_id", "text_hash").agg(F.count("*").alias("copies"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash", "copies")).alias("first")
    kept = stage(rows.join(roots, "print").groupBy("root").agg(first).select("first.*"), "kept")
    own = [unused(docs, name) for name in ("kept_id", "kept_hash", "kept_copies")]
    kept = kept.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")).alias(own[0]), F.col("text_hash").alias(own[1]), F.col("copies").alias(own[2]))
    found = docs.withColumns(dict(zip(own, key, strict=False))).join(kept, own[:2])
    once = found.where(F.col(own[2]) == 1).select(*docs.columns)
    if kept.where(F.col(own[2]) > 1).isEmpty():
        return once
    # rows that are there several times: one of each, before the shuffle too
    place = unused(found, "place")
    order = Window.partitionBy(*own[:2]).orderBy(F.lit(1))
    several = found.where(F.col(own[2]) > 1).withColumn(place, F.row_number().over(order)).where(F.col(place) == 1)
    return once.union(several.select(*docs.columns))
