"""Document fingerprints: one-permutation MinHash in DataFrame functions alone.

A text (null: empty) is lowered and cut at white space; its shingles are
``SHINGLE_WORDS`` words (fewer words are one shingle), each hashed once. The upper
bits of a hash give its bin, a bin keeps its least hash. An empty bin takes the
value of the first filled bin in a random sequence of bins of its own (optimal
densification): ``PROBES`` probes, then a random order of all filled bins, so that
every empty bin is filled, each from filled bins alike. The lowest ``BITS`` bits of
each bin are packed; likeness is the share of equal bins, corrected for the
``2**-BITS`` that agree by chance, within 0 and 1.

Equal texts have equal fingerprints; a text without words has all zeros. Texts of any
length are fingerprinted whole. Repeated rows have a row each: null ids come first, rows of
one id follow each other by a hash of their text. Other columns take no part, whatever
their names. An empty table gives no rows; a single row is its own next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE_WORDS = 5
BINS = 256
BITS = 4
PROBES = 12
#: Bins in a long of the packed fingerprint.
PER_LONG = 64 // BITS
#: Rows of consecutive ids that are worked on together, about, and sets of them at most.
RANGE_ROWS = 4096
MOST_RANGES = 1 << 15
#: Ids a range is drawn from, about.
SAMPLE_PER_RANGE = 32


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _shingles(words: Column, length: int) -> Column:
    one = F.array(F.aggregate(words, F.lit(0).cast("long"), lambda a, w: F.xxhash64(a, w)))
    many = F.transform(F.sequence(F.lit(0), F.size(words) - length), lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(length))))
    return F.when(F.size(words) < length, one).otherwise(many)


def _bins(hashes: Column) -> Column:
    """The least even value of each bin in bin order; null for an empty bin."""
    shift = 64 - (BINS.bit_length() - 1)
    # the largest value of each bin, odd: after sorting it comes first only in an empty bin
    ends = ",".join(str(((t - BINS // 2) << shift) + (1 << shift) - 1) for t in range(BINS))
    fence = F.split(F.lit(ends), ",").cast("array<bigint>")
    ordered = F.sort_array(F.concat(F.transform(hashes, lambda h: h.bitwiseAND(F.lit(-2))), fence))

    def first(values: Column) -> Column:
        new = lambda x, i: (i == 0) | (F.shiftright(x, shift) != F.shiftright(F.get(values, i - 1), shift))
        return F.filter(values, new)

    return F.transform(_let(ordered, first), lambda v: F.when(v.bitwiseAND(F.lit(1)) == 0, v))


def _densify(bins: Column) -> Column:
    every = F.sequence(F.lit(0), F.lit(BINS - 1))

    def fill(filled: Column) -> Column:
        def value(i: Column) -> Column:
            probes = [F.get(bins, F.pmod(F.xxhash64(i, F.lit(a)), F.lit(BINS)).cast("int")) for a in range(PROBES)]
            drawn = F.array_min(F.transform(filled, lambda j: F.struct(F.xxhash64(i, j, F.lit("rest")).alias("h"), F.get(bins, j).alias("v"))))
            return F.coalesce(F.get(bins, i), *probes, drawn["v"])

        return F.transform(every, value)

    return _let(F.filter(every, lambda j: F.get(bins, j).isNotNull()), fill)


def minhash(text: Column, length: int = SHINGLE_WORDS) -> Column:
    """The packed fingerprint as ``BINS * BITS / 64`` longs."""
    words = F.transform(F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), ""), lambda w: F.xxhash64(w))
    pack = lambda low: F.transform(
        F.sequence(F.lit(0), F.lit(BINS // PER_LONG - 1)),
        lambda j: F.aggregate(F.slice(low, j * PER_LONG + 1, F.lit(PER_LONG)), F.lit(0).cast("long"), lambda a, v: F.shiftleft(a, BITS).bitwiseOR(v)),
    )
    low = lambda bins: F.transform(_densify(bins), lambda v: F.shiftright(v, 1).bitwiseAND(F.lit((1 << BITS) - 1)))
    print_of = lambda w: _let(_bins(_shingles(w, length)), lambda b: _let(low(b), pack))
    zeros = F.array_repeat(F.lit(0).cast("long"), BINS // PER_LONG)
    return _let(words, lambda w: F.when(F.size(w) == 0, zeros).otherwise(print_of(w)))


def as_text(packed: Column) -> Column:
    return F.array_join(F.transform(packed, lambda v: F.lpad(F.lower(F.hex(v)), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles of two packed fingerprints."""
    lowest = sum(1 << (BITS * k) for k in range(PER_LONG))

    def unlike(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        for k in range(BITS.bit_length() - 1):
            d = d.bitwiseOR(F.shiftrightunsigned(d, 1 << k))
        return F.bit_count(d.bitwiseAND(F.lit(lowest)))

    differ = F.aggregate(F.zip_with(a, b, unlike), F.lit(0), lambda s, n: s + n)
    chance = 2.0**-BITS
    return F.least(F.greatest(((BINS - differ) / BINS - chance) / (1 - chance), F.lit(0.0)), F.lit(1.0))


def _ranges(docs: DataFrame) -> tuple[list[int], int | None]:
    """Ids that begin the ranges, and the least id (None if an id is null). Runs two
    jobs over the ids alone; what reaches the driver is one row of at most ``MOST_RANGES`` ids."""
    rows, least, missing = docs.agg(F.count("*"), F.min("doc_id"), F.count_if(F.col("doc_id").isNull())).first()
    ranges = min(MOST_RANGES, max(1, rows // RANGE_ROWS))
    cuts = []
    if ranges > 1:
        every = max(1, rows // (ranges * SAMPLE_PER_RANGE))
        drawn = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0)
        shares = F.split(F.lit(",".join(str(k / ranges) for k in range(1, ranges))), ",").cast("array<double>")
        cuts = drawn.agg(F.percentile_approx("doc_id", shares, F.lit(ranges * SAMPLE_PER_RANGE))).first()[0] or []
    return [-(1 << 63), *sorted(set(cuts) - {least})], None if missing else least


def with_next(docs: DataFrame, kept: list[str]) -> DataFrame:
    """``docs`` with ``next_<c>`` of the document that follows by doc_id, for each c of
    ``kept``; the first follows the last. Null ids come first, equal ids by a hash of
    the text. Texts are shuffled once, by range of ids; the first rows of a range also
    go to the end of the range before. Runs jobs."""
    starts, least = _ranges(docs)
    listed = F.split(F.lit(",".join(map(str, starts))), ",").cast("array<bigint>")
    steps = max(1, (len(starts) - 1).bit_length())

    def halve(at: Column, power: Column) -> Column:
        return F.when(F.get(listed, at + power) <= F.col("doc_id"), at + power).otherwise(at)

    at = F.aggregate(F.array(*(F.lit(1 << k) for k in reversed(range(steps)))), F.lit(0), halve)
    ranged = docs.withColumn("_range", F.when(F.col("doc_id").isNull(), 0).otherwise(at))
    begins = F.when(F.col("_range") == 0, F.col("doc_id").eqNullSafe(F.lit(least))).otherwise(F.col("doc_id") == F.get(listed, F.col("_range")))
    own = F.struct(F.col("_range").alias("at"), F.lit(0).alias("copy"))
    back = F.struct(F.pmod(F.col("_range") - 1, F.lit(len(starts))).alias("at"), F.lit(1).alias("copy"))
    placed = ranged.withColumn("_place", F.explode(F.when(begins, F.array(own, back)).otherwise(F.array(own))))
    order = Window.partitionBy("_place.at").orderBy("_place.copy", F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    led = placed.withColumns({f"next_{c}": F.lead(c).over(order) for c in kept})
    return led.where("_place.copy = 0").drop("_place", "_range")


def compare_edits(docs: DataFrame, length: int = SHINGLE_WORDS) -> DataFrame:
    """For every document: its fingerprint, that of its edited text (the second half
    replaced by as much of the next document's beginning), and the likenesses."""
    base = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    base = base.withColumn("packed", minhash(F.col("text"), length))
    led = with_next(base, ["text", "packed"]).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring("next_text", F.lit(1), half))
    led = led.withColumn("edited", edited).withColumn("edited_packed", minhash(F.col("edited"), length))
    return led.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("packed")).alias("fingerprint"),
        as_text(F.col("edited_packed")).alias("edited_fingerprint"),
        likeness(F.col("packed"), F.col("edited_packed")).alias("near_edited"),
        likeness(F.col("packed"), F.col("next_packed")).alias("near_next"),
    )
