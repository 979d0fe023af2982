"""Distinct and frequent items of an item stream ``(pos, item)``, in batch form.

* exact: ``groupBy(item).count()`` (partial aggregation: a hot item is merged map-side);
* reservoir sampling (Algorithm R, acceptance m/t with t the 0-based position): without custom
  state -- a row is accepted when ``pos < m`` (slot = pos) or ``u1 * pos <= m`` (slot =
  floor(u2 * m)), and the sample is, per slot, the accepted row with the largest position. That is
  exactly the sequential loop's final content, for any split of the stream into batches;
* sticky sampling: a tracked item counts every later occurrence, an untracked one starts at 1
  with probability r/n. With a per-position uniform u, an item's count is the number of its
  occurrences at or after its first position with u <= r/n. Positions are cut into blocks of
  ``STICKY_BLOCK``: counts per (item, block) and first accepted positions per item are partial
  aggregates, blocks after the first accepted position count whole, and single rows are looked at
  only in that position's own block -- a hot item never lands in a single task.

Uniforms are pure functions of (tag, seed, pos) (``tessera.functions.hashing``).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.floats import f32
from tessera.functions.hashing import uniform

STICKY_BLOCK = 1 << 16  # positions per (item, block) group of the sticky counter

# fixed tags of the seeded uniforms
TAG_RESERVOIR_ACCEPT = "reservoir-accept"
TAG_RESERVOIR_SLOT = "reservoir-slot"
TAG_STICKY_ACCEPT = "sticky-accept"


@dataclass(frozen=True)
class FrequencyParams:
    """Stream length n, and phi, epsilon, delta as float32 (the reference's parameter types)."""

    n: int
    phi: float
    epsilon: float
    delta: float
    seed: int = 42

    def __post_init__(self):
        if self.n < 1:
            raise ValueError("n must be positive")
        for name in ("phi", "epsilon", "delta"):
            object.__setattr__(self, name, f32(getattr(self, name)))
        if not 0 < self.phi <= 1 or not 0 < self.epsilon < self.phi or not 0 < self.delta < 1:
            raise ValueError("need 0 < epsilon < phi <= 1 and 0 < delta < 1")

    @classmethod
    def for_length(cls, total: int, seed: int = 42) -> FrequencyParams:
        """The ITEMS binding: n = N, phi = 75/N, epsilon = 15/N (phi/5), delta = 0.1."""
        return cls(n=total, phi=75.0 / total, epsilon=15.0 / total, delta=0.1, seed=seed)

    @property
    def m(self) -> int:
        """Reservoir size ceil(1/phi), the quotient in float32."""
        return int(math.ceil(float(np.float32(1.0) / np.float32(self.phi))))

    @property
    def r(self) -> float:
        """Sticky-sampling rate factor (float) ln(1/(delta*phi)) / epsilon, all float32 steps."""
        inv = np.float32(1.0) / (np.float32(self.delta) * np.float32(self.phi))
        return float(np.float32(np.float32(math.log(float(inv))) / np.float32(self.epsilon)))

    @property
    def sticky_p(self) -> float:
        """Acceptance probability r/n, in double."""
        return self.r / float(self.n)

    @property
    def true_threshold(self) -> float:
        """phi * n in float32: an item is truly frequent when float(count) >= this."""
        return float(np.float32(self.phi) * np.float32(self.n))

    @property
    def sticky_threshold(self) -> int:
        """(long)((phi - epsilon) * n), float32 arithmetic then truncation."""
        return int(float((np.float32(self.phi) - np.float32(self.epsilon)) * np.float32(self.n)))


def prefix(items: DataFrame, params: FrequencyParams | int) -> DataFrame:
    """The first n items (n from the parameters, or given)."""
    n = params.n if isinstance(params, FrequencyParams) else params
    return items.filter(F.col("pos") < F.lit(int(n)))


def distinct_items(items: DataFrame) -> DataFrame:
    """``(item)``: the distinct items."""
    return items.select("item").distinct()


def item_histogram(items: DataFrame) -> DataFrame:
    """``(item, n)``: exact frequencies."""
    return items.groupBy("item").agg(F.count(F.lit(1)).alias("n"))


def distinct_items_summary(items: DataFrame, approx_rsd: float | None = None) -> DataFrame:
    """``(n_items, n_distinct, largest_item)``; the largest item is floored at 0 as in the
    reference (it starts its maximum at 0).

    Exact by default (one partially aggregated shuffle by item). With ``approx_rsd`` the distinct
    count is a HyperLogLog++ estimate of that relative error: no shuffle by item at all, only a
    global merge of fixed-size sketches.
    """
    if approx_rsd is not None:
        return items.agg(
            F.count(F.lit(1)).alias("n_items"),
            F.approx_count_distinct("item", rsd=float(approx_rsd)).cast("bigint").alias("n_distinct"),
            F.greatest(F.coalesce(F.max("item"), F.lit(0)), F.lit(0)).cast("bigint").alias("largest_item"),
        )
    return item_histogram(items).agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_items"),
        F.count(F.lit(1)).alias("n_distinct"),
        F.greatest(F.coalesce(F.max("item"), F.lit(0)), F.lit(0)).cast("bigint").alias("largest_item"),
    )


def frequent_items(items: DataFrame, params: FrequencyParams) -> DataFrame:
    """``(item, n)``: items with float(count) >= phi * n, ascending by item. At most 1/phi rows."""
    return true_frequent(items, params).orderBy("item")


def true_frequent(items: DataFrame, params: FrequencyParams) -> DataFrame:
    """The true frequent items, unordered (at most 1/phi rows)."""
    return frequent_of(item_histogram(prefix(items, params)), params)


def frequent_of(counts: DataFrame, params: FrequencyParams) -> DataFrame:
    """The rows of ``(item, n)`` with float(n) >= phi * n."""
    return counts.filter(F.col("n").cast("float") >= F.lit(params.true_threshold).cast("float"))


def sticky_estimates(counts: DataFrame, params: FrequencyParams) -> DataFrame:
    """``(item)``: the items that sticky counts report."""
    return counts.filter(F.col("n") >= F.lit(params.sticky_threshold)).select("item")


def reservoir_sample(items: DataFrame, params: FrequencyParams, textbook: bool = False) -> DataFrame:
    """``(slot, pos, item)``: the final reservoir of size min(m, n).

    ``textbook=True`` accepts with m/(t+1) instead of the reference's m/t.
    """
    m = params.m
    pos = F.col("pos")
    t = pos + 1 if textbook else pos
    u1 = uniform("pos", TAG_RESERVOIR_ACCEPT, params.seed)
    u2 = uniform("pos", TAG_RESERVOIR_SLOT, params.seed)
    accepted = prefix(items, params).filter((pos < F.lit(m)) | (u1 * t.cast("double") <= F.lit(float(m))))
    slotted = accepted.select(
        F.when(pos < F.lit(m), pos).otherwise(F.floor(u2 * F.lit(float(m)))).cast("bigint").alias("slot"),
        "pos",
        "item",
    )
    return slotted.groupBy("slot").agg(F.max("pos").alias("pos"), F.max_by("item", "pos").alias("item"))


def flag_true(estimated: DataFrame, true_set: DataFrame) -> DataFrame:
    """Add ``flag`` '+' when the item is truly frequent. The true set has at most 1/phi rows, which
    may grow with the stream: Spark broadcasts it when it is small."""
    flagged = true_set.select("item", F.lit(True).alias("_true"))
    return (
        estimated.join(flagged, "item", "left")
        .select("item", F.when(F.col("_true"), F.lit("+")).otherwise(F.lit("-")).alias("flag"))
        .orderBy("item")
    )


def reservoir_frequent_items(items: DataFrame, params: FrequencyParams) -> DataFrame:
    """``(item, flag)``: the distinct items of the reservoir, flagged against the true set, by item."""
    est = reservoir_sample(items, params).select("item").distinct()
    return flag_true(est, true_frequent(items, params))


def sticky_rows(items: DataFrame, params: FrequencyParams) -> DataFrame:
    """``(item, pos, b, acc)``: the block of each row, and whether it would start its item's count."""
    accept = uniform("pos", TAG_STICKY_ACCEPT, params.seed) <= F.lit(params.sticky_p)
    block = F.floor(F.col("pos") / F.lit(STICKY_BLOCK)).cast("bigint")
    return items.select("item", "pos", block.alias("b"), accept.alias("acc"))


def sticky_merge(blocks: DataFrame, rows: DataFrame) -> DataFrame:
    """``(item, n)`` from ``blocks`` ``(item, b, c, p)`` -- counts and first accepted positions per
    item and block, repeated keys allowed -- and ``rows`` ``(item, pos, b)``."""
    first = blocks.groupBy("item").agg(F.min("p").alias("p0")).filter("p0 is not null").withColumn(
        "b0", F.floor(F.col("p0") / F.lit(STICKY_BLOCK)).cast("bigint")
    )
    whole = blocks.join(first, "item").filter("b > b0").groupBy("item").agg(F.sum("c").alias("n"))
    part = (
        rows.join(first.withColumnRenamed("b0", "b"), ["item", "b"]).filter("pos >= p0")
        .groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    )
    return whole.unionByName(part).groupBy("item").agg(F.sum("n").cast("bigint").alias("n"))


def sticky_blocks(rows: DataFrame) -> DataFrame:
    """``(item, b, c, p)`` of ``sticky_rows``: partial aggregates."""
    return rows.groupBy("item", "b").agg(
        F.count(F.lit(1)).alias("c"), F.min(F.when(F.col("acc"), F.col("pos"))).alias("p")
    )


def sticky_counts(items: DataFrame, params: FrequencyParams) -> DataFrame:
    """``(item, n)``: the sticky-sampling hash table at the end of the first n items."""
    rows = sticky_rows(prefix(items, params), params)
    return sticky_merge(sticky_blocks(rows), rows.select("item", "pos", "b"))


def sticky_frequent_items(items: DataFrame, params: FrequencyParams) -> DataFrame:
    """``(item, flag)``: sticky counts >= (long)((phi - epsilon) n), flagged against the true set,
    by item."""
    est = sticky_estimates(sticky_counts(items, params), params)
    return flag_true(est, true_frequent(items, params))


def frequent_items_summary(items: DataFrame, params: FrequencyParams) -> DataFrame:
    """``(method, n_held, n_estimated)``: per method, the items it holds and the items it reports."""
    return method_sizes(
        item_histogram(prefix(items, params)), reservoir_sample(items, params), sticky_counts(items, params), params
    )


def method_sizes(exact: DataFrame, reservoir: DataFrame, sticky: DataFrame, params: FrequencyParams) -> DataFrame:
    """The summary from ``(item, n)``, ``(slot, item)`` and ``(item, n)`` of the three methods."""
    true = F.col("n").cast("float") >= F.lit(params.true_threshold).cast("float")
    rows = (
        ("exact", exact, F.count(F.when(true, True))),
        ("reservoir", reservoir, F.count_distinct("item")),
        ("sticky", sticky, F.count(F.when(F.col("n") >= F.lit(params.sticky_threshold), True))),
    )
    out = [
        df.agg(F.lit(name).alias("method"), F.count(F.lit(1)).alias("n_held"), estimated.alias("n_estimated"))
        for name, df, estimated in rows
    ]
    return out[0].unionByName(out[1]).unionByName(out[2])
