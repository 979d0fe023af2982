"""Mixing sources to target weights by hash-threshold histograms.

Every document has a fixed 60-bit hash of its id. A source takes the documents whose hash lies under
a threshold; a larger budget has a larger threshold, so mixes of growing budgets are nested, and
taking is a filter -- no sort of the documents. The threshold of a source is found from a histogram
of sizes by (source, hash bucket): running sums give the bucket that holds the budget, and only the
rows of that one bucket per source are counted again, in finer buckets, until it holds one hash.

Sums by (source, bucket) are partial aggregates, so a source with a third of all rows sends at most
one row per bucket and task; the join with the cut table never moves the documents while the sources
are within ``BROADCAST_SOURCES`` rows, and else is a join whose skewed keys Spark splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.scratch import Scratch, broadcast_up_to

HASH_BITS = 60
STEP_BITS = 12  # hash bits that one histogram resolves: at most 4096 buckets a source
BROADCAST_SOURCES = 1 << 14

WEIGHTS = (3.0, 1.0, 2.0)  # by rank of the source, repeating
SHARE = 1.5  # of all sizes, what the mix takes in all
MOST = 2.0  # times its source's size, the most a target may be


def word_count(text: Column) -> Column:
    """The number of runs of bytes outside ``[\\x20\\x09-\\x0D]``; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def document_hash(doc_id: Column) -> Column:
    """60 bits of the MD5 of the id; a null id hashes as an empty text."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 15)
    return F.conv(digits, 16, 10).cast("bigint")


def source_targets(
    s: Scratch, sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, size)`` rows, in code point order of the
    source, null last.

    Targets share ``share`` times the sum of sizes by weight; one above ``most`` times its source's
    size stops there and the excess is shared among the others, until none is above. That end is
    target = min(level * weight, most * size), so each round only needs two sums over the sources.
    """
    by = s.keep(sizes.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size")))
    # the rank needs every source in order; per first byte, so that no one task sorts them all
    lead = F.when(F.col("source").isNull(), F.lit(256)).otherwise(
        F.when(F.col("source") == "", F.lit(-1)).otherwise(
            F.conv(F.hex(F.substring(F.encode("source", "utf-8"), 1, 1)), 16, 10).cast("int")
        )
    )
    led = by.withColumn("_lead", lead)
    before = {}
    for r in sorted(led.groupBy("_lead").count().collect()):  # at most 258 rows
        before[r["_lead"]] = sum(n for _, n in before.values()), r["count"]
    offset = F.element_at(F.create_map(*[F.lit(x) for k, (o, _) in before.items() for x in (k, o)]), F.col("_lead")) if before else F.lit(0)
    rank = F.row_number().over(Window.partitionBy("_lead").orderBy("source")) - 1 + offset
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int"))
    table = s.keep(led.select("source", "source_size", weight.alias("weight"), (F.lit(float(most)) * F.col("source_size")).alias("cap")))
    s.drop(by)
    budget = float(share) * (table.agg(F.sum("source_size")).first()[0] or 0)
    level, full = 0.0, -1
    while True:
        over = F.col("cap") <= F.lit(level) * F.col("weight")
        r = table.agg(
            F.sum(F.when(over, F.col("cap"))), F.sum(F.when(~over, F.col("weight"))), F.count(F.when(over, True))
        ).first()
        if r[2] == full or r[1] is None:
            break
        full, level = r[2], max(level, (budget - (r[0] or 0.0)) / r[1])
    return table.select("source", "source_size", F.least(F.col("cap"), F.lit(level) * F.col("weight")).alias("target"))


def thresholds(s: Scratch, docs: DataFrame, targets: DataFrame) -> DataFrame:
    """``(source, source_size, target, whole, low)`` per source, from ``(source, size, h)`` rows.

    Every document of a source is taken ``whole`` = floor(target / source_size) times, and once more
    when its hash is under the threshold ``low``, which leaves the taken sum within half the size of one
    document of the target (rows of one id share their hash, and count as one document). Null
    sources are one source; a source without any size takes nothing.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    cuts = s.keep(targets.select(
        "source", "source_size", "target", whole.alias("whole"),
        (F.col("target") - whole * F.col("source_size")).alias("budget"),
        F.lit(0).cast("bigint").alias("low"),
    ))
    n = cuts.count()
    narrow = docs.select("source", "size", "h").filter("size > 0")
    on = lambda left, right: left.join(broadcast_up_to(right, n, BROADCAST_SOURCES), left["source"].eqNullSafe(right["source"]))
    # low: the hash from which the boundary bucket of this round starts; budget: what is left there
    shift = HASH_BITS
    bound = None  # rows that lie in the boundary bucket of their source
    while shift > 0:
        width = min(STEP_BITS, shift)
        shift -= width
        rows = narrow if bound is None else bound
        c = cuts.select(F.col("source").alias("_s"), "low", "budget")
        j = rows.join(broadcast_up_to(c, n, BROADCAST_SOURCES), rows["source"].eqNullSafe(c["_s"])).filter("budget > 0")
        bucket = F.shiftright(F.col("h") - F.col("low"), shift)
        hist = j.groupBy("_s", "low", "budget", bucket.alias("bucket")).agg(
            F.sum("size").alias("size"), F.min("h").alias("h0"), F.max("h").alias("h1")
        )
        w = Window.partitionBy("_s").orderBy("bucket")  # at most 2^STEP_BITS rows a source
        run = hist.withColumn("after", F.sum("size").over(w)).withColumn("before", F.col("after") - F.col("size"))
        # the first bucket in which the running sum reaches the budget, else none: all is taken
        edge = run.filter("before < budget and after >= budget").select(
            F.col("_s"),
            (F.col("low") + F.shiftleft(F.col("bucket"), shift)).alias("low2"),
            (F.col("budget") - F.col("before")).alias("budget2"),
            "size", "h0", "h1",
        )
        single = F.col("h0") == F.col("h1")
        # one hash left: take it when that comes nearer to the budget
        done_low = F.when(F.col("size") - F.col("budget2") <= F.col("budget2"), F.col("h1") + 1).otherwise(F.col("h0"))
        step = s.keep(edge.select(
            "_s", F.when(single, done_low).otherwise(F.col("low2")).alias("low2"),
            F.when(single, F.lit(0.0)).otherwise(F.col("budget2")).alias("budget2"),
        ))
        none_left = F.when(F.col("budget") > 0, F.lit(1 << HASH_BITS)).otherwise(F.col("low"))
        new = s.keep(
            cuts.join(broadcast_up_to(step, n, BROADCAST_SOURCES), cuts["source"].eqNullSafe(step["_s"]), "left").select(
                "source", "source_size", "target", "whole",
                F.coalesce("budget2", F.lit(0.0)).alias("budget"),
                F.coalesce("low2", none_left).alias("low"),
            )
        )
        s.drop(cuts, step)
        cuts = new
        if cuts.filter("budget > 0").isEmpty():
            break
        c = cuts.filter("budget > 0").select(F.col("source").alias("_s"), F.col("low").alias("_low"))
        j = rows.join(broadcast_up_to(c, n, BROADCAST_SOURCES), rows["source"].eqNullSafe(c["_s"]))
        old, bound = bound, s.keep(j.filter(F.shiftright(F.col("h") - F.col("_low"), shift) == 0).select("source", "size", "h"))
        s.drop(old)
    s.drop(bound)
    return cuts


def take(docs: DataFrame, cuts: DataFrame) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``copies`` (how often the mix takes the
    row); columns of those names are replaced. A filter on hashes: the documents don't move while
    the sources are few."""
    new = ("size", "source_size", "target", "copies")
    c = cuts.select(F.col("source").alias("_s"), "source_size", "target", F.col("whole").alias("_whole"), F.col("low").alias("_cut"))
    rows = docs.drop(*new).withColumn("size", word_count(F.col("text")))
    taken = F.col("_whole") + (document_hash(F.col("doc_id")) < F.col("_cut")).cast("bigint")
    return (
        rows.join(broadcast_up_to(c, cuts.count(), BROADCAST_SOURCES), F.col("source").cast("string").eqNullSafe(F.col("_s")), "left")
        .withColumn("copies", F.when(F.col("size") > 0, taken).otherwise(0))
        .drop("_s", "_whole", "_cut")
    )


def source_cuts(s: Scratch, documents: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Targets and thresholds of every source of ``documents``."""
    rows = s.keep(documents.select(
        F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"), document_hash(F.col("doc_id")).alias("h")
    ))
    cuts = thresholds(s, rows, source_targets(s, rows, weights, share, most))
    s.drop(rows)
    return cuts


def mix_documents(spark, documents: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``(doc_id, source, size, source_size, target, copies, taken)``: one row per document.

    Defined cases: null texts and texts without words have size 0 and are taken 0 times; null
    sources form one source, ranked last; rows of one doc_id (null included) share a decision; an
    empty table gives an empty result. Other columns are not read.
    """
    docs = documents.select("doc_id", "source", "text")
    out = take(docs, source_cuts(Scratch(spark, "mix"), docs, weights, share, most))
    return out.withColumn("taken", F.col("size") * F.col("copies")).drop("text")


def mixed_rows(spark, documents: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """The mix itself: the rows of ``documents``, each as often as it is taken."""
    names = documents.columns
    # kept under other names, as columns of documents may be called like those that take() adds
    safe = documents.select(*[F.col(c) if c in ("doc_id", "source", "text") else F.col(c).alias(f"_{c}") for c in names])
    out = take(safe, source_cuts(Scratch(spark, "mix"), safe, weights, share, most))
    return out.where("copies > 0").withColumn("_n", F.explode(F.expr("sequence(1, cast(copies as int))"))).select(
        *[F.col(c) if c in ("doc_id", "source", "text") else F.col(f"_{c}").alias(c) for c in names]
    )
