"""Sharding by k-d tree partitioning of document metadata.

The tree starts with one node of all documents and splits nodes until every leaf holds about the
target bytes. A node is cut along its widest metadata dimension (extent over the whole table's
extent) at a weighted median: the value below which the share of bytes lies that its left leaves
should get. Values are ordered by (dimension, text hash, document hash), so a cut can pass between
documents of one value, and equal texts stay together unless that would unbalance the leaves.

Medians are found by histograms: all nodes of a level are counted at once by (node, bucket), partial
aggregates that send at most ``BUCKETS`` rows per node and task, and only the bucket that holds the
cut is counted again in finer buckets. Nothing is sorted and no document moves. What the driver
holds is the tree, one row per leaf at most, and ``BUCKETS`` sums per open node.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.scratch import Scratch

BUCKETS = 512
MAX_LEAVES = 1 << 12  # of one tree; its nodes and BUCKETS sums per open node pass through the driver
SLACK = 1 / 512  # of the target bytes, how far a cut may lie from the median
GROUP_SLACK = 1 / 64  # the same, to keep equal texts together
SLOT_ROWS = 1 << 14  # rows that one task numbers

ORDER = ("_d", "_t", "_i")  # dimension value, text hash, document hash


@dataclass
class Node:
    first: int  # leaf numbers first .. first + leaves - 1
    leaves: int
    size: int = 0
    dim: str = ""
    at: list = field(default_factory=list)  # exact values of ORDER's leading columns so far
    span: tuple = (0, 0)  # open range of the next column
    left: float = 0.0  # bytes that the cut should have on its left within the range
    cut: tuple | None = None


def assign(s: Scratch, points: DataFrame, dims: list[str], size: str, leaves: int) -> DataFrame:
    """``points`` with ``shard`` from 0 to ``leaves`` - 1, of near equal sums of ``size``.

    ``points`` has bigint columns ``dims`` (null counts as the least value less one), ``_t`` and
    ``_i``; ``size`` is positive.
    """
    if not 1 <= leaves <= MAX_LEAVES:
        raise ValueError(f"leaves must be in 1..{MAX_LEAVES}")
    total = points.agg(F.sum(size), *[f(d) for d in dims for f in (F.min, F.max)]).first()
    whole = total[0] or 0
    extent = {d: max(1, (total[2 + 2 * i] or 0) - (total[1 + 2 * i] or 0)) for i, d in enumerate(dims)}
    least = {d: (total[1 + 2 * i] or 0) - 1 for i, d in enumerate(dims)}
    # the range of shards a row can still be in
    rows = points.select("*", *[F.coalesce(F.col(d), F.lit(least[d])).alias(f"_v_{d}") for d in dims], F.lit(0).alias("_node"))
    nodes = [Node(0, leaves)]
    while any(n.leaves > 1 for n in nodes):
        rows = s.keep(rows)
        nodes = {n.first: n for n in nodes if n.leaves > 1}
        stats = rows.filter(F.col("_node").isin(list(nodes))).groupBy("_node").agg(
            F.sum(size).alias("size"), *[f(f"_v_{d}").alias(f"{a}_{d}") for d in dims for a, f in (("lo", F.min), ("hi", F.max))]
        )
        for r in stats.collect():  # a row per open node
            n = nodes[r["_node"]]
            n.size = r["size"]
            n.dim = max(dims, key=lambda d: ((r[f"hi_{d}"] - r[f"lo_{d}"]) / extent[d], -dims.index(d)))
            n.span = (r[f"lo_{n.dim}"], r[f"hi_{n.dim}"])
            n.left = n.size * (n.leaves // 2) / n.leaves
        for n in nodes.values():
            if not n.size:  # no rows: nothing to cut
                n.dim, n.cut = dims[0], ()
        target = whole / leaves
        while open_ := [n for n in nodes.values() if n.cut is None]:
            _refine(rows, open_, size, target)
        old = rows
        rows = _descend(rows, nodes)
        split = []
        for n in nodes.values():
            k = n.leaves // 2
            split += [Node(n.first, k), Node(n.first + k, n.leaves - k)]
        nodes = split
        rows = s.keep(rows)
        s.drop(old)
    return rows.withColumnRenamed("_node", "shard").drop(*[f"_v_{d}" for d in dims])


def _table(rows: DataFrame, nodes: list[Node], columns: dict) -> DataFrame:
    """A value per node (of at most MAX_LEAVES) as columns of ``rows``, by a broadcast join."""
    spark = rows.sparkSession
    made = [(n.first, *[f(n) for f, _ in columns.values()]) for n in nodes]
    schema = "_n int, " + ", ".join(f"{c} {t}" for c, (_, t) in columns.items())
    return rows.join(F.broadcast(spark.createDataFrame(made, schema)), F.col("_node") == F.col("_n")).drop("_n")


def _refine(rows: DataFrame, nodes: list[Node], size: str, target: float) -> None:
    """One histogram over the open range of each node; sets ``cut`` or narrows the range."""
    dims = sorted({n.dim for n in nodes})
    value = F.when(F.col("_k") == 1, F.col("_t")).when(F.col("_k") == 2, F.col("_i"))
    for d in dims:
        value = value.when(F.col("_dim") == d, F.col(f"_v_{d}"))
    own = F.lit(None).cast("bigint")
    for d in dims:
        own = F.when(F.col("_dim") == d, F.col(f"_v_{d}")).otherwise(own)
    pad = lambda n, i: n.at[i] if len(n.at) > i else None
    j = _table(rows, nodes, {
        "_dim": (lambda n: n.dim, "string"), "_k": (lambda n: len(n.at), "int"), "_lo": (lambda n: n.span[0], "bigint"),
        "_hi": (lambda n: n.span[1], "bigint"), "_step": (lambda n: _step(n), "bigint"),
        "_a0": (lambda n: pad(n, 0), "bigint"), "_a1": (lambda n: pad(n, 1), "bigint"),
    }).withColumn("_x", value)
    inside = (F.col("_x").between(F.col("_lo"), F.col("_hi"))
              & (F.col("_a0").isNull() | (own == F.col("_a0"))) & (F.col("_a1").isNull() | (F.col("_t") == F.col("_a1"))))
    bucket = F.expr("(_x - _lo) div _step")
    hist = j.filter(inside).groupBy("_node", bucket.alias("b")).agg(
        F.sum(size).alias("w"), F.min("_x").alias("x0"), F.max("_x").alias("x1")
    )
    by: dict[int, list] = {}
    for r in hist.collect():  # at most BUCKETS rows per open node
        by.setdefault(r["_node"], []).append((r["b"], r["w"], r["x0"], r["x1"]))
    for n in nodes:
        _choose(n, sorted(by.get(n.first, [])), target)


def _step(n: Node) -> int:
    return max(1, -(-(n.span[1] - n.span[0] + 1) // BUCKETS))


def _choose(n: Node, buckets: list, target: float) -> None:
    before = 0.0
    for _, w, x0, x1 in buckets:
        if before + w >= n.left:
            break
        before += w
    else:  # the share lies behind all rows of the range
        n.cut = (*n.at, buckets[-1][3]) if buckets else (*n.at, n.span[1])
        return
    under, over = n.left - before, before + w - n.left
    slack = (GROUP_SLACK if x0 == x1 and len(n.at) == 1 else SLACK) * target
    if min(under, over) <= slack or x0 == x1 and len(n.at) == 2:
        # up to and with x1, or up to the value before x0; the nearer, but neither side may be empty
        n.cut = (*n.at, x1) if over <= under else (*n.at, x0 - 1)
    elif x0 == x1:
        n.at, n.left = [*n.at, x0], under
        n.span = (0, (1 << 62) - 1)
    else:
        n.span, n.left = (x0, x1), under


def _descend(rows: DataFrame, nodes: dict[int, Node]) -> DataFrame:
    """Each row to the left or the right child of its node."""
    dims = sorted({n.dim for n in nodes.values()})
    own = F.lit(None).cast("bigint")
    for d in dims:
        own = F.when(F.col("_dim") == d, F.col(f"_v_{d}")).otherwise(own)
    top = (1 << 62)
    get = lambda n, i: n.cut[i] if len(n.cut or ()) > i else top
    j = rows.join(
        F.broadcast(rows.sparkSession.createDataFrame(
            [(n.first, n.dim, n.first + n.leaves // 2, get(n, 0), get(n, 1), get(n, 2)) for n in nodes.values()],
            "_n int, _dim string, _right int, _c0 bigint, _c1 bigint, _c2 bigint",
        )), F.col("_node") == F.col("_n"), "left",
    )
    # (value, text hash, document hash) <= (cut); a cut of fewer columns takes all rows of its last value
    goes_left = (own < F.col("_c0")) | ((own == F.col("_c0")) & (
        (F.col("_t") < F.col("_c1")) | ((F.col("_t") == F.col("_c1")) & (F.col("_i") <= F.col("_c2")))))
    node = F.when(F.col("_n").isNull() | goes_left, F.col("_node")).otherwise(F.col("_right"))
    return j.withColumn("_node", node).drop("_n", "_dim", "_right", "_c0", "_c1", "_c2")


def slots(s: Scratch, rows: DataFrame, group: str, order: list[str], hashed: str) -> DataFrame:
    """``slot``: 0, 1, ... within each ``group``, without gaps.

    Rows are numbered in chunks of about ``SLOT_ROWS`` (by ``hashed``, 0 .. 2^62 - 1), and each chunk
    starts at the count of the group's chunks before it, so no task numbers a whole group.
    """
    parts = max(1, rows.count() // SLOT_ROWS + 1)
    chunked = rows.withColumn("_chunk", F.pmod(F.col(hashed), F.lit(parts)))
    counts = chunked.groupBy(group, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    start = s.keep(counts.select(group, "_chunk", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_start")))
    own = Window.partitionBy(group, "_chunk").orderBy(*order)
    numbered = chunked.withColumn("_own", F.row_number().over(own) - 1)
    return numbered.join(start, [group, "_chunk"]).withColumn("slot", (F.col("_start") + F.col("_own")).cast("bigint")).drop(
        "_start", "_own", "_chunk"
    )


def shard_documents(spark, documents: DataFrame, target_bytes: int | None = None, leaves: int | None = None) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)``, one row per document.

    size = UTF-8 bytes of the text (null: none) plus 1. Give ``leaves``, or ``target_bytes`` per
    shard. Shards' sizes differ by few per cent, or by the size of one document where that is more;
    equal texts share a shard unless that would unbalance it by more than ``GROUP_SLACK``. The
    dimensions are size, characters and source and language (by their order codes). Rows that agree
    in text and doc_id stay together. Null ids, texts and metadata are values like any other; an
    empty table gives an empty result.
    """
    s = Scratch(spark, "kd")
    code = lambda c: F.conv(F.hex(F.rpad(F.substring(F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary"), 1, 7), 7, b"\0")), 16, 10).cast("bigint")
    text = F.col("text")
    points = s.keep(documents.select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.coalesce(F.length(text), F.lit(-1)).cast("bigint").alias("chars"),
        code("source").alias("source_code"), code("lang").alias("lang_code"),
        F.shiftrightunsigned(F.xxhash64(text), 2).alias("_t"),
        F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("doc")), 2).alias("_i"),
    ))
    if leaves is None:
        whole = points.agg(F.sum("size")).first()[0] or 1
        leaves = max(1, -(-whole // int(target_bytes)))
    placed = assign(s, points, ["size", "chars", "source_code", "lang_code"], "size", leaves)
    out = slots(s, placed, "shard", ["_i", "doc_id", "text_crc32"], "_i")
    return out.select("doc_id", "size", "text_crc32", "shard", "slot")
