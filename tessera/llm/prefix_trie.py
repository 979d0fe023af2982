"""Prefix trie of conversations by whole-sequence collapse.

Conversations of equal turns are one weighted sequence. What is a prefix of what is a matter of
prefix identifiers: that of depth d is the SHA-256 of the one of depth d - 1 and the turn's own
digest, so two conversations share a node exactly if they share an identifier. Sequences that are
proper prefixes of others drop out by an anti-join and the rest are the leaves; every node is a
prefix of a sequence, and its numbers are sums over the weighted sequences that start with it,
partially aggregated, so that the root or a first turn that most conversations share sends a row per
task.

Sums over subtrees need no walk over the tree. A node belongs to the sequence of its smallest member;
the nodes that a sequence owns are the deep end of its path, from a depth k on. The bytes of a subtree's
nodes are therefore, per sequence below it, the bytes of the sequence's turns from depth k on, or from
the node's own depth if that is deeper: one more sum over sequences.

Turns move as 32-byte digests and sizes. A conversation is one row with an array of them (40 bytes a
turn); the texts never leave the scan.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.scratch import Scratch

FAMILY = 5  # conversations that may share a start
STARTS = 9  # a start has fewer turns than this
CHUNK_IDS = 1 << 16  # conversation ids of one piece of an end list
BATCH_ROWS = 1 << 15  # prefixes that a task yields at once
ROOT = hashlib.sha256(b"").digest()


def turn_digest(role: Column, text: Column) -> Column:
    """32 bytes that tell a turn; the role's length parts it from the text."""
    return F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))


def start_length(conv_id: Column) -> Column:
    """How many turns of its family's first conversation a conversation starts with."""
    return F.pmod(F.crc32(conv_id.cast("string").cast("binary")), F.lit(STARTS)).cast("int")


def sequences(turns: DataFrame) -> DataFrame:
    """``(conv_id, digests, sizes)``: each conversation's turns in order, null turn numbers first, equal
    ones by digest. Rows without a conv_id belong to no conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    row = F.struct(F.col("turn").isNotNull().alias("k"), F.col("turn").alias("t"), turn_digest(role, text).alias("d"), F.octet_length(text).cast("bigint").alias("b"))
    listed = turns.filter("conv_id is not null").groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("r"))
    return listed.select("conv_id", F.col("r.d").alias("digests"), F.col("r.b").alias("sizes"))


def rebuilt(own: DataFrame) -> DataFrame:
    """Each conversation with the first h original turns of the first conversation of its family in
    place of its own first h; without that conversation none takes their place."""
    heads = own.filter(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("first"), F.slice("digests", 1, STARTS - 1).alias("head"), F.slice("sizes", 1, STARTS - 1).alias("head_sizes")
    )
    asked = own.withColumn("h", start_length(F.col("conv_id"))).withColumn("first", F.col("conv_id") - F.col("conv_id") % FAMILY)

    def put(head: str, tail: str, kind: str) -> Column:
        start = F.slice(F.coalesce(head, F.array().cast(kind)), F.lit(1), F.col("h"))
        return F.concat(start, F.slice(tail, F.col("h") + 1, F.greatest(F.size(tail) - F.col("h"), F.lit(0))))

    return asked.join(heads, "first", "left").select(
        "conv_id", put("head", "digests", "array<binary>").alias("digests"), put("head_sizes", "sizes", "array<bigint>").alias("sizes")
    )


def collapsed(s: Scratch, convs: DataFrame) -> DataFrame:
    """``(key, first, weight, digests, sizes)``: a row per different sequence, with its smallest
    conversation and how many it stands for."""
    groups = convs.groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("weight"))
    return s.keep(groups.join(convs.select("conv_id", "digests", "sizes"), "conv_id").withColumnRenamed("conv_id", "first"))


def prefixes(seqs: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """``(id, parent, depth, size, tail, last, first, *extra)``: a row per sequence and prefix, the root's
    included; tail: bytes of the turns from this prefix's last one on (of all turns, at the root)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["id", "parent", "depth", "size", "tail", "last", "first", *extra]
        for pdf in batches:
            rows = []
            for digests, sizes, *values in zip(pdf["digests"], pdf["sizes"], pdf["first"], *[pdf[c] for c in extra]):
                left = int(np.sum(sizes)) if len(sizes) else 0
                ids, n = (None, ROOT), len(digests)
                rows.append((ROOT, None, 0, 0, left, n == 0, *values))
                for depth, (d, b) in enumerate(zip(digests, sizes), 1):
                    ids = (ids[1], hashlib.sha256(ids[1] + bytes(d)).digest())
                    rows.append((ids[1], ids[0], depth, int(b), left, depth == n, *values))
                    left -= int(b)
                    if len(rows) >= BATCH_ROWS:
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
            if rows:
                yield pd.DataFrame(rows, columns=names)

    schema = "id binary, parent binary, depth bigint, size bigint, tail bigint, last boolean, first bigint"
    return seqs.select("digests", "sizes", "first", *extra).mapInPandas(run, ", ".join([schema, *[f"{c} bigint" for c in extra]]))


def end_lists(convs: DataFrame) -> DataFrame:
    """``(key, ends_sha256)``: per sequence the digest of its conversation ids, ascending, comma-joined.

    A digest is taken in order, so one task has to read a sequence's whole list, however many share it.
    It reads pieces of ``CHUNK_IDS`` ids that tasks with a slice each of the sorted ids have joined before, and holds
    one batch of them at a time.
    """

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = {"key": None, "ids": []}

        def out() -> pd.DataFrame:
            return pd.DataFrame({"key": [held["key"]], "start": [held["ids"][0]], "ids": [",".join(map(str, held["ids"]))]})

        for pdf in batches:
            done = []
            for key, i in zip(pdf["key"], pdf["conv_id"].tolist()):
                if held["ids"] and (key != held["key"] or len(held["ids"]) >= CHUNK_IDS):
                    done.append(out())
                    held["ids"] = []
                held["key"] = key
                held["ids"].append(i)
            if done:
                yield pd.concat(done)
        if held["ids"]:
            yield out()

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, sha = None, None
        for pdf in batches:
            done = []
            for key, ids in zip(pdf["key"], pdf["ids"]):
                if key != now:
                    if now is not None:
                        done.append((now, sha.hexdigest()))
                    now, sha = key, hashlib.sha256(ids.encode())
                else:
                    sha.update(f",{ids}".encode())
            if done:
                yield pd.DataFrame(done, columns=["key", "ends_sha256"])
        if now is not None:
            yield pd.DataFrame([(now, sha.hexdigest())], columns=["key", "ends_sha256"])

    ordered = convs.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    joined = ordered.mapInPandas(pieces, "key string, start bigint, ids string")
    return joined.repartition("key").sortWithinPartitions("key", "start").mapInPandas(digests, "key string, ends_sha256 string")


def build_trie(spark, conversations: DataFrame) -> DataFrame:
    """``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, is_leaf)``,
    one row per node of the trie of rebuilt conversations.

    Null roles and texts are empty; rows without a conv_id are no conversation's; null turn numbers
    come first and equal ones in the order of their digests; repeated rows are repeated turns. Only the four
    columns of the table are read, whatever others there are. A turnless rebuilt conversation is a member
    and an end of the root. Without conversations there is no root and no row. Long conversations are
    one row of 40 bytes a turn.
    """
    s = Scratch(spark, "trie")
    own = s.keep(sequences(conversations))
    convs = s.keep(rebuilt(own).withColumn("key", F.sha2(F.array_join(F.transform("digests", F.hex), "").cast("binary"), 256)))
    s.drop(own)
    seqs = collapsed(s, convs)
    paths = s.keep(prefixes(seqs).select("id", "last", "first"))
    inner = paths.filter("not last").select("id").distinct()
    ends = s.keep(paths.filter("last").select("id", "first"))
    leaves = ends.join(inner, "id", "left_anti").select("first", F.lit(1).cast("bigint").alias("leaf"))
    marked = s.keep(seqs.join(leaves, "first", "left").withColumn("leaf", F.coalesce("leaf", F.lit(0).cast("bigint"))))
    nodes = s.keep(
        prefixes(marked, ("weight", "leaf")).groupBy("id", "parent", "depth", "size").agg(
            F.min("first").alias("conv_id"), F.sum("weight").alias("n_convs"), F.sum("leaf").alias("n_leaves"),
            F.sum(F.col("weight") * F.col("tail")).alias("all_bytes"),
        )
    )
    # from depth k on, a sequence owns the nodes of its path; a sequence that owns none is no node's smallest member
    owned = s.keep(nodes.groupBy(F.col("conv_id").alias("first")).agg(F.min("depth").alias("k")))
    cut = s.keep(marked.join(owned, "first").withColumn("k", F.col("k").cast("bigint")))
    path = prefixes(cut, ("k",))
    # the tail at k, for prefixes above it: each owner's row of depth k
    at_k = path.filter("depth = k").select("first", F.col("tail").alias("tail_k"))
    once = s.keep(
        path.join(at_k, "first").groupBy("id").agg(F.sum(F.when(F.col("depth") >= F.col("k"), F.col("tail")).otherwise(F.col("tail_k"))).alias("bytes"))
    )
    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n_children"))
    # a node that isn't the first its owner has hangs below the same owner
    tops = nodes.join(owned.withColumnRenamed("first", "conv_id"), "conv_id").filter("depth = k and parent is not null")
    above = tops.select(F.col("id").alias("child"), "parent").join(nodes.select(F.col("id").alias("parent"), F.col("conv_id").alias("above")), "parent")
    above = s.keep(above.select(F.col("child").alias("id"), "above"))
    by_end = ends.join(seqs.select("first", "key"), "first").join(end_lists(convs), "key").select("id", "ends_sha256")
    joined = nodes.join(once, "id").join(children, "id", "left").join(above, "id", "left").join(by_end, "id", "left")
    zero = F.lit(0).cast("bigint")
    return joined.select(
        "conv_id", "depth",
        F.when(F.col("parent").isNotNull(), F.coalesce("above", "conv_id")).alias("parent_conv_id"),
        "n_convs", F.coalesce("n_children", zero).alias("n_children"), "n_leaves",
        (F.col("all_bytes") - F.col("bytes")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        F.col("n_children").isNull().alias("is_leaf"),
    )
