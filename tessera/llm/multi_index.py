"""Nearest neighbours by inner product with an inverted multi-index.

Vectors are cut into two halves and each half is quantised by its own codebook, so K + K centroids
make K * K cells. A query scores the centroids of each half once, and a heap walks the cells from the
largest sum of the two scores on -- the pair after (i, j) in the two sorted lists is (i + 1, j) or
(i, j + 1) -- until the cells seen hold the wanted share of all entries. These entries are ranked
anew by the inner product of the whole vectors.

Codebooks are fitted on a sample of at most ``SAMPLE`` vectors, and the share of entries to visit is
the least that finds ``RECALL`` of the true neighbours within that sample; all rows are indexed. Equal
vectors are one entry that keeps its k + 1 smallest ids (more can't be among k neighbours), found by a
row-number limit that Spark applies before its shuffle, so a vector that a third of all rows share is
one entry, and its queries are searched once.

Entries lie in blocks of one first-half centroid and at most about ``CHUNK`` rows. A query goes to the
blocks that hold cells it visits, with the cells; a block and at most about ``SLICE`` queries meet in
one task as a matrix product. Each returns its k + 1 best per query.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.scratch import Scratch

SAMPLE = 16_384
PROBES = 256  # sample vectors that measure recall
RECALL = 0.96
MAX_CENTROIDS = 64  # of a half
CHUNK = 8192
SLICE = 4096
STEP = 256  # queries per matrix product


def scores(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return vectors @ centroids.T


def nearest_centroid(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.argmax(vectors @ centroids.T - 0.5 * (centroids**2).sum(1), axis=1) if len(vectors) else np.empty(0, np.int64)


def codebook(vectors: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """k-means (Lloyd) from distinct rows, the same at every run; empty centroids stay."""
    distinct = np.unique(vectors, axis=0)
    c = distinct[np.random.default_rng(7).permutation(len(distinct))[:k]].copy()
    for _ in range(rounds):
        near = nearest_centroid(vectors, c)
        sums = np.zeros_like(c)
        np.add.at(sums, near, vectors)
        n = np.bincount(near, minlength=len(c))
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


def walk(first: np.ndarray, second: np.ndarray, counts: np.ndarray, wanted: int) -> list[tuple[int, int]]:
    """Non-empty cells in order of the summed scores, until they hold ``wanted`` entries."""
    one, two = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    a, b = first[one].tolist(), second[two].tolist()
    rows, cols = one.tolist(), two.tolist()
    heap, reached, out, held = [(-(a[0] + b[0]), 0, 0)], [0] * len(a), [], 0
    # reached[i]: cells of row i taken; (i, j) enters when (i, j - 1) and, for j = 0, (i - 1, 0) are out
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        reached[i] = j + 1
        if n := counts[rows[i], cols[j]]:
            out.append((rows[i], cols[j]))
            held += n
        if j + 1 < len(b) and (i == 0 or reached[i - 1] > j + 1):
            heapq.heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))
        if i + 1 < len(a) and reached[i + 1] == j:
            heapq.heappush(heap, (-(a[i + 1] + b[j]), i + 1, j))
    return out


class Index:
    """Codebooks and the share of entries that a query visits."""

    def __init__(self, sample: np.ndarray, k: int):
        n, d = sample.shape
        self.half = d // 2
        size = max(1, min(MAX_CENTROIDS, int(n**0.5 / 2)))
        self.books = [codebook(sample[:, : self.half], size), codebook(sample[:, self.half :], size)]
        self.share = self._share(sample, k)

    def codes(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return nearest_centroid(v[:, : self.half], self.books[0]), nearest_centroid(v[:, self.half :], self.books[1])

    def half_scores(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return scores(v[:, : self.half], self.books[0]), scores(v[:, self.half :], self.books[1])

    def _share(self, sample: np.ndarray, k: int) -> float:
        """The least share of the sample's entries, in steps of 1/64, that finds RECALL of the k
        best; one step more for what the sample may hide."""
        if len(sample) <= 4 * k:
            return 1.0
        asked = np.random.default_rng(11).permutation(len(sample))[:PROBES]
        c1, c2 = self.codes(sample)
        width = len(self.books[1])
        count = np.bincount(c1 * width + c2, minlength=len(self.books[0]) * width)
        s1, s2 = self.half_scores(sample[asked])
        need = []
        for q, x, y in zip(asked, s1, s2):
            s = sample @ sample[q]
            s[q] = -np.inf
            best = np.argpartition(-s, k)[:k]
            order = np.argsort(-(x[:, None] + y[None, :]).ravel(), kind="stable")
            before = np.empty(len(order), np.int64)
            before[order] = np.cumsum(count[order])
            need.append(before[c1[best] * width + c2[best]] / len(sample))
        found = np.sort(np.concatenate(need))
        least = found[min(len(found) - 1, int(np.ceil(RECALL * len(found))))]
        return float(min(1.0, (np.ceil(least * 64) + 1) / 64))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def valid_vectors(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(vec_id, v)``: rows with an id whose vector has the table's most frequent length (of equally
    frequent ones the largest), is not zero, and has finite components only."""
    v = F.col(vec_col)
    good = rows.filter(F.col(id_col).isNotNull() & v.isNotNull()).select(F.col(id_col).cast("bigint").alias("vec_id"), v.cast("array<double>").alias("v"))
    good = good.filter(
        F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("v", lambda x: x != 0)
    )
    most = good.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return good.filter(F.size("v") == (most["d"] if most else 0))


def search(spark, rows: DataFrame, asked, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row whose id satisfies ``asked`` (a function of
    the id column) its k entries found nearest, nearest first, ties to the smaller id.

    Rows that ``valid_vectors`` leaves out take no part. Fewer than k candidates: all of them. Rows
    that repeat an id and its vector are one candidate; a query leaves out every candidate of its id. An
    empty table gives an empty result.
    """
    s = Scratch(spark, "imi")
    empty = "query_id bigint, rank int, vec_id bigint, score double"
    valid = s.keep(valid_vectors(rows, id_col, vec_col).distinct())
    rn = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    entries = s.keep(
        valid.withColumn("rn", rn).filter(F.col("rn") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .withColumn("c", F.monotonically_increasing_id())
    )
    sample = entries.select("v").orderBy(F.xxhash64("v"), "v").limit(SAMPLE).toPandas()["v"]  # at most SAMPLE rows
    if not len(sample):
        return spark.createDataFrame([], empty)
    index = Index(_matrix(sample), k)

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                pdf["c1"], pdf["c2"] = index.codes(_matrix(pdf["v"]))
                yield pdf

    indexed = s.keep(entries.mapInPandas(coded, "v array<double>, ids array<bigint>, c bigint, c1 int, c2 int"))
    counts = np.zeros((len(index.books[0]), len(index.books[1])), np.int64)
    for r in indexed.groupBy("c1", "c2").count().collect():  # at most K * K rows
        counts[r["c1"], r["c2"]] = r["count"]
    total = int(counts.sum())
    wanted = max(4 * (k + 1), int(np.ceil(index.share * total)))
    blocks = [max(1, -(-int(n) // CHUNK)) for n in counts.sum(1)]
    queries = s.keep(
        valid.filter(asked(F.col("vec_id"))).select(F.col("vec_id").alias("query_id"), "v").distinct().join(entries.select("v", "c"), "v")
        .select("query_id", F.col("c").alias("q"))
    )
    own = s.keep(queries.select("q").distinct().join(indexed.select(F.col("c").alias("q"), "v"), "q"))
    slices = max(1, -(-own.count() // SLICE))

    def probes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), STEP):
                part, made = pdf.iloc[at : at + STEP], []
                s1, s2 = index.half_scores(_matrix(part["v"]))
                for q, v, x, y in zip(part["q"], part["v"], s1, s2):
                    cells: dict[int, list[int]] = {}
                    for i, j in walk(x, y, counts, wanted):
                        cells.setdefault(i, []).append(j)
                    made += [(q, v, i, b, js) for i, js in cells.items() for b in range(blocks[i])]
                yield pd.DataFrame(made, columns=["q", "v", "c1", "block", "cells"])

    sent = own.mapInPandas(probes, "q bigint, v array<double>, c1 int, block int, cells array<int>").withColumn(
        "slice", F.pmod(F.xxhash64("q"), F.lit(slices)).cast("int")
    )
    block = F.pmod(F.xxhash64("c"), F.element_at(F.array(*[F.lit(b) for b in blocks]), F.col("c1") + 1).cast("bigint")).cast("int")
    placed = indexed.select("c1", "c2", "v", "c", F.element_at("ids", 1).alias("least"), block.alias("block")).withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    width = len(index.books[1])

    def ranked(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            e, c2, ids, least = _matrix(left["v"]), left["c2"].to_numpy(), left["c"].to_numpy(), left["least"].to_numpy()
            # the product's last bits may differ from the exact score's
            margin = 4 * e.shape[1] * np.finfo(float).eps * np.sqrt((e * e).sum(axis=1).max())
            for at in range(0, len(right), STEP):
                part = right.iloc[at : at + STEP]
                x = _matrix(part["v"])
                seen = np.zeros((len(part), width), bool)
                for i, cells in enumerate(part["cells"]):
                    seen[i, cells] = True
                near = np.where(seen[:, c2], x @ e.T, -np.inf)
                last = min(k + 1, near.shape[1])
                bound = np.partition(-near, last - 1, axis=1)[:, last - 1]
                for i, q in enumerate(part["q"]):
                    # all that tie with the (k + 1)-th; of equal scores the entries of smaller ids stay
                    pick = np.flatnonzero((near[i] > -np.inf) & (near[i] >= -bound[i] - 2 * margin * np.sqrt((x[i] * x[i]).sum())))
                    exact = (e[pick] * x[i]).sum(axis=1)
                    order = np.lexsort((least[pick], -exact))[: k + 1]
                    out.append((q, ids[pick][order].tolist(), exact[order].tolist()))
        return pd.DataFrame(out, columns=["q", "c", "score"])

    keys = ["c1", "block", "slice"]
    found = placed.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInPandas(ranked, "q bigint, c array<bigint>, score array<double>")
    flat = found.select("q", F.explode(F.arrays_zip("c", "score")).alias("e")).select("q", F.col("e.c").alias("c"), F.col("e.score").alias("score"))
    # the entries of the k + 1 best scores are enough: each holds an id, and only the query's own goes
    close = flat.withColumn("r", F.rank().over(Window.partitionBy("q").orderBy(F.desc("score")))).filter(F.col("r") <= k + 1).drop("r")
    members = close.join(entries.select("c", "ids"), "c").select("q", "score", F.explode("ids").alias("vec_id"))
    top = members.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))).filter(F.col("r") <= k + 1)
    pairs = queries.join(s.keep(top.drop("r")), "q").filter("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
