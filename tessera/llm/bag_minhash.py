"""Near-duplicate groups by BagMinHash signatures, banding and verification.

A text is the multiset of its five-word shingles; texts are near duplicates when the weighted Jaccard
similarity of their multisets (sum of smaller counts / sum of larger counts) is 0.8 or more.

Signatures. Each shingle owns Poisson processes of points in time, one for each dyadic range of
weights (0,1], (1,2], (2,4], ..., with a rate of the range's length for every signature component. A
point of a range falls on one unit of it, and counts for a text whose multiplicity of the shingle
reaches that unit; so ranges above the multiplicity are never visited, however large it is. A
component is the earliest point it gets; it agrees between two texts with the probability of their
weighted Jaccard similarity. Points come in ascending time, and a shingle stops when its time is
behind the latest component so far: few points per shingle are made. All texts of a batch advance
together in numpy.

Search. Texts of equal words are one class, and only classes go on. Signatures are cut into bands;
classes that agree in a band share a bucket. Buckets of up to ``PAIR_BUCKET`` classes give all their
pairs. Larger ones are first probed from one member each: what verifies is linked, and as near copies
share many buckets, each with its own probe, linear work makes most of thousands of near copies one
component. Then each member outside its bucket's largest component is held against all members of
other components, so that no link between components is missed: in blocks of members, whose shingles'
postings give the overlaps with a block at once, not pair by pair. All similarities are exact, on the
whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.components import TASK_ROWS, components
from tessera.llm.scratch import Scratch, text_column

WORDS = 5
SIMILAR = 0.8
BANDS, ROWS = 25, 5  # a pair of similarity 0.8 shares no band with probability 5e-5
PAIR_BUCKET = 32
OUT_BLOCK, MEMBER_BLOCK = 128, 512  # texts of the two sides of a block
BATCH_BYTES = 1 << 21

GOLDEN, MIX1, MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer."""
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


def shingles(text: str, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Distinct shingle hashes and their counts, and a digest of the word sequence. A text of fewer
    words is one shingle of them all; one without words has none."""
    tokens = text.lower().encode("utf-8", "replace").split()
    digest = xxhash.xxh3_128_digest(b" ".join(tokens))
    if not tokens:
        return np.empty(0, np.uint64), np.empty(0, np.int64), digest
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    k = min(words, len(h))
    out = np.zeros(len(h) - k + 1, np.uint64)
    for i in range(k):
        out = mixed(out * GOLDEN + h[i : len(h) - k + 1 + i])
    s, n = np.unique(out, return_counts=True)
    return s, n, digest


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], m: int = BANDS * ROWS) -> np.ndarray:
    """BagMinHash signatures, a row of ``m`` point ids per (shingles, counts); all zero without."""
    docs = len(sets)
    ids, best = np.zeros(docs * m, np.uint64), np.full(docs * m, np.inf)
    e = np.concatenate([s for s, _ in sets]) if sets else np.empty(0, np.uint64)
    w = np.concatenate([n for _, n in sets]) if sets else np.empty(0, np.int64)
    doc = np.repeat(np.arange(docs), [len(s) for s, _ in sets]) if sets else np.empty(0, np.int64)
    # the processes: (element, range), a range being (low, low + length]
    seeds, lows, lengths, weights, owner = [mixed(e)], [np.zeros(len(e), np.int64)], [np.ones(len(e), np.int64)], [w], [doc]
    low = 1
    while (more := np.flatnonzero(w > low)).size:
        seeds.append(mixed(e[more] + np.full(len(more), low, np.uint64) * GOLDEN))
        lows.append(np.full(len(more), low))
        lengths.append(np.full(len(more), low))
        weights.append(w[more])
        owner.append(doc[more])
        low *= 2
    seed, low, length, w, doc = (np.concatenate(x) for x in (seeds, lows, lengths, weights, owner))
    time, turn = np.zeros(len(seed)), 0
    while len(seed):
        turn += 1
        z = mixed(seed + np.full(1, turn, np.uint64) * GOLDEN)
        z2 = mixed(z ^ MIX1)
        time = time - np.log((np.right_shift(z, np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / (m * length)
        slot = doc * m + ((z2 >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        unit = low + 1 + ((z2 & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0**-32 * length).astype(np.int64)
        hit = unit <= w
        if hit.any():
            at, t, point = slot[hit], time[hit], z[hit]
            np.minimum.at(best, at, t)
            first = best[at] == t
            ids[at[first]] = point[first]
        late = best.reshape(docs, m).max(axis=1)
        on = time < late[doc]
        if not on.all():
            seed, low, length, w, doc, time = seed[on], low[on], length[on], w[on], doc[on], time[on]
    return ids.reshape(docs, m)


def bands(ids: np.ndarray, count: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """A key per band of each signature."""
    part = ids.reshape(len(ids), count, rows)
    key = np.zeros(part.shape[:2], np.uint64) + np.arange(1, count + 1, dtype=np.uint64) * GOLDEN
    for i in range(rows):
        key = mixed(key + part[:, :, i]) * GOLDEN
    return key.astype(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity; of two texts without shingles 1, of one such 0."""
    total = int(a[1].sum() + b[1].sum())
    if not total:
        return 1.0
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(a[1][i], b[1][j]).sum())
    return shared / (total - shared)


def sign_documents(documents: DataFrame) -> DataFrame:
    """``(doc_id, th, key, bands)`` per row: a hash of the text, the digest of the word sequence and the
    band keys (null without words)."""
    source = documents.select("doc_id", text_column(documents).alias("text")).withColumn("th", F.xxhash64("text"))
    schema = f"doc_id {source.schema['doc_id'].dataType.simpleString()}, th bigint, key binary, bands array<bigint>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            at, texts = 0, pdf["text"].tolist()
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end]) <= BATCH_BYTES):
                    size += len(texts[end])
                    end += 1
                made = [shingles(t) for t in texts[at:end]]
                keys = bands(signatures([x[:2] for x in made]))
                part = pdf.iloc[at:end][["doc_id", "th"]].copy()
                part["key"] = [x[2] for x in made]
                part["bands"] = [k.tolist() if len(x[0]) else None for k, x in zip(keys, made)]
                yield part
                at = end

    return source.mapInPandas(run, schema)


def verified(pairs: DataFrame, texts: DataFrame, least: float = SIMILAR) -> DataFrame:
    """The ``(a, b)`` of ``pairs`` whose texts ``(c, text)`` have at least that similarity."""
    one = texts.select(F.col("c").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("c").alias("b"), F.col("text").alias("text_b"))
    source = pairs.join(two, "b").join(one, "a").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, sa = None, None
        for pdf in batches:
            ok = []
            for a, ta, tb in zip(pdf["a"], pdf["text_a"], pdf["text_b"]):
                if a != last:  # rows come sorted by a
                    last, sa = a, shingles(ta)[:2]
                na, nb = sa[1].sum(), None
                sb = shingles(tb)[:2]
                nb = sb[1].sum()
                ok.append(min(na, nb) >= least * max(na, nb) and similarity(sa, sb) >= least)
            yield pdf.loc[ok, ["a", "b"]]

    return source.mapInPandas(run, "a bigint, b bigint")


def near_groups(spark, documents: DataFrame) -> DataFrame:
    """``(doc_id, class_id, text_id, group_size, kept, key, th)``, one row per document.

    class_id is the smallest doc_id of the near-duplicate group (groups are connected by verified
    pairs), text_id that of the documents of equal words, whatever their case. Exactly one row per
    group is ``kept``, one with class_id. Null texts count as empty; texts without words are one
    group; texts of under five words are near duplicates only if equal. Ids may repeat or be null: a
    null id is a class_id only if all ids of the group are null. An empty table gives an empty result.
    ``key`` is the digest of the words, ``th`` a hash of the text, by which rows of one id are told apart.
    """
    s = Scratch(spark, "minhash")
    signed = s.keep(sign_documents(documents))
    classes = s.keep(
        signed.groupBy("key").agg(F.min("doc_id").alias("text_id"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "th"))["th"].alias("th"),
            F.first("bands").alias("bands"), F.count(F.lit(1)).alias("n"))
        .withColumn("c", F.monotonically_increasing_id())
    )
    n = classes.count()
    few = n // TASK_ROWS + 1  # tasks that write a table of at most a row per class; files stay of some size
    in_bucket = classes.select("c", F.explode("bands").alias("bucket"))
    sizes = s.keep(in_bucket.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("c").alias("pivot")).filter("size > 1").coalesce(few * 4))
    shared = s.keep(in_bucket.join(sizes, "bucket").coalesce(few * 4))
    s.drop(sizes)
    # whole texts of the classes that share a bucket, one row each; a merge join at every size, as what
    # is wanted grows with the documents
    wanted = shared.select("c").distinct().join(classes.select("c", "key", "text_id", F.col("th").alias("text_th")), "c")
    docs = documents.select(F.col("doc_id"), text_column(documents).alias("text"))
    of_class = F.col("doc_id").eqNullSafe(F.col("text_id")) & (F.xxhash64("text") == F.col("text_th"))
    texts = s.keep(docs.join(wanted.hint("merge"), of_class).select("c", "key", "text"))
    # rows may repeat, or share id and hash: one text with the class's words stands for it
    repeated = texts.groupBy("c").count().filter("count > 1").limit(1).count() > 0
    if repeated:
        texts = s.keep(_of_key(texts).dropDuplicates(["c"]).select("c", "text"))
    else:
        texts = texts.select("c", "text")
    small, big = shared.filter(f"size <= {PAIR_BUCKET}"), s.keep(shared.filter(f"size > {PAIR_BUCKET}").select("bucket", "c", "pivot").coalesce(few))
    one, two = small.select("bucket", F.col("c").alias("a")), small.select("bucket", F.col("c").alias("b"))
    pairs = one.join(two, "bucket").filter("a < b").select("a", "b").distinct()
    links = s.keep(verified(pairs, texts))
    group = None
    if not big.isEmpty():
        asked = big.filter("c <> pivot").select(F.least("c", "pivot").alias("a"), F.greatest("c", "pivot").alias("b")).distinct()
        links = links.unionByName(s.keep(verified(asked, texts)))
        group = s.keep(components(s, links, "a", "b").coalesce(few))
        members = s.keep(_labelled(s, big, group, few).coalesce(few))
        links = s.keep(_across(s, members, texts)) if not members.isEmpty() else None
        if links is not None and not links.isEmpty():  # join the components found so far
            group = components(s, links.unionByName(group.select(F.col("node").alias("a"), F.col("component").alias("b"))), "a", "b")
    if group is None:
        group = components(s, links, "a", "b")
    per_class = classes.select("key", "c", "text_id", "n").join(group.withColumnRenamed("node", "c"), "c", "left").withColumn(
        "component", F.coalesce("component", "c")
    )
    per_class = s.keep(per_class.coalesce(few))
    heads = s.keep(per_class.groupBy("component").agg(F.min("text_id").alias("class_id"), F.sum("n").alias("group_size")).coalesce(few))
    known = s.keep(per_class.join(heads, "component").select("key", "text_id", "component", "class_id", "group_size").coalesce(few))
    out = signed.select("doc_id", "key", "th").join(known, "key")
    again = Window.partitionBy("doc_id", "component").orderBy("key", "th")
    first = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.row_number().over(again) == 1)
    return out.select("doc_id", "class_id", "text_id", "group_size", first.alias("kept"), "key", "th")


def _of_key(texts: DataFrame) -> DataFrame:
    """The rows whose text has the words of ``key``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf[[shingles(t)[2] == bytes(k) for t, k in zip(pdf["text"], pdf["key"])]]

    return texts.mapInPandas(run, texts.schema)


def _labelled(s: Scratch, big: DataFrame, group: DataFrame, few: int) -> DataFrame:
    """Members of large buckets with their component, and with ``main``, the component that most
    members of the bucket are in; only buckets of several components."""
    rows = s.keep(big.join(group.withColumnRenamed("node", "c"), "c", "left").select(
        "bucket", "c", F.coalesce("component", "c").alias("component")).coalesce(few))
    count = rows.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    mains = s.keep(
        count.groupBy("bucket").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.count(F.lit(1)).alias("parts")).filter("parts > 1").coalesce(few)
    )
    return rows.join(mains, "bucket")


def elements(text: str) -> np.ndarray:
    """The multiset of a text's shingles as a set: the k-th copy of a shingle is an element of its own."""
    h, n, _ = shingles(text)
    if len(n) and n.max() > 1:
        copy = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        h = np.repeat(h, n)
        h = np.where(copy > 0, mixed(h + copy.astype(np.uint64) * MIX1), h)
    return h


def block_links(out: pd.DataFrame, members: pd.DataFrame, least: float = SIMILAR) -> pd.DataFrame:
    """Links of ``out`` to ``members`` (c, component, text): for each text of ``out`` one link to every
    other component that has a member of at least that similarity -- further links into the same
    component join nothing more."""
    found = []
    if len(out) and len(members):
        sets = [elements(t) for t in members["text"]]
        sizes = np.array([len(x) for x in sets], np.int64)
        held, all_ = np.repeat(np.arange(len(sets)), sizes), np.concatenate(sets)
        order = np.argsort(all_, kind="stable")
        held, all_ = held[order], all_[order]
        c, component = members["c"].to_numpy(), members["component"].to_numpy()
        for x, own, text in zip(out["c"], out["component"], out["text"]):
            e = elements(text)
            lo, hi = np.searchsorted(all_, e, "left"), np.searchsorted(all_, e, "right")
            n = hi - lo
            at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
            shared = np.bincount(held[at], minlength=len(sets))
            total = sizes + len(e) - shared
            near = np.flatnonzero((shared >= least * total) & (total > 0) & (component != own))
            _, one = np.unique(component[near], return_index=True)
            found += [(min(x, y), max(x, y)) for y in c[near[one]].tolist()]
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def _across(s: Scratch, members: DataFrame, texts: DataFrame) -> DataFrame:
    """The links of large buckets between components, one end outside the bucket's largest."""
    out = members.filter("component <> main").select("bucket", "c", "component")
    sizes = s.keep(
        members.groupBy("bucket").agg(
            F.ceil(F.count(F.when(F.col("component") != F.col("main"), True)) / OUT_BLOCK).cast("int").alias("outs"),
            F.ceil(F.count(F.lit(1)) / MEMBER_BLOCK).cast("int").alias("blocks"),
        )
    )
    block = lambda n: F.pmod(F.xxhash64("c"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = out.join(sizes, "bucket").withColumn("i", block("outs")).withColumn("j", every("blocks"))
    right = members.join(sizes, "bucket").withColumn("j", block("blocks")).withColumn("i", every("outs"))
    key, columns = ["bucket", "i", "j"], ["bucket", "i", "j", "c", "component", "text"]
    new = [F.col(x).alias(x) for x in columns]  # both sides come from one table
    two = [x.select(*columns[:5]).join(texts, "c").select(*new).groupBy(*key) for x in (left, right)]
    return two[0].cogroup(two[1]).applyInPandas(lambda x, y: block_links(x, y), "a bigint, b bigint").distinct()


def distinct_rows(spark, documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` that stay, one of each near-duplicate group, with all columns."""
    kept = near_groups(spark, documents).filter("kept").select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), F.col("th").alias("_th"))
    repeated = not documents.groupBy("doc_id").count().filter("count > 1").isEmpty()
    both = documents.join(kept, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64(text_column(documents)) == F.col("_th")))
    if not repeated:
        return both.select(*documents.columns)
    # an id on several rows: hold each text against the words that stay

    @F.pandas_udf("binary")
    def words_key(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in texts:
            yield pd.Series([shingles(x or "")[2] for x in t], dtype=object)

    own = both.withColumn("_own", words_key(F.col("text"))).filter("_own = _key")
    others = [c for c in documents.columns if c != "doc_id"]  # of rows that repeat an id the least by their columns
    first = F.row_number().over(Window.partitionBy("doc_id", "_own").orderBy(*others))
    return own.withColumn("_first", first).filter("_first = 1").select(*documents.columns)
