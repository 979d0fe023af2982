"""Line dedup by pairwise alignment of overlapping documents.

Documents of equal lines are one class, whose first document stands for it; the others repeat it as a
whole. Two classes overlap when they share a line. A rare line (in at most ``RARE`` classes) pairs its
holders, and all these pairs are aligned as they are. A pair that shares frequent lines only is aligned
the same way when all other lines are taken out of it: the form of a class is its frequent lines, with
one mark for each run of other lines. A line that a third of all documents hold has many holders and few
forms, and what a pair of forms has in common holds for all their members.

Pairs of forms are not all aligned. A block that goes has a run of neighbouring lines of ``MIN_CHARS``
characters around each of its lines, which the earlier form holds too. Forms that hold a run are numbered
by their first members, and rounds try the next ones (1, 2, 4, ...) for the lines still in place only: once
a form takes a line, later ones can't take more. A line that no holder of its runs takes has met all of
them in the end, so the result is that of all pairs.

Each pair is aligned by patience diff: common heads and tails first, then the lines that are unique in
both documents, in the longest order they share, then the same between two such anchors. Aligned runs
of lines are common blocks; a block of at least ``MIN_CHARS`` characters is deleted from the later
document. All pairs are judged on the documents as they came. What moves for the alignment is line
hashes (eight bytes a line); pairs of one much-shared document are a skewed join key, which Spark
splits, and only the texts that lose lines are rebuilt.
"""

from __future__ import annotations

import functools
import hashlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.scratch import Scratch, text_column

RARE = 16
MIN_CHARS = 24
BLANK = 0  # the hash of a line without characters
OTHER = -1  # in a form: lines that aren't frequent
SLICE = 2048  # members of forms that one task goes through in order


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence, of pairs in order of the first number, that increases in the second."""
    tops, ends, back = [], [], []
    for n, (_, j) in enumerate(pairs):
        at = bisect_left(tops, j)
        back.append(ends[at - 1] if at else -1)
        if at == len(tops):
            tops.append(j)
            ends.append(n)
        else:
            tops[at], ends[at] = j, n
    out, n = [], ends[-1] if ends else -1
    while n >= 0:
        out.append(pairs[n])
        n = back[n]
    return out[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Matched positions (i, j) of two lists of line hashes, increasing in both."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i0, i1, j0, j1 = todo.pop()
        while i0 < i1 and j0 < j1 and a[i0] == b[j0]:
            out.append((i0, j0))
            i0, j0 = i0 + 1, j0 + 1
        while i0 < i1 and j0 < j1 and a[i1 - 1] == b[j1 - 1]:
            i1, j1 = i1 - 1, j1 - 1
            out.append((i1, j1))
        if i0 >= i1 or j0 >= j1:
            continue
        in_a, in_b = Counter(a[i0:i1]), Counter(b[j0:j1])
        place = {h: j for j, h in enumerate(b[j0:j1], j0) if in_b[h] == 1 and in_a.get(h) == 1 and h != BLANK}
        anchors = _increasing([(i, place[h]) for i, h in enumerate(a[i0:i1], i0) if h in place])
        for (i, j), (i2, j2) in zip(anchors, [*anchors[1:], (i1, j1)]):
            out.append((i, j))
            todo.append((i + 1, i2, j + 1, j2))
        if anchors:
            todo.append((i0, anchors[0][0], j0, anchors[0][1]))
    return sorted(out)


def common_lines(a: list[int], b: list[int], chars: list[int], least: int = MIN_CHARS) -> list[int]:
    """Positions of ``b`` in common blocks of at least ``least`` characters (``chars`` of b's lines)."""
    out, block = [], []
    for i, j in [*patience(a, b), (-1, -1)]:
        if block and (i != block[-1][0] + 1 or j != block[-1][1] + 1):
            if sum(chars[y] for _, y in block) >= least:
                out += [y for _, y in block]
            block = []
        block.append((i, j))
    return out


def form_of(hashes: list[int], frequent: set[int]) -> list[int]:
    """Positions of the lines that a class's form keeps, one of each run of other lines negated and
    less 1. Blank lines between two other lines of a run can't be matched and belong to the run."""
    out, start = [], 0
    for end in [*(i for i, h in enumerate(hashes) if h in frequent), len(hashes)]:
        filled = [i for i in range(start, end) if hashes[i] != BLANK]
        if filled:
            out += [*range(start, filled[0]), -filled[0] - 1, *range(filled[-1] + 1, end)]
        else:
            out += range(start, end)
        out += [end] * (end < len(hashes))
        start = end + 1
    return out


def lines_of(text: str) -> list[str]:
    return text.split("\n")


def _bare(line: Column) -> Column:
    """A line without white space around."""
    return F.regexp_replace(line, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")


def runs_of(hashes: list[int], chars: list[int], least: int) -> list[tuple[int, int, int]]:
    """``(p, i, e)``: the shortest runs i..e of a form's lines that hold line p and have ``least`` characters.
    Whatever common block holds p holds one of them, in both forms."""
    out, start = [], 0
    for end in [*(i for i, h in enumerate(hashes) if h == OTHER), len(hashes)]:
        sums = list(accumulate(chars[start:end]))
        filled = [i for i in range(len(sums)) if chars[start + i]]
        for p in range(len(sums) if sums and sums[-1] >= least else 0):
            i, k, last = p, bisect_left(filled, p), len(sums)
            while True:
                e = max(p, bisect_left(sums, sums[i] - chars[start + i] + least))
                if e < last:
                    out.append((start + p, start + i, start + e))
                    last = e
                if e == p or k == 0:
                    break
                k -= 1
                i = filled[k]
        start = end + 1
    return out


def _places(s: Scratch, forms: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """``(f, p, key)``: the runs around each line of each form, and ``(key, f, lo, r)``: the forms that hold a
    run, numbered from 0 by their first members; both of runs that at least two members hold."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for c, hashes, chars in zip(pdf["c"], pdf["hashes"], pdf["chars"]):
                found, keys = runs_of(hashes.tolist(), chars.tolist(), least), {}
                for _, i, e in found:
                    if (i, e) not in keys:
                        digest = hashlib.blake2b(hashes[i : e + 1].astype(np.int64).tobytes(), digest_size=8).digest()
                        keys[i, e] = int.from_bytes(digest, "little", signed=True)
                yield pd.DataFrame({"f": c, "p": [p for p, _, _ in found], "key": [keys[i, e] for _, i, e in found]}).astype("int64")

    spots = s.keep(forms.select("c", "hashes", "chars").mapInPandas(cut, "f bigint, p bigint, key bigint").distinct())
    held = spots.select("key", "f").distinct().join(forms.select(F.col("c").alias("f"), "lo", "hi"), "f")
    several = held.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("lo") < F.col("hi")).alias("repeated")).filter("n > 1 OR repeated").select("key")
    sorted_ = s.keep(
        held.join(several, "key").select("key", "f", "lo").repartitionByRange("key", "lo").sortWithinPartitions("key", "lo")
        .withColumn("g", F.monotonically_increasing_id()).withColumn("part", F.shiftright("g", 33))
    )
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sorted_.groupBy("key", "part").agg(F.min("g").alias("g0"), F.count(F.lit(1)).alias("n")).select(
        "key", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("g0")).alias("shift"))
    holders = s.keep(sorted_.join(starts, ["key", "part"]).select("key", "f", "lo", (F.col("g") + F.col("shift")).alias("r")))
    kept = s.keep(spots.join(several, "key"))
    s.drop(spots, sorted_)
    return kept, holders


def _frequent(s: Scratch, classes: DataFrame, common: DataFrame, pairs: DataFrame, aligned, least: int) -> DataFrame:
    """``(b, at)``: lines lost to earlier classes that share frequent lines only with b. ``common`` has a row
    per class and frequent line, ``pairs`` the classes that share a rare line, which are judged elsewhere."""

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for hashes, chars, marks in zip(pdf["hashes"], pdf["chars"], pdf["marks"]):
                places = form_of(h := hashes.tolist(), set(marks.tolist()))
                form = [h[i] if i >= 0 else OTHER for i in places]
                rows.append((hashlib.sha256(np.array(form, np.int64).tobytes()).hexdigest(), form, [int(chars[i]) if i >= 0 else 0 for i in places], places))
            yield pd.DataFrame(rows, columns=["form", "hashes", "chars", "places"]).assign(x=pdf["c"].to_numpy())

    marks = common.groupBy("c").agg(F.collect_list("h").alias("marks"))  # at most as many as the class has lines
    formed = s.keep(classes.join(marks, "c").select("c", "hashes", "chars", "marks").mapInPandas(
        reduce, "x bigint, form string, hashes array<bigint>, chars array<int>, places array<int>"))
    order = [F.col("text_id").isNull(), F.col("text_id"), F.col("x")]
    slices = max(1, -(-formed.count() // SLICE))
    ordered = s.keep(
        formed.select("x", "form", "places").join(classes.select(F.col("c").alias("x"), "text_id"), "x").repartitionByRange(slices, *order).sortWithinPartitions(*order)
        .select("x", "form", "places", F.monotonically_increasing_id().alias("o"))
    )
    forms = s.keep(
        formed.groupBy("form").agg(F.first("hashes").alias("hashes"), F.first("chars").alias("chars"))
        .join(ordered.groupBy("form").agg(F.min("o").alias("lo"), F.max("o").alias("hi")), "form").withColumn("c", F.monotonically_increasing_id())
    )
    # x: class, f: form, o: place in the order, k: slice of the order
    members = s.keep(ordered.join(forms.select("form", F.col("c").alias("f")), "form").select("x", "f", "o", F.shiftright("o", 33).alias("k"), "places"))
    s.drop(formed, ordered)
    spots, holders = _places(s, forms, least)

    # pairs of a rare line are judged by all their lines and don't count here: of a form with r members
    # paired so, the member of number r, if it is earlier, shows that another one is
    side = lambda c: members.select(F.col("x").alias(c), F.col("f").alias(f"f{c}"))
    known = s.keep(pairs.join(side("a"), "a").join(side("b"), "b").groupBy(F.col("b").alias("u"), "fa").agg(F.count(F.lit(1)).alias("r")))
    counts = members.groupBy("f", "k").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("f").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    start = counts.select("f", "k", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n"))
    ranks = members.select("f", "k", "o", F.row_number().over(Window.partitionBy("f", "k").orderBy("o")).alias("r")).join(start, ["f", "k"]).select(
        F.col("f").alias("fa"), F.col("o").alias("other"), (F.col("r") + F.col("n") - 1).alias("r"))
    others = s.keep(known.join(ranks, ["fa", "r"], "left").select("u", "fa", "other"))
    apart = s.keep(known.select(F.col("u").alias("x")).distinct())
    s.drop(known)

    # u: all members of a form that have no such pair (-1 - f), or one member that has; a form that comes
    # before ``until`` can still take line p from it
    free = members.join(apart, "x", "left_anti")
    units = free.groupBy("f").agg(F.max("o").alias("until")).select((-1 - F.col("f")).alias("u"), "f", "until").unionByName(
        members.join(apart, "x").select(F.col("x").alias("u"), "f", F.col("o").alias("until")))
    following = lambda r: holders.filter(F.col("r") == r).select("key", "lo")
    places = ["u", "f", "p", "key", "until"]
    active = s.keep(units.join(spots, "f").join(following(0), "key").filter("lo < until").select(*places))
    tried, hits, first, width = [], [], 0, 1
    while not active.isEmpty():
        # the next holders of the runs still in place; twice as many each round
        batch = holders.filter(F.col("r").between(first, first + width - 1)).select("key", F.col("f").alias("a"), "lo")
        asked = active.groupBy(F.col("f").alias("b"), "key").agg(F.max("until").alias("until"))
        new = asked.join(batch, "key").filter("lo < until").select("a", "b").distinct()
        for t in tried:
            new = new.join(t, ["a", "b"], "left_anti")
        tried.append(s.keep(new))
        found = aligned(tried[-1], forms)
        shown = found.select(F.col("a").alias("fa"), F.col("b").alias("f"), F.explode(F.col("at").cast("array<bigint>")).alias("p")).join(
            forms.select(F.col("c").alias("fa"), "lo"), "fa")
        hit = (
            active.select("u", "f", "p", "until").distinct().join(shown, ["f", "p"]).filter("lo < until")
            .join(others.withColumn("paired", F.lit(True)), ["u", "fa"], "left").filter("paired IS NULL OR other < until")
            .groupBy("u", "f", "p").agg(F.min("lo").alias("lo"))
        )
        hits.append(s.keep(hit))
        first, width = first + width, 2 * width
        rest = (
            active.join(hits[-1].withColumnRenamed("lo", "best"), ["u", "f", "p"], "left").filter("best IS NULL OR u < 0")
            .withColumn("until", F.least("until", "best")).join(following(first), "key").filter("lo < until").select(*places)
        )
        rest = s.keep(rest)
        s.drop(active, found)
        active = rest
    if not hits:
        return members.select(F.col("x").alias("b"), F.lit(0).alias("at")).limit(0)
    taken = functools.reduce(DataFrame.unionByName, hits)
    best = taken.filter("u < 0").groupBy("f", "p").agg(F.min("lo").alias("lo"))
    of_free = free.select("x", "f", "o").join(best, "f").filter("lo < o").select("x", "p")
    lost = of_free.unionByName(taken.filter("u >= 0").select(F.col("u").alias("x"), "p").distinct()).join(members.select("x", "places"), "x")
    return s.keep(lost.select(F.col("x").alias("b"), F.element_at("places", (F.col("p") + 1).cast("int")).alias("at")))


def dedup_lines(spark, documents: DataFrame, least: int = MIN_CHARS) -> DataFrame:
    """``(doc_id, n_lines, n_removed, kept_text)``, one row per document; further columns of ``documents``
    are not read, whatever their names.

    Lines end at line feeds; they are equal when equal without white space around. A line goes if it lies
    in a common block of ``least`` characters (at least 1) with any earlier text. Earlier means a smaller
    doc_id (null last; texts of one id in a fixed order). A document of the same lines as an earlier one loses all of
    them, if they have ``least`` characters. Null texts count as empty: one blank line, never removed.
    Repeated rows share one decision by their text: of rows with the smallest id of their text none
    is a copy. An empty table gives an empty result. A text is one row of its task, whatever its length.
    """
    if least < 1:
        raise ValueError("a block has at least one character")
    s = Scratch(spark, "lines")
    text = text_column(documents)
    docs = documents.select("doc_id", F.transform(F.split(text, "\n"), _bare).alias("lines"))
    signed = s.keep(docs.select(
        "doc_id", F.sha2(F.concat_ws("\n", "lines").cast("binary"), 256).alias("key"),
        F.transform("lines", lambda x: F.when(x == "", F.lit(BLANK)).otherwise(F.xxhash64(x))).alias("hashes"),
        F.transform("lines", lambda x: F.length(x)).alias("chars"),
    ))
    classes = s.keep(
        signed.groupBy("key").agg(F.min("doc_id").alias("text_id"), F.first("hashes").alias("hashes"), F.first("chars").alias("chars"))
        .withColumn("c", F.monotonically_increasing_id())
    )
    held = s.keep(
        classes.select("c", "text_id", F.explode(F.array_distinct("hashes")).alias("h")).filter(F.col("h") != BLANK)
    )
    counts = s.keep(held.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    shared = s.keep(held.join(counts, "h"))
    s.drop(held, counts)
    # earlier(x, y): by id, null last, then by class
    order = lambda c: F.struct(F.col(f"{c}_id").isNull(), F.col(f"{c}_id"), F.col(c))
    rare = shared.filter(f"n <= {RARE}")
    pairs = (
        rare.select("h", F.col("c").alias("a"), F.col("text_id").alias("a_id"))
        .join(rare.select("h", F.col("c").alias("b"), F.col("text_id").alias("b_id")), "h").filter(order("a") < order("b")).select("a", "b")
    )
    pairs = s.keep(pairs.distinct())

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [
                common_lines([h if h != OTHER else OTHER - 1 for h in x.tolist()], y.tolist(), z.tolist(), least)
                for x, y, z in zip(pdf["lines_a"], pdf["lines_b"], pdf["chars"])
            ]
            out = pd.DataFrame({"a": pdf["a"], "b": pdf["b"], "at": found})
            yield out[out["at"].map(len) > 0]

    def aligned(pairs: DataFrame, sides: DataFrame) -> DataFrame:
        one = sides.select(F.col("c").alias("a"), F.col("hashes").alias("lines_a"))
        two = sides.select(F.col("c").alias("b"), F.col("hashes").alias("lines_b"), "chars")
        both = pairs.join(two, "b").join(one, "a").select("a", "b", "lines_a", "lines_b", "chars")
        return s.keep(both.mapInPandas(align, "a bigint, b bigint, at array<int>"))

    near = aligned(pairs, classes)
    far = _frequent(s, classes, shared.filter(f"n > {RARE}"), pairs, aligned, least)
    removed = s.keep(
        near.select("b", F.explode("at").alias("at")).unionByName(far).distinct()
        .groupBy("b").agg(F.sort_array(F.collect_list("at")).alias("at"))
    )  # a list is at most as long as the document
    per_class = s.keep(
        classes.select("key", "c", "text_id", F.aggregate("chars", F.lit(0).cast("bigint"), lambda x, y: x + y).alias("all_chars"))
        .join(removed.withColumnRenamed("b", "c"), "c", "left").select("key", "text_id", "all_chars", "at")
    )
    own = documents.select("doc_id", text.alias("text")).withColumn(
        "key", F.sha2(F.concat_ws("\n", F.transform(F.split("text", "\n"), _bare)).cast("binary"), 256)
    )
    copy = ~F.col("doc_id").eqNullSafe(F.col("text_id")) & (F.col("all_chars") >= least)
    whole = own.join(per_class, "key").select("doc_id", "text", "at", copy.alias("copy"))

    def rebuild(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            n, gone, kept = [], [], []
            for t, at, is_copy in zip(pdf["text"], pdf["at"], pdf["copy"]):
                rows = lines_of(t)
                drop = set(range(len(rows))) if is_copy else set(at.tolist() if at is not None else ())
                n.append(len(rows))
                gone.append(len(drop))
                kept.append("\n".join([x for i, x in enumerate(rows) if i not in drop]))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_lines": n, "n_removed": gone, "kept_text": kept})

    kind = whole.schema["doc_id"].dataType.simpleString()
    return whole.mapInPandas(rebuild, f"doc_id {kind}, n_lines bigint, n_removed bigint, kept_text string")

