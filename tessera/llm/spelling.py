"""Spelling variants: words one edit apart, found through pivotal grams.

All bigrams of the vocabulary have a global order, the rarest first, and those of a word are ordered by
it and then by place. A word's gram prefix is the first ``GRAM * EDITS + 1`` of them; its pivots are
``EDITS + 1`` bigrams of the prefix that don't overlap, chosen by dynamic programming so that the words
holding them are fewest. One edit leaves one of two disjoint pivots whole, and moves it by one place at
most. Of two near words, take the one whose prefix ends first in the order: its surviving pivot is in
the other one's prefix, or one place behind the end of it. So pivots are looked up among prefixes (with
that next place) only, and both are few and rare, however long a word is.

Position limits: one edit lies before or after the surviving bigram. After it, the bigram has the same
place in both words and everything before it is equal; before it, the same holds counted from the end.
Both give an equality key (side, bigram, place, length, hash of the equal part), so the lookup is an
equi-join whose candidates are almost all near where that part is long. Each candidate is verified by
its edit distance in the join, after a look at its letters: a 64-bit signature holds which letters stand
in a word an odd number of times, and one edit changes at most two of them.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.scratch import Scratch, text_column

GRAM, EDITS = 2, 1
LEAST_LENGTH, LEAST_COUNT, LEADS = 7, 2, 10
DAMAGED = 31  # of so many (document, run) pairs, one loses a code point
HELD_WORDS = 300_000  # words that a counting task holds before it passes their counts on
BATCH_ROWS = 1 << 15
RUN = re.compile(r"[A-Za-zÀ-ÿ]{%d,}" % LEAST_LENGTH)
_LOWER = {i: i + 32 for i in range(65, 91)}


def written(doc_id: str, run: str) -> str:
    """A lower-cased run as it is counted in a document: the whole, or without one code point."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % DAMAGED:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def count_words(documents: DataFrame) -> DataFrame:
    """``(word, n)`` of all words that occur at least ``LEAST_COUNT`` times. Shorter runs than
    ``LEAST_LENGTH`` can't give a word. A task adds up its documents' words before they are shuffled."""
    source = documents.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), text_column(documents).alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for pdf in batches:
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                for w, n in Counter(RUN.findall(text)).items():
                    w = written(doc_id, w.lower() if w.isascii() else w.translate(_LOWER))
                    if len(w) >= LEAST_LENGTH:
                        counts[w] += n
                if len(counts) > HELD_WORDS:
                    yield pd.DataFrame(counts.items(), columns=["word", "n"])
                    counts.clear()
        if counts:
            yield pd.DataFrame(counts.items(), columns=["word", "n"])

    each = source.mapInPandas(run, "word string, n bigint")
    return each.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def gram_counts(words: DataFrame) -> dict[str, int]:
    """How often each bigram stands in the vocabulary: at most the square of the 90 letters of a word,
    8,100 rows, reach the driver."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for pdf in batches:
            for w in pdf["word"]:
                counts.update([w[i : i + GRAM] for i in range(len(w) - GRAM + 1)])
        if counts:
            yield pd.DataFrame(counts.items(), columns=["gram", "n"])

    rows = words.select("word").mapInPandas(run, "gram string, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    return {r["gram"]: r["n"] for r in rows.collect()}


def gram_prefix(word: str, counts: dict[str, int]) -> tuple[list[tuple[int, str]], list[tuple[int, str]]]:
    """``(place, bigram)`` of a word's gram prefix, by place, and of what it is found by: the prefix and
    up to ``EDITS`` further places of its last bigram."""
    grams = sorted([(counts[g], g, i) for i in range(len(word) - GRAM + 1) for g in [word[i : i + GRAM]]])
    most = GRAM * EDITS + 1
    n, g, i = grams[most - 1]
    return sorted([x[:0:-1] for x in grams[:most]]), [x[:0:-1] for x in grams[: most + EDITS] if x <= (n, g, i + EDITS)]


def pivots(prefix: list[tuple[int, str]], counts: dict[str, int]) -> list[tuple[int, str]]:
    """``EDITS + 1`` bigrams of the prefix that don't overlap, of least total count: per number of chosen
    ones, the best choice among the places gone through so far."""
    best: list[list[tuple[int, tuple]]] = []  # per place: of each number of choices, (cost, choice)
    for at, (place, gram) in enumerate(prefix):
        before = at - 1
        while before >= 0 and prefix[before][0] > place - GRAM:
            before -= 1
        free = best[before] if before >= 0 else [(0, ())]
        row = list(best[at - 1]) if at else [(0, ())]
        for k, (cost, chosen) in enumerate(free[: EDITS + 1], 1):
            new = (cost + counts[gram], (*chosen, (place, gram)))
            if k == len(row):
                row.append(new)
            elif new < row[k]:
                row[k] = new
        best.append(row)
    return list(best[-1][EDITS + 1][1])


def _key(side: str, gram: str, place: int, length: int, part: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{side}{gram}{place},{length},{part}".encode(), digest_size=8).digest(), "little", signed=True)


def index_keys(word: str, places: list[tuple[int, str]]) -> Iterator[int]:
    """Where a word is found: per bigram, what stands before and what stands after it."""
    for p, g in places:
        yield _key("<", g, p, len(word), word[:p])
        yield _key(">", g, p, len(word), word[p + GRAM :])


def probe_keys(word: str, pivots_: list[tuple[int, str]]) -> Iterator[int]:
    """Where words near this one would be found by one of its pivots: the other is longer by ``by``, and
    the edit stands after the bigram (its place is the same) or before it (its place moves along)."""
    n = len(word)
    for p, g in pivots_:
        for by in (-1, 0, 1):
            if by > 0 or p + GRAM < n:
                yield _key("<", g, p, n + by, word[:p])
            if by > 0 or p > 0:
                yield _key(">", g, p + by, n + by, word[p + GRAM :])


def signature(word: str) -> int:
    """The letters that stand in a word an odd number of times, as bits of a signed 64-bit integer."""
    bits = 0
    for c in word:
        bits ^= 1 << (ord(c) & 63)
    return bits - (1 << 64) if bits >> 63 else bits


def near_pairs(s: Scratch, words: DataFrame) -> DataFrame:
    """``(word, near, near_n)``: all ordered pairs of words one edit apart, each once."""
    counts = gram_counts(words)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = []
        for pdf in batches:
            for w, n in zip(pdf["word"], pdf["n"].tolist()):
                prefix, places = gram_prefix(w, counts)
                letters = signature(w)
                out += [(k, w, n, letters, False) for k in index_keys(w, places)]
                out += [(k, w, n, letters, True) for k in probe_keys(w, pivots(prefix, counts))]
                if len(out) >= BATCH_ROWS:
                    yield pd.DataFrame(out, columns=["k", "word", "n", "letters", "probe"])
                    out = []
        if out:
            yield pd.DataFrame(out, columns=["k", "word", "n", "letters", "probe"])

    keyed = s.keep(words.mapInPandas(rows, "k bigint, word string, n bigint, letters bigint, probe boolean"))
    a = keyed.filter("probe").select("k", F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("letters").alias("a_l"))
    b = keyed.filter("not probe").select("k", F.col("word").alias("b"), F.col("n").alias("b_n"), F.col("letters").alias("b_l"))
    alike = F.bit_count(F.col("a_l").bitwiseXOR(F.col("b_l"))) <= 2 * EDITS
    found = s.keep(a.join(b, (a["k"] == b["k"]) & alike & (F.levenshtein("a", "b", EDITS) == EDITS)).select("a", "a_n", "b", "b_n"))
    s.drop(keyed)
    both = found.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).unionByName(
        found.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n"))
    )
    return both.distinct()


def roots(s: Scratch, forms: DataFrame) -> DataFrame:
    """``(word, root)`` of words with a form: the last of its forms. A form is ``LEADS`` times as frequent
    as its word, so a chain has at most as many steps as the largest count has digits; each round doubles
    the steps taken."""
    now = s.keep(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        new = s.keep(now.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        s.drop(now)
        if new.filter("moved").isEmpty():
            return new.select("word", "root")
        now = new.select("word", "root")


def group_variants(spark, documents: DataFrame) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)``, one row per word.

    Words are runs of letters of at least ``LEAST_LENGTH`` code points that occur at least twice, A-Z
    lower-cased; of one (doc_id, run) pair in ``DAMAGED`` a code point is left out. Null texts hold no words;
    a null doc_id is an empty one; repeated rows count as often as they stand there; other columns aren't
    read; an empty table gives an empty result. Texts and words of any length are taken whole. Of near
    words of equal n the first in code-point order is the form.
    """
    s = Scratch(spark, "spelling")
    words = s.keep(count_words(documents))
    near = near_pairs(s, words)
    best = F.min(F.struct((-F.col("near_n")).alias("n"), "near"))
    per = s.keep(near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("b")).select("word", "n_near", F.col("b.near").alias("near"), (-F.col("b.n")).alias("near_n")))
    told = s.keep(
        words.join(per, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
            *[F.when(F.col("near_n") >= LEADS * F.col("n"), F.col(c)).alias(name) for c, name in (("near", "form"), ("near_n", "form_n"))],
        )
    )
    last = roots(s, told.filter("form is not null"))
    return told.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
