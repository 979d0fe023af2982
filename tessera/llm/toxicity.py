"""Toxicity scoring behind a noisy channel.

Writers hide words by look-alike characters (1d10t), separators (i.d.i o-t) and repetition
(idiooot). A written token is taken as a noisy form of a spelt one: its characters span a lattice of
what each may stand for -- itself, the letters it looks like, nothing (a separator or a repeat), or a
word's end -- with a channel cost each, and Viterbi finds the path that is most probable under a
character trigram model of the corpus. Plain words pass as they are.

The restored words are scored by word and word-beginning evidence learned from labelled rows: how
often each stands in toxic and other texts, counted by distinct surroundings, so that copies of one
text count once. A logistic function of a document's strongest evidence is the score.

Spark counts the character trigrams over all documents and the evidence over a bounded sample of the
labelled ones (``max_labelled``), which is decoded once. Tasks hold both models whole: the trigrams are
those of the letters below U+0800 (scripts above have no look-alikes to undo and are one symbol), so
their number follows from alphabets, not from the documents; the evidence comes from the bounded
sample. Scoring is one pass without a shuffle. It decodes only tokens that can hold a word with
evidence: what doubling and accents hide has the same skeleton as what they hide it from.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.scratch import Scratch, releasing, text_column

MAX_LABELLED = 40_000
CACHE_TOKENS = 150_000
THRESHOLD = 0.7

# ---- fixed values: what characters are written for -----------------------------------------------
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¢": "c",
    "а": "a", "в": "b", "е": "e", "і": "i", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c",
    "т": "t", "у": "y", "х": "x", "α": "a", "ε": "e", "ι": "i", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
}
LOOKS = frozenset(LOOKS_LIKE)
# natural log costs of the channel
SAME, LOOK, DROP, KEEP, REPEAT, END = 0.0, 1.0, 0.6, 6.0, 0.7, 1.5

EDGE = ".,;:!?\"'()[]{}<>*_~#%&|/\\-–—…“”‘’«»¿¡`^=+$@​‌‍﻿"
SPACED = re.compile(r"(?<!\w)(?:[\w@$!|+][ \t.\-_*·​]{1,3}){2,}[\w@$!|+](?!\w)")
DOUBLED = re.compile(r"(.)\1")
RUNS = re.compile(r"(.)\1+")
PREFIXES = (4, 5, 6, 7)


class CharModel:
    """Trigram model with additive smoothing by the bigram; 0 is a word's edge."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.tri: dict[int, float] = dict(zip(keys.tolist(), counts.tolist()))
        self.bi: Counter = Counter()
        self.uni: Counter = Counter()
        for k, c in self.tri.items():
            self.bi[k >> 11] += c
            self.uni[k & 2047] += c
        self.total = sum(self.uni.values()) + 1.0
        self.memo: dict[int, float] = {}

    def cost(self, a: int, b: int, c: int) -> float:
        """-log P(c | a b), mixing trigram, and unigram estimates."""
        k = (a << 22) | (b << 11) | c
        if (v := self.memo.get(k)) is None:
            p = (self.tri.get(k, 0.0) + 2.0 * (self.uni.get(c, 0) + 0.1) / self.total) / (self.bi.get(k >> 11, 0.0) + 2.0)
            v = self.memo[k] = -math.log(p)
        return v


def _code(c: str) -> int:
    o = ord(c)
    return o if 1 < o < 2048 else 1


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """For each run of equal characters, what it may stand for, with its channel cost."""
    out, i = [], 0
    while i < len(token):
        j = i
        while j < len(token) and token[j] == token[i]:
            j += 1
        c, n = token[i], j - i
        arcs: dict[str, float] = {}

        def add(s: str, cost: float) -> None:
            arcs[s] = min(arcs.get(s, 1e9), cost)

        letters = [(c, SAME if c.isalpha() else KEEP)] * (c.isalnum()) + [(x, LOOK) for x in LOOKS_LIKE.get(c, "")]
        if c.isalpha() and not c.isascii():
            base = unicodedata.normalize("NFD", c)[0]
            letters += [(base, LOOK)] if base != c else []
        for x, cost in letters:
            add(x, cost + (REPEAT if n > 1 else 0.0))
            if n > 1:
                add(x + x, 2 * cost + (REPEAT if n > 2 else 0.0))
        if not c.isalnum():
            add("", DROP)
            add(" ", END)
        elif not c.isalpha() and not LOOKS_LIKE.get(c):
            add("", 2 * DROP)
        out.append(list(arcs.items()))
        i = j
    return out


def restore(model: CharModel, token: str) -> str:
    """The most probable spelling of a token; blanks part words."""
    best: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
    for arcs in lattice(token):
        new: dict[tuple[int, int], tuple[float, tuple]] = {}
        for (a, b), (cost, path) in best.items():
            for letters, extra in arcs:
                x, y, total = a, b, cost + extra
                for ch in letters:
                    c = 0 if ch == " " else _code(ch)
                    if c == 0 and y == 0:
                        continue
                    total += model.cost(x, y, c)
                    x, y = (0, 0) if c == 0 else (y, c)
                old = new.get((x, y))
                if old is None or total < old[0]:
                    new[x, y] = (total, (path, letters) if letters else path)
        best = new
    cost, path = min(((v + (model.cost(a, b, 0) if b else 0.0), p) for (a, b), (v, p) in best.items()), key=lambda t: t[0])
    parts = []
    while path:
        path, letters = path
        parts.append(letters)
    return "".join(reversed(parts))


def _kinds() -> np.ndarray:
    """Bits of the code points below 2^16: 1, a character that ``SPACED`` takes as a letter; 2, one that may
    stand beside it (no letter or digit, or a separator)."""
    chars = [chr(i) for i in range(1 << 16)]
    word = np.array([c.isalnum() or c in "_@$!|+" for c in chars])
    beside = np.array([not (c.isalnum() or c == "_") or c == "_" for c in chars])
    return word * np.uint8(1) + beside * np.uint8(2)


KINDS = _kinds()


def may_be_spaced(text: str) -> bool:
    """False only if ``SPACED`` matches nowhere: its first three letters stand by themselves, within 8 places."""
    kinds = KINDS[np.minimum(np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32), 0xFFFF)]
    beside = np.concatenate([[True], kinds & 2 != 0, [True]])
    at = np.flatnonzero((kinds & 1 != 0) & beside[:-2] & beside[2:])
    return len(at) > 2 and bool((at[2:] - at[:-2] <= 8).any())


class Restorer:
    """Texts to restored words; remembers ``CACHE_TOKENS`` tokens."""

    def __init__(self, model: CharModel):
        self.model = model
        self.seen: dict[str, tuple[str, ...]] = {}

    def spell(self, t: str, worth=None) -> tuple[str, ...]:
        """The words of a token. ``worth`` says of a plainly written core whether any other spelling of it
        matters; without it all do."""
        core = t.strip(EDGE)
        if core.isalpha() and len(core) > 1 and LOOKS.isdisjoint(core):
            at = t.index(core)
            edged = len(t) > len(core) and not LOOKS.isdisjoint(t[:at] + t[at + len(core) :].rstrip("!"))
            if edged or ((not core.isascii() or DOUBLED.search(core)) and (worth is None or worth(core))):
                # written as it is spelt, or not: both are words of the token
                return (core, *(x for x in restore(self.model, t if edged else core).split() if x != core))
            return (core,)
        if not any(c.isalnum() or c in LOOKS for c in t):
            return ()
        return tuple(restore(self.model, t).split())

    def token(self, t: str) -> tuple[str, ...]:
        if (w := self.seen.get(t)) is None:
            if len(self.seen) > CACHE_TOKENS:
                self.seen.clear()
            w = self.seen[t] = self.spell(t)
        return w

    def spaced(self, text: str) -> list[str]:
        """Words spelt out in single characters, over several tokens."""
        if not may_be_spaced(text):
            return []
        return [x for m in SPACED.finditer(text) for x in restore(self.model, m[0]).split() if len(x) > 2]

    def sequence(self, text: str) -> list[str]:
        text = text.lower()
        tokens = text.split()
        return [w for t in tokens for w in self.token(t)] + self.spaced(text)

    def distinct(self, text: str) -> set[str]:
        return set(self.sequence(text))


def skeleton(word: str) -> str:
    """A word without accents, each run of a letter once: what all spellings have in common that
    differ in accents and doubled letters only."""
    if not word.isascii():
        word = "".join([_BASE.get(c) or _base(c) for c in word])
    return RUNS.sub(r"\1", word) if DOUBLED.search(word) else word


_BASE: dict[str, str] = {}


def _base(c: str) -> str:
    if len(_BASE) > 4096:
        _BASE.clear()
    b = _BASE[c] = unicodedata.normalize("NFD", c)[0] if c.isalpha() else c
    return b


class Worth:
    """Whether a spelling of a token that differs in accents and doubled letters can have evidence: if
    its skeleton is that of a word with evidence, or starts with that of a beginning with evidence."""

    def __init__(self, evidence: dict[str, float]):
        self.words = {skeleton(f[:-1]) for f in evidence if f.endswith("$")}
        self.starts = {skeleton(f) for f in evidence if not f.endswith("$")}
        self.lengths = sorted({len(s) for s in self.starts})

    def __call__(self, core: str) -> bool:
        s = skeleton(core)
        return s in self.words or any(s[:k] in self.starts for k in self.lengths)


def word_features(w: str) -> list[str]:
    return [w + "$", *[w[:k] for k in PREFIXES if len(w) > k]]


# ---- counting -----------------------------------------------------------------------------------


def count_trigrams(documents: DataFrame) -> DataFrame:
    """``(key, n)``: letter trigrams of every text, words edged by 0; letters above U+07FF are one."""
    source = documents.select(text_column(documents).alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letter = np.array([i if chr(i).isalpha() else 0 for i in range(2048)], np.int64)
        keys, sums = np.empty(0, np.int64), np.empty(0, np.int64)

        def counted(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
            points = np.frombuffer((" " + " ".join(texts).lower() + " ").encode("utf-32-le", "replace"), np.uint32)
            c = np.where(points < 2048, letter[np.minimum(points, 2047)], 1)
            c = c[np.concatenate([[True], (c[1:] != 0) | (c[:-1] != 0)])]  # one 0 between words
            before = np.concatenate([[0], c[:-1]])
            # what stands before a word's edge has no say: (0, 0) starts each word
            two = np.concatenate([[0], before[:-1]])
            two = np.where(before == 0, 0, two)
            k = (two << 22) | (before << 11) | c
            return np.unique(k[(before != 0) | (c != 0)], return_counts=True)

        for pdf in batches:
            group, chars = [], 0
            for t in [*pdf["text"], None]:
                if t is not None:
                    group.append(t)
                    chars += len(t)
                if group and (t is None or chars > 1 << 21):
                    k, n = counted(group)
                    keys, back = np.unique(np.concatenate([keys, k]), return_inverse=True)
                    sums = np.bincount(back, np.concatenate([sums, n]), len(keys)).astype(np.int64)
                    group, chars = [], 0
        if len(keys):
            yield pd.DataFrame({"key": keys, "n": sums})

    return source.mapInPandas(releasing(run), "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))


def is_held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def labelled_sample(s: Scratch, documents: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """``(text, toxic)`` of at most ``most`` training rows: not held out, the least hashes first. A
    document is toxic if any of its labels says so; unlabelled rows and null ids are left out."""
    known = (
        labels.filter("doc_id is not null and toxic is not null").filter(~is_held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    )
    rows = documents.select(F.col("doc_id"), text_column(documents).alias("text"))
    # the sample has at most ``most`` rows: a proven bound for the broadcast
    return s.keep(rows.join(F.broadcast(s.keep(known)), "doc_id").select("text", "toxic").repartition(
        max(8, documents.sparkSession.sparkContext.defaultParallelism), F.xxhash64("text")))


def decoded(s: Scratch, train: DataFrame, model: CharModel) -> DataFrame:
    """``(words, toxic)``: the sample's restored words in order, spelt-out ones last, with blanks between."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        r = Restorer(model)
        for pdf in batches:
            yield pd.DataFrame({"words": [" ".join(r.sequence(t)) for t in pdf["text"]], "toxic": pdf["toxic"]})

    return s.keep(train.mapInPandas(releasing(run), "words string, toxic int"))


def _evidence(s: Scratch, train: DataFrame) -> dict[str, float]:
    """Log odds that a word with a feature speaks for a toxic text, of significant features; ``train``
    has the sample's words. What reaches the driver is bounded as the sample is."""

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = [Counter(), Counter()]
        for pdf in batches:
            for words, toxic in zip(pdf["words"], pdf["toxic"]):
                words = set(words.split())
                n[toxic].update({f for w in words for f in word_features(w)})
                n[toxic][""] += len(words)  # no feature is empty: the sum of words
        names = sorted(n[0].keys() | n[1].keys())
        for i in range(0, len(names), 50_000):
            part = names[i : i + 50_000]
            yield pd.DataFrame({"feature": part, "n0": [n[0][f] for f in part], "n1": [n[1][f] for f in part]})

    by = s.keep(train.mapInPandas(releasing(counts), "feature string, n0 bigint, n1 bigint").groupBy("feature").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1")))
    sums = by.filter("feature = ''").first()
    if sums is None or not sums["n0"] or not sums["n1"]:
        return {}
    prior, features = sums["n1"] / (sums["n0"] + sums["n1"]), by.count()
    some = by.filter("feature <> '' and n1 >= 3 and n1 >= n0").orderBy(F.desc("n1"), "feature").select("feature")
    index = {f: i for i, f in enumerate(some.toPandas()["feature"])}
    if not index:
        return {}
    heads, first = heads_of(index), PREFIXES[0]

    def contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = set()
            for words, toxic in zip(pdf["words"], pdf["toxic"]):
                words = ["^", *words.split(), "$"]
                for before, w, after in zip(words, words[1:], words[2:]):
                    for f in word_features(w) if w[:first] in heads else ():
                        if (i := index.get(f)) is not None:
                            rows.add((i, f"{before} {w[-1:]} {after}", toxic))
            yield pd.DataFrame(sorted(rows), columns=["i", "context", "toxic"])

    around = train.mapInPandas(releasing(contexts), "i int, context string, toxic int")
    once = around.groupBy("i", "context").agg(F.min("toxic").alias("lo"), F.max("toxic").alias("hi")).filter("lo = hi")
    seen = once.groupBy("i").agg(F.sum("hi").alias("k1"), F.sum(1 - F.col("hi")).alias("k0")).collect()
    need, out, names = 2 * math.log(features), {}, list(index)
    for r in seen:
        k1, k0 = r["k1"], r["k0"]
        n = k1 + k0
        gain = 2 * (k1 * math.log(max(k1, 1e-9) / (n * prior)) + (k0 * math.log(k0 / (n * (1 - prior))) if k0 else 0.0))
        p = (k1 + prior) / (n + 1)
        if p > 0.8 and gain > need:
            out[names[r["i"]]] = math.log(p / (1 - p)) - math.log(prior / (1 - prior))
    return out


def heads_of(features) -> frozenset[str]:
    """The first letters that a word with one of the features has."""
    return frozenset(f.removesuffix("$")[: PREFIXES[0]] for f in features)


def _weighed(words, evidence: dict[str, float], heads: frozenset[str]) -> tuple:
    """The words that have evidence, with the strongest of each."""
    first = PREFIXES[0]
    return tuple((w, v) for w in words if w[:first] in heads and (v := max([evidence.get(f, 0.0) for f in word_features(w)])) > 0)


def _strengths(found: dict[str, float]) -> tuple[float, float, float]:
    """The strongest, the second strongest and the summed evidence of a text's words."""
    v = sorted(found.values(), reverse=True)
    return (v[0] if v else 0.0, v[1] if len(v) > 1 else 0.0, min(sum(v), 30.0))


class Scorer:
    """Texts to their strengths; remembers the words with evidence of ``CACHE_TOKENS`` tokens."""

    def __init__(self, model: Model):
        self.model, self.restorer, self.worth = model, Restorer(model.characters), Worth(model.evidence)
        self.heads, self.memo = heads_of(model.evidence), {}

    def vector(self, text: str) -> tuple[float, float, float]:
        text, evidence, heads, memo = text.lower(), self.model.evidence, self.heads, self.memo
        if len(memo) > CACHE_TOKENS:
            memo.clear()
        found: dict[str, float] = dict(_weighed(self.restorer.spaced(text), evidence, heads))
        for t in set(text.split()):
            v = memo.get(t)
            if v is None:
                v = memo[t] = _weighed(self.restorer.spell(t, self.worth), evidence, heads)
            if v:
                found.update(v)
        return _strengths(found)

    def score(self, text: str) -> float:
        return self.model.score(self.vector(text))


class Model:
    """What scoring needs: characters, evidence and the weights of the logistic function."""

    def __init__(self, characters: CharModel, evidence: dict[str, float], weights: list[float]):
        self.characters, self.evidence, self.weights = characters, evidence, weights

    def shared(self, spark):
        """The tables as a broadcast of plain values, bounded by alphabets and by the labelled sample."""
        k = np.fromiter(self.characters.tri.keys(), np.int64, len(self.characters.tri))
        n = np.fromiter(self.characters.tri.values(), np.float64, len(self.characters.tri))
        return spark.sparkContext.broadcast((k, n, self.evidence, self.weights))

    @staticmethod
    def of(tables: tuple) -> Model:
        k, n, evidence, weights = tables
        return Model(CharModel(k, n), evidence, weights)

    def score(self, v) -> float:
        z = self.weights[0] + sum(w * x for w, x in zip(self.weights[1:], v))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _logistic(x: np.ndarray, y: np.ndarray) -> list[float]:
    """Weights by damped Newton steps with a small ridge; weights of evidence are at least 0."""
    a = np.column_stack([np.ones(len(x)), x])

    def loss(cols: np.ndarray, v: np.ndarray) -> float:
        z = cols @ v
        return float((np.logaddexp(0, z) - y * z).sum() + 5e-2 * (v @ v))

    active = np.ones(a.shape[1], bool)
    while True:
        b, v = a[:, active], np.zeros(int(active.sum()))
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(b @ v, -500, 500)))
            h = b.T @ (b * (p * (1 - p))[:, None]) + 1e-1 * np.eye(b.shape[1])
            step, t, now = np.linalg.solve(h, b.T @ (y - p) - 1e-1 * v), 1.0, loss(b, v)
            while t > 1e-6 and loss(b, v + t * step) > now:
                t /= 2
            v = v + t * step
            if np.abs(t * step).max() < 1e-8:
                break
        w = np.zeros(a.shape[1])
        w[active] = v
        if (w[1:] >= 0).all():
            return w.tolist()
        active &= np.concatenate([[True], w[1:] >= 0])


def fit(spark, documents: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model:
    """Characters from all ``documents``, evidence and weights from at most ``max_labelled``
    labelled rows that aren't held out. Without both kinds of labels every score is the prior."""
    s = Scratch(spark, "toxicity")
    # 16 bytes a trigram of letters below U+0800
    trigrams = count_trigrams(documents).toPandas().sort_values("key")
    characters = CharModel(trigrams["key"].to_numpy(np.int64), trigrams["n"].to_numpy(np.float64))
    sample = labelled_sample(s, documents, labels, max_labelled)
    train = decoded(s, sample, characters)
    s.drop(sample)
    evidence = _evidence(s, train)

    heads = heads_of(evidence)

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            v = [_strengths(dict(_weighed(set(words.split()), evidence, heads))) for words in pdf["words"]]
            yield pd.DataFrame(v, columns=["a", "b", "c"]).assign(toxic=pdf["toxic"].to_numpy())

    rows = train.mapInPandas(releasing(vectors), "a double, b double, c double, toxic int").toPandas()  # at most max_labelled rows
    s.drop(train)
    y = rows["toxic"].to_numpy(np.float64)
    if not len(y) or y.min() == y.max() or not evidence:
        p = min(max(float(y.mean()) if len(y) else 0.0, 1e-6), 1 - 1e-6)
        return Model(characters, {}, [math.log(p / (1 - p)), 0.0, 0.0, 0.0])
    # by row, so that the order of the tasks doesn't show in the last digits
    rows = rows.sort_values(["a", "b", "c", "toxic"])
    return Model(characters, evidence, _logistic(rows[["a", "b", "c"]].to_numpy(), rows["toxic"].to_numpy(np.float64)))


def score(documents: DataFrame, model: Model, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``(*keys, score)`` per row: a pass over the texts, no shuffle. A null text is an empty one."""
    spark = documents.sparkSession
    held = model.shared(spark)
    source = documents.select(*keys, text_column(documents).alias("_text"))
    schema = ", ".join([*[f"`{k}` {source.schema[k].dataType.simpleString()}" for k in keys], "score double"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(Model.of(held.value))
        for pdf in batches:
            out = pdf.drop(columns="_text")
            out["score"] = [scorer.score(t) for t in pdf["_text"]]
            yield out

    return source.mapInPandas(releasing(run), schema)


def score_documents(spark, documents: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per document.

    Only the texts enter a score; labels only of rows that aren't held out are learned. Null and
    empty texts get the score of a text without evidence; texts of any length are read whole; repeated rows get
    equal scores; other columns, whatever their names, aren't read; an empty table gives an empty result.
    """
    out = score(documents, fit(spark, documents, labels, max_labelled))
    return out.select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def clean_rows(spark, documents: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """The rows of ``documents`` that aren't predicted toxic, with all their columns."""
    model = fit(spark, documents, labels, max_labelled)
    held = model.shared(spark)

    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(Model.of(held.value))
        for texts in batches:
            yield pd.Series([scorer.score(t or "") for t in texts], dtype="float64")

    @F.pandas_udf("double")
    def toxic_score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from releasing(scores)(batches)

    return documents.filter(toxic_score(F.col("text")) < THRESHOLD)
