"""BPE encoding by speculation and verification, and decoding.

The vocabulary is a tokenizers file whose model is a BPE with word ends over byte symbols. Texts are
split into words as the file's normalizer and pre-tokenizer say; then, per batch of rows:

* speculate: greedy longest match proposes the tokens of each new word;
* verify: a proposal is the BPE encoding exactly when each adjacent pair of tokens is compatible,
  that is when merging the two tokens' own symbols never merges across their border. All new pairs of
  the batch are tested together, in numpy;
* merge: words with an incompatible pair are merged step by step, by the merges' ranks.

When is a pair (a, b) compatible? Tokens are binary trees of merges. Before b's symbols meet a's,
the piece of a next to the border is one of the nodes x on a's right spine, from its rank on until
its parent's rank, and the piece of b one of the nodes y on b's left spine. A merge (x, y) of rank m
happens exactly when both are there at m: m < rank of x's parent, and m <= rank of y's parent (of two
equal merges that overlap the left one comes first). A pair is compatible when no spine nodes x, y
have such a merge. That needs every merge to rank after the merges of its two parts, and one merge
per token; both are checked when the file is read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
from pyspark.sql import DataFrame

from tessera.llm.scratch import releasing, text_column

NEVER = np.iinfo(np.int64).max
NO_RANK = 1 << 40
SHORT = 48  # symbols of a short word
GROUP_CHARS = 1 << 20  # characters of texts whose new words are encoded together
CACHE_BYTES = 1 << 25  # bytes of words and ids that a worker remembers (some 500,000 words); then it starts over
CACHE_PAIRS = 1 << 19  # adjacent pairs of tokens that a worker remembers
# below this code point Python and the tokenizers agree on case and letter classes; other texts are
# normalized and split by the tokenizer file's own steps
COMMON = regex.compile(r"[^\u0000-ԯ‐-‧‰-⁞₠-₿]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where it is a visible Latin-1
    character, else the next free code point from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Bpe:
    """Tables of one vocabulary file and the words seen so far."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"] or ""
        self.symbols = byte_symbols()
        size = 1 + max([*self.vocab.values(), *(t["id"] for t in spec["added_tokens"])])
        self.tokens = [""] * size
        for t, i in self.vocab.items():
            self.tokens[i] = t
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for t, i in self.special.items():
            self.tokens[i] = t
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        left = np.array([self.vocab[a] for a, _ in pairs], np.int64)
        right = np.array([self.vocab[b] for _, b in pairs], np.int64)
        made = np.array([self.vocab[a + b] for a, b in pairs], np.int64)
        ranks = np.arange(len(pairs), dtype=np.int64)
        rank_of = np.full(size, -1, np.int64)
        rank_of[made] = ranks
        if len(set(made.tolist())) < len(made) or (np.maximum(rank_of[left], rank_of[right]) >= ranks).any():
            raise ValueError("the merges of this vocabulary aren't ordered by their parts")
        self.merge = {(a, b): (r, m) for r, a, b, m in zip(ranks.tolist(), left.tolist(), right.tolist(), made.tolist())}
        key = left * size + right
        order = np.argsort(key)
        self.size, self.keys, self.key_rank = size, key[order], ranks[order]
        part = [np.full(size, -1, np.int64) for _ in range(2)]
        part[0][made], part[1][made] = left, right
        self.right_spine, self.left_spine = self._spines(part[1], rank_of), self._spines(part[0], rank_of)
        # the longest token from each first three characters on, so that greedy tries few lengths
        self.reach: dict[str, int] = {}
        for t in self.vocab:
            t = t.removesuffix(self.end)
            for k in (1, 2, 3):
                if len(t) >= k:
                    self.reach[t[:k]] = max(self.reach.get(t[:k], 0), len(t))
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.split_special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.own = Tokenizer.from_file(path)
        self.words: dict[str, bytes] = {}
        self.held = 0  # bytes of the words' ids and letters
        self.known: dict[int, bool] = {}
        self.counted = {"words": 0, "merged": 0}

    @staticmethod
    def _spines(child: np.ndarray, rank_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per token the nodes from itself down by ``child`` (-1: no more), and until which rank each
        of them is there (its parent's)."""
        nodes, until = [np.arange(len(child), dtype=np.int64)], [np.full(len(child), NEVER)]
        while (nodes[-1] >= 0).any():
            top = nodes[-1]
            nodes.append(np.where(top >= 0, child[top], -1))
            until.append(np.where(top >= 0, rank_of[top], -1))
        return np.stack(nodes[:-1], 1), np.stack(until[:-1], 1)

    # ---- words -------------------------------------------------------------------------------

    def pieces(self, text: str) -> list[str]:
        """The words of a text without special tokens, as the file's steps split it."""
        if COMMON.search(text):
            text = self.own.normalizer.normalize_str(text)
            found = [w for w, _ in self.own.pre_tokenizer.pre_tokenize_str(text)]
            back = {s: b for b, s in enumerate(self.symbols)}
            return [bytes(back[c] for c in w).decode("utf-8") for w in found]
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            # a letter's lower case never depends on its neighbours here
            text = "".join(c.lower() for c in text) if "Σ" in text else text.lower()
        else:
            text = text.lower()
        return self.pattern.findall(text)

    def parts(self, text: str) -> Iterator[list[str] | int]:
        """Words of the parts between special tokens, and the special tokens' ids."""
        at = 0
        if self.split_special is not None:
            for m in self.split_special.finditer(text):
                yield self.pieces(text[at : m.start()])
                yield self.special[m[0]]
                at = m.end()
        yield self.pieces(text[at:] if at else text)

    # ---- speculate, verify, merge ------------------------------------------------------------

    def greedy(self, word: str) -> list[int] | None:
        """Longest matches from the left; None where no vocabulary token matches."""
        get, end, reach = self.vocab.get, self.end, self.reach
        out, i, n = [], 0, len(word)
        while i < n:
            most = i + (reach.get(word[i : i + 3]) or reach.get(word[i : i + 2]) or 1)
            if most >= n:
                if (t := get(word[i:] + end)) is not None:
                    out.append(t)
                    return out
                most = n - 1
            for j in range(most, i, -1):
                if (t := get(word[i:j])) is not None:
                    out.append(t)
                    i = j
                    break
            else:
                return None
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Per pair of tokens, whether no merge crosses their border."""
        xs, x_until = self.right_spine[0][a], self.right_spine[1][a]
        ys, y_until = self.left_spine[0][b], self.left_spine[1][b]
        ok = np.ones(len(a), bool)
        for i in range(xs.shape[1]):
            rows = np.flatnonzero(ok & (xs[:, i] >= 0))
            if not len(rows):
                break
            for j in range(ys.shape[1]):
                sub = rows[ys[rows, j] >= 0]
                if not len(sub):
                    break
                key = xs[sub, i] * self.size + ys[sub, j]
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                rank = np.where(self.keys[at] == key, self.key_rank[at], NEVER)
                crosses = (rank < x_until[sub, i]) & (rank <= y_until[sub, j]) & (rank < NEVER)
                ok[sub[crosses]] = False
        return ok

    def merged(self, word: str) -> list[int]:
        """Exact merging: the pair of least rank first, the left one of equals. Short words search the
        least rank in a list; long ones keep a heap of pairs over a linked list, so that a word of n
        symbols takes n log n steps."""
        ids = [self.vocab[c] for c in word[:-1]] + [self.vocab[word[-1] + self.end]]
        n = len(ids)
        if n <= SHORT:
            none = (NO_RANK, -1)
            get = self.merge.get
            todo = [get(p, none) for p in zip(ids, ids[1:])]
            while todo and (least := min(todo))[0] < NO_RANK:
                i = todo.index(least)
                ids[i] = least[1]
                del ids[i + 1], todo[i]
                if i:
                    todo[i - 1] = get((ids[i - 1], ids[i]), none)
                if i < len(todo):
                    todo[i] = get((ids[i], ids[i + 1]), none)
            return ids
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(self.merge[p][0], i, p) for i in range(n - 1) if (p := (ids[i], ids[i + 1])) in self.merge]
        heapq.heapify(heap)
        while heap:
            _, i, p = heapq.heappop(heap)
            j = after[i]
            if ids[i] != p[0] or j < 0 or ids[j] != p[1]:
                continue
            ids[i], ids[j] = self.merge[p][1], -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if (q := (ids[i], ids[k])) in self.merge:
                    heapq.heappush(heap, (self.merge[q][0], i, q))
            if (h := before[i]) >= 0 and (q := (ids[h], ids[i])) in self.merge:
                heapq.heappush(heap, (self.merge[q][0], h, q))
        return [t for t in ids if t >= 0]

    def learn(self, words: set[str]) -> None:
        """Encode words that aren't known yet."""
        if not words:
            return
        new = list(words)
        symbols = self.symbols
        spelt = [w if w.isascii() and w.isprintable() else "".join([symbols[b] for b in w.encode("utf-8")]) for w in new]
        guess = [self.greedy(s) for s in spelt]
        lengths = np.array([len(g) if g else 0 for g in guess], np.int64)
        flat = np.array([t for g in guess if g for t in g], np.int64)
        good = lengths > 0
        if len(flat) > 1:
            word_of = np.repeat(np.arange(len(new)), lengths)
            inner = np.flatnonzero(word_of[1:] == word_of[:-1])
            key, back = np.unique(flat[inner] * self.size + flat[inner + 1], return_inverse=True)
            known = np.array([self.known.get(k, -1) for k in key.tolist()], np.int8)
            ask = np.flatnonzero(known < 0)
            if len(ask):
                known[ask] = self.compatible(key[ask] // self.size, key[ask] % self.size)
                self.known.update(zip(key[ask].tolist(), known[ask].tolist()))
            bad = inner[known[back] == 0]
            good[word_of[bad]] = False
        for w, s, g, ok in zip(new, spelt, guess, good.tolist()):
            ids = g if ok else self.merged(s)
            self.words[w] = raw = np.array(ids, "<u4").tobytes()
            self.held += len(raw) + len(w) + 32
        self.counted["words"] += len(new)
        self.counted["merged"] += int((~good).sum())

    # ---- texts -------------------------------------------------------------------------------

    def encode(self, text: str) -> tuple[bytes, str]:
        """Ids as little-endian 32-bit integers, and the decoded text: the ids' tokens with a blank
        between, as this file names no decoder."""
        return next(self.encode_all([text]))

    def encode_all(self, texts) -> Iterator[tuple[bytes, str]]:
        """``encode`` of each text, in order; a group of texts at a time."""
        group, chars = [], 0
        for text in texts:
            group.append(text)
            chars += len(text)
            if chars >= GROUP_CHARS:
                yield from self._encoded(group)
                group, chars = [], 0
        yield from self._encoded(group)

    def _encoded(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        if self.held > CACHE_BYTES:
            self.words.clear()
            self.held = 0
        if len(self.known) > CACHE_PAIRS:
            self.known.clear()
        get, group, new = self.words.get, [], set()
        for text in texts:
            parts = []
            for part in self.parts(text):
                if isinstance(part, int):
                    parts.append([np.array([part], "<u4").tobytes()])
                    continue
                found = [get(w) for w in part]
                if None in found:
                    new.update([w for w, f in zip(part, found) if f is None])
                    parts.append((part, found))
                else:
                    parts.append(found)
            group.append(parts)
        self.learn(new)
        words = self.words
        for parts in group:
            found = []
            for part in parts:
                if isinstance(part, tuple):
                    part = [f or words[w] for w, f in zip(*part)]
                found += part
            raw = b"".join(found)
            yield raw, self.decode(np.frombuffer(raw, "<u4"))

    def decode(self, ids: np.ndarray) -> str:
        return " ".join([self.tokens[i] for i in ids.tolist()])


def encode_documents(documents: DataFrame, vocabulary: str, keys: tuple[str, ...] = ("doc_id",), ids: bool = True) -> DataFrame:
    """``(*keys, n_tokens, ids_sha256, decoded_sha256)`` per row, with ``ids`` (an array) if asked.

    ``vocabulary`` is the file's path on every worker. Rows are independent: no shuffle. A worker
    holds one Arrow batch of texts and works on it, and gives it on, in parts of ``GROUP_CHARS``
    characters (a longer text is a part of its own); of earlier words it remembers ``CACHE_BYTES``. A null
    text is encoded as an empty one: no tokens; texts of any length are encoded whole; columns other
    than the keys and the text aren't read; an empty table gives an empty result.
    """
    # inside, columns go by place: names of any kind can't clash
    source = documents.select(*keys, text_column(documents).alias("_text"))
    fields = [source.schema[k].simpleString().replace(":", "` ", 1) for k in keys]
    schema = ", ".join([*[f"`{f}" for f in fields], "n_tokens bigint", "ids_sha256 string", "decoded_sha256 string", *["ids array<int>"] * ids])
    names = [*keys, "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(vocabulary)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for start, n in _parts(texts):
                raws, b = [], []
                for raw, decoded in bpe.encode_all(texts.slice(start, n).to_pylist()):
                    raws.append(raw)
                    b.append(hashlib.sha256(decoded.encode("utf-8")).hexdigest())
                sizes = [len(raw) // 4 for raw in raws]
                columns = [c.slice(start, n) for c in batch.columns[:-1]]
                columns += [pa.array(sizes, pa.int64()), pa.array([hashlib.sha256(raw).hexdigest() for raw in raws]), pa.array(b)]
                if ids:
                    flat = pa.array(np.frombuffer(b"".join(raws), "<i4"), pa.int32())
                    columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), flat))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return source.mapInArrow(releasing(run), schema)


def _parts(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """``(start, length)`` of neighbouring rows of about ``GROUP_CHARS`` bytes together."""
    lengths = pa.compute.binary_length(texts).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(lengths.tolist()):
        if i > start and held + size > GROUP_CHARS:
            yield start, i - start
            start, held = i, 0
        held += size
    if len(lengths) > start:
        yield start, len(lengths) - start
