"""Repeated passages by suffix arrays: bytes covered by a 50-byte string that also starts in a document
of a smaller id.

Only strings of 50 bytes (windows) that two texts share matter, and equal windows must meet. Each window
has an anchor that its bytes decide, the least hash of its 16-byte substrings, so equal windows have
equal anchors. The work is:

* anchors: every text's distinct anchors (one for about 20 bytes) are packed, dealt by hash, and those
  that two different texts hold are sent back to these texts. Texts of equal bytes count as one, and
  a task packs them once. Anchors that several texts of a task share are dealt by (hash, text) first,
  where holders are counted, so that no task gets all holders of a frequent anchor;
* segments: the runs of windows of one shared anchor are cut out of the texts and dealt to shards by
  the anchor;
* shards: distinct segments are sorted as a suffix array by Larsson-Sadakane refinement in numpy
  (ranks by 8 bytes, then by twice as many in each round, only in groups not yet told apart); Kasai's common
  prefixes, with all segments advancing side by side, find the runs of equal windows. A group of more
  than ``SHARD_BYTES`` is several shards, whose sorted windows are merged by binary search;
* spans: an occurrence is removed where its window has a smaller id, and texts that lose bytes are
  rebuilt.

An anchor that more than ``hot`` texts hold (a passage in a third of all documents) isn't sent to one
shard: its distinct segments, with the smallest id of each by partial minima, are cut into windows, and
equal windows are grouped by their bytes. ``hot`` is at least 2^14 and such that at most 2^22 anchors
are hot, a proven bound for what tasks are told.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import as_strided
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.scratch import Scratch, forget_shuffles, text_column

LENGTH = 50  # bytes of a repeated string
GRAM = 16  # bytes of an anchor
SPAN = LENGTH - GRAM + 1  # anchors' places in a window
GROUP_BYTES = 1 << 20  # bytes of texts worked on together
PART_BYTES = 4 << 20  # packed anchors dealt to one group
SHARD_BYTES = 2 << 20  # segments dealt to one group, and in one suffix array
HOT, MAX_HOT = 1 << 14, 1 << 22
OFTEN = 4  # texts of GROUP_BYTES that share an anchor: it's dealt in two steps
LAST = (1 << 63) - 1  # larger than any order

_GOLDEN, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_LOW48 = np.uint64((1 << 48) - 1)


# ---- anchors -------------------------------------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def _words(b: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on, as native integers."""
    return as_strided(b, (len(b) - 7, 8), (1, 1)).copy().view(np.uint64).ravel()


def _sliding(x: np.ndarray, width: int, f) -> np.ndarray:
    """f over each ``width`` neighbours."""
    n, span = len(x) - width + 1, 1
    while span * 2 <= width:
        x = f(x[:-span], x[span:])
        span *= 2
    return f(x[:n], x[width - span : width - span + n])


class Texts:
    """Texts of at least LENGTH bytes, side by side, with the anchor hash of every window."""

    def __init__(self, texts: list[bytes]):
        self.lengths = np.array([len(t) for t in texts], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.data = b"".join(texts)
        b = np.frombuffer(self.data, np.uint8)
        w = _words(b)
        self.grams = _mixed((_mixed(w[: len(b) - GRAM + 1] * _GOLDEN) ^ w[8 : 8 + len(b) - GRAM + 1]) * _GOLDEN)
        self.grams |= np.uint64(1)
        self.anchors = _sliding(self.grams, SPAN, np.minimum)
        inside = np.ones(len(self.anchors), bool)  # windows that don't cross into the next text
        ends = (self.starts + self.lengths)[:-1]
        cross = (ends[:, None] - np.arange(1, LENGTH)[None, :]).ravel()
        inside[cross[(cross >= 0) & (cross < len(inside))]] = False
        self.inside = inside

    def distinct_anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """(text number, anchor), each pair once."""
        change = np.flatnonzero(np.concatenate([[True], self.anchors[1:] != self.anchors[:-1]]) & self.inside | self._first())
        doc = np.searchsorted(self.starts, change, "right") - 1
        h = self.anchors[change]
        order = np.lexsort((h, doc))
        doc, h = doc[order], h[order]
        new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])])
        return doc[new], h[new]

    def _first(self) -> np.ndarray:
        first = np.zeros(len(self.anchors), bool)
        first[self.starts] = True
        return first

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text number, first window, windows, anchor) of runs of one anchor, at most SPAN windows."""
        begin = np.concatenate([[True], (self.anchors[1:] != self.anchors[:-1]) | (self.inside[1:] != self.inside[:-1])]) | self._first()
        at = np.flatnonzero(begin)
        n = np.diff(np.append(at, len(self.anchors)))
        ok = self.inside[at]
        at, n = at[ok], n[ok]
        pieces = -(-n // SPAN)
        back = np.repeat(np.arange(len(at)), pieces)
        step = np.arange(len(back)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first = at[back] + step * SPAN
        size = np.minimum(n[back] - step * SPAN, SPAN)
        return np.searchsorted(self.starts, first, "right") - 1, first, size, self.anchors[first]


def _part(h: np.ndarray, parts: int) -> np.ndarray:
    return (((h >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def _key(h: np.ndarray, parts: int) -> np.ndarray:
    """What stands for an anchor once it is dealt: 48 bits of it, and 16 of its part's number."""
    return ((h & _LOW48) | ((_part(h, parts).astype(np.uint64) & np.uint64(0xFFFF)) << np.uint64(48))).view(np.int64)


def _groups(pdf: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, list[bytes]]]:
    """Rows with texts of at least LENGTH bytes, about GROUP_BYTES at a time."""
    at, made = [], []
    size = 0
    for n, t in enumerate(pdf["text"]):
        t = bytes(t)
        if len(t) >= LENGTH:
            at.append(n)
            made.append(t)
            size += len(t)
        if size >= GROUP_BYTES:
            yield pdf.iloc[at], made
            at, made, size = [], [], 0
    if made:
        yield pdf.iloc[at], made


def _packed(part: int, salt: int, th: np.ndarray, low: np.ndarray, top: np.ndarray) -> tuple:
    """One row of (text, anchor) pairs, sorted by text: texts, anchors of each, 6 bytes an anchor; and
    the anchors known to be hot."""
    first = np.flatnonzero(np.concatenate([[True], th[1:] != th[:-1]])) if len(th) else np.empty(0, np.int64)
    n = np.diff(np.append(first, len(th))).astype("<u4")
    six = lambda x: x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
    return part, salt, th[first].astype("<i8").tobytes(), n.tobytes(), six(low), six(top)


def _unpacked(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct (text, anchor) pairs sorted by anchor, and the distinct hot anchors."""

    def eight(column: str) -> np.ndarray:
        raw = np.frombuffer(b"".join(pdf[column]), np.uint8).reshape(-1, 6)
        out = np.zeros((len(raw), 8), np.uint8)
        out[:, :6] = raw
        return out.view("<u8").ravel()

    th = np.frombuffer(b"".join(pdf["th"]), "<i8")
    th, low = np.repeat(th, np.frombuffer(b"".join(pdf["n"]), "<u4")), eight("low")
    order = np.lexsort((th, low))
    th, low = th[order], low[order]
    if len(th):
        new = np.concatenate([[True], (th[1:] != th[:-1]) | (low[1:] != low[:-1])])
        th, low = th[new], low[new]
    return th, low, np.unique(eight("top"))


def _holders(low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted anchors the first place of each, and how many equal it."""
    begin = np.concatenate([[True], low[1:] != low[:-1]]) if len(low) else np.empty(0, bool)
    run = np.cumsum(begin) - 1
    return begin, np.bincount(run)[run] if len(low) else run


def shared_anchors(s: Scratch, texts: DataFrame, parts: int, hot: int, salts: int) -> DataFrame:
    """``(th, keys)``: per text the keys of its anchors that another text has too; under a null th the
    anchors that more than ``hot`` texts have, which are in no other list."""
    schema = "part int, salt int, th binary, n binary, low binary, top binary"
    columns, none = ["part", "salt", "th", "n", "low", "top"], np.empty(0, np.uint64)

    def pack(batches: Iterator[pd.DataFrame], often: bool) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()  # copies of a text of this task have nothing to add
        for pdf in batches:
            pdf = pdf[[x not in seen and not seen.add(x) for x in pdf["th"].tolist()]]
            for rows, made in _groups(pdf):
                doc, h = Texts(made).distinct_anchors()
                _, which, n = np.unique(h, return_inverse=True, return_counts=True)
                part, th, low = _part(h, parts), rows["th"].to_numpy(np.int64)[doc], h & _LOW48
                mine = np.flatnonzero((n[which] >= OFTEN) == often)
                salt = th % salts if often else np.full(len(th), -1)
                order = mine[np.lexsort((th[mine], salt[mine], part[mine]))]
                if not len(order):
                    continue
                part, salt, th, low = part[order], salt[order], th[order], low[order]
                edges = np.append(np.flatnonzero(np.concatenate([[True], (part[1:] != part[:-1]) | (salt[1:] != salt[:-1])])), len(part))
                out = [_packed(int(part[a]), int(salt[a]), th[a:b], low[a:b], none) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
                yield pd.DataFrame(out, columns=columns)

    def fold(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        th, low, _ = _unpacked(pdf)
        begin, n = _holders(low)
        some, top = n <= hot, low[(n > hot) & begin]
        th, low = th[some], low[some]
        order = np.argsort(th, kind="stable")
        return pd.DataFrame([_packed(int(key[0]), -1, th[order], low[order], top)], columns=columns)

    def match(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        th, low, known = _unpacked(pdf)
        begin, n = _holders(low)
        keyed = lambda x: (x | (np.uint64(key[0] & 0xFFFF) << np.uint64(48))).view(np.int64)
        told = np.isin(low, known)
        some, top = (n > 1) & (n <= hot) & ~told, np.union1d(known, low[(n > hot) & begin])
        out = pd.DataFrame({"th": pd.array(th[some], "Int64"), "key": keyed(low[some])})
        return pd.concat([out, pd.DataFrame({"th": pd.array([None] * len(top), "Int64"), "key": keyed(top)})])

    # read twice: a table of the packed anchors would be as large as the texts
    seldom, often = (texts.select("th", "text").mapInPandas(lambda x, often=o: pack(x, often), schema) for o in (False, True))
    dealt = seldom.unionByName(often.groupBy("part", "salt").applyInPandas(fold, schema))
    found = dealt.groupBy("part").applyInPandas(match, "th bigint, key bigint")
    return s.keep(found.groupBy("th").agg(F.collect_list("key").alias("keys")))


# ---- suffix arrays -------------------------------------------------------------------------------


def suffix_array(data: bytes) -> np.ndarray:
    """The sorted suffixes of ``data`` by Larsson-Sadakane refinement: ranks by the first 8 bytes, then
    by twice as many in each round. A rank is the first place of its group, and only groups of several
    suffixes are sorted again, by the ranks ``h`` further on. (Of suffixes of under 8 bytes that differ
    in zeros at the end only, the order is open.)"""
    n = len(data)
    if not n:
        return np.empty(0, np.int64)
    b = np.frombuffer(data + bytes(8), np.uint8)
    word = _words(b)[:n].byteswap()
    sa = np.argsort(word)
    sorted_ = word[sa]
    start = np.concatenate([[True], sorted_[1:] != sorted_[:-1]])
    places = np.arange(n)
    rank = np.zeros(n + 1, np.int64)  # behind the end: less than any
    first = np.maximum.accumulate(np.where(start, places, 0))
    rank[sa] = first + 1
    h = 8
    while h < n + 8:
        alone = start & np.append(start[1:], True)
        slots = np.flatnonzero(~alone)
        if not len(slots):
            break
        idx = sa[slots]
        key = rank[idx] * np.int64(n + 2) + rank[np.minimum(idx + h, n)]
        order = np.argsort(key)
        idx, key = idx[order], key[order]
        sa[slots] = idx
        new = np.concatenate([[True], key[1:] != key[:-1]])
        start[slots] = new
        rank[idx] = np.maximum.accumulate(np.where(new, slots, 0)) + 1
        h *= 2
    return sa


def common_prefixes(data: bytes, sa: np.ndarray, starts: np.ndarray, counts: np.ndarray, most: int = LENGTH) -> np.ndarray:
    """Kasai: per place of ``sa`` the common prefix with the suffix before it, up to ``most``; only for
    the ``counts`` suffixes from each of ``starts`` on. From one suffix to the next in the text the
    common prefix falls by one at most; all starts advance together."""
    n = len(data)
    b = np.frombuffer(data + bytes(most), np.uint8)
    place = np.empty(n, np.int64)
    place[sa] = np.arange(n)
    before = np.empty(n, np.int64)
    before[sa[1:]] = sa[:-1]
    before[sa[0]] = -1
    lcp = np.zeros(n, np.int64)
    at, left = starts.astype(np.int64).copy(), counts.astype(np.int64).copy()
    have = np.zeros(len(at), np.int64)
    while len(at):
        other = before[at]
        grow = np.flatnonzero(other >= 0)
        have[other < 0] = 0
        while len(grow):
            grow = grow[have[grow] < most]
            grow = grow[b[at[grow] + have[grow]] == b[np.minimum(other[grow] + have[grow], n + most - 1)]]
            have[grow] += 1
        lcp[place[at]] = have
        at, left, have = at + 1, left - 1, np.maximum(have - 1, 0)
        if not left.all():
            on = left > 0
            at, left, have = at[on], left[on], have[on]
    return lcp


class Shard:
    """Distinct segments, each with the smallest order of its holders; windows in sorted groups."""

    def __init__(self, segments: list[bytes], owners: np.ndarray):
        lengths = np.array([len(x) for x in segments], np.int64)
        begin = np.cumsum(lengths) - lengths
        self.data = b"".join(segments)
        sa = suffix_array(self.data)
        counts = lengths - LENGTH + 1
        lcp = common_prefixes(self.data, sa, begin, counts)
        segment = np.repeat(np.arange(len(segments)), lengths)
        offset = np.arange(len(sa)) - begin[segment]
        window = (offset < counts[segment])[sa]  # suffixes that start a whole window
        # a suffix that is no window may stand between two equal windows: carry the least prefix over it
        lcp_w = self._between(lcp, window, sa)
        self.at = sa[window]
        self.segment, self.offset = segment[self.at], offset[self.at]
        first = np.concatenate([[True], lcp_w[1:] < LENGTH]) if len(self.at) else np.empty(0, bool)
        self.group = np.cumsum(first) - 1
        self.heads = self.at[first]
        self.least = np.full(len(self.heads), LAST)
        np.minimum.at(self.least, self.group, owners[self.segment])

    def _between(self, lcp: np.ndarray, window: np.ndarray, sa: np.ndarray) -> np.ndarray:
        """Common prefixes of neighbouring windows: Kasai's where they are neighbours in the suffix
        array, else by comparing bytes."""
        places = np.flatnonzero(window)
        out = lcp[places]
        apart = np.flatnonzero(np.diff(places) > 1) + 1
        if len(apart):
            b = np.frombuffer(self.data, np.uint8)
            x, y = sa[places[apart]], sa[places[apart - 1]]
            same = np.ones(len(apart), bool)
            for i in range(0, LENGTH):
                same &= b[x + i] == b[y + i]
            out[apart] = np.where(same, LENGTH, 0)
        return out

    def sorted_windows(self) -> np.ndarray:
        """The groups' windows as fixed-length bytes, in order (an end mark keeps last zeros)."""
        b = np.frombuffer(self.data, np.uint8)
        rows = np.empty((len(self.heads), LENGTH + 1), np.uint8)
        rows[:, :LENGTH] = b[self.heads[:, None] + np.arange(LENGTH)[None, :]]
        rows[:, LENGTH] = 1
        return rows.view(f"S{LENGTH + 1}").ravel()


def merge(shards: list[Shard]) -> None:
    """Give equal windows of different shards their common least order, by binary search of each
    shard's sorted windows in the others'."""
    keys = [x.sorted_windows() for x in shards]
    for i in range(len(shards)):
        for j in range(i + 1, len(shards)):
            at = np.minimum(np.searchsorted(keys[j], keys[i]), len(keys[j]) - 1)
            a = np.flatnonzero(keys[j][at] == keys[i])
            b = at[a]
            least = np.minimum(shards[i].least[a], shards[j].least[b])
            shards[i].least[a] = least
            shards[j].least[b] = least


def covered(segments: list[bytes], orders: np.ndarray, shard_bytes: int = SHARD_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of the covered ranges of each row's segment, given the rows' orders."""
    index: dict[bytes, int] = {}
    which = np.array([index.setdefault(x, len(index)) for x in segments], np.int64)
    distinct = list(index)
    owner = np.full(len(distinct), LAST)
    np.minimum.at(owner, which, orders)
    sizes = np.array([len(x) for x in distinct], np.int64)
    cut = np.cumsum(sizes) // shard_bytes
    edges = [0, *(np.flatnonzero(np.diff(cut)) + 1).tolist(), len(distinct)]
    shards = [Shard(distinct[a:b], owner[a:b]) for a, b in zip(edges, edges[1:]) if a < b]
    if len(shards) > 1:
        merge(shards)
    seg, off = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for x, a in zip(shards, edges):
        less = x.least[x.group] < owner[a + x.segment]
        seg.append(x.segment[less] + a)
        off.append(x.offset[less])
    seg, off = np.concatenate(seg), np.concatenate(off)
    order = np.lexsort((off, seg))
    seg, off = seg[order], off[order]
    new = np.concatenate([[True], (seg[1:] != seg[:-1]) | (off[1:] != off[:-1] + 1)]) if len(seg) else np.empty(0, bool)
    a = np.flatnonzero(new)
    b = np.append(a[1:], len(seg))[: len(a)] - 1
    run_seg, run_from, run_to = seg[a], off[a], off[b] + LENGTH if len(a) else off
    # rows behind the owner lose the whole segment; the owner's rows its covered runs
    later = np.flatnonzero(orders > owner[which])
    own = np.flatnonzero(orders <= owner[which])
    lo, hi = np.searchsorted(run_seg, which[own], "left"), np.searchsorted(run_seg, which[own], "right")
    n = hi - lo
    rows = np.repeat(own, n)
    pick = np.repeat(lo, n) + np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
    return (
        np.concatenate([later, rows]), np.concatenate([np.zeros(len(later), np.int64), run_from[pick]]),
        np.concatenate([sizes[which[later]], run_to[pick]]),
    )


# ---- the distributed operator --------------------------------------------------------------------


def _spans(s: Scratch, docs: DataFrame, reps: DataFrame, shared: DataFrame, parts: int, groups: int, hot_keys: np.ndarray) -> DataFrame:
    """``(th, spans)``: covered ranges of the texts, as start * 128 + length."""
    # what is known of the texts grows with them: a merge join at every size
    lists = reps.join(shared.filter("th is not null"), "th").hint("merge")
    texts = docs.join(lists, ["th", "ord"]).select("th", "ord", "text", "keys")

    def segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for rows, made in _groups(pdf):
                t = Texts(made)
                doc, first, size, h = t.runs()
                key = _key(h, parts)
                lists = [np.asarray(k, np.int64) for k in rows["keys"]]
                held = np.repeat(np.arange(len(lists)), [len(k) for k in lists])
                tag = lambda d, k: _mixed(k.view(np.uint64) ^ _mixed(d.astype(np.uint64) * _GOLDEN + np.uint64(1)))
                keep = np.isin(tag(doc, key), tag(held, np.concatenate(lists)))
                doc, first, size, key = doc[keep], first[keep], size[keep], key[keep]
                th, order = rows["th"].to_numpy(np.int64), rows["ord"].to_numpy(np.int64)
                data, ends = t.data, (first + size + LENGTH - 1).tolist()
                yield pd.DataFrame({
                    "grp": _part(_mixed(key.view(np.uint64)), groups).astype(np.int32),
                    "seg": [data[a:b] for a, b in zip(first.tolist(), ends)],
                    "ord": order[doc], "th": th[doc], "at": first - t.starts[doc],
                })

    def shard(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        row, a, b = covered([bytes(x) for x in pdf["seg"]], pdf["ord"].to_numpy(np.int64))
        at, th = pdf["at"].to_numpy(np.int64), pdf["th"].to_numpy(np.int64)
        return pd.DataFrame({"th": th[row], "span": (at[row] + a) * 128 + (b - a)})

    cut = texts.mapInPandas(segments, "grp int, seg binary, ord bigint, th bigint, at bigint")
    spans = cut.groupBy("grp").applyInPandas(shard, "th bigint, span bigint")
    if len(hot_keys):
        told = docs.sparkSession.sparkContext.broadcast(np.sort(hot_keys))  # at most MAX_HOT

        def hot_segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            top = told.value
            for pdf in batches:
                for rows, made in _groups(pdf):
                    t = Texts(made)
                    doc, first, size, h = t.runs()
                    keep = np.isin(_key(h, parts), top)
                    doc, first, size = doc[keep], first[keep], size[keep]
                    th, order = rows["th"].to_numpy(np.int64), rows["ord"].to_numpy(np.int64)
                    yield pd.DataFrame({
                        "seg": [t.data[a : a + n + LENGTH - 1] for a, n in zip(first.tolist(), size.tolist())],
                        "ord": order[doc], "th": th[doc], "at": first - t.starts[doc],
                    })

        def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                segments, n = [bytes(x) for x in pdf["seg"]], [len(x) - LENGTH + 1 for x in pdf["seg"]]
                yield pd.DataFrame({
                    "window": [x[i : i + LENGTH] for x, k in zip(segments, n) for i in range(k)], "off": [i for k in n for i in range(k)],
                    "sid": np.repeat(pdf["sid"].to_numpy(np.int64), n), "o": np.repeat(pdf["o"].to_numpy(np.int64), n),
                })

        held = docs.select("th", "ord", "text").mapInPandas(hot_segments, "seg binary, ord bigint, th bigint, at bigint")
        held = s.keep(held.join(reps, ["th", "ord"]))
        owners = s.keep(held.groupBy("seg").agg(F.min("ord").alias("o")).withColumn("sid", F.monotonically_increasing_id()))
        cut = s.keep(owners.mapInPandas(windows, "window binary, off bigint, sid bigint, o bigint"))
        lost = cut.join(cut.groupBy("window").agg(F.min("o").alias("least")), "window").filter("o > least").select("sid", "off")
        held = held.join(owners, "seg").select("th", "ord", "at", "sid", "o", F.octet_length("seg").alias("n"))
        # holders behind a segment's first lose all of it, the first its windows that have a smaller id
        later = held.filter("ord > o").select("th", (F.col("at") * 128 + F.col("n")).alias("span"))
        own = held.filter("ord = o").join(lost, "sid").select("th", ((F.col("at") + F.col("off")) * 128 + LENGTH).alias("span"))
        spans = spans.unionByName(later).unionByName(own)
    return s.keep(spans.groupBy("th").agg(F.collect_list("span").alias("spans")))  # a list is bounded by its text


def remove_spans(text: bytes, spans: np.ndarray) -> tuple[int, int, bytes]:
    """Bytes removed, maximal removed runs, and what is left."""
    a, b = spans // 128, spans // 128 + spans % 128
    order = np.argsort(a, kind="stable")
    a, reach = a[order], np.maximum.accumulate(b[order])
    new = np.concatenate([[True], a[1:] > reach[:-1]])
    begin = a[new]
    end = reach[np.append(np.flatnonzero(new)[1:] - 1, len(a) - 1)]
    kept, at = [], 0
    for x, y in zip(begin.tolist(), end.tolist()):
        kept.append(text[at:x])
        at = y
    kept.append(text[at:])
    return int((end - begin).sum()), len(begin), b"".join(kept)


def text_hash(raw: Column, seed: int) -> Column:
    return F.xxhash64(raw, F.lit(seed))


def identified(s: Scratch, documents: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents ``(doc_id, ord, th, text)``, their rows without the text, and the texts of at least
    LENGTH bytes ``(th, o)`` with their smallest id. ``th`` is a 64-bit hash that is told apart by SHA-256:
    where two texts share one (n^2 / 2^65 are expected among n texts) both get another."""
    raw = text_column(documents).cast("binary")
    th, seed = text_hash(raw, 0), 0
    while True:
        docs = documents.select("doc_id", F.col("doc_id").cast("bigint").alias("ord"), th.alias("th"), raw.alias("text"))
        rows = s.keep(docs.select("doc_id", "ord", "th", F.octet_length("text").cast("bigint").alias("n_bytes"), F.sha2("text", 256).alias("sha")))
        reps = s.keep(
            rows.filter(f"n_bytes >= {LENGTH} AND ord IS NOT NULL").groupBy("th")
            .agg(F.min("ord").alias("o"), (F.min("sha") != F.max("sha")).alias("several"))
        )
        taken = [r["th"] for r in reps.filter("several").select("th").collect()]
        if not taken:
            return docs, rows, reps.select("th", "o")
        s.drop(rows, reps)
        seed += 1
        th = F.when(th.isin(taken), text_hash(raw, seed)).otherwise(th)


def dedup_passages(spark, documents: DataFrame, hot: int | None = None) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)``, one row per document.

    A null text is an empty one. Documents of one id don't cover each other; a document of a null id
    loses nothing and covers nothing. Of documents of equal bytes all but those of the smallest id lose
    everything (if they have 50 bytes). Shorter texts lose nothing; an empty table gives an empty
    result. Other columns, whatever their names, aren't read.
    """
    s = Scratch(spark, "suffix")
    docs, rows, reps = identified(s, documents)
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    anchors = total // 20  # about one for 20 bytes
    parts = max(4, -(-anchors * 10 // PART_BYTES))
    most = hot if hot is not None else max(HOT, anchors // MAX_HOT)
    salts = max(4, math.isqrt(reps.count() // max(most, 1) + 1))
    docs = docs.filter(F.col("ord").isNotNull() & (F.octet_length("text") >= LENGTH))
    shared = shared_anchors(s, docs, parts, most, salts)
    forget_shuffles(spark)
    top = shared.filter("th is null").first()
    n = shared.filter("th is not null").agg(F.sum(F.size("keys"))).first()[0] or 0
    groups = max(4, -(-n * (LENGTH + SPAN) // SHARD_BYTES))
    known = reps.select("th", F.col("o").alias("ord"))
    spans = _spans(s, docs, known, shared, parts, groups, np.array(top["keys"] if top else [], np.int64))
    s.drop(shared)
    forget_shuffles(spark)

    def rebuild(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            made = [remove_spans(bytes(t), np.asarray(x, np.int64)) for t, x in zip(pdf["text"], pdf["spans"])]
            yield pd.DataFrame({
                "th": pdf["th"], "gone": [m[0] for m in made], "runs": [m[1] for m in made], "kept": [hashlib.sha256(m[2]).hexdigest() for m in made],
            })

    lost = s.keep(
        docs.select("th", "ord", "text").join(spans.join(known, "th").hint("merge"), ["th", "ord"]).select("th", "text", "spans")
        .mapInPandas(rebuild, "th bigint, gone bigint, runs bigint, kept string").dropDuplicates(["th"])
    )
    out = rows.join(reps, "th", "left").join(lost, "th", "left")
    copy, known = F.coalesce(F.col("ord") > F.col("o"), F.lit(False)), F.col("ord").isNotNull()
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select(
        "doc_id", "n_bytes",
        F.when(copy, F.col("n_bytes")).when(known, F.coalesce("gone", F.lit(0))).otherwise(0).cast("bigint").alias("n_removed"),
        F.when(copy, F.lit(1)).when(known, F.coalesce("runs", F.lit(0))).otherwise(0).cast("bigint").alias("n_spans"),
        F.when(copy, F.lit(nothing)).when(known, F.coalesce("kept", "sha")).otherwise(F.col("sha")).alias("kept_sha256"),
    )
