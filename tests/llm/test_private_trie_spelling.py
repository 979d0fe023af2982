"""op11 to op13 against plain loops over the same rows, and hard rows: nulls in any column, empty and long
texts, ties, repeated rows, no rows, and extra columns whose names clash with those used inside."""

import collections
import hashlib
import random
import re
import time
import zlib

import pytest
from pyspark.sql import functions as F

from tessera.llm import pii, prefix_trie, spelling
from tests.llm.test_operators import frame, hard_texts

# ---- personal data -------------------------------------------------------------------------------

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, s):
    digits = re.sub("[^0-9]", "", s)
    if kind == "ip":
        return all(int(x) <= 255 for x in s.split("."))
    if kind == "card":
        total = 0
        for n, c in enumerate(reversed(digits)):
            v = int(c) * (1 + n % 2)
            total += v - 9 * (v > 9)
        return 16 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def plain_base(text):
    return [(k, *m.span()) for k, p in BASE.items() for m in re.finditer(p, text or "") if passes(k, m[0])]


PRIVATE = [
    "mail a.b+c@x-y.example.org, or a@b@c.de or @x.y or q@r", "a@b.c@d.e+x@y.z", "1.2.3.4.5.6.7.8 and 256.1.1.1 and 010.0255.1.1",
    "4111 1111 1111 1111 4111111111111111", "card 4111-1111-1111-1111.", "pay 4465758382889437 4465758382889437 now",
    "+1 (743) 555-3824 +123 +1234567 ++49 30 123456", "Konto DE89 3704 0044 0532 0130 00 BIC", "GB82WEST12345698765432 and GB82WEST12345698765433",
    "write to jane.doe [at] mail [dot] example [dot] org please", "host 2001:db8::ff00:42:8329 at 12:30:45", "call (030) 1234 5678 today", "order 4111111111111111",
    "", None, "é1.2.3.4é ٣.٣.٣.٣ x@ñ.es",
]


def test_base_spans_are_those_of_the_patterns():
    r = random.Random(3)
    texts = [t or "" for t in PRIVATE] + ["".join(r.choice("aB9. @+-()25 é:") for _ in range(r.randrange(60))) for _ in range(3000)]
    texts += ["".join(r.choice(["12", "1.2.3", ".4", "255.", "@", "a@b", ".c", "+1 ", "4111 1111 ", "1111-1111", "x"]) for _ in range(r.randrange(9))) for _ in range(3000)]
    for t in texts:
        found = pii.spans(t)
        assert [s[:3] for s in found if s[4]] == plain_base(t), t
        assert all(s[3] >= pii.THRESHOLD for s in found) and found == sorted(found, key=lambda s: (pii.KINDS.index(s[0]), s[1], s[2]))
        for k in pii.KINDS:
            own = sorted(s[1:3] for s in found if s[0] == k)
            assert all(a[1] <= b[0] for a, b in zip(own, own[1:]))


def test_proposals_are_confirmed_by_checksums_and_context():
    def added(t):
        return [(k, t[a:b]) for k, a, b, _, base in pii.spans(t) if not base]

    assert added("pay 4465758382889437 4465758382889437 now") == [("card", "4465758382889437")] * 2  # one run of 32 digits in the base
    assert added("pay 4465758382889438 4465758382889438 now") == []
    assert added("Konto DE89 3704 0044 0532 0130 00 BIC") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert added("Konto DE88 3704 0044 0532 0130 00 BIC") == []
    assert added("GB82WEST12345698765432 and GB82WEST12345698765433") == [("iban", "GB82WEST12345698765432")]
    assert added("write to jane.doe [at] mail [dot] example [dot] org") == [("email", "jane.doe [at] mail [dot] example [dot] org")]
    assert added("call 030 1234 5678 today") == [("phone", "030 1234 5678")] and added("invoice 030 1234 5678") == []
    assert added("host 2001:db8::ff00:42:8329 at 12:30:45") == [("ip", "2001:db8::ff00:42:8329")]
    assert added("std::vector at 12:30:45") == []


def test_spans_take_linear_time():
    for t in ("1" * 400_000, "a" * 400_000, "1." * 200_000, "+" + " " * 400_000, "a@" * 200_000, "(1" * 200_000, "A1 " * 130_000, "::" * 200_000, "1 a" * 130_000):
        began = time.process_time()
        pii.spans(t)
        assert time.process_time() - began < 5, t[:4]


def test_pii(spark):
    rows = [(i if i % 5 else None, t) for i, t in enumerate(PRIVATE * 2)] + hard_texts()
    found = pii.find_spans(frame(spark, rows))
    got = pii.summaries(found).collect()
    want = collections.Counter()
    for i, t in rows:
        base = plain_base(t)
        n = collections.Counter(k for k, _, _ in base)
        want[i, *[n[k] for k in BASE], hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()] += 1
    assert collections.Counter((x.doc_id, x.n_email, x.n_ip, x.n_card, x.n_phone, x.base_sha256) for x in got) == want
    assert collections.Counter((x.doc_id, x.spans) for x in got) == collections.Counter(
        (i, ",".join(f"{k}:{a}:{b}" for k, a, b, *_ in pii.spans(t or ""))) for i, t in rows
    )
    kept = {x.doc_id: x.text for x in pii.redact(frame(spark, [(1, PRIVATE[0]), (2, PRIVATE[7]), (3, None), (4, "plain")])).collect()}
    assert kept == {1: "mail <email>, or a@<email> or @x.y or q@r", 2: "Konto <iban> BIC", 3: "", 4: "plain"}
    assert pii.summaries(pii.find_spans(frame(spark, []))).collect() == [] and pii.redact(frame(spark, [])).collect() == []


# ---- conversations -------------------------------------------------------------------------------

TURNS = "conv_id bigint, turn bigint, role string, text string, id int, key string, first int, depth int, leaf string"


def plain_trie(rows):
    by = collections.defaultdict(list)
    for c, n, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            by[c].append((n is not None, n or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest(), role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in by.items()}
    convs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        convs[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
    members = collections.defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    out = collections.Counter()
    for p, ms in members.items():
        below = [q for q in members if q[: len(p)] == p]
        ends = ",".join(map(str, sorted(c for c in ms if convs[c] == p)))
        out[
            min(ms), len(p), min(members[p[:-1]]) if p else None, len(ms), children[p], sum(not children[q] for q in below),
            sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q), hashlib.sha256(ends.encode()).hexdigest(),
        ] += 1
    return out


def turns_frame(spark, rows):
    return spark.createDataFrame([(*x, 1, "k", 2, 3, "l") for x in rows], TURNS).repartition(3)


def trie_of(spark, rows):
    got = prefix_trie.build_trie(spark, turns_frame(spark, rows)).collect()
    assert all(x.is_leaf == (x.n_children == 0) for x in got)
    return collections.Counter(
        (x.conv_id, x.depth, x.parent_conv_id, x.n_convs, x.n_children, x.n_leaves, x.saved_tokens, x.ends_sha256) for x in got
    )


def test_prefix_trie(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK_IDS", 3)
    monkeypatch.setattr(prefix_trie, "BATCH_ROWS", 7)
    r = random.Random(8)
    rows = []
    for c in r.sample(range(140), 90):
        n = r.randrange(1, 12)
        rows += [(c, k, r.choice(["user", "bot", None]), r.choice(["a", "é", "", None, "ab"]) if r.random() < 0.3 else "same") for k in range(n)]
    rows += [(200, None, None, None), (200, None, "user", "x"), (200, 3, "a", "bc"), (200, 3, "ab", "c"), (200, 3, "ab", "c")]  # null and equal turn numbers
    rows += [(None, 0, "user", "nobody's"), (None, 1, "bot", "x")]
    rows += [(c, 0, "user", "copy") for c in range(300, 420)]  # one conversation many times, most of them cut off by the start
    rows += [(500, k, "user", "long " * 50) for k in range(600)]
    want = plain_trie(rows)
    assert trie_of(spark, rows) == want
    assert any(k[1] == 0 and k[7] != hashlib.sha256(b"").hexdigest() for k in want)  # some are turnless
    assert trie_of(spark, []) == trie_of(spark, [(None, 0, "user", "x")]) == collections.Counter()
    assert trie_of(spark, [(7, 0, None, None)]) == plain_trie([(7, 0, None, None)])


# ---- spelling ------------------------------------------------------------------------------------


def plain_words(rows):
    counts = collections.Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= 7:
                counts[w] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def plain_variants(rows):
    n = plain_words(rows)
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def variants_of(spark, rows):
    got = spelling.group_variants(spark, frame(spark, rows)).collect()
    assert len({x.word for x in got}) == len(got)
    return {(x.word, x.form, x.root, x.n, x.n_near, x.form_n) for x in got}


@pytest.mark.parametrize("held", [300_000, 5])
def test_spelling(spark, monkeypatch, held):
    monkeypatch.setattr(spelling, "HELD_WORDS", held)
    monkeypatch.setattr(spelling, "BATCH_ROWS", 50)
    r = random.Random(4)
    base = ["".join(r.choice("abé") for _ in range(r.randrange(7, 10))) for _ in range(60)] + ["aaaaaaaa", "abababab", "Bücherei", "ÀÉÎÕÜÝÿ", "z" * 3000]
    words = []
    for w in base:
        words += [w] * r.choice([1, 2, 3, 30, 400])
        for _ in range(4):
            i, c = r.randrange(len(w)), r.choice("abéx")
            words += [w[:i] + c + w[i:], w[:i] + c + w[i + 1 :], w[:i] + w[i + 1 :]] * r.choice([1, 2, 3])
    words += ["chained"] * 3 + ["chaineds"] * 60 + ["chainedst"] * 900
    r.shuffle(words)
    rows = [(k if k % 9 else None, r.choice([" ", ", ", "1", "_"]).join(words[k * 40 : k * 40 + 40])) for k in range(len(words) // 40 + 1)]
    rows += hard_texts() + [(7, "Straßen STRASSEN straßen strassen")] * 2
    want = plain_variants(rows)
    assert any(x[2] != x[1] and x[1] for x in want) and sum(x[4] for x in want) > 100
    assert variants_of(spark, rows) == want
    assert variants_of(spark, []) == variants_of(spark, [(1, None), (2, "few short ones")]) == set()


def test_pivots_are_disjoint_rare_and_least():
    r = random.Random(1)
    for _ in range(500):
        w = "".join(r.choice("abc") for _ in range(r.randrange(7, 14)))
        counts = {a + b: r.randrange(1, 9) for a in "abc" for b in "abc"}
        prefix, places = spelling.gram_prefix(w, counts)
        assert set(prefix) <= set(places) and len(places) <= 4
        chosen = spelling.pivots(prefix, counts)
        best = min(counts[g] + counts[h] for i, g in prefix for j, h in prefix if j - i >= 2)
        assert set(chosen) <= set(prefix) and chosen[1][0] - chosen[0][0] >= 2 and sum(counts[g] for _, g in chosen) == best


def test_levenshtein_counts_code_points(spark):
    row = spark.range(1).select(F.levenshtein(F.lit("bücherei"), F.lit("bucherei"), 1).alias("a"), F.levenshtein(F.lit("bücherei"), F.lit("bcherei"), 1).alias("b")).first()
    assert (row.a, row.b) == (1, 1)
