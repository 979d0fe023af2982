"""Cases of which an operator once did less than the whole job."""

import collections
import itertools
import random

import numpy as np

from tessera.llm import line_dedup, toxicity


def all_earlier(rows):
    """n_removed by document, from every earlier text that shares a line; texts and ids are distinct."""
    code = {"": line_dedup.BLANK}
    docs = [(i, [code.setdefault(x.strip(), len(code)) for x in t.split("\n")], [len(x.strip()) for x in t.split("\n")]) for i, t in rows]
    docs.sort(key=lambda d: (d[0] is None, d[0] or 0))
    out = {}
    for n, (i, h, c) in enumerate(docs):
        found = [line_dedup.common_lines(a, h, c) for _, a, _ in docs[:n] if (set(a) & set(h)) - {line_dedup.BLANK}]
        out[i] = len(set().union(*found))
    return out


def test_line_dedup_tries_all_earlier_holders_of_frequent_lines(spark, monkeypatch):
    r = random.Random(8)
    long = [f"a long boilerplate line number {n}" for n in range(6)]
    short = [f"short {n}" for n in range(8)]
    rows = []
    for i in range(240):
        own = [f"only in {i} and nowhere else, {k}" for k in range(3)]
        near = [f"shared by a few texts {i // 4}"] if i % 3 else []
        picked = r.choices(long, k=r.randrange(0, 4)) + r.sample(short, r.randrange(0, 5)) + r.choices(own + near + [""] * 4, k=r.randrange(0, 7))
        r.shuffle(picked)
        rows.append((None if i == 77 else i * 7 % 240, "\n".join([*picked, *own[:1]] if i % 5 else [f"{i}", *picked])))
    # one passage of short lines, whose lines have different first holders
    rows += [(1000, "p1\nshort 0\nx1"), (1001, "p2\nshort 1\nx2"), (1002, "y0\nshort 0\nshort 1\nshort 2\nshort 3\ny"), (1003, "z\nshort 0\nshort 1\nshort 2\nshort 3\nz2")]
    assert len({t for _, t in rows}) == len(rows)
    for rare, slice_ in ((16, 2048), (2, 20)):
        monkeypatch.setattr(line_dedup, "RARE", rare)
        monkeypatch.setattr(line_dedup, "SLICE", slice_)
        got = line_dedup.dedup_lines(spark, spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
        assert {x.doc_id: x.n_removed for x in got} == all_earlier(rows)


def test_line_dedup_goes_on_to_later_holders(spark, monkeypatch):
    """Lines in changing order and twice in a text: many forms, of which the first holders often don't align."""
    monkeypatch.setattr(line_dedup, "RARE", 2)
    monkeypatch.setattr(line_dedup, "SLICE", 30)
    r = random.Random(9)
    lines = [f"a frequent line that is long, number {n}" for n in range(5)] + ["short", "tiny", "twelve chars", ""]
    rows = []
    for i in range(160):
        picked = [r.choice(lines) for _ in range(r.randrange(2, 9))]
        for k in range(r.randrange(1, 4)):
            picked.insert(r.randrange(len(picked) + 1), f"own {i} {k}" if r.random() < 0.7 else f"shared by two, {i // 2} {k}")
        rows.append((i, "\n".join(picked)))
    rows = [(i, t) for n, (i, t) in enumerate(rows) if t not in {x for _, x in rows[:n]}]
    got = line_dedup.dedup_lines(spark, spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {x.doc_id: x.n_removed for x in got} == all_earlier(rows)


def test_runs_around_a_line_are_the_shortest():
    r = random.Random(3)
    for _ in range(2000):
        h = [r.choice([line_dedup.OTHER, 0, 0, 1, 2, 3, 4, 5, 6]) for _ in range(r.randrange(14))]
        c = [max(x, 0) * 3 for x in h]
        every = set()
        for p in range(len(h)):
            runs = [(i, e) for i in range(p + 1) for e in range(p, len(h)) if line_dedup.OTHER not in h[i : e + 1] and sum(c[i : e + 1]) >= 10]
            every |= {(p, i, e) for i, e in runs if not any((x, y) != (i, e) and i <= x and y <= e for x, y in runs)}
        assert sorted(line_dedup.runs_of(h, c, 10)) == sorted(every)


def restorer():
    counts = collections.Counter()
    for w in "you are such an idiot and a moron they say what a stupid loser is that the one we all know".split() * 50:
        a = b = 0
        for ch in w + " ":
            c = 0 if ch == " " else ord(ch)
            counts[(a << 22) | (b << 11) | c] += 1
            a, b = b, c
    return toxicity.Restorer(toxicity.CharModel(np.array(list(counts), np.int64), np.array(list(counts.values()), float)))


def test_toxicity_decodes_doubled_and_accented_letters():
    r = restorer()
    for noisy, clean in (("stuupid", "stupid"), ("morron", "moron"), ("iidiot", "idiot"), ("st\u00fap\u00efd", "stupid"), ("(loserr)", "loser")):
        assert {clean, noisy.strip("()")} <= r.distinct(f"you {noisy} all"), noisy
    assert r.distinct("all such") == {"all", "such"}


def test_toxicity_finds_letters_with_separators_before_them():
    r = restorer()
    for noisy in ("i .d .i .o .t", "i -d -i -o -t", "all,i d i.o.t"):
        assert "idiot" in r.distinct(f"you {noisy}") and "idiot" in r.sequence(f"you {noisy}"), noisy


def spellings(token):
    """Every path through a token's lattice, with its cost under the model, by trying them all."""
    model, out = restorer().model, {}
    for path in itertools.product(*toxicity.lattice(token)):
        text, cost, a, b, ok = "".join(x for x, _ in path), sum(c for _, c in path), 0, 0, True
        for ch in text:
            c = 0 if ch == " " else ord(ch)
            if c == 0 and b == 0:
                ok = False
                break
            cost += model.cost(a, b, c)
            a, b = (0, 0) if c == 0 else (b, c)
        if ok:
            cost += model.cost(a, b, 0) if b else 0.0
            out[text] = min(out.get(text, 1e9), cost)
    return out


def test_viterbi_finds_the_best_of_all_spellings():
    r = random.Random(2)
    m = restorer().model
    tokens = ["1d10t", "m0r0n", "stuupid", "i.d.i", "l-o-5", "$tup1", "st\u00fap\u00efd", "loo0o5", "a!!b", "1.1"]
    tokens += ["".join(r.choice("idot10.-$\u00e9") for _ in range(r.randrange(1, 7))) for _ in range(150)]
    for t in tokens:
        every = spellings(t)
        got = toxicity.restore(m, t)
        assert abs(every[got] - min(every.values())) < 1e-9, t


def test_only_worthless_tokens_are_spared():
    """Whatever spelling the lattice allows: if it has evidence, the skeleton says so."""
    r = random.Random(5)
    evidence = {"moron$": 1.0, "idio": 2.0, "stupi": 1.0, "\u00e9tait$": 1.0, "loss": 1.0}
    worth, heads, seen = toxicity.Worth(evidence), toxicity.heads_of(evidence), 0
    for _ in range(1500):
        w = r.choice(["moron", "idiots", "stupid", "\u00e9tait", "losses", "most", "idea"])
        w = "".join(r.choice([c, c + c, c, {"o": "\u00f6", "i": "\u00ef", "e": "\u00e9", "s": "\u015b"}.get(c, c)]) for c in w)
        words = {"".join(x for x, _ in p) for p in itertools.product(*toxicity.lattice(w))}
        found = toxicity._weighed(words, evidence, heads)
        assert set(found) == {(x, v) for x in words if (v := max(evidence.get(f, 0.0) for f in toxicity.word_features(x))) > 0}
        seen += bool(found)
        assert worth(w) or not found, w
    assert seen > 300


def test_spaced_letters_are_never_passed_over():
    r = random.Random(6)
    found = 0
    for _ in range(20000):
        t = "".join(r.choice("ab1 _.-*\u00b7\u200b\t@$!+|,\u00e9\u4e00\U0001f600") for _ in range(r.randrange(14)))
        match = toxicity.SPACED.search(t) is not None
        found += match
        assert toxicity.may_be_spaced(t) or not match, t
    assert found > 200
