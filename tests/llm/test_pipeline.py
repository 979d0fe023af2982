"""The pipeline: its stages one by one, each against a plain version on a small table."""

import collections
import re

import pytest

import __spark_entry__ as E
import corpus_pipeline as P
from tessera.llm import bag_minhash, toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """docs before and after each stage."""
    at = tmp_path_factory.mktemp("pipeline")
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for i, (_, stage) in enumerate(P.STAGES):
        stage(spark, out[-1], SF).write.parquet(f"{at}/{i}")
        out.append(spark.read.parquet(f"{at}/{i}"))
    return out


def test_stages_in_order(stages):
    assert [n for n, _ in P.STAGES] == ["toxicity", "exact_dedup", "minhash_near_dedup", "mixing", "bpe"]
    assert all(sorted(x.columns) == sorted(stages[0].columns) for x in stages[:-1])


def test_toxic_documents_go(spark, stages):
    scored = toxicity.score_documents(spark, stages[0], spark.read.parquet(f"{SF}/labels.parquet")).collect()
    assert {r.doc_id for r in stages[1].select("doc_id").collect()} == {r.doc_id for r in scored if r.predicted == 0}


def test_one_of_equal_texts_stays(stages):
    least = {}
    for r in stages[1].collect():
        k = re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")
        least[k] = min(least.get(k, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(least.values())


def test_one_of_near_copies_stays(stages):
    rows = sorted((r.doc_id, r.text) for r in stages[2].collect())
    made = [(i, bag_minhash.shingles(t or "")) for i, t in rows]
    parent = {i: i for i, _ in made}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (a, x) in enumerate(made):
        for b, y in made[:n]:
            if bag_minhash.similarity(x[:2], y[:2]) >= 0.8:
                p, q = sorted((find(a), find(b)))
                parent[q] = p
    assert sorted(r.doc_id for r in stages[3].collect()) == sorted({find(i) for i, _ in made})


def test_mix_repeats_whole_rows(stages):
    before = {r.doc_id: r for r in stages[3].collect()}
    times = collections.Counter(r.doc_id for r in stages[4].collect())
    assert set(times) <= set(before) and set(times.values()) <= {1, 2}
    assert all(before[r.doc_id].text == r.text and before[r.doc_id].source == r.source for r in stages[4].collect())


def test_every_row_is_encoded(stages):
    assert collections.Counter(r.doc_id for r in stages[5].collect()) == collections.Counter(r.doc_id for r in stages[4].collect())
    assert all(r.n_tokens == len(r.ids) for r in stages[5].collect())


def test_run_gives_the_same_rows(spark, stages):
    got = collections.Counter((r.doc_id, r.ids_sha256, r.decoded_sha256) for r in P.run(spark, SF).collect())
    assert got == collections.Counter((r.doc_id, r.ids_sha256, r.decoded_sha256) for r in stages[5].collect())


def test_queries_are_registered():
    names = [n for n in E.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    assert "pipeline" in E.queries()
