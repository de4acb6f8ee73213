"""Registered corpus queries against their SQL twins, and the pipeline against its stages' own rules."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as registered
import corpus_pipeline
from firmlake.llm.queries import ORACLE, QUERIES, table, tokenizer_file
from firmlake.session import write_and_read
from tests.harness import compare
from tests.llm.test_operators import brute_components, shingle_sets

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, name):
    assert compare(QUERIES[name](spark, SF_DIR), SF_DIR, ORACLE[name]) is None


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= registered.queries().keys()
    assert [int(name.split("_")[0][2:]) for name in QUERIES] == list(range(1, 14))


def test_pipeline(spark):
    docs = source = table(spark, SF_DIR, "documents")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = write_and_read(stage(spark, docs, SF_DIR), name)
        assert docs.columns == source.columns
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        assert now <= ids
        ids = now
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert sorted(r.doc_id for r in tokens) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    assert {tuple(r) for r in corpus_pipeline.run(spark, SF_DIR).collect()} == {tuple(r) for r in tokens}


def test_stages_keep_the_rows_of_brute_force(spark, tmp_path):
    """Near duplicates, benchmark passages, copies against targets and token ids, on planted cases."""
    chance = random.Random(4)
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(chance.choices(words, k=60)) for _ in range(12)]
    items = [" ".join(chance.choices(words, k=20)), "short item"]
    texts += [texts[0], texts[1] + " more", f"{texts[2]} {items[0]} end", f"{texts[3][:90]} short item {texts[4][:90]}", "short", ""]
    rows = [(i, t, f"s{i % 2}") for i, t in enumerate(texts)] + [(None, texts[5], "s0")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = lambda name: Counter(map(tuple, stages[name](spark, docs, str(tmp_path)).collect()))

    sets = shingle_sets([(d, t) for d, t, _ in rows if d is not None], 5)
    group = brute_components(list(sets), lambda a, b: sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]))
    want = Counter(r for r in rows if r[0] is None or group[r[0]] == r[0])
    assert 12 in group and group[12] == 0 and group[13] == 1 and kept("near_duplicates") == want

    assert kept("decontamination") == Counter(r for r in rows if not any(f" {i} " in f" {r[1]} " for i in items))

    got = kept("mixing")
    sizes, weights = Counter(), {"s0": 1, "s1": 2}
    for _, t, s in rows:
        sizes[s] += len(t.split())
    share = sum(sizes.values()) / sum(weights.values())
    for s, weight in weights.items():
        taken = sum(n * len(t.split()) for (_, t, own), n in got.items() if own == s)
        assert got.keys() <= set(rows) and abs(taken - weight * share) <= 90

    tokenizer = Tokenizer.from_file(tokenizer_file())
    ids = [(d, np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 0], "<u4")) for d, t, _ in rows]
    found = stages["token_ids"](spark, docs, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == Counter((d, len(x), zlib.crc32(x.tobytes())) for d, x in ids)
