"""The pipeline against a plain version of each stage on the stage's own input."""

import collections

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from test_corpus_operators import DOCS, ODD, brute_components
from tidewheel.llm import mixing, quality, tokens, toxicity

SF = "/root/testdata/sf0.001"


def test_stages_in_turn(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "quality", "near-dedup", "mixing", "packing"]
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = [r for r in docs.collect() if model.score(toxicity.terms(r.text)) < corpus_pipeline.TOXIC]

    def frame(rs):
        return spark.createDataFrame(rs, docs.schema)
    kept = {r.doc_id for r in quality.judge(frame(rows)).where("kept").collect()}
    rows = [r for r in rows if r.doc_id in kept]
    roots = brute_components([(r.doc_id, r.text) for r in rows], 80)
    rows = [r for r in rows if roots[r.doc_id] == r.doc_id]
    copies = {r.doc_id: r.copies for r in mixing.mix_plan(frame(rows)).collect()}
    enc = tokens.Encoder(tokens.default_vocabulary())
    want = collections.Counter()
    for r in rows:
        n = len(enc.encode([r.text])[0]) // 4 + 1
        for k in range(0, n, 2048):
            want[r.doc_id, k // 2048, min(2048, n - k)] += copies[r.doc_id]
    got = corpus_pipeline.run(spark, SF).collect()
    assert collections.Counter((r.doc_id, r.piece, r.length) for r in got) == +want
    load = collections.Counter()
    for r in got:
        load[r.sequence_id] += r.length
    assert max(load.values()) <= 2048


CLASH = ["_toxicity", "row", "_doc", "m", "_lang", "copies", "kept", "text_key", "group"]


@pytest.fixture(scope="module")
def odd(spark):
    d = spark.createDataFrame(ODD, DOCS).withColumn("n_chars", F.length("text").cast("bigint"))
    return d.withColumns({c: F.lit(f"own {c}") for c in CLASH if c not in d.columns})


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_rows(spark, odd, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    got = stage(spark, odd, SF)
    rows = got.collect()
    if name == "packing":
        assert sum(r.length for r in rows if r.doc_id == 2) == 1 and {r.doc_id for r in rows} == {r.doc_id for r in odd.collect()}
    else:
        assert got.columns == odd.columns and all(r[c] == f"own {c}" for r in rows for c in CLASH if c not in ("kept", "m"))
        want = {r for r in odd.collect()}
        assert {r for r in rows} <= want
    assert stage(spark, odd.where("false"), SF).count() == 0
    if name == "near-dedup":
        assert sorted(r.doc_id for r in rows if r.doc_id) == [1, 2, 3, 4, 6] and sum(r.doc_id is None for r in rows) == 2
    if name == "toxicity":
        assert len(rows) == len(ODD)
