"""The pipeline, stage by stage, against what brute force keeps of each stage's own input."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from scrubline.llm import kneser_ney, mixing
from test_decontaminate import brute
from test_simhash import brute_components, brute_fingerprint
from test_token_shards import expected

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of each stage."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet").withColumn("matches", F.lit("mine")), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(i))
        stage(spark, docs, SF).write.parquet(path)
        made = spark.read.parquet(path)
        out.append((docs, made))
        docs = made
    return out


def rows(df):
    return Counter((r.doc_id, r.text, r.lang, r.source, r.n_chars, r.matches) for r in df.collect())


def test_columns(stages):
    for docs, made in stages[:-1]:
        assert made.columns == docs.columns and made.count() > 0


def test_quality(spark, stages):
    docs, made = stages[0]
    judged = kneser_ney.classify(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    kept = {r.doc_id for r in judged.collect() if r.threshold is None or r.perplexity is None or r.perplexity <= r.threshold}
    assert rows(made) == Counter({r: n for r, n in rows(docs).items() if r[0] in kept})


def test_near_duplicates(stages):
    docs, made = stages[1]
    classes = brute_components([(r.doc_id, brute_fingerprint(r.text)) for r in docs.collect()])
    assert rows(made) == Counter({r: n for r, n in rows(docs).items() if r[0] in {c for _, _, c in classes}})


def test_decontamination(spark, stages):
    docs, made = stages[2]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {r[0] for r in brute([(r.doc_id, r.text) for r in docs.collect()], items) if not r[-1]}
    assert rows(made) == Counter({r: n for r, n in rows(docs).items() if r[0] in clean})


def test_mixing(stages):
    docs, made = stages[3]
    times = {r.doc_id: r.times for r in mixing.with_times(docs).collect()}
    assert rows(made) == Counter({r: times[r[0]] for r in rows(docs) if times[r[0]]})


def test_tokens(stages):
    docs, made = stages[4]
    held = sorted((r.doc_id, r.text) for r in docs.collect())
    assert sorted(map(tuple, made.collect())) == sorted(expected(held))


def test_run(spark, stages):
    assert Counter(map(tuple, corpus_pipeline.run(spark, SF).collect())) == Counter(map(tuple, stages[-1][1].collect()))
