from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import NASTY
from tests.llm.test_jaccard import brute_force
from tests.llm.test_measures import brute_hits
from tierforge.llm import sharding

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, stored):
    """What each stage returns, in order, after the documents themselves."""
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for _, step in corpus_pipeline.STAGES:
        out.append(stored(step(spark, out[-1], SF)))
    return out


def ids(df):
    return Counter(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages_keep_the_columns_of_documents(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "accept_quality", "one_of_similar", "drop_contaminated", "mix_to_weights", "shard",
    ]
    assert all(s.columns == stages[0].columns for s in stages[:-1])
    assert stages[-1].columns == [*stages[0].columns, "shard"]


def test_classifier_keeps_clean_documents_and_drops_junk(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = stages[1].select("doc_id").withColumn("kept", F.lit(1))
    rows = labels.join(kept, "doc_id", "left").groupBy("quality").agg(F.count("kept"), F.count("*"))
    rate = {r[0]: r[1] / r[2] for r in rows.collect()}
    assert rate[1] >= 0.99 and rate[0] <= 0.1


def test_one_of_each_group_stays(stages):
    rows = [(r[0], r[1], "") for r in stages[1].select("doc_id", "text").collect()]
    want = Counter(i for i, _, c, _ in brute_force(rows, 5, 80) if i == c)
    assert ids(stages[2]) == want


def test_contaminated_documents_go(spark, stages):
    rows = [tuple(r) for r in stages[2].select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = Counter(i for i, _, n, _ in brute_hits(rows, items) if not n)
    assert ids(stages[3]) == want


def test_mix_and_shards(stages):
    assert set(ids(stages[4]).values()) <= {1, 2}
    assert set(ids(stages[4])) <= set(ids(stages[3]))
    assert ids(stages[5]) == ids(stages[4])
    # A slot has one shard, and the shards' bytes are even (under the first map: 1.5 x the mean).
    rows = stages[5].select(
        "shard", sharding.slot_of(F.col("doc_id")).alias("slot"),
        sharding.byte_size(F.col("text")).alias("size"),
    ).collect()
    assert len({(r["slot"], r["shard"]) for r in rows}) == len({r["slot"] for r in rows})
    held = Counter()
    for r in rows:
        held[r["shard"]] += r["size"]
    assert set(held) == set(range(corpus_pipeline.SHARDS))
    assert max(held.values()) <= 1.03 * sum(held.values()) / corpus_pipeline.SHARDS


def test_run_applies_all_stages(spark, stages):
    assert ids(corpus_pipeline.run(spark, SF)) == ids(stages[-1])


def test_stages_on_nasty_and_empty_documents(spark, stored):
    kinds = spark.read.parquet(f"{SF}/documents.parquet").schema
    rows = [(i, t, None, s, None) for i, t, s in NASTY]
    for docs in (rows, []):
        now = stored(spark.createDataFrame(docs, kinds))
        for _, step in corpus_pipeline.STAGES:
            now = stored(step(spark, now, SF))
        assert now.columns == [*kinds.names, "shard"]
