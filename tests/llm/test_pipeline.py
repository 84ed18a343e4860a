"""The pipeline on the small test tables, stage by stage, and the registered SQL."""

import os

import pytest

import corpus_pipeline
from oracle_check import compare, connect
from roomtide.llm import near_groups, quality, queries, simhash, spaced_seeds, stages
from roomtide.llm.common import shared

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), queries.SQL[name]) == ""


def test_all_operators_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    names = docs.columns
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(shared(stage(spark, kept[-1], SF_DIR), name))
    assert all(k.columns == names for k in kept[:4])
    ids = [{r["doc_id"] for r in k.select("doc_id").collect()} for k in kept]
    assert ids[0] > ids[1] >= ids[2] >= ids[3] == ids[4]
    scored = quality.score_quality(docs, queries.read(spark, SF_DIR, "labels"))
    assert ids[0] - ids[1] == {r["doc_id"] for r in scored.where("predicted = 0").collect()}
    leaks = spaced_seeds.find_leaks(kept[2], queries.read(spark, SF_DIR, "benchmark"))
    assert ids[2] - ids[3] == {r["doc_id"] for r in leaks.collect()}
    texts = [r["text"] for r in kept[2].collect()]
    assert len(texts) == len(set(texts))
    assert corpus_pipeline.run(spark, SF_DIR).count() == kept[4].count()


def test_near_duplicates_are_the_groups_of_the_simhash_operator_and_more(spark):
    """Of every group that op7 links one document stays; so it does where only the shingle sets are alike."""
    words = [f"w{i}" for i in range(400)]
    # two fingerprints of texts with repeats agree in 62 bits while their sets of shingles are far from alike
    base = " ".join(words[:40] * 30)
    near = base + " " + " ".join(words[60:100])
    alike = " ".join(words[100:300]), " ".join([*words[100:299], "other"])
    texts = [near, base, *alike, "quite something else here", None, ""]
    docs = spark.createDataFrame([(10 + i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars int")
    groups = {r.doc_id: r.component_id for r in simhash.simhash_components(docs).collect()}
    assert groups[11] == 10 and near_groups.keep_one(docs).where("doc_id in (10, 11)").count() == 2
    kept = {r.doc_id for r in stages.keep_one_of_each_group(spark, docs, SF_DIR).collect()}
    assert kept == {10, 12, 14, 15}


def test_every_group_of_the_simhash_operator_keeps_one(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = {r.doc_id for r in stages.keep_one_of_each_group(spark, docs, SF_DIR).collect()}
    groups = simhash.simhash_components(docs).collect()
    assert not [r for r in groups if r.doc_id in kept and r.component_id != r.doc_id]
    assert kept <= {r.doc_id for r in near_groups.keep_one(docs).collect()}
