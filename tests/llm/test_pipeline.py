"""The pipeline stage by stage against what each must keep."""

import pytest
from edge import edge_docs, empty_docs, rows
from test_decontamination import brute
from test_simhash import components, plain_fingerprint

import corpus_pipeline as pipeline
from tallyspark.llm import toxicity
from tallyspark.llm.common import table
from tallyspark.session import materialize

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), {}
    for name, stage in pipeline.STAGES:
        out[name] = (docs, materialize(stage(spark, docs, SF), name))
        docs = out[name][1]
    return out


def test_order_and_columns(stages):
    assert list(stages) == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]
    for name, (before, after) in stages.items():
        if name != "sharding":
            assert after.columns == before.columns and after.count() <= before.count()


def test_toxic_documents_go(spark, stages):
    before, after = stages["toxicity"]
    scores = toxicity.toxicity_report(before, table(spark, SF, "labels")).collect()
    assert sorted(r.doc_id for r in after.collect()) == sorted(r.doc_id for r in scores if r.score < 0.7)
    assert 0 < after.count() < before.count()


def test_one_of_each_group_stays(stages):
    before, after = stages["near_duplicates"]
    prints = {r.doc_id: plain_fingerprint(r.text) for r in before.collect()}
    roots = components(set(prints.values()))
    first = {}
    for doc_id, fp in prints.items():
        first[roots[fp]] = min(first.get(roots[fp], doc_id), doc_id)
    assert sorted(r.doc_id for r in after.collect()) == sorted(first.values())


def test_contaminated_documents_go(spark, stages):
    before, after = stages["decontamination"]
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    found = brute([(r.doc_id, r.text) for r in before.collect()], items)
    assert sorted(r.doc_id for r in after.collect()) == sorted(r[0] for r in found if not r[5])


def test_mixing_only_drops_and_keeps_most(stages):
    before, after = stages["mixing"]
    ids = [r.doc_id for r in after.collect()]
    assert len(ids) == len(set(ids)) and set(ids) <= {r.doc_id for r in before.collect()}
    assert len(ids) > 0.6 * before.count()


def test_shards_hold_every_row(stages):
    before, after = stages["sharding"]
    got = after.collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in before.collect())
    sizes = [sum(r.shard == s for r in got) for s in range(24)]
    assert max(sizes) - min(sizes) <= 1 and {r.law for r in got} == {"rows"}


def test_run_gives_the_last_stage(spark, stages):
    got = pipeline.run(spark, SF)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, stages["sharding"][1].collect()))


@pytest.mark.parametrize("docs", [edge_docs, empty_docs])
def test_every_stage_takes_any_table(spark, docs):
    table_ = docs(spark)
    for name, stage in pipeline.STAGES:
        got = stage(spark, table_, SF)
        if name != "sharding":
            assert got.columns == table_.columns
        assert got.count() <= len(rows())
