import hashlib

import pytest
from edge import edge_docs, empty_docs, rows

from tallyspark.llm.exact_dedup import drop_copies, exact_groups


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_edge_cases(spark, keep):
    got = exact_groups(edge_docs(spark), keep).collect()
    assert len(got) == len(rows())
    groups = {}
    for doc_id, text, *_ in rows():
        groups.setdefault(text or "", []).append(doc_id)
    for text, ids in groups.items():
        mine = [r for r in got if r.text_sha256 == hashlib.sha256(text.encode()).hexdigest()]
        known = [i for i in ids if i is not None]
        best = (min if keep == "smallest" else max)(known) if known else None
        assert sorted(r.doc_id or -1 for r in mine) == sorted(i or -1 for i in ids)
        assert {r.keep_id for r in mine} == {best}
        assert {r.group_size for r in mine} == {len(ids)}
        assert [r.doc_id for r in mine if r.kept] == [best]


def test_empty_table(spark):
    assert exact_groups(empty_docs(spark)).count() == 0


def test_hot_group_keeps_one(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'copy', concat('own ', id)) as text")
    kept = [r.doc_id for r in drop_copies(docs).collect()]
    assert len(kept) == 2001 and 0 in kept and 3 not in kept
