import zlib

import numpy as np
import pytest
from edge import edge_docs, empty_docs, rows

from tallyspark.llm.sharding import number_at, place_of, shard_rows


@pytest.mark.parametrize("n", [1, 2, 3, 16, 17, 1000, 65536, 100_003])
def test_permutation_and_its_inverse(n):
    numbers = np.arange(n)
    places = place_of(numbers, n, 42)
    assert np.array_equal(np.sort(places), numbers)
    assert np.array_equal(number_at(places, n, 42), numbers)
    if n > 100:
        assert not np.array_equal(places, place_of(numbers, n, 43))
        assert abs(np.corrcoef(numbers, places)[0, 1]) < 0.2


def check(got, n, shards):
    sizes = [sum(r.shard == s for r in got) for s in range(shards)]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))


def test_rows_differ_by_one_at_most(spark):
    docs = spark.range(1003).selectExpr("1003 - id as doc_id", "if(id % 3 = 0, 'same', concat('t', id)) as text")
    got = shard_rows(docs.repartition(7), 24).collect()
    check(got, 1003, 24)
    # The shard follows from the row number alone.
    again = {r.doc_id: (r.shard, r.slot) for r in shard_rows(docs.repartition(3), 24).collect()}
    for r in got:
        assert again[r.doc_id] == (r.shard, r.slot)
        place = int(place_of(np.array([r.row_number - 1]), 1003, 42)[0])
        assert (r.shard, r.slot) == (place % 24, place // 24)


def test_edge_cases(spark):
    got = shard_rows(edge_docs(spark), 24).collect()
    check(got, len(rows()), 24)
    want = sorted((i or 0, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in rows())
    assert sorted((r.doc_id or 0, r.size, r.text_crc32) for r in got) == want
    assert shard_rows(empty_docs(spark), 24).count() == 0
