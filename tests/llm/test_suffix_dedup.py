import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from edge import edge_docs, empty_docs, rows

from tallyspark.llm.suffix_dedup import dedup_report, dedup_spans, remove_spans
from tallyspark.llm.suffix_sort import Prefixes, repeated

SF = "/root/testdata/sf0.001"


def brute(docs, length):
    count = Counter(t[i : i + length] for _, t in docs for i in range(len(t) - length + 1))
    out = []
    for doc_id, t in docs:
        spans = []
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + length
                else:
                    spans.append([i, i + length])
        kept = remove_spans(t, spans)
        sha = hashlib.sha256(kept).hexdigest()
        out.append((doc_id, len(t), len(t) - len(kept), len(spans), sha))
    return sorted(out, key=repr)


def pieces(seed):
    """Texts put together from shared passages, runs of one letter and own letters."""
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abcd") for _ in range(rng.randint(5, 60))) for _ in range(6)]
    texts = []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(0, 5)):
            own = "".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 30)))
            parts += [own, rng.choice([*passages, "z" * rng.randint(1, 40)])]
        texts.append((i, "".join(parts)))
    return [*texts, (60, texts[0][1]), (61, ""), (62, None), (63, "é" * 30)]


@pytest.mark.parametrize("seed, sorted_classes", [(1, 10_000), (2, 3)])
def test_equals_brute_force(spark, seed, sorted_classes):
    docs = pieces(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = dedup_report(df, length=12, gram=4, sorted_classes=sorted_classes)
    assert sorted(map(tuple, got.collect()), key=repr) == brute([(i, (t or "").encode()) for i, t in docs], 12)


def test_whole_table(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    docs = [(r.doc_id, (r.text or "").encode()) for r in df.select("doc_id", "text").collect()]
    assert sorted(map(tuple, dedup_report(df).collect()), key=repr) == brute(docs, 200)


def test_edge_cases(spark):
    got = dedup_spans(edge_docs(spark)).collect()
    assert len(got) == len(rows())
    for r in got:
        whole = [(0, len(r.text))] if r.doc_id == 6 else []
        assert [(s.start, s.end) for s in r.spans] == whole
    assert dedup_report(empty_docs(spark)).count() == 0


def test_mergesort_marks_equal_suffixes():
    rng = np.random.default_rng(0)
    for _ in range(100):
        n, length = int(rng.integers(20, 200)), int(rng.integers(1, 8))
        data = rng.integers(97, 97 + rng.integers(1, 4), n).astype(np.uint8)
        start = np.arange(n - length + 1)
        group = rng.integers(0, rng.integers(1, 5), len(start))
        keys = [(group[i], data[i : i + length].tobytes()) for i in start]
        count = Counter(keys)
        want = [count[k] > 1 for k in keys]
        assert repeated(Prefixes(data), start, group, length).tolist() == want


def test_hash_collisions_are_caught_by_bytes():
    # Modulo 2**64 a Thue-Morse string and its complement have equal polynomial hashes.
    bits = [bin(i).count("1") % 2 for i in range(4096)]
    one, other = np.array(bits, np.uint8) + 97, 1 - np.array(bits, np.uint8) + 97
    text = Prefixes(np.concatenate([one, other]))
    at, size = np.array([0, 4096]), np.array([4096, 4096])
    hashes = text.span(at, size)
    assert hashes[0] == hashes[1]
    assert text.compare(np.array([0]), np.array([4096]), 4096)[0] == -1
    assert not repeated(text, at, np.zeros(2, int), 4096).any()
