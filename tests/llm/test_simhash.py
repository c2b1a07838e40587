import random
import re

import xxhash
from edge import edge_docs, empty_docs, rows

from tallyspark.llm.components import smallest_reachable
from tallyspark.llm.simhash import fingerprint_of, near_fingerprints, near_report, one_per_group

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values):
    """value -> smallest value reachable over links of at most three bits."""
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a in parent:
        for b in parent:
            if a < b and (a ^ b).bit_count() <= 3:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {v: find(v) for v in parent}


def signed(v):
    return v - 2**64 if v >= 2**63 else v


def clustered(seed, centres, around, bits):
    rng = random.Random(seed)
    out = set()
    for _ in range(centres):
        centre = rng.getrandbits(64)
        weak = rng.sample(range(64), bits)
        for _ in range(around):
            v = centre
            for b in rng.sample(weak, rng.randint(0, min(bits, 7))):
                v ^= 1 << b
            out.add(v)
    return out


def check_pairs(spark, values):
    fps = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    got = {frozenset((r.a, r.b)) for r in near_fingerprints(fps).collect()}
    ordered = [signed(v) for v in values]
    want = {
        frozenset((a, b))
        for i, a in enumerate(ordered)
        for b in ordered[i + 1 :]
        if ((a ^ b) & (2**64 - 1)).bit_count() <= 3
    }
    assert got == want


def test_all_links_of_scattered_clusters(spark):
    check_pairs(spark, sorted(clustered(1, 30, 20, 12)))


def test_all_links_in_large_blocks(spark):
    # One segment is shared by hundreds: blocks are cut again, down to eight free bits.
    rng = random.Random(2)
    dense = {(7 << 32) | (rng.getrandbits(6) << 3) for _ in range(60)}
    dense |= {(7 << 32) | (5 << 16) | rng.getrandbits(7) for _ in range(120)}
    dense |= {(rng.getrandbits(32) << 32) | 9 for _ in range(100)}
    check_pairs(spark, sorted(dense | clustered(3, 2, 150, 9)))


def test_fingerprints_and_components_of_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    prints = {d.doc_id: plain_fingerprint(d.text) for d in docs}
    roots = components(set(prints.values()))
    smallest = {}
    for doc_id, fp in prints.items():
        smallest[roots[fp]] = min(smallest.get(roots[fp], doc_id), doc_id)
    want = sorted((i, f"{fp:016x}", smallest[roots[fp]]) for i, fp in prints.items())
    got = near_report(spark.read.parquet(f"{SF}/documents.parquet"))
    assert sorted(map(tuple, got.collect())) == want


def test_edge_cases(spark):
    docs = edge_docs(spark)
    got = near_report(docs).collect()
    assert len(got) == len(rows())
    blank = [r for r in got if r.fingerprint == "0" * 16]
    assert sorted((r.doc_id or 0) for r in blank) == [0, 3, 4, 5] and {r.component_id for r in blank} == {3}
    for doc_id, text, *_ in rows():
        assert f"{plain_fingerprint(text):016x}" in {r.fingerprint for r in got if r.doc_id == doc_id}
    kept = one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 3, 6, 7, 8]
    assert near_report(empty_docs(spark)).count() == 0


def test_fewer_words_than_a_shingle():
    assert fingerprint_of(b"One TWO") == xxhash.xxh64_intdigest(b"one two", 42)


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(0, 40)]
    star = [(100, i) for i in range(101, 160)]
    edges = spark.createDataFrame(chain + star + [(500, 500), (2, 1)], "a long, b long")
    got = {r.node: r.root for r in smallest_reachable(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}
