"""The prefix trie against plain Python: all nodes, members, totals and hashes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tallyspark.llm.centroids import component_totals
from tallyspark.llm.prefix_trie import prefix_trie, trie_report

SCHEMA = "conv_id long, turn int, role string, text string, depth int, comp string, p1 string, member long"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_trie(conversations):
    """Nodes of {conv_id: [(role, text)]}."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, of in members.items():
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(of) - 1) * (len(node[-1][1]) if node else 0)
            leaves[node[:d]] += not children[node]
    return {
        (min(of), len(node)): (
            min(members[node[:-1]]) if node else None,
            len(of), children[node], leaves[node], saved[node],
            sha(",".join(map(str, sorted(ends[node])))),
        )
        for node, of in members.items()
    }


def rebuilt(rows):
    turns = defaultdict(list)
    for c, t, role, text, *_ in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(of)] for c, of in turns.items()}
    out = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + mine[h:]
    return out


def found(df):
    got = df.select(*COLUMNS).collect()
    assert len({tuple(r)[:2] for r in got}) == len(got)
    return {tuple(r)[:2]: tuple(r)[2:] for r in got}


def random_rows(seed, conversations=120):
    rng = random.Random(seed)
    rows = []
    for c in [*rng.sample(range(600), conversations), None]:
        for t in range(rng.choice([1, 2, 3, 4, 8, 30])):
            turn = rng.choice([None, t, t, t, t // 2])
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(["a", "b", None, "Ü\U0001f600"])))
    return [(*r, 1, "x", "y", 2) for r in rows]


@pytest.mark.parametrize("options", [{}, {"small": 6, "block": 4}, {"small": 1}])
def test_random_conversations(spark, options):
    rows = random_rows(1)
    assert found(trie_report(spark.createDataFrame(rows, SCHEMA), **options)) == plain_trie(rebuilt(rows))


def test_given_conversations_with_splits(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert found(trie_report(df, small=10)) == plain_trie(rebuilt(rows))


def test_long_conversations_and_copies(spark):
    """Two conversations of hundreds of turns that part late, and many equal ones."""
    rows = [(c, t, "user", f"t{t if t < 300 else (c, t)}") for c in (100, 200) for t in range(400)]
    rows += [(1000 + 100 * i, t, "user", "same") for i in range(300) for t in range(8)]
    df = spark.createDataFrame([(*r, 1, "x", "y", 2) for r in rows], SCHEMA)
    want = plain_trie(rebuilt(rows))
    assert found(trie_report(df, small=50, block=64)) == want
    assert found(trie_report(df)) == want


def test_root_counts_conversations_without_turns(spark):
    members = spark.createDataFrame([(5,), (3,), (5,)], "conv_id long")
    turns = spark.createDataFrame([], "conv_id long, turn_no long, one long, two long, chars long")
    assert found(prefix_trie(members, turns)) == {(3, 0): (None, 2, 0, 1, 0, sha("3,5"))}


def test_empty_table(spark):
    empty = trie_report(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and set(empty.columns) == set(COLUMNS)


@pytest.mark.parametrize("shape", ["chain", "star", "random"])
def test_component_totals(shape):
    rng = random.Random(3)
    n = 2000
    parent = {"chain": lambda v: v - 1, "star": lambda v: 0, "random": lambda v: rng.randrange(v)}[shape]
    parents = [-1, *[parent(v) for v in range(1, n)]]
    values = [(rng.randrange(10), 1) for _ in range(n)]
    want = [list(v) for v in values]
    for v in range(n - 1, 0, -1):
        want[parents[v]] = [a + b for a, b in zip(want[parents[v]], want[v], strict=True)]
    assert component_totals(parents, values) == want
