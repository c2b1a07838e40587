"""Removal of repeated word sequences against all windows in plain Python."""

import hashlib
import random
import re

import pytest
from edge import LONG, edge_docs, empty_docs, rows

from tallyspark.llm import substring_dedup
from tallyspark.llm.substring_dedup import dedup_report, plain, word_starts

BIG = 2**63


def brute(docs, window=50):
    words = [(BIG if i is None else i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in docs]
    least = {}
    for i, w in words:
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            least[key] = min(i, least.get(key, i))
    out = []
    for (i, w), (doc_id, _) in zip(words, docs, strict=True):
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if least[tuple(w[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((doc_id, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def small_docs(spark, seed=3, n=150):
    rng = random.Random(seed)
    white = [" ", "\n", "\t ", "  ", "\r\n"]
    made = []
    for i in range(n):
        size = rng.choice([0, 3, 8, 9, 12, 40, 90])
        made.append((rng.choice([None, i, i, i, i // 2]), "".join(rng.choice("ab") + rng.choice(white) for _ in range(size))))
    return made, spark.createDataFrame(made, "doc_id long, text string")


@pytest.mark.parametrize("options", [{"seed": 3}, {"seed": 3, "compared": 2}, {"seed": 8}, {"seed": 5, "compared": 20}])
def test_small_documents(spark, options):
    made, df = small_docs(spark)
    want = brute(made, 8)
    assert got(dedup_report(df, window=8, **options)) == want
    assert sum(r[2] for r in want) > 1000


def test_long_texts_are_cut_without_loss(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "_PIECE_WORDS", 7)
    monkeypatch.setattr(substring_dedup, "_CHUNK_BYTES", 100)
    made, df = small_docs(spark, seed=4)
    assert got(dedup_report(df, window=8, seed=4, compared=5)) == brute(made, 8)


def test_given_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    want = brute([tuple(r) for r in df.collect()])
    assert got(dedup_report(df)) == want and sum(r[2] for r in want) > 0


def test_edge_cases(spark):
    want = brute([(r[0], r[1]) for r in rows()])
    assert got(dedup_report(edge_docs(spark))) == want
    assert dedup_report(empty_docs(spark)).count() == 0


def test_an_equal_id_does_not_count_and_none_is_last(spark):
    docs = [(6, LONG), (6, LONG), (None, LONG), (None, "own " + LONG)]
    out = got(dedup_report(spark.createDataFrame(docs, "doc_id long, text string")))
    assert out == brute(docs)
    assert [r[2] for r in out if r[0] == 6] == [0, 0]
    assert all(r[2] > 0 for r in out if r[0] is None)


def test_a_passage_in_very_many_contexts(spark):
    """A common passage: one anchor with hundreds of classes, compared and grouped."""
    rng = random.Random(7)
    passage = " ".join(f"p{i}" for i in range(20))
    docs = []
    for i in range(300):
        around = [" ".join(f"w{rng.randrange(40)}" for _ in range(rng.choice([0, 10, 35, 60]))) for _ in range(2)]
        docs.append((i, f"{around[0]} {passage} {around[1]}"))
    docs += [(1000 + i, t) for i, t in docs[:100]]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute(docs)
    for compared in (1000, 10):
        assert got(dedup_report(df, compared=compared)) == want


@pytest.mark.parametrize("window, seed", [(8, 3), (20, 4), (50, 16)])
def test_grouped_windows_are_those_compared(spark, window, seed):
    """Contexts of one seed with matches of any length on either side, short ones included."""
    rng = random.Random(window)
    reach = window - seed
    middle = [f"s{i}" for i in range(seed)]
    left, right = ([f"{side}{i}" for i in range(reach)] for side in "lr")
    made = []
    for i in range(120):
        before, after = (reach if rng.random() < 0.7 else rng.randrange(reach + 1) for _ in range(2))
        pool = rng.choice([1, 2, 40])
        a = [w if rng.random() < 0.9 else f"{w}x{rng.randrange(pool)}" for w in left[reach - before :]]
        b = [w if rng.random() < 0.9 else f"{w}x{rng.randrange(pool)}" for w in right[:after]]
        made.append((7, f"c{i}".encode(), rng.randrange(60), before, " ".join(a + middle + b).encode()))
    found = substring_dedup.extensions([r[2] for r in made], [r[3] for r in made], [r[4].split() for r in made], window, seed)
    want = {r[1]: m for r, m in zip(made, found, strict=True) if m}
    df = spark.createDataFrame(made, "anchor long, class binary, smallest long, before int, words binary")
    assert {bytes(r["class"]): (r["left"], r["right"]) for r in substring_dedup._grouped(df, window, seed).collect()} == want
    assert 0 < len(want) < len(made)


def test_a_long_passage_in_very_many_contexts_is_not_joined_window_by_window(spark, monkeypatch):
    rng = random.Random(11)
    passage = " ".join(f"p{i}" for i in range(200))
    docs = [(i, " ".join([f"a{rng.random()}", passage, f"b{rng.random()}"])) for i in range(40)]
    joined = []
    repeated = substring_dedup._repeated

    def counted(windows, least):
        out = repeated(windows, least)
        joined.append(out.count())
        return out

    monkeypatch.setattr(substring_dedup, "_repeated", counted)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert got(dedup_report(df, compared=2)) == brute(docs)
    few = sum(joined)
    joined.clear()
    monkeypatch.setattr(substring_dedup.math, "isqrt", lambda _: 1)
    assert got(dedup_report(df, compared=2)) == brute(docs)
    assert 39 <= few < sum(joined) / 2


def test_windows_that_no_other_context_holds_are_not_made_one_by_one(spark, monkeypatch):
    """The edge of a long passage in many contexts: most windows are in all of them or in one."""
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(12 + 16 + 34)]
    made = []
    for i in range(100):
        own = [f"w{rng.random()}" for _ in range(22)]
        made.append((7, f"c{i}".encode(), 200 + i // 2, 34, " ".join(own + passage).encode()))
    # Of a part of the passage's words only, and of own words only after the seed.
    made.append((7, b"short", 1, 3, " ".join(passage[9:60]).encode()))
    made += [(7, f"a{i}".encode(), i, 12, " ".join(passage[:28] + [f"v{i}"] * 34).encode()) for i in range(2, 20)]
    # One word less than a window.
    made += [(7, f"less{i}".encode(), 300 + i, 11, " ".join(passage[1:50]).encode()) for i in range(2)]
    found = substring_dedup.extensions([r[2] for r in made], [r[3] for r in made], [r[4].split() for r in made], 50, 16)
    want = {r[1]: m for r, m in zip(made, found, strict=True) if m}
    assert want[b"c0"] == want[b"c1"] == (3, 32) and want[b"c2"] == (12, 34) and not {b"a2", b"less1"} & set(want)
    df = spark.createDataFrame(made, "anchor long, class binary, smallest long, before int, words binary")
    windows = []
    select = type(df).select

    def counted(rows, *columns):
        out = select(rows, *columns)
        if any("explode(" in str(c) for c in columns):
            windows.append(out.count())
        return out

    monkeypatch.setattr(type(df), "select", counted)
    assert {bytes(r["class"]): (r["left"], r["right"]) for r in substring_dedup._grouped(df, 50, 16).collect()} == want
    assert len(made) < sum(windows) < 15 * len(made)


def test_words():
    assert plain(b"\t a  b\x0b\x0cc\r\n") == b"a b c"
    assert word_starts(b"a b c").tolist() == [0, 2, 4, 6] and word_starts(b"").tolist() == [0]
    assert plain(b" \n ") == b""
