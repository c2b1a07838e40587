import hashlib
import random
import re

import pytest
from edge import edge_docs, empty_docs, rows

from tallyspark.llm.decontamination import WINDOW, Patterns, clean_documents, leak_report, words_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(docs, items):
    windows = {}
    for item, text in items:
        words = WORD.findall(lowered(text))
        for i in range(max(1, len(words) - WINDOW + 1) if words else 0):
            windows.setdefault(tuple(words[i : i + WINDOW]), set()).add(item)
    out = []
    for doc_id, text in docs:
        words = WORD.findall(lowered(text))
        hit, found = set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                owners = windows.get(tuple(words[i : i + size]))
                if owners:
                    hit.update(range(i, i + size))
                    found |= owners
        listed = sorted(str(i) for i in found if i is not None)
        sha = hashlib.sha256(",".join(listed).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(listed), sha, bool(hit)))
    return sorted(out, key=repr)


def case(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "of", "Éa", "x1", "and", "zz"])
    text = lambda n: rng.choice([" ", ", ", "\n"]).join(word() for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 2, 4, 9, 10, 11, 25]))) for i in range(12)] + [(3, text(10)), (None, text(12)), (5, None)]
    docs = [(i, text(rng.choice([0, 1, 8, 30, 200]))) for i in range(25)]
    docs += [(100 + i, f"{text(5)} {t or ''} {text(5)}") for i, (_, t) in enumerate(items)] + [(None, None)]
    return docs, items


@pytest.mark.parametrize("per_block", [200_000, 15])
def test_equals_brute_force(spark, per_block):
    docs, items = case(per_block)
    got = leak_report(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
        windows_per_block=per_block,
    )
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, items)


def test_shift_tables_skip_and_find():
    rng = random.Random(1)
    for _ in range(200):
        size = rng.randint(1, 6)
        patterns = {tuple(rng.choice([b"a", b"b", b"c"]) for _ in range(size)): {"i"} for _ in range(3)}
        text = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(40)]
        spans, _ = Patterns(patterns).search(text)
        want = {k for i in range(41 - size) if tuple(text[i : i + size]) in patterns for k in range(i, i + size)}
        assert {k for a, b in spans for k in range(a, b)} == want


def test_words_are_ascii_lowered_only():
    assert words_of("Ab-É9 ÀB".encode()) == ["ab".encode(), "É9".encode(), "Àb".encode()]


def test_edge_cases(spark):
    items = spark.createDataFrame([(1, "quick brown fox"), (2, None), (3, "")], "item_id long, text string")
    docs = edge_docs(spark)
    got = leak_report(docs, items).collect()
    assert len(got) == len(rows()) and sorted(r.doc_id for r in got if r.contaminated) == [1, 2]
    kept = clean_documents(docs, items)
    assert kept.columns == docs.columns and kept.count() == len(rows()) - 2
    assert leak_report(empty_docs(spark), items).count() == 0
    assert clean_documents(docs, items.limit(0)).count() == len(rows())
