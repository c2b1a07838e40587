"""Turn repair against the cheapest edits found turn by turn."""

import hashlib
import itertools
import random
import zlib
from collections import defaultdict

import pytest

from tallyspark.llm import turn_repair
from tallyspark.llm.turn_repair import Span, _packed_block, edits, repair, repair_report

SCHEMA = "conv_id long, turn int, role string, text string, place long, fault string, span string, initials int"
COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
WHITE = " \t\n\x0b\x0c\r"
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
ROLES = {"u": "user", "a": "assistant"}


def cheapest(turns):
    """(cost, audit, lines) for [(role, text, fault)]: states are what was put last."""

    def inserted(states):
        while True:
            better = dict(states)
            for state, (cost, audit, lines) in states.items():
                for initial, role in ROLES.items():
                    to, way = NEXT.get((state, initial)), (cost + 2, audit + "I", (*lines, role + ":"))
                    if to is not None and (to not in better or way < better[to]):
                        better[to] = way
            if better == states:
                return states
            states = better

    states = inserted({0: (0, "", ())})
    for role, text, fault in turns:
        after = {}
        for state, (cost, audit, lines) in states.items():
            ways = [(state, cost + 3, "D", lines)]
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                ways.append((NEXT.get((state, role[:1])), cost + more, "K", (*lines, f"{role}:{text}")))
                ways += [
                    (NEXT.get((state, i)), cost + 2 + more, "R", (*lines, f"{full}:{text}")) for i, full in ROLES.items()
                ]
            for to, total, edit, out in ways:
                if to is not None and (to not in after or (total, audit + edit) < after[to][:2]):
                    after[to] = (total, audit + edit, out)
        states = inserted(after)
    return min(states[s] for s in (0, 3) if s in states)


def damaged(rows):
    out = defaultdict(list)
    for c, t, role, text, *_ in rows:
        c_, t_, role, text = (" " if x is None else str(x) for x in (c, t, role, text))
        code = zlib.crc32(f"{c_}:{t_}".encode()) % 20
        if code == 1:
            text = ""
        if code == 2:
            text = text.translate(str.maketrans("", "", ".!?"))
        if code == 4:
            role = "user"
        out[c] += [(t, role, text)] * {0: 0, 3: 2}.get(code, 1)
    return out


def plain_report(conversations):
    out = {}
    for c, turns in conversations.items():
        turns = sorted(turns, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        numbers = [t for t, *_ in turns if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        seen, judged = set(), []
        for _, role, text in turns:
            solid = text.strip(WHITE)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "" if solid[-1] in ".!?" else "truncated"
            seen.add((role, text))
            judged.append((role, text, fault))
        count = lambda f: sum(x[2] == f for x in judged)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(judged))
        cost, audit, lines = cheapest(judged)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[c] = (gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, digest)
    return out


def found(df):
    got = df.select("conv_id", *COLUMNS).collect()
    assert len({r.conv_id for r in got}) == len(got)
    return {r.conv_id: tuple(r)[1:] for r in got}


def random_rows(seed, lengths=(1, 2, 3, 8, 20, 80)):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "ua", "user", "assistant"]
    rows = []
    for c in [*range(50), None]:
        for t in range(rng.choice(lengths)):
            text = rng.choice(["a.", "b", "", " \t", None, "q!\n", "x? ", "same.", " ", f"{t}."])
            rows.append((c, rng.choice([None, t, t, t, t // 2]), rng.choice(roles), text))
    return [(*r, 1, "x", "y", 2) for r in rows]


@pytest.mark.parametrize("seed", [1, 2])
def test_damaged_conversations(spark, seed):
    rows = random_rows(seed)
    assert found(repair_report(spark.createDataFrame(rows, SCHEMA))) == plain_report(damaged(rows))


def test_given_conversations(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert found(repair_report(df)) == plain_report(damaged(rows))


def test_a_very_long_conversation_takes_levels(spark):
    """More turns than one block of blocks: spans are joined in three levels."""
    rng = random.Random(5)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), f"{t}{rng.choice(['.', ''])}") for t in range(3000)]
    rows += [(2, 0, "user", "Long " * 50_000 + ".")]
    got = repair(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")).report()
    assert found(got) == plain_report({c: [r[1:] for r in rows if r[0] == c] for c in (1, 2)})


def test_every_short_conversation():
    """All sequences of up to four turns of all kinds, without Spark."""
    kinds = {s: s for s in "suax"} | {s.upper(): s for s in "suax"} | {str(i): s for i, s in enumerate("suax")}
    role = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
    for n in range(1, 4):
        for signs in itertools.product(kinds, repeat=n):
            turns = [
                (role[kinds[s]], "t", "blank" if s.isdigit() else "truncated" if s.isupper() else "") for s in signs
            ]
            cost, audit, lines = cheapest(turns)
            assert Span.unpacked(_packed_block("".join(signs))).best == (cost, audit)
            made = ""
            for before, own, after in edits("".join(kinds[s] for s in signs), audit):
                made += before + (own if own != "k" else "?") + after
            assert len(made) == len(lines)


def test_spans_may_be_joined_anywhere():
    rng = random.Random(2)
    for _ in range(20):
        signs = "".join(rng.choice("suaxSUAX0123") for _ in range(12))
        whole = Span.unpacked(_packed_block(signs))
        cut = sorted(rng.sample(range(1, 12), 2))
        parts = [signs[: cut[0]], signs[cut[0] : cut[1]], signs[cut[1] :]]
        assert turn_repair.joined_spans([Span.unpacked(_packed_block(p)) for p in parts]) == whole


def test_empty_table(spark):
    got = repair_report(spark.createDataFrame([], SCHEMA))
    assert got.count() == 0 and set(got.columns) == {"conv_id", *COLUMNS}
