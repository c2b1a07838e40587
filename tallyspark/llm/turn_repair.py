"""Repair of conversation structure by weighted CYK parsing of turn intervals.

A sound conversation is empty or has the role initials ``s?(ua)+``.  Every turn may be
kept, given another role or deleted, and empty turns may be inserted; the cheapest
edits are found by a grammar in Chomsky normal form whose nonterminals are all the
shapes a span of turns can be given:

    E nothing   S s   P u..a   Q u..u   R a..a   T a..u   W su..a   V su..u

Each has rules X -> Y Z for every two shapes that may follow one another.  A cell holds
per nonterminal the smallest (cost, audit) of a span of turns; the audit names the edits
in order.  Audits of one span, shape and cost are never prefixes of one another, so the
least audit of a span is made of least audits of its parts.  Cells of single turns are
closed under insertion before and after; a longer span needs no closure of its own,
because every inserted turn stands next to some turn.

Cells are combined bottom-up by span length.  Since any two neighbouring spans may be
combined, this is done in levels: all spans of up to ``SPAN`` turns that lie together in
the global order, then of up to ``SPAN`` such blocks, and so on.  A conversation of any
length is spread over tasks that hold ``SPAN`` cells each.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.turns import joined_sha256, numbered_turns
from tallyspark.session import materialize

SPAN = 32
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
WHITE = " \t\n\x0b\x0c\r"

# First and last initial of each shape; E has neither.
_SHAPES = {"E": "", "S": "ss", "P": "ua", "Q": "uu", "R": "aa", "T": "au", "W": "sa", "V": "su"}
_NAMES = list(_SHAPES)
_SOUND = "EPW"
_FOLLOWS = {"su", "ua", "au"}


def _rules() -> list[tuple[int, int, int]]:
    """(X, Y, Z) for X -> Y Z."""
    place = {ends: name for name, ends in _SHAPES.items() if ends}
    found = [("E", "E", "E")]
    for left, ends in _SHAPES.items():
        if not ends:
            continue
        found += [(left, "E", left), (left, left, "E")]
        for right, more in _SHAPES.items():
            if more and ends[1] + more[0] in _FOLLOWS:
                found.append((place[ends[0] + more[1]], left, right))
    return [tuple(_NAMES.index(n) for n in rule) for rule in found]


_RULES = _rules()
Cell = list  # one (cost, audit) or None per nonterminal


def _closed(cell: Cell) -> Cell:
    """``cell`` after inserting turns before and after it wherever that is cheaper."""
    unit = {_NAMES.index(n): (INSERT, "I") for n in "QR"}
    changed = True
    while changed:
        changed = False
        for x, y, z in _RULES:
            for left, right in ((unit.get(y), cell[z]), (cell[y], unit.get(z))):
                if left and right:
                    found = (left[0] + right[0], left[1] + right[1])
                    if cell[x] is None or found < cell[x]:
                        cell[x], changed = found, True
    return cell


# A turn is one sign: its initial (x: any other), upper case if truncated; a digit
# (the place of the initial in INITIALS) if it has to be deleted.
INITIALS = "suax"


@lru_cache(maxsize=64)
def _turn_cell(sign: str) -> tuple:
    cell: Cell = [None] * len(_NAMES)
    cell[_NAMES.index("E")] = (DELETE, "D")
    if not sign.isdigit():
        more = TRUNCATED if sign.isupper() else 0
        for shape in "QR":
            cell[_NAMES.index(shape)] = (REROLE + more, "R")
        kept = {"s": "S", "u": "Q", "a": "R"}.get(sign.lower())
        if kept:
            cell[_NAMES.index(kept)] = (more, "K")
    return tuple(_closed(cell))


def _combined(units: list) -> tuple:
    """The cell of the whole span by CYK: all spans by length, all splits, all rules."""
    n = len(units)
    cells = {(i, i + 1): unit for i, unit in enumerate(units)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            cost, pairs = [None] * len(_NAMES), [[] for _ in _NAMES]
            for k in range(i + 1, i + length):
                left, right = cells[i, k], cells[k, i + length]
                for x, y, z in _RULES:
                    a, b = left[y], right[z]
                    if a is None or b is None:
                        continue
                    total = a[0] + b[0]
                    if cost[x] is None or total < cost[x]:
                        cost[x], pairs[x] = total, [(a[1], b[1])]
                    elif total == cost[x]:
                        pairs[x].append((a[1], b[1]))
            cells[i, i + length] = tuple(
                None if c is None else (c, min(a + b for a, b in set(found)))
                for c, found in zip(cost, pairs, strict=True)
            )
    return cells[0, n]


@dataclass(frozen=True)
class Span:
    """A parsed span: the initials at its ends, its illegal neighbours, its cell."""

    first: str
    last: str
    illegal: int
    cell: tuple

    def packed(self) -> str:
        held = ["" if c is None else f"{c[0]} {c[1]}" for c in self.cell]
        return "|".join([self.first, self.last, str(self.illegal), *held])

    @classmethod
    def unpacked(cls, text: str) -> Span:
        first, last, illegal, *held = text.split("|")
        cell = tuple((int(h.split(" ")[0]), h.split(" ")[1]) if h else None for h in held)
        return cls(first, last, int(illegal), cell)

    @property
    def best(self) -> tuple[int, str]:
        return min(self.cell[_NAMES.index(n)] for n in _SOUND if self.cell[_NAMES.index(n)])


def joined_spans(spans: list[Span]) -> Span:
    meet = sum(a.last + b.first not in _FOLLOWS for a, b in zip(spans, spans[1:], strict=False))
    inner = sum(s.illegal for s in spans)
    return Span(spans[0].first, spans[-1].last, meet + inner, _combined([s.cell for s in spans]))


def _turn(sign: str) -> Span:
    initial = INITIALS[int(sign)] if sign.isdigit() else sign.lower()
    return Span(initial, initial, 0, _turn_cell(sign))


@lru_cache(maxsize=4096)
def _packed_block(signs: str) -> str:
    return joined_spans([_turn(s) for s in signs]).packed()


def edits(initials: str, audit: str) -> list[tuple[str, str, str]]:
    """Per turn: roles inserted before it, its own role (``k`` kept, "" deleted), roles after.

    ``initials`` are the turns' own; roles are given as initials.
    """
    out, before, last, turn = [], "", "", 0
    for edit in audit:
        expected = "a" if last == "u" else "u"
        if edit == "I":
            before, last = before + expected, expected
            continue
        if edit != "D":
            last = initials[turn] if edit == "K" else expected
        out.append((before, {"K": "k", "D": "", "R": expected}[edit], ""))
        before, turn = "", turn + 1
    if before and out:
        out[-1] = (*out[-1][:2], before)
    return out


# ------------------------------------------------------------ over DataFrames


def _last_sign(text: Column) -> Column:
    """The last character that is not white space, or nothing."""
    return F.substring(F.rtrim(text, F.lit(WHITE)), -1, 1)


def ordered(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with ``place``; null role or text counts as one space."""
    space = F.lit(" ")
    return numbered_turns(
        turns.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text")),
        "turn", "role", "text",
    )


def marked(held: DataFrame) -> DataFrame:
    """conv_id, turn, place, initial and ``fault``: blank, duplicate, truncated or null.

    A turn is a duplicate if its role and text stand earlier in its conversation.
    """
    last = _last_sign(F.col("text"))
    own = F.when(last == "", "blank").when(~last.isin(".", "!", "?"), "truncated")
    turns = held.select(
        "conv_id", "turn", "role", "place", F.substring("role", 1, 1).alias("initial"), own.alias("own"),
        F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
    )
    firsts = turns.where("own is null or own <> 'blank'").groupBy("conv_id", "role", "digest").agg(F.min("place").alias("place"))
    # Places are unique: the join is even, however large a conversation is.
    seen = turns.join(firsts.select("place", F.lit(True).alias("is_first")), "place", "left")
    repeats = F.col("is_first").isNull() & ~F.col("own").eqNullSafe("blank")
    return seen.select(
        "conv_id", "turn", "place", "initial", F.when(repeats, "duplicate").otherwise(F.col("own")).alias("fault")
    )


def _signs(faults: DataFrame) -> DataFrame:
    known = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("x")
    sign = (
        F.when(F.col("fault").isin("blank", "duplicate"), F.translate(known, INITIALS, "0123"))
        .when(F.col("fault") == "truncated", F.upper(known))
        .otherwise(known)
    )
    return faults.select("conv_id", "place", sign.alias("sign"))


def parsed(faults: DataFrame) -> DataFrame:
    """Per conversation: conv_id, first_place, initials, illegal, cost, audit."""

    @F.pandas_udf("string")
    def block(signs: pd.Series) -> pd.Series:
        return signs.map(_packed_block)

    @F.pandas_udf("string")
    def level(spans: pd.Series) -> pd.Series:
        return spans.map(lambda text: joined_spans([Span.unpacked(t) for t in text.split("\n")]).packed())

    @F.pandas_udf("illegal long, cost long, audit string")
    def root(spans: pd.Series) -> pd.DataFrame:
        found = [Span.unpacked(text) for text in spans]
        return pd.DataFrame(
            [(s.illegal, *s.best) for s in found], columns=["illegal", "cost", "audit"]
        )

    def in_order(column: str, separator: str) -> Column:
        pairs = F.array_sort(F.collect_list(F.struct("first_place", column)))
        return F.array_join(F.transform(pairs, lambda x: x[column]), separator).alias(column)

    def grouped(rows: DataFrame, *keys: str) -> DataFrame:
        # At most SPAN rows share a key.
        return rows.groupBy("conv_id", *keys).agg(
            in_order("span", "\n"), in_order("initials", ""), F.min("first_place").alias("first_place")
        )

    up = lambda column: F.expr(f"{column} div {SPAN}").alias("block")
    signs = _signs(faults).select("conv_id", up("place"), F.col("place").alias("first_place"), "sign")
    pieces = (
        signs.groupBy("conv_id", "block")
        .agg(in_order("sign", ""), F.min("first_place").alias("first_place"))
        .select(
            "conv_id", "block", "first_place", block("sign").alias("span"),
            F.translate(F.lower("sign"), "0123", INITIALS).alias("initials"),
        )
    )
    while True:
        pieces = materialize(pieces, "spans")
        most = pieces.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
        if most <= SPAN:
            break
        pieces = grouped(pieces.withColumn("block", up("block")), "block").withColumn("span", level("span"))
    tops = grouped(pieces)
    several = tops.withColumn("root", root(level("span")))
    return several.select("conv_id", "first_place", "initials", "root.*")


_EDITS = "place long, inserted_before string, new_role string, inserted_after string"
_EDIT_ROWS = 20_000


def _edit_rows(conversations: DataFrame) -> DataFrame:
    """One row for each turn of the parsed conversations."""
    names = [c.split()[0] for c in _EDITS.split(", ")]

    def explode(batches):
        for batch in batches:
            held = []
            for first, initials, audit in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                held += [(first + i, *e) for i, e in enumerate(edits(initials, audit))]
                if len(held) > _EDIT_ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*held, strict=True)], names=names)
                    held = []
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*held, strict=True)], names=names)

    return conversations.select("first_place", "initials", "audit").mapInArrow(explode, _EDITS)


def _inserted(column: str) -> Column:
    """``role:text`` lines of inserted initials, each ended by a newline."""
    # Marked first, so that the letters of a role are not replaced again.
    marked = F.translate(F.col(column), "ua", "\x01\x02")
    return F.replace(F.replace(marked, F.lit("\x01"), F.lit("user:\n")), F.lit("\x02"), F.lit("assistant:\n"))


@dataclass(frozen=True)
class Repair:
    """``turns`` in order, their ``faults``, and the parse of each of the ``conversations``."""

    turns: DataFrame
    faults: DataFrame
    conversations: DataFrame

    def lines(self) -> DataFrame:
        """conv_id, place, lines: what becomes of each turn, ``role:text`` lines or null.

        Turns inserted beside a turn are in its lines.
        """
        role = F.when(F.col("new_role") == "k", F.col("role")).when(F.col("new_role") == "u", "user").otherwise("assistant")
        own = F.when(F.col("new_role") != "", F.concat(role, F.lit(":"), F.col("text"), F.lit("\n"))).otherwise("")
        text = F.concat(_inserted("inserted_before"), own, _inserted("inserted_after"))
        whole = F.substring(text, F.lit(1), F.length(text) - 1)
        return self.turns.join(_edit_rows(self.conversations), "place").select(
            "conv_id", "place", F.when(text != "", whole).alias("lines")
        )

    def report(self) -> DataFrame:
        """Per conversation with turns: gaps, faults, illegal, cost, audit, repaired_sha256."""
        count = lambda fault: F.count_if(F.col("fault") == fault).alias(fault)
        counts = self.faults.groupBy("conv_id").agg(
            F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"),
            count("blank"), count("duplicate"), count("truncated"),
        )
        hashes = joined_sha256(self.lines(), ["conv_id"], "place", "lines", "\n", "repaired_sha256")
        parts = [
            counts,
            self.conversations.select("conv_id", "illegal", "cost", "audit"),
            hashes,
        ]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part, allowMissingColumns=True)
        values = [c for c in whole.columns if c != "conv_id"]
        merged = whole.groupBy("conv_id").agg(*[F.first(c, ignorenulls=True).alias(c) for c in values])
        return merged.withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)))


def repair(turns: DataFrame) -> Repair:
    """Find the cheapest repair of every conversation of ``turns`` (conv_id, turn, role, text).

    Null role or text counts as one space, rows without conv_id are one conversation,
    turns without number come first, equal numbers go by role and text.  Further columns
    are not read.  An empty table gives no conversations.  Texts of any length are moved,
    never parsed: a turn is one sign to the parser.
    """
    held = ordered(turns)
    faults = materialize(marked(held), "turn-faults")
    return Repair(held, faults, materialize(parsed(faults), "turn-parses"))


def damage(conversations: DataFrame) -> DataFrame:
    """Conversations with faults planted by a checksum of conv_id and turn.

    Of twenty rows one is dropped, one loses its text, one its sentence ends, one
    stands twice and one has the role user.  Nulls count as one space (conv_id and turn
    only in the checksum).
    """
    space = F.lit(" ")
    plain = lambda c: F.coalesce(F.col(c).cast("string"), space)
    code = F.pmod(F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")), F.lit(20))
    return (
        conversations.select("conv_id", "turn", plain("role").alias("role"), plain("text").alias("text"), code.alias("code"))
        .where("code <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("code") == 1, "")
            .when(F.col("code") == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text"))
            .alias("text"),
            F.explode(F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        )
        .drop("copy")
    )


def repair_report(conversations: DataFrame) -> DataFrame:
    """The digest of the repair of damaged ``conversations``, one row per conv_id.

    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256; a
    conversation that lost all rows has zeros, an empty audit and the hash of nothing.
    """
    found = repair(damage(conversations)).report()
    every = conversations.select("conv_id").distinct()
    both = every.join(
        found.withColumnRenamed("conv_id", "found_id"), F.col("conv_id").eqNullSafe(F.col("found_id")), "left"
    )
    none = {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit("").cast("binary"), 256)}
    return both.select(
        "conv_id",
        *[F.coalesce(c, none.get(c, F.lit(0).cast("long"))).alias(c) for c in found.columns if c != "conv_id"],
    )
