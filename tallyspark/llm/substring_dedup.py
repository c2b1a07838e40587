"""Removal of word sequences that stand in a document with a smaller id: seed and extend.

A window is ``WINDOW`` words.  Equal windows have the same seed: of the runs of ``SEED``
words inside the window the one with the smallest hash (the last of equals), which depends
on the window's words alone.  These winnowed runs, about one for every eighteen words, are
the anchors on which documents are joined:

1. Every text is scanned once.  A seed goes on with its words to the left and to the
   right, as far as a window that holds the seed can reach: its context.  Seeds whose
   anchor stands in one document only are settled.
2. Seeds with equal context are one class, however many copies there are.  A member
   whose class has a smaller id matches over the whole context.
3. Contexts of different classes of an anchor are extended both ways from the seed.
   Where the match is ``WINDOW`` words or longer it counts against the class with the
   larger smallest id; the longest extension to the left and to the right is kept.  All
   these matches hold the seed, so together they are one piece: the maximal repeat.
4. The matches of a text are merged and cut out.

No pairs of documents are made: classes are compared inside the task that holds their
anchor, against those of smaller ids only.  An anchor with more than ``COMPARED`` classes
would be one task's work; its windows are grouped by their words instead (exact, combined
map-side).  Texts are moved twice: those that hold the context of a class to be compared,
and all of them when the matches are cut out.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import small_batches, utf8
from tallyspark.llm.suffix_sort import mixed, powers
from tallyspark.session import materialize

WINDOW = 50
SEED = 16
COMPARED = 1_000
_WHITE = bytes(32 if b == 32 or 9 <= b <= 13 else b for b in range(256))
_CHUNK_BYTES = 1_000_000
_PIECE_WORDS = 150_000
_ODD = 0xD1B54A32D192ED03


def plain(text: bytes) -> bytes:
    """The words of a text with one space between them."""
    text = text.translate(_WHITE).strip()
    while b"  " in text:
        text = text.replace(b"  ", b" ")
    return text


def word_starts(words: bytes) -> np.ndarray:
    """Where each word begins in ``plain`` text, and where one after the last would."""
    if not words:
        return np.zeros(1, np.int64)
    spaces = np.flatnonzero(np.frombuffer(words, np.uint8) == 32)
    return np.concatenate([[0], spaces + 1, [len(words) + 1]])


# ------------------------------------------------------------ seeds


class Units:
    """Some texts, or pieces of long ones, as one array of words.

    ``owner``: which text; ``first``: the number of a unit's first word in it; a unit's words
    are ``begin`` to ``end`` of the array and its windows start at ``low`` to ``high``.
    """

    def __init__(self):
        self.parts, self.size, self.words = [], 0, 0
        self.owner, self.first, self.begin, self.end, self.low, self.high = [], [], [], [], [], []

    def add(self, owner: int, first: int, lead: int, part: bytes, words: int, windows: int) -> None:
        self.parts.append(part)
        self.size += len(part) + 1
        for name, value in (
            ("owner", owner), ("first", first), ("begin", self.words), ("end", self.words + words),
            ("low", self.words + lead), ("high", self.words + lead + windows),
        ):
            getattr(self, name).append(value)
        self.words += words


def _units(texts: list[bytes], window: int, seed: int):
    """Units of about ``_CHUNK_BYTES``; a long text is cut so that no window is lost."""
    reach = window - seed
    units = Units()
    for owner, text in enumerate(texts):
        words = plain(text)
        starts = word_starts(words)
        n = len(starts) - 1
        for a in range(0, n - window + 1, _PIECE_WORDS):
            windows = min(_PIECE_WORDS, n - window + 1 - a)
            lead = min(a, reach)
            last = min(n, a + windows + window + reach)
            part = words[starts[a - lead] : starts[last] - 1]
            units.add(owner, a - lead, lead, part, last - (a - lead), windows)
            if units.size > _CHUNK_BYTES:
                yield units
                units = Units()
    if units.parts:
        yield units


def _runs(values: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` values, by doubling."""
    out, done, bits = None, 0, size
    level, width = values, 1
    while bits:
        if bits & 1:
            if out is None:
                out, done = level, width
            else:
                n = len(level) - done
                out, done = mixed(out[:n] * np.uint64(_ODD) + level[done : done + n]), done + width
        bits >>= 1
        if bits:
            n = len(level) - width
            level, width = mixed(level[:n] * np.uint64(_ODD) + level[width : width + n]), width * 2
    return out


def _smallest_place(hashes: np.ndarray, width: int) -> np.ndarray:
    """For every run of ``width`` hashes the place of the smallest, the last of equals."""
    bits = max(1, len(hashes).bit_length())
    mask = np.uint64((1 << bits) - 1)
    held = (hashes & ~mask) | (mask - np.arange(len(hashes), dtype=np.uint64))
    done = 1
    while done * 2 <= width:
        held = np.minimum(held[:-done], held[done:])
        done *= 2
    rest = width - done
    if rest:
        held = np.minimum(held[:-rest], held[rest:])
    return (mask - (held & mask)).astype(np.int64)


def seeds_of(units: Units, window: int, seed: int):
    """Arrays owner, place, anchor, left, right and the context's digests."""
    joined = b" ".join(units.parts)
    data = np.frombuffer(joined, np.uint8)
    starts = word_starts(joined)
    length = np.diff(starts) - 1
    inside = np.arange(len(data)) - np.repeat(starts[:-1], length + 1)[: len(data)]
    terms = (data.astype(np.uint64) + np.uint64(1)) * powers(_ODD, int(length.max()) + 1)[inside]
    terms[data == 32] = 0
    hashes = mixed(np.add.reduceat(terms, starts[:-1]) + length.astype(np.uint64))
    runs = _runs(hashes, seed)
    chosen = _smallest_place(runs, window - seed + 1)
    low, high = np.array(units.low), np.array(units.high)
    windows = np.repeat(low, high - low) + np.arange((high - low).sum()) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
    of = np.repeat(np.arange(len(low)), high - low)
    place = chosen[windows]
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1]) | (of[1:] != of[:-1])
    place, of = place[new], of[new]
    reach = window - seed
    begin, end = np.array(units.begin)[of], np.array(units.end)[of]
    left = np.minimum(place - begin, reach)
    right = np.minimum(end - place - seed, reach)
    a, b = starts[place - left], starts[place + seed + right] - 1
    digest = xxhash.xxh3_128_digest
    digests = [
        digest(joined[x:y], int(z)) for x, y, z in zip(a.tolist(), b.tolist(), left.tolist(), strict=True)
    ]
    number = place - begin + np.array(units.first)[of]
    return np.array(units.owner)[of], number, runs[place], left, right, digests


_SEEDS = "row binary, doc_id long, place int, anchor long, class binary, before int, after int"


def _seeds(docs: DataFrame, window: int, seed: int) -> DataFrame:
    """The seeds of all texts (``docs``: row, doc_id, text)."""
    names = [c.split()[0] for c in _SEEDS.split(", ")]

    def scan(batches):
        for batch in batches:
            for units in _units(batch.column("text").to_pylist(), window, seed):
                owner, place, anchor, left, right, digests = seeds_of(units, window, seed)
                at = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row").take(at),
                        batch.column("doc_id").take(at),
                        pa.array(place.astype(np.int32)),
                        pa.array(anchor.view(np.int64)),
                        pa.array(digests, pa.binary()),
                        pa.array(left.astype(np.int32)),
                        pa.array(right.astype(np.int32)),
                    ],
                    names=names,
                )

    return docs.mapInArrow(scan, _SEEDS)


# ------------------------------------------------------------ extension


def _contexts(docs: DataFrame, wanted: DataFrame, seed: int) -> DataFrame:
    """(anchor, class, smallest, before, words): the words of one context of each class.

    ``wanted`` names a row and a place for each.
    """
    # A text's seeds are as many as its words allow: one row for each text.
    per_row = wanted.groupBy("row").agg(
        F.collect_list(F.struct("place", "anchor", "class", "smallest", "before", "after")).alias("seeds")
    )
    texts = docs.select("row", "text").dropDuplicates(["row"])
    schema = "anchor long, class binary, smallest long, before int, words binary"

    def cut(batches):
        for batch in batches:
            for text, seeds in zip(batch.column("text").to_pylist(), batch.column("seeds"), strict=True):
                words = plain(text)
                starts = word_starts(words)
                rows = [
                    (s["anchor"], s["class"], s["smallest"], s["before"],
                     words[starts[s["place"] - s["before"]] : starts[s["place"] + seed + s["after"]] - 1])
                    for s in seeds.as_py()
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.binary()), strict=True)],
                    names=["anchor", "class", "smallest", "before", "words"],
                )

    return texts.join(per_row, "row").select("text", "seeds").mapInArrow(cut, schema)


def extensions(smallest: list[int], before: list[int], words: list[list], window: int, seed: int):
    """For each class of an anchor the furthest match to the left and right, or None.

    A match counts if it is ``window`` words long and with a class of a smaller id.
    """
    reach = window - seed
    order = sorted(range(len(words)), key=lambda i: smallest[i])
    names: dict = {}
    table = np.empty((len(words), 2 * reach + seed), np.int64)
    # Missing words differ from all others.
    table[:] = -1 - np.arange(table.size).reshape(table.shape)
    for row, i in enumerate(order):
        at = reach - before[i]
        table[row, at : at + len(words[i])] = [names.setdefault(w, len(names)) for w in words[i]]
    lefts, middle, rights = table[:, reach - 1 :: -1] if reach else table[:, :0], table[:, reach : reach + seed], table[:, reach + seed :]
    found: list = [None] * len(words)
    for row in range(1, len(order)):
        mine = smallest[order[row]]
        less = row
        while less and smallest[order[less - 1]] == mine:
            less -= 1
        same = np.flatnonzero((middle[:less] == middle[row]).all(axis=1))
        if not len(same):
            continue
        left = np.logical_and.accumulate(lefts[same] == lefts[row], axis=1).sum(axis=1)
        right = np.logical_and.accumulate(rights[same] == rights[row], axis=1).sum(axis=1)
        long = left + right >= reach
        if long.any():
            found[order[row]] = int(left[long].max()), int(right[long].max())
    return found


_MATCH = "anchor long, class binary, left int, right int"


def _compared(contexts: DataFrame, window: int, seed: int) -> DataFrame:
    """The furthest matches of classes, compared anchor by anchor."""

    def finish(rows):
        out = []
        found = extensions([r[2] for r in rows], [r[3] for r in rows], [r[4].split(b" ") for r in rows], window, seed)
        for row, match in zip(rows, found, strict=True):
            if match:
                out.append((row[0], row[1], *match))
        return out

    def batch_of(rows):
        columns = list(zip(*rows, strict=True))
        kinds = (pa.int64(), pa.binary(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["anchor", "class", "left", "right"]
        )

    def run(batches):
        held, out = [], []
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held and row[0] != held[-1][0]:
                    out += finish(held)
                    held = []
                held.append(row)
            if out:
                yield batch_of(out)
                out = []
        if held:
            out = finish(held)
            if out:
                yield batch_of(out)

    return contexts.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, _MATCH)


def _grouped(contexts: DataFrame, window: int, seed: int) -> DataFrame:
    """The same for anchors with too many classes: windows grouped by their words.

    Windows are first taken ``step`` side by side, as one wide window, and its core, the
    words that all of them hold.  A core in contexts of one smallest id only settles its
    windows, and of equal wide windows one is cut into single windows; the others match
    over all of it or, with the same smallest id, as far as that one.
    """
    reach = window - seed
    step = max(1, math.isqrt(reach))

    @F.pandas_udf("array<struct<low:int,left:int,core:binary,window:binary>>")
    def wide(words: pd.Series, before: pd.Series) -> pd.Series:
        def one(text, at):
            starts = word_starts(text)
            least, most = max(0, at + window - len(starts) + 1), min(at, reach)
            out = []
            for first in range(least - least % step, most + 1, step) if least <= most else ():
                low, high = max(first, least), min(first + step - 1, most)
                end = at + window - min(first + step - 1, reach)
                out.append({
                    "low": low, "left": high,
                    # Equal digests of different cores only cost work.
                    "core": xxhash.xxh3_64_digest(text[starts[at - first] : starts[end] - 1], first),
                    "window": hashlib.md5(text[starts[at - high] : starts[at - low + window] - 1]).digest(),
                })
            return out

        return pd.Series([one(*r) for r in zip(words, before, strict=True)])

    @F.pandas_udf("array<struct<left:int,window:binary>>")
    def single(words: pd.Series, before: pd.Series, low: pd.Series, high: pd.Series) -> pd.Series:
        def one(text, at, low, high):
            starts = word_starts(text)
            return [
                {"left": left, "window": hashlib.md5(text[starts[at - left] : starts[at - left + window] - 1]).digest()}
                for left in range(low, high + 1)
            ]

        return pd.Series([one(*r) for r in zip(words, before, low, high, strict=True)])

    contexts = materialize(contexts, "contexts")
    runs = contexts.select("anchor", "class", "smallest", F.explode(wide("words", "before")).alias("w"))
    runs = materialize(runs.select("anchor", "class", "smallest", "w.*"), "wide-windows")
    # The left end and the words of a wide window tell its core and its right end.
    groups = materialize(
        runs.groupBy(*_WINDOW, "low", "core").agg(
            F.min("smallest").alias("least"), F.max("smallest").alias("most"), F.min("class").alias("class")
        ),
        "wide-groups",
    )
    ids = groups.groupBy("anchor", "core").agg(F.min("least").alias("least"), F.max("most").alias("most"))
    cores = materialize(ids.where("least < most").select("anchor", "core"), "shared-cores")
    group = ["anchor", "class", "least", "most", "low", F.col("left").alias("high"), F.col("window").alias("wide")]
    cut = materialize(groups.join(cores, ["anchor", "core"]).select(*group), "open-groups")
    cut = cut.join(contexts.select("anchor", "class", "words", "before"), ["anchor", "class"])
    found = F.explode(single("words", "before", "low", "high")).alias("w")
    cut = cut.select("anchor", "high", "wide", "least", "most", found)
    cut = materialize(cut.select("anchor", "high", "wide", "least", "most", "w.*"), "single-windows")
    least = cut.groupBy(*_WINDOW).agg(F.min("least").alias("least"), F.max("most").alias("most"))
    least = materialize(least.where("least < most").drop("most"), "windows")
    inside = (
        _repeated(cut.drop("most").withColumnRenamed("least", "smallest"), least)
        .groupBy("anchor", F.col("high").alias("left"), F.col("wide").alias("window"), "smallest")
        .agg(F.min("left").alias("low"), F.max("left").alias("high"))
    )
    inside = materialize(inside, "group-matches")
    whole = _repeated(runs, groups.where("least < most").select(*_WINDOW, "least"))
    part = runs.drop("low").join(inside, [*_WINDOW, "smallest"])
    return (
        whole.select("anchor", "class", "low", F.col("left").alias("high"))
        .unionByName(part.select("anchor", "class", "low", "high"))
        .groupBy("anchor", "class")
        .agg(F.max("high").alias("left"), (F.lit(reach) - F.min("low")).cast("int").alias("right"))
    )


_WINDOW = ["anchor", "left", "window"]


def _repeated(windows: DataFrame, least: DataFrame) -> DataFrame:
    """The windows of classes that stand in a class of a smaller id too."""
    return windows.join(least, _WINDOW).where("least < smallest")


# ------------------------------------------------------------ matches and removal


_LAST = 2**63 - 1


def matches(
    docs: DataFrame, window: int = WINDOW, seed: int = SEED, compared: int = COMPARED
) -> DataFrame:
    """(row, start, end): word ranges that stand in a document with a smaller id.

    ``docs``: row (binary, tells rows apart), doc_id and text (binary).  Ranges of a row
    may overlap.
    """
    reach = window - seed
    found = materialize(_seeds(docs, window, seed), "seeds")
    # A document without id comes after all others.
    ids = F.coalesce("doc_id", F.lit(_LAST))
    anchors = found.groupBy("anchor").agg(F.min(ids).alias("first_id"), F.max(ids).alias("last_id"))
    # Written first: a join with a table of its own may split a very frequent anchor, one with
    # an aggregation of the same rows may not.
    shared = materialize(anchors.where("first_id < last_id").select("anchor"), "shared-anchors")
    kept = materialize(found.join(shared, "anchor").withColumn("doc_id", ids), "shared-seeds")
    # A shorter context holds no window.
    kept = kept.where(F.col("before") + F.col("after") >= reach)
    # Of the members with the smallest id any may give the words.
    classes = materialize(
        kept.groupBy("anchor", "class").agg(
            F.min("doc_id").alias("smallest"),
            F.min_by(F.struct("row", "place", "before", "after"), F.struct("doc_id", "row", "place")).alias("at"),
        ),
        "seed-classes",
    )
    open_ = classes.groupBy("anchor").agg(F.count("*").alias("classes")).where("classes > 1")
    wanted = classes.join(open_, "anchor").select("anchor", "class", "smallest", "classes", "at.*")
    few, many = F.col("classes") <= compared, F.col("classes") > compared
    longest = materialize(
        _compared(_contexts(docs, wanted.where(few), seed), window, seed), "extensions"
    )
    if not open_.where(many).isEmpty():
        longest = longest.unionByName(
            materialize(_grouped(_contexts(docs, wanted.where(many), seed), window, seed), "extensions")
        )
    # Written for the same reason: one class may hold a third of all seeds.
    verdict = materialize(
        classes.select("anchor", "class", "smallest").join(longest, ["anchor", "class"], "left"), "class-matches"
    )
    whole = F.col("doc_id") > F.col("smallest")
    left = F.when(whole, F.col("before")).otherwise(F.col("left"))
    right = F.when(whole, F.col("after")).otherwise(F.col("right"))
    return kept.join(verdict, ["anchor", "class"]).where(whole | F.col("left").isNotNull()).select(
        "row", (F.col("place") - left).alias("start"), (F.col("place") + F.lit(seed) + right).alias("end")
    )


def merged(spans) -> list[tuple[int, int]]:
    """Sorted, disjoint spans that cover the same words."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def kept_words(text: bytes, spans) -> tuple[int, int, bytes]:
    """The number of words, of those inside ``spans``, and the others joined by spaces."""
    words = plain(text)
    starts = word_starts(words)
    n, at, removed, parts = len(starts) - 1, 0, 0, []
    for start, end in merged(spans):
        if start > at:
            parts.append(words[starts[at] : starts[start] - 1])
        removed += end - start
        at = end
    if at < n:
        parts.append(words[starts[at] :])
    return n, removed, b" ".join(parts)


def keyed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """row, doc_id, text (binary): rows with equal id and text share their ``row``."""
    text = utf8(text_column)
    own = F.concat(F.coalesce(F.col(id_column).cast("string"), F.lit("-")).cast("binary"), F.lit(":").cast("binary"), text)
    return docs.select(
        F.unhex(F.md5(own)).alias("row"), F.col(id_column).cast("long").alias("doc_id"), text.alias("text")
    )


def dedup_words(docs: DataFrame, **options) -> DataFrame:
    """Every row with the word ranges to remove: doc_id, text (binary), spans.

    Windows are judged on the input.  Null text counts as empty; texts of fewer words
    than a window lose nothing; a document without id comes after all others, and rows with
    equal ids do not count against one another.  Further columns are not read; an empty
    table gives no rows.  Long texts are scanned in pieces of 150,000 windows.  Spans
    may overlap and have no order.
    """
    small_batches(docs.sparkSession)
    rows = keyed(docs)
    spans = (
        matches(rows, **options)
        .groupBy("row")
        # A row's spans are fewer than its words.
        .agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    )
    none = F.array().cast("array<struct<start:int,end:int>>")
    return rows.join(spans, "row", "left").select("doc_id", "text", F.coalesce("spans", none).alias("spans"))


def kept_text(text: Column, spans: Column) -> Column:
    """Struct of n_words, n_removed and kept (binary)."""

    @F.pandas_udf("n_words long, n_removed long, kept binary")
    def keep(texts: pd.Series, found: pd.Series) -> pd.DataFrame:
        rows = [kept_words(t, [(s["start"], s["end"]) for s in f]) for t, f in zip(texts, found, strict=True)]
        return pd.DataFrame(rows, columns=["n_words", "n_removed", "kept"])

    return keep(text, spans)


def dedup_report(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256."""
    out = dedup_words(docs, **options).select("doc_id", kept_text(F.col("text"), F.col("spans")).alias("out"))
    return out.select("doc_id", "out.n_words", "out.n_removed", F.sha2("out.kept", 256).alias("kept_sha256"))
