"""Benchmark decontamination with Wu-Manber search over words.

A benchmark item gives its runs of ten words (a shorter item its whole word run);
these windows are the patterns.  Words are symbols.  For the patterns of one length:

* the shift table says, for a block of two words, how far the end of the search
  window may move on without missing a pattern; a block of no pattern skips all;
* where the shift is zero, the bucket of that last block is searched, split by
  the first block;
* the words are then compared directly.

Documents are searched where they lie: nothing is shuffled.  Patterns are broadcast
in blocks of at most ``WINDOWS_PER_BLOCK`` windows; more windows mean more passes.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import small_batches, utf8
from tallyspark.session import materialize

WINDOW = 10
WINDOWS_PER_BLOCK = 200_000
# Word bytes: digits, letters after lower-casing A-Z, and all bytes of non-ASCII
# characters.  Every other byte separates words.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 32
    for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


class Patterns:
    """Wu-Manber tables for word patterns, one set for each pattern length."""

    def __init__(self, patterns: dict[tuple[bytes, ...], set[str]]):
        self.ids: dict[bytes, int] = {}
        for pattern in patterns:
            for word in pattern:
                self.ids.setdefault(word, len(self.ids) + 1)
        self.base = len(self.ids) + 1
        by_length = defaultdict(list)
        for pattern, items in patterns.items():
            by_length[len(pattern)].append(([self.ids[w] for w in pattern], sorted(items)))
        self.tables = [self._tables(m, group) for m, group in sorted(by_length.items())]

    def _block(self, symbols: list[int], end: int, size: int) -> int:
        return symbols[end] if size == 1 else symbols[end - 1] * self.base + symbols[end]

    def _tables(self, length: int, group):
        size = min(2, length)
        shift: dict[int, int] = {}
        buckets: dict[int, dict[int, list]] = defaultdict(lambda: defaultdict(list))
        for symbols, items in group:
            for end in range(size - 1, length):
                block = self._block(symbols, end, size)
                shift[block] = min(shift.get(block, length), length - 1 - end)
            last = self._block(symbols, length - 1, size)
            buckets[last][self._block(symbols, size - 1, size)].append((symbols, items))
        return length, size, shift, {k: dict(v) for k, v in buckets.items()}

    def search(self, text: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """The spans of words inside any occurrence, merged, and the items that occur."""
        get = self.ids.get
        symbols = [get(w, 0) for w in text]
        spans, items = [], set()
        if not any(symbols):
            return spans, items
        for length, size, shift, buckets in self.tables:
            far = length - size + 1
            end = length - 1
            while end < len(symbols):
                last = self._block(symbols, end, size)
                move = shift.get(last, far)
                if move:
                    end += move
                    continue
                start = end - length + 1
                for pattern, owners in buckets[last].get(
                    self._block(symbols, start + size - 1, size), ()
                ):
                    if symbols[start : end + 1] == pattern:
                        spans.append((start, end + 1))
                        items.update(owners)
                end += 1
        return merged(spans), items


def merged(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(x) for x in out]


def windows(benchmark: DataFrame, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """The different windows of all items with the ids that have them (as text)."""

    @F.pandas_udf("array<binary>")
    def cut(texts: pd.Series) -> pd.Series:
        def one(text):
            words = words_of(text)
            last = max(1, len(words) - WINDOW + 1) if words else 0
            return list({b" ".join(words[i : i + WINDOW]) for i in range(last)})

        return texts.map(one)

    return (
        benchmark.select(F.col(id_column).cast("string").alias("item"), F.explode(cut(utf8(text_column))).alias("window"))
        .groupBy("window")
        .agg(F.collect_set("item").alias("items"))
    )


_FOUND = "n_words long, spans array<struct<start:int,end:int>>, items array<string>"


def _searched(patterns: Patterns, text: Column, before: Column | None) -> Column:
    @F.pandas_udf(_FOUND)
    def search(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            words = words_of(text)
            spans, items = patterns.search(words)
            rows.append((len(words), [{"start": a, "end": b} for a, b in spans], sorted(items)))
        return pd.DataFrame(rows, columns=["n_words", "spans", "items"])

    found = search(text)
    if before is None:
        return found
    return F.struct(
        found["n_words"].alias("n_words"),
        F.concat(before["spans"], found["spans"]).alias("spans"),
        F.array_union(before["items"], found["items"]).alias("items"),
    )


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, out: str = "leaks", text_column: str = "text",
    windows_per_block: int = WINDOWS_PER_BLOCK,
) -> DataFrame:
    """``docs`` with a struct column ``out``: n_words, spans of hit words, items.

    Spans are half-open word ranges and may overlap when there are several blocks.
    Null and empty texts have no words; an item without words matches nothing, one
    without id marks words but is not listed; equal items all count.  All columns and rows of ``docs`` stay as they are.
    """
    spark = docs.sparkSession
    small_batches(spark)
    cut = materialize(windows(benchmark), "windows")
    blocks = max(1, -(-cut.count() // windows_per_block))
    part = F.pmod(F.xxhash64("window"), F.lit(blocks))
    result = None
    for block in range(blocks):
        # At most about windows_per_block rows reach the driver at a time.
        rows = cut.where(part == block).collect()
        patterns = Patterns({tuple(bytes(r["window"]).split()): set(r["items"]) for r in rows})
        before = None if result is None else F.col(out)
        result = (docs if result is None else result).withColumn(
            out, _searched(patterns, utf8(text_column), before)
        )
        if blocks > 1:
            result = materialize(result, "leaks")
    return result


def leak_report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = find_leaks(docs.select("doc_id", "text"), benchmark, **options)
    items = F.array_sort(F.col("leaks.items"))
    return found.select(
        "doc_id",
        F.col("leaks.n_words").alias("n_words"),
        hit_words(F.col("leaks.spans")).alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("leaks.spans") > 0).alias("contaminated"),
    )


def hit_words(spans: Column) -> Column:
    """Words inside the union of the spans.

    Spans sorted by start: each adds what lies beyond the furthest end so far.
    """
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    total = F.aggregate(
        F.array_sort(spans),
        start,
        lambda s, x: F.struct(
            (s["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(s["end"], x["start"]))).cast("long").alias("n"),
            F.greatest(s["end"], x["end"]).alias("end"),
        ),
        lambda s: s["n"],
    )
    return total


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without any hit word, with their columns."""
    name = "leaks"
    while name in docs.columns:
        name = "_" + name
    found = find_leaks(docs, benchmark, out=name)
    return found.where(F.size(F.col(name)["spans"]) == 0).drop(name)
