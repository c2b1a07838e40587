"""Removal of byte strings that repeat anywhere in the corpus, by suffix sorting.

Every byte inside a string of ``LENGTH`` bytes that also starts somewhere else is
removed.  Two suffixes can only share their first LENGTH bytes if they share the
window's anchor: of its runs of ``GRAM`` bytes the one with the smallest hash (the
last of equals), which depends on the window's bytes alone.  So:

1. All texts are cut into anchor ranges: the windows that have the same run as their
   anchor.  Anchors that occur once are settled: nothing there repeats.
2. Ranges with the same anchor and 128-bit digest of their bytes are one class.  All
   windows of a class with two or more ranges repeat; it needs no sorting, however many
   copies there are.
3. The suffixes of the remaining classes that share an anchor are sorted together:
   a mergesort that compares by prefix polynomial hashes and binary search, with
   bytes compared where hashes agree (:mod:`suffix_sort`).  Neighbours that agree on
   LENGTH bytes repeat.
4. Per text, the repeated windows are merged to spans and cut out.

Texts are scanned three times and shuffled once, in step 4.  Steps 1 to 3 move short
rows and, once, the bytes of classes that have to be sorted.  Bit maps of ``MAP_BITS``
bits, whatever the input, tell a scan which anchors matter; a false hit only costs a
row that a join then drops.  An anchor with more than ``SORTED_CLASSES`` classes is not
sorted in one task: its windows are grouped by their bytes, combined map-side.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import small_batches, utf8
from tallyspark.llm.suffix_sort import Prefixes, mixed, repeated
from tallyspark.session import materialize

LENGTH = 200
GRAM = 64
SORTED_CLASSES = 10_000
MAP_BITS = 26
_CHUNK = 1_000_000
_SORT_BYTES = 2_000_000


# ------------------------------------------------------------ anchor ranges


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    out, done = values, 1
    while done * 2 <= width:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    rest = width - done
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def _chunks(texts: list[bytes]):
    """Neighbouring texts joined to about ``_CHUNK`` bytes: (first, joined, starts)."""
    first, size, starts = 0, 0, [0]
    for i, text in enumerate(texts):
        if size and size + len(text) > _CHUNK:
            yield first, b"".join(texts[first:i]), np.array(starts)
            first, size, starts = i, 0, [0]
        size += len(text)
        starts.append(size)
    yield first, b"".join(texts[first:]), np.array(starts)


class Ranges:
    """The anchor ranges of one chunk of texts.

    ``text``: which text; ``low``: first window, ``windows``: how many; ``offset``: from
    the first window to the anchor; ``anchor``: the hash of the anchor.
    """

    def __init__(self, joined: bytes, starts: np.ndarray, length: int, gram: int):
        self.joined, self.starts, self.length = joined, starts, length
        data = np.frombuffer(joined, np.uint8)
        hashes = Prefixes(data).grams(gram)
        inside = length - gram + 1
        if len(data) < length:
            empty = np.zeros(0, np.int64)
            self.text = self.low = self.windows = self.offset = empty
            self.anchor = empty.astype(np.uint64)
            return
        # The low bits of the key hold the place, smaller for a later place.
        bits = max(1, int(len(data)).bit_length())
        mask = np.uint64((1 << bits) - 1)
        place = np.arange(len(hashes), dtype=np.uint64)
        smallest = _sliding_min((hashes & ~mask) | (mask - place), inside)
        at = (mask - (smallest & mask)).astype(np.int64)
        text = np.searchsorted(starts, np.arange(len(at)), side="right") - 1
        valid = np.flatnonzero(np.arange(len(at)) + length <= starts[text + 1])
        at, text = at[valid], text[valid]
        new = np.ones(len(valid), bool)
        new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
        begin = np.flatnonzero(new)
        self.low = valid[begin]
        self.windows = np.diff(np.append(begin, len(valid)))
        self.text = text[begin]
        self.offset = at[begin] - self.low
        self.anchor = hashes[at[begin]]

    def bytes_of(self, i: int) -> bytes:
        return self.joined[self.low[i] : self.low[i] + self.windows[i] - 1 + self.length]

    def classes(self, chosen: np.ndarray) -> pa.Array:
        """A 128-bit digest of the bytes and the offset for each chosen range.

        With the anchor's own 64 bits, classes agree in 192 bits or are not the same.
        """
        digest = xxhash.xxh3_128_digest
        return pa.array([digest(self.bytes_of(i), int(self.offset[i])) for i in chosen], pa.binary())


class BitMap:
    """A set of 64-bit numbers of fixed size: no false misses, some false hits."""

    def __init__(self, keys: DataFrame, bits: int = MAP_BITS):
        """``keys`` has one column of longs; at most 2**bits / 64 words reach the driver."""
        self.bits = bits
        place = F.col(keys.columns[0]).bitwiseAND(F.lit((1 << bits) - 1))
        words = (
            keys.select(
                F.shiftright(place, 6).alias("word"),
                F.call_function(
                    "shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int")
                ).alias("bit"),
            )
            .groupBy("word")
            .agg(F.bit_or("bit").alias("word_bits"))
            .toArrow()
        )
        self.words = np.zeros(1 << (bits - 6), np.uint64)
        self.words[words["word"].to_numpy()] = words["word_bits"].to_numpy().view(np.uint64)

    def has(self, keys: np.ndarray) -> np.ndarray:
        place = keys.view(np.uint64) & np.uint64((1 << self.bits) - 1)
        word = self.words[(place >> np.uint64(6)).astype(np.int64)]
        return (word >> (place & np.uint64(63))) & np.uint64(1) == 1


def _scan(docs: DataFrame, rows_of, schema: str, length: int, gram: int) -> DataFrame:
    """Apply ``rows_of(batch columns, first, Ranges)`` to all texts; it gives Arrow arrays."""
    names = [c.split()[0] for c in schema.split(", ")]

    def scan(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for first, joined, starts in _chunks(texts):
                arrays = rows_of(batch, first, Ranges(joined, starts, length, gram))
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.mapInArrow(scan, schema)


def _anchors(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """Anchors that occur more than once."""

    def rows_of(batch, first, ranges):
        every = np.arange(len(ranges.low))
        return [pa.array(ranges.anchor.view(np.int64)), pa.array(np.ones(len(every), np.int64))]

    found = _scan(docs.select("text"), rows_of, "anchor long, n long", length, gram)
    counts = found.groupBy("anchor").agg(F.sum("n").alias("n"))
    return counts.where("n > 1").select("anchor")


_OCCURRENCE = "digest binary, anchor long, class binary, tag long, low int, windows int, start int"


def _occurrences(docs: DataFrame, anchors: BitMap, length: int, gram: int) -> DataFrame:
    """Ranges whose anchor may occur more than once, with the digest of their text."""

    def rows_of(batch, first, ranges):
        chosen = np.flatnonzero(anchors.has(ranges.anchor))
        owner = ranges.text[chosen] + first
        low = ranges.low[chosen] - ranges.starts[ranges.text[chosen]]
        row = batch.column("row").to_numpy(zero_copy_only=False)[owner]
        tag = mixed(row.view(np.uint64) + low.astype(np.uint64)).view(np.int64)
        return [
            batch.column("digest").take(pa.array(owner)),
            pa.array(ranges.anchor[chosen].view(np.int64)),
            ranges.classes(chosen),
            pa.array(tag),
            pa.array(low.astype(np.int32)),
            pa.array(ranges.windows[chosen].astype(np.int32)),
            pa.array(ranges.offset[chosen].astype(np.int32)),
        ]

    return _scan(docs.select("digest", "row", "text"), rows_of, _OCCURRENCE, length, gram)


def _class_bytes(docs: DataFrame, wanted: BitMap, length: int, gram: int) -> DataFrame:
    """The bytes of the range that stands for each class to be sorted."""

    def rows_of(batch, first, ranges):
        row = batch.column("row").to_numpy(zero_copy_only=False)[ranges.text + first]
        low = ranges.low - ranges.starts[ranges.text]
        tag = mixed(row.view(np.uint64) + low.astype(np.uint64))
        # The class hash is dear: it is taken only where anchor and tag are wanted.
        chosen = np.flatnonzero(wanted.has(ranges.anchor ^ tag))
        return [
            pa.array(ranges.anchor[chosen].view(np.int64)),
            ranges.classes(chosen),
            pa.array(ranges.offset[chosen].astype(np.int32)),
            pa.array([ranges.bytes_of(i) for i in chosen], pa.binary()),
        ]

    return _scan(
        docs.select("row", "text"), rows_of, "anchor long, class binary, start int, bytes binary", length, gram
    )


# ------------------------------------------------------------ sorting classes


def _sort_block(rows: pd.DataFrame, length: int) -> pd.DataFrame:
    """Which windows of each class repeat in another class of the same anchor.

    ``rows``: whole anchors, one row per class.  A window can only equal one that lies
    the same way to the anchor and has the same first and last eight bytes, so the
    suffixes are split by these before the sort and single ones are left out.
    """
    sizes = rows["bytes"].map(len).to_numpy()
    joined = np.frombuffer(b"".join(rows["bytes"]), np.uint8)
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    windows = sizes - length + 1
    owner = np.repeat(np.arange(len(rows)), windows)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    start = begin[owner] + step
    text = Prefixes(joined)
    edge = min(8, length)
    side = rows["start"].to_numpy()[owner] - step
    key = mixed(rows["anchor"].to_numpy()[owner].view(np.uint64) + side.astype(np.uint64))
    key = mixed(key ^ text.span(start, edge))
    key = mixed(key + text.span(start + (length - edge), edge))
    order = np.argsort(key, kind="stable")
    alike = key[order][1:] == key[order][:-1]
    several = np.zeros(len(key), bool)
    several[order[1:][alike]] = True
    several[order[:-1][alike]] = True
    chosen = np.flatnonzero(several)
    mark = np.zeros(len(owner), bool)
    mark[chosen] = repeated(text, start[chosen], key[chosen], length)
    cuts = np.cumsum(windows)[:-1]
    masks = [np.packbits(m).tobytes() for m in np.split(mark, cuts)]
    out = rows[["anchor", "class"]].assign(mask=masks)
    return out[np.add.reduceat(mark, np.cumsum(windows) - windows) > 0]


def _sorted_classes(classes: DataFrame, length: int) -> DataFrame:
    """(anchor, class, mask): one bit per window of the class, set if it repeats."""

    def blocks(batches):
        held, size = [], 0
        for batch in batches:
            rows = batch.to_pandas()
            held.append(rows)
            size += rows["bytes"].map(len).sum()
            if size < _SORT_BYTES:
                continue
            rows = pd.concat(held, ignore_index=True)
            # The last anchor may go on in the next batch.
            rest = rows["anchor"] == rows["anchor"].iloc[-1]
            if not rest.all():
                yield rows[~rest].reset_index(drop=True)
                held = [rows[rest]]
                size = held[0]["bytes"].map(len).sum()
            else:
                held = [rows]
        if held:
            yield pd.concat(held, ignore_index=True)

    def sort(batches):
        for rows in blocks(batches):
            rows = rows.drop_duplicates(["anchor", "class"], ignore_index=True)
            found = _sort_block(rows, length)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found["anchor"]), pa.array(found["class"], pa.binary()), pa.array(found["mask"], pa.binary())],
                names=["anchor", "class", "mask"],
            )

    return (
        classes.repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(sort, "anchor long, class binary, mask binary")
    )


def _grouped_classes(classes: DataFrame, length: int) -> DataFrame:
    """The same for anchors with too many classes: windows grouped by their bytes."""
    step = F.sequence(F.lit(0), F.length("bytes") - F.lit(length))
    windows = classes.dropDuplicates(["anchor", "class"]).select(
        "anchor", "class", "start", "bytes", F.length("bytes").alias("size"), F.explode(step).alias("step")
    ).select(
        "anchor",
        "class",
        "step",
        "size",
        (F.col("start") - F.col("step")).alias("side"),
        F.substring(F.col("bytes"), F.col("step") + 1, F.lit(length)).alias("window"),
    )
    key = ["anchor", "side", "window"]
    twice = windows.groupBy(*key).count().where(F.col("count") > 1).select(*key)

    @F.pandas_udf("binary")
    def mask(sizes: pd.Series, steps: pd.Series) -> pd.Series:
        def one(size, found):
            bits = np.zeros(size - length + 1, bool)
            bits[np.asarray(found)] = True
            return np.packbits(bits).tobytes()

        return pd.Series([one(s, f) for s, f in zip(sizes, steps, strict=True)])

    return (
        windows.join(twice, key, "left_semi")
        .groupBy("anchor", "class", "size")
        .agg(F.collect_list("step").alias("steps"))
        .select("anchor", "class", mask("size", "steps").alias("mask"))
    )


def repeated_ranges(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, sorted_classes: int = SORTED_CLASSES
) -> DataFrame:
    """(digest, low, windows, mask) of all ranges with repeated windows; null mask: all.

    ``docs`` has digest, row (a long that tells rows apart) and text (binary).
    """
    anchors = BitMap(_anchors(docs, length, gram))
    found = materialize(_occurrences(docs, anchors, length, gram), "occurrences")
    classes = materialize(
        found.groupBy("anchor", "class").agg(F.count("*").alias("n"), F.min("tag").alias("tag")), "classes"
    )
    several = classes.groupBy("anchor").agg(F.count("*").alias("classes")).where("classes > 1")
    several = materialize(several, "open-anchors")
    wanted = classes.join(several, "anchor", "left_semi")
    chosen = BitMap(wanted.select(F.col("anchor").bitwiseXOR(F.col("tag"))))
    # False hits of the bit map go here; classes with bytes are written once.
    held = _class_bytes(docs, chosen, length, gram).join(
        wanted.select("anchor", "class"), ["anchor", "class"], "left_semi"
    )
    held = materialize(held, "class-bytes")
    hot = several.where(F.col("classes") > sorted_classes).select("anchor")
    masks = _sorted_classes(held.join(hot, "anchor", "left_anti"), length)
    if not hot.isEmpty():
        masks = masks.unionByName(_grouped_classes(held.join(hot, "anchor", "left_semi"), length))
    # A class with several ranges repeats as a whole.
    whole = classes.where("n > 1").select("anchor", "class", F.lit(None).cast("binary").alias("mask"))
    verdict = whole.unionByName(masks.join(classes.where("n = 1"), ["anchor", "class"], "left_semi"))
    return found.join(verdict, ["anchor", "class"]).select("digest", "low", "windows", "mask")


# ------------------------------------------------------------ removal


def spans_of(ranges, length: int) -> list[tuple[int, int]]:
    """Byte spans covered by the repeated windows of (low, windows, mask) ranges."""
    starts = []
    for low, windows, mask in ranges:
        if mask is None:
            starts.append(np.arange(low, low + windows))
        else:
            bits = np.unpackbits(np.frombuffer(mask, np.uint8))[:windows]
            starts.append(low + np.flatnonzero(bits))
    if not starts:
        return []
    at = np.unique(np.concatenate(starts))
    new = np.flatnonzero(np.append(True, np.diff(at) > length))
    ends = np.append(at[new[1:] - 1], at[-1]) + length
    return list(zip(at[new].tolist(), ends.tolist(), strict=True))


def remove_spans(text: bytes, spans) -> bytes:
    parts, at = [], 0
    for start, end in spans:
        parts.append(text[at:start])
        at = end
    return b"".join([*parts, text[at:]])


def dedup_spans(
    docs: DataFrame, length: int = LENGTH, id_column: str = "doc_id", text_column: str = "text", **options
) -> DataFrame:
    """Every row with its text (binary) and the spans to remove.

    Columns: doc_id, text, spans.  Strings are judged on the input.  Null text counts as
    empty; texts shorter than ``length`` have no spans; all rows of equal texts are
    covered alike, whatever their ids.  Spans are maximal, in order and disjoint.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        utf8(text_column).alias("text"),
        F.unhex(F.md5(utf8(text_column))).alias("digest"),
    ).withColumn("row", F.xxhash64("doc_id", "digest"))
    ranges = repeated_ranges(rows.select("digest", "row", "text"), length, **options)
    # As a set: the copies of a text give equal ranges, combined map-side.
    per_text = ranges.groupBy("digest").agg(F.collect_set(F.struct("low", "windows", "mask")).alias("ranges"))

    @F.pandas_udf("array<struct<start:long,end:long>>")
    def merge(ranges: pd.Series) -> pd.Series:
        def one(found):
            triples = [(r["low"], r["windows"], r["mask"]) for r in found]
            return [{"start": a, "end": b} for a, b in spans_of(triples, length)]

        return ranges.map(one)

    spans = per_text.select("digest", merge("ranges").alias("spans"))
    none = F.array().cast("array<struct<start:long,end:long>>")
    return rows.join(spans, "digest", "left").select(
        "doc_id", "text", F.coalesce("spans", none).alias("spans")
    )


def dedup_report(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""

    @F.pandas_udf("string")
    def kept(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series(
            [
                hashlib.sha256(remove_spans(t, [(s["start"], s["end"]) for s in found])).hexdigest()
                for t, found in zip(texts, spans, strict=True)
            ]
        )

    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return dedup_spans(docs, **options).select(
        "doc_id",
        F.octet_length("text").cast("long").alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        kept("text", "spans").alias("kept_sha256"),
    )
