"""SimHash near-dedup with deletion-variant signatures.

A 64-bit fingerprint is cut into two segments of 32 bits.  If two fingerprints
differ in three bits or fewer, one segment differs in at most one bit.  Each
different segment value is indexed under its 32 one-wildcard variants (one bit
deleted); values that meet under a variant are equal but for that bit.  So a block
of candidates is either all fingerprints with one segment value, or all with two
values that differ in one bit.  A variant has at most two different values, hence
this join grows in proportion to the values, however many copies there are.

Blocks of up to ``PAIRWISE`` fingerprints are compared pair by pair (verified on all 64
bits).  A larger block is cut again in the same way over the bits that are still
free: 32, then 16, then 8, where a block holds at most 2,048 fingerprints.  Equal
fingerprints are one node throughout, so copies are never expanded into pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import small_batches, utf8
from tallyspark.llm.components import smallest_reachable
from tallyspark.session import materialize

SHINGLE = 3
MAX_BITS = 3
PAIRWISE = 32
_SEED = 42
_UPPER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def fingerprint_of(text: bytes, shingle: int = SHINGLE) -> int:
    """The SimHash of a text as an unsigned number; 0 if it has no words."""
    words = text.translate(_UPPER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends, at = [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[:-1])]
    count = max(1, len(words) - shingle + 1)
    last = ends[shingle - 1 :] or ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[s:e], _SEED) for s, e in zip(starts, last, strict=False)), np.uint64, count
    )
    ones = np.zeros(64, np.uint64)
    for at in range(0, count, 4096):
        part = hashes[at : at + 4096].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0)
    return int.from_bytes(np.packbits(2 * ones.astype(np.int64) > count).tobytes(), "big")


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint of a binary column as a signed long."""

    @F.pandas_udf("long")
    def hashed(texts: pd.Series) -> pd.Series:
        values = np.fromiter((fingerprint_of(t, shingle) for t in texts), np.uint64, len(texts))
        return pd.Series(values.view(np.int64))

    return hashed(text)


def _bits(value: Column, low: Column, width: int) -> Column:
    return F.call_function("shiftrightunsigned", value, low).bitwiseAND(F.lit((1 << width) - 1))


def _cut(blocks: DataFrame, width: int) -> DataFrame:
    """Blocks (block, low, fp) whose free bits are low..low+width, cut in two segments.

    Returns finer blocks of the same form with width / 2 free bits.
    """
    half = width // 2
    upper = F.struct(
        F.lit(0).alias("side"),
        _bits(F.col("fp"), F.col("low") + F.lit(half), half).alias("segment"),
        F.col("low").alias("rest"),
    )
    lower = F.struct(
        F.lit(1).alias("side"),
        _bits(F.col("fp"), F.col("low"), half).alias("segment"),
        (F.col("low") + F.lit(half)).alias("rest"),
    )
    members = blocks.select("block", "fp", F.explode(F.array(upper, lower)).alias("s")).select(
        "block", "fp", "s.*"
    )
    place = ["block", "side", "segment"]
    values = members.groupBy(*place).agg(F.count("*").alias("n"))
    bit = F.col("bit")
    # The variant: side, deleted bit and the remaining bits in one number.
    variant = (
        (F.col("side") * F.lit(32) + bit).cast("long") * F.lit(1 << 32)
        + F.col("segment").bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(1).cast("long"), bit)))
    )
    pairs = (
        values.select("block", "side", "segment", F.explode(F.sequence(F.lit(0), F.lit(half - 1))).alias("bit"))
        .select("block", variant.alias("variant"), "segment")
        .groupBy("block", "variant")
        .agg(F.min("segment").alias("one"), F.max("segment").alias("two"))
        .where("one <> two")
        .withColumn("side", F.call_function("shiftrightunsigned", "variant", F.lit(37)).cast("int"))
    )
    both = pairs.select(
        "block", "side", F.explode(F.array("one", "two")).alias("segment"),
        F.xxhash64("block", "side", "one", "two").alias("finer"),
    )
    same = values.where("n > 1").select(
        *place, F.xxhash64("block", "side", "segment", "segment").alias("finer")
    )
    return members.join(same.unionByName(both), place).select(
        F.col("finer").alias("block"), F.col("rest").alias("low"), "fp"
    )


def _near_pairs(blocks: DataFrame, max_bits: int) -> DataFrame:
    one, two = blocks.select("block", F.col("fp").alias("a")), blocks.select("block", F.col("fp").alias("b"))
    differing = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    return one.join(two, "block").where((F.col("a") < F.col("b")) & (differing <= max_bits)).select("a", "b")


def near_fingerprints(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Linked pairs (a, b), each once, of different fingerprints (column ``fp``)."""
    if not 0 <= max_bits <= 3:
        raise ValueError("two segments cover at most three differing bits")
    blocks = fps.select(F.lit(0).cast("long").alias("block"), F.lit(0).alias("low"), "fp")
    width, found = 64, None
    while width > 8:
        blocks = materialize(_cut(blocks, width), "blocks")
        width //= 2
        sizes = blocks.groupBy("block").count()
        large = sizes.where(F.col("count") > PAIRWISE).select("block")
        last = width == 8 or large.isEmpty()
        now = blocks if last else blocks.join(large, "block", "left_anti")
        pairs = _near_pairs(now, max_bits)
        found = pairs if found is None else found.unionByName(pairs)
        if last:
            break
        blocks = blocks.join(large, "block", "left_semi")
    return found.distinct()


def near_groups(
    docs: DataFrame,
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Every row with its fingerprint and near-duplicate component.

    Columns: doc_id, text_hash, fp (signed), root (one value per component) and
    component_id, the smallest id in the component.  Null text counts as empty;
    all texts without words share fingerprint 0, which links like any other.  Null
    ids are skipped when the smallest is taken (null if no row has one).  Repeated
    rows are all returned.  An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    rows = materialize(
        docs.select(
            F.col(id_column).alias("doc_id"),
            F.xxhash64(utf8(text_column)).alias("text_hash"),
            fingerprint(utf8(text_column), shingle).alias("fp"),
        ),
        "fingerprints",
    )
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = smallest_reachable(near_fingerprints(nodes.select("fp"), max_bits))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = rooted.select("fp", "root").join(smallest, "root")
    return rows.join(labels, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def near_report(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, fingerprint as 16 hex digits, component_id."""
    return near_groups(docs, **options).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def one_per_group(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each component does.

    The row with the smallest id stays (a row without id only if no row of the
    component has one).  Of rows that share that id one stays.
    """
    groups = near_groups(docs, **options)
    stays = (
        groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root")
        .agg(F.min(F.struct("doc_id", "text_hash")).alias("stays"))
        .select("stays.*")
    )
    mark = "_text_hash"
    while mark in docs.columns:
        mark = "_" + mark
    stays = stays.select(F.col("doc_id").alias(mark + "_id"), F.col("text_hash").alias(mark + "_of"))
    kept = docs.withColumn(mark, F.xxhash64(utf8("text"))).join(
        stays,
        F.col("doc_id").eqNullSafe(F.col(mark + "_id")) & (F.col(mark) == F.col(mark + "_of")),
        "left_semi",
    )
    # Rows that repeat both id and text: one of them.
    return kept.dropDuplicates(["doc_id", mark]).drop(mark)
