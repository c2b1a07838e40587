"""The trie of conversation prefixes, with totals over subtrees.

A node stands for a sequence of first turns (role, text) that some conversation begins with; its
members are all conversations that do.  A node is named by its smallest member and its
depth, so the nodes of one name are a chain, and the way from the root to a node is
the way of its smallest member.

Prefixes are told apart by two 64-bit sums (exclusive or) over their turns, each a hash of
the SHA-256 of role and text and of the place.  They are running sums inside blocks of
``BLOCK`` turns, to which the sums of the blocks before are added: a conversation of any
length is spread over tasks.  Members of a node are only ever counted or reduced
to the smallest, map-side first.  Subtree totals come from :mod:`centroids`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.centroids import SMALL, subtree_totals
from tallyspark.llm.turns import joined_sha256, numbered_turns
from tallyspark.operators.ranking import distributed_row_number
from tallyspark.session import materialize

BLOCK = 1024
IDS_PER_PIECE = 1000
FAMILY, HEADS = 100, 6


def _long_of(digest: Column, start: int) -> Column:
    """64 bits of a hexadecimal digest."""
    return F.conv(F.substring(digest, start, 16), 16, -10).cast("long")


def turns_in_order(conversations: DataFrame) -> DataFrame:
    """conv_id, turn_no (from 1, by turn, role, text; nulls first), one, two (hashes), chars.

    Null role or text counts as empty; rows without conv_id are in no conversation.
    """
    empty = F.lit("")
    rows = conversations.where("conv_id is not null").select(
        "conv_id", "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text")
    )
    held = numbered_turns(rows, "turn", "role", "text")
    role, text = F.col("role").cast("binary"), F.col("text").cast("binary")
    # The length of the role tells where it ends.
    digest = F.sha2(F.concat(F.octet_length(role).cast("string").cast("binary"), F.lit(":").cast("binary"), role, text), 256)
    light = held.select("conv_id", "place", digest.alias("digest"), F.length("text").alias("chars"))
    light = materialize(
        light.select("conv_id", "place", _long_of(F.col("digest"), 1).alias("one"), _long_of(F.col("digest"), 17).alias("two"), "chars"),
        "turn-hashes",
    )
    firsts = light.groupBy("conv_id").agg(F.min("place").alias("first"))
    return light.join(firsts, "conv_id").select(
        "conv_id", (F.col("place") - F.col("first") + 1).alias("turn_no"), "one", "two", F.col("chars").cast("long").alias("chars")
    )


def with_shared_heads(turns: DataFrame) -> DataFrame:
    """Conversations rebuilt so that they share their first turns: the same columns.

    The first h turns of conversation c come from conversation c - c % 100 (all if it has
    fewer, none if there is none), then follow c's own after its first h; h is the unsigned
    crc32 of the decimal c modulo 6.  A conversation may end up without turns.
    """
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    heads = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(HEADS)).cast("long")
    lengths = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    # At most FAMILY conversations share a base, and at most HEADS - 1 of its turns.
    available = lengths.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    plan = lengths.select("conv_id", base.alias("base"), heads.alias("h")).join(available, "base", "left").select(
        "conv_id", "base", "h", F.least(F.col("h"), F.coalesce("base_n", F.lit(0))).alias("shared")
    )
    first = turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("turn_no") < HEADS)).withColumnRenamed("conv_id", "base")
    begun = plan.join(first, "base").where("turn_no <= h").select("conv_id", "turn_no", "one", "two", "chars")
    own = turns.join(plan.select("conv_id", "h", "shared"), "conv_id").where("turn_no > h").select(
        "conv_id", (F.col("turn_no") - F.col("h") + F.col("shared")).alias("turn_no"), "one", "two", "chars"
    )
    return begun.unionByName(own)


def _prefixes(turns: DataFrame, block: int) -> DataFrame:
    """member, depth, p1, p2 (the prefix), chars (of its last turn)."""
    mixed = turns.select(
        F.col("conv_id").alias("member"),
        F.col("turn_no").alias("depth"),
        F.xxhash64("one", "two", "turn_no").alias("f1"),
        F.xxhash64("turn_no", "two", F.lit("second"), "one").alias("f2"),
        "chars",
        F.expr(f"(turn_no - 1) div {block}").alias("block"),
    )
    so_far = Window.partitionBy("member", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    inside = mixed.withColumns({f"p{i}": F.bit_xor(f"f{i}").over(so_far) for i in (1, 2)})
    sums = mixed.groupBy("member", "block").agg(F.bit_xor("f1").alias("s1"), F.bit_xor("f2").alias("s2"))
    before = Window.partitionBy("member").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumns({f"o{i}": F.bit_xor(f"s{i}").over(before) for i in (1, 2)}).where("block > 0")
    joined = inside.join(offsets.select("member", "block", "o1", "o2"), ["member", "block"], "left")
    whole = lambda i: F.col(f"p{i}").bitwiseXOR(F.coalesce(f"o{i}", F.lit(0).cast("long"))).alias(f"p{i}")
    return joined.select("member", "depth", whole(1), whole(2), "chars")


def prefix_trie(members: DataFrame, turns: DataFrame, block: int = BLOCK, small: int = SMALL) -> DataFrame:
    """All nodes of the trie of ``turns`` (as :func:`turns_in_order` gives them).

    ``members``: conv_id of every conversation, also of those without turns; all are members
    of the root.  Columns: conv_id (smallest member), depth, parent_conv_id (null at
    the root), n_convs, n_children, n_leaves, saved_tokens and ends_sha256.  Turns of a
    conversation are numbered from 1 without gaps.  Without members there are no nodes.
    """
    zero = F.lit(0).cast("long")
    root = members.select(F.col("conv_id").alias("member")).distinct().select(
        "member", zero.alias("depth"), zero.alias("p1"), zero.alias("p2"), zero.alias("chars")
    )
    rows = materialize(root.unionByName(_prefixes(turns, block)), "prefixes")
    found = materialize(
        rows.groupBy("depth", "p1", "p2").agg(
            F.min("member").alias("conv_id"), F.count("*").alias("n_convs"), F.max("chars").alias("chars")
        ),
        "prefix-nodes",
    )
    # One row of ``found`` a node: a node with very many members may be split over tasks.
    ways = materialize(
        rows.join(found.select("depth", "p1", "p2", "conv_id"), ["depth", "p1", "p2"]).select("member", "depth", "conv_id"),
        "prefix-ways",
    )
    above = ways.select(F.col("member").alias("conv_id"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"))
    linked = found.select("conv_id", "depth", "n_convs", "chars").join(above, ["conv_id", "depth"], "left")
    kids = (
        linked.where("parent_conv_id is not null")
        .groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"))
        .agg(F.count("*").alias("n_children"))
    )
    # The nodes below a node: of each member the nodes it names, its own way's only from here.
    named = ways.groupBy("member").agg(F.max("depth").alias("length"), F.count_if(F.col("member") == F.col("conv_id")).alias("names"))
    sizes = (
        ways.join(named, "member")
        .groupBy("conv_id", "depth")
        .agg(
            F.sum(
                F.when(F.col("member") == F.col("conv_id"), F.col("length") - F.col("depth") + 1).otherwise(F.col("names"))
            ).alias("size")
        )
    )
    nodes = materialize(
        linked.join(kids, ["conv_id", "depth"], "left").join(sizes, ["conv_id", "depth"]).select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", zero).alias("n_children"),
            "size",
            F.col("n_children").isNull().cast("long").alias("n_leaves"),
            ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
        ),
        "trie-nodes",
    )
    after = ways.select("member", (F.col("depth") - 1).alias("depth"), F.col("conv_id").alias("next"))
    totals = subtree_totals(
        nodes.select("conv_id", "depth", "parent_conv_id", "size", "n_leaves", "saved_tokens"),
        ways.join(after, ["member", "depth"], "left"),
        ["n_leaves", "saved_tokens"],
        small,
    )
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return (
        nodes.drop("n_leaves", "saved_tokens", "size")
        .join(totals, ["conv_id", "depth"])
        .join(_ends(ways), ["conv_id", "depth"], "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", nothing))
    )


def _ends(ways: DataFrame) -> DataFrame:
    """conv_id, depth, ends_sha256: the conversations that end at a node."""
    last = ways.groupBy("member").agg(F.max_by("conv_id", "depth").alias("conv_id"), F.max("depth").alias("depth"))
    node = ["conv_id", "depth"]
    placed = distributed_row_number(last, [F.col("conv_id"), F.col("depth"), F.col("member")], "place")
    ids = F.transform(F.array_sort(F.collect_list("member")), lambda x: x.cast("string"))
    pieces = (
        placed.groupBy(*node, F.expr(f"place div {IDS_PER_PIECE}").alias("piece_no"))
        .agg(F.array_join(ids, ",").alias("piece"))
    )
    return joined_sha256(pieces, node, "piece_no", "piece", ",", "ends_sha256")


def trie_report(conversations: DataFrame, **options) -> DataFrame:
    """The trie of the conversations rebuilt by :func:`with_shared_heads`, one row a node.

    Rows without conv_id are left out, null role or text counts as empty, further columns
    are not read, repeated rows are repeated turns; an empty table gives no nodes.
    """
    turns = materialize(turns_in_order(conversations), "turns-in-order")
    members = turns.select("conv_id").distinct()
    return prefix_trie(members, with_shared_heads(turns), **options)
