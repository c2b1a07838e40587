"""Exact dedup by 128-bit content hash, with bytes compared inside each hash group.

Rows are grouped by (MD5, text).  The digest spreads the rows, and because the
text itself is part of the grouping key Spark compares the bytes of all rows
that meet, so texts with equal digests stay apart.  Copies collapse before the
shuffle (partial aggregation): a group with a third of all rows sends at most
one row per input task, and its text crosses the network once per task.

What is written in between has one short row per different text.  Documents are
matched to it by (MD5, SHA-256); if two different texts ever agree in both, the
text joins the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.session import materialize


def _digests(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.coalesce(F.col(text_column), F.lit(""))
    return docs.select(
        F.col(id_column).alias("doc_id"),
        text.alias("text"),
        F.unhex(F.md5(text.cast("binary"))).alias("digest"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("sha"),
    )


def exact_groups(
    docs: DataFrame, keep: str = "smallest", id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Every row with the group of its text.

    Columns: doc_id, keep_id (the ``smallest`` or ``largest`` id of the group),
    group_size, kept, text_sha256.  Null text counts as empty.  A null id never
    wins over an id; a group without any id has keep_id null.  Exactly one row of a
    group is kept: of rows that repeat the winning id, one.  An empty table gives
    no rows; further columns of ``docs`` are not read.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    winner = F.min if keep == "smallest" else F.max
    rows = _digests(docs, id_column, text_column)
    groups = rows.groupBy("digest", "text").agg(
        winner("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    )
    sha = F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("sha")
    short = materialize(groups.select("digest", sha, "keep_id", "group_size"), "exact-groups")
    key = ["digest", "sha"]
    if short.groupBy(*key).count().where("count > 1").isEmpty():
        found = rows.select("doc_id", *key).join(short, key)
        same_row = ["doc_id", *key]
    else:
        found = rows.join(groups, ["digest", "text"])
        same_row = ["doc_id", "digest", "text"]
    # Dealt by id, so that the join above may split a hot group over many tasks.
    once = Window.partitionBy(*same_row).orderBy(F.lit(1))
    is_winner = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return (
        found.repartition("doc_id")
        .withColumn("kept", is_winner & (F.row_number().over(once) == 1))
        .select(
            "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256")
        )
    )


def drop_copies(docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """The kept ids only."""
    return exact_groups(docs, keep).where("kept").select("doc_id")
