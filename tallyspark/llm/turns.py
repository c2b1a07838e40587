"""Conversation turns in one global order, and hashes of what may be too long for one row."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.operators.ranking import distributed_row_number


def numbered_turns(rows: DataFrame, *order: str | Column) -> DataFrame:
    """``rows`` with ``place``: their number over conv_id, then ``order`` (nulls first).

    Rows are dealt by ranges of the whole order, so a conversation with very many
    turns is spread over tasks.  The places of a conversation have no gaps.
    """
    return distributed_row_number(rows, [F.col("conv_id"), *[F.col(c) if isinstance(c, str) else c for c in order]], "place")


def joined_sha256(pieces: DataFrame, key: list[str], order: str, piece: str, separator: str, out: str) -> DataFrame:
    """(key, out): lowercase SHA-256 of the pieces of a key, in ``order``, with separators.

    A hash needs its bytes in order, so a key's pieces are read by one task; they pass
    through it one batch at a time and are never held together.  Null pieces are
    left out; key columns may be null.
    """
    spark_key = ", ".join(f"{k} {t}" for k, t in pieces.select(*key).dtypes)
    joint = separator.encode()

    def stream(batches):
        now, state, begun = None, None, False
        for batch in batches:
            keys = list(zip(*[batch.column(k).to_pylist() for k in key], strict=True))
            texts = batch.column(piece).to_pylist()
            ended = []
            for at, text in zip(keys, texts, strict=True):
                if state is None or at != now:
                    if state is not None:
                        ended.append((*now, state.hexdigest()))
                    now, state, begun = at, hashlib.sha256(), False
                if begun:
                    state.update(joint)
                state.update(text.encode())
                begun = True
            yield record(ended)
        if state is not None:
            yield record([(*now, state.hexdigest())])

    types = [pieces_type(t) for _, t in pieces.select(*key).dtypes] + [pa.string()]

    def record(rows):
        columns = list(zip(*rows, strict=True)) if rows else [()] * (len(key) + 1)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[*key, out]
        )

    return (
        pieces.where(F.col(piece).isNotNull())
        .select(*key, order, piece)
        .repartition(*key)
        .sortWithinPartitions(*key, order)
        .mapInArrow(stream, f"{spark_key}, {out} string")
    )


def pieces_type(name: str) -> pa.DataType:
    """The Arrow type of a key column."""
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}[name]
