"""Numbers for keys that never change once given."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.operators.ranking import distributed_row_number


def with_new_keys(known: DataFrame | None, rows: DataFrame, key: str, order_by: Sequence[Column], out: str) -> DataFrame:
    """The map (``key``, ``out``) after the keys of ``rows`` have got numbers.

    ``known`` is the map so far (none: nothing is numbered yet).  Keys in it keep their
    numbers; others get the numbers after the largest one, without gaps, in ``order_by`` (
    ascending; of a key's rows the first counts, equal places go by key).
    Null keys get no number.  Publish the result before it is used, for
    instance as a ``VersionedTable``: the next load starts from it.
    """
    # One row a key; which of a key's rows gives its place is settled by the order itself.
    ranked = rows.where(F.col(key).isNotNull()).select(key, *[c.alias(f"_o{i}") for i, c in enumerate(order_by)])
    places = [c for c in ranked.columns if c != key]
    firsts = ranked.groupBy(key).agg(F.min(F.struct(*places)).alias("_place")).select(key, "_place.*")
    fresh = firsts if known is None else firsts.join(known.select(key), key, "left_anti")
    numbered = distributed_row_number(fresh, [F.col(c) for c in [*places, key]], out)
    if known is None:
        return numbered.select(key, out)
    high = known.agg(F.coalesce(F.max(out), F.lit(0))).first()[0]
    return known.select(key, out).unionByName(numbered.select(key, (F.col(out) + F.lit(high)).alias(out)))

