"""From API documents (JSON text) to rows, with the defaults the feeds need."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.params import MAX_STORIES

# Field of the document -> (column, value if the field is missing, type)
REPO_FIELDS = {
    "stargazers_count": ("stars", 72000, "bigint"),
    "forks_count": ("forks", 4500, "bigint"),
    "open_issues_count": ("open_issues", 120, "bigint"),
    "subscribers_count": ("watchers", 1800, "bigint"),
}
STORY_FIELDS = {
    "title": ("title", "", "string"),
    "points": ("points", 0, "bigint"),
    "num_comments": ("num_comments", 0, "bigint"),
    "created_at": ("created_at", "", "string"),
}


def field_or_default(document: Column, name: str, default, type_name: str) -> Column:
    """A member of a JSON object; the default only if it is *missing*.

    A member that is there with the value null stays NULL.
    """
    path = f"$['{name}']"
    missing = F.variant_get(document, path, "variant").isNull()
    value = F.variant_get(document, path, type_name)
    return F.when(missing, F.lit(default).cast(type_name)).otherwise(value)


def _fields(document: Column, fields: Mapping[str, tuple]) -> list[Column]:
    return [
        field_or_default(document, name, default, type_name).alias(column)
        for name, (column, default, type_name) in fields.items()
    ]


def _is(value: Column, kind: str) -> Column:
    """Is a parsed JSON value an OBJECT or an ARRAY?  False for NULL and broken text."""
    return F.coalesce(F.schema_of_variant(value).startswith(kind), F.lit(False))


def object_rows(
    df: DataFrame,
    document: str,
    fields: Mapping[str, tuple] = REPO_FIELDS,
    keep: Sequence[str] = (),
    fallback: bool = False,
) -> DataFrame:
    """One JSON object per row -> one row with named columns.

    Text that is no JSON object (see :func:`rejected_documents`) gives no row, or with
    ``fallback`` a row of defaults.
    """
    parsed = df.select(*keep, F.try_parse_json(document).alias("_v"))
    usable = _is(F.col("_v"), "OBJECT")
    if fallback:
        whole = F.when(usable, F.col("_v")).otherwise(F.parse_json(F.lit("{}")))
        return parsed.withColumn("_v", whole).select(*keep, *_fields(F.col("_v"), fields))
    return parsed.where(usable).select(*keep, *_fields(F.col("_v"), fields))


def rejected_documents(
    df: DataFrame, document: str, member: str | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Documents that give no rows, with the ``reason``.

    With ``member`` the document must hold a list of that name.
    """
    parsed = df.select(*keep, F.col(document).alias("document"), F.try_parse_json(document).alias("_v"))
    reason = F.when(F.col("document").isNull(), "missing").when(F.col("_v").isNull(), "not JSON")
    reason = reason.when(~_is(F.col("_v"), "OBJECT"), "not an object")
    if member:
        held = F.variant_get("_v", f"$['{member}']", "variant")
        reason = reason.when(~_is(held, "ARRAY"), "no list")
    return parsed.select(*keep, "document", reason.alias("reason")).where("reason is not null")


def list_rows(
    df: DataFrame,
    document: str,
    member: str = "hits",
    fields: Mapping[str, tuple] = STORY_FIELDS,
    first: int | None = MAX_STORIES,
    keep: Sequence[str] = (),
    fallback: Sequence[Mapping[str, object]] = (),
) -> DataFrame:
    """``{"hits": [{...}, ...]}`` -> one row for each of the first entries, with its place.

    ``first=None`` takes the whole list.  Entries that are no objects give no row.  A
    document without such a list gives the rows of ``fallback`` (given as JSON members).
    """
    parsed = df.select(*keep, F.try_parse_json(document).alias("_d"))
    path = f"$['{member}']"
    if first is None:
        entries = F.variant_get("_d", path, "array<variant>")
    else:
        # Take the entries by place: the rest of a long list is never unpacked.
        entries = F.array(*(F.variant_get("_d", f"{path}[{i}]", "variant") for i in range(first)))
    usable = _is(F.variant_get("_d", path, "variant"), "ARRAY")
    other = F.from_json(F.lit(json.dumps(list(fallback))), "array<variant>")
    listed = F.when(usable, entries).otherwise(other)
    return (
        parsed.select(*keep, F.posexplode(listed).alias("position", "_v"))
        .where(_is(F.col("_v"), "OBJECT"))
        .select(*keep, "position", *_fields(F.col("_v"), fields))
    )


def rate_rows(
    df: DataFrame,
    document: str,
    member: str = "rates",
    keep: Sequence[str] = (),
    required: Mapping[str, float] | None = None,
    base_currency: str = "USD",
) -> DataFrame:
    """``{"rates": {"EUR": 0.9, ...}}`` -> one row per currency.

    Currencies of ``required`` that a document lacks get the value given there.
    This happens inside each document's map: no join, no shuffle.
    """
    rates = F.variant_get(F.try_parse_json(document), f"$['{member}']", "map<string,double>")
    parsed = df.select(*keep, rates.alias("_r"))
    if required:
        pairs = [x for name, value in required.items() for x in (F.lit(name), F.lit(float(value)))]
        defaults = F.create_map(*pairs)
        missing = F.map_filter(defaults, lambda name, _: ~F.map_contains_key(F.col("_r"), name))
        rates = F.when(F.col("_r").isNull(), defaults).otherwise(F.map_concat(F.col("_r"), missing))
    else:
        rates = F.col("_r")
    return parsed.select(*keep, F.explode(rates).alias("quote_currency", "rate")).select(
        *keep, F.lit(base_currency).alias("base_currency"), "quote_currency", "rate"
    )


def fill_required_members(df: DataFrame, key: str, defaults: DataFrame) -> DataFrame:
    """Add the rows of ``defaults`` whose key does not occur in ``df``.

    ``df`` is reduced to its distinct keys map-side; every row of ``df`` stays.
    """
    absent = defaults.join(df.select(key).distinct(), key, "left_anti")
    return df.unionByName(absent)


def fallback_if_empty(df: DataFrame, fallback: DataFrame) -> DataFrame:
    """``df`` if it has rows, else ``fallback``; decided by Spark at run time.

    One row of ``df`` is enough to drop the whole fallback: the filter compares
    with a subquery that counts at most one row, so nothing is joined.
    """
    found = df.limit(1).agg(F.count("*")).scalar()
    return df.unionByName(fallback.where(found == 0))
