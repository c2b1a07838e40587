"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree: elements on the same path (tags and
classes from the root) become one node.  A node has as many presentations as its
element has different sequences of children, and its text blocks are its content.

* Presentation importance: the entropy of a node's presentations over its pages, to
  the base of their number.  One fixed layout on all pages gives 0.
* Content importance: 1 minus the mean entropy of its text blocks over the pages.  A
  block on every page gives 0, one that occurs on a single page 1.
* Composite importance: with l presentations and g = DAMPING ** l, (1 - g) times the
  presentation importance plus g times the mean of the children's, weighted by their
  share in the sequences.

Importance is shrunk towards 1 by a prior of ``PRIOR_PAGES`` pages, so that few pages say
little and there is no number of pages at which the rule changes.  Branches below the
threshold are removed from each page, and so are those whose tag, role or class names
them as furniture (menus, footers, adverts, comments, forms): markup says outright what
entropy would have to guess on a host with few pages.  Inside ``article`` or ``main`` only
what almost every page repeats is low enough.  Sums are decimal, so a task that runs
again cannot move a branch across a threshold.

All numbers come from grouped sums over (host, path, block), combined map-side, so a
host with a third of all pages is spread.  Pages are read twice and never shuffled:
what is removed is broadcast while it has at most ``BROADCAST_PATHS`` paths, beyond
that it is joined to each page's paths.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.scalar import exact_sum
from tallyspark.llm.common import small_batches
from tallyspark.llm.html_tree import parse
from tallyspark.llm.url_filter import host_and_path
from tallyspark.session import materialize

DAMPING = 0.9
THRESHOLD = 0.3
ARTICLE_THRESHOLD = 0.05
# Every branch starts with so many pages on which it matters wholly.
PRIOR_PAGES = 1.6
BROADCAST_PATHS = 500_000

_EXACT = "decimal(28,12)"
_COUNTED = "array<struct<value:bigint,n:int>>"
_NODES = (
    "host string, page bigint, path bigint, above array<bigint>, protected boolean, beside boolean, share double, "
    f"styles {_COUNTED}, texts {_COUNTED}"
)


def _style_nodes(pages: DataFrame) -> DataFrame:
    """One row per page and path: presentations, text blocks, share in the parent."""
    kinds = pa.list_(pa.struct([("value", pa.int64()), ("n", pa.int32())]))
    schema = pa.schema(
        [
            ("host", pa.string()),
            ("page", pa.int64()),
            ("path", pa.int64()),
            ("above", pa.list_(pa.int64())),
            ("protected", pa.bool_()),
            ("beside", pa.bool_()),
            ("share", pa.float64()),
            ("styles", kinds),
            ("texts", kinds),
        ]
    )

    def counted(counter):
        return [{"value": v, "n": n} for v, n in counter.items()]

    def read(batches):
        for batch in batches:
            rows = []
            for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                nodes = parse(html).nodes
                page = xxhash.xxh64_intdigest(html) & (2**63 - 1)
                articles = [node for node in nodes.values() if node.protected]
                around = {path for node in articles for path in (*node.above, node.path)}
                for node in nodes.values():
                    parent = nodes[node.above[-1]] if node.above else None
                    rows.append(
                        {
                            "host": host,
                            "page": page,
                            "path": node.path,
                            "above": list(node.above),
                            "protected": node.protected,
                            "beside": bool(articles) and node.path not in around,
                            "share": node.share / parent.times if parent else 1.0,
                            "styles": counted(node.styles),
                            "texts": counted(node.texts),
                        }
                    )
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return pages.select("host", "html").mapInArrow(read, _NODES)


def _entropy(total: Column, weighted: Column) -> Column:
    """Entropy in nats of counts with this sum and this sum of n ln n."""
    return F.log(total) - weighted / total


def _importance(rows: DataFrame) -> DataFrame:
    """(host, path, pages, protected, beside, importance): composite, for every node of the trees."""
    key = ["host", "path"]
    nodes = rows.groupBy(*key, "above").agg(
        F.count("*").alias("pages"),
        (exact_sum("share", _EXACT) / F.count("*")).alias("share"),
        F.max("protected").alias("protected"),
        F.min("beside").alias("beside"),
    )
    n_log_n = exact_sum(F.col("n") * F.log("n"), _EXACT)
    styles = (
        rows.select(*key, F.inline("styles"))
        .groupBy(*key, "value")
        .agg(F.sum("n").alias("n"))
        .groupBy(*key)
        .agg(F.count("*").alias("styles"), _entropy(F.sum("n"), n_log_n).alias("style_entropy"))
    )
    texts = (
        rows.select(*key, F.inline("texts"))
        .groupBy(*key, "value")
        .agg(F.sum("n").alias("total"), n_log_n.alias("weighted"))
        .groupBy(*key)
        .agg((exact_sum(_entropy(F.col("total"), F.col("weighted")), _EXACT) / F.count("*")).alias("text_entropy"))
    )
    base = F.log(F.greatest(F.col("pages"), F.lit(2)))
    alone = F.col("pages") == 1
    style = F.when(alone, 1.0).otherwise(F.least(F.lit(1.0), F.col("style_entropy") / base))
    text = F.when(alone, 1.0).otherwise(1.0 - F.least(F.lit(1.0), F.col("text_entropy") / base))
    damped = F.pow(F.lit(DAMPING), F.col("styles"))
    all_nodes = materialize(
        nodes.join(styles, key)
        .join(texts, key, "left")
        .select(
            *key, "above", "pages", "protected", "beside", "share", damped.alias("damped"), style.alias("style"),
            text.alias("text"),
        ),
        "style-tree",
    )
    return _composite(all_nodes)


def _weights(damped: pd.Series, shares: pd.Series, share: pd.Series) -> pd.Series:
    """How much a node counts in each of its ancestors: the product along the way."""

    def one(g, s, own):
        step = np.asarray(g) * np.append(np.asarray(s)[1:], own)
        return np.cumprod(step[::-1])[::-1].tolist() if len(step) else []

    return pd.Series([one(*x) for x in zip(damped, shares, share, strict=True)])


def _composite(nodes: DataFrame) -> DataFrame:
    """Unroll the recursion: a node's value reaches each ancestor with a product of weights."""
    key = ["host", "path"]
    weights = F.pandas_udf(_weights, "array<double>")
    own_text = F.coalesce("text", F.lit(0.0))
    # Text blocks are children too; their share is what the elements leave.
    elements = (
        nodes.where(F.size("above") > 0)
        .groupBy("host", F.element_at("above", -1).alias("path"))
        .agg(exact_sum("share", _EXACT).alias("elements"))
    )
    valued = nodes.join(elements, key, "left").withColumn(
        "value",
        (1 - F.col("damped")) * F.col("style")
        + F.col("damped")
        * F.greatest(F.lit(0.0), 1 - F.coalesce("elements", F.lit(0.0)))
        * own_text,
    )
    steps = valued.select(*key, F.posexplode("above").alias("depth", "upper"))
    upper = nodes.select("host", F.col("path").alias("upper"), F.col("damped").alias("g"), F.col("share").alias("s"))
    chains = (
        steps.join(upper, ["host", "upper"])
        .groupBy(*key)
        .agg(F.array_sort(F.collect_list(F.struct("depth", "upper", "g", "s"))).alias("chain"))
    )
    shared = (
        valued.join(chains, key)
        .withColumn("weights", weights(F.col("chain.g"), F.col("chain.s"), F.col("share")))
        .select("host", "value", F.explode(F.arrays_zip(F.col("chain.upper").alias("upper"), "weights")).alias("z"))
        .groupBy("host", F.col("z.upper").alias("path"))
        .agg(exact_sum(F.col("value") * F.col("z.weights"), _EXACT).alias("below"))
    )
    return valued.join(shared, key, "left").select(
        *key, "above", "pages", "protected", "beside",
        (F.col("value") + F.coalesce("below", F.lit(0.0))).alias("importance"),
    )


def site_style_tree(pages: DataFrame, url_column: str = "url", html_column: str = "html") -> DataFrame:
    """(host, path, above, pages, protected, beside, importance) of every node of every host's tree."""
    return _importance(_nodes_of(pages, url_column, html_column))


def _nodes_of(pages: DataFrame, url_column: str, html_column: str) -> DataFrame:
    small_batches(pages.sparkSession)
    return materialize(_style_nodes(_known(pages, url_column, html_column)), "style-nodes")


def _known(pages: DataFrame, url_column: str, html_column: str) -> DataFrame:
    """Pages with a host: the others have no site to compare with."""
    host, _ = host_and_path(F.col(url_column))
    html = F.col(html_column)
    return pages.select(host.alias("host"), html.alias("html")).where((F.col("host") != "") & html.isNotNull())


def noisy_paths(tree: DataFrame) -> DataFrame:
    """(host, path) of the branches to remove: those whose importance, shrunk towards 1, is low.

    The fewer pages a branch was seen on, the more its prior counts: one that never varies
    goes from 4 pages on, inside an article from 31 on, one that varies a little needs more.
    """
    shrunk = (F.col("importance") * F.col("pages") + PRIOR_PAGES) / (F.col("pages") + PRIOR_PAGES)
    low = (shrunk < THRESHOLD) & ~F.col("protected")
    lowest = shrunk < ARTICLE_THRESHOLD
    return tree.where((low | lowest) & (F.size("above") > 0)).select("host", "path")


def _removed(pages: DataFrame, url_column: str, html_column: str) -> DataFrame:
    """(host, path) of the branches to remove, where copies of a page are no template.

    Equal pages of a host count as one.  Only what lies beside an article on every page it
    occurs on goes by the number of rows too: markup has said that the text is elsewhere.
    """
    rows = _nodes_of(pages, url_column, html_column)
    # Equal pages have equal rows, so any of them will do.
    different = noisy_paths(_importance(rows.dropDuplicates(["host", "page", "path"])))
    beside = noisy_paths(_importance(rows).where("beside"))
    return different.unionByName(beside).distinct()


def _text_without(html: str | None, removed) -> str:
    """Blocks that are neither furniture nor on a removed path, joined by newlines."""
    if not html:
        return ""
    return "\n".join(t for path, furniture, t in parse(html).blocks if not furniture and path not in removed)


def extract_text(
    pages: DataFrame, url_column: str = "url", html_column: str = "html", out: str = "text",
    broadcast_paths: int = BROADCAST_PATHS,
) -> DataFrame:
    """``pages`` with the main text of the whole page in ``out``; empty if there is none.

    Null html gives empty text.  Pages without host are cleaned by their markup
    alone.  Equal pages of a host are evidence of one page and all get their text.  All columns
    stay; ``out`` replaces one of that name.
    """
    removed = materialize(_removed(pages, url_column, html_column), "noisy")
    host, _ = host_and_path(F.col(url_column))
    if removed.count() <= broadcast_paths:
        # Bounded by broadcast_paths short rows.
        by_host = {h: set(g) for h, g in removed.toPandas().groupby("host")["path"]}

        @F.pandas_udf("string")
        def clean(hosts: pd.Series, htmls: pd.Series) -> pd.Series:
            none = set()
            return pd.Series(
                [_text_without(x, by_host.get(h, none)) for h, x in zip(hosts, htmls, strict=True)], dtype=object
            )

        return pages.withColumn(out, clean(host, F.col(html_column)))

    @F.pandas_udf("array<bigint>")
    def paths(htmls: pd.Series) -> pd.Series:
        return htmls.map(lambda x: list({p for p, _, _ in parse(x or "").blocks}))

    @F.pandas_udf("string")
    def clean_row(htmls: pd.Series, lists: pd.Series) -> pd.Series:
        return pd.Series(
            [_text_without(x, set() if p is None else set(p)) for x, p in zip(htmls, lists, strict=True)],
            dtype=object,
        )

    key, found = "_page", "_found"
    while {key, found} & set(pages.columns):
        key, found = "_" + key, "_" + found
    # Equal pages of a host have equal paths, so they may share a key.
    keyed = pages.withColumn(key, F.xxhash64(F.col(url_column), F.col(html_column)))
    lists = (
        keyed.select(key, host.alias("host"), F.explode(paths(F.col(html_column))).alias("path"))
        .join(removed, ["host", "path"])
        .groupBy(key)
        .agg(F.collect_set("path").alias(found))
    )
    return (
        keyed.join(lists, key, "left")
        .withColumn(out, clean_row(F.col(html_column), F.col(found)))
        .select(*[c for c in pages.columns if c != out], out)
    )
