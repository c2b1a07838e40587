import math

import pytest
from pyspark.sql import functions as F

from tallyspark.llm import url_filter as uf
from tallyspark.llm.queries import QUERIES, RULES

SF = "/root/testdata/sf0.01"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([i for i in map(rest.find, "/?#") if i >= 0] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    tail = rest[end:]
    stop = min([i for i in map(tail.find, "?#") if i >= 0] or [len(tail)])
    return host, tail[:stop]


def rule(host, path):
    fit = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: len(r.name), default=None)


URLS = [
    None, "", "no scheme/net/", "http://", "http://NET/", "http://a.Example.NET/en/x?y#z", "http://example.net/En/",
    "https://x.org/fr/", "https://org/fr", "http://example.com/de/1", "http://notexample.com/de/", "http://a.net",
    "http://a.net?x=/", "http://ÀB.net/é\n", "a://b://c.net/d", "http://user@h.net:80/p;q", "http://x" + "y" * 5000 + ".net/",
]


def test_hosts_paths_and_rules(spark):
    df = spark.createDataFrame([(i, u, 1.0) for i, u in enumerate(URLS)], "page_id long, url string, prediction double")
    got = {r.page_id: r for r in uf.verdicts(df, RULES, uf.UrlModel(None, None, 0.0)).collect()}
    assert len(got) == len(URLS)
    for i, url in enumerate(URLS):
        host, path = parts(url)
        want = rule(host, path)
        assert (got[i].host, got[i].path) == (host, path)
        assert got[i].rule == (want.name if want else None)
        assert got[i].verdict == (want.verdict if want else "allow")


def test_entropy(spark):
    row = spark.range(1).select(
        uf.entropy(F.lit("aabb")).alias("a"), uf.entropy(F.lit("")).alias("b"), uf.entropy(F.lit("abcdefgh")).alias("c")
    ).first()
    assert (row.a, row.b) == (1.0, 0.0) and math.isclose(row.c, 3.0)


@pytest.mark.parametrize("labels, verdict", [([], "allow"), ([0] * 5, "allow"), ([1] * 5, "block")])
def test_one_class_or_none(spark, labels, verdict):
    df = spark.createDataFrame([(f"http://h{i}.com/", x) for i, x in enumerate(labels)], "url string, label int")
    urls = spark.createDataFrame([(1, "http://x.com/")], "page_id long, url string")
    assert uf.verdicts(urls, RULES, uf.fit(df)).first().verdict == verdict


def test_trees_tell_urls_apart(spark):
    good = [(f"https://site{i}.com/news/{i}", 0) for i in range(150)]
    bad = [(f"http://x-{i * 7919}-q.info/a/b/c/d?u={i}&v={i * 31}&w=9", 1) for i in range(150)]
    model = uf.fit(spark.createDataFrame(good + bad + [(None, 1), ("http://z.com/", None)], "url string, label int"))
    held = [(1, "https://other.com/news/5"), (2, "http://x-55-q.info/a/b/c/d?u=5&v=1&w=9")]
    got = uf.verdicts(spark.createDataFrame(held, "page_id long, url string"), [], model).collect()
    assert {r.page_id: r.verdict for r in got} == {1: "allow", 2: "block"}


def test_whole_table_without_python(spark):
    df = QUERIES["op7_url_filter"](spark, SF)
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = df.collect()
    assert len(got) == len(pages)
    for r in got:
        host, path = parts(pages[r.page_id])
        want = rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, want.name if want else None)
        assert r.verdict == (want.verdict if want else ("block" if r.block_probability >= 0.5 else "allow"))


def test_empty_tables(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string, prediction double")
    model = uf.fit(spark.createDataFrame([], "url string, label int"))
    assert model.trees is None and uf.verdicts(none, RULES, model).count() == 0
    labelled = spark.createDataFrame([("http://a.net/", 1), ("http://b.org/", 0)] * 20, "url string, label int")
    assert uf.verdicts(none, RULES, uf.fit(labelled)).count() == 0


def test_suffix_rates_come_from_all_rows(spark, monkeypatch):
    """Also those of suffixes that no sampled URL has."""
    monkeypatch.setattr(uf, "MAX_TRAINING", 40)
    rows_ = [(f"http://h{i}.{'bad' if i % 3 == 0 else 'good' if i % 3 == 1 else f's{i}'}/", int(i % 3 == 0)) for i in range(900)]
    model = uf.fit(spark.createDataFrame(rows_, "url string, label int"))
    got = {r[0]: r[1] for r in model.suffixes.collect()}
    rate = 300 / 900
    for suffix in {u.rsplit(".", 1)[1][:-1] for u, _ in rows_}:
        of = [label for u, label in rows_ if u.endswith(f".{suffix}/")]
        assert abs(got[suffix] - (sum(of) + uf.SUFFIX_WEIGHT * rate) / (len(of) + uf.SUFFIX_WEIGHT)) < 1e-9
    assert len(got) == 302
