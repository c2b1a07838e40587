import re
from collections import Counter, defaultdict
from math import log

import pytest

from tallyspark.llm.html_extraction import extract_text, noisy_paths, site_style_tree
from tallyspark.llm.html_tree import parse

SCHEMA = "page_id long, url string, html string, host string, path long, _paths long"


def kept(html):
    return [t for _, furniture, t in parse(html).blocks if not furniture]


@pytest.mark.parametrize(
    "html, blocks",
    [
        ("", []),
        ("no markup &amp; more", ["no markup & more"]),
        ("<p>one<p>two<br>lines\n  here", ["one", "two lines here"]),
        ("<p><b>open <i>tags<p>next</b> one</p>", ["open tags", "next one"]),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e", ["a", "b", "c", "d", "e"]),
        ("<script>var t='</p><p>no';</script>yes<style>p{}</style>", ["yes"]),
        ("<SCRIPT>x</SCRIPT >a<!-- <p>no</p> -->b", ["ab"]),
        ("<script>never closed <p>text", []),
        ("a < b and <3 <a href=\"x>y\">link</a>", ["a < b and <3 link"]),
        ("<p title='never closed>text</p>after", ["text", "after"]),
        ("<head><title>T</title><meta x></head><body>B</body>", ["B"]),
        ("<nav>n</nav><div class=ad>a</div><main>m</main><footer>f</footer>", ["m"]),
        ("<div id='site-header'>h</div><article><header>title</header>x</article>", ["title", "x"]),
        ("<form>f</form><div role='navigation'>n</div><div class='userComments'>c</div>x", ["x"]),
        ("<article>x<span class='ad'>buy</span> y<div style='display:none'>z</div></article>", ["x", "y"]),
        ("<table><tr><td>1<td>2<tr><td>3</table>", ["1", "2", "3"]),
        ("&#x41;&#66; &lt;p&gt; &nbsp; &copy", ["AB <p> ©"]),
        ("</div></p>stray<div", ["stray"]),
    ],
)
def test_blocks(html, blocks):
    assert kept(html) == blocks


@pytest.mark.parametrize(
    "html, blocks",
    [
        ("<div class='widget-page'><nav>n</nav><article>text</article><div class=ad>a</div></div>", ["text"]),
        ("<div class='layout has-sidebar'><p>text</p></div><p>a longer text beside it", ["text", "a longer text beside it"]),
        ("<div class='with_comments no-widget'>x</div>yy", ["x", "yy"]),
        ("<div class='page widget'><p>most of the text</p></div><p>rest", ["most of the text", "rest"]),
        ("<p>a <span class='notice'>short</span> and <a class='related'>linked</a> word", ["a short and linked word"]),
        ("<article>so <math><mi>x</mi>=1</math> holds</article>", ["so x=1 holds"]),
        ("<article>long text</article><div class=comments><article>c</article></div>", ["long text"]),
        ("<aside><article>card</article></aside><div hidden><main>m</main></div>text", ["text"]),
    ],
)
def test_names_do_not_take_the_text(html, blocks):
    assert kept(html) == blocks


def test_depth_is_bounded_and_text_kept():
    page = parse("<div>" * 3000 + "deep" + "</div>" * 3000 + "<p>after")
    assert [t for *_, t in page.blocks] == ["deep", "after"]
    assert max(len(n.above) for n in page.nodes.values()) <= 64


def site(spark, pages=60):
    """Furniture without telling names, and an article without its tag."""
    rows = []
    for i in range(pages):
        links = "".join(f"<li>Section {j}</li>" for j in range(5))
        text = "".join(f"<p>Own sentence {i} {j} about nothing else.</p>" for j in range(1 + i % 4))
        html = (
            f"<body><div class=x1><ul>{links}</ul></div><div class=x2><h1>Story {i}</h1>{text}</div>"
            f"<div class=x3>All rights <b>reserved</b> by us</div></body>"
        )
        rows.append((i, "https://a.example.org/p", html, "clash", 1, 2))
    rows.append((900, "https://one.example.org/", "<div class=x3>Only page</div>", None, None, None))
    rows.append((901, None, "<div class=x3>No address</div><nav>x</nav>", None, None, None))
    rows.append((902, "https://a.example.org/q", None, None, None, None))
    rows.append((None, "https://a.example.org/q", "", None, None, None))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("limit", [500_000, 0])
def test_repeated_branches_go(spark, limit):
    pages = site(spark)
    got = extract_text(pages, broadcast_paths=limit)
    assert got.columns == [*pages.columns, "text"]
    texts = {r.page_id: r.text for r in got.collect()}
    assert len(texts) == 64
    for i in range(60):
        want = [f"Story {i}"] + [f"Own sentence {i} {j} about nothing else." for j in range(1 + i % 4)]
        assert texts[i] == "\n".join(want)
    assert (texts[900], texts[901], texts[902], texts[None]) == ("Only page", "No address", "", "")


def test_importance_of_the_tree(spark):
    tree = site_style_tree(site(spark)).where("host = 'a.example.org'").collect()
    assert all(0 <= r.importance <= 1.0001 for r in tree)
    low = noisy_paths(site_style_tree(site(spark))).where("host = 'a.example.org'").count()
    assert low >= 3


def test_hand_worked_importance(spark):
    # Two pages, one element with one layout; its text is the same on both.
    rows = [(i, "http://h.org/", "<div><p>same</p></div>", None, None, None) for i in range(2)]
    tree = site_style_tree(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(tree) == 3 and all(abs(r.importance) < 1e-9 for r in tree)
    # Different texts: p is 0.9 * 1, div 0.9 * that, the page 0.9 * that.
    rows = [(i, "http://h.org/", f"<div><p>{i}</p></div>", None, None, None) for i in range(2)]
    tree = site_style_tree(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(round(r.importance, 6) for r in tree) == [0.729, 0.81, 0.9]


def plain_tree(pages):
    """Importance by the recursion itself: {(host, path): importance}."""
    hosts = defaultdict(list)
    for url, html in pages:
        host = re.split(r"[/?#]", (url or "").partition("://")[2])[0].lower()
        if host and html is not None:
            hosts[host].append(parse(html).nodes)
    out = {}

    def entropy(counts):
        total = sum(counts)
        return -sum(n / total * log(n / total) for n in counts)

    for host, trees in hosts.items():
        seen = defaultdict(list)
        for tree in trees:
            for path, node in tree.items():
                seen[path].append((node, tree[node.above[-1]].times if node.above else 1))
        children = defaultdict(list)
        for path, rows in seen.items():
            if rows[0][0].above:
                children[rows[0][0].above[-1]].append(path)

        def share(path, seen=seen):
            return sum(node.share / times for node, times in seen[path]) / len(seen[path])

        def importance(path, seen=seen, children=children, share=share, host=host):
            nodes = [node for node, _ in seen[path]]
            base, alone = log(max(len(nodes), 2)), len(nodes) == 1
            styles = sum((node.styles for node in nodes), Counter())
            style = 1.0 if alone else min(1.0, entropy(styles.values()) / base)
            blocks = defaultdict(list)
            for node in nodes:
                for block, n in node.texts.items():
                    blocks[block].append(n)
            text = 1.0 if alone else 0.0
            if blocks:
                mean = sum(map(entropy, blocks.values())) / len(blocks)
                text = text if alone else 1.0 - min(1.0, mean / base)
            rest = max(0.0, 1.0 - sum(map(share, children[path])))
            below = sum(share(c) * importance(c) for c in children[path]) + rest * text
            g = 0.9 ** len(styles)
            out[host, path] = (1 - g) * style + g * below
            return out[host, path]

        for path, rows in list(seen.items()):
            if not rows[0][0].above:
                importance(path)
    return out


@pytest.mark.parametrize("given", [True, False])
def test_tree_equals_the_recursion(spark, given):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet") if given else site(spark)
    want = plain_tree([(r.url, r.html) for r in pages.collect()])
    got = {(r.host, r.path): r.importance for r in site_style_tree(pages).collect()}
    assert got.keys() == want.keys() and len(got) > 10
    assert max(abs(got[k] - want[k]) for k in want) < 1e-6


def test_few_pages_say_little(spark):
    counts, values = [1, 2, 3, 4, 5, 8, 16, 30, 31, 1000], [0.0, 0.01, 0.1, 0.2, 0.29, 0.31, 1.0]
    rows = [
        (f"{n} {v} {inside}", n, [0], n, inside, False, v) for n in counts for v in values for inside in (True, False)
    ]
    tree = spark.createDataFrame(
        rows, "host string, path long, above array<long>, pages long, protected boolean, beside boolean, importance double"
    )
    gone = {r.host for r in noisy_paths(tree).collect()}
    first = {
        (v, inside): next((n for n in counts if f"{n} {v} {inside}" in gone), None)
        for v in values
        for inside in (True, False)
    }
    assert first[0.0, False] == 4 and first[0.0, True] == 31 and first[0.2, False] == 16
    assert first[0.31, False] is None and first[0.1, True] is None and first[1.0, False] is None
    # What goes on some pages goes on more.
    for (v, inside), n in first.items():
        assert n is None or all(f"{m} {v} {inside}" in gone for m in counts if m >= n)


def test_articles_are_kept_where_pages_are_alike(spark):
    rows = [(i, "http://h.org/", "<article><p>same</p></article><div>foot</div>", None, None, None) for i in range(20)]
    texts = {r.text for r in extract_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert texts == {"same"}


@pytest.mark.parametrize("pages, html", [(4, "<div><p>same</p></div>"), (30, "<article><p>same</p></article>")])
def test_copies_are_no_template(spark, pages, html):
    rows = [(i, f"http://h.org/?v={i}", html, None, None, None) for i in range(pages)]
    got = extract_text(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert len(got) == pages and {r.text for r in got} == {"same"}


def test_empty_table(spark):
    assert extract_text(spark.createDataFrame([], SCHEMA)).count() == 0


def test_whole_table_equals_the_articles(spark):
    import html

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in extract_text(pages).collect():
        article = re.search(r"(?s)<article>(.*?)</article>", r.html)[1]
        blocks = re.split(r"</?(?:p|h1)>", article)
        clean = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in blocks]
        assert r.text == "\n".join(b for b in clean if b)
