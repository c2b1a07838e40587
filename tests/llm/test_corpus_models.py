"""Language, toxicity and mixing: held-out accuracy, laws and edge cases."""

import zlib

import numpy as np
import pytest
from edge import edge_docs, empty_docs, rows
from pyspark.sql import functions as F

from tallyspark.llm import language_id, mixing, toxicity
from tallyspark.llm.queries import DOMAIN_WEIGHTS, QUERIES, labelled_domains

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


# ------------------------------------------------------------ language


def test_language_of_held_out_documents(docs):
    model = language_id.fit_text(docs.where("doc_id % 2 = 0"))
    held = docs.where("doc_id % 2 = 1 and n_chars > 40")
    got = language_id.identify(language_id.document_rows(held), model).collect()
    lang = {r.doc_id: r.lang for r in held.collect()}
    assert len(got) == len(lang)
    assert np.mean([r.language == lang[r.id] for r in got]) > 0.97


def test_evidence_is_fused(spark, docs):
    model = language_id.fit_text(docs)
    page = lambda lang, text: f'<html lang="{lang}"><body><p>{text}</p></body></html>'
    long = {r.lang: r.text for r in docs.where("n_chars between 400 and 3000").orderBy("doc_id").collect()}
    sites = [(f"http://{x}.example.com/{i}", page(x, long[x])) for x in ("de", "en", "fr") for i in range(12)]
    odd = [
        ("http://de.example.com/a", page("de", "")),  # no text: markup and host decide
        ("http://de.example.com/b", "<p>12 345</p>"),  # nothing but the host
        ("http://fr.example.com/c", page("de", long["fr"])),  # the text outweighs the markup
        (None, None),
    ]
    pages = spark.createDataFrame(
        [(i, u, h, "clash", 0.5) for i, (u, h) in enumerate(sites + odd)],
        "page_id long, url string, html string, posterior string, evidence double",
    )
    got = {r.id: r for r in language_id.identify(language_id.page_rows(pages), model).collect()}
    assert len(got) == 40
    assert [got[i].language for i in (36, 37, 38)] == ["de", "de", "fr"]
    assert abs(sum(got[39].posterior) - 1) < 1e-9
    assert got[37].confidence < got[36].confidence


def test_language_edge_cases(spark, docs):
    model = language_id.fit_text(docs)
    got = language_id.identify(language_id.document_rows(edge_docs(spark)), model).collect()
    assert len(got) == len(rows()) and all(abs(sum(r.posterior) - 1) < 1e-9 for r in got)
    assert language_id.identify(language_id.document_rows(empty_docs(spark)), model).count() == 0
    none = language_id.fit_text(edge_docs(spark))
    got = language_id.identify(language_id.document_rows(edge_docs(spark)), none).collect()
    assert len(got) == len(rows()) and all(r.language is None for r in got)


def test_language_query_has_every_row(spark, docs):
    got = QUERIES["op3_language_id"](spark, "/root/testdata/sf0.001")
    counts = got.agg(F.count("doc_id"), F.count("page_id"), F.count("*")).first()
    whole = [spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").count() for t in ("documents", "pages")]
    assert list(counts) == [*whole, sum(whole)]


# ------------------------------------------------------------ toxicity


def test_toxicity_of_held_out_rows(spark, docs, labels):
    got = toxicity.toxicity_report(docs, labels).join(labels, "doc_id").collect()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [r for r in got if r.held_out]
    good, bad = [r.score for r in held if not r.toxic], [r.score for r in held if r.toxic]
    auc = np.mean([(b > g) + 0.5 * (b == g) for b in bad for g in good])
    assert auc > 0.9
    assert np.mean([s >= 0.7 for s in good]) < 0.05


def test_held_out_labels_do_not_matter(spark, docs, labels):
    flipped = labels.withColumn("toxic", F.when(~toxicity.usable_id("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit(docs, flipped) == toxicity.fit(docs, labels)


def test_non_negative_risk_finds_the_positives():
    # Feature 0 marks positives, feature 1 is noise; a fifth of the unlabelled are positives.
    rng = np.random.default_rng(0)
    noise = lambda: [1] if rng.random() < 0.5 else []
    positive = toxicity._Rows([[0, *noise()] for _ in range(200)], 2)
    unlabelled = toxicity._Rows([[*([0] if i % 5 == 0 else []), *noise()] for i in range(1000)], 2)
    weights, bias = toxicity.fit_nnpu(positive, unlabelled, prior=0.2)
    assert bias < bias + abs(weights[1]) < 0 < weights[0] + bias - abs(weights[1])
    # Trained as plain negatives the unlabelled positives would pull the margin down.
    _, plain = toxicity.fit_nnpu(positive, unlabelled, prior=0.001)
    assert plain < bias


def test_labels_beyond_the_caps_do_not_move_the_scores(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows_ = []
    for i in range(3000):
        toxic = int(i % 20 == 0)
        slur = "slurred" if rng.random() < (0.8 if toxic else 0.05) else "mild"
        rows_.append((i, f"{slur} word{rng.integers(0, 5)}", toxic))
    df = spark.createDataFrame(rows_, "doc_id long, text string, toxic int").cache()
    score = lambda: (m := toxicity.fit(df.drop("toxic"), df.drop("text"))).score(np.array([m.margin(b"slurred word1")]))
    all_labels = score()
    monkeypatch.setattr(toxicity, "MAX_LABELLED", 300)
    assert abs(score() - all_labels) < 0.15


def test_toxicity_edge_cases(spark, docs, labels):
    with_extra = labels.limit(5).selectExpr("doc_id", "toxic", "quality as text", "1 as unlabelled")
    report = toxicity.toxicity_report(edge_docs(spark), with_extra).collect()
    assert len(report) == len(rows()) and len({r.score for r in report}) == 1
    model = toxicity.fit(docs, labels)
    scored = edge_docs(spark).select("doc_id", toxicity.toxicity(model, F.coalesce("text", F.lit("")).cast("binary")).alias("s"))
    assert all(0 <= r.s <= 1 for r in scored.collect())
    assert toxicity.toxicity_report(empty_docs(spark), labels).count() == 0
    kept = toxicity.drop_toxic(edge_docs(spark), labels)
    assert kept.columns == edge_docs(spark).columns and kept.count() == len(rows())
    odd = spark.createDataFrame([(None, 1), (1, None), (1, 7)], "doc_id long, toxic int")
    assert toxicity.fit(edge_docs(spark), odd) == toxicity.Model()


# ------------------------------------------------------------ mixing


def test_token_totals_meet_the_targets(spark, docs, labels):
    got = QUERIES["op10_mixing"](spark, SF)
    assert "Python" not in got._jdf.queryExecution().toString()
    rates = got.toPandas()
    assert len(rates) == docs.count() and rates.rate.between(0, 1).all()
    assert np.allclose(rates[["p_good", "p_poor", "p_toxic"]].sum(axis=1), 1)
    total = (rates.rate * rates.n_tokens).sum()
    for domain, weight in DOMAIN_WEIGHTS.items():
        share = (rates.rate * rates.n_tokens * rates[f"p_{domain}"]).sum() / total
        assert abs(share - weight) < 0.01
    drawn = (rates.copies * rates.n_tokens).sum()
    assert abs(drawn / total - 1) < 0.05 and set(rates.copies) <= {0, 1}


def test_memberships_of_held_out_rows(docs, labels):
    domains = labelled_domains(labels)
    model = mixing.fit_domains(docs, domains.where("doc_id % 2 = 0"), ["good", "poor"])
    held = docs.join(domains.where("doc_id % 2 = 1 and domain <> 'toxic'"), "doc_id").select(
        F.col("text").alias("_m_text"), "domain"
    )
    got = model.memberships(held, "p").collect()
    assert np.mean([(r.p[0] > 0.5) == (r.domain == "good") for r in got]) > 0.85


@pytest.mark.parametrize("max_rate, weights", [(1.0, [0.5, 0.5]), (4.0, [0.2, 0.8]), (1.0, [1.0, 0.0])])
def test_rates_on_known_memberships(spark, max_rate, weights):
    rng = np.random.default_rng(1)
    rows_ = [(int(rng.integers(0, 400)), [float(p), float(1 - p)]) for p in rng.beta(0.4, 0.2, 500)]
    held = spark.createDataFrame(rows_, "_m_tokens long, _m_p array<double>")
    fit = mixing.fit_rates(held, weights, max_rate)
    rates = [r[0] for r in held.select(fit.rate).collect()]
    assert all(0 <= r <= max_rate for r in rates)
    totals = [sum(r * n * p[d] for r, (n, p) in zip(rates, rows_, strict=True)) for d in range(2)]
    assert np.allclose(totals, fit.totals)
    # Memberships are soft: hardly any text has nothing of the second domain.
    assert fit.off <= (mixing.TOLERANCE if min(weights) > 0 else 0.01)


def plain_least_squares(tokens, p, targets, max_rate, rounds=30_000):
    """The smallest misfit of any rates: coordinate by coordinate, without Spark."""
    worth = 1 / (tokens @ p)
    rate, miss = np.full(len(tokens), max_rate), max_rate * (tokens @ p) - targets
    for i in np.tile(np.arange(len(tokens)), rounds // len(tokens)):
        row = tokens[i] * p[i]
        if not tokens[i]:
            continue
        new = np.clip(rate[i] - (worth * miss) @ row / ((worth * row) @ row), 0, max_rate)
        miss += (new - rate[i]) * row
        rate[i] = new
    return (worth * miss**2).sum()


@pytest.mark.parametrize("share", [[0.5, 0.3, 0.2], [0.9, 0.06, 0.04], [0.99, 0.005, 0.005]])
def test_misfit_is_the_smallest(spark, share):
    """Against an independent bounded least squares, also where targets are out of reach."""
    rng = np.random.default_rng(4)
    p = rng.dirichlet([0.6, 0.3, 0.2], 400)
    tokens = rng.integers(0, 300, 400).astype(float)
    total = 0.5 * tokens.sum()
    held = spark.createDataFrame(
        [(int(n), q.tolist()) for n, q in zip(tokens, p, strict=True)], "_m_tokens long, _m_p array<double>"
    )
    fit = mixing.fit_rates(held, share, 1.0, total)
    worth = 1 / (tokens @ p)
    got = (worth * (np.array(fit.totals) - total * np.array(share)) ** 2).sum()
    least = plain_least_squares(tokens, p, total * np.array(share), 1.0)
    assert got <= least * 1.02 + 1e-6 * total


@pytest.mark.parametrize("weights", [
    {"good": 0.6, "zz": 0.1, "poor": 0.3}, {"aa": 0.1, "good": 0.6, "poor": 0.3}, {"good": 0.6, "oo": 0.1, "poor": 0.3},
])
def test_a_domain_without_labels_is_left_out(docs, labels, weights):
    """Alike at every place of the alphabet: the others share its tokens."""
    rates = mixing.mixing_rates(docs, labelled_domains(labels), weights).toPandas()
    odd = next(d for d in weights if d not in ("good", "poor"))
    of = lambda d: rates.memberships.map(lambda m: m[d])
    assert (of(odd) == 0).all()
    total = (rates.rate * rates.n_tokens).sum()
    assert abs((rates.rate * rates.n_tokens * of("good")).sum() / total - 2 / 3) < 1e-3
    assert rates.copies.sum() > 100


def test_one_labelled_domain_or_none(spark, docs, labels):
    only = mixing.mixing_rates(docs, labelled_domains(labels), {"good": 0.5, "other": 0.5}).toPandas()
    assert {(m["good"], m["other"]) for m in only.memberships} == {(1.0, 0.0)} and (only.copies == 1).all()
    none = mixing.mixing_rates(docs, labelled_domains(labels), {"x": 0.5, "y": 0.5}).toPandas()
    assert {(m["x"], m["y"]) for m in none.memberships} == {(0.5, 0.5)} and (none.copies == 1).all()


def test_unreachable_targets_keep_the_nearest_total(spark):
    # Every text has a tenth of the second domain: no total comes nearer than another.
    alike = spark.createDataFrame([(10, [0.9, 0.1])] * 100, "_m_tokens long, _m_p array<double>")
    most = 900 / 0.97
    assert sum(mixing.fit_rates(alike, [0.97, 0.03]).totals) > 0.98 * most
    # Here a smaller total has room to leave out the texts that spoil it.
    rows_ = [(10, [0.95, 0.05])] * 50 + [(10, [0.85, 0.15])] * 50
    held = spark.createDataFrame(rows_, "_m_tokens long, _m_p array<double>")
    fits = [mixing.fit_rates(held, [0.97, 0.03]), mixing.fit_rates(held, [0.97, 0.03], tokens=most)]
    off = [max(abs(a - b) for a, b in zip(f.totals, f.targets, strict=True)) / sum(f.targets) for f in fits]
    assert off[0] < off[1] - 0.01


def test_tokens(spark):
    df = spark.createDataFrame([("",), (" a  b\n\tc ",), ("one",), ("   ",)], "t string")
    assert [r[0] for r in df.select(mixing.count_tokens(F.col("t"))).collect()] == [0, 3, 1, 0]


def test_words_and_shapes_of_any_script(spark):
    texts = ["word\u2014word \u201cquoted\u201d", "\u4f60\u597d\u3002\u518d\u89c1", "one\u00a0two\u3000three", "\u0416\u00c9\u03a9 ab"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, _m_text string")
    got = mixing._features(df).withColumn("n", mixing.count_tokens(F.col("_m_text"))).orderBy("i").collect()
    assert [r._m_words for r in got] == [
        ["word", "word", "quoted"], ["\u4f60\u597d", "\u518d\u89c1"], ["one", "two", "three"], ["\u0436\u00e9\u03c9", "ab"]
    ]
    assert [r.n for r in got] == [2, 1, 3, 2]
    assert got[3]._m_capitals == 0.5 and got[2]._m_spaces == 2 / 13


def test_mixing_edge_cases(spark, docs, labels):
    few = spark.createDataFrame([(1, "good"), (6, "good"), (None, "poor"), (8, "other")], "doc_id long, domain string")
    got = mixing.mixing_rates(edge_docs(spark), few, {"good": 0.5, "poor": 0.5}).collect()
    assert len(got) == len(rows())
    mixed = mixing.mixed_documents(edge_docs(spark), few, {"good": 0.5, "poor": 0.5})
    assert mixed.columns == edge_docs(spark).columns and 0 < mixed.count() <= len(rows())
    assert mixing.mixing_rates(empty_docs(spark), few, {"good": 1.0, "poor": 1.0}).count() == 0
    doubled = mixing.mixed_documents(edge_docs(spark), few, {"good": 0.5, "poor": 0.5}, max_rate=3.0, tokens=1e6)
    assert doubled.count() > len(rows())


def test_every_label_is_a_language(spark):
    """More labels than are counted in one pass: each is found again."""
    rng = np.random.default_rng(8)
    words = {f"l{i:03d}": ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(6)] for i in range(150)}
    texts = [(k, " ".join(rng.choice(w, 40))) for k, w in words.items() for _ in range(2)]
    labelled = spark.createDataFrame(texts, "lang string, text string")
    model = language_id.fit_text(labelled)
    assert model.languages == sorted(words)
    docs = labelled.selectExpr("monotonically_increasing_id() as doc_id", "text", "lang", "cast(null as string) as source")
    got = language_id.identify(language_id.document_rows(docs), model)
    found = {r.id: r.text_language for r in got.collect()}
    assert found == {r.doc_id: r.lang for r in docs.collect()}
