"""The corpus operators as queries on whole tables, and the SQL they must equal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import (
    decontamination,
    exact_dedup,
    html_extraction,
    language_id,
    mixing,
    prefix_trie,
    sharding,
    simhash,
    substring_dedup,
    suffix_dedup,
    toxicity,
    turn_repair,
    url_filter,
)
from tallyspark.llm.common import table

SHARDS = 24
QUERIES = {}
SQL = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extraction.extract_text(pages).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars")
    )


@query
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"), keep="largest")


SQL["op2_exact_dedup"] = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
from documents
window same as (partition by coalesce(text, ''))
"""


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages and documents: rows of pages have a page_id, rows of documents a doc_id."""
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    none = F.lit(None).cast("long")
    rows = (
        language_id.page_rows(pages)
        .withColumns({"page_id": F.col("id"), "doc_id": none})
        .unionByName(language_id.document_rows(docs).withColumns({"page_id": none, "doc_id": F.col("id")}))
        .drop("id")
    )
    found = language_id.identify(rows, language_id.fit_text(docs))
    return found.select("doc_id", "page_id", "host", "declared", "language", "confidence", "text_language")


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leak_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


SQL["op4_decontamination"] = r"""
with
d as (select doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
starts as (select item_id, w, least(len(w), 10) as m, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i
           from b where len(w) > 0),
pattern as (select distinct item_id, m, array_to_string(w[i:i + m - 1], ' ') as p from starts),
place as (select doc_id, w, m, unnest(range(1, len(w) - m + 2)) as i
          from d cross join (select distinct m from pattern) where len(w) >= m),
hit as (select doc_id, item_id, m, i from (select doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') as p from place)
        join pattern using (m, p)),
words as (select doc_id, count(distinct k) as n_hit
          from (select doc_id, unnest(range(i, i + m)) as k from hit) group by doc_id),
items as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as list
          from (select distinct doc_id, item_id::varchar as item from hit) group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(list, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (doc_id) left join items using (doc_id)
"""


@query
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_report(table(spark, sf_dir, "documents"))


@query
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The law ``rows``: shard sizes differ by one row at most."""
    return shard_digest(table(spark, sf_dir, "documents"))


def shard_digest(docs: DataFrame) -> DataFrame:
    rows = sharding.shard_rows(docs, SHARDS)
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_report(table(spark, sf_dir, "documents"))


# The given tables label no URLs, so hosts are labelled by these words.  They are
# not features: the trees see only the shape of a URL.
BLOCKED_HOST_WORDS = ["ads-", "adult", "bets", "casino", "pills", "spam"]
RULES = [
    url_filter.Rule("net", "/", "block"),
    url_filter.Rule("example.net", "/en/", "allow"),
    url_filter.Rule("example.com", "/de/", "block"),
    url_filter.Rule("org", "/fr/", "allow"),
]


def labelled_urls(pages: DataFrame) -> DataFrame:
    host, _ = url_filter.host_and_path(F.col("url"))
    listed = F.lit(False)
    for word in BLOCKED_HOST_WORDS:
        listed = listed | host.contains(word)
    return pages.select("url", listed.cast("int").alias("label")).where(host != "")


@query
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.verdicts(pages, RULES, url_filter.fit(labelled_urls(pages)))


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


# Shares of the tokens of each domain of the labels table.
DOMAIN_WEIGHTS = {"good": 0.90, "poor": 0.06, "toxic": 0.04}


def labelled_domains(labels: DataFrame) -> DataFrame:
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")
    return labels.select("doc_id", domain.alias("domain"))


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most one copy of a document, so rates lie between 0 and 1."""
    labels = labelled_domains(table(spark, sf_dir, "labels"))
    rates = mixing.mixing_rates(table(spark, sf_dir, "documents"), labels, DOMAIN_WEIGHTS)
    memberships = [F.col(f"memberships.{d}").alias(f"p_{d}") for d in sorted(DOMAIN_WEIGHTS)]
    return rates.select("doc_id", "n_tokens", *memberships, "rate", "copies")


def _crc32_sql(text: str) -> str:
    """The unsigned crc32 of an ASCII text in SQL."""
    return f"""xor(4294967295, list_reduce(list_transform(range(strlen({text})), lambda i: ord(substr({text}, i + 1, 1))),
        lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
            lambda x, z: if(x & 1 = 1, xor(x >> 1, 3988292384), x >> 1)), 4294967295))"""


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie_report(table(spark, sf_dir, "conversations"))


SQL["op11_prefix_trie"] = f"""
with
turns as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
        row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) as k
    from conversations where conv_id is not null),
convs as (select conv_id, conv_id::varchar as t, count(*) as n from turns group by conv_id),
plan as (select c.conv_id, {_crc32_sql("c.t")} % 6 as h, b.conv_id as base, coalesce(b.n, 0) as base_n
    from convs c left join convs b on b.conv_id = c.conv_id - c.conv_id % 100),
built as (
    select p.conv_id, k as d, role, text from plan p join turns t on t.conv_id = p.base where k <= h
    union all
    select p.conv_id, k - h + least(h, base_n), role, text from plan p join turns t using (conv_id) where k > h),
prefix as (
    select conv_id, d, length(text) as chars, string_agg(sha256(strlen(role) || ':' || role || text), '/') over
        (partition by conv_id order by d) as p from built
    union all select conv_id, 0, 0, '' from convs),
named as (select *, min(conv_id) over (partition by d, p) as node from prefix),
nodes as (select node, d, count(*) as n_convs, any_value(chars) as chars from named group by node, d),
linked as (select nodes.*, up.node as parent from nodes
    left join named up on up.conv_id = nodes.node and up.d = nodes.d - 1),
kids as (select parent as node, d - 1 as d, count(*) as n_children from linked where parent is not null group by all),
whole as (select linked.*, coalesce(n_children, 0) as n_children from linked left join kids using (node, d)),
sums as (select up.node, up.d, sum((whole.n_children = 0)::int)::bigint as n_leaves,
        sum((n_convs - 1) * whole.chars)::bigint as saved_tokens
    from whole join named up on up.conv_id = whole.node and up.d <= whole.d group by up.node, up.d),
ends as (select node, d, string_agg(conv_id::varchar, ',' order by conv_id) as ids
    from (select conv_id, max(d) as d from named group by conv_id) join named using (conv_id, d) group by node, d)
select node as conv_id, d::bigint as depth, parent as parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
       sha256(coalesce(ids, '')) as ends_sha256
from whole join sums using (node, d) left join ends using (node, d)
"""


@query
def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_report(table(spark, sf_dir, "documents"))


SQL["op12_substring_dedup"] = r"""
with
d as (select row_number() over () as r, doc_id, coalesce(doc_id, 9223372036854775807) as rank,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
starts as (select r, rank, w, unnest(range(1, len(w) - 48)) as i from d where len(w) >= 50),
keyed as (select r, rank, i, md5(array_to_string(w[i:i + 49], ' ')) as p from starts),
hit as (select r, i from (select r, i, rank, min(rank) over (partition by p) as least from keyed) where least < rank),
gone as (select distinct r, unnest(range(i, i + 50)) as k from hit),
words as (select r, unnest(w) as word, unnest(range(1, len(w) + 1)) as k from d),
kept as (select r, count(gone.k) as n_removed, string_agg(word, ' ' order by k) filter (gone.k is null) as text
         from words left join gone using (r, k) group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept.text, '')) as kept_sha256
from d left join kept using (r)
"""


@query
def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair_report(table(spark, sf_dir, "conversations"))


# The cheapest edits turn by turn instead of by spans: state 0 nothing yet, 1 after s,
# 2 after u, 3 after a.
SQL["op13_turn_repair"] = f"""
with recursive
plain as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
        coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as t from conversations),
coded as (select *, {_crc32_sql("t")} % 20 as code from plain),
damaged as (select conv_id, turn, if(code = 4, 'user', role) as role,
        case code when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
        unnest(if(code = 3, [1, 2], [1])) as copy
    from coded where code <> 0),
placed as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as k,
        rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as solid from damaged),
faults as (select *, substr(role, 1, 1) as i, case when solid = '' then 'blank'
            when row_number() over (partition by conv_id, role, text order by k) > 1 then 'duplicate'
            when right(solid, 1) not in ('.', '!', '?') then 'truncated' else '' end as fault,
        lag(substr(role, 1, 1)) over (partition by conv_id order by k) as i_before from placed),
counts as (select conv_id, count(*) as n,
        coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps,
        count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
        count(*) filter (fault = 'truncated') as truncated,
        count(*) filter (k > 1 and i_before || i not in ('su', 'ua', 'au')) as illegal
    from faults group by conv_id),
follows(st, i, nx) as (values (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
ahead(st, st1, ins, icost, iline) as (
    select st, st, '', 0, '' from range(4) t(st)
    union all select st, nx, 'I', 2, chr(10) || if(i = 'u', 'user:', 'assistant:') from follows where i <> 's'),
acts(st1, st2, edit, i) as (
    select st, st, 'D', '' from range(4) t(st)
    union all select st, nx, 'K', i from follows
    union all select st, nx, 'R', i from follows where i <> 's'),
way as (
    select conv_id, 0::bigint as k, 0::bigint as st, {{'cost': 0, 'audit': '', 'lines': ''}} as best from counts
    union all
    select w.conv_id, w.k + 1, a.st2::bigint, min({{
        'cost': w.best.cost + h.icost + case a.edit when 'D' then 3 when 'R' then 2 else 0 end
            + if(a.edit <> 'D' and f.fault = 'truncated', 1, 0),
        'audit': w.best.audit || h.ins || a.edit,
        'lines': w.best.lines || h.iline || case a.edit when 'D' then '' when 'K' then chr(10) || f.role || ':' || f.text
            else chr(10) || if(a.i = 'u', 'user:', 'assistant:') || f.text end}})
    from way w join faults f on f.conv_id is not distinct from w.conv_id and f.k = w.k + 1
    join ahead h on h.st = w.st join acts a on a.st1 = h.st1
    where a.edit = 'D' or (f.fault not in ('blank', 'duplicate') and (a.edit = 'R' or a.i = f.i))
    group by w.conv_id, w.k, a.st2),
done as (select w.conv_id, min({{'cost': w.best.cost + h.icost, 'audit': w.best.audit || h.ins,
        'lines': w.best.lines || h.iline}}) as best
    from way w join counts c on c.conv_id is not distinct from w.conv_id and c.n = w.k
    join ahead h on h.st = w.st where h.st1 in (0, 3) group by w.conv_id)
select e.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
       coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(best.cost, 0)::bigint as cost,
       coalesce(best.audit, '') as audit, sha256(coalesce(best.lines[2:], '')) as repaired_sha256
from (select distinct conv_id from conversations) e
left join counts c on c.conv_id is not distinct from e.conv_id
left join done d on d.conv_id is not distinct from e.conv_id
"""
