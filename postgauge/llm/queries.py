"""The queries of this folder, with SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postgauge.llm import decontaminate, importance, licenses, near_dup, nearest, packing, secret_scan, source_audit
from postgauge.llm import span_dedup, token_counts, token_files, toxicity, url_filter
from postgauge.llm.tables import fresh_path, read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TOKENIZER = "word_bpe_49k.json"


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


@query
def op1_url_reputation(spark, folder):
    """A page's outcome is the quality label of the document whose number its path ends with."""
    pages = read(spark, folder, "pages").select("page_id", "url")
    number = F.regexp_extract(url_filter.path("url"), r"/([0-9]{1,18})[^/0-9]*/?$", 1)
    shown = pages.select("page_id", number.try_cast("bigint").alias("doc_id"))
    outcomes = shown.join(read(spark, folder, "labels").select("doc_id", "quality"), "doc_id").select("page_id", "quality")
    return url_filter.judge_urls(pages, outcomes)


@query
def op2_near_duplicates(spark, folder):
    return near_dup.near_duplicates(read(spark, folder, "documents"), percent=85)


@query
def op3_token_files(spark, folder):
    path = fresh_path(spark, "token_files")
    tokenizer = public_tokenizers.path(TOKENIZER)
    token_files.write_token_files(read(spark, folder, "documents"), path, tokenizer, end_id=2)
    return token_files.read_token_files(spark, path, lambda ids: (token_files.crc32(ids),), "ids_crc32 bigint")


@query
def op4_nearest_vectors(spark, folder):
    return nearest.nearest(read(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op5_pack_documents(spark, folder):
    tokenizer = public_tokenizers.path(TOKENIZER)
    return packing.pack_documents(read(spark, folder, "documents"), 2048, tokenizer, end_id=0)


@query
def op6_repeated_sentences(spark, folder):
    done = span_dedup.remove_repeated(read(spark, folder, "documents"))
    return done.select("doc_id", "text", "n_removed")


@query
def op7_toxicity(spark, folder):
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    model = toxicity.fit(docs, labels, ~toxicity.held_out(F.col("doc_id")))
    scored = toxicity.score(docs, model, carry=["doc_id"])
    doc_id = F.col("row.doc_id")
    return scored.select(
        doc_id, toxicity.held_out(doc_id).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query
def op8_secrets(spark, folder):
    found = secret_scan.scan_secrets(read(spark, folder, "documents").select("doc_id", "text"))
    base = F.col("secrets.base")

    def count(kind: str):
        return F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    digest = F.sha2(secret_scan.listed(base), 256).alias("base_sha256")
    return found.select(
        "doc_id", *map(count, ("assign", "access", "hex")), digest, secret_scan.listed(F.col("secrets.spans")).alias("spans")
    )


@query
def op9_benchmark_contamination(spark, folder):
    docs, benchmark = read(spark, folder, "documents"), read(spark, folder, "benchmark")
    found = decontaminate.find_contamination(docs, benchmark, width=10, carry=["doc_id"])
    return found.select(
        "row.doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op10_licenses(spark, folder):
    """Documents as files: a directory for each source, in it one for each language."""
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    return licenses.scan_licenses(read(spark, folder, "documents"), path)


@query
def op11_source_divergence(spark, folder):
    return source_audit.audit_sources(read(spark, folder, "documents"))


@query
def op12_target_resampling(spark, folder):
    docs, benchmark = read(spark, folder, "documents"), read(spark, folder, "benchmark")
    drawn = importance.resample(docs, benchmark, carry=["doc_id"])
    return drawn.select("row.doc_id", "n_features", "weight", "score", "rank")


@query
def op13_token_counts(spark, folder):
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    counted = token_counts.count_tokens(read(spark, folder, "documents"), tokenizer, carry=["doc_id"])
    return counted.select("row.doc_id", "n_bytes", "n_tokens", "over_limit")


_RULES_SQL = ", ".join(f"('{r.text}', '{r.host}', '{r.path}', '{r.verdict}')" for r in url_filter.RULES)
_TWO_SQL = ", ".join(f"'{s}'" for s in url_filter.TWO_PART_SUFFIXES)


_STRENGTH_SQL = "case when w > 0 and b / w > 0 then least(greatest(m * (1 - m) / (b / w) - 1, 1.0), 1000.0) else 1000.0 end"


def _shrink_sql(name: str, parent: str, child: str, upper: str, prior: str) -> str:
    """Posteriors of the rows of `child` under the priors in `upper`, by `parent`."""
    return f"""
    {name}_s as (select {parent}, k, g / t as m, t, t - nn / t as w, gg - g * g / t - g / t * (1 - g / t) * (k - 1) as b from (
        select {parent}, sum(good) as g, sum(n)::double as t, count(*) as k, sum(good * good / n) as gg, sum(n::double * n) as nn
        from {child} group by 1)),
    {name} as (select c.*, c.good + s.v * u.{prior} as a, c.n + s.v - (c.good + s.v * u.{prior}) as b from {child} c
        join {upper} u using ({parent})
        join (select {parent}, {_STRENGTH_SQL} as v from {name}_s) s using ({parent}))"""


def _further_sql(name: str, parent: str, posteriors: str, children: str) -> str:
    """What the posteriors of parents predict for a child without outcomes; `children` are the shrunk ones."""
    return f"""
    {name} as (select {parent}, p.a * v / (p.a + p.b + v + 1) as a, p.b * v / (p.a + p.b + v + 1) as b from {posteriors} p
        join (select {parent}, case when k > 1 then {_STRENGTH_SQL} else 1.0 end as v from {children}_s) using ({parent}))"""


ORACLES["op1_url_reputation"] = f"""
with p as (select page_id, coalesce(url, '') as url from pages),
h as (select page_id, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path from p),
rules(text, under, begins, verdict) as (values {_RULES_SQL}),
fits as (select page_id, arg_max(text, length(text)) as rule, arg_max(verdict, length(text)) as verdict from h, rules
    where (host = under or ends_with(host, '.' || under)) and starts_with(path, begins) group by 1),
counted as (select host, count(*) as n, sum(quality)::double as good from h
    join labels l on l.doc_id = try_cast(regexp_extract(path, '/([0-9]{{1,18}})[^/0-9]*/?$', 1) as bigint)
    where host <> '' and quality is not null group by 1),
every as (select host, n, good from (select distinct host from h where host <> '') left join counted using (host)),
split as (select *, string_split(host, '.') as x from every),
tailed as (select *, case when array_to_string(x[-2:], '.') in ({_TWO_SQL}) then array_to_string(x[-2:], '.') else x[-1] end as suffix
    from split),
named as (select host, n, good, suffix, array_to_string(x[-(len(string_split(suffix, '.')) + 1):], '.') as domain from tailed),
hosts as (select * from named where n is not null),
domains as (select domain, suffix, sum(n) as n, sum(good) as good from hosts group by 1, 2),
suffixes as (select suffix, '' as root, sum(n) as n, sum(good) as good from domains group by 1),
whole as (select '' as root, (sum(good) + 1) / (sum(n) + 2) as prior from suffixes),
{_shrink_sql("by_suffix", "root", "suffixes", "whole", "prior")},
suffix_rate as (select suffix, a / (a + b) as prior from by_suffix),
{_shrink_sql("by_domain", "suffix", "domains", "suffix_rate", "prior")},
domain_rate as (select domain, a / (a + b) as prior from by_domain),
{_shrink_sql("by_host", "domain", "hosts", "domain_rate", "prior")},
{_further_sql("near", "domain", "by_domain", "by_host")},
{_further_sql("far", "suffix", "by_suffix", "by_domain")},
judged as (select host, a, b from by_host union all
    select host, coalesce(near.a, far.a), coalesce(near.b, far.b) from named left join near using (domain) left join far using (suffix)
    where n is null and not regexp_matches(host, '^[0-9.]+(:[0-9]*)?$')),
bad as (select host from judged
    where a / (a + b) + 1.96 * sqrt(a / (a + b) * (1 - a / (a + b)) / (a + b + 1)) < 0.8)
select h.page_id, h.host, h.path, f.rule,
    coalesce(f.verdict, case when h.host in (select host from bad) then 'block' else 'allow' end) as verdict
from h left join fits f using (page_id)
"""

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLES["op11_source_divergence"] = f"""
with d as (select coalesce(lang, '') as lang, coalesce(source, '') as source, row_number() over () as row,
        translate(coalesce(text, ''), {_LOWER}) as text from documents),
w as (select lang, source, row, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term from d),
kept as (select lang, term, count(*) as n from w group by 1, 2 having count(distinct row) >= 10),
had as (select lang, source, term, count(*) as n from w semi join kept using (lang, term) group by 1, 2, 3),
langs as (select lang, count(*) as v, sum(n) as total from kept group by 1),
groups as (select g.lang, g.source, coalesce(sum(h.n), 0) as total
    from (select distinct lang, source from d) g left join had h using (lang, source) group by 1, 2),
dense as (select g.lang, g.source, k.term, coalesce(h.n, 0) as n,
        1 + (1000000000::hugeint * (coalesce(h.n, 0) + 2)) // (g.total + 2 * l.v)::hugeint as p,
        1 + (1000000000::hugeint * (k.n + 2)) // (l.total + 2 * l.v)::hugeint as q
    from groups g join langs l using (lang) join kept k using (lang)
    left join had h on h.lang = g.lang and h.source = g.source and h.term = k.term),
sums as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
    from dense a join dense b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by 1, 2, 3),
every as (select lang, source, 'pair' as part, item, coalesce(value, 0) as value
    from (select a.lang, a.source, b.source as item from groups a join groups b on a.lang = b.lang and a.source <> b.source)
    left join sums using (lang, source, item)
    union all
    select lang, source, 'term', term, (p - q) * (p - q) // (p + q) from dense where n > 0 and p > q),
placed as (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from every)
select lang, source, part, item, value::bigint as value, rank::int as rank from placed where part = 'pair' or rank <= 10
"""

# A checksum's table by its rule, and the sum of a text's bytes with it.
_CRC_SQL = """
bits as (select i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) as c
    from range(256) as t(i)),
codes as (select list(c order by i) as code from bits),
sums as (select feature, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(octet_length(encode(feature))),
        lambda k: ('0x' || substr(hex(encode(feature)), (2 * k + 1)::int, 2))::bigint)),
    lambda a, x: xor(a >> 8, code[(xor(a, x) & 255) + 1]))) % 10000 as bucket
    from (select distinct feature from (select feature from df union all select feature from tf)), codes)"""


def _features_sql(name: str, table: str) -> str:
    return f"""
{name}w as (select *, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words
    from (select *, row_number() over () as row from {table})),
{name}f as (select row, unnest(list_concat(words, list_transform(range(1, len(words)), lambda k: words[k] || ' ' || words[k + 1]))) as feature
    from {name}w)"""


ORACLES["op12_target_resampling"] = f"""
with {_features_sql("d", "documents")}, {_features_sql("t", "benchmark")}, {_CRC_SQL},
s as (select bucket, count(*) as n from df join sums using (feature) group by 1),
t as (select bucket, count(*) as n from tf join sums using (feature) group by 1),
gain as (select b as bucket, floor(1000 * ln((coalesce(t.n, 0)::double + 1) * ((select sum(n) from s)::double + 10000)
        / ((coalesce(s.n, 0)::double + 1) * ((select coalesce(sum(n), 0) from t)::double + 10000))))::bigint as gain
    from range(10000) as r(b) left join s on s.bucket = b left join t on t.bucket = b),
means as (select row, count(*) as n_features, floor(sum(gain)::double / count(*))::bigint as weight
    from df join sums using (feature) join gain using (bucket) group by 1),
scored as (select doc_id, len(words) as n_words, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint + 0.5::double)
            / 4294967296::double)))::bigint as score
    from dw left join means using (row)),
drawn as (select *, case when n_words >= 20 then row_number() over (partition by n_words >= 20 order by score desc, doc_id nulls last) end as place
    from scored)
select doc_id, n_features, weight, score,
    case when place <= 25 * (select count(*) from scored where n_words >= 20) // 100 then place end as rank from drawn
"""
