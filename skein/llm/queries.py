"""Registered queries of the text operators over the given tables, and their oracle SQL.

Each query applies one operator with production parameters to its whole table and
derives the contract's columns from the operator's output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, chat_tree, decontaminate, html_text, lexical_search, pii, prefix_trie, quality_rules, simhash, suffix_tree, token_files,
               toxicity, url_filter)
from .common import in_training, text_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_table(table(spark, sf_dir, "documents"))


def word_bpe() -> str:
    """Path of the public tokenizer file the contracts name."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def byte_bpe() -> tuple[str, str]:
    """Path and word pattern of a public vocabulary that keeps every byte of a text."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@register
def op1_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score(documents(spark, sf_dir))


@register
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(documents(spark, sf_dir))


@register
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit(toxicity.training_sample(docs, table(spark, sf_dir, "labels")))
    held_out = ~F.coalesce(in_training("doc_id", toxicity.MODULUS), F.lit(True))
    return toxicity.score(docs.withColumn("held_out", held_out), model)


@register
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(documents(spark, sf_dir), drop_text=True)


@register
def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


@register
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", simhash.hex_print("fp").alias("fingerprint"), "component_id")


@register
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(documents(spark, sf_dir), word_bpe())


@register
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return decontaminate.digest(found)


ORACLE["op8_decontamination"] = r"""with iw as (select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark where text is not null),
win as (select distinct item_id, w[i:i + 9] as p from (
  select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from iw where len(w) > 0)),
dw as (select row_number() over () as rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
pos as (select rid, l, i, w[i:i + l - 1] as p from (
  select rid, w, l, unnest(range(1, len(w) - l + 2)) as i from dw, (select distinct len(p) as l from win))),
hit as (select pos.rid, pos.i, pos.l, win.item_id from pos join win on pos.p = win.p),
cov as (select rid, count(distinct x) as n from (select rid, unnest(range(i, i + l)) as x from hit) group by rid),
its as (select rid, count(item_id) as n, string_agg(item_id, ',' order by item_id) as s from (
  select distinct rid, cast(item_id as varchar) as item_id from hit) group by rid)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(cov.n, 0) as n_hit, coalesce(its.n, 0) as n_items,
  sha256(coalesce(its.s, '')) as items_sha256, coalesce(cov.n, 0) > 0 as contaminated
from dw left join cov using (rid) left join its using (rid)
"""


URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


@register
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "rule_host string, rule_path string, rule_verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


@register
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(documents(spark, sf_dir), word_bpe())


_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
ORACLE["op9_url_filter"] = f"""
with rules(rh, rp, rv) as (values {_RULE_ROWS}),
addr as (select page_id, row_number() over () as rid, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
cut as (select page_id, rid, regexp_extract(rest, '^[^/?#]*') as raw_host, rest from addr),
parts as (select page_id, rid, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') as path from cut),
fits as (select p.page_id, p.rid, p.host, p.path, r.rh || r.rp as rule, r.rv,
    row_number() over (partition by p.rid order by length(r.rh || r.rp) desc, length(r.rh) desc) as rn
  from parts p left join rules r on (p.host = r.rh or ends_with(p.host, '.' || r.rh)) and starts_with(p.path, r.rp))
select page_id, host, path, rule, coalesce(rv, 'allow') as verdict from fits where rn = 1
"""


@register
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


ORACLE["op11_lexical_search"] = r"""with it as (select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
dw as (select row_number() over () as rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
tot as (select count(*) as n_all, cast(sum(len(w)) as bigint) as l_all from dw where len(w) > 0),
m as (select rid, doc_id, 10 + (90 * len(w) * n_all) // l_all as m from dw, tot where len(w) > 0),
tf as (select rid, term, count(*) as tf from (select rid, unnest(w) as term from dw) where term in (select term from it) group by rid, term),
wt as (select term, cast(floor(1000 * ln((2 * n_all + 2)::double / (2 * df + 1)::double)) as bigint) as wt
  from (select term, count(*) as df from tf group by term), tot),
sc as (select it.item_id, m.rid, m.doc_id, cast(sum(wt * ((1000000000 * tf) // (1000 * tf + 8 * m))) as bigint) as score
  from it join tf using (term) join wt using (term) join m using (rid) group by it.item_id, m.rid, m.doc_id),
rk as (select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id nulls last) as int) as rank, doc_id, score
  from sc where score > 0)
select * from rk where rank <= 10
"""


#: Conversation -7 of the contract: a user and an assistant that both say control strings.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


@register
def op12_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame([(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)], given.schema)
    packs = chat_tree.format_conversations(given.unionByName(planted), *byte_bpe())
    return chat_tree.read_back(packs, *byte_bpe())


ORACLE["op12_chat_tree"] = r"""with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
e as (select *, case when role = 'assistant' then 4 else 16 + length(regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'),
      '([<\[])(\\*)(/?(s>|INST\]))', '\1\\\2\3', 'g')) end
    + length(regexp_replace(text, '([<\[])(\\*)(/?(s>|INST\]))', '\1\\\2\3', 'g')) as chars from t)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(sum(chars) as bigint) as formatted_chars from e group by conv_id
"""


@register
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


ORACLE["op13_prefix_trie"] = r"""with t as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
  row_number() over (partition by conv_id order by turn nulls first, md5(concat(length(coalesce(role, '')), ':', role, text))) as p from conversations where conv_id is not null),
c as (select conv_id, conv_id - conv_id % 20 as donor, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 4 as h from (select distinct conv_id from t)),
r as (select c.conv_id, t.p, t.role, t.text from c join t on t.conv_id = c.donor and t.p <= c.h
  union all select c.conv_id, t.p + 1000000000, t.role, t.text from c join t on t.conv_id = c.conv_id and t.p > c.h),
l as (select conv_id, list(concat(length(role), ':', role, text) order by p) as path, list(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) order by p) as w from r group by conv_id),
a as (select c.conv_id, coalesce(path, []) as path, coalesce(w, []) as w from c left join l using (conv_id)),
e as (select conv_id, d, path[1:d] as node, w[d] as word, d = len(path) as ends from (select *, unnest(range(0, len(path) + 1)) as d from a)),
n as (select node, d as depth, min(conv_id) as conv_id, count(*) as n_convs, coalesce(any_value(word), 0) as word,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where ends), '')) as ends_sha256 from e group by node, d),
k as (select node[1:depth - 1] as node, count(*) as n from n where depth > 0 group by 1),
f as (select n.*, coalesce(k.n, 0) as n_children from n left join k using (node)),
s as (select node[1:x] as top, sum((n_convs - 1) * word) as saved, count(*) filter (where n_children = 0) as leaves
  from (select *, unnest(range(0, depth + 1)) as x from f) group by 1)
select f.conv_id, f.depth, p.conv_id as parent_conv_id, f.n_convs, f.n_children, s.leaves as n_leaves, cast(s.saved as bigint) as saved_tokens, f.ends_sha256
from f join s on s.top = f.node left join f p on f.depth > 0 and p.node = f.node[1:f.depth - 1]
"""
