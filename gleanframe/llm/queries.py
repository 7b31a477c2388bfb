"""The registered queries of this subpackage, each with production parameters over whole tables, and
their SQL where it can express them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanframe.llm import (
    decontaminate, exact_dedup, html_text, language, merkle, near_dedup, pieces, quality, scoring, substrings,
    trie, url_filter, warc)
from gleanframe.llm.tables import stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


OP1_SQL = r"""
with d as (
  select doc_id, length(coalesce(text, '')) as points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256
  from documents),
r as (
  select *, first_value(doc_id) over (partition by text_sha256 order by points desc, doc_id) as keep_id,
         count(*) over (partition by text_sha256) as group_size
  from d)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from r
"""

def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), words=2, percent=80)


OP2_SQL = r"""
with recursive d as (
  select doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents),
s as (
  select doc_id, case when len(w) < 2 then w
           else list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) end as shingles
  from d),
n as (select doc_id, len(shingles) as n_shingles from s),
sh as (select doc_id, unnest(shingles) as shingle from s),
links as (
  select x.doc_id as a, y.doc_id as b
  from sh x join sh y on x.shingle = y.shingle and x.doc_id < y.doc_id
  join n nx on nx.doc_id = x.doc_id join n ny on ny.doc_id = y.doc_id
  group by x.doc_id, y.doc_id, nx.n_shingles, ny.n_shingles
  having 100 * count(*) >= 80 * (nx.n_shingles + ny.n_shingles - count(*))),
two_way as (select a, b from links union all select b, a from links),
reach(doc_id, other) as (
  select doc_id, doc_id from documents
  union select reach.doc_id, two_way.b from reach join two_way on reach.other = two_way.a)
select doc_id, n_shingles, min(other) as component_id, doc_id = min(other) as kept
from reach join n using (doc_id) group by doc_id, n_shingles
"""


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = stored(warc.write(warc.records(_table(spark, sf_dir, "pages"))), "archive")
    return warc.read(archive).drop("url")


OP3_SQL = r"""
with p as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as hex
  from pages),
f as (select *, min(page_id) over (partition by hex, payload_bytes) as first from p)
select page_id, payload_bytes,
       -- base32: five hex digits are four letters
       list_aggregate(list_transform(range(0, 40, 5), lambda g: list_aggregate(list_transform([15, 10, 5, 0],
         lambda b: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                          1 + ((('0x' || substr(hex, g + 1, 5))::int >> b) & 31)::int, 1)),
         'string_agg', '')), 'string_agg', '') as payload_digest,
       case when page_id = first then 'response' else 'revisit' end as record_type,
       case when page_id <> first then first end as refers_to, true as intact
from f
"""

def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return language.identify(docs, language.train(docs))


def piece_model() -> str:
    """The vocabulary file, named by the environment or else that of the installed package."""
    if path := os.environ.get("PIECE_MODEL"):
        return path
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encoded(docs: DataFrame) -> DataFrame:
    """Ids of every document, and whether they decode to its text."""
    found = pieces.encode(docs, piece_model(), checked="round_trip")
    return found.select("doc_id", "ids", F.size("ids").cast("bigint").alias("n_ids"), "round_trip")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(_table(spark, sf_dir, "documents"))


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return scoring.score(docs, scoring.train(docs))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


RULES = [url_filter.Rule("allow", "com", "/"), url_filter.Rule("block", "example.com", "/en/"),
         url_filter.Rule("allow", "www.example.com", "/en/"), url_filter.Rule("block", "net", "/es/"),
         url_filter.Rule("block", "net", "/fr/")]


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return url_filter.judge(pages, RULES, url_filter.alias_links(pages))


# The tables hold no canonical or redirect link, so the SQL follows none; the tests do.
OP9_SQL = r"""
with p as (
  select page_id,
         translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') as path
  from pages),
rules(verdict, rule_host, rule_path) as (values
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fits as (
  select page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) as rule,
         arg_max(verdict, length(rule_host || rule_path)) as verdict
  from p join rules on (host = rule_host or ends_with(host, '.' || rule_host))
                   and starts_with(path, rule_path)
  group by page_id)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from p left join fits using (page_id)
"""

def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.repeated_substrings(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("bigint").alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


OP10_SQL = """
with d as (
  select doc_id, hex(encode(coalesce(text, ''))) as h, octet_length(encode(coalesce(text, ''))) as n_bytes
  from documents),
-- texts are cut into stretches first, since each look into a long one walks it
cuts as (select doc_id, h, n_bytes, unnest(range(0, n_bytes - 49, 512)) as cut from d),
stretches as (
  select doc_id, cut, substr(h, 2 * cut + 1, 1122) as s, least(512, n_bytes - 49 - cut) as n from cuts),
places as (select doc_id, cut, s, unnest(range(0, n)) as q from stretches),
strings as (
  select doc_id, cut + q as p, min(doc_id) over (partition by md5_number(substr(s, 2 * q + 1, 100))) as first from places),
gone as (
  select doc_id, p, p > lag(p, 1, -99) over (partition by doc_id order by p) + 50 as opens
  from strings where first < doc_id),
runs as (select doc_id, p, sum(opens::int) over (partition by doc_id order by p) as run from gone),
spans as (select doc_id, run, min(p) as begin, max(p) + 50 as stop from runs group by doc_id, run),
pieces as (
  select doc_id, begin, stop, lag(stop, 1, 0) over (partition by doc_id order by begin) as open from spans),
kept as (
  select doc_id, sum(stop - begin) as n_removed, count(*) as n_spans, max(stop) as last,
         string_agg(substr(h, (2 * open + 1)::bigint, (2 * (begin - open))::bigint), '' order by begin) as head
  from pieces join d using (doc_id) group by doc_id)
select doc_id, n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0) as n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, (2 * coalesce(last, 0) + 1)::bigint))) as kept_sha256
from d left join kept using (doc_id)
"""

# CRC-32 of the decimal digits of a number, which this SQL has no function for.
_CRC = """xor(4294967295, list_reduce(list_transform(string_split(({})::varchar, ''), lambda x: ord(x)::bigint),
  lambda c, b: list_reduce(range(8), lambda v, i: xor(v >> 1, 3988292384 * (v & 1)), xor(c, b)), 4294967295))"""


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


OP11_SQL = r"""
with d as (
  select doc_id, coalesce(text, '') as text, list_filter(regexp_split_to_array(
           coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents),
t as (select doc_id, unnest(w) as word, unnest(range(len(w))) as p from d),
h as (
  select doc_id, p, word, ('0x' || substr(md5(word), 1, 8))::bigint as h,
         lead(('0x' || substr(md5(word), 1, 8))::bigint) over (partition by doc_id order by p) as h2,
         lead(word) over (partition by doc_id order by p) as w2,
         lead(word, 2) over (partition by doc_id order by p) as w3
  from t),
grams as (
  select doc_id, h % 65536 as bucket from h
  union all
  select doc_id, 65536 + (h * 1000003 + h2) % 4294967291 % 65536 from h where h2 is not null),
twice as (
  select doc_id, unnest([p, p + 1, p + 2]) as p
  from (select *, count(*) over (partition by doc_id, word, w2, w3) as n from h where w3 is not null)
  where n > 1),
repeats as (select doc_id, count(distinct p) as n from twice group by doc_id),
lines as (
  select doc_id, count(*) - count(distinct line) as n
  from (select doc_id, unnest(string_split(text, chr(10))) as line from d)
  where regexp_matches(line, '[^\x20\x09-\x0D]') group by doc_id),
base as (
  select doc_id, len(w) as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols,
         coalesce(lines.n, 0) as n_dup_lines, coalesce(repeats.n, 0) as n_repeat_words,
         len(w) < 50 or 100 * coalesce(repeats.n, 0) > 50 * len(w) as base_failed
  from d left join lines using (doc_id) left join repeats using (doc_id)),
per_id as (
  select doc_id, min(quality) > 0 and coalesce(max(toxic), 0) = 0 as trusted, max(quality) <= 0 as rejected,
         CRC % 2 = 0 as half
  from labels where doc_id is not null and quality is not null group by doc_id),
counts as (
  select bucket, count(*) as r, count(*) filter (trusted and half) as t
  from grams left join per_id using (doc_id) group by bucket),
weights as (
  select bucket, floor(ln((t + 20) / (r * (sum(t) over () / sum(r) over ()) + 20)) * 65536 + 0.5)::bigint as w
  from counts),
sums as (
  select doc_id, sum(w)::bigint as total, count(*) as n from grams join weights using (bucket) group by doc_id),
steps as (
  select floor(total / (n * 64.0))::bigint as step, count(*) filter (trusted) as t, count(*) filter (rejected) as r
  from sums join base using (doc_id) join per_id using (doc_id)
  where not base_failed and (rejected or trusted and not half) group by 1),
costs as (
  select step, lag(step) over (order by step) as before,
         10 * (sum(t) over (order by step) - t) * sum(r) over ()
           + (sum(r) over () - sum(r) over (order by step) + r) * sum(t) over () as cost
  from steps),
least as (select floor((step + coalesce(before, step) + 1) / 2.0) as least from costs order by cost, step limit 1)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       coalesce(total / n / 65536, 0) as score,
       not base_failed and coalesce(floor(total / (n * 64.0)) >= (select least from least), true) as kept
from base left join sums using (doc_id)
""".replace("CRC", _CRC.format("doc_id"))

def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(_table(spark, sf_dir, "documents"))


_FIELD = "coalesce(strlen({0}::varchar)::varchar || ':' || {0}::varchar, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "text")) + ")"

OP12_SQL = r"""
with recursive d as (
  select doc_id, source, LEAF as leaf, case when CRC % 2 = 0 then PLAIN else LEAF end as tampered from documents),
numbered as (
  select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as i,
         count(*) over (partition by source) as n
  from d),
-- each level holds the nodes of every source; a source that has come down to one stays as it is
levels as (
  select source, 0 as level, i, leaf as digest, n from numbered
  union all
  select source, level + 1, run, sha256(string_agg(digest, '' order by i)), (max(n) + 2) // 3
  from (select *, i // 3 as run from levels where n > 1) group by source, level, run),
subroots as (
  select source, digest as subroot, row_number() over (order by source nulls first) - 1 as i, count(*) over () as n
  from levels where n = 1),
tops as (
  select 0 as level, i, subroot as digest, n from subroots
  union all
  select level + 1, run, sha256(string_agg(digest, '' order by i)), (max(n) + 2) // 3
  from (select *, i // 3 as run from tops where n > 1) group by level, run),
walk as (
  select doc_id, source, leaf, i, 0 as level, '' as proof, tampered as node from numbered
  union all
  select w.doc_id, any_value(w.source), any_value(w.leaf), any_value(w.i) // 3, any_value(w.level) + 1,
         any_value(w.proof) || coalesce(string_agg(l.digest, '' order by l.i) filter (l.i <> w.i), ''),
         sha256(string_agg(case when l.i = w.i then w.node else l.digest end, '' order by l.i))
  from walk w join levels l on l.source is not distinct from w.source and l.level = w.level
    and l.i // 3 = w.i // 3 and l.n > 1
  group by w.doc_id),
below as (
  select doc_id, source, leaf, proof, node from walk
  qualify level = max(level) over (partition by doc_id)),
climb as (
  select doc_id, leaf, subroot, proof, node, s.i, 0 as level
  from below b join subroots s on b.source is not distinct from s.source
  union all
  select c.doc_id, any_value(c.leaf), any_value(c.subroot),
         any_value(c.proof) || coalesce(string_agg(t.digest, '' order by t.i) filter (t.i <> c.i), ''),
         sha256(string_agg(case when t.i = c.i then c.node else t.digest end, '' order by t.i)),
         any_value(c.i) // 3, any_value(c.level) + 1
  from climb c join tops t on t.level = c.level and t.i // 3 = c.i // 3 and t.n > 1
  group by c.doc_id),
last as (select * from climb qualify level = max(level) over (partition by doc_id))
select doc_id, leaf, subroot, digest as root, sha256(proof) as proof_sha256, node as folded_root,
       node = digest as verified
from last, tops where tops.n = 1
""".replace("LEAF", _LEAF).replace("PLAIN", _LEAF.replace("text::varchar", "replace(text, chr(10), '')")).replace(
    "CRC", _CRC.format("doc_id"))

def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(_table(spark, sf_dir, "conversations"))


OP13_SQL = r"""
with t as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first) - 1 as p
  from conversations where conv_id is not null),
turns as (
  select conv_id, p, sha256(strlen(role)::varchar || ':' || role || text) as id,
         len(list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')) as words
  from t),
convs as (select conv_id, conv_id - conv_id % 20 as base, CRC % 4 as h from (select distinct conv_id from t)),
seqs as (
  select c.conv_id, b.p, b.id, b.words from convs c join turns b on b.conv_id = c.base and b.p < c.h
  union all
  select c.conv_id, o.p, o.id, o.words from convs c join turns o on o.conv_id = c.conv_id and o.p >= c.h),
placed as (select *, row_number() over (partition by conv_id order by p) as depth from seqs),
members as (
  select conv_id, depth, words, string_agg(id, '') over (partition by conv_id order by depth) as key from placed
  union all
  select conv_id, 0, 0, '' from convs),
sizes as (select conv_id, max(depth) as size from members group by conv_id),
nodes as (
  select key, any_value(depth) as depth, min(m.conv_id) as conv_id, count(*) as n, any_value(words) as words,
         coalesce(string_agg(m.conv_id::varchar, ',' order by m.conv_id) filter (depth = size), '') as ends
  from members m join sizes using (conv_id) group by key),
children as (
  select substr(key, 1, length(key) - 64) as key, count(*) as n from nodes where depth > 0 group by 1),
marked as (
  select nodes.*, coalesce(children.n, 0) as n_children, (nodes.n - 1) * words as saved
  from nodes left join children using (key)),
under as (select substr(key, 1, 64 * unnest(range(depth + 1))) as key, saved, n_children from marked),
sums as (
  select key, count(*) filter (n_children = 0) as n_leaves, sum(saved)::bigint as saved_tokens from under group by key)
select m.conv_id, m.depth::bigint as depth, a.conv_id as parent_conv_id, m.n as n_convs, m.n_children, n_leaves,
       saved_tokens, sha256(m.ends) as ends_sha256
from marked m join sums using (key)
  left join marked a on m.depth > 0 and a.key = substr(m.key, 1, length(m.key) - 64)
""".replace("CRC", _CRC.format("conv_id"))

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_exact_dedup, op2_near_dedup, op3_warc, op4_language_id, op5_sentencepiece, op6_lm_score,
        op7_html_text,
        op8_decontaminate, op9_url_filter, op10_substring_dedup, op11_quality_rules,
        op12_merkle_manifest, op13_conversation_trie)}

ORACLES: dict[str, str] = {
    "op1_exact_dedup": OP1_SQL, "op2_near_dedup": OP2_SQL, "op3_warc": OP3_SQL,
    "op9_url_filter": OP9_SQL, "op10_substring_dedup": OP10_SQL, "op11_quality_rules": OP11_SQL,
    "op12_merkle_manifest": OP12_SQL, "op13_conversation_trie": OP13_SQL}
