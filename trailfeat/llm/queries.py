"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table


def op1_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import shard_documents

    return shard_documents(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import quality_rules as Q

    docs = table(spark, sf_dir, "documents")
    found = Q.judged(docs, Q.learn_from_labels(docs, table(spark, sf_dir, "labels")), keep=["doc_id"])
    return found.select("row.doc_id", *Q.COUNTS, "base_failed", "rule", "kept")


#: The rules of the query; any table of this form can be passed to the operator.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filters import filter_urls

    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return filter_urls(table(spark, sf_dir, "pages"), rules)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import find_pii

    return find_pii(table(spark, sf_dir, "documents"))


def op7_secret_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import find_secrets

    return find_secrets(table(spark, sf_dir, "documents"))


def op8_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontamination import find_leaks

    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm_scoring import cross_entropy_difference

    return cross_entropy_difference(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=1)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import vocabulary_size
    from .token_ids import token_file_rows

    path = tokenizer_path("word_bpe_49k.json")
    return token_file_rows(table(spark, sf_dir, "documents"), path, vocabulary_size(path), end_id=2)


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substrings import deduplicated

    return deduplicated(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .merkle import verified_documents

    return verified_documents(table(spark, sf_dir, "documents")).drop("source")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .prefix_trie import prefix_trie, rebuilt, turns_of

    return prefix_trie(rebuilt(turns_of(table(spark, sf_dir, "conversations"))))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_feistel_shards, op2_quality_rules, op3_url_filters, op4_simhash, op5_pii_crf, op6_best_fit_packing,
        op7_secret_crf, op8_benchmark_leaks, op9_cross_entropy, op10_token_files, op11_substring_dedup,
        op12_merkle_manifest, op13_prefix_trie)}


_URL_PARTS = r"""
  select page_id,
         coalesce(lower(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1)), '') as host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') as path
  from pages
"""

OP3_SQL = rf"""
with rules(rhost, rpath, rverdict) as (values {', '.join(str(r) for r in URL_RULES)}),
located as (select row_number() over () as id, * from ({_URL_PARTS})),
hits as (
  select id, rhost || rpath as rule, rverdict,
         row_number() over (partition by id order by length(rhost || rpath) desc, length(rhost) desc, rverdict desc) as nr
  from located join rules
    on (host = rhost or host like '%.' || rhost) and starts_with(path, rpath)
)
select page_id, host, path, rule, coalesce(rverdict, 'allow') as verdict
from located left join (select * from hits where nr = 1) using (id)
"""

OP11_SQL = r"""
with split as (
  select row_number() over () as nr, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
),
windows as (
  select nr, doc_id, p, array_to_string(list_slice(words, p, p + 12), ' ') as seq
  from (select *, unnest(range(1, len(words) - 11)) as p from split)
),
firsts as (select seq, min(doc_id) as least from windows group by seq),
gone as (
  select distinct nr, w from (select nr, unnest(range(p, p + 13)) as w from windows join firsts using (seq) where least < doc_id)
),
placed as (select nr, words[w] as word, w from (select nr, words, unnest(range(1, len(words) + 1)) as w from split)),
kept as (select nr, count(*) as n, string_agg(word, ' ' order by w) as rest from placed anti join gone using (nr, w) group by nr)
select doc_id, len(words) as n_words, len(words) - coalesce(n, 0) as n_removed, sha256(coalesce(rest, '')) as kept_sha256
from split left join kept using (nr)
"""

OP12_SQL = """
with recursive fields as (
  select doc_id, source, lang, n_chars, text,
         list_reduce([ascii(c) for c in string_split(doc_id::varchar, '')],
           lambda crc, b: list_reduce([x::bigint for x in range(8)], lambda a, x: xor(a >> 1, 3988292384 * (a & 1)), xor(crc, b)),
           4294967295) as crc
  from documents
),
texts as (
  select *, case when xor(crc, 4294967295) % 2 = 0 then replace(text, chr(10), '') else text end as changed from fields
),
leaves as (
  select doc_id, source,
         sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
         sha256(head || coalesce(strlen(changed) || ':' || changed, '-')) as given
  from (select *, coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                  || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') as head
        from texts)
),
placed as (
  select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as i,
         dense_rank() over (order by source nulls first) - 1 as t
  from leaves
),
tree(lvl, t, i, d, n) as (
  select 0, t, i, leaf, count(*) over (partition by t) from placed
  union all
  select lvl + 1, t, i // 3, sha256(string_agg(d, '' order by i)), (any_value(n) + 2) // 3
  from tree where n > 1 group by lvl, t, i // 3
),
subroots as (select t, lvl as k, d as subroot from tree where n = 1),
top(lvl, t, i, d, n) as (
  select 0, 0, t, subroot, count(*) over () from subroots
  union all
  select lvl + 1, 0, i // 3, sha256(string_agg(d, '' order by i)), (any_value(n) + 2) // 3
  from top where n > 1 group by lvl, i // 3
),
nodes as (
  select lvl, t, i, d from tree where n > 1
  union all
  select s.k + top.lvl, s.t, top.i, top.d from top join subroots s on true where top.n > 1
),
spots as (
  select p.t, p.i as leaf_i, lvl, case when lvl < s.k then (p.i // (3 ** lvl)::bigint) else p.t // (3 ** (lvl - s.k))::bigint end as own
  from placed p join subroots s using (t) join (select distinct t, lvl from nodes) using (t)
),
rungs as (
  select sp.t, sp.leaf_i, sp.lvl, string_agg(d, '' order by n.i) filter (n.i < own) as a,
         string_agg(d, '' order by n.i) filter (n.i > own) as b
  from spots sp join nodes n on n.t = sp.t and n.lvl = sp.lvl and n.i // 3 = own // 3 group by all
),
paths as (
  select t, leaf_i, list({'a': coalesce(a, ''), 'd': '', 'b': coalesce(b, '')} order by lvl) as path from rungs group by all
),
proofs as (
  select p.*, s.subroot, (select d from top where n = 1) as root, coalesce(path, []) as path
  from placed p join subroots s using (t) left join paths q on q.t = p.t and q.leaf_i = p.i
)
select doc_id, leaf, subroot, root,
       sha256(list_reduce(path, lambda acc, r: acc || r.a || r.b, '')) as proof_sha256,
       list_reduce(path, lambda acc, r: sha256(r.a || acc || r.b), given) as folded_root,
       folded_root = root as verified
from proofs
"""

OP13_SQL = r"""
with crcs as (
  select distinct conv_id, xor(list_reduce([ascii(c) for c in string_split(conv_id::varchar, '')],
           lambda crc, b: list_reduce([x::bigint for x in range(8)], lambda a, x: xor(a >> 1, 3988292384 * (a & 1)), xor(crc, b)),
           4294967295), 4294967295) % 4 as h
  from conversations where conv_id is not null
),
own as (
  select conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')}
                       order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as turns
  from conversations where conv_id is not null group by conv_id
),
built as (
  select o.conv_id, list_concat(coalesce(list_slice(b.turns, 1, h), []), list_slice(o.turns, h + 1, len(o.turns))) as turns
  from own o join crcs using (conv_id) left join own b on b.conv_id = o.conv_id - o.conv_id % 20
),
steps as (
  select conv_id as c, d, list_slice(turns, 1, d) as path, len(turns) as size
  from (select *, unnest(range(len(turns) + 1)) as d from built)
),
nodes as (
  select path, any_value(d) as depth, min(c) as conv_id, count(*) as n_convs,
         sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (size = d), '')) as ends_sha256,
         case when any_value(d) = 0 then 0 else len(regexp_extract_all(any_value(path[-1].t), '[^\x20\x09-\x0D]+')) end as words
  from steps group by path
),
named as (select s.c, s.d, n.conv_id from steps s join nodes n on n.path = s.path),
linked as (
  select n.*, p.conv_id as parent_conv_id
  from nodes n left join named p on p.c = n.conv_id and p.d = n.depth - 1
),
kids as (select parent_conv_id as conv_id, depth - 1 as depth, count(*) as n_children from linked where depth > 0 group by 1, 2),
full_nodes as (select l.*, coalesce(n_children, 0) as n_children from linked l left join kids k using (conv_id, depth)),
below as (
  select a.conv_id, a.d as depth, f.conv_id as u, f.depth as du, any_value(f.n_children) as kids, any_value((f.n_convs - 1) * f.words) as saved
  from full_nodes f join named a on a.c = f.conv_id and a.d <= f.depth group by all
),
sums as (
  select conv_id, depth, count(*) filter (kids = 0) as n_leaves, sum(saved)::bigint as saved_tokens from below group by 1, 2
)
select conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
from full_nodes join sums using (conv_id, depth)
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_url_filters": OP3_SQL, "op11_substring_dedup": OP11_SQL, "op12_merkle_manifest": OP12_SQL,
            "op13_prefix_trie": OP13_SQL}
