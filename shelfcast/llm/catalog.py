"""The queries of this subpackage over the driver tables: name -> callable(spark, sf_dir), and DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.chat import format_chats, held_out
from shelfcast.llm.collocations import collocations
from shelfcast.llm.decontaminate import contamination
from shelfcast.llm.forest import near_duplicates
from shelfcast.llm.jaccard import Similarity, jaccard_components
from shelfcast.llm.labels import fold
from shelfcast.llm.language import fit, identify
from shelfcast.llm.packing import pack
from shelfcast.llm.quality import quality
from shelfcast.llm.search import search_documents
from shelfcast.llm.secrets import digest, scan
from shelfcast.llm.toxicity import toxicity
from shelfcast.llm.trie import conversation_trie
from shelfcast.llm.urls import judge

LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = table(spark, sf_dir, "conversations")
    return format_chats(chats, chats.where(~held_out())).withColumn("held_out", held_out())


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(scan(table(spark, sf_dir, "documents")))


def _held_out(folds: int, held: int):
    return F.coalesce(fold("doc_id", folds) == held, F.lit(False)).alias("held_out")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, fit(docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (fold("doc_id", 5) != 0))))
    return found.select("doc_id", _held_out(5, 0), "lang_pred", "score", "rejected")


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), folds=4, held=2)
    return scored.select("doc_id", _held_out(4, 2), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "n_passages")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), folds=3, held=1)
    return scored.select("doc_id", _held_out(3, 1), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP4_SQL = rf"""
with d as (select row_number() over () r, doc_id, regexp_extract_all({LOWER_SQL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents),
b as (select item_id, regexp_extract_all({LOWER_SQL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from benchmark),
iw as (
  select distinct item_id, least(len(w), 13) m, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') win
  from (select item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) i from b where len(w) > 0)
),
dw as (
  select r, i, m, array_to_string(w[i : i + m - 1], ' ') win
  from (select r, w, m, unnest(range(1, len(w) - m + 2)) i from d, (select distinct m from iw) where len(w) >= m)
),
hit as (select r, i, dw.m, item_id from dw join iw on dw.win = iw.win and dw.m = iw.m),
words as (select r, count(distinct j) n_hit from (select r, unnest(range(i, i + m)) j from (select distinct r, i, m from hit)) group by r),
items as (select r, count(*) n_items, sha256(string_agg(s, ',' order by s)) h from (select distinct r, cast(item_id as varchar) s from hit) group by r)
select doc_id, cast(len(w) as bigint) n_words, cast(coalesce(n_hit, 0) as bigint) n_hit, cast(coalesce(n_items, 0) as bigint) n_items,
  coalesce(h, sha256('')) items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) contaminated
from d left join words using (r) left join items using (r)
"""


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), Similarity(words=4, num=85, den=100))


OP8_SQL = rf"""
with recursive d as (select doc_id, regexp_extract_all({LOWER_SQL}, '[^\x20\x09-\x0D]+') w from documents),
s as (
  select distinct doc_id, array_to_string(w[i : i + least(len(w), 4) - 1], ' ') g
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) i from d where len(w) > 0)
),
n as (select doc_id, count(*) n from s group by doc_id),
c as (select a.doc_id a, b.doc_id b, count(*) c from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
l as (select a, b from c join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 85 * (x.n + y.n - c)),
r as (select doc_id a, doc_id b from d union select r.a, l.b from r join l on r.b = l.a)
select d.doc_id, cast(coalesce(n.n, 0) as bigint) n_shingles, m.component_id
from d left join n using (doc_id) join (select a, min(b) component_id from r group by a) m on m.a = d.doc_id
"""


def op9_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_documents(table(spark, sf_dir, "documents"))


OP9_SQL = rf"""
with d as (select row_number() over () r, doc_id, text, regexp_extract_all({LOWER_SQL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents),
t as (select r, doc_id, len(w) l, unnest(w) g from d),
p as (select r, doc_id, l, g, count(*) tf from t group by all),
f as (select g, count(*) df from p group by g),
m as (select count(*) n, sum(len(w)) / count(*) mean from d),
q as (select distinct doc_id query_id, text, unnest(list_distinct(w)) g from d where doc_id % 100 = 0),
s as (
  select query_id, text, r, doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * l / mean))), 6) score
  from q join p using (g) join f using (g), m group by all
),
o as (select *, row_number() over (partition by query_id, text order by score desc, doc_id) rank from s)
select query_id, cast(rank as integer) rank, doc_id, score from o where rank <= 10
"""


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pack(docs, tokenizer_json=public_tokenizers.path("byte_bpe_50k.json"), ranks_file=public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op11_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), Similarity(words=3, num=85, den=100))


OP11_SQL = f"select *, doc_id = component_id kept from ({OP8_SQL.replace('least(len(w), 4)', 'least(len(w), 3)').replace('greatest(len(w) - 3, 1)', 'greatest(len(w) - 2, 1)')})"


def op12_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


CRC32_SQL = (
    "xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(cast(conv_id as varchar), ''), lambda x: ord(x)::bigint)), "
    "lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"
)
OP12_SQL = f"""
with t as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) - 1 pos
  from conversations where conv_id is not null
),
c as (select conv_id, count(*) len, {CRC32_SQL} % 6 h, conv_id - conv_id % 100 base from t group by conv_id),
r as (
  select c.conv_id, t.pos + 1 d, role, text from c join t on t.conv_id = c.base and t.pos < c.h
  union all
  select c.conv_id, t.pos - c.h + least(c.h, coalesce(b.len, 0)) + 1, role, text from c left join c b on b.conv_id = c.base join t on t.conv_id = c.conv_id and t.pos >= c.h
),
p as (
  select conv_id, d, len(text) chars, sha256(string_agg(sha256(role) || sha256(text), '') over (partition by conv_id order by d)) nm from r
  union all select conv_id, 0, 0, '' from c
),
q as (select p.*, lag(nm) over (partition by conv_id order by d) up, d = max(d) over (partition by conv_id) ends from p),
n as (
  select d, nm, any_value(up) up, any_value(chars) chars, min(conv_id) conv_id, count(*) n_convs,
    sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (ends), '')) ends_sha256
  from q group by d, nm
),
k as (select d - 1 d, up nm, count(*) n_children from n where d > 0 group by all),
m as (select n.*, coalesce(n_children, 0) n_children, case when d > 0 then (n_convs - 1) * chars else 0 end saved from n left join k using (d, nm)),
s as (select v.d, v.nm, sum(cast(u.n_children = 0 as int)) n_leaves, sum(u.saved) saved from m u join p v on v.conv_id = u.conv_id and v.d <= u.d group by all)
select m.conv_id, m.d as depth, above.conv_id parent_conv_id, m.n_convs, cast(m.n_children as bigint) n_children, cast(s.n_leaves as bigint) n_leaves, cast(s.saved as bigint) saved_tokens, m.ends_sha256
from m join s using (d, nm) left join m above on above.d = m.d - 1 and above.nm = m.up
"""


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP13_SQL = rf"""
with t as (select coalesce(lang, 'und') lang, unnest(regexp_extract_all({LOWER_SQL}, '[^.,;:!?\x0A-\x0D]+')) p from documents),
w as (select lang, regexp_extract_all(p, '[^\x20\x09]+') w from t),
f as (select lang, m, array_to_string(w[i : i + m - 1], ' ') g, count(*) c from (select lang, w, m, unnest(range(1, len(w) - m + 2)) i from w, (values (1), (2), (3)) s(m)) group by all),
n as (select lang, sum(c) n from f where m = 1 group by lang),
c as (select lang, m, g, c a, string_split(g, ' ') w from f where m > 1 and c >= 10),
x as (
  select c.lang, c.m, c.g, c.w, a, k, u.c l, v.c r, (1000000::hugeint * a * a) // (u.c::hugeint * v.c) score
  from (select *, unnest(range(1, m)) k from c) c join f u on u.lang = c.lang and u.g = array_to_string(w[1 : k], ' ') join f v on v.lang = c.lang and v.g = array_to_string(w[k + 1 :], ' ')
),
b as (select * from x qualify row_number() over (partition by lang, g order by score, k) = 1),
o as (select lang, sub, max(a) longer from (select lang, a, array_to_string(w[i : i + 1], ' ') sub from (select *, unnest([1, 2]) i from c where m = 3)) group by all),
z as (select b.* from b left join o on o.lang = b.lang and o.sub = b.g where coalesce(100 * longer < 50 * a, true)),
k as (select *, row_number() over (partition by lang order by score desc, a desc, g) as pos from z)
select k.lang, pos as rank, g phrase, a, l, r, cast(n as bigint) n, cast(score as bigint) score from k join n using (lang) where pos <= 2000
"""


EVERY = (
    op1_chat_formatting, op2_secret_scans, op3_language_id, op4_benchmark_decontamination, op5_url_filters, op6_quality_classifier, op7_toxicity,
    op8_ngram_jaccard_join, op9_topk_search, op10_packing, op11_minhash_near_dedup, op12_conversation_prefix_trie, op13_phrase_collocations,
)
QUERIES = {f.__name__: f for f in EVERY}
ORACLES = {
    "op4_benchmark_decontamination": OP4_SQL, "op8_ngram_jaccard_join": OP8_SQL, "op9_topk_search": OP9_SQL,
    "op11_minhash_near_dedup": OP11_SQL, "op12_conversation_prefix_trie": OP12_SQL, "op13_phrase_collocations": OP13_SQL,
}
