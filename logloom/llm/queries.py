"""Registered queries of the package and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers

from logloom.llm import ann, decontam, hardneg, langid, neardup, packing, pieces, pii, sharding, tokencount, toxicity, trie, warc
from logloom.llm.batches import table


def op1_personal_data(spark, sf_dir):
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op2_language_id(spark, sf_dir):
    return langid.language_ids(table(spark, sf_dir, "documents"))


def op3_sentencepiece(spark, sf_dir):
    return pieces.piece_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op4_toxicity(spark, sf_dir):
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_sharding(spark, sf_dir):
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op6_nearest(spark, sf_dir):
    return ann.neighbours(table(spark, sf_dir, "embeddings"))


def op7_token_counts(spark, sf_dir):
    return tokencount.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_warc(spark, sf_dir):
    return warc.archived_pages(table(spark, sf_dir, "pages"))


def op9_simhash_components(spark, sf_dir):
    return neardup.simhash_components(table(spark, sf_dir, "documents"))


def op10_decontamination(spark, sf_dir):
    return decontam.decontamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_prefix_trie(spark, sf_dir):
    return trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op12_packing(spark, sf_dir):
    return packing.packed_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op13_hard_negatives(spark, sf_dir):
    return hardneg.mined_negatives(table(spark, sf_dir, "embeddings"))


_ALL = (
    op1_personal_data, op2_language_id, op3_sentencepiece, op4_toxicity, op5_sharding, op6_nearest, op7_token_counts,
    op8_warc, op9_simhash_components, op10_decontamination, op11_prefix_trie, op12_packing, op13_hard_negatives,
)
QUERIES = {f.__name__: f for f in _ALL}

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLES = {
    "op8_warc": """
with p as (select page_id, coalesce(html, '') body from pages),
h as (select page_id, sha1(body) d, octet_length(encode(body)) n, max(page_id) over (partition by body) owner from p),
digits as (select *, [cast('0x' || substr(d, 5 * i + 1, 5) as bigint) for i in range(8)] v from h)
select page_id, cast(n as bigint) payload_bytes,
  list_aggregate(list_transform(flatten([[(x >> 15) & 31, (x >> 10) & 31, (x >> 5) & 31, x & 31] for x in v]),
    lambda x: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', x + 1, 1)), 'string_agg', '') payload_digest,
  case when page_id = owner then 'response' else 'revisit' end record_type,
  case when page_id = owner then null else owner end refers_to
from digits""",
    "op10_decontamination": f"""
with item as (select cast(item_id as varchar) item_id, {_WORDS} w from benchmark),
sized as (select item_id, w, least(13, len(w)) k from item where len(w) > 0),
grams as (select item_id, k, array_to_string(w[i:i + k - 1], ' ') g
  from (select item_id, w, k, unnest(range(1, len(w) - k + 2)) i from sized)),
doc as (select doc_id, {_WORDS} w from documents),
places as (select doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') g
  from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) i from doc, (select distinct k from sized) where len(w) >= k)),
found as (select p.doc_id, p.i, p.k, grams.item_id from places p join grams on p.k = grams.k and p.g = grams.g),
words as (select doc_id, count(distinct pos) n_hit
  from (select doc_id, unnest(range(i, i + k)) pos from (select distinct doc_id, i, k from found)) group by doc_id),
items as (select doc_id, list_sort(list(distinct item_id)) l from found group by doc_id)
select doc.doc_id, len(w) n_words, coalesce(n_hit, 0) n_hit, coalesce(len(l), 0) n_items,
  sha256(coalesce(array_to_string(l, ','), '')) items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) contaminated
from doc left join words using (doc_id) left join items using (doc_id)""",
    "op11_prefix_trie": """
with t as (select conv_id, coalesce(role, '') r, coalesce(text, '') x,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) i
  from conversations where conv_id is not null),
own as (select conv_id, max(i) n, list({'r': r, 'x': x} order by i) s from t group by conv_id),
sized as (select *, list_reduce(list_transform(range(length(cast(conv_id as varchar))), lambda k: cast(ascii(substr(cast(conv_id as varchar), k + 1, 1)) as bigint)),
    lambda c, b: list_reduce(range(8), lambda d, k: xor(d >> 1, (d & 1) * 3988292384), xor(c, b)), 4294967295) f from own),
heads as (select sized.conv_id, sized.s, coalesce(b.s, []) base, (4294967295 - f) % 4 h
  from sized left join own b on b.conv_id = sized.conv_id - sized.conv_id % 20),
built as (select conv_id, list_concat(base[1:h], s[h + 1:]) s from heads),
members as (select conv_id, d depth, s[1:d] p, len(s) = d ended from (select conv_id, s, unnest(range(len(s) + 1)) d from built)),
nodes as (select p, depth, min(conv_id) conv_id, count(*) n_convs, string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where ended) ends,
    case when depth = 0 then 0 else (count(*) - 1) * len(regexp_extract_all(p[depth]['x'], '[^\x20\x09-\x0D]+')) end cost
  from members group by p, depth),
kids as (select c.p[1:c.depth - 1] p, count(*) n_children from nodes c where depth > 0 group by 1),
full_nodes as (select nodes.*, coalesce(n_children, 0) n_children from nodes left join kids using (p)),
sums as (select p, count(*) filter (where n_children = 0) n_leaves, sum(cost) saved_tokens
  from (select n_children, cost, unnest(list_transform(range(depth + 1), lambda k: full_nodes.p[1:k])) p from full_nodes) group by p)
select n.conv_id, n.depth, parent.conv_id parent_conv_id, n.n_convs, n.n_children, n_leaves, cast(saved_tokens as bigint) saved_tokens,
  sha256(coalesce(n.ends, '')) ends_sha256
from full_nodes n join sums using (p) left join nodes parent on n.depth > 0 and parent.p = n.p[1:n.depth - 1]""",
    "op13_hard_negatives": """
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end l,
    list_transform(embedding, lambda x: floor(256 * cast(x as double))) e
  from embeddings where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id a, b.vec_id b, a.l = b.l same, cast(list_inner_product(a.e, b.e) as bigint) s
  from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
p as (select * from (select *, row_number() over (partition by a order by s desc, b) r from s where same) where r <= 5),
n as (select p.a, p.b, s.b negative_id, p.s positive_score, s.s negative_score, row_number() over (partition by p.a, p.b order by s.s desc, s.b) r
  from p join s on s.a = p.a and not s.same and 30 * p.s <= 100 * s.s and 100 * s.s <= 90 * p.s)
select a anchor_id, b positive_id, r as rank, negative_id, positive_score, negative_score from n where r <= 10""",
}
