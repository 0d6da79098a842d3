"""The registered queries of this package and, where SQL can express them, their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import ctw, embeddings, licenses, mixing, packing, quality, quotes, simhash, substring, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.word_counts(table(spark, sf_dir, "documents"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select("doc_id", simhash.hex_print().alias("fingerprint"), "component_id")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.dedup(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op4_ctw_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link(table(spark, sf_dir, "conversations"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc.roundtrip(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])
    return found.withColumn("dice", F.round("dice", 6))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.verdict(quality.ledger(docs)).drop("text")


def quality_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many documents fail each rule of the policy in force, and how many only it rejects."""
    return quality.ablation(quality.ledger(table(spark, sf_dir, "documents").select("doc_id", "text")))


QUERIES = {
    "op1_source_mixing": op1_source_mixing,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_ctw_scoring": op4_ctw_scoring,
    "op5_quotation_linking": op5_quotation_linking,
    "op6_warc": op6_warc,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_embedding_near_dedup": op8_embedding_near_dedup,
    "op9_license_scan": op9_license_scan,
    "op10_quality_rules": op10_quality_rules,
    "quality_ablation": quality_ablation,
}

ORACLES = {
    "op5_quotation_linking": r"""
with recursive m as (
  select conv_id, turn, role, coalesce(text, '') as t, string_split(coalesce(text, ''), chr(10)) as l from conversations
), q as (
  select *, list_transform(l, lambda x: regexp_matches(x, '^[ \t]*>')) as q from m
), b as (
  select *, list_contains(q, true) as any_q,
    list_transform(list_filter(range(1, len(l) + 1), lambda i: not q[i] and not (regexp_matches(l[i], '^[^>]*\bwrote:[ \t]*$') and i < len(l) and q[i + 1])), lambda i: l[i]) as k from q
), body as (
  select conv_id, turn, role, t, case when any_q then regexp_replace(array_to_string(k, chr(10)), '^\s+|\s+$', '', 'g') else t end as body,
    len(list_filter(q, lambda x: x))::bigint as n_quoted from b
), known as (select * from body where conv_id is not null and turn is not null),
ln as (
  select conv_id, turn, t, i, l[i] as line from (select distinct b.conv_id, b.turn, b.t, b.l from b where any_q and conv_id is not null and turn is not null) x, unnest(range(1, len(x.l) + 1)) as u(i)
), lv as (
  select *, length(regexp_replace(regexp_extract(line, '^((?:[ \t]*>)+)', 1), '[^>]', '', 'g')) as level, regexp_replace(line, '^((?:[ \t]*>)+)', '') as said from ln
), ch as (
  select *, case when level is distinct from lag(level) over (partition by conv_id, turn, t order by i) then 1 else 0 end as new from lv
), rn as (
  select *, sum(new) over (partition by conv_id, turn, t order by i) as run from ch
), ps as (
  select conv_id, turn, t, run, level, string_agg(said, chr(10) order by i) as p from rn where level > 0 group by all
), ak as (
  select conv_id, turn, level, run, 0 as part, p as x from ps union all select conv_id, turn, level, run, 1, unnest(string_split_regex(p, '\n[ \t\r]*\n')) from ps
  union all select conv_id, turn, level, run, 2, unnest(string_split(p, chr(10))) from ps
), an as (
  select *, trim(regexp_replace(lower(x), '[^\p{L}\p{N}]+', ' ', 'g')) as n from ak
), asked as (
  select distinct conv_id, turn, level, run, part, md5(n) as k, case when part = 2 then len(string_split(n, ' ')) >= 8 else len(string_split(n, ' ')) >= 3 or length(n) >= 12 end as far
  from an where n <> '' and (part < 2 or len(string_split(n, ' ')) >= 3 or length(n) >= 12)
), pc as (
  select conv_id, turn, unnest(list_distinct(list_concat([body], list_concat(string_split_regex(body, '\n[ \t\r]*\n'), string_split(body, chr(10)))))) as x from known where body <> ''
), px as (
  select conv_id, turn, trim(regexp_replace(lower(x), '[^\p{L}\p{N}]+', ' ', 'g')) as n from pc
), ix as (
  select struct_pack(c := conv_id, u := turn) as spot, md5(n) as k from px where n <> '' and md5(n) in (select k from asked)
), near as (select k, spot.c as conv_id, min(spot) as near from ix group by all), first as (select k, min(near) as first from near group by k),
fd as (
  select a.*, coalesce(case when near < struct_pack(c := a.conv_id, u := turn) then near end, case when far and first < struct_pack(c := a.conv_id, u := turn) then first end) as dest
  from asked a join first on a.k = first.k left join near on a.k = near.k and a.conv_id = near.conv_id
), rp as (
  select conv_id, turn, arg_min(dest, struct_pack(a := level, b := part, c := (dest.c <> conv_id)::int, d := run, e := dest)) as dest from fd where dest is not null group by 1, 2
), hop as (
  select conv_id as a, dest.c as b from rp where dest.c <> conv_id union select dest.c, conv_id from rp where dest.c <> conv_id
), reach as (
  select distinct conv_id, conv_id as r from known union select reach.conv_id, hop.b from reach join hop on reach.r = hop.a
), th as (select conv_id, min(r) as thread_id from reach group by 1),
tn as (select conv_id, turn, lag(turn) over (partition by conv_id order by turn) as last from (select distinct conv_id, turn from known)),
meta as (
  select tn.conv_id, tn.turn, thread_id, row_number() over (partition by thread_id order by tn.conv_id, tn.turn) as position, dest is not null as linked,
    coalesce(dest.c, case when last is not null then tn.conv_id end) as reply_conv, coalesce(dest.u, last) as reply_turn
  from tn join th on tn.conv_id = th.conv_id left join rp on tn.conv_id = rp.conv_id and tn.turn = rp.turn
)
select thread_id, coalesce(position, 1)::bigint as position, body.conv_id, body.turn, role, body, n_quoted, reply_conv, reply_turn, coalesce(linked, false) as linked
from body left join meta on body.conv_id = meta.conv_id and body.turn = meta.turn
""",
    "op3_substring_dedup": r"""
with d as (
  select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), s as (
  select r, i, md5(array_to_string(w[i:i + 34], ' ')) as g from (select r, w, unnest(range(1, len(w) - 33)) as i from d)
), c as (
  select r, i from (select r, i, count(*) over (partition by g) as n from s) where n > 1
), u as (
  select r, list(distinct p) as gone from (select r, unnest(range(i, i + 35)) as p from c) group by r
), k as (
  select doc_id, w, coalesce(gone, []) as gone from d left join u using (r)
), p as (
  select doc_id, w, len(gone) as n, case when len(gone) = 0 then w else list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: not list_contains(gone, x[2])), lambda x: x[1]) end as kept from k
)
select doc_id, len(w)::bigint as n_words, n::bigint as n_removed, sha256(array_to_string(kept, ' ')) as kept_sha256 from p
""",
    "op6_warc": r"""
with p as (
  select page_id, coalesce(html, '') as h from pages
), k as (
  select *, octet_length(encode(h))::bigint as payload_bytes, case when octet_length(encode(h)) >= 1000 then max(page_id) over (partition by h) end as keeper from p
)
select page_id, payload_bytes, sha1(h) as payload_digest, case when page_id <> keeper then 'revisit' else 'response' end as record_type, case when page_id <> keeper then keeper end as refers_to from k
""",
    "op8_embedding_near_dedup": r"""
with recursive e as (
  select vec_id, label, list_transform(embedding, lambda x: x::double) as v from embeddings
), g as (
  select * from e where label is not null and len(v) > 0 and len(list_filter(v, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(v, lambda x: x <> 0)) > 0
), l as (
  select a.vec_id as a, b.vec_id as b from g a join g b on a.label = b.label and len(a.v) = len(b.v) and a.vec_id <> b.vec_id
  where list_cosine_similarity(a.v, b.v) >= 0.98
), reach as (
  select vec_id, vec_id as r from e union select reach.vec_id, l.b from reach join l on reach.r = l.a
)
select vec_id, (select count(*) from l where a = reach.vec_id)::bigint as n_links, min(r) as component_id, vec_id = min(r) as kept from reach group by vec_id
""",
    "op9_license_scan": licenses.sql(),
    "op10_quality_rules": r"""
with d as (
  select doc_id, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
  from documents
), g as (
  select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g
  from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from d)
), f as (
  select doc_id, i, count(*) over (partition by doc_id, g) as n from g
), r as (
  select doc_id, count(distinct p) as n_repeat_words
  from (select doc_id, unnest([i, i + 1, i + 2]) as p from f where n > 1) group by doc_id
), m as (
  select d.doc_id, len(w)::bigint as n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::bigint as word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
         len(l)::bigint as n_lines, (len(l) - len(list_distinct(l)))::bigint as n_dup_lines,
         coalesce(n_repeat_words, 0)::bigint as n_repeat_words
  from d left join r on d.doc_id = r.doc_id
), b as (
  select *, ((n_words < 50)::int + 2 * (100 * n_repeat_words > 50 * n_words)::int + 4 * (100 * n_symbols > 10 * n_words)::int
    + 8 * (2 * n_dup_lines > n_lines)::int + 16 * (word_chars < 2 * n_words)::int + 32 * (word_chars > 15 * n_words)::int)::bigint as failed_bits
  from m
)
select *, failed_bits & 3 <> 0 as base_failed, failed_bits = 0 as kept from b
""",
}
_RULES = ", ".join(f"('{r.name}', {1 << r.bit})" for r in quality.RULES)
ORACLES["quality_ablation"] = f"""with q as ({ORACLES["op10_quality_rules"]}), r as (select * from (values {_RULES}) as t(rule, bit))
select rule, (select count(*) from q where failed_bits & bit <> 0) as n_failed, (select count(*) from q where failed_bits = bit) as n_only from r"""
