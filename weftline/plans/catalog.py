"""The registered queries of the record-linkage engine and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions import text
from weftline.operators import assemble, blocking, evaluate, features, matcher, profile, sampling, validate
from weftline.plans import views
from weftline.plans.views import BLOCKING_SQL, NORMALISED_SQL, RECORDS_SQL, tfidf_sql
from weftline.sources import tsv
from weftline.sources.files import Scratch, write_text

QUERIES: dict = {}
ORACLES: dict = {}
FLAGSHIP = "f05_tfidf_baseline"
#: Inline texts for transliteration, and what they become.
SPELLED = {"राज": "raja", "कमल": "kamala", "ड़ा": "daa", "Shop १२, दिल्ली।": "Shop 12, dillii ", "plain": "plain", "": ""}


def query(oracle: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLES[f.__name__] = oracle
        return f

    return register


def six(*names: str):
    return [F.round(n, 6).alias(n) for n in names]


def _s1_ids(spark, d) -> DataFrame:
    return views.records(spark, d).where("entity_id like 'S1-%'").select(F.col("entity_id").alias("s1_id"))


def _candidates(spark, d, k: int = 30) -> DataFrame:
    return blocking.block_all(*views.sides(spark, d), k=k)


@query(f"with {RECORDS_SQL} select entity_id, business_name, business_address, country from r")
def load_sources(spark: SparkSession, d: str) -> DataFrame:
    return views.records(spark, d).drop("k")


@query(f"with {RECORDS_SQL} select split_part(entity_id, '-', 1) as source, count(*) as n from r where entity_id not like 'S1-%' group by 1")
def pool_union(spark: SparkSession, d: str) -> DataFrame:
    rows = views.records(spark, d)
    pool = rows.where("entity_id like 'S2-%'").unionByName(rows.where("entity_id like 'S3-%'"))
    return pool.groupBy(F.substring_index("entity_id", "-", 1).alias("source")).agg(F.count(F.lit(1)).alias("n"))


@query(f"with {RECORDS_SQL} select country, count(*) as n from r group by 1 order by n desc, country limit 10")
def country_mix(spark: SparkSession, d: str) -> DataFrame:
    return profile.country_mix(views.records(spark, d))


@query(f"with {NORMALISED_SQL} select len(matched)::int as n_matches, count(*) as n from lists group by 1")
def match_histogram(spark: SparkSession, d: str) -> DataFrame:
    return profile.match_histogram(views.truth_lists(spark, d))


@query(f"""with {NORMALISED_SQL}, c as (select len(matched) as m, len(list_filter(matched, lambda x: x like 'S2-%')) as s2 from lists)
select count(*) as n_s1, count(*) filter (m = 0) as n_singletons, round(avg(m) filter (m > 0), 6) as mean_matches,
       sum(s2)::bigint as s2_refs, sum(m - s2)::bigint as s3_refs, max(m)::int as max_matches from c""")
def match_summary(spark: SparkSession, d: str) -> DataFrame:
    return profile.match_summary(views.truth_lists(spark, d)).withColumn("mean_matches", F.round("mean_matches", 6))


@query(f"""with {NORMALISED_SQL}, o as (select cand_id, count(*) as refs from truth group by 1)
select case when cand_id like 'S2-%' then 'S2' else 'S3' end as source, count(*) as n_ids, count(*) filter (refs > 1) as n_multi, max(refs) as max_refs from o group by 1""")
def multi_owner(spark: SparkSession, d: str) -> DataFrame:
    return profile.multi_owner(views.truth(spark, d))


@query(f"""with {NORMALISED_SQL}, c as (select len(list_filter(matched, lambda x: x like 'S2-%')) > 0 as s2, len(list_filter(matched, lambda x: x like 'S3-%')) > 0 as s3 from lists)
select count(*) filter (s2 and s3) as n_both, count(*) filter (s2 and not s3) as n_only_s2, count(*) filter (not s2 and s3) as n_only_s3 from c""")
def source_coverage(spark: SparkSession, d: str) -> DataFrame:
    return profile.source_coverage(views.truth_lists(spark, d))


_ASCII = "regexp_matches({0}, '^[\\x00-\\x7F]*$')"


@query(f"""with {NORMALISED_SQL}, x as (
  select t.*, s1.business_name as na, s1.business_address as aa, s23.business_name as nb, s23.business_address as ab,
         row_number() over (partition by s1_id order by cand_id) as o
  from truth t join s1 on s1.entity_id = s1_id join s23 on s23.entity_id = cand_id)
select count(*) as n_pairs, count(*) filter (o = 1 and not {_ASCII.format("na")}) as s1_nonascii, count(*) filter (o = 1 and trim(aa) = '') as s1_addr_empty,
  count(*) filter ({_ASCII.format("nb")}) as match_name_ascii, count(*) filter (not {_ASCII.format("nb")}) as match_name_nonascii,
  count(*) filter ({_ASCII.format("na")} and {_ASCII.format("nb")}) as both_ascii, count(*) filter (trim(ab) = '') as match_addr_empty from x""")
def script_mix(spark: SparkSession, d: str) -> DataFrame:
    rows = views.records(spark, d)
    return profile.script_mix(views.truth(spark, d), rows.where("entity_id like 'S1-%'"), rows.where("entity_id not like 'S1-%'"))


def _normal(spark, d) -> DataFrame:
    return text.normalised(views.records(spark, d))


@query(f"with {NORMALISED_SQL} select entity_id, name_clean, addr_clean from n")
def normalize_names(spark: SparkSession, d: str) -> DataFrame:
    return _normal(spark, d).select("entity_id", "name_clean", "addr_clean")


@query(f"with {NORMALISED_SQL} select entity_id, array_to_string(name_tokens, ' ') as name_tokens, array_to_string(name_core, ' ') as name_core from n")
def name_core_tokens(spark: SparkSession, d: str) -> DataFrame:
    return _normal(spark, d).select("entity_id", F.array_join("name_tokens", " ").alias("name_tokens"), F.array_join("name_core", " ").alias("name_core"))


@query(f"""with {NORMALISED_SQL} select entity_id, array_to_string(addr_tokens, ' ') as addr_tokens,
  array_to_string(list_filter(addr_tokens, lambda x: x not in ('post', 'near', 'opposite', 'unit', 'number')), ' ') as own_tokens from n""")
def expand_address(spark: SparkSession, d: str) -> DataFrame:
    return _normal(spark, d).select("entity_id", F.array_join("addr_tokens", " ").alias("addr_tokens"), F.array_join(text.address_tokens_of(F.col("addr_tokens")), " ").alias("own_tokens"))


@query(f"with {NORMALISED_SQL} select entity_id, zip from n")
def extract_zip(spark: SparkSession, d: str) -> DataFrame:
    return _normal(spark, d).select("entity_id", "zip")


@query(f"with {NORMALISED_SQL} select entity_id, house from n")
def house_number(spark: SparkSession, d: str) -> DataFrame:
    return _normal(spark, d).select("entity_id", "house")


@query(f"with {NORMALISED_SQL} select entity_id, array_to_string(block, ' ') as block_text from n")
def block_text(spark: SparkSession, d: str) -> DataFrame:
    return text.block_text(views.records(spark, d)).select("entity_id", F.col("_block").alias("block_text"))


@query("select * from (values " + ", ".join(f"('{k}', '{v}')" for k, v in SPELLED.items()) + ") as t(text, latin)")
def transliterate_inline(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.createDataFrame([(k,) for k in SPELLED], "text string")
    return rows.select("text", text.transliterate(F.col("text")).alias("latin"))


_PAIRS_SQL = BLOCKING_SQL + """, x as (
  select s1_id, cand_id, tfidf, a.name_clean as an, b.name_clean as bn, a.addr_clean as aa, b.addr_clean as ba, a.name_core as ac, b.name_core as bc,
         a.name_tokens as at_, b.name_tokens as bt, a.addr_tokens as ad, b.addr_tokens as bd, a.zip as az, b.zip as bz, a.house as ah, b.house as bh,
         a.country as aco, b.country as bco
  from top join n a on a.entity_id = s1_id join n b on b.entity_id = cand_id
)"""


def _jac(a: str, b: str) -> str:
    both = f"len(list_distinct(list_concat({a}, {b})))"
    return f"round(case when {both} = 0 then 1.0 else len(list_intersect(list_distinct({a}), list_distinct({b})))::double / {both} end, 6)"


def _features(spark, d, *names) -> DataFrame:
    s1, pool = views.sides(spark, d)
    return features.build_rows(_candidates(spark, d), s1, pool).select("s1_id", "cand_id", *six(*names))


@query(f"with {_PAIRS_SQL} select s1_id, cand_id, {_jac('ac', 'bc')} as name_jac_core, {_jac('at_', 'bt')} as name_jac_full, {_jac('ad', 'bd')} as addr_jac from x")
def jaccard_features(spark: SparkSession, d: str) -> DataFrame:
    return _features(spark, d, "name_jac_core", "name_jac_full", "addr_jac")


_LEN = "round(abs(length({0}) - length({1}))::double / greatest(length({0}), length({1}), 1), 6)"


@query(f"with {_PAIRS_SQL} select s1_id, cand_id, {_LEN.format('an', 'bn')} as name_len_diff, {_LEN.format('aa', 'ba')} as addr_len_diff from x")
def length_features(spark: SparkSession, d: str) -> DataFrame:
    return _features(spark, d, "name_len_diff", "addr_len_diff")


@query(f"""with {_PAIRS_SQL} select s1_id, cand_id, (az <> '' and az = bz)::int::double as zip_match, (az = '' or bz = '')::int::double as zip_missing,
  (ah <> '' and ah = bh)::int::double as house_match, (aco <> '' and aco = bco)::int::double as same_country, round(tfidf, 6) as tfidf from x""")
def zip_house_flags(spark: SparkSession, d: str) -> DataFrame:
    return _features(spark, d, "zip_match", "zip_missing", "house_match", "same_country", "tfidf")


def _lcs(a: str, b: str) -> str:
    """The bit-vector recurrence on 127-bit integers; the shorter string, a, has at most 126 characters."""
    place = "list_sum(list_transform(range(1, length({0}) + 1), lambda i: case when {0}[i] = c then (1::hugeint << (i - 1)::hugeint) else 0::hugeint end))::hugeint"
    s, t = f"(case when length({a}) <= length({b}) then {a} else {b} end)", f"(case when length({a}) <= length({b}) then {b} else {a} end)"
    whole = f"((1::hugeint << length({s})::hugeint) - 1)"
    hits = f"list_transform(string_split({t}, ''), lambda c: {place.format(s)})"
    last = f"list_reduce({hits}, lambda v, m: ((v + (v & m)) | (v - (v & m))) & {whole}, {whole})"
    return f"(case when length({s}) = 0 then 0 else length({s}) - bit_count({last}) end)"


def _ratio(a: str, b: str) -> str:
    return f"round(case when length({a}) + length({b}) = 0 then 1.0 else 2.0 * {_lcs(a, b)} / (length({a}) + length({b})) end, 6)"


@query(f"with {_PAIRS_SQL} select s1_id, cand_id, {_ratio('an', 'bn')} as name_ratio, {_ratio('aa', 'ba')} as addr_ratio from x")
def indel_ratio(spark: SparkSession, d: str) -> DataFrame:
    return _features(spark, d, "name_ratio", "addr_ratio")


def _token_set_cte(name: str, a: str, b: str) -> str:
    split = lambda c: f"list_sort(list_distinct(list_filter(string_split({c}, ' '), lambda t: t <> '')))"
    return f"""{name}0 as (select s1_id, cand_id, {a} as a, {b} as b, {split(a)} as ta, {split(b)} as tb from x),
{name}1 as (select *, list_filter(ta, lambda t: list_contains(tb, t)) as si, list_filter(ta, lambda t: not list_contains(tb, t)) as da, list_filter(tb, lambda t: not list_contains(ta, t)) as db from {name}0),
{name}2 as (select *, array_to_string(da, ' ') as ja, array_to_string(db, ' ') as jb, length(array_to_string(si, ' ')) as s, case when len(si) > 0 then 1 else 0 end as g from {name}1),
{name} as (select s1_id, cand_id, round(case when a = '' and b = '' then 1.0 when a = '' or b = '' then 0.0 when len(si) > 0 and (len(da) = 0 or len(db) = 0) then 1.0
  else greatest(1.0 - (length(ja) + length(jb) - 2 * {_lcs("ja", "jb")})::double / (2 * (s + g) + length(ja) + length(jb)),
    case when s > 0 then 1.0 - (g + length(ja))::double / (2 * s + g + length(ja)) end, case when s > 0 then 1.0 - (g + length(jb))::double / (2 * s + g + length(jb)) end) end, 6) as v from {name}2)"""


@query(f"with {_PAIRS_SQL}, {_token_set_cte('tn', 'an', 'bn')}, {_token_set_cte('ta', 'aa', 'ba')} select s1_id, cand_id, tn.v as name_set, ta.v as addr_set from tn join ta using (s1_id, cand_id)")
def token_set_ratio(spark: SparkSession, d: str) -> DataFrame:
    return _features(spark, d, "name_set", "addr_set")


def _indexed(spark, d):
    queries, pool = blocking.shards(*views.sides(spark, d))
    return queries, pool, *blocking.build_index(pool)


@query(f"with {BLOCKING_SQL} select shard, term, df, total, round(idf, 6) as idf from vocab")
def tfidf_vocab(spark: SparkSession, d: str) -> DataFrame:
    return _indexed(spark, d)[2].select("shard", "term", "df", "total", *six("idf"))


@query(f"with {BLOCKING_SQL} select shard, term, entity_id, round(w, 6) as w from pw")
def tfidf_index(spark: SparkSession, d: str) -> DataFrame:
    return _indexed(spark, d)[3].select("shard", "term", "entity_id", *six("w"))


_TOP = "select s1_id, cand_id, round(tfidf, 6) as tfidf, rank::int as rank from top"


@query(f"with {BLOCKING_SQL} {_TOP}")
def tfidf_topk(spark: SparkSession, d: str) -> DataFrame:
    return _candidates(spark, d).select("s1_id", "cand_id", *six("tfidf"), "rank")


@query(f"""with q as (select '' as shard, 'B' || item_id as entity_id, list_filter(string_split({views.sql_clean("text")}, ' '), lambda x: x <> '') as block from benchmark),
p as (select '' as shard, 'D' || doc_id as entity_id, list_filter(string_split({views.sql_clean("text")}, ' '), lambda x: x <> '') as block from documents),
{tfidf_sql("q", "p")} {_TOP}""")
def benchmark_blocking(spark: SparkSession, d: str) -> DataFrame:
    def side(name: str, key: str, prefix: str) -> DataFrame:
        rows = spark.read.parquet(f"{d}/{name}.parquet")
        return rows.select(F.lit("").alias("shard"), F.concat(F.lit(prefix), F.col(key).cast("string")).alias("entity_id"), text.clean(F.col("text")).alias("c")).withColumn("block", text.tokens_of(F.col("c")))

    q, p = side("benchmark", "item_id", "B"), side("documents", "doc_id", "D")
    return blocking.topk(p, q).select("s1_id", "cand_id", *six("tfidf"), "rank")


@query(f"""with {NORMALISED_SQL}, p0 as (select * from s23 where country <> 'es'),
q as (select *, case when country in (select country from p0) then country else '*' end as shard from s1),
p as (select *, country as shard from p0 union all select *, '*' from p0), {tfidf_sql("q", "p")} {_TOP}""")
def shard_fallback(spark: SparkSession, d: str) -> DataFrame:
    s1, pool = views.sides(spark, d)
    return blocking.block_all(s1, pool.where("country <> 'es'")).select("s1_id", "cand_id", *six("tfidf"), "rank")


_ZIP_SQL = """z as (select * from (select *, row_number() over (partition by country, zip order by entity_id) as zr from s23 where zip <> '') where zr <= 200),
zb as (select s1.entity_id as s1_id, z.entity_id as cand_id from s1 join z on s1.country = z.country and s1.zip = z.zip where s1.zip <> '')"""


def _zipped(spark, d) -> DataFrame:
    return blocking.zip_block(*blocking.shards(*views.sides(spark, d)))


@query(f"with {NORMALISED_SQL}, {_ZIP_SQL} select s1_id, cand_id from zb")
def zip_block(spark: SparkSession, d: str) -> DataFrame:
    return _zipped(spark, d)


@query(f"""with {BLOCKING_SQL}, {_ZIP_SQL}, u as (select s1_id, cand_id, tfidf, rank from top union all select s1_id, cand_id, 0.0, null from zb)
select s1_id, cand_id, round(max(tfidf), 6) as tfidf, coalesce(max(rank), 0)::int as rank from u group by all""")
def zip_union(spark: SparkSession, d: str) -> DataFrame:
    return blocking.block_all(*views.sides(spark, d), use_zip=True).select("s1_id", "cand_id", *six("tfidf"), F.coalesce("rank", F.lit(0)).alias("rank"))


@query(f"""with {BLOCKING_SQL} select count(*) as n_true, count(top.cand_id) as n_hit, round(count(top.cand_id)::double / count(*), 6) as recall
from truth left join top using (s1_id, cand_id)""")
def blocking_recall(spark: SparkSession, d: str) -> DataFrame:
    return blocking.blocking_recall(_candidates(spark, d), views.truth(spark, d), _s1_ids(spark, d)).select("n_true", "n_hit", *six("recall"))


@query(f"""with {BLOCKING_SQL}, {_ZIP_SQL}, ks as (select unnest([5, 10, 20, 30])::int as k), c as (
  select k, s1_id, cand_id from top, ks where rank <= k union select k, s1_id, cand_id from zb, ks)
select k, (select count(*) from truth) as n_true, count(t.s1_id) as n_hit, round(count(t.s1_id)::double / (select count(*) from truth), 6) as recall,
  round(count(*)::double / (select count(*) from s1), 6) as avg_pairs from c left join truth t using (s1_id, cand_id) group by k""")
def recall_at_k(spark: SparkSession, d: str) -> DataFrame:
    found = blocking.recall_at_k(_candidates(spark, d), views.truth(spark, d), _s1_ids(spark, d), [5, 10, 20, 30], _zipped(spark, d))
    return found.select("k", "n_true", "n_hit", *six("recall", "avg_pairs"))


_LABELLED_SQL = BLOCKING_SQL + ", lab as (select top.s1_id, top.cand_id, (t.s1_id is not null)::int as label from top left join truth t using (s1_id, cand_id))"


def _labelled(spark, d) -> DataFrame:
    return features.labelled(_candidates(spark, d).select("s1_id", "cand_id"), views.truth(spark, d))


@query(f"with {_LABELLED_SQL} select s1_id, cand_id, label from lab")
def labelled_pairs(spark: SparkSession, d: str) -> DataFrame:
    return _labelled(spark, d)


@query(f"""with {_LABELLED_SQL}, neg as (select *, row_number() over (order by md5('42' || chr(1) || s1_id || chr(1) || cand_id), s1_id, cand_id) as o from lab where label = 0)
select s1_id, cand_id, label from lab where label = 1 union all select s1_id, cand_id, label from neg where o <= 4 * (select count(*) from lab where label = 1)""")
def negative_sample(spark: SparkSession, d: str) -> DataFrame:
    return sampling.negative_sample(_labelled(spark, d), 4)


@query(f"""with {RECORDS_SQL}, i as (select entity_id as s1_id, row_number() over (order by md5('42:' || entity_id), entity_id) as o from r where entity_id like 'S1-%')
select s1_id, case when o <= 50 then 'val' when o <= 250 then 'train' else 'unused' end as part from i""")
def train_val_split(spark: SparkSession, d: str) -> DataFrame:
    return sampling.split(_s1_ids(spark, d), 50, 200)


@query(f"""with {NORMALISED_SQL}, keep as (select entity_id as s1_id from s1 order by md5('42:' || entity_id), entity_id limit 100),
need as (select distinct cand_id from truth where s1_id in (select s1_id from keep)),
o as (select entity_id, row_number() over (partition by left(entity_id, 2) order by md5('42:' || entity_id), entity_id) as o from s23 where entity_id not in (select cand_id from need))
select cand_id as entity_id from need union all select entity_id from o where o <= 50""")
def sampled_pool(spark: SparkSession, d: str) -> DataFrame:
    pool = views.records(spark, d).where("entity_id not like 'S1-%'").select("entity_id")
    return sampling.sampled_pool(pool, views.truth(spark, d), sampling.sample(_s1_ids(spark, d), 100), 100)


def _f05_sql(name: str, chosen: str, keys: str = "") -> str:
    """CTE of per-record F0.5; chosen: (s1_id, cand_id) predicted pairs."""
    return f"""{name}_p as ({chosen}),
{name}_c as (select s1_id, count(*) as np, count(t.cand_id) as nh from {name}_p left join truth t using (s1_id, cand_id) group by s1_id),
{name} as (select s1_id, coalesce(np, 0)::bigint as n_pred, len(matched)::bigint as n_true, coalesce(nh, 0)::bigint as n_hit,
  case when coalesce(np, 0) = 0 and len(matched) = 0 then 1.0 when coalesce(np, 0) = 0 or len(matched) = 0 or nh = 0 then 0.0
  else 1.25 * (nh / np) * (nh / len(matched)) / (0.25 * (nh / np) + nh / len(matched)) end as f05 from lists left join {name}_c using (s1_id))"""


@query(f"with {BLOCKING_SQL}, {_f05_sql('f', 'select s1_id, cand_id from top where round(tfidf, 9) >= 0.6')} select s1_id, n_pred, n_true, n_hit, round(f05, 6) as f05 from f")
def f05_per_record(spark: SparkSession, d: str) -> DataFrame:
    chosen = _candidates(spark, d).where("round(tfidf, 9) >= 0.6")
    return evaluate.per_record(chosen, views.truth(spark, d), _s1_ids(spark, d)).select("s1_id", *[F.col(c).cast("bigint").alias(c) for c in ("n_pred", "n_true", "n_hit")], *six("f05"))


@query(f"with {BLOCKING_SQL}, {_f05_sql('f', 'select s1_id, cand_id from top where round(tfidf, 9) >= 0.6')} select count(*) as n, round(avg(f05), 6) as macro_f05 from f")
def f05_macro(spark: SparkSession, d: str) -> DataFrame:
    chosen = _candidates(spark, d).where("round(tfidf, 9) >= 0.6")
    return evaluate.macro_f05(chosen, views.truth(spark, d), _s1_ids(spark, d)).select("n", *six("macro_f05"))


def _sweep_sql(thresholds: list[float]) -> str:
    grid = ", ".join(f"{t}::double" for t in thresholds)
    return f"""with {BLOCKING_SQL}, th as (select unnest([{grid}]) as threshold),
c as (select threshold, top.s1_id, count(*) as np, count(t.cand_id) as nh from top join th on round(tfidf, 9) >= threshold left join truth t using (s1_id, cand_id) group by all),
f as (select th.threshold, case when coalesce(np, 0) = 0 and len(matched) = 0 then 1.0 when coalesce(np, 0) = 0 or len(matched) = 0 or nh = 0 then 0.0
  else 1.25 * (nh / np) * (nh / len(matched)) / (0.25 * (nh / np) + nh / len(matched)) end as f05
  from lists cross join th left join c on c.s1_id = lists.s1_id and c.threshold = th.threshold),
sweep as (select threshold, avg(f05) as macro_f05 from f group by 1)"""


def _swept(spark, d, thresholds) -> DataFrame:
    scored = _candidates(spark, d).withColumn("tfidf", F.round("tfidf", 9))
    return evaluate.sweep(scored, views.truth(spark, d), _s1_ids(spark, d), "tfidf", thresholds)


@query(f"{_sweep_sql(evaluate.THRESHOLDS)} select threshold, round(macro_f05, 6) as macro_f05 from sweep")
def threshold_sweep_tfidf(spark: SparkSession, d: str) -> DataFrame:
    return _swept(spark, d, evaluate.THRESHOLDS).select("threshold", *six("macro_f05"))


@query(f"{_sweep_sql(evaluate.BASELINE_THRESHOLDS)} select threshold, round(macro_f05, 6) as macro_f05 from sweep order by round(macro_f05, 12) desc, threshold limit 1")
def f05_tfidf_baseline(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.best_threshold(_swept(spark, d, evaluate.BASELINE_THRESHOLDS)).select("threshold", *six("macro_f05"))


@query()
def gbt_match(spark: SparkSession, d: str) -> DataFrame:
    """Matches of every S1 record: each half, by a hash of the id, gets the model and the threshold of the other half, saved and loaded again."""
    s1, pool = views.sides(spark, d)
    truth = views.truth(spark, d)
    scratch = Scratch(spark)
    ids = _s1_ids(spark, d).withColumn("fold", F.pmod(F.crc32("s1_id"), F.lit(2)))
    rows = scratch.put("rows", features.build_rows(blocking.block_all(s1, pool), s1, pool, truth).join(ids, "s1_id"))
    out = None
    for fold in (0, 1):
        seen, asked = rows.where(F.col("fold") != fold).drop("fold"), rows.where(F.col("fold") == fold).drop("fold")
        model = matcher.train(seen)
        threshold, _ = matcher.fit_threshold(model, seen, truth, ids.where(F.col("fold") != fold).select("s1_id"))
        matcher.save(model, threshold, f"{scratch.root}/{fold}")
        model, threshold = matcher.load(spark, f"{scratch.root}/{fold}")
        found = assemble.results(matcher.predict(model, asked), asked, ids.where(F.col("fold") == fold).select("s1_id"), threshold)
        out = found if out is None else out.unionByName(found)
    return out


_JOINED = "coalesce(string_agg(distinct {0}, ',' order by {0}), '')"


@query(f"with {BLOCKING_SQL} select entity_id as s1_id, {_JOINED.format('cand_id')} as candidate_entity_ids from s1 left join top on entity_id = s1_id group by 1")
def candidate_table(spark: SparkSession, d: str) -> DataFrame:
    return tsv.joined_ids(_candidates(spark, d), _s1_ids(spark, d), "candidate_entity_ids")


_MATCHED_SQL = BLOCKING_SQL + f""", res as (
  select entity_id as s1_id, country, {_JOINED.format('cand_id')} as candidate_entity_ids,
         coalesce(string_agg(distinct cand_id, ',' order by cand_id) filter (round(tfidf, 9) >= 0.6), '') as matched_entity_ids
  from s1 left join top on entity_id = s1_id group by 1, 2)"""


def _results(spark, d) -> DataFrame:
    found = _candidates(spark, d).withColumn("prob", F.round("tfidf", 9))
    return assemble.results(found, found, _s1_ids(spark, d), 0.6)


@query(f"with {_MATCHED_SQL} select s1_id, candidate_entity_ids, matched_entity_ids from res")
def match_table(spark: SparkSession, d: str) -> DataFrame:
    return _results(spark, d)


def _parts(spark, d, countries: list[list[str]]):
    s1 = views.records(spark, d).where("entity_id like 'S1-%'").select(F.col("entity_id").alias("s1_id"), "country")
    rows = Scratch(spark).put("results", _results(spark, d).join(s1, "s1_id"))
    part = lambda c, column: rows.where(F.col("country").isin(c)).select("s1_id", tsv.id_list(F.col(column)).alias("ids"))
    return [(part(c, "candidate_entity_ids"), part(c, "matched_entity_ids")) for c in countries], s1


@query(f"with {_MATCHED_SQL} select s1_id, candidate_entity_ids, matched_entity_ids from res")
def merge_parts(spark: SparkSession, d: str) -> DataFrame:
    parts, s1 = _parts(spark, d, [["en"], ["de", "es", "fr"]])
    return assemble.merged_text(assemble.merge_parts(parts, s1))


@query(f"""with {_MATCHED_SQL} select s1_id, case when country = 'fr' then '' else candidate_entity_ids end as candidate_entity_ids,
  case when country = 'fr' then '' else matched_entity_ids end as matched_entity_ids from res""")
def abstention_fill(spark: SparkSession, d: str) -> DataFrame:
    parts, s1 = _parts(spark, d, [["en"], ["de", "es"]])
    return assemble.merged_text(assemble.merge_parts(parts, s1, "fr"))


#: What the list of an S1 record says, by its document id modulo 30; of all others it is empty.
PLANTED = {0: "S2-1,S2-1", 3: "S1-3,S2-1", 6: "X-6", 9: " S2-1,,S3-2", 21: "S2-x,S3-2"}
#: Records without a line, with two lines, with a line without a tab, and with a line of another id.
ABSENT, TWICE, UNTABBED, RENAMED = 12, 15, 18, 24


def _planted(spark, d) -> DataFrame:
    """(key, rest, tabbed) lines over all S1 records, faults of each kind among them."""
    ids = _s1_ids(spark, d).withColumn("m", F.substring_index("s1_id", "-", -1).cast("long") % 30).where(F.col("m") != ABSENT)
    rest = F.lit("")
    for m, said in PLANTED.items():
        rest = F.when(F.col("m") == m, said).otherwise(rest)
    key = F.when(F.col("m") == RENAMED, F.concat("s1_id", F.lit("x"))).otherwise(F.col("s1_id"))
    lines = ids.select(key.alias("key"), rest.alias("rest"), (F.col("m") != UNTABBED).alias("tabbed"), "m")
    return lines.unionByName(lines.where(F.col("m") == TWICE)).drop("m")


_PLANTED_SQL = RECORDS_SQL + f""", i as (select entity_id as s1_id, split_part(entity_id, '-', 2)::bigint % 30 as m from r where entity_id like 'S1-%'),
l0 as (select s1_id || case when m = {RENAMED} then 'x' else '' end as key, case m {" ".join(f"when {m} then '{said}'" for m, said in PLANTED.items())} else '' end as rest, m <> {UNTABBED} as tabbed, m from i where m <> {ABSENT}),
l as (select key, rest, tabbed from l0 union all select key, rest, tabbed from l0 where m = {TWICE}),
ok as (select key, case when trim(rest) = '' then [] else string_split(rest, ',') end as ids from l where tabbed), e as (select key, unnest(ids) as id from ok),
found as (
  select 'malformed' as rule, key as x from l where not tabbed union all select 'duplicate_s1', key from ok group by key having count(*) > 1
  union all select 'repeated_id', key from ok where len(ids) <> len(list_distinct(ids)) union all select distinct 'self_match', id from e where id like 'S1-%'
  union all select distinct 'bad_prefix', id from e where id not like 'S1-%' and id not like 'S2-%' and id not like 'S3-%'
  union all select 'missing_s1', s1_id from i where s1_id not in (select key from ok) union all select distinct 'unexpected_s1', key from ok where key not in (select s1_id from i)
  union all select distinct 'unknown_id', id from e where (id like 'S2-%' or id like 'S3-%') and id not in (select entity_id from r)),
rules as (select unnest(['malformed', 'duplicate_s1', 'repeated_id', 'self_match', 'bad_prefix', 'missing_s1', 'unexpected_s1', 'unknown_id']) as rule)"""


@query(f"""with {_PLANTED_SQL} select rules.rule, count(x) as n, coalesce(array_to_string(list_sort(list(distinct x) filter (x is not null))[1:5], ','), '') as examples
from rules left join found on rules.rule = found.rule group by 1""")
def validator_report(spark: SparkSession, d: str) -> DataFrame:
    valid = views.records(spark, d).where("entity_id not like 'S1-%'").select(F.col("entity_id").alias("id"))
    return validate.check_rows(_planted(spark, d), _s1_ids(spark, d), valid).select("rule", "n", F.array_join("examples", ",").alias("examples"))


def _source_folder(spark, d) -> str:
    """The records as three tab-separated files of a test set, in a folder of their own."""
    folder = Scratch(spark).root
    for i in (1, 2, 3):
        rows = views.records(spark, d).where(F.col("entity_id").startswith(f"S{i}-")).select(tsv.RECORD_COLUMNS)
        quoted = [F.concat(F.lit('"'), F.replace(F.col(c), F.lit('"'), F.lit('""')), F.lit('"')) for c in tsv.RECORD_COLUMNS]
        write_text(rows.select(F.concat_ws("\t", *quoted).alias("value")), f"{folder}/test_source{i}.tsv", "\t".join(tsv.RECORD_COLUMNS))
    return folder


@query(f"with {RECORDS_SQL} select entity_id, business_name, business_address, country from r")
def source_files(spark: SparkSession, d: str) -> DataFrame:
    """The records, written as files and loaded again."""
    folder = _source_folder(spark, d)
    one, two, three = (tsv.load_source(spark, f"{folder}/test_source{i}.tsv") for i in (1, 2, 3))
    return one.unionByName(two).unionByName(three)


_LISTS_SQL = f"with {NORMALISED_SQL} select s1_id, array_to_string(matched, ',') as matched from lists"


def _truth_file(spark, d) -> str:
    path = f"{Scratch(spark).root}/train_ground_truth.tsv"
    tsv.write_tsv(views.truth(spark, d), _s1_ids(spark, d), path, validate.MATCH_HEADER)
    return path


@query(_LISTS_SQL)
def truth_file(spark: SparkSession, d: str) -> DataFrame:
    """The true matches, written as a file and loaded again."""
    return tsv.load_ground_truth(spark, _truth_file(spark, d)).select("s1_id", F.array_join("matched", ",").alias("matched"))


@query(f"with {NORMALISED_SQL} select l.s1_id as key, array_to_string(matched, ',') as rest from lists l join s1 on s1_id = entity_id where country = 'en'")
def fetched_lines(spark: SparkSession, d: str) -> DataFrame:
    """Raw lines of a file of lists, fetched by the ids of one country."""
    ids = sampling.by_country(views.records(spark, d).where("entity_id like 'S1-%'"), "en")
    return tsv.fetch(tsv.read_lines(spark, _truth_file(spark, d)), ids, "entity_id").select("key", "rest")


@query(f"with {NORMALISED_SQL} select s1_id, array_to_string(matched, ',') as candidates, array_to_string(matched, ',') as matches from lists")
def part_files(spark: SparkSession, d: str) -> DataFrame:
    """Lists written as headerless part files of each country, read and merged again."""
    folder = Scratch(spark).root
    s1 = views.records(spark, d).where("entity_id like 'S1-%'").select(F.col("entity_id").alias("s1_id"), "country")
    pairs = views.truth(spark, d)
    tsv.write_part_files(pairs, pairs, s1, folder)
    merged = assemble.merge_parts([tsv.read_part_folder(spark, folder)], s1)
    return merged.select("s1_id", *[F.array_join(c, ",").alias(c) for c in ("candidates", "matches")])


@query(f"""with {RECORDS_SQL}, g as (select unnest(['en', 'de']) as config), p as (select unnest(['train', 'val']) as name)
select config, name, (select count(*) from r where country = config and (entity_id like 'S1-%') = (name = 'train')) as n from g, p""")
def resumed_stages(spark: SparkSession, d: str) -> DataFrame:
    """Two results under one configuration and then under another, asked twice: each holds what its own configuration makes."""
    folder, rows, found = Scratch(spark).root, views.records(spark, d), []
    for config in ("en", "de", "de"):
        stage = tsv.Stage(spark, folder, {"country": config})
        for name, like in (("train", "entity_id like 'S1-%'"), ("val", "entity_id not like 'S1-%'")):
            found.append((config, name, stage.get(name, lambda: sampling.by_country(rows, config).where(like)).count()))  # noqa: B023
    return spark.createDataFrame(found, "config string, name string, n long").distinct()


@query("select * from (values ('planted', 1, 8, 1), ('right', 0, 0, 1), ('commas', 1, 1, 0)) as t(file, exit_code, n_errors, n_warnings)")
def checked_files(spark: SparkSession, d: str) -> DataFrame:
    """Files of an output, checked as a whole: one with a fault of each kind, a right one, and one with commas."""
    folder = _source_folder(spark, d)
    planted, right, commas = (f"{folder}/{n}.tsv" for n in ("planted", "right", "commas"))
    write_text(_planted(spark, d).select(F.when(F.col("tabbed"), F.concat("key", F.lit("\t"), "rest")).otherwise(F.col("key")).alias("value")), planted, "\t".join(validate.MATCH_HEADER))
    tsv.write_tsv(views.truth(spark, d), _s1_ids(spark, d), right, validate.MATCH_HEADER)
    write_text(_s1_ids(spark, d).select(F.concat("s1_id", F.lit(",")).alias("value")), commas, ",".join(validate.MATCH_HEADER))
    found = [(n, validate.validate(spark, path, None, folder, check_ids=True)) for n, path in (("planted", planted), ("right", right), ("commas", commas))]
    return spark.createDataFrame([(n, v.exit_code, len(v.errors), len(v.warnings)) for n, v in found], "file string, exit_code int, n_errors int, n_warnings int")


@query(f"""with {RECORDS_SQL}, i as (select entity_id as s1_id, country, row_number() over (order by md5('42:' || entity_id), entity_id) <= 100 as val from r where entity_id like 'S1-%')
select s1_id, case when val then 'val' else 'train' end as part from i where (not val and country in ('en', 'de')) or (val and country = 'fr')""")
def leave_country_out(spark: SparkSession, d: str) -> DataFrame:
    """A split whose validation part holds a country that training never sees."""
    parts = sampling.split(views.records(spark, d).where("entity_id like 'S1-%'").select(F.col("entity_id").alias("s1_id"), "country"), 100)
    train, val = sampling.by_country(parts.where("part = 'train'"), "en,de"), sampling.by_country(parts.where("part = 'val'"), "fr")
    return train.unionByName(val).select("s1_id", "part")


@query(f"with {_LABELLED_SQL} select count(*) as n_pairs, count(*) filter (label = 1) as n_positive, round(coalesce(avg(label), 0), 6) as pos_rate from lab")
def pair_totals(spark: SparkSession, d: str) -> DataFrame:
    return profile.pair_totals(_labelled(spark, d)).withColumn("pos_rate", F.round("pos_rate", 6))


@query(f"""with {NORMALISED_SQL}, m as (select s1_id, cand_id from truth where cand_id like 'S2-%' union all select entity_id, 'S2-0' from s1),
o as (select distinct s1_id from m where (s1_id, cand_id) not in (select s1_id, cand_id from truth))
select 'outside_candidates' as rule, count(*) as n, array_to_string(list_sort(list(s1_id))[1:5], ',') as examples from o""")
def outside_candidates(spark: SparkSession, d: str) -> DataFrame:
    """S1 records with a match that is not among their candidates."""
    ids, truth = _s1_ids(spark, d), views.truth(spark, d)
    matches = truth.where("cand_id like 'S2-%'").unionByName(ids.withColumn("cand_id", F.lit("S2-0")))
    lines = lambda pairs: tsv.joined_ids(pairs, ids, "rest").select(F.col("s1_id").alias("key"), "rest")
    return validate.outside_candidates(lines(matches), lines(truth)).select("rule", "n", F.array_join("examples", ",").alias("examples"))
