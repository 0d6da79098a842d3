"""The driver's tables seen as record-linkage inputs, in Spark and as DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions import tables
from weftline.functions.text import normalised


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as records of three sources by doc_id: the first words are name and address; k tells true matches."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", F.array_remove(F.split("text", r"[ \n\t]+"), "").alias("w"))
    w = F.col("w")
    part = lambda a, n: F.array_join(F.slice(w, a, n), " ")
    source = F.when(F.col("doc_id") % 3 == 0, "S1-").when(F.col("doc_id") % 3 == 1, "S2-").otherwise("S3-")
    return docs.select(
        F.concat(source, F.col("doc_id").cast("string")).alias("entity_id"),
        part(1, 6).alias("business_name"),
        F.concat((100 + F.length(part(1, 6))).cast("string"), F.lit(" "), part(7, 8), F.lit(" rd "), (10000 + F.length(part(1, 12))).cast("string")).alias("business_address"),
        F.col("lang").alias("country"),
        F.lower(part(1, 12)).alias("k"),
    )


def sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(S1, S2 and S3), normalised."""
    rows = normalised(records(spark, sf_dir))
    return rows.where("entity_id like 'S1-%'"), rows.where("entity_id not like 'S1-%'")


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s1_id, cand_id) of equal k and country."""
    rows = records(spark, sf_dir)
    a = rows.where("entity_id like 'S1-%'").select(F.col("entity_id").alias("s1_id"), "k", "country")
    b = rows.where("entity_id not like 'S1-%'").select(F.col("entity_id").alias("cand_id"), "k", "country")
    return a.join(b, ["k", "country"]).select("s1_id", "cand_id")


def truth_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s1_id, matched array), singletons included."""
    lists = truth(spark, sf_dir).groupBy("s1_id").agg(F.collect_set("cand_id").alias("m"))
    ids = records(spark, sf_dir).where("entity_id like 'S1-%'").select(F.col("entity_id").alias("s1_id"))
    return ids.join(lists, "s1_id", "left").select("s1_id", F.coalesce("m", F.array().cast("array<string>")).alias("matched"))


def _quoted(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def sql_clean(x: str) -> str:
    return f"trim(regexp_replace(replace(lower(strip_accents({x})), '&', ' and '), '[^a-z0-9]+', ' ', 'g'))"


_EXPAND = " ".join(f"when '{k}' then '{v}'" for k, v in tables.ADDRESS_WORDS.items() if k not in tables.US_STATES)

RECORDS_SQL = r"""w as (
  select doc_id, lang, list_filter(string_split_regex(text, '[ \n\t]+'), lambda x: x <> '') as w from documents
), r as (
  select (case doc_id % 3 when 0 then 'S1-' when 1 then 'S2-' else 'S3-' end) || doc_id as entity_id,
         array_to_string(w[1:6], ' ') as business_name,
         (100 + length(array_to_string(w[1:6], ' ')))::varchar || ' ' || array_to_string(w[7:14], ' ') || ' rd '
           || (10000 + length(array_to_string(w[1:12], ' ')))::varchar as business_address,
         lang as country, lower(array_to_string(w[1:12], ' ')) as k
  from w
)"""

NORMALISED_SQL = RECORDS_SQL + rf""", n0 as (
  select *, {sql_clean("business_name")} as name_clean, {sql_clean("business_address")} as addr_clean,
         regexp_extract_all(business_address, '\d{{4,}}') as runs from r
), n1 as (
  select *, list_filter(string_split(name_clean, ' '), lambda x: x <> '') as name_tokens,
         list_filter(string_split(addr_clean, ' '), lambda x: x <> '') as atok,
         list_filter(runs, lambda x: length(x) in (5, 6)) as usual from n0
), n2 as (
  select *, list_filter(name_tokens, lambda x: x not in ({_quoted(tables.LEGAL_TOKENS)})) as core0,
         list_transform(atok, lambda x: case x {_EXPAND} else x end) as addr_tokens,
         coalesce(usual[len(usual)], list_filter(runs, lambda x: length(x) = list_max(list_transform(runs, lambda y: length(y))))[1], '') as zip,
         case when regexp_matches(atok[1], '^[0-9]+$') then atok[1] else '' end as house from n1
), n3 as (
  select *, case when len(core0) = 0 then name_tokens else core0 end as name_core from n2
), n as (
  select *, list_concat(list_concat(list_concat(name_core, name_core), list_concat(name_tokens, addr_tokens)),
                        case when zip = '' then [] else [zip, zip] end) as block from n3
), s1 as (select * from n where entity_id like 'S1-%'), s23 as (select * from n where entity_id not like 'S1-%'),
truth as (select s1.entity_id as s1_id, s23.entity_id as cand_id from s1 join s23 on s1.k = s23.k and s1.country = s23.country),
lists as (
  select entity_id as s1_id, coalesce(list(cand_id order by cand_id) filter (cand_id is not null), []) as matched
  from s1 left join truth on entity_id = s1_id group by entity_id
)"""


def tfidf_sql(queries: str, pool: str, tokens: str = "block", k: int = 30, max_features: int = 300_000, min_df: int = 2) -> str:
    """CTEs up to top(s1_id, cand_id, tfidf, rank) for tables with shard, entity_id and a token list."""
    grams = f"list_concat(g, list_transform(range(1, len(g)), lambda i: g[i] || ' ' || g[i + 1]))"

    def counted(name: str, source: str) -> str:
        return f"""{name}_g as (select shard, entity_id, list_filter({tokens}, lambda x: length(x) >= 2) as g from {source}),
{name}_t as (select shard, entity_id, unnest({grams}) as term from {name}_g),
{name} as (select shard, entity_id, term, count(*) as tf from {name}_t group by all)"""

    def weighed(name: str, counts: str) -> str:
        return f"""{name}_w as (select c.shard, c.entity_id, c.term, (1 + ln(tf)) * idf as w from {counts} c join vocab v on c.shard = v.shard and c.term = v.term),
{name} as (select shard, entity_id, term, w / sqrt(sum(w * w) over (partition by shard, entity_id)) as w from {name}_w)"""

    return f"""{counted("pc", pool)},
{counted("qc", queries)},
docs as (select shard, count(distinct entity_id) as nd from {pool} group by shard),
v0 as (select shard, term, count(*) as df, sum(tf)::bigint as total from pc group by all having count(*) >= {min_df}),
v1 as (select *, row_number() over (partition by shard order by total desc, term) as vr from v0),
vocab as (select v1.shard, term, df, total, ln((1.0 + nd) / (1.0 + df)) + 1.0 as idf from v1 join docs on v1.shard = docs.shard where vr <= {max_features}),
{weighed("pw", "pc")},
{weighed("qw", "qc")},
scores as (select q.entity_id as s1_id, p.entity_id as cand_id, sum(q.w * p.w) as tfidf from qw q join pw p on q.shard = p.shard and q.term = p.term group by all),
top as (
  select * from (select *, row_number() over (partition by s1_id order by round(tfidf, 9) desc, cand_id) as rank from scores where tfidf > 0) where rank <= {k}
)"""


BLOCKING_SQL = NORMALISED_SQL + """, q as (select *, country as shard from s1), p as (select *, country as shard from s23),
""" + tfidf_sql("q", "p")
