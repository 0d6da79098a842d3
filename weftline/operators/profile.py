"""Exploratory counts of sources and ground truth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions.text import is_ascii


def match_histogram(truth: DataFrame) -> DataFrame:
    """(n_matches, n): S1 records by number of matches; truth is (s1_id, matched array)."""
    return truth.groupBy(F.size("matched").alias("n_matches")).agg(F.count(F.lit(1)).alias("n"))


def match_summary(truth: DataFrame) -> DataFrame:
    """One row: records, singletons, mean matches of the others, references to S2 and to other sources, largest set."""
    n = F.size("matched")
    refs = F.size(F.filter("matched", lambda x: x.startswith("S2-")))
    return truth.agg(
        F.count(F.lit(1)).alias("n_s1"), F.count_if(n == 0).alias("n_singletons"), F.avg(F.when(n > 0, n)).alias("mean_matches"),
        F.coalesce(F.sum(refs), F.lit(0)).alias("s2_refs"), F.coalesce(F.sum(n - refs), F.lit(0)).alias("s3_refs"), F.max(n).alias("max_matches"),
    )


def country_mix(records: DataFrame, top: int = 10) -> DataFrame:
    """(country, n): the most frequent values, ties by name; records without the column's value count as <missing>."""
    return records.groupBy(F.coalesce("country", F.lit("<missing>")).alias("country")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "country").limit(top)


def multi_owner(pairs: DataFrame) -> DataFrame:
    """(source, n_ids, n_multi, max_refs): ids that several S1 records refer to; what is not S2 counts as S3."""
    owners = pairs.groupBy("cand_id").agg(F.count(F.lit(1)).alias("refs"))
    source = F.when(F.col("cand_id").startswith("S2-"), "S2").otherwise("S3")
    return owners.groupBy(source.alias("source")).agg(F.count(F.lit(1)).alias("n_ids"), F.count_if(F.col("refs") > 1).alias("n_multi"), F.max("refs").alias("max_refs"))


def source_coverage(truth: DataFrame) -> DataFrame:
    """(n_both, n_only_s2, n_only_s3) of records with matches."""
    s2, s3 = (F.exists("matched", lambda x: F.contains(x, F.lit(f"{p}-"))) for p in ("S2", "S3"))
    return truth.agg(F.count_if(s2 & s3).alias("n_both"), F.count_if(s2 & ~s3).alias("n_only_s2"), F.count_if(~s2 & s3).alias("n_only_s3"))


def script_mix(pairs: DataFrame, s1: DataFrame, pool: DataFrame) -> DataFrame:
    """Counts over true pairs: names in ASCII, addresses that are empty; S1 counts are per record."""
    a = s1.select(F.col("entity_id").alias("s1_id"), F.col("business_name").alias("na"), F.col("business_address").alias("aa"))
    b = pool.select(F.col("entity_id").alias("cand_id"), F.col("business_name").alias("nb"), F.col("business_address").alias("ab"))
    rows = pairs.join(a, "s1_id").join(b, "cand_id", "left").withColumns({"nb": F.coalesce("nb", F.lit("")), "ab": F.coalesce("ab", F.lit(""))})
    one = F.col("first") == 1
    first = rows.groupBy("s1_id").agg(F.min("cand_id").alias("cand_id"), F.lit(1).alias("first"))
    rows = rows.join(first, ["s1_id", "cand_id"], "left")
    return rows.agg(
        F.count(F.lit(1)).alias("n_pairs"), F.count_if(one & ~is_ascii(F.col("na"))).alias("s1_nonascii"), F.count_if(one & (F.trim("aa") == "")).alias("s1_addr_empty"),
        F.count_if(is_ascii(F.col("nb"))).alias("match_name_ascii"), F.count_if(~is_ascii(F.col("nb"))).alias("match_name_nonascii"),
        F.count_if(is_ascii(F.col("na")) & is_ascii(F.col("nb"))).alias("both_ascii"), F.count_if(F.trim("ab") == "").alias("match_addr_empty"),
    )


def examples(truth: DataFrame, s1: DataFrame, pool: DataFrame, n: int = 6, seed: int = 42) -> DataFrame:
    """The records of n S1 ids with matches, with those of their matches."""
    from weftline.operators.sampling import sample

    chosen = sample(truth.where(F.size("matched") > 0).select("s1_id"), n, seed)
    pairs = truth.join(chosen, "s1_id", "left_semi").select("s1_id", F.explode("matched").alias("cand_id"))
    columns = ["business_name", "business_address", "country"]
    a = s1.select(F.col("entity_id").alias("s1_id"), *[F.col(c).alias(f"s1_{c}") for c in columns])
    return pairs.join(a, "s1_id").join(pool.select(F.col("entity_id").alias("cand_id"), *columns), "cand_id", "left")


def pair_totals(labelled: DataFrame) -> DataFrame:
    """(n_pairs, n_positive, pos_rate) of labelled pairs; the rate is 0 without pairs."""
    n, p = F.count(F.lit(1)), F.count_if(F.col("label") == 1)
    return labelled.agg(n.alias("n_pairs"), p.alias("n_positive"), F.when(n == 0, F.lit(0.0)).otherwise(p / n).alias("pos_rate"))
