"""Helpers that the operators of this package share.

Columns that an operator adds on its way start with ``__wl_``, so extra
columns of the caller never clash with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftline.sources.files import Scratch, shared_dir

__all__ = ["SEPARATORS", "WORD", "Scratch", "components", "cut", "running_total", "shared_dir", "words"]

#: What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
SEPARATORS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of a text in order; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder, which goes with its application.

    Its columns are new ones, so it can be joined with what it was made from.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True).select([F.col(f"`{c}`").alias(c) for c in df.columns])


def running_total(df: DataFrame, keys: list[str], bucket: str, order: list[str], value: str, out: str) -> DataFrame:
    """Adds the sum of ``value`` over the earlier rows of the same keys (not null), in the order (bucket, order).

    Each window task holds one bucket only; the sums of whole buckets are
    added by a second window over one row per bucket. A hot key is thus
    spread over as many tasks as it has buckets.
    """
    inner = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    before = (
        df.groupBy(*keys, bucket)
        .agg(F.sum(value).alias("__wl_sum"))
        .withColumn("__wl_before", F.coalesce(F.sum("__wl_sum").over(outer), F.lit(0)))
        .drop("__wl_sum")
    )
    same = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in [*keys, bucket]]
    local = df.withColumn("__wl_local", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    joined = local.alias("a").join(before.alias("b"), cond)
    return joined.select("a.*", (F.col("a.__wl_local") + F.col("b.__wl_before")).alias(out)).drop("__wl_local")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): root is the smallest node that it reaches.

    Large-star and small-star steps by turns: every step keeps at most as many
    edges as there were and connects the same nodes, until each node hangs on
    its root. Minima are pre-aggregated before they are shuffled and hot nodes
    meet them in a join that Spark can split, so no task holds a star.
    """

    def minima(df: DataFrame) -> DataFrame:
        return df.groupBy("a").agg(F.min("b").alias("m"))

    def tally(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = tally(now)
    while seen[0]:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = minima(both).select("a", F.least("a", "m").alias("m"))
        large = both.join(near, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        joined = large.join(minima(large), "a")
        small = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(minima(large).select("a", F.col("m").alias("b")))
        now = cut(small.where("a <> b").distinct())
        last, seen = seen, tally(now)
        if seen == last:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
