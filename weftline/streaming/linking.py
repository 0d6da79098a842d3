"""Linking a stream of S1 records against a fixed pool, one micro-batch at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions.text import normalised
from weftline.operators import blocking
from weftline.sources import files


def link_stream(stream: DataFrame, pool: DataFrame, out: str, checkpoint: str, k: int = 30, max_features: int = 300_000, min_df: int = 2):
    """Writes candidates of each arriving record to ``out``, in a folder per batch, so a repeated batch replaces itself.

    The index of the pool by country is written once beside the results and read by every batch; that of the
    whole pool, for records of other countries, when the first of them arrives.
    """
    spark = pool.sparkSession

    def index(place: str, rows: DataFrame) -> None:
        terms, weights = blocking.build_index(rows, max_features, min_df)
        terms.write.mode("overwrite").parquet(f"{place}/terms")
        weights.write.mode("overwrite").partitionBy("shard").parquet(f"{place}/weights")

    def asked(place: str, queries: DataFrame) -> DataFrame:
        weights = spark.read.parquet(f"{place}/weights").withColumn("shard", F.coalesce(F.col("shard").cast("string"), F.lit("")))
        return blocking.query_topk(spark.read.parquet(f"{place}/terms"), weights, queries, k)

    base, known, whole = normalised(pool), f"{out}/index/country", f"{out}/index/everywhere"
    index(known, base.withColumn("shard", F.col("country")))
    base.select("country").distinct().write.mode("overwrite").parquet(f"{out}/index/countries")
    files.delete(spark, whole)

    def batch(records: DataFrame, batch_id: int) -> None:
        countries = spark.read.parquet(f"{out}/index/countries").withColumn("__known", F.lit(True))
        queries = normalised(records).join(countries, "country", "left")
        here, strange = queries.where("__known").withColumn("shard", F.col("country")), queries.where("__known is null").withColumn("shard", F.lit(blocking.EVERYWHERE))
        found = asked(known, here)
        if not strange.isEmpty():
            if not files.exists(spark, f"{whole}/weights/_SUCCESS"):  # the index of the whole pool: made when first wanted
                index(whole, base.withColumn("shard", F.lit(blocking.EVERYWHERE)))
            found = found.unionByName(asked(whole, strange))
        found.write.mode("overwrite").parquet(f"{out}/candidates/batch={batch_id}")

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
