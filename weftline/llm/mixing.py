"""Mixing sources to target weights.

Each source's documents, in a pseudorandom order, are one stream of words
that is packed into blocks of a fixed length. The mix is a sequence of slots
for blocks, in output shards. Every shard draws how many of its slots go to
each source from a multinomial distribution. A source's slots are numbered
through all shards, and a slot's number is mapped through the source's
pseudorandom permutation of block indexes, a new one for each pass over the
source; blocks and slots are joined by index.

Multinomial totals stray from the targets by their own deviation. The few
slots that a source draws beyond its exact number go to the sources that
lack some, so no source gets more passes than its target allows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftline.llm.common import WORD, cut, running_total, words

WEIGHTS = (5, 2, 1)
MOST_PASSES = 3
#: Sources whose numbers a task holds as arrays; 24 bytes for each source.
MOST_SOURCES = 1_000_000
LEAST_BUCKET = 2_000
SHARDS_PER_BUCKET = 4096


def water_fill(sources: DataFrame, most: float = MOST_PASSES) -> DataFrame:
    """Adds ``target``: shares of all sizes by ``weight``, at most ``most`` times the source's ``size``.

    Sources are capped in the order of cap over weight. Of the prefixes of
    that order, the right one is the first after which no share is above its
    cap; what the capped ones leave is shared by weight. Long sums and one
    division keep the result the same in whatever order rows arrive.
    """
    order = Window.orderBy((F.col("size") / F.col("weight")), "rank")
    whole = Window.partitionBy()
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    step = sources.select(
        "*",
        F.coalesce(F.sum("size").over(upto), F.lit(0)).alias("__wl_capped"),
        F.coalesce(F.sum("weight").over(upto), F.lit(0)).alias("__wl_weight"),
        F.sum("size").over(whole).alias("__wl_all"),
        F.sum("weight").over(whole).alias("__wl_weights"),
    )
    level = (F.col("__wl_all") - most * F.col("__wl_capped")) / (F.col("__wl_weights") - F.col("__wl_weight"))
    step = step.withColumn("__wl_level", level)
    fits = F.col("__wl_level") * F.col("weight") <= most * F.col("size")
    step = step.withColumn("__wl_share", F.first(F.when(fits, F.col("__wl_level")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    cap = (most * F.col("size")).cast("double")
    target = F.when(F.col("__wl_all") == 0, F.lit(0.0)).otherwise(F.least(cap, F.col("weight") * F.col("__wl_share")))
    return step.select(*sources.columns, target.cast("double").alias("target"))


def _mix64(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def permuted(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A pseudorandom permutation of 0..n-1 for each key: a four-round Feistel network that walks its cycles back into range."""
    index, n, key = (np.asarray(x).astype(np.uint64) for x in (index, n, key))
    bits = np.ceil(np.log2(np.maximum(n.astype(np.float64), 2.0)) / 2).astype(np.uint64)
    bits += ((np.uint64(1) << (bits * np.uint64(2))) < n).astype(np.uint64)
    low = (np.uint64(1) << bits) - np.uint64(1)
    out, todo = index.copy(), np.ones(len(index), dtype=bool)
    while todo.any():
        b, mask, k = bits[todo], low[todo], key[todo]
        left, right = out[todo] >> b, out[todo] & mask
        for r in range(4):
            with np.errstate(over="ignore"):
                f = _mix64(right * np.uint64(0x9E3779B97F4A7C15) + k + np.uint64(r) * np.uint64(0xD1B54A32D192ED03))
            left, right = right, left ^ (f & mask)
        out[todo] = (left << b) | right
        todo = out >= n
    return out.astype(np.int64)


def plan_sources(docs: DataFrame, source: str, size: str, block_words: int, weights=WEIGHTS, most: float = MOST_PASSES) -> DataFrame:
    """One row per source: rank by code point (null last), size, weight, target, words of a block, number of blocks and of slots.

    A source of fewer than block_words ** 2 words has shorter blocks, down to
    one word, so that its target is met to a hundredth or to a word.
    """
    counted = cut(docs.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("size"), F.count(F.lit(1)).alias("n_docs")))
    if counted.count() > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources: weights for so many have no meaning; group them first")
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    sources = counted.withColumn("rank", rank)
    weight = F.get(F.array(*[F.lit(w) for w in weights]), F.pmod(F.col("rank"), F.lit(len(weights))))
    filled = water_fill(sources.withColumn("weight", weight.cast("bigint")), most)
    block = F.greatest(F.lit(1), F.least(F.lit(block_words), F.floor(F.col("size") / F.lit(block_words)))).cast("bigint")
    blocks = F.ceil(F.col("size") / F.col("words"))
    slots = F.when(F.col("size") > 0, F.least(F.round(F.col("target") * blocks / F.col("size")), F.floor(most * blocks))).otherwise(F.lit(0))
    return filled.withColumn("words", block).withColumn("n_blocks", blocks.cast("bigint")).withColumn("n_slots", slots.cast("bigint"))


#: Columns that the mix adds; columns of docs with these names are replaced.
ADDED = ("source_size", "target", "start", "block", "from_word", "to_word", "shard", "slot", "epoch")


def mix(docs: DataFrame, source: str = "source", size: str = "size", order: str = "doc_id", block_words: int = 64, shard_slots: int = 1024, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """The mix of ``docs`` (with a long ``size`` in words) as (fragments, sources).

    fragments: one row for each piece of a document that a slot takes: the
    columns of docs and ADDED: source_size, target, start (where the document
    begins in its source's stream), block, from_word, to_word (words of the
    document, the end not included), shard, slot and epoch (how many whole
    passes came before, 0 to 2); a document that no slot takes, an empty one
    included, has one row with null slot. sources: see ``plan_sources``. A null
    source is a source of its own; repeated rows are documents of their own; an
    empty table gives no rows; a long document is cut into blocks like any
    other. The same seed gives the same mix, but rows whose ``order`` values
    tie within a source may trade places: give ties that differ an order.
    """
    if {source, size, order} & set(ADDED):
        raise ValueError(f"source, size and order have names other than {ADDED}")
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ADDED])
    spark = docs.sparkSession
    sources = cut(plan_sources(docs, source, size, block_words))
    rows = sources.orderBy("rank").select("rank", "n_blocks", "n_slots").toPandas()  # MOST_SOURCES rows at most
    slots = _slots(spark, rows, shard_slots, seed)

    few = sources.select(F.col("source").alias("__wl_source"), F.col("size").alias("source_size"), "target", F.col("rank").alias("__wl_rank"), F.col("n_docs").alias("__wl_docs"), F.col("words").alias("__wl_words"))
    few = F.broadcast(few) if len(rows) <= 10_000 else few
    placed = docs.join(few, F.col(source).eqNullSafe(F.col("__wl_source"))).drop("__wl_source")
    buckets = F.ceil(F.col("__wl_docs") / F.greatest(F.lit(float(LEAST_BUCKET)), F.sqrt("__wl_docs"))).cast("bigint")
    shuffled = F.xxhash64(F.lit(seed), F.col(order).cast("string"))
    placed = placed.withColumn("__wl_order", shuffled).withColumn("__wl_bucket", F.pmod("__wl_order", buckets)).drop("__wl_docs")
    placed = running_total(placed, ["__wl_rank"], "__wl_bucket", ["__wl_order", order], size, "start").drop("__wl_bucket", "__wl_order")

    first = F.floor(F.col("start") / F.col("__wl_words")).cast("bigint")
    last = F.floor((F.col("start") + F.col(size) - 1) / F.col("__wl_words")).cast("bigint")
    # A document longer than many blocks: its block numbers are made in two steps, so no row holds them all.
    run = 4096
    runs = F.when(F.col(size) > 0, F.sequence(F.floor(first / F.lit(run)), F.floor(last / F.lit(run))))
    inside = F.explode_outer(F.when(F.col("__wl_run").isNotNull(), F.sequence(F.greatest(first, F.col("__wl_run") * run), F.least(last, F.col("__wl_run") * run + run - 1))))
    pieces = placed.withColumn("__wl_run", F.explode_outer(runs)).withColumn("block", inside).drop("__wl_run")
    pieces = pieces.withColumn("from_word", F.greatest(F.lit(0), F.col("block") * F.col("__wl_words") - F.col("start")))
    pieces = pieces.withColumn("to_word", F.least(F.col(size), (F.col("block") + 1) * F.col("__wl_words") - F.col("start")))
    slots = slots.withColumnsRenamed({"rank": "__wl_r2", "block": "__wl_block"})
    joined = pieces.join(slots.hint("merge"), (F.col("__wl_rank") == F.col("__wl_r2")) & (F.col("block") == F.col("__wl_block")), "left")
    return joined.drop("__wl_r2", "__wl_block", "__wl_rank", "__wl_words"), sources


def _slots(spark, sources: pd.DataFrame, shard_slots: int, seed: int) -> DataFrame:
    """(shard, slot, rank, block, epoch): which block of which source each slot takes."""
    wanted = sources["n_slots"].to_numpy(np.int64)
    blocks = sources["n_blocks"].to_numpy(np.int64)
    total = int(wanted.sum())
    shards = -(-total // shard_slots)
    share = wanted / max(total, 1)

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for shard in batch["id"]:
                n = min(shard_slots, total - shard * shard_slots)
                counts = np.random.Generator(np.random.Philox(key=[seed, shard])).multinomial(n, share)
                rank = np.flatnonzero(counts)
                begin = np.cumsum(counts[rank]) - counts[rank] + shard * shard_slots
                found.append(pd.DataFrame({"shard": shard, "rank": rank, "n": counts[rank], "first_slot": begin}))
            if found:
                yield pd.concat(found)

    tasks = max(1, min(shards, -(-shards // 64)))
    drawn = cut(spark.range(0, shards, 1, tasks).mapInPandas(draw, "shard long, rank long, n long, first_slot long"))
    got = np.zeros(len(wanted), np.int64)
    for rank, n in drawn.groupBy("rank").agg(F.sum("n")).collect():  # one row per source, bounded above
        got[rank] = n
    over, under = np.maximum(got - wanted, 0), np.maximum(wanted - got, 0)
    over_at, under_end = np.cumsum(over) - over, np.cumsum(under)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lo in range(0, len(batch), 256):
                b = batch.iloc[lo : lo + 256]
                n = b["n"].to_numpy()
                step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                rank = np.repeat(b["rank"].to_numpy(), n)
                number = np.repeat(b["before"].to_numpy(), n) + step
                slot = np.repeat(b["first_slot"].to_numpy(), n) + step
                spare = np.flatnonzero(number >= wanted[rank])
                e = over_at[rank[spare]] + number[spare] - wanted[rank[spare]]
                to = np.searchsorted(under_end, e, side="right")
                number[spare] = got[to] + e - (under_end[to] - under[to])
                rank[spare] = to
                epoch, index = np.divmod(number, blocks[rank])
                key = _mix64((np.uint64(seed) << np.uint64(40)) ^ (rank.astype(np.uint64) << np.uint64(8)) ^ epoch.astype(np.uint64))
                yield pd.DataFrame({"shard": np.repeat(b["shard"].to_numpy(), n), "slot": slot, "rank": rank, "block": permuted(index, blocks[rank], key), "epoch": epoch})

    bucket = F.floor(F.col("shard") / F.lit(SHARDS_PER_BUCKET)).cast("bigint")
    numbered = running_total(drawn.withColumn("__wl_bucket", bucket), ["rank"], "__wl_bucket", ["shard"], "n", "before")
    dealt = numbered.select("shard", "rank", "n", "first_slot", "before").repartition(tasks, "shard")
    return dealt.mapInPandas(place, "shard long, slot long, rank long, block long, epoch long")


def sized(docs: DataFrame, text: str = "text", out: str = "size") -> DataFrame:
    """Adds the number of words; a null text has none."""
    return docs.withColumn(out, F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint"))


def taken(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """One row per document of the mix: ``keys``, which tell the documents apart, and taken, its words in all slots, repeats counted."""
    words = F.coalesce(F.sum(F.when(F.col("slot").isNotNull(), F.col("to_word") - F.col("from_word"))), F.lit(0))
    return pieces.groupBy(*keys).agg(words.cast("bigint").alias("taken"))


def word_counts(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", **options) -> DataFrame:
    """doc_id, size, source_size, target and taken of each row.

    Sizes are words, 0 for null and empty texts. Documents are told apart by a
    number that a checkpoint fixes, and ordered by id and text, so reruns agree
    whatever repeats. Other columns are left out.
    """
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("text"))
    place = F.to_json(F.struct(F.col("doc_id").cast("string").alias("i"), F.xxhash64("text").alias("h")))
    rows = cut(sized(slim).select("doc_id", "source", "size", place.alias("__wl_place"), F.monotonically_increasing_id().alias("__wl_row")))
    pieces, _ = mix(rows, order="__wl_place", **options)
    found = taken(pieces, ["__wl_row", "doc_id", "size", "source_size", "target"])
    return found.select(F.col("doc_id").alias(doc_id), "size", "source_size", "target", "taken")


def mixed_texts(docs: DataFrame, text: str = "text", source: str = "source", order: str = "doc_id", **options) -> DataFrame:
    """The mix as documents: a row for each document and pass, with the words that the pass takes.

    A document that a pass takes whole keeps its text as it is; of others, the
    words taken are joined by one space, in their order. Empty documents and
    those that no slot takes have no row. Other columns pass through.
    """
    # Texts stay out of the mix: rows meet again by two hashes of the whole row, equal for equal rows only.
    columns = [F.col(f"`{c}`") for c in docs.columns]
    row = F.struct(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).alias("__wl_r")
    t, src, by = (F.col(f"__wl_r.c{docs.columns.index(c)}") for c in (text, source, order))
    keyed = docs.select(F.xxhash64(*columns).alias("__wl_k1"), F.xxhash64(F.lit(1), *columns).alias("__wl_k2"), row)
    slim = sized(keyed.select("__wl_k1", "__wl_k2", src.alias("__wl_src"), by.cast("string").alias("__wl_by"), t.alias("__wl_t")), "__wl_t", "__wl_size")
    slim = slim.groupBy("__wl_k1", "__wl_k2", "__wl_src", "__wl_by", "__wl_size").agg(F.count(F.lit(1)).alias("__wl_n"))
    slim = slim.withColumn("__wl_copy", F.explode(F.sequence(F.lit(1), F.col("__wl_n").cast("int"))))
    slim = cut(slim.withColumn("__wl_pos", F.to_json(F.struct("__wl_by", "__wl_k1", "__wl_copy"))))
    pieces, _ = mix(slim, "__wl_src", "__wl_size", "__wl_pos", **options)
    keys = ["__wl_k1", "__wl_k2"]
    spans = pieces.where("slot is not null").groupBy(*keys, "__wl_size", "__wl_copy", "epoch").agg(
        F.sort_array(F.collect_list(F.struct("from_word", "to_word"))).alias("__wl_spans"), F.sum(F.col("to_word") - F.col("from_word")).alias("__wl_got")
    )
    spans = spans.withColumnsRenamed({"__wl_k1": "__wl_j1", "__wl_k2": "__wl_j2"})
    joined = keyed.dropDuplicates(keys).join(spans.hint("merge"), (F.col("__wl_k1") == F.col("__wl_j1")) & (F.col("__wl_k2") == F.col("__wl_j2")))
    cutting = lambda w: F.array_join(F.flatten(F.transform("__wl_spans", lambda s: F.slice(w, (s["from_word"] + 1).cast("int"), (s["to_word"] - s["from_word"]).cast("int")))), " ")
    part = F.get(F.transform(F.array(words(t)), cutting), F.lit(0))
    out = F.when(F.col("__wl_got") == F.col("__wl_size"), t).otherwise(part)
    return joined.select(*[(out if c == text else F.col(f"__wl_r.c{i}")).alias(c) for i, c in enumerate(docs.columns)])
