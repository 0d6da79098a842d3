"""Candidate generation: TF-IDF top-k by country, and the postal-code pass.

Everything is one program keyed by shard; no loop over countries. The index
is a long table of (shard, term, entity, weight). A query deals the records of
a shard to tiles and its queries to chunks; each tile meets each chunk in one
task, which adds up the postings of a query's terms and keeps its k best, so
only k rows for each query and tile are shuffled, never the scored pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftline.sources.files import Scratch

#: The shard of records whose country no candidate has; its pool is everything.
EVERYWHERE = "\u0001all"
#: Postings of a tile and queries of a chunk, in expectation: what one task holds.
TILE = 1 << 20
CHUNK = 1 << 13
#: What joins the tokens of a row: normalised ones hold letters and digits.
BREAK = "\x01"
#: Bytes of text that are taken apart at a time, different terms that a task holds, records that Python gets at a time, and terms that are broadcast at once.
SLICE = 1 << 19
HELD = 1 << 19
BATCH = 1000
SENT = 1 << 21
#: What the seed of a second hash is larger by. Two of 64 bits tell terms apart.
OTHER = 1 << 32


def shards(s1: DataFrame, pool: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Adds shard to both sides: the country, or EVERYWHERE for S1 countries without candidates, with the whole pool."""
    known = pool.select("country").distinct().withColumn("__known", F.lit(True))
    queries = s1.join(known, "country", "left").withColumn("shard", F.when(F.col("__known"), F.col("country")).otherwise(F.lit(EVERYWHERE))).drop("__known")
    held = pool.withColumn("shard", F.col("country"))
    if queries.where(F.col("shard") == EVERYWHERE).isEmpty():  # a look at countries only, which spares the pool's second pass
        return queries, held
    return queries, held.unionByName(pool.withColumn("shard", F.lit(EVERYWHERE)))


class _Table(Scratch):
    """Tables whose making hands BATCH records at a time to Python: whole texts are long."""

    def put(self, name: str, df: DataFrame, codec: str = "zstd") -> DataFrame:
        key = "spark.sql.execution.arrow.maxRecordsPerBatch"
        before = self.spark.conf.get(key)
        self.spark.conf.set(key, BATCH)
        try:
            return super().put(name, df, codec)
        finally:
            self.spark.conf.set(key, before)


def _records(rows: DataFrame, tokens: str = "block") -> DataFrame:
    """(shard, entity_id, lists): a row for each record, with the joined tokens of each of its rows; a table, as normalising costs more than reading."""
    texts = rows.where("shard is not null").select("shard", "entity_id", F.array_join(tokens, BREAK).alias("text"))
    return _Table(rows.sparkSession).put("records", texts.groupBy("shard", "entity_id").agg(F.collect_list("text").alias("lists")))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashes(words: pa.Array, seed: int) -> np.ndarray:
    """Multilinear hashes of the bytes of words."""
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64) if len(words) else np.zeros(1, np.int64)
    sizes = np.diff(ends)
    at = np.arange(ends[-1] - ends[0]) - np.repeat(ends[:-1] - ends[0], sizes)
    random = np.random.Generator(np.random.Philox(key=[42, seed])).integers(0, 1 << 64, sizes.max(initial=0), np.uint64)
    bytes_ = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if ends[-1] > ends[0] else np.zeros(0, np.uint8)
    sums = np.r_[np.uint64(0), np.cumsum((bytes_.astype(np.uint64) + np.uint64(1)) * random[at], dtype=np.uint64)]
    return _mixed(sums[ends[1:] - ends[0]] - sums[ends[:-1] - ends[0]])


def _of_pair(first: np.ndarray, second: np.ndarray, alone: np.ndarray) -> np.ndarray:
    """Hashes of terms from those of their words; where ``alone``, there is no second one."""
    return _mixed(first * np.uint64(0x9E3779B97F4A7C15) + np.where(alone, np.uint64(1), _mixed(second)))


class _Terms:
    """The different terms (tokens of two characters or more, and pairs of neighbours among them) of some records, and how often each record has which."""

    def __init__(self, lists: pa.Array):
        texts = lists.flatten()
        inner = pc.split_pattern(texts, BREAK)
        sizes = inner.value_lengths().to_numpy()
        part = np.repeat(np.arange(len(texts)), sizes)
        coded = inner.flatten().dictionary_encode()
        self.words, code = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        long = pc.greater_equal(pc.utf8_length(self.words), 2).to_numpy(zero_copy_only=False)
        keep = long[code]
        code, part = code[keep], part[keep]
        record = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())[part]
        near, n = part[1:] == part[:-1], max(len(self.words), 1)
        key = np.r_[record * (n + 1) * n + code, (record[1:][near] * (n + 1) + code[1:][near] + 1) * n + code[:-1][near]]
        key, self.tf = np.unique(key, return_counts=True)  # slices are small enough for 63 bits
        self.record = key // ((n + 1) * n)
        rest, self.term = np.unique(key - self.record * ((n + 1) * n), return_inverse=True)
        second, self.first = np.divmod(rest, n)
        self.second, self.alone = np.maximum(second - 1, 0), second == 0

    def __len__(self) -> int:
        return len(self.first)

    def hashes(self, seed: int) -> np.ndarray:
        of = _hashes(self.words, seed)
        return _of_pair(of[self.first], of[self.second], self.alone)

    def strings(self, at: np.ndarray) -> np.ndarray:
        first, second = (self.words.take(pa.array(x[at])).to_numpy(zero_copy_only=False) for x in (self.first, self.second))
        return np.where(self.alone[at], first, first + " " + second) if len(at) else first

    def by_shard(self, shards: list[str]) -> Iterator[tuple[str, np.ndarray | slice]]:
        """Each shard and where its records' terms are."""
        names, code = np.unique(np.array(shards, object), return_inverse=True)
        for i, name in enumerate(names):
            yield name, (slice(None) if len(names) == 1 else np.flatnonzero(code[self.record] == i))


def _slices(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Rows of about ``size`` bytes of text at a time."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("lists").flatten()), 0).to_numpy()
        ends = np.r_[0, np.cumsum(sizes)][np.cumsum(batch.column("lists").value_lengths().to_numpy())]
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + size, side="right")))
            yield batch.slice(lo, hi - lo)
            lo = hi


def _summed(parts: list[tuple]) -> tuple:
    """(shard, h, df, total) with rows of equal shard and h summed."""
    shard, h, df, total = (np.concatenate(x) for x in zip(*parts))
    if not len(h):
        return shard, h, df, total
    order = np.argsort(h ^ _mixed(shard.astype(np.uint64)))
    shard, h = shard[order], h[order]
    first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (shard[1:] != shard[:-1])])
    return shard[first], h[first], np.add.reduceat(df[order], first), np.add.reduceat(total[order], first)


def _hash_counts(held: DataFrame, seed: int) -> DataFrame:
    """(shard, h, df, total) by the hash of a term; a task sums what it reads before it is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}
        parts, size = [], 0

        def run() -> pa.RecordBatch:
            shard, h, df, total = parts[0]
            return pa.RecordBatch.from_arrays([pa.array(list(names), pa.string()).take(pa.array(shard)), pa.array(h.view(np.int64)), pa.array(df), pa.array(total)], ["shard", "h", "df", "total"])

        for rows in _slices(batches, SLICE):
            terms = _Terms(rows.column("lists"))
            h = terms.hashes(seed)
            for shard, at in terms.by_shard(rows.column("shard").to_pylist()):
                df = np.bincount(terms.term[at], minlength=len(terms))
                has, total = np.flatnonzero(df), np.bincount(terms.term[at], terms.tf[at], len(terms)).astype(np.int64)
                parts.append((np.full(len(has), names.setdefault(shard, len(names)), np.int32), h[has], df[has], total[has]))
                size += len(has)
            if size > 2 * HELD:
                parts = [_summed(parts)]
                size = len(parts[0][1])
                if size > HELD:
                    yield run()
                    parts, size = [], 0
        if size:
            parts = [_summed(parts)]
            yield run()

    rows = held.mapInArrow(count, "shard string, h long, df long, total long")
    # Dealt first: a second aggregation on the side that counts would hold, and spill, what the first has already summed.
    return rows.repartition("shard", "h").groupBy("shard", "h").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))


def _spelled(held: DataFrame, kept: DataFrame, seed: int) -> DataFrame:
    """(shard, h, term): the terms of each kept (shard, h), in passes over ``held`` of SENT hashes each."""
    spark, n = held.sparkSession, kept.count()
    passes, out = max(1, -(-n // SENT)), None
    for i in range(passes):
        found = kept.where(F.pmod("h", F.lit(passes)) == i).toArrow()
        wanted = {}
        for shard in pc.unique(found["shard"]).to_pylist():
            wanted[shard] = np.sort(found.filter(pc.equal(found["shard"], shard))["h"].to_numpy().view(np.uint64))
        sent = spark.sparkContext.broadcast(wanted)

        def spell(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            seen = {k: np.zeros(len(v), np.uint64) for k, v in sent.value.items()}
            for rows in _slices(batches, SLICE):
                terms = _Terms(rows.column("lists"))
                h, keys = terms.hashes(seed), terms.hashes(seed + OTHER)
                for shard, of in terms.by_shard(rows.column("shard").to_pylist()):
                    if shard not in seen:
                        continue
                    at = np.flatnonzero(np.bincount(terms.term[of], minlength=len(terms)))
                    place = np.minimum(np.searchsorted(sent.value[shard], h[at]), len(seen[shard]) - 1)
                    new = (sent.value[shard][place] == h[at]) & (seen[shard][place] != keys[at])
                    at, place = at[new], place[new]
                    seen[shard][place] = keys[at]
                    if len(at):
                        yield pa.RecordBatch.from_arrays([pa.array([shard] * len(at), pa.string()), pa.array(h[at].view(np.int64)), pa.array(terms.strings(at), pa.string())], ["shard", "h", "term"])

        rows = held.mapInArrow(spell, "shard string, h long, term string").distinct()
        out = rows if out is None else out.unionByName(rows)
    return out


def vocabulary(held: DataFrame, max_features: int = 300_000, min_df: int = 2) -> DataFrame:
    """(shard, term, number, df, total, idf): terms of min_df records or more, the max_features most frequent of each shard, numbered from 1.

    Terms are counted by a hash of 64 bits first, so what is shuffled is short; only those that are frequent enough for
    the vocabulary, ties included, are spelled out. Two terms of one hash among them are seen then, and another hash is taken.
    """
    scratch, seed = _Table(held.sparkSession), 0
    while True:
        counts = scratch.put("counts", _hash_counts(held, seed).where(F.col("df") >= min_df))
        below = F.sum("n").over(Window.partitionBy("shard").orderBy(F.desc("total")).rowsBetween(Window.unboundedPreceding, Window.currentRow))
        least = counts.groupBy("shard", "total").agg(F.count(F.lit(1)).alias("n")).withColumn("n", below)
        least = least.where(F.col("n") >= max_features).groupBy("shard").agg(F.max("total").alias("least"))
        kept = counts.join(least, "shard", "left").where(F.col("total") >= F.coalesce("least", F.lit(0))).drop("least")
        kept = scratch.put("kept", kept)
        spelled = scratch.put("spelled", _spelled(held, kept.select("shard", "h"), seed))
        if spelled.groupBy("shard", "h").count().where("count > 1").isEmpty():
            break
        seed += 1
    docs = held.groupBy("shard").agg(F.count("entity_id").alias("n"))
    rank = F.row_number().over(Window.partitionBy("shard").orderBy(F.desc("total"), "term"))
    terms = kept.join(spelled, ["shard", "h"]).drop("h").withColumn("number", rank).where(F.col("number") <= max_features)
    terms = terms.join(docs, "shard").withColumn("idf", F.log((1.0 + F.col("n")) / (1.0 + F.col("df"))) + 1.0).drop("n")
    terms = scratch.put("terms", terms)
    for name in ("counts", "kept", "spelled"):
        scratch.drop(name)
    return terms


def _vocabularies(terms: pa.Table) -> dict[str, tuple]:
    """By shard two hashes of its terms, sorted by the first, and their numbers, idf and asked in that order."""
    out = {}
    for shard in pc.unique(terms["shard"]).to_pylist():
        own = terms.filter(pc.equal(terms["shard"], shard)).combine_chunks()
        parts = [x.partition(" ") for x in own["term"].to_pylist()]
        first, second = (pa.array([x[i] for x in parts], pa.string()) for i in (0, 2))
        h, other = (_of_pair(_hashes(first, x), _hashes(second, x), np.array([not x[1] for x in parts])) for x in (0, OTHER))
        order = np.lexsort((other, h))
        out[shard] = (h[order], other[order], own["number"].to_numpy()[order].astype(np.int32), own["idf"].to_numpy()[order], own["asked"].to_numpy(zero_copy_only=False)[order])
        if (h[order][1:] == h[order][:-1]).any():
            raise RuntimeError("two terms of the vocabulary have one hash")
    return out


def vectors(held: DataFrame, terms: DataFrame) -> DataFrame:
    """(shard, entity_id, number, w): arrays of the terms that a record has, with sublinear tf times idf, of unit length for each record.

    Where ``terms`` has a column ``asked``, only terms for which it holds are listed; lengths are those of all. Vocabularies are
    broadcast, those of some shards at a time when all of them have more than SENT terms.
    """
    spark = held.sparkSession
    terms = terms if "asked" in terms.columns else terms.withColumn("asked", F.lit(True))
    groups, room = [[]], 0
    for shard, n in sorted((r["shard"], r["count"]) for r in terms.groupBy("shard").count().collect()):
        if groups[-1] and room + n > SENT:
            groups.append([])
            room = 0
        groups[-1].append(shard)
        room += n
    out = None
    for group in groups:
        sent = spark.sparkContext.broadcast(_vocabularies(terms.where(F.col("shard").isin(group)).select("shard", "term", "number", "idf", "asked").toArrow()))

        def weigh(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            known = sent.value
            for rows in _slices(batches, SLICE):
                terms = _Terms(rows.column("lists"))
                h, other, n = terms.hashes(0), terms.hashes(OTHER), len(terms.term)
                number, w, show = np.zeros(n, np.int32), np.zeros(n), np.zeros(n, bool)
                for shard, of in terms.by_shard(rows.column("shard").to_pylist()):
                    if shard not in known:
                        continue
                    own, check, numbers, idf, asked = known[shard]
                    place = np.minimum(np.searchsorted(own, h), len(own) - 1)
                    has, term = (own[place] == h) & (check[place] == other), terms.term[of]
                    number[of], w[of] = numbers[place[term]], (1.0 + np.log(terms.tf[of])) * np.where(has, idf[place], 0.0)[term]
                    show[of] = (has & asked[place])[term]
                length = np.sqrt(np.bincount(terms.record, w * w, rows.num_rows))
                record, number, w = terms.record[show], number[show], w[show] / length[terms.record[show]]
                sizes = np.bincount(record, minlength=rows.num_rows)
                has = np.flatnonzero(sizes)
                ends = pa.array(np.r_[0, np.cumsum(sizes[has])].astype(np.int32))
                yield pa.RecordBatch.from_arrays([rows.column(c).take(pa.array(has)) for c in ("shard", "entity_id")] + [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (number, w)], ["shard", "entity_id", "number", "w"])

        own = held if len(groups) == 1 else held.where(F.col("shard").isin(group))
        rows = own.mapInArrow(weigh, f"shard string, entity_id {held.schema['entity_id'].dataType.simpleString()}, number array<int>, w array<double>")
        out = rows if out is None else out.unionByName(rows)
    return out


def build_index(pool: DataFrame, max_features: int = 300_000, min_df: int = 2) -> tuple[DataFrame, DataFrame]:
    """(vocabulary, weights) of the pool, each shard by itself; weights has a row (shard, term, number, entity_id, w) for each term of a record."""
    held = _records(pool)
    terms = vocabulary(held, max_features, min_df)
    rows = vectors(held, terms).select("shard", "entity_id", F.inline(F.arrays_zip("number", "w")))
    return terms, rows.join(terms.select("shard", "number", "term"), ["shard", "number"]).select("shard", "term", "number", "entity_id", "w")


def ranked(scores: DataFrame, k: int) -> DataFrame:
    """The k best candidates of each S1 record; ties by id."""
    best = Window.partitionBy("s1_id").orderBy(F.desc(F.round("tfidf", 9)), "cand_id")
    return scores.where("tfidf > 0").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _flat(table: pa.Table, column: str) -> np.ndarray:
    return table[column].combine_chunks().flatten().to_numpy()


def _best_of_tile(queries: pa.Table, pool: pa.Table, k: int) -> pa.Table:
    """The k best records of a tile for each query of a chunk: (s1_id, cand_id, tfidf)."""
    ids = pool["entity_id"].to_pylist()
    by_id = sorted(range(len(ids)), key=lambda i: ids[i].encode())  # of equal scores the smaller id comes first
    place = np.empty(len(ids), np.int64)
    place[by_id] = np.arange(len(ids))
    sizes = pool["number"].combine_chunks().value_lengths().to_numpy()
    number, w = _flat(pool, "number"), _flat(pool, "w")
    order = np.argsort(number, kind="stable")
    number, w, record = number[order], w[order], np.repeat(place, sizes)[order]
    asked, weight = _flat(queries, "number"), _flat(queries, "w")
    low, high = np.searchsorted(number, asked), np.searchsorted(number, asked, side="right")
    ends = np.cumsum(queries["number"].combine_chunks().value_lengths().to_numpy())
    found_q, found_c, found_s = [], [], []
    for i, (a, b) in enumerate(zip(np.r_[0, ends[:-1]].tolist(), ends.tolist())):
        n = high[a:b] - low[a:b]
        total = int(n.sum())
        if not total:
            continue
        at = np.repeat(low[a:b] - (np.cumsum(n) - n), n) + np.arange(total)
        score = np.bincount(record[at], w[at] * np.repeat(weight[a:b], n), len(ids))
        hit = np.flatnonzero(score > 0)
        value = np.round(score[hit], 9)
        if len(hit) > k:
            enough = value >= np.partition(value, len(value) - k)[len(value) - k]
            hit, value = hit[enough], value[enough]
        best = hit[np.argsort(-value, kind="stable")[:k]]
        found_q.append(np.full(len(best), i))
        found_c.append(best)
        found_s.append(score[best])
    gather = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
    back = np.array(by_id, np.int64)[gather(found_c, np.int64)]
    return pa.table([queries["entity_id"].take(pa.array(gather(found_q, np.int64))), pool["entity_id"].take(pa.array(back)), pa.array(gather(found_s, np.float64))], ["s1_id", "cand_id", "tfidf"])


def query_topk(terms: DataFrame, weights: DataFrame, queries: DataFrame, k: int = 30, tile: int = TILE, chunk: int = CHUNK) -> DataFrame:
    """(s1_id, cand_id, tfidf, rank): cosine of the query, over the terms of the index, with each record."""
    whole = weights.groupBy("shard", "entity_id").agg(F.collect_list(F.struct("number", "w")).alias("x"))
    asked = vectors(_records(queries), terms)
    return _met(terms, asked, whole.select("shard", "entity_id", F.col("x.number").alias("number"), F.col("x.w").alias("w")), queries, k, tile, chunk)


def topk(pool: DataFrame, queries: DataFrame, k: int = 30, max_features: int = 300_000, min_df: int = 2, tile: int = TILE, chunk: int = CHUNK) -> DataFrame:
    """As query_topk on the index of the pool, which is not kept: of its vectors only the terms of a query are made, as others add nothing to a score."""
    scratch, held = _Table(pool.sparkSession), _records(pool)
    terms = vocabulary(held, max_features, min_df)
    asked = scratch.put("asked", vectors(_records(queries), terms))
    used = asked.select("shard", F.explode("number").alias("number")).distinct().withColumn("asked", F.lit(True))
    terms = scratch.put("terms", terms.join(used, ["shard", "number"], "left").withColumn("asked", F.coalesce("asked", F.lit(False))))
    return _met(terms.where("asked"), asked, scratch.put("vectors", vectors(held, terms)), queries, k, tile, chunk)


def _met(terms: DataFrame, asked: DataFrame, held: DataFrame, queries: DataFrame, k: int, tile: int, chunk: int) -> DataFrame:
    """The k best of the vectors ``held`` for each of ``asked``; terms tells how many postings there are."""
    parts = lambda n, most: F.greatest(F.lit(1), F.ceil(n / F.lit(float(most)))).cast("int")
    tiles = terms.groupBy("shard").agg(parts(F.sum("df"), tile).alias("tiles"))
    sizes = tiles.join(queries.groupBy("shard").agg(parts(F.count(F.lit(1)), chunk).alias("chunks")), "shard")
    sizes = F.broadcast(sizes)  # a row for each shard; a join by shard would send all of a shard to one task
    own = lambda n: F.pmod(F.xxhash64("entity_id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    keep = [F.col(c).alias(c) for c in ("shard", "chunk", "tile", "entity_id", "number", "w")]  # columns of its own for each side
    q = asked.join(sizes, "shard").withColumn("chunk", own("chunks")).withColumn("tile", every("tiles")).select(*keep)
    c = held.join(sizes, "shard").withColumn("tile", own("tiles")).withColumn("chunk", every("chunks")).select(*keep)
    by, spread = ["shard", "chunk", "tile"], int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Vectors are small and costly: a number of partitions that Spark does not coalesce by their bytes.
    q, c = q.repartition(spread, *by), c.repartition(spread, *by)
    scores = q.groupBy(by).cogroup(c.groupBy(by)).applyInArrow(lambda a, b: _best_of_tile(a, b, k), "s1_id string, cand_id string, tfidf double")
    return ranked(scores, k)


def zip_block(queries: DataFrame, pool: DataFrame, cap: int = 200, order: str = "entity_id") -> DataFrame:
    """(s1_id, cand_id) of equal, non-empty postal codes in a shard; the first ``cap`` records of a code."""
    first = F.row_number().over(Window.partitionBy("shard", "zip").orderBy(order, "entity_id"))
    held = pool.where("zip <> ''").withColumn("__n", first).where(F.col("__n") <= cap)
    return queries.where("zip <> ''").select("shard", "zip", F.col("entity_id").alias("s1_id")).join(held.select("shard", "zip", F.col("entity_id").alias("cand_id")), ["shard", "zip"]).select("s1_id", "cand_id")


def zip_union(candidates: DataFrame, by_zip: DataFrame) -> DataFrame:
    """Candidates and those of equal postal codes, the latter with score 0 and no rank where they are new."""
    extra = by_zip.select("s1_id", "cand_id", F.lit(0.0).alias("tfidf"), F.lit(None).cast("int").alias("rank"))
    both = candidates.select("s1_id", "cand_id", "tfidf", "rank").unionByName(extra)
    return both.groupBy("s1_id", "cand_id").agg(F.max("tfidf").alias("tfidf"), F.max("rank").alias("rank"))


def block_all(s1: DataFrame, pool: DataFrame, k: int = 30, max_features: int = 300_000, min_df: int = 2, use_zip: bool = False, zip_cap: int = 200, zip_order: str = "entity_id") -> DataFrame:
    """Candidates of all normalised S1 records; records without any have no row."""
    queries, candidates = shards(s1, pool)
    found = topk(candidates, queries, k, max_features, min_df)
    return zip_union(found, zip_block(queries, candidates, zip_cap, zip_order)) if use_zip else found


def blocking_recall(candidates: DataFrame, truth: DataFrame, covered: DataFrame) -> DataFrame:
    """One row (n_true, n_hit, recall) over true pairs of the S1 ids in ``covered``; 1 without any."""
    pairs = truth.join(covered.select("s1_id").distinct(), "s1_id", "left_semi")
    hit = pairs.join(candidates.select("s1_id", "cand_id").distinct().withColumn("hit", F.lit(1)), ["s1_id", "cand_id"], "left")
    n, h = F.count(F.lit(1)), F.count("hit")
    return hit.agg(n.alias("n_true"), h.alias("n_hit"), F.when(n == 0, F.lit(1.0)).otherwise(h / n).alias("recall"))


def recall_at_k(candidates: DataFrame, truth: DataFrame, covered: DataFrame, ks: list[int], by_zip: DataFrame | None = None) -> DataFrame:
    """(k, n_true, n_hit, recall, avg_pairs) of one ranked frame cut at each k; the postal pass joins after the cut."""
    cut = candidates.select("s1_id", "cand_id", F.explode(F.filter(F.array(*[F.lit(k) for k in ks]), lambda k: k >= F.col("rank"))).alias("k"))
    if by_zip is not None:
        cut = cut.unionByName(by_zip.select("s1_id", "cand_id", F.explode(F.array(*[F.lit(k) for k in ks])).alias("k"))).distinct()
    pairs = truth.join(covered.select("s1_id").distinct(), "s1_id", "left_semi").withColumn("true", F.lit(1))
    both = cut.join(pairs, ["s1_id", "cand_id"], "left").groupBy("k").agg(F.count("true").alias("n_hit"), F.count(F.lit(1)).alias("n_pairs"))
    n_true, n_s1 = pairs.agg(F.count(F.lit(1)).alias("n_true")), covered.agg(F.countDistinct("s1_id").alias("n_s1"))
    grid = cut.sparkSession.createDataFrame([(k,) for k in ks], "k int").withColumn("__one", F.lit(1))
    totals = n_true.withColumn("__one", F.lit(1)).join(n_s1.withColumn("__one", F.lit(1)), "__one")
    rows = grid.join(both, "k", "left").join(totals, "__one")
    hits, found = F.coalesce("n_hit", F.lit(0)), F.coalesce("n_pairs", F.lit(0))
    return rows.select("k", "n_true", hits.alias("n_hit"), F.when(F.col("n_true") == 0, F.lit(1.0)).otherwise(hits / F.col("n_true")).alias("recall"), (found / F.greatest("n_s1", F.lit(1))).alias("avg_pairs"))
