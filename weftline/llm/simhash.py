"""SimHash near-duplicates through a Gray-order hierarchical index.

Distinct fingerprints that differ in at most three bits agree on one of four
16-bit bands. A band's value is the top node of an index: its mask is the
band, its pattern the value, and it is the key by which the index is dealt
to tasks. Below it the fingerprints are sorted by Gray rank, so neighbours
share most bits. Runs of eight form nodes, runs of eight nodes form nodes
above, each holding the bits that all below it share. A search carries the
differences met so far, adds those of the bits that a node newly fixes, and
leaves the whole group when they pass the limit or when everything in it
already belongs to the searcher's component. A task returns a spanning
forest of the links that it found, at most one row for each fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import components, cut

BANDS = 4
FAN = 8
#: Fingerprints of one band value in one task; larger groups are dealt as pairs of tiles.
TILE = 65_536
#: Candidate (search, node) pairs that a task expands at once.
FRONTIER = 1 << 20
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """The 64-bit SimHash, unsigned; zero for a text without words."""
    words = (text or b"").translate(_LOWER).split()  # bytes.split() splits at \x20 and \x09-\x0D
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(line, 42)
    ends = list(accumulate((len(w) + 1 for w in words), initial=0))
    digest, ones, n = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(words) - shingle + 1
    for lo in range(0, n, 1 << 16):
        hi = min(n, lo + (1 << 16))
        found = np.array([digest(line[a : b - 1], 42) for a, b in zip(ends[lo:hi], ends[lo + shingle : hi + shingle])], np.uint64)
        ones += np.unpackbits(found.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, text: str = "text", out: str = "fp") -> DataFrame:
    """Adds the fingerprint as a signed long; a null text counts as one without words."""

    @F.pandas_udf("long")
    def make(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))

    return docs.withColumn(out, make(F.col(text).cast("binary")))


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in the order of the binary-reflected Gray code."""
    rank = codes.copy()
    for s in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(s)
    return rank


class GrayIndex:
    """Groups of codes, each sorted by Gray rank, under nodes of shared bits."""

    def __init__(self, group: np.ndarray, codes: np.ndarray):
        order = np.lexsort((gray_rank(codes), group))
        self.group, self.codes = group[order], codes[order]
        self.labels = np.arange(len(codes))
        self.levels = []
        first, all_and, all_or, of = np.arange(len(codes)), self.codes, self.codes, self.group
        while True:
            starts_group = np.r_[True, of[1:] != of[:-1]] if len(of) else np.zeros(0, bool)
            if starts_group.all() and self.levels:
                break
            begin = np.flatnonzero(starts_group)
            within = np.arange(len(of)) - np.repeat(begin, np.diff(np.r_[begin, len(of)]))
            child = np.flatnonzero(within % FAN == 0)
            if not len(child):
                break
            all_and, all_or = np.bitwise_and.reduceat(all_and, child), np.bitwise_or.reduceat(all_or, child)
            first, of = first[child], of[child]
            mask = ~(all_and ^ all_or)
            self.levels.append({"child": np.r_[child, len(within)], "first": np.r_[first, len(codes)], "mask": mask, "bits": all_and & mask})

    def _join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Unites the components of a[i] and b[i]; labels are the smallest positions."""
        labels = self.labels
        while True:
            x, y = labels[a], labels[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = labels[labels]
                if (up == labels).all():
                    break
                labels[:] = up

    def link(self, most: int, chunk: int = 8192) -> None:
        """Unites all codes of a group that differ in at most ``most`` bits, and what they lead to."""
        n = len(self.codes)
        if not n:
            return
        top = self.levels[-1]
        tops = np.searchsorted(top["first"][:-1], np.arange(n), side="right") - 1
        for lo in range(0, n, chunk):
            hi = min(n, lo + chunk)
            ends = [(np.minimum.reduceat(self.labels, v["first"][:-1]), np.maximum.reduceat(self.labels, v["first"][:-1])) for v in self.levels]
            q = np.arange(lo, hi)
            stack = [(len(self.levels) - 1, q, tops[lo:hi], np.zeros(len(q), np.uint8), np.zeros(len(q), np.uint64))]
            while stack:
                depth, q, node, diff, known = stack.pop()
                if len(q) > FRONTIER:
                    half = len(q) // 2
                    stack += [(depth, q[half:], node[half:], diff[half:], known[half:]), (depth, q[:half], node[:half], diff[:half], known[:half])]
                    continue
                if depth < 0:
                    far = np.bitwise_count((self.codes[q] ^ self.codes[node]) & ~known) + diff
                    near = far <= most
                    self._join(q[near], node[near])
                    continue
                level = self.levels[depth]
                fresh = level["mask"][node] & ~known
                diff = diff + np.bitwise_count((self.codes[q] ^ level["bits"][node]) & fresh)
                least, largest = ends[depth]
                mine = self.labels[q]
                go = (diff <= most) & (level["first"][node + 1] - 1 > q) & ~((least[node] == largest[node]) & (self.labels[least[node]] == mine))
                q, node, diff, known = q[go], node[go], diff[go], known[go] | fresh[go]
                if not len(q):
                    continue
                begin, count = level["child"][node], level["child"][node + 1] - level["child"][node]
                step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                q, diff, known, below = np.repeat(q, count), np.repeat(diff, count), np.repeat(known, count), np.repeat(begin, count) + step
                if depth == 0:
                    after = below > q
                    q, diff, known, below = q[after], diff[after], known[after], below[after]
                stack.append((depth - 1, q, below, diff, known))

    def forest(self) -> tuple[np.ndarray, np.ndarray]:
        moved = np.flatnonzero(self.labels != np.arange(len(self.labels)))
        return self.codes[moved], self.codes[self.labels[moved]]


def links(fps: DataFrame, fp: str = "fp", most: int = 3, tile: int = TILE) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints within ``most`` bits of each other, and none else."""
    if not 0 <= most < BANDS:
        raise ValueError(f"most must be below {BANDS}: that many bands cannot all differ")
    width = 64 // BANDS
    band = [F.struct(F.lit(i).alias("band"), F.shiftrightunsigned(fp, i * width).bitwiseAND(F.lit((1 << width) - 1)).alias("value")) for i in range(BANDS)]
    rows = fps.select(fp, F.explode(F.array(*band)).alias("k")).select(fp, "k.*")
    hot = cut(rows.groupBy("band", "value").count().where(F.col("count") > tile).select("band", "value", F.ceil(F.col("count") / tile).cast("int").alias("tiles")))
    n_hot = hot.count()
    if n_hot:
        rows = rows.join(F.broadcast(hot) if n_hot <= 100_000 else hot, ["band", "value"], "left")
        tiles = F.coalesce("tiles", F.lit(1))
        own = F.pmod(F.xxhash64(fp), tiles).cast("int")
        rows = rows.withColumn("u", F.explode(F.sequence(F.lit(0), tiles - 1)))
        rows = rows.select(fp, "band", "value", F.least(own, "u").alias("lo"), F.greatest(own, "u").alias("hi"))
    else:
        rows = rows.select(fp, "band", "value", F.lit(0).alias("lo"), F.lit(0).alias("hi"))
    keys = ["band", "value", "lo", "hi"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size, groups, last = 0, 0, None

        def run() -> pa.RecordBatch:
            index = GrayIndex(np.concatenate([g for g, _ in held]), np.concatenate([c for _, c in held]))
            index.link(most)
            a, b = index.forest()
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in keys])
            codes = batch.column(fp).to_numpy().view(np.uint64)
            change = np.r_[last is None or bool((key[:, 0] != last).any()), (key[:, 1:] != key[:, :-1]).any(axis=0)]
            ids = groups + np.cumsum(change)
            groups, last = ids[-1], key[:, -1]
            begin = np.flatnonzero(change)
            if size >= TILE and len(begin):  # whole groups only: cut where the last group of what is held has ended
                held.append((ids[: begin[0]], codes[: begin[0]]))
                yield run()
                ids, codes, held, size = ids[begin[0] :], codes[begin[0] :], [], 0
            held.append((ids, codes))
            size += len(ids)
        if size:
            yield run()

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(search, "a long, b long")


def _roots(prints: DataFrame, id_: str, most: int) -> DataFrame:
    """(fp, least, root) of each distinct fingerprint; least is its smallest id."""
    fps = cut(prints.groupBy("fp").agg(F.min(id_).alias("least")))
    roots = components(links(fps, most=most))
    linked = fps.join(roots, fps["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    return cut(linked)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = 3) -> DataFrame:
    """One row per row of ``docs``: its id, fp (signed long) and component_id.

    component_id is the smallest id among the documents whose fingerprints
    lead to each other by steps of at most ``most`` bits. Texts without words
    (null ones too) have fingerprint zero and are linked like any other.
    Repeated rows stay repeated. A null id never is the smallest; a component
    of null ids only has a null component_id. An empty table gives no rows.
    """
    prints = cut(with_fingerprint(docs.select(F.col(doc_id), F.col(text).alias("__wl_text")), "__wl_text").select(doc_id, "fp"))
    linked = _roots(prints, doc_id, most)
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = linked.join(least, "root").select("fp", "component_id")
    return prints.join(by_fp, "fp")


def representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = 3) -> DataFrame:
    """The rows of docs of which one stays in each component: that with the smallest id, nulls last, of equals the smallest hash."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(F.xxhash64(*columns).alias("__wl_k1"), F.xxhash64(F.lit(1), *columns).alias("__wl_k2"), F.struct(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).alias("__wl_r"))
    at = docs.columns.index
    slim = keyed.select("__wl_k1", "__wl_k2", F.col(f"__wl_r.c{at(doc_id)}").alias("__wl_id"), F.col(f"__wl_r.c{at(text)}").alias("__wl_text"))
    prints = cut(with_fingerprint(slim, "__wl_text").drop("__wl_text"))
    linked = _roots(prints, "__wl_id", most)
    place = F.struct(F.col("__wl_id").isNull().alias("n"), F.col("__wl_id").alias("id"), F.col("__wl_k1").alias("k1"), F.col("__wl_k2").alias("k2"))
    by_print = prints.groupBy("fp").agg(F.min(place).alias("one"))
    kept = by_print.join(linked.select("fp", "root"), "fp").groupBy("root").agg(F.min("one").alias("one")).select(F.col("one.k1").alias("__wl_k1"), F.col("one.k2").alias("__wl_k2"))
    rows = keyed.join(kept.hint("merge"), ["__wl_k1", "__wl_k2"], "left_semi").dropDuplicates(["__wl_k1", "__wl_k2"])
    return rows.select(*[F.col(f"__wl_r.c{i}").alias(c) for i, c in enumerate(docs.columns)])


def hex_print(fp: str = "fp"):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
