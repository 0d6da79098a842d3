"""Scoring texts with a context-tree weighting model of bytes.

A byte is eight binary decisions. Each decision, the bits of the byte so far,
has a context tree over the bytes before it. A node of depth d counts the
decisions made after its d bytes and predicts by the Krichevsky-Trofimov
estimate; the weighted probability of a node halves its belief between its
own estimate and the product of its children, so depths from 0 to the full
one are mixed by how well each explains the training texts. Scoring uses the
trained weights: at each node on the path of a context, the share of its own
estimate is the posterior of stopping there.

Counting is a distributed sum over all training texts: byte runs of depth + 1,
from which the counts of every depth follow. The tree keeps every context and
is a partitioned table: all that hangs on one context of two bytes lies in one
partition, which computes the nodes below depth 2 for itself. Only depths 0
and 1, which the alphabet bounds, are known to all tasks. Each run of bytes
that some text holds gets its probability once; texts are dealt in batches,
which are joined with the probabilities of the runs that they hold.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import Scratch

DEPTH = 5
#: Bytes of texts whose probabilities are fetched together.
BATCH = 1 << 25
#: Entries of the tree that a task computes at once; whole contexts of two bytes.
GROUP = 1 << 19
#: Frequent tokens that every task knows the counts of; others are joined.
FREQUENT = 1 << 18
END = 0xFF  # no byte of UTF-8; also what stands before a text
HELD_OUT = (7, 2)
CHUNK = 1 << 20
_FREE = np.uint64(0xFFFFFFFFFFFFFFFF)  # no key: depth is at most 6
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def keys(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """A key of each byte and each end of the texts: the byte lowest, the ``depth`` bytes before it above. And where the texts begin."""
    pad = bytes([END]) * depth
    data = np.frombuffer(pad + b"".join(t + bytes([END]) + pad for t in texts), np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    out = data.astype(np.uint64)
    for d in range(1, depth + 1):
        out[d:] |= data[:-d].astype(np.uint64) << np.uint64(8 * d)
    begins = depth + np.cumsum(sizes + depth) - sizes - depth
    real = np.ones(len(data), bool)
    real[:depth] = False
    for d in range(depth):
        real[begins + sizes + d] = False
    return out[real], np.cumsum(sizes) - sizes


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, after a shift to where it is exact enough."""
    x = x.astype(np.float64)
    shift = np.zeros_like(x)
    for _ in range(8):
        low = x < 9
        shift = shift + np.where(low, np.log(np.where(low, x, 1.0)), 0.0)
        x = np.where(low, x + 1, x)
    inverse = 1 / x
    return (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + inverse / 12 - inverse**3 / 360 + inverse**5 / 1260 - shift


def _log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return _log_gamma(n0 + 0.5) + _log_gamma(n1 + 0.5) - _log_gamma(n0 + n1 + 1.0) - math.log(math.pi)


class Tree:
    """Sorted (context, byte) keys and counts of each depth, and the posterior of stopping at each node.

    entries are those of the depths from ``first`` on; below is what hangs on
    the last of them: (node, weighted, n0, n1) of each bit, of nodes one
    deeper. What hangs on the depth before the first stays in ``below``.
    """

    def __init__(self, entries: list[tuple[np.ndarray, np.ndarray]], first: int = 0, below: list | None = None):
        top, ends = first, below is None
        self.keys, self.sums, self.stop = [], [], []
        for k, n in entries:
            order = np.argsort(k, kind="stable")
            self.keys.append(k[order].astype(np.uint64))
            self.sums.append(np.r_[0, np.cumsum(n[order].astype(np.int64))])
        below = [None] * 8 if below is None else list(below)
        stop: list = []
        deepest = len(entries) - 1
        for d in range(len(entries) - 1, -1, -1):
            k, sums, level = self.keys[d], self.sums[d], []
            for j in range(8):
                if not len(k):
                    level.append(np.zeros(0, np.float32))
                    below[j] = None
                    continue
                node = k >> np.uint64(8 - j)
                first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
                last = np.r_[first[1:], len(k)]
                middle = np.searchsorted(k, (node[first] << np.uint64(8 - j)) | np.uint64(1 << (7 - j)))
                n0, n1 = sums[middle] - sums[first], sums[last] - sums[middle]
                own, share = _log_kt(n0, n1), np.ones(len(first))
                total = own
                if below[j] is not None:
                    child, weighted = below[j][:2]
                    up = np.searchsorted(node[first], child & np.uint64((1 << (8 * (d + top) + j)) - 1))
                    of = lambda x: np.bincount(up, x, len(first))  # noqa: E731, B023
                    both = np.logaddexp(own, of(weighted))
                    total, share = both - math.log(2), np.exp(own - both)
                held = None
                if d < deepest or not ends:
                    held = np.zeros(len(k), np.float32)
                    held[first] = share
                level.append(held)
                below[j] = (node[first], total, n0, n1)
            stop.append(level)
        self.stop, self.below = stop[::-1], below

    def under(self, top: Tree) -> Tree:
        """This tree below the shallower depths of another."""
        self.keys, self.sums, self.stop = top.keys + self.keys, top.sums + self.sums, top.stop + self.stop
        return self

    def log_probability(self, asked: np.ndarray) -> np.ndarray:
        """The natural logarithm of the probability of each key's byte after its context."""
        depth = len(self.keys)
        low, high, target = [], [], []
        for d in range(depth):
            t = asked & np.uint64((1 << (8 * (d + 1))) - 1)
            base = (t >> np.uint64(8)) << np.uint64(8)
            low.append(np.searchsorted(self.keys[d], base))
            high.append(np.searchsorted(self.keys[d], base | np.uint64(255), side="right"))
            target.append(t)
        out = np.zeros(len(asked))
        for j in range(8):
            one = (asked >> np.uint64(7 - j)) & np.uint64(1) == 1
            p = np.full(len(asked), 0.5)  # the estimate of a context that no training text holds
            for d in range(depth - 1, -1, -1):
                if not len(self.keys[d]):
                    continue
                middle = np.searchsorted(self.keys[d], ((target[d] >> np.uint64(8 - j)) << np.uint64(8 - j)) | np.uint64(1 << (7 - j)))
                sums = self.sums[d]
                n = sums[high[d]] - sums[low[d]]
                kt = (sums[high[d]] - sums[middle] + 0.5) / (n + 1.0)
                share = 1.0 if d == depth - 1 else self.stop[d][j][np.minimum(low[d], len(self.keys[d]) - 1)]
                p = np.where(n > 0, share * kt + (1 - share) * p, p)
                low[d], high[d] = np.where(one, middle, low[d]), np.where(one, high[d], middle)
            out += np.log(np.where(one, p, 1 - p))
        return out


class Scorer:
    """Probabilities of a tree, with those of recent keys at hand, all rounded alike."""

    def __init__(self, tree: Tree, slots: int = 22):
        self.tree, self.shift = tree, np.uint64(64 - slots)
        self.known = np.full(1 << slots, _FREE)
        self.value = np.zeros(1 << slots, np.float32)

    def _slot(self, asked: np.ndarray, second: bool = False) -> np.ndarray:
        return (asked * np.uint64(0xD6E8FEB86659FD93 if second else 0x9E3779B97F4A7C15)) >> self.shift

    def __call__(self, asked: np.ndarray) -> np.ndarray:
        slot = self._slot(asked)
        out = self.value[slot]
        missed = np.flatnonzero(self.known[slot] != asked)
        if len(missed):
            slot = self._slot(asked[missed], True)
            out[missed] = self.value[slot]
            missed = missed[self.known[slot] != asked[missed]]
        if len(missed):
            new, back = np.unique(asked[missed], return_inverse=True)
            found = self.tree.log_probability(new).astype(np.float32)
            out[missed] = found[back]
            slot = self._slot(new)
            slot = np.where(self.known[slot] == _FREE, slot, self._slot(new, True))
            self.known[slot], self.value[slot] = new, found
        return out.astype(np.float64)


class _Fetched:
    """Logarithms of probabilities of the keys that a batch holds."""

    def __init__(self, table: pa.Table):
        found = table["gram"].to_numpy().view(np.uint64)
        order = np.argsort(found)
        self.keys, self.value = found[order], table["lp"].to_numpy()[order]

    def log_probability(self, asked: np.ndarray) -> np.ndarray:
        return self.value[np.searchsorted(self.keys, asked)]


class _Logs(dict):
    """Logarithms of frequent tokens' counts; asked for another token, it notes it and gives 0."""

    def __init__(self, logs: dict[bytes, float]):
        super().__init__(logs)
        self.rare: list[bytes] = []

    def __missing__(self, token: bytes) -> float:
        self.rare.append(token)
        return 0.0


def _texts(batch: pa.RecordBatch, column: str = "t") -> Iterator[tuple[int, list[bytes]]]:
    """Runs of about CHUNK bytes of lower-cased texts, with the row of the first."""
    held, size, first = [], 0, 0
    for i, t in enumerate(batch.column(column)):
        text = (t.as_py() or b"").translate(_LOWER)
        held.append(text)
        size += len(text)
        if size >= CHUNK:
            yield first, held
            held, size, first = [], 0, i + 1
    if held:
        yield first, held


def _counted(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[pa.RecordBatch]:
    """(batch, gram, token, n): n counts in training texts; a run of bytes of a held-out text has 0."""
    tokens: Counter = Counter()
    found: list[tuple[np.ndarray, np.ndarray]] = []
    size = n_ends = 0
    current = None

    def merged() -> tuple[np.ndarray, np.ndarray]:
        unique, at = np.unique(np.concatenate([a for a, _ in found]), return_inverse=True)
        return unique, np.bincount(at, np.concatenate([b for _, b in found])).astype(np.int64)

    def made(grams, words, n, of) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(n), of)), grams, words, pa.array(n, pa.int64())], ["batch", "gram", "token", "n"])

    def runs() -> pa.RecordBatch:
        unique, total = merged()
        return made(pa.array(unique.view(np.int64)), pa.nulls(len(unique), pa.binary()), total, current)

    def words() -> pa.RecordBatch:
        return made(pa.nulls(len(tokens), pa.int64()), pa.array(list(tokens), pa.binary()), list(tokens.values()), 0)

    for batch in batches:
        of, held_out = batch.column("batch").to_numpy(), batch.column("held_out").to_numpy(zero_copy_only=False)
        edges = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else []
        for lo, hi in zip(edges, [*edges[1:], len(of)]):
            if current is not None and of[lo] != current and found:
                yield runs()
                found, size = [], 0
            current = of[lo]
            for first, texts in _texts(batch.slice(lo, hi - lo)):
                held = held_out[lo + first : lo + first + len(texts)]
                for train in (True, False):
                    some = [t for t, h in zip(texts, held) if h != train]
                    if not some:
                        continue
                    k, n = np.unique(keys(some, depth)[0], return_counts=True)
                    found.append((k, n if train else np.zeros(len(k), np.int64)))
                    size += len(k)
                    if train:
                        n_ends += len(some)
                        for t in some:
                            tokens.update(t.split())
                if size > 1 << 22:
                    found = [merged()]
                    size = len(found[0][0])
                    if size > 1 << 21:
                        yield runs()
                        found, size = [], 0
                if len(tokens) > 400_000:
                    yield words()
                    tokens.clear()
    if found:
        yield runs()
    if tokens:
        yield words()
    if n_ends:  # the end token: an empty one, which no word is
        yield made(pa.nulls(1, pa.int64()), pa.array([b""]), [n_ends], 0)


def _largest(table: DataFrame, weight: str, size: str, most: int) -> int:
    """The power of two such that rows of at least that weight sum to ``most`` or less of ``size``."""
    bins = table.groupBy(F.floor(F.log2(weight)).cast("int").alias("b")).agg(F.sum(size).alias("n")).collect()  # 64 rows at most
    total, least = 0, 64
    for b, n in sorted(((r["b"], r["n"]) for r in bins), reverse=True):
        total += n
        if total > most:
            break
        least = b
    return 1 << min(least, 62)


def _levels(k: np.ndarray, n: np.ndarray, first: int, depth: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Keys and counts of the depths from ``first`` on, of all runs that were counted."""
    k, n, out = k[n > 0], n[n > 0], []
    for d in range(depth, first - 1, -1):
        k, at = np.unique(k & np.uint64((1 << (8 * (d + 1))) - 1), return_inverse=True)
        n = np.bincount(at, n, len(k)).astype(np.int64)
        out.append((k, n))
    return out[::-1]


def _grown(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[tuple[np.ndarray, Tree]]:
    """Keys and the tree from depth 2 on of whole contexts of two bytes, which come sorted by ``c``."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size, last = 0, None

    def run() -> tuple[np.ndarray, Tree]:
        k, n = np.concatenate([a for a, _ in held]), np.concatenate([b for _, b in held])
        return k, Tree(_levels(k, n, 2, depth), 2)

    for batch in batches:
        if not batch.num_rows:
            continue
        c, k, n = batch.column("c").to_numpy(), batch.column("gram").to_numpy().view(np.uint64), batch.column("n").to_numpy()
        begin = np.flatnonzero(np.r_[c[0] != last, c[1:] != c[:-1]])
        last = c[-1]
        if size >= GROUP and len(begin):
            held.append((k[: begin[0]], n[: begin[0]]))
            yield run()
            k, n, held, size = k[begin[0] :], n[begin[0] :], [], 0
        held.append((k, n))
        size += len(k)
    if size:
        yield run()


def probabilities(grams: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(gram, lp): the logarithm of the probability of each run's last byte after the others, by the tree of all runs (gram, n)."""
    spark, below = grams.sparkSession, None
    rows = grams.withColumn("c", F.shiftright("gram", 8).bitwiseAND(F.lit(0xFFFF))).repartition("c").sortWithinPartitions("c")
    if depth > 1:

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, tree in _grown(batches, depth):
                for j, under in enumerate(tree.below):
                    if under is not None:
                        node, *values = under
                        up, at = np.unique(node & np.uint64((1 << (8 + j)) - 1), return_inverse=True)
                        found = [np.bincount(at, v) for v in values]
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(up), j)), pa.array(up.view(np.int64)), *map(pa.array, found)], ["j", "node", "w", "n0", "n1"])

        # Sums of whole numbers do not depend on the order of rows. At most 255 nodes of 256 contexts.
        exact = F.sum(F.round(F.col("w") * 1e6).cast("decimal(38,0)")).cast("double") / 1e6
        table = rows.mapInArrow(sums, "j long, node long, w double, n0 double, n1 double").groupBy("j", "node").agg(exact.alias("w"), F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).orderBy("j", "node").toArrow()
        j, node, values = table["j"].to_numpy(), table["node"].to_numpy().view(np.uint64), [table[x].to_numpy() for x in ("w", "n0", "n1")]
        below = [(node[j == i], *[v[j == i] for v in values]) if (j == i).any() else None for i in range(8)]
    table = grams.where("n > 0").groupBy(F.col("gram").bitwiseAND(F.lit(0xFFFF)).alias("k")).agg(F.sum("n").alias("n")).toArrow()
    shallow = _levels(table["k"].to_numpy().view(np.uint64), table["n"].to_numpy(), 0, 1)
    shared = spark.sparkContext.broadcast(Tree(shallow, 0, below))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, tree in _grown(batches, depth):
            tree = tree.under(shared.value)
            for lo in range(0, len(k), 1 << 17):
                part = k[lo : lo + (1 << 17)]
                yield pa.RecordBatch.from_arrays([pa.array(part.view(np.int64)), pa.array(tree.log_probability(part).astype(np.float32))], ["gram", "lp"])

    return rows.mapInArrow(run, "gram long, lp float")


_HELD: dict[str, tuple] = {}


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", depth: int = DEPTH, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and bits_per_byte of each row.

    A row is held out when crc32 of its id as text leaves 2 modulo 7; a null
    id counts as an empty text. The others are the training texts. score is
    log10 of the model's probability of the lower-cased text and its end. A
    null text is an empty one. Repeated rows are counted and scored each.
    Without training texts all bytes are equally likely. Texts of any length
    are scored whole, one batch at a time. Other columns are left out; an empty
    table gives no rows. Every context of the training texts is in the tree; one
    that none of them holds has the Krichevsky-Trofimov estimate of no counts.
    """
    if not 1 <= depth <= 6:
        raise ValueError("depth is 1 to 6: a key has eight bytes")
    spark = docs.sparkSession
    scratch = Scratch(spark)
    modulus, rest = HELD_OUT
    held = F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % modulus == rest
    base = docs.select(F.col(doc_id).alias("id"), held.alias("held_out"), F.col(text).cast("binary").alias("t"))
    kind = dict(base.dtypes)["id"]

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        row, size = part << 33, 0
        for batch in batches:
            n = batch.num_rows
            before = size + np.cumsum([len(t.as_py() or b"") for t in batch.column("t")], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((part << 32) + before // BATCH), pa.array(np.arange(row, row + n)), *batch.columns], ["batch", "row", *batch.schema.names])
            row, size = row + n, int(before[-1]) if n else size

    texts = scratch.put("texts", base.mapInArrow(numbered, f"batch long, row long, id {kind}, held_out boolean, t binary"), "zstd")
    parts = scratch.put("counts", texts.select("batch", "held_out", "t").mapInArrow(lambda b: _counted(b, depth), "batch long, gram long, token binary, n long"), "zstd")
    grams = scratch.put("grams", parts.where("gram is not null").groupBy("gram").agg(F.sum("n").alias("n")))
    tokens = scratch.put("tokens", parts.where("token is not null").groupBy("token").agg(F.sum("n").alias("c")))
    n_train, n_distinct = tokens.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    least = _largest(tokens.withColumn("one", F.lit(1)), "c", "one", frequent)
    common = tokens.where(F.col("c") >= least).toArrow()
    logs = dict(zip(common["token"].to_pylist(), np.log10(common["c"].to_numpy() + 1).tolist()))
    shared = spark.sparkContext.broadcast(logs)
    del common, logs
    model = uuid.uuid4().hex
    known = scratch.put("known", probabilities(grams, depth))
    wanted = scratch.put("wanted", parts.where("gram is not null").select("batch", "gram").join(known.hint("merge"), "gram").select("batch", "gram", "lp"), "zstd")
    for name in ("counts", "grams", "known"):
        scratch.drop(name)
    names = ["row", "id", "held_out", "score", "bytes", "n_tokens", "n_known", "log_sum", "rare", "times"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if model not in _HELD:
            _HELD.clear()
            _HELD[model] = _Logs(shared.value)
        logs, scorer, done = _HELD[model], Scorer(_Fetched(right), 20), []
        for batch in left.to_batches():
            for first, texts in _texts(batch):
                k, begins = keys(texts, depth)
                scores = np.add.reduceat(scorer(k), begins) / math.log(10)
                out = {n: [] for n in ("n_tokens", "n_known", "log_sum", "rare", "times")}
                for t in texts:
                    words = t.split()
                    words.append(b"")
                    total = sum(map(logs.__getitem__, words), 0.0)
                    rare = Counter(logs.rare)
                    logs.rare.clear()
                    for name, x in zip(out, (len(words), len(words) - sum(rare.values()), total, list(rare), list(rare.values()))):
                        out[name].append(x)
                n = len(texts)
                types = (pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int64()))
                done.append(pa.RecordBatch.from_arrays([*[batch.column(c)[first : first + n] for c in names[:3]], pa.array(scores), pa.array([len(t) for t in texts], pa.int64()), *[pa.array(v, y) for v, y in zip(out.values(), types)]], names))
        return pa.Table.from_batches(done)

    schema = f"row long, id {kind}, held_out boolean, score double, bytes long, n_tokens long, n_known long, log_sum double, rare array<binary>, times array<long>"
    scored = scratch.put("scored", texts.groupBy("batch").cogroup(wanted.groupBy("batch")).applyInArrow(run, schema))
    shared.unpersist()
    for name in ("texts", "wanted"):
        scratch.drop(name)
    lone = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("token"), F.col("x.times").alias("times"))
    found = lone.join(tokens.where(F.col("c") < least).hint("merge"), "token")
    # Sums of whole numbers of 1e-12 do not depend on the order of rows.
    extra = found.groupBy("row").agg(F.sum("times").alias("more_known"), (F.sum((F.col("times") * F.round(F.log10(F.col("c") + 1) * 1e12)).cast("decimal(38,0)")).cast("double") / 1e12).alias("more_sum"))
    rows = scored.drop("rare", "times").join(extra.hint("merge"), "row", "left")
    total = F.col("log_sum") + F.coalesce("more_sum", F.lit(0.0)) - F.col("n_tokens") * F.lit(math.log10(n_train + n_distinct + 1))
    return rows.select(
        F.col("id").alias(doc_id), "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"), total.alias("base_score"), "score",
        (-F.col("score") * F.lit(math.log2(10)) / (F.col("bytes") + 1)).alias("bits_per_byte"),
    )
