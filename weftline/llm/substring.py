"""Substring dedup by relative Lempel-Ziv parsing against indexed reference blocks.

A window is a run of ``window`` words. Each window picks one block of
``block`` words inside it, the leftmost with the smallest hash: equal windows
pick equal blocks at equal places, wherever they stand. The blocks picked, a
small part of all words, are the index of the reference, which is the whole
table. The consecutive windows of a document that picked the same block make
up a run, the words that this block can vouch for.

A run whose block occurs nowhere else is left alone, and a run that occurs
twice as a whole, by two hashes, is a duplicate span at once. The others meet
the reference blocks around the same index entry, each a different run: every run is
parsed greedily against them, at each place by the longest match, extended
word by word in the reference block that holds it. A factor of ``window``
words or more is a duplicate span; the windows over its boundary are looked up
one by one, and the next factor begins at the first that is found. All of this
compares words, not hashes.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import Scratch

WINDOW = 35
BLOCK = 12
#: Reference blocks of one index entry that a task holds; the windows of more are dealt to several tasks.
BLOCKS = 8192
#: Words whose hashes a task holds at once, and distinct words whose hashes it keeps.
BATCH_WORDS = 1 << 18
CACHED = 300_000
_B1, _B2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHED:
            self.clear()
        found = self[word] = xxhash.xxh3_128_digest(word)
        return found


def split(text: bytes | None) -> list[bytes]:
    return (text or b"").split()  # at \x20 and \x09-\x0D, as bytes do


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def rolling(h: np.ndarray, n: int, base: np.uint64) -> np.ndarray:
    """The hash of each run of n words, by doubling."""
    out, have, power, size, step = None, 0, base, 1, h
    while True:
        if n & size:
            if out is None:
                out, have = step, size
            else:
                m = len(h) - have - size + 1
                out, have = out[:m] * power + step[have : have + m], have + size
        if size * 2 > n:
            return out
        m = len(step) - size
        step, power, size = step[:m] * power + step[size:], power * power, size * 2


def _leftmost(value: np.ndarray, n: int) -> np.ndarray:
    """The position of the smallest of each n neighbours, the leftmost of equals."""
    at, best, size = np.arange(len(value)), value, 1
    while size < n:
        step = min(size, n - size)
        m = len(best) - step
        right = best[step:] < best[:m]
        at, best, size = np.where(right, at[step:], at[:m]), np.where(right, best[step:], best[:m]), size + step
    return at


class Runs:
    """The runs of a batch of documents: first window, number of windows, place of the block, its hash, hash of the whole."""

    def __init__(self, texts: list[bytes | None], hashes: _Hashes, window: int, block: int):
        words = [split(t) for t in texts]
        sizes = np.array([len(w) for w in words], np.int64)
        joined = b"".join(b"".join(map(hashes.__getitem__, w)) for w in words)
        self.h = np.frombuffer(joined, "<u8").reshape(-1, 2)
        self.ends = np.cumsum(sizes)
        self.begins = self.ends - sizes
        self.window = window
        empty = np.zeros(0, np.int64)
        self.doc = self.first = self.count = self.place = empty
        self.block_hash = self.whole_hash = np.zeros(0, np.uint64)
        if len(self.h) < window:
            return
        with np.errstate(over="ignore"):
            blocks = rolling(self.h[:, 0], block, _B1)
            owner = _leftmost(_mix(blocks), window - block + 1)
            doc = np.repeat(np.arange(len(sizes)), sizes)[: len(owner)]
            valid = np.flatnonzero(np.arange(len(owner)) + window <= self.ends[doc])
            if not len(valid):
                return
            own = owner[valid]
            start = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            self.first, self.count = valid[start], np.diff(np.r_[start, len(own)])
            self.doc = doc[self.first]
            at = own[start]
            self.place = at - self.first
            self.block_hash = blocks[at]
            power = np.cumprod(np.full(len(self.h), _B2))
            prefix = np.r_[np.uint64(0), np.cumsum(self.h[:, 1] * power)]
            inverse = np.uint64(pow(int(_B2), -1, 1 << 64))
            back = np.cumprod(np.full(len(self.h), inverse))
            last = self.first + self.count - 1 + window
            span = (prefix[last] - prefix[self.first]) * back[self.first]
            shape = (at - self.first).astype(np.uint64) * np.uint64(64) + self.count.astype(np.uint64)
            self.whole_hash = _mix(_mix(span) + shape * _B1)


def pack(first, place, count):
    """A run or a span as one number: first word, place of the block in it, number of windows."""
    return (first << 12) | (place << 6) | (count - 1)


def parse(segments: list[list[bytes]], window: int, mine=None) -> list[list[tuple[int, int]]]:
    """The factors (first word, words) of ``window`` words or more of each segment, relative to the others.

    The reference index leads from the words of a window to the first two
    segments that hold it. ``mine`` tells which windows this task looks up;
    matches are extended through all.
    """
    index: dict[bytes, list[tuple[int, int]]] = {}
    keys = []
    for n, words in enumerate(segments):
        line = [b" ".join(words[p : p + window]) for p in range(len(words) - window + 1)]
        keys.append(line)
        for p, key in enumerate(line):
            if mine is None or mine(key):
                held = index.setdefault(key, [])
                if len(held) < 2 and (not held or held[0][0] != n):
                    held.append((n, p))
    out = []
    for n, (words, line) in enumerate(zip(segments, keys)):
        factors, p = [], 0
        while p < len(line):
            other = next(((m, q) for m, q in index.get(line[p], ()) if m != n), None)
            if other is None:
                p += 1
                continue
            reference, at = segments[other[0]], other[1] + window
            end = p + window
            while end < len(words) and at < len(reference) and words[end] == reference[at]:
                end, at = end + 1, at + 1
            factors.append((p, end - p))
            p = end - window + 1  # the first window over the boundary
        out.append(factors)
    return out


def _batches(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int]]:
    """Row ranges of some BATCH_WORDS words: bytes / 4 is about their number."""
    sizes = [len(x) // 4 + 1 for x in (v.as_buffer() if v.is_valid else b"" for v in batch.column(column))]
    lo = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > BATCH_WORDS:
            yield lo, i
            lo = i
            total = 0
        total += n
    if lo < len(sizes):
        yield lo, len(sizes)


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows are told apart by id and hash of the text; rows with the same of both have the same result."""
    return docs.select(F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("th"), F.col(text).cast("binary").alias("t"))


def _same_doc(a: DataFrame, b: DataFrame):
    return a["id"].eqNullSafe(b["id2"]) & (a["th"] == b["th2"])


def duplicate_spans(docs: DataFrame, scratch: Scratch, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, block: int = BLOCK, most: int = BLOCKS) -> DataFrame:
    """(id, th, spans): for each document with duplicates, its spans, see ``pack``.

    Together the spans of a document hold exactly the words that lie in a
    window whose words also start elsewhere.
    """
    if not block <= window < block + 64:
        raise ValueError("a window holds its block and at most 64 places for it")
    keyed = _keyed(docs, doc_id, text)
    kind = dict(keyed.dtypes)["id"]

    def found_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            for lo, hi in _batches(batch, "t"):
                f = Runs(batch.column("t")[lo:hi].to_pylist(), hashes, window, block)
                packed = pack(f.first - f.begins[f.doc], f.place, f.count)
                rows = pa.array(f.doc + lo)
                yield pa.RecordBatch.from_arrays([pa.array(f.block_hash.view(np.int64)), pa.array(f.whole_hash.view(np.int64)), batch.column("id").take(rows), batch.column("th").take(rows), pa.array(packed)], ["h", "c", "id", "th", "s"])

    runs = scratch.put("runs", keyed.mapInArrow(found_runs, f"h long, c long, id {kind}, th long, s long"))
    # A block that occurs once vouches for nothing. Minimum and maximum of the runs around it tell whether they differ.
    # Each side of a join on hashes is a table of its own, so Spark can split what one hash brings together.
    blocks = runs.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("c0"), F.max("c").alias("c1")).where("n > 1").select("h", (F.col("c0") != F.col("c1")).alias("mixed"))
    shared = scratch.put("shared", runs.join(scratch.put("blocks", blocks).hint("merge"), "h"))
    scratch.drop("runs")
    alike = shared.where("not mixed").select("id", "th", "s")
    mixed = shared.where("mixed")
    counts = mixed.groupBy("h", "c").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "th", "s")).alias("one"))
    counts = scratch.put("mixed", counts)
    twice = mixed.join(counts.where("n > 1").select("h", "c").hint("merge"), ["h", "c"], "left_semi").select("id", "th", "s")
    # Each different run around a shared block is a reference block of its index entry, and is parsed against the others.
    parts = scratch.put("parts", counts.groupBy("h").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("parts")))
    entries = counts.join(parts.hint("merge"), "h").select("one.id", "one.th", F.struct("h", "one.s", "parts").alias("e"))
    entries = entries.groupBy(F.col("id").alias("id2"), F.col("th").alias("th2")).agg(F.collect_list("e").alias("e"))
    joined = keyed.join(entries.hint("merge"), _same_doc(keyed, entries)).select("id", "th", "t", "e")

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The words of each run; where its index entry is dealt to several tasks, for each that looks up one of its windows."""
        for batch in batches:
            for i, t in enumerate(batch.column("t")):
                words, out = split(t.as_py()), []
                for e in batch.column("e")[i].as_py():
                    first, count = e["s"] >> 12, (e["s"] & 63) + 1
                    run = words[first : first + count + window - 1]
                    wanted = [0] if e["parts"] == 1 else sorted({zlib.crc32(b" ".join(run[p : p + window])) % e["parts"] for p in range(count)})
                    out += [(e["h"], part, e["parts"], e["s"], b" ".join(run)) for part in wanted]
                rows = pa.array(np.full(len(out), i))
                columns = [pa.array(x, k) for x, k in zip(zip(*out), (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()))]
                yield pa.RecordBatch.from_arrays([*columns, batch.column("id").take(rows), batch.column("th").take(rows)], ["h", "part", "parts", "s", "run", "id", "th"])

    met = joined.mapInArrow(segments, f"h long, part int, parts int, s long, run binary, id {kind}, th long").repartition("h", "part").sortWithinPartitions("h", "part")

    def factor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None

        def done() -> pa.RecordBatch:
            """The factors of all runs of an index entry."""
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            part, n = last[1], table.column("parts")[0].as_py()
            found = parse([split(r) for r in table.column("run").to_pylist()], window, None if n == 1 else lambda key: zlib.crc32(key) % n == part)
            rows = pa.array([i for i, x in enumerate(found) for _ in x], pa.int64())
            begin = table.column("s").to_numpy() >> 12
            spans = [pack(int(begin[i]) + p, 0, size - window + 1) for i, x in enumerate(found) for p, size in x]
            return pa.RecordBatch.from_arrays([table.column("id").take(rows), table.column("th").take(rows), pa.array(spans, pa.int64())], ["id", "th", "s"])

        for batch in batches:
            h, part = batch.column("h").to_numpy(), batch.column("part").to_numpy()
            edges = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (part[1:] != part[:-1])]).tolist() if len(h) else []
            for lo, hi in zip(edges, [*edges[1:], len(h)]):
                key = (int(h[lo]), int(part[lo]))
                if held and key != last:
                    yield done()
                    held = []
                last = key
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield done()

    factors = met.mapInArrow(factor, f"id {kind}, th long, s long")
    spans = alike.union(twice).union(factors)
    found = scratch.put("spans", spans.groupBy("id", "th").agg(F.collect_set("s").alias("spans")))
    for name in ("blocks", "shared", "mixed", "parts"):
        scratch.drop(name)
    return found


def covered(n: int, spans: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Which of n words lie in the spans."""
    first, last = spans >> 12, (spans >> 12) + (spans & 63) + window
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, first, 1)
    np.add.at(step, last, -1)
    return np.cumsum(step[:-1]) > 0


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """Adds n_words, n_removed, kept_sha256 and kept_text to the rows of docs; columns with these names are replaced.

    Removed is each word in a window whose words start anywhere else in the
    table too, in the same document or another, the input judged as a whole;
    of equal windows none stays. kept_text is null where nothing is removed,
    else the other words joined by one space. Null and empty texts have no words.
    Repeated rows are duplicates of each other; ids may repeat or be null; a
    text of any length is taken whole; an empty table gives no rows. Runs that
    occur more than once as a whole are told by two 64-bit hashes of different
    bases, all others by their words.
    """
    made = {"n_words": "long", "n_removed": "long", "kept_sha256": "string", "kept_text": "string"}
    scratch = Scratch(docs.sparkSession)
    spans = duplicate_spans(docs, scratch, doc_id, text, window, block).select(F.col("id").alias("id2"), F.col("th").alias("th2"), "spans")
    rest = [c for c in docs.columns if c not in made]
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest if c != text]).alias("row"), F.col(f"`{doc_id}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("th"), F.col(f"`{text}`").cast("binary").alias("t"))
    joined = base.join(spans.hint("merge"), _same_doc(base, spans), "left").select("row", "t", "spans")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {k: [] for k in made}
            for t, s in zip(batch.column("t"), batch.column("spans")):
                words = split(t.as_py())
                gone = covered(len(words), s.values.to_numpy(), window) if s.is_valid else np.zeros(len(words), bool)
                kept = b" ".join(w for w, g in zip(words, gone.tolist()) if not g) if s.is_valid else b" ".join(words)
                for k, v in zip(made, (len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace") if s.is_valid else None)):
                    out[k].append(v)
            types = (pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("t"), *[pa.array(v, y) for v, y in zip(out.values(), types)]], ["row", "t", *made])

    schema = f"row {base.schema['row'].dataType.simpleString()}, t binary, n_words long, n_removed long, kept_sha256 string, kept_text string"
    done = joined.mapInArrow(keep, schema)
    return done.select(*[(F.col("t").cast("string").alias(c) if c == text else F.col(f"row.`{c}`").alias(c)) for c in rest], *made)
