"""Packing documents into token sequences of a fixed length.

Texts become ids once; what is packed are the lengths of their pieces.
Pieces are dealt to groups of bounded size, each packed by itself: best-fit
decreasing first, then a swap-based local search. It takes the emptiest bin
and moves its documents to other underfull bins, or exchanges one for one,
two for one or one for two, where that fills the other bin further; each
step raises the sum of squared fills, and bins become empty and go. The search
ends at the lower bound or when it can empty no bin. What groups leave
in bins that are far from full is dealt anew and packed together, level by
level, so that groups cost no sequences of their own.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import cut

LENGTH = 2048
END_ID = 0
#: Pieces that one task packs.
GROUP = 8192
#: Bins with more room than this part of their length are packed again with those of other groups.
LOOSE = 1 / 16
#: Runs of a text whose ids a task keeps at hand.
KNOWN = 1_000_000
_PLACE = re.compile(r"(?<=\S)( )(?=\S)|(?<=\S)(\n)(?=\S)")
_WIDE = re.compile(r"\s\s")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes, all by the tokenizers library.

    The vocabulary splits a text before each single space and around each
    single line feed between other characters, whatever stands there, so
    the runs between those places are encoded by themselves, each different
    run once; many go through the library together, one in a line.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.known: dict[str, bytes] = {"": b""}
        line = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.line = line[0] if len(line) == 1 else None
        shape = str(self.tokenizer.pre_tokenizer.__getstate__().decode()) if self.tokenizer.pre_tokenizer is not None else ""
        self.by_run = self.line is not None and self.tokenizer.normalizer is None and '"ByteLevel"' in shape and '"add_prefix_space":false' in shape and '"use_regex":true' in shape

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _marked(self, text: str) -> str:
        """The text with a zero character at each place between runs."""
        if _WIDE.search(text):
            return _PLACE.sub(lambda m: "\0 " if m[1] else "\0\n\0", text)
        return text.replace("\n", "\0\n\0").replace(" ", "\0 ")

    def _learn(self, runs: list[str]) -> None:
        # White space at the ends would flow into the line feeds between them.
        inner = [r[1:] if r[0] == " " else r for r in runs]
        lone = [not (self.by_run and i and i == i.strip() and "\n" not in i) for i in inner]
        plain = [r for r, x in zip(runs, lone) if not x]
        lines = ["\n".join(plain[i : i + 256]) for i in range(0, len(plain), 256)]
        found = [np.array([*e.ids, self.line], "<u4") for e in self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)]
        raw = np.concatenate(found) if found else np.zeros(0, "<u4")
        ends, raw, at = (np.flatnonzero(raw == self.line) * 4).tolist(), raw.tobytes(), 0
        for run, end in zip(plain, ends, strict=True):
            self.known[run] = raw[at:end]
            at = end + 4
        for run, x in zip(runs, lone):
            if x:
                self.known[run] = self._ids(run)

    def __call__(self, texts: list[str]) -> list[bytes]:
        whole = [not self.by_run or "\0" in t for t in texts]
        marked = pa.array([t if w else self._marked(t) for t, w in zip(texts, whole)], pa.large_string())
        parts = pc.split_pattern(pc.if_else(pa.array(whole), pa.scalar("", pa.large_string()), marked), "\0")
        coded = parts.flatten().dictionary_encode()
        runs = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.known) > KNOWN:
            self.known = {"": b""}
        missed = [r for r in runs if r not in self.known]
        if missed:
            self._learn(missed)
        found = list(map(self.known.__getitem__, runs))
        sizes = np.array(list(map(len, found)), np.int64) // 4
        each = coded.indices.to_numpy()
        n, first = sizes[each], np.cumsum(sizes) - sizes
        ends = np.cumsum(n)
        ids = np.frombuffer(b"".join(found), "<u4")[np.repeat(first[each] - (ends - n), n) + np.arange(n.sum())]
        bounds = np.r_[0, ends][parts.offsets.to_numpy()].tolist()
        return [self._ids(t) if w else ids[a:b].tobytes() for t, w, a, b in zip(texts, whole, bounds, bounds[1:])]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _some(batches: Iterator[pd.DataFrame], most: int = 1 << 21) -> Iterator[pd.DataFrame]:
    """Rows of some ``most`` characters of text at a time."""
    for batch in batches:
        group = batch["text"].str.len().fillna(0).cumsum() // most
        for _, part in batch.groupby(group, sort=False):
            yield part


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of each document: its ids and a closing id 0.

    Documents of up to ``length`` ids are one piece; longer ones are cut into
    pieces of ``length``, of which the first may be shorter. A null text is an
    empty one: the closing id alone. Repeated rows and rows with null ids are
    documents of their own. Texts of any length are taken whole; a task holds
    the ids of one. Other columns are left out; an empty table gives no rows.
    """
    path = tokenizer or default_tokenizer()
    kind = dict(docs.dtypes)[doc_id]
    end = np.array([END_ID], "<u4").tobytes()

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path)
        for batch in _some(batches):
            out: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
            for key, ids in zip(batch["doc_id"], encode([value or "" for value in batch["text"]])):
                ids += end
                n = len(ids) // 4
                cuts = [0, *range(n - (n - 1) // length * length, n + 1, length)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    part = ids[4 * a : 4 * b]
                    for name, x in zip(out, (key, k, a, b - a, zlib.crc32(part), np.frombuffer(part, "<u4").astype("int32") if with_ids else None)):
                        out[name].append(x)
            frame = pd.DataFrame({**out, "doc_id": pd.Series(out["doc_id"], dtype=batch["doc_id"].dtype)})
            yield frame if with_ids else frame.drop(columns="ids")

    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return slim.mapInPandas(make, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids)


def fill(lengths: np.ndarray, room: int = LENGTH) -> list[list[int]]:
    """Best-fit decreasing: bins of positions in ``lengths``."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(room + 1)]
    open_rooms = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fits = open_rooms >> n
        if fits:
            r = n + (fits & -fits).bit_length() - 1
            b = by_room[r].pop()
            if not by_room[r]:
                open_rooms &= ~(1 << r)
            bins[b].append(i)
        else:
            r, b = room, len(bins)
            bins.append([i])
        if r > n:
            by_room[r - n].append(b)
            open_rooms |= 1 << (r - n)
    return bins


class _Search:
    """The underfull bins as flat arrays: the length and the bin of each item, the room of each bin."""

    def __init__(self, lengths: np.ndarray, bins: list[list[int]], room: int):
        self.item = np.array([i for b in bins for i in b], np.int64)
        self.size = lengths[self.item].astype(np.int64)
        self.bin = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
        self.room = room - np.bincount(self.bin, self.size, len(bins)).astype(np.int64)
        self.full = room

    def empty(self, e: int) -> bool:
        """Steps that take from bin e and fill others, until it is empty or no step is left."""
        while True:
            own = np.flatnonzero(self.bin == e)
            if not len(own):
                return True
            own = own[np.argsort(-self.size[own], kind="stable")]
            own = own[np.r_[True, self.size[own][1:] != self.size[own][:-1]]] if len(own) > 64 else own  # of many equal ones, one will do
            if not (self._move(e, own) or self._one_for_one(e, own) or self._two_for_one(e, own) or self._one_for_two(e, own)):
                return False

    def _helps(self, e: int, b: int, gain: int) -> bool:
        """The sum of squared fills grows when ``gain`` goes from e to b."""
        return gain > 0 and (self.full - self.room[b]) + gain > self.full - self.room[e]

    def _trade(self, e: int, b: int, give: list[int], take: list[int]) -> bool:
        gain = int(self.size[give].sum() - self.size[take].sum())
        if gain > self.room[b] or not self._helps(e, b, gain):
            return False
        self.bin[give], self.bin[take] = b, e
        self.room[e] += gain
        self.room[b] -= gain
        return True

    def _move(self, e: int, own: np.ndarray) -> bool:
        for x in own:
            spare = self.room - self.size[x]
            spare[e] = -1
            spare[self.room == self.full] = -1  # a bin that is empty already
            fit = np.flatnonzero(spare >= 0)
            if len(fit) and self._trade(e, int(fit[np.argmin(spare[fit])]), [x], []):
                return True
        return False

    def _swap(self, e: int, give: list[int]) -> bool:
        """The items for one of another bin: the one that fills its bin most."""
        gain = self.size[give].sum() - self.size
        ok = (gain > 0) & (gain <= self.room[self.bin]) & (self.bin != e)
        if not ok.any():
            return False
        y = int(np.argmax(np.where(ok, gain, 0)))
        return self._trade(e, int(self.bin[y]), give, [y])

    def _one_for_one(self, e: int, own: np.ndarray) -> bool:
        return any(self._swap(e, [x]) for x in own)

    def _one_for_two(self, e: int, own: np.ndarray) -> bool:
        """Two of bin e for one of another bin."""
        return any(self._swap(e, [x, z]) for i, x in enumerate(own) for z in own[i + 1 :])

    def _two_for_one(self, e: int, own: np.ndarray) -> bool:
        """Two of another bin for one of bin e: of each first one, the smallest second that the bin's room allows."""
        order = np.lexsort((self.size, self.bin))
        size, at = self.size[order], self.bin[order]
        key = at * (4 * self.full) + size
        for x in own:
            need = np.maximum(self.size[x] - self.room[at] - size, 0)
            second = np.searchsorted(key, at * (4 * self.full) + need)
            second += second == np.arange(len(order))
            second = np.minimum(second, len(order) - 1)
            gain = self.size[x] - size - size[second]
            ok = (at[second] == at) & (second != np.arange(len(order))) & (at != e) & (gain > 0) & (gain <= self.room[at])
            if ok.any():
                k = int(np.argmax(np.where(ok, gain, 0)))
                if self._trade(e, int(at[k]), [x], [int(order[k]), int(order[second[k]])]):
                    return True
        return False


def least_bins(lengths: np.ndarray, room: int = LENGTH) -> int:
    """A lower bound: what the sum needs, or the lengths of which no two share a bin."""
    return max(-(-int(lengths.sum()) // room), int((lengths > room / 2).sum()))


def pack_lengths(lengths: np.ndarray, room: int = LENGTH) -> np.ndarray:
    """The bin of each length, none above ``room`` and none empty: bins are numbered from 0."""
    lengths = np.asarray(lengths, np.int64)
    if not len(lengths):
        return np.zeros(0, np.int64)
    bins = fill(lengths, room)
    used = np.array([lengths[b].sum() for b in bins])
    closed = [b for b, u in zip(bins, used) if u == room]
    open_bins = [b for b, u in zip(bins, used) if u < room]
    out = np.zeros(len(lengths), np.int64)
    for k, b in enumerate(closed):
        out[b] = k
    if open_bins:
        s = _Search(lengths, open_bins, room)
        least, alive, stuck = least_bins(s.size, room), len(open_bins), np.zeros(len(open_bins), bool)
        while alive > least:
            waits = np.where((s.room < room) & ~stuck, s.room, -1)
            e = int(np.argmax(waits))
            if waits[e] < 0:
                break
            if s.empty(e):
                alive -= 1
                stuck[:] = False
            else:
                stuck[e] = True
        _, number = np.unique(s.bin, return_inverse=True)
        out[s.item] = number + len(closed)
    return out


def pack(parts: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """Adds sequence_id and offset to pieces (doc_id, piece, start, length and any other columns).

    Sequences hold at most ``length`` ids and are filled from 0 without gaps.
    Rows are told apart by their place in ``parts``, which has to be a table
    that reads alike each time, so repeated rows and null ids are dealt to
    groups like any others; ties go by that place. Columns that are named like
    the two new ones are replaced. Pieces longer than ``length`` raise an
    error; an empty table gives no rows.
    """
    kept = [c for c in parts.columns if c not in ("sequence_id", "offset")]
    rows = parts.select(*[F.col(f"`{c}`") for c in kept], F.monotonically_increasing_id().alias("__wl_row"))
    schema = "__wl_row long, length long, sequence_id long, offset long, loose boolean"

    def packed(slim: DataFrame, groups: int, level: int) -> DataFrame:
        def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
            frame = frame.sort_values("__wl_row")
            sizes = frame["length"].to_numpy()
            if sizes.max() > length:
                raise ValueError(f"a piece of {sizes.max()} ids does not fit into {length}")
            at = pack_lengths(sizes, length)
            room = length - np.bincount(at, sizes)
            frame = pd.DataFrame({"__wl_row": frame["__wl_row"], "length": sizes, "sequence_id": at + (((level << 24) + int(key[0])) << 31), "loose": (room > length * LOOSE)[at]})
            frame = frame.iloc[np.argsort(at, kind="stable")]
            frame["offset"] = frame.groupby("sequence_id")["length"].cumsum() - frame["length"]
            return frame[["__wl_row", "length", "sequence_id", "offset", "loose"]]

        dealt = F.pmod(F.xxhash64(F.lit(level), "__wl_row"), F.lit(groups)).cast("long")
        return slim.select("__wl_row", "length", dealt.alias("__wl_group")).groupBy("__wl_group").applyInPandas(run, schema)

    left, done, level = rows.select("__wl_row", F.col("length").cast("long").alias("length")), None, 0
    groups = max(1, -(-parts.count() // group))
    while True:
        found = packed(left, groups, level)
        if groups == 1:
            break
        found = cut(found)
        left = found.where("loose").select("__wl_row", "length")
        fewer = max(1, -(-left.count() // group))
        if fewer > groups // 2:  # hardly any bin had room: another level would gain nothing
            break
        done = found.where("not loose") if done is None else done.unionByName(found.where("not loose"))
        groups, level = fewer, level + 1
    found = found if done is None else done.unionByName(found)
    places = found.select(F.col("__wl_row").alias("__wl_at"), "sequence_id", "offset")
    return rows.join(places.hint("merge"), F.col("__wl_row") == F.col("__wl_at")).select(*[F.col(f"`{c}`") for c in kept], "sequence_id", "offset")


def pack_documents(docs: DataFrame, **options) -> DataFrame:
    """Pieces of all documents with the sequence and the place that each got."""
    return pack(cut(pieces(docs, **options)), options.get("length", LENGTH))
