"""Mixing (1), packing (7), WARC (6) and scoring (4) against brute force, round trips and held-out texts."""

from __future__ import annotations

import hashlib
import io
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from weftline.llm import ctw, mixing, packing, queries, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_targets(sizes):
    """Shares by weight, the excess over 3 times a size shared again until none is above."""
    weight = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    total, capped = sum(sizes), set()
    while True:
        left = total - sum(3 * sizes[i] for i in capped)
        w = sum(weight[i] for i in range(len(sizes)) if i not in capped)
        share = {i: left * weight[i] / w for i in range(len(sizes)) if i not in capped}
        over = {i for i, s in share.items() if s > 3 * sizes[i] + 1e-9}
        if not over:
            return [3.0 * sizes[i] if i in capped else share[i] for i in range(len(sizes))]
        capped |= over


def mixture(seed=1):
    r = random.Random(seed)
    rows = []
    for name, n, most in (("a", 40, 300), ("b", 300, 400), ("ä", 10, 30), ("z", 5, 3000), (None, 20, 100), ("empty", 3, 0)):
        rows += [(len(rows) + i, name, " ".join(f"{name}{i}w{j}" for j in range(r.randrange(most + 1)))) for i in range(n)]
    return rows + [(9000, "a", None), (9001, "a", ""), (9001, "a", ""), (9002, "z", "big " * 20000), (9003, "b", "same text here"), (9003, "b", "same text here")]


def test_mix_reaches_its_targets(spark):
    rows = mixture()
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    pieces, sources = mixing.mix(mixing.sized(docs).drop("text"))
    got = mixing.word_counts(docs).toPandas()
    got["source"] = got.doc_id.map({i: s for i, s, _ in rows})
    assert len(got) == len(rows)
    assert sorted(got["size"]) == sorted(len(WORD.findall(t or "")) for _, _, t in rows)
    order = sorted({s for _, s, _ in rows if s is not None}) + [None]
    sizes = [sum(len(WORD.findall(t or "")) for _, s, t in rows if s == o) for o in order]
    per = {None if r.source is None else r.source: r for r in got.where(got.notna(), None).drop_duplicates("source").itertuples()}
    for name, size, target in zip(order, sizes, slow_targets(sizes)):
        assert per[name].source_size == size and per[name].target == pytest.approx(target, rel=1e-12)
        mine = got[got.source.isna() if name is None else got.source == name]
        assert abs(mine.taken.sum() - target) <= max(2, min(65, target / 50))
    assert (got.taken <= 3 * got["size"]).all()
    again = mixing.word_counts(docs.repartition(3)).toPandas()
    key = ["doc_id", "taken"]
    assert got.sort_values(key).taken.tolist() == again.sort_values(key).taken.tolist()
    # Every slot holds one block, and no block comes twice in a pass.
    p = pieces.where("slot is not null").toPandas()
    s = sources.toPandas()
    blocks = p[["slot", "source", "block", "epoch", "shard"]].drop_duplicates()
    assert sorted(blocks.slot) == list(range(int(s.n_slots.sum()))) and (blocks.slot // 1024 == blocks["shard"]).all()
    assert not blocks.duplicated(["source", "block", "epoch"]).any()
    assert p.groupby("slot").apply(lambda g: (g.to_word - g.from_word).sum(), include_groups=False).max() <= 64


def test_permutations_are_permutations():
    for n in (1, 2, 3, 5, 64, 1000, 4097):
        for key in (0, 7, 1 << 60):
            assert sorted(mixing.permuted(np.arange(n), np.full(n, n), np.full(n, key, np.uint64))) == list(range(n))


def test_mixed_texts_are_pieces_of_documents(spark):
    rows = [(i, t, s, "x") for i, s, t in mixture(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    out = mixing.mixed_texts(docs)
    assert out.columns == docs.columns
    whole = {i: WORD.findall(t or "") for i, t, _, _ in rows}
    taken = Counter()
    for r in out.collect():
        words = WORD.findall(r.text)
        assert words and r.size == "x"
        it = iter(whole[r.doc_id])
        assert all(w in it for w in words)  # a subsequence
        taken[r.source] += len(words)
    sources = {s for _, _, s, _ in rows}
    order = sorted(s for s in sources if s is not None) + [None]
    sizes = [sum(len(whole_) for whole_ in (WORD.findall(t or "") for _, t, s, _ in rows if s == o)) for o in order]
    for name, target in zip(order, slow_targets(sizes)):
        assert abs(taken[name] - target) <= 65
    assert mixing.mixed_texts(docs.limit(0)).count() == 0


def test_mix_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, source string, size long")
    assert mixing.mix(none)[0].count() == 0
    blank = spark.createDataFrame([(1, "a", 0), (2, None, 0)], "doc_id long, source string, size long")
    assert [r.taken for r in mixing.taken(mixing.mix(blank)[0], ["doc_id", "size"]).collect()] == [0, 0]


def test_mix_of_small_sources_and_clashing_columns(spark):
    rows = [(i, s, "w " * 10, 1, 2, "x") for i, s in enumerate("aaabbbccc")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, start int, rank int, slot string")
    got = mixing.word_counts(docs).toPandas().groupby("source_size").taken.sum()
    per = mixing.word_counts(docs).toPandas()
    per["source"] = per.doc_id.map(lambda i: rows[i][1])
    taken = per.groupby("source").taken.sum().to_dict()
    assert all(abs(taken[s] - t) <= 1 for s, t in (("a", 56.25), ("b", 22.5), ("c", 11.25))) and got.sum() == sum(taken.values())
    pieces, _ = mixing.mix(mixing.sized(docs))
    assert pieces.columns.count("start") == 1 and "rank" in pieces.columns and pieces.where("rank <> 2").count() == 0
    # Rows of one id and different texts: reruns in another order agree.
    same = spark.createDataFrame([(1, "a", f"{'w ' * (i % 7)}x{i}") for i in range(300)] + [(2, "b", "y " * 90)], "doc_id long, source string, text string")
    runs = [sorted(map(tuple, mixing.word_counts(d).collect())) for d in (same, same.repartition(5).orderBy("text"))]
    assert runs[0] == runs[1]


PACKED = [None, "", "a", "  two  spaces\n\n\tand tabs ", "naïve café ß", "日本語のテキスト 🙂", "x" * 9000, "word " * 5000, "<|endoftext|> is text", "it's they'll I'D 123 4.5", " nbsp em\x85nel", "a\r\nb \n c"]


def test_ids_and_pieces_against_the_tokenizer(spark):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(packing.default_tokenizer())
    plain.encode_special_tokens = True
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(PACKED)] + [(2, "a", 1), (None, "b", 1)], "doc_id long, text string, piece int")
    got = packing.pieces(docs, with_ids=True).toPandas()
    for i, t in enumerate(PACKED):
        ids = plain.encode(t or "", add_special_tokens=False).ids + [0]
        mine = got[got.doc_id == i].drop_duplicates("piece").sort_values("piece")
        assert [x for part in mine.ids for x in part] == ids
        assert mine.start.tolist() == np.r_[0, np.cumsum(mine.length)[:-1]].tolist() and (mine.length.iloc[1:] == 2048).all() and len(mine) == -(-len(ids) // 2048)
        assert mine.ids_crc32.tolist() == [zlib.crc32(np.array(x, "<u4").tobytes()) for x in mine.ids]
    out = packing.pack_documents(docs).toPandas()
    assert len(out) == len(got)
    for _, g in out.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.offset.tolist() == np.r_[0, np.cumsum(g.length)[:-1]].tolist() and g.length.sum() <= 2048
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_runs_give_the_ids_of_whole_texts():
    from tokenizers import Tokenizer

    mine, plain = packing.encoder(packing.default_tokenizer()), Tokenizer.from_file(packing.default_tokenizer())
    plain.encode_special_tokens = True
    assert mine.by_run
    r = random.Random(5)
    pools = [[chr(c) for c in range(0x250)], list(" \n\t\r\x0b\x0c\x85\xa0\x1c\x1d ab1'.,sS"), list("aeiou  thn'sre ll0123\n"), list(" \n\u3000\u2003\u180ex\u65e5a\0")]
    texts = ["".join(r.choices(r.choice(pools), k=r.randint(0, 60))) for _ in range(3000)]
    assert mine(texts) == [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


@pytest.mark.parametrize("sizes", [[], [2048], [1], [1024, 1024, 1025, 1023], [1000, 1000, 1048, 1048, 100, 1948], list(range(1, 600, 7)), [700] * 9])
def test_packing_is_valid_and_near_the_bound(sizes):
    at = packing.pack_lengths(np.array(sizes))
    used = np.bincount(at, sizes) if len(sizes) else np.zeros(0)
    assert len(at) == len(sizes) and (used <= 2048).all() and (used > 0).all()
    assert len(used) <= math.ceil(11 / 9 * max(1, sum(sizes) / 2048)) + 1


def test_local_search_empties_a_bin_that_best_fit_decreasing_needs():
    lengths, room = np.random.default_rng(146).integers(20, 45, 40), 100
    best_fit, found = len(packing.fill(lengths, room)), packing.pack_lengths(lengths, room)
    assert packing.least_bins(lengths, room) <= found.max() + 1 == best_fit - 1
    assert np.bincount(found, lengths).max() <= room
    search = packing._Search(np.array([6, 3, 5, 4, 1]), [[0, 1], [2, 3], [4]], 10)
    before = ((10 - search.room) ** 2).sum()
    assert search.empty(2) and ((10 - search.room) ** 2).sum() > before


def test_repeated_rows_and_null_ids_are_dealt_to_groups(spark):
    rows = [(None, 0, 0, 600 + i % 3, "x") for i in range(400)] + [(7, 0, 0, 100, "y")] * 100
    parts = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, offset string")
    sizes = parts.groupBy("length").count()
    out = packing.pack(parts, group=50).toPandas()
    assert sorted(out.length) == sorted(r[3] for r in rows) and sizes.count() == 4 and set(out.columns) == {"doc_id", "piece", "start", "length", "sequence_id", "offset"}
    used = out.groupby("sequence_id").length.sum()
    # Three of about 600 and two of 100 fit a sequence: 134 of them hold all, and groups of 50 cost at most a few more.
    assert used.max() <= 2048 and 134 <= len(used) <= 140 and out.sequence_id.map(lambda x: x >> 31).nunique() > 1


def pages():
    rows = [(i, f"http://h/{i}", f"<p>{i}</p>" * (i * 20)) for i in range(30)]
    big = "é" * 900
    return rows + [(100, "u", big), (105, "u", big), (103, "u", big), (105, "u", big), (200, None, None), (201, "a b\r\nX: y", ""), (None, "n", big), (300, "r", "".join(random.Random(1).choices("abc<> \r\n", k=400000))), (301, "s", "s" * 999), (302, "s", "s" * 999), (303, "t", "t" * 1000), (304, "t", "t" * 1000)]


@pytest.mark.parametrize("split", [warc.SPLIT, 997])
def test_warc_round_trip(spark, split):
    rows = pages()
    got = warc.roundtrip(spark.createDataFrame(rows, "page_id long, url string, html string"), with_payload=True, split=split).collect()
    assert len(got) == len(rows)
    body = {k: (h or "").encode() for k, _, h in rows}
    most = {}
    for k, _, h in rows:
        h = (h or "").encode()
        if len(h) >= 1000 and k is not None:
            most[h] = max(most.get(h, k), k)
    for r in got:
        b = body[r.page_id]
        keeper = most.get(b)
        revisit = keeper is not None and keeper != r.page_id
        assert (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) == (len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", keeper if revisit else None)
        assert r.payload == (None if revisit else b)
    assert warc.roundtrip(spark.createDataFrame(rows, "page_id long, url string, html string").limit(0)).count() == 0


def test_warc_of_text_ids_and_lost_records(spark, monkeypatch):
    big = "x" * 2000
    rows = [("a b/<>", big, "q"), ("ü", big, "q"), ("", "s", "q"), (None, None, "q")]
    docs = spark.createDataFrame(rows, "page_id string, html string, record_type string")
    got = {r.page_id: (r.record_type, r.refers_to, r.payload_bytes) for r in warc.roundtrip(docs).collect()}
    assert got == {"a b/<>": ("revisit", "ü", 2000), "ü": ("response", None, 2000), "": ("response", None, 1), None: ("response", None, 0)}
    read = warc.read
    monkeypatch.setattr(warc, "read", lambda *a: read(*a).where("page_id = 'ü'"))
    with pytest.raises(ValueError, match="4 records were written and 1 read"):
        warc.roundtrip(docs)


def test_reader_skips_what_only_looks_like_a_record():
    record = lambda n: warc._record(n, "u", (b"x%d" % n) * 50, hashlib.sha1((b"x%d" % n) * 50).hexdigest(), None, False)
    zipped = lambda b: (c := zlib.compressobj(1, zlib.DEFLATED, 31)).compress(b) + c.flush()
    parts = [zipped(record(1)), b"\x1f\x8b\x08junk\x1f\x8b\x08\x00", zipped(b"not a record"), zipped(record(2)), zipped(record(3))[:-9], zipped(record(4))]
    data = b"".join(parts)
    for size in (1, 7, 64, len(data)):
        found = [warc.parse(r)["page_id"] for a in range(0, len(data), size) for _, r in warc.records(io.BytesIO(data), a, min(len(data), a + size))]
        assert found == ["1", "2", "4"]


def test_base_counts_and_scores(spark):
    texts = [None, "", "the cat sat", "The CAT sat on the mat", "unseen\x1cword é", "the " * 3000, "a\nb\tc"]
    rows = [(i, texts[i % len(texts)], "x") for i in range(40)] + [(3, texts[3], "x"), (None, "null id", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = ctw.score(docs, frequent=4).toPandas()
    held = lambda k: zlib.crc32(b"" if k is None else str(k).encode()) % 7 == 2
    tokens = lambda t: WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)})) + [""]
    count = Counter(w for k, t, _ in rows if not held(k) for w in tokens(t))
    n, v = sum(count.values()), len(count)
    want = sorted((-1 if k is None else k, held(k), len(tokens(t)), sum(w in count for w in tokens(t)), round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in tokens(t)), 6)) for k, t, _ in rows)
    mine = sorted((-1 if math.isnan(r.doc_id) else int(r.doc_id), r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got.itertuples())
    assert mine == want and (got.train_tokens == n).all() and (got.score < 0).all()
    assert ctw.score(docs.limit(0)).count() == 0


def slow_tree_probability(runs, depth, context, symbol):
    """P(byte | context) by the definition: recursive weighted probabilities over all nodes."""
    lg = math.lgamma
    kt = lambda a, b: lg(a + 0.5) + lg(b + 0.5) - lg(a + b + 1) - math.log(math.pi)

    def counts(suffix, prefix):
        out = [0, 0]
        for run, n in runs.items():
            bits = f"{run[-1]:08b}"
            if run[:-1].endswith(suffix) and bits.startswith(prefix):
                out[int(bits[len(prefix)])] += n
        return out

    def weighted(suffix, prefix):
        a, b = counts(suffix, prefix)
        own = kt(a, b)
        if len(suffix) == depth:
            return own
        more = {run[-2 - len(suffix) : -1] for run in runs if run[:-1].endswith(suffix)}
        children = sum(weighted(s, prefix) for s in more if sum(counts(s, prefix)))
        return float(np.logaddexp(own, children)) - math.log(2)

    p, bits = 1.0, f"{symbol:08b}"
    for j in range(8):
        one = 0.5
        for d in range(depth, -1, -1):
            s = context[len(context) - d :]
            a, b = counts(s, bits[:j])
            if a + b == 0:
                continue
            est = (b + 0.5) / (a + b + 1)
            share = 1.0 if d == depth else math.exp(kt(a, b) - math.log(2) - weighted(s, bits[:j]))
            one = share * est + (1 - share) * one
        p *= one if bits[j] == "1" else 1 - one
    return p


def grown(texts, depth):
    k, _ = ctw.keys(texts, depth)
    out = []
    for d in range(depth + 1):
        u, n = np.unique(k & np.uint64((1 << (8 * (d + 1))) - 1), return_counts=True)
        out.append((u, n))
    return ctw.Tree(out)


def test_tree_against_the_definition():
    depth, texts = 2, [b"abracadabra", b"abab", b""]
    k, _ = ctw.keys(texts, depth)
    runs = Counter(int(x).to_bytes(depth + 1, "big") for x in k)
    tree = grown(texts, depth)
    for context in (b"ab", b"br", b"zz", b"\xff\xff", b"za"):
        for symbol in b"abcz\xff":
            got = math.exp(tree.log_probability(np.array([int.from_bytes(context + bytes([symbol]), "big")], np.uint64))[0])
            assert got == pytest.approx(slow_tree_probability(runs, depth, context, symbol), rel=1e-4)


def test_score_against_the_definition(spark):
    """The whole operator on a small table: counting, dealing, joining and scoring."""
    texts = ["abracadabra", "Abba", None, "", "cab\xe9", "rac rac", "zebra"]
    docs = spark.createDataFrame([(i, texts[i % len(texts)]) for i in range(12)], "doc_id long, text string")
    held, lower = lambda k: zlib.crc32(str(k).encode()) % 7 == 2, lambda t: (t or "").encode().lower()
    rows = [(r.doc_id, lower(r.text)) for r in docs.collect()]
    for depth in (1, 2, 3):
        runs = Counter(int(x).to_bytes(depth + 1, "big") for i, t in rows if not held(i) for x in ctw.keys([t], depth)[0])
        for r in ctw.score(docs, depth=depth).collect():
            t = dict(rows)[r.doc_id]
            padded = b"\xff" * depth + t + b"\xff"
            want = sum(math.log10(slow_tree_probability(runs, depth, padded[i : i + depth], padded[i + depth])) for i in range(len(t) + 1))
            assert r.score == pytest.approx(want, rel=1e-4)


def test_probabilities_sum_to_one_and_learning_pays():
    r = random.Random(2)
    vocabulary = ["".join(r.choices("abcdefgh", k=5)) for _ in range(30)]
    text = lambda n: " ".join(r.choices(vocabulary, k=n)).encode()
    tree = grown([text(2000)], 4)
    for context in (b"\xff\xff\xff\xff", b"abcd", text(1)[:4]):
        asked = np.array([int.from_bytes(context + bytes([s]), "big") for s in range(256)], np.uint64)
        assert np.exp(tree.log_probability(asked)).sum() == pytest.approx(1, rel=1e-9)
        assert (ctw.Scorer(tree, 4)(np.repeat(asked, 3)) == np.repeat(tree.log_probability(asked), 3).astype(np.float32)).all()
    fresh = text(300)
    k, _ = ctw.keys([fresh], 4)
    bits = -tree.log_probability(k).sum() / math.log(2) / len(k)
    assert bits < 1.3 < math.log2(9)


def test_held_out_score_of_documents(spark, sf_dir):
    got = queries.op4_ctw_scoring(spark, sf_dir).toPandas()
    held = got[got.held_out]
    assert len(got) == 200 and held.bits_per_byte.mean() < 3.5


def test_every_context_is_kept_at_any_size(spark, monkeypatch):
    for name, value in (("BATCH", 100_000), ("GROUP", 50_000)):
        monkeypatch.setattr(ctw, name, value, raising=False)
    r = random.Random(4)
    texts = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz ", k=20_000)) for _ in range(60)]  # over 1 << 19 runs, the former bound
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    held = lambda k: zlib.crc32(str(k).encode()) % 7 == 2
    tree = grown([t.encode() for i, t in enumerate(texts) if not held(i)], ctw.DEPTH)
    for row in ctw.score(docs).collect():
        want = tree.log_probability(ctw.keys([texts[row.doc_id].encode()], ctw.DEPTH)[0]).sum() / math.log(10)
        assert row.score == pytest.approx(want, rel=1e-5)
