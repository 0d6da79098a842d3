"""SimHash (2), substring (3) and embedding (8) dedup against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from weftline.llm import common, embeddings, queries, simhash, substring

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def closure(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def slow_print(text):
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("text", [None, "", " \t", "A", "a B", "a b c", "É é \x1c x y Z z", "w " * 70000, "one two three four five"])
def test_fingerprints(text):
    assert simhash.fingerprint(None if text is None else text.encode()) == slow_print(text)


def near_codes(seed, n=400):
    r = random.Random(seed)
    out = [r.getrandbits(64) for _ in range(n)]
    for i in range(n):
        x = out[r.randrange(len(out))]
        for _ in range(r.randrange(5)):
            x ^= 1 << r.randrange(64)
        out.append(x)
    center = r.getrandbits(64)
    return list(dict.fromkeys([*out, 0, 1, 7, 15, *[center ^ (1 << i) ^ (1 << j) for i in range(16) for j in range(i)]]))


def linked_groups(codes):
    f = np.array(codes, np.uint64)
    return closure(len(f), [(i, j) for i in range(len(f)) for j in np.flatnonzero(np.bitwise_count(f[i] ^ f[i + 1 :]) <= 3) + i + 1])


@pytest.mark.parametrize("tile", [simhash.TILE, 40])
def test_links_are_all_and_none_else(spark, tile):
    codes = near_codes(tile)
    want = linked_groups(codes)
    fps = spark.createDataFrame([(int(np.uint64(c).view(np.int64)),) for c in codes], "fp long")
    got = dict(common.components(simhash.links(fps, tile=tile)).collect())
    place = {int(np.uint64(c).view(np.int64)): i for i, c in enumerate(codes)}
    groups = defaultdict(set)
    for fp in place:
        groups[got.get(fp, fp)].add(place[fp])
    expected = defaultdict(set)
    for i, r in enumerate(want):
        expected[r].add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_index_prunes_in_small_steps(monkeypatch):
    monkeypatch.setattr(simhash, "FRONTIER", 64)
    codes = np.array(near_codes(9, 60), np.uint64)
    index = simhash.GrayIndex(np.zeros(len(codes), np.int64), codes)
    index.link(3, chunk=50)
    same = linked_groups([int(c) for c in index.codes])
    assert len(set(zip(index.labels.tolist(), same))) == len(set(same))
    assert (simhash.gray_rank(np.array([0, 1, 3, 2, 6, 7, 5, 4], np.uint64)) == np.arange(8)).all()


def test_near_duplicate_documents(spark):
    base = " ".join(f"word{i}" for i in range(300))
    rows = [(5, base, "x"), (3, base + " end", "x"), (3, base + " end", "x"), (9, None, "y"), (8, " ", "y"), (7, "alone", "y"), (None, base, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted(simhash.near_duplicates(docs).collect(), key=str)
    prints = [slow_print(t) for _, t, _ in rows]
    groups = closure(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3])
    least = {g: min((rows[i][0] for i in range(len(rows)) if groups[i] == g and rows[i][0] is not None)) for g in groups}
    assert sorted(((r.doc_id, r.component_id) for r in got), key=str) == sorted(((rows[i][0], least[g]) for i, g in enumerate(groups)), key=str)
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(least.values()))
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.representatives(docs.limit(0)).count() == 0


@pytest.mark.parametrize("edges", [[], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 50)], [(i, (7 * i + 3) % 90) for i in range(50)], [(4, 4), (2, 9), (9, 2)]])
def test_components(spark, edges):
    got = dict(common.components(spark.createDataFrame(edges, "a long, b long")).collect())
    nodes = sorted({x for e in edges if e[0] != e[1] for x in e})
    root = closure(100, edges)
    assert got == {x: root[x] for x in nodes}


def slow_removed(texts, window):
    words = [WORD.findall(t or "") for t in texts]
    seen = defaultdict(int)
    for w in words:
        for i in range(len(w) - window + 1):
            seen[tuple(w[i : i + window])] += 1
    out = []
    for w in words:
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def passages(seed):
    r = random.Random(seed)
    word = lambda: r.choice(["alpha", "beta", "gamma", "é", "x"]) + str(r.randrange(60))
    shared = [[word() for _ in range(n)] for n in (34, 35, 36, 50, 51, 90)]
    texts = [None, "", " \n", "short one", "a " * 200, "a b " * 100, " ".join(["q"] * 35), " ".join(["q"] * 36)]
    for _ in range(60):
        doc = []
        for _ in range(r.randrange(1, 5)):
            doc += [word() for _ in range(r.randrange(60))] + (r.choice(shared) if r.random() < 0.5 else [])
        texts.append(r.choice([" ", "\n", "\t "]).join(doc))
    return texts + texts[-3:] + [" ".join(f"long{i % 5000}" for i in range(20000))]


@pytest.mark.parametrize("batch", [substring.BATCH_WORDS, 500])
def test_substrings_against_brute_force(spark, monkeypatch, batch):
    monkeypatch.setattr(substring, "BATCH_WORDS", batch)
    texts = passages(batch)
    rows = [(i % 40, t, i, "s") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, i long, s string")
    got = {r.i: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.dedup(docs).collect()}
    want = slow_removed(texts, substring.WINDOW)
    assert got == dict(enumerate(want))
    assert sum(w[1] for w in want) > 2000


def test_substring_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "a b c", 1), (1, None, 2)], "doc_id long, text string, n_words int")
    out = substring.dedup(docs)
    assert out.columns == ["doc_id", "text", "n_words", "n_removed", "kept_sha256", "kept_text"]
    assert {(r.doc_id, r.text, r.n_words, r.n_removed, r.kept_text) for r in out.collect()} == {(None, "a b c", 3, 0, None), (1, None, 0, 0, None)}
    assert substring.dedup(docs.limit(0)).count() == 0


def test_substring_windows_of_other_sizes(spark):
    texts = passages(3)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.dedup(docs, window=20, block=20).collect()}
    assert got == dict(enumerate(slow_removed(texts, 20)))


def test_index_entries_dealt_to_several_tasks_find_the_same(spark, monkeypatch):
    r = random.Random(8)
    hot = " ".join(f"h{i}" for i in range(20))
    some = lambda x: [" ".join(f"{x}{r.randrange(9)}" for _ in range(10)) for _ in range(8)]
    lefts, rights = some("l"), some("r")
    texts = [f"{r.random()} {r.choice(lefts)} {hot} {r.choice(rights)} {r.random()}" for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = substring.duplicate_spans.__defaults__
    want = dict(enumerate(slow_removed(texts, substring.WINDOW)))
    for most in (substring.BLOCKS, 20):
        monkeypatch.setattr(substring.duplicate_spans, "__defaults__", (*whole[:-1], most))
        assert {d.doc_id: (d.n_words, d.n_removed, d.kept_sha256) for d in substring.dedup(docs).collect()} == want
    assert 500 < sum(w[1] for w in want.values()) < 40 * 40


def test_factors_are_the_longest_matches_and_reproduce_their_words():
    r = random.Random(2)
    shared = [f"s{i}" for i in range(40)]
    segments = []
    for _ in range(12):
        a, b = r.randrange(12), r.randrange(28, 40)
        segments.append([x.encode() for x in [f"l{r.randrange(2)}" for _ in range(r.randrange(6))] + shared[a:b] + [f"r{r.randrange(2)}" for _ in range(r.randrange(6))]])
    window, n = 10, 0
    line = lambda words, p, size: tuple(words[p : p + size])
    for i, factors in enumerate(substring.parse(segments, window)):
        held = lambda words, i=i: any(line(s, p, len(words)) == words for j, s in enumerate(segments) if j != i for p in range(len(s)))
        words, covered = segments[i], set()
        for p, size in factors:
            assert size >= window and held(line(words, p, size))
            covered |= set(range(p, p + size - window + 1))
            n += 1
        assert covered == {p for p in range(len(words) - window + 1) if held(line(words, p, window))}
    assert n >= 12


def slow_links(rows):
    def ok(v):
        return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    pairs = []
    for i, (_, a, la) in enumerate(rows):
        for j in range(i):
            _, b, lb = rows[j]
            if la is not None and la == lb and ok(a) and ok(b) and len(a) == len(b):
                x, y = np.array(a, float), np.array(b, float)
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.98:
                    pairs.append((i, j))
    return pairs


def vectors(seed, n=300, dim=16):
    r = np.random.default_rng(seed)
    centers = r.standard_normal((8, dim))
    rows = [(int(i), [float(np.float32(x)) for x in centers[i % 8] + r.standard_normal(dim) * r.choice([0.02, 0.1, 0.3])], int(i) % 3) for i in range(n)]
    rows += [(1000 + i, rows[i][1], rows[i][2]) for i in range(20)] + [(1100 + i, [2 * x for x in rows[i][1]], rows[i][2]) for i in range(5)]
    inf, nan = float("inf"), float("nan")
    return rows + [(2000, None, 1), (2001, [0.0] * dim, 1), (2002, [nan] * dim, 1), (2003, [inf] + [0.0] * (dim - 1), 1), (2004, rows[0][1], None), (2005, [], 1), (2006, [None] + [1.0] * (dim - 1), 1), (2007, rows[1][1][:8], rows[1][2]), (0, rows[0][1], rows[0][2])]


@pytest.mark.parametrize("sizes", [{}, {"tile": 25}])
def test_embeddings_against_brute_force(spark, sizes):
    rows = vectors(1)
    got = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), **sizes).collect()
    pairs = slow_links(rows)
    count = np.bincount([x for p in pairs for x in p], minlength=len(rows))
    groups = closure(len(rows), pairs)
    least = {g: min(rows[i][0] for i in range(len(rows)) if groups[i] == g) for g in groups}
    want = sorted((rows[i][0], int(count[i]), least[groups[i]]) for i in range(len(rows)))
    found = sorted((r.vec_id, r.n_links, r.component_id) for r in got)
    assert found == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_embeddings_with_repeated_and_null_ids(spark):
    schema = "vec_id long, embedding array<double>, label string"
    rows = [(7, [1.0, 0.0], "L1"), (8, [1.0, 0.01], "L1"), (7, [0.0, 1.0], "L2"), (9, [0.0, 1.0], "L2"), (None, [1.0, 1.0], "L3"), (None, [1.0, 1.01], "L3"), (None, [1.0, -1.0], "L4"), (5, [1.0, -1.0], "L4")]
    got = sorted((tuple(r) for r in embeddings.near_duplicates(spark.createDataFrame(rows, schema)).collect()), key=repr)
    want = [(7, 1, 7, True), (8, 1, 7, False), (7, 1, 7, True), (9, 1, 7, False), (None, 1, None, True), (None, 1, None, True), (None, 1, 5, False), (5, 1, 5, True)]
    assert got == sorted(want, key=repr)


def test_embeddings_without_rows_or_links(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int, kept string")
    assert embeddings.near_duplicates(none).count() == 0
    assert embeddings.near_duplicates(spark.createDataFrame([(1, None, None)], "vec_id long, embedding array<float>, label int")).collect()[0][1:] == (0, 1, True)


def test_estimates_are_unbiased_and_bounded():
    r = np.random.default_rng(3)
    unit = r.standard_normal((600, 64))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    codes = embeddings.Codes(unit, 42)
    rows = slice(0, 600)
    true = unit @ unit.T
    middle, upper = codes.upper(rows, rows, 0.0), codes.upper(rows, rows, embeddings.SIGMAS)
    apart = ~np.eye(600, dtype=bool)
    assert abs((middle - true)[apart].mean()) < 0.002
    assert (upper[apart] >= true[apart]).mean() > 0.999


def test_registered_queries_cover_their_tables(spark, sf_dir):
    for name, key, source in (("op2_simhash_near_dedup", "doc_id", "documents"), ("op3_substring_dedup", "doc_id", "documents"), ("op8_embedding_near_dedup", "vec_id", "embeddings")):
        ids = queries.table(spark, sf_dir, source).select(key)
        got = queries.QUERIES[name](spark, sf_dir).select(F.col(key))
        assert got.count() == ids.count() and not got.exceptAll(ids).count()


def test_large_labels_lose_no_link(spark):
    r = np.random.default_rng(6)
    x = r.standard_normal((1500, 16))
    x /= np.linalg.norm(x, axis=1)[:, None]
    u = r.standard_normal((1500, 16))
    u -= (u * x).sum(axis=1)[:, None] * x
    u /= np.linalg.norm(u, axis=1)[:, None]
    both = np.concatenate([x, 0.9802 * x + math.sqrt(1 - 0.9802**2) * u])
    unit = both / np.linalg.norm(both, axis=1)[:, None]
    want = (unit @ unit.T >= embeddings.THRESHOLD).sum(axis=1) - 1
    rows = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(both)], "vec_id long, embedding array<double>, label int")
    got = {g.vec_id: g.n_links for g in embeddings.near_duplicates(rows, tile=300).collect()}
    assert [got[i] for i in range(3000)] == want.tolist() and want.sum() >= 3000
