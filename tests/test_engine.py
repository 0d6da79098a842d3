import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from weftline import cli
from weftline.functions.text import normalised
from weftline.operators import assemble, blocking, evaluate, sampling, validate
from weftline.sources import tsv

RECORD = "entity_id string, business_name string, business_address string, country string"


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_loading(spark, tmp_path):
    p = write(tmp_path / "s.tsv", "entity_id\tbusiness_name\tbusiness_address\tcountry", 'S1-1\t"Joe ""X"" Co"\tNA\tNone', "", 'S1-2\t"two\nlines\tand tab"\t1 Elm\tUS', "S1-3\tshort")
    rows = {r.entity_id: tuple(r)[1:] for r in tsv.load_source(spark, p).collect()}
    assert rows == {"S1-1": ('Joe "X" Co', "", ""), "S1-2": ("two\nlines\tand tab", "1 Elm", "US"), "S1-3": ("short", "", "")}
    assert tsv.load_source(spark, p, 2).count() == 2
    with pytest.raises(ValueError, match="missing column country"):
        tsv.load_source(spark, write(tmp_path / "m.tsv", "entity_id\tbusiness_name\tbusiness_address", "a\tb\tc"))


def test_ground_truth_and_lines(spark, tmp_path):
    p = write(tmp_path / "g.tsv", "source1_entity_id\tmatched_entity_ids", "S1-1\tS2-1,,S3-2", "S1-2\t", "S1-1\tS2-9")
    truth = tsv.load_ground_truth(spark, p)
    assert {r.s1_id: r.matched for r in truth.collect()} == {"S1-1": ["S2-9"], "S1-2": []}
    assert [tuple(r) for r in tsv.truth_pairs(truth).collect()] == [("S1-1", "S2-9")]
    lines = tsv.read_lines(spark, p)
    assert lines.count() == 3 and tsv.fetch(lines, spark.createDataFrame([("S1-2",)], "id string")).count() == 1
    with pytest.raises(ValueError, match="duplicate S1"):
        tsv.read_part_files(spark, write(tmp_path / "p.tsv", "S1-1\tS2-1", "S1-1\tS2-2"))


def test_writing(spark, tmp_path):
    ids = spark.createDataFrame([("S1-2", 0), ("S1-1", 1), ("S1-3", 2)], "s1_id string, at int")
    pairs = spark.createDataFrame([("S1-1", "S3-1"), ("S1-1", "S2-1"), ("S1-1", "S3-1")], "s1_id string, cand_id string")
    tsv.write_tsv(pairs, ids, str(tmp_path / "o"), ("a", "b"), "at")
    assert (tmp_path / "o").read_text() == "a\tb\nS1-2\t\nS1-1\tS2-1,S3-1\nS1-3\t\n"
    both = spark.createDataFrame([("S1-1", "US"), ("S1-2", ""), ("S1-3", "A B")], "s1_id string, country string")
    tsv.write_parts(pairs, pairs.limit(0), both, str(tmp_path / "parts"))
    back = {r.s1_id: (r.country, r.candidates, r.matches) for r in tsv.read_parts(spark, str(tmp_path / "parts")).collect()}
    assert back == {"S1-1": ("US", "S2-1,S3-1", ""), "S1-2": ("", "", ""), "S1-3": ("A B", "", "")}
    tsv.write_part_files(pairs, pairs.limit(0), both, str(tmp_path / "files"))
    assert (tmp_path / "files" / ".part_A_B_cand.tsv").read_text() == "S1-3\t\n" and (tmp_path / "files" / ".part_US_cand.tsv").read_text() == "S1-1\tS2-1,S3-1\n"
    cand, match = tsv.read_part_folder(spark, str(tmp_path / "files"))
    assert {r.s1_id: r.ids for r in cand.collect()} == {"S1-1": ["S2-1", "S3-1"], "S1-2": [], "S1-3": []} and match.count() == 3
    (tmp_path / "files" / ".part_US_match.tsv").unlink()
    with pytest.raises(ValueError, match="missing match part"):
        tsv.read_part_folder(spark, str(tmp_path / "files"))


def test_stage_is_made_anew_for_another_config(spark, tmp_path):
    made = []
    make = lambda: made.append(1) or spark.range(len(made))
    assert tsv.Stage(spark, str(tmp_path / "s"), {"k": 1}).get("x", make).count() == 1
    assert tsv.Stage(spark, str(tmp_path / "s"), {"k": 1}).get("x", make).count() == 1
    assert tsv.Stage(spark, str(tmp_path / "s"), {"k": 2}).get("x", make).count() == 2
    for k in ("A", "B"):
        stage = tsv.Stage(spark, str(tmp_path / "t"), {"k": k})
        assert [stage.get(name, lambda: spark.createDataFrame([(k,)], "k string")).first().k for name in ("train", "val")] == [k, k]  # noqa: B023


def records(spark, *rows):
    return normalised(spark.createDataFrame(list(rows), RECORD))


def test_blocking_shards_fallback_and_empty_vocabulary(spark):
    s1 = records(spark, ("S1-1", "blue moon cafe", "1 elm rd 12345", "US"), ("S1-2", "blue moon cafe", "", "FR"), ("S1-3", "zzz", "", "US"))
    pool = records(spark, ("S2-1", "blue moon cafe", "1 elm rd 12345", "US"), ("S2-2", "blue moon bar", "9 oak st 12345", "US"), ("S3-3", "red sun", "", "IN"))
    got = {(r.s1_id, r.cand_id): r.tfidf for r in blocking.block_all(s1, pool).collect()}
    assert ("S1-1", "S2-1") in got and ("S1-2", "S2-1") in got and not any(k[0] == "S1-3" for k in got)
    assert got["S1-1", "S2-1"] == pytest.approx(got["S1-1", "S2-2"]) == 1  # only terms of two records or more count
    assert blocking.block_all(s1, pool.limit(0)).count() == 0 and blocking.block_all(s1, pool.where("entity_id = 'S3-3'")).count() == 0
    zipped = blocking.block_all(s1, pool, k=1, use_zip=True)
    assert {(r.s1_id, r.cand_id, r.tfidf == 0) for r in zipped.where("s1_id = 'S1-1'").collect()} == {("S1-1", "S2-1", False), ("S1-1", "S2-2", True)}


def test_recall_grows_with_k(spark, sf_dir):
    from weftline.plans import catalog

    found = catalog.recall_at_k(spark, sf_dir).orderBy("k").collect()
    assert [r.k for r in found] == [5, 10, 20, 30] and all(a.recall <= b.recall for a, b in zip(found, found[1:]))


def test_f05_and_sweep(spark):
    pairs = lambda *x: spark.createDataFrame(list(x), "s1_id string, cand_id string")
    ids = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "s1_id string")
    pred = pairs(("a", "47"), ("a", "193"), ("a", "812"), ("c", "1"), ("d", "2"))
    true = pairs(("a", "47"), ("a", "812"), ("d", "3"))
    got = {r.s1_id: r.f05 for r in evaluate.per_record(pred, true, ids).collect()}
    assert got == {"a": pytest.approx(0.7142857), "b": 1.0, "c": 0.0, "d": 0.0}
    scored = pred.withColumn("prob", F.when(F.col("cand_id") == "193", 0.4).otherwise(0.62))
    swept = {r.threshold: r.macro_f05 for r in evaluate.sweep(scored, true, ids).collect()}
    assert len(swept) == 13 and swept[0.45] == pytest.approx(0.5) and swept[0.9] == pytest.approx(0.5)
    assert evaluate.best_threshold(evaluate.sweep(scored, true, ids)).first().threshold == 0.45


def test_sampling(spark):
    ids = spark.createDataFrame([(f"S1-{i}",) for i in range(100)], "s1_id string")
    parts = sampling.split(ids, 20, 30)
    assert {r.part: r["count"] for r in parts.groupBy("part").count().collect()} == {"val": 20, "train": 30, "unused": 50}
    assert parts.exceptAll(sampling.split(ids.repartition(7), 20, 30)).count() == 0
    rows = spark.createDataFrame([("a", str(i), int(i < 5)) for i in range(100)], "s1_id string, cand_id string, label int")
    kept = sampling.negative_sample(rows, 4)
    assert {r.label: r["count"] for r in kept.groupBy("label").count().collect()} == {1: 5, 0: 20}


def test_merge_errors(spark):
    part = lambda *x: spark.createDataFrame([(i, ["S2-1"]) for i in x], "s1_id string, ids array<string>")
    s1 = spark.createDataFrame([("S1-1", "US"), ("S1-2", "IN")], "s1_id string, country string")
    whole = assemble.merge_parts([(part("S1-1"), part("S1-1")), (part("S1-2"), part().limit(0))], s1)
    assert {r.s1_id: (r.candidates, r.matches) for r in whole.collect()} == {"S1-1": (["S2-1"], ["S2-1"]), "S1-2": (["S2-1"], [])}
    for parts, message in (([("S1-1", "S1-2"), ("S1-2",)], "twice"), ([("S1-1",)], "uncovered"), ([("S1-1", "S1-2", "S1-9")], "not among")):
        with pytest.raises(ValueError, match=message):
            assemble.merge_parts([(part(*p), part(*p)) for p in parts], s1)
    filled = assemble.merge_parts([(part("S1-1"), part("S1-1"))], s1, "IN")
    assert {r.s1_id: r.candidates for r in filled.collect()} == {"S1-1": ["S2-1"], "S1-2": []}


@pytest.mark.parametrize(
    "lines, rule",
    [
        (["source1_entity_id,matched_entity_ids"], "not tab-separated"), (["a\tb"], "the header is"), (["H", "S1-1"], "malformed"), (["H", "S1-1\t", "S1-1\t"], "duplicate_s1"),
        (["H", "S1-1\tS2-1,S2-1"], "repeated_id"), (["H", "S1-1\tS1-2"], "self_match"), (["H", "S1-1\tX-1"], "bad_prefix"), (["H", "S1-1\tS2-8"], "unknown_id"), (["H"], "missing_s1"),
        (["H", "S1-1\t", "S1-5\t"], "unexpected_s1"), (["H", "S1-1\t S2-1"], "bad_prefix"), (["H", "S1-1\tS2-1,,S3-1"], "bad_prefix"), (["H", "S1-1\tS2-1"], None),
    ],
)
def test_validator(spark, tmp_path, lines, rule):
    head = "entity_id\tbusiness_name\tbusiness_address\tcountry"
    write(tmp_path / "test_source1.tsv", head, "S1-1\ta\tb\tUS")
    write(tmp_path / "test_source2.tsv", head, "S2-1\ta\tb\tUS")
    write(tmp_path / "test_source3.tsv", head, "S3-1\ta\tb\tUS")
    m = write(tmp_path / "m.tsv", *[x.replace("H", "source1_entity_id\tMatched_Entity_IDs ") if x == "H" else x for x in lines])
    c = write(tmp_path / "c.tsv", "source1_entity_id\tcandidate_entity_ids", "S1-1\tS3-1")
    found = validate.validate(spark, m, c, str(tmp_path), check_ids=True)
    if rule is None:
        assert found.passed and found.exit_code == 0 and "outside the candidates" in found.warnings[0]
    else:
        assert not found.passed and any(rule in e for e in found.errors) and str(found).endswith("FAIL")
    assert not validate.validate(spark, str(tmp_path / "absent"), None, str(tmp_path)).passed


def test_a_line_that_is_not_utf8_fails_the_file(spark, tmp_path):
    write(tmp_path / "test_source1.tsv", "entity_id\tbusiness_name\tbusiness_address\tcountry", "S1-1\ta\tb\tUS")
    (tmp_path / "m.tsv").write_bytes(b"source1_entity_id\tmatched_entity_ids\nS1-1\tS2-\xe9\n")
    assert "not UTF-8" in validate.validate(spark, str(tmp_path / "m.tsv"), None, str(tmp_path)).errors[0]


def test_tiles_and_chunks_give_the_same_candidates(spark, sf_dir):
    from weftline.plans import views

    queries, pool = blocking.shards(*views.sides(spark, sf_dir))
    index = blocking.build_index(pool)
    rows = lambda df: {(r.s1_id, r.cand_id, r["rank"]) for r in df.collect()}
    assert rows(blocking.query_topk(*index, queries)) == rows(blocking.query_topk(*index, queries, tile=500, chunk=5))


def business(tmp_path, kind):
    head = "entity_id\tbusiness_name\tbusiness_address\tcountry"
    names = [f"{a} {b}" for a in ("blue", "red", "old", "new", "grand") for b in ("moon cafe", "star hotel", "river mill", "oak bakery")]
    rows = [(i, n, f"{i + 1} elm rd {10000 + i}") for i, n in enumerate(names)]
    write(tmp_path / f"{kind}_source1.tsv", head, *[f"S1-{i}\t{n}\t{a}\tUS" for i, n, a in rows])
    write(tmp_path / f"{kind}_source2.tsv", head, *[f"S2-{i}\t{n} Ltd\t{a.replace('rd', 'road')}\tUS" for i, n, a in rows])
    write(tmp_path / f"{kind}_source3.tsv", head, *[f"S3-{i}\t{n.title()} Inc\t{a}\tUS" for i, n, a in rows[::2]])
    if kind == "train":
        write(tmp_path / "train_ground_truth.tsv", "source1_entity_id\tmatched_entity_ids", *[f"S1-{i}\tS2-{i}" + (f",S3-{i}" if i % 2 == 0 else "") for i, _, _ in rows])
    return str(tmp_path)


def test_command_line(spark, tmp_path, capsys):
    d = business(tmp_path, "train")
    business(tmp_path, "test")
    assert cli.main(["train", "--train-dir", d, "--out", f"{d}/model", "--val-size", "6", "--rounds", "3", "--top-k", "5"], spark) == 0
    assert "macro F0.5" in capsys.readouterr().out
    assert cli.main(["infer", "--test-dir", d, "--model", f"{d}/model", "--out", f"{d}/out", "--top-k", "5", "--use-zip-block"], spark) == 0
    assert cli.main(["merge-parts", "--parts", f"{d}/out", "--test-dir", d, "--out", f"{d}/merged"], spark) == 0
    assert cli.main(["validate", "--matching", f"{d}/merged/matching_results.tsv", "--candidate", f"{d}/merged/candidate_pairs.tsv", "--test-dir", d, "--check-ids"], spark) == 0
    assert cli.main(["recall-audit", "--train-dir", d, "--n", "10", "--top-ks", "2,5"], spark) == 0
    assert cli.main(["explore", "all", "--train-dir", d], spark) == 0


def test_streamed_records_find_the_same_candidates(spark, tmp_path):
    from weftline.streaming.linking import link_stream

    d = business(tmp_path, "test")
    pool = tsv.load_source(spark, f"{d}/test_source2.tsv")
    s1 = tsv.load_source(spark, f"{d}/test_source1.tsv")
    s1.repartition(2).write.parquet(f"{d}/in")
    stream = spark.readStream.schema(s1.schema).parquet(f"{d}/in")
    link_stream(stream, pool, f"{d}/out", f"{d}/ck", k=3).trigger(availableNow=True).start().awaitTermination()
    got = {(r.s1_id, r.cand_id, r["rank"]) for r in spark.read.parquet(f"{d}/out/candidates").collect()}
    want = {(r.s1_id, r.cand_id, r["rank"]) for r in blocking.block_all(normalised(s1), normalised(pool), k=3).collect()}
    assert got == want and want


def long_records(n=400, words=300):
    r = random.Random(5)
    vocabulary = ["".join(r.choices("abcdefgh", k=r.randint(1, 4))) for _ in range(200)]
    return [(str(i % 3), f"D{i % (n - 20)}", r.choices(vocabulary, k=words) if i % 50 else []) for i in range(n)]


def by_hand(rows, max_features):
    """Vocabulary and weights of each shard, by the definition; repeated ids are one record."""
    tf, terms, weights = {}, {}, {}
    for shard, i, block in rows:
        long = [t for t in block if len(t) >= 2]
        tf.setdefault(shard, {}).setdefault(i, Counter()).update(long + [f"{a} {b}" for a, b in zip(long, long[1:])])
    for shard, held in tf.items():
        df, total = Counter(t for c in held.values() for t in c), sum(held.values(), Counter())
        best = sorted((t for t in df if df[t] >= 2), key=lambda t: (-total[t], t))[:max_features]
        idf = {t: math.log((1 + len(held)) / (1 + df[t])) + 1 for t in best}
        terms |= {(shard, t): (n, df[t], total[t]) for n, t in enumerate(best, 1)}
        for i, c in held.items():
            w = {t: (1 + math.log(c[t])) * idf[t] for t in c if t in idf}
            norm = math.sqrt(sum(x * x for x in w.values()))
            weights |= {(shard, i, t): x / norm for t, x in w.items()}
    return terms, weights


def test_index_by_hashes_is_that_of_the_definition(spark, monkeypatch):
    """Ties at the cut, repeated ids, small tasks, several passes, and hashes that clash at first."""
    rows = long_records()
    want_terms, want = by_hand(rows, 500)
    pool = spark.createDataFrame(rows, "shard string, entity_id string, block array<string>").repartition(3)
    hashes, seeds = blocking._hash_counts, []
    monkeypatch.setattr(blocking, "_hash_counts", lambda held, seed: seeds.append(seed) or hashes(held, seed))
    for name, value in (("SLICE", 5000), ("HELD", 700), ("SENT", 600)):
        monkeypatch.setattr(blocking, name, value)
    for i in range(2):
        terms, weights = blocking.build_index(pool, 500)
        assert {(r.shard, r.term): (r.number, r.df, r.total) for r in terms.collect()} == want_terms
        got = {(r.shard, r.entity_id, r.term): r.w for r in weights.collect()}
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
        spell = blocking._spelled
        if not i:
            clash = lambda held, kept, seed: spell(held, kept, seed).unionByName(kept.limit(1).withColumn("term", F.lit("another")) if seed == 0 else kept.limit(0).withColumn("term", F.lit("")))
            monkeypatch.setattr(blocking, "_spelled", clash)
    assert seeds == [0, 0, 1]


def test_search_without_an_index_finds_the_same_and_shuffles_no_postings(spark):
    made, kind = long_records(600, 600), "shard string, entity_id string, block array<string>"
    rows, q = spark.createDataFrame(made, kind), spark.createDataFrame([(s, f"Q{i}", b) for s, i, b in made[:30]], kind)
    found, whole = blocking.topk(rows, q, 5), blocking.build_index(rows)
    key = lambda df: {(r.s1_id, r.cand_id, r["rank"], round(r.tfidf, 9)) for r in df.collect()}
    assert key(found) == key(blocking.query_topk(*whole, q, 5)) != set()
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "explode(block" not in plan and "collect_list" not in plan
