"""Command line: python -m weftline.cli train | infer | recall-audit | merge-parts | validate | explore.

Options for chunks, jobs and threads have no place here: partitions and
executors are Spark's.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions.text import normalised
from weftline.operators import assemble, blocking, evaluate, features, matcher, profile, sampling, validate
from weftline.sources import tsv

SEED = 42


def _sources(spark: SparkSession, folder: str, kind: str) -> tuple[DataFrame, DataFrame]:
    s1, s2, s3 = (tsv.load_source(spark, f"{folder}/{kind}_source{i}.tsv") for i in (1, 2, 3))
    columns = tsv.RECORD_COLUMNS
    return s1.select(columns), s2.select(columns).unionByName(s3.select(columns))


def _ids(s1: DataFrame) -> DataFrame:
    return s1.select(F.col("entity_id").alias("s1_id"), "country")


def _pairs(s1: DataFrame, pool: DataFrame, truth: DataFrame | None, a) -> DataFrame:
    one, all_ = normalised(s1), normalised(pool).withColumn("at", F.monotonically_increasing_id())
    found = blocking.block_all(one, all_, a.top_k, a.max_features, a.min_df, a.use_zip_block, a.zip_cap, "at")
    return features.build_rows(found, one, all_, truth)


def train(spark: SparkSession, a) -> None:
    s1, pool = _sources(spark, a.train_dir, "train")
    truth = tsv.truth_pairs(tsv.load_ground_truth(spark, f"{a.train_dir}/train_ground_truth.tsv"))
    parts = sampling.split(_ids(s1), a.val_size, a.max_train_s1, a.seed)
    if a.train_countries or a.val_countries:
        train_ids = sampling.by_country(parts.where("part = 'train'"), a.train_countries)
        val_ids = sampling.by_country(parts.where("part = 'val'"), a.val_countries)
    else:
        train_ids, val_ids = (parts.where(F.col("part") == p) for p in ("train", "val"))
    if a.max_s23:
        pool = sampling.sampled_pool(pool, truth, train_ids.unionByName(val_ids).select("s1_id"), a.max_s23, a.seed)
    config = {k: v for k, v in vars(a).items() if k in ("top_k", "val_size", "max_train_s1", "max_s23", "max_features", "min_df", "seed", "use_zip_block", "zip_cap", "train_countries", "val_countries")}
    stage = tsv.Stage(spark, f"{a.out}/checkpoint", config if a.resume else config | {"run": str(spark.sparkContext.applicationId)})

    def rows(ids: DataFrame) -> DataFrame:
        return _pairs(s1.join(ids.select(F.col("s1_id").alias("entity_id")), "entity_id", "left_semi").select(s1.columns), pool, truth, a)

    fit = stage.get("train", lambda: rows(train_ids))
    held = stage.get("val", lambda: rows(val_ids))
    totals = profile.pair_totals(fit).first()
    print(f"pairs {totals['n_pairs']}, pos_rate {totals['pos_rate']:.4f}")
    model = matcher.train(fit, a.rounds, a.seed, a.neg_per_pos, a.depth, a.rate)
    threshold, best = matcher.fit_threshold(model, held, truth, val_ids)
    matcher.save(model, threshold, a.out, config)
    base = evaluate.best_threshold(evaluate.sweep(held, truth, val_ids, "tfidf", evaluate.BASELINE_THRESHOLDS)).first()
    recall = blocking.blocking_recall(held, truth, val_ids).first()["recall"]
    print(f"blocking recall {recall:.4f}; macro F0.5 {best:.4f} at {threshold}; TF-IDF alone {base['macro_f05']:.4f} at {base['threshold']}")


def infer(spark: SparkSession, a) -> None:
    s1, pool = _sources(spark, a.test_dir, "test")
    s1 = sampling.by_country(s1, a.countries)
    model, kept = matcher.load(spark, a.model)
    threshold = kept if a.threshold is None else a.threshold
    config = {k: getattr(a, k) for k in ("top_k", "max_features", "min_df", "use_zip_block", "zip_cap", "model", "countries")} | {"threshold": threshold}
    stage = tsv.Stage(spark, f"{a.out}/stage", config if a.resume else config | {"run": str(spark.sparkContext.applicationId)})
    scored = stage.get("scored", lambda: matcher.predict(model, _pairs(s1, pool, None, a)))
    order = s1.select(F.col("entity_id").alias("s1_id"), "country").withColumn("at", F.monotonically_increasing_id())
    matches = scored.where(F.col("prob") >= threshold)
    tsv.write_part_files(scored, matches, order, a.out, "at")
    tsv.write_tsv(scored, order, f"{a.out}/candidate_pairs.tsv", validate.CANDIDATE_HEADER, "at")
    tsv.write_tsv(matches, order, f"{a.out}/matching_results.tsv", validate.MATCH_HEADER, "at")


def recall_audit(spark: SparkSession, a) -> None:
    s1, pool = _sources(spark, a.train_dir, "train")
    truth = tsv.truth_pairs(tsv.load_ground_truth(spark, f"{a.train_dir}/train_ground_truth.tsv"))
    ids = sampling.sample(_ids(s1), a.n, a.seed)
    ks = sorted(int(k) for k in a.top_ks.split(","))
    chosen = normalised(s1.join(ids.select(F.col("s1_id").alias("entity_id")), "entity_id", "left_semi").select(s1.columns))
    queries, shard_pool = blocking.shards(chosen, normalised(pool))
    found = blocking.query_topk(*blocking.build_index(shard_pool, a.max_features, a.min_df), queries, ks[-1]).persist()
    by_zip = blocking.zip_block(queries, shard_pool, a.zip_cap) if a.use_zip_block else None
    blocking.recall_at_k(found, truth, ids, ks, by_zip).orderBy("k").show()
    found.unpersist()


def merge_parts(spark: SparkSession, a) -> None:
    s1 = _ids(tsv.load_source(spark, f"{a.test_dir}/test_source1.tsv")).withColumn("at", F.monotonically_increasing_id())
    parts = [tsv.read_part_folder(spark, folder) for folder in a.parts]
    merged = assemble.merge_parts(parts, s1.select("s1_id", "country"), a.empty_countries)
    for column, header, name in (("candidates", validate.CANDIDATE_HEADER, "candidate_pairs"), ("matches", validate.MATCH_HEADER, "matching_results")):
        tsv.write_tsv(merged.select("s1_id", F.explode(column).alias("cand_id")), s1, f"{a.out}/{name}.tsv", header, "at")


def check(spark: SparkSession, a) -> int:
    found = validate.validate(spark, a.matching, a.candidate, a.test_dir, a.check_ids)
    print(found)
    return found.exit_code


def explore(spark: SparkSession, a) -> None:
    s1, pool = _sources(spark, a.train_dir, "train")
    truth = tsv.load_ground_truth(spark, f"{a.train_dir}/train_ground_truth.tsv")
    if a.what in ("all", "gt"):
        profile.match_histogram(truth).orderBy("n_matches").show()
        profile.match_summary(truth).show()
        profile.multi_owner(tsv.truth_pairs(truth)).show()
        profile.source_coverage(truth).show()
        profile.script_mix(tsv.truth_pairs(truth), s1, pool).show()
    if a.what in ("all", "country"):
        profile.country_mix(s1).show()
        profile.country_mix(pool).show()
    if a.what in ("all", "ex"):
        profile.examples(truth, s1, pool).show(truncate=False)


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="weftline")
    sub = out.add_subparsers(dest="command", required=True)

    def command(name: str, run, *groups) -> argparse.ArgumentParser:
        p = sub.add_parser(name)
        p.set_defaults(run=run)
        for g in groups:
            g(p)
        return p

    def index(p) -> None:
        p.add_argument("--top-k", type=int, default=30)
        p.add_argument("--max-features", type=int, default=300_000)
        p.add_argument("--min-df", type=int, default=2)
        p.add_argument("--use-zip-block", action="store_true")
        p.add_argument("--zip-cap", type=int, default=200)
        p.add_argument("--seed", type=int, default=SEED)

    p = command("train", train, index)
    for name in ("--train-dir", "--out"):
        p.add_argument(name, required=True)
    for name, value in (("--val-size", 50_000), ("--max-train-s1", 0), ("--max-s23", 0), ("--neg-per-pos", 4), ("--rounds", 50), ("--depth", 7)):
        p.add_argument(name, type=int, default=value)
    p.add_argument("--rate", type=float, default=0.1)
    p.add_argument("--train-countries", default="")
    p.add_argument("--val-countries", default="")
    p.add_argument("--resume", action="store_true")

    p = command("infer", infer, index)
    for name in ("--test-dir", "--model", "--out"):
        p.add_argument(name, required=True)
    p.add_argument("--threshold", type=float, default=None)
    p.add_argument("--countries", default="")
    p.add_argument("--resume", action="store_true")

    p = command("recall-audit", recall_audit, index)
    p.add_argument("--train-dir", required=True)
    p.add_argument("--n", type=int, default=20_000)
    p.add_argument("--top-ks", default="20,30,50")

    p = command("merge-parts", merge_parts)
    p.add_argument("--parts", nargs="+", required=True)
    p.add_argument("--test-dir", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--empty-countries", default="")

    p = command("validate", check)
    p.add_argument("--matching", required=True)
    p.add_argument("--candidate", default=None)
    p.add_argument("--test-dir", required=True)
    p.add_argument("--check-ids", action="store_true")

    p = command("explore", explore)
    p.add_argument("what", choices=["all", "gt", "country", "ex"], nargs="?", default="all")
    p.add_argument("--train-dir", required=True)
    return out


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(args)
    return a.run(spark or SparkSession.builder.appName("weftline").getOrCreate(), a) or 0


if __name__ == "__main__":
    sys.exit(main())
