"""Checks of result files; each rule is a filter, and a report row holds its count and five examples."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.sources.tsv import load_source, read_lines

EXAMPLES = 5
MATCH_HEADER = ("source1_entity_id", "matched_entity_ids")
CANDIDATE_HEADER = ("source1_entity_id", "candidate_entity_ids")


def _report(rows: DataFrame, rule: str, example: Column) -> DataFrame:
    """One row (rule, n, examples); examples are the smallest, kept by a bounded top-n."""
    found = rows.select(example.cast("string").alias("e"))
    few = found.distinct().orderBy("e").limit(EXAMPLES).agg(F.array_sort(F.collect_list("e")).alias("examples"))
    return found.agg(F.count(F.lit(1)).alias("n")).withColumn("__one", F.lit(1)).join(few.withColumn("__one", F.lit(1)), "__one").select(F.lit(rule).alias("rule"), "n", "examples")


def listed_ids(rest: Column) -> Column:
    """The items between commas as they stand, empty ones and blanks included; a blank list has none."""
    return F.when(F.trim(F.regexp_replace(rest, r"\s+", " ")) == "", F.array().cast("array<string>")).otherwise(F.split(rest, ","))


def check_rows(lines: DataFrame, required: DataFrame, valid: DataFrame | None = None) -> DataFrame:
    """(rule, n, examples) for lines (key, rest, tabbed) of an id list; n is 0 where a rule holds.

    required: (s1_id) that must have one row each; valid: (id) of known
    partners, None to leave ids unchecked.
    """
    ok = lines.where("tabbed").withColumn("ids", listed_ids(F.col("rest")))
    ids = ok.select("key", F.explode("ids").alias("id"))
    known = ok.select(F.col("key").alias("s1_id")).distinct()
    reports = [
        _report(lines.where(~F.col("tabbed")), "malformed", F.col("key")),
        _report(ok.groupBy("key").count().where("count > 1"), "duplicate_s1", F.col("key")),
        _report(ok.where(F.size("ids") != F.size(F.array_distinct("ids"))), "repeated_id", F.col("key")),
        _report(ids.where(F.col("id").startswith("S1-")).select("id").distinct(), "self_match", F.col("id")),
        _report(ids.where(~F.col("id").startswith("S1-") & ~F.col("id").startswith("S2-") & ~F.col("id").startswith("S3-")).select("id").distinct(), "bad_prefix", F.col("id")),
        _report(required.select("s1_id").distinct().join(known, "s1_id", "left_anti"), "missing_s1", F.col("s1_id")),
        _report(known.join(required, "s1_id", "left_anti"), "unexpected_s1", F.col("s1_id")),
    ]
    if valid is not None:
        partners = ids.where(F.col("id").startswith("S2-") | F.col("id").startswith("S3-")).select("id").distinct()
        reports.append(_report(partners.join(valid.select("id"), "id", "left_anti"), "unknown_id", F.col("id")))
    return reduce(DataFrame.unionByName, reports)


def outside_candidates(matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """The warning for S1 ids with matches that are not among their candidates; both are lines (key, rest)."""
    items = lambda df, name: df.select("key", listed_ids(F.col("rest")).alias(name))
    both = items(matches, "m").join(items(candidates, "c"), "key", "left")
    empty = F.array().cast("array<string>")
    return _report(both.where(F.size(F.array_except("m", F.coalesce("c", empty))) > 0), "outside_candidates", F.col("key"))


@dataclass
class Verdict:
    errors: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)

    @property
    def passed(self) -> bool:
        return not self.errors

    @property
    def exit_code(self) -> int:
        return 0 if self.passed else 1

    def __str__(self) -> str:
        return "\n".join([*[f"ERROR {x}" for x in self.errors], *[f"WARNING {x}" for x in self.warnings], "PASS" if self.passed else "FAIL"])


def not_utf8(spark: SparkSession, path: str) -> bool:
    """Whether any line of the file holds bytes that are no UTF-8."""
    return not spark.read.text(path).where(~F.is_valid_utf8("value")).isEmpty()


def check_header(spark: SparkSession, path: str, header: tuple[str, str]) -> list[str]:
    """Errors of the first line: absent file, empty file, not tab-separated, other names (case and blanks aside)."""
    try:
        first = spark.read.text(path).first()
    except Exception as e:
        return [f"{path}: cannot be read: {str(e).splitlines()[0][:200]}"]
    if first is None:
        return [f"{path}: empty file"]
    if not_utf8(spark, path):
        return [f"{path}: not UTF-8"]
    names = [x.strip().lower() for x in first[0].split("\t")]
    if len(names) < 2:
        return [f"{path}: the header is not tab-separated"]
    return [] if tuple(names) == header else [f"{path}: the header is {names}, not {list(header)}"]


def validate(spark: SparkSession, matching: str, candidate: str | None, test_dir: str, check_ids: bool = False) -> Verdict:
    """All checks of a submission: errors fail it, warnings do not."""
    out = Verdict(check_header(spark, matching, MATCH_HEADER))
    if out.errors:
        return out
    required = load_source(spark, f"{test_dir}/test_source1.tsv").select(F.col("entity_id").alias("s1_id"))
    valid = None
    if check_ids:
        try:
            both = [load_source(spark, f"{test_dir}/test_source{i}.tsv").select(F.col("entity_id").alias("id")) for i in (2, 3)]
            valid = both[0].unionByName(both[1]).distinct()
        except Exception:
            out.warnings.append("source 2 or 3 cannot be read; ids stay unchecked")
    lines = read_lines(spark, matching)
    for path, rows in ((matching, check_rows(lines, required, valid)),):
        out.errors += [f"{path}: {r['rule']}: {r['n']}, e.g. {r['examples']}" for r in rows.where("n > 0").collect()]
    if candidate is None:
        out.warnings.append("no candidate file")
        return out
    wrong = check_header(spark, candidate, CANDIDATE_HEADER)
    if wrong and "cannot be read" in wrong[0]:
        out.warnings += wrong
        return out
    if wrong:
        out.errors += wrong
        return out
    pairs = read_lines(spark, candidate)
    out.errors += [f"{candidate}: {r['rule']}: {r['n']}, e.g. {r['examples']}" for r in check_rows(pairs, required, valid).where("n > 0").collect()]
    out.warnings += [f"matches outside the candidates: {r['n']}, e.g. {r['examples']}" for r in outside_candidates(lines, pairs).where("n > 0").collect()]
    return out
