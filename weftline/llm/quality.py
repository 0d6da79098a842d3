"""Quality rules as a bitmask ledger, on DataFrame functions only.

Every rule is evaluated once for each document. The ledger keeps the
measurements and one bit for each failed rule; a policy is a version with
a mask of the rules that it enforces, so verdicts, policy changes and
ablations are bit operations on the ledger and never go back to the texts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import words

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A document fails when ``fails`` holds; it reads measurement columns only."""

    name: str
    bit: int
    fails: str


RULES = (
    Rule("few_words", 0, "n_words < 50"),
    Rule("repeated_windows", 1, "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", 2, "100 * n_symbols > 10 * n_words"),
    Rule("repeated_lines", 3, "2 * n_dup_lines > n_lines"),
    Rule("short_words", 4, "word_chars < 2 * n_words"),
    Rule("long_words", 5, "word_chars > 15 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return mask_of(self.rules)


def mask_of(names) -> int:
    bits = {r.name: r.bit for r in RULES}
    return sum(1 << bits[n] for n in set(names))


BASE = mask_of(["few_words", "repeated_windows"])
POLICIES = {
    1: Policy(1, ("few_words", "repeated_windows")),
    2: Policy(2, tuple(r.name for r in RULES)),
}


def _covered(hashes: Column) -> Column:
    """Words under a window of three whose hash occurs twice or more, from the array of window hashes.

    Sorted (hash, position) pairs bring equal windows together. The flagged
    positions, sorted again, each cover what the next one leaves.
    """

    def flagged(pairs: Column) -> Column:
        n = F.size(pairs)
        at = lambda i: F.get(pairs, i)["h"]
        marks = F.transform(pairs, lambda p, i: F.when((at(i - 1) == p["h"]) | (at(i + 1) == p["h"]), p["i"]))
        return F.sort_array(F.array_compact(marks)) if n is not None else marks

    def summed(at: Column) -> Column:
        steps = F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - p, F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, x: a + x)

    let = lambda value, f: F.get(F.transform(F.array(value), f), F.lit(0))
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return let(pairs, lambda p: let(flagged(p), summed))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words, all long.

    A null text counts as an empty one: all measurements are 0. Repeated rows
    are measured each for itself; other columns pass through, but for those
    with the names of the measurements, which are replaced.
    """
    t = F.coalesce(F.col("__wl_text"), F.lit(""))
    has_word = lambda x: x.rlike(r"[^\x20\x09-\x0D]")
    names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
    kept = [c for c in docs.columns if c not in names]
    w, h = F.col("__wl_w"), F.col("__wl_h")
    step = docs.withColumn("__wl_text", F.col(f"`{text}`")).select(*[F.col(f"`{c}`") for c in kept], "__wl_text", words(F.col("__wl_text")).alias("__wl_w"))
    windows = F.transform(
        F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0))),
        lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)),
    )
    step = step.select(
        *[F.col(f"`{c}`") for c in kept],
        F.size(w).cast("bigint").alias("n_words"),
        (F.length(t) - F.length(F.regexp_replace(t, r"[^\x20\x09-\x0D]+", ""))).cast("bigint").alias("word_chars"),
        (F.length(t) - F.length(F.regexp_replace(t, r"[#*$%&|<>]+", ""))).cast("bigint").alias("n_symbols"),
        F.filter(F.split(t, "\n"), has_word).alias("__wl_lines"),
        windows.alias("__wl_h"),
    )
    lines = F.col("__wl_lines")
    return step.select(
        *[F.col(f"`{c}`") for c in kept],
        "n_words",
        "word_chars",
        "n_symbols",
        F.size(lines).cast("bigint").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")).otherwise(_covered(h)).alias("n_repeat_words"),
    )


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """The measurements and ``failed_bits`` (long): one bit for each rule that the document fails.

    The bits depend on a row number in form only. Catalyst moves no filter
    below such a column; without it, a filter on the verdict would be put in
    terms of the text and split it anew for each of its words.
    """
    measured = measure(docs, text)
    bits = F.lit(0).cast("bigint")
    for rule in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("bigint"))
    return measured.drop("failed_bits").withColumn("failed_bits", F.when(F.monotonically_increasing_id() >= 0, bits))


def verdict(book: DataFrame, version: int = 2) -> DataFrame:
    """Adds base_failed and kept under the policy of that version."""
    bits = F.col("failed_bits")
    return book.withColumn("base_failed", bits.bitwiseAND(F.lit(BASE)) != 0).withColumn("kept", bits.bitwiseAND(F.lit(POLICIES[version].mask | BASE)) == 0)


def ablation(book: DataFrame, version: int = 2) -> DataFrame:
    """For each rule of the policy: how many documents fail it, and how many only it rejects.

    The ledger is first summed by distinct mask, at most 2 ** rules rows.
    """
    mask = POLICIES[version].mask | BASE
    by_mask = book.groupBy(F.col("failed_bits").bitwiseAND(F.lit(mask)).alias("m")).agg(F.count(F.lit(1)).alias("n"))
    rules = [r for r in RULES if mask >> r.bit & 1]
    sums = [F.struct(F.lit(r.name).alias("rule"), F.coalesce(F.sum(F.when(F.col("m").bitwiseAND(F.lit(1 << r.bit)) != 0, F.col("n"))), F.lit(0)).alias("n_failed"), F.coalesce(F.sum(F.when(F.col("m") == 1 << r.bit, F.col("n"))), F.lit(0)).alias("n_only")) for r in rules]
    return by_mask.agg(F.array(*sums).alias("r")).select(F.inline("r"))
