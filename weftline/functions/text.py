"""Normalisation of names and addresses as Column expressions.

All but the Unicode fold are built-in functions. ``normalised`` adds every
derived column of a record at once, so that pairs built later reuse them.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.functions import tables

_SOUNDS = tables.VOWELS | tables.VOWEL_SIGNS | tables.CONSONANTS | tables.OTHER_SIGNS | tables.DIGITS
_INHERENT = next(k for k, v in tables.VOWELS.items() if v == "a")
_DEVANAGARI = "[ऀ-ॿ]"


def _map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def _among(x: Column, words: list[str]) -> Column:
    return x.isin(words)


def has_devanagari(text: Column) -> Column:
    return text.rlike(_DEVANAGARI)


def is_ascii(text: Column) -> Column:
    return text.rlike(r"^[\x00-\x7F]*$")


def transliterate(text: Column) -> Column:
    """Devanagari by sound: a consonant with no vowel sign after it gets the vowel a; signs without a sound go."""
    bare = f"([{''.join(tables.CONSONANTS)}])(?![{''.join(tables.VOWEL_SIGNS)}])"
    spelled = F.regexp_replace(text, bare, f"$1{_INHERENT}")
    sounds = _map(_SOUNDS)
    latin = F.transform(F.split(spelled, ""), lambda c: F.coalesce(sounds[c], F.when(has_devanagari(c), F.lit("")).otherwise(c)))
    return F.when(has_devanagari(text), F.array_join(latin, "")).otherwise(text)


@F.pandas_udf(T.StringType())
def _decomposed(text: pd.Series) -> pd.Series:
    def one(x: str | None) -> str | None:
        return None if x is None else "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c)).lower()

    return text.map(one)


def fold(text: Column) -> Column:
    """Transliterated, decomposed, without combining marks, in lower case. ASCII texts never leave the JVM."""
    latin = transliterate(text)
    return F.coalesce(_decomposed(F.when(~is_ascii(latin), latin)), F.lower(latin))


def _clean_folded(folded: Column) -> Column:
    return F.trim(F.regexp_replace(F.replace(folded, F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", " "))


def clean(text: Column) -> Column:
    return _clean_folded(fold(F.coalesce(text, F.lit(""))))


def tokens_of(cleaned: Column) -> Column:
    return F.array_remove(F.split(cleaned, " "), "")


def tokenize(text: Column) -> Column:
    return tokens_of(clean(text))


def core_of(tokens: Column) -> Column:
    """Without legal-form words, unless nothing else is there."""
    core = F.filter(tokens, lambda t: ~_among(t, tables.LEGAL_TOKENS))
    return F.when(F.size(core) == 0, tokens).otherwise(core)


def expanded(tokens: Column) -> Column:
    """Abbreviations of addresses in full; codes of states stay."""
    words = _map({k: v for k, v in tables.ADDRESS_WORDS.items() if k not in tables.US_STATES and k != v and " " not in k})
    return F.transform(tokens, lambda t: F.coalesce(words[t], t))


def address_tokens_of(full: Column) -> Column:
    return F.filter(full, lambda t: ~_among(t, tables.GENERIC_ADDRESS_WORDS))


def extract_zip(text: Column) -> Column:
    """The last run of 5 or 6 digits, else the longest run of 4 or more (the first of equals), else an empty string."""
    runs = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?U)(\d{4,})"), 1)
    usual = F.filter(runs, lambda r: F.length(r).isin(5, 6))
    longest = F.aggregate(runs, F.lit(""), lambda best, r: F.when(F.length(r) > F.length(best), r).otherwise(best))
    return F.coalesce(F.try_element_at(usual, F.lit(-1)), longest)


def house_of(tokens: Column) -> Column:
    first = F.try_element_at(tokens, F.lit(1))
    return F.when(first.rlike("^[0-9]+$"), first).otherwise(F.lit(""))


def block_of(core: Column, names: Column, address: Column, zip_code: Column) -> Column:
    """Tokens for blocking: the core name twice, the full name, the address and the postal code twice."""
    found = F.concat(core, core, names, address, F.when(zip_code == "", F.array().cast("array<string>")).otherwise(F.array(zip_code, zip_code)))
    return F.when(F.size(found) == 0, F.array(F.lit("emptyrecord"))).otherwise(found)


def normalised(records: DataFrame) -> DataFrame:
    """Adds name_clean, name_tokens, name_core, addr_clean, addr_tokens, zip, house and block to records."""
    step = records.withColumns({"name_clean": clean(F.col("business_name")), "addr_clean": clean(F.col("business_address")), "zip": extract_zip(F.col("business_address"))})
    step = step.withColumns({"name_tokens": tokens_of(F.col("name_clean")), "__addr": tokens_of(F.col("addr_clean"))})
    step = step.withColumns({"name_core": core_of(F.col("name_tokens")), "addr_tokens": expanded(F.col("__addr")), "house": house_of(F.col("__addr"))})
    return step.withColumn("block", block_of(F.col("name_core"), F.col("name_tokens"), F.col("addr_tokens"), F.col("zip"))).drop("__addr")


def block_text(records: DataFrame) -> DataFrame:
    return normalised(records).withColumn("_block", F.array_join("block", " "))
