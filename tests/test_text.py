import unicodedata

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weftline.functions import similarity, tables, text


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first()["y"]


def test_fixed_values():
    assert (len(tables.LEGAL_TOKENS), len(tables.ADDRESS_WORDS), len(tables.US_STATES)) == (49, 70, 51)
    assert all(len(k) == 1 for t in (tables.VOWELS, tables.VOWEL_SIGNS, tables.CONSONANTS, tables.OTHER_SIGNS) for k in t)


@pytest.mark.parametrize("given_, want", [("राज", "raja"), ("कमल", "kamala"), ("ड" + "़" + "ा", "daa"), ("abc", "abc"), ("", ""), ("१२", "12"), ("ॿ", "")])
def test_transliterate(spark, given_, want):
    assert one(spark, given_, text.transliterate) == want


def test_fold_and_clean(spark):
    odd = "Café ﬁ ½ Çà №5 ｆｕｌｌ ß Øre İ"
    assert one(spark, odd, text.fold) == "cafe fi 1⁄2 ca no5 full ß øre i"
    assert one(spark, odd, text.clean) == "cafe fi 1 2 ca no5 full re i"
    assert one(spark, "A&B Co.", text.clean) == "a and b co"
    assert one(spark, None, text.clean) == "" and one(spark, "", text.tokenize) == []


def test_tokens(spark):
    core = lambda x: text.core_of(text.tokenize(x))
    assert one(spark, "The Company", core) == ["the", "company"] and one(spark, "Acme Corp. Ltd", core) == ["acme"]
    assert one(spark, "12 Main St CT", lambda x: text.expanded(text.tokenize(x))) == ["12", "main", "street", "ct"]
    assert one(spark, "Unit 5 Near Rd", lambda x: text.address_tokens_of(text.expanded(text.tokenize(x)))) == ["5", "road"]


@pytest.mark.parametrize("given_, want", [("1234567 12345 99999999", "12345"), ("1234567 12345678 9999", "12345678"), ("12345 678901 1234567", "678901"), ("no", ""), (None, ""), ("१२३४५", "१२३४५"), ("1111 2222", "1111")])
def test_zip(spark, given_, want):
    assert one(spark, given_, text.extract_zip) == want


def test_house_and_block(spark):
    house = lambda x: text.house_of(text.tokenize(x))
    assert one(spark, "12-B Main", house) == "12" and one(spark, "Main 12", house) == ""
    rows = spark.createDataFrame([("S1-1", "", "", "US"), ("S1-2", "Acme Ltd", "1 Elm Rd 12345", "US")], "entity_id string, business_name string, business_address string, country string")
    assert {r.entity_id: r._block for r in text.block_text(rows).collect()} == {"S1-1": "emptyrecord", "S1-2": "acme acme acme ltd 1 elm road 12345 12345 12345"}


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


@given(st.text("abc ", max_size=90), st.text("abcd ", max_size=90))
def test_lcs(a, b):
    assert similarity.lcs_length(a, b) == slow_lcs(a, b) == similarity.lcs_length(b, a)


def test_similarities(spark):
    rows = spark.createDataFrame([("", ""), ("a", ""), ("abc", "abd"), ("new york city", "york new"), ("x y", "z w"), ("fuzzy was a bear", "fuzzy fuzzy was a bear")], "a string, b string")
    a, b = F.col("a"), F.col("b")
    got = rows.select("a", "b", similarity.ratio(a, b).alias("r"), similarity.token_set_ratio(a, b).alias("t"), similarity.jaccard(text.tokens_of(a), text.tokens_of(b)).alias("j"), similarity.length_difference(a, b).alias("d")).collect()
    by = {(r.a, r.b): r for r in got}
    assert (by["", ""].r, by["", ""].t, by["", ""].j, by["", ""].d) == (1, 1, 1, 0)
    assert (by["a", ""].r, by["a", ""].t, by["a", ""].j, by["a", ""].d) == (0, 0, 0, 1)
    assert by["abc", "abd"].r == pytest.approx(4 / 6) and by["new york city", "york new"].t == 1 and by["fuzzy was a bear", "fuzzy fuzzy was a bear"].t == 1
    assert by["new york city", "york new"].j == pytest.approx(2 / 3)
    assert all(0 <= v <= 1 for r in got for v in (r.r, r.t, r.j, r.d))
    assert unicodedata.combining("́")
