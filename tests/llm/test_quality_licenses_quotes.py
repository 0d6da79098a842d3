"""The operators on DataFrame functions only: 10, 9 and 5."""

from __future__ import annotations

import re
from collections import Counter

import duckdb
import pytest

from weftline.llm import licenses, quality, queries, quotes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [None, "", " \t\n\x0b\x0c\r ", "one", "a b", "a a a", "a b c a b c", "x y z\nx y z\n\nx y z\n", "# * $ % & | < > é ß ü", "w " * 30000, " ".join(f"w{i}" for i in range(60)), "the same line\n" * 40, "Ünï  cödé word \x1c\x1d"]


def measured(text):
    text = text or ""
    w = WORD.findall(text)
    grams = Counter(zip(w, w[1:], w[2:]))
    covered = {p for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(text.count(c) for c in quality.SYMBOLS), len(lines) - len(set(lines)), len(covered)


def test_measurements_against_brute_force(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)] + [(3, "one", "x")], "doc_id long, text string, n_words string")
    got = quality.verdict(quality.ledger(docs)).collect()
    assert len(got) == len(TEXTS) + 1
    for r in got:
        n_words, _, _, _, n_repeat = want = measured(TEXTS[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (n_words < 50 or 100 * n_repeat > 50 * n_words)
        assert not (r.base_failed and r.kept)


def test_ablation_is_the_ledger_summed(spark):
    docs = spark.createDataFrame([("alpha beta",), ("# " * 60,), (" ".join(f"word{i}" for i in range(60)),)], "text string")
    book = quality.ledger(docs)
    found = {r.rule: (r.n_failed, r.n_only) for r in quality.ablation(book).collect()}
    assert found["few_words"] == (1, 1) and found["symbols"][0] == 1 and found["symbols"][1] == 0
    kept = {v: quality.verdict(book, v).where("kept").count() for v in quality.POLICIES}
    assert kept == {1: 1, 2: 1}
    assert quality.ledger(docs.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op10_quality_rules", "op5_quotation_linking", "op9_license_scan", "op8_embedding_near_dedup"])
def test_against_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.sql(f"create view {t} as from read_parquet('{sf_dir}/{t}.parquet')")
    want = con.sql(queries.ORACLES[name]).df()
    got = queries.QUERIES[name](spark, sf_dir).toPandas()[list(want.columns)]
    plain = lambda x: int(x) if isinstance(x, float) and x.is_integer() else x  # noqa: E731  whole numbers beside nulls
    norm = lambda d: sorted(repr([plain(x) for x in r]) for r in d.astype(object).where(d.notna(), None).values.tolist())
    assert norm(got) == norm(want)


def dice_of(text):
    """(license, dice, n_units) by comparing all units with all templates."""
    t = (text or "").lower()
    bare = "\n".join(re.sub(r"^[ \t]*[*/#;%-]+", "", x) for x in t.split("\n"))
    kinds = [t, *re.split(r"\n[ \t\r]*\n", t), *t.split("\n"), *re.split(r"[.!?:;][ \t\r\n]+", t), *re.split(r"\n[ \t\r]*\n", bare)]
    units = {" ".join(re.sub("[^a-z0-9]+", " ", u).split()) for u in kinds}
    best, n = None, 0
    for u in units:
        w = u.split()
        a = set(zip(w, w[1:]))
        found = []
        for name, texts in licenses.TEMPLATES.items():
            for x in texts:
                b = {tuple(g.split()) for g in licenses.template_bigrams(x)}
                d = 2 * len(a & b) / (len(a) + len(b))
                if d >= licenses.THRESHOLD:
                    found.append((-d, name))
        if found:
            n += 1
            best = min([min(found)] + ([best] if best else []))
    return (best[1], round(-best[0], 9), n) if best else (None, None, 0)


LICENSED = [
    None, "", "license", "Licensed under the Apache License, Version 2.0.", "prose before\n  LICENSED under the apache license version 2.0\nprose after",
    licenses.TEMPLATES["MIT-text"][0].replace(" to ", " to\n", 3), "Released under the MIT License.\nReleased under the MIT License.\n\nLicensed under CC BY 4.0.",
    "Copyright (c) 2020 Foo Bar Inc. Licensed under the Apache License, Version 2.0.",
    "/*\n * Copyright 2021 Foo\n *\n * " + re.sub("(.{60}\\S*) ", r"\1\n * ", licenses.TEMPLATES["MIT-text"][1]) + "\n *\n */\nint main() {}",
    "This work is licensed under the GNU Lesser General Public License, version 3.", "Licensed under the Apache thing", "licensed " * 500, "Licensed under CC BY-NC 4.0. and some more words here to miss it",
]


def test_licenses_against_brute_force(spark):
    docs = spark.createDataFrame([(i, t, 1.0) for i, t in enumerate(LICENSED)] + [(3, LICENSED[3], 1.0)], "doc_id long, text string, dice double")
    got = licenses.scan(docs, ["doc_id"]).collect()
    assert len(got) == len(LICENSED) + 1
    for r in got:
        want = dice_of(LICENSED[r.doc_id])
        assert (r.license, r.dice and round(r.dice, 9), r.n_units) == want
    assert licenses.scan(docs.limit(0), ["doc_id"]).count() == 0
    found = {r.doc_id: r.license for r in got}
    assert [found[i] for i, t in enumerate(LICENSED) if t and "opyright" in t[:20]] == ["Apache-2.0", "MIT-text"]


def test_pivots_never_lose_a_unit():
    known = [licenses.template_bigrams(t) for texts in licenses.TEMPLATES.values() for t in texts]
    words, bigrams = licenses.pivots(known)
    assert len(words) + len(bigrams) < 40
    for b in known:
        low, high = licenses.bounds(len(b))
        held = [g for g in b if g in bigrams or set(g.split()) & set(words)]
        assert low <= len(b) <= high and len(held) > len(b) - low


def test_short_and_long_quotations(spark):
    rows = [
        (1, 0, "u", "ok thanks"), (1, 1, "u", "> ok thanks\nyou are welcome"),  # a short whole passage, in its own conversation
        (2, 0, "u", "> ok thanks\nfor what"),  # and not in another one
        (3, 0, "u", "see you later\nand some other things to say"), (4, 0, "u", "> see you later\n> what was not said before\nwell"),  # a short line of a passage
        (5, 0, "u", "a line of at least eight words links alone\nand more"), (6, 0, "u", "> a line of at least eight words links alone\n> unknown\nyes"),
        (7, 0, "u", "\u6c34\u306f\u4f55\u5ea6\u3067\u6cb8\u9a30\u3057\u307e\u3059\u304b\u6559\u3048\u3066"), (8, 0, "u", "> \u6c34\u306f\u4f55\u5ea6\u3067\u6cb8\u9a30\u3057\u307e\u3059\u304b\u6559\u3048\u3066\n100"),  # no blanks between words
        (9, 0, "u", "first paragraph of words\n\nsecond paragraph of words"), (9, 1, "u", "x"), (9, 2, "u", "> first paragraph\n> of words\n>\n> gone\nso"),  # one paragraph, wrapped anew
    ]
    got = {(r.conv_id, r.turn): (r.linked, r.reply_conv, r.reply_turn) for r in quotes.link(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got[1, 1] == (True, 1, 0) and got[2, 0] == (False, None, None) and got[4, 0] == (False, None, None)
    assert got[6, 0] == (True, 5, 0) and got[8, 0] == (True, 7, 0) and got[9, 2] == (True, 9, 0)


TALK = [
    (1, 0, "user", "Could you please explain how the kettle works?\nI have no idea."),
    (1, 1, "assistant", "On Monday someone wrote:\n> Could you please explain how the kettle works?\nIt heats the water inside."),
    (1, 2, "user", ">> could you PLEASE explain how the kettle works\n> It heats the water inside.\n\nThank you very much indeed"),
    (2, 0, "user", "> It heats the water inside.\nNot in my kitchen it does"),
    (2, 1, "assistant", "no quotes at all here"),
    (3, 0, "user", "> nobody ever said this sentence\nwell then"),
    (3, 1, "user", None),
    (3, 1, "user", None),
    (None, 5, "user", "> It heats the water inside."),
    (4, 0, "user", "> > \n>\n"),
]


def test_quotations_link_and_go(spark):
    got = quotes.link(spark.createDataFrame(TALK, "conv_id long, turn long, role string, text string")).collect()
    assert len(got) == len(TALK)
    by = {(r.conv_id, r.turn): r for r in got}
    assert by[1, 1].body == "It heats the water inside." and (by[1, 1].reply_conv, by[1, 1].reply_turn, by[1, 1].linked) == (1, 0, True)
    assert by[1, 2].body == "Thank you very much indeed" and (by[1, 2].reply_conv, by[1, 2].reply_turn) == (1, 1)
    assert (by[2, 0].reply_conv, by[2, 0].reply_turn, by[2, 0].linked, by[2, 0].thread_id) == (1, 1, True, 1)
    assert (by[2, 1].reply_conv, by[2, 1].reply_turn, by[2, 1].linked, by[2, 1].thread_id) == (2, 0, False, 1)
    assert (by[3, 0].reply_conv, by[3, 0].linked, by[3, 0].thread_id) == (None, False, 3) and by[3, 1].body == ""
    assert by[None, 5].thread_id is None and by[None, 5].reply_conv is None
    assert [r.position for r in sorted(got, key=lambda r: (r.conv_id or 0, r.turn)) if r.thread_id == 1] == [1, 2, 3, 4, 5]
    assert by[4, 0].body == "" and by[4, 0].n_quoted == 2


def test_quotations_against_sql(spark):
    con = duckdb.connect()
    con.sql("create table conversations(conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", [list(t) for t in TALK])
    got = quotes.link(spark.createDataFrame(TALK, "conv_id long, turn long, role string, text string"))
    want = con.sql(f"select {', '.join(got.columns)} from ({queries.ORACLES['op5_quotation_linking']})").fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got.collect())


def test_replies_come_after_what_they_reply_to(spark, sf_dir):
    rows = queries.op5_quotation_linking(spark, sf_dir).toPandas()
    place = {(r.conv_id, r.turn): (r.thread_id, r.position) for r in rows.itertuples()}
    for r in rows.dropna(subset=["reply_conv"]).itertuples():
        thread, position = place[r.reply_conv, r.reply_turn]
        assert thread == r.thread_id and position < r.position
    assert quotes.link(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_long_conversations_are_walked_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(quotes, "TURNS", 4)
    rows = quotes.link(spark.createDataFrame([(7, 3 * i, "user", f"t{i}") for i in range(20)], "conv_id long, turn long, role string, text string")).orderBy("turn").collect()
    assert [r.reply_turn for r in rows] == [None, *range(0, 57, 3)] and [r.position for r in rows] == list(range(1, 21))
