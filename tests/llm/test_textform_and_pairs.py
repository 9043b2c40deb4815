"""One form of text: what must become equal, what must stay different, and pairs against brute force."""

import itertools

import pytest
from hypothesis import given
from hypothesis import strategies as st

from pagewright.llm import visual_form as V
from pagewright.llm.textform import folded_form, letters_form, visual_form

ALIKE = [
    ("ＡＢＣ　１２", "ABC 12"), ("é", "é"), ("a​b﻿", "ab"), ("a b", "a b"), ("a b", "a b"), ("Маss", "Mass"), ("Ορ", "Op"), ("⻓⻛", "长风"),
    ("⽤⼒", "用力"), ("㎿", "MW"), ("数數"[0] + "數", "数數"), ("о́", "ó"), ("a\r\nb", "a\nb"), ("：", ":"),
]
DIFFERENT = [("国", "國"), ("1", "l"), ("a", "A"), ("3.1", "3.2"), ("ab", "a b"), ("の", "的")]


@pytest.mark.parametrize(("a", "b"), ALIKE)
def test_alike(a, b):
    assert visual_form(a) == visual_form(b)


@pytest.mark.parametrize(("a", "b"), DIFFERENT)
def test_different(a, b):
    assert visual_form(a) != visual_form(b)


@given(st.text(max_size=60))
def test_forms_are_stable(t):
    once = visual_form(t)
    assert visual_form(once) == once
    assert letters_form(t).count("\n") == t.count("\n")
    assert folded_form(folded_form(t)) == folded_form(t)


def test_pairs_are_those_of_brute_force(spark):
    texts = ["甲乙ＡＢ", "甲乙AB", "甲乙ab", "甲乙​AB", "甲乙AB", None, "", "丙", "丙 丁", "丙　丁", "同", "同"]
    rows = [(i, t, "x" if i % 2 else None) for i, t in enumerate(texts)] + [(1, "甲乙AB", "x"), (None, "甲乙AB", "x")]
    df = spark.createDataFrame(rows, "doc_id long, ctext string, field string")  # a clashing extra column
    want = {
        ("ctext", a[0], b[0])
        for a, b in itertools.permutations([r for r in set(rows) if r[0] is not None and r[1]], 2)
        if a[0] < b[0] and a[1] != b[1] and visual_form(a[1]) == visual_form(b[1])
    }
    got = V.same_looking_pairs(df, ["ctext"]).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_links_are_those_of_brute_force(spark):
    texts = ["ＡＢ", "AB", "ab", "AB", "A​B", None, "", "丙", "丙"] + ["hot"] * 30 + ["ｈot"] * 20 + ["HOT"] * 5
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(1, "AB", 1)], "doc_id long, ctext string, n_links int")
    got = {r.doc_id: r for r in V.linked_classes(df, ["ctext"]).collect()}
    assert len(got) == len(texts) - 2
    for i, r in got.items():
        assert r.n_links == sum(bool(t) and visual_form(t) == visual_form(texts[i]) and t != texts[i] for t in texts)
    assert len({r.fold_id for r in got.values()}) == 3 and len({r.class_id for r in got.values()}) == 5
    assert V.linked_classes(df.where("false"), ["ctext"]).count() == 0


def test_forms_and_empty_table(spark):
    df = spark.createDataFrame([(1, "Ａ", None), (2, None, "")], "doc_id long, ctext string, mtext string")
    assert [tuple(r) for r in V.visual_forms(df, ["ctext", "mtext"]).collect()] == [(1, "ctext", "A", "a")]
    assert V.same_looking_pairs(df.where("false"), ["ctext", "mtext"]).count() == 0
