"""Columns and lines against brute force and by hand."""

import random

from pagewright.operators import layout
from pagewright.schema import PAGE_GEOM, WORD, empty


def brute_cut(words, width):
    best = None
    for c in range(int(0.28 * width), int(0.72 * width) + 1, 2):
        spans = sum(a < c < b for a, b in words)
        if sum(b <= c for _, b in words) >= 8 and sum(a >= c for a, _ in words) >= 8:
            score = (spans, abs(c - width / 2), c)
            best = min(best, score) if best else score
    return (best[2], best[0]) if best and best[0] <= 2 else None


def test_cuts_are_those_of_every_candidate(spark):
    rnd = random.Random(5)
    rows, sizes, want = [], [], {}
    for d in range(60):
        width = rnd.choice([595.0, 595.28, 612.0, 842.0])
        words = []
        for _ in range(rnd.randint(10, 60)):
            left = rnd.random() < 0.5
            a = rnd.uniform(40, 0.42 * width) if left else rnd.uniform(0.5 * width, 0.85 * width)
            b = a + rnd.uniform(4, 0.12 * width)
            words.append((a, b))
        words += [(200.0, 400.0)] * rnd.choice([0, 0, 1, 2, 3])
        if d % 7 == 0:
            words.append((300.0, 300.0))  # without width
        rows += [(d, "c", 1, i, "字", a, b, 10.0, 20.0) for i, (a, b) in enumerate(words)]
        sizes.append((d, 1, width, 842.0))
        if brute_cut(words, width):
            want[d] = brute_cut(words, width)
    got = layout.column_cuts(spark.createDataFrame(rows, WORD), spark.createDataFrame(sizes, PAGE_GEOM)).collect()
    assert {r.doc_id: (r.cut, r.spans) for r in got} == want and want


def test_lines(spark):
    words = [("Unit", 10.0, 30.0), ("1", 40.0, 30.9), ("号", 50.0, 31.5), ("下", 10.0, 34.5), (None, 1.0, 30.0), ("Unit", 10.0, 30.0)]
    rows = [(1, "c", 1, 0 if i in (0, 5) else i, t, x, x + 5, top, top + 10) for i, (t, x, top) in enumerate(words)]
    df = layout.clean_words(spark.createDataFrame(rows, WORD))
    got = layout.visual_lines(layout.in_columns(df, empty(spark, PAGE_GEOM))).collect()
    assert sorted((r.k, r.t, r.x0) for r in got) == [(10, "Unit 1号", 10.0), (12, "下", 10.0)]


def test_column_choice(spark):
    rows = [(1, "c", 1, i, "word", 60.0, 150.0, 10.0 * i, 10.0 * i + 5) for i in range(8)]
    rows += [(1, "c", 1, 10 + i, "中文字", 350.0, 500.0, 10.0 * i, 10.0 * i + 5) for i in range(8)]
    words, size = spark.createDataFrame(rows, WORD), spark.createDataFrame([(1, 1, 595.0, 842.0)] * 2, PAGE_GEOM)
    cuts = layout.column_cuts(words, size)
    assert [tuple(r) for r in cuts.collect()] == [(1, 1, 298, 0)]
    assert layout.column_choice(words, cuts).first()["keep"] == "right"
    assert {r.text for r in layout.in_columns(words, size).collect()} == {"中文字"}
    assert layout.in_columns(words, size, drop_english=False).count() == 16


def test_empty(spark):
    none = layout.clean_words(empty(spark, WORD))
    assert layout.visual_lines(layout.in_columns(none, empty(spark, PAGE_GEOM))).count() == 0
