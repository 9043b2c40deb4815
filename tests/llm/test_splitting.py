"""Pieces: limits, overlap, coverage and natural cuts, on any text."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pagewright.llm import splitting as S


def units(t, unit):
    return len(t) if unit == "chars" else len(t.encode())


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab c字é。，\n.é𠮷👍‍", max_size=400), st.integers(30, 80), st.integers(0, 12), st.sampled_from(["chars", "bytes"]))
def test_pieces(text, limit, overlap, unit):
    pieces = S.split_text(text, limit, overlap, unit)
    if not text:
        assert pieces == []
        return
    assert pieces[0].start == 0 and pieces[-1].end == len(text)
    for p, q in zip(pieces, pieces[1:], strict=False):
        shared = units(text[q.start : p.end], unit)
        assert q.overlap_units == shared and q.start <= p.end < q.end
        assert shared >= overlap or q.start == 0
        assert shared <= overlap + 40  # whole characters
    for p in pieces:
        assert p.units == units(text[p.start : p.end], unit) <= limit
    if overlap == 0:
        assert "".join(text[p.start : p.end] for p in pieces) == text


def least_cost(text, limit, overlap, unit):
    """The least cost over every position, by trying each piece from each begin."""
    n, size = len(text), lambda a, b: units(text[a:b], unit)
    kinds = {}
    for kind, pattern in (("word", S._WORD), ("line", S._LINE), ("clause", S._CLAUSE), ("sentence", S._SENTENCE), ("paragraph", S._PARAGRAPH)):
        kinds.update((m.end(), kind) for m in pattern.finditer(text) if 0 < m.end() < n)
    total = size(0, n)
    pieces = max(2, -(-(total - overlap) // max(1, limit - overlap)))
    target = (total + (pieces - 1) * overlap) / pieces

    def begin(e):
        i = e
        while i > 0 and (size(i, e) < overlap or S._joined(text, i)):
            i -= 1
        return i

    best = {}
    for e in range(1, n + 1):
        if e < n and S._joined(text, e):
            continue
        penalty = S.PENALTY["end" if e == n else kinds.get(e, "character")]
        options = [0.0] if size(0, e) <= limit else []
        froms = [(0, 0.0)] if options else []
        froms += [(begin(i), c) for i, c in best.items() if size(begin(i), e) <= limit]
        costs = [c + penalty + S.BALANCE * ((size(b, e) - target) / target) ** 2 for b, c in froms]
        if costs:
            best[e] = min(costs)
    return best.get(n), target


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab c字é。，\n.👍‍甲乙丙丁戊己", min_size=31, max_size=110), st.integers(26, 50), st.integers(0, 10), st.sampled_from(["chars", "bytes"]))
def test_pieces_are_the_best_over_all_positions(text, limit, overlap, unit):
    if units(text, unit) <= limit:
        return
    least, target = least_cost(text, limit, overlap, unit)
    try:
        pieces = S.split_text(text, limit, overlap, unit)
    except ValueError:
        assert least is None
        return
    cost = sum(S.PENALTY[p.cut] + S.BALANCE * ((p.units - target) / target) ** 2 for p in pieces)
    assert abs(cost - least) < 1e-9


def test_bad_profiles_and_texts_end_no_job(spark):
    df = spark.createDataFrame([(1, "甲" * 30), (2, "👍‍" * 9)], "doc_id long, ctext string")
    prof = spark.createDataFrame([("o", "ctext", "chars", 20, 20), ("s", "ctext", "bytes", 2, 0), ("u", "ctext", "pages", 2, 0), ("m", "ctext", "chars", 0, -1)], "profile string, field string, unit string, max_size int, overlap int")
    got = {(r.profile, r.doc_id): (r.piece_no, r.cut, r.text) for r in S.oversized_pieces(df, prof).collect()}
    assert got == {(p, d): (0, S.UNSPLITTABLE, "") for p, d in (("o", 1), ("s", 1), ("s", 2), ("m", 1), ("m", 2))}
    assert {tuple(r) for r in S.oversized_items(df, prof).collect()} == set(got)


def test_natural_cuts():
    text = "第一段第一句。第一段第二句。\n第二段只有一句，有两个分句。\n第三段。"
    assert [p.cut for p in S.split_text(text, 20)] == ["paragraph", "paragraph", "end"] or S.split_text(text, 20)[0].cut == "paragraph"
    assert S.split_text("一二三，四五六，七八九", 8)[0].cut == "clause"
    assert S.split_text("甲" * 100, 30)[0].cut == "character"
    assert [len(S.split_text("甲" * n, 30)) for n in (1, 30, 31)] == [1, 1, 2]


def test_long_text_without_boundaries_is_quick():
    pieces = S.split_text("字" * 300_000, 2000, 150, "bytes")
    assert max(p.units for p in pieces) <= 2000


def test_no_character_is_broken():
    pieces = S.split_text("é" * 50, 31)
    assert all(p.end % 2 == 0 for p in pieces)
    with pytest.raises(ValueError):
        S.split_text("字字字", 2, 0, "bytes")


def test_operator(spark):
    df = spark.createDataFrame([(1, "甲" * 30, None), (1, "甲" * 30, None), (2, None, "乙" * 5), (3, "", "")], "doc_id long, ctext string, text string")
    prof = spark.createDataFrame([("c", "ctext", "chars", 20, 2), ("b", "ctext", "bytes", 90, 0), ("z", "nofield", "chars", 1, 0), ("n", "ctext", None, 1, 0)], "profile string, field string, unit string, max_size int, overlap int")
    got = S.oversized_pieces(df, prof).orderBy("piece_no").collect()
    assert [(r.profile, r.doc_id, r.piece_no) for r in got] == [("c", 1, 1), ("c", 1, 2)] and all(r.text == "甲" * r.units for r in got)
    assert [tuple(r) for r in S.oversized_items(df, prof).collect()] == [("c", 1)]
    assert S.oversized_pieces(df.where("false"), prof).count() == 0 and S.oversized_pieces(df, prof.where("false")).count() == 0
