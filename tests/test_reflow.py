"""Paragraphs, letter runs and merging: by hand, and windows against a fold."""

import random

from pagewright.operators import reflow

LINE = "doc_id long, page_no int, col_no int, k int, t string, x0 double"


def paras(spark, lines, **options):
    df = spark.createDataFrame([(1, 1, 0, k, t, float(x)) for k, x, t in lines], LINE)
    return [(r.lvl, r.t) for r in reflow.paragraphs(df, **options).orderBy("para_no").collect()]


def test_reflow_by_hand(spark):
    lines = [(1, 80, "公司实现"), (6, 58, "营业收入"), (11, 58, "同比增长"), (16, 80, "本年装机"), (21, 58, "容量提升"), (26, 58, "一、经营情况"), (31, 58, "煤炭业务"), (39, 58, "稳步推进")]
    assert paras(spark, lines) == [(0, "公司实现营业收入同比增长"), (0, "本年装机容量提升"), (1, "一、经营情况"), (0, "煤炭业务"), (0, "稳步推进")]


def test_margin_and_gap_ties(spark):
    df = spark.createDataFrame([(1, 1, 0, k, "字", x) for k, x in ((1, 80.0), (6, 58.0), (12, 58.0), (17, 80.0))], LINE)
    assert reflow.margins(df).first()["margin"] == 80
    assert reflow.gaps(df).first()["med"] == 5
    assert reflow.gaps(df.where("k in (1, 6, 12)")).first()["med"] == 6
    assert reflow.gaps(df.where("k = 1")).first()["med"] == 1


def fold(lines):
    """Paragraphs of body lines by a loop."""
    xs = [round(x) for _, x, _ in lines]
    margin = max(dict.fromkeys(xs), key=xs.count)
    d = sorted(b[0] - a[0] for a, b in zip(lines, lines[1:]))
    med = d[len(d) // 2] if d else 1
    out, last = [], None
    for k, x, t in lines:
        head = t.startswith("一、")
        new = last is None or head or last[1] or x - margin >= 12 or k - last[0] >= max(med + 3, med * 1.5, 4)
        out = [*out, (int(head), t)] if new else [*out[:-1], (0, out[-1][1] + t)]
        last = (k, head)
    return out


def test_windows_are_the_fold(spark):
    rnd = random.Random(1)
    for _ in range(4):
        k, lines = 0, []
        for i in range(40):
            k += rnd.choice([4, 5, 5, 6, 8, 9])
            lines.append((k, rnd.choice([58, 58, 58, 80, 69.5]), rnd.choice(["一、标题", f"正文第{i}行字"])))
        assert paras(spark, lines) == fold(lines)


def test_letter_runs(spark):
    schema = "doc_id long, page_no int, col_no int, para_no int, lvl int, t string"

    def left(texts):
        df = spark.createDataFrame([(1, 1, 0, i, 1 if t.startswith("一") else 0, t) for i, t in enumerate(texts)], schema)
        return [r.t for r in reflow.without_letter_runs(df).orderBy("para_no").collect()]

    assert left(list("gsCo")) == []
    assert left(list("abc")) == list("abc")
    assert left(list("甲乙丙丁")) == []
    assert left(["a", "b", "一、标题", "c", "d"]) == ["a", "b", "一、标题", "c", "d"]
    assert left(["a", "b", "1", "c", "d"]) == ["a", "b", "1", "c", "d"]


def test_merge(spark):
    rows = [
        (1, 1, "p", 0, "大范围持续高温", 0, 1), (1, 1, "p", 0, "和寒潮影响。", 1, 1), (1, 2, "p", 0, "下一年计划", 0, 1), (1, 2, "p", 0, "继续推进", 0, 2),
        (1, 2, "t", 0, "| a |", -1, 1), (1, 3, "p", 0, "并扩大", 0, 1), (1, 3, "p", 0, "1.5亿元投资", 1, 1),
    ]
    items = spark.createDataFrame([(*r, "mda") for r in rows], "doc_id long, page_no int, kind string, lvl int, t string, col_no int, no int, section string")
    got = [r.t for r in reflow.merged_items(items).orderBy("seq").collect()]
    assert got == ["大范围持续高温和寒潮影响。", "下一年计划", "继续推进", "| a |", "并扩大", "1.5亿元投资"]
