"""Ends of texts one by one, limits, and cut texts in a small corpus."""

import random

import pytest

from pagewright.llm import truncation as T

BODY = "董事会围绕降本增效，持续改进绩效考核，供热量达到80.63亿元。本年度盘活土地资源取得进展，两地管理费用分别下降2.24%和4.63%。"


@pytest.mark.parametrize(
    ("end", "state"),
    [
        ("", "done"), ("面对来水偏枯，公司将", "open"), ("面对来水偏�", "broken"), ("面对来水<br", "broken"), ("面对来水&am", "broken"), ("面对来水...", "dots"), ("前景似乎仍在犹豫……", "done"),
        ("\n| 收入 | 1 | 2 |", "done"), ("\n- 项目（甲）", "done"), ("\n一、经营情况", "done"), ("\n责任编辑：甲乙", "done"), ("\n2017年9月78日于蓼阳", "done"), ("\n“从来不是一家的事”", "done"),
        ("\n面对来水偏枯，公司将", "clause"), ("\n汐浦水电站与砚港机组实现联", "bare"), ("\n计划安排资金975.", "bare"), ("何时投产？", "done"), ("\n数据口径：净利润，下半年", "done"),
        (" Since April 2018, the Company has settled", "open"), ("\nIt was completed in 2018.", "done"),
    ],
)
def test_state(end, state):
    assert T.tail_state(BODY + end)[0] == state


@pytest.mark.parametrize("t", ["�", "...", " ", "\n", "&", "<", "字"])
def test_any_end_has_a_state(t):
    assert T.tail_state(t)[0] in ("done", "bare", "clause", "open", "dots", "broken")


def corpus():
    rnd = random.Random(6)
    sentence = lambda: "".join(rnd.choice("甲乙丙丁戊己庚辛壬癸子丑寅卯") for _ in range(rnd.randint(9, 20))) + "，" + "".join(rnd.choice("天地玄黄宇宙洪荒") for _ in range(7)) + "。"
    rows, want = [], set()
    for d in range(300):
        text = "".join(sentence() for _ in range(rnd.randint(4, 14)))
        source = rnd.choice(["limit", "free", "bytes"])
        if source == "limit" and len(text) > 150:
            text = text[:150]
        if source == "bytes" and len(text.encode()) > 400:
            text = text.encode()[:400].decode("utf-8", "ignore")
        if text[-1] != "。":
            want.add(d)
        elif rnd.random() < 0.3:
            text += rnd.choice(["\n图3 子丑走势", "\n责任编辑：甲乙", "\n（完）"])
        rows.append((d, text, source))
    return rows, want


def test_cut_texts(spark):
    rows, want = corpus()
    rows += [(1000, None, "limit"), (1001, "", "limit"), rows[0], (None, "字", "x")]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, source string, state string, n_chars int")
    limits = {(r.source, r.unit): r.high for r in T.length_limits(T.text_ends(df).where("n is null")).collect()}
    assert limits[("limit", "chars")] == 150 and limits[("bytes", "bytes")] in (398, 399, 400) and not any(k[0] == "free" for k in limits)
    got = {r.doc_id for r in T.truncated_texts(df).collect()}
    assert len(got & want) >= 0.97 * len(want) and len(got - want) <= 2
    shares = {r.source: r for r in T.truncation_by_source(df).collect()}
    assert shares["free"].n_cut <= 1 and 0 < shares["limit"].cut_share < 1


def test_a_longer_text_hides_no_limit(spark):
    rows, _ = corpus()
    rows += [(2000 + i, "甲乙丙丁，" * n + "天。", "limit") for i, n in enumerate((300, 500))]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    limits = {(r.source, r.unit): r.high for r in T.length_limits(T.text_ends(df).where("n is null")).collect()}
    assert limits[("limit", "chars")] == 150 and not any(k[0] == "free" for k in limits)


@pytest.mark.parametrize("n", [200, 1200, 5000])
def test_last_lines_of_any_length(n):
    """What a line begins with decides, however far from its end."""
    long = "甲乙丙丁戊己，" * (n // 7)
    assert T.tail_state(BODY + "\n1. " + long + "公司将")[0] == "done" and T.tail_state(BODY + "\n责任编辑：" + long + "公司将")[0] == "done"
    assert T.tail_state(BODY + "\n" + long + "公司将")[0] == "clause" and T.tail_state(BODY + long + "公司将")[0] == "open"
    assert T.tail_state(BODY + "\n" + "1," * n + "公司将 " + "2," * n + "7.")[0] in ("clause", "bare")


def test_rows_and_numbers():
    assert T._is_row("收入 1,2 3.4% -5") and T._is_row("a|b") and not T._is_row("1 2 3") and not T._is_row("收入 一 3.4 5")
    assert T._number_dot("金额975.") and T._number_dot("1,2020.") and not T._number_dot("in 2018.") and not T._number_dot("end.")


def test_long_titles_teach_their_endings():
    from collections import Counter

    counts: Counter[str] = Counter()
    T.title_endings("甲" * 120 + "走势\n" + "乙" * 200 + "。\n短题情况\n", counts, {})
    assert counts == {"走势": 1, "情况": 1}


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    assert T.truncated_texts(none).count() == 0 and T.truncation_by_source(none).count() == 0
