"""Line predicates on boundary strings (checked by hand), and text functions against Python."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagewright.functions import text as X

# s, english, audit english, reversed, tripled, interleaved, furniture, level
LINES = [
    ("Liaoning", 1, 1, 0, 0, 0, 0, 0), ("MW", 0, 0, 0, 0, 0, 0, 0), ("资源量（Mt）", 0, 0, 0, 0, 0, 0, 0), ("500 MW 300 kWh", 1, 0, 0, 0, 0, 0, 0),
    ("Our principal operations", 1, 1, 0, 0, 0, 0, 0), ("ROE 5%", 0, 0, 0, 0, 0, 0, 0), ("報年5202", 0, 0, 1, 0, 0, 0, 0), ("司公限有份股源能色綠天新", 0, 0, 1, 0, 0, 0, 0),
    ("申报年度2023", 0, 0, 1, 0, 0, 0, 0), ("是担担担保否", 0, 0, 0, 1, 0, 0, 0), ("国电电力", 0, 0, 0, 0, 0, 0, 0), ("o華ur潤ce電s", 0, 0, 0, 0, 1, 0, 0),
    ("H股股東H股股東", 0, 0, 0, 0, 1, 0, 0), ("2×1,000MW机组", 0, 0, 0, 0, 0, 0, 0), ("12 / 180", 0, 0, 0, 0, 0, 1, 0), ("0002", 0, 0, 0, 0, 0, 1, 0),
    ("1234567", 0, 0, 0, 0, 0, 0, 0), ("管理層討論與及分析", 0, 0, 0, 0, 0, 1, 0), ("二〇二三年年報", 0, 0, 0, 0, 0, 1, 0), ("12中國神華能源股份有限公司", 0, 0, 0, 0, 0, 1, 0),
    ("根据2023年年度报告披露的数据公司收入增长", 0, 0, 0, 0, 0, 1, 0), ("单位：元", 0, 0, 0, 0, 0, 1, 0), ("√适用 □不适用", 0, 0, 0, 0, 0, 1, 0), ("# — · |", 0, 0, 0, 0, 0, 0, 0),
    ("一、经营情况", 0, 0, 0, 0, 0, 0, 1), ("一、本公司保证真实、", 0, 0, 0, 0, 0, 0, 0), ("（一）主营业务", 0, 0, 0, 0, 0, 0, 1), ("1.5亿元", 0, 0, 0, 0, 0, 0, 2),
    ("1. 概述", 0, 0, 0, 0, 0, 0, 2), ("（1）煤炭", 0, 0, 0, 0, 0, 0, 2), ("第三節 董事會報告", 0, 0, 0, 0, 0, 0, 1), ("第三节", 0, 0, 0, 0, 0, 0, 0),
    ("We do it", 1, 0, 0, 0, 0, 0, 0), ("abc de", 1, 0, 0, 0, 0, 0, 0), ("Hello big wide world again friends", 1, 1, 0, 0, 0, 0, 0), ("", 0, 0, 0, 0, 0, 0, 0),
]


def test_predicates(spark):
    s = F.col("s")
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(LINES)], "i int, s string")
    marks = [X.is_english(s), X.audit_english(s), X.is_reversed(s), X.is_tripled(s), X.is_interleaved(s), X.is_furniture(s), X.heading_level(s)]
    got = {r[0]: tuple(int(x) for x in r[1:]) for r in df.select("i", *marks).collect()}
    assert {LINES[i][0]: v for i, v in got.items()} == {r[0]: r[1:] for r in LINES}


def test_symbol_lines(spark):
    df = spark.createDataFrame([("---",), ("|---|",), ("# — ·",), ("a",), (None,)], "s string")
    assert [r[0] for r in df.select(X.audit_symbol_line(F.col("s"))).collect()] == [False, False, True, False, None]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="ab 　\t\n\r\x0b\x1c\x85 \xa0", max_size=8), min_size=1, max_size=30))
def test_lines_and_strip_are_pythons(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r[0]: (r[1], r[2]) for r in df.select("i", X.lines_of(F.col("t")), X.strip(F.col("t"))).collect()}
    assert got == {i: (t.splitlines(), t.strip()) for i, t in enumerate(texts)}


@pytest.mark.parametrize(("name", "year"), [("国电电力_2023年年度报告.pdf", 2023), ("招股书.pdf", 0)])
def test_report_year(spark, name, year):
    assert spark.range(1).select(X.report_year(F.lit(name))).first()[0] == year


@pytest.mark.parametrize(("folder", "short"), [("02_华能国际", "华能国际"), ("2024", "2024"), ("7 - 甲", "甲")])
def test_short_company(spark, folder, short):
    assert spark.range(1).select(X.short_company(F.lit(folder))).first()[0] == short
