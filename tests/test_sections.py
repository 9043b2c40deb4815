"""Section ranges of small reports worked out by hand (pages by `` // ``, lines by `` / ``)."""

from pagewright.operators import sections
from pagewright.schema import PAGE_TEXT, empty

REPORTS = {
    1: "国电电力发展股份有限公司 / 2023年年度报告 // 目录 / 第一节 释义 / 第二节 公司简介和主要财务指标 / 第三节 管理层讨论与分析 // 第一节 释义 / 在本报告书中 // "
    "第三节 管理层讨论与分析 / 公司实现营业收入 // 第三节 管理层讨论与分析 / 装机容量 // 第四节 公司治理 / 治理情况",
    2: "中國電力 // 10主席報告 / 20管理層討論及分析 / 30董事會報告 / 40企業管治報告 // 主席報告 / 董事會報告 / 各位股東 // 主席報告 / 本年度業績理想 // "
    "管理層討論及分析 / 業績 // 管理層討論及分析 / 發電量 // 企業管治報告 / 管治",
    3: "業務回顧 / 發電 // 財務報表 / 數據 // 附錄",
    4: "封面 // 致股东的信 / 各位股东 // 第二節 公司治理 / 內容 // 第五节 董事会工作报告 / 內容",
}
EXPECTED = {
    1: (None, None, None, None, 4, 6, "管理层讨论与分析", 3),
    2: (3, 5, "主席報告", None, 6, 7, "管理層討論及分析", None),
    3: (None, None, None, None, 1, 2, "業務回顧", None),
    4: (2, 3, "致股东的信", None, None, None, None, None),
    5: (None,) * 8,
}


def pages(spark):
    rows = [(d, i, p.replace(" / ", "\n")) for d, t in REPORTS.items() for i, p in enumerate(t.split(" // "), 1)]
    rows += [(5, 1, None), (5, 2, ""), rows[0], rows[0]]  # null and empty pages, repeated rows
    return spark.createDataFrame(rows, PAGE_TEXT)


def test_ranges(spark):
    cols = ["chair_start", "chair_end", "chair_term", "chair_num", "mda_start", "mda_end", "mda_term", "mda_num"]
    # An extra column with a clashing name changes nothing.
    got = sections.section_ranges(pages(spark).selectExpr("*", "1 AS s", "2 AS term")).collect()
    assert {r["doc_id"]: tuple(r[c] for c in cols) for r in got} == EXPECTED


def test_contents_pages(spark):
    facts = sections.line_facts(sections.telling_lines(pages(spark)))
    listed = {(r.doc_id, r.page_no) for r in sections.contents_pages(facts).where("is_contents").collect()}
    assert listed == {(1, 2), (2, 2)}


def test_labels(spark):
    reports = spark.createDataFrame([(2, "02_中国电力", "p", "f.pdf", 2023)], "doc_id long, company string, path string, file_name string, year int")
    label = sections.dry_run(reports, sections.section_ranges(pages(spark))).first()["label"]
    assert label == "02_中国电力 2023: 董事长=p3-5[主席報告] | MD&A=p6-7[管理層討論及分析]"


def test_empty(spark):
    assert sections.section_ranges(empty(spark, PAGE_TEXT)).count() == 0
