"""Tables, Markdown, files, audit and the incremental run."""

import os

import pytest
from pyspark.sql import functions as F

from pagewright.operators import audit, render, tables
from pagewright.schema import DOC_TABLE, MD_FILE, PAGE_GEOM, PAGE_TEXT, WORD, empty
from pagewright.sources import files, sinks
from pagewright.streaming.ingest import stream_section_ranges


def test_accept(spark):
    wide = lambda n, blank: [["x" if j >= blank else None for j in range(n)]]
    cases = [
        ((0, 0, 1170, 893), wide(10, 0), False), ((-5, 0, 500, 500), wide(2, 0), True), ((0, 0, 500, 500), wide(1, 0), False), ((0, 0, 500, 500), wide(10, 6), False),
        ((0, 0, 500, 500), wide(10, 5), True), ((0, 0, 500, 500), wide(9, 8), True), ((0, 0, 500, 500), [], False), ((0, 0, 500, 500), None, False),
    ]
    rows = [(1, 1, i, *map(float, box), r) for i, (box, r, _) in enumerate(cases)]
    t = tables.accepted_tables(spark.createDataFrame(rows + rows[:1], DOC_TABLE), spark.createDataFrame([(1, 1, 595.0, 842.0)], PAGE_GEOM))
    assert [r.accepted for r in t.orderBy("table_no").collect()] == [c[2] for c in cases]


def test_markdown_and_words_outside(spark):
    rows = [["项目", "2023", "Percentage"], ["Number of options", None, None], ["装机|容量", "1\n2", ""], ["", "", ""], None]
    t = spark.createDataFrame([(1, 1, 1, 50.0, 50.0, 200.0, 100.0, rows), (1, 2, 1, 0.0, 0.0, 9.0, 9.0, [["Total assets", "Net profit"]])], DOC_TABLE)
    got = tables.rendered_tables(t, empty(spark, PAGE_GEOM))
    assert [r.md for r in got.collect()] == ["| 项目 | 2023 | Percentage |\n| --- | --- | --- |\n| 装机／容量 | 1 2 |  |"]
    w = spark.createDataFrame([(1, "c", 1, 1, "in", 48.0, 60.0, 50.0, 60.0), (1, "c", 1, 2, "out", 47.9, 60.0, 50.0, 60.0), (1, "c", 2, 3, "page", 1.0, 2.0, 1.0, 2.0)], WORD)
    assert {r.text for r in tables.words_outside(w, got).collect()} == {"out", "page"}


def test_render(spark):
    merged = spark.createDataFrame([(1, "mda", 1, "p", 1, "一、甲"), (1, "mda", 2, "p", 0, "正文"), (1, "mda", 3, "t", 0, "| a |"), (1, "mda", 4, "p", 2, "1. 乙")], "doc_id long, section string, seq int, kind string, lvl int, t string")
    md = render.section_markdown(merged)
    assert md.first()["md"] == "#### 一、甲\n\n正文\n\n\n| a |\n\n\n##### 1. 乙".replace("\n\n\n", "\n\n")
    reports = spark.createDataFrame([(1, "02_甲电", "p", "a.pdf", 2023), (2, "02_甲电", "p", "b.pdf", 2023), (3, "03_乙电", "p", "c.pdf", 0)], "doc_id long, company string, path string, file_name string, year int")
    ranges = spark.createDataFrame([(1, "mda", 4, 6, "管理层讨论与分析"), (2, "mda", 1, 2, "業務回顧")], "doc_id long, section string, start int, end int, term string")
    docs = render.report_markdown(reports, ranges, md)
    one = {r.doc_id: r for r in docs.collect()}
    assert "第 4–6 页（命中标题「管理层讨论与分析」）" in one[1].content and "#### 一、甲" in one[1].content
    assert "（正文为空）" in one[2].content and "【未找到该章节】" in one[3].content and one[3].md_name == "乙电_年份未知_董事长致辞与MD&A.md"
    assert {r.doc_id for r in render.latest_by_name(docs).collect()} == {2, 3}
    total = render.extract_summary(reports, ranges).where("company is null").first()
    assert tuple(total)[1:] == (3, 0, 2, 2)


def test_files_and_audit(spark, tmp_path):
    docs = spark.createDataFrame([("02_甲电", "甲电_2023_董事长致辞与MD&A.md", "正文。\nLiaoning\n司公限有份股甲\n是担担担保否\n# — ·\n| a |\n")], "company string, md_name string, content string")
    assert sinks.write_markdown(docs, str(tmp_path)) == 1 and sinks.write_markdown(docs, str(tmp_path)) == 1
    read = files.markdown_files(spark, str(tmp_path))
    assert [(r.company, r.location) for r in read.collect()] == [("02_甲电", "sub")]
    companies = spark.createDataFrame([("02_甲电",), ("09_无",)], "company string")
    rows = {r.company: r for r in audit.audit_companies(audit.preferred_files(read), companies).collect()}
    assert (rows["02_甲电"].en, rows["02_甲电"].rv, rows["02_甲电"].dp, rows["02_甲电"].sym) == (1, 1, 1, 1) and not rows["02_甲电"].passed
    assert rows["09_无"].status == "missing" and rows["09_无"].n_files == 0 and rows[None].status == "total" and rows[None].n_files == 1
    os.makedirs(tmp_path / "02_甲电" / "年报PDF")
    (tmp_path / "02_甲电" / "年报PDF" / "甲电_2023年年度报告.pdf").write_bytes(b"x")
    found = files.report_files(spark, str(tmp_path))
    assert [(r.company, r.year) for r in found.collect()] == [("02_甲电", 2023)]
    with pytest.raises(RuntimeError):
        files.PdfReader()


def test_empty_audit(spark):
    rows = audit.audit_companies(audit.preferred_files(empty(spark, MD_FILE))).collect()
    assert all(r.n_files == 0 for r in rows)


def test_stream(spark, tmp_path):
    pages = spark.createDataFrame([(1, 1, "業務回顧\n發電"), (1, 2, "財務報表"), (1, 3, "附錄")], PAGE_TEXT)
    pages.coalesce(1).write.parquet(str(tmp_path / "in"))
    for _ in range(2):  # the second run finds nothing new
        q = stream_section_ranges(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"))
        assert q.awaitTermination(180)
    got = spark.read.parquet(str(tmp_path / "out")).where(F.col("mda_start") == 1).collect()
    assert [(r.mda_start, r.mda_end) for r in got] == [(1, 2)]
