"""Markdown of sections and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as X
from ..functions.script import to_simplified


def section_markdown(merged: DataFrame, script: dict[int, str] | None = None) -> DataFrame:
    """``doc_id, section, md``: the items of a section as Markdown; with ``script`` in simplified characters."""
    t = F.col("t")
    block = (
        F.when(F.col("kind") == "t", F.concat(F.lit("\n"), t, F.lit("\n")))
        .when(F.col("lvl") == 1, F.concat(F.lit("\n#### "), t, F.lit("\n")))
        .when(F.col("lvl") == 2, F.concat(F.lit("\n##### "), t, F.lit("\n")))
        .otherwise(F.concat(t, F.lit("\n")))
    )
    one = merged.select("doc_id", "section", "seq", block.alias("b")).groupBy("doc_id", "section").agg(F.sort_array(F.collect_list(F.struct("seq", "b"))).alias("_b"))
    md = X.strip(F.regexp_replace(F.array_join(F.col("_b.b"), "\n"), "\n{3,}", "\n\n"))
    return one.select("doc_id", "section", to_simplified(md, script or {}).alias("md"))


def year_tag(year: Column) -> Column:
    return F.when(year != 0, year.cast("string")).otherwise(F.lit("年份未知"))


def report_markdown(reports: DataFrame, ranges: DataFrame, sections: DataFrame, script: dict[int, str] | None = None) -> DataFrame:
    """``doc_id, company, year, file_name, md_name, content``: one document per report.

    ``ranges`` has ``doc_id, section, start, end, term``, ``sections`` has ``doc_id, section, md``; sections are named ``chair`` and ``mda``.
    """

    def of(name: str) -> DataFrame:
        r = ranges.where(F.col("section") == name).select("doc_id", *[F.col(c).alias(f"{name}_{c}") for c in ("start", "end", "term")])
        s = sections.where(F.col("section") == name).select("doc_id", F.col("md").alias(f"{name}_md"))
        return r.join(s, "doc_id", "left")

    r = reports.select("doc_id", "company", "year", "file_name").distinct().join(of("chair"), "doc_id", "left").join(of("mda"), "doc_id", "left")
    short, tag = X.short_company(F.col("company")), year_tag(F.col("year"))

    def pages(name: str) -> Column:
        return F.concat(F.lit("第 "), F.col(f"{name}_start"), F.lit("–"), F.col(f"{name}_end"), F.lit(" 页（命中标题「"), F.col(f"{name}_term"), F.lit("」）"))

    def part(name: str, missing: str) -> Column:
        body = F.coalesce(F.nullif(F.col(f"{name}_md"), F.lit("")), F.lit("（正文为空）"))
        return F.when(F.col(f"{name}_start").isNull(), F.lit(missing)).otherwise(F.concat(F.lit("> 抽取范围："), pages(name), F.lit("\n\n"), body))

    found = {n: F.coalesce(pages(n), F.lit("未找到")) for n in ("chair", "mda")}
    # Headings and labels of a document, in their order.
    content = F.concat_ws(
        "\n",
        F.concat(F.lit("# "), short, F.lit(" · "), tag, F.lit(" 年年度报告 · 董事长致辞与管理层讨论与分析")),
        F.lit(""),
        F.concat(F.lit("> **来源**：`年报PDF/"), F.col("file_name"), F.lit("`（"), short, F.lit(" "), tag, F.lit(" 年年度报告）")),
        F.concat(F.lit("> **抽取范围**：董事长致辞 "), found["chair"], F.lit("；管理层讨论与分析 "), found["mda"]),
        *[F.lit(n) for n in P.NOTES],
        F.lit(""),
        F.lit("### 董事长致辞（主席報告 / 致股东）"),
        part("chair", P.NOT_FOUND + "：本年度年报未单列董事长致辞 / 主席報告】"),
        F.lit(""),
        F.lit("### 管理层讨论与分析"),
        part("mda", P.NOT_FOUND + "】"),
        F.lit(""),
    )
    name = F.concat(short, F.lit("_"), tag, F.lit("_董事长致辞与MD&A.md"))
    return r.select("doc_id", "company", "year", "file_name", name.alias("md_name"), to_simplified(content, script or {}).alias("content"))


def latest_by_name(documents: DataFrame) -> DataFrame:
    """One document for each company and file: of several reports of a year the one with the greatest file name wins, then the greatest id."""
    best = documents.groupBy("company", "md_name").agg(F.max_by("doc_id", F.struct("file_name", "doc_id")).alias("doc_id"))
    return documents.join(best, ["company", "md_name", "doc_id"], "left_semi")


def extract_summary(reports: DataFrame, ranges: DataFrame) -> DataFrame:
    """``company, n_reports, n_chair, n_mda, n_files`` with a total row (company null): reports, sections found, and files."""
    hits = ranges.groupBy("doc_id").agg(F.max((F.col("section") == "chair").cast("int")).alias("c"), F.max((F.col("section") == "mda").cast("int")).alias("m"))
    r = reports.select("doc_id", "company", "year").distinct().join(hits, "doc_id", "left")
    each = r.groupBy("company", "year").agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("c", F.lit(0))).alias("c"), F.sum(F.coalesce("m", F.lit(0))).alias("m"))
    return each.rollup("company").agg(
        F.sum("n").alias("n_reports"), F.sum("c").alias("n_chair"), F.sum("m").alias("n_mda"), F.count(F.lit(1)).alias("n_files")
    )
