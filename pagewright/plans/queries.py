"""The queries of the report-text engine over the report tables: ``name -> (spark, sf_dir) -> DataFrame``, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.script import simplified_script
from ..operators import audit, layout, reflow, render, sections, tables
from ..session import cut, table
from . import pipeline


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return sections.page_lines(table(spark, d, "page_text"))


def line_english(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("s")
    return _lines(spark, d).select("doc_id", "page_no", "line_no", X.is_english(s).alias("english"), X.audit_english(s).alias("audit_english"))


def line_furniture(spark: SparkSession, d: str) -> DataFrame:
    forms = X.furniture_forms(F.col("s"))
    return _lines(spark, d).select("doc_id", "page_no", "line_no", *[c.alias(k) for k, c in sorted(forms.items())], X.is_furniture(F.col("s")).alias("furniture"))


def line_garbled(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("s")
    return _lines(spark, d).select(
        "doc_id", "page_no", "line_no", X.is_reversed(s).alias("rev"), X.audit_reversed(s).alias("audit_rev"), X.is_tripled(s).alias("tripled"),
        X.is_interleaved(s).alias("interleaved"), X.is_symbol_line(s).alias("symbols"), X.audit_symbol_line(s).alias("audit_symbols"),
    )


def line_heading(spark: SparkSession, d: str) -> DataFrame:
    return _lines(spark, d).select("doc_id", "page_no", "line_no", X.heading_level(F.col("s")).alias("lvl"))


def company_parse(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "reports").distinct()
    year = X.report_year(F.col("file_name"))
    return r.select("doc_id", "path", year.alias("parsed_year"), render.year_tag(year).alias("tag"), X.short_company(F.col("company")).alias("short"))


def _facts(spark: SparkSession, d: str) -> DataFrame:
    return sections.line_facts(sections.telling_lines(table(spark, d, "page_text")))


def toc_pages(spark: SparkSession, d: str) -> DataFrame:
    return sections.contents_pages(_facts(spark, d))


def section_hits(spark: SparkSession, d: str) -> DataFrame:
    facts = _facts(spark, d)
    return sections.section_starts(facts, sections.contents_pages(facts))


def section_ranges(spark: SparkSession, d: str) -> DataFrame:
    return sections.section_ranges(table(spark, d, "page_text"))


def range_labels(spark: SparkSession, d: str) -> DataFrame:
    return sections.dry_run(table(spark, d, "reports"), section_ranges(spark, d))


def _files(spark: SparkSession, d: str) -> DataFrame:
    """The MD&A sections as the finished files of a company, one a record."""
    r = table(spark, d, "section_record").where(F.length("mtext") > 0)
    return r.select("company", "file_name", F.col("mtext").alias("content"), F.lit("sub").alias("location")).distinct()


def audit_lines(spark: SparkSession, d: str) -> DataFrame:
    return audit.audit_lines(_files(spark, d), ["company", "file_name"]).drop("s")


def audit_rollup(spark: SparkSession, d: str) -> DataFrame:
    rows = audit.audit_companies(audit.preferred_files(cut(_files(spark, d))), table(spark, d, "reports"))
    return rows.withColumn("piped", F.round("piped", 6))


def table_filter(spark: SparkSession, d: str) -> DataFrame:
    t = tables.accepted_tables(table(spark, d, "doc_table"), table(spark, d, "page_geom"))
    return t.select("doc_id", "page_no", "table_no", "n_cols", F.round("blank_share", 6).alias("blank_share"), "accepted")


def _rendered(spark: SparkSession, d: str) -> DataFrame:
    return tables.rendered_tables(table(spark, d, "doc_table"), table(spark, d, "page_geom"))


def table_md(spark: SparkSession, d: str) -> DataFrame:
    return _rendered(spark, d).select("doc_id", "page_no", "table_no", "md")


def _words(spark: SparkSession, d: str) -> DataFrame:
    return tables.words_outside(layout.clean_words(table(spark, d, "word")), _rendered(spark, d))


def words_outside(spark: SparkSession, d: str) -> DataFrame:
    return _words(spark, d).select("doc_id", "page_no", "word_no")


def column_cut(spark: SparkSession, d: str) -> DataFrame:
    return layout.column_cuts(layout.clean_words(table(spark, d, "word")), table(spark, d, "page_geom"))


def column_choice(spark: SparkSession, d: str) -> DataFrame:
    words = layout.clean_words(table(spark, d, "word"))
    c = layout.column_choice(words, layout.column_cuts(words, table(spark, d, "page_geom")))
    return c.select("doc_id", "page_no", "cut", F.round("left_share", 6).alias("left_share"), F.round("right_share", 6).alias("right_share"), "keep")


def _vlines(spark: SparkSession, d: str) -> DataFrame:
    return layout.visual_lines(layout.in_columns(_words(spark, d), table(spark, d, "page_geom")))


def visual_lines(spark: SparkSession, d: str) -> DataFrame:
    return layout.visual_lines(layout.clean_words(table(spark, d, "word")).withColumn("col_no", F.lit(0)))


def column_lines(spark: SparkSession, d: str) -> DataFrame:
    return _vlines(spark, d)


def margin_mode(spark: SparkSession, d: str) -> DataFrame:
    return reflow.margins(reflow.body_lines(visual_lines(spark, d)))


def gap_median(spark: SparkSession, d: str) -> DataFrame:
    return reflow.gaps(reflow.body_lines(visual_lines(spark, d)))


def paragraph_reflow(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs of pages read as one column, so that the rule can be stated from the words on."""
    return reflow.paragraphs(visual_lines(spark, d))


def _ranges(spark: SparkSession, d: str) -> DataFrame:
    """``doc_id, section, start, end, term`` of the records' sections."""
    r = table(spark, d, "section_record")
    parts = F.array(*[F.struct(F.lit(n).alias("section"), F.col(f"{n}.start").alias("start"), F.col(f"{n}.end").alias("end"), F.col(f"{n}.term").alias("term")) for n in ("chair", "mda")])
    rows = r.select("doc_id", F.explode(parts).alias("p")).select("doc_id", "p.*").where(F.col("start").isNotNull() & F.col("end").isNotNull())
    return rows.groupBy("doc_id", "section").agg(F.max(F.struct("start", "end", "term")).alias("m")).select("doc_id", "section", "m.*")


def _merged(spark: SparkSession, d: str) -> DataFrame:
    return pipeline.section_items(table(spark, d, "word"), table(spark, d, "doc_table"), table(spark, d, "page_geom"), _ranges(spark, d))


def page_merge(spark: SparkSession, d: str) -> DataFrame:
    return _merged(spark, d)


def paragraph_lengths(spark: SparkSession, d: str) -> DataFrame:
    return audit.paragraph_lengths(_merged(spark, d)).withColumn("mean_length", F.round("mean_length", 6))


def render_sections(spark: SparkSession, d: str) -> DataFrame:
    return render.section_markdown(_merged(spark, d))


def render_report(spark: SparkSession, d: str) -> DataFrame:
    """Documents of the records' ranges and finished texts. One record a report: one scan gives both."""
    parts = F.array(*[F.struct(F.lit(n).alias("section"), F.col(n).alias("r"), F.col(t).alias("md")) for n, t in (("chair", "ctext"), ("mda", "mtext"))])
    rows = table(spark, d, "section_record").select("doc_id", F.explode(parts).alias("p")).select("doc_id", "p.*")
    found = F.col("r.start").isNotNull() & F.col("r.end").isNotNull()
    one = rows.groupBy("doc_id", "section").agg(F.max(F.when(found, F.struct("r.start", "r.end", "r.term"))).alias("m"), F.max("md").alias("md"))
    one = cut(one.select("doc_id", "section", "m.*", "md"))
    docs = render.report_markdown(table(spark, d, "reports"), one.where("start is not null"), one.select("doc_id", "section", "md"))
    return render.latest_by_name(cut(docs))


def extract_reports(spark: SparkSession, d: str, simplified: bool = False) -> DataFrame:
    """The whole run: pages to sections, words and tables of the sections to Markdown, and the document of each report."""
    ranges = pipeline.sections_found(table(spark, d, "page_text"))
    rest = [table(spark, d, n) for n in ("word", "doc_table", "page_geom")]
    return pipeline.documents(table(spark, d, "reports"), ranges, *rest, simplified_script(spark) if simplified else None)


def extract_simplified(spark: SparkSession, d: str) -> DataFrame:
    """The whole run with simplified characters, as it is by default for readers."""
    return extract_reports(spark, d, simplified=True)


def extract_audit(spark: SparkSession, d: str) -> DataFrame:
    """The audit of the documents of the whole run. Those of reports without a year stand beside their company's folder."""
    docs = extract_reports(spark, d).select("company", F.col("md_name").alias("file_name"), F.when(F.col("year") == 0, "root").otherwise("sub").alias("location"), "content")
    rows = audit.audit_companies(audit.preferred_files(cut(docs)), table(spark, d, "reports"))
    return rows.withColumn("piped", F.round("piped", 6))


def extract_summary(spark: SparkSession, d: str) -> DataFrame:
    return render.extract_summary(table(spark, d, "reports"), _ranges(spark, d))


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Words to Markdown: tables out, columns, lines, paragraphs, merge, rendering."""
    return render_sections(spark, d)


NAMES = (
    "line_english", "line_furniture", "line_garbled", "line_heading", "company_parse", "toc_pages", "section_hits", "section_ranges", "range_labels",
    "audit_lines", "audit_rollup", "table_filter", "table_md", "words_outside", "column_cut", "column_choice", "visual_lines", "column_lines",
    "margin_mode", "gap_median", "paragraph_reflow", "page_merge", "paragraph_lengths", "render_sections", "render_report", "extract_summary",
    "extract_reports", "extract_simplified", "extract_audit",
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {n: globals()[n] for n in NAMES}
