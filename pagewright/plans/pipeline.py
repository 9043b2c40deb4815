"""The whole run over tables of pages: sections, their text, documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import layout, reflow, render, sections, tables
from ..session import cut


def long_ranges(ranges: DataFrame) -> DataFrame:
    """``doc_id, section, start, end, term`` of the sections that were found (``chair`` and ``mda``)."""
    parts = F.array(*[F.struct(F.lit(n).alias("section"), *[F.col(f"{n}_{c}").alias(c) for c in ("start", "end", "term")]) for n in ("chair", "mda")])
    return ranges.select("doc_id", F.explode(parts).alias("p")).select("doc_id", "p.*").where("start is not null")


def section_items(words: DataFrame, doc_tables: DataFrame, geometry: DataFrame, ranges: DataFrame, drop_english: bool = True) -> DataFrame:
    """The merged paragraphs and tables of the sections of ``ranges`` (see ``reflow.merged_items``)."""
    rendered = cut(tables.rendered_tables(doc_tables, geometry, drop_english))  # they take words out and stand in the text
    outside = tables.words_outside(layout.clean_words(words), rendered)
    lines = layout.visual_lines(layout.in_columns(outside, geometry, drop_english))
    return reflow.merged_items(reflow.section_items(reflow.paragraphs(lines, drop_english), rendered, ranges))


def documents(
    reports: DataFrame, ranges: DataFrame, words: DataFrame, doc_tables: DataFrame, geometry: DataFrame, script: dict[int, str] | None = None, drop_english: bool = True
) -> DataFrame:
    """``doc_id, company, year, file_name, md_name, content``: one document a company and year. Empty tables give documents without sections, or
    none; what the operators say about nulls and repeated rows holds here."""
    md = render.section_markdown(section_items(words, doc_tables, geometry, ranges, drop_english), script)
    return render.latest_by_name(cut(render.report_markdown(reports, ranges, md, script)))


def sections_found(page_text: DataFrame) -> DataFrame:
    """``long_ranges`` of the pages, written once."""
    return cut(long_ranges(sections.section_ranges(page_text)))
