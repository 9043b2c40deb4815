"""``python -m pagewright extract|audit --base FOLDER``: from reports to Markdown, and the audit of what was written."""

from __future__ import annotations

import argparse
import importlib
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.script import simplified_script
from .operators import audit, render, sections
from .plans import pipeline
from .session import cut, remove_cuts, ship_package
from .sources import files, sinks


def _reader(name: str | None) -> files.Reader:
    if name is None:
        return files.PdfReader()
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)()


def extract(spark: SparkSession, base: str, company: str | None, dry: bool, reader: files.Reader, keep_script: bool = False, keep_english: bool = False) -> list[str]:
    """The lines to print: a line a report for a dry run, else what was written by company."""
    found = files.report_files(spark, base, company, content=True)
    pages = cut(files.read_pages(found, reader))
    reports = cut(found.drop("content"))
    t = files.page_tables(pages, reports)
    failed = [f"{r.path} page {r.page_no}: {r.stage}: {r.error}" for r in files.quarantined(pages).orderBy("path", "page_no").toLocalIterator()]
    if dry:
        labels = sections.dry_run(reports, sections.section_ranges(t["page_text"])).orderBy("company", "year")
        return [r.label for r in labels.toLocalIterator()] + failed
    ranges = pipeline.sections_found(t["page_text"])
    script = None if keep_script else simplified_script(spark)
    docs = pipeline.documents(reports, ranges, t["word"], t["doc_table"], t["page_geom"], script, not keep_english)
    written = sinks.write_markdown(docs, base)
    rows = render.extract_summary(reports, ranges).orderBy(F.asc_nulls_last("company")).toLocalIterator()
    return [f"{r.company or 'total'}: {r.n_reports} reports, {r.n_chair} chairman's letters, {r.n_mda} discussions, {r.n_files} files" for r in rows] + [f"written: {written}"] + failed


def company_folders(spark: SparkSession, base: str) -> DataFrame:
    """``company``: the folders ``<number>_<name>``, also those without any document."""
    system, root = sinks.file_system(base)
    names = [f.base_name for f in system.get_file_info(sinks.fs.FileSelector(root)) if f.type == sinks.fs.FileType.Directory]
    return spark.createDataFrame([(n,) for n in sorted(names)], "company string").where(F.col("company").rlike("^[0-9]+_"))


def audit_base(spark: SparkSession, base: str) -> tuple[list[str], bool]:
    """The lines to print, and whether the corpus passes."""
    rows = audit.audit_companies(audit.preferred_files(cut(files.markdown_files(spark, base))), company_folders(spark, base))
    lines, passed = [], True
    for r in rows.orderBy(F.asc_nulls_last("company")).toLocalIterator():
        if r.status == "missing":
            lines.append(f"{r.company}: no document")
            continue
        lines.append(f"{r.company or 'total'}: {r.n_files} files, {r.n_chars} characters, English {r.en}, reversed {r.rv}, tripled {r.dp}, symbols {r.sym}, letters {r.found_chair}, discussions {r.found_mda}")
        passed = bool(r.passed) if r.status == "total" else passed
    return [*lines, "passed" if passed else "to be looked at"], passed


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="pagewright")
    sub = p.add_subparsers(dest="what", required=True)
    e, a = sub.add_parser("extract", help="reports to Markdown"), sub.add_parser("audit", help="quality of the Markdown")
    for x in (e, a):
        x.add_argument("--base", required=True, help="folder of the companies' folders, shared by all executors")
    e.add_argument("--company", help="one company's folder only")
    e.add_argument("--dry", action="store_true", help="print the page ranges and write nothing")
    e.add_argument("--reader", help="module:class of a reader in place of that for PDF")
    e.add_argument("--keep-script", action="store_true", help="leave traditional characters")
    e.add_argument("--keep-english", action="store_true", help="leave English lines and columns")
    o = p.parse_args(args)
    spark = SparkSession.builder.appName("pagewright").getOrCreate()
    ship_package(spark)
    try:
        if o.what == "audit":
            lines, passed = audit_base(spark, o.base)
        else:
            lines, passed = extract(spark, o.base, o.company, o.dry, _reader(o.reader), o.keep_script, o.keep_english), True
        print("\n".join(lines))
        return int(not passed)
    finally:
        remove_cuts(spark)


if __name__ == "__main__":
    sys.exit(main())
