"""Quality of finished documents: counts of defects by line, company and corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as X

DEFECTS = ("en", "rv", "dp", "sym")


def audit_lines(files: DataFrame, key: list[str]) -> DataFrame:
    """``key``, ``line_no, s, en, rv, dp, sym``: the non-blank lines of each file's ``content`` with the four defects."""
    rows = files.select(*key, F.posexplode(X.lines_of(F.col("content"))).alias("_i", "_s"))
    s = F.col("s")
    lines = rows.select(*key, (F.col("_i") + 1).alias("line_no"), X.strip(F.col("_s")).alias("s")).where("s <> ''")
    return lines.select("*", X.audit_english(s).alias("en"), X.audit_reversed(s).alias("rv"), X.audit_tripled(s).alias("dp"), X.audit_symbol_line(s).alias("sym"))


def preferred_files(files: DataFrame) -> DataFrame:
    """Of a company's files those in its own folder (``location`` ``sub``), or else those beside it (``root``)."""
    best = files.groupBy("company").agg(F.max((F.col("location") == "sub").cast("int")).alias("_sub"))
    return files.join(best, "company").where((F.col("location") == "sub") | (F.col("_sub") == 0)).drop("_sub")


def audit_companies(files: DataFrame, companies: DataFrame | None = None) -> DataFrame:
    """``company, status, n_files, n_chars, en, rv, dp, sym, has_chair, has_mda, found_chair, found_mda, piped, passed, strict``.

    One row for each company and a total (company null). ``has_*`` test whether a text mentions a section (any text made here does),
    ``found_*`` whether it doesn't say that the section is missing, ``piped`` is the share of lines that begin with a bar. A company of
    ``companies`` without files has the status ``missing`` and zeros.
    """
    sized = files.select("company", "file_name", F.coalesce("content", F.lit("")).alias("content"))
    norm = F.array_join(X.lines_of(F.col("content")), "\n")
    chair_part = F.regexp_extract("content", r"(?s)### 董事长致辞.*?(?=### 管理层|$)", 0)
    per_file = sized.select(
        "company",
        "file_name",
        F.length(norm).alias("chars"),
        norm.rlike(P.CHAIR_MENTION).cast("int").alias("hc"),
        norm.rlike(P.MDA_MENTION).cast("int").alias("hm"),
        (~chair_part.contains(P.NOT_FOUND)).cast("int").alias("fc"),
        (~F.col("content").contains(P.NOT_FOUND + "】")).cast("int").alias("fm"),
    )
    f = per_file.groupBy("company").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("chars").alias("n_chars"), *[F.max(a).alias(b) for a, b in (("hc", "has_chair"), ("hm", "has_mda"), ("fc", "found_chair"), ("fm", "found_mda"))]
    )
    lines = audit_lines(sized, ["company", "file_name"])
    defects = lines.groupBy("company").agg(
        *[F.count_if(d).alias(d) for d in DEFECTS], F.count_if(F.col("s").startswith("|")).alias("n_piped"), F.count(F.lit(1)).alias("n_lines")
    )
    rows = f.join(defects, "company", "left")
    if companies is not None:
        rows = companies.select("company").distinct().join(rows, "company", "left")
    rows = rows.withColumn("status", F.when(F.col("n_files").isNull(), "missing").otherwise("ok"))
    sums = ["n_files", "n_chars", *DEFECTS, "has_chair", "has_mda", "found_chair", "found_mda", "n_piped", "n_lines"]
    total = rows.rollup("company").agg(
        F.when(F.grouping("company") == 1, F.lit("total")).otherwise(F.max("status")).alias("status"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums]
    )
    clean = (F.col("en") == 0) & (F.col("rv") == 0) & (F.col("sym") == 0)
    strict = clean & (F.col("dp") == 0) & (F.col("found_chair") > 0) & (F.col("found_mda") > 0)
    piped = F.col("n_piped") / F.greatest(F.lit(1), F.col("n_lines"))
    return total.select("company", "status", *sums[:10], piped.alias("piped"), clean.alias("passed"), strict.alias("strict"))


def paragraph_lengths(merged: DataFrame) -> DataFrame:
    """``doc_id, section, n_paragraphs, mean_length, n_short``: body paragraphs, for spotting text that is split too often."""
    body = merged.where("kind = 'p' and lvl = 0").withColumn("n", F.length("t"))
    return body.groupBy("doc_id", "section").agg(F.count(F.lit(1)).alias("n_paragraphs"), F.avg("n").alias("mean_length"), F.count_if(F.col("n") <= 60).alias("n_short"))
