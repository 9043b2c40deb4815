"""Where a report's two sections stand: first title, contents pages, stop tokens and page ranges, as set operations.

A section begins at the first title line outside contents pages and ends at the first later page that bears a title token not already usual
before the section (usual: on two pages). All steps are aggregates and equi-joins keyed by report and page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as X
from ..session import cut

CHAIR_LIMIT = 45


def page_lines(page_text: DataFrame) -> DataFrame:
    """``doc_id, page_no, line_no, s``: the stripped lines of each page, numbered from 1.

    A page given several times counts once (the greatest text, if they differ); a null or empty page has no lines but still counts as a page
    for ``page_counts``.
    """
    lines = _pages(page_text).select("doc_id", "page_no", F.posexplode(X.lines_of(F.col("text"))).alias("_i", "_s"))
    return lines.select("doc_id", "page_no", (F.col("_i") + 1).alias("line_no"), X.strip(F.col("_s")).alias("s"))


def _pages(page_text: DataFrame) -> DataFrame:
    """One text a page; a set of its texts (almost always one) is hashed, where the greatest of strings would sort whole texts."""
    return page_text.groupBy("doc_id", "page_no").agg(F.array_max(F.collect_set("text")).alias("text"))


def telling_lines(page_text: DataFrame) -> DataFrame:
    """The lines of ``page_lines`` that a search for sections looks at - short ones, and those that open a section - with ``after``, the first line
    with text among the next two. Looking ahead needs no shuffle, since the lines of a page are still one array; long lines go no further."""
    stripped = _pages(page_text).select("doc_id", "page_no", F.transform(X.lines_of(F.col("text")), X.strip).alias("_l"))
    one, two = (lambda i: F.nullif(F.get("_l", i + 1), F.lit(""))), (lambda i: F.nullif(F.get("_l", i + 2), F.lit("")))
    ahead = F.transform("_l", lambda s, i: F.struct((i + 1).alias("line_no"), s.alias("s"), F.coalesce(one(i), two(i)).alias("after")))
    kept = F.filter(ahead, lambda x: ((x["s"] != "") & (F.length(x["s"]) <= 30)) | x["s"].rlike(P.SECTION_HEAD))
    # A page with other lines only still is a page without contents.
    lines = stripped.where(F.size("_l") > 0).select("doc_id", "page_no", F.explode_outer(kept).alias("_x"))
    return lines.select("doc_id", "page_no", F.coalesce("_x.line_no", F.lit(0)).alias("line_no"), F.coalesce("_x.s", F.lit("")).alias("s"), "_x.after")


def page_counts(page_text: DataFrame) -> DataFrame:
    return page_text.groupBy("doc_id").agg(F.max("page_no").alias("n_pages"))


def _first_prefix(name: str, terms: list[str], values: list | None = None) -> Column:
    """The first term, in order, that the column begins with (or what stands for it); one expression, since a call for each part would take the
    driver longer than the search takes the executors."""
    values = [f"'{t}'" for t in terms] if values is None else values
    return F.expr("CASE " + " ".join(f"WHEN startswith({name}, '{t}') THEN {v}" for t, v in zip(terms, values, strict=True)) + " END")


def line_facts(lines: DataFrame) -> DataFrame:
    """The lines (of ``telling_lines``) with what the searches ask of each: eligible, its section numeral, and the titles it begins with."""
    s = F.col("s")
    bare = X.strip(X.without_section_prefix(s))
    citing = "[" + P.CITING + "]"
    head = F.nullif(F.regexp_extract(s, P.SECTION_HEAD, 1), F.lit(""))

    def order(terms: list[str]) -> Column:
        n = list(range(len(terms)))
        return F.least(_first_prefix("bare", terms, n), _first_prefix("s", terms, n))

    return lines.withColumn("bare", bare).select(
        "*",
        ((s != "") & (F.length(s) <= 30) & ~s.rlike(citing)).alias("eligible"),
        head.alias("head"),
        s.rlike(P.SECTION_HEAD_LINE).alias("head_line"),
        order(P.CHAIR_TERMS).alias("chair"),
        order(P.MDA_CANON).alias("canon"),
        order(P.MDA_FALLBACK).alias("fallback"),
    )


def contents_pages(facts: DataFrame) -> DataFrame:
    """``doc_id, page_no, n_numerals, n_listed, n_titles, n_figures, is_contents`` of every page with lines.

    A page lists contents if it has two section numerals, or two titles each followed by a page figure within two lines, or four titles in
    short lines (three, with three lines of figures). Titles that nest count by the longest.
    """
    s, after = F.col("s"), F.col("after")
    by_length = sorted(P.ALL_TITLES, key=lambda t: (-len(t), t))
    listed = F.when(F.col("eligible") & F.col("head").isNull() & F.coalesce(after.rlike(P.PAGE_FIGURE), F.lit(False)), _first_prefix("s", by_length))
    short = (s != "") & (F.length(s) <= 25)
    # One bit a title, so a page's titles are one number.
    titles = F.expr(" | ".join(f"IF(contains(s, '{t}'), {1 << i}L, 0L)" for i, t in enumerate(P.ALL_TITLES)))
    rows = facts.select(
        "doc_id",
        "page_no",
        F.when((F.length(s) <= 30) & ~s.rlike(r"\.{3}"), F.col("head")).alias("numeral"),
        listed.alias("listed"),
        F.when(short, titles).otherwise(F.lit(0).cast("long")).alias("titles"),
        s.rlike(P.PAGE_FIGURE).alias("figure"),
    )
    page = rows.groupBy("doc_id", "page_no").agg(
        F.count_distinct("numeral").alias("n_numerals"),
        F.count_distinct("listed").alias("n_listed"),
        F.bit_count(F.bit_or("titles")).alias("n_titles"),
        F.count_if("figure").alias("n_figures"),
    )
    c = F.col
    is_contents = (c("n_numerals") >= 2) | (c("n_listed") >= 2) | (c("n_titles") >= 4) | ((c("n_titles") >= 3) & (c("n_figures") >= 3))
    return page.withColumn("is_contents", is_contents)


def _at(kind: str) -> Column:
    return F.struct("page_no", "line_no", F.col(kind).alias("ord"))


def section_starts(facts: DataFrame, contents: DataFrame) -> DataFrame:
    """Eligible title lines outside contents pages: ``doc_id, page_no, line_no, chair, canon, fallback, own_num``.

    ``own_num`` is the number in the line, else that of the page's first section head (null for numerals above ten).
    """
    hits = facts.where(F.col("eligible") & (F.col("chair").isNotNull() | F.col("canon").isNotNull() | F.col("fallback").isNotNull()))
    hits = hits.join(contents.where(~F.col("is_contents")).select("doc_id", "page_no"), ["doc_id", "page_no"])
    first_head = facts.where(F.col("head").isNotNull()).groupBy("doc_id", "page_no").agg(F.min_by("head", "line_no").alias("page_head"))
    hits = hits.join(first_head, ["doc_id", "page_no"], "left")
    own = F.coalesce(X.numeral(F.col("head")), X.numeral(F.col("page_head")))
    return hits.select("doc_id", "page_no", "line_no", "chair", "canon", "fallback", own.alias("own_num"))


def _named(terms: list[str], ord_col: Column) -> Column:
    return F.element_at(F.array(*[F.lit(t) for t in terms]), (ord_col + 1).cast("int"))


def _first_hit(hits: DataFrame, kind: str, terms: list[str], where: Column) -> DataFrame:
    """``doc_id, page, term, num``: the first hit of a list by page, line and order of terms."""
    found = hits.where(F.col(kind).isNotNull() & where)
    one = found.groupBy("doc_id").agg(F.min_by(F.struct("page_no", F.col(kind).alias("ord"), "own_num"), _at(kind)).alias("h"))
    return one.select("doc_id", F.col("h.page_no").alias("page"), _named(terms, F.col("h.ord")).alias("term"), F.col("h.own_num").alias("num"))


def stop_tokens(facts: DataFrame, section: DataFrame) -> DataFrame:
    """``doc_id, page_no, token`` (distinct): the stop tokens of each page, seen from a section (``doc_id, page, term, num``).

    A line that opens a section of another number is that token alone; else it may begin with one section name and any top-level titles, none
    of them the section's own.
    """
    s = F.col("s")
    lines = facts.where("eligible").join(section.select("doc_id", "term", "num"), "doc_id")
    number = X.numeral(F.col("head"))
    numbered = F.col("head_line") & ~number.eqNullSafe(F.col("num"))
    name = F.when((F.col("bare") != "") & (F.col("bare") != F.col("term")), F.concat(F.lit("A:"), _first_prefix("bare", P.SECTION_NAMES)))
    major = [F.expr(f"CASE WHEN term <> '{t}' AND startswith(s, '{t}') AND length(s) <= {len(t) + 3} THEN 'H:{t}' END") for t in P.MAJOR_TITLES]
    tokens = F.when(numbered, F.array(F.concat(F.lit("SEC"), F.coalesce(number.cast("string"), F.lit("None"))))).otherwise(F.array_compact(F.array(name, *major)))
    return lines.select("doc_id", "page_no", F.explode(tokens).alias("token")).distinct()


def section_ends(facts: DataFrame, contents: DataFrame, counts: DataFrame, section: DataFrame) -> DataFrame:
    """``section`` with ``end``: the first later page with a token that two earlier pages outside contents don't have, else the last page."""
    tokens = stop_tokens(facts, section)
    plain = contents.where(~F.col("is_contents")).select("doc_id", "page_no")
    before = tokens.join(section.select("doc_id", "page"), "doc_id").where("page_no < page").join(plain, ["doc_id", "page_no"], "left_semi")
    usual = before.groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("n")).where("n >= 2").select("doc_id", "token")
    later = tokens.join(section.select("doc_id", "page"), "doc_id").where("page_no > page").join(usual, ["doc_id", "token"], "left_anti")
    stop = later.groupBy("doc_id").agg(F.min("page_no").alias("stop"))
    return section.join(stop, "doc_id", "left").join(counts, "doc_id").select("doc_id", "page", "term", "num", F.coalesce("stop", "n_pages").alias("end"))


def section_ranges(page_text: DataFrame) -> DataFrame:
    """``doc_id, chair_start, chair_end, chair_term, chair_num, mda_start, mda_end, mda_term, mda_num`` of every report with pages.

    A section that isn't found is null throughout. Where the second would begin before the first ends it is searched again after that.
    Reports without text, repeated rows, null pages and an empty table give the defined results of ``page_lines``.
    """
    # The telling lines are few; they are written once, and so is the result of each search that the next one needs.
    facts = cut(line_facts(telling_lines(page_text)).withColumn("s", F.substring("s", 1, 31)))
    contents = contents_pages(facts)
    counts = page_counts(page_text)
    hits = cut(section_starts(facts, contents))
    chair = cut(section_ends(facts, contents, counts, _first_hit(hits, "chair", P.CHAIR_TERMS, F.col("page_no") <= CHAIR_LIMIT)))
    bound = chair.select("doc_id", F.col("end").alias("chair_end"))

    def either(rows: DataFrame, tag: str) -> DataFrame:
        canon = _first_hit(rows, "canon", P.MDA_CANON, F.lit(True)).select("doc_id", F.struct("page", "term", "num").alias(f"{tag}c"))
        other = _first_hit(rows, "fallback", P.MDA_FALLBACK, F.lit(True)).select("doc_id", F.struct("page", "term", "num").alias(f"{tag}f"))
        return canon.join(other, "doc_id", "full").select("doc_id", F.coalesce(f"{tag}c", f"{tag}f").alias(tag))

    first = either(hits, "a")
    again = either(hits.join(bound, "doc_id").where("page_no > chair_end"), "b")
    both = first.join(bound, "doc_id", "left").join(again, "doc_id", "left")
    overlaps = F.col("chair_end").isNotNull() & (F.col("a.page") < F.col("chair_end"))
    mda = both.select("doc_id", F.when(overlaps, F.col("b")).otherwise(F.col("a")).alias("h")).where("h is not null").select("doc_id", "h.page", "h.term", "h.num")
    mda = section_ends(facts, contents, counts, mda)

    def named(df: DataFrame, tag: str) -> DataFrame:
        return df.select("doc_id", *[F.col(c).alias(f"{tag}_{n}") for c, n in (("page", "start"), ("end", "end"), ("term", "term"), ("num", "num"))])

    return counts.select("doc_id").join(named(chair, "chair"), "doc_id", "left").join(named(mda, "mda"), "doc_id", "left")


def range_label(start: Column, end: Column, term: Column) -> Column:
    return F.when(start.isNull(), F.lit("未找到")).otherwise(F.concat(F.lit("p"), start, F.lit("-"), end, F.lit("["), term, F.lit("]")))


def dry_run(reports: DataFrame, ranges: DataFrame) -> DataFrame:
    """``doc_id, company, year, label``: one line per report with its two ranges."""
    own = reports.select("doc_id", "company", "year").distinct()
    label = F.concat(
        F.col("company"), F.lit(" "), F.col("year"), F.lit(": 董事长="), range_label(F.col("chair_start"), F.col("chair_end"), F.col("chair_term")),
        F.lit(" | MD&A="), range_label(F.col("mda_start"), F.col("mda_end"), F.col("mda_term")),
    )
    return own.join(ranges, "doc_id", "left").select("doc_id", "company", "year", label.alias("label"))
