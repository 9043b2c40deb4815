"""From visual lines to paragraphs, and from paragraphs of columns and pages to running text.

Every sequential step is a window: islands between places where a paragraph starts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import patterns as P
from ..functions import text as X

INDENT = 12.0
LEAST_RUN = 4
_BLOCK = ["doc_id", "page_no", "col_no"]


def body_lines(lines: DataFrame, drop_english: bool = True) -> DataFrame:
    """The stripped lines without page furniture, garbled and symbol lines and, with ``drop_english``, English lines."""
    t = X.strip(F.col("t"))
    kept = lines.withColumn("t", t).where((F.col("t") != "") & ~X.is_furniture(F.col("t")) & ~X.is_garbled(F.col("t")) & ~X.is_symbol_line(F.col("t")))
    return kept.where(~X.is_english(F.col("t"))) if drop_english else kept


def measured(body: DataFrame) -> DataFrame:
    """The lines of blocks with ``margin`` (the commonest left edge, rounded half to even, the first seen on ties), ``gap`` (the step from the line
    before), ``med`` (the upper median of the block's steps, 1 without any) and ``thr`` (the step that parts paragraphs).

    All by windows over the block, which share one partitioning; the median is found by rank, so no line carries its block's gaps.
    """
    block = Window.partitionBy(*_BLOCK)
    order = block.orderBy("k")
    seen = Window.partitionBy(*_BLOCK, "x")
    body = body.withColumn("gap", F.col("k") - F.lag("k").over(order)).withColumn("x", F.bround("x0").cast("int"))
    body = body.withColumn("_n", F.count(F.lit(1)).over(seen)).withColumn("_k", F.min("k").over(seen))
    body = body.withColumn("margin", F.max_by("x", F.struct("_n", -F.col("_k"))).over(block)).withColumn("_m", F.floor(F.count("gap").over(block) / 2) + 1)
    body = body.withColumn("_r", F.row_number().over(block.orderBy(F.asc_nulls_last("gap"))))
    body = body.withColumn("med", F.coalesce(F.max(F.when(F.col("_r") == F.col("_m"), F.col("gap"))).over(block), F.lit(1)))
    return body.withColumn("thr", F.greatest(F.col("med") + 3.0, F.col("med") * 1.5, F.lit(4.0))).drop("x", "_n", "_k", "_r", "_m")


def margins(lines: DataFrame) -> DataFrame:
    """``doc_id, page_no, col_no, margin`` of each block, as ``measured``."""
    return measured(lines).select(*_BLOCK, "margin").distinct()


def gaps(lines: DataFrame) -> DataFrame:
    """``doc_id, page_no, col_no, med, thr`` of each block, as ``measured``."""
    return measured(lines).select(*_BLOCK, "med", "thr").distinct()


def paragraph_starts(body: DataFrame) -> DataFrame:
    """The lines of blocks (``k, t, x0``) with ``lvl`` and the number of their paragraph."""
    order = Window.partitionBy(*_BLOCK).orderBy("k")
    body = measured(body.withColumn("lvl", X.heading_level(F.col("t"))))
    head = F.col("lvl") > 0
    start = head | F.lag(head).over(order) | (F.col("x0") - F.col("margin") >= INDENT) | (F.col("gap") >= F.col("thr"))
    start = F.when(F.lag("k").over(order).isNull(), True).otherwise(F.coalesce(start, F.lit(False)))
    body = body.withColumn("_start", start.cast("int")).withColumn("para_no", F.sum("_start").over(order))
    return body.select(*_BLOCK, "k", "t", "x0", "lvl", "para_no")


def paragraphs(lines: DataFrame, drop_english: bool = True) -> DataFrame:
    """``doc_id, page_no, col_no, para_no, lvl, t``: paragraphs of each block (``lvl`` 0), and its headings (1 or 2).

    A line opens a paragraph if it is indented by 12 points, follows a wide gap, or is or follows a heading. Paragraphs that turn out English
    or garbled once joined are dropped, as are runs of four single characters.
    """
    body = paragraph_starts(body_lines(lines, drop_english))
    paras = body.groupBy(*_BLOCK, "para_no").agg(F.max("lvl").alias("lvl"), F.sort_array(F.collect_list(F.struct("k", "t"))).alias("_l"))
    paras = paras.select(*_BLOCK, "para_no", "lvl", F.array_join(F.col("_l.t"), "").alias("t"))
    if not drop_english:
        return paras
    return without_letter_runs(paras.where((F.col("lvl") > 0) | ~(X.is_english(F.col("t")) | X.is_garbled(F.col("t")))))


def without_letter_runs(paras: DataFrame) -> DataFrame:
    """The paragraphs without runs of four or more single ideographs or letters in a row of a block (a logo read letter by letter)."""
    order = Window.partitionBy(*_BLOCK).orderBy("para_no")
    single = (F.col("lvl") == 0) & X.strip(F.col("t")).rlike(f"^[{P.HAN}A-Za-z]$")
    p = paras.withColumn("_one", single).withColumn("_run", F.sum((~F.col("_one")).cast("int")).over(order))
    n = F.sum(F.col("_one").cast("int")).over(Window.partitionBy(*_BLOCK, "_run"))
    return p.withColumn("_n", n).where(~(F.col("_one") & (F.col("_n") >= LEAST_RUN))).drop("_one", "_run", "_n")


def section_items(paras: DataFrame, tables: DataFrame, ranges: DataFrame) -> DataFrame:
    """``doc_id, section, kind, lvl, t, page_no, col_no, no``: paragraphs (``p``) and tables (``t``) of each section.

    ``ranges`` has ``doc_id, section, start, end`` (closed page ranges). On a page tables follow its text.
    """
    p = paras.select("doc_id", "page_no", F.lit("p").alias("kind"), "lvl", X.strip(F.col("t")).alias("t"), "col_no", F.col("para_no").cast("int").alias("no"))
    t = tables.select("doc_id", "page_no", F.lit("t").alias("kind"), F.lit(0).alias("lvl"), F.col("md").alias("t"), F.lit(-1).alias("col_no"), F.col("table_no").alias("no"))
    items = p.where("t <> ''").unionByName(t)
    r = ranges.select("doc_id", "section", "start", "end")
    return items.join(r, "doc_id").where(F.col("page_no").between(F.greatest(F.lit(1), F.col("start")), F.col("end"))).drop("start", "end")


def reading_order() -> list[Column]:
    return [F.col("page_no"), (F.col("kind") == "t").cast("int"), F.col("col_no"), F.col("no")]


def merged_items(items: DataFrame) -> DataFrame:
    """``doc_id, section, seq, kind, lvl, t``: body paragraphs that a column or page end cut are joined again.

    A paragraph goes on from the item before it if both are body text of different columns or pages, the one before doesn't end a sentence and
    this one doesn't begin like a heading.
    """
    order = Window.partitionBy("doc_id", "section").orderBy(*reading_order())
    body = (F.col("kind") == "p") & (F.col("lvl") == 0)
    other_block = (F.lag("page_no").over(order) != F.col("page_no")) | (F.lag("col_no").over(order) != F.col("col_no"))
    goes_on = body & F.lag(body).over(order) & other_block & ~F.lag("t").over(order).rlike(P.SENTENCE_END) & ~F.col("t").rlike(P.HEAD_START)
    i = items.withColumn("_start", (~F.coalesce(goes_on, F.lit(False))).cast("int")).withColumn("_pos", F.row_number().over(order))
    i = i.withColumn("seq", F.sum("_start").over(Window.partitionBy("doc_id", "section").orderBy("_pos")).cast("int"))
    merged = i.groupBy("doc_id", "section", "seq").agg(F.first("kind").alias("kind"), F.first("lvl").alias("lvl"), F.sort_array(F.collect_list(F.struct("_pos", "t"))).alias("_t"))
    return merged.select("doc_id", "section", "seq", "kind", "lvl", F.array_join(F.col("_t.t"), "").alias("t"))
