"""Detected tables: which are real, their Markdown, and the words outside them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

EDGE = 5.0
PAD = 2.0


def _width(rows: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(rows, lambda r: F.coalesce(F.size(r), F.lit(0)))), F.lit(0))


def one_size(geometry: DataFrame) -> DataFrame:
    """``doc_id, page_no, width, height``: one row a page (the greatest, if repeated rows differ)."""
    return geometry.groupBy("doc_id", "page_no").agg(F.max("width").alias("width"), F.max("height").alias("height"))


def accepted_tables(tables: DataFrame, geometry: DataFrame) -> DataFrame:
    """The distinct tables with ``n_cols, blank_share, accepted``.

    Rejected are boxes beyond the page by more than 5 points, tables without rows or of one column, and those of ten columns or more that are
    blank for 60 %. On a page without geometry the box is not tested. Null rows and cells count as blank.
    """
    rows = F.coalesce("rows", F.array().cast("array<array<string>>"))
    cells = F.flatten(F.transform(rows, lambda r: F.coalesce(r, F.array().cast("array<string>"))))
    blank = F.size(F.filter(cells, lambda c: X.strip(F.coalesce(c, F.lit(""))) == ""))
    t = tables.select("doc_id", "page_no", "table_no", "x0", "top", "x1", "bottom", rows.alias("rows")).distinct()
    t = t.join(one_size(geometry), ["doc_id", "page_no"], "left")
    beyond = (F.col("x0") < -EDGE) | (F.col("top") < -EDGE) | (F.col("x1") > F.col("width") + EDGE) | (F.col("bottom") > F.col("height") + EDGE)
    t = t.withColumn("n_cols", _width(F.col("rows"))).withColumn("_cells", F.size(cells))
    t = t.withColumn("blank_share", F.when(F.col("_cells") > 0, blank / F.col("_cells")).otherwise(0.0))
    ok = ~F.coalesce(beyond, F.lit(False)) & (F.size("rows") > 0) & (F.col("n_cols") >= 2)
    ok = ok & ~((F.col("n_cols") >= 10) & (F.col("_cells") > 0) & (F.col("blank_share") >= 0.6))
    return t.withColumn("accepted", ok).drop("_cells", "width", "height")


def with_markdown(tables: DataFrame, drop_english: bool = True) -> DataFrame:
    """The tables with ``md``, their Markdown, or null if nothing is left: rows in English only, blank rows and blank columns are dropped.

    Each step is a column of its own, used by the next ones: inlined into lambdas the steps would be worked out again for every cell.
    """
    none = F.array().cast("array<string>")
    t = tables.withColumn("_full", F.transform("rows", lambda r: F.transform(F.coalesce(r, none), lambda c: F.coalesce(c, F.lit("")))))
    t = t.withColumn("_row", F.transform("_full", lambda r: X.strip(F.array_join(r, " "))))
    keep = F.transform("_row", lambda s: (s != "") & (~X.is_english(s) if drop_english else F.lit(True)))
    t = t.withColumn("_keep", keep)
    t = t.withColumn("_full", F.filter("_full", lambda r, i: F.element_at(F.col("_keep"), i + 1)))
    t = t.withColumn("_n", _width(F.col("_full")))
    t = t.withColumn("_full", F.transform("_full", lambda r: F.transform(F.concat(r, F.array_repeat(F.lit(""), F.col("_n") - F.size(r))), lambda c: X.strip(F.translate(c, "\n|", " ／")))))
    t = t.withColumn("_cols", F.when(F.col("_n") > 0, F.filter(F.sequence(F.lit(1), F.greatest(F.lit(1), F.col("_n"))), lambda i: F.exists("_full", lambda r: F.element_at(r, i) != ""))))
    t = t.withColumn("_lines", F.transform("_full", lambda r: F.concat(F.lit("| "), F.array_join(F.transform("_cols", lambda i: F.element_at(r, i)), " | "), F.lit(" |"))))
    rule = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), F.size("_cols")), " | "), F.lit(" |"))
    md = F.array_join(F.concat(F.slice("_lines", F.lit(1), F.lit(1)), F.array(rule), F.slice("_lines", F.lit(2), F.greatest(F.lit(1), F.size("_lines")))), "\n")
    return t.withColumn("md", F.when(F.size("_full") > 0, md)).drop("_full", "_row", "_keep", "_n", "_cols", "_lines")


def rendered_tables(tables: DataFrame, geometry: DataFrame, drop_english: bool = True) -> DataFrame:
    """``doc_id, page_no, table_no, x0, top, x1, bottom, md`` of the accepted tables of which something is left."""
    ok = accepted_tables(tables, geometry).where("accepted")
    return with_markdown(ok, drop_english).select("doc_id", "page_no", "table_no", "x0", "top", "x1", "bottom", "md").where("md is not null")


def words_outside(words: DataFrame, rendered: DataFrame) -> DataFrame:
    """The words that lie in no rendered table's box (with 2 points of tolerance)."""
    w, b = words.alias("w"), rendered.select("doc_id", "page_no", "x0", "top", "x1", "bottom").alias("b")
    inside = (
        (F.col("w.doc_id") == F.col("b.doc_id")) & (F.col("w.page_no") == F.col("b.page_no"))
        & (F.col("w.x0") >= F.col("b.x0") - PAD) & (F.col("w.x1") <= F.col("b.x1") + PAD)
        & (F.col("w.top") >= F.col("b.top") - PAD) & (F.col("w.bottom") <= F.col("b.bottom") + PAD)
    )
    return w.join(b, inside, "left_anti")
