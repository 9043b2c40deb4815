"""From positioned words to visual lines: two-column pages, reading columns and line bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import patterns as P
from ..session import cut
from .tables import one_size

LEAST_WORDS = 8
MOST_CROSSING = 2
HAN_SHARE = 0.3


def clean_words(words: DataFrame) -> DataFrame:
    """Distinct words with text. Words drawn twice are one; null or empty text and words without a place are dropped. Equal words stand on one
    page, so the one shuffle by page that all later steps share also brings them together."""
    w = words.select("doc_id", "page_no", "word_no", "text", "x0", "x1", "top", "bottom").where((F.length("text") > 0) & F.col("x0").isNotNull() & F.col("top").isNotNull())
    return w.repartition("doc_id", "page_no").distinct()


def column_cuts(words: DataFrame, geometry: DataFrame) -> DataFrame:
    """``doc_id, page_no, cut, spans``: the gap between two columns, of the pages that have one.

    Candidates are every second point between 28 % and 72 % of the width with eight words on either side; the one that the fewest words
    cross wins, then the most central, then the leftmost, and is accepted if at most two words cross it. Each word adds to running sums
    over the candidates, so the work is in proportion to words plus candidates.
    """
    size = one_size(geometry).select("doc_id", "page_no", "width")
    lo, hi = F.floor(F.col("width") * 0.28).cast("int"), F.floor(F.col("width") * 0.72).cast("int")
    w = words.join(size, ["doc_id", "page_no"]).select("doc_id", "page_no", "width", "x0", "x1", lo.alias("lo"), F.floor((hi - lo) / 2).cast("int").alias("last"))

    def clipped(c: Column) -> Column:
        return F.greatest(F.lit(0), F.least(F.col("last") + 1, c.cast("int")))

    from_left = clipped(F.ceil((F.col("x1") - F.col("lo")) / 2))  # first candidate with the word on its left
    past_right = clipped(F.floor((F.col("x0") - F.col("lo")) / 2) + 1)  # first candidate without the word on its right

    def step(at: Column, left: int, right: int, span: int) -> Column:
        return F.struct(at.alias("i"), F.lit(left).alias("l"), F.lit(right).alias("r"), F.lit(span).alias("s"))

    crossing = past_right < from_left
    steps = F.array(
        step(from_left, 1, 0, 0), step(F.lit(0), 0, 1, 0), step(past_right, 0, -1, 0),
        step(F.when(crossing, past_right).otherwise(F.col("last") + 1), 0, 0, 1), step(F.when(crossing, from_left).otherwise(F.col("last") + 1), 0, 0, -1),
    )
    sums = w.select("doc_id", "page_no", "width", "lo", "last", F.explode(steps).alias("e")).select("doc_id", "page_no", "width", "lo", "last", "e.*")
    sums = sums.where("i <= last").groupBy("doc_id", "page_no", "width", "lo", "last", "i").agg(F.sum("l").alias("l"), F.sum("r").alias("r"), F.sum("s").alias("s"))
    # Between two places where a sum changes, the most central candidate is the best.
    run = Window.partitionBy("doc_id", "page_no").orderBy("i")
    runs = sums.select(
        "doc_id", "page_no", "width", "lo", "i",
        (F.coalesce(F.lead("i").over(run), F.col("last") + 1) - 1).alias("j"),
        F.sum("l").over(run).alias("left"), F.sum("r").over(run).alias("right"), F.sum("s").over(run).alias("spans"),
    )
    middle = (F.col("width") / 2 - F.col("lo")) / 2

    def candidate(k: Column) -> Column:
        i = F.greatest(F.col("i"), F.least(F.col("j"), k.cast("int")))
        c = F.col("lo") + 2 * i
        return F.struct(F.col("spans").alias("spans"), F.abs(c - F.col("width") / 2).alias("far"), c.alias("cut"))

    good = runs.where((F.col("left") >= LEAST_WORDS) & (F.col("right") >= LEAST_WORDS))
    best = good.groupBy("doc_id", "page_no").agg(F.min(F.least(candidate(F.floor(middle)), candidate(F.ceil(middle)))).alias("b"))
    return best.select("doc_id", "page_no", F.col("b.cut").alias("cut"), F.col("b.spans").cast("int").alias("spans")).where(F.col("spans") <= MOST_CROSSING)


def column_choice(words: DataFrame, cuts: DataFrame) -> DataFrame:
    """``cuts`` with ``left_share, right_share, keep`` (``both``, ``left`` or ``right``): which columns hold ideographs."""
    text = F.regexp_replace("text", f"[{P.SPACE}]", "")
    side = F.when(F.col("x1") <= F.col("cut"), "l").when(F.col("x0") >= F.col("cut"), "r")
    sums = words.join(cuts, ["doc_id", "page_no"]).groupBy("doc_id", "page_no", side.alias("side"))
    sums = sums.agg(F.sum(F.regexp_count(F.col("text"), F.lit(f"[{P.HAN}]"))).alias("h"), F.sum(F.length(text)).alias("n"))
    share = F.col("h") / F.greatest(F.lit(1), F.col("n"))
    both = sums.groupBy("doc_id", "page_no").agg(
        F.coalesce(F.max(F.when(F.col("side") == "l", share)), F.lit(0.0)).alias("left_share"),
        F.coalesce(F.max(F.when(F.col("side") == "r", share)), F.lit(0.0)).alias("right_share"),
    )
    keep = F.when((F.col("left_share") >= HAN_SHARE) & (F.col("right_share") >= HAN_SHARE), "both").when(F.col("right_share") >= F.col("left_share"), "right").otherwise("left")
    return cuts.join(both, ["doc_id", "page_no"]).withColumn("keep", keep)


def in_columns(words: DataFrame, geometry: DataFrame, drop_english: bool = True) -> DataFrame:
    """The words that are read, with ``col_no``. Words across a cut are lost, as is a column that isn't kept; with ``drop_english`` off a page is
    one column.

    The words are asked three times (for cuts, for the choice, for the reading), so they are written once.
    """
    if not drop_english:
        return words.withColumn("col_no", F.lit(0))
    words = cut(words)
    choice = column_choice(words, column_cuts(words, geometry)).select("doc_id", "page_no", "cut", "keep")
    w = words.join(choice, ["doc_id", "page_no"], "left")
    left, right = F.col("x1") <= F.col("cut"), F.col("x0") >= F.col("cut")
    col = (
        F.when(F.col("cut").isNull(), 0)
        .when((F.col("keep") == "both") & left, 0)
        .when((F.col("keep") == "both") & right, 1)
        .when((F.col("keep") == "left") & left, 0)
        .when((F.col("keep") == "right") & right, 0)
    )
    return w.withColumn("col_no", col).where("col_no is not null").drop("cut", "keep")


def visual_lines(words: DataFrame) -> DataFrame:
    """``doc_id, page_no, col_no, k, t, x0``: words in bins of three points, joined from left to right.

    A space stands only between two words that meet with ASCII letters or digits. Ties in place keep the order of ``word_no``.
    """
    k = F.bround(F.col("top") / 3).cast("int")
    row = Window.partitionBy("doc_id", "page_no", "col_no", "k").orderBy("x0", "word_no")
    w = words.withColumn("k", k)
    gap = F.lag("text").over(row).rlike("[0-9A-Za-z]$") & F.col("text").rlike("^[0-9A-Za-z]")
    piece = F.concat(F.when(gap, F.lit(" ")).otherwise(F.lit("")), F.col("text"))
    w = w.withColumn("piece", piece)
    lines = w.groupBy("doc_id", "page_no", "col_no", "k").agg(F.sort_array(F.collect_list(F.struct("x0", "word_no", "piece"))).alias("_w"))
    return lines.select("doc_id", "page_no", "col_no", "k", F.array_join(F.col("_w.piece"), "").alias("t"), F.element_at("_w", 1)["x0"].alias("x0"))
