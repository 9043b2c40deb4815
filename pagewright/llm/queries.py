"""The queries of this subpackage: ``name -> (spark, sf_dir) -> DataFrame``, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import table
from . import leakage, packing, page_repair, repeated_lines, splitting, text_quality, truncation, visual_form


def _line_texts(spark: SparkSession, d: str) -> DataFrame:
    return repeated_lines.texts_of(table(spark, d, "documents"), "documents.text", "text", "source").unionByName(
        repeated_lines.texts_of(table(spark, d, "section_record"), "section_record.ctext", "ctext", "company")
    )


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return repeated_lines.repeated_lines(_line_texts(spark, d)).select("field", "doc_id", "line_no").distinct()


def p1_texts(spark: SparkSession, d: str) -> DataFrame:
    texts = _line_texts(spark, d)
    return repeated_lines.without_lines(texts, repeated_lines.repeated_lines(texts)).distinct()


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return visual_form.same_looking_pairs(table(spark, d, "section_record"), ["ctext", "mtext"])


def p2_forms(spark: SparkSession, d: str) -> DataFrame:
    return visual_form.visual_forms(table(spark, d, "section_record"), ["ctext", "mtext"]).select("doc_id", "field", "form").distinct()


def p2_classes(spark: SparkSession, d: str) -> DataFrame:
    classes = visual_form.linked_classes(table(spark, d, "section_record"), ["ctext", "mtext"])
    return classes.select("doc_id", "field", *[F.hex(c).alias(c) for c in ("fold_id", "class_id", "text_id")], "n_links")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return page_repair.noisy_words(table(spark, d, "word"), table(spark, d, "page_geom"))


def p3_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return page_repair.body_paragraphs(table(spark, d, "word"), table(spark, d, "page_geom"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return text_quality.not_prose(table(spark, d, "section_record"))


def p4_statistics(spark: SparkSession, d: str) -> DataFrame:
    """The statistics the problem names, and the kind, of every record."""
    rows = text_quality.quality_kinds(table(spark, d, "section_record"))
    return rows.select("doc_id", "n_words", "mean_word_len", "symbol_share", "line_end_share", "common_share", "kind")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return splitting.oversized_items(table(spark, d, "section_record"), table(spark, d, "split_profile"))


def p5_pieces(spark: SparkSession, d: str) -> DataFrame:
    return splitting.oversized_pieces(table(spark, d, "section_record"), table(spark, d, "split_profile"))


def p6_containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill_containers(packing.token_sizes(table(spark, d, "documents")), table(spark, d, "pack_profile"))


def p5_coverage(spark: SparkSession, d: str) -> DataFrame:
    """For each text that was cut whether its pieces cover it, fit, and share what the profile asks for."""
    records, profiles = table(spark, d, "section_record"), table(spark, d, "split_profile")
    pieces = splitting.oversized_pieces(records, profiles).join(F.broadcast(profiles.select("profile", "max_size", "overlap")), "profile")
    order = Window.partitionBy("profile", "doc_id").orderBy("piece_no")
    before = F.lag("end").over(order)
    joins = F.when(before.isNull(), F.col("start") == 0).otherwise((F.col("start") <= before) & (F.col("end") > before) & ((F.col("overlap_units") >= F.col("overlap")) | (F.col("start") == 0)))
    rows = pieces.withColumn("_joins", joins & (F.length("text") == F.col("end") - F.col("start"))).groupBy("profile", "doc_id")
    return rows.agg(F.max("end").alias("covered"), (F.max("units") <= F.max("max_size")).alias("within"), F.min("_joins").alias("joined"))


def p6_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.container_fill(p6_containers(spark, d), table(spark, d, "pack_profile"))


def p6_assigned(spark: SparkSession, d: str) -> DataFrame:
    """For each profile how many texts have a container, how many have one more often than once for each part, and how many containers are too full."""
    rows = p6_containers(spark, d).join(F.broadcast(table(spark, d, "pack_profile").groupBy("profile").agg(F.max("capacity_tokens").alias("_cap"), F.max("sep_tokens").alias("_sep"))), "profile")
    load = F.sum("n_tokens").over(Window.partitionBy("profile", "container")) + F.col("_sep") * (F.count(F.lit(1)).over(Window.partitionBy("profile", "container")) - 1)
    rows = rows.withColumn("_load", load)
    again = F.count(F.lit(1)) - F.count_distinct("doc_id", "part_no")
    return rows.groupBy("profile").agg(F.count_distinct("doc_id").alias("n_texts"), again.alias("n_again"), F.count_if((F.col("_load") > F.col("_cap")) | (F.col("_load") != F.col("fill"))).alias("n_wrong"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked_items(table(spark, d, "documents"), table(spark, d, "eval_item"))


def p7_passages(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked_passages(table(spark, d, "documents"), table(spark, d, "eval_item")).distinct()


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return truncation.truncated_texts(table(spark, d, "documents")).select("doc_id").distinct()


def p8_sources(spark: SparkSession, d: str) -> DataFrame:
    return truncation.truncation_by_source(table(spark, d, "documents"))


def p8_totals(spark: SparkSession, d: str) -> DataFrame:
    """The texts of each source, and whether its share of cut texts is that of the texts found."""
    documents = table(spark, d, "documents")
    found = truncation.truncated_texts(documents).groupBy("source").agg(F.count_distinct("doc_id").alias("_found"))
    rows = truncation.truncation_by_source(documents).join(found, "source", "left")
    agrees = (F.col("n_cut") == F.coalesce("_found", F.lit(0))) & (F.abs(F.col("cut_share") * F.col("n_texts") - F.col("n_cut")) < 1e-6)
    return rows.select("source", "n_texts", agrees.alias("agrees"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k[0] == "p" and k[1:2].isdigit()}
