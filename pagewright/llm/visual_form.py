"""Visually identical text with different characters.

Every text is brought to one form by compatibility normalisation (composed), removal of default-ignorable characters, mapped white
space, look-alike letters and full case folding, vectorised over the distinct values of each Arrow batch. Each text is normalised once; only
digests travel from there on. The folded form brings candidates together; since case is a visible difference, the form before folding
tells which of them read the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .textform import digest, fold, per_distinct, visual_form


def _stacked(df: DataFrame, id_col: str, fields: list[str]) -> DataFrame:
    """One row per non-empty text: ``doc_id, field, text``. Other columns, also with clashing names, are dropped here."""
    parts = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in fields])
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.explode(parts).alias("_p")).select("doc_id", "_p.field", "_p.text")
    return rows.where(F.col("doc_id").isNotNull() & (F.length("text") > 0))


def visual_forms(df: DataFrame, fields: list[str], id_col: str = "doc_id") -> DataFrame:
    """``doc_id, field, form, folded``: each non-empty text in its one form, and that form with case folded.

    Null and empty texts give no row; a text of invisible characters only gives an empty form. Repeated input rows repeat. An empty table
    gives an empty result.
    """

    def forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            form = per_distinct(b.column("text"), visual_form, pa.large_string())
            folded = per_distinct(form, fold, pa.large_string())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("field"), form.cast(pa.string()), folded.cast(pa.string())], ["doc_id", "field", "form", "folded"]
            )

    return _stacked(df, id_col, fields).mapInArrow(forms, "doc_id long, field string, form string, folded string")


def visual_classes(df: DataFrame, fields: list[str], id_col: str = "doc_id") -> DataFrame:
    """``doc_id, field, fold_id, class_id, text_id``: one distinct row per document and text, all as 128-bit digests. Texts that read the same but
    for case share ``fold_id``, texts that read the same ``class_id``, equal strings ``text_id``. Written once to the shared folder."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def key(text: str) -> bytes:
            form = visual_form(text)
            return digest(fold(form)) + digest(form) + digest(text)

        for b in batches:
            coded = per_distinct(b.column("text"), key, pa.binary(48))
            parts = [pc.binary_slice(coded.cast(pa.binary()), i, i + 16) for i in (0, 16, 32)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("field"), *parts], ["doc_id", "field", "fold_id", "class_id", "text_id"])

    return cut(_stacked(df, id_col, fields).mapInArrow(keys, "doc_id long, field string, fold_id binary, class_id binary, text_id binary").distinct())


def _mixed(classes: DataFrame) -> DataFrame:
    """``field, fold_id, class_id, n_rows`` of the classes with different strings: folded classes first, which are fewer, then those in them."""
    differ = [F.min("text_id").alias("_lo"), F.max("text_id").alias("_hi")]
    counts = classes.groupBy("field", "fold_id", "class_id").agg(*differ, F.count(F.lit(1)).alias("n_rows"))
    return counts.where("_lo <> _hi").select("field", "fold_id", "class_id", "n_rows")


def _salted(df: DataFrame, salts: int) -> DataFrame:
    return df.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))


def _salt(salts: int) -> Column:
    return F.pmod(F.xxhash64("doc_id", "text_id"), F.lit(salts))


def linked_classes(df: DataFrame, fields: list[str], id_col: str = "doc_id", salts: int = 8) -> DataFrame:
    """``visual_classes`` with ``n_links``: how many rows of its class hold another string. A class of any size is spread over ``salts`` tasks."""
    classes = visual_classes(df, fields, id_col)
    key = ["field", "fold_id", "class_id"]
    strings = classes.join(_mixed(classes).select(*key), key, "left_semi").groupBy(*key, "text_id").agg(F.count(F.lit(1)).alias("_same"))
    sizes = _mixed(classes).join(strings, key)
    links = _salted(sizes.select(*key, "text_id", (F.col("n_rows") - F.col("_same")).alias("n_links")), salts)
    out = classes.withColumn("_s", _salt(salts)).join(links, [*key, "text_id", "_s"], "left")
    return out.select("doc_id", "field", "fold_id", "class_id", "text_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def same_looking_pairs(df: DataFrame, fields: list[str], id_col: str = "doc_id", salts: int = 8) -> DataFrame:
    """``field, doc_id_a, doc_id_b`` (``doc_id_a < doc_id_b``, distinct): values of a field that read the same but are different strings.

    Classes whose texts are all equal strings (plain republications, however many) are removed before anything is paired, and only digests
    are joined, on the class key. Pairs are formed between different strings only, never between copies, and each class's rows are spread
    over ``salts`` tasks. The pairs themselves are the result asked for; ``linked_classes`` has one row a document instead.
    """
    classes = visual_classes(df, fields, id_col)
    key = ["field", "fold_id", "class_id"]
    rows = classes.join(_mixed(classes).select(*key), key, "left_semi")
    a = rows.select(*key, F.col("doc_id").alias("doc_id_a"), F.col("text_id").alias("_ta"), _salt(salts).alias("_s"))
    b = _salted(rows.select(*key, F.col("doc_id").alias("doc_id_b"), F.col("text_id").alias("_tb")), salts)
    pairs = a.join(b, [*key, "_s"]).where((F.col("doc_id_a") < F.col("doc_id_b")) & (F.col("_ta") != F.col("_tb")))
    return pairs.select("field", "doc_id_a", "doc_id_b").distinct()
