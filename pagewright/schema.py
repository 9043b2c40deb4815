"""Declared schemas of the engine's tables; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

REPORTS = "doc_id long, company string, path string, file_name string, year int"
PAGE_TEXT = "doc_id long, page_no int, text string"
PAGE_GEOM = "doc_id long, page_no int, width double, height double"
WORD = "doc_id long, company string, page_no int, word_no int, text string, x0 double, x1 double, top double, bottom double"
DOC_TABLE = "doc_id long, page_no int, table_no int, x0 double, top double, x1 double, bottom double, rows array<array<string>>"
MD_FILE = "company string, file_name string, location string, content string"
QUARANTINE = "path string, stage string, error string"


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)
