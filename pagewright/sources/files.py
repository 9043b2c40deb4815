"""Reports, their pages and finished Markdown, on any file system that Spark reads.

What turns the bytes of a report into pages is a reader, which can be any object (see ``Reader``). The one for PDF needs third-party libraries;
where they are missing it says so, and the engine starts from page, word and table tables, or from another reader.
"""

from __future__ import annotations

import importlib.util
from collections.abc import Iterable, Iterator
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X

PDF_FOLDER = "年报PDF"
MD_FOLDER = "董事长致辞与MD&A"
MD_SUFFIX = "董事长致辞与MD&A.md"

_PAGE = (
    "path string, page_no int, text string, width double, height double, words array<struct<text:string,x0:double,x1:double,top:double,bottom:double>>, "
    "tables array<struct<x0:double,top:double,x1:double,bottom:double,rows:array<array<string>>>>, stage string, error string"
)
_COLUMNS = ["path", "page_no", "text", "width", "height", "words", "tables", "stage", "error"]


class Reader(Protocol):
    """Opens a report; must be picklable. Each method may raise: an error ends nothing but the part it concerns."""

    def pages(self, data: bytes) -> Iterable[Any]:
        """The pages in order, whatever they are."""

    def text(self, page: Any) -> str:
        """The text of a page as lines."""

    def size(self, page: Any) -> tuple[float, float]:
        """Width and height in points."""

    def words(self, page: Any) -> list[tuple[str, float, float, float, float]]:
        """``text, x0, x1, top, bottom`` of each word."""

    def tables(self, page: Any) -> list[tuple[float, float, float, float, list[list[str | None]]]]:
        """``x0, top, x1, bottom`` and the rows of each table found."""


class PdfReader:
    """Text by one library, words and tables by another, as they see the page best."""

    def __init__(self) -> None:
        if any(importlib.util.find_spec(m) is None for m in ("pymupdf", "pdfplumber")):
            raise RuntimeError("reading PDF needs the libraries pymupdf and pdfplumber; start from the page_text, word and doc_table tables, or bring a reader of your own")

    def pages(self, data: bytes) -> Iterable[Any]:
        import io

        import pdfplumber
        import pymupdf

        with pymupdf.open(stream=data, filetype="pdf") as doc, pdfplumber.open(io.BytesIO(data)) as laid:
            yield from zip(doc, laid.pages, strict=True)

    def text(self, page: Any) -> str:
        return page[0].get_text("text")

    def size(self, page: Any) -> tuple[float, float]:
        return float(page[1].width), float(page[1].height)

    def words(self, page: Any) -> list[tuple[str, float, float, float, float]]:
        return [(w["text"], w["x0"], w["x1"], w["top"], w["bottom"]) for w in page[1].extract_words(keep_blank_chars=False) or []]

    def tables(self, page: Any) -> list[tuple[float, float, float, float, list[list[str | None]]]]:
        return [(*t.bbox, t.extract()) for t in page[1].find_tables()]


def _segment(path: Column, back: int) -> Column:
    return F.element_at(F.split(path, "/"), -back)


def report_files(spark: SparkSession, base: str, company: str | None = None, content: bool = False) -> DataFrame:
    """``doc_id, company, path, file_name, year`` (and ``content``, the bytes) of ``<base>/<company>/年报PDF/*.pdf``. A base without reports gives no
    rows. ``doc_id`` is a hash of the path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.pdf").load(base)
    files = files.where(_segment(F.col("path"), 2) == PDF_FOLDER)
    rows = files.select(
        F.xxhash64("path").alias("doc_id"), _segment(F.col("path"), 3).alias("company"), "path", _segment(F.col("path"), 1).alias("file_name"), *(["content"] if content else [])
    )
    rows = rows.withColumn("year", X.report_year(F.col("file_name")))
    return rows.where(F.col("company") == company) if company is not None else rows


def read_pages(files: DataFrame, reader: Reader) -> DataFrame:
    """``path, page_no, text, width, height, words, tables, stage, error``: the pages of each file of ``path, content``.

    What fails gives a row with its ``stage`` (``open``, ``text``, ``words`` or ``tables``) and ``error``. A file that can't be opened, or not to its
    end, keeps the pages before that; a page whose text or words fail is left out; a page whose tables fail has none. (Files are whole values, so
    keep ``spark.sql.execution.arrow.maxRecordsPerBatch`` small where they are large.)
    """

    def one(path: str, data: bytes) -> Iterator[tuple]:
        def failed(stage: str, page_no: int | None, e: Exception) -> tuple:
            return (path, page_no, None, None, None, None, None, stage, (str(e) or type(e).__name__)[:500])

        page_no = 0
        try:
            for page in reader.pages(data):
                page_no += 1
                stage, tables = "text", []
                try:
                    text, (width, height) = reader.text(page), reader.size(page)
                    stage = "words"
                    words = [dict(zip(("text", "x0", "x1", "top", "bottom"), w, strict=True)) for w in reader.words(page)]
                except Exception as e:
                    yield failed(stage, page_no, e)
                    continue
                try:
                    tables = [dict(zip(("x0", "top", "x1", "bottom", "rows"), t, strict=True)) for t in reader.tables(page)]
                except Exception as e:
                    yield failed("tables", page_no, e)
                yield (path, page_no, text, width, height, words, tables, None, None)
        except Exception as e:  # one broken file must not end the job
            yield failed("open", page_no or None, e)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, data in zip(b["path"], b["content"], strict=True):
                yield pd.DataFrame(list(one(path, bytes(data))), columns=_COLUMNS).astype({"page_no": "Int32"})

    return files.select("path", "content").mapInPandas(read, _PAGE)


def quarantined(pages: DataFrame) -> DataFrame:
    """``path, page_no, stage, error`` of what failed; what remains goes on without it."""
    return pages.where(F.col("error").isNotNull()).select("path", "page_no", "stage", "error")


def page_tables(pages: DataFrame, files: DataFrame) -> dict[str, DataFrame]:
    """The engine's tables ``page_text``, ``page_geom``, ``word`` and ``doc_table`` from pages that were read (write them once before that)."""
    p = pages.where(F.col("error").isNull()).join(files.select("path", "doc_id", "company"), "path")
    word, tab = p.select("doc_id", "company", "page_no", F.posexplode("words").alias("_i", "w")), p.select("doc_id", "page_no", F.posexplode("tables").alias("_i", "t"))
    number = (F.col("_i") + 1).cast("int")
    return {
        "page_text": p.select("doc_id", "page_no", "text"),
        "page_geom": p.select("doc_id", "page_no", "width", "height"),
        "word": word.select("doc_id", "company", "page_no", number.alias("word_no"), "w.*"),
        "doc_table": tab.select("doc_id", "page_no", number.alias("table_no"), "t.*"),
    }


def markdown_files(spark: SparkSession, base: str) -> DataFrame:
    """``company, file_name, location, content``: finished documents of the companies ``<number>_<name>``, in their own folder (``sub``) or beside
    it (``root``)."""
    path = F.col("_metadata.file_path")
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{MD_SUFFIX}").text(base, wholetext=True)
    # Paths of this source are escaped as in a URL.
    files = files.select(F.url_decode(F.regexp_replace(path, r"\+", "%2B")).alias("path"), F.col("value").alias("content"))
    sub = _segment(F.col("path"), 2) == MD_FOLDER
    company = F.when(sub, _segment(F.col("path"), 3)).otherwise(_segment(F.col("path"), 2))
    rows = files.select(company.alias("company"), _segment(F.col("path"), 1).alias("file_name"), F.when(sub, "sub").otherwise("root").alias("location"), "content")
    return rows.where(F.col("company").rlike("^[0-9]+_"))
