"""Splitting oversized items at natural boundaries.

A text is cut by dynamic programming over its boundary positions: the sum of the penalties of the cuts (paragraph, sentence, clause, line, word,
any character) and of the imbalance of the pieces is least, no piece is over the limit, and each piece begins ``overlap`` units before the end
of the piece before.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Penalty of a cut by what it falls on.
PENALTY = {"paragraph": 0.0, "sentence": 1.0, "clause": 3.0, "line": 6.0, "word": 8.0, "character": 30.0, "end": 0.0}
BALANCE = 2.0
#: A line feed in the middle of a sentence is a broken line, not the end of a paragraph.
_PARAGRAPH = re.compile(r"(?:(?<=[。！？!?；;….：:|”’」』）)\]>])[^\S\n]*\n\s*|\n[^\S\n]*\n\s*)")
_LINE = re.compile(r"\n+")
_SENTENCE = re.compile(r"[。！？!?；;…]+[”’」』）)\"']*|\.[”’\")]*(?=\s)")
_CLAUSE = re.compile(r"[，、：:]|,(?=\D)")
_WORD = re.compile(r"\s+")
_PIECE = (
    "profile string not null, doc_id long not null, piece_no int not null, start int not null, end int not null, units int not null, "
    "overlap_units int not null, cut string not null, text string not null"
)


@dataclass(frozen=True)
class Piece:
    start: int
    end: int
    units: int
    overlap_units: int
    cut: str


def _joined(text: str, i: int) -> bool:
    """Whether a cut before ``text[i]`` would break a character: a mark, joiner or selector belongs to what precedes it."""
    c = text[i]
    if c < "̀":
        return c == "\n" and text[i - 1] == "\r"
    return unicodedata.combining(c) > 0 or c in "‍️︎" or text[i - 1] == "‍" or unicodedata.category(c) in ("Mn", "Me") or 0x1F3FB <= ord(c) <= 0x1F3FF


def _may_join(text: str) -> np.ndarray:
    """For each place between characters (and the end) whether what follows may belong to what precedes: only such places are looked at."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    plain = ((code < 0x300) & (code != 0x0A)) | ((code >= 0x3001) & (code <= 0x3029)) | ((code >= 0x3400) & (code <= 0x9FFF)) | ((code >= 0xFF00) & (code <= 0xFF60))
    after_joiner = np.concatenate([[False], code[:-1] == 0x200D])
    return np.concatenate([~plain | after_joiner, [False]])


def _offsets(text: str, wide: bool) -> np.ndarray:
    """Units before each code point, and the total."""
    if not wide:
        return np.arange(len(text) + 1)
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.concatenate([[0], np.cumsum(1 + (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF))])


def split_text(text: str, max_size: int, overlap: int = 0, unit: str = "chars") -> list[Piece]:
    """Pieces of at most ``max_size`` units (``chars`` or UTF-8 ``bytes``) that cover ``text``; offsets are code points, ends exclusive.

    A piece after the first begins at the last character boundary at least ``overlap`` units before the end of the piece before. A text
    within the limit is one piece, an empty one none. The sum is least over all positions: a cut at any character is worth more than two
    natural cuts with three uneven pieces (2 * 8 + 3 * 2), so between two natural boundaries that one piece can span there never is one, and only
    longer stretches are tried character by character. A character that alone is larger than what a piece may add is a ``ValueError``.
    """
    if not text:
        return []
    n = len(text)
    at = _offsets(text, unit == "bytes")
    total = int(at[n])
    if total <= max_size:
        return [Piece(0, n, total, 0, "end")]
    if not 0 <= overlap < max_size:
        raise ValueError("the overlap must be less than the size of a piece")

    kinds: dict[int, str] = {}
    for kind, pattern in (("word", _WORD), ("line", _LINE), ("clause", _CLAUSE), ("sentence", _SENTENCE), ("paragraph", _PARAGRAPH)):
        for m in pattern.finditer(text):
            if 0 < m.end() < n:
                kinds[m.end()] = kind
    kinds = {p: k for p, k in kinds.items() if not _joined(text, p)}
    kinds[n] = "end"

    def begin(ends: np.ndarray) -> np.ndarray:
        """Where the piece after one that ends here begins."""
        if not overlap:
            return ends
        begins = np.maximum(0, np.searchsorted(at, at[ends] - overlap, side="right") - 1)
        for j in np.flatnonzero(mark[begins]).tolist():
            i = int(begins[j])
            while i > 0 and mark[i] and _joined(text, i):
                i -= 1
            begins[j] = i
        return begins

    mark = _may_join(text)
    natural = np.array([0, *sorted(kinds)])
    far = np.flatnonzero(at[natural[1:]] - at[begin(natural[:-1])] > max_size).tolist()
    for k in far:
        kinds.update((i, "character") for i in range(int(natural[k]) + 1, int(natural[k + 1])) if not (mark[i] and _joined(text, i)))
    ends = np.array(sorted(kinds))
    e_at = at[ends]
    begins = begin(ends)
    b_at = at[begins]
    n_pieces = max(2, -(-(total - overlap) // max(1, max_size - overlap)))
    target = (total + (n_pieces - 1) * overlap) / n_pieces
    low = np.searchsorted(b_at, e_at - max_size).tolist()
    whole = (e_at - target) / target
    first_cost = np.where(e_at <= max_size, BALANCE * whole * whole, np.inf).tolist()
    penalties = [PENALTY[kinds[e]] for e in ends.tolist()]
    cost = np.full(len(ends), np.inf)
    back = [-1] * len(ends)
    for j, at_e in enumerate(e_at.tolist()):
        penalty, lo = penalties[j], low[j]
        best = penalty + first_cost[j]
        if lo < j:  # earlier cuts within reach: the piece from their begin to here fits
            d = (at_e - b_at[lo:j] - target) / target
            c = cost[lo:j] + penalty + BALANCE * d * d
            i = j - 1 - int(c[::-1].argmin())  # of equal ones the last
            if c[i - lo] < best:
                best, back[j] = c[i - lo], i
        cost[j] = best
    if cost[-1] == np.inf:
        raise ValueError("a single character is larger than a piece may be")
    chain, j = [], len(ends) - 1
    while j >= 0:
        chain.append(j)
        j = back[j]
    pieces, start, last = [], 0, None
    for j in reversed(chain):
        e = int(ends[j])
        if last is not None:
            start = int(begins[last])
        shared = int(at[ends[last]] - at[start]) if last is not None else 0
        pieces.append(Piece(start, e, int(at[e] - at[start]), shared, kinds[e]))
        last = j
    return pieces


#: ``cut`` of the one row (``piece_no`` 0, no text) of a text that can't be cut.
UNSPLITTABLE = "unsplittable"


def oversized_pieces(df: DataFrame, profiles: DataFrame, id_col: str = "doc_id", max_profiles: int = 1000) -> DataFrame:
    """``profile, doc_id, piece_no, start, end, units, overlap_units, cut, text`` of each text over a profile's limit (distinct rows).

    ``profiles`` are settings (``profile, field, unit, max_size, overlap``), read to the driver; more than ``max_profiles`` are refused.
    Null and empty texts and texts within the limit give no row; a record given twice gives its pieces once; a profile with a null setting,
    an unknown unit or a field that ``df`` lacks is left out; empty tables give an empty result. Where a profile asks for an overlap of the
    size of a piece, or one character is larger than a piece may be, the text gives one row with ``piece_no`` 0 and ``cut`` ``unsplittable``.
    """
    settings = [r for r in profiles.select("profile", "field", "unit", "max_size", "overlap").limit(max_profiles + 1).collect() if None not in tuple(r)]
    if len(settings) > max_profiles:
        raise ValueError(f"more than {max_profiles} profiles")
    size = {"chars": F.length, "bytes": F.octet_length}
    settings = sorted({tuple(r) for r in settings if r["field"] in df.columns and r["unit"] in size})
    spark = df.sparkSession
    if not settings:
        return spark.createDataFrame([], _PIECE)
    wanted = F.array(
        *[
            F.when(
                size[unit](field) > max_size,
                F.struct(F.lit(name).alias("profile"), F.col(field).alias("text"), F.lit(unit).alias("unit"), F.lit(max_size).alias("max_size"), F.lit(overlap).alias("overlap")),
            )
            for name, field, unit, max_size, overlap in settings
        ]
    )
    rows = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.explode(F.array_compact(wanted)).alias("_w")).select("doc_id", "_w.*")
    rows = rows.where(F.length("text") > 0)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                text = r["text"]
                try:
                    pieces = split_text(text, r["max_size"], r["overlap"], r["unit"])
                except ValueError:
                    out.append((r["profile"], r["doc_id"], 0, 0, len(text), 0, 0, UNSPLITTABLE, ""))
                    continue
                for no, p in enumerate(pieces, 1):
                    out.append((r["profile"], r["doc_id"], no, p.start, p.end, p.units, p.overlap_units, p.cut, text[p.start : p.end]))
            kinds = [pa.string(), pa.int64(), *[pa.int32()] * 5, pa.string(), pa.string()]
            cols = list(zip(*out, strict=True)) or [[]] * 9
            names = ["profile", "doc_id", "piece_no", "start", "end", "units", "overlap_units", "cut", "text"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    # One text is one unit of work: the few large ones are spread over all tasks, and copies meet there, before they are cut.
    return rows.repartition("profile", "doc_id").dropDuplicates().mapInArrow(cut, _PIECE)


def oversized_items(df: DataFrame, profiles: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``profile, doc_id`` of the texts that had to be cut."""
    pieces = oversized_pieces(df, profiles, id_col)
    return pieces.where((F.col("piece_no") > 1) | (F.col("cut") == UNSPLITTABLE)).select("profile", "doc_id").distinct()
