"""Evaluation texts leaking into training text.

One Aho-Corasick automaton is built over the normalised evaluation items (every run of a few letters of an item is a pattern that knows its
items and places) and each document is scanned once. Hits of one item on one diagonal form a chain; a chain may bridge a single
misrecognised character. The ends of a chain are mapped back to the original characters of item and document.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textform import composed, digest, simplified_script

_NOT_WORD = re.compile(r"[\W_]+")
_PLAIN = re.compile(r"[\x00-\u02ff\u3001-\u3029\u3030-\u3098\u309b-\u312f\u3190-\u9fff\uff01-\uff9d]*")
_FOUND = "doc_id long not null, item_id long not null, doc_start int not null, doc_end int not null, item_start int not null, item_end int not null, whole boolean not null"
_BUILT: dict[bytes, Scanner] = {}


def clusters(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of the pieces of ``text`` that normalisation never joins: a character with the marks, joining vowels and invisible
    characters after it."""
    if _PLAIN.fullmatch(text):  # nothing here joins what precedes it
        yield from ((i, i + 1) for i in range(len(text)))
        return
    start = 0
    for i in range(1, len(text)):
        form = composed(text[i])
        if form and unicodedata.category(form[0])[0] not in "MC" and not "\u1100" <= form[0] <= "\u11ff":
            yield start, i
            start = i
    if text:
        yield start, len(text)


#: Letters that a whole item may lack at either end.
ENDS = 2


@dataclass(frozen=True)
class Item:
    item_id: int
    letters: str
    start: list[int]
    chars: int
    seed: int
    least: int
    #: Letters that a passage of this item has at least, if it counts.
    few: int


class Scanner:
    """The automaton over some items, with what is needed to judge a chain of its hits."""

    def __init__(self, items: list[tuple[int, str, bool]], script: dict[int, str], seed: int, seed_latin: int, least: int, least_latin: int):
        self.script = script
        self.items: list[Item] = []
        places: dict[str, list[tuple[int, int]]] = {}
        for item_id, text, latin in items:
            letters, start, _ = self.letters_and_places(text)
            q = min(seed_latin if latin else seed, len(letters))
            if not q:
                continue
            least_chars = least_latin if latin else least
            # The fewest letters in a passage of the least length, or in the whole item.
            bounds = [*start, len(text)]
            few = min((bisect_left(bounds, (bounds[i - 1] + 1 if i else 0) + least_chars, i) - i for i in range(len(letters)) if len(text) - bounds[i] >= least_chars), default=len(letters))
            self.items.append(Item(item_id, letters, start, len(text), q, least_chars, max(1, min(few, len(letters) - 2 * ENDS))))
            for p in range(len(letters) - q + 1):
                places.setdefault(letters[p : p + q], []).append((len(self.items) - 1, p))
        self.automaton = ahocorasick.Automaton()
        for k, v in places.items():
            self.automaton.add_word(k, (len(k), v))
        if places:
            self.automaton.make_automaton()
        self.empty = not places

    def letters(self, text: str) -> str:
        """Letters and digits only, composed, folded, in one script."""
        out = _NOT_WORD.sub("", composed(text).casefold())
        return out.translate(self.script) if self.script and not out.isascii() else out

    def letters_and_places(self, text: str) -> tuple[str, list[int], list[int]]:
        """The letters, with the start and end in ``text`` of what each comes from."""
        out, start, end = [], [], []
        for a, b in clusters(text):
            while b > a + 1 and not composed(text[b - 1]):  # invisible characters at the end belong to no letter
                b -= 1
            for c in self.letters(text[a:b]):
                out.append(c)
                start.append(a)
                end.append(b)
        return "".join(out), start, end

    def chains(self, letters: str) -> list[tuple[int, int, int, int, int]]:
        """``(item, first and last letter in the document, first and last in the item)``; last is exclusive."""
        by_item: dict[int, list[tuple[int, int]]] = {}
        for end, (q, where) in self.automaton.iter(letters):
            for item, p in where:
                by_item.setdefault(item, []).append((end - q + 1, p))
        found = []
        for item, hits in by_item.items():
            one = self.items[item]
            q = one.seed
            # A chain of h hits covers h (q + 3) + 2 q letters at most: hits lie up to q + 3 apart, and either end is carried on by less than q + 1.
            if len(hits) * (q + 3) + 2 * q < one.few:
                continue
            open_chains: dict[int, list[int]] = {}
            done = []
            for d, p in hits:
                chain = None
                for diagonal in (d - p, d - p - 1, d - p + 1, d - p - 2, d - p + 2):
                    c = open_chains.get(diagonal)
                    if c is not None and 0 < d - c[1] <= q + 3 and p > c[3]:
                        chain = open_chains.pop(diagonal)
                        break
                if chain is None:
                    chain = [d, d, p, p]
                    done.append(chain)
                chain[1], chain[3] = d, p
                open_chains[d - p] = chain
            found += [(item, *self.stretched(letters, one.letters, c[0], c[1] + q, c[2], c[3] + q)) for c in done if c[3] - c[2] + 3 * q >= one.few]
        return found

    def stretched(self, letters: str, other: str, d0: int, d1: int, i0: int, i1: int) -> tuple[int, int, int, int]:
        """A chain carried on over one misread letter at either end while letters agree."""
        k = 2
        while min(d0, i0) >= k and letters[d0 - k] == other[i0 - k]:
            k += 1
        if k > 2:
            d0, i0 = d0 - k + 1, i0 - k + 1
        k = 1
        while d1 + k < len(letters) and i1 + k < len(other) and letters[d1 + k] == other[i1 + k]:
            k += 1
        if k > 1:
            d1, i1 = d1 + k, i1 + k
        return d0, d1, i0, i1

    def scan(self, text: str) -> list[tuple[int, int, int, int, int, bool]]:
        """``(item id, start and end in text, start and end in the item, whole)`` of each passage that is long enough."""
        if self.empty:
            return []
        letters = self.letters(text)
        found = self.judged(self.chains(letters))
        if not found:
            return []
        own, start, end = self.letters_and_places(text)
        if own != letters:  # places are those of the text taken piece by piece, so its letters decide
            found = self.judged(self.chains(own))
        return [(self.items[i].item_id, start[d0], end[d1 - 1], a, b, whole) for i, d0, d1, a, b, whole in found]

    def judged(self, chains: list[tuple[int, int, int, int, int]]) -> list[tuple[int, int, int, int, int, bool]]:
        out = []
        for i, d0, d1, i0, i1 in chains:
            one = self.items[i]
            n = len(one.letters)
            # The marks around a passage, up to the next letters of the item, belong to it as far as can be told.
            start, end = (one.start[i0 - 1] + 1 if i0 else 0), (one.start[i1] if i1 < n else one.chars)
            # A whole item may lack letters misread at its ends, unless it is so short that they'd be much of it.
            lost = ENDS if n >= 4 * one.seed else 0
            whole = i0 <= lost and i1 >= n - lost
            if whole or end - start >= one.least:
                out.append((i, d0, d1, one.start[i0], one.start[i1 - 1] + 1, whole))
        return out


def _scanner(key: bytes, *args) -> Scanner:
    """The worker's scanner, built once a process."""
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Scanner(*args)
    return _BUILT[key]


def leaked_passages(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    item_text_col: str = "text",
    item_id_col: str = "item_id",
    min_chars: int = 60,
    min_chars_latin: int = 210,
    seed: int = 6,
    seed_latin: int = 12,
    block_chars: int = 400_000,
) -> DataFrame:
    """``doc_id, item_id, doc_start, doc_end, item_start, item_end, whole``: passages of items in documents, ends exclusive, as code points.

    A passage counts if it is the whole item or at least ``min_chars`` characters of it (``min_chars_latin`` where the item has no Chinese
    character). Width, invisible characters, case, script, spaces, breaks and punctuation don't matter, nor single misread characters with
    ``seed`` good ones around them. Null or empty documents and items give nothing; repeated rows repeat; empty tables give an empty
    result. Items are taken in blocks of at most ``block_chars`` characters, one automaton and one scan of the corpus each: an automaton takes
    about 600 bytes a character (measured: 118 MB for 200,000), so a block is about 240 MB in each worker.
    """
    spark = docs.sparkSession
    clean = items.where((F.length(item_text_col) > 0) & F.col(item_id_col).isNotNull()).select(
        F.col(item_id_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text")
    )
    total = clean.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_chars))
    script = simplified_script(spark)
    texts = docs.where((F.length(text_col) > 0) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    result = None
    for block in range(blocks):
        part = clean.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block) if blocks > 1 else clean
        rows = sorted({(r[0], r[1], not re.search("[㐀-鿿]", r[1])) for r in part.collect()})  # at most block_chars characters
        sent = spark.sparkContext.broadcast((rows, script))
        key = digest(repr((rows, seed, seed_latin, min_chars, min_chars_latin, len(script))))

        def scan(batches: Iterator[pa.RecordBatch], sent=sent, key=key) -> Iterator[pa.RecordBatch]:
            scanner = _scanner(key, *sent.value, seed, seed_latin, min_chars, min_chars_latin)
            for b in batches:
                found = []
                for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                    found += [(doc_id, *x) for x in scanner.scan(text)]
                cols = list(zip(*found, strict=True)) or [[]] * 7
                kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.bool_()]
                names = ["doc_id", "item_id", "doc_start", "doc_end", "item_start", "item_end", "whole"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

        hits = texts.mapInArrow(scan, _FOUND)
        result = hits if result is None else result.unionByName(hits)
    return result


def leaked_items(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``doc_id, item_id`` (distinct): each document with the items it holds."""
    return leaked_passages(docs, items, **options).select("doc_id", "item_id").distinct()
