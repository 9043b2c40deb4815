"""Noise in text from scanned pages: running titles, page numbers, words hyphenated across lines, misrecognised characters.

* *Edge lines.* Lines in the top and bottom zone of pages are keyed by their letters (without figures, in one script, turned round if printed
  backwards, the company's name replaced). Keys that recur over the pages of a report or of the corpus are running titles, and so are lines
  one misread character away from them; figures in the form of page numbers are page numbers.
* *Misread characters.* Words (of letters; windows of three characters where no words are marked; the shapes of figures) are counted. Each has
  an anagram hash, the sum of its characters' hashes, so a confusion of two characters is one difference of hashes wherever it happens. Rare
  words are joined in SQL with the frequent word in the same surroundings (equal hash without the character), the differences are ranked by
  how many words support them, and those with enough support are the confusable characters: none are given beforehand. Every rare word is
  then joined with frequent words at exactly a learned difference; corrections are ranked by frequency.
* *Hyphens.* A word that ends in a mark is the first part of a broken word if it makes a usual word with a word on another line of its page or on
  the next, unless the corpus knows the part as the beginning of a compound that keeps its hyphen.

Vocabularies, corrections and repaired words stay tables that are joined; only the confusable characters (at most ten a character) reach the
driver.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import patterns as P
from ..operators.layout import clean_words, column_cuts
from ..operators.reflow import paragraph_starts
from ..session import cut
from .membership import Bits, key_bits, may_match
from .textform import composed, simplified_script

#: Marks that break a word at the end of a line (fixed values).
BREAK_MARKS = "-‐‑‒–—­¬﹣－"

_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_TOKEN = re.compile(f"[{_LETTER}0-9]+")
_COMPOUND = re.compile(f"[{_LETTER}]+(?:-[{_LETTER}]+)+")
_BROKEN = f"([{_LETTER}0-9]*[{_LETTER}])[{BREAK_MARKS}]$"
_ENDS_BROKEN = re.compile(_BROKEN)
_FIGURE = re.compile(r"[0-9A-Za-z]+(?:[.,][0-9A-Za-z]+)*")
_DIGIT = re.compile("[0-9]")
_NUMBER_BEFORE, _NUMBER_AFTER = re.compile("[0-9A-Za-z][.,]$"), re.compile("[.,][0-9A-Za-z]")
_DIGITS = str.maketrans("0123456789０１２３４５６７８９", "0" * 20)
_AROUND = ".,，。;；)"
_HAN = re.compile("[㐀-鿿]")
_NOT_LETTERS = re.compile(r"[\W\d_]+")
#: What a gram is: a word, a compound with its hyphen, the shape of a figure, a figure with letters, three characters of unmarked words.
_WORD, _JOINED, _SHAPE, _MIXED, _THREE = "w", "c", "s", "f", "h"


def _figures(text: str) -> Iterator[tuple[int, str]]:
    """The figures of a word and a single letter that stands for itself, with their places."""
    bare = text.strip(_AROUND)
    if len(bare) == 1 and bare.isascii() and bare.isalpha():
        yield text.index(bare), bare
    elif _DIGIT.search(text):
        for m in _FIGURE.finditer(text):
            if _DIGIT.search(m.group()):
                yield m.start(), m.group()


def _words(text: str) -> Iterator[tuple[int, str]]:
    """The words of letters and digits; the part before a break mark is no word, and longer numbers and parts of numbers say nothing."""
    broken = _ENDS_BROKEN.search(text)
    for m in _TOKEN.finditer(text):
        t = m.group()
        if len(t) < 2 or (broken and m.end() == broken.end(1)):
            continue
        if _DIGIT.search(t) and (_NUMBER_BEFORE.search(text, 0, m.start()) or _NUMBER_AFTER.match(text, m.end()) or (len(t) > 4 and t.isdigit())):
            continue
        yield m.start(), t


def word_counts(texts: DataFrame) -> DataFrame:
    """``kind, gram, n`` of distinct ``text, n``: what words are made of, counted over all words. Each batch is counted before anything is
    shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts: Counter[str] = Counter()
            single: list[str] = []
            for text, n in zip(b.column("text").to_pylist(), b.column("n").to_pylist(), strict=True):
                grams = [_WORD + t for _, t in _words(text)]
                if "-" in text:
                    grams += [_JOINED + t for t in _COMPOUND.findall(text)]
                for _, t in _figures(text):
                    grams.append(_SHAPE + t.translate(_DIGITS))
                    if not t.replace(".", "").replace(",", "").isdigit():
                        grams.append(_MIXED + t)
                if not text.isascii() and _HAN.search(text):
                    plain = text.translate(_DIGITS)
                    grams += [_THREE + plain[i : i + 3] for i in range(len(plain) - 2)]
                if n == 1:
                    single += grams
                else:
                    for g in grams:
                        counts[g] += n
            counts.update(single)
            grams = list(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([g[0] for g in grams], pa.string()), pa.array([g[1:] for g in grams], pa.string()), pa.array(list(counts.values()), pa.int64())], ["kind", "gram", "n"]
            )

    return texts.mapInArrow(count, "kind string not null, gram string not null, n long not null").groupBy("kind", "gram").agg(F.sum("n").alias("n"))


def anagram_hash(word: Column) -> Column:
    """The sum of the hashes (40 bits) of a word's characters: equal for anagrams, and additive under substitution."""
    return F.aggregate(F.split(word, ""), F.lit(0).cast("long"), lambda acc, c: acc + F.when(c == "", 0).otherwise(F.xxhash64(c).bitwiseAND(0xFFFFFFFFFF)))


def _parts(counts: DataFrame) -> DataFrame:
    """``kind, gram, n, h, i, x``: each gram with each of its characters (in words also two neighbouring ones) and its place."""
    size = F.length("gram")
    grams = counts.where(F.col("kind").isin(_WORD, _SHAPE, _THREE) & (size >= 2)).withColumn("h", anagram_hash(F.col("gram")))
    one = F.transform(F.sequence(F.lit(1), size), lambda i: F.struct(i.alias("i"), F.substring(F.col("gram"), i, F.lit(1)).alias("x")))
    two = F.transform(F.sequence(F.lit(1), size - 1), lambda i: F.struct(i.alias("i"), F.substring(F.col("gram"), i, F.lit(2)).alias("x")))
    parts = grams.withColumn("_p", F.explode(F.when(F.col("kind") == _WORD, F.concat(one, two)).otherwise(one)))
    return parts.select("kind", "gram", "n", "h", "_p.i", "_p.x")


def confusions(counts: DataFrame, least: int = 20, times: int = 20, support: float = 2.0, specific: float = 0.2, share: float = 0.1) -> DataFrame:
    """``kind, wrong, right, delta, weight, support``: characters that are misread as others, learned from the words.

    A rare word supports a confusion if the word seen most in the same surroundings (seen ``least`` times, and ``times`` as often) has another
    character in one place; the more characters the surroundings admit, the less it says. A confusion needs a weight of ``support`` (a digit in
    a word, whose letter is known from figures, 1), must be ``specific`` of its surroundings, must have ``share`` of the weight of the
    character's likeliest reading (so a character has ten at most), and in unmarked words must be seen in two places of the window. Numbers
    are not misread as numbers, and characters of two scripts that are one character aren't confusions.
    """
    script = simplified_script(counts.sparkSession)
    parts = _parts(counts)
    rest = F.concat(F.substring(F.col("gram"), F.lit(1), F.col("i") - 1), F.lit("\0"), F.substring(F.col("gram"), F.col("i") + F.length("x"), F.lit(1 << 20)))
    parts = parts.withColumn("residual", F.col("h") - anagram_hash(F.col("x"))).withColumn("rest", rest)
    around = Window.partitionBy("kind", "i", "residual", "rest")
    han = (F.col("kind") != _THREE) | F.col("x").rlike("[㐀-鿿]")
    top = F.max(F.when(han & (F.col("n") >= least), F.struct("n", "x", "h"))).over(around)
    parts = parts.withColumn("alternatives", F.count(F.lit(1)).over(around)).withColumn("top", top)
    wrong, right = F.col("x"), F.col("top.x")
    sizes = F.length(wrong) + F.length(right)
    apart = (F.left(wrong, F.lit(1)) != F.left(right, F.lit(1))) & (F.right(wrong, F.lit(1)) != F.right(right, F.lit(1)))
    digits = wrong.rlike("^[0-9]+$") & right.rlike("^[0-9]+$")
    seen = parts.where(han & (right != wrong) & (F.col("top.n") >= F.col("n") * times) & (sizes < 4) & apart & ~digits & (F.length("rest") > 1))
    seen = seen.where(~wrong.rlike("^[.,]$") & ~right.rlike("^[.,]$"))
    if script:
        table = ("".join(map(chr, script)), "".join(script.values()))
        seen = seen.where(F.translate(wrong, *table) != F.translate(right, *table))
    pairs = seen.groupBy("kind", wrong.alias("wrong"), right.alias("right"), (F.col("top.h") - F.col("h")).alias("delta")).agg(
        F.sum(1.0 / (F.col("alternatives") - 1)).alias("weight"), F.count(F.lit(1)).alias("support"), (F.min("i") != F.max("i")).alias("_places")
    )
    pairs = pairs.withColumn("_best", F.max("weight").over(Window.partitionBy("kind", "wrong")))
    figure = (F.col("kind") == _WORD) & (F.col("wrong").rlike("^[0-9]$") | F.col("right").rlike("^[0-9]$"))
    enough = F.col("weight") >= F.when(figure, F.lit(1.0)).when(F.col("kind") == _SHAPE, F.lit(support / 2)).otherwise(F.lit(support))
    places = (F.col("kind") != _THREE) | F.col("_places")
    ranked = enough & places & (figure | (F.col("weight") >= F.col("support") * specific)) & (F.col("weight") >= F.col("_best") * share)
    return pairs.where(ranked).drop("_best", "_places")


class Confusable:
    """The learned confusions as the workers use them."""

    def __init__(self, rows: list[tuple[str, str, str, int]]):
        values: dict[str, tuple[int, str]] = {}
        for kind, wrong, right, support in rows:
            for letter, digit in ((wrong, right), (right, wrong)):
                if kind == _WORD and len(letter) == 1 and letter.isalpha() and digit.isdigit():
                    values[letter] = max(values.get(letter, (0, "")), (support, digit))
        rows = [r[:3] for r in rows]
        self.han = frozenset(w for k, w, _ in rows if k == _THREE)
        #: Letters that stand for digits, known from the shapes of figures.
        self.letters = "".join(sorted(w for k, w, r in rows if k == _SHAPE and r == "0" and w.isascii() and w.isalpha()))
        letters = set(self.letters)
        #: Those whose digit is known, and their digits.
        sure = [c for c in self.letters if c in values]
        self.values = ("".join(sure), "".join(values[c][1] for c in sure))
        self.words = sorted({(w, r) for k, w, r in rows if k == _WORD and (not (w.isdigit() or r.isdigit()) or w in letters or r in letters)})
        self.in_words = re.compile("|".join(re.escape(w) for w in sorted({w for w, _ in self.words}, key=lambda w: (-len(w), w)))) if self.words else None
        self.in_han = re.compile("[" + "".join(sorted(self.han)) + "]") if self.han else None


def confusable(counts: DataFrame, **options: float) -> tuple[Confusable, list[tuple]]:
    """The confusions, read to the driver (at most ten a character, whatever the corpus), and the rows."""
    rows = sorted(tuple(r) for r in confusions(counts, **options).select("kind", "wrong", "right", "delta", "support").collect())
    return Confusable([(*r[:3], r[4]) for r in rows]), rows


def corrections(counts: DataFrame, known: Confusable, rows: list[tuple], least: int = 20, times: int = 20) -> DataFrame:
    """``kind, gram, best``: rare grams and the frequent one each stands for, the most frequent one first (one row a gram).

    A gram is a misreading of another if one learned difference turns it into a gram at least ``times`` as frequent and seen ``least`` times. A
    figure is misread if its letters all stand for digits and the figures of the shape it then has are as much more frequent; a code that makes
    up half of what has its shape, and isn't as rare beside the figure it would be, is none.
    """
    spark = counts.sparkSession
    wanted = [r[:4] for r in rows if r[0] == _THREE or (r[0] == _WORD and (r[1], r[2]) in set(known.words))]
    pairs = spark.createDataFrame(wanted, "kind string, x string, right string, delta long")
    frequent = counts.where((F.col("n") >= least) & F.col("kind").isin(_WORD, _THREE)).select("kind", F.col("gram").alias("best"), F.col("n").alias("n_best"), anagram_hash(F.col("gram")).alias("h"))
    suspect = _parts(counts).join(F.broadcast(pairs), ["kind", "x"]).withColumn("h", F.col("h") + F.col("delta"))  # at most ten a character
    # The hashes agree up to anagrams; what counts is one substitution at one place.
    other = F.concat(F.substring(F.col("gram"), F.lit(1), F.col("i") - 1), F.col("right"), F.substring(F.col("gram"), F.col("i") + F.length("x"), F.lit(1 << 20)))
    found = suspect.hint("merge").join(frequent, ["kind", "h"]).where((F.col("n_best") >= F.col("n") * times) & (other == F.col("best")))
    best = found.groupBy("kind", "gram").agg(F.max_by("best", F.struct("n_best", "best")).alias("best"))
    if not known.letters:
        return best
    shapes = counts.where(F.col("kind") == _SHAPE).select(F.col("gram").alias("shape"), F.col("n").alias("n_shape"))
    target = shapes.where((F.col("n_shape") >= least) & F.col("shape").rlike("^[0.,]+$")).select(F.col("shape").alias("target"), F.col("n_shape").alias("n_best"))
    mixed = counts.where((F.col("kind") == _MIXED) & F.col("gram").rlike(f"^[0-9.,{known.letters}]+$"))
    mixed = mixed.withColumn("shape", F.translate("gram", "123456789", "000000000")).withColumn("target", F.translate("shape", known.letters, "0" * len(known.letters)))
    mixed = mixed.join(shapes.hint("merge"), "shape").join(target.hint("merge"), "target")
    mixed = mixed.withColumn("best", F.translate("gram", *known.values))
    as_such = counts.where(F.col("kind") == _WORD).select(F.col("gram").alias("best"), F.col("n").alias("n_as_such"))
    mixed = mixed.join(as_such.hint("merge"), "best", "left")
    code = (F.col("n_shape") >= 4) & (F.col("n") * 2 > F.col("n_shape")) & (F.length("gram") > 1) & (F.coalesce("n_as_such", F.lit(0)) < 4 * F.col("n"))
    figures = mixed.where((F.col("n_best") >= F.col("n_shape") * times) & ~code)
    return best.unionByName(figures.select("kind", "gram", "best"))


def repairs(texts: DataFrame, known: Confusable, fixes: DataFrame) -> DataFrame:
    """``text, repaired`` of the distinct words that hold a misread character. A letter whose digit isn't known stays.

    An unmarked character is misread if all but one of the windows around it say so (where two errors meet, one of them is seen in none).
    """
    known_grams = F.concat("kind", "gram")
    sent = texts.sparkSession.sparkContext.broadcast(Bits(key_bits(fixes, F.xxhash64(known_grams), fixes.count())))  # of a fixed size

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = re.compile(f"[{known.letters}]") if known.letters else None
        fixed, met = sent.value, {}

        def may(gram: str) -> bool:
            found = met.get(gram)
            if found is None:
                found = met[gram] = gram in fixed
            return found

        for b in batches:
            met.clear()
            rows: list[tuple[str, int, int, str, str]] = []
            for text in b.column("text").to_pylist():
                if known.in_han and not text.isascii():
                    plain = text.translate(_DIGITS)
                    for m in known.in_han.finditer(plain):
                        i = m.start()
                        rows += [(text, i, i - k, _THREE, plain[k : k + 3]) for k in (i - 2, i - 1, i) if k >= 0 and k + 3 <= len(plain) and may(_THREE + plain[k : k + 3])]
                if known.in_words:
                    rows += [(text, i, 0, _WORD, t) for i, t in _words(text) if known.in_words.search(t) and not t.isdigit() and may(_WORD + t)]
                if letters:
                    rows += [(text, i, 0, _MIXED, t) for i, t in _figures(text) if letters.search(t) and may(_MIXED + t)]
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["text", "at", "off", "kind", "gram"])

    seen = texts.select("text").mapInArrow(suspects, "text string, at int, off int, kind string, gram string")
    hits = seen.hint("merge").join(fixes, ["kind", "gram"]).groupBy("text").agg(F.collect_list(F.struct("at", "off", "kind", "gram", "best")).alias("hits"))

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [(t, repaired(t, h)) for t, h in zip(b.column("text").to_pylist(), b.column("hits").to_pylist(), strict=True)]
            out = [(t, r) for t, r in out if r is not None]
            yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in out], pa.string()), pa.array([r for _, r in out], pa.string())], ["text", "repaired"])

    return hits.mapInArrow(repair, "text string, repaired string")


def repaired(text: str, hits: list[dict]) -> str | None:
    """The word with its misread characters put right, or None if there are none."""
    votes: dict[int, Counter[str]] = {}
    spans: dict[int, tuple[str, str]] = {}
    for h in sorted(hits, key=lambda h: h["kind"]):  # a known word ("w") before the shape of a figure ("f")
        at, off = h["at"], h["off"]
        if h["kind"] != _THREE:
            spans[at] = (h["gram"], h["best"])
        elif h["best"][off] != h["gram"][off]:
            votes.setdefault(at, Counter())[h["best"][off]] += 1
    chars, found = list(text), bool(spans)
    for at, v in votes.items():
        windows = min(at, len(text) - 3) - max(0, at - 2) + 1
        best, n = max(v.items(), key=lambda x: (x[1], x[0]))
        if n >= max(1, windows - 1):
            chars[at], found = best, True
    for at, (gram, best) in spans.items():
        if "".join(chars[at : at + len(gram)]) == gram:
            chars[at : at + len(gram)] = [best, *[""] * (len(gram) - 1)]
    return "".join(chars) if found else None


class Reading:
    """What the corpus says about its words, as tables in the shared folder: ``counts`` (``kind, gram, n``), ``repairs`` (``text, repaired``),
    and the confusable characters."""

    def __init__(self, words: DataFrame, least: int = 20, times: int = 20, **learning: float):
        texts = cut(words.where(F.length("text") > 0).groupBy("text").agg(F.count(F.lit(1)).alias("n")))
        self.counts = cut(word_counts(texts))
        self.known, rows = confusable(self.counts, least=least, times=times, **learning)
        fixes = cut(corrections(self.counts, self.known, rows, least, times))
        self.repairs = cut(repairs(texts, self.known, fixes))


def page_sizes(words: DataFrame, geometry: DataFrame | None = None) -> DataFrame:
    """``doc_id, page_no, height, first``: the height of each page with words - where its geometry is missing that of the usual paper its lowest
    word fits on - and whether it is its report's first."""
    pages = words.groupBy("doc_id", "page_no").agg(F.max("top").alias("_low"))
    if geometry is not None:
        size = geometry.groupBy("doc_id", "page_no").agg(F.max("height").alias("height"))
        pages = pages.join(size, ["doc_id", "page_no"], "left")
    else:
        pages = pages.withColumn("height", F.lit(None).cast("double"))
    guess = F.when(F.col("_low") > 770, F.greatest(F.lit(842.0), F.col("_low"))).when(F.col("_low") > 600, 792.0).otherwise(595.0)
    pages = pages.withColumn("height", F.coalesce("height", guess)).drop("_low")
    return pages.withColumn("first", F.col("page_no") == F.min("page_no").over(Window.partitionBy("doc_id")))


def edge_lines(words: DataFrame, geometry: DataFrame | None = None, letters: str = "", top_zone: float = 0.078, bottom_zone: float = 0.93) -> DataFrame:
    """``doc_id, page_no, zone, line, company, first, alone, text, members, key, number, figure`` of the lines in the top and bottom zones of
    pages. The zones go with the height of each page; ``letters`` are those that stand for digits."""
    w = words.where(F.length("text") > 0)
    pages = cut(page_sizes(w, geometry))
    ends = pages.agg(F.max("height").alias("most"), F.min("height").alias("least")).first()
    most, least = ends["most"] or 0.0, ends["least"] or 0.0
    # Words in no page's zone stay behind before anything is shuffled.
    near = w.where((F.col("top") < max(most * top_zone, 46.0)) | (F.col("top") > least * bottom_zone))
    near = near.select("doc_id", "company", "page_no", "word_no", "text", "x0", "x1", "top")
    near = near.repartition("doc_id", "page_no").distinct().join(pages.hint("merge"), ["doc_id", "page_no"])  # one shuffle for all that follows
    zone = F.when(F.col("top") < F.greatest(F.col("height") * top_zone, F.lit(46.0)), "top").when(F.col("top") > F.col("height") * bottom_zone, "bottom")
    near = near.withColumn("zone", zone).where("zone is not null").withColumnRenamed("first", "_first")
    order = Window.partitionBy("doc_id", "page_no", "zone").orderBy("top", "x0", "word_no")
    starts = F.coalesce(F.col("top") - F.lag("top").over(order) > 1.5, F.lit(False))
    near = near.withColumn("row", F.sum(starts.cast("int")).over(order))
    # Words of a row that stand far apart (a page number beside a table) are lines of their own.
    along = Window.partitionBy("doc_id", "page_no", "zone", "row").orderBy("x0", "word_no")
    apart = F.coalesce(F.col("x0") - F.lag("x1").over(along) > 40, F.lit(False))
    near = near.withColumn("line", F.col("row") * 1000 + F.sum(apart.cast("int")).over(along))
    near = near.withColumn("alone", F.max(apart.cast("int")).over(Window.partitionBy("doc_id", "page_no", "zone", "row")) == 0)
    lines = near.groupBy("doc_id", "page_no", "zone", "line").agg(
        F.first("company").alias("company"),
        F.first("_first").alias("first"),
        F.first("alone").alias("alone"),
        F.sort_array(F.collect_list(F.struct("x0", "word_no", "text"))).alias("_w"),
    )
    lines = lines.select(
        "doc_id", "page_no", "zone", "line", "company", "first", "alone",
        F.array_join(F.col("_w.text"), " ").alias("text"), F.col("_w.word_no").alias("members"),
    )
    script = simplified_script(words.sparkSession)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key, number = [], []
            for text, company in zip(b.column("text").to_pylist(), b.column("company").to_pylist(), strict=True):
                k, n = line_key(text, company or "", script, letters)
                key.append(k)
                number.append(n)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(key, pa.string()), pa.array(number, pa.bool_())], [*b.schema.names, "key", "number"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in lines.schema) + ", key string, number boolean"
    return lines.mapInArrow(keys, schema)


@lru_cache(maxsize=4)
def _number_forms(letters: str) -> tuple[re.Pattern[str], re.Pattern[str]]:
    """The form of a page number, and figures inside a line, where ``letters`` may stand for digits."""
    digit = f"[0-9{letters}|]"
    one = rf"(?:{digit}{{1,5}}|[ivxlc]{{1,7}}|[IVXLC]{{1,7}})"
    form = re.compile(rf"^(?:第|page\s*)?\s*[-–—·]?\s*{one}\s*(?:(?:[/／]|of)\s*{one})?\s*[-–—·]?\s*(?:页|頁)?$", re.I)
    return form, re.compile(f"[0-9{letters}]*\\d[0-9{letters}]*")


def line_key(text: str, company: str, script: dict[int, str], digit_letters: str = "") -> tuple[str, bool]:
    """The key of a line - its letters in one script, ``@`` for the company's name - and whether it has the form of a page number."""
    page_number, figures = _number_forms(digit_letters)
    plain = composed(text).translate(script)
    name = re.sub(r"^\d+\s*[_\-\s]\s*", "", company).translate(script)
    letters = _NOT_LETTERS.sub("", figures.sub("", plain)).casefold()
    if name and name not in letters and name in letters[::-1]:
        letters = letters[::-1]
    bare = plain.replace(name, "").replace("股份有限公司", "").strip() if name else plain.strip()
    return (letters.replace(name, "@") if name else letters), bool(page_number.match(bare)) and any(c.isalnum() for c in bare)


def furniture_words(words: DataFrame, geometry: DataFrame | None = None, letters: str = "", digits: str = "", share: float = 0.002, min_pages: int = 4, first_share: float = 0.05) -> DataFrame:
    """``doc_id, page_no, word_no`` of the words of running titles, running company names and page numbers.

    A key recurs if it stands at the edge of two pages of a report, or of ``share`` of all pages with edge lines (``min_pages`` at least). On
    a report's first page only keys are furniture that hold the company's name or hardly ever open a report: others are headings. ``letters``
    are those misread for ``digits`` in figures.
    """
    lines = cut(edge_lines(words, geometry, letters))
    lettered = F.length("key") >= 2
    pages = lines.select("doc_id", "page_no").distinct().agg(F.count(F.lit(1)).alias("n_pages"))
    usage = lines.where(lettered).groupBy("key").agg(F.count_distinct("doc_id", "page_no").alias("n"), F.sum(F.col("first").cast("int")).alias("n_first"))
    # At most 1 / share keys for each line of a page: a small table whatever the corpus.
    common = usage.crossJoin(F.broadcast(pages)).where((F.col("n") >= min_pages) & (F.col("n") >= F.col("n_pages") * share))  # one row
    common = cut(common.select("key", ((F.col("n_first") > F.col("n") * first_share) & ~F.col("key").contains("@")).alias("opens")))
    lines = lines.join(F.broadcast(common), "key", "left")  # ``opens`` is null where a key isn't common

    def on_two_pages(rows: Column, *same: str) -> Column:
        """Whether those of the ``rows`` that are the same in a report stand on two pages of it."""
        page, around = F.when(rows, F.col("page_no")), Window.partitionBy("doc_id", *same)
        return rows & (F.min(page).over(around) != F.max(page).over(around))

    # The lines of a report are brought together once.
    told = lines.repartition("doc_id").withColumn("_by_report", on_two_pages(lettered & ~F.col("first"), "key"))
    # A bare figure beside other words is a page number if it runs with the pages of the report.
    numbered = F.col("number") & ((F.col("zone") == "bottom") | F.col("key").contains("@"))
    step = F.col("page_no") - F.translate(F.regexp_extract("text", f"[0-9{letters}]+", 0), letters, digits).try_cast("int")
    told = told.withColumn("_step", F.when(numbered, step)).withColumn("_runs", on_two_pages(F.col("_step").isNotNull(), "_step"))
    formed = F.col("alone") | F.col("text").rlike("[第页頁]|(?i)page|^[-–— ]|^[ivxlcIVXLC]+$")
    by_corpus = F.coalesce(~(F.col("first") & F.col("opens")), F.lit(False)) & F.col("opens").isNotNull()
    told = told.where(by_corpus | F.col("_by_report") | (numbered & (formed | F.col("_runs")))).select("doc_id", "page_no", "members")
    # Misread characters: one in nine at most, so of one part more than that one is still the same as that of a common key with the company's
    # name written out. A title of less than four letters has no misread form: half of it would be another word.
    script = simplified_script(words.sparkSession)
    name = F.regexp_replace("company", r"^\d+\s*[_\-\s]\s*", "")
    name = F.translate(name, "".join(chr(c) for c in script), "".join(script.values())) if script else name
    named = lines.where(lettered & F.col("company").isNotNull()).withColumn("name", name).withColumn("full", F.expr("replace(key, '@', name)"))
    title = F.coalesce(~F.col("opens"), F.lit(False))
    titles = named.where(title).select("company", "full").distinct()
    size = F.length("full")
    most = F.greatest(F.lit(1), F.floor(size / 9)).cast("int")

    def in_parts(df: DataFrame) -> DataFrame:
        def part(k: Column) -> Column:
            a, b = F.floor(k * size / (most + 1)).cast("int"), F.floor((k + 1) * size / (most + 1)).cast("int")
            return F.struct(k.alias("side"), F.substring(F.col("full"), a + 1, b - a).alias("part"))

        parts = F.explode(F.transform(F.sequence(F.lit(0), most), part)).alias("_h")
        return df.where(size >= 4).select("*", size.alias("_n"), most.alias("_most"), parts).select("*", "_h.side", "_h.part").drop("_h")

    odd = named.where(~title & ~F.col("first")).select("doc_id", "page_no", "members", "company", "full")
    near = in_parts(odd).alias("o").join(in_parts(titles).alias("t"), [F.col(f"o.{c}") == F.col(f"t.{c}") for c in ("company", "_n", "side", "part")])
    near = near.where(F.levenshtein("o.full", "t.full") <= F.col("o._most")).select("o.doc_id", "o.page_no", "o.members")
    return told.unionByName(near).select("doc_id", "page_no", F.explode("members").alias("word_no")).distinct()


def broken_words(words: DataFrame, counts: DataFrame, usual_least: int = 5) -> DataFrame:
    """``doc_id, page_no, word_no`` of the first parts of words broken at a line end.

    A word that ends in a mark is paired with the words of its page, on another line, and of the next. The two are one word if together they are
    usual (seen ``usual_least`` times, whatever the case), unless the part is a usual word itself and the rest is more than twice as usual as
    the whole, or the part begins a compound that keeps its hyphen (seen three times).
    """
    w = words.where(F.length("text") > 0).select("doc_id", "page_no", "word_no", "text", "top")
    part = F.lower(F.regexp_extract("text", _BROKEN, 1))
    ends = w.where(F.right("text", F.lit(1)).isin(*BREAK_MARKS))
    marked = ends.select("doc_id", "page_no", "word_no", "top", part.alias("part")).where("part <> ''").repartition("part").distinct()
    kept = counts.where((F.col("kind") == _JOINED) & (F.col("n") >= 3)).select(F.lower(F.regexp_extract("gram", "^[^-]+", 0)).alias("part")).distinct()
    marked = cut(marked.join(kept.hint("merge"), "part", "left_anti"))
    usual = counts.where((F.col("kind") == _WORD) & (F.col("n") >= usual_least) & F.col("gram").rlike(f"^[{_LETTER}]{{2,}}$"))
    usual = usual.groupBy(F.lower("gram").alias("w")).agg(F.sum("n").alias("n"))
    # The parts that occur with what is left of usual words behind them, told once for each pair; only words that begin with such a rest are paired.
    split = F.transform(F.sequence(F.lit(1), F.length("w") - 1), lambda i: F.struct(F.substring(F.col("w"), F.lit(1), i).alias("part"), F.substring(F.col("w"), i + 1, F.length("w")).alias("rest")))
    splits = usual.select("n", F.explode(split).alias("_s")).select("_s.part", "_s.rest", "n").join(marked.select("part").distinct().hint("merge"), "part", "left_semi")
    of_part = usual.select(F.col("w").alias("part"), F.col("n").alias("n_part")).hint("merge")
    of_rest = usual.select(F.col("w").alias("rest"), F.col("n").alias("n_rest")).hint("merge")
    splits = splits.join(of_part, "part", "left").join(of_rest, "rest", "left")
    splits = cut(splits.where(F.col("n_part").isNull() | (F.coalesce("n_rest", F.lit(0)) <= 2 * F.col("n"))).select("part", "rest"))
    n = splits.count()
    rest = F.regexp_extract("text", f"^[{_LETTER}0-9]*[{_LETTER}][{_LETTER}0-9]*", 0)
    tails = w.select("doc_id", F.col("page_no").alias("_page"), F.col("top").alias("_top"), rest.alias("rest")).where((F.col("rest") != "") & (F.col("rest") == F.lower("rest")))
    tails = may_match(tails, F.xxhash64("rest"), key_bits(splits, F.xxhash64("rest"), n), n).repartition("doc_id", "_page").distinct()
    near = marked.select("doc_id", "page_no", "word_no", "top", "part", F.explode(F.array(F.col("page_no"), F.col("page_no") + 1)).alias("_page"))
    pairs = near.join(tails.hint("merge"), ["doc_id", "_page"]).where((F.col("_page") != F.col("page_no")) | (F.abs(F.col("_top") - F.col("top")) > 3))
    return pairs.join(splits.hint("merge"), ["part", "rest"], "left_semi").select("doc_id", "page_no", "word_no").distinct()


def misread_words(words: DataFrame, repairs: DataFrame, salts: int = 8) -> DataFrame:
    """``doc_id, page_no, word_no, repaired`` of the words whose text is among the repaired. Texts are compared by their hashes (96 bits), and a
    text that holds a large share of all words is spread over ``salts`` tasks."""

    def key(df: DataFrame) -> DataFrame:
        return df.withColumn("_a", F.xxhash64("text")).withColumn("_b", F.hash("text")).drop("text")

    n = repairs.count()
    w = may_match(words.where(F.length("text") > 0).select("doc_id", "page_no", "word_no", "text"), F.xxhash64("text"), key_bits(repairs, F.xxhash64("text"), n), n)
    w = key(w).withColumn("_s", F.pmod(F.xxhash64("doc_id", "page_no"), F.lit(salts)))
    r = key(repairs).withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
    return w.join(r.hint("merge"), ["_a", "_b", "_s"]).select("doc_id", "page_no", "word_no", "repaired")


def noisy_words(words: DataFrame, geometry: DataFrame | None = None, **options: float) -> DataFrame:
    """``doc_id, page_no, word_no, kind`` (distinct, one kind a word): ``furniture`` before ``hyphen`` before ``misread``.

    Words without id, page, number or text are no cases; a word drawn twice is one; late and unordered pages don't matter; an empty table
    gives an empty result.
    """
    return _noise(words, geometry, **options).select("doc_id", "page_no", "word_no", "kind")


def _noise(words: DataFrame, geometry: DataFrame | None, **options: float) -> DataFrame:
    """``noisy_words`` with the ``repaired`` text of the misread."""
    words = words.where(F.col("doc_id").isNotNull() & F.col("page_no").isNotNull() & F.col("word_no").isNotNull())
    words = words.withColumns({"doc_id": F.col("doc_id").cast("long"), "page_no": F.col("page_no").cast("int"), "word_no": F.col("word_no").cast("int"), "top": F.col("top").cast("double")})
    reading = Reading(words, **options)
    none = F.lit(None).cast("string")
    body = misread_words(words, reading.repairs).withColumn("kind", F.lit("misread"))
    broken = broken_words(words, reading.counts).select("*", none.alias("repaired"), F.lit("hyphen").alias("kind"))
    edge = furniture_words(words, geometry, *reading.known.values).select("*", none.alias("repaired"), F.lit("furniture").alias("kind"))
    # Each kind is written by itself: one plan of all three holds much of the driver's memory. "furniture" < "hyphen" < "misread" in this order too.
    noise = cut(edge).unionByName(cut(broken)).unionByName(body).groupBy("doc_id", "page_no", "word_no").agg(F.min(F.struct("kind", "repaired")).alias("_k"))
    return noise.select("doc_id", "page_no", "word_no", "_k.kind", "_k.repaired")


_GLUE = "\x1f"  # stands at the end of a line whose last word goes on


def _spaced(before: Column, after: Column) -> Column:
    """What stands between two pieces of text: a space unless one side is an ideograph or its punctuation, nothing after a broken word."""
    wide = 0x2E80  # ideographs and their punctuation begin here
    bare = before.isNull() | before.endswith(_GLUE) | (F.ascii(F.right(before, F.lit(1))) >= wide) | (F.ascii(after) >= wide)
    return F.when(bare, F.lit("")).otherwise(F.lit(" "))


def repaired_words(words: DataFrame, geometry: DataFrame | None = None, **options: float) -> DataFrame:
    """The distinct words of the body with ``doc_id, page_no, word_no, text, x0, x1, top, bottom``: running titles and page numbers are gone,
    misread characters put right, and broken words end in a joining mark in place of the hyphen."""
    # What a page's words are goes with the page, so words are shuffled by page only, once for all that follows.
    entry = F.struct("word_no", F.struct("kind", "repaired").alias("is"))
    pages = cut(_noise(words, geometry, **options).groupBy("doc_id", "page_no").agg(F.map_from_entries(F.collect_list(entry)).alias("_is")))
    body = clean_words(words).join(pages.hint("merge"), ["doc_id", "page_no"], "left").withColumn("_k", F.try_element_at("_is", F.col("word_no")))
    body = body.select("doc_id", "page_no", "word_no", "text", "x0", "x1", "top", "bottom", "_k.kind", "_k.repaired").where(~F.col("kind").eqNullSafe("furniture"))
    glued = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - 1), F.lit(_GLUE))
    text = F.when(F.col("kind") == "hyphen", glued).otherwise(F.coalesce("repaired", "text"))
    return body.withColumn("text", text).drop("kind", "repaired")


def body_paragraphs(words: DataFrame, geometry: DataFrame, **options: float) -> DataFrame:
    """``doc_id, para_no, page_no, lvl, t``: each report's body as continuous paragraphs and headings, in reading order.

    Lines follow the baselines (which may waver), columns are read one after the other, and paragraphs that a column or page end cuts are
    joined. ``page_no`` is the page a paragraph begins on.
    """
    w = repaired_words(words, geometry, **options)  # read twice, for the columns' cuts and for the lines, from one shuffle
    cuts = column_cuts(w, geometry).select("doc_id", "page_no", "cut")
    w = w.join(cuts.hint("merge"), ["doc_id", "page_no"], "left").withColumn("col_no", F.when(F.col("x0") >= F.col("cut"), 1).otherwise(0))
    down = Window.partitionBy("doc_id", "page_no", "col_no").orderBy("top", "x0", "word_no")
    w = w.withColumn("line", F.sum(F.coalesce((F.col("top") - F.lag("top").over(down) > 4).cast("int"), F.lit(0))).over(down))
    along = Window.partitionBy("doc_id", "page_no", "col_no", "line").orderBy("x0", "word_no")
    piece = F.concat(_spaced(F.lag("text").over(along), F.col("text")), F.col("text"))
    w = w.withColumn("piece", piece)
    lines = w.groupBy("doc_id", "page_no", "col_no", "line").agg(F.min("top").alias("top"), F.sort_array(F.collect_list(F.struct("x0", "word_no", "piece"))).alias("_w"))
    lines = lines.select(
        "doc_id", "page_no", "col_no", F.bround(F.col("top") / 3).cast("int").alias("k"), F.array_join(F.col("_w.piece"), "").alias("t"), F.element_at("_w", 1)["x0"].alias("x0")
    )
    starts = paragraph_starts(lines)
    block = Window.partitionBy("doc_id", "page_no", "col_no", "para_no").orderBy("k")
    # Lines of Chinese text are set without regard to words and figures, so nothing stands between them.
    before, han = F.lag("t").over(block), f"[{P.HAN}]"
    between = F.when(before.rlike(han) | F.col("t").rlike(han), F.lit("")).otherwise(_spaced(before, F.col("t")))
    starts = starts.withColumn("piece", F.concat(between, F.col("t")))
    paras = starts.groupBy("doc_id", "page_no", "col_no", "para_no").agg(F.max("lvl").alias("lvl"), F.sort_array(F.collect_list(F.struct("k", "piece"))).alias("_l"))
    paras = paras.select("doc_id", "page_no", "col_no", "para_no", "lvl", F.array_join(F.col("_l.piece"), "").alias("t"))
    order = Window.partitionBy("doc_id").orderBy("page_no", "col_no", "para_no")
    last = F.lag("t").over(order)
    other = (F.lag("page_no").over(order) != F.col("page_no")) | (F.lag("col_no").over(order) != F.col("col_no"))
    ended = last.rlike(P.SENTENCE_END) | last.rlike(r"[.!?]$")
    goes_on = (F.col("lvl") == 0) & (F.lag("lvl").over(order) == 0) & other & ~ended & ~F.col("t").rlike(P.HEAD_START)
    paras = paras.withColumn("_new", (~F.coalesce(goes_on, F.lit(False))).cast("int")).withColumn("_pos", F.row_number().over(order))
    paras = paras.withColumn("piece", F.when(F.col("_new") == 1, F.col("t")).otherwise(F.concat(_spaced(last, F.col("t")), F.col("t"))))
    paras = paras.withColumn("no", F.sum("_new").over(Window.partitionBy("doc_id").orderBy("_pos")).cast("int"))
    merged = paras.groupBy("doc_id", F.col("no").alias("para_no")).agg(F.min("page_no").alias("page_no"), F.max("lvl").alias("lvl"), F.sort_array(F.collect_list(F.struct("_pos", "piece"))).alias("_p"))
    return merged.select("doc_id", "para_no", "page_no", "lvl", F.regexp_replace(F.array_join(F.col("_p.piece"), ""), _GLUE, "").alias("t"))
