"""Per-document text quality statistics, and which documents aren't prose.

Statistics are computed for every document. A small model - gradient-boosted trees, one against the rest for prose, list, table and junk - is
trained on a bounded sample of weakly labelled documents (labelling rules on their structure, and structural junk made from their own
sentences), its scores are calibrated on a hand-checked holdout that the sample leaves out by id and by text, and every document gets the
likeliest kind. Texts stay on the executors: the driver sees the sample's statistics only.

A word is an ideograph, a run of letters or a number, in every statistic; what is common is told by pairs of neighbouring ideographs and by
runs of letters.
"""

from __future__ import annotations

import json
import random
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .boosting import BoostedTrees, platt
from .textform import digest, simplified_script, visual_form

KINDS = ("prose", "list", "table", "junk")
#: Statistics that the model sees, in this order.
FEATURES = (
    "mean_word_len", "run_len", "symbol_share", "line_end_share", "common_share", "digit_share", "han_share", "latin_share", "odd_share", "stops",
    "item_share", "cell_share", "noise_share", "short_share", "line_len", "listing", "leader_share", "lone_share", "repeat_share",
    "sentence_share", "commas", "number_share", "stop_first",
)
_STAT = "doc_id long not null, text_id string not null, n_words int not null, " + ", ".join(f"{f} double not null" for f in FEATURES)

_HAN = "㐀-鿿豈-﫿\U00020000-\U0002ffff"
_HAN_RUN = re.compile(f"[{_HAN}]+")
_LATIN_RUN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ž]+(?:['’-][A-Za-zÀ-ÖØ-öø-ž]+)*")
_DIGIT = re.compile(r"\d")
_SYMBOL = re.compile(r"[^\w\s，。、；：？！“”‘’（）《》,.;:?!\"'()%-]")
_ODD = re.compile("[\x80-ÿ�]")
_STOP = re.compile(r"[。！？!?]|\.(?=\s|$)")
_LINE_END = re.compile(r"[。！？!?；;….]['\"”’）)」』]*$")
_ITEM = re.compile(r"^\s*(?:[-*•·◆■□▪●○※√–—]\s*|[(（]?\d{1,3}[)）.、]\s*|[(（][一二三四五六七八九十]+[)）]|[一二三四五六七八九十]+、|[a-zA-Z][.)]\s|[^，。：:]{1,6}[：:])")
_MARK = re.compile(r"^\s*[(（]?\d{1,3}[)）.、]\s*")
_NUMBER = re.compile(r"^\s*(?:[-–—+]?[\d,.]+%?|[-–—]|N/?A|不适用|不適用)?\s*$")
_NUMBER_CELL = re.compile(r"[-–+]?\d[\d,]*(?:\.\d+)?%?")
_LEADER = re.compile(r"(?:[.·…]\s?){4,}")
_REPEAT = re.compile(r"(\S)\1{3,}")
_LONE = re.compile(r"(?:^|(?<=\s))\S(?=\s|$)")


def _cells(line: str) -> bool:
    """Whether a line is a row of cells: bars, tabs, or values between commas or spaces with numbers among them."""
    if line.count("|") >= 2 or line.count("\t") >= 2:
        return True
    if "。" in line or len(line) > 160:
        return False
    for mark in (",", "，", ";", "  "):
        parts = [p.strip() for p in line.split(mark)]
        if len(parts) >= 3 and all(not p or _NUMBER.match(p) for p in parts[1:]):
            return True
    parts = line.split()
    return len(parts) >= 3 and all(_NUMBER.match(p) for p in parts[-2:])


def pairs_of(text: str, han_runs: list[str] | None = None) -> list[str]:
    """What counts as words where none are marked: neighbouring ideographs; and the words of other scripts."""
    found = [r[i : i + 2] for r in (_HAN_RUN.findall(text) if han_runs is None else han_runs) for i in range(len(r) - 1)]
    return found + [w for w in _LATIN_RUN.findall(text.casefold()) if len(w) > 1]


def in_one_script(text: str, script: dict[int, str]) -> str:
    """A text in its visual form in simplified characters; most texts hold none that would change."""
    return text.translate(script) if script and not text.isascii() and _other_script(len(script), tuple(script)).search(text) else text


@lru_cache(maxsize=2)
def _other_script(n: int, codes: tuple[int, ...]) -> re.Pattern[str]:
    return re.compile("[" + "".join(map(chr, codes)) + "]")


def text_digest(text: str) -> str:
    """What a text is known by in the holdout: equal for texts that look the same."""
    return digest(visual_form(text)).hex()


def statistics(raw: str, common: frozenset[str], script: dict[int, str], form: str | None = None) -> tuple[int, list[float]]:
    """The number of words (each ideograph, each run of letters, each number) and the values of ``FEATURES``; ``form`` is the visual form, if known."""
    text = in_one_script(visual_form(raw) if form is None else form, script)
    n = max(1, len(text) - text.count("\n"))
    han_runs = _HAN_RUN.findall(text)
    words = _LATIN_RUN.findall(text)
    han = sum(map(len, han_runs))
    latin = sum(map(len, words))
    numbers = _NUMBER_CELL.findall(text)
    n_words = han + len(words) + len(numbers)
    pairs = pairs_of(text, han_runs)
    lines = [s for s in text.split("\n") if s.strip()] or [""]
    sizes = [len(s) for s in lines]
    total = max(1, sum(sizes))
    item = cell = noise = short = number = first = ended = 0
    for s, k in zip(lines, sizes, strict=True):
        stop = _STOP.search(s)
        ended += bool(_LINE_END.search(s.rstrip()))
        first += k if s.lstrip()[:1] in "。，、；：%" else 0
        number += bool(_NUMBER.match(s))
        cell += k if _cells(s) or _NUMBER.match(s) else 0
        item += k if _ITEM.match(s) and k <= 80 and s.count("。") < 2 else 0
        noise += k if len(_SYMBOL.findall(s)) + len(_ODD.findall(s)) > 0.4 * k or _LEADER.search(s) else 0
        short += k if k <= 30 and not stop else 0
    bare = [_MARK.sub("", s) for s in lines]
    flat = "".join(bare) if han > latin else " ".join(bare)
    spans = [len(p) for p in _STOP.split(flat)]
    in_sentence = sum(p for p in spans[:-1] if 10 <= p <= 400)
    tokens = text.split()
    return n_words, [
        (han + latin + sum(map(len, numbers))) / max(1, n_words),
        (han + latin) / max(1, len(han_runs) + len(words)),
        len(_SYMBOL.findall(text)) / n,
        ended / len(lines),
        sum(map(common.__contains__, pairs)) / max(1, han + len(words)),
        len(_DIGIT.findall(text)) / n,
        han / n,
        latin / n,
        len(_ODD.findall(text)) / n,
        100 * (len(spans) - 1) / n,
        item / total,
        cell / total,
        noise / total,
        short / total,
        float(np.log1p(np.median(sizes))),
        100 * text.count("、") / n,
        sum(len(m.group()) for m in _LEADER.finditer(text)) / n,
        len(_LONE.findall(text)) / max(1, len(tokens)),
        sum(len(m.group()) for m in _REPEAT.finditer(text)) / n,
        in_sentence / max(1, len(flat)),
        100 * (text.count("，") + text.count(",")) / n,
        number / len(lines),
        first / total,
    ]


def weak_label(f: dict[str, float]) -> str | None:
    """A kind where the structure leaves little doubt, else None."""
    if f["noise_share"] > 0.6 or f["odd_share"] > 0.25 or f["leader_share"] > 0.25:
        return "junk"
    if f["cell_share"] > 0.7:
        return "table"
    if f["common_share"] < 0.2 and f["cell_share"] < 0.2 and f["item_share"] < 0.3 and (f["stop_first"] > 0.2 or f["repeat_share"] > 0.1 or f["lone_share"] > 0.5):
        return "junk"
    if f["sentence_share"] < 0.35 and (f["item_share"] > 0.6 or (f["short_share"] > 0.8 and f["common_share"] > 0.2) or f["listing"] > 4):
        return "list"
    if f["sentence_share"] > 0.8 and f["common_share"] > 0.45 and f["cell_share"] < 0.15 and f["item_share"] < 0.35 and f["noise_share"] < 0.1:
        return "prose"
    return None


def structural_junk(texts: list[str], seed: int = 7) -> list[tuple[str, str]]:
    """Lists, tables and junk made from the sentences of prose, so that every kind is in the training rows of any corpus."""
    rnd = random.Random(seed)
    out: list[tuple[str, str]] = []
    for t in texts:
        sentences = [s for s in re.split(r"(?<=[。.!?])\s*", visual_form(t)) if len(s) > 12]
        if len(sentences) < 4:
            continue
        opening = rnd.choice(sentences) + "\n" if rnd.random() < 0.5 else ""
        short = [re.split("[，,]", s)[0].rstrip("。.")[:24] for s in sentences] * 3
        figures = [f"{rnd.random() * 9000:.2f}" if rnd.random() < 0.9 else rnd.choice(["", "–", "N/A"]) for _ in range(90)]
        marks = rnd.choice([["- "] * 99, ["• "] * 99, [f"{i}. " for i in range(1, 99)], [f"（{i}）" for i in range(1, 99)], [""] * 99])
        out.append(("list", opening + "\n".join(m + s for m, s in zip(marks, short, strict=False))))
        comma, label = (", ", 24) if "".join(sentences).isascii() else ("、", 8)
        out.append(("list", opening + "\n".join(comma.join(short[i : i + 5]) for i in range(0, len(short) - 4, 5))))
        sep = rnd.choice([" | ", ",", "\t", "\n"])
        rows = [[short[i][:label], *figures[3 * i : 3 * i + 3]] for i in range(min(len(short), 30))]
        edge = ("| ", " |") if sep == " | " else ("", "")
        out.append(("table", opening + "\n".join(edge[0] + sep.join(r) + edge[1] for r in rows)))
        mixed = list(" ".join("".join(sentences)))
        rnd.shuffle(mixed)
        broken = "".join(sentences[:6]).encode().decode("latin-1")
        backwards = "\n".join(s[::-1] + "?" * 2 + "�" * rnd.randint(2, 8) for s in sentences)
        signs = "\n".join("".join(rnd.choice("#§@¤*…■\\=※□—·+_~|^°◆/") for _ in range(rnd.randint(15, 40))) for _ in range(12))
        letters = "\n".join(rnd.choice(short)[:1] * rnd.randint(5, 12) + "".join(rnd.choice("ABCxyz01%& ") for _ in range(18)) for _ in range(12))
        dots = "\n".join(s[:14] + "." * rnd.randint(12, 40) + str(rnd.randint(1, 200)) for s in short[:14])
        for j in (broken, backwards, signs, dots, "".join(mixed), "\n".join("".join(sentences)[:160]), letters, letters + "\n" + backwards):
            out.append(("junk", opening + j))
    return out


def common_words(texts: DataFrame, least_share: float = 5e-6) -> list[str]:
    """The words (pairs of ideographs, words of other scripts) that make up at least ``least_share`` of all, and occur twice, in lines with stops,
    counted over all texts. There are at most ``1 / least_share`` of them, whatever the corpus. Each task counts its batches first."""
    script = simplified_script(texts.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts: Counter[str] = Counter()
            for t in b.column("text").to_pylist():
                lines = in_one_script(visual_form(t), script).split("\n")
                counts.update(pairs_of("\n".join([s for s in lines if len(s) >= 15 and _STOP.search(s, 12)])))
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    counted = cut(texts.select("text").mapInArrow(count, "word string not null, n long not null").groupBy("word").agg(F.sum("n").alias("n")))
    total = counted.agg(F.sum("n")).first()[0] or 0
    return sorted(r[0] for r in counted.where(F.col("n") >= max(2.0, total * least_share)).select("word").collect())


def _texts(df: DataFrame, text_col: str, id_col: str) -> DataFrame:
    return df.where((F.length(text_col) > 0) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def _statistics(texts: DataFrame, common: frozenset[str], script: dict[int, str]) -> DataFrame:
    sent = texts.sparkSession.sparkContext.broadcast((common, script))  # bounded: see common_words, and one block of characters

    def stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, script = sent.value
        for b in batches:
            forms = [visual_form(t) for t in b.column("text").to_pylist()]
            rows = [statistics(t, common, script, t) for t in forms]
            cols = [b.column("doc_id"), pa.array([digest(t).hex() for t in forms], pa.string()), pa.array([r[0] for r in rows], pa.int32())]
            cols += [pa.array([r[1][j] for r in rows], pa.float64()) for j in range(len(FEATURES))]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "text_id", "n_words", *FEATURES])

    return texts.mapInArrow(stats, _STAT).distinct()


def quality_statistics(df: DataFrame, text_col: str = "mtext", id_col: str = "doc_id", least_share: float = 5e-6) -> DataFrame:
    """``doc_id, text_id, n_words`` and ``FEATURES`` of each non-empty text; a row repeated (a record delivered twice) gives one row.

    Null and empty texts and rows without id give none; a text of blanks only has zero shares; an empty table gives an empty result.
    """
    texts = _texts(df, text_col, id_col)
    return _statistics(texts, frozenset(common_words(texts, least_share)), simplified_script(df.sparkSession))


@lru_cache(maxsize=1)
def holdout() -> list[dict]:
    """The hand-checked records: where each stands (``table, doc_id``), its ``text_id``, ``kind``, statistics ``x``, and its ``use``: ``calibrate``, or
    ``test`` for those that nothing but the tests look at."""
    return json.loads((Path(__file__).parent / "quality_holdout.json").read_text("utf-8"))


def checked(use: str) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and kinds of the holdout's records of a use."""
    rows = [r for r in holdout() if r["use"] == use]
    return np.array([r["x"] for r in rows], float), np.array([KINDS.index(r["kind"]) for r in rows])


class QualityModel:
    """Trees one against the rest, each with its calibration."""

    def __init__(self, x: np.ndarray, y: np.ndarray, checked: tuple[np.ndarray, np.ndarray] | None = None):
        self.trees = [BoostedTrees().fit(x, (y == k).astype(float)) for k in range(len(KINDS))]
        cx, cy = checked if checked is not None else (x, y)
        self.calibration = [platt(t.score(cx), (cy == k).astype(float)) for k, t in enumerate(self.trees)]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        p = np.stack([1 / (1 + np.exp(-np.clip(a * t.score(x) + b, -30, 30))) for t, (a, b) in zip(self.trees, self.calibration, strict=True)], 1)
        return p / p.sum(1, keepdims=True)


def training_rows(texts: DataFrame, stats: DataFrame, common: frozenset[str], script: dict[int, str], train_rows: int = 2000, made_rows: int = 150) -> list[tuple[str, list[float]]]:
    """Weak label and statistics of about ``train_rows`` records (those with the smallest hashes of their ids), and of junk made from about
    ``made_rows`` texts of prose. The holdout's records, and texts that look like one of them, are no training rows. Texts are read and junk is
    made on the executors."""
    held_ids, held_texts = sorted({r["doc_id"] for r in holdout()}), sorted({r["text_id"] for r in holdout()})
    n = max(1, stats.count())

    def first(df: DataFrame, rows: int) -> DataFrame:
        bound = min(2**63 - 1, int(2**64 * rows / n) - 2**63)
        return df.where((F.xxhash64("doc_id") <= F.lit(bound)) & ~F.col("doc_id").isin(held_ids))

    sample = first(stats, train_rows).where(~F.col("text_id").isin(held_texts)).select(*FEATURES).limit(2 * train_rows).collect()
    rows = [(label, list(r)) for r in sample if (label := weak_label(r.asDict()))]
    sent = texts.sparkSession.sparkContext.broadcast((common, script))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, script = sent.value
        for b in batches:
            made = []
            for doc_id, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                f = statistics(t, common, script)[1]
                if text_digest(t) not in held_texts and weak_label(dict(zip(FEATURES, f, strict=True))) == "prose":
                    made += [(label, statistics(j, common, script)[1]) for label, j in structural_junk([t], seed=doc_id)]
            yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.list_(pa.float64()))], ["label", "x"])

    made = first(texts, 2 * made_rows).distinct().mapInArrow(make, "label string, x array<double>").collect()
    return sorted(rows + [(r[0], list(r[1])) for r in made])


def train(rows: list[tuple[str, list[float]]]) -> QualityModel:
    """A model from training rows, calibrated on the holdout."""
    if not rows:  # nothing to learn from: the hand-checked rows alone
        return QualityModel(*checked("calibrate"), checked("calibrate"))
    return QualityModel(np.array([x for _, x in rows], float), np.array([KINDS.index(k) for k, _ in rows]), checked("calibrate"))


def quality_kinds(df: DataFrame, text_col: str = "mtext", id_col: str = "doc_id", least_share: float = 5e-6, train_rows: int = 2000) -> DataFrame:
    """``doc_id, text_id, n_words``, ``FEATURES``, ``p_prose`` and ``kind`` of each non-empty text (distinct rows); see ``quality_statistics``."""
    texts = _texts(df, text_col, id_col)
    common = frozenset(common_words(texts, least_share))
    script = simplified_script(df.sparkSession)
    stats = cut(_statistics(texts, common, script))  # some numbers a text
    sent = df.sparkSession.sparkContext.broadcast(train(training_rows(texts, stats, common, script, train_rows)))  # trees of a fixed size

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for b in batches:
            x = np.stack([b.column(f).to_numpy() for f in FEATURES], 1)
            p = model.probabilities(x)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p[:, 0]), pa.array([KINDS[k] for k in p.argmax(1)], pa.string())], [*b.schema.names, "p_prose", "kind"])

    return stats.mapInArrow(judge, _STAT + ", p_prose double not null, kind string not null")


def not_prose(df: DataFrame, text_col: str = "mtext", id_col: str = "doc_id", **options: int) -> DataFrame:
    """``doc_id, kind`` of the records whose text isn't prose."""
    return quality_kinds(df, text_col, id_col, **options).where("kind <> 'prose'").select("doc_id", "kind").distinct()
