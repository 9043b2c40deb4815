"""Text cut off by field limits or in transfer.

Per source the histogram of text lengths, in characters and in bytes, is tested for a spike at its maximum (at most fewer texts than the spike
holds may be longer): that is the source's limit. A text whose length lies at the limit is cut if it stops without the end of a sentence. Texts below a limit may have been cut in transfer;
they need stronger evidence: a broken character or a broken tag or entity at the end, or an unfinished sentence in running text.

What is *not* running text is mostly learned from the corpus: last lines that recur within a source (site furniture, signatures) and endings
that short lines of the corpus often have (headings, captions, credits). Both tables are small whatever the corpus, because an entry needs a
fixed share of the rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut
from .textform import visual_form

_END = re.compile(r"(?:[。.!?;；…]|。)[\s\"'”’」』》)\]>]*$")
_CLOSED = re.compile(r"[”\"」』》)\]】]$")
_HAN = re.compile("[㐀-鿿]")
_RESIDUE = re.compile(r"(?:<[^<>\n]{0,24}|&#?\w{0,8};?)$")
_ITEM = re.compile(r"^(?:[-*•·◆■※▪●○]\s|[(（]?\d{1,3}[)）.、]\s?|[(（][一二三四五六七八九十]+[)）]|[一二三四五六七八九十]+、|[|｜])")
_VALUE = re.compile(r"-?\d[\d.,]*%?")
_LABEL = re.compile(r"^[^。，,.!?！？]{1,14}[:：]|^[A-Z][\w ]{1,20}\d*:\s|^[㐀-鿿]{2,4}\s+[㐀-鿿]")
_DATE = re.compile(r"^(?:[12]\d{3}\s?年\d{1,2}月\s?\d{0,2}日?(?:于\S{1,6}|於\S{1,6})?|[A-Z]\w+, [A-Z][a-z]+ (?:\d{1,2}, )?\d{4})$")
_INNER = re.compile(r"[。!?！？](?=\S)|[.!?]\s+(?=[A-Z])|[a-z%]\.\s")
_COMMA = re.compile(r"[，、；：]|,(?!\d)|;")
_YEAR = re.compile(r"(?:19|20)\d\d")
_LETTERS = re.compile(r"[\W\d_]+")
_NO_TITLE = re.compile("[。.!?！？，,；;|\t]")

#: What the last lines of a text say about its end (``n`` null), and how often short lines end in ``ending`` (``n`` of them).
_ENDS = (
    "doc_id long, source string, n_chars int, n_bytes int, text_id long, state string not null, line_key string not null, ending string not null, n long"
)


def _is_row(line: str) -> bool:
    """Whether a line is a row of cells: bars, tabs, or three values at its end."""
    if "|" in line or "\t" in line:
        return True
    parts = line.rsplit(None, 3)
    if len(parts) < 4 or not (_VALUE.fullmatch(parts[3]) and _VALUE.fullmatch(parts[2])):
        return False
    name = parts[1].removesuffix("%")
    return any(c.isdigit() for c in name[len(name.rstrip("0123456789.,")) :])


def _number_dot(line: str) -> bool:
    """Whether a line ends in a number, not a year, with a point: a decimal that was cut."""
    if not line.endswith("."):
        return False
    run = line[:-1]
    number = run[len(run.rstrip("0123456789,")) :].lstrip(",")
    return bool(number) and not _YEAR.fullmatch(number)


def last_lines(text: str) -> list[str]:
    """The last two lines with something visible, whole, in the one visual form."""
    found, end = [], len(text)
    while len(found) < 2 and end >= 0:
        at = text.rfind("\n", 0, end)
        found = [s for s in visual_form(text[at + 1 : end]).split("\n") if s.strip()] + found
        end = at if at >= 0 else -1
    return found[-2:]


def ending_of(line: str) -> str:
    """The last two letters of a line in Chinese script, the last word of another: what recurs in headings, captions and credits."""
    words = _LETTERS.sub(" ", line.casefold()).split()
    if not words:
        return ""
    return words[-1][-2:] if _HAN.search(words[-1]) else words[-1]


def tail_state(text: str) -> tuple[str, str, str]:
    """How a text ends, from its last two lines: ``(state, key of the last line, its ending)``.

    States: ``broken`` (a broken character, tag or entity inside a sentence), ``dots`` (three full stops set as a mark), ``open`` (an
    unfinished sentence after others), ``clause`` (an unfinished first sentence with a comma), ``bare`` (one unfinished line without
    any), ``done`` (anything else).
    """
    raw = text.rstrip()
    cut_char = raw.endswith("�")
    raw = raw.rstrip("�").rstrip()
    residue = _RESIDUE.search(raw)
    if residue:
        raw = raw[: residue.start()].rstrip()
    # An unambiguous "..." is three full stops; a typographic ellipsis is the author's own.
    dots = raw.endswith("...") and not raw.endswith("....")
    lines = last_lines(raw)
    if not lines:
        return "done", "", ""
    last = lines[-1].strip()
    key, ending = _LETTERS.sub("", last.casefold()), ending_of(last)
    broken = cut_char or residue is not None
    if dots:
        last = last.rstrip(".")
        if not last or _END.search(last):
            return "done", key, ending
    elif _END.search(last) and not _number_dot(last) and not (_HAN.search(last) and re.search(r"[0-9A-Za-z]\.$", last)):
        return "done", key, ending
    if _is_row(last) or (_ITEM.match(last) and not re.search("[。!?！？]", last)):
        return "done", key, ending
    # A paragraph broken into lines of fixed width goes on from the line before.
    joined = last
    if len(lines) > 1 and not re.search(r"[。.!?…:;」”)\]>|]\s*$", lines[-2]) and len(lines[-2].strip()) >= 24 and not _is_row(lines[-2]):
        joined = lines[-2].strip() + ("" if _HAN.search(last) else " ") + last
    plain = not (_CLOSED.search(last) or _DATE.match(last) or _LABEL.match(joined) or _LABEL.match(last))
    inner = _INNER.search(joined) is not None
    if dots:
        return ("dots" if inner or plain else "done"), key, ending
    if inner and not _CLOSED.search(last):
        return ("broken" if broken else "open"), key, ending
    if broken and plain:
        return "broken", key, ending
    if not plain:
        return "done", key, ending
    if _COMMA.search(joined):
        return "clause", key, ending
    return ("done" if last.endswith("%") else "bare"), key, ending


def title_endings(text: str, counts: Counter[str], known: dict[str, str]) -> None:
    """Counts the endings of a text's short lines without stop or comma (headings, captions, credits). Short is up to three quarters of the
    text's longest line, so that the lines of a paragraph set to one width don't count."""
    lines = text.split("\n")
    longest = max(map(len, lines))
    for line in lines:
        if line and len(line) * 4 <= longest * 3 and not _NO_TITLE.search(line):
            ending = known.get(line)
            if ending is None:
                ending = known[line] = ending_of(visual_form(line))
            if ending:
                counts[ending] += 1


def text_ends(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """One row per non-empty text with its lengths and the state of its end (``n`` null), and the counts of the endings of short lines (``n`` set,
    counted within each batch): whole texts are read once for both."""
    rows = df.where((F.length(text_col) > 0) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        F.length(text_col).alias("n_chars"),
        F.octet_length(text_col).alias("n_bytes"),
        F.xxhash64(text_col).alias("text_id"),
        F.col(text_col).alias("text"),
    )
    names = ["doc_id", "source", "n_chars", "n_bytes", "text_id", "state", "line_key", "ending", "n"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").to_pylist()
            counts: Counter[str] = Counter()
            known: dict[str, str] = {}
            for t in texts:
                title_endings(t, counts, known)
            ends = [tail_state(t) for t in texts]
            cols = [b.column(c) for c in names[:5]]
            cols += [pa.array([e[i] for e in ends], pa.string()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*cols, pa.nulls(len(ends), pa.int64())], names)
            m = len(counts)
            none = [pa.nulls(m, b.schema.field(c).type) for c in names[:5]]
            blank = pa.array([""] * m, pa.string())
            yield pa.RecordBatch.from_arrays([*none, blank, blank, pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names)

    return rows.mapInArrow(read, _ENDS)


def length_limits(tails: DataFrame, min_texts: int = 3, times: float = 4.0) -> DataFrame:
    """``source, unit, low, high``: the length at which a source's texts pile up at their maximum (``chars`` or ``bytes``).

    In bytes the spike is up to four wide, because a cut character is dropped or replaced. A spike must hold ``min_texts`` different texts,
    ``times`` as many a length as the lengths just below it, and more than lie beyond it, so a few longer texts don't hide a limit; the
    highest such length counts. All counts are exact; a histogram has one row a length, however many texts there are.
    """
    different = tails.select("source", "n_chars", "n_bytes", "text_id").distinct()
    parts = []
    for unit, col, width in (("chars", "n_chars", 1), ("bytes", "n_bytes", 4)):
        lengths = different.groupBy("source", F.col(col).alias("n")).agg(F.count(F.lit(1)).alias("c"))
        along = Window.partitionBy("source").orderBy("n")
        spike = lengths.withColumn("here", F.sum("c").over(along.rangeBetween(1 - width, 0)))
        spike = spike.withColumn("beyond", F.coalesce(F.sum("c").over(Window.partitionBy("source").orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        spike = spike.where((F.col("here") >= min_texts) & (F.col("here") > F.col("beyond")) & (F.col("n") >= 50)).select("source", F.col("n").alias("high"), "here")
        near = spike.join(lengths, "source").where((F.col("n") > F.col("high") * 0.9) & (F.col("n") <= F.col("high")))
        below = F.sum(F.when(F.col("n") <= F.col("high") - width, F.col("c")).otherwise(0))
        stat = near.groupBy("source", "high", "here").agg(below.alias("below"))
        expected = F.col("below") * width / F.greatest(F.lit(1.0), F.col("high") * 0.1)
        best = stat.where(F.col("here") >= times * expected).groupBy("source").agg(F.max("high").alias("high"))
        parts.append(best.select("source", F.lit(unit).alias("unit"), (F.col("high") - width + 1).alias("low"), "high"))
    return parts[0].unionByName(parts[1])


def recurring_endings(ends: DataFrame, n_texts: DataFrame, share: float = 0.001, min_lines: int = 3) -> DataFrame:
    """``ending``: the endings of short lines that occur ``share`` times the number of texts (``n_texts``: one row ``_n``), at least
    ``min_lines`` times. At most some thousand rows, because each needs its share of the lines."""
    counts = ends.where("n is not null").groupBy("ending").agg(F.sum("n").alias("c"))
    counts = counts.crossJoin(F.broadcast(n_texts))  # one row
    return counts.where((F.col("c") >= min_lines) & (F.col("c") >= F.col("_n") * share)).select("ending")


def _truncated(ends: DataFrame, recur_share: float, recur_texts: int, share: float, min_lines: int) -> DataFrame:
    tails = ends.where("n is null")
    limits = length_limits(tails)
    chars = limits.where("unit = 'chars'").select("source", F.col("low").alias("_cl"))
    octets = limits.where("unit = 'bytes'").select("source", F.col("low").alias("_bl"))
    unfinished = tails.where("state <> 'done'").drop("n")
    rows = unfinished.join(chars, "source", "left").join(octets, "source", "left")
    rows = rows.withColumn("at_limit", F.coalesce(F.col("n_chars") >= F.col("_cl"), F.lit(False)) | F.coalesce(F.col("n_bytes") >= F.col("_bl"), F.lit(False)))
    # Last lines that recur within a source, counted over different texts: furniture and signatures.
    per_source = tails.groupBy("source").agg(F.count(F.lit(1)).alias("_n"))
    recur = (
        unfinished.groupBy("source", "line_key")
        .agg(F.count_distinct("text_id").alias("_c"))
        .join(per_source, "source")
        .where((F.col("_c") >= recur_texts) & (F.col("_c") >= F.col("_n") * recur_share))
        .select("source", "line_key")
    )
    rows = rows.join(recur, ["source", "line_key"], "left_anti")
    # And those that recur over all sources, where each has few.
    total = tails.agg(F.count(F.lit(1)).alias("_n"))
    anywhere = unfinished.where(F.length("line_key") >= 4).groupBy("line_key").agg(F.count_distinct("text_id").alias("_c"))
    usual = anywhere.crossJoin(F.broadcast(total)).where((F.col("_c") >= recur_texts) & (F.col("_c") >= F.col("_n") * share))  # one row
    rows = rows.join(usual.select("line_key"), "line_key", "left_anti")
    common = recurring_endings(ends, total, share, min_lines).withColumn("_known", F.lit(True))
    rows = rows.join(common, "ending", "left")
    known = F.coalesce("_known", F.lit(False))
    state, at = F.col("state"), F.col("at_limit")
    cut_here = (
        state.isin("broken", "open")
        | ((state == "dots") & at)
        | ((state == "clause") & (at | ~known))
        | ((state == "bare") & ~known)
    )
    return rows.where(cut_here).select("doc_id", "source", "n_chars", "n_bytes", "state", "at_limit").distinct()


def truncated_texts(
    df: DataFrame, text_col: str = "text", id_col: str = "doc_id", source_col: str = "source", recur_share: float = 0.01, recur_texts: int = 3, share: float = 0.001, min_lines: int = 3
) -> DataFrame:
    """``doc_id, source, n_chars, n_bytes, state, at_limit`` of the texts that were cut (distinct).

    Null and empty texts and rows without id are no texts; a null source has no limit of its own but its texts are still judged by their
    ends; an empty table gives an empty result; ties in length are all at the limit.
    """
    ends = cut(text_ends(df, text_col, id_col, source_col))  # narrow rows, read once for each statistic
    return _truncated(ends, recur_share, recur_texts, share, min_lines)


def truncation_by_source(
    df: DataFrame, text_col: str = "text", id_col: str = "doc_id", source_col: str = "source", recur_share: float = 0.01, recur_texts: int = 3, share: float = 0.001, min_lines: int = 3
) -> DataFrame:
    """``source, n_texts, n_cut, cut_share``: how often each source truncates, over its non-empty texts."""
    ends = cut(text_ends(df, text_col, id_col, source_col))
    n = ends.where("n is null").groupBy("source").agg(F.count_distinct("doc_id").alias("n_texts"))
    cuts = _truncated(ends, recur_share, recur_texts, share, min_lines).groupBy("source").agg(F.count_distinct("doc_id").alias("n_cut"))
    out = n.join(cuts, n["source"].eqNullSafe(cuts["source"]), "left").select(n["source"], "n_texts", F.coalesce("n_cut", F.lit(0)).alias("n_cut"))
    return out.withColumn("cut_share", F.col("n_cut") / F.col("n_texts"))
