"""Line predicates and text functions as Spark expressions. Every function takes and returns a ``Column``; nothing runs in Python.

Null gives null; an empty line is no case of any predicate.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P


def strip(s: Column) -> Column:
    """Without white space at both ends (all of Unicode's)."""
    return F.regexp_replace(s, f"^[{P.SPACE}]+|[{P.SPACE}]+$", "")


def lines_of(text: Column) -> Column:
    """The lines of a text, at every Unicode line boundary; a final boundary opens no line, and an empty text has none."""
    parts = F.split(text, P.LINE_BREAK, -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)


def han_count(s: Column) -> Column:
    return F.regexp_count(s, F.lit(f"[{P.HAN}]"))


def _any(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, parts)


def is_english(s: Column) -> Column:
    """No ideograph, and two words, or a short line with a word of four letters."""
    words = F.regexp_count(s, F.lit("[A-Za-z]{2,}")) >= 2
    return ~s.rlike(f"[{P.HAN}]") & (words | ((F.length(s) <= 30) & s.rlike("[A-Za-z]{4}")))


def audit_english(s: Column) -> Column:
    """The auditor's rule: no ideograph, and two words of 24 letters together, or a short line with a word of four letters."""
    letters = F.length(F.regexp_replace(s, "[^A-Za-z]", ""))
    many = (F.regexp_count(s, F.lit("[A-Za-z]+")) >= 2) & (letters >= 24)
    return ~s.rlike(f"[{P.HAN}]") & (many | ((F.length(s) <= 30) & s.rlike("[A-Za-z]{4}")))


def is_reversed(s: Column) -> Column:
    """A running head printed backwards."""
    r = F.reverse(s)
    return (F.length(s) <= 40) & (r.contains("有限公司") | (r.rlike(P.REPORT_YEAR) & r.rlike(r"\p{Nd}{3}")))


def audit_reversed(s: Column) -> Column:
    r = F.reverse(s)
    return (F.length(s) <= 40) & (r.contains("有限公司") | r.rlike(r"年[報报]\p{Nd}"))


def is_tripled(s: Column) -> Column:
    """A short line with an ideograph three times in a row."""
    return (F.length(s) <= 30) & s.rlike(f"([{P.HAN}])\\1\\1")


def audit_tripled(s: Column) -> Column:
    return is_tripled(s) & ~s.startswith(">")


def is_interleaved(s: Column) -> Column:
    """A short line that changes between ideographs and letters too often (a logo read letter by letter)."""
    changes = F.regexp_count(s, F.lit(f"(?<=[{P.HAN}])(?=[A-Za-z])|(?<=[A-Za-z])(?=[{P.HAN}])"))
    return (F.length(s) <= 30) & ~s.rlike(r"\p{Nd}") & (changes >= 3) & (changes / F.length(s) >= 0.35)


def is_garbled(s: Column) -> Column:
    return is_reversed(s) | is_tripled(s) | is_interleaved(s)


def furniture_forms(s: Column) -> dict[str, Column]:
    """The forms of page furniture, one named predicate each."""
    forms = {k: s.rlike(v) for k, v in P.FURNITURE.items()}
    forms["report_year"] = s.rlike(P.REPORT_YEAR) & s.rlike(P.YEAR_FIGURES)
    return forms


def is_furniture(s: Column) -> Column:
    return _any(list(furniture_forms(s).values()))


def is_symbol_line(s: Column) -> Column:
    """No ideograph, letter or figure."""
    return ~s.rlike(f"[{P.HAN}0-9A-Za-z]")


def audit_symbol_line(s: Column) -> Column:
    """A line of symbols that Markdown doesn't need."""
    return is_symbol_line(s) & ~_any([s.rlike(p) for p in P.RULE_LINES])


def is_heading(s: Column) -> Column:
    return s.rlike(P.HEAD) & (F.length(s) <= 40) & ~s.rlike(P.NOT_HEAD_END)


def heading_level(s: Column) -> Column:
    """0 for body text, 1 or 2 for a heading."""
    return F.when(is_heading(s), F.when(s.rlike(P.HEAD_TOP), 1).otherwise(2)).otherwise(0)


def without_section_prefix(s: Column) -> Column:
    return F.regexp_replace(s, P.SECTION_PREFIX, "")


def numeral(s: Column) -> Column:
    """The value of a single numeral from 1 to 10, else null."""
    return F.create_map(*[F.lit(x) for i, n in enumerate(P.NUMERALS, 1) for x in (n, i)])[s]


def han_share(s: Column) -> Column:
    """Ideographs by characters that aren't white space."""
    return han_count(s) / F.greatest(F.lit(1), F.length(F.regexp_replace(s, f"[{P.SPACE}]", "")))


def report_year(file_name: Column) -> Column:
    """The first year in a file name, or 0."""
    return F.coalesce(F.nullif(F.regexp_extract(file_name, "([0-9]{4})年", 1), F.lit("")).try_cast("int"), F.lit(0))


def short_company(company: Column) -> Column:
    """A company's folder without its sorting prefix; unchanged where nothing would be left."""
    bare = F.regexp_replace(company, rf"^\p{{Nd}}+[{P.SPACE}]*[_\-{P.SPACE}][{P.SPACE}]*", "")
    return F.coalesce(F.nullif(bare, F.lit("")), company)
