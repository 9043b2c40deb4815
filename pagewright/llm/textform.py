"""One consistent form of text: the character work that several operators of this subpackage share.

All functions are plain Python over whole strings, so a caller can apply them to the distinct values of an Arrow batch. They use C-level
string operations only (regular expressions, ``translate``, ``normalize``), never a loop over characters.
"""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from ..functions.script import simplified_script  # noqa: F401  (used by the operators)

# The code points with the Unicode property Default_Ignorable_Code_Point.
DEFAULT_IGNORABLE = (
    "­͏؜ᅟᅠ឴឵᠋-᠏​-‏‪-‮⁠-⁯ㅤ︀-️﻿ﾠ"
    "￰-￸\U0001bca0-\U0001bca3\U0001d173-\U0001d17a\U000e0000-\U000e0fff"
)

# Cyrillic and Greek letters and the Latin letters that look like them, pairwise.
CYRILLIC = "АВЕЅІЈКМНОРСТУХаеѕіјорсухһԁԛԝ"
CYRILLIC_LATIN = "ABESIJKMHOPCTYXaesijopcyxhdqw"
GREEK = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαινορυ"
GREEK_LATIN = "ABEZHIKMNOPTYXaivopu"

# CJK Radicals Supplement and the ideographs they look like, in code point order. (Kangxi radicals have compatibility
# mappings of their own.)
RADICALS = (
    "⺁厂 ⺂乛 ⺃乚 ⺄乙 ⺅亻 ⺆冂 ⺇几 ⺈刀 ⺉刂 ⺊卜 ⺋㔾 ⺌小 ⺍小 ⺎兀 ⺏尣 ⺐尢 ⺑尢 ⺒巳 ⺓幺 ⺔彑 ⺕彐 ⺖忄 ⺗㣺 ⺘扌 ⺙攵 ⺛旡 ⺜日 ⺝月 ⺞歺 ⺟母 ⺠民 "
    "⺡氵 ⺢氺 ⺣灬 ⺤爫 ⺥爪 ⺦丬 ⺧牛 ⺨犭 ⺩王 ⺪疋 ⺫罒 ⺬示 ⺭礻 ⺮竹 ⺯糹 ⺰纟 ⺱罓 ⺲罒 ⺳网 ⺴网 ⺵网 ⺶羊 ⺷羊 ⺸羊 ⺹耂 ⺺肀 ⺻聿 ⺼月 ⺽臼 ⺾艹 ⺿艹 "
    "⻀艹 ⻁虎 ⻂衤 ⻃覀 ⻄西 ⻅见 ⻆角 ⻇角 ⻈讠 ⻉贝 ⻊足 ⻋车 ⻌辶 ⻍辶 ⻎辶 ⻏阝 ⻐钅 ⻑長 ⻒镸 ⻓长 ⻔门 ⻕阜 ⻖阝 ⻗雨 ⻘青 ⻙韦 ⻚页 ⻛风 ⻜飞 ⻝食 ⻞食 "
    "⻟飠 ⻠饣 ⻡首 ⻢马 ⻣骨 ⻤鬼 ⻥鱼 ⻦鸟 ⻧卤 ⻨麦 ⻩黄 ⻪黾 ⻫斉 ⻬齐 ⻭歯 ⻮齿 ⻯竜 ⻰龙 ⻱龟 ⻲亀 ⻳龟"
)

LOOKALIKE = str.maketrans(
    CYRILLIC + GREEK + "".join(p[0] for p in RADICALS.split()), CYRILLIC_LATIN + GREEK_LATIN + "".join(p[1] for p in RADICALS.split())
)
_IGNORED = re.compile(f"[{DEFAULT_IGNORABLE}]+")
_ALIKE = re.compile("[Ͱ-ԯ⺀-⻳]")
_ODD_SPACE = re.compile(r"[^\S\n ]")
_BREAK = re.compile("\r\n?|[\x85  ]")
_NOT_LETTER = re.compile(r"(?:[^\w\n]|[\d_])+")
_NOT_WORD = re.compile(r"[\W_]+")


def composed(text: str) -> str:
    """Compatibility-normalised composed form without invisible characters, look-alikes replaced; spaces are left as they came."""
    if text.isascii():
        return text
    text = unicodedata.normalize("NFKC", _IGNORED.sub("", text))
    if _ALIKE.search(text):
        # A look-alike may carry an accent, so letters are taken apart before they are replaced and composed again.
        text = unicodedata.normalize("NFC", unicodedata.normalize("NFKD", text).translate(LOOKALIKE))
    return text


def visual_form(text: str) -> str:
    """The one form of a text: equal for texts that look the same, different where a difference is visible (case included)."""
    text = _BREAK.sub("\n", text)
    return _ODD_SPACE.sub(" ", composed(text))


def fold(form: str) -> str:
    """Full case folding of a text that is in its visual form: a key for comparisons that ignore case."""
    return unicodedata.normalize("NFC", form.casefold())


def folded_form(text: str) -> str:
    """``visual_form`` with full case folding."""
    return fold(visual_form(text))


def letters_form(text: str) -> str:
    """Only the letters, folded; line feeds stay, so lines of the result are the lines of ``text``."""
    return _NOT_LETTER.sub("", composed(text).casefold())


def words_form(text: str, script: dict[int, str] | None = None) -> str:
    """Only letters and digits, folded, in one script if ``script`` maps the characters of another."""
    text = _NOT_WORD.sub("", composed(text).casefold())
    return text.translate(script) if script else text


def digest(text: str) -> bytes:
    """128 bits that stand for a text in shuffles."""
    return xxhash.xxh3_128_digest(text.encode("utf-8", "surrogatepass"))


def per_distinct(column: pa.ChunkedArray | pa.Array, function, kind: pa.DataType) -> pa.Array:
    """``function`` over the distinct non-null values of a column, spread back over its rows. Null stays null."""
    coded = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    coded = pc.dictionary_encode(coded)
    values = pa.array([function(v) for v in coded.dictionary.to_pylist()], kind)
    return values.take(coded.indices)
