"""Traditional to simplified characters, one for one, from the transliteration rules of the ICU library that Spark ships."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

_SCRIPT: dict[str, dict[int, str]] = {}


def simplified_script(spark: SparkSession) -> dict[int, str]:
    """Code point → simplified character: a few thousand entries at most (the ideographs of the basic block), whatever the data.

    A session without access to its JVM is an error: results would change in silence if text kept its script.
    """
    if "t2s" not in _SCRIPT:
        try:
            rules = spark._jvm.com.ibm.icu.text.Transliterator.getInstance("Traditional-Simplified")
        except Exception as e:
            raise RuntimeError("the table of simplified characters needs a session with access to its JVM") from e
        block = [chr(c) for c in range(0x3400, 0xA000)]
        other = rules.transliterate("\n".join(block)).split("\n")
        _SCRIPT["t2s"] = {ord(a): b for a, b in zip(block, other, strict=True) if a != b and len(b) == 1}
    return _SCRIPT["t2s"]


def to_simplified(s: Column, script: dict[int, str]) -> Column:
    """``s`` in simplified characters; phrase rules are not applied. Unchanged with an empty table, and the same when applied twice."""
    if not script:
        return s
    return F.translate(s, "".join(map(chr, script)), "".join(script.values()))
