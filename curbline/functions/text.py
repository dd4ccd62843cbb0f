"""Strict parsing of untrusted text; a value that does not parse becomes null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# All characters that Python's str.strip() removes.
BLANKS = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())

_PLAIN = r"^[-+.0-9eE]+$"
_GROUPED = r"^[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?$"


_NOTHING_TO_STRIP = r"^[!-~]([ -~]*[!-~])?$"


def strip(text: Column) -> Column:
    """Remove every kind of blank from both ends; most text has none, which is told faster."""
    return F.when(text.rlike(_NOTHING_TO_STRIP), text).otherwise(F.btrim(text, F.lit(BLANKS)))


def number(stripped: Column) -> Column:
    """Stripped text to double. Shuts out spellings only the JVM takes, such as ``1.5d``;
    single underscores between digits are allowed, as in Python.

    ``inf`` and ``nan`` come out as null: no coordinate range admits them.
    """
    return F.when(stripped.rlike(_PLAIN), stripped.try_cast("double")).when(
        stripped.rlike(_GROUPED), F.translate(stripped, "_", "").try_cast("double")
    )


def shortest_float_text(stripped: Column, value: Column) -> Column:
    """The shortest decimal text that reads back as ``value``, laid out as in Python.

    Up to 15 digits the source text itself is that number, so zeros are trimmed from its
    exact decimal; longer text goes through the JVM's own double formatting.
    """
    digits = F.length(F.regexp_replace(stripped, r"\D", ""))
    has_exponent = F.contains(F.lower(stripped), F.lit("e"))
    from_text = _without_end_zeros(F.translate(stripped, "_", "").try_cast("decimal(38,20)"))
    jvm = value.cast("string")
    exponent = F.regexp_replace(F.regexp_replace(jvm, r"\.0E", "E"), r"E-(\d)$", "E-0$1")
    return (
        F.when(value == 0, jvm)
        .when(F.abs(value) < 1e-4, F.lower(exponent))
        .when((digits <= 15) & ~has_exponent, from_text)
        .when(F.abs(value) < 1e-3, _without_end_zeros(value.cast("decimal(38,30)")))
        .otherwise(jvm)
    )


def _without_end_zeros(decimal: Column) -> Column:
    return F.regexp_replace(F.rtrim(decimal.cast("string"), F.lit("0")), r"\.$", ".0")
