"""Typed columns out of text: dates, small integers, amounts.

Every cast is a ``try_`` form: bad text becomes null and is counted later by
``operators.quality.cast_failures`` instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts read as missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Characters of a decimal number; keeps out "NaN" and JVM-only spellings such as "1d".
NUMBER_CHARACTERS = "0123456789+-.eE \t"
DIGITS = "0123456789"
DATE_LENGTH = 8


def missing_to_null(text: Column) -> Column:
    return F.when(~text.isin(*NA_TOKENS), text)


def parse_date(text: Column) -> Column:
    """``yyyyMMdd`` text to DATE; anything else is null."""
    digits_only = (F.length(text) == DATE_LENGTH) & (F.translate(text, DIGITS, "") == "")
    return F.when(digits_only, F.try_to_date(text, "yyyyMMdd"))


def to_float(text: Column) -> Column:
    """Finite decimal text to double; the cast itself checks the grammar."""
    return F.when(F.translate(text, NUMBER_CHARACTERS, "") == "", text.try_cast("double"))


def whole_small_int(number: Column) -> Column:
    """Whole numbers in the 16-bit range; null otherwise."""
    return F.when(number == F.floor(number), number.try_cast("smallint")).cast("int")


def to_small_int(text: Column) -> Column:
    """Text to a 16-bit whole number; ``"1.0"`` is accepted, ``"1.5"`` is null."""
    return whole_small_int(to_float(text))


def _apply(df: DataFrame, cols, convert) -> DataFrame:
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: convert(F.col(c)) for c in present}) if present else df


def missing_texts_to_null(df: DataFrame) -> DataFrame:
    return _apply(df, [n for n, t in df.dtypes if t == "string"], missing_to_null)


def parse_dates(df: DataFrame, cols) -> DataFrame:
    return _apply(df, cols, parse_date)


def coerce_ints(df: DataFrame, cols) -> DataFrame:
    """In two projections, so that each text is converted once and then checked."""
    return _apply(_apply(df, cols, to_float), cols, whole_small_int)


def coerce_floats(df: DataFrame, cols) -> DataFrame:
    return _apply(df, cols, to_float)
