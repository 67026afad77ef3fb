"""Text and code normalisation, number parsing and period labels."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

UNKNOWN = "DESCONOCIDO"

# Everything that counts as white space at the ends of a raw cell, not only the blank.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def stripped(text: Column) -> Column:
    """Text without leading and trailing white space of any kind; NULL stays NULL."""
    return F.btrim(text, F.lit(WHITESPACE))


def stringify(frame: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The named columns, in that order, as stripped text; NULL and NaN become NULL."""
    types = {f.name.lower(): f.dataType for f in frame.schema}

    def cell(name: str) -> Column:
        value = F.col(name)
        if isinstance(types[name.lower()], (T.DoubleType, T.FloatType)):
            value = F.when(~F.isnan(value), value)
        return stripped(value.cast("string")).alias(name)

    return frame.select(*[cell(c) for c in columns])


def normalize_code(code: Column) -> Column:
    """``' 2.00 '`` -> ``'2'``: trims and drops a trailing point with any number of zeros.

    Codes without a point, nearly all of them, skip the regular expression.
    """
    trimmed = F.trim(code)
    return F.when(F.contains(trimmed, F.lit(".")), F.regexp_replace(trimmed, r"\.0+$", "")).otherwise(trimmed)


def dictionary_code(code: Column) -> Column:
    """Cleaner for code-list cells: NULL -> ``''``, trims, drops one trailing ``.0`` only."""
    return F.regexp_replace(stripped(F.coalesce(code.cast("string"), F.lit(""))), r"\.0$", "")


def to_number(text: Column) -> Column:
    """Text -> double; what is not a number becomes NULL (also with ANSI mode on).

    A blank is sorted out first: as a failed cast it would cost eighty times a good one,
    and blanks are the common case in a survey. The type suffix that a cast would take, as
    in ``12d``, is no number either; only cells that end in such a letter are looked at twice.
    """
    trimmed = F.trim(text)
    suffixed = F.lower(F.right(trimmed, F.lit(1))).isin("d", "f") & trimmed.rlike("[0-9.][dDfF]$")
    return F.when((F.length(trimmed) > 0) & ~suffixed, text.try_cast("double"))


def is_blank(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "")


def is_finite(value: Column) -> Column:
    """False, never NULL, for NULL, NaN and both infinities."""
    # NaN sorts above infinity in Spark, so one comparison rules out both.
    return F.coalesce(F.abs(value) < F.lit(float("inf")), F.lit(False))


def is_invalid_number(text: Column, value: Column) -> Column:
    """The cell holds something, but not a finite number."""
    return text.isNotNull() & (F.trim(text) != "") & ~is_finite(value)


def is_whole(value: Column) -> Column:
    return value == F.floor(value)


def recode(code: Column, allowed: Iterable[str], unknown: str = UNKNOWN) -> Column:
    """Keep allowed codes; anything else, NULL and blank included, becomes ``unknown``."""
    return F.when(code.isin(*allowed), code).otherwise(F.lit(unknown))


def period_label(year: Column, quarter: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("T"), quarter.cast("string"))


def period_year(label: Column) -> Column:
    return F.substring(label, 1, 4).try_cast("int")


def period_quarter(label: Column) -> Column:
    return F.right(label, F.lit(1)).try_cast("int")
