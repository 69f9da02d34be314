"""Lenient casts that never throw, whether ANSI mode is on or off."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldledger import fixed_values as fv

_PLAIN_DECIMAL = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)\s*$"
_INT_LIMIT = 2147483648


def lenient_year(text: Column) -> Column:
    """Integer of a plain decimal string, cut toward zero; NULL for anything else.

    `'1970.5'` is 1970 as it is in a non-ANSI cast; exponents and values beyond
    an int are NULL.
    """
    number = text.try_cast("double")
    fits = text.rlike(_PLAIN_DECIMAL) & (F.abs(number) < _INT_LIMIT)
    # Whole numbers, which most are, never reach the pattern.
    return F.coalesce(text.try_cast("int"), F.when(fits, number.try_cast("int")))


def double_or_zero(text: Column) -> Column:
    """Double of a string; 0.0 where it is missing or does not parse."""
    return F.coalesce(text.try_cast("double"), F.lit(0.0))


def whole_count(number: Column) -> Column:
    """Whole part toward zero of a number or numeric string; 0 where there is none.

    NaN and the infinities have no whole part and count as 0.
    """
    return F.coalesce(number.try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint"))


def year_prefix(date_text: Column) -> Column:
    """Year of a `YYYYMMDD` string; NULL where the first four characters are no number."""
    return F.substring(date_text, 1, 4).try_cast("int")


def normalise_code(code: Column) -> Column:
    """Trimmed upper-case code; NULL stays NULL."""
    return F.upper(strip(code))


def strip(text: Column) -> Column:
    """Text without the Unicode white space at both ends."""
    return F.btrim(text, F.lit(fv.WHITE_SPACE))
