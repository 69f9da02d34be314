"""Text measures and display formats."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldledger import fixed_values as fv
from fieldledger.functions.casts import strip

_WORD = r"(?U)[^\s\x1c-\x1f]++"
_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{IsTitlecase}"


def word_count(text: Column) -> Column:
    """Number of words between Unicode white space; 0 for empty text."""
    return F.regexp_count(text, F.lit(_WORD))


def title_case(text: Column) -> Column:
    """Capital after every character without case, small letters elsewhere (`Bombing/Explosion`)."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(f"[{_CASED}]+|[^{_CASED}]+"), 0)
    return F.array_join(F.transform(runs, F.initcap), "")


def label_of(output: Column, open_mark: str = fv.LABEL_OPEN, close_mark: str = fv.LABEL_CLOSE) -> Column:
    """Label in the first line: after the first open mark, up to the close mark.

    NULL where the line has no open mark.
    """
    line = F.substring_index(output, "\n", 1)
    rest = F.get(F.split(line, rf"\Q{open_mark}\E", 2), F.lit(1))
    return title_case(strip(F.substring_index(rest, close_mark, 1)))


def thousands(number: Column) -> Column:
    """Whole number with thousands separators (`107,464`)."""
    return F.format_number(number, 0)


def whole_percent(part: Column, whole: Column) -> Column:
    """`part` of `whole` as a percentage rounded half to even (`12%`)."""
    share = F.bround(100 * part / whole, 0).cast("bigint")
    return F.concat(share.cast("string"), F.lit("%"))


def nonblank(text: Column) -> Column:
    """True where the text has a character other than white space."""
    return text.rlike(r"(?U)[^\s\x1c-\x1f]")
