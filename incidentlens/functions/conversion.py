"""Text to typed values. A value that does not fit becomes NULL, never an error."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace and control characters around a number are ignored by Spark's cast.
_BLANK = r"[\x00-\x20\x7f]*"
_DECIMAL_TAIL = rf"^{_BLANK}(?<sign>[+-]?)(?<whole>[0-9]*)[.][0-9]*{_BLANK}$"


def truncating_int(text: Column) -> Column:
    """Text to int the way Spark's non-ANSI cast does it: ``'1004525.9'`` is 1004525.

    Plain integers take the first branch. Only text that is not one (a decimal
    tail, or garbage) reaches the regular expression.
    """
    whole = F.regexp_replace(text, _DECIMAL_TAIL, "${sign}0${whole}")
    return F.coalesce(text.try_cast("int"), whole.try_cast("int"))


def number(text: Column) -> Column:
    return text.try_cast("double")


def us_date(text: Column, pattern: str) -> Column:
    return F.try_to_date(text, pattern)


def without_placeholder(text: Column, placeholder: str) -> Column:
    return F.nullif(text, F.lit(placeholder))
