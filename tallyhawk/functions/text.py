"""Text clean-up and formatting as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


# Fixed value: every character that counts as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip_space(c: Column) -> Column:
    """Remove every kind of white space at both ends, not blanks alone."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def zero_pad(c: Column, width: int) -> Column:
    """Pad with zeros on the left and never shorten."""
    text = c.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def whole_number_code(c: Column, width: int) -> Column:
    """A code that was read as a float, as padded text; null stays null."""
    return zero_pad(c.cast("bigint"), width)


def percent(c: Column, digits: int = 3) -> Column:
    # Ties go to the even digit.
    return F.format_string(f"%.{digits}f%%", F.bround(c * 100, digits))


def money(c: Column) -> Column:
    return F.format_string("%.2f", F.bround(c, 2))


def thousands(c: Column) -> Column:
    return F.format_number(c, 0)


def title_words(c: Column) -> Column:
    """An identifier as a heading: underscores to blanks, words capitalised."""
    return F.initcap(F.replace(c, F.lit("_"), F.lit(" ")))


def plain_number(c: Column, digits: int) -> Column:
    """A fraction as text without exponent, zeros at the end removed but one."""
    text = c.try_cast(f"decimal(38,{digits})").cast("string")
    return F.coalesce(F.regexp_replace(text, r"(\.\d+?)0+$", "$1"), c.cast("string"))
