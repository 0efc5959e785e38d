"""Text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Unicode counts as white space.
WHITE_SPACE = (
    "\t\n\u000b\u000c\r \u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(value: Column) -> Column:
    """Without white space at both ends (``trim`` would take off blanks only)."""
    return F.btrim(value.cast("string"), F.lit(WHITE_SPACE))


def titlecase(value: Column) -> Column:
    """First letter of each word upper case, the rest lower; blanks separate words."""
    return F.initcap(value)


def zero_fill(value: Column, width: int) -> Column:
    """Left-pad with zeros after a sign, if any; longer values stay whole."""
    sign = F.when(value.rlike("^[+-]"), F.left(value, F.lit(1))).otherwise(F.lit(""))
    digits = F.substring(value, F.length(sign) + 1, F.length(value))
    padded = F.concat(sign, F.lpad(digits, F.lit(width) - F.length(sign), F.lit("0")))
    return F.when(F.length(value) < width, padded).otherwise(value)
