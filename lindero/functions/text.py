"""Text, number and hash expressions with explicit rules for blanks.

White space is Unicode white space (``(?U)``), so a no-break space counts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once. Without it every use of the value would repeat its expression, and a
    chain of such uses would grow the plan exponentially."""
    return F.element_at(F.transform(F.array(value), body), 1)


def squeezed(c: Column) -> Column:
    """Runs of white space as one space, ends trimmed; null stays null."""
    return F.trim(F.regexp_replace(c.cast("string"), r"(?U)\s+", " "))


def clean(c: Column) -> Column:
    """:func:`squeezed`, null as the empty string."""
    return F.coalesce(squeezed(c), F.lit(""))


def filled(c: Column) -> Column:
    """Null for an empty string, so that ``coalesce`` passes over it."""
    return F.nullif(c, F.lit(""))


def compact(c: Column) -> Column:
    """:func:`squeezed`, null if nothing is left."""
    return filled(squeezed(c))


def first_filled(*columns: Column) -> Column:
    return F.coalesce(*map(filled, columns))


def number_or_null(c: Column) -> Column:
    """A finite decimal number in text, else null. Signs, exponents and surrounding white space are allowed."""
    text = F.regexp_replace(c.cast("string"), r"(?U)^\s+|\s+$", "")
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def whole_or_null(c: Column) -> Column:
    """:func:`number_or_null` cut toward zero; null outside of the range of int."""
    value = number_or_null(c)
    return F.when(F.abs(value) < 2147483648.0, value.cast("long").cast("int"))


def number_text(c: Column) -> Column:
    """A double as the shortest text with a decimal mark (``130000.0``), plain up to 16 digits."""
    whole = (c == F.floor(c)) & (F.abs(c) < 1e16)
    return F.when(whole, F.concat(F.format_string("%d", c.cast("long")), F.lit(".0"))).otherwise(c.cast("string"))


def short_hash(c: Column) -> Column:
    """The first 16 hexadecimal digits of SHA-256."""
    return F.substring(F.sha2(c, 256), 1, 16)


def unaccented_upper(c: Column) -> Column:
    """Upper case without the accents of western European letters."""
    return F.translate(F.upper(c), "ÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇÝ", "AAAAAAEEEEIIIIOOOOOUUUUNCY")


def filled_count(*columns: Column) -> Column:
    """How many columns are neither null nor empty."""
    return sum((F.when(F.coalesce(c.cast("string"), F.lit("")) != "", 1).otherwise(0) for c in columns), F.lit(0))
