"""Prices, surfaces and room counts in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import filled, let, number_or_null

_CURRENCY = r"(?:€|eur|euro|euros|\$|usd|£|gbp)"
PRICE = rf"(?iU){_CURRENCY}\s*(\d[\d.,\s]+)|(\d[\d.,\s]+)\s*{_CURRENCY}"
PLAIN = r"(?U)\d[\d.,\s]+"
SURFACE = r"(?iU)(\d[\d.,\s]*)\s?(?:m2|m²|metros\s?cuadrados|metros?)"
ROOMS = r"(?iU)\b(\d{1,2})\s?(?:hab(?:itaciones)?\.?|dormitorios|rooms?)\b"


def to_number(text: Column) -> Column:
    """A number whose decimal mark is guessed: of comma and dot the later one; a lone comma if one or two digits follow
    the last; dots mark thousands if every group behind the first has three digits. Else null."""
    return let(F.replace(F.regexp_replace(text, r"(?U)^\s+|\s+$", ""), F.lit(" "), F.lit("")), _guessed)


def _guessed(v: Column) -> Column:
    comma, dot = F.length(v) - F.locate(",", F.reverse(v)), F.length(v) - F.locate(".", F.reverse(v))
    has_comma, has_dot = F.contains(v, F.lit(",")), F.contains(v, F.lit("."))
    decimal_comma = F.replace(F.replace(v, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    no_comma = F.replace(v, F.lit(","), F.lit(""))
    plain = (
        F.when(has_comma & has_dot, F.when(comma > dot, decimal_comma).otherwise(no_comma))
        .when(has_comma, F.when(F.length(F.substring_index(v, ",", -1)).isin(1, 2), F.replace(v, F.lit(","), F.lit("."))).otherwise(no_comma))
        .when(has_dot & v.rlike(r"^[^.]*(\.[^.]{3})+$"), F.replace(v, F.lit("."), F.lit("")))
        .otherwise(v)
    )
    return let(plain, number_or_null)


def price_number(source: Column, plain: bool) -> Column:
    """The first number next to a currency, final even if it is none; with ``plain`` else the first one of three digits."""
    return let(source, lambda x: _price_in(x, plain))


def _price_in(source: Column, plain: bool) -> Column:
    beside = to_number(F.coalesce(filled(F.regexp_extract(source, PRICE, 1)), filled(F.regexp_extract(source, PRICE, 2))))
    if not plain:
        return F.when(source.rlike(PRICE), beside)
    tokens = F.filter(F.regexp_extract_all(source, F.lit(PLAIN), 0), lambda t: F.length(F.regexp_replace(t, r"(?U)\D", "")) >= 3)
    values = F.filter(F.transform(tokens, to_number), lambda x: x.isNotNull())
    return F.when(source.rlike(PRICE), beside).otherwise(F.try_element_at(values, F.lit(1)))


def _joined(text: Column, fallback: Column | None) -> Column:
    return F.concat_ws(" ", filled(text), filled(fallback if fallback is not None else F.lit(None).cast("string")))


def price(text: Column, fallback: Column | None = None) -> Column:
    """struct(value, currency): the value from ``text``, else the fallback; the currency from both (EUR before USD
    before GBP, also within words)."""
    currency = let(_joined(text, fallback), _currency_of)
    value = price_number(filled(text), True)
    if fallback is not None:
        value = F.coalesce(value, price_number(filled(fallback), False))
    return F.struct(value.alias("value"), currency.alias("currency"))


def _currency_of(source: Column) -> Column:
    low = F.lower(source)
    return F.when(F.contains(source, F.lit("€")) | F.contains(low, F.lit("eur")), F.lit("EUR")).when(F.contains(source, F.lit("$")) | F.contains(low, F.lit("usd")), F.lit("USD")).when(F.contains(source, F.lit("£")) | F.contains(low, F.lit("gbp")), F.lit("GBP"))


def surface(text: Column, fallback: Column | None = None) -> Column:
    return to_number(filled(F.regexp_extract(_joined(text, fallback), SURFACE, 1)))


def rooms(text: Column, fallback: Column | None = None) -> Column:
    return filled(F.regexp_extract(_joined(text, fallback), ROOMS, 1)).try_cast("int")


def listed_surface(text: Column) -> Column:
    """Whole square metres as the older listings write them: dots mark thousands, a comma decimals (which are cut)."""
    number = r"(?i)(\d{1,3}(?:[.,]\d{3})+|\d+(?:[.,]\d+)?)\s*"
    s = F.replace(text, F.lit(" "), F.lit(" "))
    raw = F.coalesce(filled(F.regexp_extract(s, number + "m²", 1)), filled(F.regexp_extract(s, number + "m2", 1)))
    return F.floor(F.replace(F.replace(raw, F.lit("."), F.lit("")), F.lit(","), F.lit(".")).try_cast("double")).cast("int")


def listed_price(text: Column, m2: Column) -> Column:
    """struct(price, unit_price, m2) of a block of text; the unit price where both are there and not zero."""
    raw = filled(F.regexp_extract(F.replace(text, F.lit(" "), F.lit(" ")), r"(\d{1,3}(?:\.\d{3})*(?:,\d{1,2})?)\s*€", 1))
    value = F.replace(F.replace(raw, F.lit("."), F.lit("")), F.lit(","), F.lit(".")).try_cast("double")
    return F.struct(value.alias("price"), F.when((value != 0) & (m2 != 0), value / m2).alias("unit_price"), m2.alias("m2"))
