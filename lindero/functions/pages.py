"""Expressions over HTML and Markdown that need no tree, and the rules that classify parsed pages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import urls
from .text import compact, filled

_HREF = r"(?i)href=[\"']([^\"']+)[\"']"
_MARKDOWN = r"\[[^\]]+\]\(([^)]+)\)"

# Patterns of fields in text (fixed values).
GENERIC_PRICE = r"(?iU)(?:€|eur|euro|euros|\$|£)\s?\d[\d.,\s]*|\d[\d.,\s]*(?:€|eur|euro|euros)"
GENERIC_SURFACE = r"(?iU)\b\d{1,4}\s?(?:m2|m²|metros cuadrados|sqm)(?![\w²])"
GENERIC_ROOMS = r"(?iU)\b\d{1,2}\s?(?:habitaciones|hab\.?|rooms?)\b"
GENERIC_PLACE = r"(?i)\b(?:bizkaia|bilbao|madrid|barcelona|valencia|sevilla)\b"
DETAIL_PRICE = r"(?iU)\d[\d.,\s]{2,}\s?€|€\s?\d[\d.,\s]{2,}"
DETAIL_SURFACE = r"(?iU)\b\d{1,4}\s?(?:m2|m²|metros?)(?![\w²])"
DETAIL_ROOMS = r"(?iU)\b\d{1,2}\s?(?:hab(?:itaciones)?\.?|dormitorios|rooms?)\b"
#: Towns in the order in which they are looked for (fixed values).
TOWNS = ("Bilbao", "Barakaldo", "Getxo", "Santurtzi", "Sestao", "Portugalete", "Basauri", "Leioa", "Erandio", "Galdakao", "Durango", "Ermua", "Muskiz", "Zamudio", "Amorebieta", "Zalla", "Balmaseda", "Gernika", "Mungia", "Abadiño", "Etxebarri", "Derio", "Trapagaran", "Abanto", "Zierbena")


def html_links(html: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(html, F.lit(_HREF), 1), F.array().cast("array<string>"))


def markdown_links(markdown: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(markdown, F.lit(_MARKDOWN), 1), F.array().cast("array<string>"))


def html_to_text(html: Column) -> Column:
    """Text of HTML without its scripts and styles: ends of blocks as line ends, tags as spaces, blank lines squeezed."""
    x = F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    x = F.regexp_replace(x, r"(?i)</(p|div|h1|h2|h3|h4|li|br|tr)>", "\n")
    x = F.regexp_replace(x, r"<[^>]+>", " ")
    return F.trim(F.regexp_replace(x, r"\n\s*\n+", "\n\n"))


def html_title(html: Column) -> Column:
    return compact(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))


def found(pattern: str, text: Column) -> Column:
    """The first match, squeezed; null if there is none."""
    return compact(F.regexp_substr(text, F.lit(pattern)))


# Parts of URLs and titles that say what a page is, by parser (fixed values).
GENERIC_LISTING = ("/buscar", "/alquiler", "/venta", "resultados", "/naves", "/inmobiliaria", "/agencia", "clientid=")
GENERIC_DETAIL = ("/inmueble/", "/ficha", "/detalle", "id-", "/d?")
PISOS_LISTING_PATH = r"/alquiler/|/venta/|/buscar/|/resultados/"
PISOS_DETAIL_PATH = r"/alquilar/[^/]+-\d+(?:_\d+)?/?$"
PISOS_DETAIL = ("/inmueble/", "/ficha", "/detalle")
PISOS_LISTING = ("/alquiler", "/venta", "/buscar", "resultados")
FOTOCASA_LISTING = ("/inmobiliaria", "/agencia", "/perfil", "clientid=", "/todas-las-zonas/l")
FOTOCASA_DETAIL = ("/d?", "/d", "/inmueble/", "/detalle", "/ficha")


def _has_any(text: Column, tokens: tuple[str, ...]) -> Column:
    return F.exists(F.array(*map(F.lit, tokens)), lambda t: F.contains(text, t))


def generic_kind(url: Column, links: Column, has_price: Column, has_surface: Column, has_rooms: Column, title: Column) -> Column:
    low = F.lower(F.coalesce(url, F.lit("")))
    htm = low.rlike(r"\.htm(?:\?|$)")
    all3 = has_price & has_surface & has_rooms
    return (
        F.when(_has_any(low, GENERIC_LISTING) & (links >= 5), F.lit("listing"))
        .when(_has_any(low, GENERIC_DETAIL), F.lit("detail"))
        .when(htm & has_price & has_surface, F.lit("detail"))
        .when(all3 & (links <= 12), F.lit("detail"))
        .when(F.contains(F.lower(F.coalesce(title, F.lit(""))), F.lit("nave")) & all3, F.lit("detail"))
        .when(links >= 20, F.lit("listing"))
        .otherwise(F.lit("unknown"))
    )


def pisos_kind(url: Column, links: Column, has_price: Column, has_surface: Column, has_description: Column, title: Column) -> Column:
    low = F.lower(F.coalesce(url, F.lit("")))
    p = urls.path(low)
    return (
        F.when(p.rlike(PISOS_LISTING_PATH), F.lit("listing"))
        .when(p.rlike(PISOS_DETAIL_PATH) | _has_any(low, PISOS_DETAIL), F.lit("detail"))
        .when(has_price & (has_surface | has_description) & ((links <= 60) | F.contains(F.lower(F.coalesce(title, F.lit(""))), F.lit("en alquiler"))), F.lit("detail"))
        .when(_has_any(low, PISOS_LISTING) & (links >= 8), F.lit("listing"))
        .otherwise(F.lit("unknown"))
    )


def fotocasa_kind(url: Column, links: Column, has_price: Column, has_surface: Column, has_rooms: Column) -> Column:
    low = F.lower(F.coalesce(url, F.lit("")))
    return (
        F.when(_has_any(low, FOTOCASA_LISTING), F.lit("listing"))
        .when(_has_any(low, FOTOCASA_DETAIL), F.lit("detail"))
        .when(has_price & has_surface & has_rooms & (links <= 10), F.lit("detail"))
        .when(links >= 15, F.lit("listing"))
        .otherwise(F.lit("unknown"))
    )


def generic_status(kind: Column, fields: Column, has_value: Column) -> Column:
    detail = F.when((fields >= 3) & has_value, F.lit("ok")).when(fields >= 1, F.lit("partial")).otherwise(F.lit("error"))
    return F.when(kind == "detail", detail).otherwise(F.when(fields >= 3, F.lit("partial")).otherwise(F.lit("error")))


def pisos_status(fields: Column) -> Column:
    return F.when(fields >= 4, F.lit("ok")).when(fields >= 2, F.lit("partial")).otherwise(F.lit("error"))


def fotocasa_status(kind: Column, fields: Column, empty: Column, has_value: Column, has_extent: Column, has_place: Column, has_description: Column) -> Column:
    return (
        F.when(empty, F.lit("error"))
        .when(kind != "detail", F.when(fields >= 3, F.lit("partial")).otherwise(F.lit("error")))
        .when(has_value & has_extent & has_place & (fields >= 4), F.lit("ok"))
        .when((has_value & has_extent & (has_place | has_description)) | (fields >= 2), F.lit("partial"))
        .otherwise(F.lit("error"))
    )


def generic_confidence(fields: Column, kind: Column, has_value: Column, has_place: Column) -> Column:
    share = F.greatest(F.lit(0.1), F.least(F.lit(1.0), fields / 7))
    score = F.when(kind == "detail", share).otherwise(F.least(share * 0.6, F.lit(0.55)))
    score = score - F.when(has_value, 0.0).otherwise(0.12) - F.when(has_place, 0.0).otherwise(0.08)
    return F.round(F.greatest(F.lit(0.1), F.least(F.lit(1.0), score)), 2)


def pisos_confidence(fields: Column) -> Column:
    return F.round(F.greatest(F.lit(0.2), F.least(F.lit(0.98), F.lit(0.35) + fields * 0.1)), 2)


def fotocasa_confidence(kind: Column, status: Column, has_value: Column, has_surface: Column, has_rooms: Column, has_place: Column, has_description: Column) -> Column:
    def worth(test: Column, yes: float, no: float = 0.0) -> Column:
        return F.when(test, yes).otherwise(no)

    score = F.lit(0.2) + worth(kind == "detail", 0.2) + worth(has_value, 0.2) + worth(has_surface, 0.12) + worth(has_rooms, 0.08) + worth(has_place, 0.15) + worth(has_description, 0.1, -0.08)
    score = F.when(status == "partial", F.least(score, F.lit(0.79))).when(status == "error", F.least(score, F.lit(0.49))).otherwise(score)
    return F.round(F.greatest(F.lit(0.1), F.least(F.lit(0.98), score)), 2)


def town(text: Column) -> Column:
    """The first town, in the order of the list, that the text names as a word."""
    any_town = text.rlike(rf"(?iU)\b(?:{'|'.join(TOWNS)})\b")  # one look for the texts that name none
    return F.when(any_town, F.coalesce(*[F.when(text.rlike(rf"(?iU)\b{t}\b"), F.lit(t)) for t in TOWNS]))


def operation(title: Column, body: Column, url: Column) -> Column:
    """``alquiler`` before ``venta``; also where ``mes`` stands inside a word; else ``N/D``."""
    text = F.lower(F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in (title, body, url)]))
    return F.when(F.contains(text, F.lit("alquiler")) | F.contains(text, F.lit("mes")), F.lit("alquiler")).when(F.contains(text, F.lit("venta")), F.lit("venta")).otherwise(F.lit("N/D"))


def present(c: Column) -> Column:
    return filled(c).isNotNull()
