"""Pages of single listings as typed records.

A page's tree is read once into texts; values, kinds, status and confidence are expressions.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers, pages
from ..functions.dom import Node, parse
from ..functions.portals import any_of
from ..functions.text import filled, filled_count

#: Parsers of domains; any other page is read by the generic one (fixed values).
PARSER_KEYS = {"fotocasa.es": "fotocasa_detail", "pisos.com": "pisos_detail"}
# Selectors in order of preference (fixed values).
SELECTORS = {
    "pisos_detail": {
        "title": ("meta[property='og:title']", "meta[name='twitter:title']", "title", "h1", "[class*='title']"),
        "price": ("[class*='price']", "[id*='price']", "meta[property='product:price:amount']"),
        "location": ("[class*='location']", "[class*='subtitle']", "[class*='address']", "[class*='zone']", "meta[property='og:locale']"),
        "info": ("[class*='features']", "[class*='characteristics']", "ul"),
        "description": ("[class*='description']", "[id*='description']", "article", "meta[property='og:description']", "meta[name='description']"),
    },
    "fotocasa_detail": {
        "title": ("meta[property='og:title']", "h1", "[class*='title']"),
        "price": ("[class*='price']", "[class*='Price']", "meta[property='product:price:amount']"),
        "location": ("[class*='location']", "[class*='address']", "[class*='zone']", "meta[property='og:locality']", "[itemprop*='addressLocality']"),
        "info": ("[class*='feature']", "[class*='characteristic']", "ul", "section"),
        "description": ("[data-testid*='description']", "[class*='detail-description']", "[class*='description']", "[id*='description']", "meta[property='og:description']", "meta[name='description']", "article", "main"),
    },
}
# Selectors of breadcrumbs; words that name no place; segments of a path before a place; towns and noise in texts (fixed values).
CRUMBS = ("nav[aria-label*='miga'] a", "[class*='breadcrumb'] a", "[data-testid*='breadcrumb'] a")
NOT_PLACES = ("espana", "españa", "todas las zonas", "comprar", "alquilar", "locales", "viviendas", "fotocasa")
KIND_SEGMENTS = ("local-comercial", "vivienda", "piso", "nave", "locales-comerciales")
NEAR = ("bilbao", "bizkaia", "sestao", "barakaldo", "getxo", "durango")
NOISY = ("conecta tu hogar", "elige la fibra", "comprueba cobertura", "ver tarifas", "ofrecido por", "contactar", "llamar", r"hace \d+ d[ií]as", r"top\+", "que mejor se adapte a ti")
NEAR_TOWNS = re.compile(rf"\b(?:{any_of(NEAR)})\b", re.IGNORECASE)
NOISE = re.compile(any_of(NOISY), re.IGNORECASE)

TEXTS = ("title", "price_text", "location_text", "info_text", "description_text")


def _clean(value: str | None) -> str | None:
    return re.sub(r"\s+", " ", value).strip() or None if value else None


def _value(node: Node | None) -> str | None:
    return None if node is None else _clean(node.get("content") if node.tag == "meta" else node.text())


def _pick(root: Node, selectors: tuple[str, ...]) -> str | None:
    """The text of the first node of the first selector that gives any."""
    return next((v for s in selectors if (v := _value(root.first(s)))), None)


def place_of(value: str | None) -> str | None:
    """A text that can name a place: of 3 to 80 characters with a letter and no stop word."""
    text = _clean(value)
    if not text or not 3 <= len(text) <= 80 or any(w in text.lower() for w in NOT_PLACES) or not re.search("[a-záéíóúñ]", text.lower()):
        return None
    return text


def description_of(value: str | None) -> str | None:
    """Without noise and Markdown marks; null under 30 characters."""
    text = _clean(value)
    if not text:
        return None
    text = _clean(re.sub(r"[*_`#]+", " ", NOISE.sub(" ", text)))
    text = (text or "").strip(" .,-")
    return text[:1500] if len(text) >= 30 else None


def _fotocasa_place(root: Node, title: str | None, url: str, both: str) -> str | None:
    options: list[str | None] = [_value(root.first(s)) for s in SELECTORS["fotocasa_detail"]["location"]]
    options += reversed([_value(n) for s in CRUMBS for n in root.select(s)])
    parts = [p for p in (title or "").split(",") if p.strip()]
    options += reversed(parts) if len(parts) > 1 else []
    segments = [p for p in re.sub(r"^[a-z]+://[^/]*|[?#].*$", "", url).split("/") if p]
    options += [next((b.replace("-", " ") for a, b in zip(segments, segments[1:], strict=False) if a in KIND_SEGMENTS), None)]
    town = NEAR_TOWNS.search(both)
    options.append(town[0] if town else None)
    return next((p for o in options if (p := place_of(o))), None)


def read_detail(html: str | None, markdown: str | None, url: str, key: str) -> tuple[dict[str, str | None], list[str]]:
    """(texts, links) of a page."""
    both = "\n".join(x for x in (markdown, html) if x)
    root = parse(html) if html else Node("[document]")
    links = [h.strip() for n in root.walk() if n.tag == "a" and (h := n.get("href"))]
    if key not in SELECTORS:
        head = next((t for n in root.walk() if n.tag == "h1" and (t := n.text())), None) or next((t for n in root.walk() if n.tag == "title" and (t := n.text())), None)
        return {"title": head, "description_text": (_clean(markdown or html) or "")[:1200] or None}, links
    rules = SELECTORS[key]
    out = {"title": _pick(root, rules["title"]), "price_text": _pick(root, rules["price"]), "info_text": _pick(root, rules["info"])}
    if not out["title"] and (m := re.search(r"^#\s+(.+)$", markdown or "", re.MULTILINE)):
        out["title"] = _clean(m[0].replace("#", ""))
    if key == "pisos_detail":
        out["location_text"] = _pick(root, rules["location"])
        out["description_text"] = _pick(root, rules["description"]) or _clean(both[:1500])
    else:
        lines = [x.strip() for x in both.splitlines() if x.strip()]
        told = next((d for s in rules["description"] if (d := description_of(_value(root.first(s))))), None) if html else None
        out["description_text"] = told or description_of(" ".join(lines[:20]) if html else (markdown or "")[:2500])
        out["location_text"] = _fotocasa_place(root, out["title"], url, both) if html else None
    return out, links


READ = ("snapshot_id", "domain", "url_final", "html", "markdown", "parser_key")


Reader = Callable[[str | None, str | None, str], tuple[Mapping[str, str | None], list[str]]]


class Parser(NamedTuple):
    """A parser that a caller adds: its key, its domains, and how it reads (html, markdown, url) into TEXTS and links."""

    key: str
    domains: tuple[str, ...]
    read: Reader


def read_details(snapshots: DataFrame, parsers: Sequence[Parser] = ()) -> DataFrame:
    """``snapshots`` (READ) with _title and the other texts, _links, and _error for a page that could not be read."""
    readers = {p.key: p.read for p in parsers}
    source = snapshots.select(*READ)
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for url, html, markdown, key in zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True):
                error = None
                try:
                    texts, links = readers[key](html, markdown, url or "") if key in readers else read_detail(html, markdown, url or "", key or "generic")
                except Exception as e:  # one page's fault stays with it
                    texts, links, error = {}, [], f"{type(e).__name__}: {str(e)[:300]}"
                rows.append((*(texts.get(t) for t in TEXTS), links, error))
            if rows:
                types = [*[pa.string()] * len(TEXTS), pa.list_(pa.string()), pa.string()]
                yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True))], names=[*READ, *(f"_{t}" for t in TEXTS), "_links", "_error"])

    return source.mapInArrow(run, ", ".join([*kinds, *(f"_{t} string" for t in TEXTS), "_links array<string>", "_error string"]))


def parser_key(domain: Column, parsers: Sequence[Parser] = ()) -> Column:
    """The parser of a domain, an added one before those known here; ``generic`` for any other."""
    own = [F.when(domain.isin(*p.domains), F.lit(p.key)) for p in parsers if p.domains]
    return F.coalesce(*own, *[F.when(domain == d, F.lit(k)) for d, k in PARSER_KEYS.items()], F.lit("generic"))


def parsed(snapshots: DataFrame, faults: bool = False, parsers: Sequence[Parser] = ()) -> DataFrame:
    """``snapshots`` (snapshot_id, domain, url_final, html, markdown) as records: texts, values, kind, status, confidence.

    Null HTML and Markdown give status ``error``; links are distinct, at most 200. A page whose reading fails is no record;
    with ``faults`` it is a row with ``read_error``, which is null in records. ``parsers`` read their domains' pages; what
    they leave out is found as for any other page.
    """
    keyed = snapshots.withColumn("parser_key", parser_key(F.col("domain"), parsers))
    both = F.concat_ws("\n", filled(F.col("markdown")), filled(F.col("html")))
    t = read_details(keyed, parsers).withColumn("_both", both)
    if not faults:
        t = t.filter("_error is null")
    pisos, fotocasa = (F.col("parser_key") == k for k in ("pisos_detail", "fotocasa_detail"))
    generic = ~pisos & ~fotocasa
    info = F.coalesce("_info_text", "_both")
    t = t.select(
        "*",
        F.when(generic, F.coalesce("_price_text", pages.found(pages.GENERIC_PRICE, F.col("_both")))).otherwise(F.coalesce("_price_text", pages.found(pages.DETAIL_PRICE, F.col("_both")))).alias("price_text"),
        F.when(generic, pages.found(pages.GENERIC_SURFACE, F.col("_both"))).otherwise(F.coalesce(pages.found(pages.DETAIL_SURFACE, info), pages.found(pages.DETAIL_SURFACE, F.col("_both")))).alias("surface_text"),
        F.when(generic, pages.found(pages.GENERIC_ROOMS, F.col("_both"))).otherwise(F.coalesce(pages.found(pages.DETAIL_ROOMS, info), pages.found(pages.DETAIL_ROOMS, F.col("_both")))).alias("rooms_text"),
        F.when(generic, F.coalesce("_location_text", pages.found(pages.GENERIC_PLACE, F.col("_both")))).otherwise(F.col("_location_text")).alias("location_text"),
        F.col("_title").alias("title"),
        F.col("_description_text").alias("description_text"),
        F.slice(F.array_distinct(F.filter("_links", lambda x: x != "")), 1, 200).alias("extracted_links"),
    )
    price = numbers.price(F.col("price_text"), F.col("_both"))
    t = t.withColumn("_price", price).withColumn("surface_sqm", numbers.surface(F.col("surface_text"), F.col("_both"))).withColumn("rooms_count", numbers.rooms(F.col("rooms_text"), F.col("_both")))
    t = t.withColumn("price_value", F.col("_price.value")).withColumn("price_currency", F.col("_price.currency"))
    fields = filled_count(*[F.col(c) for c in ("title", "price_text", "location_text", "surface_text", "rooms_text", "description_text")])
    valued, sized, roomed, placed = (F.col(c).isNotNull() for c in ("price_value", "surface_sqm", "rooms_count", "location_text"))
    told = F.coalesce(F.length("description_text") >= 60, F.lit(False))
    n_links, url = F.size("_links"), F.col("url_final")
    true_size, true_rooms = F.coalesce(F.col("surface_sqm") != 0, F.lit(False)), F.coalesce(F.col("rooms_count") != 0, F.lit(False))
    kind = (
        F.when(generic, pages.generic_kind(url, F.size("extracted_links"), F.col("price_text").isNotNull() | F.coalesce(F.col("price_value") != 0, F.lit(False)), true_size, true_rooms, F.col("title")))
        .when(pisos, pages.pisos_kind(url, n_links, F.col("price_text").isNotNull(), F.col("surface_text").isNotNull(), F.col("description_text").isNotNull(), F.col("title")))
        .otherwise(pages.fotocasa_kind(url, n_links, valued, sized, roomed))
    )
    t = t.withColumn("page_kind", kind).withColumn("_fields", fields).withColumn("_empty", F.col("_both") == "")
    of_kind = F.col("page_kind")
    status = F.when(generic, pages.generic_status(of_kind, F.col("_fields"), valued)).when(pisos, pages.pisos_status(F.col("_fields"))).otherwise(pages.fotocasa_status(of_kind, F.col("_fields"), F.col("_empty"), valued, sized | roomed, placed, told))
    t = t.withColumn("parse_status", status)
    confidence = F.when(generic, pages.generic_confidence(F.col("_fields"), of_kind, valued, placed)).when(pisos, pages.pisos_confidence(F.col("_fields"))).otherwise(pages.fotocasa_confidence(of_kind, F.col("parse_status"), valued, sized, roomed, placed, told))
    errors = F.filter(F.array(F.when(F.col("_empty"), F.lit("missing_html_and_markdown")), F.when(~pisos & (of_kind != "detail") & ~(fotocasa & F.col("_empty")), F.lit("non_detail_page_kind"))), lambda e: e.isNotNull())
    return t.select(
        "parser_key", F.col("domain").alias("source_domain"), "snapshot_id", "url_final", "page_kind", "title", "price_text", "price_value", "price_currency", "location_text",
        "surface_text", "surface_sqm", "rooms_text", "rooms_count", "description_text", "extracted_links", "parse_status", errors.alias("parse_errors"), confidence.alias("confidence_score"), *[F.col("_error").alias("read_error")] * faults,
    )
