"""Listing and detail pages as the older scraper reads them, drops of saved pages, and its run from sources to two sheets."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import numbers, pages, urls
from ..functions.dom import Node, parse
from ..functions.text import filled, squeezed
from ..sources import tables as t
from ..sources.shared import settled
from . import legacy
from .ordered import running

# Selectors of cards, links, places, breadcrumbs and next pages; caps of texts, seeds and pages; columns of the sheets (fixed values).
CARDS = ("div.card.custom-card-info", "div.card")
LINKS = ("a[href*='/inmuebles/']", "a[href*='/property/']")
PLACE = "i.fa-location-dot"
CRUMBS = (".breadcrumb", ".breadcrumbs", "nav[aria-label*='breadcrumb']")
TOPIC = r"(?iU)\b(nave|pabell[oó]n)\b"
CARD_TEXT, DETAIL_TEXT, SEEDS = 700, 600, 50
NEXT = ("a[rel='next']", ".pagination a.next", "a.page-next")
MOST_PAGES = 8
SHEET = {"Link": "link", "Ubicación": "localidad", "Detalles": "detalles", "m²": "m2", "Precio": "precio", "Fecha": "fecha", "Fuente": "fuente"}


def _first(root: Node, selectors: Sequence[str]) -> Node | None:
    """The first node in the document that any of the selectors matches."""
    wanted = {id(n) for s in selectors for n in root.select(s)}
    return next((n for n in root.walk() if id(n) in wanted), None)


def _card_rows(html: str) -> Iterator[tuple[str, str, str | None]]:
    """(link, text, text beside the place's icon) of each card with a link."""
    root = parse(html)
    for card in next((found for s in CARDS if (found := root.select(s))), []):
        anchor = _first(card, LINKS)
        if anchor is not None:
            icon = card.first(PLACE)
            yield anchor.get("href") or "", card.text(), icon.parent.text() if icon is not None and icon.parent is not None else None


def list_cards(listing: DataFrame, base: str, source: str) -> DataFrame:
    """(page_id, place, link, localidad, m2, precio, operacion, detalles, fuente) of the cards of ``listing`` (page_id, html,
    operation) that speak of industrial units. A word for the operation in the card counts more than the page's. Null HTML
    has no cards; a page that can't be read has none either."""
    kind = listing.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for page, html, operation in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                try:
                    rows += [(page, operation, k, *row) for k, row in enumerate(_card_rows(html) if html else ())]
                except Exception:  # one page's fault stays with it
                    continue
            if rows:
                types = [batch.column(0).type, pa.string(), pa.int32(), pa.string(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), types, strict=True)], names=["page_id", "operation", "place", "href", "text", "beside"])

    read = listing.select("page_id", "html", "operation").mapInArrow(run, f"page_id {kind}, operation string, place int, href string, text string, beside string")
    read = read.withColumn("text", squeezed(F.col("text"))).filter(F.col("text").rlike(TOPIC))
    low, href = F.lower("text"), F.col("href")
    link = F.when(href.startswith("http"), href).when(href.startswith("/"), F.concat(F.lit(base), href)).otherwise(F.concat(F.lit(base + "/"), href))
    read = read.withColumn("m2", numbers.listed_surface(F.col("text")))
    operation = F.when(F.contains(low, F.lit("alquiler")), "alquiler").when(F.contains(low, F.lit("venta")), "venta").otherwise(F.col("operation"))
    return read.select(
        "page_id", "place", link.alias("link"), F.coalesce(filled(squeezed(F.col("beside"))), pages.town(F.col("text")), F.lit("")).alias("localidad"), "m2",
        numbers.listed_price(F.col("text"), F.col("m2"))["price"].alias("precio"), operation.alias("operacion"), F.substring("text", 1, CARD_TEXT).alias("detalles"), F.lit(source).alias("fuente"),
    )


def detail_fields(read: DataFrame, data_surface: bool = False, crumbs: bool = False) -> DataFrame:
    """(link, localidad, m2, precio, detalles) of pages ``read`` (link, html): the price of the page's JSON-LD before that of
    its text; with ``data_surface`` the surface, too; the place of the JSON-LD, with ``crumbs`` of the breadcrumbs, else of
    the text. Null HTML gives empty details and nulls."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, trail = [], []
            for html in batch.column(1).to_pylist():
                try:
                    root = parse(html or "")
                    node = _first(root, CRUMBS)
                    text.append(root.text())
                    trail.append(node.text() if node is not None else None)
                except Exception:  # one page's fault stays with it
                    text.append("")
                    trail.append(None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(text, pa.string()), pa.array(trail, pa.string())], names=["link", "html", "text", "trail"])

    out = read.select("link", "html").mapInArrow(run, "link string, html string, text string, trail string")
    out = out.withColumn("text", squeezed(F.col("text"))).withColumn("ld", legacy.ld_json(F.coalesce("html", F.lit(""))))

    def told(*keys: str) -> Column:
        return F.coalesce(*[filled(F.try_element_at("ld", F.lit(k))) for k in keys])

    offered = F.get_json_object(told("offers"), "$.price").try_cast("double")
    surface = numbers.listed_surface(F.col("text"))
    out = out.withColumn("m2", F.coalesce(numbers.listed_surface(told("floorSize", "area", "size")), surface) if data_surface else surface)
    place = told("addressLocality", "address")
    inner = F.coalesce(filled(F.get_json_object(place, "$.addressLocality")), filled(F.get_json_object(place, "$.addressRegion")))
    named = F.when(place.startswith("{"), inner).otherwise(place)
    guessed = pages.town(F.when(F.col("trail").isNotNull(), F.col("trail")).otherwise(F.col("text")) if crumbs else F.col("text"))
    price = F.coalesce(F.nullif(offered, F.lit(0.0)), numbers.listed_price(F.col("text"), F.col("m2"))["price"])
    return out.select("link", F.coalesce(named, guessed, F.lit("")).alias("localidad"), "m2", price.alias("precio"), F.substring("text", 1, DETAIL_TEXT).alias("detalles"))


def sorted_links(found: DataFrame, by: str, link: str) -> DataFrame:
    """(by, links): the distinct links of each, in order."""
    return found.filter(filled(F.trim(link)).isNotNull()).groupBy(by).agg(F.sort_array(F.collect_set(F.trim(link))).alias("links"))


def long_enough(text: Column, least: int = 5) -> Column:
    return F.length(squeezed(text)) >= least


def drops(spark: SparkSession, folder: str) -> DataFrame:
    """(place, path, html) of the pages saved in a folder, in the order of their names; none if it is not there."""
    if not t.exists(spark, folder):
        return t.empty(spark, "place int, path string, html string")
    files = t.read_pages(spark, f"{folder}/*.html")
    places = running(files.select("path"), [], "path", total=("place", F.lit(1)))  # names alone
    return files.join(places, "path").select(F.col("place").cast("int").alias("place"), "path", "html")


def first_filled(frames: Sequence[DataFrame]) -> DataFrame:
    """The first that has a row (sitemaps that are tried one after another), else the last."""
    return next((df for df in frames[:-1] if not df.isEmpty()), frames[-1])


def with_fallback(found: DataFrame, fixed: Sequence[tuple], schema: str) -> DataFrame:
    """``found``, or rows that are given if there is none."""
    return found.sparkSession.createDataFrame(list(fixed), schema) if found.isEmpty() else found


def sheets(items: DataFrame, day: str) -> tuple[DataFrame, DataFrame]:
    """(rent, sale) with the columns of the sheets; what is for rent and for sale is in both."""
    out = items.withColumn("fecha", F.coalesce("fecha", F.lit(day))).withColumn("fuente", F.coalesce("fuente", F.lit("N/D")))
    shown = [F.col(c).alias(name) for name, c in SHEET.items()]
    return out.filter(legacy.is_rent(F.col("operacion"))).select(shown), out.filter(legacy.is_sale(F.col("operacion"))).select(shown)


def run(sources: Sequence[tuple[str, DataFrame]], folder: str, day: str) -> dict[str, int]:
    """All sources' items (name, rows with ``seq``) to two CSV sheets below ``folder``: of a link the first one stays. How
    many each source has is returned."""
    each = [legacy.normalized(df, F.lit(name), F.lit(day), keep=("seq",)) for name, df in sources]
    if not each:
        return {}
    counts = {r["source"]: r["n"] for r in legacy.counts_by_source(reduce(DataFrame.unionByName, each)).toLocalIterator()}
    for name, sheet in zip(("Alquiler", "Venta"), sheets(legacy.first_links(each, "seq"), day), strict=True):
        t.write_csv(sheet, f"{folder}/{name}")
    return counts


Reader = Callable[[DataFrame], DataFrame]


def next_links(read: DataFrame) -> DataFrame:
    """(source, url, next_url) of pages ``read`` (source, url, html): where the first link to the next page leads, for those
    that have one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for html in batch.column(2).to_pylist():
                try:
                    node = _first(parse(html or ""), NEXT)
                    found.append(node.get("href") if node is not None else None)
                except Exception:  # one page's fault stays with it
                    found.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string())], names=["source", "url", "link"])

    linked = read.select("source", "url", "html").mapInArrow(run, "source string, url string, link string").filter(filled(F.col("link")).isNotNull())
    return linked.select("source", "url", urls.absolute(F.col("url"), F.trim("link")).alias("next_url"))


def crawled(starts: DataFrame, fetch: Callable[[DataFrame], DataFrame], readers: Mapping[str, Reader], most: int = MOST_PAGES) -> DataFrame:
    """The items of the pages that ``starts`` (source, url, template) lead to, with ``source``, ``hop`` (the number of the
    page, from 1) and ``page_url``.

    A source with a template ({page}) is read page by page until one has no items (the first one may have none) or can't
    be fetched; one without follows the links to next pages; both for at most ``most`` pages, each page once. ``readers``
    by source take pages (page_id, source, url, hop, html) to items with the column page_id. A round fetches one page of every
    source that goes on, and is a table, so that nothing is fetched twice.
    """
    front = settled(starts.select("source", "url", filled(F.col("template")).alias("template"), F.lit(1).alias("hop")).dropDuplicates(["source", "url"]), "front")
    seen, rounds = front.select("source", "url"), []
    for hop in range(1, most + 1):
        got = fetch(front.select("url").distinct()).select("url", "html")
        read = settled(front.join(got, "url").filter("html is not null").select(F.concat_ws(" ", "source", "url").alias("page_id"), "source", "url", "template", "hop", "html"), "pages")
        each = [reader(read.filter(F.col("source") == name)) for name, reader in readers.items()]
        items = settled(reduce(DataFrame.unionByName, each), "items")
        rounds.append(read.select("page_id", "source", "hop", F.col("url").alias("page_url")).join(items, "page_id"))
        if hop == most:
            break
        going = read.filter("template is not null")
        going = going if hop == 1 else going.join(items.select("page_id").distinct(), "page_id", "left_semi")
        numbered = going.select("source", F.replace("template", F.lit("{page}"), F.lit(str(hop + 1))).alias("url"), "template")
        followed = next_links(read.filter("template is null")).select("source", F.col("next_url").alias("url"), F.lit(None).cast("string").alias("template"))
        front = settled(numbered.unionByName(followed).dropDuplicates(["source", "url"]).join(seen, ["source", "url"], "left_anti").withColumn("hop", F.lit(hop + 1)), "front")
        if front.isEmpty():
            break
        seen = seen.unionByName(front.select("source", "url"))
    return reduce(DataFrame.unionByName, rounds)


def crawl(starts: DataFrame, fetch: Callable[[DataFrame], DataFrame], readers: Mapping[str, Reader], folder: str, day: str, most: int = MOST_PAGES) -> dict[str, int]:
    """All sources crawled, in the order of ``readers``, into both sheets: of a link the first one stays. How many items each
    source has is returned."""
    items = settled(crawled(starts, fetch, readers, most).withColumn("seq", F.struct("hop", "page_url", "place")), "crawl")
    return run([(name, items.filter(F.col("source") == name)) for name in readers], folder, day)


def card_reader(base: str, source: str, operation: str = "N/D") -> Reader:
    """A reader of pages with cards, for :func:`crawled`."""
    return lambda read: list_cards(read.select("page_id", "html", F.lit(operation).alias("operation")), base, source)
