"""Operators of the older scraper: feature lines, embedded JSON, unions with first wins, the split by operation."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers, pages
from ..functions.text import filled, unaccented_upper
from .ordered import first_by_key, running

COLUMNS = ("link", "localidad", "m2", "precio", "operacion", "detalles", "fuente", "fecha")
# Beginnings of lines that open a record, and of lines that are passed over (fixed values).
TITLE_STARTS = ("SE VENDE", "SE ALQUILA", "ALQUILER PABELLON", "EN ZONA ", "PABELLONES LOGISTICA")
SKIPPED_STARTS = ("PABELLONES Y NAVES VIZCAYA", "MAPA DEL SITIO", "CONSULTE NUESTRAS OFERTAS")
STATE_PATTERNS = (r"(?s)__INITIAL_STATE__\s*=\s*(\{.*?\})\s*;", r"(?s)window\.appState\s*=\s*(\{.*?\})\s*;", r"(?s)__NEXT_DATA__\"?\s*type=\"application/json\">(\{.*?\})</script>")
LINKED_SITES = ("idealista.com", "indomio.es", "indomio.it", "indomio.com")


def normalized(items: DataFrame, source: Column, day: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """The eight columns with defaults where they are null or empty, and ``keep``."""

    def text(name: str, default: Column) -> Column:
        own = filled(F.col(name).cast("string")) if name in items.columns else F.lit(None).cast("string")
        return F.coalesce(own, default).alias(name)

    blank = F.lit("")
    return items.select(text("link", blank), text("localidad", blank), text("m2", blank), text("precio", blank), text("operacion", F.lit("N/D")), text("detalles", blank), text("fuente", source), text("fecha", day), *keep)


def first_links(sources: list[DataFrame], seq: str) -> DataFrame:
    """The union of all sources, each with ``source_ordinal``; rows without a link go; of a link the first one stays."""
    both = None
    for k, df in enumerate(sources):
        one = df.withColumn("source_ordinal", F.lit(k))
        both = one if both is None else both.unionByName(one, allowMissingColumns=True)
    linked = both.filter(filled(F.col("link")).isNotNull()).withColumn("_seq", F.struct("source_ordinal", seq))
    return first_by_key(linked, ["link"], "_seq").drop("_seq")


def is_rent(operation: Column) -> Column:
    return F.contains(F.lower(F.coalesce(operation, F.lit(""))), F.lit("alquiler"))


def is_sale(operation: Column) -> Column:
    """For sale, and whatever is not for rent."""
    return F.contains(F.lower(F.coalesce(operation, F.lit(""))), F.lit("venta")) | ~is_rent(operation)


def counts_by_source(items: DataFrame) -> DataFrame:
    names = [filled(F.col(c)) for c in ("fuente", "fuente_origen") if c in items.columns]
    return items.groupBy(F.coalesce(*names, F.lit("?")).alias("source")).agg(F.count("*").alias("n"))


def _starts(line: Column, starts: tuple[str, ...]) -> Column:
    up = unaccented_upper(line)
    return F.exists(F.array(*map(F.lit, starts)), lambda s: F.startswith(up, s))


def feature_records(lines: DataFrame, document: str, place: str, line: str, is_title: Column | None = None) -> DataFrame:
    """(document, record, title, features): a title line opens a record and the lines behind it are its features.

    Lines before the first title go, as do skipped ones and those of up to two characters; a leading ``- `` is cut.
    Lines are told apart by (document, place). The titles before a line are counted by :func:`ordered.running`, so one
    document may hold any share of the lines.
    """
    title = _starts(F.col(line), TITLE_STARTS) if is_title is None else is_title
    each = lines.withColumn("_title", F.coalesce(title, F.lit(False)))
    counted = running(each, [document], place, total=("_before", F.col("_title").cast("int")))
    marked = counted.withColumn("record", (F.col("_before") + F.col("_title").cast("int")).cast("long")).filter("record > 0")
    bare = F.trim(F.regexp_replace(F.trim(F.col(line)), r"^- ", ""))
    feature = F.when(~F.col("_title") & ~_starts(F.trim(F.col(line)), SKIPPED_STARTS) & (F.length(bare) > 2), F.struct(F.col(place), bare.alias("text")))
    out = marked.withColumn("_f", feature).groupBy(document, "record").agg(F.max(F.when(F.col("_title"), F.trim(F.col(line)))).alias("title"), F.sort_array(F.collect_list("_f")).alias("_fs"))
    return out.select(document, "record", "title", F.transform("_fs", lambda f: f["text"]).alias("features"))


def ld_json(html: Column) -> Column:
    """map<string,string> of the page's JSON-LD objects, later keys over earlier ones; what is not JSON goes."""
    blocks = F.regexp_extract_all(html, F.lit(r"(?is)<script[^>]*type=[\"']application/ld\+json[\"'][^>]*>(.*?)</script>"), 1)
    objects = F.flatten(F.transform(blocks, lambda b: F.when(F.trim(b).startswith("["), F.coalesce(F.from_json(b, "array<map<string,string>>"), F.array().cast("array<map<string,string>>"))).otherwise(F.array(F.from_json(b, "map<string,string>")))))
    known = F.filter(objects, lambda m: m.isNotNull())
    return F.aggregate(known, F.create_map().cast("map<string,string>"), lambda found, m: F.map_concat(F.map_filter(found, lambda k, v: ~F.map_contains_key(m, k)), m))


def state_json(html: Column) -> Column:
    """The page's embedded state: the first of three places that holds one."""
    return F.coalesce(*[filled(F.regexp_extract(html, p, 1)) for p in STATE_PATTERNS])


def _walked(node: object) -> Iterator[dict]:
    stack = [node]
    while stack:
        x = stack.pop()
        if isinstance(x, dict):
            link = x.get("url") or x.get("detailUrl")
            if isinstance(link, str) and any(s in link for s in LINKED_SITES):
                yield x
            stack.extend(reversed(list(x.values())))
        elif isinstance(x, list):
            stack.extend(reversed(x))


def json_items(blobs: DataFrame, key: str, column: str) -> DataFrame:
    """(key, place, link, detalles, text): every object at any depth that links to a known site, outer ones first.

    Null text, text that is not JSON, and JSON nested about a thousand levels deep have none. Price, surface, town and operation then come from ``text`` by
    :func:`with_fields`.
    """
    kind = blobs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    found = [(x, json.dumps(x, ensure_ascii=False)) for x in _walked(json.loads(blob) if blob else None)]
                except (ValueError, RecursionError):  # no JSON, or nested deeper than the parser goes
                    continue
                for place, (x, text) in enumerate(found):
                    rows.append((k, place, x.get("url") or x.get("detailUrl"), str(x.get("title") or x.get("subtitle") or "")[:500] or text[:500], text))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (batch.column(0).type, pa.int32(), pa.string(), pa.string(), pa.string()), strict=True)], names=[key, "place", "link", "detalles", "text"])

    return blobs.select(key, column).mapInArrow(run, f"`{key}` {kind}, place int, link string, detalles string, text string")


def with_fields(items: DataFrame, text: str = "text", title: str = "detalles", link: str = "link") -> DataFrame:
    """m2, precio, localidad and operacion out of an item's text."""
    out = items.withColumn("m2", numbers.listed_surface(F.col(text)))
    return out.withColumn("precio", numbers.listed_price(F.col(text), F.col("m2"))["price"]).withColumn("localidad", pages.town(F.col(text))).withColumn("operacion", pages.operation(F.col(title), F.col(text), F.col(link)))


def sitemap_links(xml: Column) -> Column:
    return F.regexp_extract_all(xml, F.lit(r"(?i)<loc>\s*([^<\s]+)\s*</loc>"), 1)


def is_topical(text: Column, price: Column, m2: Column) -> Column:
    """The text is about industrial units, or there is a price or a surface."""
    return F.coalesce(text, F.lit("")).rlike(r"(?iU)\b(naves?|pabell[oó]n(es)?)\b") | price.isNotNull() | m2.isNotNull()


def reachable_pages(edges: DataFrame, start: DataFrame, hops: int = 5) -> DataFrame:
    """(url, hop) that following ``next`` links (url, next_url) reaches from ``start`` (url) in at most ``hops`` pages."""
    seen = start.select("url", F.lit(1).alias("hop"))
    front = seen
    for hop in range(2, hops + 1):
        front = front.join(edges, "url").select(F.col("next_url").alias("url"), F.lit(hop).alias("hop")).distinct().join(seen.select("url"), "url", "left_anti")
        seen = seen.unionByName(front)
    return seen
