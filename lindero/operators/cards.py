"""Listing pages: cards of listings become candidate rows.

The tree work of a page is done in one Arrow batch function; prices, identity and duplicate elimination are
expressions on its rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import NamedTuple
from urllib.parse import parse_qsl, urlencode, urljoin, urlsplit, urlunsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import identity as ids
from ..functions import numbers, urls
from ..functions.dom import Node, parse
from ..functions.portals import BLOCKED, BY_DOMAIN, Portal, any_of
from ..functions.text import filled, filled_count
from .ordered import best_by_key

# Words and tags that mark a card, patterns of its fields, selectors of unknown portals (fixed values).
CARD_TAGS = ("a", "div", "article", "li", "section")
CARD_TOKENS = ("card", "item", "result", "listing", "property", "article", "row", "ad", "result")
CARD_SELECTORS = ("article", "li", "[data-testid*='listing']", "[data-testid*='property']", "[class*='card']", "[class*='item']", "[class*='result']", "[class*='listing']")
ID_ATTRIBUTES = ("data-id", "data-adid", "data-ad-id", "data-listing-id", "data-property-id", "data-re-ad-id", "id")
MARKED = ("class", "id", "data-testid", "data-test")
PRICE = re.compile(r"(?:€|eur|euro|euros)\s?\d[\d.,\s]*|\d[\d.,\s]*(?:€|eur|euro|euros)", re.IGNORECASE)
SURFACE = re.compile(r"\b\d[\d.,\s]{0,8}\s?(?:m2|m²|metros cuadrados|metros|sqm)\b", re.IGNORECASE)
ROOMS = re.compile(r"\b\d{1,2}\s?(?:hab(?:itaciones)?\.?|dormitorios|rooms?)\b", re.IGNORECASE)

#: What a source's document may set of how its portal's pages are read, and the second name of the second one.
OVERLAID = ("listing_card_selectors", "listing_detail_link_selectors", "listing_detail_url_patterns", "listing_reject_url_patterns")
SECOND_NAME = "detail_link_selectors"


class Slots(NamedTuple):
    """A caller's own functions for a domain's links, in place of its portal's rules; they run where pages are read."""

    normal: Callable[[str, str], str] | None = None  # (link, base URL) to the candidate's URL, empty for none
    is_detail: Callable[[str], bool] | None = None


class Strategy(NamedTuple):
    """How a source's listing pages are read: that of its portal, if it is known, under what its document sets."""

    portal: Portal | None
    cards: tuple[str, ...]
    links: tuple[str, ...]
    detail: tuple[str, ...]
    reject: tuple[str, ...]
    slots: Slots = Slots()

    def normal(self, link: str, base: str) -> str:
        return self.slots.normal(link, base) if self.slots.normal else candidate_url(self.portal, link, base)

    def is_detail(self, url: str) -> bool:
        """By a function for the domain, else the portal's own patterns; those of a document count for portals that are not
        known."""
        if self.slots.is_detail:
            return self.slots.is_detail(url)
        low = url.lower()
        if self.portal:
            return not re.search(any_of(self.portal.reject), low) and bool(re.search(any_of(self.portal.detail), low))
        return any(re.search(p, low) for p in self.detail)


def strategy_of(domain: str, document: Mapping[str, Sequence[str] | None] | None = None, slots: Mapping[str, Slots] | None = None) -> Strategy:
    """The strategy of a domain. Values of the document that are empty leave the portal's as they are; ``slots`` has
    functions by domain."""
    portal, told = BY_DOMAIN.get(domain), dict(document or {})
    told[OVERLAID[1]] = told.get(OVERLAID[1]) or told.get(SECOND_NAME)
    own = (portal.cards, portal.links, portal.detail, portal.reject) if portal else (CARD_SELECTORS, (), (), ())
    set_ = [tuple(x for x in told.get(k) or () if x and x.strip()) for k in OVERLAID]
    return Strategy(portal, *(s or o for s, o in zip(set_, own, strict=True)), (slots or {}).get(domain, Slots()))


FIELDS = ("candidate_url", "title_text", "price_text", "location_text", "surface_text", "rooms_text", "card_external_id", "raw_text")


def _clean(value: str | None) -> str | None:
    return re.sub(r"\s+", " ", value).strip() or None if value else None


def _marks(node: Node) -> str:
    return " ".join(node.attrs[a] for a in MARKED if node.attrs.get(a)).lower()


def card_score(node: Node) -> int:
    """Three for a listing tag, two for each marking word, one for 30 and one for 120 characters of text."""
    size, marks = len(_clean(node.text()) or ""), _marks(node)
    return 3 * (node.tag in ("article", "li", "section")) + 2 * sum(t in marks for t in CARD_TOKENS) + (size >= 30) + (size >= 120)


def card_around(anchor: Node) -> Node:
    """Of the anchor and six ancestors the first with the highest score."""
    near = [anchor, *[a for _, a in zip(range(6), anchor.ancestors(), strict=False)]]
    fit = [n for n in near if n.tag in CARD_TAGS]
    return max(fit, key=card_score) if fit else anchor


def _has_link(node: Node) -> bool:
    return any(n.tag == "a" and n.get("href") is not None for n in node.walk())


def cards_of(root: Node, selectors: tuple[str, ...]) -> list[Node]:
    """The cards that selectors find, each once; without any, the cards around anchors."""
    out: dict[int, Node] = {}
    for selector in selectors:
        for node in root.select(selector):
            if node.get("href") if node.tag == "a" else _has_link(node):
                out.setdefault(id(node), node)
    if not out:
        for node in root.walk():
            if node.tag == "a" and node.get("href") is not None:
                card = card_around(node)
                out.setdefault(id(card), card)
    return list(out.values())


def anchors_of(card: Node, selectors: tuple[str, ...]) -> list[Node]:
    out = {id(card): card} if card.tag == "a" and card.get("href") else {}
    for selector in selectors:
        for node in card.select(selector):
            if node.get("href"):
                out.setdefault(id(node), node)
    return list(out.values()) or [n for n in card.walk() if n.tag == "a" and n.get("href") is not None]


def candidate_url(portal: Portal | None, link: str, base: str) -> str:
    """A portal's normal form of a link (the row form of :func:`lindero.functions.urls.candidate`)."""
    parts = urlsplit(urljoin(base, link))
    if parts.scheme not in ("http", "https"):
        return ""
    if portal and portal.keep_query:
        kept = [(k, v) for k, v in parse_qsl(parts.query) if k.lower() not in portal.drop_keys]
        return urlunsplit((parts.scheme.lower(), parts.netloc.lower(), parts.path if parts.path.endswith("/") else parts.path + "/", urlencode(kept), ""))
    return urlunsplit((parts.scheme.lower(), parts.netloc.lower(), parts.path.rstrip("/") or "/", "", ""))


def _by_mark(card: Node, tokens: tuple[str, ...]) -> str | None:
    for node in card.walk():
        if any(t in _marks(node) for t in tokens) and (text := _clean(node.text())):
            return text
    return None


def _title(card: Node, anchor: Node) -> str | None:
    options = [_clean(anchor.text()), _by_mark(card, ("title", "headline", "subject"))]
    for tag in ("h1", "h2", "h3", "h4", "strong"):
        if node := next((n for n in card.walk() if n.tag == tag), None):
            options.append(_clean(node.text()))
    return next((o for o in options if o and len(o) >= 5), None)


def _place(card: Node, text: str) -> str | None:
    if own := _by_mark(card, ("location", "district", "zone", "address", "municip")):
        return own
    for part in (p.strip() for p in re.split(r"[|\n·]", text)):
        if part and len(part) <= 80 and any(c.isalpha() for c in part) and not PRICE.search(part) and not SURFACE.search(part):
            return _clean(part)
    return None


def _card_id(card: Node) -> str | None:
    link = next((n for n in card.walk() if n.tag == "a" and n.get("href") is not None), card)
    for value in [node.get(a) for node in (card, link) for a in ID_ATTRIBUTES]:
        if value and (m := re.search(r"\d{5,}", value)):
            return m[0]
    return None


def _match(pattern: re.Pattern[str], text: str) -> str | None:
    m = pattern.search(text)
    return _clean(m[0]) if m else None


def read_card(card: Node, anchor: Node, strategy: Strategy, base: str) -> tuple[dict[str, str | None] | None, str | None]:
    """(the fields of an accepted card, none) or (none, why not)."""
    link = _clean(anchor.get("href"))
    if not link:
        return None, "missing_href"
    own = card_around(anchor) if card.tag == "a" else card
    url = strategy.normal(link, base)
    if not url:
        return None, "invalid_candidate_url"
    if not strategy.is_detail(url):
        return None, "rejected_by_url_rules" if strategy.reject and re.search(any_of(strategy.reject), url.lower()) else "non_detail_url"
    text = _clean(own.text())
    if not text or len(text) < 12:
        return None, "card_text_too_short"
    return {
        "candidate_url": url,
        "title_text": _title(own, anchor),
        "price_text": _by_mark(own, ("price", "amount")) or _match(PRICE, text),
        "location_text": _place(own, text),
        "surface_text": _by_mark(own, ("surface", "size", "meters")) or _match(SURFACE, text),
        "rooms_text": _by_mark(own, ("room", "habit")) or _match(ROOMS, text),
        "card_external_id": _card_id(own),
        "raw_text": text,
    }, None


def read_page(html: str | None, domain: str, base: str, document: Mapping[str, Sequence[str] | None] | None = None, slots: Mapping[str, Slots] | None = None) -> list[tuple[int, str | None, dict[str, str | None]]]:
    """(position from 1, rejection reason, fields) of each card; one row ``blocked_listing_page`` at position 0 for a page
    that turns readers away. Of a card the first accepted link counts, else its last reason."""
    strategy = strategy_of(domain, document, slots)
    if not html:
        return []
    if domain == "milanuncios.com" and re.search(any_of(BLOCKED), html.lower()):
        return [(0, "blocked_listing_page", {})]
    out = []
    for position, card in enumerate(cards_of(parse(html), strategy.cards), 1):
        reason, fields = "missing_anchor", None
        for anchor in anchors_of(card, strategy.links):
            fields, why = read_card(card, anchor, strategy, base)
            if fields:
                break
            reason = why or "non_detail_url"
        out.append((position, None if fields else reason, fields or {}))
    return out


def cards(pages: DataFrame, slots: Mapping[str, Slots] | None = None) -> DataFrame:
    """(page_id, source_domain, card_position, rejection_reason, fields…) of ``pages`` (page_id, source_domain, base_url,
    html, and of OVERLAID what the sources' documents set). Null HTML has no cards; a page that can't be read is one row
    with the error as its reason. ``slots`` has a caller's functions by domain."""
    set_ = [c for c in (*OVERLAID, SECOND_NAME) if c in pages.columns]
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for page, domain, base, html, *values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                try:
                    found = read_page(html, domain or "", base or "", dict(zip(set_, values, strict=True)), slots)
                except Exception as e:  # one page's fault stays with it
                    found = [(0, f"error: {type(e).__name__}", {})]
                rows += [(page, domain, position, reason, *(fields.get(f) for f in FIELDS)) for position, reason, fields in found]
            if rows:
                kinds = [batch.column(0).type, pa.string(), pa.int32(), *[pa.string()] * (1 + len(FIELDS))]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["page_id", "source_domain", "card_position", "rejection_reason", *FIELDS])

    return pages.select("page_id", "source_domain", "base_url", "html", *set_).mapInArrow(run, f"page_id {kind}, source_domain string, card_position int, rejection_reason string, " + ", ".join(f"{f} string" for f in FIELDS))


def candidates(read: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Accepted cards with identity: external_id, canonical_url, listing_key, dedupe_key, dedupe_method; and ``keep``."""
    found = read.filter("rejection_reason is null")
    own = F.coalesce(filled(F.col("card_external_id")), ids.external_id(F.col("source_domain"), F.col("candidate_url")))
    value = numbers.price(F.col("price_text"), F.col("raw_text"))["value"]
    found = found.withColumn("external_id", own).withColumn("price_value", value)
    none = F.lit(None).cast("string")
    found = ids.identified(found, F.col("source_domain"), F.col("candidate_url"), F.col("external_id"), F.col("title_text"), F.col("price_value"), F.col("price_text"), F.col("location_text"), none.cast("double"), F.col("surface_text"))
    return found.select(
        *read.columns[:3],
        "candidate_url",
        F.coalesce(filled(F.col("_id.canonical_url")), urls.canonical(F.col("candidate_url"))).alias("canonical_url"),
        "title_text",
        "price_text",
        "price_value",
        "location_text",
        "surface_text",
        "rooms_text",
        "external_id",
        "_id.listing_key",
        F.coalesce(filled(F.col("external_id")), filled(F.col("_id.canonical_url")), F.col("_id.listing_key")).alias("dedupe_key"),
        F.when(filled(F.col("external_id")).isNotNull(), F.lit("external_id")).otherwise(F.col("_id.dedupe_method")).alias("dedupe_method"),
        F.substring("raw_text", 1, 600).alias("raw_text"),
        *keep,
    )


def richest(found: DataFrame, seq: str, within: list[str]) -> DataFrame:
    """Of candidates with one key the one with most fields, the first of equals. A missing key falls back to the listing's
    key, then to its URL."""
    key = F.coalesce(filled(F.col("dedupe_key")), filled(F.col("listing_key")), F.col("candidate_url"))
    score = filled_count(*[F.col(c) for c in ("title_text", "price_text", "location_text", "surface_text", "rooms_text")])
    return best_by_key(found.withColumn("_key", key), [*within, "_key"], score, seq).drop("_key")
