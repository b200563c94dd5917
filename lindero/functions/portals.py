"""What is known of each portal (fixed values), and predicates built from it."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Portal(NamedTuple):
    slug: str
    domain: str
    ids: tuple[str, ...]
    detail: tuple[str, ...]
    reject: tuple[str, ...]
    drop_keys: tuple[str, ...]
    cards: tuple[str, ...]
    links: tuple[str, ...]
    keep_query: bool = False
    page_param: str | None = None
    page_template: str | None = None
    max_pages: int = 1
    starts: tuple[str, ...] = ()


# Fixed values of the portals: patterns of ids, detail and other pages, dropped keys, selectors, pages and start URLs.
PORTALS = (
    Portal(
        "fotocasa",
        "fotocasa.es",
        (r"/(\d+)/d$", r"/(\d+)/?$"),
        (r"/\d+/d(?:\?|$)", r"/inmueble/\d+", r"/es/(alquiler|comprar)/naves-industriales/", r"/es/(alquiler|comprar)/locales/"),
        (r"/inmobiliaria", r"/agencia", r"/perfil", r"/l/\d+(?:\?|$)", r"/crear-alerta", r"/contactar", r"/contacto", r"/mapa", r"/favoritos", r"/share", r"/whatsapp", r"javascript:", r"mailto:", r"tel:"),
        ("from", "multimedia", "isgalleryopen", "iszoomgalleryopen", "page", "pagina"),
        ("article", "[class*='re-Card']", "[class*='re-SearchResult']", "[data-testid*='card']", "[data-testid*='search']"),
        ("a[href*='/d']", "a[href*='/comprar/']", "a[href*='/alquiler/']"),
        page_param="pagina",
        max_pages=4,
        starts=(
            "https://www.fotocasa.es/es/alquiler/naves-industriales/bizkaia-provincia/todas-las-zonas/l",
            "https://www.fotocasa.es/es/comprar/naves-industriales/bizkaia-provincia/todas-las-zonas/l",
            "https://www.fotocasa.es/es/alquiler/naves-industriales/poi/cercanias-zorrotza-bizkaia/l",
            "https://www.fotocasa.es/es/alquiler/naves-industriales/bizkaia-provincia/duranguesado/l",
            "https://www.fotocasa.es/es/alquiler/naves-industriales/bizkaia-provincia/uribe/l",
            "https://www.fotocasa.es/es/comprar/locales/bizkaia-provincia/todas-las-zonas/l",
        ),
    ),
    Portal(
        "idealista",
        "idealista.com",
        (r"/inmueble/(\d+)/?$", r"/(\d+)/?$"),
        (r"/inmueble/\d+/?$",),
        (r"/agencia", r"/obra-nueva", r"/perfil", r"/mapa", r"/inmobiliaria", r"/favoritos", r"/publicar", r"/login", r"/pagina-\d+\.htm$"),
        ("utm_source", "utm_medium", "utm_campaign", "pagina", "page"),
        ("article", "li", "[data-testid*='listing']", "[data-testid*='property']", "[class*='item']", "[class*='card']"),
        ("a[href*='/inmueble/']",),
        page_template="https://www.idealista.com/alquiler-naves/bizkaia/pagina-{page}.htm",
        max_pages=4,
    ),
    Portal(
        "milanuncios",
        "milanuncios.com",
        (r"-(\d+)\.htm$", r"/(\d+)\.htm$"),
        (r"-\d+\.htm(?:\?|$)",),
        (r"/inmobiliaria", r"/profesional", r"/mis-anuncios", r"/buscador", r"/s?buscador", r"/login", r"/registro"),
        ("pagina", "page", "from", "ref", "utm_source", "utm_medium", "utm_campaign"),
        ("article[data-testid='AD_CARD']", "article[data-testid*='AD_CARD']", "[data-testid='AD_CARD']"),
        ("a.ma-AdCardListingV2-TitleLink[href]", "a[href$='.htm']"),
        page_param="pagina",
        max_pages=5,
    ),
    Portal(
        "pisos",
        "pisos.com",
        (r"-(\d{6,})_\d+/?$", r"/(\d{6,})_\d+/?$", r"/(\d+)_", r"/(\d+)/?$"),
        (r"/alquilar/[^/]+/\d+(?:_[^/]+)?/?$", r"/alquilar/[^/]*-\d+(?:_[^/]+)?/?$", r"/inmueble/\d+/?$"),
        (r"/alquiler/?$", r"/venta/?$", r"/naves-vizcaya_bizkaia/\d+/?$", r"/inmobiliaria", r"/agencia", r"/mapa", r"/obra-nueva", r"/login"),
        ("pagina", "page", "from", "utm_source", "utm_medium", "utm_campaign"),
        ("a.ad-preview__title[href]",),
        ("a.ad-preview__title[href]",),
        keep_query=True,
        page_template="{base}{page}/",
        max_pages=4,
        starts=("https://www.pisos.com/alquiler/naves-vizcaya_bizkaia/", "https://www.pisos.com/alquiler/naves-bilbao/", "https://www.pisos.com/alquiler/naves-barakaldo/", "https://www.pisos.com/alquiler/naves-basauri/"),
    ),
    Portal(
        "yaencontre",
        "yaencontre.com",
        (r"/inmueble/(\d+)/?$", r"/(\d+)/?$"),
        (r"/inmueble/\d+(?:/|$)", r"/\d{5,}(?:/|$)", r"/[a-z0-9-]+-\d{5,}(?:\.htm)?(?:\?|/|$)"),
        (r"/alquiler/", r"/venta/", r"/obra-nueva", r"/inmobiliaria", r"/agencia", r"/perfil", r"/mapa", r"/buscador", r"/resultados", r"/filtros?", r"/contacto", r"/favoritos", r"/alertas", r"/login", r"javascript:", r"mailto:", r"tel:"),
        ("from", "page", "pagina", "offset", "limit", "sort", "orden", "order", "ref", "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content"),
        ("article", "li", "[class*='card']", "[class*='item']", "[class*='result']", "[data-testid*='property']"),
        ("a[href*='/inmueble/']", "a[href]"),
        page_param="page",
        max_pages=5,
        starts=("https://www.yaencontre.com/alquiler/naves/bizkaia", "https://www.yaencontre.com/venta/naves/bizkaia"),
    ),
)
BY_DOMAIN = {p.domain: p for p in PORTALS}
SLUGS = tuple(p.slug for p in PORTALS)
UNKNOWN_SLUG = "desconocido"

#: Page that stands in for a listing when a portal turns a reader away (fixed values).
BLOCKED = (r"pardon our interruption", r"geetest", r"captcha", r"access denied", r"noindex, nofollow")
#: Links that are never listings (fixed values).
EXCLUDED_TOKENS = ("login", "signin", "register", "contact", "contacto", "favorit", "share", "compart", "whatsapp", "mailto:", "tel:", "javascript:", "#", "/inmobiliaria", "/agencia", "/perfil")
GALLERY_KEYS = ("multimedia", "isgalleryopen", "iszoomgalleryopen", "from")
#: Which links a parser takes up and which it passes over (fixed values).
LINK_RULES = {
    "generic": ((r"/inmueble", r"/ficha", r"/detalle", r"/anuncio", r"/d\?"), (r"/blog", r"/ayuda", r"/privacidad", r"/buscar", r"/resultados", r"/inmobiliaria", r"clientid=")),
    "generic_listing": ((r"/inmueble", r"/ficha", r"/detalle", r"/anuncio", r"/d\?"), (r"/contacto", r"/favoritos", r"/mapa", r"/inmobiliaria", r"/agencia", r"clientid=", r"/todas-las-zonas/l")),
    "idealista_listing": ((r"/inmueble/", r"\d{6,}"), (r"/agencia", r"/obra-nueva", r"/mapa", r"/perfil")),
    "fotocasa_detail": (
        (r"/d\?", r"/inmueble", r"/detalle", r"/es/comprar/vivienda", r"/es/alquilar/vivienda", r"/d$", r"/d/"),
        (r"/mapa", r"/agencia", r"/inmobiliaria", r"/perfil", r"/blog", r"/ayuda", r"clientid=", r"/todas-las-zonas/l", r"/es/comprar/locales/.*/l$", r"/es/alquilar/locales/.*/l$"),
    ),
}


def any_of(patterns: tuple[str, ...]) -> str:
    return "|".join(f"(?:{p})" for p in patterns)


def _found(text: Column, patterns: tuple[str, ...]) -> Column:
    return text.rlike(any_of(patterns)) if patterns else F.lit(False)


def is_detail(url: Column, domain: Column) -> Column:
    """The URL is one of a listing's own page by the rules of its portal; other portals have none."""
    low = F.lower(F.coalesce(url, F.lit("")))
    out = F.lit(False)
    for p in PORTALS:
        out = F.when(domain == p.domain, (low != "") & ~_found(low, p.reject) & _found(low, p.detail)).otherwise(out)
    return out


def on_host(url: Column, domain: Column) -> Column:
    """A web URL's host is the domain or below it; without a domain, and for what is no web URL, that is not asked."""
    host = F.regexp_extract(F.lower(url), "^https?://([^/]+)", 1)
    return (host == "") | (F.coalesce(domain, F.lit("")) == "") | (host == domain) | host.endswith(F.concat(F.lit("."), domain))


def is_detail_of(url: Column, domain: Column, detail: Column, reject: Column) -> Column:
    """The URL is on the source's host and is a listing's own page: not by the patterns ``reject`` of its document (or, if
    that has none, of its portal), and by those of its portal, or of ``detail`` for a portal that is not known."""
    low = F.lower(F.coalesce(url, F.lit("")))
    none = F.array().cast("array<string>")

    def listed(patterns: Column) -> Column:
        return F.filter(F.coalesce(patterns, none), lambda p: F.trim(p) != "")

    def matches(patterns: Column) -> Column:
        return F.exists(listed(patterns), lambda p: F.regexp_like(low, p))

    known = domain.isin(*BY_DOMAIN)
    rejected = F.when(F.size(listed(reject)) > 0, matches(reject)).otherwise(is_rejected(url, domain))
    return (low != "") & on_host(low, domain) & ~rejected & F.when(known, is_detail(url, domain)).otherwise(matches(detail))


def is_rejected(url: Column, domain: Column) -> Column:
    low = F.lower(F.coalesce(url, F.lit("")))
    out = F.lit(False)
    for p in PORTALS:
        out = F.when(domain == p.domain, _found(low, p.reject)).otherwise(out)
    return out


def is_blocked(html: Column, domain: Column) -> Column:
    return (domain == "milanuncios.com") & _found(F.lower(F.coalesce(html, F.lit(""))), BLOCKED)


def base_excluded(url: Column) -> Column:
    low = F.lower(url)
    return F.exists(F.array(*map(F.lit, EXCLUDED_TOKENS)), lambda t: F.contains(low, t))


def passes_rules(url: Column, parser_key: Column) -> Column:
    """Exclusions first, then any inclusion; an unknown parser key has the generic rules."""
    low = F.lower(url)

    def rule(key: str) -> Column:
        include, exclude = LINK_RULES[key]
        return ~_found(low, exclude) & (_found(low, include) if include else F.lit(True))

    out = rule("generic")
    for key in LINK_RULES:
        if key != "generic":
            out = F.when(parser_key == key, rule(key)).otherwise(out)
    return out
