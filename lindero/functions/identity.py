"""Identity of a listing: portal, external id, canonical URL, and the key they make."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import urls
from .portals import PORTALS, SLUGS, UNKNOWN_SLUG
from .text import clean, filled, let, number_text, short_hash


def portal_slug(domain: Column) -> Column:
    """The first known portal whose name the domain contains, else the domain; without one ``desconocido``."""
    low = F.lower(clean(domain))
    out = F.coalesce(filled(low), F.lit(UNKNOWN_SLUG))
    for slug in reversed(SLUGS):
        out = F.when(F.contains(low, F.lit(slug)), F.lit(slug)).otherwise(out)
    return out


def portal_label(domain: Column) -> Column:
    return F.initcap(portal_slug(domain))


def external_id(domain: Column, url: Column) -> Column:
    """The id in a listing's URL by its portal's patterns, else the last run of five or more digits in the path."""
    return let(F.struct(portal_slug(domain).alias("slug"), urls.path(urls.canonical(url)).alias("p")), lambda x: _id_in(x["slug"], x["p"]))


def _id_in(slug: Column, p: Column) -> Column:
    def tried(patterns: tuple[str, ...]) -> Column:
        return F.coalesce(*[filled(F.regexp_extract(p, f"(?i){x}", 1)) for x in patterns])

    own = tried((r"/(\d{5,})/?$",))
    for portal in PORTALS:
        own = F.when(slug == portal.slug, tried(portal.ids)).otherwise(own)
    return F.coalesce(own, F.try_element_at(F.regexp_extract_all(p, F.lit(r"(\d{5,})"), 1), F.lit(-1)))


IDENTITY = ("portal", "external_id", "canonical_url", "dedupe_method", "listing_key")


def identified(df: DataFrame, source_domain: Column, url: Column, given_id: Column, title: Column, price_value: Column, price_text: Column, location: Column, surface_value: Column, surface_text: Column) -> DataFrame:
    """``df`` with ``_id``: struct(portal, external_id, canonical_url, dedupe_method, listing_key).

    The key is the external id (given, or from the URL), else the canonical URL, else a fingerprint of title, price,
    location and surface. Numbers in it are written with a decimal mark; zero counts as missing. What later steps use
    several times is a column of its own, so that it is computed once and in compiled code.
    """

    def value_or_text(value: Column, text: Column) -> Column:
        return F.lower(clean(F.coalesce(number_text(F.nullif(value.cast("double"), F.lit(0.0))), text)))

    one = df.select("*", F.coalesce(filled(clean(source_domain)), F.lit("unknown-domain")).alias("_domain"), clean(url).alias("_raw"), clean(given_id).alias("_given"))
    one = one.withColumn("_print", F.concat_ws("|", "_domain", F.lower(clean(title)), value_or_text(price_value, price_text), F.lower(clean(location)), value_or_text(surface_value, surface_text)))
    two = one.select("*", urls.scheme(F.col("_raw")).alias("_s"), urls.host(F.col("_raw")).alias("_h"), F.regexp_replace(urls.path(F.col("_raw")), "/+$", "").alias("_p"))
    two = two.withColumn("_canonical", F.when(F.col("_raw") == "", F.lit("")).otherwise(urls.joined(F.col("_s"), F.col("_h"), F.col("_p"))))
    three = two.select("*", portal_slug(F.col("_domain")).alias("_portal"), urls.path(F.col("_canonical")).alias("_path"))
    three = three.withColumn("_found", F.coalesce(filled(F.col("_given")), _id_in(F.col("_portal"), F.col("_path")), F.lit("")))
    found, canonical, domain = (F.col(c) for c in ("_found", "_canonical", "_domain"))
    method = F.when(found != "", F.lit("external_id")).when(canonical != "", F.lit("canonical_url")).otherwise(F.lit("fingerprint"))
    key = F.when(found != "", F.concat(domain, F.lit(":id:"), found)).when(canonical != "", F.concat(domain, F.lit(":url:"), canonical)).otherwise(F.concat(domain, F.lit(":fingerprint:"), short_hash(F.col("_print"))))
    key = F.coalesce(key, F.lit(""))  # never null, and known to be: joins then push no test of it below these steps
    whole = F.struct(*[c.alias(n) for c, n in zip((F.col("_portal"), found, canonical, method, key), IDENTITY, strict=True)])
    return three.select(*df.columns, whole.alias("_id"))
