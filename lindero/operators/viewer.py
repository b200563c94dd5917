"""What a viewer of published listings and their history asks for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identity import portal_label
from ..functions.text import filled
from .ordered import last_by_key

#: Labels of statuses and portals as they are shown (fixed values).
STATUS_LABELS = {"pending": "Pendiente", "processed": "Procesado", "discarded": "Descartado"}


def history_filtered(history: DataFrame, portal: str | None = None, status: str | None = None, day: str | None = None, text: str | None = None) -> DataFrame:
    """Rows of the portal and the status, first or last seen on the day, with the text in any column (as it is, in any
    case). What is not asked for does not filter."""
    out = history
    if portal:
        out = out.filter(F.col("portal") == portal)
    if status:
        out = out.filter(F.col("workflow_status") == status)
    if day:
        out = out.filter((F.col("first_seen_date").cast("string") == day) | (F.col("last_seen_date").cast("string") == day))
    if text and text.strip():
        low = text.strip().lower()
        cells = F.array(*[F.coalesce(F.lower(F.col(f"`{c}`").cast("string")), F.lit("")) for c in history.columns])
        out = out.filter(F.exists(cells, lambda x: F.contains(x, F.lit(low))))
    return out


def with_master(published: DataFrame, master: DataFrame, columns: list[str], seq: str) -> DataFrame:
    """Published rows whose ``columns`` take the master's value where it is not null (of repeated keys the last row)."""
    own = last_by_key(master, ["listing_key"], seq).select("listing_key", F.struct(*columns).alias("_m"))
    out = published.join(own, "listing_key", "left")
    return out.select(*[F.coalesce(F.col(f"_m.{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in published.columns])


def known_dates(history: DataFrame, *columns: str) -> DataFrame:
    """The distinct dates of several columns, latest first."""
    days = history.select(F.explode(F.array(*[F.col(c).cast("string") for c in columns])).alias("day"))
    return days.filter(filled(F.col("day")).isNotNull()).distinct().orderBy(F.desc("day"))


def pending_count() -> Column:
    return F.count_if(F.coalesce("workflow_status", F.lit("pending")) == "pending")


def view_table(listings: DataFrame, with_portal: bool = True) -> DataFrame:
    """Labels instead of codes, the surface with its unit, blanks instead of nulls."""
    label = F.coalesce(*[F.when(F.col("workflow_status") == k, F.lit(v)) for k, v in STATUS_LABELS.items()], F.lit(STATUS_LABELS["pending"]))
    area = F.when(F.col("surface_sqm").isNotNull(), F.concat(F.regexp_replace(F.col("surface_sqm").cast("string"), r"\.0$", ""), F.lit(" m²")))
    columns = {"title": F.col("title"), "price_text": F.col("price_text"), "location_text": F.col("location_text"), "surface": area, "rooms": F.col("rooms_count").cast("string"), "status": label, "url": F.col("url_final")}
    if with_portal:
        columns = {"portal": portal_label(F.col("source_domain")), **columns}
    return listings.select("listing_key", *[F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in columns.items()])


def client_summary(published: DataFrame, master: DataFrame) -> DataFrame:
    """One row: listings published, listings known, listings pending."""
    new = published.agg(F.count("*").alias("new_listings"))
    return new.crossJoin(master.agg(F.count("*").alias("known_listings"), pending_count().alias("pending")))  # one row each
