"""Keyed history of listings: normalisation, upsert of a day's batch, the delta of new ones, workflow status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import identity as ids
from ..functions.portals import SLUGS
from ..functions.text import clean, filled, number_or_null, whole_or_null
from .ordered import last_by_key

BUSINESS = ("source_domain", "url_final", "title", "price_text", "price_value", "location_text", "surface_sqm", "rooms_count", "parser_key", "parse_status")
WORKFLOW = ("workflow_status", "workflow_updated_at", "workflow_note")
STATUSES = ("pending", "processed", "discarded")
MASTER_DDL = "portal string, source_domain string, external_id string, canonical_url string, dedupe_method string, listing_key string, title string, price_text string, price_value double, location_text string, surface_sqm double, rooms_count int, url_final string, parser_key string, parse_status string, workflow_status string, workflow_updated_at string, workflow_note string, first_seen_date date, last_seen_date date, seen_count int"
STATUS_DDL = "listing_key string, workflow_status string, workflow_updated_at string, workflow_note string"


def column_or_null(df: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def normalized(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The 15 columns of a publishable listing from records of any subset of the business columns (and ``seq``); further
    columns that are to stay are named in ``keep``."""

    def text(name: str) -> Column:
        return clean(column_or_null(records, name))

    value, area = number_or_null(column_or_null(records, "price_value")), number_or_null(column_or_null(records, "surface_sqm"))
    words = ("source_domain", "external_id", "title", "price_text", "location_text", "surface_text", "parser_key", "parse_status")
    made = [text(c).alias(c) for c in words]
    made += [F.coalesce(filled(text("url_final")), text("url_original")).alias("url_final"), value.alias("price_value"), area.alias("surface_sqm"), whole_or_null(column_or_null(records, "rooms_count")).alias("rooms_count")]
    cleaned = records.select(*made, "seq", *[c for c in keep if c not in {*words, "url_final", "price_value", "surface_sqm", "rooms_count", "seq"}])
    c = {n: F.col(n) for n in cleaned.columns}
    who = ids.identified(cleaned, c["source_domain"], c["url_final"], c["external_id"], c["title"], c["price_value"], c["price_text"], c["location_text"], c["surface_sqm"], c["surface_text"])
    return who.select(
        "_id.portal",
        F.coalesce(filled(F.col("source_domain")), F.lit("unknown-domain")).alias("source_domain"),
        "_id.external_id",
        "_id.canonical_url",
        "_id.dedupe_method",
        "_id.listing_key",
        *("title", "price_text", "price_value", "location_text", "surface_sqm", "rooms_count", "url_final", "parser_key", "parse_status", "seq"),
        *keep,
    )


def deduplicated(listings: DataFrame) -> DataFrame:
    """The last record of each listing_key; ``seq`` becomes where the key came first."""
    return last_by_key(listings, ["listing_key"], "seq").drop("seq").withColumnRenamed("first_seq", "seq")


def with_workflow(current: DataFrame, master: DataFrame, status: DataFrame, now: str) -> DataFrame:
    """``current`` with its workflow: that of its status row if there is one (even an empty one), else of its master
    row, else pending."""
    own = status.select("listing_key", F.struct(*WORKFLOW).alias("_s"))
    old = master.select("listing_key", F.struct(*WORKFLOW).alias("_m"))
    default = F.struct(F.lit("pending").alias("workflow_status"), F.lit(now).alias("workflow_updated_at"), F.lit(None).cast("string").alias("workflow_note"))
    out = current.join(own, "listing_key", "left").join(old, "listing_key", "left").withColumn("_w", F.coalesce("_s", "_m", default))
    return out.select(*current.columns, F.coalesce(filled(F.col("_w.workflow_status")), F.lit("pending")).alias("workflow_status"), F.coalesce(filled(F.col("_w.workflow_updated_at")), F.lit(now)).alias("workflow_updated_at"), F.col("_w.workflow_note").alias("workflow_note"))


def upserted(current: DataFrame, master: DataFrame, day: Column, status: DataFrame | None = None, now: str = "", only_batch: bool = False) -> DataFrame:
    """Master history after ``current`` (one row per key) was seen on ``day``; ``in_batch`` marks its keys, ``known`` those that
    were there before.

    A value of today replaces yesterday's even if it is null. A second run on one day changes no count; a key seen
    before counts one more, whatever the order of days. Rows that are not in the batch stay as they are, or are left out
    (``only_batch``). With ``status`` the rows of the batch get their workflow as :func:`with_workflow` tells it, by the
    same join, else ``current`` has it already.
    """
    cur = current.drop("seq")
    left = cur.select(F.col("listing_key"), F.struct(*cur.columns).alias("c"))
    if status is not None:
        left = left.join(status.select("listing_key", F.struct(*WORKFLOW).alias("s")), "listing_key", "left")
    right = master.select(F.col("listing_key"), F.struct(*master.columns).alias("m"))
    both = left.join(right, "listing_key", "left" if only_batch else "full_outer")
    seen, known = F.col("c").isNotNull(), F.col("m").isNotNull()
    own: dict[str, Column] = {}
    if status is not None:
        old = F.when(known, F.struct(*[F.col(f"m.{c}") for c in WORKFLOW]))
        w = F.coalesce(F.col("s"), old, F.struct(F.lit("pending").alias("workflow_status"), F.lit(now).alias("workflow_updated_at"), F.lit(None).cast("string").alias("workflow_note")))
        own = {"workflow_status": F.coalesce(filled(w["workflow_status"]), F.lit("pending")), "workflow_updated_at": F.coalesce(filled(w["workflow_updated_at"]), F.lit(now)), "workflow_note": w["workflow_note"]}

    def field(name: str) -> Column:
        old = F.col(f"m.{name}")
        if name in own:
            return F.when(seen, own[name]).otherwise(old)
        return F.when(seen, F.col(f"c.{name}")).otherwise(old) if name in cur.columns else old

    count = F.when(~seen, F.col("m.seen_count")).when(~known, F.lit(1)).when(F.col("m.last_seen_date") == day, F.coalesce(F.nullif("m.seen_count", F.lit(0)), F.lit(1))).otherwise(F.coalesce("m.seen_count", F.lit(0)) + 1)
    values = {
        "first_seen_date": F.when(seen, F.coalesce("m.first_seen_date", day)).otherwise(F.col("m.first_seen_date")),
        "last_seen_date": F.when(seen, day).otherwise(F.col("m.last_seen_date")),
        "seen_count": count.cast("int"),
    }
    told = [F.col("s").isNotNull().alias("told")] if status is not None else []
    return both.select(*[values.get(c, field(c)).alias(c) if c != "listing_key" else F.col(c) for c in master.columns], seen.alias("in_batch"), known.alias("known"), *told)


def sorted_history(master: DataFrame) -> DataFrame:
    """History as it is shown and exported: by portal, last day and title, the greatest first, equal ones by key."""
    return master.orderBy(F.desc_nulls_last("portal"), F.desc_nulls_last("last_seen_date"), F.desc_nulls_last("title"), "listing_key")


def new_on(day: Column) -> Column:
    """The listing is in the batch and was first seen on that day; a second run of the day gives it again."""
    return F.col("in_batch") & (F.col("first_seen_date") == day)


def first_seen_on(day: Column) -> Column:
    """The listing was first seen on that day, in whichever of its batches."""
    return (F.col("first_seen_date") == day) & (F.col("last_seen_date") == day)


def status_after(status: DataFrame, current: DataFrame) -> DataFrame:
    """The status store with a row for every current key: its resolved workflow replaces what was there."""
    return status.join(current.select("listing_key"), "listing_key", "left_anti").select("listing_key", *WORKFLOW).unionByName(current.select("listing_key", *WORKFLOW))


def status_set(status: DataFrame, key: str, workflow_status: str, now: str, note: str | None = None) -> DataFrame:
    """One key's status changed or added; without a note the old one stays. ValueError for an unknown status or no key."""
    if workflow_status not in STATUSES:
        raise ValueError(f"workflow status {workflow_status!r} is none of {', '.join(STATUSES)}")
    if not key:
        raise ValueError("a listing key is needed")
    spark = status.sparkSession
    new = spark.range(1).select(F.lit(key).alias("listing_key"), F.lit(workflow_status).alias("workflow_status"), F.lit(now).alias("workflow_updated_at"), F.lit(note).cast("string").alias("_note"))
    out = status.join(new.select(F.col("listing_key"), F.struct("workflow_status", "workflow_updated_at", "_note").alias("_new")), "listing_key", "full_outer")
    return out.select(
        "listing_key",
        F.coalesce("_new.workflow_status", "workflow_status").alias("workflow_status"),
        F.coalesce("_new.workflow_updated_at", "workflow_updated_at").alias("workflow_updated_at"),
        F.coalesce("_new._note", "workflow_note").alias("workflow_note"),
    )


def status_applied(master: DataFrame, status: DataFrame) -> DataFrame:
    """Master rows with the workflow of their status rows."""
    own = status.select("listing_key", F.struct(*WORKFLOW).alias("_s"))
    out = master.join(own, "listing_key", "left")
    return out.select(*[F.when(F.col("_s").isNotNull(), F.col(f"_s.{c}")).otherwise(F.col(c)).alias(c) if c in WORKFLOW else F.col(c) for c in master.columns])


def edits(original: DataFrame, edited: DataFrame) -> DataFrame:
    """The (listing_key, workflow_status, workflow_note) that differ from the original."""
    a, b = original.alias("a"), edited.alias("b")
    changed = ~F.col("a.workflow_status").eqNullSafe(F.col("b.workflow_status")) | ~F.coalesce("a.workflow_note", F.lit("")).eqNullSafe(F.coalesce("b.workflow_note", F.lit("")))
    return a.join(b, "listing_key").filter(changed).select("listing_key", "b.workflow_status", "b.workflow_note")


def with_relevance(candidates: DataFrame, history: DataFrame, day: Column) -> DataFrame:
    """``selected`` and ``selection_reason``: new keys, and those not seen yet on ``day``, are selected."""
    old = history.select("listing_key", F.col("last_seen_date").alias("_last"), F.lit(True).alias("_known"))
    out = candidates.join(old, "listing_key", "left")
    reason = F.when(F.col("_known").isNull(), "new_listing_key").when(F.col("_last").eqNullSafe(day), "already_seen_today").otherwise("seen_previous_day")
    return out.select(*candidates.columns, (reason != "already_seen_today").alias("selected"), reason.alias("selection_reason"))


def portal_counts(listings: DataFrame) -> DataFrame:
    """(portal, n) of the known portals, zero where there is none."""
    counted = listings.groupBy("portal").agg(F.count("*").alias("n"))
    known = listings.sparkSession.createDataFrame([(s,) for s in SLUGS], "portal string")
    return known.join(counted, "portal", "left").select("portal", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def replayed(batches: DataFrame, day: str, seq: str, keys: list[str]) -> DataFrame:
    """History of many days at once, for days that come in order: first and last day, and the number of days."""
    return batches.groupBy(*keys).agg(F.min(day).alias("first_seen_date"), F.max(day).alias("last_seen_date"), F.countDistinct(day).alias("seen_count"), F.max_by(F.col(seq), F.col(seq)).alias("last_seq"))
