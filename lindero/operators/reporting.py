"""Counts of runs, harvests and the funnel from listing pages to parsed listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.portals import BY_DOMAIN

METRICS = ("listing_pages_fetched", "listing_pages_ok", "cards_detected", "candidates_emitted", "candidates_rejected_by_rules", "candidates_deduped_out", "candidates_already_seen", "candidates_sent_to_detail")
DETAIL = ("detail_archive_ok", "detail_archive_error", "parsed_detail_ok", "parsed_detail_partial", "parsed_detail_error")
TOTAL = "total"


def status_counts(status: Column) -> list[Column]:
    """How many are ok, partial, or anything else (an error)."""
    return [F.count_if(status == "ok").alias("ok"), F.count_if(status == "partial").alias("partial"), F.count_if(~F.coalesce(status.isin("ok", "partial"), F.lit(False))).alias("error")]


def detail_count(kind: str = "page_kind") -> Column:
    return F.count_if(F.col(kind) == "detail")


def page_errors(pages: DataFrame) -> DataFrame:
    """(source_domain, listing_page_url, error) of the listing pages that are not read, as their status is not ok or partial."""
    unread = pages.filter(~F.coalesce(F.col("status").isin("ok", "partial"), F.lit(False)))
    return unread.select("source_domain", F.col("url").alias("listing_page_url"), F.concat(F.lit("listing_snapshot_status_"), F.coalesce(F.nullif("status", F.lit("")), F.lit("unknown"))).alias("error"))


def reason_map(rows: DataFrame, by: str, reason: str) -> DataFrame:
    """(by, rejection_reasons map<string,long>)."""
    counted = rows.filter(F.col(reason).isNotNull()).groupBy(by, reason).agg(F.count("*").alias("n"))
    return counted.groupBy(by).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(reason, "n")))).alias("rejection_reasons"))


def rolled_up(rows: DataFrame, by: str, metrics: list[str]) -> DataFrame:
    """Sums of ``metrics`` by ``by`` and, as ``total``, of all."""
    return rows.rollup(by).agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in metrics], F.grouping(by).alias("_all")).select(F.when(F.col("_all") == 1, F.lit(TOTAL)).otherwise(F.col(by)).alias(by), *metrics)


def harvested(pages: DataFrame, cards: DataFrame, candidates: DataFrame) -> DataFrame:
    """source_domain and METRICS of a harvest: ``pages`` (source_domain, status), ``cards`` (source_domain, card_position,
    rejection_reason; position 0 stands for a page that has none), ``candidates`` (source_domain, selected), which are those
    that are left of the accepted cards once equal ones are one."""
    ok, card = F.col("status").isin("ok", "partial"), F.col("card_position") > 0
    fetched = pages.groupBy("source_domain").agg(F.count("*").alias("listing_pages_fetched"), F.count_if(F.coalesce(ok, F.lit(False))).alias("listing_pages_ok"))
    read = cards.groupBy("source_domain").agg(F.count_if(card).alias("cards_detected"), F.count_if(F.col("rejection_reason").isNull()).alias("candidates_emitted"), F.count_if(card & F.col("rejection_reason").isNotNull()).alias("candidates_rejected_by_rules"))
    left = candidates.groupBy("source_domain").agg(F.count("*").alias("_left"), F.count_if("selected").alias("candidates_sent_to_detail"), F.count_if(~F.col("selected")).alias("candidates_already_seen"))
    every = fetched.join(read, "source_domain", "full_outer").join(left, "source_domain", "full_outer").na.fill(0)
    return every.withColumn("candidates_deduped_out", F.greatest(F.col("candidates_emitted") - F.col("_left"), F.lit(0))).select("source_domain", *METRICS)


def funnel(harvest: DataFrame, archived: DataFrame, parsed: DataFrame, errors: DataFrame) -> DataFrame:
    """One row per known portal and one in total: listing metrics, archived pages, parsed listings.

    ``harvest``: source_domain and the metrics; ``archived``: source_domain, status, snapshot_path; ``parsed``:
    source_domain, page_kind, parse_status (only detail pages count); ``errors``: snapshot_path, error, which add to the
    parse errors of the portal whose archived page it is. The total is over all portals, known or not.
    """
    ok = F.col("status").isin("ok", "partial")
    stages = [
        harvest.select(F.col("source_domain").alias("portal"), *METRICS),
        archived.select(F.col("source_domain").alias("portal"), F.coalesce(ok, F.lit(False)).cast("long").alias("detail_archive_ok"), F.coalesce(~ok, F.lit(True)).cast("long").alias("detail_archive_error")),
        parsed.filter("page_kind = 'detail'").select(
            F.col("source_domain").alias("portal"),
            (F.col("parse_status") == "ok").cast("long").alias("parsed_detail_ok"),
            (F.col("parse_status") == "partial").cast("long").alias("parsed_detail_partial"),
            (~F.coalesce(F.col("parse_status").isin("ok", "partial"), F.lit(False))).cast("long").alias("parsed_detail_error"),
        ),
        errors.join(archived.select("snapshot_path", F.col("source_domain").alias("portal")).distinct(), "snapshot_path").select("portal", F.lit(1).cast("long").alias("parsed_detail_error")),
    ]
    rows = stages[0]
    for stage in stages[1:]:
        rows = rows.unionByName(stage, allowMissingColumns=True)
    summed = rolled_up(rows, "portal", [*METRICS, *DETAIL])
    known = harvest.sparkSession.createDataFrame([(d,) for d in [*BY_DOMAIN, TOTAL]], "portal string")
    return known.join(summed, "portal", "left").na.fill(0)
