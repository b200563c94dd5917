"""Sources and jobs from JSON documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_json

SOURCE_DDL = "domain string, enabled boolean, mode string, start_urls array<string>, rate_limit_seconds double, login_allowed boolean, parser_key string, notes string, timeout_seconds double, archiver_enabled boolean, harvest_enabled boolean, listing_start_urls array<string>, max_listing_pages int, listing_page_start int, listing_page_param string, listing_page_url_template string, listing_first_page_uses_start_url boolean, listing_card_selectors array<string>, listing_detail_link_selectors array<string>, listing_detail_url_patterns array<string>, listing_reject_url_patterns array<string>, listing_block_patterns array<string>, detail_link_selectors array<string>"
JOB_DDL = "job_name string, sources array<string>, filters map<string,string>, max_urls int, notes string"
# Keys that a document must have, and what others default to (fixed values).
SOURCE_REQUIRED = ("domain", "enabled", "mode", "start_urls", "rate_limit_seconds", "login_allowed", "parser_key")
JOB_REQUIRED = ("job_name", "sources")
SOURCE_DEFAULTS = {"timeout_seconds": 20.0, "archiver_enabled": True, "harvest_enabled": False, "max_listing_pages": 1, "listing_page_start": 1, "listing_first_page_uses_start_url": True}


def with_defaults(sources: DataFrame) -> DataFrame:
    """``sources`` with the defaults of what their documents leave out; listing pages start where the source does."""
    out = sources.na.fill({k: v for k, v in SOURCE_DEFAULTS.items() if k in sources.columns})
    if {"start_urls", "listing_start_urls"} <= set(out.columns):
        out = out.withColumn("listing_start_urls", F.coalesce("listing_start_urls", "start_urls"))
    return out


def validated(df: DataFrame, required: tuple[str, ...], filled_lists: tuple[str, ...] = ()) -> DataFrame:
    """``df``; ValueError if a required key is missing in any document, or a list that is there is empty (documents are few)."""
    empty = F.filter(F.array(*[F.when(F.size(k) == 0, F.lit(k)) for k in filled_lists]), lambda k: k.isNotNull()) if filled_lists else F.array().cast("array<string>")
    hollow = df.select(empty.alias("_empty")).filter(F.size("_empty") > 0).take(1)
    if hollow:
        raise ValueError(f"{', '.join(hollow[0][0])} must not be an empty list")
    missing = F.filter(F.array(*[F.when(F.col(k).isNull(), F.lit(k)) for k in required]), lambda k: k.isNotNull())
    bad = df.withColumn("_missing", missing).filter(F.size("_missing") > 0).select("_missing").take(1)
    if bad:
        raise ValueError(f"a document lacks {', '.join(bad[0][0])}")
    return df


def load_sources(spark: SparkSession, path: str) -> DataFrame:
    return validated(with_defaults(read_json(spark, path, SOURCE_DDL)), SOURCE_REQUIRED, ("start_urls", "listing_start_urls")).orderBy("domain")


def load_jobs(spark: SparkSession, path: str) -> DataFrame:
    return validated(read_json(spark, path, JOB_DDL), JOB_REQUIRED, ("sources",)).orderBy("job_name")


def by_key(df: DataFrame, key: str, value: str) -> dict:
    """The one row with that key; KeyError if there is none."""
    row = df.filter(F.col(key) == value).limit(1).collect()
    if not row:
        raise KeyError(value)
    return row[0].asDict(True)


def matching(df: DataFrame, **wanted: object) -> DataFrame:
    """Rows that equal all the values that are given; none and empty ones do not filter."""
    for name, value in wanted.items():
        if value not in (None, ""):
            df = df.filter(F.col(name) == value)
    return df
