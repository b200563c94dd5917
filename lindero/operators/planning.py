"""Which sources a job may use, which URLs it starts from, which listing pages it reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls
from ..functions.portals import PORTALS
from ..functions.text import filled

MISSING, DISABLED, NO_ARCHIVER, NO_HARVEST, NO_START = "missing_source", "disabled", "archiver_disabled", "harvest_disabled", "missing_listing_start_urls"


def job_sources(jobs: DataFrame, sources: DataFrame, harvest: bool = False) -> DataFrame:
    """Each (job_name, place, domain) of a job's list with its source and the first reason why it can't be used
    (null: it can). ``harvest`` asks for listing pages, too."""
    listed = jobs.select("job_name", F.posexplode_outer("sources").alias("place", "domain")).filter("domain is not null")
    out = listed.join(sources.withColumn("_there", F.lit(True)), "domain", "left")
    reason = F.when(F.col("_there").isNull(), MISSING).when(~F.coalesce("enabled", F.lit(True)), DISABLED).when(~F.coalesce("archiver_enabled", F.lit(True)), NO_ARCHIVER)
    if harvest:
        reason = reason.when(~F.coalesce("harvest_enabled", F.lit(False)), NO_HARVEST).when(F.coalesce(F.size("listing_start_urls"), F.lit(0)) < 1, NO_START)
    return out.withColumn("reason", reason).drop("_there")


def seed_urls(eligible: DataFrame, max_urls: int | None = None) -> DataFrame:
    """(url, domain, place) of the eligible sources' start URLs: each once, in order, at most ``max_urls`` of them
    (none or zero: all), and ``times`` it was listed."""
    each = eligible.filter("reason is null").select("place", "domain", F.posexplode("start_urls").alias("ordinal", "url")).filter(filled(F.col("url")).isNotNull())
    seq = F.struct("place", "ordinal")
    once = each.groupBy("url").agg(F.min(seq).alias("seq"), F.min_by("domain", seq).alias("domain"), F.count("*").alias("times")).orderBy("seq")
    return (once.limit(max_urls) if max_urls else once).select("url", "domain", F.col("seq.place").alias("place"), F.col("seq.ordinal").alias("ordinal"), "times")


def pages_of(start: Column, first: Column, count: Column, parameter: Column, template: Column, first_is_start: Column) -> Column:
    """array<struct<page_number, url, strategy>> of a start URL."""
    return F.transform(F.sequence(first, first + count - 1), lambda n: F.struct(n.alias("page_number"), urls.page_url(start, n, first, parameter, template, first_is_start).alias("page")))


def page_plan(sources: DataFrame) -> DataFrame:
    """One row per listing page of ``sources``: start URLs times page numbers, in order, with how the URL was made."""
    first, count = F.coalesce(F.nullif("listing_page_start", F.lit(0)), F.lit(1)), F.greatest(F.coalesce("max_listing_pages", F.lit(1)), F.lit(1))
    each = sources.select("*", F.posexplode("listing_start_urls").alias("start_ordinal", "listing_start_url")).filter(filled(F.col("listing_start_url")).isNotNull())
    planned = each.select("*", F.explode(pages_of(F.col("listing_start_url"), first, count, F.col("listing_page_param"), F.col("listing_page_url_template"), F.col("listing_first_page_uses_start_url"))).alias("_p"))
    return planned.select("domain", "parser_key", "start_ordinal", "listing_start_url", F.col("_p.page_number").alias("page_number"), F.col("_p.page.url").alias("listing_page_url"), F.col("_p.page.strategy").alias("pagination_strategy"))


def with_strategy(sources: DataFrame) -> DataFrame:
    """``sources`` with what their documents leave open filled in from their portal, if it is known: start URLs of listing
    pages, how many pages, page parameter, page template. A list without a filled entry, an empty text and a number that is
    null count as left open (a zero number of pages is one); a source of no known portal has one page."""
    known = sources.sparkSession.createDataFrame([(p.domain, list(p.starts), p.max_pages, p.page_param, p.page_template) for p in PORTALS], "domain string, _starts array<string>, _most int, _param string, _template string")
    out = sources.join(F.broadcast(known), "domain", "left")  # one row a portal
    columns = {f.name: f.dataType.simpleString() for f in sources.schema}

    def own(name: str, kind: str) -> Column:
        return F.col(name) if name in columns else F.lit(None).cast(kind)

    starts = F.filter(own("listing_start_urls", "array<string>"), lambda u: filled(F.trim(u)).isNotNull())
    made = {
        "listing_start_urls": F.when(F.size(starts) > 0, starts).otherwise(F.coalesce("_starts", F.array().cast("array<string>"))),
        "max_listing_pages": F.coalesce(F.nullif(F.coalesce(own("max_listing_pages", "int"), F.col("_most")), F.lit(0)), F.lit(1)),
        "listing_page_param": filled(F.trim(F.coalesce(filled(own("listing_page_param", "string")), F.col("_param")))),
        "listing_page_url_template": filled(F.trim(F.coalesce(filled(own("listing_page_url_template", "string")), F.col("_template")))),
    }
    return out.withColumns(made).select(*dict.fromkeys([*sources.columns, *made]))
