"""The steps from a job to parsed listings, each a table of its run; a step whose table is there is skipped on resume.

Fetching is a function that is passed in: from (url, seq, …) rows to (url, html, markdown). Nothing here opens a
connection by itself.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import aliases, cards, details, discovery, history, planning, reporting
from ..operators.ordered import latest_equal_before
from ..sources import tables as t
from ..sources.shared import settled
from . import publish

Fetch = Callable[[DataFrame], DataFrame]
STEPS = ("archive", "index", "discover", "listing_pages", "listing_errors", "listing_cards", "harvest", "archive_discovered", "parse", "export", "funnel")


def archived(urls: DataFrame, fetch: Fetch, local_markdown: bool = False) -> DataFrame:
    """Fetched pages with ids, hashes, status, and whether their content equals an earlier page of the URL and day. Each URL
    is fetched once; what the fetcher tells of it besides its texts stays. ``local_markdown``: pages that come without Markdown
    get that of their HTML."""
    found = fetch(urls.dropDuplicates(["url"]))
    told = [c for c in ("fetch_status", "http_status", "attempts", "fetch_error") if c in found.columns]
    found = found.select("url", "html", "markdown", *told)
    pages = settled(discovery.with_markdown(found) if local_markdown else found, "fetched")
    got = discovery.snapshot_keys(urls.join(pages, "url", "left"))
    got = got.withColumn("status", discovery.archive_status(F.col("html").isNotNull(), F.coalesce(F.length("markdown") > 0, F.lit(False))))
    return latest_equal_before(got, ["url", "day"], "seq", [("content_hash_preferred", "content_hash_match"), ("markdown_hash", "markdown_hash_match"), ("html_hash", "html_hash_match")])


class Run(NamedTuple):
    statuses: dict[str, str]
    status: str
    errors: list[dict[str, str]]


def overall(statuses: dict[str, str], archive_errors: int) -> str:
    """failed if a step failed, else partial if pages could not be archived, else completed."""
    if any(s == "failed" for k, s in statuses.items() if k != "funnel"):
        return "failed"
    return "partial" if archive_errors else "completed"


def run_job(spark: SparkSession, job: str, jobs: DataFrame, sources: DataFrame, root: str, run_id: str, day: str, fetch: Fetch, resume: bool = False, force: tuple[str, ...] = (), only: tuple[str, ...] = (), parsers: Sequence[details.Parser] = (), slots: Mapping[str, cards.Slots] | None = None, portal_defaults: bool = False, local_markdown: bool = False, clock: Callable[[], str] | None = None) -> Run:
    """All steps of a job's run below ``root/run_id``, or ``only`` some of them on what is there. A step that fails is noted
    and those that need it are skipped. ``parsers`` of detail pages and ``slots`` with functions for links are the
    caller's own; with ``portal_defaults`` what sources leave open of their listing pages comes from their portal; with
    ``local_markdown`` pages that come without Markdown get that of their HTML. ``clock``
    tells the times of the manifest; without one they are the beginning of ``day``."""
    began = clock() if clock else f"{day}T00:00:00Z"
    sources = planning.with_strategy(sources) if portal_defaults else sources
    base = f"{root}/{run_id}"
    statuses: dict[str, str] = {}
    errors: list[dict[str, str]] = []

    def table(step: str) -> DataFrame:
        return spark.read.parquet(f"{base}/{step}")

    def step(name: str, needs: tuple[str, ...], make: Callable[[], DataFrame]) -> None:
        if only and name not in only:
            statuses[name] = "skipped"
        elif any(statuses[n] == "failed" or (statuses[n] == "skipped" and not t.exists(spark, f"{base}/{n}")) for n in needs):
            statuses[name] = "skipped"
        elif resume and name not in force and t.exists(spark, f"{base}/{name}/_SUCCESS"):
            statuses[name] = "skipped"
        else:
            try:
                make().write.mode("overwrite").parquet(f"{base}/{name}")
                statuses[name] = "completed"
            except Exception as e:  # kept with the run; later steps are skipped
                statuses[name] = "failed"
                errors.append({"step": name, "error": f"{type(e).__name__}: {str(e)[:300]}"})

    own = jobs.filter(F.col("job_name") == job)
    limit = own.select("max_urls").first()
    eligible = planning.job_sources(own, sources)
    harvested = planning.job_sources(own, sources, harvest=True).filter("reason is null")
    today = F.lit(day).cast("date").alias("day")

    def seq(*order: str) -> F.Column:
        return F.xxhash64(*order).alias("seq")

    def gaps() -> DataFrame:
        """The seconds that a source's document asks for between two requests."""
        return sources.select("domain", history.column_or_null(sources, "rate_limit_seconds", "double").cast("double").alias("gap"))

    def seeds() -> DataFrame:
        first = planning.seed_urls(eligible, (limit or [None])[0])
        return archived(first.join(gaps(), "domain", "left").select("url", F.col("domain").alias("source_domain"), F.struct("place", "ordinal").alias("seq"), today, "gap"), fetch, local_markdown)

    def links() -> DataFrame:
        pages = table("archive").filter("status <> 'error'").join(sources.select(F.col("domain").alias("source_domain"), "parser_key"), "source_domain")
        return discovery.discovered(pages.withColumn("base_url", F.col("url")).withColumn("allowed_domain", F.col("source_domain")).withColumn("run", F.lit(run_id)), distinct_in="run").select("run", "url", "seq", "place")

    def listing_pages() -> DataFrame:
        plan = planning.page_plan(harvested).withColumnRenamed("listing_page_url", "url")
        return archived(plan.join(gaps(), "domain", "left").select("url", F.col("domain").alias("source_domain"), F.struct("start_ordinal", "page_number").alias("seq"), today, "gap"), fetch, local_markdown)

    def listing_cards() -> DataFrame:
        rows = table("listing_pages").filter("status in ('ok', 'partial')").select(F.col("snapshot_id").alias("page_id"), "seq", "source_domain", F.col("url").alias("base_url"), "html")
        document = sources.select(F.col("domain").alias("source_domain"), *[c for c in (*cards.OVERLAID, cards.SECOND_NAME) if c in sources.columns])
        place = rows.select("page_id", F.concat_ws("/", F.lpad("seq.start_ordinal", 6, "0"), F.lpad("seq.page_number", 6, "0")).alias("page_place")).groupBy("page_id").agg(F.min("page_place").alias("page_place"))
        return cards.cards(rows.join(document, "source_domain", "left"), slots).join(place, "page_id")

    def found() -> DataFrame:
        each = table("listing_cards").withColumn("order", F.concat_ws("/", "source_domain", "page_place", F.lpad("card_position", 6, "0")))
        best = cards.richest(cards.candidates(each, keep=("order",)), "order", ["source_domain"])
        master = t.read_versioned(spark, f"{root}/master", history.MASTER_DDL)
        return history.with_relevance(best, master, F.lit(day).cast("date")).withColumn("url", F.col("candidate_url")).withColumn("run", F.lit(run_id))

    def listings() -> DataFrame:
        shown_on = table("listing_pages").select(F.col("snapshot_id").alias("page_id"), F.col("url").alias("referer")).groupBy("page_id").agg(F.min("referer").alias("referer"))
        more = aliases.merge_aliases(table("harvest").filter("selected"), "run", "order").join(shown_on, "page_id", "left").select("url", "source_domain", "referer")
        linked = table("discover").join(table("archive").select("seq", "source_domain"), "seq").select("url", "source_domain", F.lit(None).cast("string").alias("referer"))
        every = more.unionByName(linked).groupBy("url").agg(F.min("source_domain").alias("source_domain"), F.min("referer").alias("referer"))
        every = every.join(gaps().withColumnRenamed("domain", "source_domain"), "source_domain", "left")
        return archived(every.select("url", "source_domain", seq("url"), today, "referer", "gap"), fetch, local_markdown)

    def records() -> DataFrame:
        rows = table("archive_discovered").filter("status in ('ok', 'partial')")
        return details.parsed(rows.select("snapshot_id", F.col("source_domain").alias("domain"), F.col("url").alias("url_final"), "html", "markdown"), faults=True, parsers=parsers)

    def export() -> DataFrame:
        rows = table("parse").filter("read_error is null").orderBy("snapshot_id")
        t.write_csv(publish.exported(rows), f"{base}/export.csv")
        t.write_json_lines(publish.exported(rows), f"{base}/export.jsonl")
        return publish.exported(rows).groupBy("source_domain", "parse_status").agg(F.count("*").alias("n"))

    def report() -> DataFrame:
        gone = table("archive_discovered").select("source_domain", "status", F.col("url").alias("snapshot_path"))
        read = table("parse")
        faults = read.filter("read_error is not null").select(F.col("url_final").alias("snapshot_path"), F.col("read_error").alias("error"))
        return reporting.funnel(reporting.harvested(table("listing_pages"), table("listing_cards"), table("harvest")), gone, read.filter("read_error is null"), faults)

    step("archive", (), seeds)
    step("index", ("archive",), lambda: discovery.indexed(table("archive")))
    step("discover", ("archive",), links)
    step("listing_pages", (), listing_pages)
    step("listing_errors", ("listing_pages",), lambda: reporting.page_errors(table("listing_pages")))
    step("listing_cards", ("listing_pages",), listing_cards)
    step("harvest", ("listing_cards",), found)
    step("archive_discovered", ("archive", "discover", "harvest"), listings)
    step("parse", ("archive_discovered",), records)
    step("export", ("parse",), export)
    step("funnel", ("harvest", "archive_discovered", "parse"), report)
    there = [s for s in ("archive", "archive_discovered") if t.exists(spark, f"{base}/{s}/_SUCCESS")]
    pages = {s: table(s).agg(*reporting.status_counts(F.col("status"))).first().asDict() for s in there}
    status = overall(statuses, pages.get("archive", {}).get("error", 0))
    reasons = {}
    if t.exists(spark, f"{base}/listing_cards/_SUCCESS"):
        reasons = {r["source_domain"]: r["rejection_reasons"] for r in reporting.reason_map(table("listing_cards"), "source_domain", "rejection_reason").orderBy("source_domain").toLocalIterator()}
    details_found = table("parse").agg(reporting.detail_count().alias("n")).first()["n"] if t.exists(spark, f"{base}/parse/_SUCCESS") else 0
    t.write_document(spark, f"{base}/manifest.json", {"pipeline_run_id": run_id, "job_name": job, "started_at": began, "ended_at": clock() if clock else began, "status": status, "export": {"csv": f"{base}/export.csv", "jsonl": f"{base}/export.jsonl"}, "step_statuses": statuses, "page_statuses": pages, "detail_count": details_found, "rejection_reasons": reasons, "errors_summary": errors})
    return Run(statuses, status, errors)
