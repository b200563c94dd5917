"""Commands over the tables of a root folder. Exit codes: 0 done, 1 failed, 2 not found."""

from __future__ import annotations

import argparse
import importlib
import json
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import details, older, planning, viewer
from .operators import history as h
from .plans import pipeline, publish
from .sources import config
from .sources import tables as t
from .sources.fetch import polite


def _session() -> SparkSession:
    return SparkSession.builder.appName("lindero").getOrCreate()


def _show(df: DataFrame, columns: Sequence[str] | None = None) -> None:
    """Rows as pipe-separated text, one at a time."""
    for row in df.select(F.concat_ws(" | ", *[F.col(c).cast("string") for c in columns or df.columns]).alias("line")).toLocalIterator():
        print(row["line"])


def _files(urls: DataFrame) -> DataFrame:
    """A fetcher without a network: URLs are paths of files that Spark reads; a page that is not there is null."""
    spark = urls.sparkSession
    paths = [r["url"] for r in urls.select("url").toLocalIterator() if r["url"].startswith(("file:", "/"))]
    there = [p for p in paths if t.exists(spark, p)]
    none = F.lit(None).cast("string")
    if not there:
        return urls.select("url", none.alias("html"), none.alias("markdown"))
    plain = F.regexp_replace(F.col("path"), "^file:/*", "/")
    got = spark.read.format("binaryFile").load(there).select(plain.alias("_path"), t.decoded(F.col("content")).alias("html"))
    return urls.select("url", F.regexp_replace("url", "^file:/*", "/").alias("_path")).join(got, "_path", "left").select("url", "html", none.alias("markdown"))


def _fetcher(connect: str | None) -> pipeline.Fetch:
    """Files, or pages over the connections that ``package.module:function`` opens."""
    if not connect:
        return _files
    module, _, name = connect.partition(":")
    return polite(getattr(importlib.import_module(module), name))


#: Commands that run some of a job's steps on what its run has so far.
STEPS = {
    "run-job": ("archive", "index"),
    "discover-job-run": ("discover",),
    "harvest-listings": ("listing_pages", "listing_errors", "listing_cards", "harvest"),
    "archive-discovered": ("archive_discovered",),
    "parse-discovered": ("parse", "export"),
    "report-run": ("funnel",),
}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="lindero")
    out.add_argument("--root", default="data")
    out.add_argument("--sources", default="config/sources")
    out.add_argument("--jobs", default="config/jobs")
    commands = out.add_subparsers(dest="command", required=True)

    def add(name: str, *positional: str, **options: object) -> None:
        c = commands.add_parser(name)
        for p in positional:
            c.add_argument(p)
        for k, v in options.items():
            flag = "--" + k.replace("_", "-")
            c.add_argument(flag, action="store_true") if v is bool else c.add_argument(flag, default=v)

    add("list-sources")
    add("show-source", "domain")
    add("list-jobs")
    add("show-job", "name")
    add("plan-job", "name")
    add("plan-pages", "name")
    add("run-job-full", "name", run_id="run", day="1970-01-01", resume=bool, force="", connect=None, portal_defaults=bool)
    for name in STEPS:
        add(name, "name", run_id="run", day="1970-01-01", connect=None, portal_defaults=bool)
    add("archive", "url", day="1970-01-01")
    add("list-runs", job=None)
    add("legacy", "folder", out="legacy", day="1970-01-01")
    add("show-run", "run_id")
    add("list-snapshots", "run_id", domain=None, date=None, status=None)
    add("parse-pages", "glob", domain="unknown-domain")
    add("publish", "records", day="1970-01-01", now="1970-01-01T00:00:00Z")
    add("publish-latest", "name", run_id="run", day="1970-01-01", now="1970-01-01T00:00:00Z", connect=None, make=bool)
    add("export-history", "path")
    add("apply-edits", "edits", now="1970-01-01T00:00:00Z")
    add("published-dates")
    add("set-listing-status", "key", "status", now="1970-01-01T00:00:00Z", note=None)
    add("history", portal=None, status=None, day=None, text=None)
    add("client-view", "day")
    return out


def run(args: argparse.Namespace, spark: SparkSession) -> int:
    name, root = args.command, args.root
    if name in ("list-sources", "show-source"):
        sources = config.load_sources(spark, args.sources)
        if name == "list-sources":
            _show(sources, ["domain", "enabled", "parser_key", "harvest_enabled"])
        else:
            print(json.dumps(config.by_key(sources, "domain", args.domain), ensure_ascii=False, indent=2))
    elif name in ("list-jobs", "show-job"):
        jobs = config.load_jobs(spark, args.jobs)
        if name == "list-jobs":
            _show(jobs.withColumn("sources", F.array_join("sources", ",")), ["job_name", "sources", "max_urls"])
        else:
            print(json.dumps(config.by_key(jobs, "job_name", args.name), ensure_ascii=False, indent=2))
    elif name in ("plan-job", "plan-pages", "run-job-full"):
        jobs, sources = config.load_jobs(spark, args.jobs), config.load_sources(spark, args.sources)
        job = config.by_key(jobs, "job_name", args.name)
        own = planning.job_sources(jobs.filter(F.col("job_name") == args.name), sources, harvest=name == "plan-pages")
        if name == "plan-job":
            _show(own, ["place", "domain", "reason"])
            _show(planning.seed_urls(own, job["max_urls"]), ["url", "times"])
        elif name == "plan-pages":
            _show(planning.page_plan(own.filter("reason is null")))
        else:
            done = pipeline.run_job(spark, args.name, jobs, sources, root, args.run_id, args.day, _fetcher(args.connect), args.resume, tuple(filter(None, args.force.split(","))), portal_defaults=args.portal_defaults)
            print(json.dumps({"status": done.status, "steps": done.statuses, "errors": done.errors}, indent=2))
            return 1 if done.status == "failed" else 0
    elif name in STEPS:
        jobs, sources = config.load_jobs(spark, args.jobs), config.load_sources(spark, args.sources)
        config.by_key(jobs, "job_name", args.name)
        done = pipeline.run_job(spark, args.name, jobs, sources, root, args.run_id, args.day, _fetcher(args.connect), only=STEPS[name], portal_defaults=args.portal_defaults)
        print(json.dumps({"steps": {s: done.statuses[s] for s in STEPS[name]}, "errors": done.errors}, indent=2))
        return 1 if done.errors else 0
    elif name == "archive":
        one = spark.createDataFrame([(args.url, 0)], "url string, seq int").withColumn("day", F.lit(args.day).cast("date"))
        _show(pipeline.archived(one, _files), ["snapshot_id", "url", "status", "html_hash"])
    elif name == "list-runs":
        _show(config.matching(publish.runs(spark, root), job_name=args.job).orderBy("pipeline_run_id"), ["pipeline_run_id", "job_name", "status"])
    elif name == "legacy":
        saved = older.drops(spark, args.folder)
        cards = older.list_cards(saved.select(F.col("place").alias("page_id"), "html", F.lit("N/D").alias("operation")), "https://www.inmoercilla.com", "Inmoercilla")
        print(json.dumps(older.run([("Inmoercilla", cards.withColumn("seq", F.struct("page_id", "place")))], f"{root}/{args.out}", args.day), ensure_ascii=False))
    elif name == "show-run":
        path = f"{root}/{args.run_id}/manifest.json"
        if not t.exists(spark, path):
            return 2
        print(json.dumps(t.read_document(spark, path), ensure_ascii=False, indent=2))
    elif name == "list-snapshots":
        if not t.exists(spark, f"{root}/{args.run_id}/archive"):
            return 2
        _show(config.matching(spark.read.parquet(f"{root}/{args.run_id}/archive").withColumn("date", F.col("day").cast("string")), domain=args.domain, date=args.date, status=args.status), ["snapshot_id", "url", "domain", "date", "status", "is_duplicate"])
    elif name == "parse-pages":
        pages = t.read_pages(spark, args.glob).select(F.col("path").alias("snapshot_id"), F.lit(args.domain).alias("domain"), F.col("path").alias("url_final"), "html", F.lit(None).cast("string").alias("markdown"))
        for row in details.parsed(pages).toJSON().toLocalIterator():
            print(row)
    elif name == "publish":
        rows = t.read_json_lines(spark, args.records, ", ".join(f"{c} string" for c in h.BUSINESS), place=True)
        print(json.dumps(publish.publish_to(rows.withColumnRenamed(t.PLACE, "seq"), root, args.day, args.now), indent=2))
    elif name == "publish-latest":
        jobs, sources = config.load_jobs(spark, args.jobs), config.load_sources(spark, args.sources)
        config.by_key(jobs, "job_name", args.name)

        def make() -> str:
            pipeline.run_job(spark, args.name, jobs, sources, root, args.run_id, args.day, _fetcher(args.connect))
            return args.run_id

        print(json.dumps(publish.publish_latest(spark, root, args.name, args.day, args.now, make if args.make else None), indent=2))
    elif name == "export-history":
        t.write_csv(h.sorted_history(t.read_versioned(spark, f"{root}/master", h.MASTER_DDL)), args.path)
    elif name == "apply-edits":
        edits = t.read_keyed_lines(spark, args.edits, "listing_key string, workflow_status string, workflow_note string", "listing_key")
        print(publish.set_statuses(spark, root, edits, args.now))
    elif name == "published-dates":
        print("\n".join(publish.published_dates(spark, root)))
    elif name == "set-listing-status":
        publish.set_status(spark, root, args.key, args.status, args.now, args.note)
    elif name == "history":
        master = t.read_versioned(spark, f"{root}/master", h.MASTER_DDL)
        _show(h.sorted_history(viewer.history_filtered(master, args.portal, args.status, args.day, args.text)), ["listing_key", "title", "price_text", "workflow_status", "first_seen_date", "last_seen_date", "seen_count"])
    elif name == "client-view":
        path = f"{root}/published/{args.day}/all.csv"
        if not t.exists(spark, path):
            return 2
        _show(viewer.client_summary(t.read_csv(spark, path, publish.PUBLISHED), t.read_versioned(spark, f"{root}/master", h.MASTER_DDL)))
    return 0


def main(argv: Sequence[str] | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        return run(args, _session())
    except KeyError as e:
        print(f"not found: {e}", file=sys.stderr)
        return 2
    except (ValueError, OSError) as e:
        print(f"{type(e).__name__}: {e}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
