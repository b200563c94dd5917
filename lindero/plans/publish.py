"""Publishing a batch: identity, history, status, the day's new listings per portal."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.portals import SLUGS
from ..operators import history as h
from ..sources import store
from ..sources import tables as t

PUBLISHED = ("portal", "source_domain", "listing_key", "external_id", "title", "price_text", "price_value", "location_text", "surface_sqm", "rooms_count", "url_final", "parse_status", "workflow_status", "workflow_updated_at", "workflow_note", "first_seen_date", "last_seen_date", "seen_count")
KEY = "listing_key"
MASTER, STATUS = h.MASTER_DDL, h.STATUS_DDL


class Published(NamedTuple):
    master: DataFrame  # history, with in_batch
    status: DataFrame
    new: DataFrame


def publish(records: DataFrame, master: DataFrame, status: DataFrame, day: str, now: str) -> Published:
    """One lazy plan from ``records`` (business columns and ``seq``) to the new history, status store and delta."""
    on = F.lit(day).cast("date")
    after = h.upserted(h.deduplicated(h.normalized(records)), master, on, status, now).drop("known", "told")
    batch = after.filter("in_batch")
    return Published(after, h.status_after(status, batch), batch.filter(h.new_on(on)).select(*PUBLISHED))


def _lists(new: DataFrame, folder: str) -> None:
    """The day's list as a CSV folder for every known portal (with the header alone for an empty one), from one write, and
    one for all."""
    spark = new.sparkSession
    fs, parts = t.file_system(spark, folder), f"{folder}/.parts-{uuid.uuid4().hex}"
    new.select(*PUBLISHED, F.col("portal").alias("_list")).write.partitionBy("_list").option("header", True).option("escape", '"').csv(parts)
    for slug in SLUGS:
        made, place = t._path(spark, f"{parts}/_list={slug}"), t._path(spark, f"{folder}/{slug}.csv")
        fs.delete(place, True)
        if fs.exists(made):
            fs.rename(made, place)
        else:
            t.write_text(spark, f"{folder}/{slug}.csv/part-00000.csv", ",".join(PUBLISHED) + "\n")
    fs.delete(t._path(spark, parts), True)
    t.write_csv(new, f"{folder}/all.csv", PUBLISHED)


def publish_to(records: DataFrame, root: str, day: str, now: str, parts: bool = False, attempts: int = 10) -> dict:
    """:func:`publish` on the keyed tables below ``root``: the batch's rows, made once, are the next change of history and
    of the status store; the history is only read, once, to meet them. The delta goes to a CSV folder for every known
    portal (even an empty one) and one for all; a summary document says how many there are. ``parts``: the day comes in
    several batches, and its list is that of all of them so far, not of the last one alone.

    If another writer commits first, the batch is made again on what is there then.
    """
    spark: SparkSession = records.sparkSession
    masters, statuses = f"{root}/master", f"{root}/status"
    on = F.lit(day).cast("date")
    for _ in range(attempts):
        m, s = store.version(spark, masters), store.version(spark, statuses)
        current = h.deduplicated(h.normalized(records))
        rows = h.upserted(current, store.rows_of(spark, masters, m, MASTER), on, store.rows_of(spark, statuses, s, STATUS), now, only_batch=True).drop("in_batch")
        batch = store.write_segment(rows, masters, KEY, m.buckets or store.BUCKETS)
        made = spark.read.schema(rows.schema).parquet(f"{masters}/{batch.path}")
        counts = made.agg(F.count_if(~F.col("known")).alias("known"), F.count_if(~F.col("told")).alias("told")).first()
        try:
            if batch.rows:
                flows = store.write_segment(made.select(KEY, *h.WORKFLOW), statuses, KEY, s.buckets or store.BUCKETS)
                store.put(spark, statuses, s, flows, counts["told"], KEY, STATUS)
                m = store.put(spark, masters, m, batch, counts["known"], KEY, MASTER)
            break
        except store.Conflict:
            continue
    else:
        raise store.Conflict(f"{root}: {attempts} attempts failed")
    if parts:
        new = store.rows_of(spark, masters, m, MASTER).filter(h.first_seen_on(on))
    else:
        new = made.filter(F.col("first_seen_date") == on)
    folder = f"{root}/published/{day}"
    _lists(new, folder)
    counted = {r["portal"]: r["n"] for r in t.read_csv(spark, f"{folder}/all.csv", PUBLISHED).groupBy("portal").agg(F.count("*").alias("n")).collect()}
    summary = {"publish_date": day, "input_records": records.count(), "deduped_records": batch.rows, "new_records": sum(counted.values()), "history_records": m.rows, "portal_counts": {p: counted.get(p, 0) for p in SLUGS}, "published_at": now}
    t.write_document(spark, f"{folder}/summary.json", summary)
    return summary


#: The columns of a run's exported records.
EXPORTED = (*h.BUSINESS, "external_id", "surface_text")
#: What is read of a run's manifest.
RUN_DDL = "pipeline_run_id string, job_name string, status string, started_at string, ended_at string, export struct<csv: string, jsonl: string>"


def exported(records: DataFrame) -> DataFrame:
    """Parsed records as they are exported: the columns of EXPORTED, those that are missing null."""
    return records.select(*[h.column_or_null(records, c).cast("string").alias(c) for c in EXPORTED])


def runs(spark: SparkSession, root: str) -> DataFrame:
    """The manifests of the runs below ``root``."""
    if not t.exists(spark, root):
        return t.empty(spark, RUN_DDL)
    return spark.read.schema(t.schema_of(RUN_DDL)).option("multiLine", True).option("pathGlobFilter", "manifest.json").option("recursiveFileLookup", True).json(root)


def latest_run(spark: SparkSession, root: str, job: str) -> dict | None:
    """The manifest of a job's latest run (by its end, else its start) whose export can be read."""

    def usable(run: dict) -> bool:
        e = run["export"] or {}
        return any(p and t.exists(spark, p) for p in (e.get("csv"), e.get("jsonl")))

    return t.latest_usable(runs(spark, root).filter(F.col("job_name") == job), usable)


def publish_latest(spark: SparkSession, root: str, job: str, day: str, now: str, run: Callable[[], str] | None = None) -> dict:
    """Publish what a job's latest usable run has exported, the CSV before the JSON lines. If that run did not start on
    ``day``, or there is none, ``run`` makes one (and returns its id); without it that is a FileNotFoundError. The summary
    says which run it was, and whether it was made."""
    found, made = latest_run(spark, root, job), False
    if found is None or (found["started_at"] or "")[:10] != day:
        if run is None:
            raise FileNotFoundError(f"no usable run of {job} on {day}")
        wanted, made = run(), True
        found = next((r.asDict(True) for r in runs(spark, root).filter(F.col("pipeline_run_id") == wanted).toLocalIterator()), None)
        if found is None:
            raise FileNotFoundError(f"run {wanted} has no manifest")
    e = found["export"] or {}
    records = t.read_export(spark, e.get("csv"), e.get("jsonl"), EXPORTED, place=True).withColumnRenamed(t.PLACE, "seq")
    return publish_to(records, root, day, now) | {"pipeline_run_id": found["pipeline_run_id"], "run_made": made}


def set_status(spark: SparkSession, root: str, key: str, status: str, now: str, note: str | None = None) -> None:
    """One listing's status in the store, and in history if it is there: the key's bucket is read, one row is written."""

    def told(v: store.Version) -> tuple[DataFrame, int]:
        old = store.rows_of(spark, f"{root}/status", v, STATUS, only=key)
        return h.status_set(old, key, status, now, note), int(old.isEmpty())

    store.changed(spark, f"{root}/status", KEY, STATUS, told)

    def shown(v: store.Version) -> tuple[DataFrame, int]:
        own = store.rows_of(spark, f"{root}/status", store.version(spark, f"{root}/status"), STATUS, only=key)
        return h.status_applied(store.rows_of(spark, f"{root}/master", v, MASTER, only=key), own), 0

    store.changed(spark, f"{root}/master", KEY, MASTER, shown)


def set_statuses(spark: SparkSession, root: str, edits: DataFrame, now: str) -> int:
    """Many edits at once (listing_key, workflow_status, workflow_note; as :func:`history.edits` tells them); how many there
    were. A null note leaves the old one."""
    bad = edits.filter(~F.coalesce(F.col("workflow_status").isin(*h.STATUSES), F.lit(False)) | F.col(KEY).isNull()).limit(1).collect()
    if bad:
        raise ValueError(f"workflow status {bad[0]['workflow_status']!r} of {bad[0][KEY]!r} is none of {', '.join(h.STATUSES)}, or there is no key")
    new = edits.dropDuplicates([KEY]).select(KEY, F.struct("workflow_status", F.lit(now).alias("workflow_updated_at"), "workflow_note").alias("_new"))

    def told(v: store.Version) -> tuple[DataFrame, int]:
        met = new.join(store.rows_of(spark, f"{root}/status", v, STATUS), KEY, "left")
        rows = met.select(KEY, "_new.workflow_status", "_new.workflow_updated_at", F.coalesce("_new.workflow_note", "workflow_note").alias("workflow_note"))
        return rows, met.filter("workflow_status is null and workflow_updated_at is null").count()

    def shown(v: store.Version) -> tuple[DataFrame, int]:
        own = store.rows_of(spark, f"{root}/status", store.version(spark, f"{root}/status"), STATUS).join(new.select(KEY), KEY, "left_semi")
        return h.status_applied(store.rows_of(spark, f"{root}/master", v, MASTER).join(new.select(KEY), KEY, "left_semi"), own), 0

    store.changed(spark, f"{root}/status", KEY, STATUS, told)
    store.changed(spark, f"{root}/master", KEY, MASTER, shown)
    return new.count()


def published_dates(spark: SparkSession, root: str) -> list[str]:
    """The days that were published, latest first."""
    path = f"{root}/published"
    if not t.exists(spark, path):
        return []
    return sorted((s.getPath().getName() for s in t.file_system(spark, path).listStatus(t._path(spark, path)) if s.isDirectory()), reverse=True)
