"""From documents through a run to daily lists, history and edits, by commands."""

import json

import pytest
from pyspark.sql import functions as F

from lindero import cli
from lindero.operators import history
from lindero.plans import pipeline, publish
from lindero.sources import config
from lindero.sources import tables as t

PAGE = "<h1>Nave grande</h1><span class='price'>450.000 €</span><p>980 m2, 4 habitaciones, Bilbao</p>"


def command(spark, capsys, *args):
    code = cli.run(cli.parser().parse_args(list(args)), spark)
    return code, capsys.readouterr().out


def test_from_documents_to_lists(spark, tmp_path, capsys):
    for d in ("sources", "jobs"):
        (tmp_path / d).mkdir()
    doc = {"domain": "nuevo.es", "enabled": True, "mode": "m", "start_urls": ["https://nuevo.es/"], "rate_limit_seconds": 0, "login_allowed": False, "parser_key": "generic", "archiver_enabled": True, "harvest_enabled": False}
    (tmp_path / "sources/a.yaml").write_text(json.dumps(doc))
    (tmp_path / "jobs/a.yaml").write_text('{"job_name": "j", "sources": ["nuevo.es"]}')
    root = f"file://{tmp_path}/data"
    base = ["--root", root, "--jobs", f"file://{tmp_path}/jobs", "--sources", f"file://{tmp_path}/sources"]
    with pytest.raises(FileNotFoundError):
        command(spark, capsys, *base, "publish-latest", "j", "--day", "2026-03-22")
    assert publish.latest_run(spark, root, "j") is None
    links = "".join(f"<a href='/inmueble/{n}'>x</a>" for n in (100001, 100002))

    def fetch(urls):
        return urls.select("url", F.when(F.col("url").contains("/inmueble/"), PAGE).otherwise(links).alias("html"), F.lit("nave").alias("markdown"))

    def make():
        jobs, sources = config.load_jobs(spark, f"file://{tmp_path}/jobs"), config.load_sources(spark, f"file://{tmp_path}/sources")
        times = iter(["2026-03-22T08:00:00Z", "2026-03-22T09:00:00Z"])
        pipeline.run_job(spark, "j", jobs, sources, root, "r1", "2026-03-22", fetch, clock=lambda: next(times))
        return "r1"

    told = publish.publish_latest(spark, root, "j", "2026-03-22", "now", make)
    assert (told["run_made"], told["pipeline_run_id"], told["input_records"], told["history_records"], told["new_records"]) == (True, "r1", 2, 2, 2)
    again = json.loads(command(spark, capsys, *base, "publish-latest", "j", "--day", "2026-03-22")[1])
    assert (again["run_made"], again["pipeline_run_id"], again["history_records"]) == (False, "r1", 2)
    with pytest.raises(FileNotFoundError):
        command(spark, capsys, *base, "publish-latest", "j", "--day", "2026-03-23")
    assert "r1 | j" in command(spark, capsys, *base, "list-runs", "--job", "j")[1]
    rows = t.read_csv(spark, f"{root}/published/2026-03-22/all.csv", publish.PUBLISHED).collect()
    assert {(r["title"], r["price_value"], r["url_final"]) for r in rows} == {("Nave grande", "450000.0", f"https://nuevo.es/inmueble/{n}") for n in (100001, 100002)}


def write_run(spark, root, run_id, started, ended, csv, jsonl, titles):
    rows = spark.createDataFrame([("fotocasa.es", f"https://www.fotocasa.es/x/{100000 + i}/d", title) for i, title in enumerate(titles)], "source_domain string, url_final string, title string")
    base = f"{root}/{run_id}"
    if csv:
        t.write_csv(publish.exported(rows), f"{base}/export.csv")
    if jsonl:
        t.write_json_lines(publish.exported(rows.withColumn("title", rows["title"])), f"{base}/export.jsonl")
    t.write_document(spark, f"{base}/manifest.json", {"pipeline_run_id": run_id, "job_name": "j", "status": "completed", "started_at": started, "ended_at": ended, "export": {"csv": f"{base}/export.csv", "jsonl": f"{base}/export.jsonl"}})


def test_the_latest_usable_run_counts(spark, tmp_path):
    root = f"file://{tmp_path}"
    write_run(spark, root, "old", "2026-03-22T01", "2026-03-22T02", True, True, ["viejo"])
    write_run(spark, root, "good", "2026-03-22T03", None, False, True, ["uno", "dos"])
    write_run(spark, root, "bare", "2026-03-22T05", "2026-03-22T06", False, False, [])
    write_run(spark, root, "early", "2026-03-21T23", "2026-03-22T02:30", True, False, ["x"])
    assert publish.latest_run(spark, root, "j")["pipeline_run_id"] == "good" and publish.latest_run(spark, root, "k") is None
    told = publish.publish_latest(spark, root, "j", "2026-03-22", "now")
    assert (told["pipeline_run_id"], told["input_records"], told["new_records"]) == ("good", 2, 2)
    assert sorted(r["title"] for r in t.read_versioned(spark, f"{root}/master", history.MASTER_DDL).collect()) == ["dos", "uno"]


def test_history_is_exported_in_order_and_edits_are_applied(spark, tmp_path, capsys):
    root = f"file://{tmp_path}/data"
    write_run(spark, root, "r", "2026-03-22T01", "2026-03-22T02", True, False, ["b", "a", "a"])
    publish.publish_latest(spark, root, "j", "2026-03-22", "now")
    (tmp_path / "edits.jsonl").write_text('{"listing_key": "fotocasa.es:id:100001", "workflow_status": "pending"}\n{"listing_key": "fotocasa.es:id:100001", "workflow_status": "discarded", "workflow_note": "no"}\n')
    assert command(spark, capsys, "--root", root, "apply-edits", f"file://{tmp_path}/edits.jsonl")[1].strip() == "1"
    assert command(spark, capsys, "--root", root, "export-history", f"file://{tmp_path}/out")[0] == 0
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    lines = [x.split(",") for x in text.splitlines() if not x.startswith("portal")]
    assert [(x[5][-1], x[6]) for x in lines] == [("0", "b"), ("1", "a"), ("2", "a")] and [x[15] for x in lines] == ["pending", "discarded", "pending"]
