"""The older scraper's readers, fetching without a network, readers of snapshots and published lists, commands."""

import json

import pytest
from pyspark.sql import functions as F

from lindero import cli
from lindero.operators import discovery, legacy, older, reporting
from lindero.plans import publish
from lindero.sources import fetch
from lindero.sources import tables as t

CARD = "<div class='card custom-card-info'><a href='{}'>ver</a><p><i class='fa-location-dot'></i> {}</p>{}</div>"
LIST = CARD.format("/inmuebles/1", "Zamudio", "Nave industrial 1.200 m² 450.000,00 € en venta") + CARD.format("https://x.es/property/2", "", "Pabellón en Basauri, alquiler 900 €") + CARD.format("/inmuebles/3", "Bilbao", "Piso de 90 m2") + "<div class='card'><a href='/inmuebles/4'>Nave</a></div>"


def test_list_cards(spark):
    p = spark.createDataFrame([(1, LIST, "venta"), (2, None, "venta"), (3, "<div class='card'><a href='inmuebles/9'>x</a> Nave</div>", "venta"), (4, "<div class='card'><a href='y/inmuebles/9'>x</a> Nave 10 m2</div>", "alquiler")], "page_id int, html string, operation string")
    got = {(r["page_id"], r["place"]): r for r in older.list_cards(p, "https://b.es", "B").collect()}
    assert sorted(got) == [(1, 0), (1, 1), (4, 0)]  # a flat of a card, and a link that no selector finds, are left out
    a, b, c = got[1, 0], got[1, 1], got[4, 0]
    assert (a["link"], a["localidad"], a["m2"], a["precio"], a["operacion"], a["fuente"]) == ("https://b.es/inmuebles/1", "Zamudio", 1200, 450000.0, "venta", "B")
    assert (b["link"], b["localidad"], b["m2"], b["operacion"]) == ("https://x.es/property/2", "Basauri", None, "alquiler")
    assert (c["link"], c["m2"], c["operacion"]) == ("https://b.es/y/inmuebles/9", 10, "alquiler")


def test_detail_fields(spark):
    ld = "<script type='application/ld+json'>{}</script>"
    rows = [
        ("a", ld.format('{"offers": {"price": "1200"}, "address": {"addressLocality": "Getxo"}, "floorSize": "77 m2"}') + "<p>Nave de 50 m2 por 9.000 € en Bilbao</p>"),
        ("b", "<nav class='breadcrumb'>Inicio Basauri</nav><p>Nave de 50 m2 por 9.000 € en Bilbao</p>"),
        ("c", ld.format('{"offers": {"price": 0}, "addressLocality": "Lezama"}') + "<p>100 €</p>"),
        ("d", None),
    ]
    p = spark.createDataFrame(rows, "link string, html string")
    one = {r["link"]: (r["localidad"], r["m2"], r["precio"]) for r in older.detail_fields(p, data_surface=True, crumbs=True).collect()}
    assert one == {"a": ("Getxo", 77, 1200.0), "b": ("Basauri", 50, 9000.0), "c": ("Lezama", None, 100.0), "d": ("", None, None)}
    two = {r["link"]: (r["localidad"], r["m2"], r["precio"]) for r in older.detail_fields(p).collect()}
    assert two["a"] == ("Getxo", 50, 1200.0) and two["b"][1:] == (50, 9000.0) and two["d"] == ("", None, None)


def test_run_to_two_sheets(spark, tmp_path):
    cols = "seq int, link string, m2 int, precio double, operacion string"
    a = spark.createDataFrame([(0, "l1", 10, 1.0, "Alquiler"), (1, "l2", None, None, "venta y alquiler"), (2, "", 1, 1.0, "venta"), (3, "l5", 1, 1.0, "traspaso")], cols)
    b = spark.createDataFrame([(0, "l1", 99, 9.0, "venta"), (1, "l3", 5, 2.0, None)], cols)
    counts = older.run([("A", a), ("B", b)], f"file://{tmp_path}/out", "2026-01-02")
    assert counts == {"A": 4, "B": 2}
    sheet = {n: sorted((r["Link"], r["Fuente"], r["Fecha"]) for r in t.read_csv(spark, f"file://{tmp_path}/out/{n}", list(older.SHEET)).collect()) for n in ("Alquiler", "Venta")}
    assert sheet["Alquiler"] == [("l1", "A", "2026-01-02"), ("l2", "A", "2026-01-02")] and [x[0] for x in sheet["Venta"]] == ["l2", "l3", "l5"]
    assert older.run([], "x", "d") == {}


def test_drops_fallbacks_and_links(spark, tmp_path):
    (tmp_path / "d").mkdir()
    for name in ("b", "a", "c"):
        (tmp_path / "d" / f"{name}.html").write_text(f"<p>{name}</p>")
    assert [(r["place"], r["html"]) for r in older.drops(spark, f"file://{tmp_path}/d").orderBy("place").collect()] == [(0, "<p>a</p>"), (1, "<p>b</p>"), (2, "<p>c</p>")]
    assert older.drops(spark, f"file://{tmp_path}/none").count() == 0
    df = spark.createDataFrame([("s", " /b"), ("s", "/a"), ("s", "/b"), ("s", " "), ("s", None)], "k string, link string")
    assert older.sorted_links(df, "k", "link").first()["links"] == ["/a", "/b"]
    assert older.first_filled([df.limit(0), df, df.limit(1)]).count() == 5 and older.first_filled([df.limit(0)]).count() == 0
    assert older.with_fallback(df.limit(0), [("x", "y")], "k string, link string").count() == 1 and older.with_fallback(df, [("x", "y")], "k string, link string").count() == 5
    assert [r[0] for r in df.select(older.long_enough(F.lit(" abcd "))).limit(1).collect()] == [False]


def test_fetching():
    waits, seen = [], []

    def run(answers, url="https://x.es/a", retries=3):
        waits.clear()
        left = list(answers)
        asked = []

        def opener(at, agent):
            asked.append((at, agent))
            x = left.pop(0)
            if isinstance(x, Exception):
                raise x
            return x

        return fetch.fetched(url, opener, ["u", "v"], waits.append, lambda: 0.1, retries, seen.append), asked

    assert run([(200, "ok")]) == ("ok", [("https://x.es/a", "u")]) and waits == []
    assert run([(403, "body")])[0] == "body" and seen == ["body"]
    body, asked = run([(503, ""), OSError(), (404, "no"), (200, "late")])
    assert body == "late" and [a for _, a in asked] == ["u", "v", "u", "v"] and waits == pytest.approx([1.0, 0.9 * 1.8 + 0.1, 0.9 * 1.8 * 1.6 + 0.1])
    assert run([(500, "x")] * 4)[0] is None and len(waits) == 3
    body, asked = run([(404, ""), (200, "es")], "https://www.milanuncios.com/n")
    assert body == "es" and asked[1][0] == "https://es.milanuncios.com/n" and waits == [] and fetch.swapped("https://es.milanuncios.com/n") == "https://www.milanuncios.com/n"


def test_snapshots_and_other_readers(spark, tmp_path):
    for k, md in (("s1", True), ("s2", False)):
        d = tmp_path / "snap" / k
        d.mkdir(parents=True)
        (d / "page.html").write_bytes(b"<p>\xff" + k.encode())
        files = {"page_html": str(d / "page.html"), "page_md": str(d / "page.md") if md else None}
        if md:
            (d / "page.md").write_text("# " + k)
        (d / "meta.json").write_text(json.dumps({"snapshot_id": k, "status": "ok", "files": files}))
    got = {r["snapshot_id"]: r for r in t.read_snapshots(spark, f"file://{tmp_path}/snap", "snapshot_id string, status string").collect()}
    assert got["s1"]["markdown"] == "# s1" and got["s2"]["markdown"] is None and got["s2"]["html"] == "<p>�s2" and got["s1"]["snapshot_path"].endswith("/snap/s1")
    kind = "listing_key string, seen_count int"
    t.write_csv(spark.createDataFrame([("a", 2)], kind), f"file://{tmp_path}/p.csv")
    assert t.read_published(spark, f"file://{tmp_path}/p.csv", kind).collect()[0]["seen_count"] == 2
    for path, other in ((f"file://{tmp_path}/none.csv", kind), (f"file://{tmp_path}/p.csv", "x string")):
        assert t.read_published(spark, path, other).count() == 0
    import os

    for k, name in enumerate(("m1", "m3", "m2")):
        (tmp_path / f"{name}.json").write_text("{}")
        os.utime(tmp_path / f"{name}.json", (1000 + k, 1000 + k))
    assert t.latest_modified(spark, f"file://{tmp_path}/m*.json").endswith("m2.json") and t.latest_modified(spark, f"file://{tmp_path}/q*.json") is None
    docs = spark.createDataFrame([(["a", "", None, " ", "b"],), (None,)], "archived_snapshot_paths array<string>")
    assert [(r["place"], r["path"]) for r in t.listed_paths(docs).collect()] == [(0, "a"), (4, "b")]
    runs = spark.createDataFrame([("r1", "2026-01-01", "2026-01-05"), ("r2", "2026-01-03", ""), ("r3", "2026-01-02", "2026-01-04")], "run string, started_at string, ended_at string")
    assert t.latest_usable(runs, lambda r: r["run"] != "r1")["run"] == "r3" and t.latest_usable(runs, lambda r: False) is None
    t.write_text(spark, f"file://{tmp_path}/x.html", "<p>ñ</p>")
    assert (tmp_path / "x.html").read_text() == "<p>ñ</p>"


def test_documents_defaults_and_faults(spark, tmp_path):
    from lindero.sources import config

    document = {"domain": "d", "enabled": True, "mode": "m", "start_urls": ["u"], "rate_limit_seconds": 1.0, "login_allowed": False, "parser_key": "generic"}
    (tmp_path / "s.json").write_text(json.dumps(document))
    row = config.load_sources(spark, f"file://{tmp_path}/s.json").first()
    assert (row["listing_start_urls"], row["max_listing_pages"], row["harvest_enabled"], row["timeout_seconds"]) == (["u"], 1, False, 20.0)
    for fault in ({"start_urls": []}, {"listing_start_urls": []}, {"mode": None}):
        (tmp_path / "s.json").write_text(json.dumps(document | fault))
        with pytest.raises(ValueError):
            config.load_sources(spark, f"file://{tmp_path}/s.json")
    (tmp_path / "j.json").write_text(json.dumps({"job_name": "j", "sources": []}))
    with pytest.raises(ValueError):
        config.load_jobs(spark, f"file://{tmp_path}/j.json")


def test_the_last_line_of_a_key_counts(spark, tmp_path):
    path = tmp_path / "h.jsonl"
    path.write_text("".join(json.dumps({"listing_key": k, "n": i}) + "\n" for i, k in enumerate(["a", "b", "", "a", None, "c", "b"])))
    assert sorted(tuple(r) for r in t.read_keyed_lines(spark, f"file://{path}", "listing_key string, n int", "listing_key").collect()) == [("a", 3), ("b", 6), ("c", 5)]


def test_page_errors_index_and_counts(spark):
    p = spark.createDataFrame([("a", "u1", "ok", "h", "m"), ("a", "u2", "error", None, None), ("b", "u3", None, None, None)], "source_domain string, url string, status string, html string, markdown string")
    assert sorted((r["listing_page_url"], r["error"]) for r in reporting.page_errors(p).collect()) == [("u2", "listing_snapshot_status_error"), ("u3", "listing_snapshot_status_unknown")]
    assert discovery.indexed(p).columns == ["source_domain", "url", "status"] and discovery.indexed(p).count() == 1
    assert spark.createDataFrame([("detail",), ("listing",), (None,)], "page_kind string").agg(reporting.detail_count()).first()[0] == 1
    slugs = spark.createDataFrame([("https://x.es/a/Nave-En_Bilbao.htm",), ("https://x.es/",)], "u string").select(discovery.slug(F.col("u"))).collect()
    assert slugs[0][0] == "nave-en-bilbao-htm" and len(slugs[1][0]) == 16
    items = spark.createDataFrame([("x", None), (None, "y"), (None, None)], "fuente string, fuente_origen string")
    assert {r["source"]: r["n"] for r in legacy.counts_by_source(items).collect()} == {"x": 1, "y": 1, "?": 1}


def test_commands_of_single_steps(spark, tmp_path, capsys):
    page = tmp_path / "p.html"
    page.write_text("<a href='/inmueble/123456'>x</a>")
    for kind, name, value in (("sources", "s", {"domain": "d", "enabled": True, "mode": "m", "start_urls": [f"file://{page}"], "rate_limit_seconds": 1.0, "login_allowed": False, "parser_key": "generic", "harvest_enabled": True, "listing_start_urls": [f"file://{page}"]}), ("jobs", "j", {"job_name": "j", "sources": ["d"]})):
        (tmp_path / kind).mkdir()
        (tmp_path / kind / f"{name}.json").write_text(json.dumps(value))
    root = f"file://{tmp_path}/root"
    common = ["--root", root, "--sources", f"file://{tmp_path}/sources", "--jobs", f"file://{tmp_path}/jobs"]

    def call(*args):
        code = cli.run(cli.parser().parse_args([*common, *args]), spark)
        return code, capsys.readouterr().out

    code, out = call("run-job", "j", "--run-id", "r", "--day", "2026-01-01")
    assert code == 0 and json.loads(out)["steps"] == {"archive": "completed", "index": "completed"}
    assert json.loads(call("harvest-listings", "j", "--run-id", "r")[1])["steps"]["harvest"] == "completed"
    assert json.loads(call("parse-discovered", "j", "--run-id", "r")[1])["steps"]["parse"] == "skipped"  # nothing is archived yet
    for name, step in (("discover-job-run", "discover"), ("archive-discovered", "archive_discovered"), ("parse-discovered", "parse"), ("report-run", "funnel")):
        assert json.loads(call(name, "j", "--run-id", "r")[1])["steps"][step] == "completed"
    assert call("list-runs", "--job", "j")[1].startswith("r | j | ") and call("list-runs", "--job", "other")[1] == ""
    assert "partial" in call("archive", str(page))[1]
    (tmp_path / "drops").mkdir()
    (tmp_path / "drops" / "a.html").write_text(LIST)
    assert json.loads(call("legacy", f"file://{tmp_path}/drops")[1]) == {"Inmoercilla": 2}
    assert publish.PUBLISHED
