"""Fetching over made-up connections, strategies of documents, and crawls into sheets."""

import os
import random
import sys
import uuid

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from lindero.functions import portals
from lindero.operators import cards, details, older, planning
from lindero.plans import pipeline
from lindero.sources import config, fetch
from lindero.sources import tables as t

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers don't find test modules


class Made:
    """A connection with its own clock, which notes every request in a file of its task."""

    def __init__(self, folder, faults):
        self.clock, self.faults, self.asked = 0.0, faults, {}
        self.file = open(f"{folder}/{os.getpid()}-{uuid.uuid4().hex}", "a", buffering=1)

    def now(self):
        return self.clock

    def sleep(self, seconds):
        self.clock += seconds

    def get(self, url, headers):
        n = self.asked[url] = self.asked.get(url, 0) + 1
        self.file.write(f"{self.clock}\t{url}\t{headers.get('Referer', '')}\t{headers['User-Agent']}\n")
        self.clock += 0.01
        fault = self.faults.get(url, {}).get(n)
        if fault == "raise":
            raise OSError("no line")
        return (fault, "") if fault else (200, f"<p>{url}</p>")


def requests(folder):
    """(clock, url, referer, agent) of each task's file."""
    return [[line.rstrip("\n").split("\t") for line in open(f"{folder}/{name}")] for name in sorted(os.listdir(folder))]


def test_sites_keep_their_distance_and_faults_are_tried_again(spark, tmp_path):
    rng = random.Random(3)
    urls = [(f"https://{rng.choice(['www.a.es', 'es.a.es', 'b.es', 'c.es', 'hot.es', 'hot.es', 'hot.es'])}/{i}", i, None) for i in range(120)] + [(None, 500, None), ("file:/x", 501, None)]
    one, two, three = urls[0][0], urls[1][0], urls[2][0]
    faults = {one: {1: 503, 2: "raise"}, two: {k: 500 for k in range(1, 9)}, three: {1: "raise", 2: 429}}
    folder = str(tmp_path)
    get = fetch.polite(lambda: Made(folder, faults), gap=2.0, agents=("x", "y"), retries=3, tasks=3)
    df = spark.createDataFrame(urls, "url string, seq int, referer string")
    got = {r["url"]: r for r in get(df).collect()}
    assert len(got) == len(urls)
    assert {u for u, r in got.items() if r["fetch_status"] == "failed"} == {two, None, "file:/x"}
    assert (got[one]["attempts"], got[two]["attempts"], got[three]["attempts"], got[two]["http_status"], got[two]["fetch_error"]) == (3, 4, 3, 500, "status 500")
    assert got[urls[5][0]]["html"] == f"<p>{urls[5][0]}</p>" and got[None]["fetch_error"] == "no web address"
    sites, tasks = {}, requests(folder)
    for k, task in enumerate(tasks):
        last = {}
        for at, url, _, _ in task:
            site = fetch.site_of(url.split("/")[2])
            assert sites.setdefault(site, k) == k  # one task a site, the two hosts of a.es included
            assert float(at) - last.get(site, -9) >= 2.0 - 1e-9
            last[site] = float(at)
    assert set(sites) == {"a.es", "b.es", "c.es", "hot.es"} and sum(map(len, tasks)) == 120 - 3 + 3 + 4 + 3
    assert [a for task in tasks for _, u, _, a in task if u == two] == ["x", "y", "x", "y"]


def test_sites_take_turns_and_rows_have_their_own_distance(spark, tmp_path):
    rows = [(f"https://{h}.es/{i}", i, g) for i in range(6) for h, g in (("slow", 10.0), ("quick", 0.0), ("own", None))]
    fetch.polite(lambda: Made(str(tmp_path), {}), gap=1.0, tasks=1)(spark.createDataFrame(rows, "url string, seq int, gap double")).collect()
    (task,) = requests(str(tmp_path))
    at = {h: [float(c) for c, u, _, _ in task if u.split("/")[2] == f"{h}.es"] for h in ("slow", "quick", "own")}
    assert at["slow"][-1] - at["slow"][0] > 49.99 and task[-1][1].startswith("https://slow") and at["slow"][-1] < 51  # the others wait for nobody


def test_the_page_that_showed_a_listing_is_looked_at_first(spark, tmp_path):
    rows = [("https://a.es/1", 1, "https://a.es/l"), ("https://a.es/2", 2, "https://a.es/l"), ("https://a.es/3", 3, None)]
    faults = {"https://a.es/l": {1: "raise"}}
    got = fetch.polite(lambda: Made(str(tmp_path), faults), gap=1.0, tasks=1)(spark.createDataFrame(rows, "url string, seq int, referer string")).collect()
    assert all(r["fetch_status"] == "ok" for r in got)
    assert [(u, r) for _, u, r, _ in requests(str(tmp_path))[0]] == [("https://a.es/l", ""), ("https://a.es/1", "https://a.es/l"), ("https://a.es/2", "https://a.es/l"), ("https://a.es/3", "")]


CARD = "<section data-x='1'><a class='ver' href='/oferta/{0}?x=1'>Nave industrial grande {0}</a><span class='price'>{0}.000 €</span></section><section><a class='ver' href='/ayuda/1'>Preguntas frecuentes aquí</a></section>"


def test_an_unknown_portal_from_its_document_to_records(spark, tmp_path):
    """Planned, read and classified by what its document says, its links by the caller's functions, its pages by the caller's
    parser; every page is asked for once, listings with the page that showed them."""
    jobs = spark.createDataFrame([("j", ["nuevo.es"], 0)], "job_name string, sources array<string>, max_urls int")
    document = {"domain": "nuevo.es", "enabled": True, "mode": "m", "start_urls": ["https://nuevo.es/"], "rate_limit_seconds": 3.0, "login_allowed": False, "parser_key": "generic", "archiver_enabled": True, "harvest_enabled": True, "listing_start_urls": ["https://nuevo.es/l"], "max_listing_pages": 2, "listing_page_param": "p", "listing_card_selectors": ["section"], "detail_link_selectors": ["a.ver"], "listing_detail_url_patterns": ["/oferta/[0-9]+"], "listing_reject_url_patterns": ["/ayuda"]}
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "a.yaml").write_text(__import__("json").dumps(document))
    sources = config.load_sources(spark, f"file://{tmp_path}/s")
    (tmp_path / "asked").mkdir()
    folder = str(tmp_path / "asked")

    class Site(Made):
        def get(self, url, headers):
            status, _ = super().get(url, headers)
            if "/oferta/" in url:
                return status, f"<h1>Nave {url[-2:]}</h1>"
            return status, CARD.format(11 if url.endswith("/l") else 22) if "/l" in url else "<p>inicio</p>"

    def read(html, markdown, url):
        return {"title": html.strip("<>h1/"), "price_text": "7.000 €"}, []

    slots = {"nuevo.es": cards.Slots(normal=lambda link, base: "https://nuevo.es" + link.partition("?")[0])}
    done = pipeline.run_job(spark, "j", jobs, sources, f"file://{tmp_path}/root", "r", "2026-03-22", fetch.polite(lambda: Site(folder, {}), tasks=1), parsers=[details.Parser("mine", ("nuevo.es",), read)], slots=slots)
    assert done.errors == [] and done.status in ("completed", "partial")
    base = f"file://{tmp_path}/root/r"
    harvest = spark.read.parquet(f"{base}/harvest").collect()
    assert {(r["candidate_url"], r["price_text"]) for r in harvest} == {("https://nuevo.es/oferta/11", "11.000 €"), ("https://nuevo.es/oferta/22", "22.000 €")}
    records = spark.read.parquet(f"{base}/parse").collect()
    assert {(r["parser_key"], r["url_final"], r["price_value"]) for r in records} == {("mine", f"https://nuevo.es/oferta/{n}", 7000.0) for n in (11, 22)}
    asked = [x for task in requests(folder) for x in task]
    assert sorted(u for _, u, r, _ in asked if r or "/oferta/" not in u) == sorted(["https://nuevo.es/", "https://nuevo.es/l", "https://nuevo.es/l?p=2", "https://nuevo.es/l", "https://nuevo.es/l?p=2", "https://nuevo.es/oferta/11", "https://nuevo.es/oferta/22"])
    assert {(u, r) for _, u, r, _ in asked if "/oferta/" in u} == {("https://nuevo.es/oferta/11", "https://nuevo.es/l"), ("https://nuevo.es/oferta/22", "https://nuevo.es/l?p=2")}
    pages = spark.read.parquet(f"{base}/archive_discovered").collect()
    assert {r["fetch_status"] for r in pages} == {"ok"} and {r["attempts"] for r in pages} == {1}


def test_what_documents_leave_open_comes_from_the_portal(spark):
    rows = [("fotocasa.es", None, None, None, None), ("pisos.com", ["https://x/", " "], 0, "pag", " "), ("idealista.com", [" "], 9, None, "{base}/{page}"), ("nuevo.es", [], None, None, None)]
    df = spark.createDataFrame(rows, "domain string, listing_start_urls array<string>, max_listing_pages int, listing_page_param string, listing_page_url_template string")
    got = {r["domain"]: tuple(r)[1:] for r in planning.with_strategy(df).collect()}
    p = portals.BY_DOMAIN
    assert got["fotocasa.es"] == (list(p["fotocasa.es"].starts), 4, "pagina", None)
    assert got["pisos.com"] == (["https://x/"], 1, "pag", None)
    assert got["idealista.com"] == ([], 9, None, "{base}/{page}")
    assert got["nuevo.es"] == ([], 1, None, None)
    assert planning.with_strategy(df.select("domain")).filter("domain = 'pisos.com'").first()["listing_page_url_template"] == "{base}{page}/"


def test_functions_for_links_of_known_portals():
    own = cards.strategy_of("pisos.com", {"detail_link_selectors": ["a.mine"]}, {"pisos.com": cards.Slots(is_detail=lambda u: u.endswith("!"))})
    assert own.links == ("a.mine",) and own.is_detail("https://x/!") and not own.is_detail("https://www.pisos.com/inmueble/1/")
    assert own.normal("/a?o=1", "https://pisos.com/") == "https://pisos.com/a/?o=1"
    assert cards.strategy_of("pisos.com", {"listing_detail_link_selectors": ["a.first"], "detail_link_selectors": ["a.mine"]}).links == ("a.first",)


def card(n, source, operation):
    return f"<div class='card'><a href='/inmuebles/{n}'>Nave {n} en Bilbao</a> 500 m² 100.000 € {operation}</div>"


def test_ten_sources_into_two_sheets(spark, tmp_path):
    """Five with numbered pages, the third of which is empty and hides a fourth; five that link to their next page, one of
    them in a circle. Two sources show the same link."""
    site, starts = {}, []
    for k in range(10):
        base = f"https://s{k}.es"
        show = lambda n, k=k: card(f"{k}{n}" if k != 9 else f"8{n}", k, "venta" if k % 2 else "alquiler")
        if k < 5:
            site |= {f"{base}/l": show(1) + show(2) if k else "<p>nada</p>", f"{base}/l?page=2": show(3), f"{base}/l?page=3": "<p>fin</p>", f"{base}/l?page=4": show(4)}
            starts.append((f"s{k}", f"{base}/l", f"{base}/l?page={{page}}"))
        else:
            site |= {f"{base}/l": show(1) + "<a rel='next' href='/2'>más</a>", f"{base}/2": show(2) + (f"<a rel='next' href='{base}/l'>más</a>" if k == 5 else "<ul class='pagination'><li><a class='next' href='3'></a></li></ul>"), f"{base}/3": show(3)}
            starts.append((f"s{k}", f"{base}/l", None))
    pages = spark.createDataFrame(list(site.items()), "url string, html string")
    asked = []

    def get(urls):
        asked.extend(r["url"] for r in urls.collect())
        return urls.join(pages, "url", "left")

    readers = {f"s{k}": older.card_reader("https://s8.es" if k == 9 else f"https://s{k}.es", f"s{k}") for k in range(10)}
    counts = older.crawl(spark.createDataFrame(starts, "source string, url string, template string"), get, readers, f"file://{tmp_path}", "2026-03-22")
    assert counts == {"s0": 1, **{f"s{k}": 3 for k in range(1, 5)}, "s5": 2, **{f"s{k}": 3 for k in range(6, 10)}}
    assert len(asked) == len(set(asked)) and not any(u.endswith("page=4") for u in asked) and "https://s5.es/3" not in asked
    sheets = {name: t.read_csv(spark, f"file://{tmp_path}/{name}", list(older.SHEET)).collect() for name in ("Alquiler", "Venta")}
    want = {"s0": ["03"], **{f"s{k}": [f"{k}{n}" for n in (1, 2, 3)] for k in range(1, 9)}, "s5": ["51", "52"]}
    links = {f"https://{s}.es/inmuebles/{n}" for s, ns in want.items() for n in ns}  # what s9 shows was shown by s8
    assert {r["Link"] for rows in sheets.values() for r in rows} == links and sum(map(len, sheets.values())) == len(links)
    assert {r["Fuente"] for r in sheets["Alquiler"]} == {"s0", "s2", "s4", "s6", "s8"} and all(r["m²"] == "500" for r in sheets["Venta"])


def test_a_crawl_without_pages(spark, tmp_path):
    starts = spark.createDataFrame([("s", "https://s.es/l", None)], "source string, url string, template string")
    none = lambda urls: urls.withColumn("html", F.lit(None).cast("string"))
    assert older.crawl(starts, none, {"s": older.card_reader("https://s.es", "s")}, f"file://{tmp_path}", "2026-03-22") in ({}, {"s": 0})
    with pytest.raises(FileNotFoundError):
        t.read_export(spark, f"file://{tmp_path}/none.csv", None, ["a"])
