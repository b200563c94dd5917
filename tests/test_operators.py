"""Operators on small tables, and against a row-by-row model on random ones."""

import random

import pytest
from pyspark.sql import functions as F

from lindero.operators import aliases, cards, details, discovery, history, legacy, ordered, planning, reporting, viewer
from lindero.plans import pipeline, publish
from lindero.sources import config
from lindero.sources import tables as t

RECORDS = "source_domain string, url_final string, title string, price_text string, price_value string, location_text string, surface_sqm string, rooms_count string, parser_key string, parse_status string, seq long"


def record(url, domain="fotocasa.es", price="100.0", seq=0, title="Nave"):
    return (domain, url, title, "100 €", price, "Bilbao", "50", "2", "p", "ok", seq)


DAY1 = [record("https://www.fotocasa.es/x/188901695/d?from=a", seq=0), record("https://www.fotocasa.es/x/188901695/d", seq=1, price=None), record("https://www.pisos.com/alquilar/nave-1234567_1/", "pisos.com", seq=2)]
DAY2 = [record("https://www.fotocasa.es/x/188901695/d", seq=0), record("https://www.idealista.com/inmueble/777777/", "idealista.com", seq=1)]


def test_two_days_of_publishing(spark, tmp_path):
    root = f"file://{tmp_path}"
    first = publish.publish_to(spark.createDataFrame(DAY1, RECORDS), root, "2026-03-21", "n1")
    assert (first["input_records"], first["deduped_records"], first["new_records"]) == (3, 2, 2)
    assert first["portal_counts"] == {"fotocasa": 1, "idealista": 0, "milanuncios": 0, "pisos": 1, "yaencontre": 0}
    again = publish.publish_to(spark.createDataFrame(DAY1, RECORDS), root, "2026-03-21", "n1")
    assert again["new_records"] == 2  # a second run of a day gives its listings again
    publish.set_status(spark, root, "pisos.com:id:1234567", "processed", "n2", "visto")
    second = publish.publish_to(spark.createDataFrame(DAY2, RECORDS), root, "2026-03-22", "n3")
    assert (second["deduped_records"], second["new_records"], second["history_records"]) == (2, 1, 3)
    m = {r["listing_key"]: r for r in t.read_versioned(spark, f"{root}/master", history.MASTER_DDL).collect()}
    old = m["fotocasa.es:id:188901695"]
    assert (str(old["first_seen_date"]), str(old["last_seen_date"]), old["seen_count"], old["workflow_status"], old["price_value"]) == ("2026-03-21", "2026-03-22", 2, "pending", 100.0)
    assert (m["pisos.com:id:1234567"]["workflow_status"], m["pisos.com:id:1234567"]["workflow_note"], m["pisos.com:id:1234567"]["seen_count"]) == ("processed", "visto", 1)
    assert publish.published_dates(spark, root) == ["2026-03-22", "2026-03-21"]
    assert [r["listing_key"] for r in t.read_csv(spark, f"{root}/published/2026-03-22/all.csv", publish.PUBLISHED).collect()] == ["idealista.com:id:777777"]
    assert t.read_csv(spark, f"{root}/published/2026-03-22/yaencontre.csv", publish.PUBLISHED).count() == 0


def test_null_of_today_replaces_yesterdays_value(spark):
    none = t.empty(spark, history.STATUS_DDL)
    one = publish.publish(spark.createDataFrame(DAY2[:1], RECORDS), t.empty(spark, history.MASTER_DDL), none, "2026-03-21", "n").master
    two = publish.publish(spark.createDataFrame([record(DAY2[0][1], price=None)], RECORDS), one.drop("in_batch"), none, "2026-03-22", "n").master
    assert [r["price_value"] for r in two.collect()] == [None]


def test_unknown_status(spark):
    with pytest.raises(ValueError):
        history.status_set(t.empty(spark, history.STATUS_DDL), "k", "open", "n")


def test_ordered_against_a_model(spark):
    rng = random.Random(4)
    rows = [(rng.choice("abcdef"), i, rng.randint(0, 3)) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, seq long, score int").repartition(5)
    last, first, best = {}, {}, {}
    for k, i, s in rows:
        last[k] = i
        first.setdefault(k, i)
        if k not in best or s > best[k][1]:
            best[k] = (i, s)
    assert {r["k"]: (r["seq"], r["first_seq"]) for r in ordered.last_by_key(df, ["k"], "seq").collect()} == {k: (last[k], first[k]) for k in last}
    assert {r["k"]: r["seq"] for r in ordered.first_by_key(df, ["k"], "seq").collect()} == first
    assert {r["k"]: r["seq"] for r in ordered.best_by_key(df, ["k"], F.col("score"), "seq").collect()} == {k: v[0] for k, v in best.items()}


def test_latest_equal_before(spark):
    df = spark.createDataFrame([("u", 1, "x", None), ("u", 2, "y", "h"), ("u", 3, "x", "h"), ("u", 4, "z", "h"), ("v", 1, "x", None)], "u string, seq int, a string, b string")
    got = {(r["u"], r["seq"]): (r["is_duplicate"], r["match_reason"], r["matched_seq"], r["previous_count"]) for r in ordered.latest_equal_before(df, ["u"], "seq", [("a", "content"), ("b", "html")]).collect()}
    assert got == {("u", 1): (False, "none", None, 0), ("u", 2): (False, "none", None, 1), ("u", 3): (True, "html", 2, 2), ("u", 4): (True, "html", 3, 3), ("v", 1): (False, "none", None, 0)}


def test_latest_equal_before_against_a_model(spark):
    rng = random.Random(8)
    names = [("p", "content"), ("m", "markdown"), ("h", "html")]
    rows = [(rng.choice("uv"), i, *(rng.choice(["a", "b", "c", None]) for _ in names)) for i in range(120)]
    df = spark.createDataFrame(rows, "u string, seq int, p string, m string, h string").repartition(4)
    got = {r["seq"]: (r["is_duplicate"], r["match_reason"], r["matched_seq"], r["previous_count"]) for r in ordered.latest_equal_before(df, ["u"], "seq", names).collect()}
    for u, i, *hashes in rows:
        before = [r for r in rows if r[0] == u and r[1] < i]
        want = next(((True, names[k][1], r[1]) for r in reversed(before) for k in range(3) if hashes[k] and r[2 + k] == hashes[k]), (False, "none", None))
        assert got[i] == (*want, len(before))


def test_alias_groups_follow_the_last_row(spark):
    def merged(rows):
        """The rule, row by row: all keys of a row lead to the group that it joined."""
        groups, leads = {}, {}
        for i, keys, filled in rows:
            keys = [k.strip() for k in keys if k.strip()]
            if not keys:
                continue
            group = next((leads[k] for k in keys if k in leads), keys[0])
            if group not in groups or filled > groups[group][0]:
                groups[group] = (filled, i)
            for k in keys:
                leads[k] = group
        return sorted(i for _, i in groups.values())

    def run(rows):
        cols = "r string, seq int, external_id string, listing_key string, canonical_url string, url string, title_text string, price_text string"
        data = [("r", i, *keys, "t" if filled > 0 else "", "p" if filled > 1 else "") for i, keys, filled in rows]
        df = spark.createDataFrame(data, cols)
        return sorted(x["seq"] for x in aliases.merge_aliases(df, "r", "seq", scored=("title_text", "price_text")).collect())

    joined = [(1, ("", "k1", "", ""), 1), (2, ("", "k2", "", ""), 1), (3, ("", "k1", "k2", ""), 0), (4, ("", "k2", "", ""), 2)]
    assert run(joined) == merged(joined) == [2, 4]
    rng = random.Random(5)
    for _ in range(6):
        rows = [(i, tuple(rng.choice(["", f" k{rng.randint(0, 9)}", f"k{rng.randint(0, 9)}"]) for _ in range(4)), rng.randint(0, 2)) for i in range(40)]
        assert run(rows) == merged(rows)


def test_json_lines_keep_objects_only(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_text('{"a": "1", "n": 2}\n\n  {"a": "2"}  \n[{"a": "3"}]\n{"a": "4"\n7\n"x"\nnull\n{"a": "5", "n": "x"}\n')
    assert [(r["a"], r["n"]) for r in t.read_json_lines(spark, f"file://{path}", "a string, n int").collect()] == [("1", 2), ("2", None), ("5", None)]
    with pytest.raises(Exception, match="not a JSON object"):
        t.read_json_lines(spark, f"file://{path}", "a string", strict=True).collect()
    assert t.read_json_lines(spark, f"file://{tmp_path}/none", "a string").count() == 0


def test_versions_survive_a_crash_at_any_point(spark, tmp_path):
    root = f"file://{tmp_path}/v"
    assert t.read_versioned(spark, root, "a int").count() == 0
    t.write_versioned(spark.range(1).selectExpr("1 as a"), root)
    one = {p.name for p in (tmp_path / "v").iterdir()}
    t.write_versioned(t.read_versioned(spark, root, "a int").selectExpr("a + 1 as a"), root)
    assert one <= {p.name for p in (tmp_path / "v").iterdir()}  # what was current is still there
    assert [r["a"] for r in t.read_versioned(spark, root, "a int").collect()] == [2]
    (tmp_path / "v" / "v-dead").mkdir()  # a version that was being written, without a pointer
    assert [r["a"] for r in t.read_versioned(spark, root, "a int").collect()] == [2]


def test_a_day_in_two_micro_batches(spark, tmp_path):
    from lindero.streaming import publishing

    data, root = f"{tmp_path}/in", f"file://{tmp_path}/root"
    for k, rows in enumerate([DAY1[:1], DAY1[2:]]):
        spark.createDataFrame(rows, RECORDS).withColumn("publish_date", F.lit("2026-03-21")).coalesce(1).write.mode("append").parquet(data)
        stream = spark.readStream.schema(RECORDS + ", publish_date string").parquet(data)
        publishing.publish_stream(stream, root, f"{tmp_path}/check").trigger(availableNow=True).start().awaitTermination()
        assert t.read_csv(spark, f"{root}/published/2026-03-21/all.csv", publish.PUBLISHED).count() == k + 1


def test_strategies_of_documents(spark):
    html = "<section><a href='/oferta/12'>Nave industrial grande</a></section><section><a href='/ayuda/1'>Preguntas frecuentes aquí</a></section>"
    p = spark.createDataFrame([(1, "nuevo.es", "https://nuevo.es/l", html, ["section"], [" "], ["/oferta/[0-9]+"], ["/ayuda"])], "page_id int, source_domain string, base_url string, html string, listing_card_selectors array<string>, listing_detail_link_selectors array<string>, listing_detail_url_patterns array<string>, listing_reject_url_patterns array<string>")
    assert [(r["candidate_url"], r["rejection_reason"]) for r in cards.cards(p).orderBy("card_position").collect()] == [("https://nuevo.es/oferta/12", None), (None, "rejected_by_url_rules")]
    assert {r["rejection_reason"] for r in cards.cards(p.drop(*cards.OVERLAID)).collect()} == {"non_detail_url"}
    own = cards.strategy_of("pisos.com", {"listing_card_selectors": ["x", " "], "listing_reject_url_patterns": None})
    assert own.cards == ("x",) and own.reject == own.portal.reject and own.detail == own.portal.detail


def test_detail_urls_of_a_host(spark):
    from lindero.functions import portals

    rows = [
        ("https://www.idealista.com/inmueble/1/", "idealista.com", None, None, True),
        ("https://idealista.com/inmueble/1/", "idealista.com", None, None, True),
        ("https://evil.com/inmueble/1/", "idealista.com", None, None, False),
        ("https://notidealista.com/inmueble/1/", "idealista.com", None, None, False),
        ("https://www.idealista.com/inmueble/1/", "idealista.com", None, ["/inmueble"], False),
        ("https://www.idealista.com/otro/1/", "idealista.com", ["/otro"], None, False),
        ("https://x.nuevo.es/oferta/1", "nuevo.es", ["/oferta/"], None, True),
        ("https://x.nuevo.es/oferta/1", "nuevo.es", None, None, False),
        ("", "nuevo.es", ["."], None, False),
    ]
    df = spark.createDataFrame(rows, "url string, domain string, detail array<string>, reject array<string>, want boolean")
    got = df.select(portals.is_detail_of(F.col("url"), F.col("domain"), F.col("detail"), F.col("reject")).alias("got"), "want").collect()
    assert [r["got"] for r in got] == [r["want"] for r in got]


def test_upsert_and_null_keys(spark):
    df = spark.createDataFrame([(None, 1, "n"), ("a", 2, "x"), ("a", 3, "y"), (None, 4, "m")], "k string, seq int, v string")
    assert sorted(r["v"] for r in ordered.keep_last_but_null(df, "k", "seq").collect()) == ["m", "n", "y"]
    new = spark.createDataFrame([("a", 9, "z")], "k string, seq int, v string")
    assert sorted(r["v"] for r in ordered.upsert(df, new, "k").collect()) == ["m", "n", "z"]


def test_relevance(spark):
    c = spark.createDataFrame([("a",), ("b",), ("c",)], "listing_key string")
    m = spark.createDataFrame([("a", "2026-03-22"), ("b", "2026-03-21")], "listing_key string, d string").select("listing_key", F.to_date("d").alias("last_seen_date"))
    got = {r["listing_key"]: r["selection_reason"] for r in history.with_relevance(c, m, F.lit("2026-03-22").cast("date")).collect()}
    assert got == {"a": "already_seen_today", "b": "seen_previous_day", "c": "new_listing_key"}


def test_eligibility_and_seeds(spark):
    jobs = spark.createDataFrame([("j", ["a", "b", "c", "d"])], "job_name string, sources array<string>")
    sources = spark.createDataFrame([("a", True, True, ["u1", "u2", "u1"]), ("b", False, True, ["u3"]), ("c", True, False, ["u4"])], "domain string, enabled boolean, archiver_enabled boolean, start_urls array<string>")
    plan = planning.job_sources(jobs, sources)
    assert {r["domain"]: r["reason"] for r in plan.collect()} == {"a": None, "b": "disabled", "c": "archiver_disabled", "d": "missing_source"}
    assert [(r["url"], r["times"]) for r in planning.seed_urls(plan).collect()] == [("u1", 2), ("u2", 1)]
    assert planning.seed_urls(plan, 1).count() == 1


def test_discovery(spark):
    html = "<a href='/inmueble/1'>x</a><a href='/contacto'>c</a><a href='https://other.es/inmueble/2'>o</a><a href='/inmueble/1?from=list'>x</a>"
    s = spark.createDataFrame([(1, "https://www.x.es/l", html, "[m](/ficha/3) [a](/agencia/1)", "generic", "x.es", "unknown")], "seq int, base_url string, html string, markdown string, parser_key string, allowed_domain string, page_kind string")
    assert sorted(r["url"] for r in discovery.discovered(s).collect()) == ["https://www.x.es/ficha/3", "https://www.x.es/inmueble/1"]
    assert discovery.discovered(s.withColumn("page_kind", F.lit("detail"))).count() == 0


LISTING = """<article class='re-Card' data-adid='123456789'><a href='/es/alquiler/naves-industriales/x/123456789/d'>Nave en Bilbao grande</a><span class='re-CardPrice'>450.000 €</span><span>980 m²</span></article>
<article class='re-Card' data-adid='123456789'><a href='/es/alquiler/naves-industriales/x/123456789/d?from=l'>Nave en Bilbao grande</a><span class='re-CardPrice'>450.000 €</span><span>980 m²</span></article>
<article class='re-Card'><a href='/es/alquiler/naves-industriales/y/987654321/d'>Otra nave más</a><span class='re-CardPrice'>1.200 €/mes</span></article>
<article class='re-Card'><a href='/inmobiliaria/z'>Agencia de naves</a></article>"""


def test_cards(spark):
    p = spark.createDataFrame([(1, "fotocasa.es", "https://www.fotocasa.es/es/l", LISTING), (2, "milanuncios.com", "https://www.milanuncios.com/", "<p>Captcha</p>"), (3, "fotocasa.es", "https://x", None)], "page_id int, source_domain string, base_url string, html string")
    read = cards.cards(p)
    reasons = {(r["page_id"], r["card_position"]): r["rejection_reason"] for r in read.collect()}
    assert reasons == {(1, 1): None, (1, 2): None, (1, 3): None, (1, 4): "rejected_by_url_rules", (2, 0): "blocked_listing_page"}
    best = {r["external_id"]: r for r in cards.richest(cards.candidates(read), "card_position", ["source_domain"]).collect()}
    assert sorted(best) == ["123456789", "987654321"]
    assert best["123456789"]["price_text"] == "450.000 €" and best["123456789"]["card_position"] == 1
    assert best["987654321"]["price_value"] == 1200.0 and best["123456789"]["listing_key"] == "fotocasa.es:id:123456789"


def test_details(spark):
    pisos = "<html><head><title>Nave en alquiler</title></head><body><h1>Nave</h1><span class='price'>235.000 €</span><ul class='features'><li>1200 m2</li><li>3 habitaciones</li></ul><div class='location'>Bilbao</div><div class='description'>Nave grande</div></body></html>"
    foto = "<meta property='og:title' content='Nave, Bilbao'><span class='price'>450.000 €</span><ul class='features'><li>980 m²</li><li>4 habitaciones</li></ul><div class='description'>Conecta tu hogar. Una nave industrial muy amplia y luminosa en el polígono, con oficinas. Llamar</div>"
    rows = [
        ("a", "pisos.com", "https://www.pisos.com/alquilar/nave-1234567_1/", pisos, None),
        ("b", "fotocasa.es", "https://www.fotocasa.es/es/x/1/d", foto, None),
        ("c", "otro.es", "https://otro.es/inmueble/1", "<h1>Nave</h1><p>250000 EUR, 1200 m2, 3 habitaciones en Bilbao <a href='/x'>x</a>", None),
        ("d", "fotocasa.es", "https://www.fotocasa.es/inmobiliaria/x", "<h1>Agencia</h1>", None),
        ("e", "otro.es", "https://otro.es/", None, None),
    ]
    got = {r["snapshot_id"]: r for r in details.parsed(spark.createDataFrame(rows, "snapshot_id string, domain string, url_final string, html string, markdown string")).collect()}
    a, b, c, d, e = (got[k] for k in "abcde")
    assert (a["page_kind"], a["price_currency"], a["price_value"], a["surface_sqm"], a["rooms_count"]) == ("detail", "EUR", 235000.0, 1200.0, 3) and a["confidence_score"] >= 0.6
    assert (b["parse_status"], b["price_value"], b["surface_sqm"], b["rooms_count"], b["location_text"]) == ("ok", 450000.0, 980.0, 4, "Bilbao") and "onecta" not in b["description_text"]
    assert (c["parse_status"], c["price_currency"], c["price_value"], c["surface_sqm"], c["rooms_count"], c["extracted_links"]) == ("ok", "EUR", 250000.0, 1200.0, 3, ["/x"])
    assert d["page_kind"] == "listing" and d["price_value"] is None and d["confidence_score"] < 0.7
    assert e["parse_status"] == "error" and "missing_html_and_markdown" in e["parse_errors"]


def test_funnel(spark):
    harvest = spark.createDataFrame([("fotocasa.es", *[1] * 8), ("otro.es", *[2] * 8)], "source_domain string, " + ", ".join(f"{m} long" for m in reporting.METRICS))
    archived = spark.createDataFrame([("fotocasa.es", "ok", "p1"), ("milanuncios.com", "partial", "p2"), ("milanuncios.com", "error", "p3")], "source_domain string, status string, snapshot_path string")
    parsed = spark.createDataFrame([("fotocasa.es", "detail", "ok"), ("milanuncios.com", "detail", "partial"), ("fotocasa.es", "listing", "ok")], "source_domain string, page_kind string, parse_status string")
    errors = spark.createDataFrame([("p2", "x"), ("gone", "y")], "snapshot_path string, error string")
    got = {r["portal"]: r for r in reporting.funnel(harvest, archived, parsed, errors).collect()}
    assert len(got) == 6 and got["total"]["candidates_emitted"] == 3 and got["pisos.com"]["detail_archive_ok"] == 0
    m = got["milanuncios.com"]
    assert (m["detail_archive_ok"], m["detail_archive_error"], m["parsed_detail_partial"], m["parsed_detail_error"]) == (1, 1, 1, 1) and got["fotocasa.es"]["parsed_detail_ok"] == 1


def test_aliases(spark):
    rows = [("r", 1, "9", "k1", "u1", "a", "t", None), ("r", 2, None, "k1", "u2", "b", "t", "p"), ("r", 3, None, "k3", "u3", "c", "t", None), ("r", 4, "9", "k3", "u4", "d", None, None)]
    df = spark.createDataFrame(rows, "run string, seq int, external_id string, listing_key string, canonical_url string, url string, title_text string, price_text string")
    assert [r["seq"] for r in aliases.merge_aliases(df, "run", "seq").orderBy("seq").collect()] == [2, 3]  # groups that are apart stay apart


def test_viewer(spark):
    df = spark.createDataFrame([("fotocasa", "pending", "2026-03-21", "2026-03-22", "Nave 50%"), ("pisos", None, "2026-03-20", None, "Local")], "portal string, workflow_status string, first_seen_date string, last_seen_date string, title string")
    assert viewer.history_filtered(df, portal="fotocasa", status="pending", day="2026-03-22", text="nave 50%").count() == 1
    assert viewer.history_filtered(df, text="50_").count() == 0
    assert [r["day"] for r in viewer.known_dates(df, "first_seen_date", "last_seen_date").collect()] == ["2026-03-22", "2026-03-21", "2026-03-20"]
    assert df.agg(viewer.pending_count()).first()[0] == 2


def test_older_scraper(spark):
    lines = spark.createDataFrame([("d", i, x) for i, x in enumerate(["inicio", "Se alquila pabellón", "- 500 m2", "ok", "MAPA DEL SITIO x", "SE VENDE nave", "luz"])], "doc string, pos int, line string")
    assert [(r["title"], r["features"]) for r in legacy.feature_records(lines, "doc", "pos", "line").orderBy("record").collect()] == [("Se alquila pabellón", ["500 m2"]), ("SE VENDE nave", ["luz"])]
    blob = spark.createDataFrame([(1, '{"a": [{"url": "https://www.idealista.com/1", "title": "Nave 300 m2 Bilbao 1.500 €", "sub": {"detailUrl": "https://indomio.es/2"}}], "url": 5}'), (2, "{bad"), (3, None)], "id int, j string")
    items = legacy.with_fields(legacy.json_items(blob, "id", "j")).orderBy("place").collect()
    assert [(i["link"], i["m2"], i["precio"], i["localidad"]) for i in items] == [("https://www.idealista.com/1", 300, 1500.0, "Bilbao"), ("https://indomio.es/2", None, None, None)]
    pages_ = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "url string, next_url string")
    assert {(r["url"], r["hop"]) for r in legacy.reachable_pages(pages_, spark.createDataFrame([("a",)], "url string")).collect()} == {("a", 1), ("b", 2), ("c", 3)}


def test_tables_and_config(spark, tmp_path):
    p = tmp_path / "x.jsonl"
    p.write_text('{"a": "1"}\n\nbad\n[1]\n{"a": "2"}\n')
    assert sorted(r["a"] for r in t.read_json_lines(spark, f"file://{p}", "a string").collect()) == ["1", "2"]
    assert t.read_json_lines(spark, f"file://{tmp_path}/none", "a string").count() == 0
    with pytest.raises(Exception):
        t.read_json_lines(spark, f"file://{p}", "a string", strict=True).collect()
    with pytest.raises(FileNotFoundError):
        t.read_export(spark, f"file://{tmp_path}/no.csv", None, ["a"])
    root = f"file://{tmp_path}/v"
    t.write_versioned(spark.range(3), root)
    t.write_versioned(t.read_versioned(spark, root, "id long").filter("id > 0"), root)  # replaces what it reads
    assert t.read_versioned(spark, root, "id long").count() == 2
    d = tmp_path / "sources"
    d.mkdir()
    (d / "a.yaml").write_text('{"domain": "a.es", "enabled": true, "mode": "m", "start_urls": ["u"],\n "rate_limit_seconds": 2, "login_allowed": false, "parser_key": "generic"}')
    s = config.load_sources(spark, f"file://{d}")
    assert config.by_key(s, "domain", "a.es")["timeout_seconds"] == 20.0
    with pytest.raises(KeyError):
        config.by_key(s, "domain", "b.es")
    (d / "b.yaml").write_text('{"enabled": true}')
    with pytest.raises(ValueError, match="domain"):
        config.load_sources(spark, f"file://{d}")


def test_pipeline_with_resume(spark, tmp_path):
    jobs = spark.createDataFrame([("j", ["fotocasa.es"], 0)], "job_name string, sources array<string>, max_urls int")
    sources = config.with_defaults(spark.createDataFrame([("fotocasa.es", True, "generic", ["https://www.fotocasa.es/"], ["https://www.fotocasa.es/es/l"], True, True, 1)], "domain string, enabled boolean, parser_key string, start_urls array<string>, listing_start_urls array<string>, archiver_enabled boolean, harvest_enabled boolean, max_listing_pages int"))
    for c, kind in (("listing_page_start", "int"), ("listing_page_param", "string"), ("listing_page_url_template", "string"), ("listing_first_page_uses_start_url", "boolean")):
        sources = sources.withColumn(c, F.lit(None).cast(kind))

    def fetch(urls):
        return urls.select("url", F.when(F.col("url").endswith("/l"), F.lit(LISTING)).otherwise(F.lit("<h1>Nave</h1><span class='price'>450.000 €</span><p>980 m2, 4 habitaciones, Bilbao</p>")).alias("html"), F.lit("nave").alias("markdown"))

    root = f"file://{tmp_path}"
    done = pipeline.run_job(spark, "j", jobs, sources, root, "r", "2026-03-22", fetch)
    assert done.errors == [] and done.status == "completed" and set(done.statuses.values()) == {"completed"}
    assert spark.read.parquet(f"{root}/r/parse").filter("parse_status <> 'error'").count() == 2
    total = next(r for r in spark.read.parquet(f"{root}/r/funnel").collect() if r["portal"] == "total")
    assert [total[m] for m in reporting.METRICS] == [1, 1, 4, 3, 1, 1, 0, 2]
    manifest = t.read_document(spark, f"{root}/r/manifest.json")
    assert manifest["rejection_reasons"] == {"fotocasa.es": {"rejected_by_url_rules": 1}} and manifest["page_statuses"]["archive"] == {"ok": 1, "partial": 0, "error": 0}
    again = pipeline.run_job(spark, "j", jobs, sources, root, "r", "2026-03-22", fetch, resume=True, force=("parse",))
    assert [k for k, v in again.statuses.items() if v == "completed"] == ["parse"]
    assert pipeline.overall({"archive": "failed", "parse": "skipped"}, 0) == "failed" and pipeline.overall({"archive": "completed"}, 2) == "partial"


def test_added_parsers_and_pages_that_cannot_be_read(spark):
    def read(html, markdown, url):
        return {"title": html.upper(), "price_text": "7.000 €"}, ["/a", "/a"]

    def broken(html, markdown, url):
        raise RuntimeError("broken")

    rows = [("a", "malo.es", "https://malo.es/1", "x", None), ("b", "otro.es", "https://otro.es/2", "<h1>Nave</h1>", None), ("c", "mio.es", "https://mio.es/3", "nave", None)]
    p = spark.createDataFrame(rows, "snapshot_id string, domain string, url_final string, html string, markdown string")
    parsers = [details.Parser("mine", ("mio.es",), read), details.Parser("broken", ("malo.es",), broken)]
    got = {r["snapshot_id"]: r for r in details.parsed(p, faults=True, parsers=parsers).collect()}
    assert got["a"]["read_error"] == "RuntimeError: broken" and got["b"]["read_error"] is None and got["b"]["title"] == "Nave"
    assert (got["c"]["parser_key"], got["c"]["title"], got["c"]["price_value"], got["c"]["extracted_links"]) == ("mine", "NAVE", 7000.0, ["/a"])
    assert sorted(r["snapshot_id"] for r in details.parsed(p, parsers=parsers).collect()) == ["b", "c"]


def test_files_of_one_name_keep_their_own_pages(spark, tmp_path):
    from lindero import cli

    for k in "ab":
        (tmp_path / k).mkdir()
        (tmp_path / k / "page.html").write_text(f"<p>{k}</p>")
    urls = spark.createDataFrame([(f"{tmp_path}/a/page.html",), (f"file://{tmp_path}/b/page.html",), (f"{tmp_path}/c/page.html",), ("https://x",)], "url string")
    assert sorted((r["html"] or "") for r in cli._files(urls).collect()) == ["", "", "<p>a</p>", "<p>b</p>"]


def test_deep_json_has_no_items(spark):
    deep = '{"a":' * 30000 + "1" + "}" * 30000
    df = spark.createDataFrame([(1, deep), (2, '{"url": "https://www.idealista.com/x"}')], "k int, blob string")
    assert [r["k"] for r in legacy.json_items(df, "k", "blob").collect()] == [2]


def test_stream_gives_what_batches_give(spark, tmp_path):
    from lindero.streaming.publishing import publish_stream

    for day, rows in (("2026-03-21", DAY1), ("2026-03-22", DAY2)):
        spark.createDataFrame(rows, RECORDS).withColumn("publish_date", F.lit(day).cast("date")).coalesce(1).write.parquet(f"{tmp_path}/in/{day}")
        publish.publish_to(spark.createDataFrame(rows, RECORDS), f"file://{tmp_path}/batch", day, f"{day}T00:00:00Z")
    source = spark.readStream.schema(RECORDS + ", publish_date date").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
    publish_stream(source, f"file://{tmp_path}/stream", f"file://{tmp_path}/ck").trigger(availableNow=True).start().awaitTermination(120)
    cols = ["listing_key", "first_seen_date", "last_seen_date", "seen_count", "price_value", "workflow_status"]
    a, b = (sorted(map(tuple, t.read_versioned(spark, f"file://{tmp_path}/{k}/master".replace("/master", "") + "/master", history.MASTER_DDL).select(cols).collect())) for k in ("batch", "stream"))
    assert a == b and len(a) == 3


def test_cli(spark, tmp_path, capsys):
    from lindero import cli

    (tmp_path / "jobs").mkdir()
    (tmp_path / "jobs/a.yaml").write_text('{"job_name": "j", "sources": ["a.es"]}')
    base = ["--root", f"file://{tmp_path}/data", "--jobs", f"file://{tmp_path}/jobs", "--sources", f"file://{tmp_path}/jobs"]
    assert cli.run(cli.parser().parse_args([*base, "list-jobs"]), spark) == 0 and "j | a.es" in capsys.readouterr().out
    assert cli.run(cli.parser().parse_args([*base, "show-run", "none"]), spark) == 2
    with pytest.raises(KeyError):
        cli.run(cli.parser().parse_args([*base, "show-job", "none"]), spark)
