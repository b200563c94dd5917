"""Parts that no query shows: Markdown of pages, places and descriptions, embedded states, the viewer's table, topics."""

import datetime

from pyspark.sql import functions as F

from lindero.functions import dom
from lindero.operators import details, discovery, legacy, ordered, viewer
from lindero.plans import pipeline
from lindero.streaming import publishing


def test_markdown_of_pages(spark):
    page = "<h2>Nave <b>grande</b></h2><script>x</script><div><p>uno<br>dos <img src='i'></p><ul><li>a <a href='/b'>c</a></li><li>d</li></ul></div><noscript>n</noscript>"
    assert dom.markdown(page) == "## Nave **grande**\n\nuno\ndos\n\n* a [c](/b)\n\n* d"
    deep = "<div>" * 3000 + "fondo" + "</div>" * 3000
    rows = [(1, page, None), (2, page, "suyo"), (3, None, None), (4, page, ""), (5, deep, None), (6, "", None)]
    got = {r["k"]: r["markdown"] for r in discovery.with_markdown(spark.createDataFrame(rows, "k int, html string, markdown string")).collect()}
    assert got == {1: dom.markdown(page), 2: "suyo", 3: None, 4: dom.markdown(page), 5: "fondo", 6: None}


def test_pages_without_markdown_get_their_own(spark):
    urls = spark.createDataFrame([("https://a.es/1", 1), ("https://a.es/2", 2)], "url string, seq int").withColumn("day", F.lit("2026-03-22").cast("date"))
    fetch = lambda u: u.select("url", F.when(F.col("url").endswith("1"), "<p>uno</p>").alias("html"), F.lit(None).cast("string").alias("markdown"))
    assert {r["url"][-1]: r["status"] for r in pipeline.archived(urls, fetch).collect()} == {"1": "partial", "2": "error"}
    assert {r["url"][-1]: (r["status"], r["markdown"]) for r in pipeline.archived(urls, fetch, local_markdown=True).collect()} == {"1": ("ok", "uno"), "2": ("error", None)}


def test_places_in_their_order():
    def place(html, title=None, url="https://www.fotocasa.es/x", both=""):
        return details._fotocasa_place(dom.parse(html), title, url, both)

    own = details.SELECTORS["fotocasa_detail"]["location"]
    assert len(own) == 5
    assert place("<nav class='breadcrumb'><a>Getxo</a><a>Barakaldo</a></nav>", "Nave, Bilbao") == "Barakaldo"
    assert place("<p class='zone'>Leioa</p><nav class='breadcrumb'><a>Getxo</a></nav>", "Nave, Bilbao") == "Leioa"
    assert place("", "Nave en venta, Polígono Sur, Bilbao") == "Bilbao"
    kind = next(iter(details.KIND_SEGMENTS))
    assert place("", None, f"https://www.fotocasa.es/es/{kind}/san-mames/9/d") == "san mames"
    assert place("", None, "https://www.fotocasa.es/x", "una nave en Sestao, cerca") == "Sestao"
    assert place("", None) is None and details.place_of("a") is None and details.place_of("12 34") is None and details.place_of("x" * 81) is None


def test_descriptions_without_marks():
    text = "**Nave** industrial muy _amplia_ y luminosa # con oficinas"
    assert details.description_of(text) == "Nave industrial muy amplia y luminosa con oficinas"
    assert details.description_of("corta") is None and details.description_of(None) is None
    assert len(details.description_of("nave " * 900)) <= 1500


def test_embedded_states(spark):
    rows = [("<script id=\"__NEXT_DATA__\" type=\"application/json\">{\"a\": 1}</script>",), ("<p>nada</p>",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "h string").select(legacy.state_json(F.col("h"))).collect()]
    assert got == ['{"a": 1}', None, None]


def test_titles_and_lines_of_many_documents(spark):
    lines = [(f"d{k % 3}", k, "t" if k % 5 == 0 else f"- dato {k}", k % 5 == 0) for k in range(1, 60)]
    df = spark.createDataFrame(lines, "doc string, pos int, line string, head boolean").repartition(5)
    got = {(r["doc"], r["record"]): r["features"] for r in legacy.feature_records(df, "doc", "pos", "line", F.col("head")).collect()}
    want = {}
    for d in ("d0", "d1", "d2"):
        record = 0
        for doc, _, line, head in lines:
            if doc == d:
                record += head
                if record:
                    want.setdefault((d, record), [])
                    if not head:
                        want[d, record].append(line[2:])
    assert got == want


def test_table_of_the_viewer(spark):
    rows = [("k1", "fotocasa.es", "Nave", "1 €", None, 980.0, 3, "processed", "u"), ("k2", "otro.es", None, None, "Bilbao", 50.5, None, None, None)]
    df = spark.createDataFrame(rows, "listing_key string, source_domain string, title string, price_text string, location_text string, surface_sqm double, rooms_count int, workflow_status string, url_final string")
    got = {r["listing_key"]: r for r in viewer.view_table(df).collect()}
    assert (got["k1"]["surface"], got["k1"]["rooms"], got["k1"]["location_text"], got["k1"]["status"]) == ("980 m²", "3", "", viewer.STATUS_LABELS["processed"])
    assert (got["k2"]["surface"], got["k2"]["title"], got["k2"]["status"]) == ("50.5 m²", "", viewer.STATUS_LABELS["pending"])
    assert "portal" not in viewer.view_table(df, with_portal=False).columns


def test_topics_links_and_first_rows(spark):
    df = spark.createDataFrame([("una NAVE", None, None), ("un pabellón", None, None), ("navegar", None, None), (None, 1.0, None), ("local", None, 5)], "t string, p double, m int")
    assert [r[0] for r in df.select(legacy.is_topical(F.col("t"), F.col("p"), F.col("m"))).collect()] == [True, True, False, True, True]
    xml = spark.createDataFrame([("<urlset><url><loc> https://a.es/1 </loc></url><LOC>https://a.es/2</LOC></urlset>",)], "x string")
    assert xml.select(legacy.sitemap_links(F.col("x"))).first()[0] == ["https://a.es/1", "https://a.es/2"]
    n = spark.range(9)
    assert [r["id"] for r in ordered.first_n(n, [F.desc("id")], 2).collect()] == [8, 7] and ordered.first_n(n, [F.col("id")], 0).count() == 9


def test_counts_by_window(spark, tmp_path):
    at = datetime.datetime(2026, 3, 22, 10, 5)
    rows = [(at + datetime.timedelta(minutes=m), p) for m, p in ((0, "a"), (10, "a"), (50, "b"), (70, "a"), (300, "a"))]
    spark.createDataFrame(rows, "at timestamp, portal string").coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("at timestamp, portal string").parquet(f"{tmp_path}/in")
    seen = []
    publishing.windowed_counts(stream, "at").writeStream.outputMode("update").foreachBatch(lambda df, _: seen.extend(df.collect())).option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start().awaitTermination(60)
    assert sorted((r["window"]["start"].hour, r["portal"], r["n"]) for r in seen) == [(10, "a", 2), (10, "b", 1), (11, "a", 1), (15, "a", 1)]
