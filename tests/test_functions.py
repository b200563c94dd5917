"""Column functions against tables of values."""

import pytest
from pyspark.sql import functions as F

from lindero.functions import dom, identity, numbers, pages, portals, text, urls


def values(spark, column, inputs):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    return [r[0] for r in rows.select("i", column(F.col("x")).alias("y")).orderBy("i").select("y").collect()]


def test_numbers_by_locale(spark):
    cases = {"450.000": 450000.0, "1.60": 1.6, "1,600": 1600.0, "1.234,5": 1234.5, "1,234.5": 1234.5, "450.000.": None, "1.875": 1875.0, "12,5": 12.5, " 1 200 ": 1200.0, "": None, None: None}
    assert values(spark, numbers.to_number, list(cases)) == list(cases.values())


def test_price(spark):
    cases = [("235.000 €", 235000.0, "EUR"), ("1.600 €", 1600.0, "EUR"), ("250000 EUR", 250000.0, "EUR"), ("USD 1,200.50", 1200.5, "USD"), ("£ 99", 99.0, "GBP"), ("Precio 1200", 1200.0, None), ("12", None, None), ("", None, None), (None, None, None)]
    got = values(spark, lambda c: numbers.price(c), [c[0] for c in cases])
    assert [(g["value"], g["currency"]) for g in got] == [(v, c) for _, v, c in cases]


def test_price_falls_back_only_beside_a_currency(spark):
    df = spark.createDataFrame([("Precio", "hay 900 naves"), ("Precio", "por 900 €")], "a string, b string")
    assert [r[0]["value"] for r in df.select(numbers.price(F.col("a"), F.col("b"))).collect()] == [None, 900.0]


def test_surface_and_rooms(spark):
    assert values(spark, numbers.surface, ["1200 m2", "450 m²", "1.200 m2", "90 metros cuadrados", "x"]) == [1200.0, 450.0, 1200.0, 90.0, None]
    assert values(spark, numbers.rooms, ["3 habitaciones", "2hab.", "4 dormitorios", "12 rooms", "123 hab"]) == [3, 2, 4, 12, None]


def test_older_numbers(spark):
    assert values(spark, numbers.listed_surface, ["1.200 m²", "90,7 m2", "x"]) == [1200, 90, None]
    assert [v["price"] for v in values(spark, lambda c: numbers.listed_price(c, F.lit(10)), ["1.875,50 €", "x"])] == [1875.5, None]


def test_text(spark):
    assert values(spark, text.clean, [" a \n b ", None, ""]) == ["a b", "", ""]
    assert values(spark, text.number_or_null, ["5", " 1e3 ", "5d", "nan", "", None]) == [5.0, 1000.0, None, None, None, None]
    assert values(spark, text.whole_or_null, ["5.9", "-5.9", "1e12"]) == [5, -5, None]
    assert values(spark, text.unaccented_upper, ["Pabellón"]) == ["PABELLON"]


@pytest.mark.parametrize(
    ("link", "full"),
    [("/a?x=1", "https://H.es/a?x=1"), ("b", "https://H.es/p/b"), ("../c", "https://H.es/c"), ("//o.es/d", "https://o.es/d"), ("?q=1", "https://H.es/p/x?q=1"), ("#t", "https://H.es/p/x?k=1#t"), ("mailto:a@b", "mailto:a@b"), ("./e/./f/..", "https://H.es/p/e/"), ("", "https://H.es/p/x?k=1#z")],
)
def test_absolute(spark, link, full):
    assert values(spark, lambda c: urls.absolute(F.lit("https://H.es/p/x?k=1#z"), c), [link]) == [full]


def test_canonical_and_queries(spark):
    assert values(spark, urls.canonical, ["HTTPS://WWW.X.es/A/b//?q#f", "https://x.es", "", None, "https://x.es/a|b.htm"]) == ["https://www.x.es/A/b", "https://x.es/", "", "", "https://x.es/a|b.htm"]
    assert values(spark, lambda c: urls.without_query_keys(c, ("from",)), ["https://x/a?from=1&b=2&c=#f", "https://x/a?from=1", "https://x/a#f"]) == ["https://x/a?b=2", "https://x/a", "https://x/a#f"]
    assert values(spark, lambda c: urls.candidate(c, F.lit("https://pisos.com/"), ("page",), keep_query=True), ["/alquilar/n-1?page=2&o=3"]) == ["https://pisos.com/alquilar/n-1/?o=3"]


def test_page_urls(spark):
    def at(start, n, param=None, template=None):
        s = urls.page_url(F.lit(start), F.lit(n), F.lit(1), F.lit(param).cast("string"), F.lit(template).cast("string"), F.lit(True))
        return tuple(spark.range(1).select(s.alias("s")).first()["s"])

    assert at("https://x/l", 1, "pagina") == ("https://x/l", "start_url")
    assert at("https://x/l", 2, "pagina") == ("https://x/l?pagina=2", "query_param")
    assert at("https://x/l?page=1&o=2", 3) == ("https://x/l?page=3&o=2", "query_param")
    assert at("https://x/l/", 2, template="{base}{page}/") == ("https://x/l/2/", "template")


def test_identity(spark):
    ids = {
        ("fotocasa.es", "https://www.fotocasa.es/es/x/188901695/d?from=list"): "188901695",
        ("idealista.com", "https://www.idealista.com/inmueble/123456/"): "123456",
        ("milanuncios.com", "https://www.milanuncios.com/n/a|b-98765.htm"): "98765",
        ("pisos.com", "https://www.pisos.com/alquilar/nave-1234567_100500/"): "1234567",
        ("yaencontre.com", "https://www.yaencontre.com/x/inmueble/55555"): "55555",
        ("otro.es", "https://otro.es/a/12345/b"): "12345",
        ("otro.es", "https://otro.es/a"): None,
    }
    df = spark.createDataFrame([(i, *k) for i, k in enumerate(ids)], "i int, d string, u string")
    assert [r[0] for r in df.orderBy("i").select(identity.external_id(F.col("d"), F.col("u"))).collect()] == list(ids.values())
    none = F.lit(None).cast("string")
    key = identity.identified(spark.range(1), F.lit(""), F.lit(""), none, F.lit("A"), F.lit(130000.0), none, none, F.lit(None).cast("double"), none).select("_id.listing_key").first()[0]
    import hashlib

    assert key == "unknown-domain:fingerprint:" + hashlib.sha256(b"unknown-domain|a|130000.0||").hexdigest()[:16]


def test_portal_rules(spark):
    df = spark.createDataFrame([("pisos.com", "https://www.pisos.com/alquilar/nave-1234567_100500/"), ("pisos.com", "https://www.pisos.com/alquiler/"), ("milanuncios.com", "https://www.milanuncios.com/x-1.htm"), ("otro.es", "https://otro.es/inmueble/1")], "d string, u string")
    assert [r[0] for r in df.select(portals.is_detail(F.col("u"), F.col("d"))).collect()] == [True, False, True, False]
    assert values(spark, portals.base_excluded, ["https://x/a", "https://x/Contacto", "https://x/#b"]) == [False, True, True]
    assert values(spark, lambda c: portals.is_blocked(c, F.lit("milanuncios.com")), ["<p>Pardon Our Interruption", "ok", None]) == [True, False, False]


def test_pages(spark):
    html = "<html><title> A  b </title><script>var x='</p>'</script><p>uno</p><p>dos</p></html>"
    assert values(spark, pages.html_title, [html, "<p>"]) == ["A b", None]
    assert values(spark, pages.html_to_text, [html])[0].split() == ["A", "b", "uno", "dos"]
    assert values(spark, pages.town, ["en BILBAO y Zamudio", "Bilbaotik", None]) == ["Bilbao", None, None]
    assert values(spark, lambda c: pages.operation(c, F.lit(""), F.lit("")), ["en venta", "venta o alquiler", "2 meses", "x"]) == ["venta", "alquiler", "alquiler", "N/D"]


def test_tree():
    root = dom.parse("<div class='a b'><ul><li id=x>uno<li>dos</ul><p>p<b>q<p>r<script>var a='<p>';</script></div>")
    assert [n.text() for n in root.select("li")] == ["uno", "dos"]
    assert root.first("div.a #x").text() == "uno"
    assert [n.text() for n in root.select("p")] == ["p q r", "r"] or [n.text() for n in root.select("p")][0].startswith("p q")
    assert root.first("[class*='b'] li, h1").get("id") == "x"
    assert root.first("[class$='zz']") is None
    assert dom.markdown("<h1>T</h1><p>a <a href='/b'>c</a></p><ul><li>x</li></ul>") == "# T\n\na [c](/b)\n\n* x"
