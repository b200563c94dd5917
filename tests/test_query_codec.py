"""Queries of URLs against the standard library's rules for forms."""

import random
from urllib.parse import parse_qsl, urlencode, urlparse, urlunparse

import duckdb
from pyspark.sql import functions as F

from lindero import queries
from lindero.functions import urls

ODD = ["a=%C3%A9&b=ñ", "a=1+2&a=%2b&x", "=v&k==&k=a=b", "q=*~._-(x)", "a=&b&c=0&", "k=%20%26%3d", "%zz=%4&%=%25&a=%", "a=%ff%fe", "a=%e2%82", "p%61ge=2&Page=3", "a=b;c=d", "a=%F0%9F%98%80", "", "&&", "=", "a=%0A", "+=+", "page=1&page=2&x=", "é=%E9x", "x+y=1&z=2"]


def randoms(n):
    rng = random.Random(9)
    alphabet = ["a", "Z", "5", "=", "&", "+", "%", "%41", "%c3%b1", "%2F", "%80", "ñ", "😀", "*", "~", "-", "_", ".", "/", " ", "(", "page", "%70age"]
    return ["".join(rng.choices(alphabet, k=rng.randint(0, 9))) for _ in range(n)]


def without(url, drop):
    parsed = urlparse(url)
    if not parsed.query:
        return url
    kept = [(k, v) for k, v in parse_qsl(parsed.query, keep_blank_values=False) if k.lower() not in drop]
    return urlunparse((parsed.scheme, parsed.netloc, parsed.path, parsed.params, urlencode(kept), ""))


def paged(url, name, number):
    parsed = urlparse(url)
    items = dict(parse_qsl(parsed.query, keep_blank_values=True))
    items[name] = str(number)
    return urlunparse((parsed.scheme, parsed.netloc, parsed.path, parsed.params, urlencode(items), parsed.fragment))


def test_queries_that_lose_keys(spark):
    each = [f"HTTPS://x.es/a;b?{q}#f" for q in ODD + randoms(600)]
    df = spark.createDataFrame([(u,) for u in each], "u string")
    got = [r[0] for r in df.select(urls.without_query_keys(F.col("u"), ("page",))).collect()]
    for u, g in zip(each, got, strict=True):
        want = without(u, {"page"})
        assert g == (want if urlparse(u).query else u), u


def test_candidates_keep_their_other_pairs_encoded_anew(spark):
    each = [f"/n?{q}" for q in ODD + randoms(100)]
    df = spark.createDataFrame([(u,) for u in each], "u string")
    got = [r[0] for r in df.select(urls.candidate(F.col("u"), F.lit("https://pisos.com/l"), ("page",), keep_query=True)).collect()]
    assert got == [without(f"https://pisos.com/n/?{u[3:]}", {"page"}).removesuffix("?") for u in each]


def test_pages_of_start_urls(spark):
    each = [f"https://x.es/l?{q}#f" for q in ODD + randoms(300)] + ["https://x.es/l", "https://x.es/l#f"]
    df = spark.createDataFrame([(u,) for u in each], "u string")
    none = F.lit(None).cast("string")
    got = [r[0] for r in df.select(urls.page_url(F.col("u"), F.lit(3), F.lit(1), F.lit("page"), none, F.lit(True))["url"]).collect()]
    for u, g in zip(each, got, strict=True):
        assert g == paged(u, "page", 3), u


def test_words_of_pages_that_have_signs_of_urls(spark, tmp_path):
    words = ["Heble###", "#", "#a=b", "a#b#c", "x&y=1#z", "%23", "%#", "%4#1", "a\n", "a\n#", "a?b", "a+b#", "ñ#é", "~*#", ""]
    rows = [(i * 8 + k, f"<html><h1>{w} more</h1></html>") for i, w in enumerate(words) for k in range(8)] + [(8 * len(words) + k, None) for k in range(8)]
    spark.createDataFrame(rows, "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    db = duckdb.connect()
    db.sql(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    want = dict(db.sql(queries.ORACLES["query_codec"]).fetchall())
    got = {r["page_id"]: r["url"] for r in queries.query_codec(spark, str(tmp_path)).collect()}
    assert got == want and want[0] == "https://x.es/a0?a=%C3%A9&b=Heble%23%23%23"


def test_line_feeds_at_a_querys_end_are_encoded(spark):
    got = spark.createDataFrame([("https://x.es/l?a=b\n",)], "u string").select(urls.without_query_keys(F.col("u"), ("page",))).first()[0]
    assert got == "https://x.es/l?a=b%0A"
