"""State per listing against the batch over all days."""

import random

import pytest
from pyspark.sql import functions as F

from lindero.operators import history as h
from lindero.sources import tables as t
from lindero.streaming import listings

RECORDS = "source_domain string, url_final string, title string, price_value string, day date, seq long"


@pytest.fixture
def states(spark):
    spark.conf.set(*listings.PROVIDER)
    yield spark
    spark.conf.unset(listings.PROVIDER[0])


def record(i, day, seq):
    return ("fotocasa.es", f"https://www.fotocasa.es/x/{100000 + i}/d", f"Nave {i} el {day}", f"{seq}.0", f"2026-03-{day:02d}", seq)


def test_days_in_any_order_and_more_than_once(states, tmp_path):
    rng = random.Random(4)
    rows = [record(rng.choice([0, 0, 0, *range(12)]), rng.randint(1, 20), s) for s in range(150)]
    batches = [rng.choices(rows, k=30) for _ in range(4)] + [rows]  # repeated rows within and across batches
    days, late = {}, {}
    for n, batch in enumerate(batches):
        df = states.createDataFrame([(*r[:4], None, r[5], r[4]) for r in batch], "source_domain string, url_final string, title string, price_value string, x string, seq long, d string")
        df.select("source_domain", "url_final", "title", "price_value", F.to_date("d").alias("day"), "seq").repartition(3).write.mode("append").parquet(f"{tmp_path}/in")
        source = states.readStream.schema(RECORDS).parquet(f"{tmp_path}/in")
        listings.keep_states(source, f"file://{tmp_path}/root", f"{tmp_path}/check").trigger(availableNow=True).start().awaitTermination(180)
        for i in sorted({(int(r[1].split("/")[4]), r[4]) for r in batch}):
            seen = days.setdefault(i[0], [])
            if i[1] not in seen:
                late[i[0]] = late.get(i[0], 0) + bool(seen and i[1] < max(seen))
                seen.append(i[1])
        got = {r["listing_key"].split(":")[-1]: r for r in t.read_versioned(states, f"file://{tmp_path}/root/states", h.MASTER_DDL).collect()}
        assert {int(k): (str(r["first_seen_date"]), str(r["last_seen_date"]), r["seen_count"]) for k, r in got.items()} == {k: (min(v), max(v), len(v)) for k, v in days.items()}
    every = states.read.schema(RECORDS).parquet(f"{tmp_path}/in")
    n = h.normalized(every, keep=("day",))
    want = {r["listing_key"]: (r["first_seen_date"], r["last_seen_date"], r["seen_count"]) for r in h.replayed(n, "day", "seq", ["listing_key"]).collect()}
    last = {r["listing_key"]: r["title"] for r in n.groupBy("listing_key").agg(F.max_by("title", F.struct("day", "seq")).alias("title")).collect()}
    master = t.read_versioned(states, f"file://{tmp_path}/root/states", h.MASTER_DDL).collect()
    assert {r["listing_key"]: (r["first_seen_date"], r["last_seen_date"], r["seen_count"]) for r in master} == want
    assert {r["listing_key"]: r["title"] for r in master} == last
    assert sum(late.values()) > 0


def test_late_days_are_counted_in_the_order_of_batches(states, tmp_path):
    for n, day in enumerate([5, 3, 5, 9, 4]):
        states.createDataFrame([(*record(1, day, n)[:4], n, f"2026-03-{day:02d}")], "source_domain string, url_final string, title string, price_value string, seq long, d string").select("source_domain", "url_final", "title", "price_value", F.to_date("d").alias("day"), "seq").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        out = listings.listing_states(states.readStream.schema(RECORDS).parquet(f"{tmp_path}/in"))
        seen = []
        out.writeStream.outputMode("update").foreachBatch(lambda df, _, seen=seen: seen.extend(df.collect())).option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start().awaitTermination(120)
        got = [(r["seen_count"], r["late_days"], r["days_of_batch"]) for r in seen]
        assert got == [[(1, 0, 1)], [(2, 1, 1)], [(2, 1, 0)], [(3, 1, 1)], [(4, 2, 1)]][n]
