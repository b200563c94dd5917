"""Keyed tables: what a change writes, what two writers see, what is left of older versions."""

import os
import random

import pytest
from pyspark.sql import functions as F

from lindero.operators import history
from lindero.plans import publish
from lindero.sources import store
from lindero.sources import tables as t

DDL = "k string, v int"


def bytes_of(path):
    return sum(os.path.getsize(f"{d}/{f}") for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def put(spark, root, rows, buckets=4):
    known = {r["k"] for r in t.read_versioned(spark, root, DDL).collect()}
    return store.changed(spark, root, "k", DDL, lambda v: (spark.createDataFrame(rows, DDL), sum(k not in known for k, _ in rows)), buckets)


def test_changes_against_a_dict(spark, tmp_path):
    root, rng, want = f"file://{tmp_path}/t", random.Random(2), {}
    for n in range(14):
        rows = list({f"k{rng.randint(0, 30)}": n for _ in range(rng.choice([1, 1, 1, 12]))}.items())
        v = put(spark, root, rows)
        want.update(rows)
        assert v.number == n + 1 and v.rows == len(want) and len(v.logs) < 2 * store.MERGED
    assert {r["k"]: r["v"] for r in t.read_versioned(spark, root, DDL).collect()} == want
    one = next(iter(want))
    assert [tuple(r) for r in store.rows_of(spark, root, v, DDL, only=one).collect()] == [(one, want[one])]
    assert store.rows_of(spark, root, v, DDL, only="none").count() == 0
    assert "_bucket" in store.rows_of(spark, root, v, DDL, only=one)._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:60]


def test_old_versions_go_and_the_last_ones_stay(spark, tmp_path):
    root = f"file://{tmp_path}/t"
    for n in range(6):
        put(spark, root, [(f"k{i}", n) for i in range(20)])
    numbers = store._numbers(spark, root)
    assert numbers == [4, 5, 6]
    for n in numbers:  # each of them can be read
        assert {r["v"] for r in store.rows_of(spark, root, store._read(spark, root, n), DDL).collect()} == {n - 1}
    named = store._all_named(spark, root, numbers)
    assert {d for d in os.listdir(tmp_path / "t") if d.startswith("v-")} == named
    (tmp_path / "t" / "v-dead").mkdir()
    assert store.unnamed(spark, root, 0) == [] and store.unnamed(spark, root, 1 << 50) == ["v-dead"]
    assert t.read_versioned(spark, root, DDL).count() == 20


def test_of_two_writers_one_tries_again(spark, tmp_path):
    root = f"file://{tmp_path}/t"
    put(spark, root, [("a", 1), ("b", 1)])
    old = store.version(spark, root)
    mine, theirs = (store.write_segment(spark.createDataFrame([(k, 2)], DDL), root, "k", 4) for k in "ab")
    store.put(spark, root, old, mine, 0, "k", t.schema_of(DDL))
    with pytest.raises(store.Conflict):
        store.put(spark, root, old, theirs, 0, "k", t.schema_of(DDL))
    tried = []

    def change(v):
        tried.append(v.number)
        if len(tried) == 1:
            put(spark, root, [("c", 3)])  # another writer, between look and commit
        return store.rows_of(spark, root, v, DDL, only="b").select("k", (F.col("v") + 10).alias("v")), 0

    store.changed(spark, root, "k", DDL, change)
    assert tried == [2, 3]
    assert sorted(tuple(r) for r in t.read_versioned(spark, root, DDL).collect()) == [("a", 2), ("b", 11), ("c", 3)]


def test_writers_at_once_lose_nothing(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    root = f"file://{tmp_path}/t"
    put(spark, root, [("n", 0)])

    def add(_):
        store.changed(spark, root, "k", DDL, lambda v: (store.rows_of(spark, root, v, DDL, only="n").select("k", (F.col("v") + 1).alias("v")), 0), attempts=50)

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(add, range(8)))
    assert [tuple(r) for r in t.read_versioned(spark, root, DDL).collect()] == [("n", 8)]


def test_a_status_edit_writes_one_row_whatever_the_history(spark, tmp_path):
    sizes = {}
    for n in (200, 20_000):
        root = f"file://{tmp_path}/{n}"
        kind = {f.name: f.dataType for f in t.schema_of(publish.MASTER)}
        rows = spark.range(n).select(*[(F.concat(F.lit("k"), "id") if c == "listing_key" else F.concat(F.lit("text "), F.sha2(F.col("id").cast("string"), 256)) if c == "title" else F.lit(None)).cast(k).alias(c) for c, k in kind.items()])
        store.changed(spark, f"{root}/master", "listing_key", publish.MASTER, lambda v, rows=rows, n=n: (rows, n))
        before = bytes_of(f"{tmp_path}/{n}")
        publish.set_status(spark, root, "k7", "processed", "now", "visto")
        sizes[n] = bytes_of(f"{tmp_path}/{n}") - before
        v = store.version(spark, f"{root}/master")
        got = store.rows_of(spark, f"{root}/master", v, publish.MASTER, only="k7").collect()
        assert [(r["workflow_status"], r["workflow_note"]) for r in got] == [("processed", "visto")] and v.rows == n
        assert t.read_versioned(spark, f"{root}/master", history.MASTER_DDL).count() == n
    assert sizes[200] == sizes[20_000] < 20_000


def test_edits_of_many_listings(spark, tmp_path):
    root = f"file://{tmp_path}"
    store.changed(spark, f"{root}/status", "listing_key", publish.STATUS, lambda v: (spark.createDataFrame([("a", "pending", "t", "nota"), ("b", "pending", "t", None)], publish.STATUS), 2))
    before = t.read_versioned(spark, f"{root}/status", history.STATUS_DDL)
    after = before.withColumn("workflow_status", F.when(F.col("listing_key") == "a", "discarded").otherwise(F.col("workflow_status")))
    told = history.edits(before, after)
    assert publish.set_statuses(spark, root, told.select("listing_key", "workflow_status", F.lit(None).cast("string").alias("workflow_note")), "now") == 1
    got = {r["listing_key"]: tuple(r)[1:] for r in t.read_versioned(spark, f"{root}/status", history.STATUS_DDL).collect()}
    assert got == {"a": ("discarded", "now", "nota"), "b": ("pending", "t", None)}
    with pytest.raises(ValueError):
        publish.set_statuses(spark, root, told.withColumn("workflow_status", F.lit("open")), "now")


def test_lines_of_later_files_and_parts_win(spark, tmp_path):
    """Large files are read before small ones, and a file's parts by several tasks."""
    (tmp_path / "part-0").write_text('{"k": "a", "v": 1}\n' + '{"k": "x", "v": 1}\n' * 5)
    (tmp_path / "part-1").write_text('{"k": "a", "v": 2}\n' + "".join(f'{{"k": "b", "v": {i}}}\n' for i in range(3000)) + '{"k": "c", "v": 1}\n' * 3000)
    (tmp_path / "part-2").write_text('{"k": "c", "v": 9}\n{"k": " ", "v": 9}\n{"v": 9}\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = t.read_keyed_lines(spark, f"file://{tmp_path}", DDL, "k")
        assert got.rdd.getNumPartitions() > 0 and sorted(tuple(r) for r in got.collect()) == [("a", 2), ("b", 2999), ("c", 9), ("x", 1)]
        placed = t.read_json_lines(spark, f"file://{tmp_path}/part-1", DDL, place=True)
        assert placed.rdd.getNumPartitions() > 10
        assert [r["v"] for r in placed.filter("k = 'b'").orderBy("place").collect()] == list(range(3000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
