"""What came before a row of its key, over ranges of rows; and the merge of aliases that rests on it."""

import random

import pytest
from pyspark.sql import functions as F

from lindero.operators import aliases, ordered


@pytest.fixture
def many_parts(spark):
    """Small tables in as many parts as there are shuffle partitions, so that keys are cut."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    yield spark
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_running_against_a_model(many_parts):
    rng = random.Random(6)
    for hot in (0.0, 0.6, 1.0):
        rows = [("hot" if rng.random() < hot else rng.choice(["a", "b", None]), i, rng.choice([None, rng.randint(0, 99)]), rng.randint(1, 3)) for i in range(300)]
        df = many_parts.createDataFrame(rng.sample(rows, len(rows)), "k string, seq int, v int, n int")
        got = {r["seq"]: (r["last"], r["sum"]) for r in ordered.running(df, ["k"], "seq", last={"last": F.col("v")}, total=("sum", F.col("n"))).collect()}
        last, total = {}, {}
        for k, i, v, n in rows:
            assert got[i] == (last.get(k), total.get(k, 0))
            last[k] = v if v is not None else last.get(k)
            total[k] = total.get(k, 0) + n
    assert ordered.running(df.limit(0), ["k"], "seq", last={"last": F.col("v")}).count() == 0


def test_one_key_is_looked_at_in_many_parts(many_parts):
    df = many_parts.range(20_000).select(F.lit("u").alias("k"), F.col("id").alias("seq"), F.lit("same").alias("h"))
    out = ordered.latest_equal_before(df, ["k"], "seq", [("h", "content")])
    got = out.agg(F.sum("previous_count"), F.sum("matched_seq"), F.count(F.when(F.col("is_duplicate"), 1))).first()
    assert tuple(got) == (sum(range(20_000)), sum(range(19_999)), 19_999)
    each = ordered.running(df, ["k"], "seq", last={"before": F.col("seq")})
    parts = [r["n"] for r in each.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(parts) >= 3 and max(parts) < 10_000


def test_rows_with_equal_places_are_not_before_each_other(spark):
    df = spark.createDataFrame([("u", 1, "x"), ("u", 1, "x"), ("u", 2, "x"), (None, 1, "x"), (None, 2, None)], "u string, seq int, h string")
    got = sorted(((r["u"] or "", r["seq"], r["is_duplicate"], r["matched_seq"], r["previous_count"]) for r in ordered.latest_equal_before(df, ["u"], "seq", [("h", "c")]).collect()), key=str)
    assert got == sorted([("u", 1, False, None, 0), ("u", 1, False, None, 0), ("u", 2, True, 1, 2), ("", 1, False, None, 0), ("", 2, False, None, 1)], key=str)


def merged(rows):
    """The rule, row by row: all keys of a row lead to the group that it joined."""
    groups, leads = {}, {}
    for i, keys, filled in rows:
        keys = [k.strip() for k in keys if k and k.strip()]
        if not keys:
            continue
        group = next((leads[k] for k in keys if k in leads), keys[0])
        if group not in groups or filled > groups[group][0]:
            groups[group] = (filled, i)
        leads.update(dict.fromkeys(keys, group))
    return sorted(i for _, i in groups.values())


COLUMNS = "r string, seq int, external_id string, listing_key string, canonical_url string, url string, title_text string, price_text string, _salt int, up string"


def run(spark, runs):
    data = [(r, i, *keys, "t" if filled > 0 else "", "p" if filled > 1 else None, 1, "u") for r, rows in runs.items() for i, keys, filled in rows]
    out = {r: [] for r in runs}
    for x in aliases.merge_aliases(spark.createDataFrame(data, COLUMNS).repartition(3), "r", "seq", scored=("title_text", "price_text")).collect():
        out[x["r"]].append(x["seq"])
    return {r: sorted(v) for r, v in out.items()}


def test_groups_of_crossing_keys_against_the_rule(many_parts):
    rng = random.Random(7)
    runs = {}
    for k in range(12):
        keys = rng.choice([3, 8, 30])
        draw = lambda: rng.choice(["", None, " ", f" k{rng.randint(0, keys)}", f"k{rng.randint(0, keys)} "])  # noqa: E731,B023
        runs[f"r{k}"] = [(i, tuple(draw() for _ in range(4)), rng.randint(0, 2)) for i in range(rng.choice([1, 40, 120]))]
    runs["hot"] = [(i, (rng.choice(["", "", "", f"e{rng.randint(0, 5)}"]), "hot", f"c{i % 50}", f"u{i}"), rng.randint(0, 2)) for i in range(200)]
    runs["chain"] = [(i, ("", f"k{i}", f"k{i + 1}", ""), 0) for i in range(60)]
    runs["from behind"] = [(i, ("", f"k{60 - i}", f"k{59 - i}", ""), i % 3) for i in range(60)]
    assert run(many_parts, runs) == {r: merged(rows) for r, rows in runs.items()}


def test_a_run_of_a_million_rows_goes_through_many_tasks(many_parts):
    """A third of the rows hold one key; every row's url is its own."""
    i = F.col("id")
    df = many_parts.range(1_000_000).select(F.lit("r").alias("run"), i.alias("seq"), F.lit(None).cast("string").alias("external_id"), F.when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (i / 6).cast("long"))).alias("listing_key"), F.concat(F.lit("u"), i).alias("url"), F.when(i % 5 == 0, "t").alias("title_text"))
    keyed = df.select("run", F.struct("seq").alias("at"), F.array("listing_key", "url").alias("keys"))
    up = aliases.pointers(keyed, "run", "at", "keys")
    sizes = [r["n"] for r in up.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 7 and max(sizes) < 300_000
    out = aliases.merge_aliases(df, "run", "seq", scored=("title_text",)).agg(F.count("*"), F.sum(F.when(F.col("listing_key") == "hot", F.col("seq")))).first()
    assert tuple(out) == (166_668, 0)


def test_rows_without_keys_or_columns(spark):
    df = spark.createDataFrame([("r", 1, None), ("r", 2, " "), (None, 3, "u"), (None, 4, "u")], "run string, seq int, url string")
    assert [r["seq"] for r in aliases.merge_aliases(df, "run", "seq").collect()] == [3]
    assert aliases.merge_aliases(df.limit(0), "run", "seq").count() == 0
    assert aliases.merge_aliases(df.drop("url"), "run", "seq").count() == 0


def test_only_keys_at_the_borders_of_parts_are_summed_up(many_parts):
    """Rows are dealt out twice, by ranges and by parts; there is no third shuffle that grows with the number of keys."""
    sc = many_parts.sparkContext

    def dealt():
        stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
        return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))

    df = many_parts.range(20_000).select(F.concat(F.lit("key"), (F.col("id") / 2).cast("long")).alias("k"), F.col("id").alias("seq"))
    before = dealt()
    got = ordered.running(df, ["k"], "seq", last={"last": F.col("seq")}).select(F.count("last"), F.sum("last")).first()
    assert tuple(got) == (10_000, sum(range(0, 20_000, 2)))
    assert dealt() - before < 45_000
