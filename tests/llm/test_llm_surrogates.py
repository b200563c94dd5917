"""Surrogates: one number one replacement, numbers that are found again, blocks that are nearly full, callers' columns."""

import random
from ipaddress import ip_address, ip_network

import pytest
from pyspark.sql import functions as F

pytest.importorskip("lindero.llm")

from lindero.llm import surrogates  # noqa: E402


def test_a_phone_number_has_one_replacement_in_all_spellings(spark):
    same = ["+34 612 345 678", "+34612345678", "+34-612-345-678", "+34 612345678"]
    other = ["+1 212 555 0100", "+12125550100", "+351 21 123 4567", "+351211234567", "+34 612 345 679"]
    df = spark.createDataFrame([(i, f"llame al {p} ya") for i, p in enumerate(same + other)], "doc_id long, text string")
    got = [r["text"].removeprefix("llame al ").removesuffix(" ya") for r in surrogates.with_surrogates(df).orderBy("doc_id").collect()]
    plain = ["".join(c for c in g if c.isdigit() or c == "+") for g in got]
    assert len(set(plain[:4])) == 1 and plain[0] != "+34612345678" and plain[0].startswith("+34")
    assert plain[4] == plain[5] and plain[4].startswith("+1") and plain[6] == plain[7] and plain[6].startswith("+351")
    assert len(set(plain)) == 4
    assert [[c if not c.isdigit() else "0" for c in a] for a in got] == [[c if not c.isdigit() else "0" for c in b] for b in same + other]


def test_replacements_of_phones_are_phones():
    rng = random.Random(5)
    for _ in range(300):
        n = f"{rng.choice('6789')}{rng.randint(0, 99):02d} {rng.randint(0, 999):03d} {rng.randint(0, 999):03d}"
        new, done = surrogates.replace(f"tel {n}.")
        assert [e.kind for e, _ in done] == ["phone"] and [e.kind for e in surrogates.detect(new)] == ["phone"], (n, new)


def test_a_nearly_full_block_of_addresses_keeps_them_apart(spark):
    block = ip_network("192.168.0.0/16")
    chosen = random.Random(1).sample(range(1 << 16), 40_000)
    canon = [str(ip_address(int(block.network_address) + i)) for i in chosen] + ["8.8.8.8", "8.8.4.4"]
    rows = [("ip", c, surrogates.surrogate("ip", c)) for c in canon]
    moved = {r["canon"]: r["made"] for r in surrogates.collisions_resolved(spark.createDataFrame(rows, "kind string, canon string, made string"), attempts=2).collect()}
    final = {c: moved.get(c, m) for _, c, m in rows}
    assert len(set(final.values())) == len(canon)
    assert all(ip_address(m) in block for c, m in final.items() if c.startswith("192.168."))
    assert final["8.8.8.8"] not in canon


def test_callers_columns_keep_their_values(spark):
    names = {"text_key": "a", "_special": "b", "special": "c", "own": 1, "spread": 2, "_salt": 3, "_": 4, "__": 5, "made": "d", "a b": 6, "kinds": "gone"}
    df = spark.createDataFrame([(1, "Mr John Smith, 192.168.0.1, a@b.org"), (2, None), (3, "Mrs John Doe")], "doc_id int, text string").select(*[F.lit(v).alias(k) for k, v in names.items()], "doc_id", "text")
    rows = surrogates.with_surrogates(df).orderBy("doc_id").collect()
    assert [r[k] for r in rows for k in names if k != "kinds"] == [v for k, v in names.items() if k != "kinds"] * 3
    assert rows[0]["text"].count(",") == 2 and "Smith" not in rows[0]["text"] and rows[1]["text"] is None and rows[0]["n_entities"] == 4
    assert surrogates.with_surrogates(df).columns == [*[c for c in df.columns if c != "kinds"], "n_entities", "kinds"]


def shuffled(spark):
    sc = spark.sparkContext
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def test_texts_move_only_if_a_replacement_in_them_is_not_the_first(spark, tmp_path):
    """Two texts hold one's replacement as the other's original; 2 MB of other texts stay where they are."""
    first = "mail@example.org"
    rng = random.Random(4)
    texts = [f"an {first}", f"an {surrogates.surrogate('email', first)}", *["".join(rng.choices("abcdefgh ", k=10_000)) for _ in range(200)], "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "docs"))
    before = shuffled(spark)
    got = [r["text"] for r in sorted(surrogates.with_surrogates(spark.read.parquet(str(tmp_path / "docs"))).collect())]
    assert shuffled(spark) - before < 100_000
    assert got[2:] == texts[2:] and len({*got[:2], *texts[:2]}) == 4


def test_texts_that_ask_for_replacements(spark):
    rows = spark.range(5000).selectExpr("xxhash64(id) AS text_key", "id").unionByName(spark.sql("SELECT explode(array(0L, -1L, 32767L, 32768L, 33554431L, 33554432L, -9223372036854775808L)) AS text_key, -1L AS id"))
    per_text = rows.filter("id % 10 = 0 OR id = -1").select("text_key")
    got = surrogates._asking(rows, per_text)
    assert got.columns == ["text_key", "id", "asks"] and got.count() == 5007
    assert got.filter("(id % 10 = 0 OR id = -1) AND NOT asks").count() == 0 and got.filter("id % 10 <> 0 AND id <> -1 AND asks").count() < 50
    assert surrogates._asking(rows, per_text.limit(0)).filter("asks").count() == 0
