"""Merging discovered rows that share any identity key, in order.

The rule is told row by row: a row joins the group of its first key that is known, else opens one; all of its keys then
lead to its group. But a key always leads to the group of the last row that held it. So a row's group is that of one
earlier row, the last one that holds the row's first known key, and the groups are the trees of these pointers. Pointers
come from what ran before under each key (:func:`ordered.running`), roots from doubling them: nothing goes through a
run's rows one after another, and a key may hold any share of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import filled_count
from ..sources.shared import settled
from .ordered import running

ALIASES = ("external_id", "listing_key", "canonical_url", "url")
SCORED = ("title_text", "price_text", "location_text", "surface_text", "rooms_text")
#: Tasks that meet rows of one key in a round of doubling.
SALTS = 8


def _stripped(c: Column) -> Column:
    text = c.cast("string")
    bare = F.left(text, F.lit(1)).between("!", "~") & F.right(text, F.lit(1)).between("!", "~")
    return F.when(bare, text).otherwise(F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", ""))


def pointers(rows: DataFrame, run: str, at: str, keys: str) -> DataFrame:
    """(at, up) of the rows with any of ``keys`` (an array of distinct strings, the first ones count first): the earlier
    row of their run whose group they join, null for one that opens a group. ``at`` is their place, different in each.

    Rows that pass a key on from one to the next all point to the row that brought the group to that key, so that trees
    are as deep as groups were led over from key to key, not as rows follow each other.
    """
    short = settled(rows.filter(F.size(keys) > 0).select(F.col(run).alias("run"), F.col(at).alias("at"), F.col(keys).alias("keys")), "keys")
    seen = running(short.select("run", "at", F.posexplode("keys").alias("pos", "key")), ["run", "key"], "at", last={"before": F.col("at")})
    told = seen.groupBy("at").agg(F.first("run").alias("run"), F.min_by("key", F.when(F.col("before").isNotNull(), F.col("pos"))).alias("via"), F.collect_list("key").alias("keys"))
    # A row brings its group to a key unless it got its group from there.
    held = told.select("run", "at", "via", F.explode("keys").alias("key")).withColumn("comes", F.when(~F.col("key").eqNullSafe(F.col("via")), F.col("at")))
    led = running(held, ["run", "key"], "at", last={"from": F.col("comes")})
    return led.groupBy("at").agg(F.max(F.when(F.col("key") == F.col("via"), F.col("from"))).alias("up"))


def roots(tree: DataFrame) -> DataFrame:
    """(at, root) from (at, up): where the pointers end. A round doubles their length, over the rows that are not there
    yet."""
    tree = settled(tree, "pointers")
    linked = tree.filter("up is not null").select("at", "up", F.lit(False).alias("there"))
    while True:
        going = linked.filter("not there")
        ends = going.select(F.col("up").alias("to")).distinct()
        hops = ends.join(linked.select(F.col("at").alias("to"), F.col("up").alias("further"), F.col("there").alias("done")).hint("merge"), "to", "left")
        hops = hops.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        dealt = going.withColumn("salt", F.pmod(F.xxhash64("at"), F.lit(SALTS)).cast("int"))
        gone = dealt.join(hops.hint("merge"), (F.col("up") == F.col("to")) & (dealt["salt"] == hops["salt"])).select("at", F.coalesce("further", "up").alias("up"), F.coalesce("done", F.lit(True)).alias("there"))
        linked = settled(linked.filter("there").unionByName(gone), "pointers")
        if linked.filter("not there").isEmpty():
            return tree.filter("up is null").select("at", F.col("at").alias("root")).unionByName(linked.select("at", F.col("up").alias("root")))


def merge_aliases(rows: DataFrame, run: str, seq: str, aliases: Sequence[str] = ALIASES, scored: Sequence[str] = SCORED) -> DataFrame:
    """The richest row of each group, the first of equals, for each ``run``.

    Rows go by ``seq``, those with an equal one as they were read. Keys are stripped; an empty or missing one is none; a row
    without any goes. A column of ``scored`` counts if it is neither null nor empty. Groups that are apart stay apart,
    though later rows may hold keys of both. An empty table gives no rows.
    """
    known = [c for c in aliases if c in rows.columns]
    counted = [c for c in scored if c in rows.columns]
    base = settled(rows, "merged", number="_row")
    text = [F.nullif(_stripped(F.col(c)), F.lit("")) for c in known] or [F.lit(None).cast("string")]
    keyed = base.select(F.col(run).alias("run"), F.struct(F.col(seq).alias("seq"), F.col("_row").alias("row")).alias("at"), F.array_distinct(F.array_compact(F.array(*text))).alias("keys"), (filled_count(*[F.col(c) for c in counted]) if counted else F.lit(0)).alias("score"))
    groups = roots(pointers(keyed, "run", "at", "keys"))
    scores = keyed.select("at", "score").join(groups.hint("merge"), "at")
    best = scores.groupBy("root").agg(F.min_by("at", F.struct((-F.col("score")).alias("s"), "at")).alias("at")).select(F.col("at.row").alias("_row"))
    return base.join(best.hint("merge"), "_row", "left_semi").select(rows.columns)
