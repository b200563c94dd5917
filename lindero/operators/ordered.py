"""Operators whose result depends on the order of rows. The order is a column, never the order of arrival.

A window over a key would bring all rows of a hot key to one task; ``first``/``last``/``best`` aggregate instead, so
that partial results are combined before the shuffle, and ``running`` goes over ranges of rows with a carry.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import settled


def _row(df: DataFrame) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def last_by_key(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """The last row of each key, with ``first_seq``, where the key came first (its place among the others)."""
    out = df.groupBy(*keys).agg(F.max_by(_row(df), F.col(seq)).alias("_row"), F.min(seq).alias("first_seq"))
    return out.select("_row.*", "first_seq")


def first_by_key(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """The first row of each key."""
    return df.groupBy(*keys).agg(F.min_by(_row(df), F.col(seq)).alias("_row")).select("_row.*")


def best_by_key(df: DataFrame, keys: Sequence[str], score: Column, seq: str) -> DataFrame:
    """The row with the highest score of each key, the first of equals."""
    return df.groupBy(*keys).agg(F.min_by(_row(df), F.struct((-score).alias("s"), F.col(seq).alias("o"))).alias("_row")).select("_row.*")


def distinct_in_order(df: DataFrame, key: str, seq: str) -> DataFrame:
    """(key, first_seq, times): each value once, where it came first and how often it came."""
    return df.groupBy(key).agg(F.min(seq).alias("first_seq"), F.count("*").alias("times"))


def keep_last_but_null(df: DataFrame, key: str, seq: str) -> DataFrame:
    """Rows without a key as they are; of the others the last of each key."""
    nulls = df.filter(F.col(key).isNull())
    return nulls.unionByName(last_by_key(df.filter(F.col(key).isNotNull()), [key], seq).drop("first_seq"))


def first_n(df: DataFrame, order: Sequence[Column], n: int | None) -> DataFrame:
    """The first ``n`` rows in order; none or zero is no limit."""
    return df.orderBy(*order).limit(n) if n else df


def upsert(index: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``index`` with all rows of the keys in ``new`` replaced by those of ``new``; rows without a key stay."""
    old = index.join(new.select(key).distinct(), key, "left_anti").select(index.columns)
    return old.unionByName(new, allowMissingColumns=True)


def running(df: DataFrame, keys: Sequence[str], seq: str, last: Mapping[str, Column] | None = None, total: tuple[str, Column] | None = None) -> DataFrame:
    """``df`` with what came before each row among the rows of its key, strictly by ``seq``: for each of ``last`` (name,
    value) the last value that was not null, for ``total`` (name, value) the sum, 0 for the first row.

    ``keys`` and ``seq`` tell rows apart; null keys are a key. Two passes, so that one key may hold any share of the rows:
    rows are dealt by ranges of (keys, seq), each part is looked at for itself, and what a key brings along from the
    parts before is added. A part's border cuts one key at most, so there are fewer such carries than parts, and they
    are broadcast; nothing else is summed up by key.
    """
    values = {f"_run_v{i}": v for i, v in enumerate((last or {}).values())}
    names = dict(zip(values, last or {}, strict=True))
    added = [v.alias(k) for k, v in values.items()] + ([total[1].alias("_run_n")] if total else [])
    rows = settled(df.select("*", *added).repartitionByRange(*keys, seq).withColumn("_run_part", F.spark_partition_id()), "running")
    inside = Window.partitionBy("_run_part", *keys).orderBy(seq).rowsBetween(Window.unboundedPreceding, -1)
    here = rows.select("*", *[F.last(k, ignorenulls=True).over(inside).alias(f"{k}h") for k in values], *([F.sum("_run_n").over(inside).alias("_run_nh")] if total else []))
    ends = [F.max_by(k, F.when(F.col(k).isNotNull(), F.col(seq))).alias(k) for k in values] + ([F.sum("_run_n").alias("_run_n")] if total else [])
    # Only the first and the last key of a part can go on in another one.
    whole = F.struct(F.lit(0).alias("_run_none"), *[F.col(k) for k in keys])
    borders = rows.groupBy(F.col("_run_part").alias("_run_of")).agg(F.min(whole).alias("_run_low"), F.max(whole).alias("_run_high"))
    cut = (F.col("_run_part") == F.col("_run_of")) & (whole.eqNullSafe(F.col("_run_low")) | whole.eqNullSafe(F.col("_run_high")))
    parts = rows.join(F.broadcast(borders), cut, "left_semi").groupBy("_run_part", *keys).agg(F.count("*").alias("_run_rows"), *ends)
    earlier = Window.partitionBy(*keys).orderBy("_run_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.last(k, ignorenulls=True).over(earlier).alias(f"{k}c") for k in values] + ([F.sum("_run_n").over(earlier).alias("_run_nc")] if total else [])
    carry = parts.select(F.col("_run_part").alias("_run_at"), *[F.col(k).alias(f"_run_k{i}") for i, k in enumerate(keys)], F.sum("_run_rows").over(earlier).alias("_run_before"), *carried).filter("_run_before is not null")
    same = F.col("_run_part") == F.col("_run_at")
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"_run_k{i}"))
    out = [F.coalesce(f"{k}h", f"{k}c").alias(name) for k, name in names.items()]
    if total:
        out.append((F.coalesce("_run_nh", F.lit(0)) + F.coalesce("_run_nc", F.lit(0))).alias(total[0]))
    return here.join(F.broadcast(carry), same, "left").select(*df.columns, *out)


def latest_equal_before(df: DataFrame, keys: Sequence[str], seq: str, hashes: Sequence[tuple[str, str]]) -> DataFrame:
    """For each row the latest earlier row of its key that has any hash in common with it: ``is_duplicate``,
    ``match_reason`` (that of the first of ``hashes``, (column, reason), that the two have in common), ``matched_seq``, and
    how many rows of the key came before. A null hash equals nothing; rows with equal ``seq`` are not before each other.

    Only keys and hashes are looked at: each row is a point under its key and one under each (key, hash), and the points
    before it are found by :func:`running`. So a key, or a content, may hold any share of the rows.
    """
    by = [f"_k{i}" for i in range(len(keys))]
    own = [F.col(k).alias(b) for k, b in zip(keys, by, strict=True)]
    points = F.array(F.struct(F.lit(0).alias("which"), F.lit("").alias("hash")), *[F.struct(F.lit(i).alias("which"), F.col(c).cast("string").alias("hash")) for i, (c, _) in enumerate(hashes, 1)])
    each = df.select(*own, F.col(seq).alias("_seq"), F.explode(points).alias("_p")).select(*by, "_seq", "_p.*").filter("hash is not null")
    each = each.groupBy(*by, "_seq", "which", "hash").agg(F.count("*").alias("n"))
    found = running(each, [*by, "which", "hash"], "_seq", last={"at": F.col("_seq")}, total=("before", F.col("n")))
    at = [F.max(F.when(F.col("which") == i, F.col("at"))).alias(f"_at{i}") for i in range(1, len(hashes) + 1)]
    told = found.groupBy(*by, "_seq").agg(F.max(F.when(F.col("which") == 0, F.col("before"))).cast("long").alias("previous_count"), *at)
    told = told.withColumn("_at", F.greatest(*[f"_at{i}" for i in range(1, len(hashes) + 1)]) if len(hashes) > 1 else F.col("_at1"))
    same = F.col(f"d.`{seq}`").eqNullSafe(F.col("_seq"))
    for k, b in zip(keys, by, strict=True):
        same &= F.col(f"d.`{k}`").eqNullSafe(F.col(b))
    reason = F.lit("none")
    for i, (_, label) in reversed(list(enumerate(hashes, 1))):
        reason = F.when(F.col(f"_at{i}") == F.col("_at"), F.lit(label)).otherwise(reason)
    out = df.alias("d").join(told.hint("merge"), same)
    return out.select(*[F.col(f"d.`{c}`") for c in df.columns], F.col("_at").isNotNull().alias("is_duplicate"), reason.alias("match_reason"), F.col("_at").alias("matched_seq"), "previous_count")
