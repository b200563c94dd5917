"""State per listing in a stream: first and last day, number of days, late days, and the newest record.

A micro-batch touches the listings that it holds, not the history. Days may come in any order and any number of times:
a listing's days are kept as a map, so that a day that was there before counts for nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle

from ..operators import history as h
from ..sources import store

#: What the state tells of a listing.
STATE_DDL = "listing_key string, first_seen_date date, last_seen_date date, seen_count int, late_days int, days_of_batch int, place long, record string"
#: The provider of states that the operator needs, by the name of its setting.
PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class SeenDays(StatefulProcessor):
    """The days of one listing. Rows: (listing_key, day, place, record), ``place`` telling which record of a day is last."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._days = handle.getMapState("days", "day int", "there boolean")
        self._sum = handle.getValueState("sum", "first int, last int, n int, late int, place long, record string")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        first, last, n, late, place, record = self._sum.get() if self._sum.exists() else (None, None, 0, 0, None, None)
        found: set[int] = set()
        newest = (last, place) if n else None
        for part in rows:
            days = (pd.to_datetime(part["day"]) - pd.Timestamp(0)).dt.days
            found.update(int(d) for d in days.unique())
            at = max(zip(days, part["place"], part["record"], strict=True), key=lambda x: x[:2])
            if newest is None or at[:2] >= newest:
                newest, place, record = (int(at[0]), int(at[1])), int(at[1]), at[2]
        fresh = 0
        for day in sorted(found):
            if self._days.containsKey((day,)):
                continue
            self._days.updateValue((day,), (True,))
            fresh += 1
            late += last is not None and day < last
            first, last, n = min(day, day if first is None else first), max(day, day if last is None else last), n + 1
        self._sum.update((first, last, n, late, place, record))
        dates = [pd.Timestamp(0) + pd.Timedelta(days=d) for d in (first, last)]
        yield pd.DataFrame({"listing_key": [key[0]], "first_seen_date": [dates[0].date()], "last_seen_date": [dates[1].date()], "seen_count": [n], "late_days": [late], "days_of_batch": [fresh], "place": [place], "record": [record]})

    def close(self) -> None:
        pass


def listing_states(records: DataFrame, day: str = "day", seq: str = "seq") -> DataFrame:
    """The state of every listing of a micro-batch after it, for a stream of ``records`` (business columns, ``seq`` as a long
    and a date): :data:`STATE_DDL`, ``record`` being the normalised listing as JSON, that of the last day and place. Rows
    without a day go. ``late_days`` counts the days that came after a later one, ``days_of_batch`` those that were new.

    Needs the state store of :data:`PROVIDER`. A key's rows pass through one task in pieces; only its days are held.
    """
    n = h.normalized(records.filter(F.col(day).isNotNull()).withColumn("seq", F.col(seq)), keep=(day,))
    text = F.to_json(F.struct(*[c for c in n.columns if c not in (day, "seq")]))
    each = n.select("listing_key", F.col(day).cast("date").alias("day"), F.coalesce(F.col("seq").cast("long"), F.lit(0)).alias("place"), text.alias("record"))
    return each.groupBy("listing_key").transformWithStateInPandas(SeenDays(), STATE_DDL, "Update", "None")


def as_master(states: DataFrame) -> DataFrame:
    """States as rows of history; their workflow is pending."""
    kind = {f.name: f.dataType.simpleString() for f in store._kind(h.MASTER_DDL).fields}
    own = ("first_seen_date", "last_seen_date", "seen_count")
    flow = {"workflow_status": F.lit("pending"), "workflow_updated_at": F.concat(F.col("last_seen_date").cast("string"), F.lit("T00:00:00Z")), "workflow_note": F.lit(None).cast("string")}
    read = F.from_json("record", ", ".join(f"{c} {t}" for c, t in kind.items() if c not in (*own, *flow)))
    rows = states.withColumn("_r", read)
    return rows.select(*[(F.col(c) if c in (*own, "listing_key") else flow[c] if c in flow else F.col(f"_r.{c}")).alias(c) for c in kind])


def keep_states(records: DataFrame, root: str, checkpoint: str, day: str = "day", seq: str = "seq") -> DataStreamWriter:
    """A writer that keeps the history of a stream's listings in the keyed table ``root/states``: each micro-batch writes the
    listings that it holds, and the table is not read. A batch that is delivered twice writes the same rows again; only the
    version's number of rows then counts its new listings twice."""

    def each(states: DataFrame, batch_id: int) -> None:
        states = states.persist()
        try:
            fresh = states.filter("seen_count = days_of_batch").count()  # all of their days are new: they are
            store.changed(states.sparkSession, f"{root}/states", "listing_key", h.MASTER_DDL, lambda v: (as_master(states), fresh))
        finally:
            states.unpersist()

    return listing_states(records, day, seq).writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", checkpoint)
