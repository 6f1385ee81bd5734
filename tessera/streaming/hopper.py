"""Folders as streams: every file once, keyed writes, windows over events."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tessera.sinks.tables import TableStore


def hopper(spark: SparkSession, path: str, archive: str | None = None, glob: str = "*") -> DataFrame:
    """A stream of path, content of whole files; done files move to `archive` when a later batch ends."""
    r = spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", glob)
    if archive:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return r.load(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))


def sweep(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """All that waits, then an end. A batch that is repeated after a failure has the same number."""
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upsert_into(store: TableStore, table: str, key: str, order: list[str] | None = None) -> Callable[[DataFrame, int], None]:
    """A batch writer that repeats harmlessly: rows go in by key, of equal keys the last by `order`; only the buckets of the batch's keys are rewritten."""

    def each(batch: DataFrame, number: int) -> None:
        store.write(batch, table, key=key, order=order)

    return each


def deduplicated(stream: DataFrame, id: str = "id", at: str | None = None, late: str = "1 hour") -> DataFrame:
    """First row of each id; with an event time, ids are forgotten after `late`."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark([id]) if at else stream.dropDuplicates([id])


def tumbling(events: DataFrame, size: str = "1 hour", late: str | None = None) -> DataFrame:
    return _windowed(events, F.window("ts", size), late)


def sliding(events: DataFrame, size: str = "1 hour", step: str = "15 minutes", late: str | None = None) -> DataFrame:
    return _windowed(events, F.window("ts", size, step), late)


def _windowed(events: DataFrame, window: Any, late: str | None) -> DataFrame:
    e = events.withWatermark("ts", late) if late else events
    g = e.groupBy(window.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return g.select(F.col("w.start").alias("window_start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str | None = None) -> DataFrame:
    e = events.withWatermark("ts", late) if late else events
    g = e.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return g.select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n", "total")


def enriched(events: DataFrame, table: DataFrame, on: str) -> DataFrame:
    """A stream joined to a table."""
    return events.join(table, on, "left")


def running_totals(events: DataFrame) -> DataFrame:
    """user_id, n, total after every batch, kept as state of each user."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, total = state.get if state.exists else (0, 0.0)
        for f in frames:
            n, total = n + len(f), total + float(f["value"].sum())
        state.update((n, total))
        yield pd.DataFrame({"user_id": [key[0]], "n": [n], "total": [total]})

    return events.select("user_id", "value").groupBy("user_id").applyInPandasWithState(step, "user_id long, n long, total double", "n long, total double", "update", GroupStateTimeout.NoTimeout)


#: Groups of users that share state, and rows that a group gathers before it joins them to its visits.
USER_GROUPS, GATHERED = 1024, 200_000
_HELD = ("known", "user", "first", "last", "n", "total")


def merged_visits(rows: pd.DataFrame, width: int) -> pd.DataFrame:
    """rows (known, user, first, last, n, total), those of a user less than `width` apart as one; by user and time."""
    by = np.lexsort((rows["total"], rows["n"], rows["last"], rows["first"], rows["user"], rows["known"]))
    known, user, first, last, n, total = (rows[c].to_numpy()[by] for c in _HELD)
    if not len(by):
        return rows
    new_user = np.append(True, (user[1:] != user[:-1]) | (known[1:] != known[:-1]))
    reached = pd.Series(last).groupby(np.cumsum(new_user)).cummax().to_numpy()
    at = np.flatnonzero(new_user | np.append(True, first[1:] >= reached[:-1] + width))
    ends = np.append(at[1:], len(by)) - 1
    return pd.DataFrame({"known": known[at], "user": user[at], "first": first[at], "last": reached[ends], "n": np.add.reduceat(n, at), "total": np.add.reduceat(total, at)})


def visits(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """user_id, session_start, last_event, n, total of each visit of a user, given out once event time has passed its end; events later than `late` don't count.

    Visits end when a user's events pause for `gap`. Users share state by the hash of their id,
    USER_GROUPS groups in all whatever the session, as a checkpoint keeps them: a call costs far
    more than a row. State is a group's open visits, each of which merges with another when an
    event closes the gap between them, so events within `late` may come in any order.
    """
    width = int(pd.Timedelta(gap).total_seconds() * 1_000_000)

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        kinds = dict(zip(_HELD, ("bool", "int64", "int64", "int64", "int64", "float64"), strict=True))
        visits = pd.DataFrame({c: np.array(x, kinds[c]) for c, x in zip(_HELD, state.get if state.exists else [[]] * 6, strict=True)})
        more, size = [], 0
        for f in frames:
            more.append(pd.DataFrame({"known": f["known"], "user": f["user"], "first": f["at"], "last": f["at"], "n": 1, "total": f["value"]}).astype(kinds))  # a call for time alone brings an empty frame of no kinds
            size += len(f)
            if size >= max(GATHERED, len(visits)):  # visits grow by half at least, or shrink
                visits, more, size = merged_visits(pd.concat([visits, *more]), width), [], 0
        visits = merged_visits(pd.concat([visits, *more]) if more else visits, width)
        past = state.getCurrentWatermarkMs() * 1000
        over = visits["last"] + width <= past
        ended, still = visits[over], visits[~over]
        if len(still):
            state.update(tuple(still[c].tolist() for c in _HELD))
            state.setTimeoutTimestamp(-(-(int(still["last"].min()) + width) // 1000))
        elif state.exists:
            state.remove()
        if len(ended):
            yield ended

    out = "known boolean, user long, first long, last long, n long, total double"
    held = "known array<boolean>, user array<long>, first array<long>, last array<long>, n array<long>, total array<double>"
    user = F.col("user_id").cast("long")
    rows = events.select(F.pmod(F.hash(user), F.lit(USER_GROUPS)).alias("users"), user.isNotNull().alias("known"), F.coalesce(user, F.lit(0)).alias("user"), "ts", F.unix_micros("ts").alias("at"), "value").withWatermark("ts", late)
    done = rows.groupBy("users").applyInPandasWithState(step, out, held, "append", GroupStateTimeout.EventTimeTimeout)
    return done.select(F.when(F.col("known"), F.col("user")).alias("user_id"), F.timestamp_micros("first").alias("session_start"), F.timestamp_micros("last").alias("last_event"), "n", "total")


def dropped_late(query: StreamingQuery) -> int:
    """Rows that a finished query left out because the watermark had passed them."""
    return sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)
