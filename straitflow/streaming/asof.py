"""As-of join of two streams in event time."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Reports known, and rows that wait: times in microseconds, values, rows as JSON.
STATE = "known_at array<long>, known array<double>, waiting_at array<long>, waiting array<string>"
OUTPUT = "row string, value double, reported_at long"


def asof_stream(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    on: str,
    value: str,
    delay: str = "1 day",
    salts: int = 8,
) -> DataFrame:
    """Adds to each left row the last `value` of the same `by` at or before `on`, and `reported_at`, the time of that.

    Both streams have the timestamp `on`; rows without one are left out, and so are reports without a value. A row
    waits until the watermark has passed it, so reports that come at most `delay` behind the newest row seen count in
    whatever order they come. Then it comes out once, with nulls if nothing was reported by then; rows still
    ahead of the watermark wait for the next run. Of reports of the same time, the largest counts. A report is kept until a
    later one is behind the watermark too. Rows and reports later than the delay are dropped.

    Rows of a key are spread over `salts` groups by their content, and its reports, which are few, are sent to each: a
    key with a third of all rows is not one group. State is one row per group.
    """
    row = F.to_json(F.struct(*left.columns), {"ignoreNullFields": "false"})
    rows = left.where(F.col(on).isNotNull()).select(
        *by,
        F.pmod(F.xxhash64(row), F.lit(salts)).cast("int").alias("_salt"),
        F.col(on).alias("_at"),
        row.alias("_row"),
        F.lit(None).cast("double").alias("_value"),
    )
    reports = right.where(F.col(value).isNotNull() & F.col(on).isNotNull()).select(
        *by,
        F.explode(F.array(*[F.lit(i) for i in range(salts)])).alias("_salt"),
        F.col(on).alias("_at"),
        F.lit(None).cast("string").alias("_row"),
        F.col(value).cast("double").alias("_value"),
    )
    # Times travel as numbers, so that no time zone of a worker can shift them.
    both = rows.unionByName(reports).withWatermark("_at", delay).withColumn("_us", F.unix_micros("_at"))
    joined = both.groupBy(*by, "_salt").applyInPandasWithState(
        _advance, OUTPUT, STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
    # The row comes back in the types that it had.
    told = joined.select(F.from_json("row", left.schema).alias("r"), "value", "reported_at")
    return told.select("r.*", F.col("value").alias(value), F.timestamp_micros("reported_at").alias("reported_at"))


def _advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    known_at, known, waiting_at, waiting = map(list, state.get) if state.exists else ([], [], [], [])
    for batch in batches:
        is_row = batch["_row"].notna()
        waiting_at += batch.loc[is_row, "_us"].astype("int64").tolist()
        waiting += batch.loc[is_row, "_row"].tolist()
        known_at += batch.loc[~is_row, "_us"].astype("int64").tolist()
        known += batch.loc[~is_row, "_value"].tolist()
    closed = state.getCurrentWatermarkMs() * 1000
    order = np.lexsort((np.array(known, float), np.array(known_at, np.int64)))
    times, values = np.array(known_at, np.int64)[order], np.array(known, float)[order]
    at = np.array(waiting_at, np.int64)
    out = np.flatnonzero(at < closed)
    if len(out):
        place = np.searchsorted(times, at[out], side="right") - 1
        found = place >= 0
        last = np.maximum(place, 0)
        told, when = (values[last], times[last]) if len(times) else (np.zeros(len(out)), np.zeros(len(out), np.int64))
        yield pd.DataFrame(
            {
                "row": [waiting[i] for i in out],
                "value": pd.Series(np.where(found, told, np.nan)).astype("Float64").mask(~found),
                "reported_at": pd.Series(when).astype("Int64").mask(~found),
            }
        )
    # A report is done with once a later one has been passed as well.
    first = max(0, int(np.searchsorted(times, closed, side="left")) - 1)
    keep = np.flatnonzero(at >= closed)
    left = [int(at[i]) for i in keep]
    state.update((times[first:].tolist(), values[first:].tolist(), left, [waiting[i] for i in keep]))
    if left:
        state.setTimeoutTimestamp(max(min(left) // 1000 + 1, state.getCurrentWatermarkMs() + 1))
