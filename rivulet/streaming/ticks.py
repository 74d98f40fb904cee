"""Ticks of keyed series with typed state, timers and TTL (LIVE13, UDF5).

A refresh cadence must go on while no data comes.  :func:`ticks` gives every
series one row a step of event time, also for the steps in which the series is
silent: its count so far and its newest value are carried on by a timer.  A
series that has been silent for ``quiet`` steps is forgotten (its state and
timer go), so state is one row for each series seen lately.

Records are reduced to one row a series and step by a watermarked window
aggregate first (partial aggregation: a hot series reaches the state as one
row a task), which also puts late records into their step.  The answer
depends on the records and the final watermark alone, not on how the stream
was cut into micro-batches.

:func:`counts_with_ttl` is the processing-time form: a count per key whose
state expires ``ttl_ms`` after its last change.

Named state and timers need a state store with column families, which Spark's
default provider does not have: start both with ``conf=STATE_CONF`` (see
:func:`rivulet.streaming.runner.start`), whatever the session's provider is.

Both keep named state, readable by Spark's ``statestore`` reader
(``stateVarName`` ``"series"`` or ``"count"``).  A null key is a key of its
own; records without an event time belong to no step and are left out; an
empty stream has no ticks.
"""

from __future__ import annotations

import sys
from typing import Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Settings of queries with named state.
STATE_CONF = {"spark.sql.streaming.stateStore.providerClass":
              "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}

_COLS = ["tick", "n", "total", "value", "silent"]


class _SeriesTicks(StatefulProcessor):
    """State of a series: ``(total, value, tick, silent)`` as of its last tick."""

    def __init__(self, keys: Sequence[str], step: int, quiet: int):
        self.keys, self.step, self.quiet = list(keys), step, quiet

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("series", "total bigint, value string, tick bigint, silent int")

    def _silent(self, cur: tuple, stop: int, out: list) -> tuple | None:
        """Ticks without data after ``cur`` up to and with ``stop``."""
        total, value, tick, silent = cur
        while tick + self.step <= stop and silent < self.quiet:
            tick, silent = tick + self.step, silent + 1
            out.append((tick, 0, total, value, True))
        return None if silent >= self.quiet else (total, value, tick, silent)

    def _keep(self, cur: tuple | None) -> None:
        if cur is None:
            self.state.clear()
        else:
            self.state.update(cur)
            self.handle.registerTimer(cur[2] + self.step)

    def _rows(self, key, out: list) -> pd.DataFrame:
        df = pd.DataFrame(out, columns=_COLS)
        for i, k in enumerate(self.keys):
            df.insert(i, k, pd.Series([key[i]] * len(df), dtype=object))
        return df

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        got = sorted(r for pdf in rows for r in pdf[["tick", "n", "value"]].itertuples(index=False, name=None))
        cur, out = None, []
        if self.state.exists():
            cur = tuple(self.state.get())
            self.handle.deleteTimer(cur[2] + self.step)
        for tick, n, value in got:
            if cur is not None:
                cur = self._silent(cur, tick - self.step, out)
            total = int(n) + (cur[0] if cur is not None else 0)
            cur = (total, value, int(tick), 0)
            out.append((int(tick), int(n), total, value, False))
        self._keep(cur)
        yield self._rows(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.state.exists():
            return
        out: list = []
        self._keep(self._silent(tuple(self.state.get()), timerValues.getCurrentWatermarkInMs(), out))
        if out:
            yield self._rows(key, out)

    def close(self) -> None:
        pass


def _as_instant(ts: Column, kind: T.DataType) -> Column:
    """The instant to keep time by: a wall clock is read as UTC, whatever the
    session's zone (event time must be an instant)."""
    if isinstance(kind, T.TimestampType):
        return ts
    minutes = F.unix_date(F.to_date(ts)).cast("bigint") * 1440 + F.hour(ts) * 60 + F.minute(ts)
    return F.timestamp_micros(minutes * 60_000_000 + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint"))


def _instant(ms: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampType):
        return F.timestamp_millis(ms)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=ms / 1000)


def ticks(stream: DataFrame, series: str | Sequence[str], time: str, value: str, order: Sequence[str],
          step_ms: int, delay_ms: int, quiet: int) -> DataFrame:
    """``(series..., tick, n, total, value, silent)`` of a stream.

    ``tick`` ends a step of ``step_ms`` of event time ``time``; ``n`` are the
    step's records, ``total`` those of the series since it was last forgotten,
    ``value`` its newest value by ``order`` (a tie goes to the greater value).
    Steps end once the watermark, ``delay_ms`` behind the newest record, has
    passed them; later records are dropped by the watermark, as in any window
    aggregate.
    """
    keys = [series] if isinstance(series, str) else list(series)
    time_kind, value_kind = stream.schema[time].dataType, stream.schema[value].dataType
    newest = F.max(F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], F.col(value).alias("v")))
    steps = (stream.withColumn("__at", _as_instant(F.col(time), time_kind))
             .withWatermark("__at", f"{delay_ms} milliseconds")
             .groupBy(F.window("__at", f"{step_ms} milliseconds").alias("__w"), *[F.col(k) for k in keys])
             .agg(F.count(F.lit(1)).alias("n"), newest.alias("__v")))
    steps = steps.select(*keys, F.unix_millis("__w.end").alias("tick"), "n",
                         F.col("__v.v").cast("string").alias("value"))
    out_schema = T.StructType([T.StructField(k, stream.schema[k].dataType) for k in keys] + [
        T.StructField("tick", T.LongType()), T.StructField("n", T.LongType()), T.StructField("total", T.LongType()),
        T.StructField("value", T.StringType()), T.StructField("silent", T.BooleanType())])
    out = steps.groupBy(*keys).transformWithStateInPandas(_SeriesTicks(keys, step_ms, quiet), out_schema, "append",
                                                          "EventTime")
    return out.select(*keys, _instant(F.col("tick"), time_kind).alias("tick"), "n", "total",
                      F.col("value").cast(value_kind).alias("value"), "silent")


class _TtlCount(StatefulProcessor):
    def __init__(self, keys: Sequence[str], ttl_ms: int):
        self.keys, self.ttl_ms = list(keys), ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("count", "n bigint", ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        n = sum(len(pdf) for pdf in rows) + (self.state.get()[0] if self.state.exists() else 0)
        self.state.update((n,))
        yield pd.DataFrame([(*key, n)], columns=[*self.keys, "n"])

    def close(self) -> None:
        pass


def counts_with_ttl(stream: DataFrame, series: str | Sequence[str], ttl_ms: int) -> DataFrame:
    """``(series..., n)`` after each micro-batch: records of the series since
    its state last expired, ``ttl_ms`` of processing time after a change.  Run it
    on a cadence or once: in processing time there is always a next batch, so
    an available-now trigger would not end."""
    keys = [series] if isinstance(series, str) else list(series)
    schema = T.StructType([T.StructField(k, stream.schema[k].dataType) for k in keys] + [T.StructField("n", T.LongType())])
    return stream.select(*keys).groupBy(*keys).transformWithStateInPandas(
        _TtlCount(keys, ttl_ms), schema, "update", "ProcessingTime")
