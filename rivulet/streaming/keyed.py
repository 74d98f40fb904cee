"""Keyed arrival-order state for streams (LIVE1, LIVE6, AGG4, SRC7, OPS9).

Spark rejects ``row_number`` and other non-time windows on streaming
DataFrames, so the per-record forms keep a small state per key with
``applyInPandasWithState``: a counter and a running total, a "sentinel
seen" flag, or the last offset.  Within one micro-batch a key's rows are
sorted by the order columns; across batches the state carries on, so the
answer equals the batch operator's when data arrives in order.  A key's
rows of one micro-batch are held together, which the trigger size bounds
(``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger``).
"""

from __future__ import annotations

from typing import Sequence

import sys
import warnings

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

# The per-key step functions below run in Python workers; ship them (and
# this module's helpers) by value, so executors need only pyspark, pandas
# and numpy - not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _concat(pdfs) -> pd.DataFrame:
    # pyspark's Arrow serializer concatenates our outputs and pandas warns
    # about all-NA columns (e.g. sliding stats of rejected rows); harmless.
    warnings.filterwarnings("ignore", category=FutureWarning, message=".*concatenation with empty or all-NA.*")
    frames = [p for p in pdfs if len(p)]
    return pd.concat(frames, ignore_index=True) if frames else pd.DataFrame()


def running_count_and_total(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
                            inc: str | None = None, seed=0, seq: str = "seq",
                            total: str = "total") -> DataFrame:
    """Per key: ``seq`` = 1, 2, ... in arrival order and, if ``inc`` is given,
    ``total`` = seed + running sum of ``inc`` (nulls count as 0)."""
    keys, order_cols = list(keys), list(order_cols)
    in_schema = df.schema
    fields = list(in_schema.fields) + [T.StructField(seq, T.LongType())]
    total_type = None
    if inc:
        total_type = in_schema[inc].dataType
        if isinstance(total_type, T.DecimalType):
            total_type = T.DecimalType(38, total_type.scale)
        elif isinstance(total_type, T.IntegralType):
            total_type = T.LongType()
        fields.append(T.StructField(total, total_type))
    out_schema = T.StructType(fields)
    state_schema = T.StructType([T.StructField("n", T.LongType()),
                                 T.StructField("t", total_type or T.LongType())])
    names = [f.name for f in fields]

    def step(key, pdfs, state):
        pdf = _concat(pdfs)
        if pdf.empty:
            return
        pdf = pdf.sort_values(order_cols, kind="mergesort").reset_index(drop=True)
        n0, t0 = state.get if state.exists else (0, seed)
        pdf[seq] = range(n0 + 1, n0 + 1 + len(pdf))
        t_last = t0
        if inc:
            vals = pdf[inc].where(pdf[inc].notna(), 0)
            run = vals.astype(object).cumsum() if isinstance(total_type, T.DecimalType) else vals.cumsum()
            pdf[total] = run + t0
            t_last = pdf[total].iloc[-1]
        state.update((int(pdf[seq].iloc[-1]), t_last))
        yield pdf[names]

    return df.groupBy(*keys).applyInPandasWithState(
        step, out_schema, state_schema, "append", GroupStateTimeout.NoTimeout)


def take_until(df: DataFrame, is_sentinel: str, order_col: str = "offset",
               key: str = "partition") -> DataFrame:
    """SRC7 streaming: per partition, records before the first sentinel; the
    state is the flag "sentinel seen" (then the partition emits nothing)."""
    schema = df.drop(is_sentinel).schema
    names = schema.fieldNames()

    def step(k, pdfs, state):
        if state.exists and state.get[0]:
            for _ in pdfs:
                pass
            return
        pdf = _concat(pdfs)
        if pdf.empty:
            return
        pdf = pdf.sort_values(order_col, kind="mergesort").reset_index(drop=True)
        hits = pdf.index[pdf[is_sentinel].fillna(False).astype(bool)]
        if len(hits):
            pdf = pdf.iloc[: hits[0]]
            state.update((True,))
        else:
            state.update((False,))
        if len(pdf):
            yield pdf[names]

    return df.groupBy(key).applyInPandasWithState(
        step, schema, T.StructType([T.StructField("stopped", T.BooleanType())]), "append",
        GroupStateTimeout.NoTimeout)


def changelog(df: DataFrame, order_cols: Sequence[str], out: str = "count") -> DataFrame:
    """AGG4 streaming, per record: the count of its key after it."""
    present = df.where(F.col("key").isNotNull() & F.col("value").isNotNull())
    return running_count_and_total(present, ["key"], order_cols, seq=out)


def offset_gaps(df: DataFrame, key: str = "partition", col: str = "offset") -> DataFrame:
    """OPS9 streaming: duplicates and gaps per partition, the state being the
    last offset seen.  Assumes offsets arrive in order per partition (as a
    consumer reads them); output ``(partition, kind, prev_offset, offset)``."""
    out_schema = T.StructType([T.StructField(key, df.schema[key].dataType),
                               T.StructField("kind", T.StringType()),
                               T.StructField("prev_offset", T.LongType()),
                               T.StructField(col, T.LongType())])

    def step(k, pdfs, state):
        pdf = _concat(pdfs)
        if pdf.empty:
            return
        offs = np.sort(pdf[col].astype("int64").to_numpy(), kind="mergesort")
        if state.exists:
            prev, cur = np.concatenate([[state.get[0]], offs[:-1]]), offs
        else:
            prev, cur = offs[:-1], offs[1:]
        diff = cur - prev
        hit = (diff == 0) | (diff > 1)
        state.update((int(offs[-1]),))
        if hit.any():
            yield pd.DataFrame({key: k[0], "kind": np.where(diff[hit] == 0, "duplicate", "gap"),
                                "prev_offset": prev[hit], col: cur[hit]})

    return df.groupBy(key).applyInPandasWithState(
        step, out_schema, T.StructType([T.StructField("last", T.LongType())]), "append",
        GroupStateTimeout.NoTimeout)


def sequence_and_sliding(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], y: str,
                         size: int, seq: str = "seq") -> DataFrame:
    """LIVE1 + LIVE5 streaming: per series, the message counter over every row
    and, for rows with a non-null ``y``, the buffer of the newest ``size``
    accepted values after it (``n``, ``lo``, ``hi``, ``total``).  The state is
    the counter and the last ``size - 1`` accepted values."""
    keys, order_cols = list(keys), list(order_cols)
    stats = [T.StructField("n", T.LongType()), T.StructField("lo", T.LongType()),
             T.StructField("hi", T.LongType()), T.StructField("total", T.LongType())]
    out_schema = T.StructType(list(df.schema.fields) + [T.StructField(seq, T.LongType())] + stats)
    state_schema = T.StructType([T.StructField("count", T.LongType()),
                                 T.StructField("recent", T.ArrayType(T.LongType()))])
    names = out_schema.fieldNames()

    def step(key, pdfs, state):
        pdf = _concat(pdfs)
        if pdf.empty:
            return
        pdf = pdf.sort_values(order_cols, kind="mergesort").reset_index(drop=True)
        count, recent = state.get if state.exists else (0, [])
        recent = [int(v) for v in (recent if recent is not None else [])]
        pdf[seq] = range(count + 1, count + 1 + len(pdf))
        accepted = pdf[y].notna().to_numpy()
        vals = np.concatenate([np.asarray(recent, dtype="int64"),
                               pdf.loc[accepted, y].astype("int64").to_numpy()])
        k = len(recent)
        # frames over the carried values plus this batch's accepted values
        idx = np.arange(k, len(vals))
        lo_idx = np.maximum(idx - (size - 1), 0)
        csum = np.concatenate([[0], np.cumsum(vals)])
        roll = pd.Series(vals, dtype="float64").rolling(size, min_periods=1)
        stats = {"n": (idx - lo_idx + 1), "total": csum[idx + 1] - csum[lo_idx],
                 "lo": roll.min().to_numpy()[k:].astype("int64"), "hi": roll.max().to_numpy()[k:].astype("int64")}
        for c, arr in stats.items():
            col = pd.array([pd.NA] * len(pdf), dtype="Int64")
            col[accepted] = arr
            pdf[c] = col
        recent = vals[-(size - 1):].tolist() if size > 1 else []
        state.update((int(pdf[seq].iloc[-1]), recent))
        yield pdf[names]

    return df.groupBy(*keys).applyInPandasWithState(
        step, out_schema, state_schema, "append", GroupStateTimeout.NoTimeout)
