"""Sinks (SNK1-SNK5): topic writes, the 8-byte long value form, console
lines and text files.  Batch and streaming DataFrames go through the same
functions; a streaming DataFrame returns the started query."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.functions.numbers import long_to_bytes
from rivulet.functions.text import java_format
from rivulet.operators.records import RECORD_FORMAT
from rivulet.sinks.topic_log import append, append_batches, has_positions
from rivulet.sources.envelope import FIELDS, TEXT_FORMAT_OPTIONS


def _write(df: DataFrame, fmt: str, path: str | None, *, mode: str = "append",
           checkpoint: str | None = None, trigger: str | None = "available-now",
           output_mode: str = "append", options: dict | None = None):
    if df.isStreaming:
        from rivulet.streaming.runner import start
        return start(df, sink=fmt, path=path, checkpoint=checkpoint, trigger=trigger,
                     output_mode=output_mode, options=options)
    w = df.write.format(fmt).mode(mode).options(**(options or {}))
    return w.save(path) if path else w.save()


def to_topic(df: DataFrame, topic: str, *, fmt: str = "parquet", partitions: int | None = None,
             order: Sequence[str] = (), **kw):
    """SNK1 / SNK3: ``stream.to(topic)`` / ``producer.send``.

    Kafka: ``topic`` is the topic name (key optional; the broker gives
    partition and offset).  Elsewhere ``topic`` is a directory of envelope
    files.  Records that carry partition and offset (a mirror's) keep them;
    all others are appended with dense offsets as commits of
    :mod:`rivulet.sinks.topic_log`, which takes ``partitions`` and ``order``.
    """
    if fmt == "kafka":
        opts = dict(kw.pop("options", None) or {})
        opts.setdefault("topic", topic)
        cols = [c for c in ("key", "value") if c in df.columns]
        return _write(df.select(*cols), "kafka", None, options=opts, **kw)
    options = {**(TEXT_FORMAT_OPTIONS if fmt in ("json", "csv") else {}), **(kw.pop("options", None) or {})}
    if has_positions(df.columns):
        missing = {"key": "string", "timestamp": "timestamp_ntz"}
        out = df.withColumns({c: F.lit(None).cast(t) for c, t in missing.items() if c not in df.columns})
        return _write(out.select(*FIELDS), fmt, topic, options=options, **kw)
    if df.isStreaming:
        from rivulet.streaming.runner import start
        return start(df, foreach_batch=append_batches(topic, partitions=partitions, order=order, fmt=fmt, options=options), **kw)
    if kw.pop("mode", "append") != "append":
        raise ValueError("records are appended to a topic")
    return append(df, topic, partitions=partitions, order=order, fmt=fmt, options=options, **kw)


def long_values(df: DataFrame, col: str = "count") -> DataFrame:
    """SNK2: ``table.to(String, Long, topic)`` - the count as an 8-byte
    big-endian value next to its string key."""
    return df.select(F.col("key"), long_to_bytes(F.col(col)).alias("value"))


def console_lines(df: DataFrame) -> DataFrame:
    """SNK4: the consumer's printed line per record."""
    return df.select(java_format(RECORD_FORMAT, "key", "value", "partition", "offset").alias("value"))


def to_console(df: DataFrame, **kw):
    """SNK4: print records (``show`` for a batch, the console sink for a stream)."""
    if df.isStreaming:
        return _write(df, "console", None, **kw)
    df.show(truncate=False)
    return None


def to_text(df: DataFrame, path: str, col: str = "value", **kw):
    """SNK5: ``writeAsText`` / file sink - one value per line."""
    return _write(df.select(F.col(col).cast("string").alias("value")), "text", path, **kw)
