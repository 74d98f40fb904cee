"""Joins of a topic with a table of one row per topic partition, or per series.

A hash exchange on ``partition`` alone would put whole topic partitions in a
few tasks.  The small side is copied to ``SALTS`` salts, the topic's records
are salted by their own columns, and the join is an equi-join on
``(partition, salt)``: one lazy plan at every size, evenly spread; adaptive
execution broadcasts the small side where it measures it small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 64


def join_small(big: DataFrame, small: DataFrame, key: str, small_key: str, salt_by: Sequence[Column | str],
               how: str = "left", salts: int = SALTS, null_safe: bool = False) -> DataFrame:
    """``big JOIN small ON key = small_key``; ``salt_by``: columns of ``big``
    that tell its records apart.  ``how``: inner or left (a copied row must
    not come out unmatched).  ``null_safe``: a null key meets a null key."""
    if how not in ("inner", "left"):
        raise ValueError(f"a salted join cannot be {how}")
    s = small.withColumn("__salt_s", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    b = big.withColumn("__salt_b", F.pmod(F.xxhash64(*salt_by), F.lit(salts)).cast("int"))
    same = F.col(key).eqNullSafe(F.col(small_key)) if null_safe else F.col(key) == F.col(small_key)
    on = same & (F.col("__salt_b") == F.col("__salt_s"))
    return b.join(s, on, how).drop("__salt_b", "__salt_s")
