"""Number parsing and the 8-byte long wire form, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rivulet.functions.util import as_col

# Python ``int(text)`` grammar (ASCII digits, optional sign,
# single underscores between digit groups, surrounding whitespace) and
# Java ``Integer.parseInt`` grammar (no whitespace allowed).
PY_INT_PATTERN = r"^\s*[+-]?[0-9]+(_[0-9]+)*\s*$"
JAVA_INT_PATTERN = r"^[+-]?[0-9]+$"


def py_int(col) -> Column:
    """Python ``int(text)`` as a nullable bigint: NULL means "rejected".

    ``4.5``, blanks, non-ASCII digits and values outside bigint are rejects.
    """
    v = as_col(col)
    cleaned = F.regexp_replace(F.regexp_replace(v, r"^\s+|\s+$", ""), "_", "")
    return F.when(v.rlike(PY_INT_PATTERN), cleaned.try_cast("bigint"))


def java_parse_int(col) -> Column:
    """``Integer.parseInt(text)`` as a nullable int: NULL where Java throws."""
    v = as_col(col)
    return F.when(v.rlike(JAVA_INT_PATTERN), v.try_cast("int"))


def long_to_bytes(col) -> Column:
    """Big-endian 8-byte form of a bigint (Kafka's LongSerializer).

    ``hex`` of a negative bigint is already 16 two's-complement digits, so
    the left pad only matters for non-negative values.
    """
    return F.unhex(F.lpad(F.hex(as_col(col).cast("bigint")), 16, "0"))


def bytes_to_long(col) -> Column:
    """Inverse of :func:`long_to_bytes`; NULL unless exactly 8 bytes."""
    b = as_col(col)
    return F.when(F.octet_length(b) == 8, F.conv(F.hex(b), 16, -10).cast("bigint"))
