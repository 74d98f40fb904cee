"""Text scalars with the reference's (Java) semantics, as Column expressions.

Java's ``String.split(regex)`` (limit 0) differs from Spark's ``split``:
Java drops *trailing* empty strings, keeps a leading one produced by a
positive-width match at the start, returns ``[""]`` for empty input and
``[]`` for input made only of separators.  Spark keeps every empty string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.util import as_col

# The separators the reference splits on.
NON_WORD = r"\W+"
WHITESPACE = r"\s+"
TAB = "\t"
SPACE = " "

# Character class that, if present, makes a run-pattern leave a real token.
_TOKEN_CLASS = {NON_WORD: r"\w", WHITESPACE: r"\S"}


def java_split(col, pattern: str) -> Column:
    """``v.split(pattern)`` with Java's limit-0 rules, as an array column.

    General form, valid for any pattern: the array is cut after its last
    non-empty element; if none is non-empty, the result is ``[""]`` for
    empty input and ``[]`` otherwise.  Null input gives null.
    """
    v = as_col(col)
    parts = F.split(v, pattern, -1)
    # 1-based position (from the end) of the last non-empty element, 0 if none
    from_end = F.array_position(F.transform(F.reverse(parts), lambda x: x != F.lit("")), True)
    keep = F.when(from_end > 0, F.size(parts) - from_end + 1).when(v == F.lit(""), 1).otherwise(0)
    return F.slice(parts, 1, keep)


def explode_run_split(df: DataFrame, col: str, pattern: str, out: str = "word",
                      lower: bool = False, keep_source: bool = False) -> DataFrame:
    """One row per token of ``col.split(pattern)`` under Java's rules.

    Hot-path form for *run* patterns (``\\W+``, ``\\s+``) whose matches can
    never be adjacent, so blanks only appear first or last: a
    ``posexplode`` plus a filter, all inside whole-stage codegen.
    The only blank kept is the leading one of a text that has a token,
    or the single blank of an empty text.
    """
    token = _TOKEN_CLASS.get(pattern)
    if token is None:
        raise ValueError(f"not a run pattern with a known token class: {pattern!r}")
    src = F.lower(F.col(col)) if lower else F.col(col)
    rest = [c for c in df.columns if c != col]
    cols = rest + ([F.col(col).alias(f"{col}__src")] if keep_source else [])
    # The blank rule needs one boolean per text; computing it before the
    # explode keeps the (possibly huge) source text out of every token row.
    flagged = df.select(*cols, src.alias("__v"),
                        ((src == F.lit("")) | src.rlike(token)).alias("__lead_ok"))
    exploded = flagged.select(*cols and [c if isinstance(c, str) else F.col(f"{col}__src") for c in cols],
                              "__lead_ok",
                              F.posexplode(F.split(F.col("__v"), pattern, -1)).alias("__i", out))
    kept = exploded.where((F.col(out) != F.lit("")) | ((F.col("__i") == 0) & F.col("__lead_ok")))
    return kept.drop("__lead_ok", "__i")


def first_field(col, sep: str) -> Column:
    """``v.split(sep)[0]`` for a literal separator; never indexes past the end.

    A text made only of separators gives the empty string (Java would throw).
    """
    return F.substring_index(as_col(col), sep, 1)


# Fixed value: code points outside the Basic Multilingual Plane, which Java
# strings store as two UTF-16 units.
SUPPLEMENTARY = r"[^\x{10000}-\x{10FFFF}]"


def java_length(col) -> Column:
    """``String.length()``: UTF-16 units, i.e. code points plus one for each
    code point outside the BMP (Spark's ``length`` counts code points)."""
    v = as_col(col)
    return F.length(v) + F.length(F.regexp_replace(v, SUPPLEMENTARY, ""))


def java_format(fmt: str, *cols) -> Column:
    """``printf``/string concatenation: nulls render as ``null``."""
    return F.format_string(fmt, *[as_col(c) for c in cols])
