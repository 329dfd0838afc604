"""Column expressions shared by the operators (all JVM-side, codegen-friendly)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth import config


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: str | Column) -> Column:
    """NaN becomes NULL, so NULL is the only missing marker downstream."""
    c = col(c)
    return F.when(~F.isnan(c), c)


def normalise_nan(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in every floating column, keep the rest as is."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    if not floats:
        return df
    return df.select([nan_to_null(F.col(c)).alias(c) if c in floats else F.col(c) for c in df.columns])


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den with a zero (or NULL) denominator giving NULL (never an ANSI
    error); a NaN input gives NULL too, so a later fill treats it as missing."""
    return nan_to_null(col(num) / F.nullif(col(den), F.lit(0.0)))


def half_even(c: str | Column) -> Column:
    """Round half to even to a whole number (``rint``), as numpy/pandas do."""
    return F.rint(col(c))


def cap_upper(c: str | Column, upper: float) -> Column:
    """Clip from above; NULL stays NULL (``least`` would turn NULL into the cap)."""
    c = col(c)
    return F.when(c > F.lit(upper), F.lit(float(upper))).otherwise(c)


def bin_label(c: str | Column, bins: Sequence[tuple[str, float, float]], default: str) -> Column:
    """Label of the first bin with ``lo <= x < hi``; anything else gets ``default``."""
    c = col(c)
    expr = None
    for label, lo, hi in bins:
        cond = c >= F.lit(float(lo))
        if hi != float("inf"):
            cond = cond & (c < F.lit(float(hi)))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


def isclose(a: str | Column, b: str | Column, rtol: float = config.ISCLOSE_RTOL, atol: float = config.ISCLOSE_ATOL) -> Column:
    """numpy.isclose(a, b): |a - b| <= atol + rtol * |b|; NULL/NaN compare false."""
    a, b = col(a), col(b)
    return F.coalesce(F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b), F.lit(False))


def currency(c: str | Column) -> Column:
    """``$1,234.56``: a dollar sign before the grouped two-decimal number
    (so a negative amount reads ``$-1,234.56``, as Python's format gives)."""
    return F.concat(F.lit("$"), F.format_number(col(c), 2))


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric columns in schema order, minus ``exclude``."""
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "columns") -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Missing {what}: {missing}")
