"""Data quality and cleaning: profile, nulls, duplicates, imputation, outliers.

Every statistic is one aggregate over the table (partial/final); only the
per-column results (a few numbers per column) reach the driver, where they
become literals of the next, fully distributed, projection or filter.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth import config
from hearth.config import SCALE, Scale
from hearth.functions.columns import normalise_nan, numeric_columns
from hearth.operators import brackets
from hearth.operators.quantiles import combine, medians, mode_values, pandas_q, quantile_map
from hearth.session import materialise


def _missing(df: DataFrame, c: str):
    dt = df.schema[c].dataType
    m = F.col(c).isNull()
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        m = m | F.isnan(F.col(c))
    return m


def table_profile(df: DataFrame) -> DataFrame:
    """(position, column, dtype, rows, nulls): one aggregate over all columns."""
    parts = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(c).alias("column"),
            F.lit(t).alias("dtype"),
            F.count(F.lit(1)).alias("rows"),
            F.count_if(_missing(df, c)).alias("nulls"),
        )
        for i, (c, t) in enumerate(df.dtypes)
    ]
    return df.agg(F.array(*parts).alias("a")).select(F.inline("a"))


def missing_values(df: DataFrame) -> DataFrame:
    """(column, missing) for columns with missing values, most first (ties by name)."""
    prof = table_profile(df)
    return (
        prof.filter(F.col("nulls") > 0)
        .select("column", F.col("nulls").alias("missing"))
        .orderBy(F.col("missing").desc(), F.col("column").asc())
    )


def duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row (rows, distinct_rows, duplicates): rows equal to an earlier row.

    Equality over ``columns`` (all by default), NULLs equal. Map-side
    combining collapses a hot duplicate before the shuffle.
    """
    cols = list(columns) if columns is not None else df.columns
    groups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicates"),
    )


def drop_missing(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop a row if any (of ``subset``) column is missing."""
    cond = None
    for c in subset or df.columns:
        m = _missing(df, c)
        cond = m if cond is None else (cond | m)
    return df.filter(~cond) if cond is not None else df


def missing_counts(df: DataFrame) -> tuple[int, dict]:
    """(rows, {column: missing}) in one aggregate."""
    row = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count_if(_missing(df, c)).alias(c) for c in df.columns]).first().asDict()
    rows = row.pop("__rows")
    return rows, row


def columns_with_missing(df: DataFrame) -> list[str]:
    _, counts = missing_counts(df)
    return [c for c in df.columns if counts[c] > 0]


def fill_values(df: DataFrame, strategy: str, columns: Sequence[str], scale: Scale = SCALE, max_rows: int | None = None) -> dict:
    """The value each column is filled with under ``strategy``."""
    if strategy == "median":
        return medians(df, columns, scale, max_rows=max_rows)
    if strategy == "mean":
        row = df.agg(*[F.avg(F.when(~_missing(df, c), F.col(c))).alias(c) for c in columns]).first()
        return row.asDict()
    if strategy == "mode":
        return mode_values(df, columns)
    raise ValueError(f"{strategy!r} is not an imputation strategy (median, mean, mode, drop)")


def impute(
    df: DataFrame,
    strategy: str = config.IMPUTE_STRATEGY,
    columns: Sequence[str] | None = None,
    scale: Scale = SCALE,
    max_rows: int | None = None,
) -> DataFrame:
    """Fill each column that has missing values with its own median/mean/mode,
    or drop rows with any missing value (``drop``). Columns are independent.
    Median and mean need numeric columns; mode works on any type.
    """
    if strategy == "drop":
        return drop_missing(df, columns)
    if strategy not in ("median", "mean", "mode"):
        raise ValueError(f"{strategy!r} is not an imputation strategy (median, mean, mode, drop)")
    rows = max_rows
    if columns:
        targets = list(columns)
    else:
        rows, counts = missing_counts(df)
        targets = [c for c in df.columns if counts[c] > 0]
    if not targets:
        return df
    if strategy in ("median", "mean"):
        bad = [c for c in targets if not isinstance(df.schema[c].dataType, T.NumericType)]
        if bad:
            raise ValueError(f"Cannot take the {strategy} of non-numeric columns: {bad}")
    values = fill_values(df, strategy, targets, scale, max_rows=rows)
    return fill_with(df, values)


def fill_with(df: DataFrame, values: dict) -> DataFrame:
    """Replace missing values (NULL and NaN) by the given per-column literal."""
    out = []
    for c in df.columns:
        if c in values and values[c] is not None:
            dt = df.schema[c].dataType
            lit = F.lit(values[c]).cast(dt)
            out.append(F.when(_missing(df, c), lit).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


class Step(NamedTuple):
    """One outlier step: its column, bounds (None when undefined) and row condition."""

    column: str
    lower: float | None
    upper: float | None
    keep: Column


def _default_outlier_columns(df: DataFrame, target: str | None, key: str | None) -> list[str]:
    return numeric_columns(df, exclude=[x for x in (target, key) if x])


def iqr_bounds_steps(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    threshold: float = config.OUTLIER_THRESHOLD,
    target: str | None = config.TARGET,
    key: str | None = config.KEY,
    scale: Scale = SCALE,
) -> tuple[DataFrame, list[Step]]:
    """Sequential IQR filter: per column, quartiles of the rows that survived
    the previous columns, keep [Q1 - t*IQR, Q3 + t*IQR] inclusive (NULL dropped).

    Returns the filtered (lazy) frame and the per-step bounds. The outlier
    columns are written once. Up to ``exact_direct_max`` rows, each step sorts
    its column; beyond, it is one pass over them (more beyond tens of millions of rows) that finds its column's quartiles in their brackets and, of the
    rows its bounds will keep, brackets the next column's (``brackets``).
    """
    cols = list(columns) if columns is not None else _default_outlier_columns(df, target, key)
    qs = (pandas_q(0.25), pandas_q(0.75))
    # Bounds need only the outlier columns: that narrow projection is written
    # once to the shared folder for the sequential passes.
    narrow = materialise(df.sparkSession, df.select(*cols), "outlier-columns")
    n0 = narrow.count()  # every later step holds at most n0 rows
    cur, keep, steps, ahead = narrow, F.lit(True), [], None
    for i, c in enumerate(cols):
        if n0 <= scale.exact_direct_max:
            q = quantile_map(cur, [c], [0.25, 0.75], scale, max_rows=n0)
            quartiles = [q[c, p] for p in (0.25, 0.75) if (c, p) in q]
        else:
            after = cols[i + 1] if i + 1 < len(cols) else None
            quartiles, ahead = _bracketed_quartiles(cur, c, after, threshold, qs, ahead, scale)
        if not quartiles:  # no value left: the step removes every row
            cond, lo, hi = F.lit(False), None, None
        else:
            q1, q3 = quartiles
            lo, hi = q1 - threshold * (q3 - q1), q3 + threshold * (q3 - q1)
            cond = F.col(c).between(F.lit(lo), F.lit(hi))
        steps.append(Step(c, lo, hi, cond))
        keep = keep & cond
        cur = cur.filter(cond)
    # The sequential filters are row-wise, so their conjunction on the input
    # keeps exactly the rows the sequence keeps.
    return df.filter(keep), steps


def _bracketed_quartiles(cur: DataFrame, c: str, after: str | None, threshold: float, qs: tuple, around: tuple | None, scale: Scale):
    """([q1, q3] of ``c`` or [], brackets of the quartiles of ``after`` or None) in one pass where ``around`` brackets c's."""
    around = around or tuple(brackets.brackets(cur, {c: qs}).values())
    more = brackets.following(c, around, after, threshold, qs) if after else None
    state, guess = brackets.run_pass(cur, {(c, q): b for q, b in zip(qs, around, strict=True)}, scale, more, [after] if after else [])
    found = brackets.finish(cur, state, scale)
    ahead = tuple(brackets.Bracket(*g) for g in guess.values()) if guess and None not in guess.values() else None
    return [combine(f.low, f.high, f.fraction) for f in (found[c, q] for q in qs if (c, q) in found)], ahead


def iqr_single_pass(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    threshold: float = config.OUTLIER_THRESHOLD,
    target: str | None = config.TARGET,
    key: str | None = config.KEY,
    scale: Scale = SCALE,
) -> tuple[DataFrame, list[Step]]:
    """Opt-in variant: every column's quartiles from the *unfiltered* input in
    one quantile job, then one conjunctive filter. Two passes whatever the
    column count, but not the sequential semantics (it keeps a superset or
    different rows when columns are correlated)."""
    cols = list(columns) if columns is not None else _default_outlier_columns(df, target, key)
    q = quantile_map(df, cols, [0.25, 0.75], scale)
    keep, steps = F.lit(True), []
    for c in cols:
        if (c, 0.25) not in q:
            steps.append(Step(c, None, None, F.lit(False)))
            keep = F.lit(False)
            continue
        q1, q3 = q[(c, 0.25)], q[(c, 0.75)]
        lo, hi = q1 - threshold * (q3 - q1), q3 + threshold * (q3 - q1)
        cond = F.col(c).between(F.lit(lo), F.lit(hi))
        steps.append(Step(c, lo, hi, cond))
        keep = keep & cond
    return df.filter(keep), steps


def zscore_steps(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    threshold: float | None = None,
    target: str | None = config.TARGET,
    key: str | None = config.KEY,
) -> tuple[DataFrame, list[Step]]:
    """Sequential z-score filter: keep |x - mean| / std < t (sample std, strict).

    A zero or undefined std, or a missing value, drops the row. ``threshold``
    None means 1.5 (the configured outlier threshold).
    """
    t = config.OUTLIER_THRESHOLD if threshold is None else threshold
    cols = list(columns) if columns is not None else _default_outlier_columns(df, target, key)
    narrow = materialise(df.sparkSession, normalise_nan(df.select(*cols)), "outlier-columns")
    cur, keep, steps = narrow, F.lit(True), []
    for c in cols:
        row = cur.agg(F.avg(c).alias("m"), F.stddev_samp(c).alias("s")).first()
        m, s = row["m"], row["s"]
        if s is None or s == 0 or m is None:  # undefined z: every row goes
            steps.append(Step(c, None, None, F.lit(False)))
            keep = F.lit(False)
            cur = cur.filter(F.lit(False))
            continue
        cond = F.abs((F.col(c) - F.lit(m)) / F.lit(s)) < F.lit(t)
        steps.append(Step(c, m - t * s, m + t * s, cond))
        keep = keep & cond
        cur = cur.filter(cond)
    return df.filter(keep), steps


def remove_outliers(
    df: DataFrame,
    method: str = config.OUTLIER_METHOD,
    threshold: float | None = None,
    columns: Sequence[str] | None = None,
    target: str | None = config.TARGET,
    key: str | None = config.KEY,
    scale: Scale = SCALE,
) -> DataFrame:
    if method == "iqr":
        t = config.OUTLIER_THRESHOLD if threshold is None else threshold
        return iqr_bounds_steps(df, columns, t, target, key, scale)[0]
    if method == "iqr_single_pass":
        t = config.OUTLIER_THRESHOLD if threshold is None else threshold
        return iqr_single_pass(df, columns, t, target, key, scale)[0]
    if method == "zscore":
        return zscore_steps(df, columns, threshold, target, key)[0]
    raise ValueError(f"{method!r} is not an outlier method (iqr, zscore, iqr_single_pass)")


def outlier_report(
    df: DataFrame,
    method: str = config.OUTLIER_METHOD,
    threshold: float | None = None,
    columns: Sequence[str] | None = None,
    target: str | None = config.TARGET,
    key: str | None = config.KEY,
    scale: Scale = SCALE,
) -> DataFrame:
    """(step, column, lower, upper, rows_kept, rows_removed, pct_removed).

    Bounds come from the sequential filter; the kept counts of all steps are
    then measured in one aggregate with cumulative conditions.
    """
    if method == "iqr":
        t = config.OUTLIER_THRESHOLD if threshold is None else threshold
        _, steps = iqr_bounds_steps(df, columns, t, target, key, scale)
    elif method == "iqr_single_pass":
        t = config.OUTLIER_THRESHOLD if threshold is None else threshold
        _, steps = iqr_single_pass(df, columns, t, target, key, scale)
    elif method == "zscore":
        _, steps = zscore_steps(df, columns, threshold, target, key)
    else:
        raise ValueError(f"{method!r} is not an outlier method (iqr, zscore, iqr_single_pass)")
    parts, acc = [], F.lit(True)
    for i, (c, lo, hi, keep) in enumerate(steps):
        acc = acc & F.coalesce(keep, F.lit(False))
        parts.append(
            F.struct(
                F.lit(i + 1).alias("step"),
                F.lit(c).alias("column"),
                F.lit(lo).cast("double").alias("lower"),
                F.lit(hi).cast("double").alias("upper"),
                F.count_if(acc).alias("rows_kept"),
                F.count(F.lit(1)).alias("rows_in"),
            )
        )
    if not parts:
        return df.sparkSession.createDataFrame([], "step int, column string, lower double, upper double, rows_kept bigint, rows_removed bigint, pct_removed double")
    rep = df.agg(F.array(*parts).alias("a")).select(F.inline("a"))
    return rep.select(
        "step",
        "column",
        "lower",
        "upper",
        "rows_kept",
        (F.col("rows_in") - F.col("rows_kept")).alias("rows_removed"),
        F.try_divide((F.col("rows_in") - F.col("rows_kept")) * 100.0, F.col("rows_in")).alias("pct_removed"),
    )
