"""Registered queries: profile, nulls, duplicates, imputation, outliers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth import config
from hearth.operators import quality as Q
from hearth.plans import sqltext as S
from hearth.plans.registry import r6, register
from hearth.sources.fixtures import districts

RAW8 = [c for c in config.RAW_COLUMNS if c != config.TARGET]  # outlier columns, schema order
DISTRICT_COLS = ["district_id", *config.RAW_COLUMNS]


def _profile_sql() -> str:
    parts = []
    for i, c in enumerate(DISTRICT_COLS):
        dtype = "bigint" if c == "district_id" else "double"
        parts.append(
            f"SELECT {i} AS position, '{c}' AS \"column\", '{dtype}' AS dtype, COUNT(*) AS \"rows\", "
            f"COUNT(*) FILTER (WHERE {c} IS NULL OR isnan({c})) AS nulls FROM districts"
            if dtype == "double"
            else f"SELECT {i} AS position, '{c}' AS \"column\", '{dtype}' AS dtype, COUNT(*) AS \"rows\", "
            f"COUNT(*) FILTER (WHERE {c} IS NULL) AS nulls FROM districts"
        )
    return "\nUNION ALL\n".join(parts)


@register("table_profile", S.on_districts(_profile_sql()))
def q_table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.table_profile(districts(spark, sf_dir))


@register(
    "missing_values",
    S.on_districts(
        "SELECT \"column\", missing FROM ("
        + "\nUNION ALL\n".join(f"SELECT '{c}' AS \"column\", COUNT(*) FILTER (WHERE {c} IS NULL) AS missing FROM districts" for c in DISTRICT_COLS)
        + ") WHERE missing > 0 ORDER BY missing DESC, \"column\""
    ),
)
def q_missing_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.missing_values(districts(spark, sf_dir))


@register(
    "duplicate_rows",
    S.on_districts(
        f"""SELECT CAST(COALESCE(SUM(n), 0) AS BIGINT) AS "rows", COUNT(*) AS distinct_rows,
       CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS duplicates
FROM (SELECT COUNT(*) AS n FROM districts GROUP BY {S.RAW})"""
    ),
)
def q_duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Equality over the measured columns: the key would make every row unique.
    return Q.duplicate_rows(districts(spark, sf_dir), list(config.RAW_COLUMNS))


@register("impute_drop", S.on_districts("SELECT * FROM districts WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in DISTRICT_COLS)))
def q_impute_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.impute(districts(spark, sf_dir), "drop")


def _fill_sql(fill_expr: str) -> str:
    cols = ", ".join(c if c != "total_bedrooms" else f"COALESCE(total_bedrooms, ({fill_expr})) AS total_bedrooms" for c in DISTRICT_COLS)
    return S.on_districts(f"SELECT {cols} FROM districts")


@register("impute_median", _fill_sql(f"SELECT {S.midpoint('xs')} FROM (SELECT {S.sorted_list('total_bedrooms')} AS xs FROM districts)"))
def q_impute_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.impute(districts(spark, sf_dir), "median")


@register("impute_mean", _fill_sql("SELECT AVG(total_bedrooms) FROM districts"))
def q_impute_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.impute(districts(spark, sf_dir), "mean")


@register(
    "impute_mode",
    _fill_sql(
        "SELECT total_bedrooms FROM districts WHERE total_bedrooms IS NOT NULL "
        "GROUP BY total_bedrooms ORDER BY COUNT(*) DESC, total_bedrooms ASC LIMIT 1"
    ),
)
def q_impute_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.impute(districts(spark, sf_dir), "mode")


def iqr_chain(source: str, columns, t: float, prefix: str = "s") -> tuple[str, str, list[str]]:
    """CTEs filtering ``source`` sequentially by IQR; returns (ctes, last cte, bound ctes)."""
    ctes, cur, bounds = [], source, []
    for i, c in enumerate(columns):
        b = f"{prefix}b{i}"
        nxt = f"{prefix}{i + 1}"
        ctes.append(
            f"{b} AS (SELECT {S.lerp('xs', 0.25)} AS q1, {S.lerp('xs', 0.75)} AS q3 FROM (SELECT {S.sorted_list(c)} AS xs FROM {cur}))"
        )
        lo = f"({b}.q1 - {S.dbl(t)} * ({b}.q3 - {b}.q1))"
        hi = f"({b}.q3 + {S.dbl(t)} * ({b}.q3 - {b}.q1))"
        ctes.append(f"{nxt} AS (SELECT {cur}.* FROM {cur}, {b} WHERE {c} >= {lo} AND {c} <= {hi})")
        bounds.append((b, lo, hi))
        cur = nxt
    return ",\n".join(ctes), cur, bounds


_IQR_CTES, _IQR_LAST, _IQR_BOUNDS = iqr_chain("districts", RAW8, config.OUTLIER_THRESHOLD)


@register("outliers_iqr", f"WITH districts AS ({S.DISTRICTS_SQL}),\n{_IQR_CTES}\nSELECT * FROM {_IQR_LAST}")
def q_outliers_iqr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.remove_outliers(districts(spark, sf_dir), "iqr", 1.5)


def _report_sql() -> str:
    kept, acc = [], []
    for i, (c, (b, lo, hi)) in enumerate(zip(RAW8, _IQR_BOUNDS)):
        acc.append(f"({c} >= {lo} AND {c} <= {hi})")
        kept.append(
            f"SELECT {i + 1} AS step, '{c}' AS \"column\", ROUND(MIN({lo}), 6) AS lower, ROUND(MIN({hi}), 6) AS upper, "
            f"COUNT(*) FILTER (WHERE {' AND '.join(acc)}) AS rows_kept, COUNT(*) AS rows_in "
            f"FROM districts, {', '.join(x[0] for x in _IQR_BOUNDS[: i + 1])}"
        )
    body = "\nUNION ALL\n".join(kept)
    return (
        f"WITH districts AS ({S.DISTRICTS_SQL}),\n{_IQR_CTES},\nrep AS ({body})\n"
        "SELECT step, \"column\", lower, upper, rows_kept, rows_in - rows_kept AS rows_removed, "
        "ROUND((rows_in - rows_kept) * CAST(100.0 AS DOUBLE) / rows_in, 6) AS pct_removed FROM rep"
    )


@register("outlier_report", _report_sql())
def q_outlier_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rep = Q.outlier_report(districts(spark, sf_dir), "iqr", 1.5)
    return rep.select("step", "column", r6("lower"), r6("upper"), "rows_kept", "rows_removed", r6("pct_removed"))


def _zscore_sql(t: float) -> str:
    ctes, cur = [], "districts"
    for i, c in enumerate(RAW8):
        st, nxt = f"zs{i}", f"z{i + 1}"
        ctes.append(f"{st} AS (SELECT AVG({c}) AS m, STDDEV_SAMP({c}) AS s FROM {cur})")
        ctes.append(f"{nxt} AS (SELECT {cur}.* FROM {cur}, {st} WHERE abs(({c} - {st}.m) / NULLIF({st}.s, 0)) < {S.dbl(t)})")
        cur = nxt
    return f"WITH districts AS ({S.DISTRICTS_SQL}),\n" + ",\n".join(ctes) + f"\nSELECT * FROM {cur}"


@register("outliers_zscore", _zscore_sql(3.0))
def q_outliers_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.remove_outliers(districts(spark, sf_dir), "zscore", 3.0)


def _iqr_single_sql(t: float) -> str:
    bounds = ",\n".join(
        f"b{i} AS (SELECT {S.lerp('xs', 0.25)} AS q1, {S.lerp('xs', 0.75)} AS q3 FROM (SELECT {S.sorted_list(c)} AS xs FROM districts))"
        for i, c in enumerate(RAW8)
    )
    cond = " AND ".join(
        f"{c} >= b{i}.q1 - {S.dbl(t)} * (b{i}.q3 - b{i}.q1) AND {c} <= b{i}.q3 + {S.dbl(t)} * (b{i}.q3 - b{i}.q1)" for i, c in enumerate(RAW8)
    )
    tables = ", ".join(f"b{i}" for i in range(len(RAW8)))
    return f"WITH districts AS ({S.DISTRICTS_SQL}),\n{bounds}\nSELECT districts.* FROM districts, {tables} WHERE {cond}"


@register("outliers_iqr_single_pass", _iqr_single_sql(config.OUTLIER_THRESHOLD))
def q_outliers_iqr_single_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Opt-in: bounds of all 8 columns from the unfiltered table, one filter."""
    return Q.remove_outliers(districts(spark, sf_dir), "iqr_single_pass", 1.5)
