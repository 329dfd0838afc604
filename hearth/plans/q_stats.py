"""Registered queries: grouped aggregates and the statistics behind each chart."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth import config
from hearth.functions.columns import numeric_columns
from hearth.operators import eda
from hearth.plans import sqltext as S
from hearth.plans.registry import r6, register
from hearth.plans.views import housing

T = config.TARGET
NUMERIC = [c for c in ["district_id", *config.RAW_COLUMNS, "rooms_per_household", "bedrooms_per_room", "population_per_household"] if c != "district_id"]


def _round_all(df: DataFrame, cols, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(F.col(c), digits).alias(c) if c in cols else F.col(c) for c in df.columns])


# --- grouped aggregates ------------------------------------------------------------


@register(
    "grouped_mean",
    S.on_housing(f"SELECT income_category, ROUND(AVG({T}), 6) AS {T} FROM housing WHERE income_category IS NOT NULL GROUP BY 1 ORDER BY 1"),
)
def q_grouped_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_all(eda.grouped_aggregate(housing(spark, sf_dir), "income_category", T, "mean"), [T])


@register(
    "grouped_sum",
    S.on_housing(
        f"SELECT income_category, ROUND(COALESCE(SUM({T}), 0), 2) AS {T} FROM housing WHERE income_category IS NOT NULL GROUP BY 1 ORDER BY 1"
    ),
)
def q_grouped_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Sums of ~10^8 differ between engines in the last bits: cents are compared.
    return _round_all(eda.grouped_aggregate(housing(spark, sf_dir), "income_category", T, "sum"), [T], 2)


@register(
    "grouped_count",
    S.on_housing(f"SELECT income_category, COUNT({T}) AS {T} FROM housing WHERE income_category IS NOT NULL GROUP BY 1 ORDER BY 1"),
)
def q_grouped_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eda.grouped_aggregate(housing(spark, sf_dir), "income_category", T, "count")


@register(
    "grouped_median",
    S.on_housing(
        f"SELECT income_category, ROUND({S.midpoint('xs')}, 6) AS {T} FROM "
        f"(SELECT income_category, {S.sorted_list(T)} AS xs FROM housing WHERE income_category IS NOT NULL GROUP BY 1) ORDER BY 1"
    ),
)
def q_grouped_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_all(eda.grouped_aggregate(housing(spark, sf_dir), "income_category", T, "median"), [T])


@register(
    "trend_by_age",
    S.on_housing(f"SELECT housing_median_age, ROUND(AVG({T}), 6) AS {T} FROM housing WHERE housing_median_age IS NOT NULL GROUP BY 1 ORDER BY 1"),
)
def q_trend_by_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_all(eda.trend(housing(spark, sf_dir), "housing_median_age", T, "mean"), [T])


@register(
    "trend_median_by_age",
    S.on_housing(
        f"SELECT housing_median_age, ROUND({S.midpoint('xs')}, 6) AS {T} FROM "
        f"(SELECT housing_median_age, {S.sorted_list(T)} AS xs FROM housing WHERE housing_median_age IS NOT NULL GROUP BY 1) ORDER BY 1"
    ),
)
def q_trend_median_by_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_all(eda.trend(housing(spark, sf_dir), "housing_median_age", T, "median"), [T])


# --- per-column statistics -------------------------------------------------------------


def _describe_sql() -> str:
    parts = []
    for i, c in enumerate(NUMERIC):
        parts.append(
            f"SELECT {i} AS position, '{c}' AS \"column\", COUNT({c}) AS \"count\", ROUND(AVG({c}), 6) AS mean, "
            f"ROUND(STDDEV_SAMP({c}), 6) AS std, ROUND(MIN({c}), 6) AS \"min\", "
            f"ROUND(ANY_VALUE({S.lerp('xs', 0.25)}), 6) AS p25, ROUND(ANY_VALUE({S.lerp('xs', 0.5)}), 6) AS p50, "
            f"ROUND(ANY_VALUE({S.lerp('xs', 0.75)}), 6) AS p75, ROUND(MAX({c}), 6) AS \"max\" "
            f"FROM housing, (SELECT {S.sorted_list(c)} AS xs FROM housing) l"
        )
    return S.on_housing("\nUNION ALL\n".join(parts))


@register("summary_statistics", _describe_sql())
def q_summary_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = eda.summary_statistics(housing(spark, sf_dir))
    return _round_all(out, ["mean", "std", "min", "p25", "p50", "p75", "max"])


@register(
    "numeric_moments",
    S.on_housing(
        "\nUNION ALL\n".join(
            f"SELECT '{c}' AS \"column\", ROUND(AVG({c}), 6) AS mean, ROUND(ANY_VALUE({S.midpoint('xs')}), 6) AS median, "
            f"ROUND(STDDEV_SAMP({c}), 6) AS std FROM housing, (SELECT {S.sorted_list(c)} AS xs FROM housing) l"
            for c in NUMERIC
        )
    ),
)
def q_numeric_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_all(eda.numeric_moments(housing(spark, sf_dir)), ["mean", "median", "std"])


_RANGE_COLS = ["latitude", "longitude", "median_income", T]


@register(
    "column_ranges",
    S.on_housing("\nUNION ALL\n".join(f"SELECT '{c}' AS \"column\", MIN({c}) AS \"min\", MAX({c}) AS \"max\" FROM housing" for c in _RANGE_COLS)),
)
def q_column_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eda.column_ranges(housing(spark, sf_dir), _RANGE_COLS)


@register(
    "kpis",
    S.on_housing(
        f"SELECT COUNT(*) AS records, 13 AS features, ROUND(AVG({T}), 6) AS mean_price, "
        f"ROUND(ANY_VALUE({S.midpoint('xs')}), 6) AS median_price FROM housing, (SELECT {S.sorted_list(T)} AS xs FROM housing) l"
    ),
)
def q_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_all(eda.kpis(housing(spark, sf_dir)), ["mean_price", "median_price"])


# --- correlations -----------------------------------------------------------------


def _corr_sql(a: str, b: str) -> str:
    a2 = f"CASE WHEN {b} IS NOT NULL THEN {a} END"
    b2 = f"CASE WHEN {a} IS NOT NULL THEN {b} END"
    return f"COVAR_POP({a}, {b}) / NULLIF(SQRT(VAR_POP({a2}) * VAR_POP({b2})), 0)"


@register(
    "correlation_matrix",
    S.on_housing(
        "\nUNION ALL\n".join(
            f"SELECT '{a}' AS column_a, '{b}' AS column_b, ROUND({_corr_sql(a, b)}, 6) AS corr FROM housing" for a in NUMERIC for b in NUMERIC
        )
    ),
)
def q_correlation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_all(eda.correlation_matrix(housing(spark, sf_dir)), ["corr"])


_TC = "\nUNION ALL\n".join(f"SELECT '{c}' AS \"column\", ROUND({_corr_sql(c, T)}, 6) AS corr FROM housing" for c in NUMERIC)


@register("target_correlation", S.on_housing(f"SELECT * FROM ({_TC}) ORDER BY corr DESC NULLS LAST, \"column\""))
def q_target_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_all(eda.target_correlation(housing(spark, sf_dir)), ["corr"])


@register("top_correlations", S.on_housing(f"SELECT * FROM ({_TC}) WHERE corr < 1.0 ORDER BY corr DESC, \"column\" LIMIT 5"))
def q_top_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_all(eda.top_correlations(housing(spark, sf_dir), 5), ["corr"])


@register("bottom_correlations", S.on_housing(f"SELECT * FROM ({_TC}) ORDER BY corr ASC NULLS FIRST, \"column\" DESC LIMIT 5"))
def q_bottom_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_all(eda.bottom_correlations(housing(spark, sf_dir), 5), ["corr"])


# --- histogram, grids -------------------------------------------------------------


def bin_sql(c: str, lo: str, hi: str, bins: int) -> str:
    return f"CAST(LEAST(floor(({c} - {lo}) / ({hi} - {lo}) * {S.dbl(bins)}), {bins - 1}) AS INTEGER)"


def histogram_sql(source: str, c: str, bins: int, digits: int = 6) -> tuple[str, str]:
    """(CTEs, SELECT) over ``source`` (a CTE name) giving (bin, bin_lo, bin_hi, count)."""
    r = (
        f"r AS (SELECT CASE WHEN MIN({c}) = MAX({c}) THEN MIN({c}) - 0.5 ELSE MIN({c}) END AS lo, "
        f"CASE WHEN MIN({c}) = MAX({c}) THEN MAX({c}) + 0.5 ELSE MAX({c}) END AS hi FROM {source})"
    )
    counts = f"cnt AS (SELECT {bin_sql(c, 'r.lo', 'r.hi', bins)} AS bin, COUNT(*) AS n FROM {source}, r WHERE {c} IS NOT NULL GROUP BY 1)"
    w = f"((r.hi - r.lo) / {S.dbl(bins)})"
    select = (
        f"SELECT CAST(b.i AS INTEGER) AS bin, ROUND(r.lo + b.i * {w}, {digits}) AS bin_lo, "
        f"ROUND(r.lo + (b.i + 1) * {w}, {digits}) AS bin_hi, CAST(COALESCE(cnt.n, 0) AS BIGINT) AS \"count\" "
        f"FROM range({bins}) b(i) CROSS JOIN r LEFT JOIN cnt ON cnt.bin = b.i"
    )
    return f"{r},\n{counts}", select


_H_CTES, _H_SELECT = histogram_sql("housing", T, 50)


@register("histogram", S.on_housing(_H_SELECT, _H_CTES))
def q_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_all(eda.histogram(housing(spark, sf_dir), T, 50), ["bin_lo", "bin_hi"])


@register(
    "histogram_center",
    S.on_housing(
        f"SELECT ROUND(AVG({T}), 6) AS mean, ROUND(ANY_VALUE({S.midpoint('xs')}), 6) AS median FROM housing, (SELECT {S.sorted_list(T)} AS xs FROM housing) l"
    ),
)
def q_histogram_center(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_all(eda.column_center(housing(spark, sf_dir), T), ["mean", "median"])


def grid_sql(x: str, y: str, colour: str | None, bins: int) -> str:
    r = (
        f"r AS (SELECT CASE WHEN MIN({x}) = MAX({x}) THEN MIN({x}) - 0.5 ELSE MIN({x}) END AS xlo, "
        f"CASE WHEN MIN({x}) = MAX({x}) THEN MAX({x}) + 0.5 ELSE MAX({x}) END AS xhi, "
        f"CASE WHEN MIN({y}) = MAX({y}) THEN MIN({y}) - 0.5 ELSE MIN({y}) END AS ylo, "
        f"CASE WHEN MIN({y}) = MAX({y}) THEN MAX({y}) + 0.5 ELSE MAX({y}) END AS yhi FROM housing)"
    )
    extra = f", ROUND(AVG({colour}), 6) AS colour_mean" if colour else ""
    return S.on_housing(
        f"SELECT {bin_sql(x, 'r.xlo', 'r.xhi', bins)} AS x_bin, {bin_sql(y, 'r.ylo', 'r.yhi', bins)} AS y_bin, COUNT(*) AS \"count\"{extra} "
        f"FROM housing, r WHERE {x} IS NOT NULL AND {y} IS NOT NULL GROUP BY 1, 2",
        r,
    )


@register(
    "scatter_points",
    S.on_housing(f"SELECT district_id, longitude, latitude, {T} FROM housing WHERE longitude IS NOT NULL AND latitude IS NOT NULL"),
)
def q_scatter_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eda.scatter_points(housing(spark, sf_dir), "longitude", "latitude", T)


@register("scatter_grid", grid_sql("longitude", "latitude", None, 50))
def q_scatter_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eda.scatter_grid(housing(spark, sf_dir), "longitude", "latitude", None, 50)


@register("geo_grid", grid_sql("longitude", "latitude", T, 50))
def q_geo_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_all(eda.geo_grid(housing(spark, sf_dir), T, 50), ["colour_mean"])


def _pair_sql(bins: int = 20) -> str:
    cols = list(config.PAIR_COLUMNS)
    r = "r AS (SELECT " + ", ".join(
        f"CASE WHEN MIN({c}) = MAX({c}) THEN MIN({c}) - 0.5 ELSE MIN({c}) END AS lo_{c}, "
        f"CASE WHEN MIN({c}) = MAX({c}) THEN MAX({c}) + 0.5 ELSE MAX({c}) END AS hi_{c}"
        for c in cols
    ) + " FROM housing)"
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            parts.append(
                f"SELECT '{a}' AS column_x, '{b}' AS column_y, {config.PAIR_HUE} AS hue, "
                f"{bin_sql(a, 'r.lo_' + a, 'r.hi_' + a, bins)} AS x_bin, {bin_sql(b, 'r.lo_' + b, 'r.hi_' + b, bins)} AS y_bin, COUNT(*) AS \"count\" "
                f"FROM housing, r WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1, 2, 3, 4, 5"
            )
    return S.on_housing("\nUNION ALL\n".join(parts), r)


@register("pair_points", _pair_sql(20))
def q_pair_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eda.pair_grid(housing(spark, sf_dir), config.PAIR_COLUMNS, config.PAIR_HUE, 20)


# --- box, density, violin ---------------------------------------------------------


@register(
    "box_stats",
    S.on_housing(
        f"""SELECT q.income_category, COUNT(*) AS n, ROUND(ANY_VALUE(q.q1), 6) AS q1, ROUND(ANY_VALUE(q.med), 6) AS median,
       ROUND(ANY_VALUE(q.q3), 6) AS q3,
       ROUND(MIN({T}) FILTER (WHERE {T} >= q.lo_f AND {T} <= q.hi_f), 6) AS whisker_lo,
       ROUND(MAX({T}) FILTER (WHERE {T} >= q.lo_f AND {T} <= q.hi_f), 6) AS whisker_hi,
       COUNT(*) FILTER (WHERE NOT ({T} >= q.lo_f AND {T} <= q.hi_f)) AS fliers
FROM housing h JOIN q ON h.income_category = q.income_category
WHERE {T} IS NOT NULL
GROUP BY q.income_category""",
        f"""ql AS (SELECT income_category, {S.sorted_list(T)} AS xs FROM housing WHERE income_category IS NOT NULL GROUP BY 1),
q0 AS (SELECT income_category, {S.lerp('xs', 0.25)} AS q1, {S.lerp('xs', 0.5)} AS med, {S.lerp('xs', 0.75)} AS q3 FROM ql),
q AS (SELECT *, q1 - {S.dbl(1.5)} * (q3 - q1) AS lo_f, q3 + {S.dbl(1.5)} * (q3 - q1) AS hi_f FROM q0)""",
    ),
)
def q_box_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = eda.box_stats(housing(spark, sf_dir), "income_category", T)
    return _round_all(out, ["q1", "median", "q3", "whisker_lo", "whisker_hi"])


_SQRT2PI = f"{S.dbl(math.sqrt(2.0 * math.pi))}"


def _density_sql(points: int = 1000) -> str:
    parts = []
    for c in config.DENSITY_COLUMNS:
        parts.append(
            f"""SELECT '{c}' AS "column", CAST(g.i AS INTEGER) AS point, ROUND(ANY_VALUE(p.g0 + g.i * p.step), 6) AS x,
       ROUND(SUM(exp(-0.5 * ((p.g0 + g.i * p.step - h.{c}) / p.h) * ((p.g0 + g.i * p.step - h.{c}) / p.h))) / ANY_VALUE(p.norm), 9) AS density
FROM housing h, range({points}) g(i),
     (SELECT lo - 0.5 * (hi - lo) AS g0, ((hi + 0.5 * (hi - lo)) - (lo - 0.5 * (hi - lo))) / {S.dbl(points - 1)} AS step, bw AS h,
             n * bw * {_SQRT2PI} AS norm
      FROM (SELECT MIN({c}) AS lo, MAX({c}) AS hi, COUNT({c}) AS n, STDDEV_SAMP({c}) * pow(COUNT({c}), {S.dbl(-0.2)}) AS bw FROM housing)) p
WHERE h.{c} IS NOT NULL
GROUP BY g.i"""
        )
    return S.on_housing("\nUNION ALL\n".join(parts))


@register("density", _density_sql(1000))
def q_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = eda.density(housing(spark, sf_dir), config.DENSITY_COLUMNS, 1000)
    return out.select("column", "point", F.round("x", 6).alias("x"), F.round("density", 9).alias("density"))


def _violin_sql(x: str = "age_category", y: str = "median_income", points: int = 100, cut: float = 2.0) -> str:
    return S.on_housing(
        f"""SELECT p.grp AS category, CAST(g.i AS INTEGER) AS point, ROUND(ANY_VALUE(p.g0 + g.i * p.step), 6) AS y,
       ROUND(SUM(exp(-0.5 * ((p.g0 + g.i * p.step - h.{y}) / p.h) * ((p.g0 + g.i * p.step - h.{y}) / p.h))) / ANY_VALUE(p.norm), 9) AS density
FROM housing h JOIN p ON h.{x} = p.grp, range({points}) g(i)
WHERE h.{y} IS NOT NULL
GROUP BY p.grp, g.i""",
        f"""s AS (SELECT {x} AS grp, MIN({y}) AS lo, MAX({y}) AS hi, COUNT({y}) AS n,
              STDDEV_SAMP({y}) * pow(COUNT({y}), {S.dbl(-0.2)}) AS bw FROM housing WHERE {x} IS NOT NULL GROUP BY 1),
p AS (SELECT grp, lo - {S.dbl(cut)} * bw AS g0, ((hi + {S.dbl(cut)} * bw) - (lo - {S.dbl(cut)} * bw)) / {S.dbl(points - 1)} AS step,
             bw AS h, n * bw * {_SQRT2PI} AS norm FROM s WHERE n >= 2 AND bw > 0)""",
    )


@register("violin_data", _violin_sql())
def q_violin_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = eda.violin_data(housing(spark, sf_dir), "age_category", "median_income", 100)
    return out.select("category", "point", F.round("y", 6).alias("y"), F.round("density", 9).alias("density"))


def _pair_density_sql(points: int = 200, cut: float = 3.0) -> str:
    hue = config.PAIR_HUE
    parts, ctes = [], []
    for k, c in enumerate(config.PAIR_COLUMNS):
        ctes.append(
            f"""s{k} AS (SELECT {hue} AS grp, MIN({c}) AS lo, MAX({c}) AS hi, COUNT({c}) AS n,
              STDDEV_SAMP({c}) * pow(COUNT({c}), {S.dbl(-0.2)}) AS bw FROM housing WHERE {hue} IS NOT NULL GROUP BY 1),
p{k} AS (SELECT grp, lo - {S.dbl(cut)} * bw AS g0, ((hi + {S.dbl(cut)} * bw) - (lo - {S.dbl(cut)} * bw)) / {S.dbl(points - 1)} AS step,
             bw AS h, n * bw * {_SQRT2PI} AS norm FROM s{k} WHERE n >= 2 AND bw > 0)"""
        )
        parts.append(
            f"""SELECT '{c}' AS "column", p.grp AS hue, CAST(g.i AS INTEGER) AS point, ROUND(ANY_VALUE(p.g0 + g.i * p.step), 6) AS x,
       ROUND(SUM(exp(-0.5 * ((p.g0 + g.i * p.step - h.{c}) / p.h) * ((p.g0 + g.i * p.step - h.{c}) / p.h))) / ANY_VALUE(p.norm), 9) AS density
FROM housing h JOIN p{k} p ON h.{hue} = p.grp, range({points}) g(i) WHERE h.{c} IS NOT NULL GROUP BY p.grp, g.i"""
        )
    return S.on_housing("\nUNION ALL\n".join(parts), ",\n".join(ctes))


@register("pair_density", _pair_density_sql())
def q_pair_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = eda.pair_density(housing(spark, sf_dir))
    return out.select("column", "hue", "point", F.round("x", 6).alias("x"), F.round("density", 9).alias("density"))


# --- missing values: every 19th district has NaN in one column, every 23rd NULL in it ---

_HOLED = """holed AS (SELECT * REPLACE (CASE WHEN district_id % 19 = 0 OR district_id % 23 = 0 THEN NULL ELSE median_income END AS median_income) FROM housing)"""


def holed(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("district_id")
    value = F.when(k % 19 == 0, F.lit(float("nan"))).when(k % 23 == 0, F.lit(None)).otherwise(F.col("median_income"))
    return housing(spark, sf_dir).withColumn("median_income", value)


@register("grouped_mean_missing", S.on_housing("SELECT income_category, ROUND(AVG(median_income), 6) AS median_income FROM holed WHERE income_category IS NOT NULL GROUP BY 1", _HOLED))
def q_grouped_mean_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_all(eda.grouped_aggregate(holed(spark, sf_dir), "income_category", "median_income", "mean"), ["median_income"])


@register(
    "summary_statistics_missing",
    S.on_housing(
        f"""SELECT CAST(0 AS INTEGER) AS position, 'median_income' AS "column", COUNT(median_income) AS "count", ROUND(AVG(median_income), 6) AS mean,
       ROUND(STDDEV_SAMP(median_income), 6) AS std, ROUND(MIN(median_income), 6) AS "min", ROUND({S.lerp('ANY_VALUE(l.xs)', 0.25)}, 6) AS p25,
       ROUND({S.lerp('ANY_VALUE(l.xs)', 0.5)}, 6) AS p50, ROUND({S.lerp('ANY_VALUE(l.xs)', 0.75)}, 6) AS p75, ROUND(MAX(median_income), 6) AS "max"
FROM holed, (SELECT {S.sorted_list('median_income')} AS xs FROM holed) l""",
        _HOLED,
    ),
)
def q_summary_statistics_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_all(eda.summary_statistics(holed(spark, sf_dir), ["median_income"]), ["mean", "std", "min", "p25", "p50", "p75", "max"])


@register(
    "outliers_zscore_missing",
    S.on_housing(
        "SELECT district_id FROM holed, (SELECT AVG(median_income) AS m, STDDEV_SAMP(median_income) AS s FROM holed) z WHERE abs((median_income - m) / s) < 2.0",
        _HOLED,
    ),
)
def q_outliers_zscore_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hearth.operators import quality

    return quality.remove_outliers(holed(spark, sf_dir), "zscore", 2.0, columns=["median_income"]).select("district_id")


__all__ = ["numeric_columns", "r6"]
