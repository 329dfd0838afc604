"""Registered queries: totals, ratio features, categories, logs, checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth import config
from hearth.operators import features as FE
from hearth.plans import sqltext as S
from hearth.plans.registry import register
from hearth.plans.views import housing
from hearth.sources.fixtures import districts, raw_averages

DISTRICT_COLS = ["district_id", *config.RAW_COLUMNS]
HOUSING_COLS = DISTRICT_COLS + list(config.DERIVED_FEATURES)


@register(
    "derive_totals",
    S.on_raw_averages(
        """SELECT district_id, longitude, latitude, housing_median_age,
       round_even(avg_rooms * round_even(population / NULLIF(avg_occupancy, 0), 0), 0) AS total_rooms,
       round_even(avg_bedrooms * round_even(population / NULLIF(avg_occupancy, 0), 0), 0) AS total_bedrooms,
       population,
       round_even(population / NULLIF(avg_occupancy, 0), 0) AS households,
       median_income,
       median_house_value * 100000 AS median_house_value
FROM raw_averages"""
    ),
)
def q_derive_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FE.derive_totals(raw_averages(spark, sf_dir))


def _one_ratio_sql(name: str) -> str:
    num, den, cap = FE.RATIOS[name]
    r = f"{num} / NULLIF({den}, 0)"
    filled = f"COALESCE({r}, m)"
    val = f"CASE WHEN {filled} > {S.dbl(cap)} THEN {S.dbl(cap)} ELSE {filled} END" if cap is not None else filled
    return S.on_districts(
        f"""SELECT districts.*, {val} AS {name}
FROM districts, (SELECT {S.midpoint('xs')} AS m FROM (SELECT {S.sorted_list(r.replace(num, 'd.' + num).replace(den, 'd.' + den))} AS xs FROM districts d))"""
    )


@register("rooms_per_household", _one_ratio_sql("rooms_per_household"))
def q_rooms_per_household(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FE.rooms_per_household(districts(spark, sf_dir))


@register("bedrooms_per_room", _one_ratio_sql("bedrooms_per_room"))
def q_bedrooms_per_room(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FE.bedrooms_per_room(districts(spark, sf_dir))


@register("population_per_household", _one_ratio_sql("population_per_household"))
def q_population_per_household(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FE.population_per_household(districts(spark, sf_dir))


@register("income_category", S.on_districts(f"SELECT *, {S.INCOME_CASE} AS income_category FROM districts"))
def q_income_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FE.income_category(districts(spark, sf_dir))


@register("age_category", S.on_districts(f"SELECT *, {S.AGE_CASE} AS age_category FROM districts"))
def q_age_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FE.age_category(districts(spark, sf_dir))


@register(
    "log_features",
    S.on_districts(
        "SELECT *, " + ", ".join(f"ROUND(ln(1 + {c}), 9) AS log_{c}" for c in config.LOG_COLUMNS) + " FROM districts"
    ),
)
def q_log_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = FE.log_features(districts(spark, sf_dir))
    return out.select(*DISTRICT_COLS, *[F.round(f"log_{c}", 9).alias(f"log_{c}") for c in config.LOG_COLUMNS])


@register("all_features", S.on_housing("SELECT * FROM housing"))
def q_all_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return housing(spark, sf_dir)


def _checks_sql() -> str:
    parts = [f"SELECT 'nulls' AS \"check\", '{f}' AS feature, COUNT(*) FILTER (WHERE {f} IS NULL) AS \"count\" FROM housing" for f in config.DERIVED_FEATURES]
    parts.append(
        "SELECT 'out_of_range', 'bedrooms_per_room', COUNT(*) FILTER (WHERE bedrooms_per_room < 0 OR bedrooms_per_room > 1.0) FROM housing"
    )
    parts += [f"SELECT 'missing', '{f}', CAST(0 AS BIGINT)" for f in config.DERIVED_FEATURES]
    return S.on_housing("\nUNION ALL\n".join(parts))


@register("validate_features", _checks_sql())
def q_validate_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FE.feature_checks(housing(spark, sf_dir))


def _recheck_sql() -> str:
    parts = []
    for n, (num, den, _) in FE.RATIOS.items():
        ok = f"COALESCE(abs({num} / NULLIF({den}, 0) - {n}) <= {S.dbl(config.ISCLOSE_ATOL)} + {S.dbl(config.ISCLOSE_RTOL)} * abs({n}), false)"
        parts.append(
            f"SELECT '{n}' AS feature, COUNT(*) AS \"rows\", COUNT(*) FILTER (WHERE {ok}) AS matching, "
            f"COUNT(*) FILTER (WHERE NOT {ok}) AS mismatching FROM housing"
        )
    return S.on_housing("\nUNION ALL\n".join(parts))


@register("ratio_recheck", _recheck_sql())
def q_ratio_recheck(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FE.ratio_recheck(housing(spark, sf_dir))


_COMPLETE = " AND ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL) = 0" for c in config.DERIVED_FEATURES)


@register(
    "features_valid",
    S.on_housing(
        f"SELECT 'housing' AS source, {_COMPLETE} AS valid FROM housing "
        f"UNION ALL SELECT 'every 13th ratio missing', {_COMPLETE} FROM (SELECT * REPLACE (CASE WHEN district_id % 13 <> 0 THEN rooms_per_household END AS rooms_per_household) FROM housing)"
    ),
)
def q_features_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The validation flag of the feature table, and of one with holes."""
    h = housing(spark, sf_dir)
    holed = h.withColumn("rooms_per_household", F.when(F.col("district_id") % 13 != 0, F.col("rooms_per_household")))
    flags = [("housing", FE.validate_features(h)[1]), ("every 13th ratio missing", FE.validate_features(holed)[1])]
    return spark.createDataFrame(flags, "source string, valid boolean")
