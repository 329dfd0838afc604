"""Registered queries: scans, sinks, catalog, projections, filters, join, SQL, row changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth import config
from hearth.operators import relational as rel
from hearth.plans import sqltext as S
from hearth.plans.registry import r6, register
from hearth.plans.views import housing, summary
from hearth.session import scratch_path
from hearth.sources.contracts import Contract, publish, violating_rows
from hearth.sources import sinks
from hearth.sources.fixtures import districts
from hearth.sources.tables import ORDERS_SCHEMA, scan_table, table_path

DISTRICT_COLS = ["district_id", *config.RAW_COLUMNS]
SUMMARY_SELECT = """SELECT income_category, ROUND(avg_house_value, 6) AS avg_house_value, ROUND(avg_rooms, 6) AS avg_rooms,
       ROUND(avg_age, 6) AS avg_age, district_count FROM district_summary"""
DISTRICT_SCHEMA = "district_id bigint, " + ", ".join(f"{c} double" for c in config.RAW_COLUMNS)


def _rounded_summary(df: DataFrame) -> DataFrame:
    return df.select("income_category", r6("avg_house_value"), r6("avg_rooms"), r6("avg_age"), "district_count")


# --- scans and sinks ----------------------------------------------------------------


@register("scan_table", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def q_scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = scan_table(spark, table_path(sf_dir, "orders"), "parquet", schema=ORDERS_SCHEMA)
    return df.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


@register("stage_roundtrip", S.on_districts("SELECT * FROM districts"))
def q_stage_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw stage written as CSV with a header (current file + snapshot), read back typed."""
    root = scratch_path(spark, "stages")
    path = sinks.save_stage(spark, districts(spark, sf_dir), "raw", root=root, fmt="csv")
    return scan_table(spark, path, "csv", schema=DISTRICT_SCHEMA)


@register("replace_table", S.on_housing("SELECT * FROM housing"))
def q_replace_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    sinks.replace_table(spark, housing(spark, sf_dir), "housing")
    return sinks.fetch_all(spark, "housing")


@register("fetch_all", S.on_housing(SUMMARY_SELECT, S.SUMMARY_CTE))
def q_fetch_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    sinks.replace_table(spark, summary(spark, sf_dir), "district_summary")
    return _rounded_summary(sinks.fetch_all(spark, "district_summary"))


@register("table_count", S.on_housing("SELECT 'housing' AS \"table\", COUNT(*) AS \"rows\" FROM housing"))
def q_table_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    sinks.replace_table(spark, housing(spark, sf_dir), "housing_counted")
    rows = sinks.table_count(spark, "housing_counted")
    return spark.createDataFrame([("housing", rows)], "table string, rows bigint")


@register(
    "table_statistics",
    S.on_housing(
        "SELECT 'district_summary' AS \"table\", COUNT(*) AS \"rows\" FROM district_summary "
        "UNION ALL SELECT 'housing', COUNT(*) FROM housing",
        S.SUMMARY_CTE,
    ),
)
def q_table_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = housing(spark, sf_dir)
    sinks.replace_table(spark, h, "housing")
    sinks.replace_table(spark, rel.district_summary(spark.table("housing")), "district_summary")
    return sinks.table_statistics(spark, ["district_summary", "housing"])


@register(
    "contract_violations",
    S.on_housing(
        "\nUNION ALL\n".join(
            f"SELECT 'not_null' AS \"constraint\", '{c}' AS \"column\", COUNT(*) FILTER (WHERE {c} IS NULL) AS violations FROM housing"
            for c in config.RAW_COLUMNS
        )
        + "\nUNION ALL\nSELECT 'unique', 'district_id', COUNT(*) FILTER (WHERE n > 1) FROM (SELECT COUNT(*) AS n FROM housing GROUP BY district_id)"
    ),
)
def q_contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.contract_violations(housing(spark, sf_dir), not_null=config.RAW_COLUMNS, unique=["district_id"])


# --- projections and filters ---------------------------------------------------------


@register(
    "project_rename",
    S.on_districts("SELECT district_id, median_income AS income, housing_median_age AS age, median_house_value AS value FROM districts"),
)
def q_project_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel.project_rename(
        districts(spark, sf_dir),
        ["district_id", "median_income", "housing_median_age", "median_house_value"],
        {"median_income": "income", "housing_median_age": "age", "median_house_value": "value"},
    )


@register(
    "numeric_columns",
    S.on_housing(
        "SELECT district_id, longitude, latitude, housing_median_age, total_rooms, total_bedrooms, population, households, "
        "median_income, rooms_per_household, bedrooms_per_room, population_per_household FROM housing"
    ),
)
def q_numeric_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel.select_numeric(housing(spark, sf_dir), exclude=[config.TARGET])


@register("filter_by_income", S.on_housing("SELECT * FROM housing WHERE median_income >= 3.0 AND median_income <= 5.0"))
def q_filter_by_income(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel.filter_by_income(housing(spark, sf_dir), 3.0, 5.0)


@register(
    "filter_by_location",
    S.on_housing("SELECT * FROM housing WHERE latitude >= 33.0 AND latitude <= 36.0 AND longitude >= -124.0 AND longitude <= -120.0"),
)
def q_filter_by_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel.filter_by_location(housing(spark, sf_dir), 33.0, 36.0, -124.0, -120.0)


_RANGE_WHERE = (
    "median_income >= 3.0 AND median_income <= 6.0 "
    "AND median_house_value >= (SELECT MIN(median_house_value) FROM housing) "
    "AND median_house_value <= (SELECT MAX(median_house_value) FROM housing)"
)


@register("range_filter", S.on_housing(f"SELECT * FROM housing WHERE {_RANGE_WHERE}"))
def q_range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel.range_filter(housing(spark, sf_dir), {"median_income": (3.0, 6.0), config.TARGET: None})


@register("range_filter_counts", S.on_housing(f"SELECT COUNT(*) FILTER (WHERE {_RANGE_WHERE}) AS shown, COUNT(*) AS total FROM housing"))
def q_range_filter_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel.range_filter_counts(housing(spark, sf_dir), {"median_income": (3.0, 6.0), config.TARGET: None})


@register("head_rows", S.on_housing("SELECT * FROM housing ORDER BY district_id LIMIT 5"))
def q_head_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel.head_rows(housing(spark, sf_dir), 5)


@register("tail_rows", S.on_housing("SELECT * FROM (SELECT * FROM housing ORDER BY district_id DESC LIMIT 5) ORDER BY district_id"))
def q_tail_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel.tail_rows(housing(spark, sf_dir), 5)


# --- summary and join ------------------------------------------------------------------


@register("district_summary", S.on_housing(SUMMARY_SELECT, S.SUMMARY_CTE))
def q_district_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_summary(summary(spark, sf_dir))


@register(
    "join_with_summary",
    S.on_housing(
        """SELECT h.district_id AS id, h.longitude, h.latitude, h.median_income, h.median_house_value, h.income_category,
       h.rooms_per_household, ROUND(ds.avg_house_value, 6) AS district_avg_value,
       ROUND(ds.avg_rooms, 6) AS district_avg_rooms, ds.district_count
FROM housing h JOIN district_summary ds ON h.income_category = ds.income_category
ORDER BY id LIMIT 100""",
        S.SUMMARY_CTE,
    ),
)
def q_join_with_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = housing(spark, sf_dir)
    j = rel.join_with_summary(h, rel.district_summary(h), limit=100)
    return j.select(*[r6(c) if c in ("district_avg_value", "district_avg_rooms") else F.col(c) for c in j.columns])


# --- SQL surface and row changes ----------------------------------------------------


@register("custom_sql", S.on_housing("SELECT * FROM housing WHERE median_income >= 3.0 AND median_income <= 6.0"))
def q_custom_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    housing(spark, sf_dir).createOrReplaceTempView("housing_view")
    return rel.custom_sql(spark, "SELECT * FROM housing_view WHERE median_income >= ? AND median_income <= ?", [3.0, 6.0])


@register(
    "update_rows",
    S.on_housing(
        "SELECT district_id, " + S.RAW + ", rooms_per_household, bedrooms_per_room, population_per_household, "
        "CASE WHEN households = 0 THEN 'unknown' ELSE income_category END AS income_category, age_category FROM housing"
    ),
)
def q_update_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Districts without households get the category 'unknown' (change table from the data)."""
    h = housing(spark, sf_dir)
    changes = h.filter(F.col("households") == 0).select("district_id", F.lit("unknown").alias("new_value"))
    return rel.update_rows(h, changes, "income_category")


@register("delete_rows", S.on_housing("SELECT * FROM housing WHERE district_id NOT IN (SELECT district_id FROM housing WHERE total_rooms = 0)"))
def q_delete_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Districts without rooms are removed."""
    h = housing(spark, sf_dir)
    return rel.delete_rows(h, h.filter(F.col("total_rooms") == 0).select("district_id"))


@register(
    "matched_changes",
    S.on_housing("SELECT c.k AS district_id, h.district_id IS NOT NULL AS matched FROM (SELECT DISTINCT district_id * 2 AS k FROM housing) c LEFT JOIN housing h ON h.district_id = c.k"),
)
def q_matched_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of the doubled district numbers are districts."""
    h = housing(spark, sf_dir)
    return rel.matched_changes(h, h.select((F.col("district_id") * 2).alias("district_id")))


@register(
    "summary_contract",
    S.on_housing(
        "SELECT 'not_null' AS \"constraint\", 'income_category' AS \"column\", COUNT(*) FILTER (WHERE income_category IS NULL) AS violations FROM district_summary "
        "UNION ALL SELECT 'unique', 'income_category', COUNT(*) FILTER (WHERE n > 1) FROM (SELECT COUNT(*) AS n FROM district_summary GROUP BY income_category)",
        S.SUMMARY_CTE,
    ),
)
def q_summary_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored summary has one row per category: it goes into a typed table, created where absent, and is checked there."""
    rows = summary(spark, sf_dir)
    sinks.create_if_absent(spark, "contracted_summary", rows.schema)
    sinks.replace_table(spark, rows, "contracted_summary")
    return sinks.contract_violations(spark.table("contracted_summary"), not_null=["income_category"], unique=["income_category"])


# --- enforced contracts and committed changes ------------------------------------------

DISTRICT_CONTRACT = Contract(not_null=["total_bedrooms", "median_income"], unique=[["district_id"], ["longitude", "latitude"]])


@register(
    "contract_violating_rows",
    S.on_districts(
        """SELECT district_id, array_to_string(list_filter([CASE WHEN total_bedrooms IS NULL THEN 'total_bedrooms is null' END, CASE WHEN median_income IS NULL THEN 'median_income is null' END,
       CASE WHEN nd > 1 THEN 'district_id is not unique' END, CASE WHEN nl > 1 THEN 'longitude, latitude is not unique' END], lambda x: x IS NOT NULL), '; ') AS violations
FROM (SELECT *, COUNT(*) OVER (PARTITION BY district_id) AS nd, CASE WHEN longitude IS NOT NULL AND latitude IS NOT NULL THEN COUNT(*) OVER (PARTITION BY longitude, latitude) END AS nl FROM districts)
WHERE total_bedrooms IS NULL OR median_income IS NULL OR nd > 1 OR nl > 1"""
    ),
)
def q_contract_violating_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Districts that break the contract (inputs present, one district per place), with the broken rules."""
    found = violating_rows(districts(spark, sf_dir), DISTRICT_CONTRACT)
    return found.select("district_id", F.array_join("violations", "; ").alias("violations"))


@register("publish_quarantine", S.on_districts("SELECT 'published' AS part, COUNT(*) AS \"rows\" FROM districts WHERE total_bedrooms IS NOT NULL UNION ALL SELECT 'rejected', COUNT(*) FROM districts WHERE total_bedrooms IS NULL"))
def q_publish_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Districts are published under a contract; those without bedrooms are set aside."""
    publish(spark, districts(spark, sf_dir), "published_districts", Contract(not_null=["total_bedrooms"], unique=[["district_id"]]), "quarantine")
    parts = [("published", "published_districts"), ("rejected", "published_districts_rejected")]
    counted = [spark.table(t).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(p).alias("part"), "rows") for p, t in parts]
    return counted[0].unionByName(counted[1])


@register(
    "update_table",
    S.on_housing(
        "SELECT district_id, " + S.RAW + ", rooms_per_household, bedrooms_per_room, population_per_household, "
        "CASE WHEN households = 0 THEN 'unknown' ELSE income_category END AS income_category, age_category FROM housing"
    ),
)
def q_update_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change of ``update_rows`` committed to a stored table, which is read back."""
    sinks.replace_table(spark, housing(spark, sf_dir), "housing_updated")
    h = spark.table("housing_updated")
    changes = h.filter(F.col("households") == 0).select("district_id", F.lit("unknown").alias("new_value"))
    sinks.update_table(spark, "housing_updated", changes, "income_category")
    return spark.table("housing_updated")


@register("delete_from_table", S.on_housing("SELECT * FROM housing WHERE district_id NOT IN (SELECT district_id FROM housing WHERE total_rooms = 0)"))
def q_delete_from_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The removal of ``delete_rows`` committed to a stored table, which is read back."""
    sinks.replace_table(spark, housing(spark, sf_dir), "housing_deleted")
    h = spark.table("housing_deleted")
    sinks.delete_from_table(spark, "housing_deleted", h.filter(F.col("total_rooms") == 0).select("district_id"))
    return spark.table("housing_deleted")
