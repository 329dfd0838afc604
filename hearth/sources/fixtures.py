"""The ``districts`` table: a housing-shaped table derived from orders/lineitem.

One row per order that has line items; the raw district schema plus the
key ``district_id``. ``DISTRICTS_SQL`` is the same definition in SQL text
(used by the SQL oracle); ``districts`` builds it with the DataFrame API.

Plan: lineitem is reduced per order (partial aggregate map-side, so a hot
order key collapses before the shuffle), and orders is shuffled once on the
same key to meet it: one sort-merge / shuffled-hash join on the order key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.session import path_signature
from hearth.sources.tables import read_table, table_path

DISTRICTS_SQL = """SELECT o.o_orderkey AS district_id,
       CAST(-124.35 AS DOUBLE) + (o.o_custkey % 1000) * CAST(0.01 AS DOUBLE) AS longitude,
       CAST(32.54 AS DOUBLE) + (o.o_orderkey % 941) * CAST(0.01 AS DOUBLE) AS latitude,
       CAST(1 + (o.o_orderkey * 7) % 52 AS DOUBLE) AS housing_median_age,
       CASE WHEN o.o_orderkey % 107 = 0 THEN CAST(0 AS DOUBLE)
            WHEN o.o_orderkey % 53 = 0 THEN CAST(1 AS DOUBLE)
            ELSE l.qty * 8 + o.o_orderkey % 29 END AS total_rooms,
       CASE WHEN o.o_orderkey % 17 = 0 THEN NULL ELSE l.qty + o.o_custkey % 41 END AS total_bedrooms,
       l.n * (20 + o.o_custkey % 97) AS population,
       CASE WHEN o.o_orderkey % 101 = 0 THEN CAST(0 AS DOUBLE)
            ELSE l.n * (5 + o.o_orderkey % 23) END AS households,
       o.o_totalprice / 40000 AS median_income,
       20000 + o.o_totalprice * CAST(0.6 AS DOUBLE) + l.cents / CAST(100 AS DOUBLE) AS median_house_value
FROM orders o
JOIN (SELECT l_orderkey,
             CAST(SUM(l_quantity) AS DOUBLE) AS qty,
             CAST(COUNT(*) AS DOUBLE) AS n,
             CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) AS cents
      FROM lineitem GROUP BY l_orderkey) l
  ON l.l_orderkey = o.o_orderkey"""

# Raw averages (per-household form) of the districts with households > 0,
# target in units of 100,000: input of the totals derivation.
RAW_AVERAGES_SQL = """SELECT district_id,
       median_income, housing_median_age,
       total_rooms / NULLIF(households, 0) AS avg_rooms,
       total_bedrooms / NULLIF(households, 0) AS avg_bedrooms,
       population,
       COALESCE(population / NULLIF(households, 0), 0) AS avg_occupancy,
       latitude, longitude,
       median_house_value / 100000 AS median_house_value
FROM districts"""


def districts(spark: SparkSession, base_dir: str) -> DataFrame:
    """The districts table of a scale-factor folder (raw schema + key)."""
    per_order = (
        read_table(spark, base_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.sum("l_quantity").cast("double").alias("qty"),
            F.count(F.lit(1)).cast("double").alias("n"),
            F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).cast("double").alias("cents"),
        )
    )
    orders = read_table(spark, base_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    j = orders.join(per_order, orders["o_orderkey"] == per_order["l_orderkey"])
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    qty, n, cents, price = F.col("qty"), F.col("n"), F.col("cents"), F.col("o_totalprice")
    zero, one = F.lit(0.0), F.lit(1.0)
    return j.select(
        ok.alias("district_id"),
        (F.lit(-124.35) + (ck % 1000) * F.lit(0.01)).alias("longitude"),
        (F.lit(32.54) + (ok % 941) * F.lit(0.01)).alias("latitude"),
        (F.lit(1) + (ok * 7) % 52).cast("double").alias("housing_median_age"),
        F.when(ok % 107 == 0, zero).when(ok % 53 == 0, one).otherwise(qty * 8 + ok % 29).alias("total_rooms"),
        F.when(ok % 17 == 0, F.lit(None).cast("double")).otherwise(qty + ck % 41).alias("total_bedrooms"),
        (n * (F.lit(20) + ck % 97)).alias("population"),
        F.when(ok % 101 == 0, zero).otherwise(n * (F.lit(5) + ok % 23)).alias("households"),
        (price / 40000).alias("median_income"),
        (F.lit(20000) + price * F.lit(0.6) + cents / F.lit(100.0)).alias("median_house_value"),
    )


def raw_averages(spark: SparkSession, base_dir: str) -> DataFrame:
    """Per-household averages of the districts (input of ``derive_totals``);
    districts without households have occupancy 0 and no room averages."""
    d = districts(spark, base_dir)
    h = F.nullif(F.col("households"), F.lit(0.0))
    return d.select(
        "district_id",
        "median_income",
        "housing_median_age",
        (F.col("total_rooms") / h).alias("avg_rooms"),
        (F.col("total_bedrooms") / h).alias("avg_bedrooms"),
        "population",
        F.coalesce(F.col("population") / h, F.lit(0.0)).alias("avg_occupancy"),
        "latitude",
        "longitude",
        (F.col("median_house_value") / 100000).alias("median_house_value"),
    )
