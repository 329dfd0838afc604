import pytest
from pyspark.sql import functions as F

from hearth.operators import relational as rel
from hearth.plans.views import housing
from hearth.session import scratch_path
from hearth.sources import districts, scan_table, sinks


@pytest.fixture(scope="module")
def h(spark, small_dir):
    return housing(spark, small_dir).cache()


def test_districts_counts(spark, small_dir):
    d = districts(spark, small_dir)
    agg = d.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("total_bedrooms").isNull()).alias("nb"), F.count_if(F.col("households") == 0).alias("h0")).first()
    assert (agg["n"], agg["nb"], agg["h0"]) == (1473, 89, 15)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_income_filter_pushed_to_scan(spark, small_dir):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = _plan(rel.filter_by_income(spark.read.parquet(f"{small_dir}/orders.parquet"), 100.0, 200.0, "o_totalprice").select("o_orderkey"))
    assert "PushedFilters" in plan and "GreaterThanOrEqual(o_totalprice,100.0)" in plan and "LessThanOrEqual(o_totalprice,200.0)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan


def test_join_broadcasts_checked_summary(h):
    j = rel.join_with_summary(h, rel.district_summary(h), limit=20)
    plan = _plan(j)
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    rows = j.collect()
    assert len(rows) == 20 and [r["id"] for r in rows] == sorted(r["id"] for r in rows)


def test_head_tail(h):
    head = [r["district_id"] for r in rel.head_rows(h, 3).collect()]
    tail = [r["district_id"] for r in rel.tail_rows(h, 3).collect()]
    ids = sorted(r[0] for r in h.select("district_id").collect())
    assert head == ids[:3] and tail == ids[-3:]


def test_range_filter_defaults_to_data_bounds(h):
    c = rel.range_filter_counts(h, {"median_income": None, "median_house_value": None}).first()
    assert c["shown"] == c["total"] == h.count()


def test_update_and_delete(spark, h):
    ids = [r[0] for r in h.select("district_id").orderBy("district_id").limit(2).collect()]
    changes = spark.createDataFrame([(ids[0], "unknown"), (-1, "x")], "district_id long, new_value string")
    up = rel.update_rows(h, changes, "income_category")
    assert up.filter(F.col("income_category") == "unknown").count() == 1 and up.count() == h.count()
    assert rel.matched_keys(h, changes) == 1
    dele = rel.delete_rows(h, changes.select("district_id"))
    assert dele.count() == h.count() - 1


def test_custom_sql_positional_params(spark, h):
    h.createOrReplaceTempView("h_test")
    n = rel.custom_sql(spark, "SELECT COUNT(*) AS n FROM h_test WHERE median_income >= ? AND median_income <= ?", [3.0, 5.0]).first()["n"]
    assert n == rel.filter_by_income(h, 3.0, 5.0).count()


def test_sinks_roundtrip_and_catalog(spark, h):
    info = sinks.replace_table(spark, h, "h_tbl")
    assert info["rows_written"] == h.count() and info["delta"] == h.count()
    again = sinks.replace_table(spark, spark.table("h_tbl"), "h_tbl")  # replace from itself: new location first
    assert again["delta"] == 0
    assert sinks.table_count(spark, "h_tbl") == h.count() and sinks.table_count(spark, "absent_tbl") == 0
    stats = {r["table"]: r["rows"] for r in sinks.table_statistics(spark, ["h_tbl"]).collect()}
    assert stats == {"h_tbl": h.count()}
    with pytest.raises(ValueError):
        sinks.replace_table(spark, h.limit(0), "h_empty")
    with pytest.raises(ValueError):
        sinks.save_stage(spark, h, "final")
    p = sinks.save_stage(spark, h.select("district_id", "median_income"), "interim", root=scratch_path(spark, "t-stage"), fmt="csv")
    back = scan_table(spark, p, "csv", schema="district_id long, median_income double")
    assert back.count() == h.count()
    with pytest.raises(FileNotFoundError):
        scan_table(spark, scratch_path(spark, "nope"), "csv")


def test_contracts(spark):
    df = spark.createDataFrame([(1, None), (1, 2.0), (2, 3.0)], "k long, v double")
    got = {(r["constraint"], r["column"]): r["violations"] for r in sinks.contract_violations(df, ["v"], ["k"]).collect()}
    assert got == {("not_null", "v"): 1, ("unique", "k"): 1}
