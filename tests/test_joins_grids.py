import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from hearth.config import Scale
from hearth.operators import eda, relational as rel
from hearth.operators.joins import sized_broadcast


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sized_broadcast_respects_bound(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # only explicit hints
    try:
        big = spark.range(1000).withColumnRenamed("id", "k")
        small = spark.range(10).withColumnRenamed("id", "k")
        within, beyond = big.join(sized_broadcast(small, 1 << 20), "k"), big.join(sized_broadcast(big, 10), "k")
        assert "BroadcastHashJoin" in _plan(within) and "BroadcastHashJoin" not in _plan(beyond)
        assert "SinglePartition" not in _plan(within) + _plan(beyond)
        assert within.count() == 10 and beyond.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_update_with_unbounded_change_table(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(200).select(F.col("id").alias("district_id"), F.lit("a").alias("income_category"))
        changes = df.filter("district_id % 2 = 0").select("district_id", F.lit("b").alias("new_value"))
        out = rel.update_rows(df, changes, "income_category", scale=Scale(broadcast_max_bytes=5))
        assert "BroadcastHashJoin" not in _plan(out)
        got = {r["district_id"]: r["income_category"] for r in out.collect()}
        assert all(v == ("b" if k % 2 == 0 else "a") for k, v in got.items()) and len(got) == 200
        gone = rel.delete_rows(df, changes.select("district_id"), scale=Scale(broadcast_max_bytes=5))
        assert gone.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scatter_grid_matches_numpy_binning(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"x": rng.normal(size=500), "y": rng.uniform(0, 10, 500), "c": rng.normal(5, 1, 500)})
    got = eda.scatter_grid(spark.createDataFrame(pdf), "x", "y", "c", bins=8).toPandas()
    xb = np.minimum(np.floor((pdf.x - pdf.x.min()) / (pdf.x.max() - pdf.x.min()) * 8), 7).astype(int)
    yb = np.minimum(np.floor((pdf.y - pdf.y.min()) / (pdf.y.max() - pdf.y.min()) * 8), 7).astype(int)
    exp = pdf.assign(x_bin=xb, y_bin=yb).groupby(["x_bin", "y_bin"]).agg(count=("c", "size"), colour_mean=("c", "mean")).reset_index()
    m = got.merge(exp, on=["x_bin", "y_bin"], suffixes=("", "_e"))
    assert len(m) == len(exp) == len(got)
    assert (m["count"] == m["count_e"]).all()
    np.testing.assert_allclose(m["colour_mean"], m["colour_mean_e"], rtol=1e-12)
