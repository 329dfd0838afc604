"""The bounded-memory paths give the same answers as the direct ones on the fixture."""

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from hearth.config import Scale
from hearth.operators import eda, features as FE, quality as Q, regression as R
from hearth.plans.views import housing
from hearth.sources import districts

SMALL = Scale(exact_direct_max=300, refine_buckets=32, refine_collect_max=100, broadcast_max_bytes=2)


def _same(a, b, key):
    pa = a.toPandas().sort_values(key).reset_index(drop=True)
    pb = b.toPandas().sort_values(key).reset_index(drop=True)
    assert pa.equals(pb)


@pytest.fixture(scope="module")
def h(spark, small_dir):
    return housing(spark, small_dir).cache()


def test_box_and_medians(h):
    _same(eda.box_stats(h, "income_category", "median_house_value"), eda.box_stats(h, "income_category", "median_house_value", scale=SMALL), "income_category")
    _same(
        eda.grouped_aggregate(h, "income_category", "housing_median_age", "median"),
        eda.grouped_aggregate(h, "income_category", "housing_median_age", "median", scale=SMALL),
        "income_category",
    )


def test_outliers_and_features(spark, small_dir):
    d = districts(spark, small_dir)
    _same(Q.remove_outliers(d, "iqr", 1.5), Q.remove_outliers(d, "iqr", 1.5, scale=SMALL), "district_id")
    _same(FE.all_features(d), FE.all_features(d, scale=SMALL), "district_id")


def test_empty_inputs(spark):
    e = spark.createDataFrame([], "district_id long, x double, c string, median_house_value double")
    assert eda.histogram(e, "x", 5).count() == 5
    assert eda.summary_statistics(e, ["x"]).first()["count"] == 0
    assert eda.density(e, ["x"]).count() == 0
    assert Q.remove_outliers(e, "iqr", 1.5, columns=["x"]).count() == 0
    assert eda.grouped_aggregate(e, "c", "x", "median").count() == 0
    with pytest.raises(ValueError):
        R.prepare_features(e, ["x"])


def test_metrics_equal_regression_evaluator(spark, h):
    prep, feats = R.prepare_features(h)
    train, test = R.train_test_split(prep)
    pred = R.predictions(R.fit_ols(train, feats), test).cache()
    m = R.evaluate_metrics(pred).first()
    for name in ("rmse", "mae", "r2"):
        ev = RegressionEvaluator(labelCol="median_house_value", predictionCol="prediction", metricName=name)
        assert m[name] == pytest.approx(ev.evaluate(pred), rel=1e-9)


@pytest.mark.parametrize("name", ["score_details", "score_linear", "score_batch", "evaluate_metrics", "all_features"])
def test_districts_are_built_once_a_query(spark, tmp_path, monkeypatch, name):
    """Medians, fits, metrics and results read one written copy: none aggregates lineitem again."""
    from hearth.plans import q_model, views
    from hearth.plans.registry import queries

    orders = spark.range(1, 60).select(F.col("id").alias("o_orderkey"), (F.col("id") % 7).alias("o_custkey"), (F.col("id") * 997.5).alias("o_totalprice"))
    lines = orders.select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_orderkey") % 5 + 1.0).alias("l_quantity"), (F.col("o_totalprice") / 3).alias("l_extendedprice"))
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    lines.unionByName(lines.where("l_orderkey % 2 = 0")).write.parquet(f"{tmp_path}/lineitem.parquet")
    built = []

    def counted(*args):
        built.append(args)
        return districts(*args)

    monkeypatch.setattr(views, "districts", counted)
    monkeypatch.setattr(q_model, "districts", counted)
    out = queries()[name](spark, str(tmp_path))
    assert len(built) == 1
    assert not any("lineitem.parquet" in f or "orders.parquet" in f for f in out.inputFiles())
    assert out.count() in (1, 59)
