"""NaN and NULL as missing values, infinities, huge ranges, empty columns, duplicate changes."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hearth.config import Scale
from hearth.operators import eda, features, quality, quantiles, relational, scoring, regression
from hearth.sources import sinks

NAN = float("nan")
SMALL = Scale(exact_direct_max=40, refine_buckets=16, refine_collect_max=10)


def true_nan(spark, rows, schema):
    """A frame that holds real NaN (createDataFrame keeps NaN of Python tuples)."""
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def holed(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(400):
        x = NAN if i % 5 == 0 else None if i % 7 == 0 else float(rng.normal())
        y = NAN if i % 11 == 0 else float(rng.normal() + (x or 0 if x == x else 0))
        rows.append((i, ["a", "b", None][i % 3], x, y, None, 5.0))
    return true_nan(spark, rows, "district_id long, cat string, x double, y double, empty double, flat double")


@pytest.fixture(scope="module")
def frame(holed):
    pdf = pd.DataFrame([r.asDict() for r in holed.collect()])
    return pdf.astype({"x": float, "y": float, "empty": float})


def test_fixture_holds_real_nan(holed):
    assert holed.filter(F.isnan("x")).count() == 80 and holed.filter(F.col("x").isNull()).count() > 0


def test_histogram_and_ranges(holed, frame):
    got = eda.histogram(holed, "x", 7).orderBy("bin").toPandas()
    counts, edges = np.histogram(frame["x"].dropna(), 7)
    assert got["count"].tolist() == counts.tolist() and np.allclose(got["bin_lo"], edges[:-1])
    r = eda.column_ranges(holed, ["x"]).first()
    assert (r["min"], r["max"]) == (frame["x"].min(), frame["x"].max())


def test_summary_and_moments(holed, frame):
    d = frame["x"].describe()
    r = eda.summary_statistics(holed, ["x"]).first()
    assert np.allclose([r[c] for c in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")], d[["count", "mean", "std", "min", "25%", "50%", "75%", "max"]])
    m = eda.numeric_moments(holed, ["x"]).first()
    assert np.allclose([m["mean"], m["median"], m["std"]], [frame["x"].mean(), frame["x"].median(), frame["x"].std()])


@pytest.mark.parametrize("how", ["mean", "sum", "count", "median"])
def test_grouped(holed, frame, how):
    got = {r["cat"]: r["x"] for r in eda.grouped_aggregate(holed, "cat", "x", how).collect()}
    want = getattr(frame.groupby("cat")["x"], how)()
    assert got.keys() == set(want.index) and all(np.isclose(got[k], want[k]) for k in got)


def test_box_density_and_violin(holed, frame):
    got = {r["cat"]: r for r in eda.box_stats(holed, "cat", "x").collect()}
    for c, part in frame.groupby("cat"):
        v = part["x"].dropna()
        q1, q3 = v.quantile(0.25), v.quantile(0.75)
        inside = v[(v >= q1 - 1.5 * (q3 - q1)) & (v <= q3 + 1.5 * (q3 - q1))]
        r = got[c]
        assert np.allclose([r["n"], r["q1"], r["q3"], r["whisker_lo"], r["whisker_hi"], r["fliers"]], [len(v), q1, q3, inside.min(), inside.max(), len(v) - len(inside)])

    def kde(v, grid):
        h = v.std() * len(v) ** -0.2
        return np.exp(-0.5 * ((grid[:, None] - v.to_numpy()) / h) ** 2).sum(axis=1) / (len(v) * h * np.sqrt(2 * np.pi))

    one = eda.density(holed, ["x", "flat", "empty"], points=200).orderBy("point").toPandas()
    assert set(one["column"]) == {"x"}
    assert np.allclose(one["density"], kde(frame["x"].dropna(), one["x"].to_numpy()), rtol=1e-9, atol=1e-14)
    two = eda.pair_density(holed, ["x", "y"], "cat", points=40).toPandas()
    assert len(two) == 2 * 2 * 40
    for (column, hue), part in two.groupby(["column", "hue"]):
        v = frame.loc[frame["cat"] == hue, column].dropna()
        assert np.allclose(part["density"], kde(v, part["x"].to_numpy()), rtol=1e-9, atol=1e-14)


def test_violin_has_no_cap_on_categories(spark):
    df = spark.range(24_000).select((F.col("id") % 12_000).alias("g"), (F.col("id") * 1.5).alias("v"))
    assert eda.violin_data(df, "g", "v", points=3).count() == 36_000


def test_zscore_ignores_missing(holed, frame):
    got = {r["district_id"] for r in quality.remove_outliers(holed, "zscore", 1.5, columns=["x"]).collect()}
    z = (frame["x"] - frame["x"].mean()).abs() / frame["x"].std()
    assert got == set(frame.loc[z < 1.5, "district_id"])


def test_correlations_survive_empty_constant_and_disjoint_columns(spark, holed, frame):
    cols = ["x", "y", "empty", "flat"]
    got = {(r["column_a"], r["column_b"]): r["corr"] for r in eda.correlation_matrix(holed, cols).collect()}
    want = frame[cols].corr()
    for a in cols:
        for b in cols:
            w = want.loc[a, b]
            assert got[a, b] is None if np.isnan(w) else np.isclose(got[a, b], w)
    target = {r["column"]: r["corr"] for r in eda.target_correlation(holed, "y", cols).collect()}
    assert target["empty"] is None and target["flat"] is None and np.isclose(target["x"], want.loc["x", "y"])
    disjoint = spark.createDataFrame([(1.0, None), (2.0, None), (None, 3.0), (None, 5.0)], "a double, b double")
    got = {(r["column_a"], r["column_b"]): r["corr"] for r in eda.correlation_matrix(disjoint, ["a", "b"]).collect()}
    assert got["a", "b"] is None and np.isclose(got["a", "a"], 1.0)


def test_null_keys_on_every_quantile_path(spark):
    rows = [(None if i % 3 == 0 else "big" if i % 3 == 1 else "b", float(i * 37 % 911 if i % 3 == 1 else i % 20)) for i in range(600)]
    df = spark.createDataFrame(rows, "k string, x double")
    answer = lambda scale: sorted((str(r["k"]), r["prob"], r["value"], r["n"]) for r in quantiles.exact_quantiles(df, ["x"], [0.25, 0.5], by=["k"], scale=scale).collect())
    direct = answer(Scale())
    assert len(direct) == 6 and answer(SMALL) == direct
    nulls_big = df.withColumn("k", F.when(F.col("k") == "big", None).when(F.col("k").isNull(), "c").otherwise(F.col("k")))
    one = lambda scale: sorted((str(r["k"]), r["value"]) for r in quantiles.exact_quantiles(nulls_big, ["x"], [0.5], by=["k"], scale=scale).collect())
    assert one(SMALL) == one(Scale())


EXTREMES = {
    "infinities": [float(i) for i in range(300)] + [float("inf")] * 3 + [float("-inf")] * 2,
    "huge range": [1.7e308, -1.7e308] + [i * 1e-3 for i in range(300)],
    "many magnitudes": [s * 10.0**e for e in range(-150, 150) for s in (1, -1)],
    "tiny": [i * 5e-324 for i in range(-150, 150)],
    "equal": [4.25] * 300,
    "mostly infinite": [float("inf")] * 200 + [float(i) for i in range(100)],
}


@pytest.mark.parametrize("name", list(EXTREMES))
def test_extreme_values_give_the_same_on_every_path(spark, name):
    values = EXTREMES[name]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    rows = lambda scale: {r["prob"]: r["value"] for r in quantiles.exact_quantiles(df, ["x"], probs, scale=scale).collect()}
    small, direct = rows(SMALL), rows(Scale())
    assert small.keys() == direct.keys() == set(probs)
    assert all(small[p] == direct[p] or (small[p] != small[p] and direct[p] != direct[p]) for p in probs)
    assert direct[0.0] == min(values) and direct[1.0] == max(values)


def test_totals_of_districts_without_occupancy(spark):
    row = (1, 2.0, 30.0, 5.0, 1.0, 100.0, 0.0, 34.0, -118.0, 2.5)
    df = spark.createDataFrame([row], "district_id long, median_income double, housing_median_age double, avg_rooms double, avg_bedrooms double, population double, avg_occupancy double, latitude double, longitude double, median_house_value double")
    r = features.derive_totals(df).first()
    assert r["households"] is None and r["total_rooms"] is None and r["population"] == 100.0


def test_duplicate_changes_do_not_multiply_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "district_id long, income_category string")
    changes = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z"), (9, "q")], "district_id long, new_value string")
    got = sorted(tuple(r) for r in relational.update_rows(df, changes, "income_category").collect())
    assert got == [(1, "y"), (2, "b"), (3, "c")]
    assert {(r["district_id"], r["matched"]) for r in relational.matched_changes(df, changes).collect()} == {(1, True), (9, False), (None, False)}


def test_scoring_returns_every_row(spark):
    train = spark.createDataFrame([(i, float(i % 9), float(i % 9) * 3 + 1) for i in range(60)], "district_id long, median_income double, median_house_value double")
    model = regression.fit_ols(train, ["median_income"])
    row = dict(longitude=-118.0, latitude=34.0, housing_median_age=20.0, total_rooms=100.0, total_bedrooms=20.0, population=50.0, households=10.0, median_income=2.0)
    bad = [row, row | {"longitude": 3.0}, row | {"median_income": None}, row | {"median_income": NAN}, row | {"households": 0.0}]
    df = spark.createDataFrame([tuple([i, *b.values()]) for i, b in enumerate(bad)], "district_id long, " + ", ".join(f"{c} double" for c in row))
    got = {r["district_id"]: (r["prediction"], r["violation"] is None) for r in scoring.score_batch(model, df).collect()}
    assert [got[i][1] for i in range(5)][:3] == [True, False, False]
    assert all(np.isclose(got[i][0], 7.0) for i in (0, 1, 4)) and got[2][0] is None and got[3][0] is None


def test_details_carry_the_model_metrics(spark):
    cols = ["rooms_per_household", "bedrooms_per_room", "population_per_household"]
    df = spark.createDataFrame([(1, 5.0, 1.0, 0.1, 2.0, "low")], "district_id long, prediction double, " + ", ".join(f"{c} double" for c in cols) + ", income_category string")
    r = scoring.score_details(df, 4.0, metrics={"rmse": 1.5, "r2": 0.5}).first()
    assert (r["model_rmse"], r["model_r2"]) == (1.5, 0.5)


def test_refused_replacement_leaves_the_table(spark):
    name = "kept_table"
    sinks.replace_table(spark, spark.range(5), name)
    with pytest.raises(ValueError):
        sinks.replace_table(spark, spark.range(0), name)
    assert sinks.table_count(spark, name) == 5
    done = sinks.replace_table(spark, spark.range(8), name)
    assert sinks.table_count(spark, name) == 8 and done["delta"] == 3
    other = sinks.replace_table(spark, spark.range(2).withColumn("more", F.lit(1)), name)
    assert other["rows_written"] == 2 and spark.table(name).columns == ["id", "more"]


class _Remote:
    """A session of a cluster without a shared folder."""

    class sparkContext:  # noqa: N801
        master = "yarn"

        @staticmethod
        def getCheckpointDir():
            return None

    class conf:  # noqa: N801
        @staticmethod
        def get(key, default=None):
            return default


def test_a_cluster_without_shared_folder_is_refused():
    from hearth.session import shared_dir

    with pytest.raises(RuntimeError):
        shared_dir(_Remote())
