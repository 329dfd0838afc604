import numpy as np
import pandas as pd
import pytest

from hearth.config import Scale
from hearth.operators.quantiles import exact_quantiles, medians, mode_values, quantile_map

TINY = Scale(exact_direct_max=40, refine_buckets=8, refine_collect_max=10)


def _frame(spark, n=500, seed=1, hot=False):
    rng = np.random.default_rng(seed)
    g = rng.choice(["a", "b", "c"], size=n)
    if hot:
        g[: n // 2] = "a"  # one group holds half the rows
    x = np.round(rng.normal(10, 3, size=n), 2)
    x[::37] = np.nan
    y = rng.integers(0, 20, size=n).astype(float)
    pdf = pd.DataFrame({"g": g, "x": x, "y": y})
    return pdf, spark.createDataFrame(pdf)


def test_linear_and_median_match_pandas(spark):
    pdf, df = _frame(spark)
    q = quantile_map(df, ["x", "y"], [0.0, 0.1, 0.25, 0.5, 0.75, 1.0])
    for c in ["x", "y"]:
        for p in [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]:
            assert q[(c, p)] == pdf[c].quantile(p)
    m = medians(df, ["x", "y"])
    assert m["x"] == pdf["x"].median() and m["y"] == pdf["y"].median()


@pytest.mark.parametrize("hot", [False, True])
def test_refinement_equals_direct(spark, hot):
    pdf, df = _frame(spark, n=400, seed=3, hot=hot)
    probs = [0.25, 0.5, 0.75]
    direct = exact_quantiles(df, ["x", "y"], probs, by=["g"]).toPandas()
    refined = exact_quantiles(df, ["x", "y"], probs, by=["g"], scale=TINY).toPandas()
    key = ["g", "column", "prob"]
    a = direct.sort_values(key).reset_index(drop=True)
    b = refined.sort_values(key).reset_index(drop=True)
    pd.testing.assert_frame_equal(a[key + ["value", "n"]], b[key + ["value", "n"]], check_dtype=False)
    for (g, c, p), v in a.set_index(key)["value"].items():
        assert v == pdf.loc[pdf.g == g, c].quantile(p)


def test_refinement_many_ties(spark):
    # a third of the rows share one value: refinement must end on the tie
    vals = [5.0] * 200 + list(np.arange(400, dtype=float))
    pdf = pd.DataFrame({"x": vals})
    df = spark.createDataFrame(pdf)
    q = quantile_map(df, ["x"], [0.1, 0.5, 0.9], scale=TINY)
    for p in [0.1, 0.5, 0.9]:
        assert q[("x", p)] == pdf["x"].quantile(p)


def test_all_null_column_is_absent(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert quantile_map(df, ["x"], [0.5]) == {}


def test_mode_ties_to_smallest(spark):
    df = spark.createDataFrame([(3.0, "b"), (1.0, "a"), (3.0, "a"), (1.0, "b"), (None, None)], "x double, s string")
    assert mode_values(df, ["x", "s"]) == {"x": 1.0, "s": "a"}


def test_bad_probability(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    with pytest.raises(ValueError):
        exact_quantiles(df, ["x"], [1.5])


def test_hot_group_few_distinct_values_direct(spark):
    # 3,000 rows, one group holds two thirds, only 12 distinct values: exact in
    # one pass even with a bound of 40 values per group.
    rng = np.random.default_rng(9)
    g = np.where(np.arange(3000) < 2000, "hot", rng.choice(["a", "b"], size=3000))
    x = rng.integers(0, 12, size=3000).astype(float)
    pdf = pd.DataFrame({"g": g, "x": x})
    out = exact_quantiles(spark.createDataFrame(pdf), ["x"], [0.1, 0.25, 0.5, 0.9], by=["g"], scale=TINY).toPandas()
    for _, r in out.iterrows():
        assert r["value"] == pdf.loc[pdf.g == r["g"], "x"].quantile(r["prob"])
    med = exact_quantiles(spark.createDataFrame(pdf), ["x"], [0.5], by=["g"], scale=TINY, kind="median").toPandas()
    for _, r in med.iterrows():
        assert r["value"] == pdf.loc[pdf.g == r["g"], "x"].median()


def test_mixed_paths_in_one_call(spark):
    # group "few": 600 rows, 5 distinct values (duplicate-combined path);
    # group "many": 300 rows, ~300 distinct values (refinement) under TINY.
    rng = np.random.default_rng(21)
    few = pd.DataFrame({"g": "few", "x": rng.integers(0, 5, 600).astype(float)})
    many = pd.DataFrame({"g": "many", "x": np.round(rng.normal(0, 1, 300), 6)})
    pdf = pd.concat([few, many], ignore_index=True)
    out = exact_quantiles(spark.createDataFrame(pdf), ["x"], [0.25, 0.5, 0.75], by=["g"], scale=TINY).toPandas()
    assert len(out) == 6
    for _, r in out.iterrows():
        assert r["value"] == pdf.loc[pdf.g == r["g"], "x"].quantile(r["prob"])
