"""Quantiles of whole columns from sketch brackets, against pandas."""

import dataclasses

import numpy as np
import pandas as pd
import pytest

from hearth.config import SCALE
from hearth.operators import brackets as B
from hearth.operators import quality, quantiles

LARGE = dataclasses.replace(SCALE, exact_direct_max=1)
TIGHT = dataclasses.replace(LARGE, refine_collect_max=40)
PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.fixture(scope="module")
def columns():
    rng = np.random.default_rng(11)
    n = 20_000
    return pd.DataFrame(
        {
            "even": rng.uniform(-5, 5, n),
            "wide": rng.lognormal(0, 12, n) * rng.choice([-1, 1], n),
            "tied": rng.choice([1.0, 2.0, 3.0, 1e9], n, p=[0.4, 0.35, 0.2, 0.05]),
            "ends": np.where(rng.random(n) < 0.4, rng.choice([-np.inf, np.inf], n), rng.normal(size=n)),
            "few": np.where(np.arange(n) < 7, np.arange(n) * 1.5, np.nan),
            "none": np.full(n, np.nan),
        }
    )


def _expected(columns, c, p):
    if c != "ends":
        return columns[c].dropna().quantile(p)
    x = np.sort(columns[c])  # pandas has no quantile where both order statistics are the same infinity
    at = (len(x) - 1) * quantiles.pandas_q(p)
    return quantiles.combine(float(x[int(np.floor(at))]), float(x[int(np.ceil(at))]), at - np.floor(at))


@pytest.mark.parametrize("scale", [LARGE, TIGHT])
def test_same_bits_as_pandas(spark, columns, scale):
    df = spark.createDataFrame(columns).repartition(5)
    got = quantiles.quantile_map(df, list(columns), PROBS, scale)
    assert {c for c, _ in got} == set(columns) - {"none"}
    for (c, p), value in got.items():
        want = _expected(columns, c, p)
        assert value == want or (np.isnan(value) and np.isnan(want)), (c, p)
    mid = quantiles.medians(df, ["even", "tied", "few"], scale)
    assert mid == {c: columns[c].median() for c in mid}


def test_counts_decide_not_the_sketch(spark, columns, monkeypatch):
    df = spark.createDataFrame(columns[["even"]]).repartition(3)
    wrong = {("even", 0.25): B.Bracket(4.0, 4.5, 10.0), ("even", 0.75): B.Bracket(-9.0, -8.0, 10.0)}
    found = B.finish(df, wrong, TIGHT)
    for q in (0.25, 0.75):
        f = found["even", q]
        assert quantiles.combine(f.low, f.high, f.fraction) == columns["even"].quantile(q)


def test_two_passes_for_all_columns(spark, columns, monkeypatch):
    ran = []
    merged = B.merged
    monkeypatch.setattr(B, "merged", lambda *a: ran.append(1) or merged(*a))
    df = spark.createDataFrame(columns[["even", "wide", "tied"]])
    quantiles.quantile_map(df, ["even", "wide", "tied"], PROBS, LARGE)
    assert len(ran) == 2


@pytest.mark.parametrize("scale", [LARGE, TIGHT])
def test_sequential_bounds(spark, scale, monkeypatch):
    rng = np.random.default_rng(5)
    n = 30_000
    base = rng.normal(size=n)
    pdf = pd.DataFrame({f"c{i}": base * i + rng.standard_t(2, n) for i in range(5)})
    pdf.loc[rng.random(n) < 0.02, "c2"] = np.nan
    pdf["c4"] = pdf["c4"].round(0)
    ran = []
    merged = B.merged
    monkeypatch.setattr(B, "merged", lambda *a: ran.append(1) or merged(*a))
    _, steps = quality.iqr_bounds_steps(spark.createDataFrame(pdf).repartition(4), list(pdf), 1.5, scale=scale)
    for step in steps:
        x = pdf[step.column].dropna()
        q1, q3 = x.quantile(0.25), x.quantile(0.75)
        assert (step.lower, step.upper) == (q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)), step.column
        pdf = pdf[pdf[step.column].between(step.lower, step.upper)]
    if scale is LARGE:
        assert len(ran) == len(steps) + 1  # one pass a column, one for the first brackets


def test_empty_table(spark):
    df = spark.createDataFrame([], "x double, y double")
    assert quantiles.quantile_map(df, ["x", "y"], [0.5]) == {}
    out, steps = quality.iqr_bounds_steps(df, ["x", "y"])
    assert out.count() == 0 and [s.lower for s in steps] == [None, None]
