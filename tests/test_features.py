import math

import pytest

from hearth.operators import features as FE


def _rows(df, key="id"):
    return {r[key]: r for r in df.collect()}


def test_ratios_zero_denominators_and_cap(spark):
    df = spark.createDataFrame(
        [(1, 10.0, 2.0, 20.0, 5.0), (2, 0.0, 1.0, 8.0, 0.0), (3, 4.0, 8.0, 12.0, 4.0), (4, 6.0, None, 9.0, 3.0)],
        "id int, total_rooms double, total_bedrooms double, population double, households double",
    )
    out = _rows(FE.with_ratios(df))
    # rooms/households: 2.0, NULL (0 hh), 1.0, 2.0 -> median of [2, 1, 2] = 2
    assert out[1]["rooms_per_household"] == 2.0
    assert out[2]["rooms_per_household"] == 2.0
    # bedrooms/rooms: 0.2, NULL (0 rooms), 2.0, NULL -> median 1.1 taken before the cap; 2.0 capped to 1.0
    assert out[3]["bedrooms_per_room"] == 1.0
    assert out[2]["bedrooms_per_room"] == 1.0 and out[4]["bedrooms_per_room"] == 1.0
    assert out[1]["bedrooms_per_room"] == pytest.approx(0.2)
    # population/households: 4, NULL, 3, 3 -> median 3
    assert out[2]["population_per_household"] == 3.0


@pytest.mark.parametrize(
    "income,cat",
    [(0.0, "low"), (2.4999, "low"), (2.5, "medium"), (4.5, "high"), (6.0, "very_high"), (-1.0, "very_high"), (None, "very_high")],
)
def test_income_bins(spark, income, cat):
    df = spark.createDataFrame([(income,)], "median_income double")
    assert FE.income_category(df).first()["income_category"] == cat


@pytest.mark.parametrize("age,cat", [(0.0, "new"), (9.99, "new"), (10.0, "medium"), (30.0, "old"), (-5.0, "old"), (None, "old")])
def test_age_bins(spark, age, cat):
    df = spark.createDataFrame([(age,)], "housing_median_age double")
    assert FE.age_category(df).first()["age_category"] == cat


def test_log_features_skip_absent_and_null_on_minus_one(spark):
    df = spark.createDataFrame([(0.0, -1.0)], "total_rooms double, population double")
    out = FE.log_features(df).first()
    assert out["log_total_rooms"] == 0.0 and out["log_population"] is None
    assert "log_households" not in out.asDict()


def test_derive_totals_half_even(spark):
    df = spark.createDataFrame(
        [(1, 3.0, 10.0, 2.5, 0.5, 10.0, 4.0, 37.0, -122.0, 1.5)],
        "district_id int, median_income double, housing_median_age double, avg_rooms double, avg_bedrooms double, "
        "population double, avg_occupancy double, latitude double, longitude double, median_house_value double",
    )
    r = FE.derive_totals(df).first()
    assert r["households"] == 2.0  # rint(2.5) = 2 (half to even)
    assert r["total_rooms"] == 5.0 and r["total_bedrooms"] == 1.0
    assert r["median_house_value"] == 150000.0
    assert list(FE.derive_totals(df).columns)[:3] == ["district_id", "longitude", "latitude"]


def test_validate_features(spark):
    df = spark.createDataFrame([(0.5, None, 1.5)], "rooms_per_household double, population_per_household double, bedrooms_per_room double")
    report, valid = FE.validate_features(df)
    rows = {(r["check"], r["feature"]): r["count"] for r in report.collect()}
    assert rows[("missing", "income_category")] == 1
    assert rows[("nulls", "population_per_household")] == 1
    assert rows[("out_of_range", "bedrooms_per_room")] == 1
    assert valid is False


def test_ratio_recheck(spark):
    df = spark.createDataFrame([(10.0, 4.0, 2.5), (10.0, 0.0, 2.5), (9.0, 3.0, 3.0000001)], "total_rooms double, households double, rooms_per_household double")
    r = FE.ratio_recheck(df).first()
    assert (r["rows"], r["matching"], r["mismatching"]) == (3, 2, 1)
    assert not math.isnan(r["rows"])


def test_nan_inputs_are_missing_for_ratios(spark):
    df = spark.createDataFrame(
        [(1, float("nan"), 2.0, 2.0, 1.0), (2, 4.0, 2.0, 2.0, 2.0), (3, 8.0, 2.0, 2.0, 2.0)],
        "id int, total_rooms double, total_bedrooms double, population double, households double",
    )
    out = {r["id"]: r for r in FE.with_ratios(df).collect()}
    assert out[1]["rooms_per_household"] == 3.0  # median of [2, 4]
