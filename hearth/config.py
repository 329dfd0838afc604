"""Fixed values the results depend on, gathered in one place.

Every operator takes its column names and thresholds as parameters; the
defaults below are the district-table conventions.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

# --- fixed values (must stay equal to the analysed application's settings) ---

# Income bins, each [lo, hi); a value that falls in none of them is "very_high".
INCOME_BINS: tuple[tuple[str, float, float], ...] = (
    ("low", 0.0, 2.5),
    ("medium", 2.5, 4.5),
    ("high", 4.5, 6.0),
    ("very_high", 6.0, float("inf")),
)
INCOME_DEFAULT = "very_high"

# Age bins, each [lo, hi); a value that falls in none of them is "old".
AGE_BINS: tuple[tuple[str, float, float], ...] = (
    ("new", 0.0, 10.0),
    ("medium", 10.0, 30.0),
    ("old", 30.0, float("inf")),
)
AGE_DEFAULT = "old"

TARGET = "median_house_value"
KEY = "district_id"

# Raw schema, in order.
RAW_COLUMNS: tuple[str, ...] = (
    "longitude",
    "latitude",
    "housing_median_age",
    "total_rooms",
    "total_bedrooms",
    "population",
    "households",
    "median_income",
    "median_house_value",
)

# Base inputs a scoring record must carry.
BASE_FEATURES: tuple[str, ...] = RAW_COLUMNS[:-1]

# Model features, in order.
FEATURE_COLUMNS: tuple[str, ...] = (
    "longitude",
    "latitude",
    "housing_median_age",
    "total_rooms",
    "total_bedrooms",
    "population",
    "households",
    "median_income",
    "rooms_per_household",
    "bedrooms_per_room",
    "population_per_household",
)

# Derived features checked by feature validation.
DERIVED_FEATURES: tuple[str, ...] = (
    "rooms_per_household",
    "bedrooms_per_room",
    "population_per_household",
    "income_category",
    "age_category",
)

# Columns that get a log1p feature by default.
LOG_COLUMNS: tuple[str, ...] = ("total_rooms", "total_bedrooms", "population", "households")

# Columns shown in the pair view, and its hue.
PAIR_COLUMNS: tuple[str, ...] = ("median_income", "median_house_value", "housing_median_age", "rooms_per_household")
PAIR_HUE = "income_category"

# Columns of the density view.
DENSITY_COLUMNS: tuple[str, ...] = ("median_income", "rooms_per_household", "population_per_household")

# Outliers, imputation, split.
OUTLIER_METHOD = "iqr"
OUTLIER_THRESHOLD = 1.5
IMPUTE_STRATEGY = "median"
TEST_SIZE = 0.2
SEED = 42

# Dashboard slider bounds.
MIN_LONGITUDE, MAX_LONGITUDE = -124.35, -114.31
MIN_LATITUDE, MAX_LATITUDE = 32.54, 41.95
MIN_HOUSING_AGE, MAX_HOUSING_AGE = 1, 52
MIN_INCOME, MAX_INCOME = 0.5, 15.0

# Scoring-input rules, first failure wins (checked in this order); the wording is our own.
INPUT_RULE_MESSAGES: tuple[str, ...] = (
    "Longitude should be negative",
    "Latitude should be between 32 and 42",
    "total_rooms must be positive",
    "total_bedrooms must be positive",
    "population must be positive",
    "households must be positive",
    "Housing median age should be between 0 and 100",
    "Median income must be positive",
)

# Numeric closeness used by the ratio re-check (numpy isclose defaults).
ISCLOSE_RTOL = 1e-5
ISCLOSE_ATOL = 1e-8

# --- end of fixed values ---


@dataclass(frozen=True)
class Scale:
    """Knobs that bound memory per task; none of them changes a result.

    exact_direct_max: most distinct values a group may have for its exact
        quantiles to be read from one running sum over its (value, count)
        pairs in one task; groups with more are narrowed by histogram
        refinement first.
    refine_buckets: buckets per refinement pass.
    refine_collect_max: a refined value range is gathered (per group, sorted)
        once it holds at most this many rows.
    broadcast_max_bytes: a side of a join is broadcast only if it was written in
        at most this many bytes.
    """

    exact_direct_max: int = 1_000_000
    refine_buckets: int = 4096
    refine_collect_max: int = 100_000
    broadcast_max_bytes: int = 32 << 20


#: HEARTH_EXACT_DIRECT_MAX lowers the first bound, so that small tables take the path of large ones (bench.py uses it).
SCALE = Scale(exact_direct_max=int(os.environ.get("HEARTH_EXACT_DIRECT_MAX", Scale.exact_direct_max)))
