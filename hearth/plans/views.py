"""Named tables the queries start from (DataFrames over the districts, which are built and written once a call)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hearth.config import SCALE, Scale
from hearth.operators.features import all_features, ratio_medians
from hearth.operators.relational import district_summary
from hearth.session import materialise
from hearth.sources.fixtures import districts


def district_inputs(spark: SparkSession, sf_dir: str, scale: Scale = SCALE) -> tuple[DataFrame, dict]:
    """The districts and the medians that fill their ratios.

    The districts are written once: sizes, medians, fits, metrics and results are passes over
    what was written, none of which aggregates lineitem and joins orders again.
    """
    rows = materialise(spark, districts(spark, sf_dir), "districts")
    return rows, ratio_medians(rows, scale=scale)


def housing(spark: SparkSession, sf_dir: str, scale: Scale = SCALE) -> DataFrame:
    """The ``housing`` table: districts with the derived features (14 columns + key)."""
    rows, fill = district_inputs(spark, sf_dir, scale)
    return all_features(rows, fill=fill, scale=scale)


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``district_summary`` table."""
    return district_summary(housing(spark, sf_dir))
