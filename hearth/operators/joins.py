"""Join helpers: broadcast only behind a checked size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.session import path_bytes, scratch_path


def sized_broadcast(side: DataFrame, max_bytes: int) -> DataFrame:
    """``side``, written once to the shared folder, and marked for broadcast if
    its files hold at most ``max_bytes`` bytes.

    The side's plan runs once, in parallel, and what is broadcast has a measured
    size; a larger side is left to the planner (sort-merge or shuffled hash
    join, with AQE's skew handling).
    """
    spark = side.sparkSession
    path = scratch_path(spark, "materialised", "join-side")
    side.write.parquet(path)
    written = spark.read.schema(side.schema).parquet(path)
    return F.broadcast(written) if path_bytes(spark, path) <= max_bytes else written
