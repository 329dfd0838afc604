"""Projections, filters, the summary aggregate and join, SQL surface, row changes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth import config
from hearth.config import SCALE, Scale
from hearth.functions.columns import numeric_columns, require_columns
from hearth.operators.joins import sized_broadcast

JOIN_COLUMNS = (
    "longitude",
    "latitude",
    "median_income",
    "median_house_value",
    "income_category",
    "rooms_per_household",
)


def project_rename(df: DataFrame, columns: Sequence[str], rename: Mapping[str, str] | None = None) -> DataFrame:
    """Column subset in the given order, then renamed."""
    require_columns(df, columns)
    out = df.select(*columns)
    return out.withColumnsRenamed(dict(rename)) if rename else out


def select_numeric(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """All numeric columns (schema order), minus ``exclude``."""
    return df.select(*numeric_columns(df, exclude))


def filter_by_income(df: DataFrame, min_income: float, max_income: float, column: str = "median_income") -> DataFrame:
    """lo <= income <= hi (both inclusive); pushed down to the scan."""
    return df.filter(F.col(column).between(F.lit(float(min_income)), F.lit(float(max_income))))


def filter_by_location(df: DataFrame, min_lat: float, max_lat: float, min_lon: float, max_lon: float) -> DataFrame:
    """Inclusive bounding box."""
    return df.filter(
        F.col("latitude").between(F.lit(float(min_lat)), F.lit(float(max_lat)))
        & F.col("longitude").between(F.lit(float(min_lon)), F.lit(float(max_lon)))
    )


def range_bounds(df: DataFrame, ranges: Mapping[str, tuple | None]) -> dict[str, tuple[float, float]]:
    """Bounds per column; a missing bound defaults to the column's min / max (one job)."""
    need = [c for c, r in ranges.items() if r is None or r[0] is None or r[1] is None]
    mm = {}
    if need:
        row = df.agg(*[F.min(c).alias(f"lo_{c}") for c in need], *[F.max(c).alias(f"hi_{c}") for c in need]).first()
        mm = {c: (row[f"lo_{c}"], row[f"hi_{c}"]) for c in need}
    out = {}
    for c, r in ranges.items():
        lo = r[0] if r is not None and r[0] is not None else mm[c][0]
        hi = r[1] if r is not None and r[1] is not None else mm[c][1]
        out[c] = (lo, hi)
    return out


def range_filter(df: DataFrame, ranges: Mapping[str, tuple | None]) -> DataFrame:
    """Inclusive filter on several columns with data-derived default bounds."""
    cond = F.lit(True)
    for c, (lo, hi) in range_bounds(df, ranges).items():
        cond = cond & F.col(c).between(F.lit(lo), F.lit(hi))
    return df.filter(cond)


def range_filter_counts(df: DataFrame, ranges: Mapping[str, tuple | None]) -> DataFrame:
    """One row (shown, total): the "n of N" line, in one aggregate."""
    cond = F.lit(True)
    for c, (lo, hi) in range_bounds(df, ranges).items():
        cond = cond & F.col(c).between(F.lit(lo), F.lit(hi))
    return df.agg(F.count_if(F.coalesce(cond, F.lit(False))).alias("shown"), F.count(F.lit(1)).alias("total"))


def head_rows(df: DataFrame, n: int = 5, key: str = config.KEY) -> DataFrame:
    """First n rows by key (a distributed top-n, no total sort)."""
    return df.orderBy(F.col(key).asc()).limit(n)


def tail_rows(df: DataFrame, n: int = 5, key: str = config.KEY) -> DataFrame:
    """Last n rows by key, returned in key order."""
    return df.orderBy(F.col(key).desc()).limit(n).orderBy(F.col(key).asc())


def aggregate_by_income_category(df: DataFrame, category: str = "income_category") -> DataFrame:
    """Per non-null category: mean value, mean rooms/household, mean age, count;
    highest mean value first. Partial aggregation map-side, one small shuffle."""
    return (
        df.filter(F.col(category).isNotNull())
        .groupBy(category)
        .agg(
            F.avg(config.TARGET).alias("avg_house_value"),
            F.avg("rooms_per_household").alias("avg_rooms_per_household"),
            F.avg("housing_median_age").alias("avg_age"),
            F.count(F.lit(1)).alias("count_districts"),
        )
        .orderBy(F.col("avg_house_value").desc())
    )


def district_summary(df: DataFrame) -> DataFrame:
    """The summary table: the category aggregate with two columns renamed."""
    return aggregate_by_income_category(df).select(
        "income_category",
        "avg_house_value",
        F.col("avg_rooms_per_household").alias("avg_rooms"),
        "avg_age",
        F.col("count_districts").alias("district_count"),
    )


def join_with_summary(
    housing: DataFrame,
    summary: DataFrame,
    limit: int | None = 100,
    key: str = config.KEY,
    scale: Scale = SCALE,
) -> DataFrame:
    """Each district with its category's summary (inner equi-join on the category).

    The summary side has one row per category; it is broadcast only after its
    size is checked. Rows are returned in key order, the first ``limit``
    (None: all) - a TakeOrderedAndProject, never a full sort.
    """
    side = sized_broadcast(
        summary.select(
            "income_category",
            F.col("avg_house_value").alias("district_avg_value"),
            F.col("avg_rooms").alias("district_avg_rooms"),
            "district_count",
        ),
        scale.broadcast_max_bytes,
    )
    out = housing.select(F.col(key).alias("id"), *JOIN_COLUMNS).join(side, "income_category").select(
        "id", *JOIN_COLUMNS, "district_avg_value", "district_avg_rooms", "district_count"
    )
    return out.orderBy("id").limit(limit) if limit is not None else out


def custom_sql(spark: SparkSession, query: str, params: Sequence | Mapping | None = None) -> DataFrame:
    """Arbitrary SQL over registered views with positional ``?`` (or named) parameters."""
    if params is None:
        return spark.sql(query)
    return spark.sql(query, args=list(params) if not isinstance(params, Mapping) else dict(params))


def update_rows(
    df: DataFrame,
    changes: DataFrame,
    column: str,
    key: str = config.KEY,
    scale: Scale = SCALE,
) -> DataFrame:
    """Set ``column`` to the change table's ``new_value`` for matching keys.

    Set-based: a left join on the key (change table broadcast when its size
    is bounded) and a conditional. Of several changes for one key the largest
    non-null ``new_value`` wins, so rows are never multiplied; changes without
    a key match nothing.
    """
    require_columns(changes, [key, "new_value"])
    one = changes.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max("new_value").alias("new_value"), F.lit(True).alias("__hit"))
    side = sized_broadcast(one, scale.broadcast_max_bytes)
    j = df.join(side, key, "left")
    dt = df.schema[column].dataType
    return j.select(
        *[
            (F.when(F.col("__hit"), F.col("new_value").cast(dt)).otherwise(F.col(c)).alias(c) if c == column else F.col(c))
            for c in df.columns
        ]
    )


def delete_rows(df: DataFrame, keys: DataFrame, key: str = config.KEY, scale: Scale = SCALE) -> DataFrame:
    """Remove the rows whose key is in ``keys`` (anti join)."""
    return df.join(sized_broadcast(keys.select(key).distinct(), scale.broadcast_max_bytes), key, "left_anti")


def matched_changes(df: DataFrame, keys: DataFrame, key: str = config.KEY) -> DataFrame:
    """(key, matched): whether a row exists for each distinct change key."""
    hits = df.select(F.col(key)).distinct().withColumn("matched", F.lit(True))
    return keys.select(key).distinct().join(hits, key, "left").select(key, F.coalesce("matched", F.lit(False)).alias("matched"))


def matched_keys(df: DataFrame, keys: DataFrame, key: str = config.KEY) -> int:
    """How many change keys find a row (the 'a row matched' signal, per key)."""
    return keys.select(key).distinct().join(df.select(key), key, "left_semi").count()
