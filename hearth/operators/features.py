"""Feature derivation: totals, ratios (median-filled), categories, logs, checks.

The three ratio medians are exact and taken in one shared job; everything
else is a projection that stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth import config
from hearth.config import SCALE, Scale
from hearth.functions.columns import bin_label, cap_upper, half_even, isclose, require_columns, safe_ratio
from hearth.operators.quantiles import medians

# name -> (numerator, denominator, upper cap or None)
RATIOS: dict[str, tuple[str, str, float | None]] = {
    "rooms_per_household": ("total_rooms", "households", None),
    "bedrooms_per_room": ("total_bedrooms", "total_rooms", 1.0),
    "population_per_household": ("population", "households", None),
}


def derive_totals(avg: DataFrame, key: str | None = config.KEY) -> DataFrame:
    """Per-household averages back to totals, target scaled to currency units.

    households = rint(population / avg_occupancy), then
    total_rooms = rint(avg_rooms * households), same for bedrooms (half-even).
    An occupancy of zero leaves households and the two totals NULL.
    """
    require_columns(avg, ["avg_rooms", "avg_bedrooms", "avg_occupancy", "population", config.TARGET])
    households = half_even(safe_ratio("population", "avg_occupancy"))
    out = (
        avg.withColumn(config.TARGET, F.col(config.TARGET) * 100000)
        .withColumn("households", households)
        .withColumn("total_rooms", half_even(F.col("avg_rooms") * F.col("households")))
        .withColumn("total_bedrooms", half_even(F.col("avg_bedrooms") * F.col("households")))
        .drop("avg_rooms", "avg_bedrooms", "avg_occupancy")
    )
    keep = ([key] if key and key in avg.columns else []) + list(config.RAW_COLUMNS)
    return out.select(*keep)


def ratio_medians(df: DataFrame, names: Sequence[str] = tuple(RATIOS), scale: Scale = SCALE, max_rows: int | None = None) -> dict:
    """{ratio: its exact median over the table}, all in one job (absent where the ratio has no value)."""
    ratios = df.select(*[safe_ratio(RATIOS[n][0], RATIOS[n][1]).alias(n) for n in names])
    return medians(ratios, list(names), scale, max_rows=max_rows) if names else {}


def with_ratios(
    df: DataFrame,
    names: Sequence[str] = tuple(RATIOS),
    fill: dict | None = None,
    scale: Scale = SCALE,
    max_rows: int | None = None,
) -> DataFrame:
    """Add ratio features; a zero or missing denominator (or missing numerator)
    gives the ratio's exact median over the table; bedrooms_per_room is then
    capped at 1.0 (the median is taken before the cap).

    ``fill`` supplies the medians (e.g. fitted ones); else one job computes
    all requested medians together (``max_rows``: a known bound on the rows,
    see ``exact_quantiles``).
    """
    for n in names:
        if n not in RATIOS:
            raise ValueError(f"Unknown ratio feature: {n}")
        require_columns(df, RATIOS[n][:2])
    raw = df.select("*", *[safe_ratio(RATIOS[n][0], RATIOS[n][1]).alias(n) for n in names]) if names else df
    if fill is None:
        fill = ratio_medians(df, names, scale, max_rows)
    cols = []
    for c in raw.columns:
        if c in names:
            filled = F.coalesce(F.col(c), F.lit(fill.get(c)).cast("double"))
            cap = RATIOS[c][2]
            cols.append((cap_upper(filled, cap) if cap is not None else filled).alias(c))
        else:
            cols.append(F.col(c))
    return raw.select(*cols)


def rooms_per_household(df: DataFrame, scale: Scale = SCALE) -> DataFrame:
    return with_ratios(df, ["rooms_per_household"], scale=scale)


def bedrooms_per_room(df: DataFrame, scale: Scale = SCALE) -> DataFrame:
    return with_ratios(df, ["bedrooms_per_room"], scale=scale)


def population_per_household(df: DataFrame, scale: Scale = SCALE) -> DataFrame:
    return with_ratios(df, ["population_per_household"], scale=scale)


def income_category(df: DataFrame, column: str = "median_income", out: str = "income_category") -> DataFrame:
    """First income bin with lo <= x < hi; negative or missing -> very_high."""
    require_columns(df, [column])
    return df.withColumn(out, bin_label(column, config.INCOME_BINS, config.INCOME_DEFAULT))


def age_category(df: DataFrame, column: str = "housing_median_age", out: str = "age_category") -> DataFrame:
    """First age bin with lo <= x < hi; negative or missing -> old."""
    require_columns(df, [column])
    return df.withColumn(out, bin_label(column, config.AGE_BINS, config.AGE_DEFAULT))


def log_features(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """log_<c> = log1p(c) for each present column (absent ones are skipped).

    log1p of a value <= -1 is NULL here (numpy gives -inf / NaN).
    """
    columns = config.LOG_COLUMNS if columns is None else columns
    present = [c for c in columns if c in df.columns]
    return df.withColumns({f"log_{c}": F.log1p(F.col(c)) for c in present}) if present else df


def all_features(
    df: DataFrame, include_log: bool = False, fill: dict | None = None, scale: Scale = SCALE, max_rows: int | None = None
) -> DataFrame:
    """Ratios (one shared median job), income and age categories, optional logs."""
    out = with_ratios(df, tuple(RATIOS), fill=fill, scale=scale, max_rows=max_rows)
    out = age_category(income_category(out))
    return log_features(out) if include_log else out


def validate_features(df: DataFrame, expected: Sequence[str] = config.DERIVED_FEATURES) -> tuple[DataFrame, bool]:
    """Feature report as rows (check, feature, count) and the overall flag.

    Rows: ``missing`` for each absent feature (count 1), ``nulls`` for each
    present feature with nulls, ``out_of_range`` when bedrooms_per_room has
    values outside [0, 1]. ``valid`` is false on missing features or nulls
    only; a range problem alone does not clear it. One aggregate job.
    """
    spark = df.sparkSession
    present = [f for f in expected if f in df.columns]
    missing = [f for f in expected if f not in df.columns]
    aggs = [F.count_if(F.col(f).isNull()).alias(f"n__{f}") for f in present]
    has_bpr = "bedrooms_per_room" in df.columns
    if has_bpr:
        b = F.col("bedrooms_per_room")
        aggs.append(F.count_if((b < 0) | (b > 1.0)).alias("range__bedrooms_per_room"))
    counts = df.agg(*aggs).first().asDict() if aggs else {}
    rows = [("missing", f, 1) for f in missing]
    rows += [("nulls", f, int(counts[f"n__{f}"])) for f in present if counts[f"n__{f}"] > 0]
    if has_bpr and counts["range__bedrooms_per_room"] > 0:
        rows.append(("out_of_range", "bedrooms_per_room", int(counts["range__bedrooms_per_room"])))
    valid = not missing and not any(r[0] == "nulls" for r in rows)
    report = spark.createDataFrame(rows, "check string, feature string, count bigint")
    return report, valid


def feature_checks(df: DataFrame, expected: Sequence[str] = config.DERIVED_FEATURES) -> DataFrame:
    """The same checks as a lazy one-row-per-check table (zero counts kept).

    (check, feature, count): nulls per present feature, out_of_range for
    bedrooms_per_room, missing (0/1) per expected feature.
    """
    present = [f for f in expected if f in df.columns]
    parts = [F.struct(F.lit("nulls").alias("check"), F.lit(f).alias("feature"), F.count_if(F.col(f).isNull()).alias("count")) for f in present]
    if "bedrooms_per_room" in df.columns:
        b = F.col("bedrooms_per_room")
        parts.append(F.struct(F.lit("out_of_range").alias("check"), F.lit("bedrooms_per_room").alias("feature"), F.count_if((b < 0) | (b > 1.0)).alias("count")))
    for f in expected:
        parts.append(F.struct(F.lit("missing").alias("check"), F.lit(f).alias("feature"), F.lit(0 if f in df.columns else 1).cast("bigint").alias("count")))
    return df.agg(F.array(*parts).alias("a")).select(F.inline("a"))


def ratio_recheck(df: DataFrame, rtol: float = config.ISCLOSE_RTOL, atol: float = config.ISCLOSE_ATOL) -> DataFrame:
    """Recompute every stored ratio from its inputs and count the rows that agree.

    (feature, rows, matching, mismatching) with numpy ``isclose`` semantics;
    rows whose recomputation is undefined (zero denominator) count as mismatching.
    """
    present = [n for n in RATIOS if n in df.columns and all(c in df.columns for c in RATIOS[n][:2])]
    parts = []
    for n in present:
        num, den, _ = RATIOS[n]
        ok = isclose(safe_ratio(num, den), F.col(n), rtol, atol)
        parts.append(
            F.struct(
                F.lit(n).alias("feature"),
                F.count(F.lit(1)).alias("rows"),
                F.count_if(ok).alias("matching"),
                F.count_if(~ok).alias("mismatching"),
            )
        )
    if not parts:
        raise ValueError("No stored ratio feature with its inputs present")
    return df.agg(F.array(*parts).alias("a")).select(F.inline("a"))
