"""Exact quantiles and modes that stay bounded per task.

An exact quantile of a group needs that group's values in one place, which
is fine for a group of bounded size and wrong for a group holding a third
of 100 TB (Spark's own ``percentile`` merges a map of all distinct values
of a group in one task). So:

* a group of at most ``Scale.exact_direct_max`` rows is sorted in one task;
* a bigger group with at most that many distinct values has its duplicates
  combined first (partial/final count per group and value) and its sorted
  (value, count) pairs scanned once in one task - so a hot group of few
  distinct values (ages, counts) is exact in one pass whatever its size;
* whole columns (no group) of more rows take sketch brackets instead, see ``brackets``;
* groups with more distinct values find the order statistics they need by histogram
  refinement: per pass, the rows inside the current value interval of a
  target are bucketed (``refine_buckets`` equal-width buckets between the
  interval's actual min and max), bucket counts are aggregated with a
  partial/final aggregate, and a running sum over the buckets picks the
  bucket holding the wanted rank. Once an interval holds at most
  ``refine_collect_max`` rows its values are gathered (sorted) and the rank
  is read off; an interval of one distinct value ends at once.

Every pass is a distributed aggregate; only scalars (is anything left?)
reach the driver. Interval tables are checkpointed to keep lineage short.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearth.config import SCALE, Scale
from hearth.functions.columns import nan_to_null
from hearth.operators import brackets
from hearth.operators.joins import sized_broadcast
from hearth.session import materialise, shared_dir

_MAX_PASSES = 64


def long_values(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, x) with x a non-null double, one row per input cell."""
    by = list(by)
    if len(columns) == 1:
        c = columns[0]
        out = df.select(*by, F.lit(c).alias("column"), nan_to_null(F.col(c).cast("double")).alias("x"))
    else:
        cast = df.select(*by, *[nan_to_null(F.col(c).cast("double")).alias(c) for c in columns])
        out = cast.unpivot(by, list(columns), "column", "x")
    return out.filter(F.col("x").isNotNull())


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    scale: Scale = SCALE,
    kind: str = "linear",
    max_rows: int | None = None,
) -> DataFrame:
    """Exact quantiles: (by..., column, prob, value, n).

    ``max_rows``: a known upper bound on the rows of ``df`` (e.g. a count
    taken already); at most ``exact_direct_max`` skips the size-check job.

    The two order statistics around position p·(n-1) are found exactly and
    combined as pandas does: ``kind="linear"`` is numpy's linear
    interpolation (``Series.quantile``), ``kind="median"`` the midpoint
    (a + b) / 2 of ``Series.median`` (use it with p = 0.5). Groups with no
    non-null value are absent; NULL group keys form their own group.
    """
    probs = [check_probability(p) for p in probs]
    if kind not in ("linear", "median"):
        raise ValueError(f"unknown quantile kind {kind}")
    by = list(by)
    # Group columns get names of their own, so they never clash with the columns used below.
    inner = [f"_by{i}" for i in range(len(by))]
    keys = inner + ["column"]
    values = long_values(df.select(*[F.col(b).alias(i) for b, i in zip(by, inner)], *columns), columns, inner)
    shown = [F.col(i).alias(b) for b, i in zip(by, inner)] + [F.col("column"), F.col("prob"), _combine(kind).alias("value"), F.col("n")]
    if max_rows is not None and max_rows <= scale.exact_direct_max:
        return _direct(values, keys, probs).select(*shown)
    if not by:
        if max_rows is None and df.count() <= scale.exact_direct_max:
            return _direct(values, keys, probs).select(*shown)
        return _whole_columns(df, columns, probs, scale, kind)
    # Per group: rows, range and (approximate, ~2% error) distinct values; the
    # direct path is bounded by distinct values, kept under the bound with margin.
    distinct = F.approx_count_distinct("x", 0.02)
    shared_dir(df.sparkSession)  # checkpoints need the shared folder
    sizes = values.groupBy(*keys).agg(F.count("x").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"), distinct.alias("d")).checkpoint()
    direct_ok = F.col("d") * 1.1 <= F.lit(scale.exact_direct_max)

    widest = sizes.agg(F.max("n"), F.max("d")).first()
    if widest[0] is None:
        return _empty(df, by)
    if widest[0] <= scale.exact_direct_max:
        stats = _direct(values, keys, probs)  # every group fits by rows
    elif widest[1] * 1.1 <= scale.exact_direct_max:
        stats = _direct_weighted(values, keys, probs)  # big groups, few distinct values
    else:
        # Refinement scans the values once per pass: write the narrow
        # (keys, x) form once to the shared folder instead of recomputing it.
        values = materialise(df.sparkSession, values, "quantile-values")
        big = sizes.filter(~direct_ok).select(*keys, "n", "lo", "hi")
        # The big groups are few; dropping them by a broadcast anti-join keeps
        # their rows from being shuffled. NULL keys match NULL keys.
        named = sized_broadcast(big.select(*[F.col(k).alias(f"b_{k}") for k in keys]), scale.broadcast_max_bytes)
        rest = values.join(named, [F.col(k).eqNullSafe(F.col(f"b_{k}")) for k in keys], "left_anti")
        stats = _direct_weighted(rest, keys, probs).unionByName(_refined(values, big, keys, probs, scale))
    return stats.select(*shown)


def _whole_columns(df: DataFrame, columns: Sequence[str], probs: list, scale: Scale, kind: str) -> DataFrame:
    """Quantiles of whole columns from sketch brackets: (column, prob, value, n), columns x probs rows.

    The columns are written once; sketch and counts are passes over what was written."""
    df = materialise(df.sparkSession, brackets.numbers(df, columns), "quantile-columns")
    qs = {pandas_q(p): p for p in probs}
    found = brackets.order_statistics(df, {c: list(qs) for c in columns}, scale)
    rows = [(c, qs[q], combine(f.low, f.high, f.fraction, kind), f.n) for (c, q), f in found.items()]
    return df.sparkSession.createDataFrame(rows, "column string, prob double, value double, n bigint")


def combine(a: float, b: float, t: float, kind: str = "linear") -> float:
    """The quantile between two order statistics, in the floating-point steps of ``_combine``."""
    if kind == "median":
        return (a + b) / 2.0
    if a == b:
        return a
    return a + (b - a) * t if t < 0.5 else b - (b - a) * (1.0 - t)


def pandas_q(p: float) -> float:
    """q as pandas computes it: p·100 is handed to numpy's percentile, which
    divides by 100 again (same floating-point steps, so positions agree to
    the last bit)."""
    return (p * 100.0) / 100.0


def _prob_rows(probs: list):
    """One struct per probability: its label and pandas' q."""
    return F.explode(F.array(*[F.struct(F.lit(p).alias("prob"), F.lit(pandas_q(p)).alias("q")) for p in probs]))


def _positions(n):
    """numpy's linear virtual index (n - 1)·q (0-based), its floor and ceil ranks and fraction."""
    pos = (n - 1).cast("double") * F.col("q")
    return pos, F.floor(pos), F.ceil(pos), pos - F.floor(pos)


def _combine(kind: str):
    a, b, t = F.col("v_lo"), F.col("v_hi"), F.col("frac")
    if kind == "median":
        return (a + b) / F.lit(2.0)
    return F.when(a == b, a).when(t < 0.5, a + (b - a) * t).otherwise(b - (b - a) * (F.lit(1.0) - t))


def quantile_map(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], scale: Scale = SCALE, kind: str = "linear", max_rows: int | None = None
) -> dict:
    """{(column, prob): value} for ungrouped quantiles; bounded by columns × probs."""
    rows = exact_quantiles(df, columns, probs, scale=scale, kind=kind, max_rows=max_rows).collect()
    return {(r["column"], r["prob"]): r["value"] for r in rows}


def medians(df: DataFrame, columns: Sequence[str], scale: Scale = SCALE, max_rows: int | None = None) -> dict:
    """{column: exact median} (absent when the column has no value)."""
    return {c: v for (c, _), v in quantile_map(df, columns, [0.5], scale, kind="median", max_rows=max_rows).items()}


def _empty(df: DataFrame, by: list) -> DataFrame:
    spark = df.sparkSession
    fields = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name in by])
    schema = (fields + ", " if fields else "") + "column string, prob double, value double, n bigint"
    return spark.createDataFrame([], schema)


def _direct(values: DataFrame, keys: list, probs: list) -> DataFrame:
    """Order statistics of groups with a bounded number of rows:
    (keys, prob, v_lo, v_hi, frac, n). Each group's values are sorted in one
    task (at most ``exact_direct_max`` of them, checked by the caller)."""
    agg = values.groupBy(*keys).agg(F.sort_array(F.collect_list("x")).alias("xs"), F.count("x").alias("n"))
    per_prob = agg.select("*", _prob_rows(probs).alias("pq")).select("*", "pq.*").drop("pq")
    _, lo, hi, frac = _positions(F.col("n"))
    return per_prob.select(
        *keys,
        "prob",
        F.element_at("xs", (lo + 1).cast("int")).alias("v_lo"),
        F.element_at("xs", (hi + 1).cast("int")).alias("v_hi"),
        frac.alias("frac"),
        "n",
    )


def _pick(pairs, k):
    """Value holding 0-based rank ``k`` in a sorted array of (x, w) pairs: one
    pass with a constant-size state (running count, found value)."""
    init = F.struct(F.lit(0).cast("bigint").alias("acc"), F.lit(None).cast("double").alias("v"))
    return F.aggregate(
        pairs,
        init,
        lambda s, e: F.struct((s["acc"] + e["w"]).alias("acc"), F.coalesce(s["v"], F.when(s["acc"] + e["w"] > k, e["x"])).alias("v")),
        lambda s: s["v"],
    )


def _direct_weighted(values: DataFrame, keys: list, probs: list) -> DataFrame:
    """Order statistics of groups with a bounded number of *distinct* values.

    Duplicates are combined first (a partial/final count per (group, value)),
    so a group's task holds at most its distinct values as sorted
    (value, count) pairs - however many rows the group has.
    """
    weights = values.groupBy(*keys, "x").agg(F.count(F.lit(1)).alias("w"))
    agg = weights.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("x", "w"))).alias("xs"), F.sum("w").alias("n"))
    per_prob = agg.select("*", _prob_rows(probs).alias("pq")).select("*", "pq.*").drop("pq")
    _, lo, hi, frac = _positions(F.col("n"))
    return per_prob.select(*keys, "prob", _pick(F.col("xs"), lo).alias("v_lo"), _pick(F.col("xs"), hi).alias("v_hi"), frac.alias("frac"), "n")


#: An interval wider than this many powers of two is cut by magnitude, not linearly.
_WIDE = 16.0


def _magnitude(x):
    """A weakly increasing map of all doubles to [-2200, 2200]: sign and binary
    logarithm (at least 1 apart from zero), infinities at the ends."""
    size = F.least(F.log2(F.abs(x)) + F.lit(1080.0), F.lit(2200.0))
    return F.when(x == 0, F.lit(0.0)).when(x > 0, size).otherwise(-size)


def _share(x, lo, hi):
    """Where x lies in [lo, hi], as 0..1: by magnitude over wide intervals (any
    range, infinities included), linearly over narrow ones. Either way a bucket
    is a small part of its interval, so few passes reach single values."""
    span = _magnitude(hi) - _magnitude(lo)
    return F.when(span > F.lit(_WIDE), (_magnitude(x) - _magnitude(lo)) / span).otherwise((x - lo) / (hi - lo))


def _refined(values: DataFrame, big: DataFrame, keys: list, probs: list, scale: Scale) -> DataFrame:
    """Order statistics by histogram refinement for groups larger than the direct bound."""
    shared_dir(values.sparkSession)  # checkpoints below need the shared folder
    # The ranks each probability needs (0-based): floor and ceil of p * (n - 1).
    want = big.select("*", _prob_rows(probs).alias("pq")).select("*", "pq.*").drop("pq")
    _, k_lo, k_hi, frac = _positions(F.col("n"))
    want = want.withColumn("k_lo", k_lo).withColumn("k_hi", k_hi).withColumn("frac", frac)
    ranks = (
        want.select(*keys, F.explode(F.array_distinct(F.array("k_lo", "k_hi"))).alias("k0"), "lo", "hi", "n")
        .distinct()
        .select(*keys, "k0", F.col("k0").alias("k"), "lo", "hi", F.col("n").alias("cnt"))
    )
    ranks = ranks.checkpoint()

    done = None
    # (keys, k0, k, lo, hi, cnt): the group's k0-th smallest value is the k-th smallest within [lo, hi]
    state = ranks
    for _ in range(_MAX_PASSES):
        finished = state.filter((F.col("lo") == F.col("hi")) | (F.col("cnt") <= scale.refine_collect_max))
        state = state.filter((F.col("lo") < F.col("hi")) & (F.col("cnt") > scale.refine_collect_max))
        done = finished if done is None else done.unionByName(finished)
        if state.isEmpty():
            break

        intervals = state.select(*[F.col(k).alias(f"g_{k}") for k in keys], F.col("lo").alias("ilo"), F.col("hi").alias("ihi")).distinct()
        inside = _in_interval(values, intervals, keys, scale)  # (keys, x, ilo, ihi)
        bucket = F.least(
            F.floor(_share(F.col("x"), F.col("ilo"), F.col("ihi")) * F.lit(float(scale.refine_buckets))),
            F.lit(scale.refine_buckets - 1),
        )
        hist = inside.groupBy(*keys, "ilo", "ihi", bucket.alias("b")).agg(
            F.count("x").alias("bcnt"), F.min("x").alias("blo"), F.max("x").alias("bhi")
        )
        w = Window.partitionBy(*keys, "ilo", "ihi").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
        hist = hist.withColumn("before", F.coalesce(F.sum("bcnt").over(w), F.lit(0)))
        hist = hist.select(*[F.col(k).alias(f"h_{k}") for k in keys], "ilo", "ihi", "before", "bcnt", "blo", "bhi")
        cond = [F.col(k).eqNullSafe(F.col(f"h_{k}")) for k in keys] + [
            F.col("lo") == F.col("ilo"),
            F.col("hi") == F.col("ihi"),
            F.col("k") >= F.col("before"),
            F.col("k") < F.col("before") + F.col("bcnt"),
        ]
        state = (
            state.join(hist, cond)
            .select(
                *keys,
                "k0",
                (F.col("k") - F.col("before")).alias("k"),
                F.col("blo").alias("lo"),
                F.col("bhi").alias("hi"),
                F.col("bcnt").alias("cnt"),
            )
            .checkpoint()
        )
    else:
        raise RuntimeError("quantile refinement did not converge")

    # Read the ranks off the final intervals.
    single = done.filter(F.col("lo") == F.col("hi")).select(*keys, "k0", F.col("lo").alias("v"))
    multi = done.filter(F.col("lo") < F.col("hi"))
    intervals = multi.select(*[F.col(k).alias(f"g_{k}") for k in keys], F.col("lo").alias("ilo"), F.col("hi").alias("ihi")).distinct()
    gathered = (
        _in_interval(values, intervals, keys, scale)
        .groupBy(*keys, "ilo", "ihi")
        .agg(F.sort_array(F.collect_list("x")).alias("xs"))  # at most refine_collect_max values each
        .select(*[F.col(k).alias(f"h_{k}") for k in keys], "ilo", "ihi", "xs")
    )
    cond = [F.col(k).eqNullSafe(F.col(f"h_{k}")) for k in keys] + [F.col("lo") == F.col("ilo"), F.col("hi") == F.col("ihi")]
    picked = multi.join(gathered, cond).select(*keys, "k0", F.element_at("xs", F.col("k").cast("int") + 1).alias("v"))
    order_stats = single.unionByName(picked)

    lo_v = order_stats.select(*[F.col(k).alias(f"l_{k}") for k in keys], F.col("k0").alias("kl"), F.col("v").alias("v_lo"))
    hi_v = order_stats.select(*[F.col(k).alias(f"u_{k}") for k in keys], F.col("k0").alias("ku"), F.col("v").alias("v_hi"))
    return (
        want.join(lo_v, [F.col(k).eqNullSafe(F.col(f"l_{k}")) for k in keys] + [F.col("k_lo") == F.col("kl")])
        .join(hi_v, [F.col(k).eqNullSafe(F.col(f"u_{k}")) for k in keys] + [F.col("k_hi") == F.col("ku")])
        .select(*keys, "prob", "v_lo", "v_hi", "frac", "n")
    )


def _in_interval(values: DataFrame, intervals: DataFrame, keys: list, scale: Scale) -> DataFrame:
    """Rows of ``values`` inside one of the (disjoint per group) intervals.

    ``intervals`` has columns g_<key>..., ilo, ihi; the result (keys, x, ilo, ihi).
    """
    side = sized_broadcast(intervals, scale.broadcast_max_bytes)
    cond = [F.col(k).eqNullSafe(F.col(f"g_{k}")) for k in keys] + [F.col("x") >= F.col("ilo"), F.col("x") <= F.col("ihi")]
    return values.join(side, cond).select(*keys, "x", "ilo", "ihi")


def mode_values(df: DataFrame, columns: Sequence[str]) -> dict:
    """{column: most frequent non-null value}, ties to the smallest value.

    A distributed count per (column, value) with map-side combining, then a
    per-column ``min(struct(-freq, value))`` aggregate, itself partial/final:
    no column's values are ever gathered in one task; one row per column
    reaches the driver. Numeric columns compare as doubles, others as strings.
    """
    types = dict(df.dtypes)
    numeric = [c for c in columns if types[c] != "string"]
    text = [c for c in columns if types[c] == "string"]
    out: dict = {}
    for group, cast in ((numeric, "double"), (text, "string")):
        if not group:
            continue
        cells = df.select(*[F.col(c).cast(cast).alias(c) for c in group])
        if cast == "double":
            cells = cells.select(*[nan_to_null(c).alias(c) for c in group])
        long = cells.unpivot([], list(group), "column", "value").filter(F.col("value").isNotNull())
        counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("freq"))
        best = counts.groupBy("column").agg(F.min(F.struct((-F.col("freq")).alias("nf"), F.col("value"))).alias("best"))
        for r in best.select("column", "best.value").collect():
            out[r["column"]] = r["value"]
    return out


def check_probability(p: float) -> float:
    if not (isinstance(p, (int, float)) and 0.0 <= p <= 1.0 and not math.isnan(p)):
        raise ValueError(f"invalid probability {p}")
    return float(p)
