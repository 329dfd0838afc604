"""Exact order statistics of whole columns, bracketed by mergeable quantile sketches.

A KLL sketch of each column (one aggregate for all columns, merged over salted groups of
tasks before the last merge) gives for every wanted rank a bracket of two values that
holds it with near certainty. One more pass counts exactly what lies below and at the
bracket's ends and gathers what lies strictly inside, a share of about 2 x ERROR of the rows;
where that is more than ``Scale.refine_collect_max``, the inside is sketched instead
and the bracket narrows by the same factor again. Counts decide, not the sketch: a
bracket that misses its rank is widened to all values, so the result is exact whatever
the sketch said. Values equal to a bracket's end are counted, never gathered, so
ties of any number cost nothing.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.config import SCALE, Scale
from hearth.functions.columns import nan_to_null

SKETCH_K = 2048
#: Rank error allowed for, 2.5 times what a sketch of SKETCH_K exceeds once in a hundred times.
ERROR = 0.006
#: Groups of tasks whose sketches are merged before the last merge.
SALTS = 64
#: Quantiles are read off a sketch at the multiples of 1 / GRID (their ranks must be constants).
GRID = 512
_MAX_PASSES = 16
EVERYTHING = (-math.inf, math.inf)


class Found(NamedTuple):
    """The order statistics around a probability's position, the position's fraction, and the column's values."""

    low: float
    high: float
    fraction: float
    n: int


class Bracket(NamedTuple):
    """Two values that should enclose the wanted ranks, and how many values are expected between them."""

    lo: float
    hi: float
    expected: float


def numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as doubles, NaN as missing: worked out once a row, however many aggregates read them."""
    return df.select(*[nan_to_null(F.col(c).cast("double")).alias(c) for c in dict.fromkeys(columns)])


def merged(df: DataFrame, counts: Mapping[str, Column], sketches: Mapping[str, Column], lists: Mapping[str, Column]) -> DataFrame:
    """One row: how often ``counts`` hold, the GRID + 1 quantiles of ``sketches`` (null without values) and the sorted
    ``lists``, of non-null values, in two steps over salted tasks."""
    salted = df.groupBy(F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("__salt")).agg(
        *[F.count_if(c).alias(k) for k, c in counts.items()],
        *[F.kll_sketch_agg_double(c, F.lit(SKETCH_K)).alias(k) for k, c in sketches.items()],
        *[F.collect_list(c).alias(k) for k, c in lists.items()],
    )
    row = salted.agg(
        F.count(F.lit(1)).alias("__groups"),
        *[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in counts],
        *[F.kll_merge_agg_double(k, F.lit(SKETCH_K)).alias(k) for k in sketches],
        *[F.sort_array(F.flatten(F.collect_list(k))).alias(k) for k in lists],
    )
    # one constant that Spark folds, instead of GRID + 1 literals in the plan
    ranks = F.split(F.lit(" ".join(str(i / GRID) for i in range(GRID + 1))), " ").cast("array<double>")
    grids = {k: F.when(F.kll_sketch_get_n_double(k) > 0, F.kll_sketch_get_quantile_double(k, ranks)) for k in sketches}
    return row.withColumns(grids) if grids else row


def between_ranks(grid: Column, size: Column, first: Column, last: Column) -> Column:
    """struct(lo, hi, expected): quantiles out of ``grid``, of ``size`` values, that enclose the 0-based ranks first..last."""
    slack = size * F.lit(ERROR) + F.lit(2.0)
    low = F.floor((first - slack) / size * GRID).cast("int")
    high = F.ceil((last + slack) / size * GRID).cast("int")
    some = size > 0
    return F.struct(
        F.when(some & (low > 0), F.get(grid, low)).otherwise(F.lit(-math.inf)).alias("lo"),
        F.when(some & (high < GRID), F.get(grid, high)).otherwise(F.lit(math.inf)).alias("hi"),
        F.when(some, (F.least(high, F.lit(GRID)) - F.greatest(low, F.lit(0))) * size / F.lit(float(GRID))).otherwise(F.lit(0.0)).alias("expected"),
    )


def brackets(df: DataFrame, wanted: Mapping[str, Sequence[float]]) -> dict[tuple[str, float], Bracket]:
    """First brackets of every (column, q), from one sketch a column."""
    cols = list(wanted)
    row = merged(numbers(df, cols), {f"n{i}": F.col(c).isNotNull() for i, c in enumerate(cols)}, {f"s{i}": F.col(c) for i, c in enumerate(cols)}, {})
    parts = {}
    for i, c in enumerate(cols):
        for j, q in enumerate(wanted[c]):
            at = (F.col(f"n{i}") - 1) * F.lit(q)
            parts[c, q] = between_ranks(F.col(f"s{i}"), F.col(f"n{i}"), at, at).alias(f"b{i}_{j}")
    got = row.select(*parts.values()).first()
    return {key: Bracket(*value) for key, value in zip(parts, got, strict=True)}


class Pass(NamedTuple):
    """What one pass over the rows is to count, sketch and gather, and what is read off its one row."""

    counts: dict
    sketches: dict
    lists: dict
    read: dict


def plan_pass(around: Mapping[tuple[str, float], Bracket], scale: Scale) -> Pass:
    """The pass that counts at, below and inside the brackets, and gathers or sketches the inside."""
    p = Pass({}, {}, {}, {})
    for i, ((c, q), b) in enumerate(around.items()):
        x = F.col(c)
        inside = (x > F.lit(b.lo)) & (x < F.lit(b.hi))
        p.counts.update({f"n{i}": x.isNotNull(), f"below{i}": x < F.lit(b.lo), f"upto{i}": x <= F.lit(b.lo), f"all{i}": x <= F.lit(b.hi)})
        position = (F.col(f"n{i}") - 1).cast("double") * F.lit(q)
        first, last = F.floor(position), F.ceil(position)
        offset = F.col(f"upto{i}")
        reads = [F.col(f"{k}{i}").alias(k) for k in ("n", "below", "upto", "all")]
        if b.expected <= scale.refine_collect_max:
            p.lists[f"xs{i}"] = F.when(inside, x)
            reads.append(F.size(f"xs{i}").cast("bigint").alias("in"))
            pick = lambda k, i=i, offset=offset: F.get(f"xs{i}", (k - offset).cast("int"))
            reads += [pick(first).alias("first"), pick(last).alias("last"), F.lit(None).cast("struct<lo:double,hi:double,expected:double>").alias("next")]
        else:
            p.sketches[f"sk{i}"] = F.when(inside, x)
            p.counts[f"in{i}"] = inside
            reads.append(F.col(f"in{i}").alias("in"))
            none = F.lit(None).cast("double")
            reads += [none.alias("first"), none.alias("last"), between_ranks(F.col(f"sk{i}"), F.col(f"in{i}"), (first - offset).cast("double"), (last - offset).cast("double")).alias("next")]
        p.read[c, q] = F.struct(*reads)
    return p


def settle(row, q: float, b: Bracket) -> Found | Bracket | None:
    """What a pass says of one bracket: the order statistics, a narrower bracket, or None (no values)."""
    n = row["n"]
    if not n:
        return None
    position = float(n - 1) * q
    ranks = (math.floor(position) - row["below"], math.ceil(position) - row["below"])
    at_lo = row["upto"] - row["below"]
    if ranks[0] < 0 or ranks[1] >= row["all"] - row["below"]:
        return Bracket(*EVERYTHING, float(n))  # the bracket misses its rank
    value = []
    for rank, gathered in zip(ranks, (row["first"], row["last"]), strict=True):
        value.append(b.lo if rank < at_lo else b.hi if rank >= at_lo + row["in"] else gathered)
    if None in value:
        narrower = Bracket(*row["next"])
        # ranks on both sides of an end: keep that end
        lo = b.lo if ranks[0] < at_lo else narrower.lo
        hi = b.hi if ranks[1] >= at_lo + row["in"] else narrower.hi
        return Bracket(max(lo, b.lo), min(hi, b.hi), narrower.expected)
    return Found(*value, position - math.floor(position), n)


def run_pass(df: DataFrame, around: Mapping[tuple[str, float], Bracket], scale: Scale, more: Pass | None = None, also: Sequence[str] = ()):
    """({(column, q): Found | Bracket | None}, what ``more`` reads of the columns ``also``) of one pass over ``df``."""
    p = plan_pass(around, scale)
    extra = more or Pass({}, {}, {}, {})
    row = merged(numbers(df, [c for c, _ in around] + list(also)), p.counts | extra.counts, p.sketches | extra.sketches, p.lists | extra.lists)
    reads = [v.alias(f"r{i}") for i, v in enumerate(p.read.values())] + [v.alias(k) for k, v in extra.read.items()]
    got = row.select(*reads).first()
    result = {key: settle(got[f"r{i}"], key[1], around[key]) for i, key in enumerate(p.read)}
    return result, {k: got[k] for k in extra.read}


def finish(df: DataFrame, state: Mapping[tuple[str, float], object], scale: Scale) -> dict[tuple[str, float], Found]:
    """Narrow the brackets that are left until every order statistic is found; columns without values are left out."""
    state = dict(state)
    for _ in range(_MAX_PASSES):
        open_ = {k: b for k, b in state.items() if isinstance(b, Bracket)}
        if not open_:
            return {k: f for k, f in state.items() if f is not None}
        state |= run_pass(df, open_, scale)[0]
    raise RuntimeError("quantile brackets did not converge")


def order_statistics(df: DataFrame, wanted: Mapping[str, Sequence[float]], scale: Scale = SCALE) -> dict[tuple[str, float], Found]:
    """{(column, q): order statistics around q (n - 1)}; two passes up to refine_collect_max / (2 x ERROR) rows."""
    return finish(df, brackets(df, wanted), scale)


def following(c: str, c_brackets: tuple[Bracket, Bracket], after: str, threshold: float, qs: Sequence[float]) -> Pass | None:
    """Brackets of the next column ``after`` among the rows that c's bounds will keep, before those are known.

    c's quartile brackets bound the bounds: some rows are kept for sure, some perhaps. The
    sure ones are sketched, the doubtful ones widen the ranks. None where an end is infinite.
    """
    (a1, b1, _), (a3, b3, _) = c_brackets
    if not all(map(math.isfinite, (a1, b1, a3, b3))):
        return None
    lower = sorted((v1 - threshold * (v3 - v1)) for v1 in (a1, b1) for v3 in (a3, b3))
    upper = sorted((v3 + threshold * (v3 - v1)) for v1 in (a1, b1) for v3 in (a3, b3))
    x, y = F.col(c), F.col(after)
    sure, maybe = x.between(F.lit(lower[-1]), F.lit(upper[0])), x.between(F.lit(lower[0]), F.lit(upper[-1]))
    n_sure, n_maybe = F.col("__sure"), F.col("__maybe")
    reads = {}
    for j, q in enumerate(qs):
        first, last = (n_sure - 1) * F.lit(q) - (n_maybe - n_sure), (n_maybe - 1) * F.lit(q)
        reads[f"__b{j}"] = F.when(n_sure > 0, between_ranks(F.col("__next"), n_sure, first, last))
    return Pass({"__sure": sure & y.isNotNull(), "__maybe": maybe & y.isNotNull()}, {"__next": F.when(sure, y)}, {}, reads)
