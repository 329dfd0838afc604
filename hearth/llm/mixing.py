"""Mixing sources to target sizes by entropy balancing.

Every source has a target number of words. Among all document rates that meet
the targets, entropy balancing takes those of least relative entropy to the
original corpus: the rate of a document of size x in source s is
``min(max_copies, exp(lambda_s * x / mean_s))``, with ``mean_s`` the source's
token-weighted mean size. The convex dual in lambda separates by source; all
sources are solved together by distributed Newton steps (kept inside a
bracketing interval) on the (source, size) histogram of the corpus.

Rates become whole copies by systematic rounding: within a source, documents
are ordered by size and then by a hash, and a document gets an extra copy where
the running sum of the fractional rates passes a whole number; each source
starts the sum at the one of ``PHASES`` fractions that brings its total nearest
the target. The running sum is taken over (source, size, bucket) counts, buckets holding at most about
``BUCKET_ROWS`` rows of a (source, size), so no group of rows is ordered in one task.

Only DataFrame operations are used. Sizes are words separated by blanks
(null text: 0). A null source is a source of its own, ranked last. Rows of size
0 take nothing and get rate 1. Repeated rows are separate documents; equal rows
are interchangeable. Results depend on the rows only, not on their order or
partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearth.llm.common import materialise, row_key

BUCKET_ROWS = 50_000
PHASES = 32


def word_count(text: Column) -> Column:
    """Number of runs of characters other than blank and tab to carriage return."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], max_copies: float) -> DataFrame:
    """(source, source_size) -> also ``target``: shares by repeating weights in code-point order of the
    sources (null last), a share stopping at ``max_copies`` times its source, the excess shared again.

    Shares grow together in proportion to their weights; a source whose cap per
    weight is small stops first. With the sources sorted by that ratio, the
    level reached by the others follows from running sums.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = sizes.withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(float(max_copies))).withColumn("ratio", F.col("cap") / F.col("w"))
    everything = Window.partitionBy()
    by_ratio = Window.orderBy("ratio", F.col("source").isNull(), "source")
    upto = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    level = (
        ranked.withColumn("place", F.row_number().over(by_ratio))
        .withColumn("caps_before", F.coalesce(F.sum("cap").over(upto), F.lit(0.0)))
        .withColumn("w_left", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(upto), F.lit(0.0)))
        .withColumn("level", (F.sum("source_size").over(everything) - F.col("caps_before")) / F.col("w_left"))
    )
    # the first place whose cap is not below the level left by the earlier ones sets the level from there on
    stop = F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("place", "level"))).over(everything)
    reached = level.withColumn("stop", stop)
    shared = F.least(F.col("cap"), F.col("w") * F.col("stop.level"))
    return reached.select("source", "source_size", F.when(F.col("place") < F.col("stop.place"), F.col("cap")).otherwise(shared).alias("target"))


def capped_rate(lam: Column, scaled: Column, max_copies: float) -> Column:
    return F.least(F.lit(float(max_copies)), F.exp(F.least(lam * scaled, F.lit(50.0))))


def at_cap(max_copies: float) -> Column:
    """The target asks for every document ``max_copies`` times."""
    return F.col("target") >= F.lit(float(max_copies)) * F.col("source_size") * (1 - 1e-12)


def solve_rates(histogram: DataFrame, targets: DataFrame, max_copies: float, tolerance: float, max_steps: int) -> DataFrame:
    """(source, mean, lam): the dual solution per source by safeguarded Newton steps."""
    spark = histogram.sparkSession
    moments = histogram.groupBy("source").agg((F.sum(F.col("n") * F.col("size") * F.col("size")) / F.sum(F.col("n") * F.col("size"))).alias("mean"))
    start = F.log(F.col("target") / F.col("source_size"))
    inner = (F.col("source_size") > 0) & (F.col("target") > 0) & ~at_cap(max_copies)
    state = targets.where(inner).join(moments, targets["source"].eqNullSafe(moments["source"])).select(targets["source"], "target", "mean", start.alias("lam"), F.lit(-1e3).alias("lo"), F.lit(1e3).alias("hi"), F.lit(False).alias("done"))
    state = materialise(spark, state, "mix_state")
    bins = histogram.where("size > 0").withColumnRenamed("source", "of")
    for _ in range(max_steps):
        joined = state.join(bins, state["source"].eqNullSafe(bins["of"])).drop("of")
        scaled = F.col("size") / F.col("mean")
        rate = capped_rate(F.col("lam"), scaled, max_copies)
        words = F.col("n") * F.col("size")
        sums = joined.groupBy("source", "target", "mean", "lam", "lo", "hi").agg(
            F.sum(words * rate).alias("got"), F.sum(F.when(rate < max_copies, words * scaled * rate).otherwise(0.0)).alias("slope")
        )
        miss = F.col("got") - F.col("target")
        done = F.abs(miss) <= F.lit(tolerance) * F.col("target")
        step = sums.withColumn("miss", miss).withColumn("done", done | (F.col("hi") - F.col("lo") < 1e-12)).withColumn("lo", F.when(F.col("miss") < 0, F.greatest("lo", "lam")).otherwise(F.col("lo"))).withColumn("hi", F.when(F.col("miss") > 0, F.least("hi", "lam")).otherwise(F.col("hi")))
        newton = F.col("lam") - F.col("miss") / F.nullif(F.col("slope"), F.lit(0.0))
        inside = F.when((newton > F.col("lo")) & (newton < F.col("hi")), newton).otherwise((F.greatest("lo", F.lit(-60.0)) + F.least("hi", F.lit(60.0))) / 2)
        state = materialise(spark, step.select("source", "target", "mean", F.when(F.col("done"), F.col("lam")).otherwise(inside).alias("lam"), "lo", "hi", "done"), "mix_state")
        if state.where("not done").isEmpty():
            break
    return state.select("source", "mean", "lam")


def mix(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    max_copies: int = 3, seed: int = 8, tolerance: float = 1e-9, max_steps: int = 60,
) -> DataFrame:
    """One row per row of ``df``: id, source, key, size, source_size, target, rate and copies."""
    spark = df.sparkSession
    text = F.col(text_col)
    rows = df.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(text).alias("size"), row_key(id_col, text_col).alias("row_key"))
    rows = materialise(spark, rows.withColumn("key", F.xxhash64(F.lit(seed), "row_key")), "mix_rows")
    histogram = materialise(spark, rows.groupBy("source", "size").agg(F.count("*").alias("n")), "mix_histogram")
    sizes = histogram.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).cast("long").alias("source_size"))
    targets = materialise(spark, source_targets(sizes, weights, max_copies), "mix_targets")
    solved = solve_rates(histogram, targets, max_copies, tolerance, max_steps)
    lam = solved.select(F.col("source").alias("of"), "mean", "lam")
    rated = (
        histogram.join(targets, histogram["source"].eqNullSafe(targets["source"]))
        .select(histogram["source"], "size", "n", "source_size", "target")
        .join(lam, F.col("source").eqNullSafe(lam["of"]), "left")
        .withColumn("rate", F.when(F.col("size") == 0, F.lit(1.0)).when(at_cap(max_copies), F.lit(float(max_copies))).otherwise(F.coalesce(capped_rate(F.col("lam"), F.col("size") / F.col("mean"), max_copies), F.lit(0.0))))
        .withColumn("buckets", F.ceil(F.col("n") / F.lit(BUCKET_ROWS)).cast("int"))
        .select("source", "size", "source_size", "target", "rate", "buckets")
    )
    rated = rated.select(*[F.col(c).alias(f"r_{c}") for c in rated.columns])
    placed = rows.join(rated, rows["source"].eqNullSafe(rated["r_source"]) & (rows["size"] == rated["r_size"])).select(
        "id", "source", "row_key", "key", "size", F.col("r_source_size").alias("source_size"), F.col("r_target").alias("target"), F.col("r_rate").alias("rate"), F.pmod(F.col("key"), F.col("r_buckets").cast("long")).cast("int").alias("bucket")
    )
    placed = materialise(spark, placed, "mix_placed")
    return with_copies(placed, max_copies)


def with_copies(placed: DataFrame, max_copies: int) -> DataFrame:
    """Add ``copies``: the rate rounded systematically along (size, bucket, key) within each source."""
    part = F.col("rate") - F.floor("rate")
    groups = placed.groupBy("source", "size", "bucket").agg(F.count("*").alias("n"), F.first("rate").alias("rate"), F.first("target").alias("target"))
    before = Window.partitionBy("source").orderBy("size", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed_groups = materialise(placed.sparkSession, groups.withColumn("before", F.coalesce(F.sum(F.col("n") * part).over(before), F.lit(0.0))), "mix_groups")
    # of PHASES starting points of the rounding, each source takes the one that comes nearest its target
    extra = lambda p: F.floor(F.col("before") + F.lit(p / PHASES) + F.col("n") * part) - F.floor(F.col("before") + F.lit(p / PHASES))
    totals = placed_groups.groupBy("source").agg(F.first("target").alias("target"), *[F.sum(F.col("size") * (F.col("n") * F.floor("rate") + extra(p))).alias(f"p{p}") for p in range(PHASES)])
    miss = F.array(*[F.struct(F.abs(F.col(f"p{p}") - F.col("target")).alias("miss"), F.lit(p / PHASES).alias("phase")) for p in range(PHASES)])
    phases = totals.select(F.col("source").alias("of"), F.array_min(miss)["phase"].alias("phase"))
    offsets = placed_groups.join(phases, F.col("source").eqNullSafe(F.col("of"))).select(
        F.col("source").alias("o_source"), F.col("size").alias("o_size"), F.col("bucket").alias("o_bucket"), (F.col("before") + F.col("phase")).alias("offset")
    )
    joined = placed.join(offsets, placed["source"].eqNullSafe(offsets["o_source"]) & (placed["size"] == offsets["o_size"]) & (placed["bucket"] == offsets["o_bucket"])).drop("o_source", "o_size", "o_bucket")
    rank = F.row_number().over(Window.partitionBy("source", "size", "bucket").orderBy("key", "id"))
    ranked = joined.withColumn("rank", rank)
    more = F.floor(F.col("offset") + F.col("rank") * part) - F.floor(F.col("offset") + (F.col("rank") - 1) * part)
    return ranked.withColumn("copies", F.least(F.lit(max_copies).cast("long"), F.floor("rate") + more).cast("int")).drop("offset", "rank", "bucket")


def mixed_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """``df`` with every row repeated as often as the mix takes it (rows of size 0 stay once).

    Rows equal in id and text are merged: one of them is repeated as often as
    all of them together are taken.
    """
    plan = mix(df, id_col, text_col, source_col, **options)
    totals = plan.groupBy("row_key").agg(F.sum("copies").cast("int").alias("__copies")).where("__copies > 0").withColumnRenamed("row_key", "__key")
    keyed = df.withColumn("__key", row_key(id_col, text_col)).join(totals, "__key").dropDuplicates(["__key"])
    return keyed.withColumn("__i", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*df.columns)
