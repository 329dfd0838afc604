"""Uniform shuffle into shards of exact sizes with a hypergeometric communication matrix.

Rows fall into source blocks by a hash. How many rows of block b go to target
cell c is drawn exactly: the matrix of counts is multivariate hypergeometric
with the block sizes as row sums and the cell capacities as column sums, as for
a uniformly random permutation. Each block is then permuted locally and dealt
out by its row of the matrix (first the rows of cell 0, and so on), rows are
exchanged to their cells, and each cell is permuted again. The cells of a shard
follow one another, so positions are gapless and shard sizes differ by at most
one row.

The matrix is drawn by halving: the capacities are split between the two halves
of a range of blocks by hypergeometric draws, and so on down to single blocks
(ratio-of-uniforms sampling of Stadlober, 1990, from hashed uniforms). Both
sides of the matrix grow with the table up to ``MAX_SIDE``; no block, cell or
shard is a single task's whole work unless it is small.

Only DataFrame operations are used. Randomness is a hash of seed, id and text,
so reruns agree and lost tasks repeat the same draws. Rows equal in id and text
are interchangeable. Nulls hash like any value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.llm.common import materialise, unit_hash

MAX_SIDE = 1024
BLOCK_ROWS = 8192
#: Candidates per draw; all are rejected with probability below 1e-25, and then the mode is taken.
TRIES = 48


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body uses it."""
    return F.transform(F.array(value), lambda x: body(x))[0]


def ln_factorial(n: Column) -> Column:
    """ln n! for n >= 0: Stirling's series, shifted by the recurrence so that it is exact to double precision."""
    x = n + F.lit(9.0)  # ln n! = ln Gamma(n + 9) - ln((n + 1)(n + 2)...(n + 8))
    series = (x - 0.5) * F.log(x) - x + 0.918938533204672742 + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x)
    shift = F.log((n + 1) * (n + 2) * (n + 3) * (n + 4)) + F.log((n + 5) * (n + 6) * (n + 7) * (n + 8))
    return series - shift


def hypergeometric(good: Column, bad: Column, sample: Column, *seed: Column) -> Column:
    """How many of ``sample`` draws without replacement from good + bad are good (doubles holding whole numbers)."""

    def urn(a: Column) -> Column:
        pool = a["good"] + a["bad"]
        return F.struct(
            a["good"].alias("good"), a["bad"].alias("bad"), a["sample"].alias("sample"), pool.alias("pool"),
            F.least(a["good"], a["bad"]).alias("small"), F.greatest(a["good"], a["bad"]).alias("large"), F.least(a["sample"], pool - a["sample"]).alias("taken"),
        )

    def weight(b: Column, z: Column) -> Column:
        return let(z, lambda k: ln_factorial(k) + ln_factorial(b["small"] - k) + ln_factorial(b["taken"] - k) + ln_factorial(b["large"] - b["taken"] + k))

    def draw(b: Column) -> Column:
        share = b["small"] / b["pool"]
        variance = (b["pool"] - b["taken"]) * b["taken"] * share * (1 - share) / F.greatest(b["pool"] - 1, F.lit(1.0))
        shape = F.struct(
            (b["taken"] * share + 0.5).alias("centre"), F.sqrt(variance + 0.5).alias("spread"),
            F.floor((b["taken"] + 1) * (b["small"] + 1) / (b["pool"] + 2)).cast("double").alias("mode"), b.alias("b"),
        )
        return let(shape, sampled)

    def sampled(c: Column) -> Column:
        b = c["b"]
        width = F.lit(1.7155277699214135) * c["spread"] + F.lit(0.8989161620588988)  # 2 sqrt(2/e), 3 - 2 sqrt(3/e)
        top = F.least(F.least(b["taken"], b["small"]) + 1, F.floor(c["centre"] + 16 * c["spread"]).cast("double"))
        bounds = F.struct(c["centre"].alias("centre"), width.alias("width"), top.alias("top"), c["mode"].alias("mode"), weight(b, c["mode"]).alias("most"), b.alias("b"))
        return let(bounds, first_accepted)

    def first_accepted(d: Column) -> Column:
        b = d["b"]

        def candidate(i: Column) -> Column:
            u = unit_hash(*seed, i, seed=101) + F.lit(2.0**-54)
            v = unit_hash(*seed, i, seed=202)
            return let(u, lambda x: F.struct(x.alias("u"), (d["centre"] + d["width"] * (v - 0.5) / x).alias("w")))

        def accept(c: Column) -> Column:
            z = F.floor(c["w"]).cast("double")
            return (c["w"] >= 0) & (c["w"] < d["top"]) & (z >= b["taken"] - b["large"]) & (2 * F.log(c["u"]) <= d["most"] - weight(b, z))

        drawn = F.filter(F.transform(F.sequence(F.lit(1), F.lit(TRIES)), candidate), accept)
        return let(F.coalesce(F.floor(F.get(drawn, F.lit(0))["w"]).cast("double"), d["mode"]), lambda z: unfold(b, z))

    def unfold(b: Column, z: Column) -> Column:
        """From draws of the rarer kind in the smaller part to draws of the good kind in the sample."""
        of_small = F.when(b["good"] <= b["bad"], z).otherwise(b["taken"] - z)
        return F.when(b["taken"] == b["sample"], of_small).otherwise(b["good"] - of_small)

    def checked(b: Column) -> Column:
        return F.when((b["good"] <= 0) | (b["sample"] <= 0), F.lit(0.0)).when(b["bad"] <= 0, b["sample"]).when(b["sample"] >= b["pool"], b["good"]).otherwise(draw(b))

    given = F.struct(good.alias("good"), bad.alias("bad"), sample.alias("sample"))
    return let(let(given, urn), checked)


def halve(node: DataFrame, level: int, seed: int) -> DataFrame:
    """Split every range of blocks of one level in two, dealing its cell capacities to the halves."""
    half = (F.size("sizes") / 2).cast("int")
    left_sizes = F.slice("sizes", F.lit(1), half)
    right_sizes = F.slice("sizes", half + 1, F.size("sizes") - half)
    rows = F.aggregate(left_sizes, F.lit(0.0), lambda s, x: s + x)
    pool = F.aggregate("caps", F.lit(0.0), lambda s, x: s + x)
    zero = F.struct(rows.alias("sample"), pool.alias("pool"), F.expr("cast(array() as array<double>)").alias("dealt"))

    def deal(state: Column, cap: Column) -> Column:
        got = hypergeometric(cap, state["pool"] - cap, state["sample"], F.lit(seed), F.lit(level), F.col("first"), F.size(state["dealt"]))
        return let(got, lambda x: F.struct((state["sample"] - x).alias("sample"), (state["pool"] - cap).alias("pool"), F.concat(state["dealt"], F.array(x)).alias("dealt")))

    dealt = node.withColumn("left", F.aggregate("caps", zero, deal)["dealt"])
    left = F.struct(F.col("first").alias("first"), left_sizes.alias("sizes"), F.col("left").alias("caps"))
    right = F.struct((F.col("first") + half).cast("int").alias("first"), right_sizes.alias("sizes"), F.zip_with("caps", "left", lambda c, x: c - x).alias("caps"))
    whole = F.struct(F.col("first").alias("first"), F.col("sizes").alias("sizes"), F.col("caps").alias("caps"))
    split = dealt.select(F.explode(F.when(F.size("sizes") > 1, F.array(left, right)).otherwise(F.array(whole))).alias("n"))
    return split.select("n.first", "n.sizes", "n.caps")


def communication_matrix(block_sizes: DataFrame, blocks: int, capacities: Column, seed: int) -> DataFrame:
    """(block, caps): rows of the matrix, drawn from (block, n); blocks without rows have size 0."""
    counted = block_sizes.agg(F.map_from_entries(F.collect_list(F.struct("block", F.col("n").cast("double")))).alias("m"))
    sizes = F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda b: F.coalesce(F.element_at(F.col("m"), b), F.lit(0.0)))
    node = counted.select(F.lit(0).alias("first"), sizes.alias("sizes"), capacities.alias("caps"))
    spark = block_sizes.sparkSession
    levels = max(0, (blocks - 1).bit_length())
    for level in range(levels):
        node = halve(node, level, seed)
        if level % 3 == 2:  # spread the growing number of ranges, and bound the plan
            node = materialise(spark, node.repartition(min(64, 2 ** (level + 1)), "first"), "matrix")
    return node.select(F.col("first").alias("block"), F.transform("caps", lambda x: x.cast("long")).alias("caps"))


def shard(df: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``df`` with ``shard`` (0 .. n_shards - 1) and ``slot`` (gapless position in it)."""
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    spark = df.sparkSession
    base = df.drop("shard", "slot")
    rnd = F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))
    total = base.count()
    side = min(MAX_SIDE, max(1, -(-total // block_rows)))
    per_shard = -(-side // n_shards)
    cells = n_shards * per_shard
    keyed = base.withColumn("__rnd", rnd).withColumn("__block", F.pmod(F.xxhash64(F.lit(3), "__rnd"), F.lit(side)).cast("int"))
    sizes = base.select(F.pmod(F.xxhash64(F.lit(3), rnd), F.lit(side)).cast("int").alias("block")).groupBy("block").agg(F.count("*").alias("n"))

    def shard_size(s: Column) -> Column:
        return F.lit(total // n_shards) + (s < total % n_shards).cast("long")

    def cell_start(c: Column) -> Column:
        """First slot of a cell within its shard."""
        n, k = shard_size(F.floor(c / per_shard)), F.pmod(c, F.lit(per_shard))
        return k * F.floor(n / per_shard) + F.least(k, F.pmod(n, F.lit(per_shard)))

    def cell_size(c: Column) -> Column:
        n, k = shard_size(F.floor(c / per_shard)), F.pmod(c, F.lit(per_shard))
        return F.floor(n / per_shard) + (k < F.pmod(n, F.lit(per_shard))).cast("long")

    capacities = F.transform(F.sequence(F.lit(0).cast("long"), F.lit(cells - 1).cast("long")), lambda c: cell_size(c).cast("double"))
    matrix = communication_matrix(sizes, side, capacities, seed)
    running = F.aggregate("caps", F.expr("cast(array() as array<long>)"), lambda a, x: F.concat(a, F.array(F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0).cast("long")) + x)))
    dealt = materialise(spark, matrix.select(F.col("block").alias("__block"), running.alias("__ends")), "matrix")

    # permute locally: number equal rows, then order a block's rows by a hash; deal them out by the matrix
    number = F.row_number().over(Window.partitionBy("__block", "__rnd").orderBy("__rnd"))
    numbered = keyed.withColumn("__rnd", F.xxhash64(F.lit(4), "__rnd", number))
    first = Window.partitionBy("__block").orderBy("__rnd")
    ranked = numbered.withColumn("__rank", F.row_number().over(first)).join(dealt, "__block")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(cells.bit_length()))])
    passed = lambda at, s: (at + s <= cells) & (F.try_element_at(F.col("__ends"), (at + s).cast("int")) < F.col("__rank"))
    cell = F.aggregate(steps, F.lit(0), lambda at, s: F.when(passed(at, s), at + s).otherwise(at))
    sent = ranked.withColumn("__cell", cell.cast("long")).drop("__ends", "__rank", "__block")
    # exchange, and permute again inside the cell
    second = Window.partitionBy("__cell").orderBy(F.xxhash64(F.lit(6), "__rnd"), "__rnd")
    return (
        sent.withColumn("slot", (cell_start(F.col("__cell")) + F.row_number().over(second) - 1).cast("long"))
        .withColumn("shard", F.floor(F.col("__cell") / per_shard).cast("int"))
        .drop("__cell", "__rnd")
    )


def text_size(text: Column) -> Column:
    """UTF-8 bytes plus one; a null text has no bytes."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


