"""Chat rendering after collapsing cumulative snapshots of conversations.

A log often holds a conversation many times, each entry a longer prefix of the
same dialogue. Every turn gets the rolling hash of the conversation up to and
including it: the sum over its turns of a hash of (position, role, text), as two
times two 32-bit lanes, so that it can be summed in pieces. A conversation whose
whole hash is the hash of a proper prefix of another one goes (anti-join); of
equal conversations the one with the smallest id stays. The rest are rendered.

Only DataFrame operations are used. Turns are ordered by turn (null last), role
and text; a turn repeated with equal id, turn, role and text counts once. Long
conversations are worked on in chunks of ``CHUNK`` turn numbers and rendered in
parts of ``PART`` turns, so no conversation is gathered whole. A null role
renders as ``unknown``, a null text as empty; rows without conversation id form
no conversation and are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearth.llm.common import materialise

CHUNK = 1024
PART = 4096
LANES = ("h0", "h1", "h2", "h3")


def positions(turns: DataFrame) -> DataFrame:
    """Distinct turns with their position from 0 in the conversation and their chunk."""
    chunk = F.coalesce(F.floor(F.col("turn") / CHUNK), F.lit(1 << 62))
    chunked = turns.where("conv is not null").distinct().withColumn("chunk", chunk)
    order = Window.partitionBy("conv", "chunk").orderBy(F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_last(), F.col("text").asc_nulls_last())
    counts = chunked.groupBy("conv", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("conv", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return chunked.withColumn("i", F.row_number().over(order) - 1).join(offsets, ["conv", "chunk"]).withColumn("pos", F.col("offset") + F.col("i")).drop("i", "offset")


def lanes(*cols: str) -> list[Column]:
    """Four 32-bit hashes of the columns: sums of them cannot overflow."""
    out = []
    for seed in (0, 1):
        h = F.xxhash64(F.lit(seed), *cols)
        out += [h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32)]
    return [c.alias(name) for c, name in zip(out, LANES, strict=True)]


def prefix_hashes(placed: DataFrame) -> DataFrame:
    """(conv, pos, h0..h3): the hash of every prefix, by sums within chunks and over earlier chunks."""
    # a null and an empty string hash alike but differ; the flags keep them apart
    tagged = placed.withColumn("nulls", F.col("role").isNull().cast("int") * 2 + F.col("text").isNull().cast("int"))
    hashed = tagged.select("conv", "chunk", "pos", *lanes("pos", "nulls", "role", "text"))
    sums = hashed.groupBy("conv", "chunk").agg(*[F.sum(h).alias(h) for h in LANES])
    before = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    start = sums.select("conv", "chunk", *[F.coalesce(F.sum(h).over(before), F.lit(0)).alias(f"s_{h}") for h in LANES])
    upto = Window.partitionBy("conv", "chunk").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    inside = hashed.select("conv", "chunk", "pos", *[F.sum(h).over(upto).alias(h) for h in LANES])
    return inside.join(start, ["conv", "chunk"]).select("conv", "pos", *[(F.col(h) + F.col(f"s_{h}")).alias(h) for h in LANES])


def maximal(placed: DataFrame) -> DataFrame:
    """(conv, n_turns, copies) of the conversations that no other one continues; of equal ones the smallest id."""
    hashes = materialise(placed.sparkSession, prefix_hashes(placed), "chat_prefixes")
    ends = hashes.groupBy("conv").agg(F.max("pos").alias("pos"))
    whole = hashes.join(ends, ["conv", "pos"]).groupBy("pos", *LANES).agg(F.min("conv").alias("conv"), F.count("*").alias("copies"))
    last = ends.select("conv", F.col("pos").alias("last"))
    proper = hashes.join(last, "conv").where("pos < last").select("pos", *LANES).distinct()
    return whole.join(proper, ["pos", *LANES], "left_anti").select("conv", (F.col("pos") + 1).alias("n_turns"), "copies")


def render_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("unknown")), F.lit("|>\n"), F.coalesce(text, F.lit("")), F.lit("\n<|end|>\n"))


def format_chats(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per part of each maximal conversation: id, part, n_turns, copies and the rendered chat."""
    turns = df.select(F.col(id_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    placed = materialise(df.sparkSession, positions(turns), "chat_turns")
    rendered = placed.join(maximal(placed), "conv").select("conv", "n_turns", "copies", "pos", F.floor(F.col("pos") / PART).cast("int").alias("part"), render_turn(F.col("role"), F.col("text")).alias("line"))
    parts = rendered.groupBy("conv", "part", "n_turns", "copies").agg(F.sort_array(F.collect_list(F.struct("pos", "line"))).alias("lines"))
    return parts.select(F.col("conv").alias(id_col), "part", "n_turns", "copies", F.array_join(F.col("lines.line"), "").alias("chat"))
