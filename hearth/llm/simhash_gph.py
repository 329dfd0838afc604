"""SimHash near-duplicates found with the generalised pigeonhole principle.

A fingerprint is 64 bits; two link at ``max_distance`` or fewer differing bits.
The bits are cut into m parts, bits that vary together sharing a part. Part i
gets a threshold t_i (-1: not probed) with ``sum(t_i) = max_distance - m + 1``;
then two fingerprints within ``max_distance`` agree within t_i bits on at least
one part (generalised pigeonhole). m, the parts and the thresholds come from a
dynamic programme over estimated candidate counts. Candidates meet in a bucket
(part, value) and are verified by their Hamming distance.

Only distinct fingerprints are compared, so copies never form pairs. A bucket
of more than ``bucket_limit`` fingerprints is not paired up: its members meet
again under every value within ``ceil(max_distance / 2)`` bits of their own,
where a group holds at most one ball of fingerprints, whatever the data, and each
links to the smallest of its ball: at most 64 links a member, however large the group.

Null and blank texts have fingerprint zero and link like any other. A null id
is never a component's id unless all its ids are null. Repeated rows are
separate documents with equal fingerprints. A whole text of any length is hashed by
one task. Input columns other than id and text are ignored by ``cluster`` and kept by
``near_dedup``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.llm.common import append_columns, materialise, row_key, text_bytes, unit_hash
from hearth.llm.components import connected_components

BITS = 64
HASH_SEED = 42


def fingerprint_of(text: bytes, shingle_words: int = 3) -> int:
    """The 64-bit fingerprint of one text: majority of its shingles' XXH64 bits."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    starts = np.zeros(len(words) + 1, dtype=np.int64)
    np.cumsum([len(w) + 1 for w in words], out=starts[1:])
    k = min(shingle_words, len(words))
    begin = starts[: len(words) - k + 1].tolist()
    end = (starts[k:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], HASH_SEED) for a, b in zip(begin, end, strict=True)], dtype=np.uint64)
    ones = np.zeros(BITS, dtype=np.int64)
    for part in range(0, len(hashes), 1 << 16):
        piece = hashes[part : part + (1 << 16)]
        ones += np.unpackbits(piece.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, text_col: str = "text", out: str = "fp", shingle_words: int = 3) -> DataFrame:
    """``df`` without its text, with the signed 64-bit fingerprint in ``out``."""

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        raw, offs = text_bytes(batch.column(batch.schema.get_field_index(text_col)))
        fps = [fingerprint_of(raw[a:b].tobytes(), shingle_words) for a, b in zip(offs[:-1], offs[1:], strict=True)]
        return [pa.array(np.array(fps, dtype=np.uint64).view(np.int64))]

    return append_columns(df, compute, [T.StructField(out, T.LongType())], drop=(text_col,))


# ---------------------------------------------------------------- partition plan


def group_bits(sample: np.ndarray, parts: int) -> list[int]:
    """Masks of ``parts`` groups of bits; bits with high mutual correlation share one."""
    bits = np.unpackbits(sample.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)
    bits -= bits.mean(axis=0)
    norm = np.sqrt((bits**2).sum(axis=0))
    norm[norm == 0] = 1.0
    corr = np.abs(bits.T @ bits) / np.outer(norm, norm)
    np.fill_diagonal(corr, 0.0)
    free, masks = set(range(BITS)), []
    for p in range(parts):
        size = BITS // parts + (p < BITS % parts)
        left = sorted(free)
        best = int(np.argmax(corr[np.ix_(left, left)].max(axis=1)))
        group = [left[best]]
        free.discard(group[0])
        while len(group) < size:
            left = sorted(free)
            score = corr[np.ix_(left, group)].mean(axis=1)
            group.append(left[int(np.argmax(score))])
            free.discard(group[-1])
        masks.append(sum(1 << b for b in group))
    return masks


def bit_patterns(mask: int, radius: int) -> list[int]:
    """All xor patterns of at most ``radius`` bits of ``mask``, the empty one first."""
    bits = [1 << b for b in range(BITS) if mask >> b & 1]
    return [sum(c) for r in range(radius + 1) for c in combinations(bits, r)]


def estimate_candidates(sample: np.ndarray, mask: int, threshold: int, total: int, probes: int = 1024) -> float:
    """Expected candidate pairs among ``total`` fingerprints when one part is probed within ``threshold``."""
    size = bin(mask).count("1")
    expected = total * total * sum(comb(size, r) for r in range(threshold + 1)) / 2.0**size
    if len(sample) < 2:
        return expected
    values, counts = np.unique(sample & np.uint64(mask), return_counts=True)
    queries = (sample & np.uint64(mask))[:: max(1, len(sample) // probes)]
    found = -len(queries)  # a query's own entry
    for pattern in bit_patterns(mask, threshold):
        probe = queries ^ np.uint64(pattern)
        at = np.minimum(np.searchsorted(values, probe), len(values) - 1)
        found += int(counts[at][values[at] == probe].sum())
    return max(expected, found / len(queries) * total * total / len(sample))


def allocate(costs: list[dict[int, float]], budget: int) -> tuple[float, list[int]]:
    """Thresholds per part, summing to ``budget``, of the least total cost (dynamic programme)."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for options in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in best.items():
            for t, c in options.items():
                if (now := spent + t) not in step or cost + c < step[now][0]:
                    step[now] = (cost + c, [*chosen, t])
        best = step
    return best[budget]


def plan_parts(sample: np.ndarray, total: int, max_distance: int) -> list[tuple[int, int]]:
    """(mask, threshold) of every probed part, for the number of parts that costs least."""
    plans = []
    for m in range(1, max_distance + 3):
        masks = group_bits(sample, m) if len(sample) else group_bits(np.zeros(1, np.uint64), m)
        costs = []
        for mask in masks:
            size = bin(mask).count("1")
            options = {-1: 0.0}
            for t in range(max_distance + 1):
                signatures = sum(comb(size, r) for r in range(t + 1))
                if signatures <= 600:  # more probes per fingerprint are never cheaper than fewer bits
                    options[t] = float(total) * (signatures + 1) + estimate_candidates(sample, mask, t, total)
            costs.append(options)
        try:
            cost, chosen = allocate(costs, max_distance - m + 1)
        except KeyError:
            continue
        plans.append((cost, [(mask, t) for mask, t in zip(masks, chosen, strict=True) if t >= 0]))
    return min(plans, key=lambda p: p[0])[1]


def partition_plan(fps: DataFrame, total: int, max_distance: int, sample_size: int) -> list[tuple[int, int]]:
    """The plan from a bounded sample (``sample_size``) of the distinct fingerprints, made in one task."""
    rate = min(1.0, sample_size / max(total, 1))
    sample = fps.where(unit_hash("fp", seed=11) < rate).select("fp").repartition(1)

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b.column(0).to_numpy(zero_copy_only=False) for b in batches]
        values = np.sort(np.concatenate(got).astype(np.int64).view(np.uint64)) if got else np.zeros(0, np.uint64)
        rows = plan_parts(values, total, max_distance)
        masks = np.array([m for m, _ in rows], dtype=np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(masks), pa.array([t for _, t in rows], pa.int32())], names=["mask", "threshold"])

    return [(r["mask"], r["threshold"]) for r in sample.mapInArrow(plan, "mask long, threshold int").collect()]


# ---------------------------------------------------------------- probing


def signed(value: int) -> int:
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


def probe_buckets(part: int, mask: int, threshold: int) -> Column:
    """The buckets of one part within ``threshold`` bits of ``fp``; its own is marked as the center."""
    patterns = bit_patterns(mask + (1 << BITS) if mask < 0 else mask, threshold)
    value = F.col("fp").bitwiseAND(F.lit(mask))
    return F.transform(
        F.array(*[F.lit(signed(p)) for p in patterns]),
        lambda p: F.struct(F.lit(part).alias("part"), value.bitwiseXOR(p).alias("value"), (p == 0).alias("center")),
    )


def close_pairs(members: Column, max_distance: int, both: bool) -> Column:
    """Verified (a, b) pairs, a < b, of an array of structs (fp, center); one of a pair must be a center if ``both``."""

    def partners(x: Column) -> Column:
        def near(y: Column) -> Column:
            ok = (x["fp"] < y["fp"]) & (F.bit_count(x["fp"].bitwiseXOR(y["fp"])) <= max_distance)
            return ok & (x["center"] | y["center"]) if both else ok

        return F.transform(F.filter(members, near), lambda y: F.struct(x["fp"].alias("a"), y["fp"].alias("b")))

    return F.flatten(F.transform(members, partners))


def ball_links(fps: DataFrame, max_distance: int) -> DataFrame:
    """Links of fingerprints that lie within ``ceil(max_distance / 2)`` bits of a common value.

    For an even distance all members of such a ball link with each other, so each
    links to the ball's smallest only; for an odd one its pairs are verified.
    """
    ball = F.array(*[F.lit(signed(p)) for p in bit_patterns((1 << BITS) - 1, (max_distance + 1) // 2)])
    near = fps.select("fp", F.explode(F.transform(ball, lambda p: F.col("fp").bitwiseXOR(p))).alias("near")).groupBy("near")
    if max_distance % 2 == 0:
        members = near.agg(F.array_sort(F.collect_list("fp")).alias("m")).where(F.size("m") > 1)
        return members.select(F.col("m")[0].alias("a"), F.explode(F.slice("m", F.lit(2), F.size("m") - 1)).alias("b"))
    members = near.agg(F.collect_list(F.struct("fp", F.lit(True).alias("center"))).alias("m")).where(F.size("m") > 1)
    return members.select(F.explode(close_pairs(F.col("m"), max_distance, both=False)).alias("p")).select("p.a", "p.b")


def links(fps: DataFrame, total: int, max_distance: int = 2, bucket_limit: int = 32, sample_size: int = 16_384) -> DataFrame:
    """Links (a, b) whose transitive closure is that of all pairs of distinct fingerprints within ``max_distance``."""
    spark = fps.sparkSession
    plan = partition_plan(fps, total, max_distance, sample_size)
    probes = [probe_buckets(part, mask, threshold) for part, (mask, threshold) in enumerate(plan)]
    probed = fps.select("fp", F.explode(F.concat(*probes)).alias("p")).select("fp", "p.part", "p.value", "p.center")
    hot = probed.groupBy("part", "value").agg(F.count("*").alias("size")).where(F.col("size") > bucket_limit)
    hot = materialise(spark, hot.select("part", "value", F.lit(True).alias("hot")), "simhash_hot")
    told = probed.join(hot, ["part", "value"], "left")
    small = (
        told.where(F.col("hot").isNull())
        .groupBy("part", "value")
        .agg(F.collect_list(F.struct("fp", "center")).alias("m"))
        .where(F.size("m") > 1)
        .select(F.explode(close_pairs(F.col("m"), max_distance, both=True)).alias("p"))
        .select("p.a", "p.b")
    )
    crowded = materialise(spark, told.where("hot").select("fp").distinct(), "simhash_crowded")
    return small.unionByName(ball_links(crowded, max_distance)).distinct()


def classes(fps: DataFrame, id_col: str, max_distance: int, bucket_limit: int) -> DataFrame:
    """(fp, root, component_id) for every distinct fingerprint; ``fps`` holds fp and the smallest id of its rows.

    ``root`` is the smallest fingerprint of the component, hence tells components apart whatever their ids.
    """
    linked = connected_components(links(fps, fps.count(), max_distance, bucket_limit), "a", "b")
    members = materialise(fps.sparkSession, linked.join(fps, linked["node"] == fps["fp"]).select("fp", "root", id_col), "simhash_members")
    roots = members.groupBy("root").agg(F.min(id_col).alias("component_id"))
    found = members.join(roots, "root").select("fp", "root", "component_id")
    return fps.join(found, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", F.col(id_col)).alias("component_id"))


def cluster(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3, max_distance: int = 2, bucket_limit: int = 32) -> DataFrame:
    """One row per row of ``df``: its id, row key, ``fp`` (signed), ``root`` of its component and ``component_id``, the smallest id reachable."""
    spark = df.sparkSession
    keyed = df.select(F.col(id_col), F.col(text_col), row_key(id_col, text_col).alias("row_key"))
    rows = materialise(spark, fingerprints(keyed, text_col, "fp", shingle_words), "simhash_rows")
    fps = materialise(spark, rows.groupBy("fp").agg(F.min(id_col).alias(id_col)), "simhash_distinct")
    # written first: a join of two plain exchanges is one that adaptive execution can split at a hot fingerprint
    found = materialise(spark, classes(fps, id_col, max_distance, bucket_limit), "simhash_classes")
    return rows.join(found, "fp")


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3, max_distance: int = 2) -> DataFrame:
    """``df`` with one row of each near-duplicate group: the one with the smallest id (ties: smallest row key).

    Groups are components of fingerprints; ids only choose the row that stays, so
    they may repeat or be null. A group whose ids are all null keeps the row with
    the smallest key.
    """
    rows = cluster(df, id_col, text_col, shingle_words, max_distance)
    order = F.struct(F.col(id_col).isNull(), F.col(id_col), F.col("row_key"))
    keep = rows.groupBy("root").agg(F.min(order).alias("best")).select(F.col("best.row_key").alias("__key")).distinct()
    keyed = df.withColumn("__key", row_key(id_col, text_col))
    return keyed.join(keep, "__key", "left_semi").dropDuplicates(["__key"]).drop("__key")
