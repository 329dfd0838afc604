"""Approximate nearest neighbours by cosine with an inverted multi-index.

Unit vectors are cut in two halves, each quantised by its own ``centroids``
k-means centroids (fitted on a bounded sample of ``sample_size`` vectors). A
vector's cell is its pair of nearest centroids; every vector is indexed. A query
walks the centroid pairs by increasing summed distance with a heap
(multi-sequence algorithm) until its cells hold ``scan`` of all entries (and
more than k); the
entries of these cells are reranked by exact cosine on the original vectors.

Entries are worked on in blocks of at most about ``ENTRY_BLOCK`` vectors of one
first-half centroid, queries in blocks of about ``QUERY_BLOCK``; a query is sent
once to each block of a first-half centroid it visits, with a bit set of the
second halves it wants. A hot cell is therefore many blocks, never one task.
Each block returns a query's best k; these are merged per query.

Vectors that are null, zero, or hold null or non-finite components take no part.
The others' length is read from the table, and lengths that differ are an error;
where ``dim`` is given, vectors of another length take no part. Ties go to the smaller id. Queries and
entries with a null id take no part. Rows that repeat an id are separate
entries; a query's own row is left out by id.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearth.llm.common import materialise, unit_hash

ENTRY_BLOCK = 8192
QUERY_BLOCK = 2048


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of an Arrow list column as float64."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def unit(rows: np.ndarray) -> np.ndarray:
    scale = np.abs(rows).max(axis=1, keepdims=True)  # keeps huge and tiny components from over- or underflowing
    rows = rows / scale
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of corresponding rows; equal rows give equal results wherever they stand."""
    with np.errstate(all="ignore"):
        dot, na, nb = (a * b).sum(axis=1), (a * a).sum(axis=1), (b * b).sum(axis=1)
        out = dot / (np.sqrt(na) * np.sqrt(nb))
    odd = ~np.isfinite(out) | ~np.isfinite(na) | ~np.isfinite(nb) | (na < 1e-280) | (nb < 1e-280)
    if odd.any():
        out[odd] = (unit(a[odd]) * unit(b[odd])).sum(axis=1)
    return out


def distances(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.maximum((rows * rows).sum(axis=1)[:, None] - 2 * rows @ centers.T + (centers * centers).sum(axis=1), 0.0)


def kmeans(rows: np.ndarray, k: int, steps: int = 12, seed: int = 9) -> np.ndarray:
    rng = np.random.default_rng(seed)
    distinct = np.unique(rows, axis=0)
    centers = distinct[rng.permutation(len(distinct))[:k]].copy()
    for _ in range(steps):
        near = distances(rows, centers).argmin(axis=1)
        count = np.bincount(near, minlength=len(centers))
        for j in np.flatnonzero(count):
            centers[j] = rows[near == j].mean(axis=0)
    return centers


@dataclass
class MultiIndex:
    dim: int
    first: np.ndarray
    second: np.ndarray

    def cells(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half, u = self.dim // 2, unit(rows)
        return distances(u[:, :half], self.first).argmin(axis=1), distances(u[:, half:], self.second).argmin(axis=1)

    def visit(self, rows: np.ndarray, sizes: np.ndarray, want: float) -> Iterator[list[tuple[int, int]]]:
        """Per row, the non-empty cells in order of summed distance until they hold ``want`` entries."""
        half, u = self.dim // 2, unit(rows)
        for d1, d2 in zip(distances(u[:, :half], self.first), distances(u[:, half:], self.second), strict=True):
            o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
            heap, seen, held, out = [(d1[o1[0]] + d2[o2[0]], 0, 0)], {(0, 0)}, 0, []
            while heap and held < want:
                _, i, j = heapq.heappop(heap)
                n = sizes[o1[i], o2[j]]
                if n:
                    out.append((int(o1[i]), int(o2[j])))
                    held += n
                for a, b in ((i + 1, j), (i, j + 1)):
                    if a < len(o1) and b < len(o2) and (a, b) not in seen:
                        seen.add((a, b))
                        heapq.heappush(heap, (d1[o1[a]] + d2[o2[b]], a, b))
            yield out


def usable(df: DataFrame, id_col: str, vec_col: str, dim: int | None) -> DataFrame:
    """(id, vec) of the rows that take part; vectors as arrays of doubles, of any length without ``dim``."""
    vec = F.col("vec")
    finite = F.forall(vec, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    long_enough = F.size("vec") > 0 if dim is None else F.size("vec") == dim
    return rows.where(F.col("id").isNotNull() & long_enough & finite & F.exists(vec, lambda x: x != 0))


def width(rows: DataFrame) -> int:
    """The one length of all vectors; 2 for an empty table."""
    least, most = rows.agg(F.min(F.size("vec")), F.max(F.size("vec"))).first()
    if least != most:
        raise ValueError(f"vectors of {least} to {most} components: give dim to search those of one length")
    return least or 2


def train(rows: DataFrame, dim: int, centroids: int, sample_size: int) -> MultiIndex:
    total = rows.count()
    rate = min(1.0, sample_size / max(total, 1))
    sample = rows.where(unit_hash("id", seed=9) < rate).sort("id").select("vec").toArrow()
    vectors = unit(matrix(sample.column("vec"), dim)) if sample.num_rows else np.eye(1, dim)
    half = dim // 2
    return MultiIndex(dim, kmeans(vectors[:, :half], centroids), kmeans(vectors[:, half:], centroids))


def search(
    df: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", dim: int | None = None, centroids: int = 32, sample_size: int = 16_384, scan: float = 0.5,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest entries found for every row whose id meets ``is_query``.

    ``is_query`` takes the id column and returns a boolean column.
    """
    if centroids > 62:
        raise ValueError("at most 62 centroids: a query's second halves are one bit set")
    spark = df.sparkSession
    rows = materialise(spark, usable(df, id_col, vec_col, dim), "vectors")
    dim = width(rows) if dim is None else dim
    index = train(rows, dim, centroids, sample_size)
    shared = spark.sparkContext.broadcast(index)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                c1, c2 = shared.value.cells(matrix(batch.column(1), dim))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(c1, pa.int32()), pa.array(c2, pa.int32())], names=["id", "vec", "c1", "c2"])

    entries = materialise(spark, rows.mapInArrow(assign, "id long, vec array<double>, c1 int, c2 int"), "entries")
    sizes = np.zeros((len(index.first), len(index.second)), dtype=np.int64)  # one number per cell, however many entries
    for r in entries.groupBy("c1", "c2").agg(F.count("*").alias("n")).collect():
        sizes[r["c1"], r["c2"]] = r["n"]
    want = max(scan * sizes.sum(), k + 1)  # a query may meet itself
    blocks = np.maximum(1, -(-sizes.sum(axis=1) // ENTRY_BLOCK))
    queries = entries.where(is_query(F.col("id")))
    query_blocks = max(1, -(-queries.count() // QUERY_BLOCK))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A query's row for every first-half centroid it visits, with the second halves as bits."""
        for batch in batches:
            ids, vecs, c1s, bits = [], [], [], []
            for q, cells in enumerate(shared.value.visit(matrix(batch.column(1), dim), sizes, want)) if batch.num_rows else ():
                by_first: dict[int, int] = {}
                for a, b in cells:
                    by_first[a] = by_first.get(a, 0) | 1 << b
                ids += [q] * len(by_first)
                c1s += by_first.keys()
                bits += by_first.values()
            at = pa.array(ids, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(c1s, pa.int32()), pa.array(bits, pa.int64())], names=["id", "vec", "c1", "bits"])

    per_first = F.element_at(F.array(*[F.lit(int(b)) for b in blocks]), F.col("c1") + 1)
    block = F.pmod(F.xxhash64("id"), per_first.cast("long")).cast("int")
    # entries meet every block of queries, queries every block of entries of the centroids they visit
    placed = entries.select("id", "vec", "c1", "c2", block.alias("eb"), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb"))
    sent = queries.select("id", "vec").mapInArrow(send, "id long, vec array<double>, c1 int, bits long")
    asked = sent.select("id", "vec", "bits", "c1", F.explode(F.sequence(F.lit(0), per_first - 1)).alias("eb"), F.pmod(F.xxhash64(F.lit(5), "id"), F.lit(query_blocks)).cast("int").alias("qb"))

    def best(q: pd.DataFrame, e: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(q) and len(e):
            e = e.sort_values("id", kind="stable")
            eid, ev = e["id"].to_numpy(np.int64), np.stack(e["vec"].to_numpy())
            eu, second = unit(ev), e["c2"].to_numpy(np.int64)
            for lo in range(0, len(q), 256):
                part = q.iloc[lo : lo + 256]
                qid, qv, bits = part["id"].to_numpy(np.int64), np.stack(part["vec"].to_numpy()), part["bits"].to_numpy(np.int64)
                near = unit(qv) @ eu.T
                near[((bits[:, None] >> second[None, :]) & 1 == 0) | (qid[:, None] == eid[None, :])] = -np.inf
                floor = np.partition(near, -min(k, len(eid)), axis=1)[:, -min(k, len(eid))] - 1e-9  # rounding of the product
                for i, at in enumerate(near >= np.maximum(floor, -2.0)[:, None]):
                    found = np.flatnonzero(at)
                    exact = cosine(np.broadcast_to(qv[i], (len(found), dim)), ev[found])
                    top = found[order := np.lexsort((eid[found], -exact))[:k]], exact[order]
                    out += [(int(qid[i]), int(eid[j]), float(s)) for j, s in zip(*top, strict=True)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    keys = ["c1", "eb", "qb"]
    found = asked.groupBy(*keys).cogroup(placed.groupBy(*keys)).applyInPandas(best, "query_id long, vec_id long, score double")
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
