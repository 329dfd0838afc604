"""MinHash near-duplicates from bottom-k sketches of a single hash function.

A document is the set of its word shingles, each a 64-bit hash; two documents link
if ``100 * intersection >= percent * union``. A sketch holds the k smallest hashes.

*Inverted lists.* Documents of equal sets are one class, so copies never form
pairs. Two classes that link share at least c values of their sketches: all but
1e-10 of a hypergeometric tail for k-value sketches, the exact bound where sketches
hold whole sets. Hence they also share one of the (size - c + 1) rarest values of
either sketch, rare meaning held by few sketches, and only those enter the lists; a
class with fewer than c values that anybody else holds enters none. Passages and
phrases that many documents share are the most frequent values and drop out first.

*Overlaps.* Every list first links its members to its most typical one (a star).
Verified links show which members have the same hub, hence lie in one component;
lists with one hub are done: a group of n near copies costs n candidates, not n
squared. What is left are lists over several hubs. Short ones give their pairs of
different hubs. The members of longer ones meet again with sketches 16 times as long,
whose lists are shorter, and what is still crowded then meets in a grid of blocks
where only pairs of similar sketches are emitted, so no list is cut, capped or held
in one task.

*Union sketches.* The k smallest values of two sketches together are a uniform
sample of the union; the share that both hold estimates the similarity, and pairs
whose sample holds fewer than c common values are dropped.

*Exact Jaccard* over the whole sets decides. Components give each document the
smallest id that it reaches.

Null and blank texts have no shingles and link with nothing; texts of fewer words
than a shingle are one shingle. Null ids are never a component's id unless all its
ids are null. Repeated rows are separate documents of one class; a row is kept if
its id is its component's. Input columns but id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.llm.common import append_columns, likely_among, materialise, row_key, text_bytes
from hearth.llm.components import connected_components

K = 64
LIST_LIMIT = 64
BLOCK = 1024
CELL_COLUMNS = 4096
#: Odd multipliers of a shingle's words, in turn.
TURNS = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F]


class WordHashes(dict):
    """64-bit hash of every word seen."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def mixed(h: np.ndarray) -> np.ndarray:
    """The one hash function's last step: a bijection that spreads every bit."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingle_hashes(text: bytes, size: int, known: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles of ``size`` words (fewer words: all of them as one; none: empty)."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype=np.int64)
    h = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
    k = min(size, len(words))
    total = np.full(len(h) - k + 1, k, dtype=np.uint64)
    for i in range(k):
        total = (total + h[i : len(h) - k + 1 + i]) * np.uint64(TURNS[i % len(TURNS)])
    return np.unique(mixed(total).view(np.int64))


def list_array(arrays: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate(arrays) if arrays else np.zeros(0, dtype=np.int64)
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays], dtype=np.int64)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64()))


def shingle_sets(df: DataFrame, text_col: str = "text", size: int = 4, k: int = K, whole: bool = True) -> DataFrame:
    """``df`` without its text, with the number ``n`` of its distinct shingles, a 128-bit name ``cid`` of their set, the ``sketch`` of the k smallest hashes and, if ``whole``, all ``hashes``."""

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        raw, offs = text_bytes(batch.column(batch.schema.get_field_index(text_col)))
        known, n, names, sketches, sets = WordHashes(), [], [], [], []
        for a, b in zip(offs[:-1], offs[1:], strict=True):
            hashes = shingle_hashes(raw[a:b].tobytes(), size, known)
            n.append(len(hashes))
            names.append(xxhash.xxh3_128_digest(hashes.tobytes()))
            sketches.append(hashes[:k].copy())
            if whole:
                sets.append(hashes)
        found = [pa.array(n, pa.int64()), pa.array(names, pa.binary()), list_array(sketches)]
        return [*found, list_array(sets)] if whole else found

    longs = T.ArrayType(T.LongType(), False)
    fields = [T.StructField("n", T.LongType()), T.StructField("cid", T.BinaryType()), T.StructField("sketch", longs), T.StructField("hashes", longs)]
    return append_columns(df, compute, fields if whole else fields[:3], drop=(text_col,))


def needed_overlap(k: int, percent: int, miss: float = 1e-10) -> int:
    """Shared values that samples of k from a union of this similarity have, but for a chance of ``miss``."""
    p, tail = percent / 100, 0.0
    for shared in range(k + 1):
        tail += comb(k, shared) * p**shared * (1 - p) ** (k - shared)
        if tail > miss:
            return shared
    return k


def needed(n: Column, k: int, percent: int) -> Column:
    """Values of a class's sketch that any linked class's sketch holds as well."""
    whole = F.ceil((n * percent) / F.lit(100.0) - 1e-9)  # both sketches hold their whole sets
    return F.when(n <= k * percent // 100, whole).otherwise(F.lit(needed_overlap(k, percent))).cast("int")


def inverted_lists(classes: DataFrame, k: int, percent: int) -> DataFrame:
    """(v, node, n, typical): each class under the rarest values of its sketch that decide; ``typical`` grows with how common its values are."""
    values = classes.select("node", F.explode("sketch").alias("v"))
    held = materialise(classes.sparkSession, values.groupBy("v").agg(F.count("*").alias("held")).where("held > 1"), "minhash_values")
    shared = values.join(held, "v").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("held", "v"))).alias("s"))
    shared = shared.join(classes.select("node", "n"), "node").withColumn("c", needed(F.col("n"), k, percent)).where(F.size("s") >= F.col("c"))
    typical = F.aggregate("s", F.lit(0).cast("long"), lambda t, x: t + x["held"])
    rarest = F.slice("s", F.lit(1), F.size("s") - F.col("c") + 1)
    return shared.select("node", "n", typical.alias("typical"), F.explode(rarest).alias("e")).select("e.v", "node", "n", "typical")


def comparable(n: Column, other: Column, percent: int) -> Column:
    """Whether sets of these sizes can reach the similarity."""
    return F.least(n, other) * 100 >= F.greatest(n, other) * percent


def verified(pairs: DataFrame, sets: DataFrame, k: int, percent: int) -> DataFrame:
    """Those of the distinct pairs (a, b) that the union sketch lets pass and whose whole sets reach the similarity."""
    spark = pairs.sparkSession

    def with_sets(df: DataFrame, column: str) -> DataFrame:
        for side in ("a", "b"):
            own = sets.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col(column).alias(f"s_{side}"))
            df = df.join(own, side)
        return df

    sample = F.slice(F.array_sort(F.array_union("s_a", "s_b")), 1, k)
    common = F.size(F.array_intersect(sample, F.array_intersect("s_a", "s_b")))
    exact = F.ceil(F.size(sample) * percent / F.lit(100.0) - 1e-9)
    enough = F.when((F.size(sample) < k) & (F.greatest("n_a", "n_b") <= k), exact).otherwise(F.least(exact, F.lit(needed_overlap(k, percent))))
    likely = materialise(spark, with_sets(pairs, "sketch").where(common >= enough).select("a", "b"), "minhash_likely")
    both = F.size(F.array_intersect("s_a", "s_b")).cast("long")
    return with_sets(likely, "hashes").where(both * 100 >= (F.col("n_a") + F.col("n_b") - both) * percent).select("a", "b")


def star_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """Every list member with the list's most typical one."""
    heads = lists.groupBy("v").agg(F.max(F.struct("typical", "node", "n")).alias("head"), F.count("*").alias("size")).where("size > 1")
    heads = materialise(lists.sparkSession, heads.select("v", F.col("head.node").alias("head"), F.col("head.n").alias("head_n")), "minhash_heads")
    met = lists.join(heads, "v").where((F.col("node") != F.col("head")) & comparable(F.col("n"), F.col("head_n"), percent))
    return met.select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")).distinct()


def cross_pairs(members: Column, percent: int) -> Column:
    """Pairs (a, b) of different roots of an array of structs (node, n, root)."""

    def partners(x: Column) -> Column:
        def meets(y: Column) -> Column:
            return (x["node"] < y["node"]) & (x["root"] != y["root"]) & comparable(x["n"], y["n"], percent)

        return F.transform(F.filter(members, meets), lambda y: F.struct(x["node"].alias("a"), y["node"].alias("b")))

    return F.flatten(F.transform(members, partners))


def short_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of different roots in lists of bounded size."""
    member = F.struct("node", "n", "root")
    return rows.groupBy("v").agg(F.collect_list(member).alias("m")).select(F.explode(cross_pairs(F.col("m"), percent)).alias("p")).select("p.a", "p.b")


def crowded_pairs(crowded: DataFrame, sets: DataFrame, block: int, percent: int, k: int) -> DataFrame:
    """Pairs of different roots in crowded lists whose sketches of k overlap enough.

    A list's members are cut into blocks, and every two blocks meet in a cell of
    their own, where matrix products over slices of the values count the common
    values of all their sketches (31 bits of each value: equal values stay equal).
    Sketches that hold their whole sets are asked for the similarity itself.
    """
    short = F.transform(F.slice("hashes", 1, k), lambda x: x.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int"))
    known = sets.select("node", short.alias("short"), needed(F.col("n"), k, percent).alias("c"))
    blocks = F.ceil(F.col("size") / F.lit(block)).cast("int")
    rows = crowded.join(known, "node").withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("node", F.lit(5)), "blocks").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = rows.select("v", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "node", "n", "root", "c", "short")

    def meet(cell: pa.Table) -> pa.Table:
        node, n, root, c, own = (cell.column(x).to_numpy() for x in ("node", "n", "root", "c", "own"))
        lists = cell.column("short").combine_chunks()
        _, value, held = np.unique(lists.flatten().to_numpy(), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(node)), np.diff(lists.offsets.to_numpy()))
        again = held[value] > 1
        row, value = row[again], value[again]
        order = np.argsort(value, kind="stable")
        row, value = row[order], value[order]
        _, column = np.unique(value, return_inverse=True)
        low, high = cell.column("low")[0].as_py(), cell.column("high")[0].as_py()
        left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
        common = np.zeros((len(left), len(right)), dtype=np.float32)
        for at in range(0, int(column.max(initial=-1)) + 1, CELL_COLUMNS):
            first, last = np.searchsorted(column, (at, at + CELL_COLUMNS))
            matrix = np.zeros((len(node), CELL_COLUMNS), dtype=np.float32)
            matrix[row[first:last], column[first:last] - at] = 1
            common += matrix[left] @ matrix[right].T
        a, b = left[:, None], right[None, :]
        common += 2  # two values of one sketch may share their 31 bits
        whole = np.maximum(n[a], n[b]) <= k
        enough = np.where(whole, 100 * common >= percent * (n[a] + n[b] - common), common >= np.maximum(c[a], c[b]))
        ok = enough & (root[a] != root[b]) & (np.minimum(n[a], n[b]) * 100 >= percent * np.maximum(n[a], n[b]))
        if low == high:
            ok &= node[a] < node[b]
        i, j = np.nonzero(ok)
        x, y = node[left[i]], node[right[j]]
        return pa.table({"a": np.minimum(x, y), "b": np.maximum(x, y)})

    return cells.groupBy("v", "low", "high").applyInArrow(meet, "a long, b long")


def hubs(found: DataFrame) -> DataFrame:
    """(node, root) for every linked node: the most linked node next to it (itself included), and that one's own hub.

    Equal roots lie in one component; it takes a few aggregates, and no loop, to see that a large group is one.
    """
    both = found.select(F.col("a").alias("node"), F.col("b").alias("next")).unionByName(found.select(F.col("b").alias("node"), F.col("a").alias("next")))
    degree = both.groupBy("node").agg(F.count("*").alias("degree"))
    reach = both.join(degree.withColumnRenamed("node", "next"), "next").select("node", F.struct("degree", "next").alias("hub"))
    own = degree.select("node", F.struct("degree", F.col("node").alias("next")).alias("hub"))
    hub = reach.unionByName(own).groupBy("node").agg(F.max("hub").alias("hub")).select("node", F.col("hub.next").alias("hub"))
    hub = materialise(found.sparkSession, hub, "minhash_hubs")
    return hub.join(hub.select(F.col("node").alias("hub"), F.col("hub").alias("root")), "hub").select("node", "root")


def links(classes: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int = 80, k: int = K, limit: int = LIST_LIMIT, growth: int = 16, block: int = BLOCK) -> DataFrame:
    """Verified links (a, b) whose transitive closure is that of all linking pairs of distinct sets.

    ``classes`` holds node, n and sketch; ``sets_of`` adds sketch and ``hashes`` to a table of nodes.
    """
    spark = classes.sparkSession
    found, sets, last = None, None, False
    while True:
        lists = materialise(spark, inverted_lists(classes, k, percent), "minhash_lists")
        if sets is None:
            sets = materialise(spark, sets_of(lists.select("node").distinct()), "minhash_sets")
        stars = materialise(spark, verified(star_pairs(lists, percent), sets, k, percent), "minhash_links")
        found = stars if found is None else found.unionByName(stars)
        roots = materialise(spark, hubs(found), "minhash_roots")
        placed = lists.join(roots, "node", "left").select("v", "node", "n", F.coalesce("root", "node").alias("root"))
        placed = materialise(spark, placed, "minhash_placed")
        open_lists = placed.groupBy("v").agg(F.count("*").alias("size"), F.min("root").alias("low"), F.max("root").alias("high")).where("low != high")
        open_lists = materialise(spark, open_lists.select("v", "size"), "minhash_open")
        members = placed.join(open_lists, "v")
        crowded = materialise(spark, members.where(F.col("size") > limit), "minhash_crowded")
        pairs = short_pairs(members.where(F.col("size") <= limit), percent)
        any_left = not crowded.isEmpty()
        if any_left and last:
            pairs = pairs.unionByName(crowded_pairs(crowded, sets, block, percent, k))
        found = found.unionByName(materialise(spark, verified(pairs.distinct(), sets, k, percent), "minhash_links"))
        if last or not any_left:
            return found
        k, last = k * growth, True
        again = sets.join(crowded.select("node").distinct(), "node", "left_semi")
        sets = classes = materialise(spark, again.withColumn("sketch", F.slice("hashes", 1, k)), "minhash_again")


def cluster(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 4, percent: int = 80, k: int = K, limit: int = LIST_LIMIT) -> DataFrame:
    """One row per row of ``df``: its id, ``n_shingles``, ``component_id`` (the smallest id that it reaches) and whether it is ``kept``."""
    spark = df.sparkSession
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), row_key(id_col, text_col).alias("row"))
    rows = materialise(spark, shingle_sets(texts, "text", shingle_words, k, whole=False), "minhash_rows")
    copies = rows.where("n > 0").groupBy("cid").agg(F.min("id").alias("id"), F.min("row").alias("row"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    classes = materialise(spark, copies.withColumn("node", F.monotonically_increasing_id()), "minhash_classes")

    def sets_of(nodes: DataFrame) -> DataFrame:
        """Whole sets, hashed again from one text of each class: few classes share enough values to need them."""
        wanted = materialise(spark, classes.select("node", "row").join(nodes, "node", "left_semi"), "minhash_wanted")
        once = likely_among(texts.select("text", "row"), wanted, "row").groupBy("row").agg(F.first("text").alias("text"))  # repeated rows
        return shingle_sets(once.join(wanted, "row").select("node", "text"), "text", shingle_words, k)

    linked = connected_components(links(classes, sets_of, percent, k, limit), "a", "b")
    members = materialise(spark, linked.join(classes.select("node", "id"), "node"), "minhash_members")
    least = materialise(spark, members.groupBy("root").agg(F.min("id").alias("component")), "minhash_components")
    found = materialise(spark, members.join(least, "root").select("node", "component"), "minhash_found")
    named = classes.select("node", "cid", "id").join(found, "node", "left").select("cid", F.coalesce("component", "id").alias("component"))
    named = materialise(spark, named, "minhash_named")
    told = rows.select("id", "n", "cid").join(named, "cid", "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    return told.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
