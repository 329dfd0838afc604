"""Exact removal of long repeated byte strings by a hash-compared suffix sort.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere
else, in another text or in the same one. Texts are taken as UTF-8.

Every window of ``length`` bytes is represented by its anchor: the ``GRAM``-byte
string in it whose prefix-polynomial hash is least (the leftmost of equals).
Equal windows have equal anchors at equal distances, so windows need to be
compared only where their anchors' grams agree. Consecutive windows with one
anchor form a region. The table of anchors holds about one row per 170 bytes,
and is all that is exchanged of texts without repeats.

* Anchors whose gram occurs once are done. Equal regions form a class, found by
  counting (gram, digest); all windows of a class of two or more are repeats.
* Different regions with the same gram (where repeats begin and end) are sorted:
  the suffixes from the anchor on, and the reversed prefixes before it, by a
  mergesort that compares two suffixes by binary search for their common
  extension on prefix-polynomial hashes. Two windows at the same distance from
  their anchors are equal if no common extension between them in the two orders
  is too short. Every adjacent pair is verified on its bytes; if hashes lied, the
  sort is done again with another multiplier.
* A gram with more than ``GROUP`` classes is dealt out over salted groups; windows
  that stay single in a group meet the other groups' windows in a second exchange
  by (gram, distance, hash), one row per distinct window of a group.

Null texts are empty. Texts shorter than ``length`` lose nothing. Rows that
repeat id and text are separate texts, so they are each other's repeats; their windows
are gathered once, however many they are. Input columns of any names pass through, but
for those named like a result (``n_bytes``, ``spans``, ``kept``, ``n_repeated_words``), which are replaced.

Passages can also be told by their number of words, whatever their bytes: every word becomes
``CODE`` bytes of its hash, and the same search finds the strings of ``words`` words that also
start elsewhere. They are counted, not removed. Words are compared by these 32 bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.llm.common import append_columns, likely_among, materialise, row_key, text_bytes

GRAM = 64
GROUP = 2048
#: Bytes handled at a time; positions in a piece must fit PLACE bits.
PIECE = 1 << 18
PLACE = 22
SORT_BYTES = 1 << 21
CODE = 4

Reader = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]


def polynomial(seed: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random byte values, and the powers and inverse powers of an odd multiplier, modulo 2^64."""
    rng = np.random.default_rng(seed)
    values = rng.integers(1, 1 << 63, 256, dtype=np.uint64)
    base = int(rng.integers(1 << 62, 1 << 63, dtype=np.uint64)) | 5
    inverse = pow(base, -1, 1 << 64)
    power = lambda x: np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, x, np.uint64)]))
    return values, power(base), power(inverse)


def scramble(h: np.ndarray) -> np.ndarray:
    """Spread polynomial hashes over all bits (xor-shift-multiply rounds)."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def word_codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) like text_bytes, with CODE bytes of hash for each word ``[^\\x20\\x09-\\x0D]+`` of the texts."""
    raw, offs = text_bytes(column)
    word = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    edge = np.zeros(len(raw) + 1, dtype=bool)
    edge[offs] = True
    begin = np.flatnonzero(word & (edge[:-1] | ~np.concatenate([[False], word[:-1]])))
    end = np.flatnonzero(word & (edge[1:] | ~np.concatenate([word[1:], [False]]))) + 1
    values, powers, inverses = polynomial(4, PIECE)
    codes, i = np.empty(len(begin), dtype=np.uint32), 0
    while i < len(begin):
        j = max(i + 1, int(np.searchsorted(end, begin[i] + PIECE, side="right")))
        data, at = raw[begin[i] : end[j - 1]], begin[i:j] - begin[i]
        if len(data) >= len(powers):  # a word longer than a piece
            values, powers, inverses = polynomial(4, len(data))
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(values[data] * powers[: len(data)], out=sums[1:])
        codes[i:j] = scramble((sums[end[i:j] - begin[i]] - sums[at]) * inverses[at]) >> np.uint64(32)
        i = j
    return codes.view(np.uint8), np.searchsorted(begin, offs) * CODE


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, from running minima forth and back within blocks."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(values)] = values
    grid = padded.reshape(blocks, width)
    forth = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], forth[width - 1 : width - 1 + n])


class AnchorFinder:
    """Anchors of all windows of the texts in a buffer."""

    def __init__(self, length: int):
        self.length, self.width = length, length - GRAM + 1
        self.values, self.powers, self.inverses = polynomial(3, PIECE + length + 1)

    def pieces(self, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
        """Byte ranges of at most PIECE window starts: whole texts, or parts of a longer one."""
        start, end = 0, int(offsets[-1])
        bounds = offsets[1:]
        while start < end:
            stop = int(bounds[max(np.searchsorted(bounds, start + PIECE, side="right") - 1, 0)])
            if stop <= start:  # a text longer than a piece
                stop = min(start + PIECE, int(bounds[np.searchsorted(bounds, start, side="right")]))
            yield start, stop
            start = stop

    def find(self, raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Per piece: text number, first window, windows, anchor's distance from the first window, gram, digest."""
        for start, stop in self.pieces(offsets):
            of_last = int(offsets[np.searchsorted(offsets, stop - 1, side="right")])
            data = raw[start : min(stop + self.length - 1, of_last)]  # windows that begin in the piece may end behind it
            if len(data) < self.length:
                continue
            inside = np.clip(offsets, start, start + len(data)) - start
            text = np.repeat(np.arange(len(offsets) - 1), np.diff(inside))
            sums = np.zeros(len(data) + 1, dtype=np.uint64)
            np.cumsum(self.values[data] * self.powers[: len(data)], out=sums[1:])
            grams = scramble((sums[GRAM:] - sums[:-GRAM]) * self.inverses[: len(data) - GRAM + 1])
            place = np.arange(len(grams), dtype=np.uint64)
            least = sliding_min(grams >> np.uint64(PLACE) << np.uint64(PLACE) | place, self.width)
            anchor = (least & np.uint64((1 << PLACE) - 1)).astype(np.int64)
            windows = np.flatnonzero((text[: len(anchor)] == text[self.length - 1 : self.length - 1 + len(anchor)]) & (np.arange(len(anchor)) < stop - start))
            if not len(windows):
                continue
            at = anchor[windows]
            first = np.flatnonzero((np.diff(at, prepend=-1) != 0) | (np.diff(windows, prepend=-2) != 1))
            count = np.diff(np.append(first, len(windows)))
            begin = windows[first]
            view = memoryview(data.tobytes())
            digest = [xxhash.xxh3_64_intdigest(view[b : b + n + self.length - 1]) for b, n in zip(begin.tolist(), count.tolist(), strict=True)]
            which = text[begin]
            yield which, begin + start - offsets[which], count, at[first] - begin, grams[at[first]].view(np.int64), np.array(digest, dtype=np.uint64).view(np.int64)


def anchors(keyed: DataFrame, text_col: str, length: int, read: Reader = text_bytes) -> DataFrame:
    """(a, b, p, n, q, gram, d): text key, first window, number of windows, anchor's distance, gram hash, region digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = AnchorFinder(length)
        for batch in batches:
            raw, offs = read(batch.column(2))
            for which, p, n, q, gram, d in finder.find(raw, offs):
                at = pa.array(which)
                cols = [batch.column(0).take(at), batch.column(1).take(at), pa.array(p.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(q.astype(np.int32)), pa.array(gram), pa.array(d)]
                yield pa.RecordBatch.from_arrays(cols, names=["a", "b", "p", "n", "q", "gram", "d"])

    return keyed.select("a", "b", text_col).mapInArrow(run, "a long, b int, p int, n int, q int, gram long, d long")


# ---------------------------------------------------------------- suffix sort


class Suffixes:
    """Rows of bytes (a matrix and the rows' lengths) with their prefix-polynomial hashes."""

    def __init__(self, data: np.ndarray, lengths: np.ndarray, groups: np.ndarray, seed: int):
        values, powers, _ = polynomial(seed, data.shape[1] + 1)
        self.data, self.lengths, self.groups = data, lengths, groups
        self.sums = np.zeros((data.shape[0], data.shape[1] + 1), dtype=np.uint64)
        np.cumsum(values[data] * powers[: data.shape[1]], axis=1, out=self.sums[:, 1:])

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common extension of rows i and j: binary search for the last equal prefix hash."""
        low, high = np.zeros(len(i), np.int64), np.minimum(self.lengths[i], self.lengths[j])
        while (open_ := low < high).any():
            middle = (low + high + 1) // 2
            equal = self.sums[i, middle] == self.sums[j, middle]
            low = np.where(open_ & equal, middle, low)
            high = np.where(open_ & ~equal, middle - 1, high)
        return low

    def less(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Row i comes before row j: by group, then by bytes, a prefix first."""
        out = self.groups[i] < self.groups[j]
        same = np.flatnonzero(self.groups[i] == self.groups[j])
        a, b = i[same], j[same]
        ext = self.common(a, b)
        ended = (ext == self.lengths[a]) | (ext == self.lengths[b])
        at = np.minimum(ext, self.data.shape[1] - 1)
        out[same] = np.where(ended, self.lengths[a] < self.lengths[b], self.data[a, at] < self.data[b, at])
        return out

    def order(self) -> np.ndarray:
        """Merge sort: all runs of a level are merged at once, each row finding its place in the sibling run."""
        n = len(self.lengths)
        order, run = np.arange(n), 1
        while run < n:
            place = np.arange(n)
            block = place // run
            left = block % 2 == 0
            other = np.where(left, (block + 1) * run, (block - 1) * run)
            low, high = np.minimum(other, n), np.minimum(other + run, n)
            while (open_ := np.flatnonzero(low < high)).size:
                middle = (low[open_] + high[open_]) // 2
                mine, theirs = order[open_], order[middle]
                # a row of the left run goes before its equals of the right run
                before = np.where(left[open_], True, False)
                passed = np.empty(len(open_), dtype=bool)
                passed[before] = self.less(theirs[before], mine[before])
                passed[~before] = ~self.less(mine[~before], theirs[~before])
                low[open_] = np.where(passed, middle + 1, low[open_])
                high[open_] = np.where(passed, high[open_], middle)
            start = np.where(left, block * run, (block - 1) * run)
            target = start + (place - block * run) + (low - np.minimum(other, n))
            merged = np.empty_like(order)
            merged[target] = order
            order, run = merged, run * 2
        return order

    def verified(self) -> tuple[np.ndarray, np.ndarray] | None:
        """(order, common extension with the row before; -1 at a group's first), or None where hashes lied."""
        order = self.order()
        a, b = order[:-1], order[1:]
        same = self.groups[a] == self.groups[b]
        equal = self.data[a] == self.data[b]
        shortest = np.minimum(self.lengths[a], self.lengths[b])
        equal &= np.arange(self.data.shape[1]) < shortest[:, None]
        ext = np.where(equal.all(axis=1), self.data.shape[1], equal.argmin(axis=1))
        at = np.minimum(ext, self.data.shape[1] - 1)
        row = np.arange(len(a))
        sorted_ = np.where(ext == shortest, self.lengths[a] <= self.lengths[b], self.data[a][row, at] < self.data[b][row, at])
        if (same & ~sorted_).any() or (same & (self.common(a, b) != ext)).any():
            return None
        return order, np.concatenate([[-1], np.where(same, ext, -1)])


def sort_suffixes(data: np.ndarray, lengths: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    for seed in range(5, 25):
        if (found := Suffixes(data, lengths, groups, seed).verified()) is not None:
            return found
    raise RuntimeError("suffix sort: every multiplier collided")


def repeated_windows(regions: list[bytes], n: np.ndarray, q: np.ndarray, groups: np.ndarray, weight: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(repeat, single): matrices over (region, window) of windows that occur twice or more among the regions of
    their group, and of windows that are the first of their kind there. ``weight`` counts a region's own copies."""
    rows, width = len(regions), int(n.max())
    right, left = np.zeros((rows, length), np.uint8), np.zeros((rows, max(1, int(q.max()))), np.uint8)
    for i, (r, at) in enumerate(zip(regions, q.tolist(), strict=True)):
        whole = np.frombuffer(r, np.uint8)
        tail = whole[at : at + length]
        right[i, : len(tail)] = tail
        left[i, :at] = whole[:at][::-1]
    sizes = n - 1 + length
    r_order, r_ext = sort_suffixes(right, np.minimum(sizes - q, length), groups)
    l_order, l_ext = sort_suffixes(left, q.copy(), groups)
    repeat, first = np.zeros((rows, width), bool), np.zeros((rows, width), bool)
    r_class, l_class = np.empty(rows, np.int64), np.empty(rows, np.int64)
    for distance in range(int((q - n + 1).min()), int(q.max()) + 1):  # of the anchor from the window's start
        active = np.flatnonzero((distance <= q) & (distance > q - n))
        if not len(active):
            continue
        r_class[r_order] = np.cumsum(r_ext < length - distance)
        l_class[l_order] = np.cumsum(l_ext < distance)
        kind = r_class[active] * (rows + 1) + l_class[active]
        _, one, which = np.unique(kind, return_index=True, return_inverse=True)
        copies = np.bincount(which, weight[active])
        window = q[active] - distance
        repeat[active, window] = copies[which] >= 2
        first[active[one], window[one]] = True
    return repeat, first


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, length) of the runs of True in the rows of a matrix."""
    edge = np.diff(np.pad(mask, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, start = np.nonzero(edge == 1)
    return row, start, np.nonzero(edge == -1)[1] - start


MEMBER = "gram long, salt int, salts int, a long, b int, p int, n int, q int, weight int, region binary"
OUTCOME = "a long, b int, p int, n int, gram long, distance int, h long, weight int"


def outcome(table: pa.Table, length: int, step: int = 1) -> Iterator[pa.RecordBatch]:
    """Repeated window runs of complete groups; for salted grams also their windows for the second exchange (with h).

    Only windows that begin at a multiple of ``step`` go there; nobody asks for the others.
    """
    get = lambda c: table.column(c).to_numpy()
    n, q, p, weight, salts, gram = get("n").astype(np.int64), get("q").astype(np.int64), get("p"), get("weight"), get("salts"), get("gram")
    regions = table.column("region").to_pylist()
    groups = np.cumsum((np.diff(gram, prepend=gram[:1]) != 0) | (np.diff(get("salt"), prepend=0) != 0))
    repeat, first = repeated_windows(regions, n, q, groups, weight, length)
    row, start, count = runs(repeat)
    a, b = table.column("a").combine_chunks(), table.column("b").combine_chunks()
    names = ["a", "b", "p", "n", "gram", "distance", "h", "weight"]

    def rows(at, start, count, distance, h, w) -> pa.RecordBatch:
        i = pa.array(at)
        cols = [a.take(i), b.take(i), pa.array((p[at] + start).astype(np.int32)), pa.array(count.astype(np.int32)), pa.array(gram[at]), pa.array(distance, pa.int32()), pa.array(h, pa.int64()), pa.array(w, pa.int32())]
        return pa.RecordBatch.from_arrays(cols, names=names)

    mine = weight[row] < 2  # windows of copied regions are known to be repeats
    none = [None] * int(mine.sum())
    yield rows(row[mine], start[mine], count[mine], none, none, none)
    at, window = np.nonzero(first & (salts > 1)[:, None] & ((p[:, None] + np.arange(first.shape[1])) % step == 0))
    if len(at):
        values, powers, _ = polynomial(2, length)
        h = np.empty(len(at), np.uint64)
        for i in np.unique(at):
            of = at == i
            data = values[np.frombuffer(regions[i], np.uint8)]
            h[of] = (np.lib.stride_tricks.sliding_window_view(data, length)[window[of]] * powers[:length]).sum(axis=1, dtype=np.uint64)
        known = np.where(repeat[at, window], 2, 1)
        yield rows(at, window, np.ones(len(at), np.int64), q[at] - window, h.view(np.int64), known)


def resolve(batches: Iterator[pa.RecordBatch], length: int, step: int = 1) -> Iterator[pa.RecordBatch]:
    """outcome() over a stream of members sorted by (gram, salt), a bounded number of whole groups at a time."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        waiting.append(batch)
        table = pa.Table.from_batches(waiting)
        if table.nbytes < SORT_BYTES:
            continue
        gram, salt = table.column("gram").to_numpy(), table.column("salt").to_numpy()
        starts = np.flatnonzero((np.diff(gram) != 0) | (np.diff(salt) != 0)) + 1
        if len(starts):  # all groups but the last are whole
            cuts = [0]
            for s in starts:  # bounded pieces of whole groups
                if (s - cuts[-1]) * 2 * length >= SORT_BYTES:
                    cuts.append(int(s))
            if cuts[-1] != starts[-1]:
                cuts.append(int(starts[-1]))
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                yield from outcome(table.slice(lo, hi - lo), length, step)
            waiting = table.slice(cuts[-1]).to_batches()
    table = pa.Table.from_batches(waiting) if waiting else None
    if table is not None and table.num_rows:
        gram, salt = table.column("gram").to_numpy(), table.column("salt").to_numpy()
        starts = [*(np.flatnonzero((np.diff(gram) != 0) | (np.diff(salt) != 0)) + 1).tolist(), table.num_rows]
        lo = 0
        for s in starts:
            if (s - lo) * 2 * length >= SORT_BYTES or s == table.num_rows:
                yield from outcome(table.slice(lo, s - lo), length, step)
                lo = s


def repeated(keyed: DataFrame, text_col: str, length: int, group: int, read: Reader = text_bytes, step: int = 1) -> DataFrame:
    """(a, b, p, n): runs of windows of each text, as ``read`` gives it, that occur elsewhere. Complete for multiples of ``step``."""
    spark = keyed.sparkSession
    every = materialise(spark, anchors(keyed, text_col, length, read), "anchors")
    # the counts are written first: a join of two plain exchanges is one that adaptive execution can split at hot grams
    twice = materialise(spark, every.groupBy("gram").agg(F.count("*").alias("c")).where("c > 1").select("gram"), "shared_grams")
    shared = materialise(spark, every.join(twice, "gram", "left_semi"), "shared_anchors")
    classes = shared.groupBy("gram", "d").agg(F.count("*").alias("copies"), F.min(F.struct("a", "b", "p", "n", "q")).alias("r"))
    classes = materialise(spark, classes, "regions")
    copied = shared.join(classes.where("copies > 1").select("gram", "d"), ["gram", "d"], "left_semi").select("a", "b", "p", "n")
    contested = materialise(spark, classes.groupBy("gram").agg(F.count("*").alias("m")).where("m > 1"), "contested_grams")
    salts = F.ceil(F.col("m") / F.lit(group)).cast("int")
    members = classes.join(contested, "gram").select(
        "gram", F.pmod(F.xxhash64("d"), salts.cast("long")).cast("int").alias("salt"), salts.alias("salts"), "r.*", F.least("copies", F.lit(2)).cast("int").alias("weight")
    )
    wanted = members.groupBy("a", "b").agg(F.collect_list(F.struct("gram", "salt", "salts", "p", "n", "q", "weight")).alias("m"))
    wanted = materialise(spark, wanted, "wanted")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offs = read(batch.column(2))
            lists = batch.column(3)
            per = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten()
            text = np.repeat(np.arange(len(per)), per)
            field = {f.name: flat.field(i) for i, f in enumerate(flat.type)}
            begin = offs[text] + field["p"].to_numpy()
            end = begin + field["n"].to_numpy() + length - 1
            at = pa.array(text)
            region = pa.array([raw[s:e].tobytes() for s, e in zip(begin.tolist(), end.tolist(), strict=True)], pa.binary())
            cols = [field["gram"], field["salt"], field["salts"], batch.column(0).take(at), batch.column(1).take(at), field["p"], field["n"], field["q"], field["weight"], region]
            yield pa.RecordBatch.from_arrays(cols, names=["gram", "salt", "salts", "a", "b", "p", "n", "q", "weight", "region"])

    # only texts that may be wanted are exchanged
    regions = likely_among(keyed.select("a", "b", text_col), wanted, "a").join(wanted, ["a", "b"]).mapInArrow(cut, MEMBER)
    dealt = regions.repartition("gram", "salt").sortWithinPartitions("gram", "salt")
    sorted_ = materialise(spark, dealt.mapInArrow(lambda batches: resolve(batches, length, step), OUTCOME), "suffix_sorted")
    found = sorted_.where("h is null").select("a", "b", "p", "n")
    across = sorted_.where("h is not null")
    agreed = across.groupBy("gram", "distance", "h").agg(F.sum("weight").alias("w"), F.count("*").alias("c")).where("w > 1 and c > 1").select("gram", "distance", "h")
    late = across.where("weight = 1").join(agreed, ["gram", "distance", "h"], "left_semi").select("a", "b", "p", "n")
    return copied.unionByName(found).unionByName(late)


SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def removed_spans(windows, length: int) -> list[tuple[int, int]]:
    """Maximal byte ranges covered by runs (p, n) of windows."""
    out: list[tuple[int, int]] = []
    for p, n in sorted(windows):
        if out and p <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], p + n - 1 + length))
        else:
            out.append((p, p + n - 1 + length))
    return out


def repeated_words(keyed: DataFrame, text_col: str, words: int, group: int) -> DataFrame:
    """(a, b, p, n): runs of strings of ``words`` words of each text that occur elsewhere; p is a word's number."""
    found = repeated(keyed, text_col, words * CODE, group, word_codes, CODE)
    first = F.ceil(F.col("p") / CODE).cast("int")  # strings of codes that begin inside a code are none of words
    last = F.floor((F.col("p") + F.col("n") - 1) / CODE).cast("int")
    return found.select("a", "b", first.alias("p"), (last - first + 1).alias("n")).where("n > 0")


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, group: int = GROUP, words: int = 0) -> DataFrame:
    """``df`` with n_bytes, spans (removed byte ranges) and kept (the remaining bytes).

    With ``words``, also n_repeated_words: the words covered by a string of that many words that also starts anywhere else.
    """
    if length <= GRAM:
        raise ValueError(f"length must be more than {GRAM}")
    if words and words * CODE <= GRAM:
        raise ValueError(f"words must be more than {GRAM // CODE}, or 0")
    key = row_key(id_col, text_col)
    keyed = df.withColumn("a", F.xxhash64(key)).withColumn("b", F.hash(F.lit(9), key)) if not {"a", "b"} & {c.lower() for c in df.columns} else None
    if keyed is None:
        renamed = df.withColumnsRenamed({c: f"__{c}" for c in df.columns if c.lower() in ("a", "b")})
        back = {f"__{c}": c for c in df.columns if c.lower() in ("a", "b")}
        names = {v: k for k, v in back.items()}
        return remove_repeats(renamed, names.get(id_col, id_col), names.get(text_col, text_col), length, group, words).withColumnsRenamed(back)
    runs_ = repeated(keyed, text_col, length, group).withColumn("w", F.lit(False))
    if words:
        runs_ = runs_.unionByName(repeated_words(keyed, text_col, words, group).withColumn("w", F.lit(True)))
    windows = runs_.distinct().groupBy("a", "b").agg(F.collect_list(F.struct("p", "n", "w")).alias("__w"))
    joined = keyed.join(windows, ["a", "b"], "left").drop("a", "b")

    def finish(batch: pa.RecordBatch) -> list[pa.Array]:
        column = lambda name: batch.column(batch.schema.get_field_index(name))
        raw, offs = text_bytes(column(text_col))
        spans, kept, covered = [], [], []
        for begin, end, found in zip(offs[:-1].tolist(), offs[1:].tolist(), column("__w").to_pylist(), strict=True):
            cuts = removed_spans([(w["p"], w["n"]) for w in found if not w["w"]], length) if found else []
            covered.append(sum(e - s for s, e in removed_spans([(w["p"], w["n"]) for w in found if w["w"]], words)) if found else 0)
            spans.append([{"start": s, "end": e} for s, e in cuts])
            edges = [0, *(x for c in cuts for x in c), end - begin]
            kept.append(b"".join(raw[begin + s : begin + e].tobytes() for s, e in zip(edges[::2], edges[1::2], strict=True)))
        columns = [pa.array(np.diff(offs)), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary()), pa.array(covered, pa.int64())]
        return columns[: len(fields)]

    fields = [T.StructField("n_bytes", T.LongType()), T.StructField("spans", SPAN), T.StructField("kept", T.BinaryType())]
    if words:
        fields.append(T.StructField("n_repeated_words", T.LongType()))
    return append_columns(joined, finish, fields, drop=("__w",))
