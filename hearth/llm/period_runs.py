"""Periodic runs of words: a stretch that repeats itself many times over, found and collapsed.

A run is a stretch of consecutive words whose smallest period is q (words q apart
are identical), at least ``max(min_length, min_exponent * q)`` words long, that no
neighbouring word extends keeping period q.

Seed and extend on diagonals. On the diagonal of lag q a run is a stretch of at
least ``(min_exponent - 1) * q`` equal pairs (i, i + q). Lags are taken in classes
[s, 2s), s = 1, 2, 4, ...: every such stretch holds a whole k-gram that starts at
a multiple of a step, where k and the step are the powers of two that the class
guarantees (k = 2s, step s for exponent 4). k-grams are named by pairs of names of
half their length, so equal names are equal words, not equal hashes. An index
(name, position) gives the occurrences of each seed at lags s to 2s - 1 within its
own document: at most as many pairs as words, in every class. Seeds of one lag are
taken in order of position, and one that starts no later than the lag's furthest
covered position is suppressed; what remains is one seed chain per stretch,
extended to both sides by the names of shorter grams. A stretch found under a
multiple of its smallest period is the same stretch (Fine and Wilf), so the
smallest lag of equal stretches is the period.

Documents are independent, so nothing is shuffled and no document is cut. Work is
n log n in the words of a document whatever its repeats; tasks hold about
``PIECE_WORDS`` words at a time, or one document.

Null and blank texts have no words and no runs. Ties, repeated rows: every row has
its own result. An input column called like a result column is replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.llm.common import append_columns, text_bytes

PIECE_WORDS = 1 << 18
RUN = T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")])
ARROW_RUN = pa.list_(pa.struct([pa.field(n, pa.int64(), False) for n in ("start", "length", "period")]))

Rewrite = Callable[[int | None, list[bytes]], list[bytes]]


def name_grams(names: np.ndarray, half: int) -> np.ndarray:
    """Names of the grams twice as long: 0 and up where a gram occurs again, below 0 (its own) where it does not."""
    longer = -1 - np.arange(len(names), dtype=np.int64)
    at = np.flatnonzero((names[: max(0, len(names) - half)] >= 0) & (names[half:] >= 0))
    if len(at):
        pairs = names[at] * (int(names.max()) + 1) + names[at + half]
        _, name, count = np.unique(pairs, return_inverse=True, return_counts=True)
        again = count[name] > 1
        longer[at[again]] = name[again]
    return longer


def seed_pairs(names: np.ndarray, doc_end: np.ndarray, low: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, lag) of every seed at a multiple of ``step`` and its occurrences at lags ``low`` to ``2 * low - 1``."""
    at = np.flatnonzero(names >= 0)
    width = len(names) + 1
    index = np.sort(names[at] * width + at)
    seeds = at[at % step == 0]
    base = names[seeds] * width
    first = np.searchsorted(index, base + np.minimum(seeds + low, doc_end[seeds]))
    count = np.searchsorted(index, base + np.minimum(seeds + 2 * low, doc_end[seeds])) - first
    position = np.repeat(seeds, count)
    entry = np.arange(len(position)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
    return position, index[entry] % width - position


def extend(levels: list[np.ndarray], begin: np.ndarray, end: np.ndarray, lag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal stretches [begin, end) of the diagonals, moved out to their first unequal pair on both sides."""
    for h in range(len(levels) - 1, -1, -1):
        names, size = levels[h], 1 << h
        before = np.maximum(begin - size, 0)
        begin = np.where((begin >= size) & (names[before] == names[before + lag]), before, begin)
        last = len(names) - size
        after = np.minimum(end, last)
        other = np.minimum(end + lag, last)
        end = np.where((end + lag <= last) & (names[after] == names[other]), end + size, end)
    return begin, end


def find_runs(docs: list[list[bytes]], min_length: int = 6, min_exponent: int = 4) -> list[np.ndarray]:
    """Per document an array of (start, length, period), by start and then period."""
    if min_exponent < 2:
        raise ValueError("min_exponent must be 2 or more")
    sizes = np.array([len(d) for d in docs], dtype=np.int64)
    total = int(sizes.sum()) + len(docs) + 1  # one separator before each document and one at the end
    starts = np.cumsum(sizes + 1) - sizes
    known: dict[bytes, int] = {}
    names = -1 - np.arange(total, dtype=np.int64)
    doc_end = np.zeros(total, dtype=np.int64)
    for start, words in zip(starts.tolist(), docs, strict=True):
        names[start : start + len(words)] = [known.setdefault(w, len(known)) for w in words]
        doc_end[start : start + len(words)] = start + len(words)
    found, levels, low = [], [names], 1
    while low * min_exponent <= sizes.max(initial=0):
        # the guaranteed stretch of (min_exponent - 1) * low pairs holds an aligned gram of k words
        k, step = (2 * low, low) if min_exponent >= 4 else (low, low) if min_exponent == 3 else (max(1, low // 2),) * 2
        while len(levels) < k.bit_length():
            levels.append(name_grams(levels[-1], 1 << (len(levels) - 1)))
        grams = levels[k.bit_length() - 1]
        if not (grams >= 0).any():
            break
        position, lag = seed_pairs(grams, doc_end, low, step)
        order = np.lexsort((position, lag))
        position, lag = position[order], lag[order]
        # per lag, a seed that begins a step after the one before lies inside what that one covers
        head = np.ones(len(position), dtype=bool)
        head[1:] = (lag[1:] != lag[:-1]) | (position[1:] != position[:-1] + step)
        tail = np.append(head[1:], True)[: len(head)]
        begin, end = extend(levels[: k.bit_length()], position[head], position[tail] + k, lag[head])
        length = end + lag[head] - begin
        good = length >= np.maximum(min_length, min_exponent * lag[head])
        found.append(np.stack([begin[good], length[good], lag[head][good]], axis=1))
        low *= 2
    runs = np.concatenate(found) if found else np.zeros((0, 3), dtype=np.int64)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), dtype=bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)  # equal stretches: the smallest period
    runs = runs[first]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    owner = np.searchsorted(starts, runs[:, 0], side="right") - 1
    cuts = np.searchsorted(owner, np.arange(len(docs) + 1))
    runs[:, 0] -= starts[owner] if len(docs) else 0
    return [runs[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not len(runs):
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    inside = np.cumsum(edge)[:-1] > 0
    return b" ".join([words[i] for i in np.flatnonzero(~inside).tolist()])


def pieces(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold at most ``most`` bytes together, or one row."""
    begin, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > begin and held + n > most:
            yield begin, i
            begin, held = i, 0
        held += n
    if len(sizes):
        yield begin, len(sizes)


def collapse_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 6, min_exponent: int = 4, rewrite: Rewrite | None = None) -> DataFrame:
    """``df`` without its text, with ``n_words``, ``runs`` (start, length, period by start, then period) and the ``collapsed`` text.

    ``rewrite(id, words)`` may change a document's words before the search.
    """

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        raw, offs = text_bytes(batch.column(batch.schema.get_field_index(text_col)))
        ids = batch.column(batch.schema.get_field_index(id_col))
        n_words, texts, parts, counts = [], [], [], []
        for a, b in pieces(np.diff(offs), 6 * PIECE_WORDS):
            docs = [raw[offs[i] : offs[i + 1]].tobytes().split() for i in range(a, b)]
            if rewrite is not None:
                docs = [rewrite(i, words) for i, words in zip(ids.slice(a, b - a).to_pylist(), docs, strict=True)]
            found = find_runs(docs, min_length, min_exponent)
            n_words += [len(d) for d in docs]
            texts += [collapse(d, r) for d, r in zip(docs, found, strict=True)]
            counts += [len(r) for r in found]
            parts += found
        runs = np.concatenate(parts) if parts else np.zeros((0, 3), dtype=np.int64)
        flat = pa.StructArray.from_arrays([pa.array(runs[:, i]) for i in range(3)], fields=list(ARROW_RUN.value_type))
        offsets = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)]).astype(np.int32)
        return [
            pa.array(n_words, pa.int64()),
            pa.ListArray.from_arrays(pa.array(offsets), flat),
            pa.array(texts, pa.binary()).cast(pa.string()),
        ]

    fields = [T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN, False)), T.StructField("collapsed", T.StringType())]
    return append_columns(df, compute, fields, drop=(text_col,))


def longest_run(runs: Column) -> Column:
    """The run with the greatest length (ties: smallest start, then period); null without runs."""
    ranked = F.transform(runs, lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length")))
    return F.array_min(ranked)


def run_lines(runs: Column) -> Column:
    """All runs as text: ``start,length,period`` and a line feed each."""

    def line(r: Column) -> Column:
        return F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))

    return F.array_join(F.transform(runs, line), "")
