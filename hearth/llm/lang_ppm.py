"""Language identification by prediction by partial matching (PPM).

Per language a context tree of depth ``order`` over bytes holds how often each
byte followed each context. The probability of a byte is that of the longest
context in which it was seen, times the escape probabilities of the longer
contexts in which it was not (escape method C: a context with T occurrences and
U distinct bytes gives a byte seen n times n / (T + U) and escapes with
U / (T + U); below the empty context every byte costs 8 bits; symbols of longer
contexts are not excluded). The statistics are frozen after training, so the
code length of a byte after a context is a constant: the model stores it, for
every language at once, for each (context, byte) of the training text, and the
exact code length of a text is a sum of table entries. The language with the
shortest code length wins (ties: the smallest label).

Training text is a sample of at most about ``train_bytes`` bytes, split evenly
over the labels: pieces of ``PIECE`` bytes, chosen by a hash of the text and the
piece's number, at least one of every label. A text that a label repeats counts
once. Pieces carry the bytes before them as context, so all pieces of a text
count what the whole text does. A label without any text is not learned. The model holds
one entry per distinct (order + 1)-gram of it, hence is bounded; it is
broadcast. Texts are lower-cased first. Scoring walks whole texts in blocks of
``BLOCK`` bytes, so memory does not depend on text length. Only the lower-cased text
goes to Python, in an Arrow UDF; the other columns wait in the JVM.

A null text, or one without a letter, is ``und`` with score 0. Without any
labelled text every text is ``und``. Other columns pass through; columns named
like the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import text_bytes, unit_hash

UNDETERMINED = "und"
#: Bytes handled at a time; scoring holds some 100 bytes for each.
BLOCK = 1 << 17
PIECE = 1 << 12
RAW_BITS = 8.0
RESULTS = ["lang_pred", "score", "bits_per_byte"]


def gram_codes(raw: np.ndarray, offsets: np.ndarray, order: int, start: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
    """For bytes ``start..stop`` of the buffer: (order + 1)-gram ending there, as an integer, and the row it is in.

    Bytes before a text's first one count as zero.
    """
    inside = np.clip(offsets, start, stop)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(inside))
    codes = raw[start:stop].astype(np.uint64)
    for back in range(1, order + 1):
        lo = max(start, back)
        if lo < stop:
            codes[lo - start :] |= raw[lo - back : stop - back].astype(np.uint64) << np.uint64(8 * back)
    begins = offsets[:-1][(offsets[:-1] > start - order) & (offsets[:-1] < stop)]
    for known in range(order):  # bytes of the text before the last one
        at = begins + known
        at = at[(at >= start) & (at < stop)]
        codes[at - start] &= np.uint64((1 << (8 * (known + 1))) - 1)
    return codes, rows


def gram_counts(pieces: DataFrame, order: int) -> DataFrame:
    """(label, gram, n) over pieces (raw, label, lead), grams counted per block before the shuffle.

    The first ``lead`` bytes of a piece are context only.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offs = text_bytes(batch.column(0))
            labels = np.asarray(batch.column(1).to_pylist(), dtype=object)
            names, which = np.unique(labels.astype(str), return_inverse=True)
            begin = offs[:-1] + batch.column(2).to_numpy(zero_copy_only=False)
            for start in range(0, int(offs[-1]), BLOCK):
                codes, rows = gram_codes(raw, offs, order, start, min(start + BLOCK, int(offs[-1])))
                counted = np.arange(start, start + len(codes)) >= begin[rows]
                codes, of = codes[counted], which[rows[counted]]
                for i, name in enumerate(names):
                    grams, n = np.unique(codes[of == i], return_counts=True)
                    if len(grams):
                        yield pa.RecordBatch.from_arrays([pa.array([name] * len(grams)), pa.array(grams.view(np.int64)), pa.array(n.astype(np.int64))], names=["label", "gram", "n"])

    grams = pieces.select("raw", "label", "lead").mapInArrow(count, "label string, gram long, n long")
    return grams.groupBy("label", "gram").agg(F.sum("n").alias("n"))


class GramTable:
    """Sorted distinct grams with an open-addressing index for vectorised lookups."""

    MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)  # golden-ratio (Fibonacci) hashing

    def __init__(self, grams: np.ndarray):
        self.grams = grams
        size_bits = max(4, int(np.ceil(np.log2(max(len(grams), 1) * 4))))
        self.shift, self.mask = np.uint64(64 - size_bits), (1 << size_bits) - 1
        self.slots = np.full(1 << size_bits, -1, dtype=np.int32)
        todo = np.arange(len(grams))
        at = self._home(grams)
        while len(todo):
            free = self.slots[at] < 0
            self.slots[at[free]] = todo[free]  # of several for one slot the last stays
            lost = self.slots[at] != todo
            todo, at = todo[lost], (at[lost] + 1) & self.mask

    def _home(self, grams: np.ndarray) -> np.ndarray:
        return ((grams * self.MULTIPLIER) >> self.shift).astype(np.int64)

    def find(self, grams: np.ndarray) -> np.ndarray:
        """Index of each gram in ``grams``, -1 where absent."""
        if not len(self.grams):
            return np.full(len(grams), -1, dtype=np.int32)
        at = self._home(grams)
        found = self.slots[at]
        open_ = np.flatnonzero((found >= 0) & (self.grams[found] != grams))
        while len(open_):
            at[open_] = (at[open_] + 1) & self.mask
            found[open_] = now = self.slots[at[open_]]
            open_ = open_[(now >= 0) & (self.grams[now] != grams[open_])]
        return found


@dataclass
class PpmModel:
    """Code lengths in bits of every seen (context, byte), and escape lengths of every seen context, per order and language."""

    labels: list[str]
    order: int
    tables: list[GramTable]
    bits: list[np.ndarray]
    contexts: list[GramTable]
    escapes: list[np.ndarray]

    @classmethod
    def fit(cls, labels: list[str], order: int, label_index: np.ndarray, grams: np.ndarray, counts: np.ndarray) -> PpmModel:
        tables, bits, contexts, escapes = [], [], [], []
        for k in range(order + 1):
            at_order = grams & np.uint64((1 << (8 * (k + 1))) - 1)
            distinct, which = np.unique(at_order, return_inverse=True)
            n = np.zeros((len(distinct), len(labels)))
            np.add.at(n, (which, label_index), counts)
            ctx, of = np.unique(distinct >> np.uint64(8), return_inverse=True)
            total, kinds = np.zeros((len(ctx), len(labels))), np.zeros((len(ctx), len(labels)))
            np.add.at(total, of, n)
            np.add.at(kinds, of, n > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, np.log2((total + kinds) / kinds), 0.0)
                direct = np.log2((total + kinds)[of] / n)
            if k:
                shorter = tables[-1].find(distinct & np.uint64((1 << (8 * k)) - 1))
                fallback = bits[-1][shorter]
            else:
                fallback = np.full((len(distinct), len(labels)), RAW_BITS)
            tables.append(GramTable(distinct))
            bits.append(np.where(n > 0, direct, escape[of] + fallback).astype(np.float32))
            contexts.append(GramTable(ctx))
            escapes.append(escape.astype(np.float32))
        return cls(labels, order, tables, bits, contexts, escapes)

    def code_lengths(self, codes: np.ndarray, k: int | None = None) -> np.ndarray:
        """Bits of each gram's last byte after its context, one column per language."""
        k = self.order if k is None else k
        if k < 0:
            return np.full((len(codes), len(self.labels)), RAW_BITS, dtype=np.float32)
        at = self.tables[k].find(codes)
        out = self.bits[k][at]
        missed = np.flatnonzero(at < 0)
        if len(missed):
            rest = codes[missed]
            ctx = self.contexts[k].find(rest >> np.uint64(8))
            escape = np.where(ctx[:, None] >= 0, self.escapes[k][ctx], 0)
            out[missed] = escape + self.code_lengths(rest & np.uint64((1 << (8 * k)) - 1), k - 1)
        return out

    def text_bits(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Total code length of every text, one column per language."""
        out = np.zeros((len(offsets) - 1, len(self.labels)))
        end = int(offsets[-1])
        for start in range(0, end, BLOCK):
            codes, rows = gram_codes(raw, offsets, self.order, start, min(start + BLOCK, end))
            cost = self.code_lengths(codes).astype(np.float64)
            first = np.flatnonzero(np.diff(rows, prepend=-1))
            out[rows[first]] += np.add.reduceat(cost, first, axis=0)
        return out


def training_pieces(df: DataFrame, text_col: str, label_col: str, order: int, train_bytes: int) -> tuple[list[str], DataFrame | None]:
    """The labels that have text, and the sample as rows (label, raw, lead): a piece's bytes, the first ``lead`` of them context."""
    texts = df.where(F.col(text_col).isNotNull() & F.col(label_col).isNotNull()).select(F.lower(text_col).alias("t"), F.col(label_col).cast("string").alias("label"))
    rows = texts.where("t != ''").select("label", F.col("t").cast("binary").alias("raw"), F.xxhash64("t").alias("a"), F.xxhash64(F.lit(1), "t").alias("b"))
    size = F.octet_length("raw")
    numbers = F.sequence(F.lit(0), F.floor((size - 1) / PIECE).cast("int"))
    draw = lambda i: unit_hash("a", "b", i, seed=2)
    distinct = rows.select("label", "a", "b", size.alias("size"), F.array_min(F.transform(numbers, draw)).alias("low")).distinct()
    sizes = {r["label"]: (r["size"], r["low"]) for r in distinct.groupBy("label").agg(F.sum("size").alias("size"), F.min("low").alias("low")).collect()}
    labels = sorted(sizes)
    if not labels:
        return [], None
    share = train_bytes / len(labels)
    bound = F.coalesce(*[F.when(F.col("label") == name, max(min(1.0, share / sizes[name][0]), sizes[name][1])) for name in labels])
    lead = lambda i: F.least(i * PIECE, F.lit(order))
    cut = lambda i: F.struct(i.alias("piece"), lead(i).alias("lead"), F.substring("raw", i * PIECE - lead(i) + 1, lead(i) + PIECE).alias("raw"))
    chosen = rows.withColumn("bound", bound).select("label", "a", "b", F.explode(F.transform(F.filter(numbers, lambda i: draw(i) <= F.col("bound")), cut)).alias("p"))
    once = chosen.groupBy("label", "a", "b", "p.piece").agg(F.first("p.raw").alias("raw"), F.first("p.lead").alias("lead"))
    return labels, once.select("label", "raw", "lead")


def train(df: DataFrame, text_col: str = "text", label_col: str = "lang", order: int = 4, train_bytes: int = 8_000_000) -> PpmModel:
    """Fit on the rows of ``df`` that have text and label, at most about ``train_bytes`` bytes of them."""
    labels, pieces = training_pieces(df, text_col, label_col, order, train_bytes)
    if pieces is None:
        return PpmModel.fit([], order, np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0))
    grams = gram_counts(pieces, order).toPandas()
    index = {name: i for i, name in enumerate(labels)}
    return PpmModel.fit(labels, order, grams["label"].map(index).to_numpy(np.int64), grams["gram"].to_numpy(np.int64).view(np.uint64), grams["n"].to_numpy(np.float64))


def identify(df: DataFrame, model: PpmModel, text_col: str = "text") -> DataFrame:
    """``df`` with lang_pred, score (posterior of the winner under equal priors) and bits_per_byte (its code length)."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def score(lower: pa.Array, letters: pa.Array) -> pa.Array:
        ppm: PpmModel = shared.value
        raw, offs = text_bytes(lower)
        worded = np.array(letters.to_pylist(), dtype=bool)
        n = len(offs) - 1
        if not ppm.labels:
            return pa.StructArray.from_arrays([pa.array([UNDETERMINED] * n, pa.string()), pa.array(np.zeros(n)), pa.array([None] * n, pa.float64())], RESULTS)
        bits = ppm.text_bits(raw, offs)
        best = bits.argmin(axis=1)
        least = bits[np.arange(n), best]
        posterior = 1.0 / np.exp2(np.maximum(least[:, None] - bits, -1000.0)).sum(axis=1)
        names = [ppm.labels[i] if ok else UNDETERMINED for i, ok in zip(best, worded, strict=True)]
        per_byte = np.where(worded, least / np.maximum(np.diff(offs), 1), np.nan)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(np.where(worded, posterior, 0.0)), pa.array(per_byte, from_pandas=True)], RESULTS)

    # Called non-deterministic, since a filter on the results would else be pushed below them and score every text again.
    scored = F.arrow_udf(score, "lang_pred string, score double, bits_per_byte double").asNondeterministic()
    kept = [F.col(f"`{c.replace('`', '``')}`") for c in df.columns if c.lower() not in RESULTS]
    return df.withColumn("__found", scored(F.lower(text_col), has_letter(text_col))).select(*kept, "__found.*")


def held_out(id_col: str = "doc_id") -> Column:
    """The quarter of the documents that training never sees."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 4 == 2


def accepted(text_col: str = "text", judged_bytes: int = 64) -> Column:
    """A document is kept if a language was found and its model codes the text in fewer than 8 bits a byte.

    The escapes of a text's first bytes weigh too much in a short one: below ``judged_bytes`` bytes the language is enough.
    """
    return (F.col("lang_pred") != UNDETERMINED) & ((F.col("bits_per_byte") < RAW_BITS) | (F.octet_length(text_col) < judged_bytes))


def has_letter(text_col: str = "text") -> Column:
    return F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
