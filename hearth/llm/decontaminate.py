"""Benchmark decontamination with a generalised suffix automaton.

The normalised benchmark items (words of bytes: letters, digits and anything
non-ASCII, A-Z lower-cased) form one automaton over word numbers. A document is
streamed through it; the state and its matching length say at every word how
long the longest benchmark passage ending there is. Where that reaches
``window`` words, the last ``window`` of them are an item's window; an item of
fewer words counts where the whole of it ends. The words under such matches are
hit; maximal runs of them are the spans.

Items are taken in groups of at most about ``group_words`` words, each an
automaton of bounded size that is broadcast; several groups are streamed over
the documents one after the other inside the same tasks, without a shuffle.

Null texts have no words. An item without words matches nothing. An item with a
null id marks words but is named by the empty string. Items that share an id
count once. Input columns named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.llm.common import append_columns, text_bytes

#: Bytes of words after lower-casing; the others become blanks.
WORD_TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_TABLE).split()


@dataclass
class ItemAutomaton:
    """Generalised suffix automaton of items; what each state proves is precomputed."""

    window: int
    numbers: dict[bytes, int] = field(default_factory=dict)
    step: list[dict[int, int]] = field(default_factory=lambda: [{}])
    length: list[int] = field(default_factory=lambda: [0])
    link: list[int] = field(default_factory=lambda: [-1])
    #: state -> items whose window of ``window`` words ends there
    windows: dict[int, tuple[str, ...]] = field(default_factory=dict)
    #: state -> (words, item) of short items that end there, longest first; every length of an item's name
    short: dict[int, list[tuple[int, str]]] = field(default_factory=dict)

    @classmethod
    def build(cls, items: Iterable[tuple[str, bytes]], window: int) -> ItemAutomaton:
        made = cls(window)
        named = [(name, [made.numbers.setdefault(w, len(made.numbers)) for w in words_of(text)]) for name, text in items]
        for _, tokens in named:
            last = 0
            for token in tokens:
                last = made._extend(last, token)
        made._mark([x for x in named if x[1]])
        return made

    def _new(self, length: int, step: dict[int, int], link: int) -> int:
        self.length.append(length)
        self.step.append(step)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, parent: int, token: int, target: int) -> int:
        """A state for the strings of ``target`` that are no longer than parent's plus one."""
        copy = self._new(self.length[parent] + 1, dict(self.step[target]), self.link[target])
        self.link[target] = copy
        while parent >= 0 and self.step[parent].get(token) == target:
            self.step[parent][token] = copy
            parent = self.link[parent]
        return copy

    def _extend(self, last: int, token: int) -> int:
        known = self.step[last].get(token)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, token, known)
        new = self._new(self.length[last] + 1, {}, 0)
        at = last
        while at >= 0 and token not in self.step[at]:
            self.step[at][token] = new
            at = self.link[at]
        if at >= 0:
            target = self.step[at][token]
            self.link[new] = target if self.length[target] == self.length[at] + 1 else self._split(at, token, target)
        return new

    def _mark(self, named: list[tuple[str, list[int]]]) -> None:
        holders: dict[int, set[str]] = {}
        ends: dict[int, set[tuple[int, str]]] = {}
        for name, tokens in named:
            at = 0
            for token in tokens:
                at = up = self.step[at][token]
                while up > 0 and self.length[up] >= self.window and name not in holders.setdefault(up, set()):
                    holders[up].add(name)
                    up = self.link[up]
            if len(tokens) < self.window:
                ends.setdefault(at, set()).add((len(tokens), name))
        # a suffix link leads to a shorter state, so by length each state adds its own to what its link proves
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__):
            up = self.link[state]
            if self.length[state] >= self.window:
                self.windows[state] = self.windows[up] if self.length[up] >= self.window else tuple(sorted(holders[state]))
            own, above = ends.get(state), self.short.get(up, [])
            if own or above:
                self.short[state] = sorted({*own, *above}, reverse=True) if own else above

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Maximal hit spans (word numbers, end excluded) and the items that occur."""
        number, step, link, length, window = self.numbers.get, self.step, self.link, self.length, self.window
        windows, short = self.windows, self.short
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        at = matched = 0
        for i, word in enumerate(words):
            token = number(word)
            if token is None:
                at = matched = 0
                continue
            following = step[at].get(token)
            if following is None:
                while at and following is None:
                    at = link[at]
                    following = step[at].get(token)
                matched = length[at]
                if following is None:
                    at = matched = 0
                    continue
            at = following
            matched += 1
            if at not in short and (matched < window or at not in windows):
                continue
            hit = 0
            if matched >= window and at in windows:
                hit = window
                items.update(windows[at])
            for n, name in short.get(at, ()):
                if n <= matched:
                    hit = max(hit, n)
                    items.add(name)
            if hit:
                start = i + 1 - hit
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, i + 1))
        return spans, items


def merge_spans(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
ARROW_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def automata(items: DataFrame, id_col: str, text_col: str, window: int, group_words: int) -> list[ItemAutomaton]:
    """One automaton per group of items; a group is collected by itself and holds about ``group_words`` words."""
    size = F.octet_length(text_col) / 2 + 1  # at least the number of words
    total = items.where(F.col(text_col).isNotNull()).agg(F.sum(size)).first()[0] or 0
    groups = max(1, int(-(-total // group_words)))
    group = F.pmod(F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(text_col)), F.lit(groups))
    rows = items.where(F.col(text_col).isNotNull()).select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("t"), group.alias("g"))
    return [ItemAutomaton.build([(r["id"], r["t"].encode()) for r in rows.where(F.col("g") == g).sort("id", "t").collect()], window) for g in range(groups)]


def scan(df: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 13, group_words: int = 200_000) -> DataFrame:
    """``df`` with n_words, spans (hit word ranges) and items (sorted ids of the items that occur)."""
    fields = [T.StructField("n_words", T.LongType()), T.StructField("spans", SPANS), T.StructField("items", T.ArrayType(T.StringType()))]
    out = df
    for first, automaton in enumerate(automata(items, item_id, item_text, window, group_words)):
        shared = df.sparkSession.sparkContext.broadcast(automaton)

        def stream(batch: pa.RecordBatch, shared=shared, merging=first > 0) -> list[pa.Array]:
            column = lambda name: batch.column(batch.schema.get_field_index(name))
            raw, offs = text_bytes(column(text_col))
            before = [(s or [], i or []) for s, i in zip(column("spans").to_pylist(), column("items").to_pylist(), strict=True)] if merging else None
            counts, spans, found = np.zeros(len(offs) - 1, np.int64), [], []
            for k, (a, b) in enumerate(zip(offs[:-1], offs[1:], strict=True)):
                words = words_of(raw[a:b].tobytes())
                got, names = shared.value.scan(words)
                if before and (before[k][0] or got):
                    got = merge_spans([*got, *((s["start"], s["end"]) for s in before[k][0])])
                    names = names | set(before[k][1])
                counts[k] = len(words)
                spans.append([{"start": s, "end": e} for s, e in got])
                found.append(sorted(names))
            return [pa.array(counts), pa.array(spans, ARROW_SPANS), pa.array(found, pa.list_(pa.string()))]

        out = _append(out, stream, fields, keep=first > 0)
    return out


def _append(df: DataFrame, fn, fields: list[T.StructField], keep: bool) -> DataFrame:
    """append_columns, or the same with the earlier results readable by ``fn``."""
    if not keep:
        return append_columns(df, fn, fields)
    renamed = [T.StructField(f"__new_{f.name}", f.dataType) for f in fields]
    merged = append_columns(df, fn, renamed)
    return merged.drop(*[f.name for f in fields]).withColumnsRenamed({f"__new_{f.name}": f.name for f in fields})


def hit_words() -> Column:
    """Number of hit words of a scanned row."""
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))


def contaminated(n_hit: Column, n_words: Column, per: int = 20) -> Column:
    """Hit words make up at least one in ``per`` words."""
    return (n_hit > 0) & (n_hit * per >= n_words)


def remove_spans(
    df: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 13, per: int = 20, chars_col: str | None = None,
) -> DataFrame:
    """``df`` without contaminated rows, and with the remaining hit spans cut out of the text.

    A span is cut from the first byte of its first word to the last byte of its last word;
    spans are judged on the input, not on what a cut brings together. ``chars_col`` names a
    column of text lengths that a cut text renews; rows without a span stay as they are,
    and input columns named like a result of ``scan`` keep their values.
    """
    aside = {c: f"__in_{k}" for k, c in enumerate(df.columns) if c.lower() in ("n_words", "spans", "items")}
    scanned = scan(df.withColumnsRenamed(aside), items, text_col, item_id, item_text, window)
    kept = scanned.where(~contaminated(hit_words(), F.col("n_words"), per))

    def cut(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
        spans = batch.column(batch.schema.get_field_index("spans")).to_pylist()
        return [pa.array([t if not s else cut_words(t.encode(), [(x["start"], x["end"]) for x in s]).decode() for t, s in zip(texts, spans, strict=True)], pa.string())]

    cleaned = append_columns(kept, cut, [T.StructField("__clean", T.StringType())])
    if chars_col:
        renewed = F.length("__clean").cast(df.schema[chars_col].dataType)
        cleaned = cleaned.withColumn(chars_col, F.when(F.size("spans") > 0, renewed).otherwise(F.col(chars_col)))
    cleaned = cleaned.withColumn(text_col, F.col("__clean"))
    return cleaned.select(*[F.col(aside.get(c, c)).alias(c) for c in df.columns])


def cut_words(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``text`` without the words of the given ranges and what stands between them."""
    flat = np.frombuffer(text.translate(WORD_TABLE), dtype=np.uint8) != 0x20
    edges = np.flatnonzero(np.diff(flat, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    out, at = [], 0
    for a, b in spans:
        out.append(text[at : starts[a]])
        at = ends[b - 1]
    return b"".join([*out, text[at:]])
