"""Conversation structure repair: the cheapest edits that give every conversation a legal order of roles.

Rows of a conversation are taken by turn (nulls first), then role and text. Edits:
Keep (0), Rerole to user or assistant (3), Delete (4), Insert an empty turn of user
or assistant (3); a truncated row that is not deleted costs 3 more, a blank or
duplicate one must be deleted. The roles' initials that remain read
``(s?(ua)+)?``. Among the cheapest repairs the one whose audit (the edits'
initials in order) is least in ASCII order is taken; an audit determines its
repair, since each edit's role follows from the state before it.

Persistent audit DP. A state is what has been emitted last: nothing, s, u or a.
Each state keeps its cheapest audit as a node (parent, edit), so that audits share
their prefixes. A node stores a rolling hash of its audit and ancestors at powers
of two; two audits of equal cost are compared at their first difference, found by
lifting both nodes while their hashes differ, and verified: the nodes before it are
followed down until they are one node, so a collision of hashes cannot decide. Two
audits that compete for a state never extend one another, because a longer one
would cost an insertion more; the first difference therefore decides for good.

At scale. Equal rows of a conversation are one row with a count; first occurrences
are a partial minimum. Rows are dealt by ranges of (conversation, turn, role, text)
and cut into chunks of 4096 rows, so a conversation of any size is spread over
tasks. A chunk that may continue a conversation is solved from each of the four
states; a second, tiny pass strings a conversation's chunks together with the same
persistent nodes, whose edits are now whole chunk audits. The digest of a repaired
conversation is taken in one stream over its rows, because SHA-256 is sequential;
it holds one row at a time.

A null id is a conversation of its own; null roles and texts are one space. Ties
are ordered by role and text; repeated rows are duplicates. Extra columns are
ignored. An empty table gives no rows; ids without rows can be passed in.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import materialise

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
CHUNK_BITS = 12
#: States, and the state that an emitted turn leads to: user from anywhere but after user, assistant after user.
START, SYSTEM, USER, ASSISTANT = range(4)
STEP = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
ROLE_AFTER = {USER: "user", ASSISTANT: "assistant"}
MODULUS, BASE = (1 << 61) - 1, 1_000_003


class Audits:
    """Audits as linked nodes that share prefixes; node 0 is the empty audit."""

    def __init__(self) -> None:
        self.parent, self.edit, self.depth, self.hash, self.up = [0], [b""], [0], [0], [()]

    def extend(self, node: int, edit: bytes) -> int:
        up, k = [node], 0
        while len(self.up[up[k]]) > k:  # the ancestor 2^(k+1) above is 2^k above the one 2^k above
            up.append(self.up[up[k]][k])
            k += 1
        self.parent.append(node)
        self.edit.append(edit)
        self.depth.append(self.depth[node] + 1)
        value = edit[0] if len(edit) == 1 else xxhash.xxh64_intdigest(edit)
        self.hash.append((self.hash[node] * BASE + value + 1) % MODULUS)
        self.up.append(tuple(up))
        return len(self.parent) - 1

    def lift(self, node: int, depth: int) -> int:
        while self.depth[node] > depth:
            up = self.up[node]
            node = up[min((self.depth[node] - depth).bit_length(), len(up)) - 1]
        return node

    def less(self, a: int, b: int) -> bool:
        """Whether audit ``a`` comes before audit ``b``."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self.lift(a, depth), self.lift(b, depth)
        if self.hash[x] != self.hash[y]:
            for k in range(len(self.up[x]) - 1, -1, -1):
                if k < len(self.up[x]) and self.hash[self.up[x][k]] != self.hash[self.up[y][k]]:
                    x, y = self.up[x][k], self.up[y][k]
        first, p, q = (x, y), x, y
        while p != q:  # verified: edits are compared down to the node that both share
            if self.edit[p] != self.edit[q]:
                first = (p, q)
            p, q = self.parent[p], self.parent[q]
        if self.edit[first[0]] != self.edit[first[1]]:
            return self.edit[first[0]] < self.edit[first[1]]
        return self.depth[a] < self.depth[b]

    def text(self, node: int) -> bytes:
        edits = []
        while node:
            edits.append(self.edit[node])
            node = self.parent[node]
        return b"".join(reversed(edits))


States = dict[int, tuple[int, int]]


def offer(audits: Audits, states: States, state: int, cost: int, node: int, edit: bytes) -> bool:
    """Let the audit of ``node`` and ``edit`` compete for a state; whether it won."""
    held = states.get(state)
    if held and held[0] < cost:
        return False
    new = audits.extend(node, edit)
    if held and held[0] == cost and not audits.less(new, held[1]):
        return False
    states[state] = (cost, new)
    return True


def insertions(audits: Audits, states: States) -> States:
    """The states after any insertions."""
    out = dict(states)
    todo = list(out)
    while todo:
        state = todo.pop()
        cost, node = out[state]
        if out.get(STEP[state], (cost + INSERT, 0))[0] >= cost + INSERT and offer(audits, out, STEP[state], cost + INSERT, node, b"I"):
            todo.append(STEP[state])
    return out


def consume(audits: Audits, states: States, initial: str, fault: str, count: int) -> States:
    """The states after one row (``fault``: b blank, d duplicate, t truncated, o none) and its ``count - 1`` copies."""
    out: States = {}
    for state, (cost, node) in insertions(audits, states).items():
        offer(audits, out, state, cost + DELETE, node, b"D")
        if fault in "bd":
            continue
        extra = TRUNCATED if fault == "t" else 0
        offer(audits, out, STEP[state], cost + REROLE + extra, node, b"R")
        kept = SYSTEM if initial == "s" and state == START else STEP[state] if initial == ("a" if state == USER else "u") else None
        if kept is not None:
            offer(audits, out, kept, cost + KEEP + extra, node, b"K")
    if count > 1:
        copies = b"D" * (count - 1)
        out = {s: (cost + DELETE * len(copies), audits.extend(node, copies)) for s, (cost, node) in out.items()}
    return out


def finish(audits: Audits, states: States) -> tuple[int, int]:
    """(cost, node) of the best complete audit."""
    done = insertions(audits, states)
    ends = [done[s] for s in (START, ASSISTANT) if s in done]
    best = ends[0]
    for other in ends[1:]:
        if other[0] < best[0] or (other[0] == best[0] and audits.less(other[1], best[1])):
            best = other
    return best


LEGAL = {"su", "ua", "au"}


def solve_chunk(rows: list[tuple[str, str, int]], begins: bool) -> dict:
    """The best audits of a chunk's rows (initial, fault, count) from each state it may begin in."""
    starts, ends, costs, texts = [], [], [], []
    for start in (START,) if begins else (START, SYSTEM, USER, ASSISTANT):
        audits = Audits()
        states: States = {start: (0, 0)}
        for initial, fault, count in rows:
            states = consume(audits, states, initial, fault, count)
        for end, (cost, node) in sorted(states.items()):
            starts.append(start)
            ends.append(end)
            costs.append(cost)
            texts.append(audits.text(node))
    illegal = sum((n - 1) * (2 * i not in LEGAL) for i, _, n in rows) + sum(a[0] + b[0] not in LEGAL for a, b in zip(rows, rows[1:], strict=False))
    return {"starts": starts, "ends": ends, "costs": costs, "texts": texts, "illegal": illegal, "first": rows[0][0], "last": rows[-1][0]}


CHUNK_SCHEMA = "ck string, chunk long, starts array<int>, ends array<int>, costs array<long>, texts array<binary>, illegal long, first string, last string"


def grouped(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[tuple, list[dict]]]:
    """Runs of rows with equal keys, across batches."""
    held, at = [], None
    for batch in batches:
        for row in batch.to_pylist():
            key = tuple(row[k] for k in keys)
            if held and key != at:
                yield at, held
                held = []
            at = key
            held.append(row)
    if held:
        yield at, held


def as_batches(rows: Iterator[dict], schema: pa.Schema, size: int = 2048) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def solve_chunks(ordered: DataFrame) -> DataFrame:
    """Per (conversation, chunk) its best audits, from the rows without their texts."""
    schema = pa.schema([
        ("ck", pa.string()), ("chunk", pa.int64()), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())),
        ("costs", pa.list_(pa.int64())), ("texts", pa.list_(pa.binary())), ("illegal", pa.int64()), ("first", pa.string()), ("last", pa.string()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solved() -> Iterator[dict]:
            for (_, ck), rows in grouped(batches, ("chunk", "ck")):
                # rows are sorted: only the first conversation of a chunk can have begun before it
                begins = rows[0]["pos"] % (1 << CHUNK_BITS) != 0
                yield {"ck": ck, "chunk": rows[0]["chunk"]} | solve_chunk([(r["initial"], r["fault"], r["n"]) for r in rows], begins)

        yield from as_batches(solved(), schema)

    slim = ordered.select("ck", "chunk", "pos", F.substring("role", 1, 1).alias("initial"), "fault", "n")
    return slim.repartition("chunk").sortWithinPartitions("chunk", "pos").mapInArrow(run, CHUNK_SCHEMA)


def string_chunks(chunks: list[dict]) -> Iterator[dict]:
    """The chosen audit of every chunk of one conversation, given in order."""
    audits = Audits()
    states: States = {START: (0, 0)}
    for c in chunks:
        after: States = {}
        for start, end, cost, text in zip(c["starts"], c["ends"], c["costs"], c["texts"], strict=True):
            if start in states:
                offer(audits, after, end, states[start][0] + cost, states[start][1], text)
        states = after
    total, node = finish(audits, states)
    closing = b""
    while audits.depth[node] > len(chunks):  # insertions after the last row
        closing = audits.edit[node] + closing
        node = audits.parent[node]
    texts = []
    while node:
        texts.append(audits.edit[node])
        node = audits.parent[node]
    state, last = START, None
    for c, text in zip(chunks, reversed(texts), strict=True):
        illegal = c["illegal"] + (last is not None and last + c["first"] not in LEGAL)
        whole = text + (closing if c is chunks[-1] else b"")
        yield {"ck": c["ck"], "chunk": c["chunk"], "state": state, "edits": whole, "cost": total if last is None else 0, "illegal": illegal}
        state = next(e for s, e, t in zip(c["starts"], c["ends"], c["texts"], strict=True) if s == state and t == text)
        last = c["last"]


def choose(solved: DataFrame) -> DataFrame:
    """Per (conversation, chunk) the edits of the best repair, the state before them, and the conversation's cost (on its first chunk)."""
    schema = pa.schema([("ck", pa.string()), ("chunk", pa.int64()), ("state", pa.int32()), ("edits", pa.binary()), ("cost", pa.int64()), ("illegal", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from as_batches((row for _, chunks in grouped(batches, ("ck",)) for row in string_chunks(chunks)), schema)

    dealt = solved.repartition("ck").sortWithinPartitions("ck", "chunk")
    return dealt.mapInArrow(run, "ck string, chunk long, state int, edits binary, cost long, illegal long")


def order_rows(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Distinct rows with count, fault, position and chunk, in order of (conversation, turn, role, text)."""
    spark = df.sparkSession
    keyed = df.select(
        F.coalesce(F.concat(F.lit("="), F.col(conv).cast("string")), F.lit("")).alias("ck"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    )
    rows = materialise(spark, keyed.groupBy("ck", "turn", "role", "text").agg(F.count("*").alias("n")), "repair_rows")
    said = F.md5(F.concat(F.col("role"), F.lit("\0"), F.col("text")))
    when = F.struct(F.col("turn").isNotNull().alias("has"), F.col("turn").alias("turn"))
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    full = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    first = materialise(spark, rows.where(~blank).groupBy("ck", said.alias("said")).agg(F.min(when).alias("first")), "repair_first")
    fault = F.when(blank, "b").when(~when.eqNullSafe(F.col("first")), "d").when(~full, "t").otherwise("o")
    flagged = rows.withColumn("said", said).join(first, ["ck", "said"], "left").select("ck", "turn", "role", "text", "n", fault.alias("fault"))
    order = [F.col("ck"), F.col("turn").asc_nulls_first(), F.col("role")]
    dealt = flagged.repartitionByRange(*order, F.substring("text", 1, 32)).sortWithinPartitions(*order, "text")
    placed = dealt.withColumn("pos", F.monotonically_increasing_id())
    return materialise(spark, placed.withColumn("chunk", F.shiftright("pos", CHUNK_BITS)), "repair_ordered")


TURN_FIELDS = [("ck", pa.string()), ("turn", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]


def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(ck, turn, edit, role, text) of every repaired turn; edits of a chunk arrive before its rows."""
    state, edits, at, ck = START, b"", 0, None

    def inserted(upto: int | None) -> Iterator[tuple]:
        nonlocal state, at
        while at < len(edits) and edits[at : at + 1] == b"I" and upto != at:
            at += 1
            state = STEP[state]
            yield ck, None, "I", ROLE_AFTER[state], ""

    for batch in batches:
        for row in batch.to_pylist():
            if row["edits"] is not None:
                yield from inserted(None)  # what closes the chunk before
                state, edits, at, ck = row["state"], row["edits"], 0, row["ck"]
                continue
            yield from inserted(None)
            edit = edits[at : at + 1].decode()
            at += row["n"]  # the copies of a row are deleted
            if edit == "D":
                continue
            role = row["role"]
            state = SYSTEM if edit == "K" and state == START and role[:1] == "s" else STEP[state]
            yield ck, row["turn"], edit, role if edit == "K" else ROLE_AFTER[state], row["text"]
    yield from inserted(None)


def with_edits(ordered: DataFrame, chosen: DataFrame) -> DataFrame:
    """Rows and, before each chunk's rows, its edits; not yet dealt."""
    head = chosen.select("ck", "chunk", F.lit(-1).cast("long").alias("pos"), "state", "edits")
    empty = [F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), F.lit(0).cast("long").alias("n")]
    body = ordered.select("ck", "chunk", "pos", F.lit(None).cast("int").alias("state"), F.lit(None).cast("binary").alias("edits"), F.col("turn").cast("long").alias("turn"), "role", "text", "n")
    return head.select("*", *empty).unionByName(body)


def repaired_turns(ordered: DataFrame, chosen: DataFrame) -> DataFrame:
    """The turns of the repaired conversations: ck, chunk order, edit, role and text, with the turn they came from."""
    schema = pa.schema([*TURN_FIELDS, ("chunk", pa.int64()), ("seq", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = [0]

        def watched() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):  # one row at a time, so that the chunk read is the chunk written
                    one = batch.slice(i, 1)
                    yield one
                    chunk[0] = one.column("chunk")[0].as_py()

        def turns() -> Iterator[dict]:
            for seq, t in enumerate(edited(watched())):
                yield dict(zip([n for n, _ in TURN_FIELDS], t, strict=True)) | {"chunk": chunk[0], "seq": seq}

        yield from as_batches(turns(), schema)

    dealt = with_edits(ordered, chosen).repartition("ck", "chunk").sortWithinPartitions("ck", "chunk", "pos")
    return dealt.mapInArrow(run, "ck string, turn long, edit string, role string, text string, chunk long, seq long")


def digests(ordered: DataFrame, chosen: DataFrame) -> DataFrame:
    """SHA-256 of every repaired conversation's ``role:text`` lines, streamed in order."""
    schema = pa.schema([("ck", pa.string()), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def hashed() -> Iterator[dict]:
            at, digest = None, None
            for ck, _, _, role, text in edited(batches):
                if ck != at:
                    if digest is not None:
                        yield {"ck": at, "repaired_sha256": digest.hexdigest()}
                    at, digest = ck, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            if digest is not None:
                yield {"ck": at, "repaired_sha256": digest.hexdigest()}

        yield from as_batches(hashed(), schema)

    dealt = with_edits(ordered, chosen).repartition("ck").sortWithinPartitions("ck", "chunk", "pos")
    return dealt.mapInArrow(run, "ck string, repaired_sha256 string")


def repair(df: DataFrame, ids: DataFrame | None = None, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Per conversation: its faults, the cost and audit of its best repair, and the repaired text's digest.

    ``ids`` may hold the ids (column ``conv``) of conversations to report even if they have no rows.
    """
    spark = df.sparkSession
    ordered = order_rows(df, conv, turn, role, text)
    chosen = materialise(spark, choose(solve_chunks(ordered)), "repair_edits")

    def rows_with(fault: str) -> Column:
        return F.sum(F.when(F.col("fault") == fault, 1).otherwise(0))

    copies = F.sum(F.when(F.col("fault") != "b", F.col("n") - 1).otherwise(0))
    span = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    counted = ordered.groupBy("ck").agg(
        F.coalesce(span, F.lit(0)).cast("long").alias("gaps"), F.sum(F.when(F.col("fault") == "b", F.col("n")).otherwise(0)).alias("blank"),
        (rows_with("d") + copies).alias("duplicate"), rows_with("t").alias("truncated"),
    )
    parts = F.transform(F.array_sort(F.collect_list(F.struct("chunk", F.col("edits").cast("string").alias("edits")))), lambda c: c["edits"])
    audits = chosen.groupBy("ck").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"), F.array_join(parts, "").alias("audit"))
    found = counted.join(audits, "ck").join(digests(ordered, chosen), "ck", "left")
    named = (df if ids is None else ids).select(F.col(conv)).distinct()
    named = named.withColumn("ck", F.coalesce(F.concat(F.lit("="), F.col(conv).cast("string")), F.lit("")))
    zeros = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    none = F.sha2(F.lit(""), 256)
    return named.join(found, "ck", "left").select(F.col(conv), *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", none).alias("repaired_sha256"))
