import hashlib
import random
from functools import cache

import pytest
from pyspark.sql import functions as F

from hearth.llm import chat_repair as C
from hearth.llm import queries

ROLES = ["system", "user", "assistant", "tool", "", "s", " "]
TEXTS = ["Hi.", "Why?", "no end", "", " \n", "Yes! ", "open, "]


def brute(rows):
    """(cost, audit, repaired turns) over every way to edit; rows are (role, text, fault)."""

    @cache
    def best(i, state, inserts):
        """Least (cost, audit) from row i on in a state, written from the front."""
        ways = []
        if i == len(rows) and state in "0a":
            ways.append((0, ""))
        if inserts < 2:
            c, a = best(i, "a" if state == "u" else "u", inserts + 1)
            ways.append((c + 3, "I" + a))
        if i < len(rows):
            role, _, fault = rows[i]
            c, a = best(i + 1, state, 0)
            ways.append((c + 4, "D" + a))
            if fault in "ot":
                extra, after = 3 * (fault == "t"), "a" if state == "u" else "u"
                c, a = best(i + 1, after, 0)
                ways.append((c + 3 + extra, "R" + a))
                if role[:1] == after:
                    ways.append((c + extra, "K" + a))
                if role[:1] == "s" and state == "0":
                    c, a = best(i + 1, "s", 0)
                    ways.append((c + extra, "K" + a))
        return min(ways, default=(10**9, ""))

    cost, audit = best(0, "0", 0)
    i, turns = 0, []
    for e in audit:
        prior = turns[-1][0][:1] if turns else "0"
        needed = "assistant" if prior == "u" else "user"
        if e == "I":
            turns.append((needed, ""))
            continue
        if e != "D":
            turns.append((rows[i][0] if e == "K" else needed, rows[i][1]))
        i += 1
    return cost, audit, turns


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = text.rstrip(" \t\n\v\f\r")
        if not bare.strip(" \t\n\v\f\r"):
            out.append("b")
        elif (role, text) in seen:
            out.append("d")
        else:
            out.append("o" if bare[-1] in ".!?" else "t")
        seen.add((role, text))
    return out


def expected(turned):
    """The report on rows (turn, role, text), written plainly."""
    rows = sorted(((t is not None, t or 0), r or " " if r is None else r, " " if x is None else x) for t, r, x in turned)
    rows = [(r, x) for _, r, x in rows]
    f = faults(rows)
    cost, audit, out = brute(tuple((r, x, y) for (r, x), y in zip(rows, f, strict=True)))
    known = [t for t, _, _ in turned if t is not None]
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    digest = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in out).encode()).hexdigest()
    return (gaps, f.count("b"), f.count("d"), f.count("t"), illegal, cost, audit, digest), out


def conversations(n, seed, size):
    rng = random.Random(seed)
    found = {}
    for c in range(n):
        turns = [rng.choice([None, *range(6)]) if rng.random() < 0.2 else t for t in range(rng.randint(0, size))]
        found[c] = [(t, None if rng.random() < 0.03 else rng.choice(ROLES[:3] if rng.random() < 0.8 else ROLES), None if rng.random() < 0.03 else rng.choice(TEXTS[:3] if rng.random() < 0.7 else TEXTS) * rng.randint(1, 2)) for t in turns]
    return found


SCHEMA = "conv_id long, turn long, role string, text string"


def check(spark, found, ids=None):
    df = spark.createDataFrame([(c, *row) for c, rows in found.items() for row in rows], SCHEMA)
    named = spark.createDataFrame([(c,) for c in found], "conv_id long")
    got = {r[0]: tuple(r)[1:] for r in C.repair(df, ids=named).collect()}
    assert set(got) == set(found)
    for c, rows in found.items():
        want = expected(rows)[0] if rows else (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
        assert got[c] == want, (c, rows)


def test_repairs_match_brute_force(spark):
    check(spark, conversations(300, 5, 9))


@pytest.mark.parametrize("bits", [1, 2])
def test_conversations_cut_into_chunks(spark, bits, monkeypatch):
    monkeypatch.setattr(C, "CHUNK_BITS", bits)
    check(spark, conversations(40, 7 + bits, 40))


def test_solved_in_pieces_equals_solved_whole():
    rng = random.Random(2)
    for _ in range(300):
        rows = [(rng.choice("suax"), rng.choice("bdtooo"), rng.choice([1, 1, 1, 3])) for _ in range(rng.randint(1, 30))]
        plain = tuple((r, "", f if k == 0 else ("b" if f == "b" else "d")) for r, f, n in rows for k in range(n))
        cuts = sorted(rng.sample(range(1, len(rows)), min(len(rows) - 1, rng.randint(0, 4))))
        parts = [{"ck": "c", "chunk": k} | C.solve_chunk(rows[a:b], a == 0) for k, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(rows)], strict=True))]
        chosen = list(C.string_chunks(parts))
        cost, audit, _ = brute(plain)
        assert (chosen[0]["cost"], b"".join(c["edits"] for c in chosen).decode()) == (cost, audit)


def test_comparison_survives_hash_collisions(monkeypatch):
    monkeypatch.setattr(C, "MODULUS", 1)  # every hash is equal
    rng = random.Random(4)
    audits = C.Audits()
    nodes = {"": 0}
    for _ in range(200):
        s = rng.choice(list(nodes))
        e = rng.choice("DIKR")
        nodes.setdefault(s + e, audits.extend(nodes[s], e.encode()))
    for a in nodes:
        for b in nodes:
            if a != b and not a.startswith(b) and not b.startswith(a):
                assert audits.less(nodes[a], nodes[b]) == (a < b)
    monkeypatch.setattr(C, "MODULUS", (1 << 61) - 1)


def test_hot_conversation_repeated_rows_and_long_text(spark):
    long = "word " * 100_000 + "."
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for t in range(9000)]
    rows += [(2, 0, "user", "Same.")] * 3000 + [(2, 1, "assistant", long)]
    rows += [(3, None, "user", "A."), (3, None, "assistant", "B.")] + [(None, 0, "user", "Null id."), (None, 1, "assistant", "Yes.")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("TEXT_", F.lit(1)).withColumn("ck", F.lit("x")).withColumn("pos", F.lit(0))
    got = {r["conv_id"]: r for r in C.repair(df).collect()}
    assert got[1]["cost"] == 0 and got[1]["audit"] == "K" * 9000
    assert got[1]["repaired_sha256"] == hashlib.sha256("\n".join(f"{r}:{x}" for _, _, r, x in rows[:9000]).encode()).hexdigest()
    assert got[2]["duplicate"] == 2999 and got[2]["audit"] == "K" + "D" * 2999 + "K" and got[2]["cost"] == 4 * 2999
    assert got[2]["repaired_sha256"] == hashlib.sha256(f"user:Same.\nassistant:{long}".encode()).hexdigest()
    assert got[3]["gaps"] == 0 and got[3]["audit"] in {expected([r[1:] for r in rows if r[0] == 3])[0][6]}
    assert got[None]["audit"] == "KK"


def test_repaired_turns(spark):
    found = conversations(60, 11, 8)
    df = spark.createDataFrame([(c, *row) for c, rows in found.items() for row in rows], SCHEMA)
    ordered = C.order_rows(df, "conv_id", "turn", "role", "text")
    chosen = C.materialise(spark, C.choose(C.solve_chunks(ordered)), "edits")
    got = {}
    for r in sorted(C.repaired_turns(ordered, chosen).collect(), key=lambda r: (r["ck"], r["chunk"], r["seq"])):
        got.setdefault(r["ck"], []).append((r["role"], r["text"]))
    for c, rows in found.items():
        assert got.get(f"={c}", []) == (expected(rows)[1] if rows else []), c


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert C.repair(df).count() == 0
    only = C.repair(df, ids=spark.createDataFrame([(5,), (None,)], "conv_id long")).collect()
    assert {(r["conv_id"], r["audit"], r["cost"], r["repaired_sha256"]) for r in only} == {(i, "", 0, hashlib.sha256(b"").hexdigest()) for i in (5, None)}


def test_registered_query_equals_its_sql(spark, small_dir):
    import duckdb

    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{small_dir}/conversations.parquet')")
    want = sorted(con.sql(queries.oracle_sql()["op13_conversation_repair"]).fetchall())
    got = sorted(tuple(r) for r in queries.queries()["op13_conversation_repair"](spark, small_dir).collect())
    assert got == want and sum(r[6] > 0 for r in got) > 3
