"""Conversation repair against plain searches, over pieces and parts, and with odd rows."""

import hashlib
import random
import zlib
from itertools import product

import pytest
from pyspark.sql import functions as F

from scarp.llm import conversation_repair as cr
from scarp.llm import damage, queries

WHITE = " \t\n\x0b\x0c\r"


def plain(rows):
    """(cost, audit) by relaxing all items until nothing changes; rows are (letter, must go, truncated)."""
    best = {(0, 0): (0, "")}
    for j in range(len(rows) + 1):
        for _ in range(4):
            for state in range(4):
                if (j, state) not in best:
                    continue
                cost, audit = best[j, state]
                for role, after in cr.GRAMMAR[state].items():
                    if role in "ua":
                        new = (cost + 3, audit + "I")
                        if (j, after) not in best or new < best[j, after]:
                            best[j, after] = new
        if j == len(rows):
            break
        letter, must_go, truncated = rows[j]
        for state in range(4):
            if (j, state) not in best:
                continue
            cost, audit = best[j, state]
            moves = [(4, "D", state)]
            if not must_go:
                for role, after in cr.GRAMMAR[state].items():
                    if role == letter:
                        moves.append((3 * truncated, "K", after))
                    if role in "ua":
                        moves.append((3 + 3 * truncated, "R", after))
            for w, e, after in moves:
                new = (cost + w, audit + e)
                if (j + 1, after) not in best or new < best[j + 1, after]:
                    best[j + 1, after] = new
    return min(best[len(rows), s] for s in (0, 3) if (len(rows), s) in best)


def exhaustive(rows):
    """(cost, audit) by trying all edits of few rows, with up to two insertions before each and at the end."""
    best = None
    for edits in product("KRD", repeat=len(rows)):
        for gaps in product(range(3), repeat=len(rows) + 1):
            audit = "".join("I" * gaps[j] + e for j, e in enumerate(edits)) + "I" * gaps[-1]
            cost, state, j = 0, 0, 0
            for letter in audit:
                if letter == "I" or letter == "R":
                    after = cr.GRAMMAR[state].get("a" if state == 2 else "u")
                else:
                    after = cr.GRAMMAR[state].get(rows[j][0]) if letter == "K" else state
                if after is None or (letter in "KR" and rows[j][1]):
                    break
                cost += {"K": 0, "R": 3, "D": 4, "I": 3}[letter]
                if letter != "I":
                    cost += 3 * (letter != "D" and rows[j][2])
                    j += 1
                state = after
            else:
                if state in (0, 3) and (best is None or (cost, audit) < best):
                    best = (cost, audit)
    return best


def some_rows(rnd, n):
    return [(rnd.choice("suaux"), rnd.random() < 0.15, rnd.random() < 0.2) for _ in range(n)]


def test_lightest_is_the_cheapest_of_all():
    rnd = random.Random(1)
    for _ in range(150):
        rows = some_rows(rnd, rnd.randrange(0, 4))
        want = exhaustive(rows)
        assert plain(rows) == want
        assert list(cr.lightest(rows, goals=cr.ACCEPTING).values()) == [want]


def test_pieces_join_to_the_whole():
    rnd = random.Random(2)
    for _ in range(200):
        rows = some_rows(rnd, rnd.randrange(0, 30))
        cut = rnd.randrange(0, len(rows) + 1)
        table = cr.joined(cr.lightest(rows[:cut]), cr.lightest(rows[cut:], cr.STATES))
        assert min(v for (_, t), v in table.items() if t in cr.ACCEPTING) == plain(rows)
        assert table == cr.lightest(rows)


def reference(table):
    """The contract's result of a whole table of (conv, turn, role, text), in plain Python."""
    convs = {c: [] for c, *_ in table}
    for conv, turn, role, text in sorted(table, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or " ", r[3] or " ")):
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else text.translate({ord(c): None for c in ".!?"}) if kind == 2 else text
        role = "user" if kind == 4 else role
        convs[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        counts, seen, marked = {"blank": 0, "duplicate": 0, "truncated": 0}, set(), []
        for _, role, text in rows:
            bare = text.strip(WHITE)
            fault = ("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
            if fault:
                counts[fault] += 1
            seen.add((role, text))
            marked.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        pairs = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        cost, audit = plain(marked) if rows else (0, "")
        state, j, lines = 0, 0, []
        for e in audit:
            role, text = rows[j][1:] if e != "I" else (None, "")
            j += e != "I"
            if e == "D":
                continue
            if e in "IR":
                role = "assistant" if state == 2 else "user"
            state = cr.GRAMMAR[state][role[0]]
            lines.append(f"{role}:{text}")
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], pairs, cost, audit, sha)
    return out


def run_query(spark, rows, tmp):
    schema = "conv_id long, turn long, role string, text string, part int, rows string, key int"
    spark.createDataFrame([(*r, 1, "x", 2) for r in rows], schema).write.parquet(f"{tmp}/conversations.parquet")
    got = queries.op13_conversation_repair(spark, tmp).collect()
    assert len({r.conv_id for r in got}) == len(got)
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in got}


@pytest.fixture()
def small_pieces(monkeypatch):
    monkeypatch.setattr(cr, "PIECE", 7)


def test_query_equals_the_plain_version(spark, tmpdir_local, small_pieces):
    rnd = random.Random(3)
    texts = ["Yes.", "No!", "Why?", "cut off", "", " \t\n", None, "Yes. ", "é ", "x" * 5000 + "."]
    rows = []
    for conv in [None, *range(60)]:
        for turn in range(rnd.randrange(1, 9)):
            rows.append((conv, rnd.choice([turn, turn, turn, None, turn // 2]), rnd.choice(["system", "user", "assistant", "user", "tool", None, ""]),
                         rnd.choice(texts)))
    rows += rnd.sample(rows, 30)                                  # repeated rows
    rows += [(1000, t, "user" if t % 2 else "assistant", f"{t % 50}.") for t in range(900)]   # one conversation over many tasks
    rnd.shuffle(rows)
    want = reference(rows)
    assert run_query(spark, rows, tmpdir_local) == want


def test_empty_table_and_dropped_conversations(spark, tmpdir_local):
    assert run_query(spark, [], f"{tmpdir_local}/a") == {}
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert run_query(spark, [(gone, 0, "user", "Hello.")], f"{tmpdir_local}/b") == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_repaired_rows(spark):
    rows = spark.createDataFrame([(1, 0, "assistant", "Hi."), (1, 1, "user", "Where?"), (1, 2, "user", ""), (2, 0, "system", "Be kind.")],
                                 "conv_id long, turn long, role string, text string")
    audits, repaired = cr.repair(cr.conversation_rows(rows))
    assert {r.conv_id: (r.cost, r.audit) for r in audits.collect()} == {1: (10, "IKKDI"), 2: (4, "D")}
    assert [tuple(r) for r in repaired.orderBy("conv_id", "pos").collect()] == [
        (1, 0, "I", "user", ""), (1, 1, "K", "assistant", "Hi."), (1, 2, "K", "user", "Where?"), (1, 3, "I", "assistant", "")]


def test_damage_keeps_undamaged_rows(spark):
    rows = spark.range(2000).select((F.col("id") % 100).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.lit("A. b!").alias("text"))
    kinds = {t: zlib.crc32(f"{t % 100}:{t}".encode()) % 20 for t in range(2000)}
    got = {}
    for r in damage.damaged_rows(rows).collect():
        got.setdefault(r.turn, []).append(r.text)
    want = {t: {1: [""], 2: ["A b"], 3: ["A. b!"] * 2}.get(k, ["A. b!"]) for t, k in kinds.items() if k}
    assert got == want
