"""Conversation repair: the cheapest edits that give a legal sequence of roles, by Knuth's lightest derivation.

The rows of a conversation, by turn, must become ``(s?(ua)+)?``: an optional system message and pairs of user and
assistant, or nothing. Each row is kept (K, 0), given the role user or assistant (R, 3) or deleted (D, 4); empty user or
assistant messages may be inserted anywhere (I, 3). Blank rows and rows whose role and text stood earlier in the
conversation must be deleted; a row that stays without a closing ``.``, ``!`` or ``?`` costs 3 more. The audit is the
string of edit letters; among the cheapest the one that comes first in ASCII order is taken.

The edits form a weighted hypergraph of deductions. An item (s, j, t) says that the first j rows can be edited so that the
role grammar moves from state s to state t; it follows from an item that ends in j - 1 and an edit of row j, or from an
item that ends in j and an insertion. The weight of a deduction is its premise's cost plus that of the edit and its
premise's audit plus one letter: a monotone function of the premise, and a superior one, as items are ranked by cost,
rows and audit. (Two audits of equal cost over the same rows never extend one another: the longer one would have more
insertions.) So the agenda pops every item once, with its final weight, and stops when the goal is popped: all rows read,
grammar in an accepting state.

**At scale** rows are sorted over the whole table by range (conversation, turn, role, text), so that even a conversation
with a third of all rows is dealt over many tasks. Each task reads its sorted rows as a stream, solves them in pieces of
at most ``PIECE`` rows from every state the piece may start in, and joins the tables of consecutive pieces; a
conversation that spans tasks has one table per task, joined at the end. What is repeated earlier is found with a grouped
minimum, joined on salted keys. The edits are applied in one more pass that streams over the pieces of a conversation in
order. Memory is bounded by a piece and by the audits (one byte an edit, which the result holds in one cell anyway).

Defined results: null role and text read as one space; a null conversation id is a conversation of its own; null turns
come first; rows of one turn are ordered by role, then text; equal rows are rows of their own (all but the first are
duplicates); a role whose first letter is not ``s``, ``u`` or ``a`` cannot be kept; other columns are ignored;
conversations without rows do not occur, and an empty table gives empty results.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch_table

# Costs of the edits, grammar of the roles (state: role letter -> next state).
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
GRAMMAR: dict[int, dict[str, int]] = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
ACCEPTING = (0, 3)
STATES = (0, 1, 2, 3)
ROLE = {"u": "user", "a": "assistant"}
LEGAL_PAIRS = ("su", "ua", "au")

PIECE = 256              # rows solved at once
PIECE_CHARS = 4_000_000  # characters of text in a piece, or one row
SALTS = 16

Row = tuple[str, bool, bool]                       # role letter, must go, truncated
Table = dict[tuple[int, int], tuple[int, str]]     # (from state, to state) -> (cost, audit)


def row_edits(row: Row, state: int) -> Iterator[tuple[int, str, int]]:
    """``(cost, letter, next state)`` of the edits of a row in a grammar state."""
    letter, must_go, truncated = row
    yield DELETE, "D", state
    if must_go:
        return
    extra = TRUNCATED if truncated else 0
    for role, after in GRAMMAR[state].items():
        if role == letter:
            yield KEEP + extra, "K", after
        if role in ROLE:
            yield REROLE + extra, "R", after


def lightest(rows: Sequence[Row], starts: Iterable[int] = (0,), goals: Iterable[int] | None = None) -> Table:
    """Weights of the goal items (start, all rows, state); with ``goals`` only the first of these states that is popped."""
    n = len(rows)
    agenda = [(0, 0, "", s, s) for s in starts]
    heapq.heapify(agenda)
    done: set[tuple[int, int, int]] = set()
    table: Table = {}
    wanted = None if goals is None else set(goals)
    while agenda:
        cost, j, audit, start, state = heapq.heappop(agenda)
        if (start, j, state) in done:
            continue
        done.add((start, j, state))
        if j == n:
            table[start, state] = (cost, audit)
            if wanted is not None and state in wanted:
                return {(start, state): (cost, audit)}
        else:
            for weight, letter, after in row_edits(rows[j], state):
                if (start, j + 1, after) not in done:
                    heapq.heappush(agenda, (cost + weight, j + 1, audit + letter, start, after))
        for role, after in GRAMMAR[state].items():
            if role in ROLE and (start, j, after) not in done:
                heapq.heappush(agenda, (cost + INSERT, j, audit + "I", start, after))
    return table


def joined(a: Table, b: Table) -> Table:
    """Table of two consecutive pieces."""
    out: Table = {}
    for (s, t), (cost, audit) in a.items():
        for (t2, u), (more, rest) in b.items():
            if t == t2 and ((s, u) not in out or (cost + more, audit + rest) < out[s, u]):
                out[s, u] = (cost + more, audit + rest)
    return out


# ------------------------------------------------------------ rows

def conversation_rows(table: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                      text_col: str = "text") -> DataFrame:
    """``conv_id, turn, role, text`` under fixed names, null role and text as one space."""
    space = F.lit(" ")
    return table.select(F.col(id_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                        F.coalesce(F.col(role_col).cast("string"), space).alias("role"),
                        F.coalesce(F.col(text_col).cast("string"), space).alias("text"))


def marked_rows(rows: DataFrame) -> DataFrame:
    """Distinct rows with their number of ``copies``, ``blank``, ``truncated``, and ``seen``: role and text stood earlier."""
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    each = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    each = each.select("*", blank.alias("blank"), (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("truncated"),
                       F.struct("conv_id", F.sha2(F.concat_ws("\n", F.hex("role"), F.hex("text")), 256).alias("h")).alias("key"))
    each = scratch_table(each, "repair-rows")
    # nulls are the first turns: min would skip them
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    again = (each.where(~F.col("blank")).groupBy("key").agg(F.min(turn).alias("earliest"), F.count(F.lit(1)).alias("n"))
             .where(F.col("n") > 1).select("key", "earliest", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    left = each.withColumn("salt", F.pmod(F.xxhash64("turn"), F.lit(SALTS)).cast("int"))
    seen = F.coalesce(turn > F.col("earliest"), F.lit(False))
    return left.join(again, ["key", "salt"], "left").select(
        "conv_id", "turn", "role", "text", "copies", "blank", "truncated", seen.alias("seen"))


_STATS = ("rows", "blank", "duplicate", "truncated", "illegal", "turns")


def pieces_of(marked: DataFrame) -> DataFrame:
    """Pieces of conversations in order (``part``, ``piece``): their rows, and the table and counts at the end of a part."""
    kind = marked.schema["conv_id"].dataType.simpleString()
    out_schema = (f"conv_id {kind}, part int, piece long, rows array<struct<role:string,text:string>>, "
                  "weights array<struct<s:int,t:int,cost:long,audit:string>>, " + ", ".join(f"n_{c} long" for c in _STATS)
                  + ", first_turn long, last_turn long, first_role string, last_role string")
    # a conversation's rows are consecutive over the partitions; the range bounds that reach the driver hold no whole texts
    keys = ["conv_id", "turn", "role"]
    ordered = marked.repartitionByRange(*keys, F.left("text", F.lit(32))).sortWithinPartitions(*keys, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        state: dict = {"conv": None, "open": False, "first": True, "piece": 0}
        out: list[dict] = []
        held = 0                                             # characters in out

        def begin(conv) -> None:
            state.update(conv=conv, open=True, rows=[], texts=[], chars=0, tables=[], stats=dict.fromkeys(_STATS, 0),
                         first_turn=None, last_turn=None, first_role=None, last_role=None,
                         starts=STATES if state["first"] else (0,))
            state["first"] = False

        def solve(last: bool) -> None:
            nonlocal held
            tables, here = state["tables"], lightest(state["rows"], state["starts"])
            state["starts"] = sorted({t for _, t in here})
            tables.append((1, here))
            # tables of equally many pieces are joined, so that audits are copied a logarithmic number of times
            while len(tables) > 1 and (last or tables[-2][0] <= tables[-1][0]):
                (n, after), (m, before) = tables.pop(), tables.pop()
                tables.append((n + m, joined(before, after)))
            after = tables[-1][1]
            held += state["chars"]
            record = {"conv_id": state["conv"], "part": part, "piece": state["piece"], "rows": state["texts"], "weights": None}
            if last:
                record["weights"] = [{"s": s, "t": t, "cost": c, "audit": a} for (s, t), (c, a) in after.items()]
                record.update({f"n_{c}": state["stats"][c] for c in _STATS})
                record.update({c: state[c] for c in ("first_turn", "last_turn", "first_role", "last_role")})
            out.append(record)
            state.update(piece=state["piece"] + 1, rows=[], texts=[], chars=0)

        def add(r: dict, duplicate: bool) -> None:
            stats, letter = state["stats"], r["role"][:1]
            if r["blank"]:
                stats["blank"] += 1
            elif duplicate:
                stats["duplicate"] += 1
            elif r["truncated"]:
                stats["truncated"] += 1
            if stats["rows"] and state["last_role"] + letter not in LEGAL_PAIRS:
                stats["illegal"] += 1
            if r["turn"] is not None and r["turn"] != state["last_turn"]:
                stats["turns"] += 1
                state["last_turn"] = r["turn"]
                if state["first_turn"] is None:
                    state["first_turn"] = r["turn"]
            if not stats["rows"]:
                state["first_role"] = letter
            stats["rows"] += 1
            state["last_role"] = letter
            state["rows"].append((letter, r["blank"] or duplicate, r["truncated"]))
            state["texts"].append({"role": r["role"], "text": r["text"]})
            state["chars"] += len(r["text"])

        schema = None
        for batch in batches:
            if schema is None:
                schema = pa.schema([pa.field("conv_id", batch.schema.field("conv_id").type), ("part", pa.int32()), ("piece", pa.int64()),
                                    ("rows", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))),
                                    ("weights", pa.list_(pa.struct([("s", pa.int32()), ("t", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])))]
                                   + [(f"n_{c}", pa.int64()) for c in _STATS]
                                   + [("first_turn", pa.int64()), ("last_turn", pa.int64()), ("first_role", pa.string()), ("last_role", pa.string())])
            for r in batch.to_pylist():
                if not state["open"] or r["conv_id"] != state["conv"]:
                    if state["open"]:
                        solve(True)
                    begin(r["conv_id"])
                for copy in range(r["copies"]):
                    if len(state["rows"]) >= PIECE or state["chars"] >= PIECE_CHARS:
                        solve(False)
                    add(r, r["seen"] or copy > 0)
                    if len(out) >= 1000 or held >= PIECE_CHARS:
                        yield pa.RecordBatch.from_pylist(out, schema)
                        out.clear()
                        held = 0
        if state["open"]:
            solve(True)
            yield pa.RecordBatch.from_pylist(out, schema)

    return ordered.mapInArrow(run, out_schema)


def weighed(pieces: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit`` per conversation, from the tables of its parts."""
    kind = pieces.schema["conv_id"].dataType.simpleString()
    columns = ["part", "weights", *[f"n_{c}" for c in _STATS], "first_turn", "last_turn", "first_role", "last_role"]
    parts = (pieces.where(F.col("weights").isNotNull()).groupBy(F.struct("conv_id").alias("key"))
             .agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("parts")).select("key.conv_id", "parts"))
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]

    def one(parts: list[dict]) -> tuple[list[int], str]:
        table: Table = {(0, 0): (0, "")}
        counts = dict.fromkeys(_STATS, 0)
        low = high = last_role = None
        for p in parts:
            table = joined(table, {(w["s"], w["t"]): (w["cost"], w["audit"]) for w in p["weights"]})
            for c in _STATS:
                counts[c] += p[f"n_{c}"]
            if p["first_turn"] is not None:
                counts["turns"] -= p["first_turn"] == high
                low, high = p["first_turn"] if low is None else low, p["last_turn"]
            if last_role is not None:
                counts["illegal"] += last_role + p["first_role"] not in LEGAL_PAIRS
            last_role = p["last_role"]
        cost, audit = min(v for (_, t), v in table.items() if t in ACCEPTING)
        gaps = 0 if low is None else high - low + 1 - counts["turns"]
        return [gaps, counts["blank"], counts["duplicate"], counts["truncated"], counts["illegal"], cost], audit

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [one(p) for p in batch.column("parts").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id")] + [pa.array([g[0][k] for g in got], pa.int64()) for k in range(len(names))]
                + [pa.array([g[1] for g in got], pa.string())], names=["conv_id", *names, "audit"])

    return parts.mapInArrow(run, f"conv_id {kind}, " + ", ".join(f"{c} long" for c in names) + ", audit string")


def edited(pieces: DataFrame, audits: DataFrame) -> DataFrame:
    """``conv_id, pos, edit, role, text``: the repaired rows, conversations whole and in order within a partition."""
    kind = pieces.schema["conv_id"].dataType.simpleString()
    row = "array<struct<role:string,text:string>>"
    # the audit comes before the pieces of its conversation in one sorted stream
    stream = (audits.select("conv_id", F.lit(-1).alias("part"), F.lit(-1).cast("long").alias("piece"), "audit", F.lit(None).cast(row).alias("rows"))
              .unionByName(pieces.select("conv_id", "part", "piece", F.lit(None).cast("string").alias("audit"), "rows")))
    stream = stream.repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, at, state, pos = None, "", 0, 0, 0
        out: list[tuple] = []

        def emit(edit: str, role: str, text: str) -> None:
            nonlocal state, pos
            out.append((conv, pos, edit, role, text))
            state = GRAMMAR[state][role[:1]]
            pos += 1

        def insertions() -> None:
            nonlocal at
            while at < len(audit) and audit[at] == "I":
                emit("I", ROLE["a" if state == 2 else "u"], "")
                at += 1

        def flush(kind: pa.DataType) -> pa.RecordBatch:
            types = (kind, pa.int64(), pa.string(), pa.string(), pa.string())
            columns = zip(*out) if out else [[]] * 5
            batch = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=["conv_id", "pos", "edit", "role", "text"])
            out.clear()
            return batch

        conv_type = None
        for batch in batches:
            conv_type = batch.schema.field("conv_id").type
            size = 0
            for r in batch.to_pylist():
                if r["audit"] is not None:
                    insertions()                             # what was left for the end of the conversation before
                    conv, audit, at, state, pos = r["conv_id"], r["audit"], 0, 0, 0
                    continue
                for message in r["rows"]:
                    insertions()
                    edit = audit[at]
                    at += 1
                    if edit == "K":
                        emit("K", message["role"], message["text"])
                    elif edit == "R":
                        emit("R", ROLE["a" if state == 2 else "u"], message["text"])
                    size += len(message["text"])
                if size > PIECE_CHARS:
                    yield flush(conv_type)
                    size = 0
            yield flush(conv_type)
        insertions()
        if out:
            yield flush(conv_type)

    return stream.mapInArrow(run, f"conv_id {kind}, pos long, edit string, role string, text string")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Audits (one row per conversation) and repaired rows of ``conversation_rows``."""
    pieces = scratch_table(pieces_of(marked_rows(rows)), "repair-pieces")
    audits = scratch_table(weighed(pieces), "repair-audits")
    return audits, edited(pieces, audits)


def text_digests(repaired: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256`` of the conversations with rows: SHA-256 of ``role:text`` joined by newlines.

    Reads the rows of :func:`edited` as they come, in order, so a conversation of any length is hashed as a stream.
    """
    kind = repaired.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest = None, None
        for batch in batches:
            done: list[tuple] = []
            for c, pos, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "pos", "role", "text"))):
                if pos == 0:
                    if digest is not None:
                        done.append((conv, digest.hexdigest()))
                    conv, digest = c, hashlib.sha256()
                digest.update((("\n" if pos else "") + f"{role}:{text}").encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], batch.schema.field("conv_id").type),
                                              pa.array([d[1] for d in done], pa.string())], names=["conv_id", "repaired_sha256"])
            kind_of = batch.schema.field("conv_id").type
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], kind_of), pa.array([digest.hexdigest()], pa.string())], names=["conv_id", "repaired_sha256"])

    return repaired.mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")
