"""Conversation structure repair: the cheapest edits that make turns alternate, by a checkpointed dynamic program.

The state of a repaired conversation is what its last turn was: nothing, system, user or assistant. A backward vector
has, for each state, the cost of the edits still to come. Vectors are kept at the borders of blocks of about the square
root of the rows only; a walk forward makes a block's vectors anew from the one behind it and takes, of the edits that
keep to the least cost, the one whose initial is the ASCII-least.

Rows are sorted by range, so that a long conversation lies in many partitions. A conversation that a partition holds
whole, in one block, is repaired where it lies. Of others each block gives the least costs from any state to any state
(16 numbers), from which the vectors at its borders follow; blocks are then walked from each of the four states side by
side, and which of the walks is the conversation's own follows from where the walk before it ended.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared

KEEP_TRUNCATED, REROLE, DELETE, INSERT = 3, 3, 4, 3
NEVER = 1 << 60
#: States: nothing yet, after system, after user, after assistant. The next state where a role's initial may follow.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: The state after an inserted or reroled turn (only one role fits), and that role.
FORCED = (2, 2, 3, 2)
ROLE = {2: "user", 3: "assistant"}
END = (0, 6, 3, 0)
#: Faults of a row, in the order in which they count.
FINE, TRUNCATED, BLANK, DUPLICATE = "0123"
WHITE = " \t\n\x0b\x0c\r"
#: The k-th block of a conversation has k times as many rows, so n rows make about sqrt(n / 32) blocks; a block ends early at so many characters.
BLOCK_ROWS, BLOCK_CHARS = 64, 4 << 20
#: Characters of a text that take part in dealing rows out by range.
HEAD = 32
PIECE = "conv_id long, part int, seq int, whole boolean, codes string, matrix array<long>, audit string, roles array<string>, texts array<string>"
SUMMARY = "conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def before(code: str, initial: str, after: tuple) -> tuple:
    """The backward vector before a row, from that after it."""
    out = []
    for s in range(4):
        best = DELETE + after[s]
        if code < BLANK:
            extra = KEEP_TRUNCATED if code == TRUNCATED else 0
            best = min(best, REROLE + extra + after[FORCED[s]])
            to = NEXT[s].get(initial)
            if to is not None:
                best = min(best, extra + after[to])
        out.append(best)
    # Turns may be inserted before the row, one user or assistant turn at a time.
    two, three = min(out[2], INSERT + out[3]), min(out[3], INSERT + out[2])
    return min(out[0], INSERT + two), min(out[1], INSERT + two), two, three


def vector(codes: str, after: tuple) -> tuple:
    """The backward vector before rows, given as initial and fault each, from that after them."""
    for i in range(len(codes) - 2, -1, -2):
        after = before(codes[i + 1], codes[i], after)
    return after


def matrix(codes: str) -> list[int]:
    """Least costs from each state before the rows to each state after them, by state before and then after."""
    columns = [vector(codes, tuple(0 if s == t else NEVER for s in range(4))) for t in range(4)]
    return [min(columns[t][s], NEVER) for s in range(4) for t in range(4)]


def walk(codes: str, state: int, after: tuple, last: bool) -> tuple[str, int]:
    """The ASCII-least of the cheapest edits from a state on, and the state that they end in; ``last`` adds turns that are missing at the end."""
    n = len(codes) // 2
    size = math.isqrt(n) + 1
    marks = [after]  # of the blocks, from the last one on
    for begin in range((n - 1) // size * size if n else 0, 0, -size):
        marks.append(vector(codes[2 * begin : 2 * min(begin + size, n)], marks[-1]))
    letters = []
    for begin in range(0, n, size):
        rows, held = codes[2 * begin : 2 * min(begin + size, n)], [marks.pop()]
        for i in range(len(rows) - 2, -1, -2):
            held.append(before(rows[i + 1], rows[i], held[-1]))
        for i in range(0, len(rows), 2):
            now, to, code, initial = held.pop(), held[-1], rows[i + 1], rows[i]
            extra = KEEP_TRUNCATED if code == TRUNCATED else 0
            while True:
                if DELETE + to[state] == now[state]:
                    letters.append("D")
                elif INSERT + now[FORCED[state]] == now[state]:
                    letters.append("I")
                    state = FORCED[state]
                    continue
                elif code < BLANK and initial in NEXT[state] and extra + to[NEXT[state][initial]] == now[state]:
                    letters.append("K")
                    state = NEXT[state][initial]
                else:
                    letters.append("R")
                    state = FORCED[state]
                break
    while last and state in (1, 2):
        letters.append("I")
        state = FORCED[state]
    return "".join(letters), state


def apply(audit: str, state: int, roles: list[str], texts: list[str]) -> tuple[list[str], list[str]]:
    """Roles and texts of the repaired rows."""
    out_roles, out_texts, i = [], [], 0
    for letter in audit:
        if letter == "K":
            state = NEXT[state][roles[i][:1]]
            out_roles.append(roles[i])
        elif letter != "D":
            state = FORCED[state]
            out_roles.append(ROLE[state])
        if letter != "D":
            out_texts.append("" if letter == "I" else texts[i])
        i += letter != "I"
    return out_roles, out_texts


def _fault() -> tuple:
    """Whether a text is blank, and whether its last character that is not white ends no sentence."""
    ended = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    return F.translate("text", WHITE, "") == "", ~ended


def _sorted_rows(turns: DataFrame) -> DataFrame:
    """Rows, equal ones as one with their number, after markers of first occurrences, in order within ranges."""
    head = F.substring("text", 1, HEAD)
    blank, truncated = _fault()
    rows = turns.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.select("conv_id", "turn", "role", head.alias("head"), F.lit(1).alias("kind"), "text", F.when(blank, BLANK).when(truncated, TRUNCATED).otherwise(FINE).alias("fault"), F.lit("").alias("sha"), "n")
    seen = turns.where(~blank).groupBy("conv_id", "role", head.alias("head"), F.sha2("text", 256).alias("sha")).agg(F.bool_or(F.col("turn").isNull()).alias("none"), F.min("turn").alias("least"))
    first = seen.select("conv_id", F.when(~F.col("none"), F.col("least")).alias("turn"), "role", "head", F.lit(0).alias("kind"), F.lit("").alias("text"), F.lit(FINE).alias("fault"), "sha", F.lit(0).cast("long").alias("n"))
    return rows.unionByName(first).repartitionByRange("conv_id", "turn", "role", "head").sortWithinPartitions("conv_id", "turn", "role", "head", "kind", "text")


class _Block:
    def __init__(self, conv_id: int | None, seq: int, index: int):
        self.conv_id, self.seq, self.index = conv_id, seq, index
        self.codes: list[str] = []
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.chars = 0

    def add(self, role: str, text: str, fault: str) -> None:
        self.codes.append((role[0] if role[:1] in ("s", "u", "a") else "-") + fault)
        self.roles.append(role if fault < BLANK else "")
        self.texts.append(text if fault < BLANK else "")
        self.chars += len(role) + len(text) if fault < BLANK else 1

    def full(self, block_rows: int) -> bool:
        return len(self.codes) >= block_rows * (self.index + 1) or self.chars >= BLOCK_CHARS

    def row(self, part: int, whole: bool) -> tuple:
        codes = "".join(self.codes)
        if not whole:
            return self.conv_id, part, self.seq, False, codes, matrix(codes), None, self.roles, self.texts
        audit, _ = walk(codes, 0, END, True)
        return self.conv_id, part, self.seq, True, codes, None, audit, *apply(audit, 0, self.roles, self.texts)


def _blocks(batches, block_rows: int) -> Iterator[tuple[_Block, bool]]:
    """Blocks of sorted rows, and whether one is all of its conversation; the first and last conversation may go on elsewhere."""
    block, place, pending, first = None, None, set(), True
    seq = 0
    for b in batches:
        for conv_id, turn, role, head, kind, text, fault, sha, n in zip(*(c.to_pylist() for c in b.columns)):
            if place != (conv_id, turn, role, head):
                place, pending = (conv_id, turn, role, head), set()
            if block is None or block.conv_id != conv_id:
                if block is not None:
                    yield block, block.index == 0 and not first
                    first = False
                block = _Block(conv_id, seq, 0)
                seq += 1
            if kind == 0:
                pending.add(sha)
                continue
            for _ in range(n):
                kind_of = fault
                if fault < BLANK:
                    digest = hashlib.sha256(text.encode()).hexdigest()
                    kind_of = fault if digest in pending else DUPLICATE
                    pending.discard(digest)
                if block.full(block_rows):
                    yield block, False
                    block = _Block(conv_id, seq, block.index + 1)
                    seq += 1
                block.add(role, text, kind_of)
    if block is not None:
        yield block, False


def _cut(batches, block_rows: int):
    from pyspark import TaskContext

    part, held, chars = TaskContext.get().partitionId(), [], 0
    for block, whole in _blocks(batches, block_rows):
        held.append(block.row(part, whole))
        chars += block.chars
        if len(held) >= 512 or chars >= BLOCK_CHARS:
            yield _batch(held, _PIECES)
            held, chars = [], 0
    if held:
        yield _batch(held, _PIECES)


_TEXTS = pa.list_(pa.string())
_PIECES = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int32()), ("whole", pa.bool_()), ("codes", pa.string()), ("matrix", pa.list_(pa.int64())), ("audit", pa.string()), ("roles", _TEXTS), ("texts", _TEXTS)])
_SUMMARIES = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "cost")), ("audit", pa.string()), ("repaired_sha256", pa.string())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _ends(blocks: pd.DataFrame) -> pd.DataFrame:
    """The vector behind each block of a conversation: about as many blocks as the square root of its rows, 16 numbers each."""
    blocks = blocks.sort_values(["part", "seq"])
    after, out = END, []
    for m in reversed(blocks["matrix"].tolist()):
        out.append(list(after))
        after = tuple(min(int(m[4 * s + t]) + after[t] for t in range(4)) for s in range(4))
    return pd.DataFrame({"part": blocks["part"], "seq": blocks["seq"], "after": out[::-1], "last": [i == len(out) - 1 for i in range(len(out))]})


def _begins(blocks: pd.DataFrame) -> pd.DataFrame:
    """The state in which the walk comes to each block of a conversation."""
    blocks = blocks.sort_values(["part", "seq"])
    state, out = 0, []
    for ends in blocks["ends"].tolist():
        out.append(state)
        state = int(ends[state])
    return pd.DataFrame({"part": blocks["part"], "seq": blocks["seq"], "state": out})


def repair(turns: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Repaired conversations, in pieces of bounded size.

    Takes ``conv_id``, ``turn``, ``role`` and ``text`` of ``turns``; other columns, of any name, are ignored. Null
    roles and texts are one space; rows without conv_id are one conversation. Rows go by turn, nulls first, and equal
    turns by role and text, so repeated rows stand together. A row is blank (no character that is not white), else
    duplicate (role and text seen earlier), else truncated (its last character that is not white is none of ``.!?``).
    Blank and duplicate rows are deleted; the others' roles are made ``(system? (user assistant)+)?`` by the cheapest
    edits. A role counts by its initial; one that is not s, u or a (the empty one too) cannot be kept. Texts and
    conversations of any length are taken whole; a conversation in a block of its own partition is one piece.

    Gives (conv_id, part, seq, codes, audit, roles, texts): pieces of a conversation go by part and seq; codes has an
    initial and a fault for every row, audit the edits' initials, roles and texts what they leave. An empty table
    gives no rows.
    """
    turns = turns.select(turns["conv_id"].cast("long").alias("conv_id"), turns["turn"].cast("long").alias("turn"), F.coalesce(turns["role"].cast("string"), F.lit(" ")).alias("role"), F.coalesce(turns["text"].cast("string"), F.lit(" ")).alias("text"))
    cut = shared.table(_sorted_rows(turns).mapInArrow(lambda batches: _cut(batches, block_rows), PIECE), "turns")
    parts = cut.where(~F.col("whole"))
    behind = parts.select("conv_id", "part", "seq", "matrix").groupBy("conv_id").applyInPandas(_ends, "part int, seq int, after array<long>, last boolean")

    def walks(batches):
        for b in batches:
            c = b.to_pydict()
            made = [[walk(codes, s, tuple(after), last) for s in range(4)] for codes, after, last in zip(c["codes"], c["after"], c["last"])]
            columns = [b.column("conv_id"), b.column("part"), b.column("seq"), pa.array([[a for a, _ in m] for m in made], _TEXTS), pa.array([[e for _, e in m] for m in made], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "part", "seq", "audits", "ends"])

    walked = shared.table(parts.select("conv_id", "part", "seq", "codes").join(behind, ["part", "seq"]).mapInArrow(walks, "conv_id long, part int, seq int, audits array<string>, ends array<int>"), "walks")
    states = walked.select("conv_id", "part", "seq", "ends").groupBy("conv_id").applyInPandas(_begins, "part int, seq int, state int")
    own = walked.join(states, ["part", "seq"]).select("part", "seq", "state", F.element_at("audits", F.col("state") + 1).alias("audit"))

    def applied(batches):
        for b in batches:
            c = b.to_pydict()
            made = [apply(*x) for x in zip(c["audit"], c["state"], c["roles"], c["texts"])]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array([r for r, _ in made], _TEXTS), pa.array([t for _, t in made], _TEXTS)], names=["conv_id", "part", "seq", "codes", "audit", "roles", "texts"])

    done = parts.drop("audit").join(own, ["part", "seq"]).select("conv_id", "part", "seq", "codes", "audit", "state", "roles", "texts").mapInArrow(applied, "conv_id long, part int, seq int, codes string, audit string, roles array<string>, texts array<string>")
    kept = ["conv_id", "part", "seq", "codes", "audit", "roles", "texts"]
    return done.withColumn("whole", F.lit(False)).unionByName(cut.where("whole").select(*kept, "whole"))


class _Tally:
    """Counts, edits and digest of a conversation, from its pieces in order."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.counts, self.illegal, self.cost = conv_id, [0, 0, 0], 0, 0
        self.audit: list[str] = []
        self.sha, self.begun, self.last = hashlib.sha256(), False, ""

    def add(self, codes: str, audit: str, roles: list[str], texts: list[str]) -> None:
        for k, code in enumerate((BLANK, DUPLICATE, TRUNCATED)):
            self.counts[k] += codes[1::2].count(code)
        initials = self.last + codes[0::2]
        self.illegal += sum(initials[i : i + 2] not in ("su", "ua", "au") for i in range(len(initials) - 1))
        self.last = initials[-1:]
        self.cost += DELETE * audit.count("D") + INSERT * audit.count("I") + REROLE * audit.count("R")
        at = 0
        for letter in audit:
            if letter != "I":
                self.cost += KEEP_TRUNCATED * (letter != "D" and codes[2 * at + 1] == TRUNCATED)
                at += 1
        self.audit.append(audit)
        for role, text in zip(roles, texts):
            self.sha.update(f"{chr(10) * self.begun}{role}:{text}".encode())
            self.begun = True

    def row(self) -> tuple:
        return self.conv_id, *self.counts, self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest()


def _tallies(batches):
    now, rows = None, []
    for b in batches:
        for conv_id, codes, audit, roles, texts in zip(*(b.column(c).to_pylist() for c in ("conv_id", "codes", "audit", "roles", "texts"))):
            if now is None or now.conv_id != conv_id:
                rows += [now.row()] if now else []
                now = _Tally(conv_id)
            now.add(codes, audit, roles, texts)
        if len(rows) >= 1024:
            yield _batch(rows, _SUMMARIES)
            rows = []
    rows += [now.row()] if now else []
    if rows:
        yield _batch(rows, _SUMMARIES)


def summary(pieces: DataFrame, turns: DataFrame) -> DataFrame:
    """Per conversation of ``turns``: gaps in its turns (nulls aside), counts of faults, illegal neighbours, cost, audit and the digest of the repaired rows.

    ``pieces`` is what ``repair`` gives for ``turns``. A conversation of several pieces is digested a piece at a time:
    SHA-256 reads its text in order, so this is the one step that no other task can share.
    """
    columns = ["conv_id", "part", "seq", "codes", "audit", "roles", "texts"]
    whole = pieces.where("whole").select(*columns).mapInArrow(_tallies, SUMMARY)
    parts = pieces.where(~F.col("whole")).select(*columns).repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq").mapInArrow(_tallies, SUMMARY)
    gaps = turns.groupBy(F.col("conv_id").cast("long").alias("id")).agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"))
    found = whole.unionByName(parts)
    return gaps.join(found, gaps["id"].eqNullSafe(found["conv_id"])).drop("id").select("conv_id", "gaps", *[c for c in found.columns if c != "conv_id"])


def damage(turns: DataFrame) -> DataFrame:
    """Rows with the faults that the crc32 of ``conv_id:turn`` names, modulo 20: dropped, emptied, without ``.!?``, repeated, of role user; nulls are one space."""
    part = lambda c: F.coalesce(turns[c].cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.translate(part("text"), ".!?", "")).otherwise(part("text"))
    rows = turns.select(turns["conv_id"].cast("long").alias("conv_id"), turns["turn"].cast("long").alias("turn"), F.when(fate == 4, "user").otherwise(part("role")).alias("role"), text.alias("text"), fate.alias("fate"))
    return rows.where("fate <> 0").withColumn("again", F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("fate", "again")


def damaged_and_repaired(turns: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Every conversation of ``turns``, damaged and repaired; one that loses all of its rows has zeros, no edits and the digest of the empty string."""
    rows = damage(turns)
    found = summary(repair(rows, block_rows), rows)
    ids = turns.select(turns["conv_id"].cast("long").alias("id")).distinct()
    empty = {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit(""), 256)}
    joined = ids.join(found, ids["id"].eqNullSafe(found["conv_id"]), "left")
    return joined.select(F.col("id").alias("conv_id"), *[F.coalesce(found[c], empty.get(c, F.lit(0).cast("long"))).alias(c) for c in found.columns if c != "conv_id"])
