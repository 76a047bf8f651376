"""Conversation structure repair by Hirschberg's divide and conquer (operator 12).

The roles of a repaired conversation read ``(system)? (user assistant)*``.
That language has four states; every row moves between them by Keep, Rerole or
Delete, with Inserts before it.  A forward vector holds, for each state, the
least cost of reaching it and the place of its ASCII-least audit among the four
(two audits up to one row never are prefixes of each other, so the order of
beginnings decides).  A backward vector holds the least cost from each state to
the end.  Where the two meet in the middle, the state of least sum and least
audit is the crossing; both halves are then solved the same way, in space
linear in the rows.

Conversations lie in blocks of bounded size of the sorted table.  One that
lies inside a block is repaired there.  The others are pieces: a piece gives
its four-by-four table of costs, the vectors of a conversation's pieces meet at
every boundary, and each piece is then solved between its two crossings.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.llm.common import table, written

BLANKS = " \t\n\x0b\x0c\r"
#: Rows and bytes of text of a block.
BLOCK_ROWS, BLOCK_BYTES = 4096, 8 << 20
#: Costs of the edits, and of leaving a truncated row undeleted.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

# -- the language and its edits

#: States: nothing yet, after system, after user, after assistant; the next role's initials and states.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: The state that an inserted or rerolled row leads to, and the edits that end a conversation.
FILLED = (USER, USER, ASSISTANT, USER)
TAIL = ("", "II", "I", "")
INFINITE = 1 << 60


def row_class(initial: str, deleted: bool, truncated: bool) -> int:
    """What the edits of a row depend on: 0 must go, else its initial and whether it is truncated."""
    return 0 if deleted else 1 + "sua".find(initial if initial else "?") % 4 + 4 * truncated


def _moves(c: int) -> tuple[dict, ...]:
    """For each state {next state: (cost, letters)} of a row of class ``c``: least cost, then least letters."""
    out = []
    for q in range(4):
        best: dict[int, tuple[int, str]] = {}
        at, before = q, ""
        for _ in range(3):  # a third insert would only return to a state met before
            spent = INSERT * len(before)
            options = [(at, spent + DELETE, before + "D")]
            if c:
                more = TRUNCATED if c > 4 else 0
                options.append((FILLED[at], spent + REROLE + more, before + "R"))
                keep = NEXT[at].get("sua?"[(c - 1) % 4])
                if keep is not None:
                    options.append((keep, spent + more, before + "K"))
            for to, cost, letters in options:
                best[to] = min(best.get(to, (INFINITE, "")), (cost, letters))
            at, before = FILLED[at], before + "I"
        out.append(best)
    return tuple(out)


MOVES = tuple(_moves(c) for c in range(9))


class Vectors:
    """Forward and backward vectors as numbered states of a machine over row classes.

    Costs are kept relative to their least, so few different vectors occur; a
    step is looked up once it has been worked out.
    """

    def __init__(self):
        self.number: dict[tuple, int] = {}
        self.vector: list[tuple] = []
        self.ahead: dict[tuple[int, int], tuple[int, int]] = {}
        self.back: dict[tuple[int, int], tuple[int, int]] = {}

    def name(self, vector: tuple) -> int:
        if vector not in self.number:
            self.number[vector] = len(self.vector)
            self.vector.append(vector)
        return self.number[vector]

    def _relative(self, costs: list, ranks: tuple) -> tuple[int, int]:
        least = min(costs)
        return self.name((tuple(min(c - least, INFINITE) if c < INFINITE else INFINITE for c in costs), ranks)), least

    def _ahead(self, v: int, c: int) -> tuple[int, int]:
        costs, ranks = self.vector[v]
        best: list = [(INFINITE, 9, "")] * 4
        for q in range(4):
            if costs[q] < INFINITE:
                for to, (cost, letters) in MOVES[c][q].items():
                    best[to] = min(best[to], (costs[q] + cost, ranks[q], letters))
        order = sorted(range(4), key=lambda q: (best[q][0] >= INFINITE, best[q][1:], q))
        ranks = [0] * 4
        for place, q in enumerate(order):
            ranks[q] = place
        return self._relative([b[0] for b in best], tuple(ranks))

    def _back(self, v: int, c: int) -> tuple[int, int]:
        costs, _ = self.vector[v]
        return self._relative([min(cost + costs[to] for to, (cost, _) in MOVES[c][q].items()) for q in range(4)], ())

    def forward(self, rows: bytes, costs: tuple, ranks: tuple = (0, 1, 2, 3)) -> tuple[list, tuple]:
        """(costs, order of the audits) after ``rows`` from those before."""
        v, total = self._relative(list(costs), ranks)
        ahead = self.ahead
        for c in rows:
            step = ahead.get((v, c))
            if step is None:
                step = ahead[v, c] = self._ahead(v, c)
            v, more = step
            total += more
        costs, ranks = self.vector[v]
        return [min(c + total, INFINITE) for c in costs], ranks

    def backward(self, rows: bytes, costs: tuple) -> list:
        """Least costs from every state before ``rows``, given those after."""
        v, total = self._relative(list(costs), ())
        back = self.back
        for c in reversed(rows):
            step = back.get((v, c))
            if step is None:
                step = back[v, c] = self._back(v, c)
            v, more = step
            total += more
        return [min(c + total, INFINITE) for c in self.vector[v][0]]


VECTORS = Vectors()
ENDS = tuple(INSERT * len(t) if q != SYSTEM else 2 * INSERT for q, t in enumerate(TAIL))


def only(q: int) -> tuple:
    return tuple(0 if i == q else INFINITE for i in range(4))


def crossing(costs, ranks, rest) -> int:
    """The state of least cost in all, and among those of the ASCII-least audit so far."""
    return min(range(4), key=lambda q: (costs[q] + rest[q], ranks[q]))


def between(rows: bytes, enter: int, leave: int) -> str:
    """ASCII-least cheapest audit of ``rows`` from one state to another, by halves."""
    if len(rows) == 0:
        return ""
    if len(rows) == 1:
        return MOVES[rows[0]][enter][leave][1]
    mid = len(rows) // 2
    costs, ranks = VECTORS.forward(rows[:mid], only(enter))
    q = crossing(costs, ranks, VECTORS.backward(rows[mid:], only(leave)))
    return between(rows[:mid], enter, q) + between(rows[mid:], q, leave)


@lru_cache(maxsize=1 << 16)
def solved(rows: bytes) -> tuple[int, str]:
    """(cost, audit) of a whole conversation."""
    costs, ranks = VECTORS.forward(rows, only(START))
    q = crossing(costs, ranks, ENDS)
    return costs[q] + ENDS[q], between(rows, START, q) + TAIL[q]


def repaired(audit: str, roles: list, texts: list, state: int = START):
    """(role, text) of the rows that an audit leaves, from a state on."""
    at = 0
    for letter in audit:
        if letter == "I":
            state = FILLED[state]
            yield ("user" if state == USER else "assistant"), ""
            continue
        role, text = roles[at], texts[at]
        at += 1
        if letter == "K":
            state = NEXT[state][role[0]]
            yield role, text
        elif letter == "R":
            state = FILLED[state]
            yield ("user" if state == USER else "assistant"), text


# -- faults

def faults(roles: list, texts: list, late: set = frozenset()) -> tuple[bytes, list[int], list[bytes]]:
    """(row classes, [blank, duplicate, truncated], distinct keys in order) of rows in order.

    ``late`` are the keys that an earlier piece of the conversation holds.
    """
    seen: set[bytes] = set()
    classes, counts, keys = bytearray(), [0, 0, 0], []
    for role, text in zip(roles, texts):
        raw = role.encode()
        key = hashlib.md5(len(raw).to_bytes(4, "little") + raw + text.encode(), usedforsecurity=False).digest()
        body = text.rstrip(BLANKS)
        blank, again, cut = not body, key in seen or key in late, bool(body) and body[-1] not in ".!?"
        if key not in seen:
            seen.add(key)
            keys.append(key)
        first = 0 if blank else 1 if again else 2 if cut else None
        if first is not None:
            counts[first] += 1
        classes.append(row_class(role[:1], blank or again, cut))
    return bytes(classes), counts, keys


def illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials[:-1], initials[1:]))


# -- tables

def key_of(conv_id: str) -> Column:
    """A text that tells conversations apart, for null ids too."""
    return F.coalesce(F.concat(F.lit("c"), F.col(conv_id).cast("string")), F.lit(""))


def damaged(conversations: DataFrame) -> DataFrame:
    """(key, conv_id, turn, role, text) after the damage that crc32 of ``conv_id:turn`` deals; nulls are one space."""
    def text(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = conversations.select(key_of("conv_id").alias("key"), F.col("conv_id").cast("long").alias("conv_id"),
                                F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text"),
                                kind.alias("kind")).where(F.col("kind") != 0)
    return rows.select("key", "conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                       F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
                       .otherwise(F.col("text")).alias("text"),
                       F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
                       ).drop("copy")


def turn_gaps(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """(key, conv_id, gaps) of every conversation; turns are made distinct in the tasks first."""
    turns = (rows.select("key", "turn").where(F.col("turn").isNotNull()).distinct().groupBy("key")
             .agg(F.min("turn").alias("low"), F.max("turn").alias("high"), F.count("turn").alias("n")))
    missing = F.try_subtract(F.try_add(F.try_subtract(F.col("high"), F.col("low")), F.lit(1)), F.col("n"))
    all_of = conversations.select(key_of("conv_id").alias("key"), F.col("conv_id").cast("long").alias("conv_id")).distinct()
    return all_of.join(turns, "key", "left").select("key", "conv_id", F.when(F.col("n").isNull(), 0).otherwise(missing)
                                                    .cast("long").alias("gaps"))


PIECES = ("key string, conv_id long, block long, blank long, duplicate long, truncated long, illegal long, cost long, "
          "audit string, repaired_sha256 string, roles array<string>, texts array<string>, keys array<binary>")
TEXTS, BYTES = pa.list_(pa.string()), pa.list_(pa.binary())


def _piece_rows(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"block": pa.int64(), "conv_id": pa.int64(), "key": pa.string(), "audit": pa.string(), "repaired_sha256": pa.string(),
             "roles": TEXTS, "texts": TEXTS, "keys": BYTES}
    names = [f.split()[0] for f in PIECES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], kinds.get(n, pa.int64())) for n in names], names=names)


def digest(lines) -> str:
    return hashlib.sha256("\n".join(f"{role}:{text}" for role, text in lines).encode()).hexdigest()


def in_blocks(rows: DataFrame, with_rows: bool) -> DataFrame:
    """Rows sorted over the whole table and cut into blocks: a result for each conversation inside a block,
    a piece for each that touches a block's edge."""
    keyed = (rows.withColumn("start", F.left("text", F.lit(64))).withColumn("hash", F.xxhash64("text"))
             .withColumn("place", F.monotonically_increasing_id()))
    order = ["key", "turn", "role", "start", "hash", "place"]  # the last parts equal rows only
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "conv_id", "role", "text")

    def finished(key, conv_id, roles, texts):
        classes, counts, _ = faults(roles, texts)
        cost, audit = solved(classes)
        lines = list(repaired(audit, roles, texts))
        out = {"key": key, "conv_id": conv_id, "illegal": illegal([r[:1] for r in roles]), "cost": cost, "audit": audit,
               "repaired_sha256": digest(lines)} | dict(zip(("blank", "duplicate", "truncated"), counts))
        return out | ({"roles": [r for r, _ in lines], "texts": [t for _, t in lines]} if with_rows else {})

    def block(number, groups):
        out = []
        for i, (key, conv_id, roles, texts) in enumerate(groups):
            if 0 < i < len(groups) - 1:
                out.append(finished(key, conv_id, roles, texts))
            else:
                out.append({"key": key, "conv_id": conv_id, "block": number, "roles": roles, "texts": texts,
                            "keys": faults(roles, texts)[2]})
        return _piece_rows(out)

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        groups, n, size = [], 0, 0
        for b in batches:
            for key, conv_id, role, text in zip(*(c.to_pylist() for c in b.columns)):
                if n and (n >= BLOCK_ROWS or size + len(text) > BLOCK_BYTES):
                    yield block(number, groups)
                    number, groups, n, size = number + 1, [], 0, 0
                if not groups or groups[-1][0] != key:
                    groups.append((key, conv_id, [], []))
                groups[-1][2].append(role)
                groups[-1][3].append(text)
                n, size = n + 1, size + len(text)
        if groups:
            yield block(number, groups)

    return written(ordered.mapInArrow(run, PIECES), "conversation-blocks")


JUDGED = ("key string, conv_id long, block long, blank long, duplicate long, truncated long, illegal long, classes binary, "
          "initials string, costs array<long>, ranks array<long>, roles array<string>, texts array<string>")


def judged(pieces: DataFrame) -> DataFrame:
    """Faults of every piece, given the texts of the earlier pieces of its conversation, and its table of costs."""
    held = pieces.select("key", "block", F.explode("keys").alias("h"))
    first = held.groupBy("key", "h").agg(F.min("block").alias("first"))
    late = (held.join(first, ["key", "h"]).where(F.col("block") > F.col("first")).groupBy("key", "block")
            .agg(F.collect_list("h").alias("late")))  # of one piece: BLOCK_ROWS at most

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                classes, counts, _ = faults(r["roles"], r["texts"], set(r["late"] or ()))
                each = [VECTORS.forward(classes, only(q)) for q in range(4)]
                initials = [x[:1] for x in r["roles"]]
                yield pa.RecordBatch.from_pydict({
                    "key": pa.array([r["key"]]), "conv_id": pa.array([r["conv_id"]], pa.int64()), "block": pa.array([r["block"]]),
                    **{name: pa.array([n], pa.int64()) for name, n in zip(("blank", "duplicate", "truncated"), counts)},
                    "illegal": pa.array([illegal(initials)], pa.int64()), "classes": pa.array([classes], pa.binary()),
                    "initials": pa.array([(initials[0] or "?") + (initials[-1] or "?")]),
                    "costs": pa.array([[c for costs, _ in each for c in costs]], pa.list_(pa.int64())),
                    "ranks": pa.array([[int(c) for _, ranks in each for c in ranks]], pa.list_(pa.int64())),
                    "roles": pa.array([r["roles"]], TEXTS), "texts": pa.array([r["texts"]], TEXTS)})

    wide = pieces.select("key", "conv_id", "block", "roles", "texts").join(late, ["key", "block"], "left")
    return written(wide.mapInArrow(run, JUDGED), "conversation-pieces")


CROSSINGS = "key string, block long, enter int, leave int, tail string, cost long, illegal long"


def crossings(pieces: DataFrame) -> DataFrame:
    """The states in which each piece begins and ends; a group holds 32 numbers for each block of a conversation."""
    import pandas as pd

    def run(group):
        group = group.sort_values("block", ignore_index=True)
        costs, ranks = list(only(START)), (0, 1, 2, 3)
        ahead = []
        for table_of, order in zip(group["costs"], group["ranks"]):
            best = [(INFINITE, 9, 9)] * 4
            for q in range(4):
                for to in range(4):
                    if costs[q] < INFINITE and table_of[4 * q + to] < INFINITE:
                        best[to] = min(best[to], (costs[q] + int(table_of[4 * q + to]), ranks[q], int(order[4 * q + to])))
            placed = sorted(range(4), key=lambda q: (best[q][0] >= INFINITE, best[q][1:], q))
            costs, ranks = [x[0] for x in best], tuple(placed.index(q) for q in range(4))
            ahead.append((costs, ranks))
        rest, leave = list(ENDS), []
        for (costs, ranks), table_of in zip(reversed(ahead), reversed(list(group["costs"]))):
            leave.append(crossing(costs, ranks, rest))
            rest = [min(min(int(table_of[4 * q + to]) + rest[to], INFINITE) for to in range(4)) for q in range(4)]
        leave.reverse()
        initials = list(group["initials"])
        n = len(group)
        return pd.DataFrame({
            "key": group["key"], "block": group["block"], "enter": np.array([START, *leave[:-1]], np.int32),
            "leave": np.array(leave, np.int32), "tail": [""] * (n - 1) + [TAIL[leave[-1]]],
            "cost": np.array([rest[START]] + [0] * (n - 1), np.int64),
            "illegal": np.array([0] + [a[1] + b[0] not in ("su", "ua", "au") for a, b in zip(initials[:-1], initials[1:])], np.int64)})

    return pieces.select("key", "block", "initials", "costs", "ranks").groupBy("key").applyInPandas(run, CROSSINGS)


COUNTS = ["blank", "duplicate", "truncated", "illegal", "cost"]


def joined(pieces: DataFrame, with_rows: bool) -> DataFrame:
    """Results of the conversations in pieces.

    A piece is solved on its own.  Its lines then go to the conversation's
    task, which reads them in order and keeps only a running digest: the
    digest of one conversation is one value of all its lines, and sha256
    cannot be put together from parts.
    """
    at = crossings(pieces).withColumnRenamed("illegal", "border")
    both = pieces.drop("costs", "ranks", "initials").join(at, ["key", "block"])
    solved_schema = ("key string, conv_id long, block long, blank long, duplicate long, truncated long, illegal long, cost long, "
                     "audit string, roles array<string>, texts array<string>")

    def solve(batches):
        for b in batches:
            for r in b.to_pylist():
                audit = between(r["classes"], r["enter"], r["leave"]) + r["tail"]
                lines = list(repaired(audit, r["roles"], r["texts"], r["enter"]))
                yield pa.RecordBatch.from_pydict({
                    "key": pa.array([r["key"]]), "conv_id": pa.array([r["conv_id"]], pa.int64()), "block": pa.array([r["block"]]),
                    **{c: pa.array([r[c]], pa.int64()) for c in COUNTS[:3]},
                    "illegal": pa.array([r["illegal"] + r["border"]], pa.int64()), "cost": pa.array([r["cost"]], pa.int64()),
                    "audit": pa.array([audit]), "roles": pa.array([[x for x, _ in lines]], TEXTS),
                    "texts": pa.array([[x for _, x in lines]], TEXTS)})

    parts = written(both.mapInArrow(solve, solved_schema), "conversation-parts")

    def stream(batches):
        now, started = None, False
        for b in batches:
            for r in b.to_pylist():
                if now is None or now["key"] != r["key"]:
                    if now is not None:
                        yield out(now)
                    now, started = {"key": r["key"], "conv_id": r["conv_id"], "sha": hashlib.sha256(), "audit": [], **dict.fromkeys(COUNTS, 0)}, False
                for c in COUNTS:
                    now[c] += r[c]
                now["audit"].append(r["audit"])
                for role, text in zip(r["roles"], r["texts"]):
                    now["sha"].update((("\n" if started else "") + f"{role}:{text}").encode())
                    started = True
        if now is not None:
            yield out(now)

    def out(now):
        return _piece_rows([{**now, "audit": "".join(now["audit"]), "repaired_sha256": now["sha"].hexdigest()}])

    results = parts.repartition(F.col("key")).sortWithinPartitions("key", "block").mapInArrow(stream, PIECES).drop("block", "keys")
    if with_rows:
        lines = parts.select("key", "conv_id", "block", "roles", "texts")
        return results, lines
    return results, None


class Repair:
    """Repaired conversations of (key, conv_id, turn, role, text) rows.

    ``report``: one row a conversation with its faults, cost, audit and digest.
    ``rows``: its repaired rows (key, conv_id, block, pos, role, text), in the
    order of block and pos (with ``with_rows``).  Rows of one turn go by role,
    then by the text's first 64 characters, then by a hash of it; equal rows
    stay side by side.
    """

    def __init__(self, rows: DataFrame, with_rows: bool = False):
        blocks = in_blocks(rows, with_rows)
        whole = blocks.where(F.col("block").isNull())
        ends, lines = joined(judged(blocks.where(F.col("block").isNotNull())), with_rows)
        self.report = whole.drop("block", "keys").unionByName(ends).drop("roles", "texts")
        self.rows = None
        if with_rows:
            all_lines = whole.select("key", "conv_id", F.lit(0).cast("long").alias("block"), "roles", "texts").unionByName(lines)
            self.rows = all_lines.select("key", "conv_id", "block", F.posexplode(F.arrays_zip("roles", "texts")).alias("pos", "line")).select(
                "key", "conv_id", "block", "pos", F.col("line.roles").alias("role"), F.col("line.texts").alias("text"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation of ``conversations`` after the dealt damage.

    Conversations that lose every row have zeros, an empty audit and the
    digest of nothing.  Null ids make one conversation.
    """
    conversations = table(spark, sf_dir, "conversations")
    rows = damaged(conversations)
    report = Repair(rows).report.drop("conv_id")
    zero = F.lit(0).cast("long")
    return turn_gaps(conversations, rows).join(report, "key", "left").select(
        "conv_id", "gaps", *[F.coalesce(F.col(c), zero).alias(c) for c in COUNTS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
