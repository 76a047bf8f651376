"""Operator 12 against a plain backward dynamic program with greedy audits."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from tests.conftest import SF001, SF01
from landfall.llm import conversations as conv
from landfall.llm.common import table

GO = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}  # state: the last role's initial
FILL = {"": "u", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}


def damage(rows):
    """rows (conv_id, turn, role, text) in any order -> those after the damage, in order."""
    out = []
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def repair(rows):
    """rows (turn, role, text) in order: (gaps, blank, duplicate, truncated, illegal, cost, audit, repaired lines)."""
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    counts, must, cut, seen = [0, 0, 0], [], [], set()
    for _, role, text in rows:
        marks = re.findall(r"[^\x20\x09-\x0D]", text)
        blank, again, short = not marks, (role, text) in seen, bool(marks) and marks[-1] not in ".!?"
        seen.add((role, text))
        for i, x in enumerate((blank, again, short)):
            if x:
                counts[i] += 1
                break
        must.append(blank or again)
        cut.append(short)
    bad = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    n = len(rows)

    def edits(i, q):  # (letter, cost, next row, next state), of row i in state q
        out = []
        if i < n:
            out.append(("D", 4, i + 1, q))
            if not must[i]:
                more = 3 * cut[i]
                to = GO.get((q, rows[i][1][:1]))
                if to:
                    out.append(("K", more, i + 1, to))
                out.append(("R", 3 + more, i + 1, FILL[q]))
        out.append(("I", 3, i, FILL[q]))
        return out

    rest = [{q: 10**9 for q in FILL} for _ in range(n + 1)]
    rest[n].update({"": 0, "a": 0})
    for i in range(n, -1, -1):
        for _ in range(4):  # inserts lead from state to state of one row
            for q in FILL:
                rest[i][q] = min([rest[i][q], *(cost + rest[j][to] for _, cost, j, to in edits(i, q))])
    i, q, audit, lines = 0, "", "", []
    while not (i == n and rest[n][q] == 0):
        letter, _, j, to = min(e for e in edits(i, q) if e[1] + rest[e[2]][e[3]] == rest[i][q])
        audit += letter
        if letter != "D":
            lines.append((rows[i][1] if letter == "K" else NAMES[to], "" if letter == "I" else rows[i][2]))
        i, q = j, to
    return (gaps, *counts, bad, rest[0][""], audit, lines)


def expected(rows):
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    out = {}
    for c, mine in by.items():
        *numbers, lines = repair(damage(mine))
        text = "\n".join(f"{role}:{text}" for role, text in lines)
        out[c] = (*numbers, hashlib.sha256(text.encode()).hexdigest())
    return out


NUMBERS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def got(df):
    rows = df.collect()
    out = {r["conv_id"]: tuple(r[c] for c in NUMBERS) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_whole_table(spark, sf):
    rows = [tuple(r) for r in table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert got(conv.op12(spark, sf)) == expected(rows)


def made():
    rng = random.Random(5)
    texts = ["Yes.", "No", "", " \t", "Why?", "Go on!", "a\n.", "é?\n ", None, "word " * 2000 + "."]
    roles = ["user", "assistant", "system", "tool", "", None, "User"]
    rows = [(c, rng.choice([None, *range(8)]), rng.choice(roles[:3] * 3 + roles), rng.choice(texts) if rng.random() < .5 else f"t{rng.random()}.")
            for c in [*range(60), None] for _ in range(rng.randrange(1, 12))]
    rows += [(1000, t, rng.choice(roles[:2]), rng.choice(["Same.", f"text {t % 50}.", f"cut {t}"])) for t in range(1500)]
    rows += [(1001, 3, "user", "Equal.")] * 300 + [(1002, -10**18, "user", "a."), (1002, 10**18, "assistant", "b.")]
    return rows


@pytest.mark.parametrize("size", [3, 64, 4096])
def test_odd_conversations(spark, monkeypatch, tmp_path, size):
    """Blocks of any size give the same; one conversation holds most rows; ids, turns, roles and texts are null."""
    monkeypatch.setattr(conv, "BLOCK_ROWS", size)
    rows = made()
    path = str(tmp_path)
    spark.createDataFrame([(*r, "x", 0) for r in rows], "conv_id long, turn long, role string, text string, audit string, key int"
                          ).repartition(5).write.parquet(f"{path}/conversations.parquet")
    want = expected(rows)
    result = got(conv.op12(spark, path))
    assert result.keys() == want.keys()
    assert {c: (result[c], want[c]) for c in want if result[c] != want[c]} == {}


def test_repaired_rows(spark, monkeypatch):
    """The operator's own rows are those of the digest, in order."""
    monkeypatch.setattr(conv, "BLOCK_ROWS", 7)
    rows = [r for r in made() if r[0] in (1, 2, 3, 1000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = conv.Repair(conv.damaged(df), with_rows=True).rows.collect()
    for c in (1, 2, 3, 1000):
        lines = [(r["role"], r["text"]) for r in sorted((r for r in out if r["conv_id"] == c), key=lambda r: (r["block"], r["pos"]))]
        assert lines == repair(damage([r for r in rows if r[0] == c]))[-1]


def test_empty(spark, tmp_path):
    path = str(tmp_path)
    schema = "conv_id long, turn long, role string, text string"
    spark.createDataFrame([], schema).write.parquet(f"{path}/conversations.parquet")
    assert conv.op12(spark, path).collect() == []
    gone = next(i for i in itertools.count() if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    spark.createDataFrame([(gone, 0, "user", "Hi.")], schema).write.mode("overwrite").parquet(f"{path}/conversations.parquet")
    assert got(conv.op12(spark, path)) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_audits():
    """Cheapest and ASCII-least audits against every sequence of edits of short conversations."""
    kinds = [("u", 0, 0), ("u", 1, 0), ("a", 0, 0), ("a", 1, 0), ("s", 0, 0), ("t", 0, 0), ("t", 1, 0), ("u", 0, 1)]
    for n in range(4):
        for rows in itertools.product(kinds, repeat=n):
            best = None
            for letters in itertools.product(*([("", "I", "II")] + [[x + y for x in "DKR" for y in ("", "I", "II")]] * n)):
                audit, q, cost, i = "".join(letters), "", 0, 0
                for x in audit:
                    if x == "I":
                        q, cost = FILL[q], cost + 3
                        continue
                    initial, short, gone = rows[i]
                    i += 1
                    if x == "D":
                        cost += 4
                    elif gone:
                        break
                    else:
                        q, cost = (GO.get((q, initial)) if x == "K" else FILL[q]), cost + 3 * short + 3 * (x == "R")
                        if q is None:
                            break
                else:
                    if q in ("", "a"):
                        best = min(best or (10**9, ""), (cost, audit))
            assert conv.solved(bytes(conv.row_class(a, bool(g), bool(s)) for a, s, g in rows)) == best, rows


def test_halves_of_long_conversations():
    rng = random.Random(7)
    for n in (50, 333, 2000):
        rows = bytes(rng.choice([0, 1, 2, 2, 3, 3, 4, 6, 7]) for _ in range(n))
        cost, audit = conv.solved(rows)
        plain = repair([(0, " ", " ") if c == 0 else (0, "sua?"[(c - 1) % 4], f"{i}" + ("" if c > 4 else ".")) for i, c in enumerate(rows)])
        assert (cost, audit) == (plain[5], plain[6])
