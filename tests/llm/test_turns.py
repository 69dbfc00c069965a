"""Conversation repair: edits against every edit string and a plain table of
least labels, damage and faults against a plain version, long conversations
cut into segments, defined results."""

import hashlib
import re
import zlib
from itertools import product

import numpy as np
import pytest

from ticklake.llm import turns

SCHEMA = "conv_id long, turn long, role string, text string"


def apply(edits, rows):
    """(cost, repaired lines) of an edit string, or None if it does not fit."""
    out, roles, i, cost = [], "", 0, 0
    for e in edits:
        due = "a" if roles.endswith("u") else "u"
        if e == "I":
            cost, roles = cost + 2, roles + due
            out.append({"u": "user", "a": "assistant"}[due] + ":")
            continue
        if i == len(rows):
            return None
        role, text, forced, cut = rows[i]
        i += 1
        if e == "D":
            cost += 3
            continue
        if forced:
            return None
        cost += cut
        if e == "K":
            roles += role[:1] or "?"
            out.append(f"{role}:{text}")
        else:
            cost, roles = cost + 2, roles + due
            out.append({"u": "user", "a": "assistant"}[due] + ":" + text)
    if i < len(rows) or not re.fullmatch("(s?(ua)+)?", roles):
        return None
    return cost, "\n".join(out)


def brute(rows):
    """Least (cost, audit, text) over every edit string of up to 3 inserts."""
    found = []
    for n in range(len(rows), len(rows) + 4):
        for edits in product("DIKR", repeat=n):
            if edits.count("I") == n - len(rows):
                got = apply(edits, rows)
                if got:
                    found.append((got[0], "".join(edits), got[1]))
    return min(found)


def table(rows):
    """The same from a table filled row by row: least (cost, audit) by what
    was written last."""
    due = {"": "u", "s": "u", "u": "a", "a": "u"}

    def inserts(best):
        for _ in range(3):
            for q, (c, a) in list(best.items()):
                best[due[q]] = min(best.get(due[q], (9e9, "")), (c + 2, a + "I"))
        return best

    best = inserts({"": (0, "")})
    for role, _, forced, cut in rows:
        after = {}
        for q, (c, a) in best.items():
            steps = [(q, c + 3, a + "D")]
            if not forced:
                steps.append((due[q], c + 2 + cut, a + "R"))
                if role[:1] == due[q] or (q == "" and role[:1] == "s"):
                    steps.append((role[:1], c + cut, a + "K"))
            for to, c2, a2 in steps:
                after[to] = min(after.get(to, (9e9, "")), (c2, a2))
        best = inserts(after)
    return min(best[q] for q in ("", "a") if q in best)


def random_rows(rng, n):
    roles = ["user", "assistant", "system", "tool", "", "umpire"]
    return [(roles[min(int(rng.exponential(1.2)), 5)], f"t{i}", bool(rng.random() < .15), int(rng.random() < .2)) for i in range(n)]


def lattice(rows):
    return [(None if forced else role[:1], 0 if forced else cut) for role, _, forced, cut in rows]


def test_every_edit_string():
    rng = np.random.default_rng(1)
    for n in (0, 1, 1, 2, 2, 2, 3, 3, 3, 3, 4, 4, 4, 4):
        rows = random_rows(rng, n)
        assert turns.cheapest(lattice(rows))[:2] == brute(rows)[:2] == table(rows)


def test_larger_against_the_table():
    rng = np.random.default_rng(2)
    for _ in range(400):
        rows = random_rows(rng, int(rng.integers(0, 40)))
        cost, audit, _ = turns.cheapest(lattice(rows))
        assert (cost, audit) == table(rows)
        assert apply(audit, rows)[0] == cost


def plain(rows):
    """The whole contract in plain code: {conv: result} of (conv, turn, role, text)."""
    after, out = {}, {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        here = after.setdefault(conv, [])
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fate == 1:
            text = ""
        if fate == 2:
            text = re.sub("[.!?]", "", text)
        if fate == 4:
            role = "user"
        here += [(turn, role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    for conv, here in after.items():
        here.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, counts, marked = set(), dict.fromkeys(("blank", "duplicate", "truncated"), 0), []
        for _, role, text in here:
            body = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            marked.append((role, text, fault in ("blank", "duplicate"), int(fault == "truncated")))
        known = [t for t, _, _ in here if t is not None]
        cost, audit = table(marked)
        out[conv] = {"gaps": max(known) - min(known) + 1 - len(set(known)) if known else 0, **counts,
                     "illegal": sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(here, here[1:])),
                     "cost": cost, "audit": audit,
                     "repaired_sha256": hashlib.sha256(apply(audit, marked)[1].encode()).hexdigest()}
    return out


def conversations(rng, n):
    rows = []
    for c in range(n):
        conv = None if c == 3 else c
        length = 700 if c in (5, 6) else int(rng.integers(1, 12))
        for t in range(length):
            role = ["user", "assistant"][t % 2] if rng.random() < .8 else rng.choice(["system", "user", "tool", ""])
            text = rng.choice(["Yes.", "No", "Why? ", "é!\n\t", " \n", "", "ok. ok", "long " * 50 + ".", f"n{t}.", f"m{t}"])
            turn = None if rng.random() < .03 else int(t + (rng.random() < .05) * 3)
            rows.append((conv, turn, None if rng.random() < .02 else str(role), None if rng.random() < .02 else str(text)))
    return rows + rows[:9]


@pytest.mark.parametrize("segment", [512, 5])
def test_whole_operator_against_plain(spark, segment):
    rows = conversations(np.random.default_rng(3), 60)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", cost string, present long").repartition(3)
    got = {r["conv_id"]: r.asDict() for r in turns.repair_conversations(df, segment).collect()}
    want = plain(rows)
    assert len(got) == len(want)
    for conv, w in want.items():
        assert {k: got[conv][k] for k in w} == w, conv


def test_defined_results(spark):
    assert turns.repair_conversations(spark.createDataFrame([], SCHEMA)).count() == 0
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    r = turns.repair_conversations(spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA)).collect()
    assert [tuple(x) for x in r] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_long_conversation_keeps_short_labels():
    rng = np.random.default_rng(4)
    rows = random_rows(rng, 6000)
    c = turns.Conversation(segment=64)
    for i, (role, text, forced, cut) in enumerate(rows):
        c.add(i, role, text, forced, False, bool(cut))
        assert max(len(a) for _, a, _ in c.labels.values()) < 200
    got = c.result()
    assert (got["cost"], got["audit"]) == table(rows)
    assert got["repaired_sha256"] == hashlib.sha256(apply(got["audit"], rows)[1].encode()).hexdigest()
