"""Operator 12: conversation structure repair by bidirectional Dijkstra.

A conversation is repaired by editing its rows in order, so that the role
initials become ``(s?(ua)+)?``: an optional system row, then user and
assistant in turn, or nothing.  The edits form a lattice: a node is (rows
read, what was written last: nothing, s, u or a), an edge keeps a row, gives
it the role that is due, deletes it or inserts an empty row that is due.  One
heap grows from the start, one from the ends.  A node leaves its heap with the
least cost and, among those, the least audit (the initials of the edits).  When
the two heaps' least costs together pass the best crossing, every crossing of
that cost has been met, and the one whose joined audit is least is the answer.

Why the least audit of a node is enough: the edits' initials alone say which
nodes a path runs through, so of two cheapest paths to a node neither audit
begins with the other, and the order holds whatever follows.

Scale: conversations are dealt out by id, sorted, and read as a stream of
Arrow batches.  A conversation of more than ``SEGMENT`` rows is searched
segment by segment: the cheapest label of each of the four nodes of a segment's
end starts the next, with its audit and its SHA-256 so far, so a task holds a
segment of rows and four audits (the audit is a cell of the result).  The hash
of a conversation's text is one sequential sum, so one conversation is one
task's stream; it is never held.  Only repeated (role, text) pairs of one
conversation, their first turns, meet the rows in a join; Spark picks its way
from the written table's size.

Defined results: null role and text are one space, as are a null id and turn
in the damage key; rows of a null id are one conversation; of one turn, rows
are taken by role, then text; every conversation gives one row, also when
no row is left; an empty table gives an empty result; other columns play no
part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from heapq import heappop, heappush
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.llm.arrow import bounded
from ticklake.session import materialize

SEGMENT = 512
SEGMENT_CHARS = 1 << 22
BLANK = " \t\n\x0b\f\r"
#: Costs of the edits, and of a truncated row that is not deleted.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: What was written last: nothing, s, u, a.  The repaired text may end after nothing or a.
START, S, U, A = range(4)
ENDS = (START, A)
DUE = {START: U, S: U, U: A, A: U}
ROLE = {U: "user", A: "assistant"}
KEEP = {(START, "s"): S, **{(q, "u" if v == U else "a"): v for q, v in DUE.items()}}
FROM_DUE = {U: (START, S, A), A: (U,)}
FROM_KEEP = {}
for (_q, _c), _v in KEEP.items():
    FROM_KEEP.setdefault((_v, _c), []).append(_q)
#: What the rest costs at most more from the first node than from the second:
#: a system row kept there is deleted here, a row due there is inserted here.
MORE = {(A, START): DELETE, (A, S): 0, (A, U): INSERT, (U, A): INSERT, (U, S): INSERT, (U, START): INSERT + DELETE,
        (START, S): 0}
LEGAL = ("su", "ua", "au")
MAX_LONG = 2 ** 63 - 1

#: A row of the lattice: (role's initial, None where it must go; 1 if truncated).
Row = tuple[str | None, int]


def _onward(rows: Sequence[Row], i: int, q: int) -> Iterator[tuple[int, str, int, int]]:
    """Edges out of a node: (cost, initial, rows read, written last)."""
    if i < len(rows):
        initial, cut = rows[i]
        yield DELETE, "D", i + 1, q
        if initial is not None:
            to = KEEP.get((q, initial))
            if to is not None:
                yield cut, "K", i + 1, to
            yield REROLE + cut, "R", i + 1, DUE[q]
    yield INSERT, "I", i, DUE[q]


def _backward(rows: Sequence[Row], i: int, q: int) -> Iterator[tuple[int, str, int, int]]:
    """Edges into a node, by where they come from."""
    if i:
        initial, cut = rows[i - 1]
        yield DELETE, "D", i - 1, q
        if initial is not None:
            for p in FROM_KEEP.get((q, initial), ()):
                yield cut, "K", i - 1, p
            for p in FROM_DUE.get(q, ()):
                yield REROLE + cut, "R", i - 1, p
    for p in FROM_DUE.get(q, ()):
        yield INSERT, "I", i, p


def cheapest(rows: Sequence[Row], starts: dict[int, tuple[int, str]] | None = None,
             ends: Sequence[int] = ENDS) -> tuple[int, str, int] | None:
    """The least (cost, audit) from one of ``starts`` (node: cost and audit
    so far) to one of ``ends``, and the start it comes from.

    Heap entries are (cost, rows passed, audit, node's last, start): of equal
    cost, edges that cost nothing lead to entries further on, so a node's
    candidates are all there when the first of them leaves the heap."""
    n = len(rows)
    heads: list[list] = [[], []]
    starts = starts or {START: (0, "")}
    for q, (cost, audit) in starts.items():
        heappush(heads[0], (cost, 0, audit, q, q))
    for q in ends:
        heappush(heads[1], (0, 0, "", q, q))
    settled: tuple[dict, dict] = ({}, {})
    best = None                                  # (cost, audit, start)
    while heads[0] or heads[1]:
        tops = [h[0][0] if h else 0 for h in heads]
        if best is not None and tops[0] + tops[1] > best[0]:
            break
        side = 1 if not heads[0] or (heads[1] and tops[1] < tops[0]) else 0
        cost, passed, audit, q, origin = heappop(heads[side])
        i = n - passed if side else passed
        if (i, q) in settled[side]:
            continue
        settled[side][i, q] = (cost, audit, origin)
        other = settled[1 - side]
        # a path may begin or end where the other side has come
        if side and i == 0 and q in starts:
            found = (cost + starts[q][0], starts[q][1] + audit, q)
            best = found if best is None else min(best, found)
        elif not side and i == n and q in ends:
            found = (cost, audit, origin)
            best = found if best is None else min(best, found)
        for w, edit, j, p in (_backward if side else _onward)(rows, i, q):
            met = other.get((j, p))
            if met is not None:
                found = ((cost + w + met[0], met[1] + edit + audit, met[2]) if side
                         else (cost + w + met[0], audit + edit + met[1], origin))
                best = found if best is None else min(best, found)
            if (j, p) not in settled[side]:
                heappush(heads[side], (cost + w, n - j if side else j, edit + audit if side else audit + edit, p, origin))
    return best


class _Hash:
    """SHA-256 of lines joined by newlines."""

    def __init__(self, of: "_Hash | None" = None):
        self.sum = of.sum.copy() if of else hashlib.sha256()
        self.any = of.any if of else False

    def line(self, text: str) -> None:
        self.sum.update(("\n" + text if self.any else text).encode("utf-8", "surrogatepass"))
        self.any = True


def replay(edits: str, last: int, rows: Sequence[tuple[str, str]], out: _Hash) -> int:
    """Applies ``edits`` to (role, text) rows; returns what was written last."""
    i = 0
    for e in edits:
        if e == "D":
            i += 1
            continue
        if e == "K":
            role, text = rows[i]
            last = KEEP[last, role[:1]]
        else:
            last = DUE[last]
            role, text = ROLE[last], rows[i][1] if e == "R" else ""
        i += e != "I"
        out.line(f"{role}:{text}")
    return last


class Conversation:
    """One conversation's rows in order, one by one."""

    def __init__(self, segment: int = SEGMENT, segment_chars: int = SEGMENT_CHARS):
        self.segment, self.segment_chars = segment, segment_chars
        #: by node: cost, audit after the part that all labels share, hash
        self.labels: dict[int, tuple[int, str, _Hash]] = {START: (0, "", _Hash())}
        self.shared: list[str] = []
        self.rows: list[Row] = []
        self.texts: list[tuple[str, str]] = []
        self.chars = 0
        self.n = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.low = self.high = self.last_turn = None
        self.turns = 0
        self.before = None                       # the row before: (turn, role, text)

    def add(self, turn: int | None, role: str, text: str, blank: bool, repeat: bool, cut: bool) -> None:
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.last_turn
            self.high = self.last_turn = turn
        # equal rows of one turn lie together
        repeat = repeat or self.before == (turn, role, text)
        fault = "blank" if blank else "duplicate" if repeat else "truncated" if cut else None
        if fault:
            self.n[fault] += 1
        if self.before is not None:
            self.n["illegal"] += self.before[1][:1] + role[:1] not in LEGAL
        self.before = (turn, role, text)
        self.rows.append((None if blank or repeat else role[:1], TRUNCATED if cut and not blank and not repeat else 0))
        self.texts.append((role, text))
        self.chars += len(text)
        if len(self.rows) >= self.segment or self.chars >= self.segment_chars:
            self._search(range(4))

    def _search(self, ends: Sequence[int], together: bool = False) -> None:
        """Labels at the end of the rows held: one for each of ``ends``, or
        one for the least of them."""
        starts = {q: (c, a) for q, (c, a, _) in self.labels.items()}
        made = {}
        for goal in ([tuple(ends)] if together else [(e,) for e in ends]):
            found = cheapest(self.rows, starts, goal)
            if found is None:
                continue
            cost, audit, origin = found
            kept = _Hash(self.labels[origin][2])
            last = replay(audit[len(starts[origin][1]):], origin, self.texts, kept)
            made[last] = (cost, audit, kept)
        # labels that no cheapest path runs through
        made = {q: x for q, x in made.items()
                if not any((r, q) in MORE and x[0] > y[0] + MORE[r, q] for r, y in made.items())}
        common = commonprefix([a for _, a, _ in made.values()])
        self.shared.append(common)
        self.labels = {q: (c, a[len(common):], kept) for q, (c, a, kept) in made.items()}
        self.rows, self.texts, self.chars = [], [], 0

    def result(self) -> dict:
        self._search(ENDS, together=True)
        (cost, audit, out), = self.labels.values()
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.turns, MAX_LONG)
        return {"gaps": gaps, **self.n, "cost": cost, "audit": "".join(self.shared) + audit, "repaired_sha256": out.sum.hexdigest()}


RESULT = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")
COLS = [c.split()[0] for c in RESULT.split(", ")]


def _repair(segment: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ident, done = None, None, []

        def flush(kind):
            made = pa.RecordBatch.from_pydict({"conv_id": pa.array([i for i, _ in done], kind), **{
                c: pa.array([r[c] for _, r in done], pa.string() if c in ("audit", "repaired_sha256") else pa.int64())
                for c in COLS}})
            done.clear()
            return made

        kind = None
        for b in batches:
            kind = b.schema.field("conv_id").type
            cols = [b.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "present", "blank", "repeat", "cut")]
            for conv, turn, role, text, present, *faults in zip(*cols):
                if now is None or conv != ident:
                    if now is not None:
                        done.append((ident, now.result()))
                    now, ident = Conversation(segment), conv
                if present:
                    now.add(turn, role, text, *faults)
            if done:
                yield flush(kind)
        if now is not None:
            done.append((ident, now.result()))
            yield flush(kind)
    return run


def damage_key(conv: Column, turn: Column) -> Column:
    return F.concat(F.coalesce(conv.cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(turn.cast("string"), F.lit(" ")))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with faults put in by a hash of id
    and turn.  ``present`` is false for dropped rows, which stay so that every
    conversation has a row."""
    fate = F.crc32(damage_key(F.col("conv_id"), F.col("turn"))) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return rows.select(
        "conv_id", "turn", F.when(fate == 4, "user").otherwise(role).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (fate != 0).alias("present"),
        F.explode(F.when(fate == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("nth")).drop("nth")


def repair(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row a conversation of (conv_id, turn, role, text, present):
    its faults, the cheapest repair's cost and audit, and the hash of the
    repaired text."""
    whole = F.rtrim(F.col("text"), F.lit(BLANK))
    marked = rows.select("*", (whole == "").alias("blank"), (~F.right(whole, F.lit(1)).isin(".", "!", "?")).alias("cut"),
                         F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256).alias("pair"))
    # the first turn of every pair that a conversation holds in several turns
    late = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = (marked.filter("present").groupBy("conv_id", "pair").agg(F.min(late).alias("first"), F.max(late).alias("last"))
             .filter("first < last").select(F.col("conv_id").alias("of"), F.col("pair").alias("same"), "first"))
    first = materialize(first, "repeated_turns")
    met = marked.join(first, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("pair") == F.col("same")), "left")
    met = met.select("conv_id", "turn", "role", "text", "present", "blank", "cut",
                     F.coalesce(F.col("first") < late, F.lit(False)).alias("repeat"))
    order = ["conv_id", "turn", "role", "text"]
    ready = bounded(met.repartition("conv_id").sortWithinPartitions(*order))
    kind = rows.schema["conv_id"].dataType.simpleString()
    return ready.mapInArrow(_repair(segment), f"conv_id {kind}, {RESULT}")


def repair_conversations(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """The stated damage, then its repair."""
    four = conversations.select("conv_id", "turn", "role", "text")
    return repair(damaged(four), segment)
