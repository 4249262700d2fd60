"""Repairing the turns of conversations: cheapest edits to a valid order of roles.

A conversation is read in order. For each state of the pattern of roles the cheapest edits that lead
there survive, as a leaf of a tree whose nodes point back to the edit before them and count the nodes
behind. Once all survivors have one ancestor, the edits up to it are settled: they are handed on and
forgotten, so a task holds what is open, not the conversation. Edits of equal cost are compared by
their letters back to where they part. Texts are held for open edits that keep them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What edits cost.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
USER, ASSISTANT = "user", "assistant"
#: White space: blank and tab to carriage return.
SPACE = " \t\n\x0b\x0c\r"

# States: nothing yet, after the system turn, after a user's turn, after an assistant's.
START, SYSTEM, ASKED, ANSWERED = range(4)
#: The turn that a state waits for, and the state after it; a kept system turn may only come first.
NEXT = {START: ("u", ASKED), SYSTEM: ("u", ASKED), ASKED: ("a", ANSWERED), ANSWERED: ("u", ASKED)}
NAMES = {"u": USER, "a": ASSISTANT}
#: What it costs at most to go on from the second state in place of the first: a survivor dearer than
#: another by more can be neither cheapest nor tied. (From START on, a system turn may have to go.)
INSTEAD = {
    START: ((SYSTEM, 6), (ASKED, 7), (ANSWERED, 4)),
    SYSTEM: ((START, 0), (ASKED, 3), (ANSWERED, 0)),
    ASKED: ((START, 3), (SYSTEM, 3), (ANSWERED, 3)),
    ANSWERED: ((START, 0), (SYSTEM, 6), (ASKED, 3)),
}

EDITS = (
    "conv {conv}, place long, edit string, turn long, role string, text string, report struct<gaps: long, blank: long, "
    "duplicate: long, truncated: long, illegal: long, cost: long>"
)


class _Edit:
    """A node of the tree: an edit, the one before it, and how many nodes and survivors follow."""

    __slots__ = ("before", "behind", "depth", "letter", "turn")

    def __init__(self, before: _Edit | None, letter: str, turn: tuple | None):
        self.before, self.letter, self.turn = before, letter, turn
        self.depth = before.depth + 1 if before else 0
        self.behind: list[_Edit] = []


def _less(a: _Edit, more_a: str, b: _Edit, more_b: str) -> bool:
    """Whether the letters of the edits up to ``a`` and then ``more_a`` come before those of ``b``."""
    left, right = [], []
    while a is not b:
        if a.depth >= b.depth:
            left.append(a.letter)
            a = a.before
        else:
            right.append(b.letter)
            b = b.before
    return "".join(reversed(left)) + more_a < "".join(reversed(right)) + more_b


class Repair:
    """The survivors of one conversation. ``add`` its turns in order, then ``close``; both return the
    edits settled so far, as (letter, (turn, role, text))."""

    def __init__(self):
        self.root = _Edit(None, "", None)
        # State: cost and last edit of the survivor.
        self.states: dict[int, tuple[int, _Edit]] = {START: (0, self.root)}

    def _move(self, steps: list[tuple[int, int, _Edit, str, tuple | None]]) -> None:
        """New survivors from steps (state, cost, edit before, letter or none, turn)."""
        best: dict[int, tuple[int, int, _Edit, str, tuple | None]] = {}
        for step in steps:
            other = best.get(step[0])
            if other is None or step[1] < other[1] or (step[1] == other[1] and _less(step[2], step[3], other[2], other[3])):
                best[step[0]] = step
        for state in list(best):
            if any(other in best and best[other][1] + more < best[state][1] for other, more in INSTEAD[state]):
                del best[state]
        old = [edit for _, edit in self.states.values()]
        self.states = {}
        for state, cost, before, letter, turn in best.values():
            if letter:
                edit = _Edit(before, letter, turn)
                before.behind.append(edit)
            else:
                edit = before
            self.states[state] = (cost, edit)
        # Branches that no survivor is on go, up to where they left the rest.
        alive = {id(edit) for _, edit in self.states.values()}
        for edit in old:
            while edit is not self.root and not edit.behind and id(edit) not in alive and edit.before is not None:
                before, edit.before = edit.before, None
                before.behind.remove(edit)
                edit = before

    def _inserts(self) -> None:
        steps = [(state, cost, edit, "", None) for state, (cost, edit) in self.states.items()]
        for state, (cost, edit) in self.states.items():
            role, after = NEXT[state]
            steps.append((after, cost + INSERT, edit, "I", (None, NAMES[role], "")))
        self._move(steps)

    def _settled(self) -> list[tuple[str, tuple | None]]:
        """The edits that all survivors share and that were not handed on before."""
        out = []
        last = {id(edit) for _, edit in self.states.values()}
        while len(self.root.behind) == 1 and id(self.root) not in last:
            self.root = self.root.behind[0]
            self.root.before = None
            out.append((self.root.letter, self.root.turn))
            self.root.turn = None
        return out

    def add(self, turn: int | None, role: str, text: str, useless: bool, truncated: bool) -> list[tuple[str, tuple | None]]:
        """One turn; a ``useless`` one has to be deleted, a ``truncated`` one costs more if it stays."""
        self._inserts()
        steps, initial, more = [], role[:1], TRUNCATED if truncated else 0
        for state, (cost, edit) in self.states.items():
            steps.append((state, cost + DELETE, edit, "D", None))
            if useless:
                continue
            wanted, after = NEXT[state]
            if initial == wanted:
                steps.append((after, cost + more, edit, "K", (turn, role, text)))
            else:
                steps.append((after, cost + REROLE + more, edit, "R", (turn, NAMES[wanted], text)))
            if state == START and initial == "s":
                steps.append((SYSTEM, cost + more, edit, "K", (turn, role, text)))
        self._move(steps)
        return self._settled()

    def close(self) -> tuple[int, list[tuple[str, tuple | None]]]:
        """The cost of the cheapest repair and the edits not handed on before."""
        self._inserts()
        ends = {state: x for state, x in self.states.items() if state in (START, ANSWERED)}
        self._move([(START, cost, edit, "", None) for cost, edit in ends.values()])
        return self.states[START][0], self._settled()


class _Conversation:
    """What one conversation's turns show, one after the other, and its repair."""

    def __init__(self, conv):
        self.conv, self.place, self.repair = conv, 0, Repair()
        self.initial, self.first, self.turn, self.turns = None, None, None, 0
        self.blank = self.duplicate = self.truncated = self.illegal = 0

    def _rows(self, edits: list) -> list[tuple]:
        rows = []
        for letter, turn in edits:
            rows.append((self.conv, self.place, letter, *(turn or (None, None, None)), None))
            self.place += 1
        return rows

    def add(self, turn: int | None, role: str, text: str, seen: bool) -> list[tuple]:
        """A turn; ``seen`` if an earlier one has its role and text."""
        words = text.strip(SPACE)
        blank, cut = not words, words[-1:] not in (".", "!", "?")
        duplicate, truncated = seen and not blank, cut and not (blank or seen)
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        if self.initial is not None and self.initial + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = role[:1]
        if turn is not None and turn != self.turn:
            self.first = turn if self.first is None else self.first
            self.turn, self.turns = turn, self.turns + 1
        return self._rows(self.repair.add(turn, role, text, blank or duplicate, truncated))

    def end(self) -> list[tuple]:
        cost, edits = self.repair.close()
        gaps = self.turn - self.first + 1 - self.turns if self.turns else 0
        names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
        values = (gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost)
        return [*self._rows(edits), (self.conv, self.place, None, None, None, None, dict(zip(names, values, strict=True)))]


def _values(batch: pa.RecordBatch) -> Iterator[tuple]:
    for k in range(0, len(batch), 256):
        yield from zip(*(column.slice(k, 256).to_pylist() for column in batch.columns), strict=True)


def _first_of_each(turns: DataFrame) -> DataFrame:
    """``conv, turn, role, text, later``: whether the conversation has the role and text under a lesser number.

    Rows equal in all but the turn are counted before they are dealt out; only sorts of rows that occur
    more than once are joined back.
    """
    same = ["conv", "role", "digest"]
    rows = turns.withColumn("digest", F.sha2("text", 256))
    order = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    sorts = rows.groupBy(*same).agg(F.min(order).alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    sorts = sorts.select(F.col("conv").alias("c2"), F.col("role").alias("r2"), F.col("digest").alias("d2"), "least")
    equal = F.col("conv").eqNullSafe(F.col("c2")) & (F.col("role") == F.col("r2")) & (F.col("digest") == F.col("d2"))
    met = rows.join(sorts, equal, "left")
    # Of rows in one turn, which are neighbours, the reader tells the first.
    return met.withColumn("later", F.coalesce(F.col("least") < order, F.lit(False))).select("conv", "turn", "role", "text", "later")


def edits(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The edits that repair every conversation, and a report on each.

    One row an edit, ``conv, place, edit, turn, role, text``: K a turn that stays, R one with another
    role, D one that goes (no turn, role and text), I one put in (no turn, empty text); after a
    conversation's last edit one row with a null ``edit`` and its ``report``. Rows are in order within
    a partition and a conversation is in one: :func:`digests` needs that.

    Turns are taken by number, nulls first, those of one number by role and text; rows equal in all stay
    neighbours and all but the first are duplicates. The first fault of a turn counts: blank (white
    space alone), duplicate (role and text of an earlier one), truncated (no ``.!?`` at the end). Blank
    and duplicate turns go. What is left reads, by the initials of the roles, as nothing or an optional
    system turn and pairs of user and assistant. Of the cheapest edits those come whose letters are
    least in ASCII. Null roles and texts are a blank; a null conversation is one like any other.
    ``gaps`` are the numbers missing between the least and the largest, ``illegal`` neighbours that may
    not follow each other. Other columns are not read; an empty table gives no rows.

    A conversation is one task's, which reads it as a sorted stream and holds the open edits alone.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    own = turns.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), blank(role).alias("role"), blank(text).alias("text"))
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    rows = _first_of_each(own).repartition("conv").sortWithinPartitions(*order)
    schema = EDITS.format(conv=own.schema["conv"].dataType.simpleString())
    kinds = pa.schema(
        [("place", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]
        + [("report", pa.struct([(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]))]
    )

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, before, kind = None, None, None

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            arrays = [pa.array(columns[0], kind), *(pa.array(c, t) for c, t in zip(columns[1:], kinds.types, strict=True))]
            return pa.RecordBatch.from_arrays(arrays, names=["conv", *kinds.names])

        for batch in batches:
            kind, rows = batch.schema.field(0).type, []
            for c, t, r, x, later in _values(batch):
                if now is None or now.conv != c:
                    rows += now.end() if now else []
                    now, before = _Conversation(c), None
                seen = later or before == (t, r, x)
                before = (t, r, x)
                rows += now.add(t, r, x, seen)
                if len(rows) >= 1_000:
                    yield out(rows)
                    rows = []
            if rows:
                yield out(rows)
        if now is not None:
            yield out(now.end())

    return rows.mapInArrow(repaired, schema)


def digests(edits: DataFrame) -> DataFrame:
    """``conv, audit, sha256, report`` of each conversation, read along :func:`edits` without a shuffle.

    ``audit`` is the letters of its edits, ``sha256`` that of ``role:text`` of what is left, joined by
    line feeds. A conversation's texts are never held together.
    """
    kind = edits.schema["conv"].dataType.simpleString()
    report = edits.schema["report"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, found, empty = [], hashlib.sha256(), True
        for batch in batches:
            rows = []
            for c, _, letter, _, role, text, last in _values(batch):
                if letter is None:
                    rows.append((c, "".join(letters), found.hexdigest(), last))
                    letters, found, empty = [], hashlib.sha256(), True
                    continue
                letters.append(letter)
                if letter != "D":
                    found.update(f"{'' if empty else chr(10)}{role}:{text}".encode())
                    empty = False
            if rows:
                columns = list(zip(*rows, strict=True))
                types = [batch.schema.field(0).type, pa.string(), pa.string(), batch.schema.field(6).type]
                arrays = [pa.array(x, t) for x, t in zip(columns, types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=["conv", "audit", "sha256", "report"])

    return edits.mapInArrow(run, f"conv {kind}, audit string, sha256 string, report {report}")


def damaged(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, turn, role, text`` with faults put in, by the CRC-32 of ``conv:turn`` modulo 20.

    0 drops a row, 1 empties its text, 2 takes its ``.!?`` out, 3 repeats it, 4 makes it the user's.
    Nulls are read as a blank, but for the columns ``conv`` and ``turn`` of the result.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    name = F.concat(blank(conv), F.lit(":"), blank(turn))
    rows = turns.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), blank(role).alias("role"), blank(text).alias("text"),
        (F.crc32(name.cast("binary")) % 20).cast("int").alias("kind"),
    )

    def changed(kind: int, value: Column, column: str) -> Column:
        return F.when(F.col("kind") == kind, value).otherwise(F.col(column))

    rows = rows.where("kind <> 0").withColumns(
        {
            "text": F.when(F.col("kind") == 1, "").otherwise(changed(2, F.translate("text", ".!?", ""), "text")),
            "role": changed(4, F.lit(USER), "role"),
            "copies": F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))),
        }
    )
    return rows.withColumn("copy", F.explode("copies")).select("conv", "turn", "role", "text")
