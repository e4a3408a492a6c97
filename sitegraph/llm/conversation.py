"""Conversation repair by a Viterbi pass with survivor coalescence.

A conversation's rows, in order of turn, are edited at least cost so that the
initials of the roles read ``(s?(ua)+)?``: keep a row, give it the role user or
assistant, delete it, or insert an empty row.  The automaton of that pattern has
four states, so a row leaves at most four survivors, the cheapest edits that end
in each state.  Their edits stand in one tree of backpointers; every node counts
its children and the survivors that stand on it.  What all survivors share is
final, leaves the tree at once and goes on to a digest or to output rows; only
the unresolved rest of a conversation is held.  A survivor that another one
beats whatever follows is dropped, so the rest stays short.

Of equally cheap edits the ASCII-least string of initials (D, I, K, R) wins, by the
candidates' complete strings from the last shared edit on.  Cut behind its last row, no
survivor's string is the beginning of another's, as all have used the same rows; so the
order of the strings of one row, and the few edits behind them, decide the order at the
next row, and a tie costs no walk through the tree however long it is unresolved.

Rows are spread by conversation and sorted by turn; a task streams through them.
The rows of one conversation pass one task because its digest and its string of
edits are one sequence each, but no task holds them.  Which rows repeat an earlier
one is decided before, by a partial aggregate on hashes of role and text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitegraph.llm.common import parallelism

KEEP, REROLE, DELETE, INSERT = "KRDI"
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED_COST = 3
BLANKS = " \t\n\x0b\x0c\r"
#: States: nothing yet, after the system row, after a user row, after an assistant row.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
#: What any state may cost more than another one at the end, whatever follows: a survivor in the
#: first state is beaten by one in the second that is cheaper by more than this.
SURPLUS = {(EMPTY, ASSISTANT): 4, (EMPTY, USER): 7, (SYSTEM, ASSISTANT): 0, (SYSTEM, USER): 3, (USER, ASSISTANT): 3, (ASSISTANT, USER): 3}
#: Rows between two looks for what all survivors share.
LOOK = 16


class _Node:
    """One edit; ``refs`` counts children and survivors that stand here."""
    __slots__ = ("above", "edit", "row", "refs")

    def __init__(self, above: _Node | None, edit: str, row):
        self.above, self.edit, self.row, self.refs = above, edit, row, 0
        if above is not None:
            above.refs += 1


def _release(node: _Node | None, root: _Node) -> None:
    """Takes one reference off ``node`` and frees what nothing stands on any more."""
    while node is not None:
        node.refs -= 1
        if node.refs or node is root:
            return
        node.above, node = None, node.above


class Repair:
    """The rows of one conversation, one by one; ``emit(edit, row, role, text)`` gets the final edits in order.

    ``row`` is what was fed (None for an inserted row); role and text are those after the edit.
    """

    def __init__(self, emit: Callable):
        self.emit, self.at = emit, EMPTY
        self.root = _Node(None, "", None)
        self.root.refs = 1
        #: state: cost, node, place of its string up to the last row among those of all survivors, inserts since
        self.live: dict[int, tuple[int, _Node, int, str]] = {EMPTY: (0, self.root, 0, "")}
        self.fed, self.look, self.held = 0, LOOK, 0
        self.live = self._inserted({EMPTY: (0, 0, "", self.root, "")}, None)

    def feed(self, role: str, text: str, faulty: bool, truncated: bool, row=None) -> None:
        """Next row; ``faulty`` rows must go."""
        initial, extra = role[:1], TRUNCATED_COST * truncated
        best: dict[int, tuple] = {}
        for state, (cost, node, place, tail) in self.live.items():
            def offer(to, more, edit, cost=cost, node=node, place=place, tail=tail):
                self._offer(best, to, (cost + more, place, tail + edit, node, edit))
            offer(state, COST[DELETE], DELETE)
            if faulty:
                continue
            to = ASSISTANT if state == USER else USER
            if initial == ("a" if state == USER else "u"):
                offer(to, extra, KEEP)
            else:
                offer(to, COST[REROLE] + extra, REROLE)
                if initial == "s" and state == EMPTY:
                    offer(SYSTEM, extra, KEEP)
        self.live = self._inserted(best, (role, text, row))
        self.fed += 1
        if self.fed >= self.look:
            self.look = self.fed + max(LOOK, self._coalesce())

    @staticmethod
    def _offer(best: dict, state: int, x: tuple) -> None:
        """x: cost, place and later edits (these three compare), node, edits to add to it."""
        if state not in best or x[:3] < best[state][:3]:
            best[state] = x

    def _inserted(self, best: dict, data) -> dict:
        """The survivors after a row and the rows inserted behind it."""
        for to, states in ((USER, (EMPTY, SYSTEM, ASSISTANT)), (ASSISTANT, (USER,))):
            for state in states:
                if state in best:
                    cost, place, later, node, edits = best[state]
                    self._offer(best, to, (cost + COST[INSERT], place, later + INSERT, node, edits + INSERT))
        for (state, other), d in SURPLUS.items():
            if state in best and other in best and best[state][0] > best[other][0] + d:
                del best[state]
        made, live = {}, {}
        row = 0 if data is None else 1  # edits that take the row
        behind = {state: x[4][row:] for state, x in best.items()}
        strings = {state: (x[1], x[2][:len(x[2]) - len(behind[state])]) for state, x in best.items()}
        places = {x: i for i, x in enumerate(sorted(set(strings.values())))}
        for state, (cost, _, _, node, edits) in best.items():
            for k, e in enumerate(edits):  # one node for each edit, shared by the states that have it
                key = (id(node), e)
                if key not in made:
                    made[key] = _Node(node, e, data if k < row else None)
                node = made[key]
            node.refs += 1
            live[state] = (cost, node, places[strings[state]], behind[state])
        for _, node, _, _ in self.live.values():
            _release(node, self.root)
        return live

    def _coalesce(self) -> int:
        """Emits what all survivors share; the number of edits that stay."""
        node = next(iter(self.live.values()))[1]
        chain = []
        while node is not self.root:
            chain.append(node)
            node = node.above
        self.held = max(self.held, len(chain))
        while chain and self.root.refs == 1:
            nxt = chain.pop()
            self._final(nxt)
            nxt.above, self.root = None, nxt
        return len(chain)

    def _final(self, node: _Node) -> None:
        role, text, row = node.row or ("", "", None)
        if node.edit in (REROLE, INSERT):
            role = "assistant" if self.at == USER else "user"
        if node.edit != DELETE:
            self.at = SYSTEM if self.at == EMPTY and role[:1] == "s" else ASSISTANT if self.at == USER else USER
        self.emit(node.edit, row, role, text)

    def finish(self) -> int:
        """Emits the rest; the least cost."""
        ends = [self.live[state] for state in (EMPTY, ASSISTANT) if state in self.live]
        cost, node, _, _ = min(ends, key=lambda x: (x[0], x[2], x[3]))
        chain = []
        while node is not self.root:
            chain.append(node)
            node = node.above
        for node in reversed(chain):
            self._final(node)
        return cost


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the faults that the contract plants by crc32 of ``conv_id:turn``.

    Null roles and texts become one space, as null ids and turns do in the hashed string.
    """
    c = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                         F.coalesce(F.col("turn").cast("string"), F.lit(" ")))) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    text = F.when(c == 1, "").when(c == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    role = F.when(c == 4, "user").otherwise(role)
    return conversations.where(c != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"),
                                              F.explode(F.array_repeat(F.lit(0), F.when(c == 3, 2).otherwise(1)))).drop("col")


def _flagged(rows: DataFrame, ids: DataFrame | None) -> DataFrame:
    """(conv_id, turn, role, text, blank, again, truncated, there), spread by conversation and sorted.

    ``again`` marks rows whose role and text stand at an earlier turn; the equal
    rows of one turn stand together.  A row with ``there`` false only names an id.
    """
    r = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    h = [F.xxhash64(F.lit(s), "role", F.lit("\n"), "text").alias(f"h{s}") for s in (1, 2)]
    firsts = (r.select("conv_id", *h, F.struct("turn").alias("t")).groupBy("conv_id", "h1", "h2")
              .agg(F.min("t").alias("first"), F.max("t").alias("last")).where("first < last")
              .select(F.col("conv_id").alias("id"), F.col("h1").alias("i1"), F.col("h2").alias("i2"), "first"))
    end = F.rtrim("text", F.lit(BLANKS))
    r = r.select("*", *h)
    r = r.join(firsts, r["conv_id"].eqNullSafe(firsts["id"]) & (r["h1"] == firsts["i1"]) & (r["h2"] == firsts["i2"]), "left")
    r = r.select("conv_id", "turn", "role", "text", (end == "").alias("blank"),
                 F.coalesce(F.struct("turn") > F.col("first"), F.lit(False)).alias("again"),
                 (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("truncated"), F.lit(True).alias("there"))
    if ids is not None:
        no = [F.lit(None).cast(f.dataType).alias(f.name) for f in r.schema.fields[1:-1]]
        r = r.union(ids.select("conv_id").distinct().select("conv_id", *no, F.lit(False)))
    return (r.repartition(parallelism(rows.sparkSession), "conv_id")
            .sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text"))


class _Conversation:
    """Counts over the rows of one conversation, and its repair."""

    def __init__(self, key, keep_rows: bool):
        self.key, self.counts, self.edits, self.rows = key, [0, 0, 0, 0], [], [] if keep_rows else None
        self.low = self.high = self.before = None
        self.turns, self.kept, self.digest = 0, 0, hashlib.sha256()
        self.seq = 0
        self.repair = Repair(self.take)

    def add(self, turn, role, text, blank, again, truncated) -> None:
        if self.before is not None:
            again = again or self.before == (turn, role, text)
            if self.before[1][:1] + role[:1] not in ("su", "ua", "au"):
                self.counts[3] += 1
        if turn is not None:
            if self.high != turn:
                self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        self.before = (turn, role, text)
        fault = 0 if blank else 1 if again else 2 if truncated else None
        if fault is not None:
            self.counts[fault] += 1
        self.repair.feed(role, text, fault in (0, 1), fault == 2, turn)

    def take(self, edit, turn, role, text) -> None:
        self.edits.append(edit)
        if self.rows is not None:
            self.rows.append((self.key, self.seq, edit, turn, role, text))
            self.seq += 1
        if edit != DELETE:
            self.digest.update(f"{chr(10) if self.kept else ''}{role}:{text}".encode())
            self.kept += 1

    def summary(self) -> tuple:
        cost = self.repair.finish()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.key, gaps, *self.counts, cost, "".join(self.edits), self.digest.hexdigest())


def _run(rows: DataFrame, ids: DataFrame | None, names: list[tuple[str, T.DataType]], keep_rows: bool) -> DataFrame:
    flagged = _flagged(rows, ids)
    key = flagged.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", key), *[T.StructField(n, t) for n, t in names]])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, arrow = None, None

        def table(out):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), arrow)], schema.fieldNames())

        def ended(c):
            row = c.summary()
            return c.rows if keep_rows else [row]
        for batch in batches:
            if arrow is None:
                arrow = [batch.schema.field("conv_id").type, *[_ARROW[t.typeName()] for _, t in names]]
            out = []
            for key, turn, role, text, blank, again, truncated, there in zip(*[batch.column(i).to_pylist() for i in range(8)]):
                if now is None or key != now.key:
                    if now is not None:
                        out += ended(now)
                    now = _Conversation(key, keep_rows)
                if there:
                    now.add(turn, role, text, blank, again, truncated)
                    if keep_rows and now.rows:
                        out += now.rows
                        now.rows.clear()
                        now.edits.clear()
            if out:
                yield table(out)
        if now is not None and (out := ended(now)):
            yield table(out)

    return flagged.mapInArrow(stream, schema)


_ARROW = {"long": pa.int64(), "string": pa.string()}


def repair_summary(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) per conversation.

    ``rows`` has conv_id, turn, role and text; ``ids`` names further conversations
    (conv_id) that get a row though they have none.  Rows are taken by turn, nulls
    first, those of one turn by role and text.  Null roles and texts count as one
    space; rows without an id are one conversation; repeated rows are duplicates;
    an empty table gives an empty one; other columns are ignored.
    """
    return _run(rows, ids, [(n, T.LongType()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
                + [("audit", T.StringType()), ("repaired_sha256", T.StringType())], False)


def repaired_rows(rows: DataFrame) -> DataFrame:
    """(conv_id, seq, edit, turn, role, text): every edit of every conversation in order, with the row after it.

    Rows with the edit D are those that go; inserted ones have no turn.  Edge
    cases as in ``repair_summary``.
    """
    return _run(rows, None, [("seq", T.LongType()), ("edit", T.StringType()), ("turn", T.LongType()), ("role", T.StringType()),
                             ("text", T.StringType())], True)
