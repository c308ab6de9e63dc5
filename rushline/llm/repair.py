"""Conversation structure repair by a Viterbi search whose survivors coalesce.

A conversation may be any sequence of rows; repaired ones read ``(s?(ua)+)?`` by
the initials of their roles. The cheapest edits are found by a search over four
states (nothing yet, after system, after user, after assistant). Paths live in a
tree of back pointers with reference counts: a path that no survivor uses is
freed at once, and as soon as all survivors share an ancestor, the edits up to it
are final and leave the tree. Memory holds what is still undecided, not the
conversation. Paths of equal cost are told apart by their complete undecided
letters; the order of these is carried from row to row, which gives the same
answer as reading them again.

Rows are dealt by ranges of (conversation, turn), so a conversation that holds a
third of all rows lies in many tasks. Of a conversation cut by such a range every
part is first searched from all four states; the small tables of costs and orders
that come out are chained to find where each part begins and ends, and then the
part is repaired by itself. A part's rows stream through the search.

Results for special cases. NULL roles and texts read as one space, which also
stands for a NULL conversation or turn in the key of the damage; a NULL conversation is a
conversation of its own. Rows of one turn stand by role, then text, so repeated
rows are adjacent (the later ones are duplicates). An empty or blank text is
deleted. A conversation without rows gives one row with no edits. Long texts are
read once and only held by the row that has them. An empty table gives no rows.
Other columns are not read, so their names may be anything.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rushline.llm.common import BATCH_ROWS, SPACES, ship_package, stored

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
ENDS = (START, ASSISTANT)
#: The state that a role leads to, by state; its keys are the roles allowed next.
NEXT = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER},
        USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
#: The only role that Rerole and Insert can give in a state.
FORCED = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: What it costs at most to go on from the state of the column as one could from
#: that of the row: a survivor dearer by more than this can never win.
EMULATED = {START: {ASSISTANT: 2, USER: 7, SYSTEM: 10}, SYSTEM: {ASSISTANT: 0, START: 0, USER: 5},
            USER: {ASSISTANT: 5, START: 5, SYSTEM: 5},
            ASSISTANT: {START: 0, USER: 5, SYSTEM: 10}}
#: Initials that may follow one another.
LEGAL = ("su", "ua", "au")
#: Final edits of a conversation that are written as one row.
PIECE = 1000


# --------------------------------------------------------------------------
# Rows and their faults
# --------------------------------------------------------------------------

def _blank(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damage(rows: DataFrame, modulus: int = 20) -> DataFrame:
    """Rows (conv_id, turn, role, text, alive) with faults put in by a hash of their key.

    Of the remainders, 0 drops a row (it stays, not alive, to name its conversation),
    1 empties its text, 2 takes its sentence ends, 3 repeats it, 4 makes its role user.
    """
    key = F.concat(_blank("conv_id"), F.lit(":"), _blank("turn"))
    fault = F.col("fault")
    return rows.select(
        "conv_id", "turn", _blank("role").alias("role"), _blank("text").alias("text"),
        F.pmod(F.crc32(key.cast("binary")), F.lit(modulus)).alias("fault"),
    ).select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        (fault != 0).alias("alive"),
        F.explode(F.sequence(F.lit(1), F.when(fault == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def with_faults(rows: DataFrame) -> DataFrame:
    """Each row's first fault: blank, duplicate, truncated, or '' (also of rows not alive)."""
    same = Window.partitionBy("conv_id", "alive", "role", "text").orderBy(
        F.col("turn").asc_nulls_first())
    last = F.right(F.rtrim(F.col("text"), F.lit(SPACES)), F.lit(1))
    return rows.withColumn("fault", F.when(~F.col("alive"), "").when(last == "", "blank").when(
        F.row_number().over(same) > 1, "duplicate").when(
        ~last.isin(".", "!", "?"), "truncated").otherwise(""))


# --------------------------------------------------------------------------
# The search
# --------------------------------------------------------------------------

class _Node:
    """One edit of a path; ``uses`` counts the nodes and survivors that go through it."""

    __slots__ = ("parent", "edit", "uses")

    def __init__(self, parent, edit):
        self.parent, self.edit, self.uses = parent, edit, 0
        if parent is not None:
            parent.uses += 1


class Search:
    """The survivors of one conversation, or of a part of it that begins in a state."""

    def __init__(self, state: int = START):
        self.root = _Node(None, None)
        self.root.uses = 1
        #: state -> (cost, order among the survivors' undecided letters, node)
        self.alive = {state: (0, 0, self.root)}

    def _with_inserts(self):
        """Survivors, and what they become by inserting rows: (cost, letters, parent, state, roles)."""
        for state, (cost, order, node) in self.alive.items():
            roles: tuple = ()
            while True:
                yield cost + INSERT * len(roles), (order, "I" * len(roles)), node, state, roles
                if len(roles) == 2:  # a third insert only repeats the first
                    break
                roles += (FORCED[state],)
                state = NEXT[state][roles[-1][0]]

    def _survive(self, candidates) -> None:
        best: dict[int, tuple] = {}
        for c in candidates:
            if c[2] not in best or c[:2] < best[c[2]][:2]:
                best[c[2]] = c
        kept = [c for s, c in best.items() if not any(
            c[0] > best[t][0] + more for t, more in EMULATED[s].items() if t in best)]
        old = [node for *_, node in self.alive.values()]
        self.alive = {}
        for order, (cost, _, state, parent, edits) in enumerate(sorted(kept, key=lambda c: c[1])):
            node = parent
            for edit in edits:
                node = _Node(node, edit)
            node.uses += 1
            self.alive[state] = (cost, order, node)
        for node in old:
            while node is not None:
                node.uses -= 1
                if node.uses:
                    break
                node = node.parent

    def feed(self, initial: str, fault: str, role: str, text: str) -> None:
        """The next row; an edit is (letter, role or None, text)."""
        candidates = []
        for cost, (order, letters), node, state, roles in self._with_inserts():
            inserts = [("I", r, "") for r in roles]

            def add(letter, more, to, edit):
                candidates.append((cost + more, (order, letters + letter), to, node, [*inserts, edit]))

            add("D", DELETE, state, ("D", None, ""))
            if fault in ("blank", "duplicate"):
                continue
            late = TRUNCATED if fault == "truncated" else 0
            if initial in NEXT[state]:
                add("K", KEEP + late, NEXT[state][initial], ("K", role, text))
            forced = FORCED[state]
            add("R", REROLE + late, NEXT[state][forced[0]], ("R", forced, text))
        self._survive(candidates)

    def decided(self) -> list[tuple]:
        """Edits that all survivors share and that were not returned before."""
        if self.root.uses > 1:
            return []
        (*_, node) = next(iter(self.alive.values()))
        path = []
        while node is not self.root:
            path.append(node)
            node = node.parent
        edits = []
        while path:
            self.root = path.pop()
            edits.append(self.root.edit)
            if self.root.uses > 1:
                break
        self.root.parent = None
        return edits

    def close(self, state: int | None = None) -> int:
        """Leave only the best end: of the whole conversation, or of a part that must end
        in ``state``. Returns its cost; all edits are decided then."""
        if state is None:
            best = min(((cost, letters, s, node, [("I", r, "") for r in roles])
                        for cost, letters, node, s, roles in self._with_inserts() if s in ENDS),
                       key=lambda c: c[:2])
        else:
            cost, order, node = self.alive[state]
            best = (cost, (order, ""), state, node, [])
        self._survive([best])
        return best[0]


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple]:
    """Runs of rows that are equal in the first ``keys`` columns: (key, iterator of the rest)."""
    rows = (row for batch in batches
            for row in zip(*(column.to_pylist() for column in batch.columns)))
    for key, run in groupby(rows, key=lambda row: row[:keys]):
        yield key, (row[keys:] for row in run)


def _search_parts(batches):
    """Tables of parts: costs and orders of every end, by the state a part begins in."""
    for (conv, segment), rows in _groups(batches, 2):
        searches = [Search(state) for state in STATES]
        last = ""
        for role, alive, fault in rows:
            if alive:
                last = role[:1]
                for search in searches:
                    search.feed(role[:1], fault, role, "")
                    search.decided()
        found = [[search.alive.get(end, (-1, -1))[:2] for end in STATES] for search in searches]
        yield (conv, segment, [c for row in found for c, _ in row],
               [o for row in found for _, o in row], last)


def _chain(batches):
    """The states each part of a conversation begins and ends in."""
    for (conv,), rows in _groups(batches, 1):
        parts = list(rows)  # at most one part a task of the sort
        survivors = {START: (0, 0)}
        steps = []
        for _, costs, orders, *_ in parts:
            best: dict[int, tuple] = {}
            for begin, (cost, order) in survivors.items():
                for end in STATES:
                    more = costs[4 * begin + end]
                    found = (cost + more, (order, orders[4 * begin + end]), begin)
                    if more >= 0 and (end not in best or found[:2] < best[end][:2]):
                        best[end] = found
            ranks = sorted(best, key=lambda end: best[end][1])
            survivors = {end: (best[end][0], ranks.index(end)) for end in best}
            steps.append(best)
        # where the whole conversation ends, as Search.close() finds it
        tail = Search()
        tail.alive = {s: (cost, order, tail.root) for s, (cost, order) in survivors.items()}
        order = min(c[:2] for c in tail._with_inserts() if c[3] in ENDS)[1][0]
        (end,) = (s for s in survivors if survivors[s][1] == order)
        borders = [end]
        for best in reversed(steps):
            borders.append(best[borders[-1]][2])
        borders.reverse()
        before = ""
        for i, (segment, _, _, last) in enumerate(parts):
            ends = None if i == len(parts) - 1 else borders[i + 1]
            yield conv, segment, borders[i], ends, before
            before = last or before


def _repair_parts(batches):
    """Final edits of every part, PIECE or so of them a row."""
    for (conv, segment), rows in _groups(batches, 2):
        search, edits, piece, illegal, spent, read = None, [], 0, 0, 0, 0
        for begin, end, before, role, text, alive, fault in rows:
            if search is None:
                search, last = Search(begin), before
            if not alive:
                continue
            illegal += last != "" and last + role[:1] not in LEGAL
            last = role[:1]
            search.feed(last, fault, role, text)
            read += 1
            if read % 16 == 0:
                edits += search.decided()
            if len(edits) >= PIECE:
                yield _piece(conv, segment, piece, edits, 0, illegal)
                edits, piece, illegal = [], piece + 1, 0
        spent = search.close(end)
        edits += search.decided()
        yield _piece(conv, segment, piece, edits, spent, illegal)


def _piece(conv, segment, piece, edits, cost, illegal) -> tuple:
    return (conv, segment, piece, "".join(letter for letter, *_ in edits),
            [None if role is None else f"{role}:{text}" for _, role, text in edits], cost, illegal)


def _through(df: DataFrame, step, schema: T.StructType) -> DataFrame:
    """``step`` over the rows of every task, written back in batches."""
    arrow = to_arrow_schema(schema)

    def run(batches):
        rows = step(batches)
        while held := list(islice(rows, BATCH_ROWS)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, f.type) for column, f in zip(zip(*held), arrow)], schema=arrow)

    return df.mapInArrow(run, schema)


# --------------------------------------------------------------------------
# The operator
# --------------------------------------------------------------------------

def sorted_parts(rows: DataFrame, tasks: int | None = None) -> DataFrame:
    """Rows in the order of their conversations, written once: ``segment`` is the task of the
    sort that held a row, ``place`` its place there."""
    keys = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text"]
    dealt = rows.repartitionByRange(tasks, *keys) if tasks else rows.repartitionByRange(*keys)
    return stored(dealt.sortWithinPartitions(*keys).withColumns(
        {"segment": F.spark_partition_id(), "place": F.monotonically_increasing_id()}),
        "conversation_parts")


def repair(parts: DataFrame) -> DataFrame:
    """The cheapest edits of every conversation of ``sorted_parts(with_faults(...))``.

    Columns conv_id, segment, piece (their order is that of the conversation), audit
    (the letters of the edits: Keep, Rerole, Delete, Insert), turns (``role:text`` by
    edit, NULL where deleted), cost and illegal (to be summed).
    """
    spark = parts.sparkSession
    ship_package(spark)
    conv = parts.schema["conv_id"]

    def schema(rest: str) -> T.StructType:
        return T.StructType([T.StructField("conv_id", conv.dataType),
                             *T._parse_datatype_string(rest).fields])

    # conversations that lie in several tasks of the sort: at most one a border
    cut = parts.groupBy("conv_id").agg(F.min("segment").alias("lo"), F.max("segment").alias("hi")
                                       ).where("lo < hi").select(F.col("conv_id").alias("cut_id"))
    pieces = parts.join(cut, F.col("conv_id").eqNullSafe(F.col("cut_id")), "left_semi")
    tables = _through(
        pieces.repartition("segment").sortWithinPartitions("segment", "place").select(
            "conv_id", "segment", "role", "alive", "fault"),
        _search_parts, schema("segment int, costs array<int>, orders array<int>, last string"))
    borders = _through(
        tables.repartition("conv_id").sortWithinPartitions(
            F.col("conv_id").asc_nulls_first(), "segment"),
        _chain, schema("segment int, begin int, end int, before string"))
    borders = stored(borders, "conversation_borders").withColumnsRenamed(
        {"conv_id": "border_id", "segment": "border_segment"})
    known = parts.join(
        borders, (F.col("segment") == F.col("border_segment"))
        & F.col("conv_id").eqNullSafe(F.col("border_id")), "left")
    return _through(
        known.repartition("segment").sortWithinPartitions("segment", "place").select(
            "conv_id", "segment", F.coalesce("begin", F.lit(START)).alias("begin"), "end",
            F.coalesce("before", F.lit("")).alias("before"), "role", "text", "alive", "fault"),
        _repair_parts, schema("segment int, piece int, audit string, turns array<string>, "
                              "cost long, illegal long"))


def fault_counts(parts: DataFrame) -> DataFrame:
    """Per conversation: gaps among its turns, and rows by first fault."""
    turn = F.when(F.col("alive"), F.col("turn"))

    def rows_with(fault: str) -> Column:
        return F.count(F.when(F.col("fault") == fault, 1)).alias(fault)

    # distinct turns in two steps: first within (conversation, turn)
    by_turn = parts.groupBy("conv_id", turn.alias("turn")).agg(
        *[rows_with(f) for f in ("blank", "duplicate", "truncated")])
    return by_turn.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long")
        .alias("gaps"), *[F.sum(f).alias(f) for f in ("blank", "duplicate", "truncated")])


def digest(parts: DataFrame) -> DataFrame:
    """One row per conversation: counts of faults, the audit and a hash of what it became."""
    edits = repair(parts).groupBy("conv_id").agg(
        F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"),
        F.array_sort(F.collect_list(F.struct("segment", "piece", "audit", "turns"))).alias("p"))
    became = F.array_join(F.flatten("p.turns"), "\n")
    edits = edits.select(F.col("conv_id").alias("edited_id"), "cost", "illegal",
                         F.array_join("p.audit", "").alias("audit"),
                         F.sha2(became, 256).alias("repaired_sha256"))
    return fault_counts(parts).join(
        edits, F.col("conv_id").eqNullSafe(F.col("edited_id"))).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        "repaired_sha256")
