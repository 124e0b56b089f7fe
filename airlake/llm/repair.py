"""Cheapest repair of a conversation's structure, with an audit of what was done.

A conversation is repaired by one letter per edit: ``K`` keeps a turn, ``R`` gives it the
role that may stand there, ``D`` deletes it, ``I`` inserts an empty turn. The roles that
remain must read ``(s?(ua)+)?``, which four states follow. The cheapest edits are found
turn by turn, and among equally cheap ones those whose letters come first.

Audits are persistent: an audit is a node with one more letter than its parent, so all states
share their prefixes. A node knows its ancestors at powers of two and a rolling hash of
its letters; two audits are compared by lifting both to the last place where their hashes
agree. That the letters before it do agree is verified, so a collision changes nothing.

Conversations of any length are cut into segments of bounded length. A segment is solved for
every state it may begin in, each to every state it may end in, and small rows of costs and
of how these audits compare are joined along the conversation (``_route``): equal costs
over the same turns mean that neither audit begins with the other, so what comes first stays
first whatever follows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import groupby, islice, zip_longest
from operator import and_
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from airlake.operators.windows import number_within
from airlake.scratch import keep

#: Turns of a segment.
SEGMENT = 4096
#: What edits cost, and what an undeleted truncated turn adds.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Pairs of role initials that may follow each other.
LEGAL = ["su", "ua", "au"]

#: States: nothing yet, after s, after u, after a. Where a state gets with an initial, and with the only role that may be given.
BEGIN, SYSTEM, USER, ASSISTANT = range(4)
AFTER = {"s": {BEGIN: SYSTEM}, "u": {BEGIN: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
GIVEN = [USER, USER, ASSISTANT, USER]
GIVEN_ROLE = ["user", "user", "assistant", "user"]
ENDS = (BEGIN, ASSISTANT)
NEVER = 1 << 60

#: How two audits over the same turns compare: they part (before or after), or one is the other and so many inserts.
BEFORE, BEHIND, MOST_INSERTS = -8, 8, 4
SHIFTS = 2 * MOST_INSERTS + 1

SPACE = " \t\n\v\f\r"
BATCH = 4096
SOLVED = (
    "costs ARRAY<BIGINT>, relations BINARY, audits ARRAY<STRING>, blank BIGINT, duplicate BIGINT, truncated BIGINT, "
    "pairs BIGINT, first STRING, last STRING"
)
ROUTE = "segment BIGINT, start BIGINT, end BIGINT, cost BIGINT, illegal BIGINT"
LETTERS = "position BIGINT, letters STRING, roles ARRAY<STRING>"

MODULUS, BASE = (1 << 61) - 1, 1_000_003


class Audits:
    """Strings of letters that share their prefixes."""

    def __init__(self, modulus: int = MODULUS):
        self.modulus = modulus
        self.letters, self.depths, self.hashes = [""], [0], [0]
        #: Of each node its ancestors 1, 2, 4, … above.
        self.ancestors: list[list[int]] = [[]]

    def extend(self, node: int, letter: str) -> int:
        above, k = [node], 0
        while k < len(self.ancestors[above[k]]):
            above.append(self.ancestors[above[k]][k])
            k += 1
        self.letters.append(letter)
        self.depths.append(self.depths[node] + 1)
        self.hashes.append((self.hashes[node] * BASE + ord(letter)) % self.modulus)
        self.ancestors.append(above)
        return len(self.letters) - 1

    def text(self, node: int) -> str:
        letters = []
        while node:
            letters.append(self.letters[node])
            node = self.ancestors[node][0]
        return "".join(reversed(letters))

    def _lifted(self, node: int, depth: int) -> int:
        over = self.depths[node] - depth
        while over:
            k = over.bit_length() - 1
            node = self.ancestors[node][k]
            over -= 1 << k
        return node

    def _alike(self, a: int, b: int) -> bool:
        """Whether two audits of one length have the same letters, letter by letter up to where they share nodes."""
        while a != b:
            if self.letters[a] != self.letters[b]:
                return False
            a, b = self.ancestors[a][0], self.ancestors[b][0]
        return True

    def before(self, a: int, b: int) -> bool:
        """Whether audit ``a`` comes before ``b``; a beginning of another comes before it."""
        depth = min(self.depths[a], self.depths[b])
        x, y = self._lifted(a, depth), self._lifted(b, depth)
        if self.hashes[x] == self.hashes[y]:
            if self._alike(x, y):
                return self.depths[a] < self.depths[b]
            return self.text(a) < self.text(b)
        for k in reversed(range(len(self.ancestors[x]))):
            if k < len(self.ancestors[x]) and self.hashes[self.ancestors[x][k]] != self.hashes[self.ancestors[y][k]]:
                x, y = self.ancestors[x][k], self.ancestors[y][k]
        if self._alike(self.ancestors[x][0], self.ancestors[y][0]):
            return self.letters[x] < self.letters[y]
        return self.text(a) < self.text(b)


def solve(turns: list[tuple[str, bool, bool]], start: int, modulus: int = MODULUS) -> list[tuple[int, str] | None]:
    """The cheapest audit from a state to each state.

    Turns are (role initial, whether it must go, whether it is truncated).
    """
    audits = Audits(modulus)
    costs, nodes = [NEVER] * 4, [0] * 4
    costs[start] = 0
    _insert(audits, costs, nodes)
    for initial, must_go, truncated in turns:
        # Per state reached: cost, node before, letter.
        best = [(cost + DELETE, node, "D") for cost, node in zip(costs, nodes)]
        if not must_go:
            kept, more = AFTER.get(initial, {}), TRUNCATED if truncated else 0
            for state in range(4):
                if costs[state] == NEVER:
                    continue
                to = kept.get(state) if initial else state
                if to is not None:
                    _offer(audits, best, to, (costs[state] + more, nodes[state], "K"))
                if to != GIVEN[state]:
                    _offer(audits, best, GIVEN[state], (costs[state] + REROLE + more, nodes[state], "R"))
        costs = [min(cost, NEVER) for cost, _, _ in best]
        nodes = [audits.extend(node, letter) if cost < NEVER else 0 for cost, node, letter in best]
        _insert(audits, costs, nodes)
    return [(cost, audits.text(node)) if cost < NEVER else None for cost, node in zip(costs, nodes)]


def _offer(audits: Audits, best: list, state: int, new: tuple[int, int, str]) -> None:
    old = best[state]
    if new[0] < old[0]:
        best[state] = new
    elif new[0] == old[0]:
        # Equal costs over the same turns: the letters differ within both.
        if new[1] == old[1]:
            first = new[2] < old[2]
        else:
            first = audits.before(audits.extend(*new[1:]), audits.extend(*old[1:]))
        if first:
            best[state] = new


def _insert(audits: Audits, costs: list[int], nodes: list[int]) -> None:
    """Reach states by inserted turns; cheaper states are final before dearer ones."""
    for state in sorted(range(4), key=costs.__getitem__):
        to, cost = GIVEN[state], costs[state] + INSERT
        if cost <= costs[to] and cost < NEVER:
            node = audits.extend(nodes[state], "I")
            if cost < costs[to] or audits.before(node, nodes[to]):
                costs[to], nodes[to] = cost, node


def relation(a: str, b: str) -> int:
    """How two audits over the same turns compare."""
    if a.startswith(b) or b.startswith(a):
        return len(a) - len(b)
    return BEFORE if a < b else BEHIND


def relations(audits: list[str]) -> bytes:
    """Every two audits compared, where one of them follows up to so many inserts that the other lacks."""
    out = bytearray()
    for a in audits:
        for b in audits:
            for more in range(-MOST_INSERTS, MOST_INSERTS + 1):
                found = relation("I" * max(more, 0) + a, "I" * max(-more, 0) + b)
                out.append(max(BEFORE, min(BEHIND, found)) & 0xFF)
    return bytes(out)


class _Along:
    """The cheapest audits of a conversation from its beginning to each state, segment after segment."""

    def __init__(self):
        self.costs = [0, NEVER, NEVER, NEVER]
        self.compared = [[0] * 4 for _ in range(4)]
        self.came_from = bytearray()

    def add(self, costs: list[int | None], table: bytes) -> None:
        """``costs`` by state at the beginning, then at the end."""
        n = len(costs)

        def compare(i: int, a: int, j: int, b: int) -> int:
            known = self.compared[i][j]
            if not -MOST_INSERTS <= known <= MOST_INSERTS:
                return known
            code = table[((4 * i + a) * n + 4 * j + b) * SHIFTS + known + MOST_INSERTS]
            return code - 256 if code > 127 else code

        total, origin = [NEVER] * 4, [0] * 4
        for to in range(4):
            for i in range(n // 4):
                own = costs[4 * i + to]
                if own is None or self.costs[i] == NEVER:
                    continue
                cost = self.costs[i] + own
                if cost < total[to] or cost == total[to] and compare(i, to, origin[to], to) < 0:
                    total[to], origin[to] = cost, i
        reached = [s for s in range(4) if total[s] < NEVER]
        compared = [[0] * 4 for _ in range(4)]
        for a in reached:
            for b in reached:
                compared[a][b] = compare(origin[a], a, origin[b], b)
        self.costs, self.compared = total, compared
        self.came_from.extend(origin)

    def finish(self) -> tuple[int, list[tuple[int, int]]]:
        """The whole cost, and each segment's states at its two ends."""
        end = min(ENDS, key=lambda s: self.costs[s])
        a, b = ENDS
        if self.costs[a] == self.costs[b] < NEVER and len(self.came_from):
            end = a if self.compared[a][b] < 0 else b
        cost, route = self.costs[end], []
        for at in range(len(self.came_from) - 4, -1, -4):
            start = self.came_from[at + end]
            route.append((start, end))
            end = start
        return cost, route[::-1]


def _streamed(df: DataFrame, keys: list[str], order: list[str], function: Callable, fields: str) -> DataFrame:
    """``function(key, rows)`` over every group of ``keys`` in ``order``; it yields ``fields``, the key is put before.

    Rows of a group pass one after the other, so its size is no matter of memory.
    """
    own = StructType.fromDDL(fields)
    out, width = StructType([df.schema[k] for k in keys] + own.fields), len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = []

        def rows() -> Iterator[tuple]:
            for batch in batches:
                types[:] = [field.type for field in batch.schema][:width]
                yield from zip(*(column.to_pylist() for column in batch.columns))

        def results() -> Iterator[tuple]:
            for key, group in groupby(rows(), key=lambda row: row[:width]):
                for found in function(key, (row[width:] for row in group)):
                    yield (*key, *found)

        found = results()
        while held := list(islice(found, BATCH)):
            columns = [pa.array(c, t) for c, t in zip_longest(zip(*held), types)]
            yield pa.RecordBatch.from_arrays(columns, names=out.names)

    # A number that is asked for is kept: few small rows may still be much work.
    width_of_shuffles = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartition(width_of_shuffles, *keys).sortWithinPartitions(*keys, *order)
    return placed.mapInArrow(run, out)


def joined(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join on keys of which null equals null."""
    renamed = right.select(*(F.col(c).alias(f"_right_{c}") if c in keys else F.col(c) for c in right.columns))
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys))
    return left.join(renamed, same, how).drop(*(f"_right_{k}" for k in keys))


def fault_of(text: Column, repeated: Column) -> Column:
    """The first fault of a turn: blank, duplicate, truncated or null."""
    end = F.substring(F.rtrim(text, F.lit(SPACE)), -1, 1)
    return (
        F.when(end == "", "blank").when(repeated, "duplicate").when(~end.isin(".", "!", "?"), "truncated")
    )


def _solve_segment(key: tuple, rows: Iterator[tuple]) -> Iterator[tuple]:
    turns, faults, pairs, initials = [], {"blank": 0, "duplicate": 0, "truncated": 0}, 0, []
    for _, initial, fault in rows:
        if initials:
            pairs += initials[-1] + initial not in LEGAL
        initials.append(initial)
        turns.append((initial, fault in ("blank", "duplicate"), fault == "truncated"))
        if fault:
            faults[fault] += 1
    starts = range(4) if key[1] else [BEGIN]
    found = [entry for start in starts for entry in solve(turns, start)]
    audits = [entry[1] if entry else "" for entry in found]
    yield [entry and entry[0] for entry in found], relations(audits), audits, *faults.values(), pairs, initials[0], initials[-1]


def _route(key: tuple, rows: Iterator[tuple]) -> Iterator[tuple]:
    along, pairs, last, first_segment = _Along(), 0, None, None
    for segment, costs, table, inside, first, end in rows:
        first_segment = segment if first_segment is None else first_segment
        pairs += inside + (last is not None and last + first not in LEGAL)
        last = end
        along.add(costs, table)
    cost, route = along.finish()
    for i, (start, end) in enumerate(route):
        yield first_segment + i, start, end, cost, pairs


def _letters(key: tuple, rows: Iterator[tuple]) -> Iterator[tuple]:
    """What an audit does with each turn: letters and, for inserted and given ones, roles."""
    for first, initials, audit, state in rows:
        at, letters, roles = 0, "", []
        for letter in audit:
            if letter != "I" and letters.strip("I"):
                yield first + at, letters, roles
                at, letters, roles = at + 1, "", []
            letters += letter
            roles.append(GIVEN_ROLE[state] if letter in "IR" else None)
            if letter in "IR":
                state = GIVEN[state]
            elif letter == "K" and initials[at]:
                state = AFTER[initials[at]][state]
        if letters:
            yield first + at, letters, roles


class Repaired(NamedTuple):
    """What ``repair`` finds: an edit per row, and a row per conversation."""

    edits: DataFrame
    conversations: DataFrame


def repair(
    turns: DataFrame, conversation_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role",
    text_column: str = "text", segment: int = SEGMENT,
) -> Repaired:
    """The cheapest edits that give every conversation roles ``(s?(ua)+)?`` by their initials.

    ``edits``: ``conversation``, ``position`` (of the turn, from 0), ``part`` (several edits
    may belong to one turn, inserted ones come with their neighbour), ``edit``, ``turn``, ``role``
    and ``text`` as repaired. ``conversations``: ``conversation``, ``blank``, ``duplicate`` and
    ``truncated`` turns (the first fault of each counts), ``illegal`` pairs of neighbours before the repair,
    ``cost``, ``audit`` (the edits in order; of equally cheap ones the first in ASCII).

    Blank turns and those whose role and text were seen earlier are deleted. Null turns come first;
    turns of one number are ordered by role, then by the SHA-256 of their texts. Null roles and texts are one
    space; an empty role has no initial, so keeping it changes nothing. Rows of a null
    conversation are one conversation. Other columns are not read. No rows give no rows. Texts are whole,
    conversations may be of any length: no task holds more than a segment's turns.
    """

    def text_or_space(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" "))

    rows = turns.select(
        F.col(f"`{conversation_column}`").alias("conversation"), F.col(f"`{turn_column}`").alias("turn"),
        text_or_space(role_column).alias("role"), text_or_space(text_column).alias("text"),
    ).withColumn("digest", F.sha2(F.col("text").cast("binary"), 256)).withColumn("copy", F.monotonically_increasing_id())
    order = [F.asc_nulls_first("turn"), F.asc("role"), F.asc("digest"), F.asc("copy")]
    numbered = number_within(rows, ["conversation"], order, "position").drop("copy")
    numbered = numbered.withColumn("position", F.col("position") - 1)
    numbered = keep(numbered.withColumn("segment", F.expr(f"position div {int(segment)}")), "turns")

    # Where each role and text of a conversation is seen first.
    firsts = numbered.groupBy("conversation", "role", "digest").agg(F.min("position").alias("position"))
    firsts = firsts.select("conversation", "position", F.lit(True).alias("is_first"))
    flagged = joined(numbered.select("conversation", "segment", "position", "role", "text"), firsts, ["conversation", "position"], "left")
    flagged = flagged.select(
        "conversation", "segment", "position", F.substring("role", 1, 1).alias("initial"),
        fault_of(F.col("text"), F.col("is_first").isNull()).alias("fault"),
    )
    of_segment = ["conversation", "segment"]
    solved = keep(_streamed(flagged, of_segment, ["position"], _solve_segment, SOLVED), "segments")
    route = _streamed(
        solved.select("conversation", "segment", "costs", "relations", "pairs", "first", "last"),
        ["conversation"], ["segment"], _route, ROUTE,
    )
    # A segment's audits are those from each state it may begin in (only one for the first) to each it may end in.
    which = F.when(F.col("segment") == 0, F.col("end")).otherwise(4 * F.col("start") + F.col("end"))
    chosen = joined(solved.select(*of_segment, "audits", "blank", "duplicate", "truncated"), route, of_segment)
    chosen = keep(chosen.withColumn("audit", F.element_at("audits", which.cast("int") + 1)).drop("audits"), "audits")
    pieces = F.sort_array(F.collect_list(F.struct("segment", "audit")))
    conversations = chosen.groupBy("conversation").agg(
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")), F.max("illegal").alias("illegal"),
        F.max("cost").alias("cost"), F.array_join(pieces["audit"], "").alias("audit"),
    )

    initial = F.sort_array(F.collect_list(F.struct("position", F.substring("role", 1, 1).alias("initial"))))
    initials = numbered.groupBy(*of_segment).agg(F.min("position").alias("first"), initial["initial"].alias("initials"))
    applied = joined(initials, chosen.select(*of_segment, "audit", "start"), of_segment)
    letters = _each(applied.select("conversation", "first", "initials", "audit", "start"), ["conversation"], _letters, LETTERS)
    given = joined(numbered.drop("segment", "digest"), letters, ["conversation", "position"])
    edits = given.select(*given.columns, F.posexplode(F.split("letters", "(?<=.)(?=.)")).alias("part", "edit"))
    role = F.coalesce(F.get("roles", F.col("part")), F.col("role"))
    text = F.when(F.col("edit") == "I", "").otherwise(F.col("text"))
    return Repaired(
        edits.select("conversation", "position", "part", "edit", "turn", role.alias("role"), text.alias("text")), conversations
    )


def _each(df: DataFrame, keys: list[str], function: Callable, fields: str) -> DataFrame:
    """``function`` over rows as they are, without a shuffle."""
    own = StructType.fromDDL(fields)
    out, width = StructType([df.schema[k] for k in keys] + own.fields), len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(column.to_pylist() for column in batch.columns))
            found = [(*row[:width], *f) for row in rows for f in function(row[:width], iter([row[width:]]))]
            if found:
                types = [field.type for field in batch.schema][:width]
                columns = [pa.array(c, t) for c, t in zip_longest(zip(*found), types)]
                yield pa.RecordBatch.from_arrays(columns, names=out.names)

    return df.mapInArrow(run, out)


def _hashed(key: tuple, rows: Iterator[tuple]) -> Iterator[tuple]:
    digest = hashlib.sha256()
    for n, (_, _, role, text) in enumerate(rows):
        digest.update(("\n" * (n > 0) + f"{role}:{text}").encode())
    yield (digest.hexdigest(),)


def digests(edits: DataFrame) -> DataFrame:
    """``conversation`` and ``sha256`` of what is left of it, its ``role:text`` joined by line breaks."""
    left = edits.where("edit <> 'D'").select("conversation", "position", "part", "role", "text")
    return _streamed(left, ["conversation"], ["position", "part"], _hashed, "sha256 STRING")


def damage(turns: DataFrame) -> DataFrame:
    """Faults for ``conv_id, turn, role, text``, chosen by a hash of conversation and turn.

    Of twenty values 0 drops a turn, 1 empties its text, 2 removes the text's ends of sentences,
    3 repeats the turn and 4 makes it the user's. Null roles and texts become one space.
    """
    space = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    kind = F.crc32(F.concat(space["conv_id"], F.lit(":"), space["turn"]).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(space["text"], ".!?", "")).otherwise(space["text"])
    role = F.when(kind == 4, "user").otherwise(space["role"])
    times = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    damaged = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("times"))
    each = F.explode(F.array_repeat(F.lit(0), F.col("times"))).alias("_")
    return damaged.select("conv_id", "turn", "role", "text", each).drop("_")
