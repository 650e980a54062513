"""Repair of conversations whose turns break the role grammar, by generalised LR parsing with edits.

Rows are marked with their first fault (blank, duplicate, truncated) by expressions and one join with the repeated
(role, text) pairs of a conversation. Then each conversation passes once, in order, through a parser: tables are built from
GRAMMAR, and the open stacks form a graph-structured stack, whose tails are shared. Every row may be kept, get another
role or be deleted, and rows may be inserted anywhere; stacks with the same top are merged, and the one of the least
(cost, audit) stays. A stack whose cost exceeds another's by more than SLACK can't win and goes.

Repair is the digest of all repaired lines in order, which only one process can compute; so a conversation is one sorted
stream through one task, whatever its length. It is never gathered: a task holds a batch of rows, one hash state per open
stack, and one byte per row and stack for the audit, which is a column of the result. What can be spread is: damage,
faults and the search for repeated texts are spread over all tasks, however long a conversation.

Rows are taken by turn, NULL first, equal turns by role and text. A NULL role or text counts as one space: an initial that
the grammar doesn't have, and a blank text. An empty role has no initial and can't be kept either. Repeated rows are
duplicates. A NULL id is a conversation like any other. Gaps beyond a bigint are NULL. An empty table gives no rows; columns
beside the four named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm.common import load, short_batches, stage

# Roles by initial; capitals are the grammar's own symbols. A conversation without rows is fine, too.
GRAMMAR = (("C", "T"), ("C", "sT"), ("T", "P"), ("T", "TP"), ("P", "ua"))
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
# Two inserts lead from any stack to the end of a pair, one starts the next pair, and a system row that another stack keeps
# is deleted: so no stack's rest costs more than another's by over two inserts, one insert and one deletion.
SLACK = 3 * INSERT + DELETE
CHUNK = 4096  # edits of an audit that are put aside together
SPACES = " \t\n\x0b\x0c\r"
# Edits in the order of their initials; I and J insert, R and S rerole, each to assistant and user.
CODES = {("I", "a"): "I", ("I", "u"): "J", ("R", "a"): "R", ("R", "u"): "S"}
INITIALS = str.maketrans("JS", "IR")


def _tables(grammar: tuple[tuple[str, str], ...]) -> tuple[dict, dict]:
    """SLR actions by (state, terminal) and gotos by (state, symbol); the first rule's head is the start symbol."""
    start, heads = grammar[0][0], {h for h, _ in grammar}
    first = {h: set() for h in heads}
    follow = {h: set() for h in heads} | {start: {"$"}}
    for _ in grammar * 2:
        for head, body in grammar:
            first[head] |= first[body[0]] if body[0] in heads else {body[0]}
            for x, after in zip(body, [*body[1:], None]):
                if x in heads:
                    follow[x] |= follow[head] if after is None else first[after] if after in heads else {after}

    def closed(items: set) -> frozenset:
        found, new = set(items), set(items)
        while new:
            wanted = {grammar[r][1][d] for r, d in new if d < len(grammar[r][1])}
            new = {(r, 0) for r, (head, _) in enumerate(grammar) if head in wanted} - found
            found |= new
        return frozenset(found)

    states = [closed({(r, 0) for r, (head, _) in enumerate(grammar) if head == start})]
    actions, gotos = {}, {}
    for at, state in enumerate(states):
        for symbol in sorted({grammar[r][1][d] for r, d in state if d < len(grammar[r][1])}):
            to = closed({(r, d + 1) for r, d in state if grammar[r][1][d:d + 1] == symbol})
            if to not in states:
                states.append(to)
            gotos[at, symbol] = states.index(to)
        actions |= {(at, x): ("shift", to) for (here, x), to in gotos.items() if here == at and x not in heads}
        for rule in [r for r, d in state if d == len(grammar[r][1])]:
            head, body = grammar[rule]
            for terminal in follow[head]:
                if (at, terminal) in actions:
                    raise ValueError(f"the grammar isn't SLR: {head} -> {body} before {terminal}")
                actions[at, terminal] = ("accept", 0) if head == start else ("reduce", rule)
    return actions, gotos


ACTIONS, GOTOS = _tables(GRAMMAR)
BOTTOM = (0, None)


@lru_cache(None)
def _after(stack: tuple, symbol: str) -> tuple | None:
    """The stack after a symbol, or None where the grammar doesn't allow it."""
    while True:
        kind, to = ACTIONS.get((stack[0], symbol), (None, 0))
        if kind != "reduce":
            return None if kind is None else (to, stack) if kind == "shift" else stack
        head, body = GRAMMAR[to]
        for _ in body:
            stack = stack[1]
        stack = (GOTOS[stack[0], head], stack)


def _merge(tops: dict, stack: tuple | None, value: tuple) -> bool:
    """Keep the lesser of two stacks with the same top."""
    if stack is None or (stack[0] in tops and tops[stack[0]][0] <= value):
        return False
    tops[stack[0]] = (value, stack)
    return True


@lru_cache(None)
def _steps(stack: tuple, initial: str, bad: bool, truncated: bool) -> list[tuple[tuple, int, str]]:
    """What an edit of a row, and inserts after it, make of a stack: (stack, cost, edits). The initial ``^`` stands for no
    row, before the first one."""
    tops: dict = {}
    if initial == "^":
        _merge(tops, stack, (0, ""))
    else:
        _merge(tops, stack, (DELETE, "D"))
    if initial != "^" and not bad:
        extra = TRUNCATED * truncated
        _merge(tops, _after(stack, initial), (extra, "K"))
        for role in ROLES:
            _merge(tops, _after(stack, role), (REROLE + extra, CODES["R", role]))
    changed = True
    while changed:
        changed = False
        for (cost, edits), own in list(tops.values()):
            for role in ROLES:
                changed |= _merge(tops, _after(own, role), (cost + INSERT, edits + CODES["I", role]))
    return [(own, cost, edits) for (cost, edits), own in tops.values()]


class _Parse:
    """The open stacks of a conversation. Each has a key (cost, rank, edits) by which equal tops are merged: the edits since
    the last chunk was put aside, and the rank of the chunks before; also its chunks and the hash of its repaired lines."""

    def __init__(self) -> None:
        self.tops = {0: ((0, 0, ""), BOTTOM, (), None)}
        self.row("^", False, False, "", "")

    def row(self, initial: str, bad: bool, truncated: bool, role: str, text: str) -> None:
        best: dict = {}
        for (cost, rank, edits), stack, chunks, lines in self.tops.values():
            for new, more, code in _steps(stack, initial, bad, truncated):
                key = (cost + more, rank, edits + code)
                if new[0] not in best or key < best[new[0]][0]:
                    best[new[0]] = (key, new, chunks, lines, code)
        limit = min(x[0][0] for x in best.values()) + SLACK
        self.tops = {
            top: (key, stack, chunks, _fed(lines, code, role, text))
            for top, (key, stack, chunks, lines, code) in best.items() if key[0] <= limit
        }
        if min(len(x[0][2]) for x in self.tops.values()) >= 2 * CHUNK:
            self._put_aside()

    def _put_aside(self) -> None:
        """Move the first edits of each stack to its chunks. Chunks of one length decide the order of what follows."""
        ranked = sorted({(rank, edits[:CHUNK]) for (_, rank, edits), *_ in self.tops.values()})
        place = {x: (n, x[1]) for n, x in enumerate(ranked)}
        for top, ((cost, rank, edits), stack, chunks, lines) in self.tops.items():
            number, chunk = place[rank, edits[:CHUNK]]
            self.tops[top] = ((cost, number, edits[CHUNK:]), stack, (chunk, chunks), lines)

    def end(self) -> tuple[int, str, str]:
        """Cost, audit and digest of the cheapest repair."""
        done = [x for x in self.tops.values() if x[1] == BOTTOM or _after(x[1], "$")]
        (cost, _, edits), _, chunks, lines = min(done, key=lambda x: x[0])
        parts = [edits]
        while chunks:
            chunk, chunks = chunks
            parts.append(chunk)
        return cost, "".join(reversed(parts)).translate(INITIALS), (lines or sha256()).hexdigest()


def _fed(lines, code: str, role: str, text: str):
    """The hash of the lines so far and those that a row's edits add."""
    added = [f"{role}:{text}" if c == "K" else f"{ROLES['u' if c in 'JS' else 'a']}:{text if c in 'RS' else ''}" for c in code if c != "D"]
    if not added:
        return lines
    fed = sha256() if lines is None else lines.copy()
    fed.update((("" if lines is None else "\n") + "\n".join(added)).encode())
    return fed


class _Conversation:
    def __init__(self, conv) -> None:
        self.conv, self.parse = conv, _Parse()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.turn = self.before = None

    def row(self, turn, role: str, text: str, blank: bool, seen: bool, truncated: bool) -> None:
        duplicate = not blank and (seen or self.before == (turn, role, text))
        truncated = truncated and not blank and not duplicate
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        if self.before is not None:
            self.illegal += self.before[1][:1] + role[:1] not in LEGAL
        if turn is not None:
            self.first = turn if self.first is None else self.first
            self.turns += turn != self.turn
            self.turn = turn
        self.before = (turn, role, text)
        self.parse.row(role[:1], blank or duplicate, truncated, role, text)

    def result(self) -> tuple:
        gaps = 0 if self.first is None else self.turn - self.first + 1 - self.turns
        counts = (self.blank, self.duplicate, self.truncated, self.illegal)
        return (self.conv, gaps if gaps < 1 << 63 else None, *counts, *self.parse.end())


RESULT = (
    "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, "
    "repaired_sha256 string"
)


def marked(rows: DataFrame) -> DataFrame:
    """``rows(conv, turn, role, text, there)`` with what their texts and earlier equal rows say: blank, truncated, and seen:
    whether an earlier turn has the same role and text. Of equal rows of one turn none is marked."""
    bare = F.rtrim("text", F.lit(SPACES))
    rows = rows.withColumn("blank", bare == "").withColumn("truncated", ~F.substring(bare, -1, 1).isin(".", "!", "?"))
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    known = F.sha2("text", 256)
    pairs = rows.where("there AND NOT blank").groupBy("conv", "role", known.alias("known"))
    repeated = stage(pairs.agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first < last").drop("last"))
    repeated = repeated.withColumnsRenamed({"conv": "own", "role": "as"})
    same = F.col("conv").eqNullSafe(F.col("own")) & (F.col("role") == F.col("as")) & (known == F.col("known"))
    later = F.coalesce(place > F.col("first"), F.lit(False))
    return rows.join(repeated, same, "left").withColumn("seen", later).drop("own", "as", "known", "first")


def repair(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    there: Column | None = None,
) -> DataFrame:
    """One row per conversation: its id, faults, and the cost, audit and digest of its cheapest repair. Rows that are not
    ``there`` only name their conversation."""
    there = F.lit(True) if there is None else there
    named = rows.select(
        F.col(conv_id).alias("conv"), F.col(turn).cast("bigint").alias("turn"), F.coalesce(role, F.lit(" ")).alias("role"),
        F.coalesce(text, F.lit(" ")).alias("text"), there.alias("there"),
    )
    taken = ["conv", "turn", "role", "text", "there", "blank", "seen", "truncated"]
    ordered = marked(short_batches(named)).select(*taken).repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")
    schema = f"conv {dict(named.dtypes)['conv']}, {RESULT}"
    names = [x.split()[0] for x in schema.split(", ")]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done, kinds = None, [], None

        def out() -> pa.RecordBatch:
            kinds_out = [kinds, *[pa.int64()] * 6, pa.string(), pa.string()]
            columns = [pa.array(column, kind) for column, kind in zip(zip(*done), kinds_out)]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            kinds = batch.schema.field(0).type
            for conv, *values in zip(*[column.to_pylist() for column in batch.columns]):
                if now is None or now.conv != conv:
                    if now is not None:
                        done.append(now.result())
                    now = _Conversation(conv)
                at, who, said, present, blank, seen, truncated = values
                if present:
                    now.row(at, who, said, blank, seen, truncated)
            if done:
                yield out()
        if now is not None:
            done.append(now.result())
            yield out()

    return ordered.mapInArrow(parse, schema).withColumnRenamed("conv", conv_id)


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of conversations with the damage that the CRC-32 of their id and turn chooses; dropped ones stay, not ``there``."""

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(shown("text"), "[.!?]", "")).otherwise(shown("text"))
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(shown("role")).alias("role"), text.alias("text"),
        (kind != 0).alias("there"), F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("again"),
    )


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(load(spark, sf_dir, "conversations")), there=F.col("there"))
