"""Repair of conversation structure by a grammar-compressed dynamic program.

A conversation is read as a sequence of symbols, one for each row: its role's initial (system, user, assistant, other)
and fault (none, truncated, or one that must go). The cheapest edits turn it into an optional system row and pairs of
user and assistant, `(s?(ua)+)?`. Four states say how far the repaired rows have come, so a row is a matrix of costs
from state to state in min-plus algebra, and a sequence of rows is their product.

1. Rows are sorted by conversation and turn, range by range, and cut into blocks of bounded size (`BLOCK_ROWS`,
   `BLOCK_CHARS`). A long conversation is many blocks, in many tasks.
2. The sequences of a batch of blocks are compressed together by Re-Pair: the most frequent pair of symbols becomes a
   rule, again and again. Each rule has one matrix, the product of its two symbols, made bottom-up and used by every
   conversation of the batch that holds it. Beside each cost stands the state between the two symbols, so a rule is
   also a rope of edits that is written out only along the cheapest path.
3. A conversation of several blocks multiplies the matrices of its blocks, `FAN` at a time, level by level, and hands
   back to each block the states it begins and ends in.

Of equally cheap edits the least string of initials counts (Delete < Insert < Keep < Rerole). Insertions stand before a
row, or after the last one. So two strings of edits for the same rows from the same state differ before either ends, and
where they end in different states they are different: their order is an order of the end states, four small numbers
that multiply with the costs. No string is compared.

Defined results: null roles and texts are one space; a null id is a conversation of its own, a null turn comes first and
has no part in gaps. Rows of one turn stand by role, then text; equal rows are counted, not repeated, so that a hot row is one
row. Blank and duplicate rows must go. A conversation without rows is legal, with no edits. Columns other than the four
named are left out. A text of any length is read as a whole. The digest of one conversation's repaired text is made in one
pass over its blocks in order, in bounded memory.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meshroad.llm.common import BROADCAST_ROWS, in_arrow, materialize

BLOCK_ROWS = 4_096
BLOCK_CHARS = 256 * 1024
# Blocks whose matrices are multiplied in one group.
FAN = 256
# Symbols that share one grammar.
GRAMMAR_SYMBOLS = 20_000

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
# States: nothing yet, after a system row, after a user row, after an assistant row (complete).
EMPTY, SYSTEM, USER, PAIR = STATES = range(4)
NEVER = 1 << 60
# What must be inserted when the rows end in a state, and what that costs.
ENDINGS = {EMPTY: "", SYSTEM: "II", USER: "I", PAIR: ""}
MUST_GO, BREAK = "x", -1
BLANK, DUPLICATE, CUT = 1, 2, 3
LEGAL = frozenset(("su", "ua", "au"))
WHITE = " \t\n\x0b\f\r"


# ---- the algebra

def after(state: int, role: str) -> int | None:
    """The state after a row of a role is kept, if it may be."""
    if role == "s":
        return SYSTEM if state == EMPTY else None
    if role == "u":
        return USER if state != USER else None
    return PAIR if role == "a" and state == USER else None


def wanted(state: int) -> str:
    """The role that an inserted or reroled row gets."""
    return "assistant" if state == USER else "user"


def next_state(state: int, edit: str, role: str) -> int:
    if edit == "D":
        return state
    return after(state, wanted(state)[0] if edit in "IR" else role)


class Matrix:
    """Least cost from state to state over some rows; `rank` orders the end states of a start by their edits."""

    __slots__ = ("cost", "rank")

    def __init__(self, cost, rank):
        self.cost, self.rank = cost, rank

    def times(self, other: Matrix) -> tuple[Matrix, list[list[int]]]:
        """The product, and the state between the two for each entry."""
        cost, rank, via = [], [], []
        for i in STATES:
            mine, order = self.cost[i], self.rank[i]
            best = [min((mine[k] + other.cost[k][j], order[k], k) for k in STATES) for j in STATES]
            cost.append([min(NEVER, b[0]) for b in best])
            via.append([b[2] for b in best])
            keys = [(order[k], other.rank[k][j]) if c < NEVER else (9, j) for j, (c, _, k) in enumerate(best)]
            by_edits = sorted(STATES, key=keys.__getitem__)
            rank.append([by_edits.index(j) for j in STATES])
        return Matrix(cost, rank), via


@functools.cache
def row_matrix(symbol: str) -> tuple[Matrix, list[list[str]]]:
    """The matrix of one row, and the edits of each entry: insertions, then what is done to the row."""
    role, extra = symbol.lower(), TRUNCATED if symbol.isupper() else 0
    found = [[(NEVER, "") for _ in STATES] for _ in STATES]
    for start in STATES:
        state, inserted = start, ""
        for _ in range(3):
            base = INSERT * len(inserted)
            options = [(base + DELETE, inserted + "D", state)]
            if symbol != MUST_GO:
                options.append((base + REROLE + extra, inserted + "R", after(state, wanted(state)[0])))
                kept = after(state, role)
                if kept is not None:
                    options.append((base + KEEP + extra, inserted + "K", kept))
            for cost, edits, end in options:
                found[start][end] = min(found[start][end], (cost, edits))
            state, inserted = after(state, wanted(state)[0]), inserted + "I"
    rank = []
    for line in found:
        order = sorted(STATES, key=lambda j, line=line: (line[j][0] >= NEVER, line[j][1], j))
        rank.append([order.index(j) for j in STATES])
    return Matrix([[c for c, _ in line] for line in found], rank), [[e for _, e in line] for line in found]


def walk(matrices: Iterable[Matrix], start: int, end: int | None = None) -> tuple[int, list[int]]:
    """Least cost of passing all matrices, and the states before the first, between them and after the last.

    Without `end` the rows are the last ones: what must be inserted after them counts too.
    """
    line = [(0 if j == start else NEVER, 0 if j == start else 9) for j in STATES]
    back = []
    for m in matrices:
        best = [min((line[k][0] + m.cost[k][j], line[k][1], m.rank[k][j], k) for k in STATES) for j in STATES]
        back.append([b[3] for b in best])
        order = sorted(STATES, key=lambda j: (best[j][0] >= NEVER, best[j][1], best[j][2]))
        line = [(min(NEVER, best[j][0]), order.index(j)) for j in STATES]
    if end is None:
        end = min(STATES, key=lambda j: (line[j][0] + INSERT * len(ENDINGS[j]), line[j][1]))
        cost = line[end][0] + INSERT * len(ENDINGS[end])
    else:
        cost = line[end][0]
    states = [end]
    for k in reversed(back):
        states.append(k[states[-1]])
    return cost, states[::-1]


class Grammar:
    """Re-Pair over some sequences; a symbol is a number, rows first, rules after them."""

    def __init__(self, sequences: list[str]):
        letters = sorted(set(itertools.chain.from_iterable(sequences)))
        number = {c: k for k, c in enumerate(letters)}
        rows = [row_matrix(c) for c in letters]
        self.edits = [e for _, e in rows]
        self.matrices = [m for m, _ in rows]
        self.rules: list[tuple[int, int, list[list[int]]]] = []
        flat = np.fromiter(itertools.chain.from_iterable([*map(number.__getitem__, s), BREAK] for s in sequences), dtype=np.int64)
        while len(flat) > 1:
            pair = self._most_frequent(flat)
            if pair is None:
                break
            matrix, via = self.matrices[pair[0]].times(self.matrices[pair[1]])
            flat = self._replaced(flat, pair, len(self.matrices))
            self.matrices.append(matrix)
            self.rules.append((*pair, via))
        ends = np.flatnonzero(flat == BREAK)
        self.sequences = [flat[a:b].tolist() for a, b in zip([0, *(ends[:-1] + 1).tolist()], ends.tolist())] if len(ends) else []

    @staticmethod
    def _most_frequent(flat: np.ndarray) -> tuple[int, int] | None:
        inside = (flat[:-1] != BREAK) & (flat[1:] != BREAK)
        size = int(flat.max()) + 1
        keys, counts = np.unique((flat[:-1] * size + flat[1:])[inside], return_counts=True)
        if not len(keys) or counts.max() < 2:
            return None
        return divmod(int(keys[counts.argmax()]), size)

    @staticmethod
    def _replaced(flat: np.ndarray, pair: tuple[int, int], name: int) -> np.ndarray:
        at = np.flatnonzero((flat[:-1] == pair[0]) & (flat[1:] == pair[1]))
        if pair[0] == pair[1] and len(at):  # in a run, every other place
            first = np.concatenate([[True], np.diff(at) > 1])
            place = np.arange(len(at))
            at = at[(place - np.maximum.accumulate(np.where(first, place, 0))) % 2 == 0]
        flat = flat.copy()
        flat[at] = name
        return np.delete(flat, at + 1)

    def product(self, k: int) -> Matrix:
        """The matrix of a whole sequence."""
        return functools.reduce(lambda a, b: a.times(b)[0], (self.matrices[s] for s in self.sequences[k]))

    def cheapest(self, k: int, start: int, end: int | None) -> str:
        """The edits of a sequence, from its ropes."""
        symbols = self.sequences[k]
        _, states = walk((self.matrices[s] for s in symbols), start, end)
        out, base = [], len(self.edits)
        stack = [(s, states[n], states[n + 1]) for n, s in enumerate(symbols)][::-1]
        while stack:
            symbol, i, j = stack.pop()
            if symbol < base:
                out.append(self.edits[symbol][i][j])
            else:
                left, right, via = self.rules[symbol - base]
                stack += [(right, via[i][j], j), (left, i, via[i][j])]
        return "".join(out) + (ENDINGS[states[-1]] if end is None else "")


# ---- rows and blocks

def damage(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows (`conv_id`, `turn`, `role`, `text`, `copies`) with faults planted by a checksum of id and turn; a dropped row has no copies."""
    c, t = F.col(f"`{conv_id}`"), F.col(f"`{turn}`").cast("long")
    r, x = (F.coalesce(F.col(f"`{n}`").cast("string"), F.lit(" ")) for n in (role, text))
    key = F.concat(F.coalesce(c.cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(t.cast("string"), F.lit(" ")))
    kind = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    rows = conversations.select(c.alias("conv_id"), t.alias("turn"), r.alias("role"), x.alias("text"), kind.alias("_kind"))
    gone = F.col("_kind") == 0
    return rows.select(
        "conv_id", F.when(~gone, F.col("turn")).alias("turn"),
        F.when(gone, "").when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(gone | (F.col("_kind") == 1), "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(gone, 0).when(F.col("_kind") == 3, 2).otherwise(1).cast("long").alias("copies"))


def _trimmed() -> Column:
    return F.rtrim("text", F.lit(WHITE))


def _key() -> Column:
    return F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))


def sorted_rows(rows: DataFrame) -> DataFrame:
    """Distinct rows with their number of copies, symbol and fault, sorted by conversation and turn over ranges."""
    named = rows.filter("copies > 0").withColumn("_trim", _trimmed()).filter("_trim != ''").select("conv_id", "turn", _key().alias("_key"))
    # Role and text that stand in several turns of a conversation, with the first of these.
    again = named.groupBy("conv_id", "_key").agg(F.min(F.struct("turn")).alias("first"), F.max(F.struct("turn")).alias("last"))
    again = materialize(again.filter("not (first <=> last)").select(F.col("conv_id").alias("_conv"), F.col("_key").alias("_again"), "first"), "repeated-rows")
    distinct = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")).withColumn("_trim", _trimmed()).withColumn("_key", _key())
    side = F.broadcast(again) if again.count() <= BROADCAST_ROWS else again.hint("merge")
    joined = distinct.join(side, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("_key") == F.col("_again")), "left")
    fault = (F.when(F.col("_trim") == "", BLANK).when(F.col("first").isNotNull() & ~F.col("first.turn").eqNullSafe(F.col("turn")), DUPLICATE)
             .when(~F.expr("right(_trim, 1)").isin(".", "!", "?"), CUT).otherwise(0))
    initial = F.substring("role", 1, 1)
    plain = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    rows = joined.withColumn("_fault", fault).select(
        "conv_id", "turn", "role", "text", "copies", "_fault",
        F.when(F.col("_fault").isin(BLANK, DUPLICATE), MUST_GO).when(F.col("_fault") == CUT, F.upper(plain)).otherwise(plain).alias("_symbol"))
    order = ["conv_id", "turn", "role"]
    return rows.repartitionByRange(*order, F.substring("text", 1, 100)).sortWithinPartitions(*order, "text")


BLOCK = ("part int, no long, sequence string, roles array<string>, texts array<string>, faults array<int>, rows long, blank long, duplicate long, "
         "truncated long, illegal long, first_role string, last_role string, first_turn long, last_turn long, turns long")


def _schema(conv: T.DataType, rest: str) -> T.StructType:
    return T.StructType([T.StructField("conv_id", conv), *T.StructType.fromDDL(rest).fields])


class _Block:
    """Rows of one conversation in order, as they are gathered."""

    def __init__(self, conv, no: int):
        self.conv, self.no, self.chars = conv, no, 0
        self.symbols, self.roles, self.texts, self.faults = [], [], [], []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_role = self.last_role = self.first_turn = self.last_turn = None

    def add(self, symbol, turn, role, text, fault, times=1):
        initial = role[:1]
        if self.last_role is None:
            self.first_role = initial
        elif self.last_role + initial not in LEGAL:
            self.illegal += 1
        if times > 1 and initial + initial not in LEGAL:
            self.illegal += times - 1
        self.last_role = initial
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn, self.last_turn = turn if self.first_turn is None else self.first_turn, turn
        self.blank += times * (fault == BLANK)
        self.duplicate += times * (fault == DUPLICATE)
        self.truncated += times * (fault == CUT)
        self.symbols.append(symbol * times)
        kept = symbol != MUST_GO  # rows that must go are not carried
        self.roles += [role if kept else None] * times
        self.texts += [text if kept else None] * times
        self.faults += [fault] * times
        self.chars += len(text) if kept else 0

    def row(self, part):
        sequence = "".join(self.symbols)
        return (self.conv, part, self.no, sequence, self.roles, self.texts, self.faults, len(sequence), self.blank, self.duplicate, self.truncated,
                self.illegal, self.first_role, self.last_role, self.first_turn, self.last_turn, self.turns)


def _cut(schema: pa.Schema):
    """A task's sorted rows to blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        block, ready, held = None, [], 0

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*ready), schema)], schema=schema)

        for some in batches:
            for at in range(0, some.num_rows, BLOCK_ROWS):
                for conv, turn, role, text, copies, fault, symbol in zip(*(c.to_pylist() for c in some.slice(at, BLOCK_ROWS).columns)):
                    if block is None or block.conv != conv:
                        if block is not None:
                            ready.append(block.row(part))
                            held += block.chars + len(ready[-1][3])
                        block = _Block(conv, 0)
                    todo = [(symbol, fault, 1)] if copies else []
                    if copies > 1:
                        todo.append((MUST_GO, BLANK if fault == BLANK else DUPLICATE, copies - 1))
                    for what, why, times in todo:
                        while times:
                            if len(block.faults) >= BLOCK_ROWS or block.chars >= BLOCK_CHARS:
                                ready.append(block.row(part))
                                held += block.chars + BLOCK_ROWS
                                block = _Block(conv, block.no + 1)
                            some_of = min(times, BLOCK_ROWS - len(block.faults))
                            block.add(what, turn, role, text, why, some_of)
                            times -= some_of
                    if held > 4 * BLOCK_CHARS or len(ready) >= 1_000:
                        yield batch()
                        ready, held = [], 0
        if block is not None:
            ready.append(block.row(part))
        if ready:
            yield batch()

    return run


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def blocks(rows: DataFrame) -> DataFrame:
    """Conversations in blocks, ordered by (`part`, `no`) within each; one with no rows has an empty block."""
    schema = _schema(rows.schema["conv_id"].dataType, BLOCK)
    return in_arrow(sorted_rows(rows), _cut(_arrow(schema)), schema)


def _in_grammars(rows: list[dict], sequence_of) -> Iterator[tuple[dict, Grammar | None, int]]:
    """Each row with the grammar that holds its sequence; equal sequences are one."""
    start = 0
    while start < len(rows):
        number, size, end = {}, 0, start
        while end < len(rows) and (size < GRAMMAR_SYMBOLS or end == start):
            s = sequence_of(rows[end])
            if s and s not in number:
                number[s] = len(number)
                size += len(s) + 1
            end += 1
        grammar = Grammar(list(number)) if number else None
        for row in rows[start:end]:
            s = sequence_of(row)
            yield (row, grammar, number[s]) if s else (row, None, 0)
        start = end


# ---- conversations of several blocks

NODE = "cost array<long>, rank array<int>, " + BLOCK.partition("faults array<int>, ")[2]


def _join_nodes(a: dict, b: dict) -> dict:
    """Counts of two neighbouring runs of rows; the matrices are multiplied apart."""
    if not a["rows"] or not b["rows"]:
        return dict(b if not a["rows"] else a)
    out = {n: a[n] + b[n] for n in ("rows", "blank", "duplicate", "truncated", "illegal", "turns")}
    out["illegal"] += a["last_role"] + b["first_role"] not in LEGAL
    if a["last_turn"] is not None and a["last_turn"] == b["first_turn"]:
        out["turns"] -= 1
    return out | {"first_role": a["first_role"], "last_role": b["last_role"],
                  "first_turn": b["first_turn"] if a["first_turn"] is None else a["first_turn"],
                  "last_turn": a["last_turn"] if b["last_turn"] is None else b["last_turn"]}


IDENTITY = Matrix([[0 if i == j else NEVER for j in STATES] for i in STATES], [[0 if i == j else 1 + (j if j < i else j - 1) for j in STATES] for i in STATES])


def _matrix_of(node: dict) -> Matrix:
    return Matrix([node["cost"][4 * i:4 * i + 4] for i in STATES], [node["rank"][4 * i:4 * i + 4] for i in STATES])


def _flat(m: Matrix) -> dict:
    return {"cost": [c for line in m.cost for c in line], "rank": [r for line in m.rank for r in line]}


def _per_batch(df: DataFrame, make, schema: T.StructType, at_once: int = 1_000) -> DataFrame:
    """`make` turns a list of rows (as dicts) into an iterator of rows."""
    out = _arrow(schema)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, at_once):
                made = list(make(batch.slice(at, at_once).to_pylist()))
                yield pa.RecordBatch.from_pylist(made, schema=out)

    return in_arrow(df, run, schema)


def _leaf_nodes(several: DataFrame) -> DataFrame:
    def make(rows):
        for row, grammar, k in _in_grammars(rows, lambda r: r["sequence"]):
            yield row | _flat(grammar.product(k) if grammar else IDENTITY)

    columns = ["conv_id", "idx", "part", "no", "sequence", *[f.name for f in T.StructType.fromDDL(NODE).fields][2:]]
    return _per_batch(several.select(*columns), make, _schema(several.schema["conv_id"].dataType, "idx long, part int, no long, " + NODE))


def _parents(nodes: DataFrame) -> DataFrame:
    """Up to `FAN` neighbours to one node; `children` holds their places and matrices."""
    names = [f.name for f in T.StructType.fromDDL(NODE).fields]
    grouped = nodes.groupBy("conv_id", F.floor(F.col("idx") / FAN).alias("up")).agg(F.sort_array(F.collect_list(F.struct("idx", *names))).alias("children"))

    def make(rows):
        for row in rows:
            total = functools.reduce(_join_nodes, row["children"])
            matrix = functools.reduce(lambda a, b: a.times(b)[0], map(_matrix_of, row["children"]))
            places = [{"idx": c["idx"], "cost": c["cost"], "rank": c["rank"]} for c in row["children"]]
            yield total | _flat(matrix) | {"conv_id": row["conv_id"], "idx": row["up"], "children": places}

    schema = _schema(nodes.schema["conv_id"].dataType, "idx long, children array<struct<idx: long, cost: array<long>, rank: array<int>>>, " + NODE)
    return _per_batch(grouped, make, schema, 16)


def _children(parents: DataFrame, spans: DataFrame) -> DataFrame:
    """The states that each child begins and ends in, from those of its parent; none for the end of a conversation."""
    p = spans.select(F.col("conv_id").alias("_conv"), F.col("idx").alias("_idx"), "start", "end")
    joined = parents.join(p, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("idx") == F.col("_idx"))).select("conv_id", "children", "start", "end")

    def make(rows):
        for row in rows:
            last = len(row["children"]) - 1
            _, states = walk(map(_matrix_of, row["children"]), row["start"], row["end"])
            for n, c in enumerate(row["children"]):
                yield {"conv_id": row["conv_id"], "idx": c["idx"], "start": states[n], "end": None if row["end"] is None and n == last else states[n + 1]}

    return _per_batch(joined, make, _schema(parents.schema["conv_id"].dataType, "idx long, start int, end int"), 16)


def _in_blocks(table: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Conversations of one block, blocks of longer ones with the states they begin and end in, and counts of the longer ones."""
    names = [f.name for f in T.StructType.fromDDL(NODE).fields][2:]
    sizes = table.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("conv_id").alias("_conv"))
    sizes = materialize(sizes, "long-conversations")
    side = F.broadcast(sizes) if sizes.count() <= BROADCAST_ROWS else sizes.hint("merge")
    same = F.col("conv_id").eqNullSafe(F.col("_conv"))
    single = table.join(side, same, "left_anti").withColumns({"start": F.lit(EMPTY), "end": F.lit(None).cast("int")})
    if sizes.isEmpty():
        return table.withColumns({"start": F.lit(EMPTY), "end": F.lit(None).cast("int")}), single.limit(0), None
    several = table.join(side, same, "left_semi")
    place = W.partitionBy("conv_id").orderBy("part", "no")
    slim = several.select("conv_id", "part", "no", "sequence", *names)
    nodes = materialize(_leaf_nodes(slim.withColumn("idx", (F.row_number().over(place) - 1).cast("long"))), "block-matrices")
    levels, below = [], nodes
    while True:
        levels.append(materialize(_parents(below), "joined-matrices"))
        below = levels[-1]
        if below.filter("idx > 0").isEmpty():
            break
    spans = below.select("conv_id", "idx", F.lit(EMPTY).alias("start"), F.lit(None).cast("int").alias("end"))
    for level in reversed(levels):
        spans = materialize(_children(level, spans), "block-states")
    p, n = spans.alias("p"), nodes.select("conv_id", "idx", "part", "no").alias("n")
    placed = n.join(p, F.col("n.conv_id").eqNullSafe(F.col("p.conv_id")) & (F.col("n.idx") == F.col("p.idx")))
    placed = placed.select(F.col("n.conv_id").alias("_conv"), F.col("part").alias("_part"), F.col("no").alias("_no"), "start", "end")
    at = same & (F.col("part") == F.col("_part")) & (F.col("no") == F.col("_no"))
    return single, several.join(placed.hint("merge"), at).drop("_conv", "_part", "_no"), below.select("conv_id", *names)


COUNTS = ("blank", "duplicate", "truncated", "illegal", "first_turn", "last_turn", "turns")


def repaired_blocks(table: DataFrame) -> DataFrame:
    """Per block its edits (`audit`) with their cost and the repaired rows (`role`, `text`, and the edit that made them)."""

    def make(rows):
        for row, grammar, k in _in_grammars(rows, lambda r: r["sequence"]):
            audit = grammar.cheapest(k, row["start"], row["end"]) if grammar else ""
            state, at, out, cost = row["start"], 0, [], 0
            for edit in audit:
                if edit == "I":
                    out.append({"role": wanted(state), "text": "", "edit": edit})
                    state, cost = next_state(state, edit, ""), cost + INSERT
                    continue
                symbol, role, text = row["sequence"][at], row["roles"][at], row["texts"][at]
                at += 1
                if edit == "D":
                    cost += DELETE
                else:
                    out.append({"role": wanted(state) if edit == "R" else role, "text": text, "edit": edit})
                    cost += (REROLE if edit == "R" else KEEP) + (TRUNCATED if symbol.isupper() else 0)
                state = next_state(state, edit, symbol.lower())
            yield {n: row[n] for n in ("conv_id", "part", "no", *COUNTS)} | {"audit": audit, "cost": cost, "repaired": out}

    schema = _schema(table.schema["conv_id"].dataType, "part int, no long, " + ", ".join(f"{c} long" for c in COUNTS)
                     + ", audit string, cost long, repaired array<struct<role: string, text: string, edit: string>>")
    return _per_batch(table.select("conv_id", "part", "no", "sequence", "roles", "texts", "start", "end", *COUNTS), make, schema, 200)


LINES = "array_join(transform(repaired, r -> concat(r.role, ':', r.text)), '\\n')"


def _digests(parts: DataFrame) -> DataFrame:
    """One row for each conversation of several blocks: its blocks pass in order, one at a time."""
    schema = _schema(parts.schema["conv_id"].dataType, "audit string, cost long, repaired_sha256 string")
    out = _arrow(schema)

    def run(batches):
        conv, seen, audits, cost, digest, any_line = None, False, [], 0, None, False

        def row():
            return pa.RecordBatch.from_pylist([{"conv_id": conv, "audit": "".join(audits), "cost": cost, "repaired_sha256": digest.hexdigest()}], schema=out)

        for batch in batches:
            for at in range(0, batch.num_rows, 16):
                for c, audit, paid, lines, has in zip(*(x.to_pylist() for x in batch.slice(at, 16).columns)):
                    if not seen or c != conv:
                        if seen:
                            yield row()
                        conv, seen, audits, cost, digest, any_line = c, True, [], 0, hashlib.sha256(), False
                    audits.append(audit)
                    cost += paid
                    if has:
                        digest.update((b"\n" if any_line else b"") + lines.encode())
                        any_line = True
        if seen:
            yield row()

    made = parts.select("conv_id", "part", "no", "audit", "cost", F.expr(LINES).alias("lines"), (F.size("repaired") > 0).alias("has"))
    ordered = made.repartition("conv_id").sortWithinPartitions("conv_id", "part", "no").select("conv_id", "audit", "cost", "lines", "has")
    return in_arrow(ordered, run, schema)


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """For rows (`conv_id`, `turn`, `role`, `text`, `copies`): blocks with edits and repaired rows of conversations of one block,
    those of longer ones, and the counts of the latter (none if there are none)."""
    single, several, totals = _in_blocks(materialize(blocks(rows), "conversation-blocks"))
    return repaired_blocks(single), repaired_blocks(several), totals


def repaired_rows(rows: DataFrame) -> DataFrame:
    """The repaired conversations: `conv_id`, `part`, `no` and `pos` (their order), `role`, `text`, `edit`."""
    single, several, totals = repair(rows)
    made = single if totals is None else single.unionByName(several)
    return made.select("conv_id", "part", "no", F.posexplode("repaired").alias("pos", "r")).select("conv_id", "part", "no", "pos", "r.*")


def report(rows: DataFrame) -> DataFrame:
    """Per conversation: gaps in its turns, faults, illegal neighbours, cost and edits of the repair, digest of its result."""
    single, several, totals = repair(rows)
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0)).alias("gaps")
    out = ["conv_id", gaps, "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    whole = single.withColumn("repaired_sha256", F.sha2(F.expr(LINES).cast("binary"), 256)).select(*out)
    if totals is None:
        return whole
    digests = _digests(several).withColumnRenamed("conv_id", "_conv")
    return whole.unionByName(totals.join(digests.hint("merge"), F.col("conv_id").eqNullSafe(F.col("_conv"))).select(*out))
