"""Conversations repaired at least cost, as shortest paths found by an auction.

A conversation is a lattice: its nodes are the places between rows, each with the state that the
roles so far have reached, and its arcs are the edits with their integer costs. The auction keeps a
price at every node, never above the cost of any arc plus the price behind it, and a path that it
extends along an arc without slack or, where there is none, contracts after raising the price of its
end. Run from the last place backwards, each path ends at the first node that an earlier one has
settled, so prices converge to the exact cost of finishing in a number of steps that grows with the
rows. Then every arc without slack lies on a cheapest path, and following the least letter among them
gives the first of the cheapest edits in the alphabet.

Long conversations are cut into parts of bounded length, whose costs from state to state are arcs of a
coarse lattice of the same kind.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webcorpus.llm.common import written

CELL = 12  # a part has at most 2 ** CELL rows
ROWS = 2000  # rows of a batch that is handed on
REMEMBERED = 64  # parts of up to so many rows are solved once per task

# The costs of the edits; a blank or duplicate row can only be deleted.
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
NEVER = 1 << 60

# States: nothing yet, after the system's turn, the user's, the assistant's. Turns may end in ENDS.
STATES, START = 4, 0
FORCED = (2, 2, 3, 2)  # the state after the one turn that an insertion or a new role can add
ROLES = ("user", "user", "assistant", "user")  # and its role
KEPT = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 3, (3, 1): 2}  # by state and role initial, of INITIALS
INITIALS = "sua"
ENDS = (0, NEVER, NEVER, 0)
LEGAL = {"su", "ua", "au"}

# A row's code: the index of its role's initial, and flags.
OTHER, DELETED, CUT = 3, 4, 8

Arcs = Callable[[int], list[tuple[str, int, int]]]


def converge(nodes: int, arcs: Arcs) -> list[int]:
    """The exact cost from every node to the destination, which is node number ``nodes``.

    arcs(node) lists (letter, cost, next node), in the same place or the next one; costs are not
    negative, and a circle's are positive. Later places are taken first. The prices of a place start
    at the least one of the place behind it, which no arc undercuts.
    """
    price = [0] * (nodes + 1)
    settled = [False] * nodes + [True]
    for origin in range(nodes - 1, -1, -1):
        if origin % STATES == STATES - 1 and origin + 1 < nodes:
            price[origin + 1 - STATES : origin + 1] = [min(price[origin + 1 : origin + 1 + STATES])] * STATES
        path = [origin]
        while not settled[path[-1]]:
            node = path[-1]
            least, ahead = NEVER, -1
            for _, cost, to in arcs(node):
                if cost + price[to] < least:
                    least, ahead = cost + price[to], to
            if price[node] < least or least == NEVER:
                price[node] = least
                settled[node] = least == NEVER  # no way on
                if len(path) > 1:
                    path.pop()
            else:
                path.append(ahead)
        if price[path[-1]] < NEVER:
            for node in path:
                settled[node] = True
    return price


def lattice(codes: bytes, exits: tuple[int, ...], last: bool, upto: int = STATES - 1) -> Arcs:
    """The edits of a part, from its first place on: D, I, K, R in this order. Leaving it in a state
    costs exits; turns can be inserted in front of every row, and behind the last one of all. States
    above ``upto`` are left out: prices would rise for ever on a circle that leads nowhere."""
    rows = len(codes)
    end = STATES * (rows + 1)

    def arcs(node: int) -> list[tuple[str, int, int]]:
        at, state = divmod(node, STATES)
        if at == rows:
            out = [("", exits[state], end)] if exits[state] < NEVER else []
            return [*out, ("I", INSERT, node - state + FORCED[state])] if last else out
        code, behind = codes[at], STATES * (at + 1)
        out = [("D", DELETE, behind + state), ("I", INSERT, node - state + FORCED[state])]
        if not code & DELETED:
            extra = TRUNCATED if code & CUT else 0
            kept = KEPT.get((state, code & 3))
            if kept is not None:
                out.append(("K", extra, behind + kept))
            out.append(("R", REROLE + extra, behind + FORCED[state]))
        return out if upto == STATES - 1 else [arc for arc in out if arc[2] % STATES <= upto]

    return arcs


def trace(arcs: Arcs, price: list[int], node: int, nodes: int) -> tuple[str, int]:
    """The letters of the alphabetically first of the cheapest ways, and the last node before the end."""
    letters = []
    while True:
        letter, _, to = next(arc for arc in arcs(node) if arc[1] + price[arc[2]] == price[node])
        if to == nodes:
            return "".join(letters), node
        letters.append(letter)
        node = to


def _solve(codes: bytes) -> tuple[int, str]:
    """Cost and letters of a conversation that is one part."""
    nodes = STATES * (len(codes) + 1)
    arcs = lattice(codes, ENDS, True)
    price = converge(nodes, arcs)
    return price[START], trace(arcs, price, START, nodes)[0]


_remembered = lru_cache(maxsize=20_000)(_solve)


def solve(codes: bytes) -> tuple[int, str]:
    return _remembered(codes) if len(codes) <= REMEMBERED else _solve(codes)


def crossings(codes: bytes) -> list[list[int]]:
    """The least cost through a part from each state to each, without turns behind its last row."""
    out = [[NEVER] * STATES for _ in range(STATES)]
    for leave in range(STATES):
        exits = tuple(0 if state == leave else NEVER for state in range(STATES))
        # The first two states are left for good: no way back leads to them.
        arcs = lattice(codes, exits, False, leave if leave < 2 else STATES - 1)
        price = converge(STATES * (len(codes) + 1), arcs)
        for enter in range(STATES):
            out[enter][leave] = price[enter]
    return out


def border_prices(parts: list[list[list[int]]]) -> list[tuple[int, ...]]:
    """The cost of finishing from each state in front of each part, and behind the last."""
    ending = tuple(converge(STATES, lattice(b"", ENDS, True))[:STATES])
    end = STATES * (len(parts) + 1)

    def arcs(node: int) -> list[tuple[str, int, int]]:
        at, state = divmod(node, STATES)
        if at == len(parts):
            return [("", ending[state], end)]
        return [("", cost, STATES * (at + 1) + to) for to, cost in enumerate(parts[at][state]) if cost < NEVER]

    price = converge(end, arcs)
    return [tuple(price[STATES * i : STATES * (i + 1)]) for i in range(len(parts) + 1)]


# --- Spark ---

_KEY = ("conv", pa.string())
_PARTS = pa.schema([
    _KEY, ("cell", pa.int64()), ("codes", pa.binary()), ("blank", pa.int64()), ("duplicate", pa.int64()),
    ("truncated", pa.int64()), ("illegal", pa.int64()), ("first", pa.string()), ("last", pa.string()),
])
_SOLVED = pa.schema([
    _KEY, ("cell", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("blank", pa.int64()),
    ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()),
])
_CROSSED = pa.schema([_KEY, ("cell", pa.int64()), ("crossings", pa.list_(pa.int64()))])
_PRICED = pa.schema([_KEY, ("cell", pa.int64()), ("exits", pa.list_(pa.int64())), ("closing", pa.bool_()), ("cost", pa.int64())])
_WAYS = pa.schema([_KEY, ("cell", pa.int64()), ("enter", pa.int32()), ("leave", pa.int32()), ("audit", pa.string())])
_ROWS = pa.schema([_KEY, ("line", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])

SQL_TYPES = {pa.string(): "string", pa.int64(): "bigint", pa.int32(): "int", pa.binary(): "binary", pa.bool_(): "boolean", pa.list_(pa.int64()): "array<bigint>"}


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{field.name} {SQL_TYPES[field.type]}" for field in schema)


def _mapped(df: DataFrame, made: Callable[[Iterator[dict]], Iterator[tuple]], schema: pa.Schema) -> DataFrame:
    """A generator over the rows of a partition, as dicts, that gives tuples of the schema."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in batch.to_pylist())
        out: list[tuple] = []
        for made_row in made(rows):
            out.append(made_row)
            if len(out) >= ROWS:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema=schema)

    return df.mapInArrow(run, _ddl(schema))


def _by(rows: Iterator[dict], *names: str) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Runs of rows with equal values, each to be read before the next."""
    row = next(rows, None)
    while row is not None:
        key = tuple(row[name] for name in names)

        def run() -> Iterator[dict]:
            nonlocal row
            while row is not None and tuple(row[name] for name in names) == key:
                yield row
                row = next(rows, None)

        group = run()
        yield key, group
        for _ in group:
            pass


def _make_parts(rows: Iterator[dict]) -> Iterator[tuple]:
    for (cell, conv), group in _by(rows, "cell", "conv"):
        codes, counts, illegal = bytearray(), [0, 0, 0], 0
        first = last = None
        new = False
        for row in group:
            if not row["is_row"]:  # says that the next row is the first to say its text
                new = True
                continue
            initial = row["initial"]
            faults = (row["blank"], not row["blank"] and not new, row["truncated"])
            fault = next((i for i, found in enumerate(faults) if found), None)
            code = INITIALS.index(initial) if initial and initial in INITIALS else OTHER
            if fault is not None:
                counts[fault] += 1
                code |= CUT if fault == 2 else DELETED
            codes.append(code)
            if last is not None:
                illegal += last + initial not in LEGAL
            first, last, new = initial if first is None else first, initial, False
        yield conv, cell, bytes(codes), *counts, illegal, first, last


def _solve_whole(rows: Iterator[dict]) -> Iterator[tuple]:
    for row in rows:
        cost, audit = solve(row["codes"])
        yield row["conv"], row["cell"], cost, audit, row["blank"], row["duplicate"], row["truncated"], row["illegal"]


def _cross(rows: Iterator[dict]) -> Iterator[tuple]:
    for row in rows:
        yield row["conv"], row["cell"], [cost for line in crossings(row["codes"]) for cost in line]


def _price(rows: Iterator[dict]) -> Iterator[tuple]:
    for (conv,), group in _by(rows, "conv"):
        cells, parts = [], []
        for row in group:
            cells.append(row["cell"])
            parts.append([row["crossings"][i : i + STATES] for i in range(0, STATES * STATES, STATES)])
        prices = border_prices(parts)
        for i, cell in enumerate(cells):
            closing = i + 1 == len(cells)
            yield conv, cell, list(ENDS if closing else prices[i + 1]), closing, prices[0][START] if i == 0 else 0


def _ways(rows: Iterator[dict]) -> Iterator[tuple]:
    """The way through a part from each state, given the prices behind it."""
    for row in rows:
        codes = row["codes"]
        nodes = STATES * (len(codes) + 1)
        arcs = lattice(codes, tuple(row["exits"]), row["closing"])
        price = converge(nodes, arcs)
        for enter in range(STATES):
            if price[enter] < NEVER:
                audit, node = trace(arcs, price, enter, nodes)
                yield row["conv"], row["cell"], enter, node % STATES, audit


def _chain(rows: Iterator[dict]) -> Iterator[tuple]:
    for (conv,), group in _by(rows, "conv"):
        state, last = START, None
        for (cell,), ways in _by(group, "cell"):
            taken = next(way for way in ways if way["enter"] == state)
            state = taken["leave"]
            border = last is not None and last + taken["first"] not in LEGAL
            last = taken["last"]
            yield (
                conv, cell, taken["cost"], taken["audit"], taken["blank"], taken["duplicate"], taken["truncated"],
                taken["illegal"] + border,
            )


def _apply(rows: Iterator[dict]) -> Iterator[tuple]:
    """The rows of each conversation after its edits; a part's letters come in front of its rows."""
    for (conv,), group in _by(rows, "conv"):
        state, line, letters = START, 0, iter("")
        for row in group:
            inserted = letters if row["audit"] is not None else ()
            for _ in inserted:  # what is left of a part's letters stands behind its last row
                line += 1
                yield conv, line, "I", ROLES[state], ""
                state = FORCED[state]
            if row["audit"] is not None:
                letters = iter(row["audit"])
                continue
            for letter in letters:
                if letter != "I":
                    break
                line += 1
                yield conv, line, "I", ROLES[state], ""
                state = FORCED[state]
            if letter == "D":
                continue
            role = row["role"] if letter == "K" else ROLES[state]
            state = KEPT[state, INITIALS.index(role[0])]
            line += 1
            yield conv, line, letter, role, row["text"]
        for _ in letters:
            line += 1
            yield conv, line, "I", ROLES[state], ""
            state = FORCED[state]


_BLANKS = " \t\n\x0b\f\r"


def _conv(conv_id: Column) -> Column:
    return F.coalesce(conv_id.cast("string"), F.lit(" "))


def _conv_id(conv: Column) -> Column:
    return F.nullif(conv, F.lit(" ")).cast("bigint").alias("conv_id")


def _place(rows: DataFrame) -> DataFrame:
    """The rows in order, numbered so that a cell holds a bounded number of neighbours."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    role = F.coalesce(F.col("role").cast("string"), F.lit(" "))
    rows = rows.select(_conv(F.col("conv_id")).alias("conv"), F.col("turn").cast("bigint").alias("turn"), role.alias("role"), text.alias("text"))
    # Ranges by the start of a text agree with the order by whole texts.
    ranged = rows.repartitionByRange("conv", "turn", "role", F.left("text", F.lit(64)))
    placed = ranged.sortWithinPartitions("conv", "turn", "role", "text").withColumn("pos", F.monotonically_increasing_id())
    said = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))
    return written(placed.withColumn("cell", F.shiftright("pos", CELL)).withColumn("said", said), "turns")


def _solve_parts(placed: DataFrame) -> DataFrame:
    """The cheapest edits of every part (conversation, cell)."""
    firsts = placed.groupBy("conv", "said").agg(F.min("pos").alias("pos")).select(
        "conv", F.shiftright("pos", CELL).alias("cell"), "pos", F.lit(False).alias("is_row")
    )
    end = F.rtrim("text", F.lit(_BLANKS))
    rows = placed.select(
        "conv", "cell", "pos", F.lit(True).alias("is_row"), F.left("role", F.lit(1)).alias("initial"), (end == "").alias("blank"),
        (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
    )
    dealt = rows.unionByName(firsts, allowMissingColumns=True).repartition("cell").sortWithinPartitions("cell", "pos", "is_row")
    parts = written(_mapped(dealt, _make_parts, _PARTS), "conversation-parts")

    several = parts.groupBy("conv").count().filter("count > 1").select("conv")
    whole = _mapped(parts.join(several, "conv", "left_anti"), _solve_whole, _SOLVED)
    cut = written(parts.join(several, "conv", "left_semi"), "cut-conversations")
    by_conv = lambda df: df.repartition("conv").sortWithinPartitions("conv", "cell")
    crossed = _mapped(cut.select("conv", "cell", "codes").repartition("conv", "cell"), _cross, _CROSSED)
    priced = written(_mapped(by_conv(crossed), _price, _PRICED), "border-prices")
    ways = _mapped(cut.select("conv", "cell", "codes").join(priced, ["conv", "cell"]), _ways, _WAYS)
    known = cut.drop("codes").join(priced.select("conv", "cell", "cost"), ["conv", "cell"])
    chained = _mapped(by_conv(ways.join(known, ["conv", "cell"])), _chain, _SOLVED)
    return written(whole.unionByName(chained), "solved-parts")


def repair_conversations(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(audits, repaired) of the rows (conv_id, turn, role, text).

    audits has a row per conversation: conv_id, gaps in its turns, the number of blank, duplicate
    and truncated rows (each row's first fault counts) and of illegal neighbours, and the cost and
    letters (audit) of the cheapest edits, the alphabetically first among equals, after which the
    role initials are ``(s?(ua)+)?``. repaired has the rows after them: conv_id, line (from 1),
    edit, role, text; the rows of a conversation are in one partition, in order.

    Rows are taken by turn, NULLs first, ties by role and text. A NULL role or text is one space;
    NULL conv_ids are one conversation. A row is blank without a visible character, a duplicate if
    its role and text were said before, truncated if its last visible character is not one of .!?.
    Edits: K keeps a row (its initial must fit), R gives it the role of user or assistant (3), D
    deletes it (4, and the only one for blank and duplicate rows), I inserts an empty turn of the user or the assistant
    (3); a truncated row that stays costs 3 more. Repeated rows are duplicates, very long
    conversations are solved in parts, texts are only carried. Other columns are not read; an empty table gives none.
    """
    placed = _place(conversations)
    solved = _solve_parts(placed)
    turns = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    gaps = placed.groupBy("conv").agg(F.coalesce(turns, F.lit(0)).cast("bigint").alias("gaps"))
    letters = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("cell", "audit"))), lambda p: p["audit"]), "")
    sums = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    audits = gaps.join(solved.groupBy("conv").agg(*sums, letters.alias("audit")), "conv")
    ahead = solved.select("conv", F.shiftleft("cell", CELL).alias("pos"), F.lit(0).alias("kind"), "audit")
    rows = placed.select("conv", "pos", F.lit(1).alias("kind"), "role", "text").unionByName(ahead, allowMissingColumns=True)
    dealt = rows.repartition("conv").sortWithinPartitions("conv", "pos", "kind")
    repaired = _mapped(dealt, _apply, _ROWS)
    return audits.withColumn("conv_id", _conv_id(F.col("conv"))).drop("conv"), repaired.select(
        _conv_id(F.col("conv")), "line", "edit", "role", "text"
    )
