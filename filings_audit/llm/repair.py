"""Repair of conversations: the cheapest edits that give every conversation the roles (system?)(user assistant)+, or none.

The rows of a conversation and four states (nothing yet, after system, after user, after assistant) span a lattice: Keep,
Rerole and Delete lead to the next row, Insert stays at it, and costs are small whole numbers. Shortest paths are found by
an auction: every node has a price that never exceeds the cost of any arc plus the price at its end; a path
grows from an origin along an arc that attains its price (extension), or its last node raises its price to the cheapest
way on and is left (contraction), until the path reaches a goal. Origins are taken from the end of the lattice
backwards, so that a path only has to reach a node already known to lead on at its price. Every cheapest path then
consists of tight arcs (cost equals the fall of the price) and is traced by taking the least letter at each node.

Conversations of bounded size are solved by one task each. Longer ones are dealt out by ranges of their turns and cut into
pieces; a piece is solved between every two states, and the pieces' costs are joined from the last to the first. Equal
costs between the same states can't have one's edits begin with the other's, so the least letters of a whole are
made of the least letters of its pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filings_audit.session import materialize

# Fixed values of the edit model.
RETURNS = " \t\n\x0b\x0c\r"  # white space
REROLE, INSERT, DELETE, CUT = 2, 2, 3, 1
NEXT = (2, 2, 3, 2)  # the state after the next turn; its role follows
ROLE = {2: "user", 3: "assistant"}
LEGAL = {"su", "ua", "au"}

ROWS, BYTES = 2048, 4 << 20  # of a conversation that one task holds
PIECE = 512  # rows of a piece of a longer one
STRIDE = 16  # rows between origins of the auction

FINE, TRUNCATED, MUST_GO = 0, 1, 2
NONE = float("inf")


def _arcs(kind: str, fault: int, state: int) -> list[tuple[str, int, int, int]]:
    """(letter, cost, rows passed, next state) in the order of the letters; ``kind``: first letter of the role, or ''."""
    on, extra = NEXT[state], CUT if fault == TRUNCATED else 0
    out = [("D", DELETE, 1, state), ("I", INSERT, 0, on)]
    if fault != MUST_GO:
        if kind == "s" and state == 0:
            out.append(("K", extra, 1, 1))
        elif kind == ROLE[on][0]:
            out.append(("K", extra, 1, on))
        out.append(("R", REROLE + extra, 1, on))
    return out


ARCS = {(kind, fault): [_arcs(kind, fault, s) for s in range(4)] for kind in ("s", "u", "a", "") for fault in range(3)}
LAST = [[("I", INSERT, 0, NEXT[s])] for s in range(4)]  # behind the last row
LEAST = {FINE: 0, TRUNCATED: CUT, MUST_GO: DELETE}


class Auction:
    """Prices of the lattice of some rows, towards the goals among the states behind the last of them."""

    def __init__(self, codes: list[tuple[str, int]], goals: set[int]):
        self.n, self.goals = len(codes), goals
        # States from which no goal can be reached, whatever the rows, are left out.
        alive = {0} if goals == {0} else {0, 1} if goals <= {0, 1} else {0, 1, 2, 3}
        self.tables = {c: [[a for a in arcs if a[3] in alive] for arcs in ARCS[c]] for c in set(codes)}
        self.levels = [self.tables[c] for c in codes] + [[[a for a in arcs if a[3] in alive] for arcs in LAST]]
        self.alive = sorted(alive)
        # To begin with, a price is what the rows to come cost at least.
        self.prices = [[0] * 4]
        for _, fault in reversed(codes):
            self.prices.append([self.prices[-1][0] + LEAST[fault]] * 4)
        self.prices.reverse()
        self.leads_on = [bytearray(4) for _ in range(self.n + 1)]
        for state in goals:
            self.leads_on[self.n][state] = 1
        for level in [*range(self.n - self.n % STRIDE, 0, -STRIDE), 0]:
            for state in self.alive:
                self._bid(level, state)

    def _bid(self, level: int, state: int) -> None:
        path = [(level, state)]
        while True:
            level, state = path[-1]
            if self.leads_on[level][state]:
                break
            cheapest, end = NONE, None
            for _, cost, passed, to in self.levels[level][state]:
                cost += self.prices[level + passed][to]
                if cost < cheapest:
                    cheapest, end = cost, (level + passed, to)
            if self.prices[level][state] < cheapest:
                self.prices[level][state] = cheapest
                if len(path) > 1:
                    path.pop()
                elif end is None:
                    return  # no way to a goal
            elif end is None:
                if len(path) == 1:
                    return
                path.pop()
            else:
                path.append(end)
        for level, state in path:
            self.leads_on[level][state] = 1

    def _trace_from(self) -> list[bytearray]:
        """Nodes from which tight arcs lead to a goal."""
        good = [bytearray(4) for _ in range(self.n + 1)]
        for level in range(self.n, -1, -1):
            prices = self.prices[level]
            for state in sorted(self.alive, key=prices.__getitem__):  # a tight Insert leads to a lower price
                good[level][state] = (level == self.n and state in self.goals) or any(
                    good[level + passed][to] and prices[state] == cost + self.prices[level + passed][to]
                    for _, cost, passed, to in self.levels[level][state]
                )
        return good

    def paths(self, origins: list[int]) -> list[tuple[int, str] | None]:
        """Cost and least letters of the cheapest path from each state before the first row; None where there is none."""
        good, out = self._trace_from(), []
        for state in origins:
            if not good[0][state]:
                out.append(None)
                continue
            cost, level, letters = self.prices[0][state], 0, []
            while not (level == self.n and state in self.goals):
                price = self.prices[level][state]
                for letter, step, passed, to in self.levels[level][state]:
                    if good[level + passed][to] and price == step + self.prices[level + passed][to]:
                        letters.append(letter)
                        level, state = level + passed, to
                        break
            out.append((cost, "".join(letters)))
        return out


def cheapest(codes: list[tuple[str, int]]) -> tuple[int, str]:
    """Cost and edits of a whole conversation."""
    return Auction(codes, {0, 3}).paths([0])[0]


def code(role: str, fault: str) -> tuple[str, int]:
    kind = role[:1] if role[:1] in ("s", "u", "a") else ""
    return kind, FINE if not fault else TRUNCATED if fault == "truncated" else MUST_GO


def edited(turns: list[tuple[str, str]], letters: str, state: int = 0) -> list[dict]:
    """The turns that the edits leave or insert, as (edit, role, text)."""
    out, at = [], 0
    for letter in letters:
        role, text = turns[at] if letter != "I" else ("", "")
        at += letter != "I"
        if letter == "D":
            continue
        state = 1 if letter == "K" and state == 0 and role[:1] == "s" else NEXT[state]
        out.append({"edit": letter, "role": role if letter == "K" else ROLE[state], "text": text})
    return out


def plain_fault(text: str) -> str:
    """The faults that a row shows by itself."""
    rest = text.rstrip(RETURNS)
    return "blank" if not rest else "" if rest[-1] in ".!?" else "truncated"


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


def _streamed(batches: Iterator[pa.RecordBatch], n_keys: int = 1) -> Iterator[tuple[tuple, tuple]]:
    """Rows of sorted batches as (key, others)."""
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        yield from zip(zip(*columns[:n_keys]), zip(*columns[n_keys:]))


def _groups(batches: Iterator[pa.RecordBatch], rows: int | None = None, size: int | None = None) -> Iterator[tuple[tuple, list[tuple]]]:
    """Neighbouring rows with one key, cut after ``rows`` rows or ``size`` characters of the last column."""
    key, held, n = None, [], 0
    for name, row in _streamed(batches):
        if held and (name != key or (rows is not None and len(held) >= rows) or (size is not None and n >= size)):
            yield key, held
            held, n = [], 0
        key = name
        held.append(row)
        n += len(row[-1]) if size is not None else 0
    if held:
        yield key, held


def _out(rows: Iterator[tuple], schema: pa.Schema, most: int = 200) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
TURNS = "array<struct<edit:string,role:string,text:string>>"
ARROW_TURNS = pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]))
STATS = ["n_blank", "n_duplicate", "n_truncated", "n_illegal", "n_turns", "least_turn", "most_turn", "first_turn", "last_turn"]


def _stats(rows: list[tuple], faults: list[str]) -> tuple:
    """Of rows (turn, role, ...) in order."""
    turns = [row[0] for row in rows if row[0] is not None]
    ends = (min(turns), max(turns)) if turns else (None, None)
    counts = [faults.count(name) for name in ("blank", "duplicate", "truncated")]
    return *counts, _illegal([row[1][:1] for row in rows]), len(set(turns)), *ends, rows[0][0], rows[-1][0]


def repair(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Two tables: a row per conversation (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit), and the repaired
    conversations in pieces (conv_id, part, piece, turns of edit, role and text), most of them one piece.

    Rows stand in the order of turn (nulls first), then role and text. A null role or text counts as one space, a null
    conv_id as an id of its own. A row's fault is the first of: blank; duplicate, if role and text stood before; truncated. A
    role that begins with none of s, u, a (or is empty) can't be kept. Other columns are not read, and an empty
    table gives empty tables. A conversation whose rows all go has a piece without turns.
    """
    blank_text = lambda c: F.coalesce(F.col(c), F.lit(" "))
    plain = rows.select(rows[conv_id].alias("conv_id"), rows[turn].cast("long").alias("turn"), rows[role].alias("role"), rows[text].alias("text"))
    plain = plain.withColumns({"role": blank_text("role"), "text": blank_text("text")})
    sizes = plain.groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size"))
    long_ones = materialize(sizes.where((F.col("n") > ROWS) | (F.col("size") > BYTES)).select(F.col("conv_id").alias("__id")), "long-conversations")
    same = plain["conv_id"].eqNullSafe(long_ones["__id"])
    kind = plain.schema["conv_id"].dataType.simpleString()
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "text"]
    small = plain.join(long_ones, same, "left_anti").repartition("conv_id").sortWithinPartitions(*order)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def whole(key: tuple, held: list[tuple]) -> tuple:
            seen: set[tuple[str, str]] = set()
            faults = []
            for _, role, text in held:
                fault = plain_fault(text)
                faults.append(fault if fault == "blank" or (role, text) not in seen else "duplicate")
                seen.add((role, text))
            cost, audit = cheapest([code(row[1], fault) for row, fault in zip(held, faults)])
            *counts, illegal, n, least, most, _, _ = _stats(held, faults)
            gaps = most - least + 1 - n if n else 0
            return *key, gaps, *counts, illegal, cost, audit, edited([row[1:] for row in held], audit)

        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return
        fields = [first.schema.field(0), *((c, pa.int64()) for c in COUNTS), ("audit", pa.string()), ("turns", ARROW_TURNS)]
        schema = pa.schema(fields)
        yield from _out((whole(*group) for group in _groups(_again(first, batches))), schema)

    counts = ", ".join(f"{c} long" for c in COUNTS)
    done = materialize(small.mapInArrow(solve, f"conv_id {kind}, {counts}, audit string, turns {TURNS}"), "conversations")
    found = done.select("conv_id", *COUNTS, "audit")
    pieces = done.select("conv_id", F.lit(0).cast("long").alias("part"), F.lit(0).cast("long").alias("piece"), "turns")
    if long_ones.isEmpty():
        return found, pieces
    more, more_pieces = _repair_long(plain.join(long_ones, same, "left_semi"), kind)
    return found.unionByName(more), pieces.unionByName(more_pieces)


def _again(first: pa.RecordBatch, rest: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield first
    yield from rest


# A node of the list of chosen pieces of a long conversation: letters, part, piece, state before it, what follows.
def _less(one: tuple | None, other: tuple | None) -> bool:
    """Whether the letters of one list come before those of the other; both are read no further than they agree."""
    a, b = "", ""
    while one is not other or a != b:
        if not a:
            if one is None:
                return bool(b) or other is not None
            a, one = one[0], one[4]
            continue
        if not b:
            if other is None:
                return False
            b, other = other[0], other[4]
            continue
        n = min(len(a), len(b))
        if a[:n] != b[:n]:
            return a[:n] < b[:n]
        a, b = a[n:], b[n:]
    return False


def _repair_long(rows: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """The same for conversations of any length: no task holds more than a piece of texts, and the letters of one
    conversation, which its row of the result holds anyway."""
    digest = F.unhex(F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text").cast("binary")))
    # Equal rows have places of their own, so that ranges can split them; one of them comes first.
    placed = materialize(rows.withColumn("digest", digest), "long-rows").withColumn("place", F.monotonically_increasing_id())
    moment = F.struct(F.col("turn").isNotNull().alias("has"), "turn", "place")
    first = placed.groupBy(F.col("conv_id").alias("f_id"), F.col("digest").alias("f_digest")).agg(F.min(moment).alias("first"), F.count("*").alias("n"))
    first = materialize(first.where("n > 1").drop("n"), "repeated-turns")
    marked = placed.join(first, placed["conv_id"].eqNullSafe(first["f_id"]) & (placed["digest"] == first["f_digest"]), "left")
    order = [F.asc("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text_start"), F.asc("digest"), F.asc("place")]
    marked = marked.select("conv_id", "turn", "role", F.coalesce(moment > F.col("first"), F.lit(False)).alias("again"), F.substring("text", 1, 1000).alias("text_start"), "digest", "place", "text")
    ranged = marked.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "again", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()

        def piece(number: int, key: tuple, held: list[tuple]) -> tuple:
            faults = [f if (f := plain_fault(text)) == "blank" or not again else "duplicate" for *_, again, text in held]
            codes = [code(row[1], fault) for row, fault in zip(held, faults)]
            ways = []
            for goal in range(4):
                for origin, way in enumerate(Auction(codes, {goal}).paths([0, 1, 2, 3])):
                    if way is not None:
                        ways.append({"before": origin, "after": goal, "cost": way[0], "letters": way[1]})
            turns = [{"edit": "", "role": row[1], "text": row[-1]} for row in held]
            return *key, part, number, *_stats(held, faults), held[0][1][:1], held[-1][1][:1], ways, turns

        batches = iter(batches)
        start = next(batches, None)
        if start is None:
            return
        ways = pa.list_(pa.struct([("before", pa.int32()), ("after", pa.int32()), ("cost", pa.int64()), ("letters", pa.string())]))
        schema = pa.schema([
            start.schema.field(0), ("part", pa.int64()), ("piece", pa.int64()), *((c, pa.int64()) for c in STATS),
            ("first_initial", pa.string()), ("last_initial", pa.string()), ("ways", ways), ("turns", ARROW_TURNS),
        ])
        groups = enumerate(_groups(_again(start, batches), PIECE, BYTES))
        yield from _out((piece(number, *group) for number, group in groups), schema, 4)

    ways = "array<struct<before:int,after:int,cost:long,letters:string>>"
    stats = ", ".join(f"{c} long" for c in STATS)
    schema = f"conv_id {kind}, part long, piece long, {stats}, first_initial string, last_initial string, ways {ways}, turns {TURNS}"
    pieces = materialize(ranged.mapInArrow(cut, schema), "pieces")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces of a conversation from the last to the first: the cheapest way on from each state, and then the choice."""

        def ended(key: tuple, best: dict, total: list, most, least, n: int) -> Iterator[tuple]:
            cost, chosen = best[0]
            letters = []
            while chosen is not None:
                some, part, piece, before, chosen = chosen
                letters.append(some)
                yield *key, part, piece, before, some, *[None] * len(COUNTS)
            blank, duplicate, truncated, illegal = total
            gaps = most - least + 1 - n if n else 0
            yield *key, None, None, None, "".join(letters), gaps, blank, duplicate, truncated, illegal, cost

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
            key = None
            for name, (part, piece, *numbers, first_initial, last_initial, ways) in _streamed(batches):
                *counts, n_turns, least, most, first_turn, last_turn = numbers
                if name != key:
                    if key is not None:
                        yield from ended(key, best, total, high, low, n)
                    key, best, total, low, high, n, later = name, {0: (0, None), 3: (0, None)}, [0] * 4, None, None, 0, None
                total = [a + b for a, b in zip(total, counts)]
                if later is not None:
                    total[3] += last_initial + later[0] not in LEGAL
                    n -= last_turn is not None and last_turn == later[1]
                n += n_turns
                low = least if low is None else low if least is None else min(low, least)
                high = most if high is None else high if most is None else max(high, most)
                later, ahead = (first_initial, first_turn), {}
                for way in ways:
                    if way["after"] not in best:
                        continue
                    cost, rest = best[way["after"]]
                    cost, node = cost + way["cost"], (way["letters"], part, piece, way["before"], rest)
                    old = ahead.get(way["before"])
                    if old is None or cost < old[0] or (cost == old[0] and _less(node, old[1])):
                        ahead[way["before"]] = cost, node
                best = ahead
            if key is not None:
                yield from ended(key, best, total, high, low, n)

        batches = iter(batches)
        start = next(batches, None)
        if start is None:
            return
        fields = [start.schema.field(0), ("part", pa.int64()), ("piece", pa.int64()), ("before", pa.int64()), ("letters", pa.string())]
        yield from _out(rows(_again(start, batches)), pa.schema([*fields, *((c, pa.int64()) for c in COUNTS)]))

    slim = pieces.drop("turns").repartition("conv_id").sortWithinPartitions("conv_id", F.desc("part"), F.desc("piece"))
    counts = ", ".join(f"{c} long" for c in COUNTS)
    joined = materialize(slim.mapInArrow(join, f"conv_id {kind}, part long, piece long, before long, letters string, {counts}"), "choices")
    found = joined.where("part IS NULL").select("conv_id", *COUNTS, F.col("letters").alias("audit"))
    chosen = joined.where("part IS NOT NULL").select("part", "piece", "before", "letters")
    fitted = pieces.select("conv_id", "part", "piece", "turns").join(chosen, ["part", "piece"]).select("conv_id", "part", "piece", "before", "letters", "turns")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            before, letters, turns = (batch.column(i).to_pylist() for i in (3, 4, 5))
            made = [edited([(t["role"], t["text"]) for t in some], way, state) for state, way, some in zip(before, letters, turns)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(made, ARROW_TURNS)], names=["conv_id", "part", "piece", "turns"])

    return found, fitted.mapInArrow(apply, f"conv_id {kind}, part long, piece long, turns {TURNS}")


def digests(pieces: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of each repaired conversation, ``role:text`` joined by line ends, as lower-case hex.

    Pieces pass through the hash one at a time, so no task holds a conversation.
    """
    kind = pieces.schema["conv_id"].dataType.simpleString()
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    pieces = pieces.select("conv_id", "part", "piece", F.size("turns").alias("n"), lines.alias("lines"))
    ordered = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece").select("conv_id", "n", "lines")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
            key, started, digest = None, False, None
            for name, (n, lines) in _streamed(batches):
                if name != key:
                    if key is not None:
                        yield *key, digest.hexdigest()
                    key, started, digest = name, False, hashlib.sha256()
                if n:
                    digest.update(("\n" if started else "").encode() + lines.encode())
                    started = True
            if key is not None:
                yield *key, digest.hexdigest()

        batches = iter(batches)
        start = next(batches, None)
        if start is not None:
            yield from _out(rows(_again(start, batches)), pa.schema([start.schema.field(0), ("repaired_sha256", pa.string())]), 2000)

    return ordered.mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text) with faults made by the CRC-32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1
    empties its text, 2 takes out its ``.!?``, 3 repeats it, 4 makes it a user's. Nulls are one space."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate(spaced("text"), ".!?", "")).otherwise(spaced("text"))
    copies = F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1)
    role = F.when(fault == 4, "user").otherwise(spaced("role"))
    made = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(1), copies)))
    return made.select("conv_id", "turn", "role", "text")
