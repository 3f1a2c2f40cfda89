"""Repair of the turn structure of conversations: the cheapest edits, by bidirectional Dijkstra over the edit lattice.

A repaired conversation has role initials ``(s?(ua)+)?``. Edits: keep a turn (0), give it the role user or assistant (3), delete it (4; a must
for blank and duplicate turns), insert an empty turn of user or assistant anywhere (3). A truncated turn that stays costs 3 more. The audit
is the string of edits K, R, D, I in order; of the cheapest repairs the one with the least audit counts.

Method. A node of the lattice is (turns read, roles so far: none, s, u, a). Forward and reverse heaps grow until no cheaper crossing is
possible; every node and edge at which cheapest halves meet gives an audit, and the least one wins. Nodes of equal cost leave the heaps in order
of turns read, so their least audits are final; audits of one cost up to one node never begin with each other, so least parts make a least whole.
Long conversations are cut into blocks of ``BLOCK`` turns: the cheapest audit of a block for each pair of roles at its borders comes from the
same search, and pairs of blocks are joined to larger ones. The search sees one letter a turn, and its results are kept for equal strings.

Distribution. Rows are dealt by ranges of (conversation, turn, role, hash of the text, number of the row) and sorted, so a conversation with
a third of all rows is spread over many tasks. Duplicates are known before, from one aggregate by conversation and content, made partly
before its shuffle. Each task repairs the conversations that lie inside it; those at its borders, and those over ``CHUNK`` rows or bytes at a time, give
their counts, block audits and turns in chunks. A task a conversation then joins the audits and streams the chunks, as a checksum of a whole
text must; it holds one chunk and the audit.

Cases: null roles and texts are one blank (a blank text is deleted, a blank role fits nothing); null turns come first; turns with equal numbers
go by role, then hash of the text; a null conversation id is a conversation; empty conversations have an empty repair; an empty table
gives no rows. Extra columns are not read and cannot clash.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import stage
from .base import query, read

BLOCK = 96
#: Rows and characters that are held of one conversation before they are passed on.
CHUNK_ROWS, CHUNK_CHARS = 2000, 100_000
SPACE = " \t\n\x0b\x0c\r"

#: Roles so far: 0 none, 1 system, 2 user, 3 assistant. What a kept turn of an initial, and a turn of a role of choice, leads to.
KEEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
CHOICE = (2, 2, 3, 2)
COMPLETE = (0, 3)
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
ROLE = {2: "user", 3: "assistant"}
#: A turn that must go.
GONE = "-"


def row_edges(symbol: str) -> list[tuple[int, int, int, str]]:
    """Edges over a turn: roles before, roles after, cost, edit. Letters: its initial or x, capital if truncated; ``-`` must go."""
    edges = [(q, q, DELETE, "D") for q in range(4)]
    if symbol != GONE:
        more = TRUNCATED if symbol.isupper() else 0
        edges += [(q, CHOICE[q], REROLE + more, "R") for q in range(4)]
        edges += [(q, KEEP[q, symbol.lower()], more, "K") for q in range(4) if (q, symbol.lower()) in KEEP]
    return edges


INSERTS = [(q, CHOICE[q], INSERT, "I") for q in range(4)]
OUT = {s: [[e[1:] for e in row_edges(s) if e[0] == q] for q in range(4)] for s in "-suaxSUAX"}
INTO = {s: [[(e[0], *e[2:]) for e in row_edges(s) if e[1] == q] for q in range(4)] for s in "-suaxSUAX"}
INSERT_OUT = [[e[1:] for e in INSERTS if e[0] == q] for q in range(4)]
INSERT_INTO = [[(e[0], *e[2:]) for e in INSERTS if e[1] == q] for q in range(4)]


@lru_cache(maxsize=1 << 15)
def cheapest(symbols: str, entry: int, exits: tuple[int, ...]) -> tuple[int, str] | None:
    """Least cost, and the least audit of that cost, from roles ``entry`` before the turns to one of ``exits`` after them."""
    n = len(symbols)

    def leaving(node: int) -> Iterator[tuple[int, int, str]]:
        i, q = divmod(node, 4)
        for to, cost, edit in INSERT_OUT[q]:
            yield node - q + to, cost, edit
        if i < n:
            for to, cost, edit in OUT[symbols[i]][q]:
                yield node - q + 4 + to, cost, edit

    def entering(node: int) -> Iterator[tuple[int, int, str]]:
        i, q = divmod(node, 4)
        for of, cost, edit in INSERT_INTO[q]:
            yield node - q + of, cost, edit
        if i:
            for of, cost, edit in INTO[symbols[i - 1]][q]:
                yield node - q - 4 + of, cost, edit

    labels = ({entry: (0, "")}, {4 * n + q: (0, "") for q in exits})
    heaps = ([(0, 0, entry)], [(0, 0, 4 * n + q) for q in exits])
    done: tuple[dict, dict] = ({}, {})
    best = float("inf")
    while heaps[0] or heaps[1]:
        front = [heap[0][0] if heap else None for heap in heaps]
        if None in front:
            side = 0 if front[1] is None else 1
            if front[side] > best:
                break
        else:
            # Cheapest halves may meet anywhere: both sides finish cost 0, then go on while a crossing can be as cheap as the best.
            if min(front) > 0 and sum(front) > best:
                break
            side = 0 if front[0] <= front[1] else 1
        cost, _, node = heapq.heappop(heaps[side])
        if node in done[side]:
            continue
        cost, audit = done[side][node] = labels[side][node]
        if node in labels[1 - side]:
            best = min(best, cost + labels[1 - side][node][0])
        for other, more, edit in entering(node) if side else leaving(node):
            label = (cost + more, edit + audit if side else audit + edit)
            if other not in done[side] and (other not in labels[side] or label < labels[side][other]):
                labels[side][other] = label
                heapq.heappush(heaps[side], (label[0], n - other // 4 if side else other // 4, other))
            if other in labels[1 - side]:
                best = min(best, label[0] + labels[1 - side][other][0])
    found = [(c + done[1][node][0], a + done[1][node][1]) for node, (c, a) in done[0].items() if node in done[1]]
    for node, (c, a) in done[0].items():
        for other, more, edit in leaving(node):
            if other in done[1]:
                found.append((c + more + done[1][other][0], a + edit + done[1][other][1]))
    return min(found, default=None)


Paths = dict[tuple[int, int], tuple[int, str]]


def joined(left: Paths, right: Paths) -> Paths:
    """Cheapest audits over two pieces that follow each other."""
    out: Paths = {}
    for (a, b), (c1, s1) in left.items():
        for (b2, d), (c2, s2) in right.items():
            if b == b2 and (a, d) in out and out[a, d][0] < c1 + c2:
                continue
            if b == b2:
                label = (c1 + c2, s1 + s2)
                out[a, d] = min(out.get((a, d), label), label)
    return out


def paths(symbols: str) -> Paths:
    """Cheapest audits over any number of turns, for each pair of roles before and after."""
    level = []
    for at in range(0, max(1, len(symbols)), BLOCK):
        block = symbols[at:at + BLOCK]
        found = {(a, b): cheapest(block, a, (b,)) for a in range(4) for b in range(4)}
        level.append({k: v for k, v in found.items() if v})
    return reduced(level)


def reduced(level: list[Paths]) -> Paths:
    """Neighbours are joined two by two, so no audit is copied more often than the logarithm of the pieces."""
    while len(level) > 1:
        level = [joined(*level[k:k + 2]) if k + 1 < len(level) else level[k] for k in range(0, len(level), 2)]
    return level[0]


def complete(found: Paths) -> tuple[int, str]:
    return min(v for (a, b), v in found.items() if a == 0 and b in COMPLETE)


def repair(symbols: str) -> tuple[int, str]:
    """Cost and audit of a conversation."""
    return cheapest(symbols, 0, COMPLETE) if len(symbols) <= BLOCK else complete(paths(symbols))


class Repaired:
    """Turns go in, in order; the turns of the repaired conversation come out, and a running checksum of them."""

    def __init__(self, audit: str):
        self.audit, self.at, self.roles, self.places = audit, 0, 0, 0
        self.sha = hashlib.sha256()

    def _out(self, role: str, text: str) -> tuple[str, str]:
        self.sha.update((f"\n{role}:{text}" if self.places else f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.places += 1
        return role, text

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            self.roles = CHOICE[self.roles]
            yield self._out(ROLE[self.roles], "")

    def turn(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.roles = KEEP[self.roles, role[:1]]
            yield self._out(role, text)
        elif edit == "R":
            self.roles = CHOICE[self.roles]
            yield self._out(ROLE[self.roles], text)


LEGAL = {"su", "ua", "au"}


class Piece:
    """What is known of a conversation from some of its turns in order: counts, ends and one letter a turn."""

    def __init__(self) -> None:
        self.blank = self.duplicate = self.truncated = self.illegal = self.numbers = 0
        self.first = self.last = None  # initials
        self.low = self.high = None  # turn numbers
        self.symbols: list[str] = []

    def add(self, turn: int | None, role: str, text: str, again: bool) -> None:
        initial, body = role[:1], text.rstrip(SPACE)
        symbol = initial if initial in ("s", "u", "a") else "x"
        if not body:
            self.blank += 1
            symbol = GONE
        elif again:
            self.duplicate += 1
            symbol = GONE
        elif body[-1] not in ".!?":
            self.truncated += 1
            symbol = symbol.upper()
        self.symbols.append(symbol)
        if self.last is None:
            self.first = initial
        elif self.last + initial not in LEGAL:
            self.illegal += 1
        self.last = initial
        if turn is not None:
            self.numbers += turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn

    def follow(self, later: Piece) -> None:
        """Take in the counts of the turns that come next."""
        self.blank += later.blank
        self.duplicate += later.duplicate
        self.truncated += later.truncated
        self.illegal += later.illegal
        if later.last is not None:
            self.illegal += self.last is not None and self.last + later.first not in LEGAL
            self.first = later.first if self.last is None else self.first
            self.last = later.last
        if later.high is not None:
            self.numbers += later.numbers - (self.high == later.low)
            self.low = later.low if self.low is None else self.low
            self.high = later.high

    def report(self, cost: int, done: Repaired) -> dict:
        gaps = self.high - self.low + 1 - self.numbers if self.numbers else 0
        return {"gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal,
                "cost": cost, "audit": done.audit, "repaired_sha256": done.sha.hexdigest(), "n_repaired": done.places}


#: Kinds of records between the two steps. Their numbers are the order in which the second step reads them.
REPORT, PIECE, TURNS, REPAIRED = range(4)
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "n_repaired"]
HELD = ["first", "last", "low", "high", "numbers"]


def record_schema(id_col: str, id_type: T.DataType) -> T.StructType:
    path = T.StructType([T.StructField("before", T.IntegerType()), T.StructField("after", T.IntegerType()),
                         T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType())])
    texts = T.ArrayType(T.StringType())
    return T.StructType([
        T.StructField(id_col, id_type), T.StructField("_kind", T.IntegerType()), T.StructField("_part", T.IntegerType()),
        T.StructField("_chunk", T.LongType()), *[T.StructField(c, T.LongType()) for c in COUNTS],
        T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType()),
        T.StructField("_first", T.StringType()), T.StructField("_last", T.StringType()), T.StructField("_low", T.LongType()),
        T.StructField("_high", T.LongType()), T.StructField("_numbers", T.LongType()), T.StructField("_paths", T.ArrayType(path)),
        T.StructField("_roles", texts), T.StructField("_texts", texts)])


def repaired_chunks(done: Repaired, turns: Iterator[tuple[str, str]], wanted: bool) -> Iterator[dict]:
    """Run the turns through; give them in chunks where they are wanted."""
    first, roles, texts = done.places, [], []
    for role, text in turns:
        if wanted:
            roles.append(role)
            texts.append(text)
            if len(roles) >= CHUNK_ROWS:
                yield {"_kind": REPAIRED, "_chunk": first, "_roles": roles, "_texts": texts}
                first, roles, texts = done.places, [], []
    if roles:
        yield {"_kind": REPAIRED, "_chunk": first, "_roles": roles, "_texts": texts}


class Conversation:
    """The turns of one conversation that a task of the first step sees."""

    def __init__(self, key, border: bool, wanted: bool, chunk_rows: int):
        self.key, self.border, self.wanted, self.chunk_rows = key, border, wanted, chunk_rows
        self.piece, self.roles, self.texts, self.chars, self.chunks = Piece(), [], [], 0, 0

    def add(self, turn, role, text, again) -> Iterator[dict]:
        self.piece.add(turn, role, text, again)
        self.roles.append(role)
        self.texts.append(text)
        self.chars += len(role) + len(text)
        if len(self.roles) >= self.chunk_rows or self.chars >= CHUNK_CHARS:
            yield self._pass_on()

    def _pass_on(self) -> dict:
        self.border = True
        out = {"_kind": TURNS, "_chunk": self.chunks, "_roles": self.roles, "_texts": self.texts}
        self.chunks += 1
        self.roles, self.texts, self.chars = [], [], 0
        return out

    def end(self) -> Iterator[dict]:
        symbols = "".join(self.piece.symbols)
        if self.border:
            if self.roles:
                yield self._pass_on()
            p = self.piece
            yield {"_kind": PIECE, "_chunk": 0, "blank": p.blank, "duplicate": p.duplicate, "truncated": p.truncated, "illegal": p.illegal,
                   **{f"_{c}": getattr(p, c) for c in HELD},
                   "_paths": [{"before": a, "after": b, "cost": c, "audit": s} for (a, b), (c, s) in paths(symbols).items()]}
            return
        cost, audit = repair(symbols)
        done = Repaired(audit)
        yield from repaired_chunks(done, result(done, zip(self.roles, self.texts)), self.wanted)
        yield {"_kind": REPORT, **self.piece.report(cost, done)}


def result(done: Repaired, turns) -> Iterator[tuple[str, str]]:
    for role, text in turns:
        yield from done.turn(role, text)
    yield from done.inserted()


def batches_of(records: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for r in records:
        rows.append(r)
        size += 1 + len(r.get("_roles") or ())
        if len(rows) >= 2000 or size >= CHUNK_ROWS:
            yield pa.RecordBatch.from_pylist(rows, schema)
            rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema)


def first_step(batches: Iterator[pa.RecordBatch], id_col: str, wanted: bool, chunk_rows: int) -> Iterator[dict]:
    """Conversations inside the task, whole; the first and the last, and large ones, in pieces."""
    part, now, started = TaskContext.get().partitionId(), None, False
    for batch in batches:
        for key, turn, role, text, present, again in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or key != now.key:
                if now is not None:
                    for r in now.end():
                        yield {id_col: now.key, "_part": part, **r}
                now, started = Conversation(key, not started, wanted, chunk_rows), True
            if present:
                for r in now.add(turn, role, text, again):
                    yield {id_col: key, "_part": part, **r}
    if now is not None:
        now.border = True
        for r in now.end():
            yield {id_col: now.key, "_part": part, **r}


def second_step(batches: Iterator[pa.RecordBatch], id_col: str, wanted: bool) -> Iterator[dict]:
    """Conversations from their pieces, then their turns, in order."""
    rows = (r for batch in batches for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist())
    key, whole, found, done, cost = None, None, [], None, 0

    def begin() -> None:
        nonlocal done, cost
        if done is None:
            cost, audit = complete(reduced(found))
            done = Repaired(audit)
            found.clear()

    def finish() -> Iterator[dict]:
        begin()
        for r in repaired_chunks(done, done.inserted(), wanted):
            yield {id_col: key, **r}
        yield {id_col: key, "_kind": REPORT, **whole.report(cost, done)}

    for r in rows:
        if whole is None or r[id_col] != key:
            if whole is not None:
                yield from finish()
            key, whole, found, done = r[id_col], Piece(), [], None
        if r["_kind"] == PIECE:
            piece = Piece()
            for c in ("blank", "duplicate", "truncated", "illegal"):
                setattr(piece, c, r[c])
            for c in HELD:
                setattr(piece, c, r[f"_{c}"])
            whole.follow(piece)
            found.append({(p["before"], p["after"]): (p["cost"], p["audit"]) for p in r["_paths"]})
        else:
            begin()
            turns = (x for role, text in zip(r["_roles"], r["_texts"]) for x in done.turn(role, text))
            for x in repaired_chunks(done, turns, wanted):
                yield {id_col: key, **x}
    if whole is not None:
        yield from finish()


def records(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
            present: str | None = None, wanted: bool = True, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Reports of all conversations and, if ``wanted``, their repaired turns in chunks; stored."""
    blank = F.lit(" ")
    there = F.coalesce(F.col(present), F.lit(False)) if present else F.lit(True)
    rows = rows.select(
        F.col(conv).alias("_conv"), F.col(turn).cast("long").alias("_turn"), F.coalesce(role, blank).alias("_role"),
        F.coalesce(text, blank).alias("_text"), there.alias("_there"), F.monotonically_increasing_id().alias("_row"))
    rows = stage(rows.withColumns({"_h1": F.xxhash64("_role", "_text"), "_h2": F.xxhash64(F.lit(1), "_role", "_text")}), "turns")
    group = ["_conv", "_h1", "_h2"]
    again = rows.where("_there").groupBy(*group).agg(
        F.min(F.struct("_turn", "_row")).alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    again = again.select(*[F.col(c).alias(f"{c}g") for c in group], "_first")
    same = F.col("_conv").eqNullSafe(F.col("_convg")) & (F.col("_h1") == F.col("_h1g")) & (F.col("_h2") == F.col("_h2g"))
    flagged = rows.join(again, same, "left")
    flag = F.col("_first").isNotNull() & ~F.struct("_turn", "_row").eqNullSafe(F.col("_first"))
    order = [F.col(c).asc_nulls_first() for c in ("_conv", "_turn", "_role", "_h1", "_h2", "_row")]
    dealt = flagged.select("_conv", "_turn", "_role", "_text", "_there", "_row", "_h1", "_h2", flag.alias("_again"))
    dealt = dealt.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = record_schema(conv, rows.schema["_conv"].dataType)
    arrow = to_arrow_schema(schema)
    step = dealt.select("_conv", "_turn", "_role", "_text", "_there", "_again").mapInArrow(
        lambda batches: batches_of(first_step(batches, conv, wanted, chunk_rows), arrow), schema)
    found = stage(step, "conversation_records")
    whole = found.where(F.col("_kind").isin(REPORT, REPAIRED))
    pieces = found.where(F.col("_kind").isin(PIECE, TURNS)).repartition(F.col(conv)).sortWithinPartitions(
        F.col(conv).asc_nulls_first(), "_kind", "_part", "_chunk")
    return whole.unionByName(pieces.mapInArrow(lambda batches: batches_of(second_step(batches, conv, wanted), arrow), schema))


def reports(found: DataFrame, conv: str = "conv_id") -> DataFrame:
    """A row a conversation: faults, cost, audit, checksum of the repaired text and number of its turns."""
    return found.where(F.col("_kind") == REPORT).select(conv, *COUNTS[:-1], "audit", "repaired_sha256", "n_repaired")


def repaired_turns(found: DataFrame, conv: str = "conv_id") -> DataFrame:
    """The turns of the repaired conversations: conversation, place from 0, role and text."""
    turns = found.where(F.col("_kind") == REPAIRED).select(conv, "_chunk", F.posexplode(F.arrays_zip("_roles", "_texts")).alias("_at", "_turn"))
    return turns.select(conv, (F.col("_chunk") + F.col("_at")).alias("place"),
                        F.col("_turn._roles").alias("role"), F.col("_turn._texts").alias("text"))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults by the checksum of ``conv_id:turn``; ``_present`` is false for a row that is dropped."""
    blank = F.lit(" ")
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")])
    fault = F.pmod(F.crc32(name.cast("binary")), F.lit(20))
    rows = rows.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
                       fault.alias("_fault"))
    text = F.when(F.col("_fault") == 1, "").when(F.col("_fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("_fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        (F.col("_fault") != 0).alias("_present"),
        F.explode(F.when(F.col("_fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"))


@query("op13_conversation_repair")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """The cheapest repair of every conversation after damage."""
    return reports(records(damaged(read(spark, folder, "conversations")), present="_present", wanted=False))
