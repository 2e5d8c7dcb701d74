"""Conversation structure repair with Four-Russians block tables.

A repaired conversation has role initials ``(s?(ua)+)?``.  Edits of its rows,
in order: Keep (0), Rerole to user or assistant (2), Delete (3; required for
blank and duplicate rows), Insert an empty user or assistant row anywhere (2);
an undeleted truncated row adds 1.  The audit is the cheapest edits' initials,
of equally cheap ones the least as ASCII.

The pattern is an automaton of four states; a row is one of nine symbols (its
initial, whether it is truncated, or that it must go).  What it costs to repair
the rest of a conversation is a vector over the states, and less its least
entry there are few such vectors.  So a block of BLOCK symbols is a lookup:
(vector behind it, block) -> (vector before it, cost).  Vectors are looked up
from the last block to the first; then, from the first to the last, each block
is expanded backward from the vector behind it, so that every step sees the
exact cost of all that follows and takes the least initial among the cheapest.
Expanded blocks are looked up too.

Spark's part: rows are counted by (conversation, turn, role, text), so copies
collapse before the shuffle; only short rows without texts are sorted by range,
so a conversation with a third of all rows lies in many segments.  A segment is
a 4 x 4 matrix of costs (min-plus), segments of one conversation are joined by
the products, and each segment writes its edits for each state it may be
entered in.  Texts are shuffled once, for the digest of the repaired text: a
sha256 runs over one conversation in order, so there a conversation is streamed
through one task, a batch at a time.

Rows are ordered by turn (nulls first), then role, then md5 of the text.  A
null id or turn is one space in the damage hash, a null role or text is one
space.  A row whose role is empty cannot be kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialise, pick

BLOCK = 4
FREE = 1 << 40                      # no way
START, SYSTEM, USER, ASSISTANT = range(4)
MUST_GO = 8                         # else 2 * initial (s, u, a, other) + truncated
INITIALS = "sua"
SPACES = " \t\n\x0b\x0c\r"
STEP = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})  # state, initial -> state
NEXT = (USER, USER, ASSISTANT, USER)  # the state after an inserted or reroled row
ENDS = (0, FREE, FREE, 0)

Vector = tuple[int, int, int, int]


# ------------------------------------------------------------ block tables

def with_inserts(v: Vector) -> Vector:
    """Least costs when rows may also be inserted before going on."""
    v = list(v)
    for _ in range(3):
        for q in range(4):
            v[q] = min(v[q], 2 + v[NEXT[q]])
    return tuple(min(x, FREE) for x in v)


def normalised(v: Vector) -> tuple[Vector, int]:
    least = min(v)
    return tuple(x - least if x < FREE else FREE for x in v), least


def step_costs(symbol: int, state: int, behind: Vector) -> list[tuple[str, int, int]]:
    """(edit, cost to the end, next state) of one row, Insert left out."""
    out = [("D", 3 + behind[state], state)]
    if symbol != MUST_GO:
        initial, truncated = INITIALS[symbol >> 1:(symbol >> 1) + 1], symbol & 1
        if initial in STEP[state] and initial:
            to = STEP[state][initial]
            out.append(("K", truncated + behind[to], to))
        out.append(("R", 2 + truncated + behind[NEXT[state]], NEXT[state]))
    return out


def before_symbol(symbol: int, behind: Vector) -> Vector:
    return with_inserts(tuple(min(c for _, c, _ in step_costs(symbol, q, behind)) for q in range(4)))


@lru_cache(maxsize=1 << 18)
def before_block(behind: Vector, block: bytes) -> tuple[Vector, int]:
    """The block table: normalised vector behind a block -> normalised vector
    before it and its cost.  Entries are made when first asked for; there are
    at most 9^BLOCK blocks and a few dozen vectors."""
    for symbol in reversed(block):
        behind = before_symbol(symbol, behind)
    return normalised(behind)


@lru_cache(maxsize=1 << 18)
def trace_block(behind: Vector, block: bytes, state: int) -> tuple[str, int]:
    """The edits of a block entered in ``state`` and the state it is left in:
    the block is expanded backward, then followed from its first symbol."""
    vectors = [behind]
    for symbol in reversed(block):
        vectors.append(before_symbol(symbol, vectors[-1]))
    vectors.reverse()
    out = []
    for i, symbol in enumerate(block):
        left = vectors[i][state]
        if left >= FREE:
            return "", state
        while True:
            ways = [(e, to) for e, cost, to in step_costs(symbol, state, vectors[i + 1]) if cost == left]
            if 2 + vectors[i][NEXT[state]] == left:
                ways.append(("I", None))
            edit, to = min(ways, key=lambda w: w[0])
            out.append(edit)
            if edit != "I":
                state = to
                break
            state, left = NEXT[state], left - 2
    return "".join(out), state


END_VECTOR = with_inserts(ENDS)


def end_edits(state: int) -> str:
    """Rows inserted behind the last one."""
    out = ""
    while ENDS[state]:
        out, state = out + "I", NEXT[state]
    return out


def blocks(symbols: bytes) -> list[bytes]:
    return [symbols[i:i + BLOCK] for i in range(0, len(symbols), BLOCK)]


def vectors_behind(symbols: bytes, behind: Vector) -> tuple[list[Vector], Vector, int]:
    """The vector behind each block, the one before the first, and the costs
    taken off, by lookups from the last block to the first."""
    vector, total = normalised(behind)
    out = []
    for block in reversed(blocks(symbols)):
        out.append(vector)
        vector, cost = before_block(vector, block)
        total += cost
    return out[::-1], vector, total


def trace(symbols: bytes, behind: list[Vector], state: int) -> tuple[str, int]:
    parts = []
    for block, vector in zip(blocks(symbols), behind):
        edits, state = trace_block(vector, block, state)
        parts.append(edits)
    return "".join(parts), state


def repair(symbols: bytes) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    behind, vector, cost = vectors_behind(symbols, END_VECTOR)
    edits, state = trace(symbols, behind, START)
    return cost + vector[START], edits + end_edits(state)


def segment_matrix(symbols: bytes) -> list[int]:
    """Least cost from each state before a segment to each state behind it."""
    columns = []
    for q in range(4):
        unit = with_inserts(tuple(0 if s == q else FREE for s in range(4)))
        _, vector, cost = vectors_behind(symbols, unit)
        columns.append([x + cost if x < FREE else FREE for x in vector])
    return [columns[q][p] for p in range(4) for q in range(4)]


def before_segment(matrix: list[int], behind: Vector) -> Vector:
    return tuple(min(FREE, *(matrix[4 * p + q] + behind[q] for q in range(4))) for p in range(4))


# ------------------------------------------------------------ rows

def damaged(conversations: DataFrame) -> DataFrame:
    """Every row with its fate: ``copies`` (0: dropped, 2: repeated), and role
    and text after the damage; conv_id and turn keep their nulls."""
    text_or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(text_or_space("conv_id"), F.lit(":"), text_or_space("turn")).cast("binary")) % 20
    rows = pick(conversations, conv_id="long", turn="long", role="string", text="string")
    return rows.select(
        "conv_id", "turn",
        F.when(fate == 4, "user").otherwise(text_or_space("role")).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.translate(text_or_space("text"), ".!?", "")).otherwise(text_or_space("text")).alias("text"),
        F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).cast("long").alias("copies"))


def position() -> Column:
    """The order of rows in a conversation."""
    return F.struct(F.col("turn").isNotNull().alias("has_turn"), "turn", "role", "text_md5")


def sort_key() -> list[Column]:
    return [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text_md5")]


def short_rows(rows: DataFrame) -> DataFrame:
    """One row for each (conversation, turn, role, text) without its text: how
    many copies are left, its initial, and the first turn of this role and text."""
    bare = F.rtrim("text", F.lit(SPACES))
    each = rows.select("conv_id", "turn", "role", F.md5(F.col("text").cast("binary")).alias("text_md5"), "copies",
                       (bare == "").alias("blank"), (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("open_end"))
    counted = each.groupBy("conv_id", "turn", "role", "text_md5").agg(
        F.sum("copies").alias("copies"), F.first("blank").alias("blank"), F.first("open_end").alias("open_end"))
    counted = materialise(counted, "repair-rows")
    key = [F.struct("conv_id").alias("conv"), "role", "text_md5"]  # a struct is null-safe as a key
    first = (counted.filter("copies > 0").groupBy(*key)
             .agg(F.min(F.struct(F.col("turn").isNotNull().alias("has_turn"), "turn")).alias("first")))
    later = F.struct(F.col("turn").isNotNull().alias("has_turn"), "turn") > F.col("first")
    initial = F.substring("role", 1, 1)
    number = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return (counted.withColumn("conv", F.struct("conv_id")).join(first, ["conv", "role", "text_md5"], "left")
            .select("conv_id", "turn", "role", "text_md5", "copies", "blank",
                    F.coalesce(later, F.lit(False)).alias("repeat"), "open_end", number.alias("initial")))


SEGMENT = pa.schema([("conv_id", pa.int64()), ("segment", pa.int64()), ("symbols", pa.binary()), ("matrix", pa.list_(pa.int64())),
                     ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("turns", pa.int64()), ("blank", pa.int64()),
                     ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("ends", pa.list_(pa.int64()))])
SEGMENT_DDL = ("conv_id long, segment long, symbols binary, matrix array<long>, first_turn long, last_turn long, turns long, "
               "blank long, duplicate long, truncated long, illegal long, ends array<long>")
LEGAL = {(0, 1), (1, 2), (2, 1)}


def describe_segment(rows: list[dict]) -> dict:
    """Symbols and counts of a segment's rows, in order."""
    symbols, turns, initials = bytearray(), [], []
    blank = duplicate = truncated = illegal = 0
    for row in rows:
        n = row["copies"]
        if not n:
            continue
        if row["turn"] is not None and (not turns or turns[-1] != row["turn"]):
            turns.append(row["turn"])
        if row["blank"]:
            blank += n
            symbols += bytes([MUST_GO]) * n
        elif row["repeat"]:
            duplicate += n
            symbols += bytes([MUST_GO]) * n
        else:
            duplicate += n - 1
            truncated += row["open_end"]
            symbols.append(2 * row["initial"] + row["open_end"])
            symbols += bytes([MUST_GO]) * (n - 1)
        illegal += (n - 1) + (bool(initials) and (initials[-1], row["initial"]) not in LEGAL)
        initials = [*initials[:1], row["initial"]]
    return {"symbols": bytes(symbols), "turns": len(turns), "first_turn": turns[0] if turns else None,
            "last_turn": turns[-1] if turns else None, "blank": blank, "duplicate": duplicate, "truncated": truncated,
            "illegal": illegal, "ends": [initials[0], initials[-1]] if initials else []}


def segments(rows: DataFrame, ranges: int | None = None) -> DataFrame:
    """The rows of each conversation in order, cut where the range partitions
    of the whole table end (``ranges`` of them, else as many as the session and
    adaptive execution make); written, so that numbers stay."""
    packed = (rows.repartitionByRange(*([ranges] if ranges else []), *sort_key()).withColumn("segment", F.spark_partition_id().cast("long"))
              .groupBy("conv_id", "segment")
              .agg(F.sort_array(F.collect_list(F.struct(
                  F.col("turn").isNotNull().alias("has_turn"), "turn", "role", "text_md5", "copies", "blank", "repeat",
                  F.col("open_end").cast("int").alias("open_end"), "initial"))).alias("rows"))
              .select("conv_id", "segment", F.transform("rows", lambda r: F.struct(
                  r["turn"].alias("turn"), r["copies"].alias("copies"), r["blank"].alias("blank"), r["repeat"].alias("repeat"),
                  r["open_end"].alias("open_end"), r["initial"].alias("initial"))).alias("rows")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict = {name: [] for name in SEGMENT.names}
            for conv_id, segment, rows in zip(*(c.to_pylist() for c in batch.columns)):
                values = describe_segment(rows) | {"conv_id": conv_id, "segment": segment}
                values["matrix"] = None
                for name in out:
                    out[name].append(values[name])
            yield pa.RecordBatch.from_pydict(out, schema=SEGMENT)

    return materialise(packed.mapInArrow(run, SEGMENT_DDL), "repair-segments")


def gap_count(first: int | None, last: int | None, turns: int) -> int:
    return 0 if first is None else last - first + 1 - turns


REPAIRS = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
REPAIRS_ARROW = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                           ("audit", pa.string())])


def repair_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations of one segment."""
    for batch in batches:
        out: dict = {name: [] for name in REPAIRS_ARROW.names}
        for row in batch.to_pylist():
            row["cost"], row["audit"] = repair(row["symbols"])
            row["gaps"] = gap_count(row["first_turn"], row["last_turn"], row["turns"])
            for name in out:
                out[name].append(row[name])
        yield pa.RecordBatch.from_pydict(out, schema=REPAIRS_ARROW)


def with_matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [row | {"matrix": segment_matrix(row["symbols"])} for row in batch.to_pylist()]
        yield pa.RecordBatch.from_pylist(rows, schema=SEGMENT)


BOUNDARY_ARROW = pa.schema([("conv_id", pa.int64()), ("segment", pa.int64()), ("behind", pa.list_(pa.int64()))])


def vectors_of_segments(table: pa.Table) -> pa.Table:
    """The vector behind every segment of one conversation, from its last."""
    rows = sorted(table.select(["conv_id", "segment", "matrix"]).to_pylist(), key=lambda r: r["segment"])
    behind, out = END_VECTOR, []
    for row in reversed(rows):
        out.append({"conv_id": row["conv_id"], "segment": row["segment"], "behind": list(behind)})
        behind = before_segment(row["matrix"], behind)
    return pa.Table.from_pylist(out, schema=BOUNDARY_ARROW)


WAYS = "conv_id long, segment long, before array<long>, edits array<string>, leaves array<long>"
WAYS_ARROW = pa.schema([("conv_id", pa.int64()), ("segment", pa.int64()), ("before", pa.list_(pa.int64())),
                        ("edits", pa.list_(pa.string())), ("leaves", pa.list_(pa.int64()))])


def ways_through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each segment: the cost to the end, the edits and the state behind it,
    for every state that it may be entered in."""
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            behind, vector, cost = vectors_behind(row["symbols"], tuple(row["behind"]))
            ways = [trace(row["symbols"], behind, q) for q in range(4)]
            rows.append({"conv_id": row["conv_id"], "segment": row["segment"], "before": [x + cost if x < FREE else FREE for x in vector],
                         "edits": [w[0] for w in ways], "leaves": [w[1] for w in ways]})
        yield pa.RecordBatch.from_pylist(rows, schema=WAYS_ARROW)


def join_segments(table: pa.Table) -> pa.Table:
    """One conversation's result from its segments."""
    rows = sorted(table.to_pylist(), key=lambda r: r["segment"])
    state, parts, turns, illegal, last_turn, last = START, [], 0, 0, None, None
    for row in rows:
        parts.append(row["edits"][state])
        state = row["leaves"][state]
        turns += row["turns"] - (last_turn is not None and row["first_turn"] == last_turn)
        last_turn = row["last_turn"] if row["last_turn"] is not None else last_turn
        illegal += row["illegal"]
        if row["ends"]:
            illegal += last is not None and (last, row["ends"][0]) not in LEGAL
            last = row["ends"][1]
    first_turn = next((r["first_turn"] for r in rows if r["first_turn"] is not None), None)
    totals = {c: sum(r[c] for r in rows) for c in ("blank", "duplicate", "truncated")}
    return pa.Table.from_pylist([{"conv_id": rows[0]["conv_id"], "gaps": gap_count(first_turn, last_turn, turns), **totals,
                                  "illegal": illegal, "cost": rows[0]["before"][START], "audit": "".join(parts) + end_edits(state)}],
                                schema=REPAIRS_ARROW)


def repairs(rows: DataFrame, ranges: int | None = None) -> DataFrame:
    """Counts, cost and audit of every conversation of :func:`damaged` rows
    (or any rows of these columns): an original conversation without rows left
    has zeros and no edits."""
    cut = segments(short_rows(rows), ranges)
    conv = F.struct("conv_id")
    many = materialise(cut.groupBy(conv.alias("conv")).agg(F.count("*").alias("pieces")).filter("pieces > 1").select("conv"), "long-conversations")
    whole = cut.withColumn("conv", conv).join(many, "conv", "left_anti").drop("conv").mapInArrow(repair_whole, REPAIRS)
    long = cut.withColumn("conv", conv).join(many, "conv", "left_semi").drop("conv")
    long = materialise(long.mapInArrow(with_matrices, SEGMENT_DDL), "long-segments")
    behind = long.groupBy("conv_id").applyInArrow(vectors_of_segments, "conv_id long, segment long, behind array<long>")
    key = [F.struct("conv_id", "segment").alias("at")]
    ways = (long.select(*key, "*").join(behind.select(*key, "behind"), "at").drop("at").mapInArrow(ways_through, WAYS))
    facts = long.select(*key, "first_turn", "last_turn", "turns", "blank", "duplicate", "truncated", "illegal", "ends")
    joined = ways.withColumn("at", F.struct("conv_id", "segment")).join(facts, "at").drop("at").groupBy("conv_id").applyInArrow(join_segments, REPAIRS)
    return whole.unionByName(joined)


# ------------------------------------------------------------ repaired texts

DIGESTS = REPAIRS + ", repaired_sha256 string"
DIGESTS_ARROW = pa.schema([*REPAIRS_ARROW, ("repaired_sha256", pa.string())])


class Replay:
    """Follows an audit over a conversation's rows and gives the repaired rows."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            self.state = NEXT[self.state]
            yield ("assistant" if self.state == ASSISTANT else "user"), ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "K":
            self.state = STEP[self.state][role[0]]
            yield role, text
        elif edit == "R":
            self.state = NEXT[self.state]
            yield ("assistant" if self.state == ASSISTANT else "user"), text


def repaired_rows(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """(role, text) of the repaired conversation."""
    replay = Replay(audit)
    for role, text in rows:
        yield from replay.row(role, text)
    yield from replay.inserted()


def digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` with the sha256 of each repaired conversation.  A task reads
    whole conversations in order, the repair first, and holds one audit and one
    batch."""
    names = [c.split()[0] for c in REPAIRS.split(", ")]
    texts = rows.filter("copies > 0").select(
        "conv_id", F.lit(1).alias("kind"), "turn", "role", F.md5(F.col("text").cast("binary")).alias("text_md5"), "text", "copies",
        *(F.lit(None).cast("string" if c == "audit" else "long").alias(c) for c in names[1:]))
    heads = found.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                         F.lit("").alias("text_md5"), F.lit(None).cast("string").alias("text"), F.lit(0).cast("long").alias("copies"), *names[1:])
    ordered = (heads.unionByName(texts).repartition("conv_id")
               .sortWithinPartitions(F.asc_nulls_first("conv_id"), "kind", *sort_key()[1:]).drop("text_md5", "turn"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, replay, digest, lines = None, None, None, 0
        out: dict = {name: [] for name in DIGESTS_ARROW.names}

        def put(pairs: Iterator[tuple[str, str]]) -> None:
            nonlocal lines
            for role, text in pairs:
                digest.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
                lines += 1

        def finish() -> None:
            if head is not None:
                put(replay.inserted())
                for name in REPAIRS_ARROW.names:
                    out[name].append(head[name])
                out["repaired_sha256"].append(digest.hexdigest())

        for batch in batches:
            columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            kinds, copies = columns["kind"].to_pylist(), columns["copies"].to_pylist()
            for i in range(batch.num_rows):
                if not kinds[i]:
                    finish()
                    head = {name: columns[name][i].as_py() for name in REPAIRS_ARROW.names}
                    replay, digest, lines = Replay(head["audit"]), hashlib.sha256(), 0
                else:
                    role, text = columns["role"][i].as_py(), columns["text"][i].as_py()
                    for _ in range(copies[i]):
                        put(replay.row(role, text))
            yield pa.RecordBatch.from_pydict(out, schema=DIGESTS_ARROW)
            out = {name: [] for name in DIGESTS_ARROW.names}
        finish()
        yield pa.RecordBatch.from_pydict(out, schema=DIGESTS_ARROW)

    return ordered.mapInArrow(run, DIGESTS)


def repair_conversations(conversations: DataFrame, ranges: int | None = None) -> DataFrame:
    """Damage, then repair every conversation: conv_id, gaps, blank, duplicate,
    truncated, illegal, cost, audit, repaired_sha256."""
    rows = damaged(conversations)
    return digests(rows, materialise(repairs(rows, ranges), "repairs"))
