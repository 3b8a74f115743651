"""Repair of conversation structure by a dynamic programme with square-root checkpoints.

A conversation's role initials shall read ``(s?(ua)+)?``. Each row is kept (cost 0), given the
role user or assistant (1) or deleted (2, the only choice for a blank row or a duplicate), and
empty rows of either role may be inserted anywhere (5); a row with a truncated text that is not
deleted costs 5 more. Of the cheapest edit sequences the one with the ASCII-least letters
(D, I, K, R) is taken. A state is what came last: nothing (0), s (1), u (2) or a (3); it leaves one role
only for an inserted or changed row, so letters determine the repair.

**Order.** Rows are range-partitioned by conversation, turn (nulls first), role and the text's hash, and
numbered in that order, so that a long conversation spans many tasks. A repeated (role, text) is
found by an aggregate of first numbers, which meets the rows on the number: no key is hot.

**Checkpoints.** Rows are cut into blocks of about the square root of the longest conversation
(``LEAST_BLOCK`` rows at least), each a short text of one letter a row. A task turns a block into the 4 x 4 costs of
getting from state to state; folded backwards over a conversation's blocks, which are as few as
a block's rows, they give the vector of costs to the end behind each block. Only these are stored.
Then one stream over a conversation's blocks and rows, in order, recomputes a block's vectors from
the one behind it, walks forward along edits whose costs are tight, and hashes or returns the repaired rows. The stream holds
one block's vectors and one row; it alone is serial, as a hash of the whole text is.

Defined cases. A null role or text is one space; a null conversation id is a conversation, a null
turn comes first. Rows of one turn come by role and by the text's MD5; equal rows are duplicates. Empty texts and texts of white space
are blank. A role of another initial, or none, cannot be kept. An empty table gives no row. Extra
columns are left out, whatever their names. A very long text takes a task's memory a few times.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitlake.llm.tables import stored

# edits' costs; what an inserted or changed row becomes in each state, by name and by state
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
NEXT = (2, 2, 3, 2)
ROLE = {2: "user", 3: "assistant"}
KEEPS = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
END = (0, 2 * INSERT, INSERT, 0)
NEVER = 1 << 60

INITIALS, FAULTS = "suax", "-tbd"
LEGAL = ("su", "ua", "au")
LEAST_BLOCK = 256
NOT_SPACE = r"[^\x20\x09-\x0D]"

VECTORS = "number long, after array<long>"
SUMMARY = ("conv string, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")
REPAIRED = "conv string, at long, edit string, role string, text string"


# -- costs -----------------------------------------------------------------------------

def letter(initial: str, fault: str) -> str:
    return chr(ord("A") + 4 * INITIALS.index(initial) + FAULTS.index(fault))


def _meaning(code: str) -> tuple[str, str]:
    k = ord(code) - ord("A")
    return INITIALS[k // 4], FAULTS[k % 4]


def _rules(code: str) -> tuple[list[int | None], int, bool]:
    """For each state the one a kept row leads to, the cost of not deleting, and whether one must delete."""
    initial, fault = _meaning(code)
    return [KEEPS.get((initial, s)) for s in range(4)], TRUNCATED if fault == "t" else 0, fault in "bd"


RULES = {chr(ord("A") + k): _rules(chr(ord("A") + k)) for k in range(16)}


def before(code: str, after: tuple[int, ...]) -> tuple[int, ...]:
    """The vector of costs to the end before a row, from the one after it."""
    keeps, extra, must = RULES[code]
    own = [DELETE + v for v in after]
    if not must:
        for s in range(4):
            own[s] = min(own[s], REROLE + extra + after[NEXT[s]])
            if keeps[s] is not None:
                own[s] = min(own[s], extra + after[keeps[s]])
    once = [min(own[s], INSERT + own[NEXT[s]]) for s in range(4)]
    return tuple(min(once[s], INSERT + once[NEXT[s]]) for s in range(4))


@lru_cache(4096)
def block_costs(codes: str) -> list[int]:
    """Least costs from each state before a block to each state right after its last row, row by row."""
    columns = []
    for t in range(4):
        vector = tuple(0 if s == t else NEVER for s in range(4))
        for code in reversed(codes):
            vector = before(code, vector)
        columns.append(vector)
    return [min(columns[t][s], NEVER) for s in range(4) for t in range(4)]


def through(costs: list[int], after: tuple[int, ...]) -> tuple[int, ...]:
    """The vector before a block from the one behind it."""
    return tuple(min(costs[4 * s + t] + after[t] for t in range(4)) for s in range(4))


def walk(codes: str, after: tuple[int, ...], state: int) -> Iterator[tuple[str, int]]:
    """Tight edits of a block from ``state`` on, as (letter, state after it)."""
    vectors = [after]
    for code in reversed(codes):
        vectors.append(before(code, vectors[-1]))
    vectors.reverse()
    for k, code in enumerate(codes):
        keeps, extra, must = RULES[code]
        here, then = vectors[k], vectors[k + 1]
        while here[state] != DELETE + then[state] and here[state] == INSERT + here[NEXT[state]]:
            state = NEXT[state]
            yield "I", state
        if here[state] == DELETE + then[state]:
            edit = "D"
        elif not must and keeps[state] is not None and here[state] == extra + then[keeps[state]]:
            edit, state = "K", keeps[state]
        else:
            edit, state = "R", NEXT[state]
        yield edit, state


def tail(state: int) -> Iterator[tuple[str, int]]:
    """What is inserted behind the last row."""
    while END[state]:
        state = NEXT[state]
        yield "I", state


# -- tables ----------------------------------------------------------------------------

def in_order(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Stored rows with ``number``, which rises along each conversation, and faults of their own."""
    rows = df.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
                     F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(" ")).alias("role"),
                     F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(" ")).alias("text"))
    rows = rows.select("conv", "turn", "role", F.unhex(F.md5("text")).alias("hash"), "text")
    order = ["conv", "turn", "role", "hash"]
    numbered = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("number", F.monotonically_increasing_id())
    last = F.regexp_extract("text", f"({NOT_SPACE})[\\x20\\x09-\\x0D]*\\z", 1)
    return stored(numbered.withColumns({"blank": last == "", "cut": ~last.isin("", ".", "!", "?")}), "turns")


def with_codes(rows: DataFrame) -> DataFrame:
    """(conv, number, code): initial and first fault of each row as a letter."""
    first = rows.groupBy("conv", "role", "hash").agg(F.min("number").alias("number")).select("number", F.lit(True).alias("first"))
    known = rows.select("conv", "number", "role", "blank", "cut").join(first, "number", "left")
    initial = F.substring("role", 1, 1)
    fault = F.when(F.col("blank"), FAULTS.index("b")).when(F.col("first").isNull(), FAULTS.index("d")) \
        .when(F.col("cut"), FAULTS.index("t")).otherwise(0)
    place = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return known.select("conv", "number", F.char(F.lit(ord("A")) + 4 * place + fault).alias("code"))


def _costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        costs = [block_costs(c) for c in batch.column("codes").to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(costs, pa.list_(pa.int64()))], names=[*batch.schema.names, "costs"])


def _checkpoints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        numbers, vectors = [], []
        for blocks in batch.column("blocks").to_pylist():
            vector = END
            for block in reversed(blocks):
                numbers.append(block["number"])
                vectors.append(vector)
                vector = through(block["costs"], vector)
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(vectors, pa.list_(pa.int64()))], names=["number", "after"])


def checkpoints(rows: DataFrame, least_block: int = LEAST_BLOCK) -> tuple[DataFrame, int]:
    """(conv, block, codes, after) of all blocks, and how many numbers a block spans.

    A block is a conversation's rows of one run of numbers. Numbers rise without gaps within a
    partition of the order, so blocks are full but at conversations' and partitions' ends.
    """
    longest = rows.groupBy("conv").count().agg(F.max("count")).first()[0] or 0
    span = max(least_block, math.isqrt(longest) + 1)
    block = F.expr(f"number div {span}")
    gathered = with_codes(rows).groupBy("conv", block.alias("block")).agg(
        F.min("number").alias("number"), F.sort_array(F.collect_list(F.struct("number", "code"))).alias("rows"))
    blocks = gathered.select("conv", "block", "number", F.array_join("rows.code", "").alias("codes"))
    conv = rows.schema["conv"].dataType.simpleString()
    blocks = stored(blocks.mapInArrow(_costs, f"conv {conv}, block long, number long, codes string, costs array<long>"), "blocks")
    listed = blocks.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("number", "costs"))).alias("blocks"))
    vectors = listed.select("blocks").mapInArrow(_checkpoints, VECTORS)
    return blocks.join(vectors, "number").select("conv", "block", "codes", "after"), span


# -- the walk --------------------------------------------------------------------------

class Walk:
    """One conversation on its way: the state, and what is told of it at the end."""

    def __init__(self, conv):
        self.conv, self.state, self.cost, self.at, self.last = conv, 0, None, 0, ""
        self.hash, self.audit, self.illegal = hashlib.sha256(), [], 0
        self.counts = dict.fromkeys("btd", 0)
        self.edits: Iterator[tuple[str, int]] = iter(())

    def block(self, codes: str, after: list[int]) -> None:
        after = tuple(after)
        if self.cost is None:
            self.cost = through(block_costs(codes), after)[0]
        for code in codes:
            initial, fault = _meaning(code)
            self.illegal += bool(self.last) and self.last + initial not in LEGAL
            self.last = initial
            if fault != "-":
                self.counts[fault] += 1
        self.edits = walk(codes, after, self.state)

    def _out(self, edit: str, role: str, text: str) -> tuple:
        self.hash.update(f"{chr(10) if self.at else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        self.at += 1
        return (self.conv, self.at, edit, role, text)

    def row(self, role: str, text: str) -> Iterator[tuple]:
        for edit, self.state in self.edits:
            self.audit.append(edit)
            if edit == "I":
                yield self._out(edit, ROLE[self.state], "")
                continue
            if edit != "D":
                yield self._out(edit, ROLE[self.state] if edit == "R" else role, text)
            return

    def end(self) -> Iterator[tuple]:
        for edit, self.state in tail(self.state):
            self.audit.append(edit)
            yield self._out(edit, ROLE[self.state], "")

    def summary(self) -> tuple:
        return (self.conv, self.counts["b"], self.counts["d"], self.counts["t"], self.illegal, self.cost,
                "".join(self.audit), self.hash.hexdigest())


def _stream(rows_wanted: bool, schema: pa.Schema):
    """Over rows sorted by (conv, block, number), a block's codes (number -1) before its rows."""
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Walk | None = None
        out: list[tuple] = []
        size = 0

        def full() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

        def finish() -> list[tuple]:
            trailing = list(now.end())
            return trailing if rows_wanted else [now.summary()]

        for batch in batches:
            for conv, codes, after, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv", "codes", "after", "role", "text")], strict=True):
                if now is None or conv != now.conv:
                    if now is not None:
                        out += finish()
                    now = Walk(conv)
                if codes is not None:
                    now.block(codes, after)
                    continue
                made = list(now.row(role, text))
                if rows_wanted:
                    out += made
                    size += sum(len(r[4]) + 100 for r in made)
                if size > 4 << 20 or len(out) >= 2000:
                    yield full()
                    out, size = [], 0
        if now is not None:
            out += finish()
        if out:
            yield full()
    return go


def _walked(rows: DataFrame, schema: str, fields: list[tuple[str, pa.DataType]], rows_wanted: bool, least_block: int) -> DataFrame:
    blocks, span = checkpoints(rows, least_block)
    block = F.expr(f"number div {span}")
    none = F.lit(None)
    mixed = blocks.select("conv", "block", F.lit(-1).cast("long").alias("number"), "codes", "after", none.cast("string").alias("role"),
                          none.cast("string").alias("text")).unionByName(
        rows.select("conv", block.alias("block"), "number", none.cast("string").alias("codes"),
                    none.cast("array<long>").alias("after"), "role", "text"))
    kind = rows.schema["conv"].dataType
    dealt = mixed.repartition("conv").sortWithinPartitions("conv", "block", "number")
    typed = dealt.select(F.col("conv").cast("string"), "codes", "after", "role", "text")
    done = typed.mapInArrow(_stream(rows_wanted, pa.schema(fields)), schema)
    return done.withColumn("conv", F.col("conv").cast(kind))


def repaired(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
             least_block: int = LEAST_BLOCK) -> DataFrame:
    """The repaired rows: conversation, place from 1, edit (I, K or R), role and text."""
    rows = in_order(df, conv, turn, role, text)
    fields = [("conv", pa.string()), ("at", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]
    return _walked(rows, REPAIRED, fields, True, least_block).withColumnRenamed("conv", conv)


def audited(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
            every: DataFrame | None = None, least_block: int = LEAST_BLOCK) -> DataFrame:
    """One row for each conversation, also for those only in ``every`` (its ``conv`` column): faults, cost, edits, hash."""
    rows = in_order(df, conv, turn, role, text)
    counted = ("blank", "duplicate", "truncated", "illegal", "cost")
    fields = [("conv", pa.string()), *[(c, pa.int64()) for c in counted], ("audit", pa.string()), ("repaired_sha256", pa.string())]
    walked = _walked(rows, SUMMARY, fields, False, least_block)
    wide = [F.col(c).cast("decimal(38,0)") for c in ("most", "least", "n")]
    gap = F.least(wide[0] - wide[1] + 1 - wide[2], F.lit((1 << 63) - 1).cast("decimal(38,0)")).cast("long")
    gaps = rows.where("turn IS NOT NULL").groupBy("conv", "turn").agg(F.lit(1).alias("one")).groupBy("conv").agg(
        F.max("turn").alias("most"), F.min("turn").alias("least"), F.count("one").alias("n")).select("conv", gap.alias("gaps"))
    ids = (every if every is not None else df).select(F.col(f"`{conv}`").alias("conv")).distinct()
    names = ["gaps", *counted, "audit", "repaired_sha256"]
    # null ids meet in an aggregate, one row a conversation from each part
    parts = ids.unionByName(gaps, allowMissingColumns=True).unionByName(walked, allowMissingColumns=True)
    merged = parts.groupBy("conv").agg(*[F.max(c).alias(c) for c in names])
    zeros = {c: 0 for c in ("gaps", *counted)} | {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    return merged.select(F.col("conv").alias(conv), *[F.coalesce(c, F.lit(zeros[c])).alias(c) for c in names])


def damaged(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with planted faults, by a hash of conversation and turn; nulls but of ids and turns become a space."""
    def shown(c: str) -> Column:
        return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))

    which = F.crc32(F.encode(F.concat(shown(conv), F.lit(":"), shown(turn)), "UTF-8")) % 20
    rows = df.select(F.col(f"`{conv}`").alias("c"), F.col(f"`{turn}`").alias("t"), shown(role).alias("r"), shown(text).alias("x"), which.alias("w"))
    times = F.when(F.col("w") == 3, 2).when(F.col("w") == 0, 0).otherwise(1)
    text_now = F.when(F.col("w") == 1, "").when(F.col("w") == 2, F.regexp_replace("x", "[.!?]", "")).otherwise(F.col("x"))
    role_now = F.when(F.col("w") == 4, "user").otherwise(F.col("r"))
    return rows.select(F.col("c").alias(conv), F.col("t").alias(turn), role_now.alias(role), text_now.alias(text),
                       F.explode(F.array_repeat(F.lit(0), times)).alias("copy_")).drop("copy_")
