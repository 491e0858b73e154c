"""Conversation structure repair: the cheapest edits that make the roles alternate.

A conversation is well formed if the initials of its roles are nothing, or an optional `s` and then one or more
`ua`. Edits: Keep a row (cost 0), give it the Role user or assistant (1), Delete it (2), Insert a row without text
(5). A row is blank (no character beside white space), or else a duplicate (role and text seen earlier in the
conversation), or else truncated (its last such character is none of `.!?`). Blank and duplicate rows must be
deleted; a truncated one that is not costs 5 more. Of the cheapest edits those whose initials, D I K R, come first
in ASCII order are taken.

The rows are sorted over the cluster and cut into blocks of at most `BLOCK` rows, wherever conversations begin. A
conversation inside one block is solved there. Of one that reaches over blocks, each part gives the least costs
between any two states (four by four numbers); these, taken from the last part to the first, give the vector
of costs at each part's end, from which the part is solved alone. Within a part, vectors of costs are kept at
checkpoints only, one for each square root of its rows, and computed again between two of them on the walk forward.

Defined cases: a null role or text is one space; a null conversation is one of its own; null turns come first.
Rows that tie in turn and role come in an order fixed by their texts, copies next to each other. A role whose initial is
neither s, u nor a, an empty one included, cannot be kept. Conversations without rows do not occur; an empty
table gives empty results. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.llm.arrow import _arrow_type
from eventmart.sources.staging import stage

# Rows of a block, as a power of two.
_BLOCK_BITS = 14
_SPACES = " \t\n\x0b\x0c\r"

INSERT, REROLE, DELETE, TRUNCATED = 5, 1, 2, 5
# States: nothing yet, after s, after u, after a. The next role in each, and the state it leads to.
_NEXT_ROLE, _NEXT_STATE = "uuau", (2, 2, 3, 2)
# Costs of ending in each state: what is still to be inserted, named below.
_END = (0, 2 * INSERT, INSERT, 0)
_ENDING = ("", "ua", "a", "")
_NEVER = 1 << 60
_ROLES = {"s": 0, "u": 1, "a": 2}
_KEEP_TO = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 3, (3, 1): 2}
_LEGAL = {(0, 1), (1, 2), (2, 1)}
_FREE, _FORCED, _CUT_SHORT = 0, 1, 2


def _options(role: int, fault: int, state: int) -> list[tuple[str, int, int]]:
    """What can be done with a row but inserting before it: (edit, cost, state after)."""
    found = [("D", DELETE, state)]
    if fault != _FORCED:
        extra = TRUNCATED if fault == _CUT_SHORT else 0
        if (state, role) in _KEEP_TO:
            found.append(("K", extra, _KEEP_TO[state, role]))
        found.append(("R", extra + REROLE, _NEXT_STATE[state]))
    return found


_OPTIONS = {(r, f): [_options(r, f, s) for s in range(4)] for r in range(4) for f in range(3)}

# A row: its role, its fault, and how many copies of it follow, all of which are deleted.
_Row = tuple[int, int, int]


def _table(schema: T.StructType, columns: dict) -> pa.Table:
    """Lists, or Arrow columns as they are, as a table of this schema."""
    return pa.table(
        {
            f.name: c if isinstance(c := columns[f.name], (pa.Array, pa.ChunkedArray)) else pa.array(c, _arrow_type(f.dataType))
            for f in schema.fields
        }
    )


def _costs_before(row: _Row, after: list[int]) -> list[int]:
    """The least costs from before a row, with what is inserted there, by those from after it."""
    copies = DELETE * row[2]
    own = [min(cost + after[to] for _, cost, to in found) + copies for found in _OPTIONS[row[:2]]]
    u, a = min(own[2], INSERT + own[3]), min(own[3], INSERT + own[2])
    return [min(own[0], INSERT + u), min(own[1], INSERT + u), u, a]


def costs_between(rows: list[_Row]) -> list[int]:
    """The least cost from each state before the rows to each after them, four by four."""
    columns = []
    for to in range(4):
        costs = [_NEVER] * 4
        costs[to] = 0
        for row in reversed(rows):
            costs = _costs_before(row, costs)
        columns.append(costs)
    return [min(columns[to][state], _NEVER) for state in range(4) for to in range(4)]


def walk(rows: list[_Row], end: list[int], state: int) -> tuple[list[tuple[str, str, str]], int, int]:
    """The ASCII-least cheapest edits: (roles inserted before, edit, new role) of each row, their state after, the cost.

    `end` holds the costs from after the rows. Of the backward vectors only every square root one is kept.
    """
    step = max(1, isqrt(len(rows)))
    checkpoints, costs = {}, list(end)
    for i in range(len(rows), 0, -1):
        if i % step == 0 or i == len(rows):
            checkpoints[i] = costs
        costs = _costs_before(rows[i - 1], costs)
    total, edits = costs[state], []
    for begin in range(0, len(rows), step):
        stop = min(begin + step, len(rows))
        vectors = [checkpoints.pop(stop)]
        for i in range(stop - 1, begin - 1, -1):
            vectors.append(_costs_before(rows[i], vectors[-1]))
        for i in range(begin, stop):
            here, after = vectors[stop - i], vectors[stop - i - 1]
            copies, before = DELETE * rows[i][2], ""
            while True:
                tight = [(e, to) for e, cost, to in _OPTIONS[rows[i][:2]][state] if cost + copies + after[to] == here[state]]
                if INSERT + here[_NEXT_STATE[state]] != here[state] or (tight and tight[0][0] == "D"):
                    break
                before += _NEXT_ROLE[state]
                state = _NEXT_STATE[state]
            edit, to = tight[0]
            edits.append((before, edit, _NEXT_ROLE[state] if edit == "R" else ""))
            state = to
    return edits, state, total


# -- over a table


def _sorted_rows(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """The distinct rows in order, with their number of copies and a number `at` that grows."""
    space = F.lit(" ")
    plain = rows.select(
        F.col(f"`{conv}`").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), space).alias("role"),
        F.coalesce(F.col(f"`{text}`").cast("string"), space).alias("text"),
    )
    # Equal rows are next to each other in any case; counted first, a row repeated very often is no task of its own.
    counted = plain.groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("copies"))
    counted = counted.withColumn("_order", F.xxhash64("text"))
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("_order")]
    dealt = counted.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    numbered = dealt.withColumn("at", F.monotonically_increasing_id()).drop("_order")
    return stage(numbered, "conversations")[0]


def _facts(ordered: DataFrame) -> DataFrame:
    """Of each row what the costs depend on, without its text."""
    trimmed = F.rtrim(F.col("text"), F.lit(_SPACES))
    initial = F.substring("role", 1, 1)
    code = F.lit(3)
    for letter, number in _ROLES.items():
        code = F.when(initial == letter, number).otherwise(code)
    facts = ordered.select(
        "at", "conv", "copies", "role", code.alias("code"),
        (trimmed == "").alias("is_blank"),
        F.when(~F.right(trimmed, F.lit(1)).isin(".", "!", "?"), True).otherwise(False).alias("is_cut"),
        F.sha2("text", 256).alias("digest"),
    )
    # The first rows are joined back by their own numbers, so that a text seen very often is no hot key.
    firsts = facts.filter("not is_blank").groupBy("conv", "role", "digest").agg(F.min("at").alias("at"))
    found = facts.drop("role", "digest").join(firsts.select("at", F.lit(True).alias("is_first")), "at", "left")
    return found.withColumn("is_first", F.coalesce("is_first", F.lit(False)))


_COUNTS = ("blank", "duplicate", "truncated", "illegal")


def _solved(conv_type: T.DataType):
    """A function that solves the conversations inside a block, and sums up the parts of the others; its schema."""
    schema = T.StructType(
        [
            # A part of a conversation is named by its first row.
            T.StructField("part", T.LongType()),
            # Of parts: those not solved have costs between states, and the roles at their ends.
            T.StructField("conv", conv_type),
            *[T.StructField(c, T.LongType()) for c in _COUNTS],
            T.StructField("cost", T.LongType()),
            T.StructField("between", T.ArrayType(T.LongType())),
            T.StructField("ends", T.ArrayType(T.LongType())),
            # Of rows: of parts that are solved, the edits; of others, what they depend on.
            T.StructField("at", T.LongType()),
            *[T.StructField(c, T.StringType()) for c in ("before", "edit", "new_role", "after")],
            *[T.StructField(c, T.LongType()) for c in ("code", "fault", "copies")],
        ]
    )

    def solve(block: pa.Table) -> pa.Table:
        block = block.combine_chunks().sort_by("at")
        conv = block.column("conv").to_pylist()
        names = ("at", "code", "copies", "is_blank", "is_cut", "is_first")
        at, code, copies, is_blank, is_cut, is_first = (block.column(c).to_pylist() for c in names)
        bounds = [0, *(i for i in range(1, len(conv)) if conv[i] != conv[i - 1]), len(conv)]
        out: dict[str, list] = {f: [] for f in schema.fieldNames() if f != "conv"}
        source: list[int | None] = []

        def emit(row: int | None, **values) -> None:
            source.append(row)
            for name, column in out.items():
                column.append(values.get(name))

        for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
            rows, counts = [], dict.fromkeys(_COUNTS, 0)
            for i in range(begin, end):
                forced = is_blank[i] or not is_first[i]
                fault = _FORCED if forced else _CUT_SHORT if is_cut[i] else _FREE
                rows.append((code[i], fault, copies[i] - 1))
                counts["blank"] += copies[i] if is_blank[i] else 0
                counts["duplicate"] += 0 if is_blank[i] else copies[i] - 1 + (not is_first[i])
                counts["truncated"] += fault == _CUT_SHORT
                counts["illegal"] += copies[i] - 1 + (i > begin and (code[i - 1], code[i]) not in _LEGAL)
            part = at[begin]
            if begin == 0 or end == len(conv):
                # It may go on in the next block.
                emit(begin, part=part, between=costs_between(rows), ends=[code[begin], code[end - 1]], **counts)
                for i, (role, fault, more) in enumerate(rows, begin):
                    emit(None, part=part, at=at[i], code=role, fault=fault, copies=more)
            else:
                edits, state, cost = walk(rows, _END, 0)
                emit(begin, part=part, cost=cost, **counts)
                for i, (before, edit, new) in enumerate(edits, begin):
                    after = _ENDING[state] if i == end - 1 else ""
                    emit(None, part=part, at=at[i], before=before, edit=edit, new_role=new, after=after, copies=copies[i] - 1)
        out["conv"] = block.column("conv").take(pa.array(source, pa.int64()))
        return _table(schema, out)

    return solve, schema


def _linked(conv_type: T.DataType):
    """A function that takes the parts of a conversation from the last to the first; its schema."""
    schema = T.StructType(
        [
            T.StructField("part", T.LongType()),
            T.StructField("conv", conv_type),
            T.StructField("cost", T.LongType()),
            T.StructField("illegal", T.LongType()),
            T.StructField("is_first", T.BooleanType()),
            T.StructField("is_last", T.BooleanType()),
            T.StructField("end", T.ArrayType(T.LongType())),
        ]
    )

    def link(parts: pa.Table) -> pa.Table:
        parts = parts.combine_chunks().sort_by("part")
        between, ends = parts.column("between").to_pylist(), parts.column("ends").to_pylist()
        n, costs, vectors = len(between), list(_END), []
        for own in reversed(between):
            vectors.append(costs)
            costs = [min(own[4 * s + t] + costs[t] for t in range(4)) for s in range(4)]
        illegal = [int(i > 0 and (ends[i - 1][1], ends[i][0]) not in _LEGAL) for i in range(n)]
        return _table(
            schema,
            {
                "part": parts.column("part"), "conv": parts.column("conv"), "cost": [costs[0]] + [0] * (n - 1),
                "illegal": illegal, "is_first": [i == 0 for i in range(n)], "is_last": [i == n - 1 for i in range(n)],
                "end": vectors[::-1],
            },
        )

    return link, schema


_WALKED = T.StructType(
    [
        T.StructField("part", T.LongType()),
        T.StructField("entry", T.LongType()),
        # Of a part: the state after it. Of its rows: the edits.
        T.StructField("exit", T.LongType()),
        T.StructField("at", T.LongType()),
        *[T.StructField(c, T.StringType()) for c in ("before", "edit", "new_role", "after")],
        T.StructField("copies", T.LongType()),
    ]
)


def _walked(rows: pa.Table, parts: pa.Table) -> pa.Table:
    """The edits of a part for each state it may be entered in; the first part of a conversation is in state 0."""
    rows = rows.combine_chunks().sort_by("at")
    at, copies = rows.column("at").to_pylist(), rows.column("copies").to_pylist()
    own = list(zip(rows.column("code").to_pylist(), rows.column("fault").to_pylist(), copies, strict=True))
    part = parts.to_pylist()[0]
    out: dict[str, list] = {f: [] for f in _WALKED.fieldNames()}
    for entry in [0] if part["is_first"] else range(4):
        edits, state, _ = walk(own, part["end"], entry)
        values = [(part["part"], entry, state, None, None, None, None, None, None)]
        for i, (before, edit, new) in enumerate(edits):
            after = _ENDING[state] if part["is_last"] and i == len(edits) - 1 else ""
            values.append((part["part"], entry, None, at[i], before, edit, new, after, copies[i]))
        for value in values:
            for column, one in zip(out.values(), value, strict=True):
                column.append(one)
    return _table(_WALKED, out)


def _entered(parts: pa.Table) -> pa.Table:
    """The state each part of a conversation is entered in, from the first to the last."""
    exits: dict[int, dict[int, int]] = {}
    for part, entry, end in zip(*[parts.column(c).to_pylist() for c in ("part", "entry", "exit")], strict=True):
        exits.setdefault(part, {})[entry] = end
    state, found = 0, []
    for part in sorted(exits):
        found.append(state)
        state = exits[part][state]
    return pa.table({"part": sorted(exits), "entry": found})


def _plan(facts: DataFrame, conv_type: T.DataType) -> tuple[DataFrame, DataFrame]:
    """The parts of conversations with their counts and costs, and the edits of all rows."""
    solve, schema = _solved(conv_type)
    solved = facts.withColumn("_block", F.shiftright("at", _BLOCK_BITS)).groupBy("_block").applyInArrow(solve, schema)
    solved, _ = stage(solved, "conversation-parts")
    parts = solved.filter("at is null").select("part", "conv", *_COUNTS, "cost", "between", "ends")

    link, schema = _linked(conv_type)
    links = parts.filter("between is not null").select("part", "conv", "between", "ends").groupBy("conv").applyInArrow(link, schema)
    links, _ = stage(links, "conversation-links")
    unsolved = solved.filter("at is not null and edit is null").select("part", "at", "code", "fault", "copies")
    walked = unsolved.groupBy("part").cogroup(links.groupBy("part")).applyInArrow(_walked, _WALKED)
    walked, _ = stage(walked, "conversation-walks")
    exits = walked.filter("at is null").select("part", "entry", "exit").join(links.select("part", "conv"), "part")
    entries = exits.groupBy("conv").applyInArrow(_entered, "part long, entry long")

    columns = ["part", "at", "before", "edit", "new_role", "after", "copies"]
    edits = solved.filter("edit is not null").select(*columns)
    edits = edits.unionByName(walked.filter("at is not null").join(entries, ["part", "entry"]).select(*columns))
    more = links.select("part", F.col("cost").alias("_cost"), F.col("illegal").alias("_illegal"))
    parts = parts.join(more, "part", "left").select(
        "part", "conv", "blank", "duplicate", "truncated",
        (F.col("illegal") + F.coalesce("_illegal", F.lit(0))).alias("illegal"), F.coalesce("cost", "_cost").alias("cost"),
    )
    return parts, stage(edits, "conversation-edits")[0]


def _joined(pieces: str, order: str):
    """The texts of a group in order, joined."""
    found = F.array_sort(F.collect_list(F.struct(order, pieces)))
    return F.array_join(F.transform(found, lambda p: p[pieces]), "")


def repair(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """The conversations, and the rows of the repaired ones.

    Conversations: `conv`, gaps (turns missing between the first and the last; nulls do not count), blank, duplicate, truncated,
    illegal (pairs of rows whose initials are not su, ua or au), cost, and audit, the initials of the edits.
    Rows: `conv`, `place` and `line` to order them by, role, text.
    """
    ordered = _sorted_rows(rows, conv, turn, role, text)
    conv_type = ordered.schema["conv"].dataType
    parts, edits = _plan(_facts(ordered), conv_type)

    inserts = lambda c: F.repeat(F.lit("I"), F.length(c))
    letters = F.concat(inserts("before"), "edit", F.repeat(F.lit("D"), F.col("copies").cast("int")), inserts("after"))
    by_part = edits.select("part", "at", letters.alias("letters")).groupBy("part").agg(_joined("letters", "at").alias("letters"))
    sums = [F.sum(c).alias(c) for c in (*_COUNTS, "cost")]
    found = parts.join(by_part, "part").groupBy("conv").agg(*sums, _joined("letters", "part").alias("audit"))
    span = F.max("turn").cast("long") - F.min("turn").cast("long") + 1 - F.countDistinct("turn")
    gaps = ordered.groupBy(F.col("conv").alias("_conv")).agg(F.coalesce(span, F.lit(0).cast("long")).alias("gaps"))
    conversations = found.join(gaps, F.col("conv").eqNullSafe(F.col("_conv"))).select(
        F.col("conv").alias(conv), "gaps", *_COUNTS, "cost", "audit"
    )

    full = lambda c: F.when(c == "u", "user").otherwise("assistant")
    made = lambda c: F.transform(
        F.filter(F.split(c, ""), lambda r: r != ""), lambda r: F.struct(full(r).alias("role"), F.lit("").alias("text"))
    )
    kept = F.when(F.col("edit") == "D", F.array().cast("array<struct<role:string,text:string>>")).otherwise(
        F.array(F.struct(F.when(F.col("edit") == "R", full(F.col("new_role"))).otherwise(F.col("role")).alias("role"), "text"))
    )
    lines = F.posexplode(F.concat(made("before"), kept, made("after"))).alias("line", "row")
    repaired = ordered.select("at", "conv", "role", "text").join(edits.drop("part", "copies"), "at").select("conv", "at", lines)
    return conversations, repaired.select(F.col("conv").alias(conv), F.col("at").alias("place"), "line", "row.role", "row.text")


def digests(repaired: DataFrame, conv: str = "conv_id") -> DataFrame:
    """`conv` and the SHA-256 of its lines `role:text`, joined by newlines.

    Each conversation's lines pass through one task in order, none of them kept: the digest of a sequence cannot
    be put together from parts.
    """
    kind = repaired.schema[conv].dataType
    lines = repaired.select(
        F.col(f"`{conv}`").alias("conv"), "place", "line", F.concat("role", F.lit(":"), "text").alias("value")
    )
    ordered = lines.repartition("conv").sortWithinPartitions("conv", "place", "line").select("conv", "value")
    schema = T.StructType([T.StructField(conv, kind), T.StructField("sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, digest, last = False, None, None
        for batch in batches:
            column = batch.column("conv")
            done: list = []
            for k, (own, value) in enumerate(zip(column.to_pylist(), batch.column("value").to_pylist(), strict=True)):
                if open_ and own == last:
                    digest.update(b"\n")
                else:
                    if open_:
                        done.append((last, digest.hexdigest()))
                    open_, digest, last = True, hashlib.sha256(), own
                digest.update(value.encode())
            kind_ = column.type
            yield _batch(done, kind_, conv)
        if open_:
            yield _batch([(last, digest.hexdigest())], kind_, conv)

    return ordered.mapInArrow(run, schema)


def _batch(rows: list, kind: pa.DataType, conv: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], kind), pa.array([r[1] for r in rows], pa.string())], [conv, "sha256"])


def damage(rows: DataFrame) -> DataFrame:
    """Faults put into a fifth of the rows (conv_id, turn, role, text) for trials, by a checksum of conversation and turn."""
    space = F.lit(" ")
    of = lambda c: F.coalesce(F.col(c).cast("string"), space)
    kind = F.crc32(F.concat(of("conv_id"), F.lit(":"), of("turn"))) % 20
    copies = F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return (
        rows.select("conv_id", "turn", of("role").alias("role"), of("text").alias("text"), kind.alias("_kind"))
        .filter("_kind <> 0")
        .select("conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                F.explode(copies).alias("_copy"))
        .drop("_copy")
    )
