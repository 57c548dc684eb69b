"""Conversation structure repair: the cheapest edits by depth-first branch and bound.

The roles of a sound conversation are an optional system turn and pairs of user and
assistant, or nothing. Rows are kept, given another role, deleted, or turns without text are
put in between. Faults are found with DataFrame functions; the search runs over one byte
per row; texts pass through tasks sorted by conversation and are never gathered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.llm.common import SLICE_ROWS, column, first_column
from caseloom.session import cut_lineage

# Costs of the edits, white space, ends of sentences.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
SPACES, SENTENCE_ENDS = " \t\n\x0b\x0c\r", ".!?"

#: First letters that the grammar knows; any other role cannot be kept.
INITIALS = "sua"
FAULTS = ["sound", "blank", "duplicate", "truncated"]
#: Edit letters in ASCII order, the order in which branches are tried.
D, I, K, R = b"DIKR"

# States: what the turns so far end with.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: State after a put-in or re-roled turn, which can only have the one role that may come next.
NEXT = (USER, USER, ASSISTANT, USER)
#: State after keeping a turn with an initial; absent if it may not be kept.
KEEP = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
COMPLETE = (True, False, False, True)
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}

#: Rows of edits given out at a time.
OUT_ROWS = 4_096
EDITS = pa.schema([("conv_id", pa.int64()), ("pos", pa.int64()), ("edit", pa.string()), ("cost", pa.int64())])
TURNS = pa.schema([("conv_id", pa.int64()), ("pos", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])
DIGESTS = pa.schema([("conv_id", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])


class Steps:
    """Edits of one row in each state, from its byte: first letter's class and fault."""

    def __init__(self, code: int):
        initial, fault = "suax"[code >> 2], FAULTS[code & 3]
        self.delete = DELETE
        if fault in ("blank", "duplicate"):
            self.keep: list[int | None] = [None] * 4
            self.kept_cost = self.reroled_cost = None
        else:
            extra = TRUNCATED if fault == "truncated" else 0
            self.keep = [moves.get(initial) for moves in KEEP]
            self.kept_cost, self.reroled_cost = extra, REROLE + extra


STEPS = [Steps(code) for code in range(16)]


def row_code(initial: Column, fault: Column) -> Column:
    """Byte of a row for the search; ``fault`` is a name of FAULTS."""
    letter = F.coalesce(F.nullif(F.instr(F.lit(INITIALS), initial), F.lit(0)), F.lit(len(INITIALS) + 1)) - 1
    return (letter * 4 + F.array_position(F.array(*[F.lit(f) for f in FAULTS]), fault) - 1).cast("int")


def suffix_bounds(codes: bytes) -> list[tuple[int, int, int, int]]:
    """Least cost of the rows from each position on, in each state, if a conversation might end anywhere.

    Leaving out how it must end only lowers the cost, by that of two put-in turns at most.
    """
    low = (0, 0, 0, 0)
    bounds = [low] * (len(codes) + 1)
    for i in range(len(codes) - 1, -1, -1):
        step, costs = STEPS[codes[i]], []
        for state in range(4):
            cost = low[state] + step.delete
            if step.keep[state] is not None:
                cost = min(cost, low[step.keep[state]] + step.kept_cost)
            if step.reroled_cost is not None:
                cost = min(cost, low[NEXT[state]] + step.reroled_cost)
            costs.append(cost)
        for _ in range(2):  # a turn or two put in before the row
            costs = [min(costs[state], costs[NEXT[state]] + INSERT) for state in range(4)]
        low = bounds[i] = tuple(costs)
    return bounds


def _branches(codes: bytes, i: int, state: int, cost: int) -> list[tuple[int, int, int, int]]:
    """``(letter, position, state, cost)`` of the edits that are possible now, in ASCII order."""
    after = NEXT[state]
    if i == len(codes):
        return [] if COMPLETE[state] else [(I, i, after, cost + INSERT)]
    step = STEPS[codes[i]]
    out = [(D, i + 1, state, cost + step.delete), (I, i, after, cost + INSERT)]
    if step.keep[state] is not None:
        out.append((K, i + 1, step.keep[state], cost + step.kept_cost))
    if step.reroled_cost is not None:
        out.append((R, i + 1, after, cost + step.reroled_cost))
    return out


def _dive(codes: bytes, low: list[tuple[int, int, int, int]]) -> tuple[int, bytes]:
    """A first solution: always the branch with the least cost and bound."""
    i, state, cost, path = 0, NOTHING, 0, bytearray()
    while branches := _branches(codes, i, state, cost):
        letter, i, state, cost = min(branches, key=lambda b: b[3] + low[b[1]][b[2]])
        path.append(letter)
    return cost, bytes(path)


def cheapest_edits(codes: bytes) -> tuple[int, bytes]:
    """Least (cost, audit) over all edits that give a sound conversation.

    Depth first with a stack of its own. Branches are tried in ASCII order, so audits come
    in ascending order: a node (position, state) that was entered before at no higher
    cost had the better prefix, and a solution found in order is only replaced by a cheaper
    one. Branches whose cost and suffix bound exceed the incumbent's cost are dropped. As
    the bound misses the true cost by two put-in turns at most, a node is entered only a few
    times, whatever the length.
    """
    low = suffix_bounds(codes)
    incumbent = _dive(codes, low)
    limit = incumbent[0] + 1  # a solution of the same cost may still have the lesser audit
    entered: dict[tuple[int, int], int] = {}
    path = bytearray()
    stack = [(0, 0, 0, NOTHING, 0)]  # letters before this one, letter, position, state, cost
    while stack:
        depth, letter, i, state, cost = stack.pop()
        if cost + low[i][state] >= limit or entered.get((i, state), limit) <= cost:
            continue
        entered[i, state] = cost
        if letter:
            del path[depth - 1 :]
            path.append(letter)
        if i == len(codes) and COMPLETE[state]:
            incumbent = min(incumbent, (cost, bytes(path)))
            limit = cost
            continue
        stack += [(depth + 1, *branch) for branch in reversed(_branches(codes, i, state, cost))]
    return incumbent


def row_faults(conversations: DataFrame) -> DataFrame:
    """``(conv_id, pos, turn, role, text, initial, fault, illegal)``: rows in order, each with its first fault.

    Rows stand by ``turn`` (missing ones first), equal ones by role and text. Blank: nothing
    but white space. Duplicate: role and text stood earlier in the conversation. Truncated:
    the last visible character ends no sentence. ``illegal`` marks a row whose role may not
    follow the one before it.
    """
    rows = first_column(conversations, "conv_id", "turn", "role", "text").select(
        "conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")]
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    placed = rows.withColumn("pos", F.row_number().over(order).cast("long")).withColumn("initial", F.left("role", F.lit(1)))
    seen = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy("pos")) > 1
    body = F.rtrim(F.col("text"), F.lit(SPACES))
    fault = (
        F.when(body == "", "blank").when(seen, "duplicate").when(~F.right(body, F.lit(1)).isin(*SENTENCE_ENDS), "truncated").otherwise("sound")
    )
    pair = F.concat(F.lag("initial").over(Window.partitionBy("conv_id").orderBy("pos")), "initial")
    return placed.select("*", fault.alias("fault"), F.coalesce(~pair.isin("su", "ua", "au"), F.lit(False)).alias("illegal"))


def fault_counts(rows: DataFrame) -> DataFrame:
    """Per conversation of ``row_faults``: missing turn numbers, rows by fault, illegal neighbours."""
    gaps = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    return rows.groupBy("conv_id").agg(
        F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"),
        *[F.count_if(F.col("fault") == f).alias(f) for f in FAULTS[1:]],
        F.count_if("illegal").alias("illegal"),
    )


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int | None, bytes]]:
    """Conversations of a sorted stream with the bytes of their rows."""
    key, codes, begun = None, bytearray(), False
    for batch in batches:
        for conv, code in zip(column(batch, "conv_id"), column(batch, "code"), strict=True):
            if begun and conv != key:
                yield key, bytes(codes)
                codes = bytearray()
            key, begun = conv, True
            codes.append(code)
    if begun:
        yield key, bytes(codes)


def _by_row(conv: int | None, cost: int, audit: bytes) -> Iterator[tuple]:
    """An audit cut into the letters of each row, with those put in before it; what is put in at the end has a row of its own."""
    pos, begin = 1, 0
    for k, letter in enumerate(audit):
        if letter != I:
            yield conv, pos, audit[begin : k + 1].decode(), None
            pos, begin = pos + 1, k + 1
    yield conv, pos, audit[begin:].decode(), cost


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _in_batches(rows: Iterable[tuple], schema: pa.Schema, most: int) -> Iterator[pa.RecordBatch]:
    out = []
    for row in rows:
        out.append(row)
        if len(out) == most:
            yield _batch(out, schema)
            out = []
    yield _batch(out, schema)


def edits(rows: DataFrame) -> DataFrame:
    """``(conv_id, pos, edit, cost)``: the edit letters of each row of ``row_faults``, and of the end with the cost."""

    def search(batches):
        found = ((conv, *cheapest_edits(codes)) for conv, codes in _runs(batches))
        return _in_batches((row for f in found for row in _by_row(*f)), EDITS, OUT_ROWS)

    coded = rows.select("conv_id", "pos", row_code(F.col("initial"), F.col("fault")).alias("code"))
    dealt = coded.repartition("conv_id").sortWithinPartitions("conv_id", "pos").select("conv_id", "code")
    return dealt.mapInArrow(search, "conv_id long, pos long, edit string, cost long")


def _applied(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """``(conv_id, letter, role, text, cost)`` of the stream of edits and rows; cost stands at the end of a conversation."""
    state, edit = NOTHING, ""
    for whole in batches:
        for start in range(0, whole.num_rows, SLICE_ROWS):
            batch = whole.slice(start, SLICE_ROWS)
            for conv, letters, cost, role, text in zip(*[column(batch, c) for c in ("conv_id", "edit", "cost", "role", "text")], strict=True):
                if letters is not None and cost is None:
                    edit = letters  # of the row that comes next
                    continue
                for letter in letters if cost is not None else edit:
                    if letter == "D":
                        yield conv, letter, None, None, None
                        continue
                    state = KEEP[state][role[:1]] if letter == "K" else NEXT[state]
                    yield conv, letter, role if letter == "K" else ROLE_OF[state], "" if letter == "I" else text, None
                if cost is not None:
                    yield conv, "", None, None, cost
                    state = NOTHING


def _with_edits(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows and edits in one sorted stream per conversation: an edit stands just before its row."""
    marks = found.select("conv_id", "pos", "edit", "cost", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    texts = rows.select("conv_id", "pos", F.lit(None).cast("string").alias("edit"), F.lit(None).cast("long").alias("cost"), "role", "text")
    both = marks.union(texts).repartition("conv_id")
    return both.sortWithinPartitions("conv_id", "pos", F.col("edit").isNull()).drop("pos")


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``(conv_id, pos, role, text, edit)``: the turns of the repaired conversations, numbered from 1."""

    def apply(batches):
        def turns():
            pos = 0
            for conv, letter, role, text, cost in _applied(batches):
                if cost is not None:
                    pos = 0
                elif letter != "D":
                    pos += 1
                    yield conv, pos, role, text, letter

        return _in_batches(turns(), TURNS, SLICE_ROWS)

    return _with_edits(rows, found).mapInArrow(apply, "conv_id long, pos long, role string, text string, edit string")


def repair_digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``(conv_id, cost, audit, repaired_sha256)``: digest of the repaired ``role:text`` lines, fed turn by turn."""

    def apply(batches):
        def digests():
            audit, digest, first = [], hashlib.sha256(), True
            for conv, letter, role, text, cost in _applied(batches):
                if cost is not None:
                    yield conv, cost, "".join(audit), digest.hexdigest()
                    audit, digest, first = [], hashlib.sha256(), True
                    continue
                audit.append(letter)
                if letter != "D":
                    digest.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
                    first = False

        return _in_batches(digests(), DIGESTS, SLICE_ROWS)

    return _with_edits(rows, found).mapInArrow(apply, "conv_id long, cost long, audit string, repaired_sha256 string")


def find_repairs(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with their faults and the cheapest edits of each, both stored in the shared folder.

    Null roles and texts are one space: such a text is blank, such a role cannot be kept. Rows
    of one turn number stand by role and text, repeated rows are duplicates. Rows without
    conv_id are one conversation. Very long texts move once through the sort and are
    held a slice of rows at a time; a conversation of n rows takes some hundred bytes of each
    in the search. No rows give no conversations; further columns are not looked at.
    """
    rows = cut_lineage(row_faults(conversations), "turns")
    return rows, cut_lineage(edits(rows), "edits")


def repair_report(conversations: DataFrame) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)`` per conversation with rows."""
    rows, found = find_repairs(conversations)
    counts, digests = fault_counts(rows), repair_digests(rows, found)
    other = digests.withColumnRenamed("conv_id", "_id")
    return counts.join(other, F.col("conv_id").eqNullSafe(F.col("_id"))).drop("_id")


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with planted damage, by the checksum of ``conv_id:turn``: dropped, emptied, without sentence ends, repeated, or the user's."""
    rows = first_column(conversations, "conv_id", "turn", "role", "text")
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    rows = rows.select("conv_id", "turn", part("role").alias("role"), part("text").alias("text"), kind.alias("kind")).filter("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", SENTENCE_ENDS, "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("_copy")).drop("_copy")


def damage_and_repair(conversations: DataFrame) -> DataFrame:
    """The report of the damaged rows for every conv_id; without rows left: zeros, no audit, the digest of nothing."""
    ids = first_column(conversations, "conv_id").distinct().select(F.col("conv_id").alias("_id"))
    report = repair_report(damaged(conversations))
    joined = ids.join(report, F.col("conv_id").eqNullSafe(F.col("_id")), "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    digest = F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256")
    return joined.select(F.col("_id").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"), digest)
