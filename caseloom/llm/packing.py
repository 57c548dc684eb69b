"""Packing: first-fit decreasing with a tournament tree, run in randomised groups of documents.

Documents are cut into full pieces and a rest. Pieces carry only ids, lengths and
checksums; token ids never leave the task that made them.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.common import column, first_column, slices
from caseloom.llm.tokens import encoder
from caseloom.session import cut_lineage

#: Pieces of a group, on average. A group is packed in one task.
GROUP_PIECES = 8_192

PIECES = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "row")]
)


class CapacityTree:
    """Free room of bins 0..n-1; finds the first bin with enough of it in logarithmic time.

    A tournament: every inner node holds the larger room of its two children.
    """

    def __init__(self, bins: int, room: int):
        self.leaves = 1
        while self.leaves < bins:
            self.leaves *= 2
        self.room = [room] * (2 * self.leaves)

    def take(self, size: int) -> tuple[int, int]:
        """Put ``size`` into the first bin that has room; the bin and its room before."""
        room, node = self.room, 1
        while node < self.leaves:
            node *= 2
            if room[node] < size:
                node += 1
        before = room[node]
        room[node] = before - size
        bin_number = node - self.leaves
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
        return bin_number, before


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[tuple[int, int]]:
    """Bin and offset of every size, larger sizes placed first, ties in the given order."""
    placed: list[tuple[int, int]] = [(0, 0)] * len(sizes)
    full = 0
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    while full < len(order) and sizes[order[full]] == capacity:
        placed[order[full]] = (full, 0)
        full += 1
    tree = CapacityTree(max(1, len(order) - full), capacity)
    for i in order[full:]:
        number, before = tree.take(sizes[i])
        placed[i] = (full + number, capacity - before)
    return placed


def cut_documents(docs: DataFrame, path: str, end_id: int, capacity: int) -> DataFrame:
    """Pieces of every document's ids with ``end_id`` appended: full ones and the rest, with a row number."""

    def cut(batches):
        model, end = encoder(path), end_id.to_bytes(4, "little")
        row = TaskContext.get().partitionId() << 40
        for batch in slices(batches):
            rows = []
            for doc, ids in zip(column(batch, "doc_id"), model.ids(column(batch, "text", "")), strict=True):
                ids += end
                n = len(ids) // 4
                for start in range(0, n, capacity):
                    piece = ids[4 * start : 4 * (start + capacity)]
                    row += 1
                    rows.append((doc, start, len(piece) // 4, zlib.crc32(piece), n, row))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), PIECES, strict=True)], schema=PIECES)

    return first_column(docs, "doc_id", "text").mapInArrow(
        cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, row long"
    )


def pack(docs: DataFrame, path: str, end_id: int = 2, capacity: int = 4096, group_pieces: int = GROUP_PIECES, seed: int = 7) -> DataFrame:
    """One row per piece: document, start, length, checksum, its sequence and the offset there.

    Every id lies in exactly one piece; offsets of a sequence are gapless from 0 and
    its length is at most ``capacity``. A null or empty text is the end id alone.
    Repeated rows are packed each on its own and dealt to groups by their row numbers,
    missing ids stay missing, an empty table gives no rows, further columns are not
    looked at.
    """
    pieces = cut_lineage(cut_documents(docs, path, end_id, capacity), "pieces")
    groups = max(1, -(-pieces.count() // group_pieces))
    spread = F.xxhash64(F.lit(seed), "doc_id", "start", "ids_crc32", "length", "row")

    def place(key, rows):
        rows = rows.drop_columns("_group").sort_by([(c, "ascending") for c in ("doc_id", "start", "ids_crc32")])
        placed = first_fit_decreasing(rows.column("length").to_pylist(), capacity)
        sequences = pa.array([(key[0].as_py() << 32) + b for b, _ in placed], pa.int64())
        offsets = pa.array([o for _, o in placed], pa.int64())
        return rows.append_column("sequence_id", sequences).append_column("offset", offsets)

    return (
        pieces.withColumn("_group", F.pmod(spread, F.lit(groups)))
        .drop("row")
        .groupBy("_group")
        .applyInArrow(
            place,
            "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
        )
    )
