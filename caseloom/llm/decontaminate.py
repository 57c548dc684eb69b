"""Benchmark decontamination: n-gram seeds with an exact bound, then Smith-Waterman alignment.

Every document is searched for the seeds of the test items: pairs of words that are
neighbours or one word apart, in the item as in the text; of a one-word item, the word. A copy that reaches the score
leaves at least ``LEAST_SCORE`` times the item's words, less one, of its pairs of
successive equal words with at most one word changed, left out or put in between; a
text with fewer seeds of an item within its reach holds no copy of it. All others are
aligned with the item word by word, so copies with words changed, left out or put in
are scored by what remains. How many documents hold a seed plays no part.

The test items are a given query set. They are taken in blocks of a bounded number of
seeds, each block broadcast and held against all documents.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.common import WordHashes, column, first_column, kept_rows, mixed, odd_numbers, place_of, slices
from caseloom.session import cut_lineage

WORD = re.compile(r"\w+")
#: Distances of the words of a seed.
APART = (1, 2)
#: Words of a text that are searched at a time.
PART_WORDS = 4_096
#: Bits of a seed's hash that the first look-up goes by.
LOOK_BITS = 20
#: Test items broadcast at a time, and bytes of their texts.
BLOCK_ITEMS, BLOCK_BYTES = 2_000, 4 << 20
MATCH, MISMATCH, GAP = 2, -1, -1
#: Share of the score of a verbatim copy from which a passage counts as one.
LEAST_SCORE = 0.5
#: Words that must be aligned, or all of a shorter item.
LEAST_WORDS = 8

SCORES = pa.schema(
    [("doc_id", pa.int64()), ("item_id", pa.int64()), ("first_word", pa.int64()), ("end_word", pa.int64()), ("matched", pa.int64()), ("score", pa.float64())]
)


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def pair_hashes(h: np.ndarray, apart: int) -> np.ndarray:
    """Hash of every two word hashes that lie ``apart`` words from each other, in order."""
    first, second = odd_numbers(2, 17)
    return mixed(h[: len(h) - apart] * first + h[apart:] * second) if len(h) > apart else np.empty(0, np.uint64)


class Seeds:
    """Sorted hashes of the word pairs of a block of items, with the items and places they come from."""

    def __init__(self, items: list[tuple[int, list[str]]], least_score: float = LEAST_SCORE):
        hashes, found = WordHashes(), []
        self.items = [(number, words) for number, words in items if words]
        for at, (_, words) in enumerate(self.items):
            h = hashes([w.encode() for w in words])
            found += [(g, at, place) for apart in (APART if len(words) > 1 else (0,)) for place, g in enumerate(pair_hashes(h, apart).tolist())]
        self.apart = APART if all(len(words) > 1 for _, words in self.items) else (0, *APART)
        found.sort()
        grams = np.array([g for g, _, _ in found], np.uint64)
        self.grams, self.begin, self.count = np.unique(grams, return_index=True, return_counts=True)
        self.item = np.array([at for _, at, _ in found], np.int64)
        self.place = np.array([place for _, _, place in found], np.int64)
        self.look = np.zeros(1 << LOOK_BITS, bool)
        self.look[self.grams >> np.uint64(64 - LOOK_BITS)] = True
        self.least_score = least_score
        self.lengths = np.array([len(words) for _, words in self.items], np.int64)
        # equal words w and errors e of a copy: 2w - e >= 2 * least_score * length, and pairs with two errors use them up
        self.need = np.array([max(1, math.ceil(n * least_score - 1 - 1e-9)) for n in self.lengths.tolist()], np.int64)
        # no more errors than that, so no words farther from where they would be
        self.shift = np.array([int(2 * n * (1 - least_score) + 1e-9) for n in self.lengths.tolist()], np.int64)

    def _hits(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Item, place in it and word of every seed."""
        items, places, words = [], [], []
        for apart in self.apart:
            got = pair_hashes(h, apart)
            where = np.flatnonzero(self.look[got >> np.uint64(64 - LOOK_BITS)])
            at = np.minimum(np.searchsorted(self.grams, got[where]), len(self.grams) - 1)
            equal = self.grams[at] == got[where]
            where, at = where[equal], at[equal]
            count = self.count[at]
            row = np.repeat(self.begin[at] - (np.cumsum(count) - count), count) + np.arange(count.sum())
            items.append(self.item[row])
            places.append(self.place[row])
            words.append(np.repeat(where, count))
        return np.concatenate(items), np.concatenate(places), np.concatenate(words)

    def _offsets(self, h: np.ndarray, first: int, found: dict[int, list[int]]) -> None:
        """Adds, per item, where a copy may begin: offsets followed closely by as many seeds as a copy has."""
        item, place, word = self._hits(h)
        enough = np.bincount(item, minlength=len(self.items)) >= self.need
        if not enough[item].any():
            return
        item, place, word = (x[enough[item]] for x in (item, place, word))
        places = np.unique(item << 32 | place) >> 32  # a copy has each place of the item once
        enough = np.bincount(places, minlength=len(self.items)) >= self.need
        item, place, word = (x[enough[item]] for x in (item, place, word))
        order = np.sort((item << 32) + (1 << 30) + word - place)
        item = order >> 32
        near = np.searchsorted(order, order + self.shift[item], "right") - np.arange(len(order))
        for x in np.unique(order[near >= self.need[item]]).tolist():
            found[x >> 32].append(first + (x & ((1 << 32) - 1)) - (1 << 30))

    def passages(self, words: list[str], h: np.ndarray) -> list[tuple[int, int, int, list[str], int]]:
        """(item, number, first word, words, offsets) of the stretches that may hold a copy of an item.

        A stretch is at most as long as the longest copy and the item, three lengths of
        it, and begins a length behind the one before, so each copy lies in one of them.
        """
        if not len(self.grams):
            return []
        found, overlap = defaultdict(list), int((2 * self.lengths + self.shift).max())
        for first in range(0, len(h), PART_WORDS):
            self._offsets(h[first : first + PART_WORDS + overlap], first, found)
        out = []
        for at in sorted(found):
            length, shift = int(self.lengths[at]), int(self.shift[at])
            runs: list[list[int]] = []
            for offset in sorted(set(found[at])):
                start, end = max(0, offset - shift), min(len(words), offset + length + shift)
                if runs and start <= runs[-1][1]:
                    runs[-1][1:] = [max(end, runs[-1][1]), runs[-1][2] + 1]
                elif start < end:
                    runs.append([start, end, 1])
            piece, reach = 0, 2 * length + shift
            for start, end, offsets in runs:
                for first in range(start, max(start + 1, end - reach + length), length):
                    out.append((self.items[at][0], piece, first, words[first : min(first + reach, end)], offsets))
                    piece += 1
        return out


def align(item: list[int], passage: list[int]) -> tuple[int, int, int, int]:
    """Best local alignment of two word sequences: score, first word, end, equal words.

    One row of the matrix at a time; gaps along a row are a running maximum.
    """
    p = np.array(passage)
    steps = np.arange(1, len(p) + 1)
    rows = [np.zeros(len(p) + 1, np.int64)]
    for word in item:
        above = rows[-1]
        best = np.maximum(above[:-1] + np.where(p == word, MATCH, MISMATCH), above[1:] + GAP)
        best = np.maximum(best, 0)
        row = np.zeros(len(p) + 1, np.int64)
        row[1:] = np.maximum.accumulate(best - GAP * steps) + GAP * steps
        rows.append(row)
    table = np.array(rows)
    i, j = np.unravel_index(int(table.argmax()), table.shape)
    score, end, matched = int(table[i, j]), int(j), 0
    while i and j and table[i, j] > 0:
        same = p[j - 1] == item[i - 1]
        if table[i, j] == table[i - 1, j - 1] + (MATCH if same else MISMATCH):
            matched += bool(same)
            i, j = i - 1, j - 1
        elif table[i, j] == table[i - 1, j] + GAP:
            i -= 1
        else:
            j -= 1
    return score, int(j), end, matched


def copies(item: list[str], stretches: list[tuple[int, list[str]]], least_score: float, least_words: int) -> list[tuple[int, int, int, float]]:
    """(first word, end, equal words, score) of the copies of an item in stretches of a text, none over another.

    The best alignment of all stretches comes first; what lies left and right of it is
    aligned again, until no part reaches the score.
    """
    numbers: dict[str, int] = {}
    wanted = [numbers.setdefault(w, len(numbers)) for w in item]
    most = np.bincount(wanted)
    aligned: list[tuple] = []

    def best(start: int, p: np.ndarray) -> None:
        """Keeps the best alignment of a part, if the words it shares with the item allow the score."""
        shared = int(np.minimum(np.bincount(p[p >= 0], minlength=len(most)), most).sum())
        if shared < least_score * len(item) or shared < min(least_words, len(item)):
            return
        total, a, b, matched = align(wanted, p)
        if b > a and total >= least_score * MATCH * len(item):
            heappush(aligned, (-total, start + a, start + b, matched, start, len(p), p.tobytes()))

    for first, words in stretches:
        best(first, np.array([numbers.get(w, -1) for w in words], np.int64))
    starts, ends, rows = [], [], []  # spans that are settled, in order
    while aligned:
        total, a, b, matched, start, n, part = heappop(aligned)
        p = np.frombuffer(part, np.int64)
        low, high = bisect_right(ends, start), bisect_left(starts, start + n)  # settled spans that reach into the part
        if bisect_right(ends, a) == bisect_left(starts, b):
            at = bisect_left(starts, b)
            starts.insert(at, a)
            ends.insert(at, b)
            high += 1
            if matched >= min(least_words, len(item)):
                rows.append((a, b, matched, -total / (MATCH * len(item))))
        free = start
        for x, y in [*zip(starts[low:high], ends[low:high], strict=True), (start + n, start + n)]:
            if x > free:
                best(free, p[free - start : x - start])
            free = max(free, y)
    return sorted(rows)


def _blocks(benchmark: DataFrame, size: int, size_bytes: int) -> Iterator[dict[int, tuple[int | None, list[str]]]]:
    """The items in blocks of about ``size`` items and ``size_bytes`` bytes at most, each a dict of row number to (item_id, words).

    Items are told apart by a stored row number: texts that share an id are items each, equal rows are one.
    """
    rows = first_column(benchmark, "item_id", "text").filter("text IS NOT NULL").distinct()
    items = cut_lineage(rows.withColumn("row", F.monotonically_increasing_id()), "items")
    n, total = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(-(-n // size), -(-total // size_bytes))
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block)
        found = {r["row"]: (r["item_id"], words_of(r["text"])) for r in part.collect()}
        if found:
            yield found


class Search:
    """Finds the copies of a block's items in texts."""

    def __init__(self, items: dict[int, tuple[int | None, list[str]]], least_score: float, least_words: int):
        self.items, self.least_score, self.least_words = items, least_score, least_words
        self.seeds, self.hashes = Seeds([(row, words) for row, (_, words) in items.items()], least_score), WordHashes()

    def __call__(self, text: str | None) -> Iterator[tuple[int | None, int, int, int, float]]:
        """(item_id, first word, end, equal words, score) of every copy."""
        words = words_of(text)
        found = self.seeds.passages(words, self.hashes([w.encode() for w in words])) if words else []
        for row, stretches in groupby(found, lambda p: p[0]):
            item, wanted = self.items[row]
            parts = [(first, part) for _, _, first, part, _ in stretches]
            for copy in copies(wanted, parts, self.least_score, self.least_words):
                yield item, *copy


def contaminated(
    docs: DataFrame, benchmark: DataFrame, least_score: float = LEAST_SCORE, least_words: int = LEAST_WORDS,
    block_items: int = BLOCK_ITEMS, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``(doc_id, item_id, first_word, end_word, matched, score)``: passages that copy a test item.

    ``score`` is the alignment's share of a verbatim copy's. Null and empty texts and
    items copy nothing; an item of a few words needs all of them. Items that share an id are
    searched for each by its own text, equal rows of an item once; items and documents without id
    are searched, too, and their passages have none; repeated rows of a document give
    its passages again. Very long texts are searched in parts that overlap by the longest copy.
    Empty tables give no rows; further columns are not looked at.
    """
    out = None
    for block in _blocks(benchmark, block_items, block_bytes):
        found = _in_block(first_column(docs, "doc_id", "text"), block, least_score, least_words)
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = docs.sparkSession.createDataFrame([], "doc_id long, item_id long, first_word long, end_word long, matched long, score double")
    return out


def _in_block(docs: DataFrame, block: dict[int, tuple[int | None, list[str]]], least_score: float, least_words: int) -> DataFrame:
    given = docs.sparkSession.sparkContext.broadcast(block)

    def find(batches):
        search = Search(given.value, least_score, least_words)
        for batch in slices(batches):
            rows = [(doc, *copy) for doc, text in zip(column(batch, "doc_id"), column(batch, "text"), strict=True) for copy in search(text)]
            columns = zip(*rows, strict=True) if rows else [[]] * len(SCORES)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SCORES, strict=True)], schema=SCORES)

    return docs.mapInArrow(find, "doc_id long, item_id long, first_word long, end_word long, matched long, score double")


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, least_score: float = LEAST_SCORE, least_words: int = LEAST_WORDS,
    block_items: int = BLOCK_ITEMS, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``docs`` whose text copies no test item, all columns as they are; nothing is shuffled.

    Each row is judged by its own text in the task that has it, so a row without id goes like any other
    and a clean row stays beside another of its id. Otherwise as ``contaminated``; columns
    whose names clash are kept.
    """
    place = place_of(docs, "text")
    for block in _blocks(benchmark, block_items, block_bytes):
        given = docs.sparkSession.sparkContext.broadcast(block)

        def make_test(given=given):
            search = Search(given.value, least_score, least_words)
            return lambda batch: [next(search(text), None) is None for text in batch.column(place).to_pylist()]

        docs = kept_rows(docs, make_test)
    return docs
