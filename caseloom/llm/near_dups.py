"""Near-duplicates: an inverted join on MinHash coordinates with prefix and skip merging.

A signature has ``COORDINATES`` minima of the shingle set. Two documents are compared
if their signatures agree in a least number of coordinates, the match threshold:

* post: a text's signature is posted under each (coordinate, value) pair;
* skip: a value that only one text has matches nothing and is left out. Each text may
  also skip one pair fewer than the threshold, its most frequent ones (a passage many
  texts share): two texts with that many common pairs have one in both of the remaining prefixes, as
  all texts order their pairs alike;
* count: texts that meet under a prefix pair have their collisions counted over the
  whole signatures, and the survivors are confirmed on the full shingle sets.

Only the grouping is asked for, so a posting list of n texts is not expanded into its
pairs. Each text is first compared with a few pivots of the list, the most typical text
among them. In lists that still hold several groups, texts of different groups are then
compared block by block through longer signatures, inside tasks; only pairs that agree
in nearly as much as linked texts do are put out, each under one list, and confirmed.
Every pair of different texts that meets under a prefix pair is thus either compared
or already in one group.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.common import WordHashes, column, first_column, matching, mixed, odd_numbers, slices, window_hashes
from caseloom.operators.graph import connected_components
from caseloom.session import cut_lineage

#: Coordinates of a signature, and of the longer one, which has a byte for each.
COORDINATES = 32
SKETCH = 1_024
#: Chance that two texts just similar enough agree in fewer coordinates than are asked for.
MISS = 1e-6
#: Texts of a list that meet in one task, once with themselves and once with each other block.
BLOCK = 1_024
#: Shingles whose minima are taken at a time.
CHUNK = 8_192

SIGNATURES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_shingles", pa.int64()),
        ("print_a", pa.int64()),
        ("print_b", pa.int64()),
        ("signature", pa.list_(pa.int32())),
    ]
)
SETS = pa.schema([("doc_id", pa.int64()), ("shingles", pa.list_(pa.int64())), ("sketch", pa.binary())])
PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def least_matches(coordinates: int, percent: int, miss: float = MISS) -> int:
    """Coordinates in which a pair of that similarity agrees with a chance of at least ``1 - miss``."""
    p, below, n = percent / 100, 0.0, 0
    while n < coordinates and p < 1:
        below += math.comb(coordinates, n) * p**n * (1 - p) ** (coordinates - n)
        if below > miss:
            return max(n, 1)
        n += 1
    return coordinates


def words_of(text: str | None) -> list[bytes]:
    """Words of a text, A-Z in lower case, cut at ASCII white space only."""
    return (text or "").encode().lower().split()


def shingle_set(words: list[bytes], hashes: WordHashes, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the word runs; of a shorter text, the whole as one."""
    if not words:
        return np.empty(0, np.uint64)
    h = hashes(words)
    if len(words) < width:
        return mixed(window_hashes(h, len(words)) + np.uint64(len(words)))
    return np.unique(window_hashes(h, width))


def minima(shingles: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each coordinate the least hash of the set, cut to its upper 32 bits after mixing."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), CHUNK):
        part = shingles[start : start + CHUNK, None] * factors + offsets
        part ^= part >> np.uint64(32)
        np.minimum(least, part.min(axis=0), out=least)
    return (mixed(least) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def signatures(docs: DataFrame, coordinates: int = COORDINATES, width: int = 5) -> DataFrame:
    """Per row: set size, a 128-bit print of the set, and the MinHash signature."""

    def sign(batches):
        hashes = WordHashes()
        factors, offsets = odd_numbers(coordinates, 1), odd_numbers(coordinates, 2)
        for batch in slices(batches):
            rows = []
            for doc, text in zip(column(batch, "doc_id"), column(batch, "text"), strict=True):
                s = shingle_set(words_of(text), hashes, width)
                prints = [int(mixed(s + np.uint64(salt)).sum(dtype=np.uint64).view(np.int64)) for salt in (3, 5)]
                rows.append((doc, len(s), *prints, minima(s, factors, offsets) if len(s) else []))
            arrays = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), SIGNATURES, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=SIGNATURES)

    return first_column(docs, "doc_id", "text").mapInArrow(
        sign, "doc_id long, n_shingles long, print_a long, print_b long, signature array<int>"
    )


def sketch_of(shingles: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> bytes:
    """A byte of each of ``SKETCH`` minima, in 32-bit arithmetic."""
    least = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(short), 512):
        part = short[start : start + 512, None] * factors + offsets
        np.minimum(least, part.min(axis=0), out=least)
    return (mixed(least.astype(np.uint64)) >> np.uint64(56)).astype(np.uint8).tobytes()


def shingle_sets(docs: DataFrame, width: int = 5) -> DataFrame:
    """Per row the full shingle set and the longer signature."""

    def collect(batches):
        hashes = WordHashes()
        factors, offsets = ((odd_numbers(SKETCH, seed) >> np.uint64(32)).astype(np.uint32) | np.uint32(1) for seed in (7, 9))
        for batch in slices(batches):
            sets = [shingle_set(words_of(t), hashes, width) for t in column(batch, "text")]
            sketches = [sketch_of(s, factors, offsets) for s in sets]
            arrays = [column(batch, "doc_id"), [s.view(np.int64) for s in sets], sketches]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(arrays, SETS, strict=True)], schema=SETS)

    return first_column(docs, "doc_id", "text").mapInArrow(collect, "doc_id long, shingles array<long>, sketch binary")


def prefix_postings(classes: DataFrame, matches: int) -> DataFrame:
    """``(key, rep, weight, keys)``: each text under the pairs that it may not skip.

    ``weight`` grows with the texts that share the text's pairs, ``keys`` are its pairs in order.
    """
    pairs = classes.select(
        "rep", F.posexplode("signature").alias("place", "value")
    ).select("rep", (F.shiftleft(F.col("place").cast("long"), 32) + F.col("value").cast("long") + F.lit(1 << 31)).alias("key"))
    shared = pairs.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # a text has at most one entry per coordinate here, so the array is bounded
    own = pairs.join(shared, "key").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("own"))
    own = own.filter(F.size("own") >= matches)
    # pairs that nobody shares come first in the order: they use up the prefix and match nothing
    kept = F.slice("own", F.lit(1), F.size("own") - (matches - 1))
    weight = F.aggregate("own", F.lit(0).cast("long"), lambda total, p: total + p["n"])
    rows = own.select("rep", weight.alias("weight"), F.transform(kept, lambda p: p["key"]).alias("keys"))
    return rows.select("rep", "weight", "keys", F.explode("keys").alias("key"))


def collided(pairs: DataFrame, classes: DataFrame, matches: int, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` whose signatures agree in enough coordinates and whose sizes allow a link."""

    def side(name):
        return classes.select(F.col("rep").alias(name), F.col("n_shingles").alias(f"n_{name}"), F.col("signature").alias(f"s_{name}"))

    sized = pairs.join(side("a"), "a").join(side("b"), "b")
    alike = F.size(F.filter(F.zip_with("s_a", "s_b", lambda x, y: x == y), lambda same: same))
    long_enough = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    return sized.filter(long_enough & (alike >= matches)).select("a", "b")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` with ``100 * common >= percent * union`` of their full sets."""
    full = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a")), "a").join(
        sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b")), "b"
    )
    common = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - common
    return full.filter(100 * common.cast("long") >= percent * union).select("a", "b")


def near_duplicates(
    docs: DataFrame, percent: int = 80, width: int = 5, coordinates: int = COORDINATES, miss: float = MISS
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` per row of ``docs (doc_id, text)``.

    Documents are linked if their sets of word shingles have a Jaccard similarity of
    at least ``percent`` in a hundred; ``component_id`` is the least doc_id reachable.
    Texts with equal sets form a class that is compared once. Null, empty and blank
    texts have no shingles and are linked with nothing; rows without id are linked
    with nothing and have no component; very long texts are taken whole; an
    empty table gives no rows; further columns are not looked at.

    Repeated rows of an id all have its result, so all of them are kept or none. Of rows that
    share an id but not their text the one with the least text hash speaks for it.
    """
    rows = first_column(docs, "doc_id", "text")
    hashed = rows.withColumn("_h", F.xxhash64("text"))
    spread = hashed.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("_h").alias("_least"), F.max("_h").alias("_most"))
    several = cut_lineage(spread.filter("_least <> _most").select(F.col("doc_id").alias("_id"), "_least"), "several")
    if several.isEmpty():
        return _near_duplicates(rows, percent, width, coordinates, miss)
    marked = hashed.join(several, F.col("doc_id") == F.col("_id"), "left")
    speaking = cut_lineage(marked.filter("_least IS NULL OR _h = _least").select("doc_id", "text"), "speaking")
    found = cut_lineage(_near_duplicates(speaking, percent, width, coordinates, miss), "found")
    of_several = matching(found, several.toDF("doc_id", "_least"), "doc_id", "left_semi").distinct()
    return found.unionByName(marked.filter("_h <> _least").select("doc_id").join(of_several, "doc_id"))


def _near_duplicates(docs: DataFrame, percent: int, width: int, coordinates: int, miss: float) -> DataFrame:
    """The same where all rows of an id have one text."""
    matches = least_matches(coordinates, percent, miss)
    signed = cut_lineage(signatures(docs, coordinates, width), "signatures")
    prints = ["print_a", "print_b", "n_shingles"]
    classes = cut_lineage(
        signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy(*prints)
        .agg(F.min("doc_id").alias("rep"), F.any_value("signature").alias("signature")),
        "classes",
    )
    postings = cut_lineage(prefix_postings(classes, matches), "postings")
    candidates = cut_lineage(postings.select(F.col("rep").alias("doc_id")).distinct(), "candidates")
    texts = matching(first_column(docs, "doc_id", "text"), candidates, "doc_id", "left_semi")
    sets = cut_lineage(shingle_sets(texts, width).dropDuplicates(["doc_id"]), "sets")

    typical = F.max_by("rep", F.struct("weight", "rep"))
    pivots = postings.groupBy("key").agg(typical.alias("p0"), F.min_by("rep", F.xxhash64("rep")).alias("p1"))
    starred = postings.select("rep", "key").join(pivots, "key").select("rep", F.explode(F.array("p0", "p1")).alias("pivot"))
    stars = _ordered(starred, "rep", "pivot").distinct()
    linked = cut_lineage(confirmed(collided(stars, classes, matches, percent), sets, percent), "links")
    components = connected_components(linked, "a", "b")

    rest = open_pairs(postings, components, classes, sets, percent, least_matches(SKETCH, percent, miss))
    # collisions of these were counted over the longer signatures, sizes compared
    more = cut_lineage(confirmed(rest, sets, percent), "links")
    if not more.isEmpty():
        components = _joined(components, more)

    grouped = classes.join(components.withColumnRenamed("node", "rep"), "rep", "left").select(
        *prints, F.coalesce("component", "rep").alias("component_id")
    )
    joined = signed.drop("signature").join(grouped, prints, "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return joined.select("doc_id", "n_shingles", own.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def _ordered(pairs: DataFrame, x: str, y: str) -> DataFrame:
    return pairs.filter(F.col(x) != F.col(y)).select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))


def _joined(components: DataFrame, links: DataFrame) -> DataFrame:
    """Components after further links, which join groups or single texts."""
    components = cut_lineage(components, "components")
    for side in ("a", "b"):
        named = components.select(F.col("node").alias(side), F.col("component").alias(f"group_{side}"))
        links = links.join(named, side, "left").withColumn(f"group_{side}", F.coalesce(f"group_{side}", side))
    merged = connected_components(links.select("group_a", "group_b"), "group_a", "group_b")
    merged = cut_lineage(merged.toDF("component", "merged"), "merged")
    moved = components.join(merged, "component", "left").select("node", F.coalesce("merged", "component").alias("component"))
    single = merged.join(components.select(F.col("node").alias("component")), "component", "left_anti")
    return moved.unionByName(single.select(F.col("component").alias("node"), F.col("merged").alias("component")))


def open_pairs(postings: DataFrame, components: DataFrame, classes: DataFrame, sets: DataFrame, percent: int, matches: int) -> DataFrame:
    """Pairs ``(a, b)`` that meet under a key, are in different groups and may be linked.

    A list is dealt into blocks of about ``BLOCK`` texts, and every two blocks meet in
    a task of their own. A pair is put out under the first key that both texts have.
    """
    member = (
        postings.select("key", "rep", "keys")
        .join(components.withColumnRenamed("node", "rep"), "rep", "left")
        .withColumn("component", F.coalesce("component", "rep"))
    )
    member = cut_lineage(member, "members")
    mixed_keys = member.groupBy("key").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("n")
    )
    mixed_keys = mixed_keys.filter("lo < hi").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    open_members = cut_lineage(member.join(mixed_keys, "key"), "open")
    needed = open_members.select("rep").distinct()
    known = needed.join(classes.select("rep", "n_shingles"), "rep").join(
        sets.select(F.col("doc_id").alias("rep"), "sketch"), "rep"
    )
    rows = open_members.join(known, "rep").withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumn("first", F.least("own", "other")).withColumn("second", F.greatest("own", "other"))

    def meet(key, table):
        rep, group, size = (np.array(table.column(c).to_pylist()) for c in ("rep", "component", "n_shingles"))
        own, keys = np.array(table.column("own").to_pylist()), table.column("keys").to_pylist()
        bytes_ = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(len(rep), SKETCH)
        here, first, second = (k.as_py() for k in key)
        names, counts = np.unique(group, return_counts=True)
        a, b = [], []
        if len(names) > 1:
            most = names[counts.argmax()]  # its members need not be held against each other
            for i in np.flatnonzero(group != most).tolist():
                # of two texts outside the largest group, the later one looks for the earlier
                test = (group != group[i]) & ((group == most) | (np.arange(len(rep)) < i))
                if first != second:
                    test &= own != own[i]
                test &= 100 * np.minimum(size, size[i]) >= percent * np.maximum(size, size[i])
                at = np.flatnonzero(test)
                alike = np.count_nonzero(bytes_[at] == bytes_[i], axis=1)
                for j in at[alike >= matches].tolist():
                    mine = set(keys[i])
                    if next(k for k in keys[j] if k in mine) == here:
                        a.append(min(rep[i], rep[j]))
                        b.append(max(rep[i], rep[j]))
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=PAIRS)

    columns = ["key", "first", "second", "rep", "component", "n_shingles", "own", "keys", "sketch"]
    return rows.select(*columns).groupBy("key", "first", "second").applyInArrow(meet, "a long, b long").distinct()
