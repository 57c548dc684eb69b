"""Toxicity: every maximal scoring passage of token log-odds, judged by extreme-value statistics.

Training counts in how many toxic and other documents each word occurs. A word's
log-odds have a Dirichlet prior centred on the counts of all words with the same
beginning, so rare inflections of a known word are recognised. Each text is scanned
once for all its maximal scoring segments (Ruzzo and Tompa). Segment scores are put on
the scale of a random text of the same length by Karlin and Altschul's statistics,
whose constants come from the other documents; the passages of a document are
aggregated by the sum statistic of its best r segments, and a logistic curve fitted on
all training rows turns that into a probability.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.common import bounded, column, first_column, kept_rows, labelled_for_training, place_of, slices
from caseloom.session import cut_lineage

WORD = re.compile(r"\w+")
#: Entries of the word list and of the list of beginnings: below 2 MB when broadcast.
LEXICON = 20_000
#: Letters of a word's beginning.
BEGINNING = 4
#: Words that a task counts before it hands them on.
FLUSH = 300_000

SCORES = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("n_passages", pa.int64())])


@dataclass
class Model:
    """Word and beginning scores, extreme-value constants, and the final curve."""

    words: dict[str, float] = field(default_factory=dict)
    beginnings: dict[str, float] = field(default_factory=dict)
    gap: float = 0.5  # what any other word costs
    rate: float = 0.0  # lambda; 0 if nothing can be told apart
    factor: float = 1.0  # K
    intercept: float = 0.0
    slope: float = 0.0

    def spots(self, text: str) -> tuple[list[tuple[int, float]], int]:
        """Places and scores of the words that speak for toxicity, and the number of words."""
        words = WORD.findall(text.lower())
        known, starts, n = self.words, self.beginnings, BEGINNING
        found = [(i, known[w] if w in known else starts[w[:n]]) for i, w in enumerate(words) if w in known or w[:n] in starts]
        return found, len(words)

    def passages(self, text: str) -> tuple[list[tuple[int, int, float]], int]:
        """Every maximal passage (first word, end, score), and the number of words."""
        found, n = self.spots(text)
        return maximal_segments(found, self.gap), n

    def surprise(self, scores: Sequence[float], n: int) -> float:
        """-ln of the chance that a random text of ``n`` words has passages as good as the best r."""
        if not self.rate or not scores or not n:
            return 0.0
        best, total = 0.0, 0.0
        for r, s in enumerate(sorted(scores, reverse=True), 1):
            total += self.rate * s - math.log(self.factor * n)
            if total <= 0:
                break
            log_p = -total + (r - 1) * math.log(total) - math.lgamma(r + 1) - math.lgamma(r)
            if -log_p <= best and r > 1:
                break
            best = max(best, -log_p)
        return min(best, 200.0)

    def score(self, text: str | None) -> tuple[float, int]:
        segments, n = self.passages(text or "")
        z = self.intercept + self.slope * self.surprise([s for *_, s in segments], n)
        # a random text of this length has one such passage in twenty times
        bar = math.log(max(20 * self.factor * n, 1.0)) / self.rate if self.rate else math.inf
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z)))), sum(s > bar for *_, s in segments)


def maximal_segments(spots: Sequence[tuple[int, float]], gap: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments of a text in time linear in the number of spots.

    Words between two spots cost ``gap`` each; a segment starts and ends at a spot.
    """
    kept: list[list] = []  # first, end, sum before it, sum with it, place of the nearest lower sum before
    total, at = 0.0, 0
    for i, s in spots:
        total -= gap * (i - at)
        at = i + 1
        first, end, before, total = i, i + 1, total, total + s
        after = total
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= before:
                j = kept[j][4]
            if j < 0 or kept[j][3] >= after:
                kept.append([first, end, before, after, j])
                break
            first, before = kept[j][0], kept[j][2]
            del kept[j:]
    return [(a, b, hi - lo) for a, b, lo, hi, _ in kept]


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """``(text, label)`` of the rows to learn from; labels are broadcast only if they are few."""
    rows = cut_lineage(labelled_for_training(labels, label), "labels")
    texts = first_column(docs, "doc_id", "text").filter(F.col("text").isNotNull())
    return texts.join(F.broadcast(rows) if bounded(rows) else rows, "doc_id").select("text", "label")


def word_counts(texts: DataFrame) -> DataFrame:
    """``(word, toxic, other)``: documents of either kind that have the word."""
    schema = pa.schema([("word", pa.string()), ("toxic", pa.int64()), ("other", pa.int64())])

    def count(batches):
        seen = (Counter(), Counter())

        def rows():
            words = list(seen[0].keys() | seen[1].keys())
            columns = [words, [seen[0][w] for w in words], [seen[1][w] for w in words]]
            for c in seen:
                c.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for batch in slices(batches):
            for text, y in zip(column(batch, "text"), column(batch, "label"), strict=True):
                seen[0 if y == 1 else 1].update(set(WORD.findall(text.lower())))
            if len(seen[0]) + len(seen[1]) > FLUSH:
                yield rows()
        yield rows()

    parts = texts.mapInArrow(count, "word string, toxic long, other long")
    return parts.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def train(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", strength: float = 2.0, least: float = 2.0, lexicon: int = LEXICON
) -> Model:
    """Learn from every labelled document that is not held out.

    ``strength`` is the weight of the prior in documents, ``least`` the log-odds from
    which a word counts. Only word lists of at most ``lexicon`` entries and a table
    of counts per step of surprise come to the driver. Without documents of both
    kinds the score is the share of the label, 0 without any.
    """
    texts = labelled_texts(docs, labels, label)
    sizes = {r["label"]: r["n"] for r in texts.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = sizes.pop(1, 0), sum(sizes.values())
    if not n1 or not n0:
        return Model(intercept=30.0 if n1 else -30.0)
    counts = cut_lineage(word_counts(texts), "words")
    start = F.substring("word", 1, BEGINNING).alias("start")
    starts = counts.groupBy(start).agg(F.sum("toxic").alias("t"), F.sum("other").alias("o"))
    base = n1 / (n1 + n0)
    starts = starts.withColumn("share", (F.col("t") + 2 * base) / (F.col("t") + F.col("o") + 2))
    # the prior of a word: `strength` documents, dealt to the kinds as its beginning's are
    words = counts.filter("toxic >= 2").withColumn("start", start).join(starts.select("start", "share"), "start")

    def odds(toxic, other):
        """Log-odds ratio less its standard deviation: rare words have to prove more."""
        return F.log(toxic / other) - math.log(n1 / n0) - F.sqrt(1 / toxic + 1 / other)

    start_odds = odds(F.col("t") + 2 * base, F.col("o") + 2 * (1 - base))
    word_odds = odds(F.col("toxic") + strength * F.col("share"), F.col("other") + strength * (1 - F.col("share")))

    def top(df, name, odds, weight):
        rows = df.select(name, odds.alias("s"), weight.alias("w")).filter(F.col("s") >= least)
        return {r[name]: r["s"] for r in rows.orderBy(F.desc(F.col("s") * F.sqrt("w")), name).limit(lexicon).collect()}

    model = Model(top(words, "word", word_odds, F.col("toxic")), top(starts.filter("t >= 3"), "start", start_odds, F.col("t")))
    return _calibrated(texts, model)


def _calibrated(texts: DataFrame, model: Model) -> Model:
    """Constants of the extreme-value statistics, then the curve, from all training rows."""
    spark = texts.sparkSession
    given = spark.sparkContext.broadcast(model)
    seen = pa.schema([("label", pa.int32()), ("n", pa.int64()), ("spots", pa.list_(pa.float64())), ("found", pa.list_(pa.float64()))])

    def look(batches):
        m = given.value
        for batch in slices(batches):
            rows = []
            for text, y in zip(column(batch, "text"), column(batch, "label"), strict=True):
                spots, n = m.spots(text)
                found = [s for *_, s in maximal_segments(spots, m.gap)]
                rows.append((1 if y == 1 else 0, n, [round(s, 1) for _, s in spots], found))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), seen, strict=True)], schema=seen)

    stats = cut_lineage(texts.mapInArrow(look, "label int, n long, spots array<double>, found array<double>"), "passages")
    clean = stats.filter("label = 0")
    words = clean.agg(F.sum("n")).first()[0] or 0
    steps = clean.select(F.explode("spots").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("k")).collect()
    model.rate = _rate([(r["s"], r["k"]) for r in steps], words, model.gap)
    if not model.rate:
        model.rate = 1.0  # no clean document has a listed word
    best = F.coalesce(F.array_max("found"), F.lit(0.0))
    row = clean.agg(F.count(F.lit(1)).alias("d"), F.sum(F.col("n") * F.exp(-model.rate * best)).alias("e")).first()
    model.factor = max(row["d"] / row["e"], 1e-9) if row["e"] else 1.0
    fixed = spark.sparkContext.broadcast(model)
    binned = pa.schema([("label", pa.int32()), ("x", pa.float64())])

    def measure(batches):
        m = fixed.value
        for batch in batches:
            x = [round(4 * m.surprise(f, n)) / 4 for f, n in zip(column(batch, "found"), column(batch, "n"), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int32()), pa.array(x, pa.float64())], schema=binned)

    rows = stats.select("label", "n", "found").mapInArrow(measure, "label int, x double")
    table = rows.groupBy("label", "x").agg(F.count(F.lit(1)).alias("k")).collect()  # at most 2 x 801 rows
    model.intercept, model.slope = _curve([(r["x"], r["label"], r["k"]) for r in table])
    return model


def _rate(steps: list[tuple[float, int]], words: int, gap: float) -> float:
    """The positive root of sum p(s) exp(rate * s) = 1 over a clean word's scores s."""
    hits = sum(k for _, k in steps)
    if not hits or words <= hits:
        return 0.0
    p = [(s, k / words) for s, k in steps] + [(-gap, 1 - hits / words)]
    if sum(s * q for s, q in p) >= 0:
        return 0.0

    def excess(rate):
        return sum(q * math.exp(min(rate * s, 300.0)) for s, q in p) - 1

    low, high = 0.0, 1e-3
    while excess(high) < 0:
        low, high = high, high * 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return high


def _curve(table: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Logistic regression on one number by Newton steps, lightly held near zero."""
    x, y, k = (np.array(c, float) for c in zip(*table, strict=True))
    a = math.log((np.sum(k * y) + 0.5) / (np.sum(k * (1 - y)) + 0.5))
    b = 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30)))
        w = k * p * (1 - p)
        g = np.array([np.sum(k * (y - p)), np.sum(k * (y - p) * x) - 0.01 * b])
        h = np.array([[np.sum(w) + 1e-6, np.sum(w * x)], [np.sum(w * x), np.sum(w * x * x) + 0.01]])
        step = np.linalg.solve(h, g)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(max(b, 0.0))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score, n_passages)`` for every row of ``docs (doc_id, text)``.

    Null and empty texts have no passage and get the score of a text without any;
    repeated rows and missing ids give a row each; an empty table gives none; further
    columns are not looked at.
    """
    given = docs.sparkSession.sparkContext.broadcast(model)

    def rate(batches):
        m = given.value
        for batch in slices(batches):
            rows = [m.score(t) for t in column(batch, "text")]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": column(batch, "doc_id"), "score": [s for s, _ in rows], "n_passages": [n for _, n in rows]}, SCORES
            )

    return first_column(docs, "doc_id", "text").mapInArrow(rate, "doc_id long, score double, n_passages long")


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` below the threshold, all columns as they are; nothing is shuffled.

    Each row is judged by its own whole text, rows without id and repeated ones like any
    other; null and empty texts have the score of a text without a passage; an empty table
    stays empty; columns whose names clash are kept.
    """
    given, place = docs.sparkSession.sparkContext.broadcast(model), place_of(docs, "text")

    def make_test():
        m = given.value
        return lambda batch: [m.score(t)[0] < threshold for t in batch.column(place).to_pylist()]

    return kept_rows(docs, make_test)


def passages(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, first_word, end_word, score)``: every maximal toxic passage of every text."""
    given = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("first_word", pa.int64()), ("end_word", pa.int64()), ("score", pa.float64())])

    def find(batches):
        m = given.value
        for batch in slices(batches):
            rows = [(d, *p) for d, t in zip(column(batch, "doc_id"), column(batch, "text", ""), strict=True) for p in m.passages(t)[0]]
            columns = zip(*rows, strict=True) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return first_column(docs, "doc_id", "text").mapInArrow(find, "doc_id long, first_word long, end_word long, score double")
