"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

The metadata is the stated length, ``n_chars``, and how far it is from the text's real one.

score = w0 + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2): all pairwise
interactions in time linear in the number of features of a text.
"""

from __future__ import annotations

import io
import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.common import CACHE_CHARS, CACHE_WORDS, column, first_column, kept_rows, labelled_for_training, place_of, slices
from caseloom.session import cut_lineage

#: Labelled rows that the model is fitted on at most, taken by a hash of their ids.
SAMPLE_ROWS = 10_000
#: Hash buckets for words.
BUCKETS = 1 << 15
#: Parts that each statistic's range is cut into.
BINS = 8
RANK = 8
EPOCHS = 12
BATCH = 128

LINES = re.compile(r"[^\n]+")
#: Statistics, the last ``META`` of them from metadata; a missing one has a feature of its own.
STATS, META = 20, 2

SCORES = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


class Features:
    """Hashed words with weights, and statistics of a text's structure and size."""

    def __init__(self, buckets: int = BUCKETS, limit: int = CACHE_WORDS):
        self.buckets, self.limit = buckets, limit
        self.known: dict[str, int] = {}

    def places(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > self.limit:
            known.clear()
        values = list(map(known.get, words))
        if None in values:
            for i, v in enumerate(values):
                if v is None:
                    values[i] = v = xxhash.xxh64_intdigest(words[i]) % self.buckets
                    if len(words[i]) <= CACHE_CHARS:
                        known[words[i]] = v
        return np.array(values, np.int64)

    def __call__(self, text: str | None, n_chars=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct buckets, their weights (of length 1 together), the statistics."""
        text = text or ""
        words = text.split()
        ids = self.places([w.lower() for w in words])
        places, counts = np.unique(ids, return_counts=True)
        weights = np.log1p(counts)
        if len(weights):
            weights /= np.sqrt((weights**2).sum())
        stats = np.concatenate([self.statistics(text, words, ids, counts), self.metadata(text, n_chars)])
        return places, weights.astype(np.float32), stats

    @staticmethod
    def statistics(text: str, words: list[str], ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        n, chars, lines = max(len(words), 1), max(len(text), 1), LINES.findall(text)
        size = len(text.encode())
        stats = [
            np.log2(n),
            chars / n,
            sum(map(str.isupper, words)) / n,
            sum(map(str.istitle, words)) / n,
            sum(map(str.isalpha, words)) / n,
            sum(map(text.count, "#*$%&<>")) / n,
            text.count("|") / n,
            text.count("!") / n,
            sum(map(text.count, "0123456789")) / chars,
            len(counts) / n,
            float((ids[1:] == ids[:-1]).sum()) / n,
            (int(counts.max()) if len(counts) else 0) / n,
            text.count(".") / n,
            text.count(",") / n,
            len(lines) / n,
            1 - len(set(lines)) / max(len(lines), 1),
            sum(map(text.count, "{}();=_/\\@:")) / chars,
            (size - len(text)) / chars,
        ]
        return np.array(stats, np.float32)

    @staticmethod
    def metadata(text: str, n_chars) -> np.ndarray:
        """Stated length and its difference from the real one; not a number where none is stated."""
        if not isinstance(n_chars, int | float) or not math.isfinite(n_chars):
            return np.full(META, np.nan, np.float32)
        return np.array([np.log2(1 + max(n_chars, 0)), (n_chars - len(text)) / max(len(text), 1)], np.float32)


@dataclass
class Model:
    """``edges`` cut the statistics into bins; features are words first, then bins, then missing metadata."""

    edges: np.ndarray
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def rows(self, places: np.ndarray, weights: np.ndarray, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return with_bins(self.edges, places, weights, stats, len(self.linear) - STATS * BINS - META)

    def score(self, places: np.ndarray, weights: np.ndarray, stats: np.ndarray) -> float:
        if not len(self.linear):
            return self.bias
        i, x = self.rows(places, weights, stats)
        v = self.factors[i] * x[:, None]
        s = v.sum(axis=0)
        z = self.bias + float(self.linear[i] @ x) + 0.5 * float((s * s).sum() - (v * v).sum())
        return 1.0 / (1.0 + float(np.exp(-np.clip(z, -30, 30))))

    def packed(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, edges=self.edges, bias=np.float64(self.bias), linear=self.linear, factors=self.factors)
        return out.getvalue()

    @staticmethod
    def unpacked(raw: bytes) -> Model:
        z = np.load(io.BytesIO(raw))
        return Model(z["edges"], float(z["bias"]), z["linear"], z["factors"])


def with_bins(edges, places, weights, stats, buckets):
    bins = (stats[:, None] > edges).sum(axis=1) + np.arange(STATS) * BINS + buckets
    missing = np.flatnonzero(np.isnan(stats))
    bins[missing] = buckets + STATS * BINS + missing - (STATS - META)
    return np.concatenate([places, bins]), np.concatenate([weights, np.full(STATS, 0.5, np.float32)])


def fit(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]], labels: np.ndarray, buckets: int = BUCKETS, seed: int = 5) -> Model:
    """Logistic loss, AdaGrad steps over shuffled mini-batches; the same for the same rows."""
    stats = np.array([s for *_, s in rows])
    known = np.where(np.isnan(stats).all(axis=0), 0, stats)
    edges = np.nanquantile(known, np.arange(1, BINS) / BINS, axis=0).T.astype(np.float32)
    # junk is rare: also tell apart the far ends of each statistic
    edges[:, 0], edges[:, -1] = np.nanquantile(known, 0.03, axis=0), np.nanquantile(known, 0.97, axis=0)
    edges.sort(axis=1)
    cells = [with_bins(edges, p, w, s, buckets) for p, w, s in rows]
    size = buckets + STATS * BINS + META
    rng = np.random.default_rng(seed)
    linear, factors = np.zeros(size), rng.normal(0, 0.05, (size, RANK))
    share = labels.mean()
    bias = float(np.log(share / (1 - share)))
    g_linear, g_factors, g_bias = np.full(size, 1e-2), np.full((size, RANK), 1e-2), 1e-2
    step, decay = 0.08, 1e-5
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for start in range(0, len(order), BATCH):
            some = order[start : start + BATCH]
            i = np.concatenate([cells[r][0] for r in some])
            x = np.concatenate([cells[r][1] for r in some]).astype(np.float64)
            ends = np.cumsum([len(cells[r][0]) for r in some])
            starts = np.concatenate([[0], ends[:-1]])
            doc = np.repeat(np.arange(len(some)), np.diff(np.concatenate([[0], ends])))
            v = factors[i] * x[:, None]
            s = np.add.reduceat(v, starts)
            z = bias + np.add.reduceat(linear[i] * x, starts) + 0.5 * ((s * s).sum(1) - np.add.reduceat((v * v).sum(1), starts))
            err = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[some]
            used, at = np.unique(i, return_inverse=True)
            d = err[doc] * x
            gl = np.bincount(at, d, len(used)) + decay * linear[used]
            gf_rows = d[:, None] * (s[doc] - v)
            gf = np.stack([np.bincount(at, gf_rows[:, f], len(used)) for f in range(RANK)], 1) + decay * factors[used]
            g_linear[used] += gl * gl
            g_factors[used] += gf * gf
            g_bias += err.sum() ** 2
            linear[used] -= step * gl / np.sqrt(g_linear[used])
            factors[used] -= 0.5 * step * gf / np.sqrt(g_factors[used])
            bias -= step * err.sum() / np.sqrt(g_bias)
    return Model(edges, bias, linear.astype(np.float32), factors.astype(np.float32))


def _states_length(docs: DataFrame) -> bool:
    return "n_chars" in [c.lower() for c in docs.columns]


def _given(docs: DataFrame) -> DataFrame:
    """``(doc_id, text, n_chars)``, the last null where the table has none."""
    stated = ["n_chars"] if _states_length(docs) else []
    rows = first_column(docs, "doc_id", "text", *stated)
    return rows if stated else rows.withColumn("n_chars", F.lit(None).cast("long"))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on at most ``sample_rows`` labelled documents that are not held out.

    The sample is bounded, so one task fits the model; a megabyte comes to the driver.
    Without documents of both kinds every score is the share of the label, 1 without any;
    rows without id are not learned from, repeated ids count once.
    """
    ids = labelled_for_training(labels, label)
    chosen = cut_lineage(ids.orderBy(F.xxhash64(F.lit(11), "doc_id"), "doc_id").limit(sample_rows), "sample")
    texts = _given(docs).join(F.broadcast(chosen), "doc_id")  # at most sample_rows ids
    # an id may have rows with different texts: the least by its hash speaks for it, however the rows are read
    own = F.min_by(F.struct("text", "n_chars", "label"), F.struct(F.xxhash64("text"), "n_chars"))
    texts = cut_lineage(texts.groupBy("doc_id").agg(own.alias("own")).select("doc_id", "own.*"), "sample")

    def learn(batches):
        features, rows, kinds = Features(), [], []
        for batch in slices(batches):
            rows += map(features, column(batch, "text"), column(batch, "n_chars"))
            kinds += column(batch, "label")
        y = np.array([float(k == 1) for k in kinds])
        model = fit(rows, y) if 0 < y.sum() < len(y) else Model(np.zeros(0), float(y.mean()) if len(y) else 1.0, np.zeros(0), np.zeros((0, RANK)))
        yield pa.RecordBatch.from_pydict({"model": [model.packed()]}, pa.schema([("model", pa.binary())]))

    # sorted, so that the model is the same however the sample was read
    raw = texts.coalesce(1).sortWithinPartitions("doc_id").mapInArrow(learn, "model binary").collect()
    return Model.unpacked(bytes(raw[0]["model"])) if raw else Model(np.zeros(0), 1.0, np.zeros(0), np.zeros((0, RANK)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score)`` for every row of ``docs (doc_id, text, n_chars)``, each from the whole text.

    Null and empty texts have no words and the statistics of an empty text; ``n_chars``
    may be null or not there, as in the rows the model was fitted on; repeated
    rows and missing ids give a row each; an empty table gives none; further columns
    are not looked at.
    """
    given = docs.sparkSession.sparkContext.broadcast(model.packed())

    def rate(batches):
        m, features = Model.unpacked(given.value), Features()
        for batch in slices(batches):
            scores = [m.score(*features(t, n)) for t, n in zip(column(batch, "text"), column(batch, "n_chars"), strict=True)]
            yield pa.RecordBatch.from_pydict({"doc_id": column(batch, "doc_id"), "score": scores}, SCORES)

    return _given(docs).mapInArrow(rate, "doc_id long, score double")


def with_quality(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that reach the threshold, all columns as they are; nothing is shuffled.

    Each row is judged by its own whole text, rows without id and repeated ones like any
    other; null and empty texts have the statistics of an empty text; an empty table stays
    empty; columns whose names clash are kept.
    """
    given, place = docs.sparkSession.sparkContext.broadcast(model.packed()), place_of(docs, "text")
    stated = place_of(docs, "n_chars") if _states_length(docs) else None

    def make_test():
        m, features = Model.unpacked(given.value), Features()

        def test(batch):
            lengths = [None] * batch.num_rows if stated is None else batch.column(stated).to_pylist()
            return [m.score(*features(t, n)) >= threshold for t, n in zip(batch.column(place).to_pylist(), lengths, strict=True)]

        return test

    return kept_rows(docs, make_test)
