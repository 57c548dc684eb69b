"""Token counts: a broadcast table of frequent pre-tokens, the rest by the workers' own tables.

Nothing is shuffled. The frequent table is fitted on a bounded sample and only saves
time: a pre-token outside it is encoded by the library and kept in the worker's table.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.common import CACHE_CHARS, CACHE_WORDS, column, first_column, slices
from caseloom.llm.tokens import Encoder

#: Documents that the table of frequent pre-tokens is fitted on, and their greatest length: below 40 MB.
SAMPLE_DOCS = 2_000
SAMPLE_CHARS = 20_000
#: Entries of that table, each of at most 64 characters: below 20 MB when broadcast.
FREQUENT = 50_000

COUNTS = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


class TwoTierCounts:
    """Number of tokens of a text: frequent lengths first, then the worker's own table."""

    def __init__(self, path: str, table: tuple[str, bytes], limit: int = CACHE_WORDS):
        self.encoder = Encoder(path)
        parts, lengths = table
        self.frequent = dict(zip(parts.split("\0"), lengths, strict=True)) if lengths else {}
        self.recent: dict[str, int] = {}
        self.limit = limit

    def __call__(self, texts: list[str]) -> list[int]:
        cuts = [self.encoder.cut(t) if t else [] for t in texts]
        lists = [c for c in cuts if c]
        new: dict[str, int] = {}
        if lists:
            if len(self.recent) > self.limit:
                self.recent.clear()
            need = list(set().union(*lists).difference(self.frequent).difference(self.recent))
            for start in range(0, len(need), 4096):
                some = need[start : start + 4096]
                counts = self.encoder.encode_parts(some)[1].tolist()
                for part, n in zip(some, counts, strict=True):
                    (self.recent if len(part) <= CACHE_CHARS else new)[part] = n
        often, recent, out = self.frequent, self.recent, []
        for text, parts in zip(texts, cuts, strict=True):
            if parts is None:
                out.append(len(self.encoder.whole(text)))
            else:
                out.append(sum([often[p] if p in often else recent[p] if p in recent else new[p] for p in parts]))
        return out


def frequent_lengths(docs: DataFrame, path: str, sample_docs: int, sample_chars: int, size: int) -> tuple[str, bytes]:
    """The ``size`` most frequent pre-tokens of some documents with their token counts.

    At most ``sample_docs`` texts of at most ``sample_chars`` characters are taken,
    from as few partitions as hold them. One blob of parts and one byte per length;
    parts with more than 255 tokens, long ones and ones with a zero character are
    left to the second tier.
    """
    texts = first_column(docs, "text").filter(F.length("text") <= sample_chars).take(sample_docs)
    model, seen = Encoder(path), Counter()
    for row in texts:
        seen.update(model.cut(row["text"]) or ())
    top = [p for p, _ in seen.most_common(size) if len(p) <= CACHE_CHARS and "\0" not in p]
    counts = model.encode_parts(top)[1].tolist() if top else []
    kept = [(p, n) for p, n in zip(top, counts, strict=True) if n < 256]
    return "\0".join(p for p, _ in kept), bytes(n for _, n in kept)


def count_tokens(
    docs: DataFrame, path: str, limit: int = 512, sample_docs: int = SAMPLE_DOCS, frequent: int = FREQUENT
) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` for every row of ``docs (doc_id, text)``.

    Counts equal the library's for the file at ``path``. Null and empty texts have
    no bytes and no tokens; repeated rows and missing ids give a row each; an empty
    table gives none; further columns are not looked at.
    """
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path, sample_docs, SAMPLE_CHARS, frequent))

    def count(batches):
        counts = TwoTierCounts(path, table.value)
        for batch in slices(batches):
            texts = column(batch, "text", "")
            yield pa.RecordBatch.from_pydict(
                {"doc_id": column(batch, "doc_id"), "n_bytes": [len(t.encode()) for t in texts], "n_tokens": counts(texts)},
                COUNTS,
            )

    rows = first_column(docs, "doc_id", "text").mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)
