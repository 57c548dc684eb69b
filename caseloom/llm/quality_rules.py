"""Quality rules: base counts of a text, then lines that recur across a host's documents.

Normalised lines are hashed; the distinct documents of a host that hold a line are
counted; lines above the limit are removed, and documents that lose more than half of
their words to that are rejected.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.common import column, first_column, slices
from caseloom.session import cut_lineage

WORD = re.compile(r"[^\x20\x09-\x0D]+")
WHITE = "\t\n\x0b\x0c\r "
#: Documents of one host that may share a line.
HOST_DOCS = 20
#: Digits count as equal in lines: page numbers and dates do not make a line another one.
DIGITS = str.maketrans("123456789", "000000000")

TEXTS = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [("row", pa.int64()), ("host", pa.string())]
    + [("lines", pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int64())])))]
)


def repeat_words(words: list[str]) -> int:
    """Words in windows of three that occur at least twice in the text."""
    if len(words) < 4:
        return 0
    numbers: dict[str, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    # windows are numbered exactly: pairs of words first, then pairs and a word
    _, pairs = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)
    _, window, counts = np.unique(pairs[:-1] * len(numbers) + ids[2:], return_inverse=True, return_counts=True)
    again = counts[window] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


def repeat_lines(lines: list[str]) -> int:
    """Lines with a word that are equal to an earlier one."""
    worded = [x for x in lines if x.strip(WHITE)]
    return len(worded) - len(set(worded))


def line_key(line: str) -> int:
    """Hash of a line without regard to case, spacing and the digits in it."""
    return xxhash.xxh64_intdigest(" ".join(WORD.findall(line.lower().translate(DIGITS)))) - (1 << 63)


def measured(docs: DataFrame, host: str = "source") -> DataFrame:
    """Per row the base counts, a row number, its host and the distinct lines with their words."""

    def measure(batches):
        row = TaskContext.get().partitionId() << 40
        for batch in slices(batches):
            rows = []
            hosts = column(batch, "host")
            for doc, text, where in zip(column(batch, "doc_id"), column(batch, "text", ""), hosts, strict=True):
                words, lines = WORD.findall(text), text.split("\n")
                weights: dict[int, int] = {}
                for x in lines:
                    if n := len(WORD.findall(x)):
                        key = line_key(x)
                        weights[key] = weights.get(key, 0) + n
                row += 1
                rows.append(
                    (
                        doc, len(words), len(text) - sum(map(text.count, WHITE)), sum(map(text.count, "#*$%&|<>")),
                        repeat_lines(lines), repeat_words(words), row, where,
                        [{"line": k, "words": n} for k, n in weights.items()],
                    )
                )
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), TEXTS, strict=True)], schema=TEXTS)

    has_host = host in docs.columns
    rows = first_column(docs, "doc_id", "text", *([host] if has_host else []))
    where = F.coalesce(F.col(host).cast("string"), F.lit("")) if has_host else F.lit("")
    return rows.select("doc_id", "text", where.alias("host")).mapInArrow(
        measure,
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
        " row long, host string, lines array<struct<line: long, words: long>>",
    )


def frequent_lines(stored: DataFrame, host_docs: int = HOST_DOCS) -> DataFrame:
    """``(host, line, n_docs)`` of lines in more than ``host_docs`` distinct documents of a host.

    All rows of an id are one document, each row without id is one of its own.
    """
    alone = F.when(F.col("doc_id").isNull(), F.col("row")).alias("alone")
    lines = stored.select("host", F.explode("lines.line").alias("line"), "doc_id", alone).distinct()
    return lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_docs")).filter(F.col("n_docs") > host_docs)


def rule_verdicts(docs: DataFrame, host: str = "source", host_docs: int = HOST_DOCS) -> DataFrame:
    """Base counts, ``base_failed``, words and lines lost to frequent lines, and ``kept`` per row.

    ``docs`` is ``(doc_id, text, host)``. Null and empty texts have no words and fail;
    a missing host is a host of its own; repeated rows of an id count as one document
    and give a row each; an empty table gives none; further columns are not looked at.
    """
    stored = cut_lineage(measured(docs, host), "measured")
    frequent = frequent_lines(stored, host_docs).select("host", "line")
    lines = stored.select("row", "host", F.explode("lines").alias("l")).select("row", "host", "l.line", "l.words")
    lost = lines.join(frequent, ["host", "line"], "left_semi").groupBy("row")
    # as many as the text has lines
    lost = lost.agg(F.sum("words").alias("lost_words"), F.collect_list("line").alias("lost_lines"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = stored.drop("lines", "host").join(lost, "row", "left").drop("row")
    rows = rows.withColumn("lost_words", F.coalesce("lost_words", F.lit(0))).withColumn("base_failed", failed)
    return rows.withColumn("kept", ~F.col("base_failed") & (2 * F.col("lost_words") <= F.col("n_words")))


def without_lines(docs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """``(doc_id, text)`` of kept documents, their frequent lines removed.

    Rows of one id lose what any of them loses; rows without id are left out.
    """
    kept = verdicts.filter("kept AND doc_id IS NOT NULL").select("doc_id", F.explode_outer("lost_lines").alias("line"))
    lost = kept.groupBy("doc_id").agg(F.collect_set("line").alias("lost_lines"))

    def strip(batches):
        for batch in slices(batches):
            texts = []
            for text, lost_lines in zip(column(batch, "text", ""), column(batch, "lost_lines"), strict=True):
                gone = set(lost_lines)
                texts.append("\n".join(x for x in text.split("\n") if not gone or not WORD.search(x) or line_key(x) not in gone))
            yield pa.RecordBatch.from_pydict(
                {"doc_id": column(batch, "doc_id"), "text": texts}, pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
            )

    return first_column(docs, "doc_id", "text").join(lost, "doc_id").mapInArrow(strip, "doc_id long, text string")
