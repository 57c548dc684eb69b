"""Frames for the operator tests: awkward rows every operator has to survive."""

from __future__ import annotations

AWKWARD = [
    (1, "Plain words on a line.\nAnd another line, with more words in it."),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (5, "é"),
    (6, "x" * 5_000),
    (7, "word " * 60_000),
    (8, "tab\tand\x0bodd\x1cseparators here <|endoftext|> İΣ ﬁ 漢字 🙂"),
    (9, "same text twice"),
    (9, "same text twice"),
    (None, "a row without id"),
    (1 << 62, "a large id"),
]


def awkward(spark):
    """``doc_id`` and ``text`` beside a second column of either name."""
    rows = [(i, t, -1, "other") for i, t in AWKWARD]
    frame = spark.createDataFrame(rows, "doc_id long, text string, a long, b string")
    return frame.toDF("doc_id", "text", "doc_id", "text")


def empty(spark, schema="doc_id long, text string, source string"):
    return spark.createDataFrame([], schema)
