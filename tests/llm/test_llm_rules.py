from __future__ import annotations

import random
import re
from collections import Counter

from llm_frames import AWKWARD, awkward, empty

from caseloom.llm import quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + j for i, w in enumerate(windows) if w in twice for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), sum(x in lines[:i] for i, x in enumerate(lines)), len(covered),
    )


def test_base_counts_equal_brute_force(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab#|é \n\t\x0c\x1c") for _ in range(rng.randint(0, 120))) for _ in range(200)] + ["a b c a b c d", "a a a a"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality_rules.rule_verdicts(df).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base_counts(texts[r.doc_id])


def test_frequent_lines_of_a_host_go_and_depleted_documents_with_them(spark):
    own = lambda i: " ".join(f"w{i}x{j}" for j in range(60))
    banner = "Share  this page 12 " + " ".join(f"b{j}" for j in range(20))
    rows = [(i, f"{banner.upper() if i % 2 else banner}\n{own(i)}", "h") for i in range(30)]
    rows += [(100 + i, own(500) + "\n" + own(501), "h") for i in range(25)]  # one text in 25 documents
    rows += [(200 + i, f"{banner}\n{own(i + 900)}", f"host{i}") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    verdicts = quality_rules.rule_verdicts(df)
    got = {r.doc_id: r for r in verdicts.collect()}
    assert all(got[i].kept and got[i].lost_words == 24 for i in range(30))
    assert not any(got[100 + i].kept or got[100 + i].base_failed for i in range(25))
    assert all(got[200 + i].lost_words == 0 for i in range(30))
    texts = {r.doc_id: r.text for r in quality_rules.without_lines(df, verdicts).collect()}
    assert texts[3] == own(3) and texts[200].startswith("Share") and 100 not in texts


def test_awkward_and_empty_tables(spark):
    got = quality_rules.rule_verdicts(awkward(spark)).collect()
    assert len(got) == len(AWKWARD) and {r.n_repeat_words for r in got if r.doc_id == 7} == {60_000}
    assert quality_rules.rule_verdicts(empty(spark)).count() == 0


def test_repeated_rows_of_an_id_are_one_document(spark):
    letters = str.maketrans("0123456789", "abcdefghij")  # digits are equal in lines
    own = lambda i: " ".join(f"{i}x{j}" for j in range(60)).translate(letters)
    shared = " ".join(f"s{j}" for j in range(20))
    rows = [(7, f"{own(7)}\n{shared}", "h")] * 25 + [(100 + i, f"{own(100 + i)}\n{shared}", "h") for i in range(19)]
    rows += [(None, own(900), "h")] * 25  # rows without id are documents each
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = quality_rules.rule_verdicts(df).collect()
    assert len(got) == len(rows) and all((r.lost_words, r.kept) == ((60, False) if r.doc_id is None else (0, True)) for r in got)
    more = df.union(spark.createDataFrame([(200, f"{own(200)}\n{shared}", "h")], df.schema))
    assert {r.lost_words for r in quality_rules.rule_verdicts(more).collect() if r.doc_id is not None} == {20}  # now 21 documents


def test_columns_that_differ_in_case_only(spark):
    df = spark.createDataFrame([(1, "X", "one two three", "h")], "doc_id long, Text string, text string, source string")
    assert [r.n_words for r in quality_rules.rule_verdicts(df).collect()] == [3]
