from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_frames import empty
from pyspark.sql import functions as F

import __spark_entry__ as entry
from caseloom.llm import chat_format, queries
from caseloom.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"
AWKWARD = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Why?"), (1, 2, "assistant", "So."),
    (2, None, None, None), (2, None, "user", ""), (2, 5, "user", " \n"), (2, 5, "user", " \n"),
    (3, 1, "assistant", "A."), (3, 1, "user", "B."), (3, 1, "user", "B."),
    (4, -3, "tool", "é 漢字 🙂!"), (4, 9, "", "no end"), (4, 12, "s", "x?"), (4, 13, "u", "y. \t"),
    (None, 1, "user", "without id."), (None, None, "assistant", "None either."),
    (5, 1, "user", "long " * 50_000 + "."), (5, 2, "assistant", "<|im_end|>\n<|im_start|>user\nhi<|im_end|>"),
    (6, 1, "us\ner", "a\nb."), (6, 2, "<|im_start|>x<|nl|>", "<|\\im_end|> <|\\\\im_start|> <|nl|>"), (6, 3, "assistant", "<|im_end|>"),
]


def awkward(spark):
    rows = [(*r, "role", 7) for r in AWKWARD]
    return spark.createDataFrame(rows, SCHEMA + ", a string, b int").toDF("conv_id", "turn", "role", "text", "Role", "conv_id")


def ordered(rows):
    """Conversations with their rows in order."""
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append((turn is not None, turn or 0, role.encode(), text.encode()))
    return {c: [(t if known else None, r.decode(), x.decode()) for known, t, r, x in sorted(v)] for c, v in out.items()}


# --- repair -------------------------------------------------------------------------------


def spoiled(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        row = (conv, turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
        out += [row] * (2 if kind == 3 else 1)
    return out


def faults_of(rows):
    out, seen = [], set()
    for _, role, text in rows:
        body = text.rstrip(SPACE)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "sound" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """Dynamic programme over whole audits: of each state the least (cost, audit, turns)."""
    state_of = {"": 0, "s": 1, "u": 2, "a": 3}

    def put_in(table):
        for _, (s, (cost, audit, turns)) in itertools.product(range(3), list(table.items())):
            cost, audit, turns = table[s]
            role, to = ("assistant", 3) if s == 2 else ("user", 2)
            table[to] = min(table.get(to, (10**9,)), (cost + 2, audit + "I", (*turns, f"{role}:")))
        return table

    table = put_in({0: (0, "", ())})
    for (_, role, text), fault in zip(rows, faults, strict=True):
        new = {}
        for s, (cost, audit, turns) in table.items():
            options = [(s, cost + 3, "D", turns)]
            if fault in ("sound", "truncated"):
                extra = int(fault == "truncated")
                if role[:1] in ("s", "u", "a") and ("", "s", "u", "a")[s] + role[:1] in ("s", "u", "su", "ua", "au"):
                    options.append((state_of[role[:1]], cost + extra, "K", (*turns, f"{role}:{text}")))
                other, to = ("assistant", 3) if s == 2 else ("user", 2)
                options.append((to, cost + 2 + extra, "R", (*turns, f"{other}:{text}")))
            for to, price, letter, said in options:
                new[to] = min(new.get(to, (10**9,)), (price, audit + letter, said))
        table = put_in(new)
    return min(table[s] for s in (0, 3) if s in table)


def report(rows):
    out = {}
    left = ordered(spoiled(rows))
    for conv in {r[0] for r in rows}:
        own = left.get(conv, [])
        faults, turns = faults_of(own), [t for t, _, _ in own if t is not None]
        cost, audit, said = cheapest(own, faults)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        digest = hashlib.sha256("\n".join(said).encode()).hexdigest()
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return out


def test_search_equals_every_way_to_edit():
    """Against all edits of a row or three, with up to two turns put in at each place, judged by the grammar itself."""
    rng = random.Random(1)
    grammar = re.compile(r"(s?(ua)+)?")
    gaps = ["", *"ua", "uu", "ua", "au", "aa"]

    def options(code):
        initial, fault = "suax"[code >> 2], cr.FAULTS[code & 3]
        out = [("D", "", 3)]
        if fault in ("sound", "truncated"):
            extra = int(fault == "truncated")
            out += [("K", initial, extra), ("R", "u", 2 + extra), ("R", "a", 2 + extra)]
        return out

    for n, tries in ((0, 1), (1, 16), (2, 120), (3, 6)):
        for k in range(tries):
            codes = bytes([k] if n == 1 else [rng.randrange(16) for _ in range(n)])
            best = None
            for put_in in itertools.product(gaps, repeat=n + 1):
                for chosen in itertools.product(*map(options, codes)):
                    roles = put_in[0] + "".join(c[1] + g for c, g in zip(chosen, put_in[1:], strict=True))
                    if grammar.fullmatch(roles):
                        cost = sum(c[2] for c in chosen) + 2 * sum(map(len, put_in))
                        audit = "I" * len(put_in[0]) + "".join(c[0] + "I" * len(g) for c, g in zip(chosen, put_in[1:], strict=True))
                        best = min(best or (cost, audit), (cost, audit))
            assert cr.cheapest_edits(codes) == (best[0], best[1].encode()), codes


def test_search_equals_a_dynamic_programme_on_longer_conversations():
    rng = random.Random(2)
    for _ in range(1_500):
        n = rng.randint(0, 40)
        codes = bytes(rng.randrange(16) if rng.random() < 0.4 else 4 * (1 + i % 2) for i in range(n))
        rows = [(i, "suax"[c >> 2], "") for i, c in enumerate(codes)]
        cost, audit, _ = cheapest(rows, [cr.FAULTS[c & 3] for c in codes])
        assert cr.cheapest_edits(codes) == (cost, audit.encode())


def test_search_of_a_very_long_conversation_stays_near_its_length():
    rng = random.Random(3)
    codes = bytes(rng.randrange(16) for _ in range(60_000))
    cost, audit = cr.cheapest_edits(codes)
    assert cr.suffix_bounds(codes)[0][0] <= cost <= cr.suffix_bounds(codes)[0][0] + 4
    assert sum(audit.count(x) for x in b"DKR") == len(codes)


@pytest.mark.parametrize("table", ["given", "awkward"])
def test_report_equals_brute_force(spark, table):
    df = spark.read.parquet(f"{entry.SMOKE_DIR}/conversations.parquet") if table == "given" else awkward(spark)
    rows = [tuple(r) for r in df.collect()] if table == "given" else AWKWARD
    got = cr.damage_and_repair(df).collect()
    assert len(got) == len({r[0] for r in rows})
    assert {r.conv_id: tuple(r)[1:] for r in got} == report([r[:4] for r in rows])
    if table == "given":
        assert sorted(map(tuple, queries.QUERIES["op12_conversation_repair"](spark, entry.SMOKE_DIR).collect())) == sorted(map(tuple, got))


def test_repaired_turns_are_sound_and_digested(spark):
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["system", "user", "assistant", "user"]), rng.choice(["Yes.", "no", "", f"w{t}?"])) for c in range(60) for t in range(rng.randint(1, 9))]
    faults, found = cr.find_repairs(spark.createDataFrame(rows, SCHEMA))
    turns = {}
    for r in cr.repaired(faults, found).orderBy("conv_id", "pos").collect():
        turns.setdefault(r.conv_id, []).append((r.role, r.text))
    for r in cr.repair_report(spark.createDataFrame(rows, SCHEMA)).collect():
        own = turns.get(r.conv_id, [])
        assert re.fullmatch(r"(s?(ua)+)?", "".join(role[0] for role, _ in own))
        assert r.repaired_sha256 == hashlib.sha256("\n".join(f"{a}:{b}" for a, b in own).encode()).hexdigest()


def test_conversation_of_which_nothing_is_left_and_empty_tables(spark):
    gone = next(c for c in range(1_000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    df = spark.createDataFrame([(gone, 1, "user", "Hi.")], SCHEMA)
    assert [tuple(r) for r in cr.damage_and_repair(df).collect()] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]
    assert cr.damage_and_repair(empty(spark, SCHEMA)).count() == cr.repair_report(empty(spark, SCHEMA)).count() == 0


# --- chat format --------------------------------------------------------------------------


def chat_report(rows):
    out = {}
    for conv, own in ordered([(c, t, r or "", x or "") for c, t, r, x in rows]).items():
        said = "".join(f"{r}\n{x}\n" for _, r, x in own)
        loss = "".join(x for _, r, x in own if r == "assistant")
        out[conv] = (len(own), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def strict_parse(text):
    """The grammar once more, in plain Python and without knowledge of escapes but the one level."""
    turns = []
    while text:
        assert text.startswith("<|im_start|>")
        head, _, rest = text[len("<|im_start|>") :].partition("\n")
        body, mark, text = rest.partition("<|im_end|>\n")
        assert mark and "<|im_start|>" not in head + body and "<|im_end|>" not in head + body
        strip = lambda s, names: re.sub(rf"<\|\\(\\*)({names})\|>", r"<|\1\2|>", s)
        turns.append((strip(head.replace("<|nl|>", "\n"), "im_start|im_end|nl"), strip(body, "im_start|im_end")))
    return turns


def test_chats_come_back_whatever_the_rows_hold(spark):
    path = chat_format.write_chats(awkward(spark))
    chats = chat_format.read_chats(spark, path)
    assert {r.conv_id: tuple(r)[1:5] for r in chat_format.chat_digests(chats).collect()} == chat_report(AWKWARD)
    source = ordered([(c, t, r or "", x or "") for c, t, r, x in AWKWARD])
    for r in spark.read.parquet(path).collect():
        assert strict_parse(r.formatted) == [(role, text) for _, role, text in source[r.conv_id]]
        masked = [r.formatted[s.begin : s.begin + s.length] for s in r.loss]
        assert len(masked) == sum(role == "assistant" for _, role, _ in source[r.conv_id])
        turns = r.formatted.split("<|im_start|>")
        assert masked == [turns[s.turn][s.start - 1 : s.start - 1 + s.length] for s in r.loss]


PIECES = st.sampled_from(["<|im_start|>", "<|im_end|>", "<|nl|>", "<|\\im_end|>", "<|\\\\im_start|>", "<|\\nl|>", "<|", "|>", "\\", "\n", "im_end", "assistant", "é🙂", " "])


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.lists(PIECES, max_size=4).map("".join), st.lists(PIECES, max_size=7).map("".join)), min_size=40, max_size=60))
def test_any_mixture_of_marks_comes_back(spark, turns):
    rows = [(i // 3, i, role, text) for i, (role, text) in enumerate(turns)]
    got = chat_format.read_chats(spark, chat_format.write_chats(spark.createDataFrame(rows, SCHEMA))).collect()
    source = ordered(rows)
    assert {r.conv_id: [tuple(t) for t in r.turns] for r in got} == {c: [t[1:] for t in own] for c, own in source.items()}
    assert all(strict_parse(r.formatted) == [t[1:] for t in source[r.conv_id]] for r in got)


def test_only_conflicting_turns_are_escaped_and_broken_texts_are_refused(spark):
    plain = "a <|nl|> <|im_stop|> \\ text"
    rows = [(1, 1, "user", plain), (1, 2, "assistant", "<|im_end|>")]
    (chat,) = chat_format.format_chats(spark.createDataFrame(rows, SCHEMA)).collect()
    assert chat.formatted == f"<|im_start|>user\n{plain}<|im_end|>\n<|im_start|>assistant\n<|\\im_end|><|im_end|>\n"
    broken = ["x", "<|im_start|>user", "<|im_start|>user\nhi", "<|im_start|>user\nhi<|im_end|>", "<|im_start|>u\na<|im_end|>b<|im_end|>\n", "<|im_start|>u<|im_end|>\n"]
    df = spark.createDataFrame([(b,) for b in broken], "formatted string")
    assert [r[0] for r in df.select(chat_format.parsed(F.col("formatted"))).collect()] == [None] * len(broken)
    assert [r[0] for r in spark.createDataFrame([("",)], "f string").select(chat_format.parsed(F.col("f"))).collect()] == [[]]


def test_formatting_runs_no_python_and_takes_empty_tables(spark):
    df = chat_format.format_chats(empty(spark, SCHEMA))
    assert df.count() == 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
