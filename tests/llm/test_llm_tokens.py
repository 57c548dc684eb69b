from __future__ import annotations

import random
import sys
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from llm_frames import AWKWARD, awkward, empty
from tokenizers import Tokenizer

from caseloom.llm import packing, token_counts, token_files
from caseloom.llm.tokens import Encoder

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
SIGNS = list("aAbéÉßİΣς .,;!_'’s\t\n ́̈①½²٣9\x1c漢字🙂<|>") + ["<|endoftext|>", "'s", "...", "., ", " . ", "É. ", "ﬁ", "  "]


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_parts_give_the_library_ids(path):
    rng, library = random.Random(9), Tokenizer.from_file(path)
    texts = ["".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 30))) for _ in range(3_000)]
    for encoder in (Encoder(path), Encoder(path, limit=50)):
        got = [np.frombuffer(x, "<u4").tolist() for s in range(0, 3_000, 60) for x in encoder.ids(texts[s : s + 60])]
        assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_long_and_many_words_give_the_library_ids():
    rng, library = random.Random(12), Tokenizer.from_file(WORDS)
    word = lambda: "".join(rng.choice("abcéßñÅȳ0½'.,#") for _ in range(rng.choice([1, 3, 8, 9, 16, 23, 24, 25, 40, 300])))
    texts = [" ".join(word() for _ in range(200)) for _ in range(60)] + ["a\0 a a\0b", "’ Éa Éa. é", "", " ", "\xa0É\x85", "Жук. жук"]
    expected = [library.encode(t, add_special_tokens=False).ids for t in texts]
    for limit in (50, 700_000):
        encoder = Encoder(WORDS, limit=limit)
        for size in (66, 7):  # known words the second time
            got = [np.frombuffer(x, "<u4").tolist() for s in range(0, len(texts), size) for x in encoder.ids(texts[s : s + size])]
            assert got == expected
        assert max(map(len, encoder.table.wide), default=0) <= 64


def test_the_library_is_asked_once_for_a_word(monkeypatch):
    asked = []
    for name in {"encode_parts", "encode_words"} & set(dir(Encoder)):
        plain = getattr(Encoder, name)
        monkeypatch.setattr(Encoder, name, lambda self, parts, *more, plain=plain: asked.extend(parts) or plain(self, parts, *more))
    words = ["word", "größe", "wörtlich"]
    texts = [f"{w}{a} {b}{w}{a} {w}{a}{w}" for w in words for a in (".", "!!", "...", '"', "##") for b in ("(", "[", "<<")]
    library = Tokenizer.from_file(WORDS)
    assert [np.frombuffer(x, "<u4").tolist() for x in Encoder(WORDS).ids(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert sorted(asked) == sorted([*words, ".", "!!", "...", '"', "##", "(", "[", "<<"])


def test_only_words_are_remembered():
    texts = [f"{w}{sign}" for w in ("word", "other", "it's") for sign in (".", ",", "!", "2024", ", it's", '"')]
    encoder, library = Encoder(WORDS), Tokenizer.from_file(WORDS)
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.ids(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert encoder.table.held == len(["word", "other", "it", "'s", ".", ",", "!", "2", "0", "4", '"'])


def test_apostrophes_give_the_library_ids():
    rng, library = random.Random(14), Tokenizer.from_file(WORDS)
    texts = ["".join(rng.choice(["'", "'", "s", "re", "ll", "l", "v", "e", "d", "M", "é", "Ж", "7", "!", " "]) for _ in range(rng.randint(1, 14))) for _ in range(4_000)]
    assert [np.frombuffer(x, "<u4").tolist() for x in Encoder(WORDS).ids(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_counts(spark):
    library = Tokenizer.from_file(BYTES)
    got = token_counts.count_tokens(awkward(spark), BYTES, limit=5, frequent=20).collect()
    count = lambda t: len(library.encode(t or "", add_special_tokens=False).ids)
    expected = [(i or 0, len((t or "").encode()), count(t), count(t) > 5) for i, t in AWKWARD]
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == sorted(expected)
    assert token_counts.count_tokens(empty(spark), BYTES).count() == 0
    pieces = token_counts.count_tokens(awkward(spark).limit(3), public_tokenizers.path("piece_bpe_32k.model"))
    assert pieces.filter("n_tokens > 0").count() >= 1


@pytest.mark.parametrize("kind", ["few", "all", "runs", "rising"])
def test_blocks_round_trip(kind):
    rng = np.random.default_rng(10)
    for n in (1, 2, 511, 512, 513, 5_000):
        ids = {"few": rng.integers(0, 5, n), "all": rng.integers(0, 49_408, n), "runs": np.repeat(rng.integers(0, 49_408, n), 9)[:n],
               "rising": np.arange(n) % 49_408}[kind].astype(np.int32)
        blocks = token_files.encode_blocks(ids, 8, 512)
        assert [k for k, _ in blocks] == [512] * (n // 512) + [n % 512] * (n % 512 > 0)
        assert (token_files.decode_blocks(blocks, 8) == ids).all()
        alone = np.concatenate([token_files.decode_blocks([b], 8) for b in blocks])
        assert (alone == ids).all()  # blocks do not depend on each other
    assert sum(len(p) for _, p in token_files.encode_blocks(np.tile([7, 8, 9], 2_000).astype(np.int32), 8, 2_048)) < 1_500


def test_blocks_are_written_as_before():
    ids = np.repeat(np.arange(30_000) * 7_919 % 49_408, 1 + np.arange(30_000) % 3)[:40_000].astype(np.int32)
    ids[::3] %= 11
    payloads = b"".join(p for _, p in token_files.encode_blocks(ids, 8, 512))
    assert (len(payloads), zlib.crc32(payloads)) == (75678, 2959022186)


def test_few_calls_a_coded_id():
    calls, ids = [], (np.arange(2_048) * 7_919 % 49_408).astype(np.int32)
    sys.setprofile(lambda frame, event, arg: calls.append(event == "call"))
    try:
        blocks = token_files.encode_blocks(ids, 8)
    finally:
        sys.setprofile(None)
    assert sum(calls) < 12 * len(ids)
    assert (token_files.decode_blocks(blocks, 8) == ids).all()


def test_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_IDS", 5_000)
    folder = token_files.write_tokens(awkward(spark), WORDS, str(tmp_path / "t"))
    got = token_files.read_tokens(spark, folder).collect()
    library, start = Tokenizer.from_file(WORDS), 0
    ids = {}
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == start and r.n_tokens == len(r.ids) // 4
        start += r.n_tokens
        ids.setdefault(r.doc_id, []).append(np.frombuffer(bytes(r.ids), "<u4").tolist())
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start) if r.doc_id is not None]
    assert order == sorted(order) and len(got) == len(AWKWARD)
    for doc, text in AWKWARD:
        assert library.encode(text or "", add_special_tokens=False).ids + [1] in ids[doc]
    name = max((tmp_path / "t").glob("ids-*.bin"), key=lambda p: p.stat().st_size)
    raw = bytearray(name.read_bytes())
    raw[40] ^= 255
    name.write_bytes(raw)
    with pytest.raises(Exception, match="checksum"):
        token_files.read_tokens(spark, folder).collect()
    assert token_files.read_tokens(spark, token_files.write_tokens(empty(spark), WORDS, str(tmp_path / "e"))).count() == 0


def naive_first_fit(sizes, capacity):
    bins, placed = [], {}
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = next((b for b, used in enumerate(bins) if used + sizes[i] <= capacity), len(bins))
        if at == len(bins):
            bins.append(0)
        placed[i] = (at, bins[at])
        bins[at] += sizes[i]
    return [placed[i] for i in range(len(sizes))]


def test_tree_equals_naive_first_fit():
    rng = random.Random(11)
    for _ in range(100):
        sizes = [rng.choice([rng.randint(1, 64), 64, rng.randint(1, 9)]) for _ in range(rng.randint(0, 80))]
        assert packing.first_fit_decreasing(sizes, 64) == naive_first_fit(sizes, 64)


def test_packing(spark):
    library, capacity = Tokenizer.from_file(WORDS), 64
    got = packing.pack(awkward(spark), WORDS, end_id=2, capacity=capacity, group_pieces=300).collect()
    for doc in {i for i, _ in AWKWARD}:
        whole = [library.encode(t or "", add_special_tokens=False).ids + [2] for i, t in AWKWARD if i == doc]
        pieces = [r for r in got if r.doc_id == doc]
        assert sum(r.length for r in pieces) == sum(map(len, whole))
        for r in pieces:
            ids = np.array(whole[0][r.start : r.start + r.length], "<u4").tobytes()
            assert r.doc_tokens == len(whole[0]) and r.ids_crc32 == zlib.crc32(ids) and 0 < r.length <= capacity
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    assert packing.pack(empty(spark), WORDS).count() == 0


def test_equal_rows_spread_over_the_groups(spark):
    rows = [(None, "one text without id")] * 2_000 + [(5, "one text of one id")] * 2_000 + [(10 + i, f"text {i}") for i in range(2_000)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), WORDS, capacity=64, group_pieces=300).collect()
    groups = Counter(r.sequence_id >> 32 for r in got)
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    assert len(groups) == 20 and max(groups.values()) < 2 * 300
