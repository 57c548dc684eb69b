"""Token ids and counts by the public tokenizer libraries, with remembered pieces of text.

A tokenizer whose parts of text are encoded on their own is asked only once for each
distinct part. Which cutting is allowed follows from the tokenizer's own file; texts
in which it would not be safe, and other kinds of tokenizers, are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Sequence
from itertools import chain

import numpy as np

from caseloom.llm.common import CACHE_CHARS

#: Parts that a worker remembers, at most about 140 MB; the table is emptied when full.
CACHE_PARTS = 700_000
#: Ids of remembered parts, beyond which the table is emptied as well.
CACHE_IDS = 8_000_000
#: Words and parts that the table of a worker remembers: its slots are at most half taken, and as many as for ``CACHE_PARTS``.
TABLE_PARTS = 1_000_000
#: Words that the library encodes in a call; more at once takes longer for each.
CALL_WORDS = 256

# fixed values: the characters with the Unicode property White_Space
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Parts that a byte-level tokenizer never joins: a word with the space before it, a run of white space.
PARTS = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: Beyond these characters a text may change by NFC, and lower case may depend on more than the character.
FAR = re.compile("[^\x00-\u024f]")
#: str.split() takes these for white space, the tokenizers do not.
SEPARATORS = re.compile("[\x1c-\x1f]")
#: A pre-tokenizer's pattern, and the same for lower-case near characters without white space.
WORDS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
LETTERS, DIGITS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u024f", "0-9\xb2\xb3\xb9\xbc-\xbe"
NEAR_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{DIGITS}]|[^{LETTERS}{DIGITS}]+")


def cutting(spec: dict) -> str:
    """``words``, ``parts`` or ``whole``: how texts may be cut without changing the ids."""
    pre, normal = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    if spec.get("model", {}).get("type") != "BPE" or spec["model"].get("dropout") or spec.get("truncation"):
        return "whole"
    if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not normal:
        return "parts"
    steps = [n.get("type") for n in (normal or {}).get("normalizers", [])]
    first = (pre.get("pretokenizers") or [{}])[0]
    if steps == ["NFC", "Replace", "Lowercase"] and first.get("type") == "Split" and first.get("behavior") == "Removed":
        # NFC never joins a character to white space; only parts without white space are kept
        if first.get("invert") and "\\s" in first.get("pattern", {}).get("Regex", ""):
            return "words"
    return "whole"


#: Bytes: white space, letters, digits, other signs, and those that are not looked into.
SPACES, LETTER, DIGIT, SIGN, OPAQUE = range(5)
KINDS = np.full(256, SIGN, np.uint8)
for _kind, _bytes in ((SPACES, b"\t\n\v\f\r "), (LETTER, bytes(range(97, 123))), (DIGIT, b"0123456789"), (OPAQUE, bytes([*range(65, 91), *range(128, 256)]))):
    KINDS[list(_bytes)] = _kind
#: Letters of an apostrophe's word, by the first of them; of two, the second as well.
SHORT, LONG = np.isin(np.arange(256), list(b"stmd")), {b"r": b"e", b"v": b"e", b"l": b"l"}


def windows(raw: bytes) -> np.ndarray:
    """The eight bytes from each place on, as integers; ``raw`` ends with at least seven bytes that do not matter."""
    return np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,))


def cut_words(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places and lengths of the words of ``raw``, as ``NEAR_WORDS`` cuts them; it begins with white space and is padded.

    Parts (between white space) with capital or non-ASCII letters are left whole.
    """
    codes = np.frombuffer(raw, np.uint8)
    kinds = KINDS.take(codes)
    kinds[-PartTable.WIDTH :] = SPACES
    opaque = np.flatnonzero(kinds == OPAQUE)
    if len(opaque):
        space = kinds == SPACES
        edges = np.flatnonzero(space[1:] != space[:-1]) + 1
        part = np.searchsorted(edges, opaque, side="right") - 1
        part = part[np.flatnonzero(np.diff(part, prepend=-1))]
        level = np.zeros(len(kinds), np.int8)
        level[edges[part]], level[edges[part + 1]] = 1, -1
        kinds[np.cumsum(level, dtype=np.int8) > 0] = LETTER
    edge = kinds[1:] != kinds[:-1]
    edge |= kinds[1:] == DIGIT
    edges = np.flatnonzero(edge) + 1
    own = np.flatnonzero(kinds[edges] != SPACES)
    start, length = edges[own], np.diff(edges, append=len(raw))[own]
    # an apostrophe on its own takes the letters of 's, 're and the like from the next word
    marks = np.flatnonzero((codes[start] == 39) & (length == 1) & (kinds[start] == SIGN) & (kinds[start + 1] == LETTER))
    if len(marks):
        one, two = codes[start[marks] + 1], codes[start[marks] + 2]
        taken = SHORT[one].astype(np.int64)
        for first, second in LONG.items():
            taken[(one == ord(first)) & (two == ord(second))] = 2
        length[marks] += taken
        start[marks + 1] += taken
        length[marks + 1] -= taken
        kept = np.flatnonzero(length)
        start, length = start[kept], length[kept]
    return start, length


class PartTable:
    """Parts of text (bytes) to numbers and to ids, looked up many at once.

    Parts of up to ``WIDTH`` bytes without a zero are their own keys, in open addressing;
    longer ones are in a dict up to ``CACHE_CHARS`` bytes, beyond that known to one call only.
    """

    WIDTH = 24
    KEPT = np.array([(1 << 8 * n) - 1 for n in range(9)], "<u8")
    MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.keys, self.numbers = np.zeros((1 << 12, 3), "<u8"), np.zeros(1 << 12, np.int32)
        self.wide: dict[bytes, int] = {}
        self.size = self.held = self.used = 0
        self.first, self.count, self.pool = np.zeros(1 << 11, np.int64), np.zeros(1 << 11, np.int64), np.zeros(1 << 13, "<u4")

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        h = keys[:, 0] * self.MIX[0] + (keys[:, 1] ^ keys[:, 1] >> np.uint64(29)) * self.MIX[1] + (keys[:, 2] ^ keys[:, 2] >> np.uint64(31)) * self.MIX[2]
        h ^= h >> np.uint64(32)
        h *= self.MIX[0]
        return (h >> np.uint64(65 - len(self.keys).bit_length())).astype(np.int64)

    def _keys(self, view: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        keys = np.zeros((len(start), 3), "<u8")
        for j in range(3):
            some = slice(None) if j == 0 else np.flatnonzero(length > 8 * j)
            keys[some, j] = view[start[some] + 8 * j] & self.KEPT[np.minimum(length[some] - 8 * j, 8)]
        return keys

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of keys, -1 for unknown ones."""
        at, left, out = self._slots(keys), None, np.empty(0, np.int64)
        while left is None or len(left):
            there = self.keys.take(at, axis=0, mode="clip")
            same = there[:, 0] == keys[:, 0]
            same &= there[:, 1] == keys[:, 1]
            same &= there[:, 2] == keys[:, 2]
            found = np.where(same, self.numbers.take(at, mode="clip"), -1)
            on = np.flatnonzero(~same & (there[:, 0] != 0))
            if left is None:
                out, left = found.astype(np.int64), on
            else:
                out[left] = found
                left = left[on]
            keys, at = keys[on], (at[on] + 1) & (len(self.keys) - 1)
        return out

    def _put(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        """Keys that are not in the table yet, each once."""
        if 2 * (self.size + len(keys)) > len(self.keys):
            full = np.flatnonzero(self.keys[:, 0])
            keys, numbers = np.concatenate([self.keys[full], keys]), np.concatenate([self.numbers[full], numbers])
            slots = 1 << (2 * len(keys)).bit_length()  # a quarter to a half of them are taken
            self.keys = self.numbers = None  # not two tables at once
            self.keys, self.numbers, self.size = np.zeros((slots, 3), "<u8"), np.zeros(slots, np.int32), 0
        self.size += len(keys)
        at = self._slots(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[at, 0] == 0)
            self.numbers[at[free]] = free  # of several for one slot the last stays
            won = free[self.numbers[at[free]] == free]
            self.keys[at[won]], self.numbers[at[won]] = keys[won], numbers[won]
            lost = np.ones(len(keys), bool)
            lost[won] = False
            keys, numbers, at = keys[lost], numbers[lost], (at[lost] + 1) & (len(self.keys) - 1)

    def find(self, raw: bytes, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Numbers of the parts at ``start`` of ``raw``, -1 for unknown ones; ``raw`` is padded, see ``windows``."""
        narrow = np.flatnonzero(length <= self.WIDTH)
        out = np.full(len(start), -1, np.int64)
        out[narrow] = self._find(self._keys(windows(raw), start[narrow], length[narrow]))
        if len(narrow) < len(start):
            wide = np.flatnonzero(length > self.WIDTH)
            ends = (start[wide] + length[wide]).tolist()
            out[wide] = [self.wide.get(raw[a:b], -1) for a, b in zip(start[wide].tolist(), ends, strict=True)]
        return out

    def add(self, parts: Sequence[bytes], ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Numbers of distinct parts that are not in the table yet; their ids follow each other."""
        numbers = np.arange(self.held, self.held + len(parts))
        for name, used, new in (("first", self.held, self.used + np.cumsum(counts) - counts), ("count", self.held, counts), ("pool", self.used, ids)):
            array = getattr(self, name)
            if used + len(new) > len(array):
                array = np.concatenate([array[:used], np.zeros(max(used, len(new)) + len(new), array.dtype)])
                setattr(self, name, array)
            array[used : used + len(new)] = new
        self.held, self.used = self.held + len(parts), self.used + len(ids)
        length = np.fromiter(map(len, parts), np.int64, len(parts))
        narrow = length <= self.WIDTH
        start = np.cumsum(length) - length
        view = windows(b"".join(parts) + bytes(self.WIDTH))
        self._put(self._keys(view, start[narrow], length[narrow]), numbers[narrow])
        for i in np.flatnonzero(~narrow).tolist():
            self.wide[parts[i]] = int(numbers[i])
        return numbers

    def ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of parts one after another, and how many each has."""
        counts = self.count[numbers]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        return self.pool[np.repeat(self.first[numbers] - ends + counts, counts) + np.arange(total)], counts

    def forget(self, parts: Sequence[bytes]) -> None:
        """Long parts are not kept from call to call."""
        for p in parts:
            if len(p) > CACHE_CHARS:
                self.wide.pop(p, None)


class Encoder:
    """Encodes with a ``.json`` (tokenizers) or ``.model`` (sentencepiece) file.

    No special tokens are added; their strings inside a text are handled as the
    library does by default. ``None`` counts as the empty text.
    """

    def __init__(self, path: str, limit: int = CACHE_PARTS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.limit, self.special, self.bare = limit, [], None
        self.table_limit = TABLE_PARTS if limit == CACHE_PARTS else limit
        self.recent: dict[str, bytes] = {}
        self.table = PartTable()
        if path.endswith(".model"):
            import sentencepiece

            self.model, self.how = sentencepiece.SentencePieceProcessor(model_file=path), "model"
        elif path.endswith(".json"):
            from tokenizers import Tokenizer

            self.model = Tokenizer.from_file(path)
            with open(path, encoding="utf-8") as f:
                spec = json.load(f)
            self.how = cutting(spec)
            if self.how == "words":
                self._prepare_words(spec)
            self.special = [t["content"] for t in spec.get("added_tokens", [])]
        else:
            raise ValueError("a .json or .model file is needed")

    def _prepare_words(self, spec: dict) -> None:
        """The file's model without the steps before it, for words that have been through them.

        Only if these steps are the known ones and the last token of each word tells that it is the last.
        """
        from tokenizers import Tokenizer, pre_tokenizers

        steps, model = spec["pre_tokenizer"]["pretokenizers"], spec["model"]
        byte_level = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}
        known = len(steps) == 2 and steps[0]["pattern"] == {"Regex": WORDS} and byte_level.items() <= steps[1].items()
        suffix, plain = model.get("end_of_word_suffix"), not model.get("unk_token") and not model.get("ignore_merges")
        alphabet = pre_tokenizers.ByteLevel.alphabet()
        if not known or not suffix or not plain or not all(c in model["vocab"] and c + suffix in model["vocab"] for c in alphabet):
            return
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.level = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0x250)}
        self.last = np.zeros(max(model["vocab"].values()) + 1, bool)
        self.last[[i for t, i in model["vocab"].items() if t.endswith(suffix)]] = True
        self.bare = Tokenizer.from_str(json.dumps(spec | {"normalizer": None, "pre_tokenizer": None, "added_tokens": []}))

    def whole(self, text: str) -> list[int]:
        if self.how == "model":
            return self.model.encode(text, num_threads=1)
        return self.model.encode(text, add_special_tokens=False).ids

    def cut(self, text: str) -> list[str] | None:
        """Parts that are encoded on their own, or None if the text must stay whole."""
        if self.how in ("whole", "model") or any(s in text for s in self.special):
            return None
        if self.how == "parts":
            return PARTS.findall(text)
        if SEPARATORS.search(text):
            return None
        # near characters: what the normaliser would do, so that fewer distinct parts remain
        return (text.lower() if text.isascii() or not FAR.search(text) else text).split()

    def encode_parts(self, parts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many of them each part has."""
        got = self.model.encode(parts, is_pretokenized=True, add_special_tokens=False)
        counts = np.bincount(np.array(got.word_ids, np.int64), minlength=len(parts)) if got.ids else np.zeros(len(parts), int)
        return np.array(got.ids, "<u4"), counts

    def encode_words(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words as ``NEAR_WORDS`` cuts them: only the byte level and the model are left to do."""
        level = self.level
        words = [w if w.isascii() and w.isprintable() else w.translate(level) for w in words]
        ids = np.array(self.bare.encode_batch_fast([words], is_pretokenized=True, add_special_tokens=False)[0].ids, "<u4")
        counts = np.diff(np.flatnonzero(self.last[ids]), prepend=-1)
        if len(counts) != len(words):
            raise ValueError("a word's last token was not found")
        return ids, counts

    def ids(self, texts: Sequence[str | None]) -> list[bytes]:
        """Per text its ids as little-endian 32-bit integers."""
        if self.bare:
            return self._ids_of_words(texts)
        cuts = [self.cut(t) if t else [] for t in texts]
        if len(self.recent) > self.limit:
            self.recent.clear()
        need = set(chain.from_iterable(filter(None, cuts))).difference(self.recent)
        new: dict[str, bytes] = {}
        for some, ids, counts in self._encoded(list(need), self.encode_parts, 4096):
            raw, ends = ids.tobytes(), (np.cumsum(counts) * 4).tolist()
            new.update((p, raw[a:b]) for p, a, b in zip(some, [0, *ends], ends, strict=False))
        self.recent.update((p, i) for p, i in new.items() if len(p) <= CACHE_CHARS)
        known = self.recent
        return [
            np.array(self.whole(text), "<u4").tobytes() if cut is None else b"".join([known[p] if p in known else new[p] for p in cut])
            for text, cut in zip(texts, cuts, strict=True)
        ]

    def _encoded(self, parts: list, encode, call: int):
        for start in range(0, len(parts), call):
            yield parts[start : start + call], *encode(parts[start : start + call])

    def _ids_of_words(self, texts: Sequence[str | None]) -> list[bytes]:
        """The same by the table: words are cut, and looked up, in all texts at once."""
        table = self.table
        if table.held > self.table_limit or table.used > CACHE_IDS:
            table.clear()
        plain = [self.plain(t) if t else b"" for t in texts]
        raw = b"\n%b\n%b" % (b"\n".join(filter(None, plain)), bytes(PartTable.WIDTH))
        start, length = cut_words(raw)
        numbers = table.find(raw, start, length)
        missing = np.flatnonzero(numbers < 0)
        if len(missing):
            places = start[missing], length[missing]
            need = {raw[a : a + n] for a, n in zip(*[x.tolist() for x in places], strict=True)}
            self._add_parts(list(need))
            numbers[missing] = table.find(raw, *places)
            table.forget(need)
        ids, counts = table.ids(numbers)
        held, ends = ids.tobytes(), np.concatenate([[0], np.cumsum(counts) * 4])
        out, at = [], 1
        sizes = np.array([len(p) + 1 if p else 0 for p in plain])
        bounds = ends[np.searchsorted(start, 1 + np.concatenate([[0], np.cumsum(sizes)]))].tolist()
        for text, own, a, b in zip(texts, plain, bounds, bounds[1:], strict=False):
            out.append(np.array(self.whole(text), "<u4").tobytes() if own is None else held[a:b])
        return out

    def plain(self, text: str) -> bytes | None:
        """The text with ASCII white space alone between its parts, or None if it must stay whole.

        Near characters are in lower case, as the normaliser would have them, so that fewer distinct parts remain.
        """
        if any(s in text for s in self.special) or any(c in text for c in "\x1c\x1d\x1e\x1f\0"):
            return None
        if text.isascii():
            return text.lower().encode()
        if FAR.search(text):
            return " ".join(text.split()).encode("utf-8", "surrogatepass")
        return text.lower().replace("\x85", " ").replace("\xa0", " ").encode()

    def _add_parts(self, need: list[bytes]) -> None:
        """Adds parts to the table that it does not know.

        Parts of near characters are put together from their words. In other ones, a full
        stop or comma behind a letter or digit is a pre-token of its own, so only what is
        before it is encoded.
        """
        bare = [p for p in need if p.isalpha() and p.islower()]  # as bytes: ASCII letters alone
        if bare:
            _, ids, counts = zip(*self._encoded(b"\n".join(bare).decode().split("\n"), self.encode_words, CALL_WORDS), strict=True)
            self.table.add(bare, np.concatenate(ids), np.concatenate(counts))
            need = [p for p in need if not (p.isalpha() and p.islower())]
        near: dict[str, list[str]] = {}
        far: dict[str, list[str]] = {}
        for p in b"\n".join(need).decode("utf-8", "surrogatepass").split("\n") if need else []:
            low = p.lower()
            if p.isascii() or not FAR.search(p + low):
                near[p] = [low] if low.isascii() and low.isalpha() else NEAR_WORDS.findall(low)
            elif len(p) > 1 and p[-1] in ".," and p[-2].lower()[-1].isalnum():
                far[p] = [p[:-1], p[-1]]
            else:
                far[p] = [p]
        for cuts, encode, call in ((near, self.encode_words, CALL_WORDS), (far, self.encode_parts, 4096)):
            words = list(set(chain.from_iterable(cuts.values())))
            number = dict(zip(words, self._numbers(words, encode, call).tolist(), strict=True))
            rest = [p for p in cuts if p not in number]
            if rest:
                ids, counts = self.table.ids(np.fromiter((number[w] for p in rest for w in cuts[p]), np.int64))
                lengths = np.fromiter((len(cuts[p]) for p in rest), np.int64, len(rest))
                ends = np.concatenate([[0], np.cumsum(counts)])[np.cumsum(lengths)]
                self.table.add([p.encode("utf-8", "surrogatepass") for p in rest], ids, np.diff(ends, prepend=0))
            self.table.forget([w.encode("utf-8", "surrogatepass") for w in words if w not in cuts and len(w) > CACHE_CHARS // 4])

    def _numbers(self, words: list[str], encode, call: int) -> np.ndarray:
        """The table's numbers of distinct words; ``encode`` gives ids of up to ``call`` unknown ones."""
        raws = [w.encode("utf-8", "surrogatepass") for w in words]
        length = np.fromiter(map(len, raws), np.int64, len(raws))
        numbers = self.table.find(b"".join(raws) + bytes(PartTable.WIDTH), np.cumsum(length) - length, length)
        missing = np.flatnonzero(numbers < 0).tolist()
        if missing:
            _, ids, counts = zip(*self._encoded([words[i] for i in missing], encode, call), strict=True)
            numbers[missing] = self.table.add([raws[i] for i in missing], np.concatenate(ids), np.concatenate(counts))
        return numbers


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a file, made once."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
