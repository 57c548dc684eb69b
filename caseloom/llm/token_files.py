"""Token-id files: ids coded by an adaptive context-mixing range coder in independent blocks.

A file holds the ids of consecutive documents, cut into blocks of equal length. Each
block begins with an empty model and has a checksum, so any block is read alone.

For each id the order-2 context (the two ids before) and the order-1 context (the id
before) name the id they were last followed by. Their chances to be right are kept per
confidence of the context and mixed by weights that follow the recent errors. An id
that neither names is coded by the order-0 model: adaptive frequencies of its upper
bits, the lower bits as they are. The three-way choice and the id drive a range coder.

Coding is sequential within a block, so the blocks of a file are coded side by side:
each step codes one id of every block with whole-array operations.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseloom.llm.common import column, first_column, slices
from caseloom.llm.tokens import encoder
from caseloom.llm.warc import file_system
from caseloom.session import cut_lineage, run_path

MAGIC = b"IDBLOCK1"
BLOCK = 2_048
#: Blocks coded side by side.
LANES = 4_096
#: Ids after which a task begins another file.
FILE_IDS = 4 * BLOCK * LANES
ORDER1, ORDER2 = 1_024, 2_048  # contexts per block
TOP = 256  # values of an id's upper bits
SEEN = 24  # weight of one id in the order-0 frequencies

CELLS = ORDER1 + ORDER2
STEPS = 32  # ids of a block that are handled in one go

LOW24, LOW48, LOWEST = 0xFFFFFF, (1 << 48) - 1, 1 << 24
HASH1, HASH2 = 40503, 60493
#: By "not named" * 8 + confidence: what a context's entry gains, and whether its id stays (all bits) or goes (none).
GAIN = np.array([1] * 7 + [0] + [0, 0] + [(c >> 1) - c for c in range(2, 8)], np.int32)
STAYS = np.array([-1] * 8 + [0, 0] + [-1] * 6, np.int32)
#: Chances (of 65536) by confidence that order 1 and order 2 are right, at first.
RIGHT = np.array([[500, 9000, 16000, 24000, 30000, 36000, 42000, 48000], [1000, 24000, 34000, 42000, 48000, 52000, 56000, 60000]], np.int32)
#: Blocks whose frequencies are refreshed in one go.
ROWS = 128


class Models:
    """Adaptive state of ``n`` blocks; the coder and the decoder take the same steps.

    Arrays of both contexts have a row for order 1 and one for order 2. Flags are masks: -1 (all bits) or 0.
    """

    def __init__(self, n: int, finding: bool = False):
        self.n, self.finding = n, finding
        self.lane = np.arange(n)
        self.at = np.stack([self.lane * CELLS, self.lane * CELLS + ORDER1])
        self.at8 = np.stack([self.lane, self.lane + n]) * 8
        held = np.zeros(n * (CELLS + TOP + TOP // 2) + 1, np.int32)  # one array: large ones get large pages
        self.table, self.counts, begins = np.split(held, [n * CELLS, n * (CELLS + TOP)])  # id * 8 + confidence
        self.counts = self.counts.reshape(n, TOP)
        self.counts += 1
        self.right = np.repeat(RIGHT, n, axis=0).ravel()
        self.weight = np.full(n, 32768, np.int32)
        # where the order-0 interval of each value begins; modulo 65536 the last one's end is the next block's first
        self.cumulative = begins.view(np.uint16)[:-1]
        self.begins = self.cumulative[:-1].reshape(n, TOP)
        self.coarse = np.zeros((16, n), np.uint16)  # every sixteenth of them
        self.first, self.first16 = self.lane * TOP, self.lane * 16 - 1
        self.case = np.zeros((2, n), np.int64)
        self.gain, self.stays = np.zeros((2, n), np.int32), np.zeros((2, n), np.int32)
        self.refresh()

    def refresh(self) -> None:
        """Order-0 frequencies from the counts: at least 32 of 65536 for each value."""
        for first in range(0, self.n, ROWS):
            c = self.counts[first : first + ROWS]
            f = (c * ((65536 - 32 * TOP) / c.sum(axis=1, keepdims=True, dtype=np.int32))).astype(np.int32)
            f += 32
            np.cumsum(f, axis=1, out=f)
            self.begins[first : first + ROWS, 1:] = f[:, :-1]
        if self.finding:
            self.coarse[:] = self.begins[:, ::16].T

    def find(self, v: np.ndarray) -> np.ndarray:
        """The value (256 * block + value) whose order-0 interval holds ``v``: first its sixteenth, then in there."""
        v = v.astype(np.uint16)
        group = self.first16 + np.add.reduce((self.coarse <= v).view(np.uint8), axis=0, dtype=np.uint8)
        begins = self.cumulative[:-1].reshape(-1, 16).take(group, axis=0, mode="clip")
        eights = (begins <= v[:, None]).view(np.int64)
        ones = eights[:, 0] + eights[:, 1]
        ones *= 0x0101010101010101
        ones >>= 56
        group <<= 4
        group += ones
        group -= 1
        return group

    def interval(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the order-0 intervals of values (256 * block + value) begin, and their sizes."""
        low, end = self.cumulative.take(place, mode="clip"), self.cumulative.take(place + 1, mode="clip")
        end -= low
        return low.astype(np.int64), end.astype(np.int64)

    def count(self, tops: np.ndarray, missed: np.ndarray) -> None:
        """Counts values of some steps where they were coded by order 0; block by block, as the counts lie."""
        place, weight = np.empty(tops.T.shape, np.int64), np.empty(tops.T.shape, np.int32)
        np.add(tops.T, self.first[:, None], out=place)
        np.bitwise_and(missed.T, SEEN, out=weight)
        np.add.at(self.counts.ravel(), place.ravel(), weight.ravel())

    def contexts(self, hashed1: np.ndarray, hashed2: np.ndarray, out: np.ndarray) -> None:
        """Places in the table, from the id before times HASH1 and the one before that times HASH2."""
        one, two = out[..., 0, :], out[..., 1, :]
        np.right_shift(hashed1, 4, out=one)  # only the lowest 16 bits count
        one &= ORDER1 - 1
        np.add(hashed1, hashed2, out=two)
        two >>= 5
        two &= ORDER2 - 1
        out += self.at

    def entries(self, at: np.ndarray, out: np.ndarray) -> None:
        self.table.take(at, out=out, mode="clip")

    def remember(self, at: np.ndarray, e: np.ndarray, id8: np.ndarray) -> None:
        """The entries after an id (times 8): more sure of it, less sure, or replaced."""
        case, gain, stays = self.case, self.gain, self.stays
        differs = e ^ id8  # below 8 where the entry names the id
        unnamed = differs & 7
        unnamed |= 8
        np.copyto(case, np.minimum(differs, unnamed, out=unnamed))
        GAIN.take(case, out=gain, mode="clip")
        STAYS.take(case, out=stays, mode="clip")
        fresh = id8 + 1
        gain += e
        gain -= fresh
        gain &= stays
        gain += fresh
        self.table[at] = gain

    def judge(self, at: np.ndarray, q: np.ndarray, hit: np.ndarray) -> np.ndarray:
        """Chances after an id that the contexts named or not; returns by how much they were off."""
        off = hit & 65535
        off -= q
        self.right[at] = (off >> 5) + q
        return off

    def weigh(self, change: np.ndarray) -> None:
        w = self.weight
        w += change
        np.maximum(w, 2048, out=w)
        np.minimum(w, 63488, out=w)


def below(x: np.ndarray, limit: int) -> np.ndarray:
    """Whether ``x`` is less than ``limit``, as a mask."""
    x = x - limit
    x >>= 8 * x.itemsize - 1
    return x


def weight_change(off: np.ndarray, agree: np.ndarray) -> np.ndarray:
    """How the weight follows the errors of the orders: only where both name the same id."""
    off = np.abs(off)
    change = off[..., 0, :] - off[..., 1, :]
    change >>= 6
    change &= agree
    return change


def frequencies(q: np.ndarray, weight: np.ndarray, agree: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Frequencies (of 65536) of "only order 1 is right" and "order 2 is right"."""
    q1, q2 = q[..., 0, :], q[..., 1, :]
    # both orders name the same id: its chance is mixed from both
    other = q1 - q2
    other &= agree
    other += q2
    other >>= 2
    other *= 65536 - weight >> 4
    f2 = q2 >> 2
    f2 *= weight >> 4
    f2 += other
    f2 >>= 10
    np.maximum(f2, 64, out=f2)
    np.minimum(f2, 60000, out=f2)
    f1 = 65536 - f2
    f1 >>= 2
    f1 *= q1 >> 4
    f1 >>= 10
    np.maximum(f1, 32, out=f1)
    np.minimum(f1, 64512 - f2, out=f1)
    f1 &= ~agree
    return f1, f2


def refresh_at(step: int) -> bool:
    return step in (8, 16, 32, 64) or step % 128 == 127


def spans(length: int, stop: int) -> list[tuple[int, int]]:
    """Steps in order, at most ``STEPS`` at a time; a span ends where the frequencies are refreshed, and at ``stop``."""
    ends = [i + 1 for i in range(length) if refresh_at(i) or i + 1 in (stop, length)]
    return [(i, min(i + STEPS, b)) for a, b in zip([0, *ends], ends, strict=False) for i in range(a, b, STEPS)]


def low_bits(most: int) -> int:
    """Bits below an id's upper part, so that the upper part has at most ``TOP`` values."""
    bits = max(int(most).bit_length() - 8, 0)
    if bits > 16:
        raise ValueError("ids of at most 24 bits are coded")
    return bits


class RangeCoder:
    """``n`` range coders in step: 48-bit intervals, output in 24-bit words."""

    def __init__(self, n: int):
        self.n, self.low, self.range = n, np.zeros(n, np.int64), np.full(n, LOW48)
        self.words: list[np.ndarray] = []
        self.lanes: list[np.ndarray] = []
        self.ended: int | None = None  # place of the last lane at its end
        self.word, self.short = np.empty((STEPS, 2, n), np.int64), np.empty((STEPS, 2, n), np.int64)

    def encode(self, start: np.ndarray, size: np.ndarray, bits: np.ndarray) -> None:
        """Intervals of 2 ** bits by step, number in the step, and lane; a size of 1 of 2 ** 0 changes nothing."""
        low, rng = self.low, self.range
        words, short = self.word[: len(start)], self.short[: len(start)]
        for step in np.ndindex(start.shape[:2]):
            rng >>= bits[step]
            low += rng * start[step]
            rng *= size[step]
            flag, word = short[step], words[step]
            np.subtract(rng, LOWEST, out=flag)
            flag >>= 63
            np.right_shift(low, 24, out=word)
            gone = word & flag
            gone <<= 24
            low -= gone
            by = flag & 24
            low <<= by
            rng <<= by
        if self.ended is not None:
            short[..., -1] = 0
        at = np.flatnonzero(short.ravel() < 0)
        self.words.append(words.ravel().take(at).astype(np.int32))
        self.lanes.append((at % self.n).astype(np.uint16 if self.n <= 65_536 else np.int64))

    def end_last(self) -> None:
        """What the last lane is given from now on does not count."""
        self.ended = int(self.low[-1])

    def finish(self) -> list[bytes]:
        """The words of every lane, carries passed on to the words before."""
        if self.ended is not None:
            self.low[-1] = self.ended
        lanes, every = np.concatenate(self.lanes), np.arange(self.n)
        used = np.bincount(lanes, minlength=self.n)
        out = np.zeros((self.n, used.max() + 2), np.int32)
        out[np.arange(out.shape[1]) < used[:, None]] = np.concatenate(self.words)[np.argsort(lanes, kind="stable")]
        out[every, used] = self.low >> 24
        out[every, used + 1] = self.low & LOW24
        while (carry := out >> 24).any():
            out &= LOW24
            out[:, :-1] += carry[:, 1:]
        raw = out.astype("<u4", copy=False).view(np.uint8).reshape(len(out), out.shape[1], 4)[:, :, :3]
        return [raw[i, :k].tobytes() for i, k in enumerate((used + 2).tolist())]


class RangeDecoder:
    """The counterpart: ``payloads`` of 24-bit words."""

    def __init__(self, payloads: list[bytes]):
        n = len(payloads)
        counts = [len(p) // 3 for p in payloads]
        words = np.zeros((n, max(counts, default=0) + 3), np.int32)
        raw = words.astype("<i4", copy=False).view(np.uint8).reshape(n, -1, 4)
        for i, (p, k) in enumerate(zip(payloads, counts, strict=True)):
            raw[i, :k, :3] = np.frombuffer(p, np.uint8).reshape(k, 3)
        words = raw.reshape(n, -1).view("<i4")
        self.code = (words[:, 0].astype(np.int64) << 24) + words[:, 1]
        self.range = np.full(n, LOW48)
        self.words, self.next = words.ravel(), np.arange(n) * words.shape[1] + 2
        self.following = np.zeros(n, self.words.dtype)

    def choose(self, f1: np.ndarray, f2: np.ndarray) -> np.ndarray:
        """Takes up "order 2 is right", "only order 1 is right" or "neither"; masks: not neither, and order 2."""
        code, rng = self.code, self.range
        step, limits = rng >> 16, np.empty((2, len(code)), np.int64)
        np.add(f1, f2, out=limits[0])
        limits[1] = f2
        limits *= step
        hit = code - limits
        code[:] = hit[0]
        hit >>= 63
        step <<= 16
        step -= limits[0]
        limits[0] -= limits[1]
        code += limits[0] & hit[0]
        code += limits[1] & hit[1]
        limits[1] -= limits[0]
        limits[0] -= step
        limits &= hit
        np.add(step, limits[0], out=rng)
        rng += limits[1]
        self.move_on()
        return hit

    def value(self, places: np.ndarray) -> np.ndarray:
        """Where the codes lie in their intervals, of 2 ** places."""
        self.step = self.range >> places
        return (self.code / self.step).astype(np.int64)  # exact: both are below 2 ** 53

    def consume(self, start: np.ndarray, size: np.ndarray) -> None:
        self.code -= self.step * start
        np.multiply(self.step, size, out=self.range)
        self.move_on()

    def move_on(self) -> None:
        """Another word where the interval is short."""
        short = below(self.range, LOWEST)
        # a damaged block may ask for more words than it has; its checksum tells
        self.words.take(self.next, out=self.following, mode="clip")
        self.next -= short
        following = self.following & short
        short &= 24
        self.range <<= short
        self.code <<= short
        self.code |= following
        self.code &= LOW48


def encode_blocks(ids: np.ndarray, bits: int, block: int = BLOCK) -> list[tuple[int, bytes]]:
    """(number of ids, payload) of each block of ``ids``.

    All ids are known, so what follows from them alone is done for many steps in one go.
    """
    n, whole = -(-len(ids) // block), len(ids) // block
    if not n:
        return []
    lengths = np.full(n, block)
    lengths[-1] = len(ids) - block * (n - 1)
    padded = np.zeros((n, block + 2), np.int32)  # two ids before the first
    padded[:whole, 2:] = ids[: whole * block].reshape(whole, block)
    padded[whole:, 2 : 2 + len(ids) - whole * block] = ids[whole * block :]
    models, coder = Models(n), RangeCoder(n)
    both = STEPS, 2, n
    arrays = [np.empty(s, k) for s, k in ((both, np.int64), (both, np.int32), (both, np.int32), (both, np.int32), ((STEPS, n), np.int32), (both, np.int64), (both, np.int64))]
    arrays.append(np.full(both, 16))
    for begin, end in spans(int(lengths[0]), int(lengths[-1])):
        some, m = np.ascontiguousarray(padded[:, begin : end + 2].T), end - begin
        got = some[2:]
        at, e, q, off, weight, start, size, places = (a[:m] for a in arrays)
        id8 = got << 3
        models.contexts(some[1:-1] * np.int64(HASH1), some[:-2] * np.int64(HASH2), at)
        for step in range(m):
            models.entries(at[step], e[step])
            models.remember(at[step], e[step], id8[step])
        agree, hit = below(e[:, 0] ^ e[:, 1], 8), below(e ^ id8[:, None], 8)
        np.add(e & 7, models.at8, out=at)
        for step in range(m):
            models.right.take(at[step], out=q[step], mode="clip")
            off[step] = models.judge(at[step], q[step], hit[step])
        change = weight_change(off, agree)
        for step in range(m):
            weight[step] = models.weight
            models.weigh(change[step])
        f1, f2 = frequencies(q, weight, agree)
        hit1, hit2, no1, no2 = hit[:, 0], hit[:, 1], ~hit[:, 0], ~hit[:, 1]
        # of each id the choice, then the id itself where neither order names it
        start[:, 0] = no2 & (f2 + (no1 & f1))
        size[:, 0] = (hit2 & f2) + (no2 & ((hit1 & f1) + (no1 & (65536 - f2 - f1))))
        no1 &= no2
        places[:, 1] = no1 & (16 + bits)
        models.count(got >> bits, no1)
        low, f = models.interval((got >> bits) + models.first)
        low <<= bits
        low += (got & ((1 << bits) - 1)) * f
        np.bitwise_and(low, no1, out=start[:, 1])
        f -= 1
        f &= no1
        np.add(f, 1, out=size[:, 1])
        coder.encode(start, size, places)
        if end == lengths[-1]:
            coder.end_last()
        if refresh_at(end - 1):
            models.refresh()
    return list(zip(lengths.tolist(), coder.finish(), strict=True))


def decode_blocks(blocks: list[tuple[int, bytes]], bits: int) -> np.ndarray:
    """Ids of blocks in order; all but the last have the same length."""
    n = len(blocks)
    if not n:
        return np.zeros(0, np.int32)
    lengths = [k for k, _ in blocks]
    if any(k != lengths[0] for k in lengths[:-1]) or lengths[-1] > lengths[0]:
        raise ValueError("blocks of different lengths cannot be decoded side by side")
    models, decoder = Models(n, finding=True), RangeDecoder([p for _, p in blocks])
    out = np.zeros((n, lengths[0]), np.int32)
    at, place, e, q = np.empty((2, n), np.int64), np.empty((2, n), np.int64), np.empty((2, n), np.int32), np.empty((2, n), np.int32)
    most = (1 << 16 + bits) - 1
    hashed1, hashed2, last = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for begin, end in spans(lengths[0], lengths[0]):
        steps, missed = np.empty((end - begin, n), np.int32), np.empty((end - begin, n), np.int32)
        for got, neither in zip(steps, missed, strict=True):
            models.contexts(hashed1, hashed2, at)
            models.entries(at, e)
            np.copyto(place, e & 7)
            place += models.at8
            models.right.take(place, out=q, mode="clip")
            agree = below(e[0] ^ e[1], 8)
            hit = decoder.choose(*frequencies(q, models.weight, agree))
            named = e >> 3
            np.subtract(named[1], named[0], out=got)
            got &= hit[1].astype(np.int32)
            got += named[0]
            miss = ~hit[0]
            neither[:] = miss
            if neither.any():
                # a block in which an order names the id has an interval of 1 of 2 ** 0
                v = decoder.value(miss & (16 + bits))
                np.minimum(v, most, out=v)
                top = models.find(v >> bits)
                low, f = models.interval(top)
                low <<= bits
                v -= low
                rest = (v / f).astype(np.int64)
                np.minimum(rest, (1 << bits) - 1, out=rest)
                low += rest * f
                low &= miss
                f -= 1
                f &= miss
                f += 1
                decoder.consume(low, f)
                top -= models.first
                top <<= bits
                top += rest
                top -= got
                top &= miss
                got += top.astype(np.int32)
            id8 = got << 3
            models.weigh(weight_change(models.judge(place, q, below(e ^ id8, 8)), agree))
            models.remember(at, e, id8)
            np.multiply(last, HASH2, out=hashed2)
            np.copyto(last, got)
            np.multiply(last, HASH1, out=hashed1)
        out[:, begin:end] = steps.T
        models.count(steps >> bits, missed)
        if refresh_at(end - 1):
            models.refresh()
    return out.ravel()[: lengths[0] * (n - 1) + lengths[-1]]


class FileWriter:
    """One file: magic, payloads, then an index of blocks and documents and its place."""

    def __init__(self, sink, bits: int, block: int = BLOCK, lanes: int = LANES):
        self.sink, self.bits, self.block, self.lanes = sink, bits, block, lanes
        self.blocks: list[tuple[int, int, int]] = []  # ids, bytes, checksum of the ids
        self.docs: list[int] = []
        self.sizes: list[int] = []
        self.missing: list[int] = []
        self.parts, self.held = [], 0
        sink.write(MAGIC)
        self.bytes = len(MAGIC)

    def add(self, doc: int | None, ids: bytes) -> None:
        if doc is None:
            self.missing.append(len(self.docs))
        self.docs.append(doc or 0)
        self.sizes.append(len(ids) // 4)
        self.parts.append(ids)
        self.held += len(ids) // 4
        if self.held >= self.block * self.lanes:
            self._code(last=False)

    def _code(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self.parts), "<u4")
        width = self.block * self.lanes
        whole = len(ids) if last else len(ids) // width * width
        for start in range(0, whole, width):
            some = ids[start : min(start + width, whole)]
            for i, (k, payload) in enumerate(encode_blocks(some.astype(np.int32), self.bits, self.block)):
                check = zlib.crc32(some[i * self.block : i * self.block + k].tobytes())
                self.blocks.append((k, len(payload), check))
                self.sink.write(payload)
                self.bytes += len(payload)
        rest = ids[whole:].tobytes()
        self.parts, self.held = [rest] if rest else [], len(rest) // 4

    def close(self) -> None:
        self._code(last=True)
        out = io.BytesIO()
        np.savez_compressed(
            out, blocks=np.array(self.blocks, np.int64).reshape(-1, 3), docs=np.array(self.docs, np.int64),
            sizes=np.array(self.sizes, np.int64), missing=np.array(self.missing, np.int64), bits=np.int64(self.bits),
        )
        index = out.getvalue()
        self.sink.write(index + struct.pack("<QQ", self.bytes, len(index)) + MAGIC)
        self.sink.close()


def read_file(raw, lanes: int = LANES):
    """(document, ids before it in the file, ids as bytes), block groups decoded one after another."""
    size = raw.size()
    raw.seek(size - 24)
    place, length, magic = struct.unpack("<QQ8s", raw.read(24))
    if magic != MAGIC:
        raise ValueError("not a token-id file")
    raw.seek(place)
    index = np.load(io.BytesIO(raw.read(length)))
    blocks, bits = index["blocks"].tolist(), int(index["bits"])
    sizes, docs, missing = index["sizes"].tolist(), index["docs"].tolist(), set(index["missing"].tolist())
    raw.seek(len(MAGIC))
    held, number, before = b"", 0, 0
    for start in range(0, len(blocks), lanes):
        some = blocks[start : start + lanes]
        ids = decode_blocks([(k, raw.read(n)) for k, n, _ in some], bits).astype("<u4")
        at = 0
        for k, _, check in some:
            if zlib.crc32(ids[at : at + k].tobytes()) != check:
                raise ValueError("a block's checksum does not match")
            at += k
        held += ids.tobytes()
        at = 0
        while number < len(sizes) and at + 4 * sizes[number] <= len(held):
            n = sizes[number]
            yield None if number in missing else docs[number], before, held[at : at + 4 * n]
            at, number, before = at + 4 * n, number + 1, before + n
        held = held[at:]


MANIFEST = pa.schema([("part", pa.int64()), ("number", pa.int64()), ("file", pa.string()), ("docs", pa.int64()), ("ids", pa.int64())])


def write_tokens(docs: DataFrame, path: str, folder: str | None = None, end_id: int = 1, most_id: int = 65_535) -> str:
    """Encode every document, append ``end_id``, and write the ids in ascending doc_id order.

    Rows are dealt out by ranges of ``doc_id``; each task writes files of its own and
    returns their names, which become the folder's manifest table. Files of lost or
    repeated tasks are not in it. Null and empty texts are the end id alone; rows
    without id come first and equal ids in the order of their texts' hashes; an empty
    table gives a manifest without files; further columns are not looked at.
    """
    spark = docs.sparkSession
    folder = folder or run_path(spark, "tokens")
    bits = low_bits(most_id)

    def write(batches):
        fs, root = file_system(folder)
        fs.create_dir(root, recursive=True)
        part, number, model, end = TaskContext.get().partitionId(), 0, encoder(path), end_id.to_bytes(4, "little")
        writer, name, rows = None, "", []

        def close():
            writer.close()
            rows.append((part, number, name, len(writer.docs), sum(writer.sizes)))

        for batch in slices(batches):
            for doc, ids in zip(column(batch, "doc_id"), model.ids(column(batch, "text", "")), strict=True):
                if writer and sum_ids >= FILE_IDS:
                    close()
                    writer, number = None, number + 1
                if not writer:
                    name = f"ids-{uuid.uuid4().hex}.bin"
                    writer, sum_ids = FileWriter(fs.open_output_stream(f"{root}/{name}"), bits), 0
                writer.add(doc, ids + end)
                sum_ids += len(ids) // 4 + 1
        if writer:
            close()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), MANIFEST, strict=True)], schema=MANIFEST)

    rows = first_column(docs, "doc_id", "text")
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    ordered.mapInArrow(write, "part long, number long, file string, docs long, ids long").write.parquet(f"{folder}/manifest")
    return folder


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of a folder: ``ids`` are little-endian 32-bit integers.

    A row per document that was written, repeated ones and those without id included, however long;
    a folder of an empty table has none. Ids that fail their block's checksum are an error.
    """
    manifest = spark.read.schema("part long, number long, file string, docs long, ids long").parquet(f"{folder}/manifest")
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    files = manifest.withColumn("before", F.coalesce(F.sum("ids").over(before), F.lit(0))).select("file", "before")
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def read(batches):
        fs, root = file_system(folder)
        for batch in batches:
            for name, first in zip(column(batch, "file"), column(batch, "before"), strict=True):
                rows, size = [], 0
                with fs.open_input_file(f"{root}/{name}") as raw:
                    for doc, start, ids in read_file(raw):
                        rows.append((doc, first + start, len(ids) // 4, ids))
                        size += len(ids)
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    files = cut_lineage(files, "files")
    spread = files.repartition(max(1, min(files.count(), 100_000)), "file")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")
