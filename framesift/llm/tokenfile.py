"""A compact file format for token ids: adaptive context mixing and a range coder, in independent, checksummed blocks.

The ids of documents, in ascending doc_id order, are cut into blocks of BLOCK ids. Each block starts from empty
models of orders 1 and 2 and can be read alone. For each id, the order-2 and order-1 contexts (the last two ids, the last
one) each predict the id that followed last time, with a confidence. Order 0 is the distribution of whole ids in the
segment, whose head holds it. The three are mixed: an id's probability is the sum of the order-0 probability and those of
the contexts that predict it, by weights that the block learns for each pair of confidences. A carry-less range coder with
64-bit state and 16-bit digits encodes the ids. Blocks do not depend on each other, so that numpy codes all blocks of a
segment in step, one id of each at a time.

A segment, as bytes (numbers little-endian): MAGIC; uint32 number of documents, of blocks; uint32 block length, number of
different ids; then per document int64 doc_id, uint8 (1: doc_id is null), uint32 number of ids; then per different id,
ascending, uint32 id and uint32 frequency; then per block uint32 number of ids, uint32 crc32 of its ids (uint32 each),
uint32 bytes of its code; uint32 crc32 of all before it; then the codes of the blocks in order: digits (uint16).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framesift.llm.common import kept_in_process, partitions_for, table, written
from framesift.llm.tokenids import Encoder, vocabulary

MAGIC = b"FSTOK4\0\0"
BLOCK = 4096
SEGMENT = 9_000_000  # ids after which a segment ends: what a task holds and codes at once
HASH_BITS = 11  # of the table of each order
WEIGHT_BITS = 12  # weights add up to 4096
MOST_NAMES = 1 << 18  # different ids of a segment, from whatever vocabulary
_TOP, _BOT = np.uint64(1 << 48), np.uint64(1 << 32)
_FOUR, _16, _48, _LOW32 = np.uint64(4), np.uint64(16), np.uint64(48), np.uint64(0xFFFFFFFF)
_ONE, _TWO, _THREE = np.uint32(1), np.uint32(2), np.uint32(3)
# the weights of orders 2 and 1, of 4096, move by 1/32 to these, by which was right: none, 1, 2, both; the rest is order 0's
_GOAL = np.array([[32, 32, 4000, 4000], [32, 4000, 32, 32]], dtype=np.int32)


class Order0:
    """The distribution of a segment's ids: names ascending, and frequencies of at least 1 that add up to 1 << bits."""

    def __init__(self, names: np.ndarray, freq: np.ndarray):
        self.names, total = names, int(freq.sum()) or 1
        self.bits = total.bit_length() - 1
        if total != 1 << self.bits:
            raise ValueError("the head of a segment is damaged")
        top = int(names[-1]) + 2 if len(names) else 1
        dense = top <= 1 << 22  # else ids are found by search
        self.place = None if not dense else np.zeros(top, np.int64)
        if dense:
            self.place[names.astype(np.int64) + 1] = np.arange(1, len(names) + 1)
        # of place 0, no id: nothing; places begin at 1
        self.freq = np.concatenate([np.zeros(1, np.uint32), freq.astype(np.uint32)])
        self.cum = np.concatenate([np.zeros(2, np.uint32), np.cumsum(freq)[:-1].astype(np.uint32)])[: len(names) + 1]
        self.slot = np.repeat(np.arange(1, len(names) + 1, dtype=np.uint32), freq)

    @classmethod
    def of(cls, ids: np.ndarray) -> Order0:
        names, n = np.unique(ids, return_counts=True)
        if not len(names):
            return cls(names, np.zeros(0, np.int64))
        if len(names) > MOST_NAMES:
            raise ValueError(f"a segment has more than {MOST_NAMES} different ids")
        bits = max(16, (len(names)).bit_length() + 1)  # at least twice as many as ids, so that frequencies of 1 cost little
        freq = 1 + np.floor(n / n.sum() * ((1 << bits) - len(names))).astype(np.int64)
        freq[n.argmax()] += (1 << bits) - freq.sum()
        return cls(names, freq)

    def places(self, ids: np.ndarray) -> np.ndarray:
        return (self.place[ids.astype(np.int64) + 1] if self.place is not None else np.searchsorted(self.names, ids) + 1).astype(np.uint32)


class Models:
    """The models of orders 1 and 2 and the mixing weights of n blocks, side by side. Ids are places in the order 0."""

    def __init__(self, n: int, bits: int):
        at = np.arange(n, dtype=np.int64)
        self.base = np.stack([at << HASH_BITS, (n + at) << HASH_BITS])
        self.rows = at << 4
        # a cell: predicted id, shifted by 2, and its confidence 0 to 3; first those of order 2
        self.cells = np.zeros(2 * n << HASH_BITS, dtype=np.uint32)
        self.mix = np.full(n * 16, 1024 | 1024 << 16, dtype=np.uint32)
        self.last, self.before = (np.zeros(n, dtype=np.uint32) for _ in range(2))
        self.bits = np.uint32(bits)

    def predict(self, k: int):
        """Of the first k blocks: what orders 2 and 1 predict, their weights times 1 << bits, the weight of order 0; and what learn() needs."""
        h = self.last[:k] * np.uint32(0x9E3779B1)
        cells = np.empty((2, k), dtype=np.uint32)
        np.multiply(h ^ self.before[:k], np.uint32(0x85EBCA77), out=cells[0])
        cells[1] = h
        cells >>= np.uint32(32 - HASH_BITS)
        i = self.base[:, :k] + cells
        c = self.cells.take(i)
        sure = c & _THREE
        row = self.rows[:k] + ((sure[0] << _TWO) | sure[1])
        p = self.mix.take(row)
        weights = np.empty((2, k), dtype=np.uint32)
        np.bitwise_and(p, np.uint32(0xFFFF), out=weights[0])
        np.right_shift(p, np.uint32(16), out=weights[1])
        rest = np.uint32(1 << WEIGHT_BITS) - weights[0] - weights[1]
        return c >> _TWO, weights << self.bits, rest, (i, c, sure, row, weights)

    def learn(self, k: int, x: np.ndarray, right: np.ndarray, seen) -> None:
        i, c, sure, row, weights = seen
        self.cells[i] = np.where(right, c + (sure < _THREE), (x << _TWO) | _ONE)
        which = right.view(np.uint8)
        goal = _GOAL.take((which[0] << 1) | which[1], axis=1)
        p = weights.view(np.int32)
        goal -= p
        goal >>= 5
        p += goal
        self.mix[row] = weights[0] | weights[1] << np.uint32(16)
        self.before[:k] = self.last[:k]
        self.last[:k] = x


def _interval(order0: Order0, x: np.ndarray, told: np.ndarray, weights: np.ndarray, rest: np.ndarray):
    """Start and length of the ids x, of 1 << (WEIGHT_BITS + bits), and which predictions are right: all distributions are
    added up, in order of the ids."""
    right = told == x
    before, own = weights * (told < x), weights * right
    start = rest * order0.cum.take(x) + before[0] + before[1]
    return start, rest * order0.freq.take(x) + own[0] + own[1], right


def _at(order0: Order0, v: np.ndarray, told: np.ndarray, weights: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """The id in whose interval v lies: the smaller prediction, the larger one, or one of order 0, whose scale is that of v
    without the weights of the predictions below."""
    swap = told[0] > told[1]
    low, high = np.where(swap, told[1], told[0]), np.where(swap, told[0], told[1])
    w_low, w_high = np.where(swap, weights[1], weights[0]), np.where(swap, weights[0], weights[1])
    start = rest * order0.cum.take(low)
    end = start + rest * order0.freq.take(low) + w_low
    is_low = (v >= start) & (v < end)
    v = v - w_low * (v >= end)
    start = rest * order0.cum.take(high)
    end = start + rest * order0.freq.take(high) + w_high
    is_high = (v >= start) & (v < end)
    v = np.minimum((v - w_high * (v >= end)) // rest, np.uint32(len(order0.slot) - 1))
    return np.where(is_low, low, np.where(is_high, high, order0.slot.take(v)))


def _due(low: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether a digit is due; sizes that got too small at a digit's edge are cut to it."""
    due = (low ^ (low + size)) < _TOP
    small = size < _BOT
    if small.any():
        cut = np.flatnonzero(small & ~due)
        size[cut] = (np.uint64(0) - low[cut]) & _LOW32
        due |= small
    return due


def _alive(lengths: np.ndarray, longest: int) -> list[int]:
    """For each place up to the longest block's end, how many blocks have an id there: the first ones."""
    return np.searchsorted(-lengths, -np.arange(longest), side="left").tolist()


def encode_blocks(blocks: list[np.ndarray], order0: Order0) -> list[bytes]:
    """The digits of each block of places; the blocks' lengths must not increase."""
    n, longest = len(blocks), max((len(b) for b in blocks), default=0)
    lengths = np.array([len(b) for b in blocks], dtype=np.int64)
    ids = np.zeros((longest, n), dtype=np.uint32)
    for k, b in enumerate(blocks):
        ids[: len(b), k] = b
    m = Models(n, order0.bits)
    low, size = np.zeros(n, np.uint64), np.full(n, 0xFFFFFFFFFFFFFFFF, np.uint64)
    width = 4 * longest + 8
    out, pos = np.zeros(n * width, dtype=np.uint16), np.arange(n, dtype=np.int64) * width
    scale = np.uint64(WEIGHT_BITS + order0.bits)
    for t, k in enumerate(_alive(lengths, longest)):
        x = ids[t, :k]
        told, weights, rest, seen = m.predict(k)
        start, length, right = _interval(order0, x, told, weights, rest)
        m.learn(k, x, right, seen)
        lo, sz = low[:k], size[:k]
        sz >>= scale
        lo += sz * start
        sz *= length
        due = _due(lo, sz)  # for all blocks at once: where no digit is due, the next one takes its place
        out[pos[:k]] = (lo >> _48).astype(np.uint16)
        shift = due.astype(np.uint64)
        pos[:k] += shift.view(np.int64)
        shift <<= _FOUR
        lo <<= shift
        sz <<= shift
        while (small := sz < _BOT).any():  # unlikely ids; a digit that is due with a size large enough can wait
            j = np.flatnonzero(small)
            l, s = lo[j], sz[j]
            _due(l, s)
            out[pos[j]] = l >> _48
            pos[j] += 1
            lo[j], sz[j] = l << _16, s << _16
    for _ in range(4):
        out[pos] = low >> _48
        pos += 1
        low <<= _16
    return [out[k * width : pos[k]].astype("<u2").tobytes() for k in range(n)]


def decode_blocks(coded: list[bytes], lengths: list[int], order0: Order0) -> list[np.ndarray]:
    """The places of each block again."""
    n, longest = len(coded), max(lengths, default=0)
    count = np.array(lengths, dtype=np.int64)
    width = max((len(c) // 2 for c in coded), default=0) + 8
    words, pos = np.zeros(n * width, dtype=np.uint16), np.arange(n, dtype=np.int64) * width
    for k, c in enumerate(coded):
        words[k * width : k * width + len(c) // 2] = np.frombuffer(c, "<u2")
    ids = np.zeros((longest, n), dtype=np.uint32)
    m = Models(n, order0.bits)
    low, size, code = np.zeros(n, np.uint64), np.full(n, 0xFFFFFFFFFFFFFFFF, np.uint64), np.zeros(n, np.uint64)
    for _ in range(4):
        code = (code << _16) | words[pos]
        pos += 1
    scale = np.uint64(WEIGHT_BITS + order0.bits)
    most = np.uint64((1 << int(scale)) - 1)
    for t, k in enumerate(_alive(count, longest)):
        told, weights, rest, seen = m.predict(k)
        lo, sz, co = low[:k], size[:k], code[:k]
        sz >>= scale
        v = np.minimum((co - lo) // sz, most).astype(np.uint32)
        x = _at(order0, v, told, weights, rest)
        start, length, right = _interval(order0, x, told, weights, rest)
        m.learn(k, x, right, seen)
        ids[t, :k] = x
        lo += sz * start
        sz *= length
        due = _due(lo, sz)
        shift = due.astype(np.uint64)
        digits = words.take(pos[:k]) * shift
        pos[:k] += shift.view(np.int64)
        shift <<= _FOUR
        co <<= shift
        co |= digits
        lo <<= shift
        sz <<= shift
        while (small := sz < _BOT).any():
            j = np.flatnonzero(small)
            l, s = lo[j], sz[j]
            _due(l, s)
            co[j] = (co[j] << _16) | words[pos[j]]
            pos[j] += 1
            lo[j], sz[j] = l << _16, s << _16
    by_block = np.ascontiguousarray(ids.T)
    return [by_block[k, : lengths[k]] for k in range(n)]


def write_segment(doc_ids: np.ndarray, nulls: np.ndarray, lengths: np.ndarray, ids: np.ndarray, block: int = BLOCK) -> bytes:
    """A segment: documents' ids, one after another."""
    ids = np.ascontiguousarray(ids, dtype="<u4")
    order0 = Order0.of(ids)
    blocks, places = [ids[k : k + block] for k in range(0, len(ids), block)], order0.places(ids)
    coded = encode_blocks([places[k : k + block] for k in range(0, len(ids), block)], order0)
    head = [MAGIC, np.array([len(doc_ids), len(blocks), block, len(order0.names)], "<u4").tobytes(), doc_ids.astype("<i8").tobytes(), nulls.astype("u1").tobytes(), lengths.astype("<u4").tobytes()]
    head += [order0.names.astype("<u4").tobytes(), order0.freq[1:].astype("<u4").tobytes()]
    head += [np.array([[len(b), zlib.crc32(b.tobytes()), len(c)] for b, c in zip(blocks, coded, strict=True)], "<u4").tobytes()]
    head = b"".join(head)
    return b"".join([head, zlib.crc32(head).to_bytes(4, "little"), *coded])


def read_segment(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What write_segment() was given; ValueError if a checksum does not hold."""
    if data[:8] != MAGIC:
        raise ValueError("no segment of token ids")
    docs, blocks, _, different = (int(x) for x in np.frombuffer(data, "<u4", 4, 8))
    at = 24
    doc_ids = np.frombuffer(data, "<i8", docs, at)
    nulls = np.frombuffer(data, "u1", docs, at + 8 * docs).astype(bool)
    lengths = np.frombuffer(data, "<u4", docs, at + 9 * docs).astype(np.int64)
    at += 13 * docs
    names, freq = (np.frombuffer(data, "<u4", different, at + 4 * different * k) for k in range(2))
    at += 8 * different
    rows = np.frombuffer(data, "<u4", 3 * blocks, at).reshape(blocks, 3)
    at += 12 * blocks
    if zlib.crc32(data[:at]) != int.from_bytes(data[at : at + 4], "little"):
        raise ValueError("the head of a segment is damaged")
    ends = (at + 4 + np.cumsum(rows[:, 2].astype(np.int64))).tolist()
    coded = [data[e - c : e] for c, e in zip(rows[:, 2].tolist(), ends, strict=True)]
    try:
        out = decode_blocks(coded, rows[:, 0].astype(int).tolist(), Order0(names, freq.astype(np.int64))) if blocks else []
    except (IndexError, ZeroDivisionError) as e:  # more digits are asked for than there are
        raise ValueError("a block is damaged") from e
    out = [names[b.astype(np.int64) - 1] for b in out]
    for b, row in zip(out, rows, strict=True):
        if zlib.crc32(b.astype("<u4").tobytes()) != int(row[1]):
            raise ValueError("a block is damaged")
    return doc_ids, nulls, lengths, np.concatenate(out) if out else np.zeros(0, np.uint32)


def segments(docs: DataFrame, model_path: str, end_id: int, segment: int = SEGMENT, block: int = BLOCK) -> DataFrame:
    """docs(doc_id, text) to rows (part, segment, before, n_tokens, n_docs, data), to be written as files.

    Parts ascend with doc_id (nulls first), segments within a part; before: ids of the part before the segment. Each
    document is its ids and end_id; null and empty texts are end_id alone; repeated rows are documents of their own.
    """
    model = vocabulary(model_path)
    shared, digest = docs.sparkSession.sparkContext.broadcast(model), hash(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encoder = kept_in_process("encoder", digest, lambda: Encoder(shared.value))
        held: list[tuple] = []
        n, count, before = 0, 0, 0

        def row() -> pa.RecordBatch:
            ids = np.concatenate([x[2] for x in held])
            data = write_segment(np.array([x[0] or 0 for x in held], np.int64), np.array([x[0] is None for x in held]), np.array([len(x[2]) for x in held]), ids, block)
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "segment": pa.array([count], pa.int32()), "before": [before], "n_tokens": [n], "n_docs": pa.array([len(held)], pa.int64()), "data": pa.array([data], pa.binary())})

        for batch in batches:
            for doc_id, x in zip(batch.column(0).to_pylist(), encoder.many(batch.column(1).to_pylist()), strict=True):
                x = np.append(x, np.uint32(end_id))
                held.append((doc_id, None, x))
                n += len(x)
                if n >= segment:
                    yield row()
                    before, count = before + n, count + 1
                    held, n = [], 0
        if held:
            yield row()

    x = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    x = x.repartitionByRange(partitions_for(docs.sparkSession), F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first())
    return x.mapInArrow(run, "part int, segment int, before long, n_tokens long, n_docs long, data binary")


def read_back(files: DataFrame) -> DataFrame:
    """What segments() has written, to (doc_id, start, n_tokens, ids_crc32), a row for each document. The driver gets a
    number for each part."""
    base, so_far = {}, 0
    for part, n in sorted(files.groupBy("part").agg(F.sum("n_tokens")).collect()):
        base[part], so_far = so_far, so_far + n
    shared = files.sparkSession.sparkContext.broadcast(base)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, before, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                doc_ids, nulls, lengths, ids = read_segment(data)
                start = np.concatenate(([0], np.cumsum(lengths)[:-1]))
                ids = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(ids[4 * a : 4 * (a + n)]) for a, n in zip(start.tolist(), lengths.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64(), mask=nulls), pa.array(start + before + shared.value[part]), pa.array(lengths), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.select("part", "before", "data").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents under word_bpe_49k.json, written to files and read back: see segments() and read_back()."""
    import public_tokenizers

    return read_back(written(segments(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2), "tokens"))
