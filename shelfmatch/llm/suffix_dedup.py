"""Removal of passages that another document already has, by a distributed merge sort of suffixes.

A byte goes if a string of ``length`` bytes over it also starts in a document with a smaller id. Sorting every suffix of a
corpus would move many times its size, so suffixes that cannot have a partner are dropped first, without loss:

1. Documents are packed into blocks, written once. Every window of ``length`` bytes has an anchor, its least hash of
   ``GRAM`` bytes; equal windows have equal anchors. Runs of windows with the same anchor are *stretches*; a block sends
   the sorted, packed hashes of its stretches, with the least id that holds each, to ranges of anchors.
2. A range tells each block which stretches a smaller document holds whole (removed at once), and which are the first of
   their kind but share the anchor with other stretches of other documents: their windows may still be equal in part.
3. Suffixes that start those windows are sorted in each block and exchanged as front-coded runs, by ranges of all their
   bytes. A range merges its runs part by part: of each run it reads some strings ahead, and all that are not beyond the
   first run's end of these are merged as arrays. Equal neighbours tell the least id of each window.
4. Blocks join the places of such windows, and what went in step 2, with their own texts.

Blocks meet answers through a bucketed table, so texts move once and are never shuffled.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfmatch.llm.common import quoted, unused
from shelfmatch.session import keep_until_released, materialize, scratch_path

#: Bytes of an anchor.
GRAM = 24
#: Bytes of text in a block, windows read at once, bytes of text to one range of suffixes; ranges of hashes take twice as
#: many, but no more than lets every core have some. Each block sends a row to each range, so larger ones mean fewer rows.
BLOCK, CHUNK, RANGE = 8 << 20, 1 << 16, 16 << 20
#: Strings that a range merges at once, strings that it reads ahead of each run at least, and strings read in one go.
MERGED, AHEAD, STEP = 1 << 19, 32, 1 << 11
#: Bytes of answers or runs that go on together.
SENT = 4 << 20
#: Strings that a block shows of itself for cutting ranges, and how many of them one task sorts.
SAMPLE, SORTED = 128, 1 << 20
#: Bits kept of the hashes of an anchor and of a stretch; together they stand for a stretch.
ANCHOR_BITS, STRETCH_BITS = 40, 48
#: A row without an id comes after all others.
LAST = (1 << 63) - 1

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * 2 + 1
_MULT = [np.uint64(int(x) | 1) for x in _RANDOM.integers(1 << 40, 1 << 62, 16)]


# Packed arrays


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed string; equal bytes of all numbers stand together, so small numbers cost little."""
    head, body = [struct.pack("<I", len(arrays))], []
    for a in arrays:
        head.append(struct.pack("<2sQ", a.dtype.str[1:].encode(), len(a)))
        body.append(np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T).tobytes())
    return zstandard.ZstdCompressor(level=2).compress(b"".join(head + body))


def unpack(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    count, at, shapes, out = struct.unpack_from("<I", raw)[0], 4, [], []
    for _ in range(count):
        kind, n = struct.unpack_from("<2sQ", raw, at)
        shapes.append((np.dtype("<" + kind.decode()), n))
        at += struct.calcsize("<2sQ")
    for kind, n in shapes:
        plane = np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(plane.T).view(kind).reshape(n))
        at += n * kind.itemsize
    return out


def pack_texts(ids: list[int | None], texts: list[bytes]) -> bytes:
    numbers = np.array([LAST if i is None else i for i in ids], np.int64)
    return pack(numbers, np.array([len(t) for t in texts], np.int64), np.frombuffer(b"".join(texts), np.uint8))


# Stretches


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _MULT[10]
    return x ^ (x >> np.uint64(32))


def _levels(data: np.ndarray, width: int) -> list[np.ndarray]:
    """Hashes of all strings of 1, 2, 4, ... bytes up to ``width``, each from those of half the length."""
    out = [_BYTE[data]]
    while 2 << (len(out) - 1) <= width:
        have, done = out[-1], 1 << (len(out) - 1)
        out.append(have[:-done] * _MULT[len(out)] + have[done:])
    return out


def _hash(levels: list[np.ndarray], width: int) -> np.ndarray:
    """Hashes of all strings of ``width`` bytes, put together from powers of two."""
    n, at, out = len(levels[0]) - width + 1, 0, None
    for k in reversed(range(width.bit_length())):
        if width >> k & 1:
            part = levels[k][at:at + n]
            out = part if out is None else out * _MULT[8] + part
            at += 1 << k
    return out


def _hash_at(levels: list[np.ndarray], width: int, at: np.ndarray) -> np.ndarray:
    """What ``_hash`` has at the places ``at``."""
    out = None
    for k in reversed(range(width.bit_length())):
        if width >> k & 1:
            part = levels[k][at]
            out = part if out is None else out * _MULT[8] + part
            at = at + (1 << k)
    return out


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    done = 1
    while done * 2 <= width:
        x, done = np.minimum(x[:-done], x[done:]), done * 2
    return np.minimum(x[:len(x) - (width - done)], x[width - done:]) if width > done else x


def documents_at(stops: np.ndarray, a: int, b: int) -> np.ndarray:
    """The place of the document of each byte from ``a`` to ``b``, of documents that stop at ``stops``."""
    first, last = int(np.searchsorted(stops, a, "right")), int(np.searchsorted(stops, b, "left"))
    return np.repeat(np.arange(first, last + 1, dtype=np.int32), np.diff(np.minimum(stops[first:last + 1], b), prepend=a))


def stretches(data: np.ndarray, stops: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Anchor hash, stretch hash, first window and number of windows of every stretch of a block.

    No window spans two documents, which stop at ``stops``. Chunks may cut a stretch: equal windows keep equal
    anchors, and a cut stretch is only looked at more closely.
    """
    gram = min(GRAM, length)
    found: list[tuple[np.ndarray, ...]] = []
    for at in range(0, len(data) - length + 1, CHUNK):
        part = data[at:at + CHUNK + length - 1]
        own = documents_at(stops, at, at + len(part))
        n = len(part) - length + 1
        levels = _levels(part, length)
        anchor = _least(_mixed(_hash(levels, gram)), length - gram + 1)[:n]
        whole = own[:n] == own[length - 1:]
        first = whole.copy()
        first[1:] &= ~(whole[:-1] & (anchor[1:] == anchor[:-1]) & (own[1:n] == own[:n - 1]))
        last = whole.copy()
        last[:-1] &= first[1:] | ~whole[1:]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last)
        if not len(starts):
            continue
        # The first and the last window hold all bytes of a stretch, unless it is long: then all its windows count.
        total, long = np.zeros(len(starts), np.uint64), np.flatnonzero(ends - starts > length)
        if len(long):
            total[long] = np.add.reduceat(np.where(whole, _hash(levels, length), np.uint64(0)), starts)[long]
        of_first, of_last = _hash_at(levels, length, starts), _hash_at(levels, length, ends)
        stretch = _mixed((total ^ (of_first * _MULT[11])) + of_last * _MULT[12] + (ends - starts).astype(np.uint64) * _MULT[13])
        found.append((anchor[starts], stretch, (starts + at).astype(np.uint32), (ends - starts + 1).astype(np.uint32)))
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.uint32), np.empty(0, np.uint32)
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def equal_parts(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Value, begin and end of each part of equal neighbours."""
    edges = np.flatnonzero(np.diff(values, prepend=-1, append=-1)) if len(values) else values
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        yield int(values[a]), a, b


def joined(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans from ``starts`` to ``stops``, those that meet as one, in ascending order."""
    order = np.argsort(starts, kind="stable")
    starts, stops = starts[order], np.maximum.accumulate(stops[order])
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] > stops[:-1]
    return starts[new].astype(np.uint32), stops[np.append(new[1:], True)[:len(new)]].astype(np.uint32)


def in_order(values: np.ndarray) -> np.ndarray:
    """What a stable ``argsort`` gives, by a faster sort after which only equal values are looked at again."""
    order = np.argsort(values)
    sorted_ = values[order]
    twice = np.zeros(len(values), bool)
    twice[1:] = sorted_[1:] == sorted_[:-1]
    twice[:-1] |= twice[1:]
    order[twice] = order[twice][np.lexsort((order[twice], sorted_[twice]))]
    return order


class Block:
    """One block's texts and its stretches, in an order that every reading of the block repeats."""

    def __init__(self, data: bytes, length: int):
        self.ids, self.sizes, self.data = unpack(data)
        self.stops = np.cumsum(self.sizes)
        anchor, stretch, start, count = stretches(self.data, self.stops, length)
        # The least of many hashes is small: hashed once more, anchors spread evenly over the ranges.
        anchor, stretch = _mixed(anchor) >> np.uint64(64 - ANCHOR_BITS), stretch >> np.uint64(64 - STRETCH_BITS)
        spare = np.uint64(64 - ANCHOR_BITS)
        order = in_order(anchor << spare | stretch & np.uint64((1 << (64 - ANCHOR_BITS)) - 1))
        self.anchor, self.stretch, self.start, self.count = anchor[order], stretch[order], start[order], count[order]
        self.owner = self.ids[np.searchsorted(self.stops, start, "right")][order] if len(order) else np.empty(0, np.int64)
        # Equal stretches of the block are one entry with the least id.
        new = np.ones(len(order), bool)
        new[1:] = (self.anchor[1:] != self.anchor[:-1]) | (self.stretch[1:] != self.stretch[:-1])
        self.firsts = np.flatnonzero(new)
        self.entry = np.cumsum(new) - 1
        self.least = np.minimum.reduceat(self.owner, self.firsts) if len(order) else self.owner

    def dealt(self, ranges: int) -> np.ndarray:
        """The range of anchors of each entry, in ascending order."""
        return (self.anchor[self.firsts] * np.uint64(ranges) >> np.uint64(ANCHOR_BITS)).astype(np.int64)

    def sent(self, ranges: int) -> Iterator[tuple[int, bytes]]:
        """For each range met: anchors (as differences), stretches and the least ids (as places in a list) of its entries."""
        for r, a, b in equal_parts(self.dealt(ranges)):
            at = self.firsts[a:b]
            ids, place = np.unique(self.least[a:b], return_inverse=True)
            yield r, pack(np.diff(self.anchor[at], prepend=np.uint64(0)), self.stretch[at], ids, place.astype(np.uint32))

    def told(self, answers: list[tuple[int, bytes]], ranges: int) -> tuple[np.ndarray, np.ndarray]:
        """Stretches that go whole, and those to be looked at window by window, as places in the block's order."""
        state = np.zeros(len(self.firsts), np.uint8)
        to = self.dealt(ranges)
        begin, end = (np.searchsorted(to, [r for r, _ in answers], side) for side in ("left", "right"))
        for a, b, (_, data) in zip(begin, end, answers, strict=True):
            state[a:b] = unpack(data)[0]
        of, later = state[self.entry], self.owner > self.least[self.entry]
        return np.flatnonzero((of == HELD) | later), np.flatnonzero((of == SHARED) & ~later)

    def windows(self, open_: np.ndarray) -> np.ndarray:
        """Places of all windows of the stretches ``open_``, in their order."""
        count = self.count[open_].astype(np.int64)
        return np.repeat(self.start[open_] - np.cumsum(count) + count, count) + np.arange(count.sum())


#: What a range answers for an entry: nothing to do; a smaller document has all of it; look at its windows.
ALONE, HELD, SHARED = 0, 1, 2


def answered(entries: list[tuple[int, bytes]]) -> Iterator[tuple[int, bytes]]:
    """The answers of one range to each block, from the blocks' entries."""
    anchors, parts = [], []
    for _, data in entries:
        steps, *part = unpack(data)
        anchors.append(np.cumsum(steps, dtype=np.uint64))
        parts.append(part)
    anchor = np.concatenate(anchors)
    del anchors
    order = np.argsort(anchor, kind="stable")
    same = np.diff(anchor[order]) == 0
    twice = order[np.concatenate((same, [False])) | np.concatenate(([False], same))]  # places whose anchor stands elsewhere too
    state = np.full(len(anchor), ALONE, np.uint8)
    if len(twice):
        stretch, owner = np.concatenate([p[0] for p in parts])[twice], np.concatenate([p[1][p[2]] for p in parts])[twice]
        order = np.lexsort((owner, stretch, anchor[twice]))
        a, s, o = anchor[twice][order], stretch[order], owner[order]
        new_anchor = np.concatenate(([True], a[1:] != a[:-1]))
        new = new_anchor | np.concatenate(([True], s[1:] != s[:-1]))
        least = o[new][np.cumsum(new) - 1]  # sorted: the first has the least id
        groups = np.flatnonzero(new_anchor)
        mixed = np.minimum.reduceat(least, groups) < np.maximum.reduceat(least, groups)
        found = np.where(np.repeat(mixed, np.diff(np.append(groups, len(order)))), SHARED, ALONE)
        state[twice[order]] = np.where(least < o, HELD, found)
    at = 0
    for (block, _), p in zip(entries, parts, strict=True):
        own, at = state[at:at + len(p[0])], at + len(p[0])
        if own.any():
            yield block, pack(own)


# Suffix runs


def prefixes(data: np.ndarray, at: np.ndarray, width: int = 8) -> np.ndarray:
    """The first ``width`` (at most eight) bytes at each place as numbers that sort as the bytes do."""
    out = np.zeros(len(at), np.uint64)
    for i in range(width):
        out = out << np.uint64(8) | data[at + i].astype(np.uint64)
    return out


def shared_with_last(text: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
    """How many first bytes each row of ``text`` has in common with the row before; ``before`` is the one before the first."""
    share = np.zeros(len(text), np.int64)
    other = text[1:] != text[:-1]
    share[1:] = np.where(other.any(axis=1), other.argmax(axis=1), text.shape[1])
    if before is not None:
        share[0] = shared_with_last(np.concatenate((before, text[:1])))[1]
    return share


def front_coded(data: np.ndarray, at: np.ndarray, ids: np.ndarray, length: int) -> bytes:
    """A sorted run of the suffixes at ``at``: common prefix with the one before, the rest of the bytes, id, place.

    Suffixes are cut to ``length`` bytes. ``ids`` are the documents'.
    """
    text = np.lib.stride_tricks.sliding_window_view(data, length)[at]
    order = np.argsort(text.view(f"S{length}").ravel(), kind="stable")  # compares all bytes, zero bytes too
    text = text[order]
    shared = shared_with_last(text)
    rest = text[np.arange(length) >= shared[:, None]]
    names, place = np.unique(ids[order], return_inverse=True)
    return pack(shared.astype(np.uint8 if length < 256 else np.uint32), rest, names, place.astype(np.uint32), at[order].astype(np.uint32))


class Run:
    """Reads a front-coded run some strings at a time."""

    def __init__(self, data: bytes, length: int):
        self.shared, self.rest, names, place, self.at = unpack(data)
        self.owners = names[place]  # the id of the document that each string is from
        self.length, self.next, self.read = length, 0, 0
        self.source = np.zeros(length, np.int64)  # where in ``rest`` each byte of the string last read is
        self.ahead = np.empty((0, length), np.uint8)

    def owner(self, at: int) -> int:
        """The id of the document that the string at a place of the run is from."""
        return int(self.owners[at])

    def fill(self, rows: int) -> bool:
        """Have ``rows`` strings ahead, or all that are left; whether there are any."""
        parts, have = [self.ahead], len(self.ahead)
        while have < rows and self.next < len(self.shared):
            shared = self.shared[self.next:self.next + min(rows - have, STEP)]
            own = np.arange(self.length) >= shared[:, None]
            count = np.count_nonzero(own)
            source = np.zeros(own.shape, np.int64)
            source[own] = np.arange(self.read, self.read + count)
            source[0] = np.where(own[0], source[0], self.source)
            np.maximum.accumulate(source, axis=0, out=source)  # a byte in common is where the string before has it
            parts.append(self.rest[source])
            self.source, self.read, self.next, have = source[-1].copy(), self.read + count, self.next + len(shared), have + len(shared)
        self.ahead = np.concatenate(parts) if len(parts) > 1 else self.ahead
        return len(self.ahead) > 0


def merged_parts(runs: list[Run], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Run, place in the run, and common prefix with the string before, for all strings in ascending order, part by part.

    What is read ahead of the runs is bounded. All strings up to the least of the last ones ahead can't be followed by a
    smaller one, so they are put in order together: a merge sort that takes sorted runs as they are. Where runs are so
    different that parts get small, up to four times as many strings are read ahead.
    """
    rows = max(AHEAD, MERGED // max(1, len(runs)))
    most = 4 * rows
    kind = f"S{length}"
    left = list(range(len(runs)))
    before = None
    while left := [r for r in left if runs[r].fill(rows)]:
        more = [runs[r].ahead[-1].tobytes() for r in left if runs[r].next < len(runs[r].shared)]
        bound = np.array([min(more)], kind) if more else None
        texts, places, counts = [], [], []
        for r in left:
            run = runs[r]
            n = len(run.ahead) if bound is None else int(np.searchsorted(run.ahead.view(kind).ravel(), bound, "right")[0])
            first = run.next - len(run.ahead)
            texts.append(run.ahead[:n])
            places.append(np.arange(first, first + n))
            counts.append(n)
            run.ahead = run.ahead[n:]
        text = np.concatenate(texts)
        del texts
        order = np.argsort(text.view(kind).ravel(), kind="stable")  # compares all bytes, zero bytes too
        text = text[order]
        share = shared_with_last(text, before)
        before = text[-1:].copy()
        rows = min(most, 2 * rows) if len(text) < MERGED // 2 else rows
        del text
        yield np.repeat(left, counts)[order], np.concatenate(places)[order], share


def merged(runs: list[Run], length: int) -> Iterator[tuple[int, int, int]]:
    """What ``merged_parts`` gives, string by string."""
    for part in merged_parts(runs, length):
        yield from zip(*[x.tolist() for x in part], strict=True)


def repeats(entries: list[tuple[int, bytes]], length: int) -> Iterator[tuple[int, bytes]]:
    """For each block of one range: places of the suffixes whose first ``length`` bytes a smaller document has too."""
    runs = [Run(data, length) for _, data in entries]
    stop = np.cumsum([len(run.owners) for run in runs])
    begin = np.concatenate(([0], stop[:-1]))
    owners = np.concatenate([run.owners for run in runs])
    hits: list[np.ndarray] = []

    def close(row: np.ndarray, same: np.ndarray) -> None:
        """Groups of equal strings, each whole; ``same`` tells the strings that the one before is equal to."""
        twice = same.copy()
        twice[:-1] |= same[1:]
        row, firsts = row[twice], np.flatnonzero(~same[twice])
        if len(row):
            owner = owners[row]
            least = np.minimum.reduceat(owner, firsts)
            hits.append(row[owner > np.repeat(least, np.diff(np.append(firsts, len(row))))])

    row, same = np.empty(0, np.int64), np.empty(0, bool)  # the last group, which the next part may go on with
    for run, place, share in merged_parts(runs, length):
        row, same = np.concatenate((row, begin[run] + place)), np.concatenate((same, share == length))
        last = int(np.flatnonzero(~same)[-1])
        close(row[:last], same[:last])
        row, same = row[last:], same[last:]
    close(row, same)
    found = np.sort(np.concatenate(hits)) if hits else row[:0]
    for (block, _), run, first, a, b in zip(entries, runs, begin, *np.searchsorted(found, [begin, stop]), strict=True):
        if a < b:
            yield block, pack(np.sort(run.at[found[a:b] - first]))


# The job


def _by_range(rows: DataFrame, ranges: int, answer: Callable[[list[tuple[int, bytes]]], Iterator[tuple[int, bytes]]], name: str) -> DataFrame:
    """Answers to the blocks from rows of ``rng, block, data``: each range is one task.

    Rows of ranges below zero are answers already.
    """

    def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes]]:
        held: list[tuple[int, bytes]] = []
        now = None
        for batch in batches:
            for rng, block, data in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                if rng < 0:
                    yield rng, block, data
                    continue
                if rng != now:
                    yield from ((now, *row) for row in (answer(held) if held else ()))
                    held, now = [], rng
                held.append((block, data))
        yield from ((now, *row) for row in (answer(held) if held else ()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _together(answers(batches))

    dealt = rows.repartitionById(ranges, F.pmod("rng", F.lit(ranges))).sortWithinPartitions("rng", "block")
    return materialize(dealt.mapInArrow(run, "rng int, block long, data binary"), name)


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)


def _together(rows: Iterator[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
    """Rows of ``rng, block, data`` in batches of about ``SENT`` bytes."""
    some, size = [], 0
    for row in rows:
        some.append(row)
        size += len(row[2])
        if size >= SENT:
            yield _batch(some, ["rng", "block", "data"], [pa.int32(), pa.int64(), pa.binary()])
            some, size = [], 0
    if some:
        yield _batch(some, ["rng", "block", "data"], [pa.int32(), pa.int64(), pa.binary()])


def sampled(text: bytes, length: int) -> list[bytes]:
    """``SAMPLE`` strings of ``length`` bytes at places that every reading of the text repeats; none if it is shorter."""
    if len(text) < length:
        return []
    at = np.random.Generator(np.random.PCG64(len(text))).integers(0, len(text) - length + 1, SAMPLE)
    return [text[a:a + length] for a in at.tolist()]


def packed_blocks(docs: DataFrame, keep: tuple[str, ...], block_bytes: int, length: int) -> tuple[DataFrame, int]:
    """Blocks of whole documents as a bucketed table (``block, size, data, rest, sample``), and its buckets.

    ``rest`` holds the columns ``keep`` of the block's rows as an Arrow stream, ``sample`` some strings of ``length`` bytes.
    Rows are not shuffled.
    """
    spark = docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, rest, size = [], [], [], 0

        def out() -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rest[0].schema) as stream:
                for part in rest:
                    stream.write_batch(part)
            row = size, pack_texts(ids, texts), sink.getvalue().to_pybytes(), sampled(b"".join(texts), length)
            return _batch([row], ["size", "data", "rest", "sample"], [pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.binary())])

        for batch in batches:
            first, others = 0, batch.select(list(range(2, batch.num_columns)))
            for at, (i, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True)):
                if ids and size + len(text) > block_bytes:
                    rest.append(others.slice(first, at - first))
                    yield out()
                    ids, texts, rest, size, first = [], [], [], 0, at
                ids.append(i)
                texts.append(text)
                size += len(text)
            if batch.num_rows:
                rest.append(others.slice(first))
        if ids:
            yield out()

    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    named = [F.col(quoted(c)).alias(f"c{k}") for k, c in enumerate(keep)]
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *named).mapInArrow(
        run, "size long, data binary, rest binary, sample array<binary>")
    name, path = f"suffix_blocks_{uuid.uuid4().hex}", scratch_path(spark, "suffix-blocks")
    rows.withColumn("block", F.monotonically_increasing_id()).write.option("path", path).bucketBy(buckets, "block").saveAsTable(name)
    keep_until_released(spark, path)
    blocks = spark.table(name)
    spark.sql(f"drop table {name}")  # only the name: the files stay, and the plan that reads them
    return blocks, buckets


def _with_answers(blocks: DataFrame, buckets: int, *answers: DataFrame) -> DataFrame:
    """Each block's columns and then the answers to it, in one list a kind; only answers are shuffled."""
    own_columns = blocks.columns
    for k, found in enumerate(answers):
        own = found.repartition(buckets, "block").groupBy("block").agg(F.collect_list(F.struct("rng", "data")).alias(f"answers{k}"))
        blocks = blocks.join(own.hint("shuffle_hash"), "block", "left")
    return blocks.select(*own_columns, *[f"answers{k}" for k in range(len(answers))])


def splitters(blocks: DataFrame, count: int, ranges: int) -> list[bytes]:
    """Strings that cut suffixes into about ``ranges`` equal ranges, from the samples that all blocks carry.

    Whole strings are sorted by Spark, so a first part that very many suffixes share is cut too; each task tells the first of
    every so many, and only those, about one a range, come to the driver.
    """
    step = max(1, count * SAMPLE // ranges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, n = None, 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if n == step:
                    yield _batch([(first, n)], ["text", "n"], [pa.binary(), pa.int64()])
                    n = 0
                first, n = (first, n + 1) if n else (text, 1)
        if n:
            yield _batch([(first, n)], ["text", "n"], [pa.binary(), pa.int64()])

    texts = blocks.select(F.explode("sample").alias("text"))
    parts = -(-count * SAMPLE // SORTED)
    ordered = texts.repartitionByRange(max(1, parts), "text").sortWithinPartitions("text")
    cuts: list[bytes] = []
    since = 0
    for row in sorted(ordered.mapInArrow(run, "text binary, n long").collect()):
        if since >= step and cuts[-1:] != [bytes(row["text"])]:
            cuts.append(bytes(row["text"]))
            since = 0
        since += row["n"]
    return cuts


def range_of(data: np.ndarray, at: np.ndarray, cuts: np.ndarray, length: int) -> np.ndarray:
    """How many of ``cuts`` (ascending strings of ``length`` bytes) each string at ``at`` reaches.

    The first eight bytes tell it for nearly all; where they are a cut's too, all bytes are compared.
    """
    width = min(8, length)
    heads = prefixes(np.frombuffer(cuts.tobytes(), np.uint8), np.arange(len(cuts)) * length, width)
    own = prefixes(data, at, width)
    to, most = np.searchsorted(heads, own, "left"), np.searchsorted(heads, own, "right")
    tied = np.flatnonzero(to < most)
    windows = np.lib.stride_tricks.sliding_window_view(data, length) if len(tied) else None
    for first in range(0, len(tied), CHUNK):
        some = tied[first:first + CHUNK]
        to[some] = np.searchsorted(cuts, windows[at[some]].view(f"S{length}").ravel(), "right")
    return to


def repeated_spans(docs: DataFrame, length: int = 50, block_bytes: int = BLOCK, range_bytes: int = RANGE,
                   keep: tuple[str, ...] = ("doc_id",), characters: bool = False) -> DataFrame:
    """For every row of ``docs``: its columns ``keep``, ``n_bytes``, removed ``spans`` (start, stop in bytes), ``kept``.

    Null and empty texts, and those shorter than ``length`` bytes, keep all they have. Rows with the same id never remove
    from one another, so repeated rows stay as they are; a row without an id comes after all others and removes from none.
    An empty table gives an empty result; other columns are not read. Ids must be integers, or cast to them. With ``characters`` a code point only part of which
    should go stays whole, so that what is kept (binary) is UTF-8. Equal stretches are told by 88 bits of hash, all other
    windows by their bytes.
    """
    blocks, buckets = packed_blocks(docs, keep, block_bytes, length)
    count, total = blocks.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    cores = 2 * docs.sparkSession.sparkContext.defaultParallelism
    ranges = max(1, -(-total // range_bytes), min(cores, -(-total * 4 // range_bytes)))
    groups = max(1, -(-total // (2 * range_bytes)), min(cores, -(-total * 4 // range_bytes)))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield from _together((r, block, d) for r, d in Block(data, length).sent(groups))

    entries = blocks.select("block", "data").mapInArrow(send, "rng int, block long, data binary")
    first = _by_range(entries, groups, answered, "stretch-answers")
    cuts = np.array(splitters(blocks, count, ranges), f"S{length}")

    def dealt(block: Block, open_: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Windows of the stretches ``open_`` and their documents' ids by the range of their strings; ranges without any don't come."""
        at, ids = block.windows(open_), np.repeat(block.owner[open_], block.count[open_])
        to = range_of(block.data, at, cuts, length)
        order = np.argsort(to, kind="stable")
        for r, a, b in equal_parts(to[order]):
            yield r, at[order[a:b]], ids[order[a:b]]

    def found(number: int, data: bytes, answers: list[dict] | None) -> Iterator[tuple[int, int, bytes]]:
        """A block's rows: what of it goes as a whole, and runs of the suffixes to be looked at."""
        block = Block(data, length)
        held, open_ = block.told([(a["rng"], a["data"]) for a in answers or ()], groups)
        if len(held):
            starts = block.start[held].astype(np.int64)
            yield -1 - number % ranges, number, pack(*joined(starts, starts + block.count[held] + length - 1))
        for r, at, ids in dealt(block, open_):
            yield r, number, front_coded(block.data, at, ids, length)

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                yield from _together(found(*row))

    runs = _with_answers(blocks.select("block", "data"), buckets, first).mapInArrow(suffixes, "rng int, block long, data binary")
    second = _by_range(runs, ranges, lambda entries: repeats(entries, length), "suffix-answers")

    def removed(data: np.ndarray, answers: list[dict] | None) -> np.ndarray:
        """Whether each byte of a block goes."""
        n = len(data)
        starts, stops = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for row in answers or ():
            a, *b = unpack(row["data"])
            starts.append(a.astype(np.int64))
            stops.append(b[0].astype(np.int64) if row["rng"] < 0 else starts[-1] + length)
        first, last = joined(np.concatenate(starts), np.concatenate(stops))
        change = np.zeros(n + 1, np.int8)
        change[first], change[last] = 1, -1
        gone = np.cumsum(change[:n], dtype=np.int8) > 0
        if characters and n:
            points = np.flatnonzero(data & 0xC0 != 0x80)  # where a code point begins
            gone = np.repeat(np.logical_and.reduceat(gone, points), np.diff(np.append(points, n)))
        return gone

    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    out = StructType([docs.schema[c] for c in keep] + StructType.fromDDL("n_bytes long, spans array<struct<start long, stop long>>, kept binary").fields)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, rest, answers in zip(*[batch.column(i).to_pylist() for i in range(1, 4)], strict=True):
                _, sizes, text = unpack(data)
                gone = removed(text, answers)
                rows, a = [], 0
                for b in np.cumsum(sizes).tolist():
                    own = gone[a:b]
                    edges = np.flatnonzero(np.diff(np.concatenate(([False], own, [False])).astype(np.int8))).reshape(-1, 2)
                    kept = text[a:b] if not len(edges) else text[a:b][~own]
                    rows.append((b - a, [{"start": x, "stop": y} for x, y in edges.tolist()], kept.tobytes()))
                    a = b
                made = _batch(rows, ["n_bytes", "spans", "kept"], [pa.int64(), span, pa.binary()])
                at = 0
                with pa.ipc.open_stream(rest) as stream:
                    for part in stream:
                        own = made.slice(at, part.num_rows)
                        at += part.num_rows
                        yield pa.RecordBatch.from_arrays([*part.columns, *own.columns], names=[*keep, "n_bytes", "spans", "kept"])

    whole = blocks.select("block", "data", "rest")
    return _with_answers(whole, buckets, second).mapInArrow(settle, out)


def without_repeats(docs: DataFrame, length: int = 50) -> DataFrame:
    """``docs`` with repeated passages taken out of ``text`` and ``n_chars`` counted anew, all other columns as they were.

    Rows of which nothing is left go. Null and empty texts stay as they are.
    """
    others = tuple(c for c in docs.columns if c not in ("text", "n_chars"))
    blank = unused("blank", [*docs.columns, "n_bytes", "spans", "kept"])
    names = {c: f"c{k}" for k, c in enumerate(others)}
    marked = docs.select("doc_id", "text", *[F.col(quoted(c)).alias(n) for c, n in names.items()], F.col("text").isNull().alias(blank))
    found = repeated_spans(marked, length, keep=(*names.values(), blank), characters=True)
    left = found.filter((F.col("n_bytes") == 0) | (F.octet_length("kept") > 0)).withColumn(
        "text", F.when(~F.col(blank), F.col("kept").cast("string")))
    made = {"text": F.col("text"), "n_chars": F.coalesce(F.length("text"), F.lit(0)).cast("long")}
    return left.select(*[made[c].alias(c) if c in made else F.col(names[c]).alias(c) for c in docs.columns])
