"""Repeated substrings by a distributed difference-cover suffix order.

A byte is removed if some string of `length` bytes that covers it also starts anywhere else. To see that, the suffixes of the texts are
put into order by their first `length` bytes:

* suffixes are sampled by a difference cover: of every `period` neighbouring ones a few, so that of any two suffixes some pair of
  sampled ones lies equally far behind (less than a period). The sampled ones are sorted by a triple of eight-byte characters and
  named by their place in that order (of mixed characters, not of the alphabet: it makes equal triples neighbours all the same, and a
  beginning that many suffixes share is no hot key);
* recursion on the names: triples of names, sorted and named again, order the sampled suffixes by about three times as many bytes, until
  the names stand for nearly `length` bytes. A name that only one suffix has can be in no repeated string, so it is dropped;
* the remaining suffixes are merged through the sampled ones that follow within a period: equal strings meet in one run of equal
  sampled suffixes, where neighbours are compared by the bytes before and behind.

What cannot repeat is left out of the order beforehand, without loss: the smallest hash in every stretch of w strings of k bytes is the
same wherever a text repeats, so a string of `length` bytes with a smallest hash that occurs once is not repeated. The rest is
cut where the text itself says so (at chosen hashes), and equal pieces are one piece.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import forget, fresh, saved
from tallymark.llm.words import column_bytes, mix, slices

LENGTH = 200
#: Bytes of a text batch that are hashed at once, and of the pieces that share a block.
SLICE_BYTES, BLOCK_BYTES = 1 << 19, 1 << 16
#: One of so many smallest hashes is a place to cut at; a piece has at most LONGEST starts.
CUT, LONGEST = 8, 1 << 15
#: Zero bytes between the pieces of a block.
GAP = 1
#: Bits of a place in a block; a block has less than BLOCK_BYTES + LONGEST + length bytes.
PLACE = 17
#: Sampled suffixes that are equal up to the last bytes and are compared within one task, at most.
LONG_RUN = 1 << 14
BLOCKS = "block bigint, data binary, places array<int>, starts array<int>, numbers array<bigint>, begins array<int>"
LAST_ROWS = "k0 bigint, k1 bigint, k2 bigint, at bigint, edge binary, near int"
#: Texts and their ranges are joined by broadcast if at most so many ranges (16 bytes each) were counted.
BROADCAST_RANGES = 200_000

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_LETTERS = np.random.default_rng(13).integers(1, (1 << 64) - 1, 256, dtype=np.uint64, endpoint=True)
RANGES = "array<struct<start:bigint,stop:bigint>>"
_RANGES = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def width(length: int) -> int:
    """Bytes of the hashed strings and strings in a stretch: a power of two w with 3 w < length + 2."""
    if length < 8:
        raise ValueError("length must be at least 8")
    return 1 << (((length + 1) // 3).bit_length() - 1)


def _powers(base: int, n: int) -> np.ndarray:
    values = np.full(n, base, np.uint64)
    values[:1] = 1
    return np.multiply.accumulate(values)


def _smallest(data: np.ndarray, w: int) -> np.ndarray:
    """The smallest hash of the w strings of w bytes that begin at each place or up to w - 1 behind it."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_LETTERS[data] * _powers(_BASE, n), out=sums[1:])
    low = mix((sums[w:] - sums[:-w]) * _powers(_INVERSE, n - w + 1))
    step = 1
    while step < w:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    return low


def stretches(column: pa.Array, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, last, hash): runs of places of a text with one smallest hash, in order; places count from the text's begin."""
    data, bounds = column_bytes(column)
    rows, firsts, hashes, lo, reach = [], [], [], 0, 2 * w - 1
    ends = []
    while lo + reach <= len(data):
        hi = min(len(data), lo + SLICE_BYTES + reach - 1)
        low = _smallest(data[lo:hi], w)
        row = np.searchsorted(bounds, np.arange(lo, lo + len(low)), "right") - 1
        inside = np.arange(lo, lo + len(low)) + reach <= bounds[row + 1]
        at = np.flatnonzero(inside)
        if len(at):
            new = np.ones(len(at), bool)
            new[1:] = (np.diff(at) > 1) | (low[at[1:]] != low[at[:-1]]) | (row[at[1:]] != row[at[:-1]])
            start = np.flatnonzero(new)
            stop = np.append(start[1:], len(at)) - 1
            rows.append(row[at[start]])
            firsts.append(at[start] + lo)
            ends.append(at[stop] + lo)
            hashes.append(low[at[start]])
        lo += len(low)
    if not rows:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    row, first, last, found = (np.concatenate(x) for x in (rows, firsts, ends, hashes))
    # a run may go on in the next part
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (found[1:] != found[:-1]) | (first[1:] != last[:-1] + 1)
    start = np.flatnonzero(new)
    last = last[np.append(start[1:], len(row)) - 1]
    row, first, found = row[start], first[start], found[start]
    return row, first - bounds[row], last - bounds[row], found


def _stretch_rows(texts: DataFrame, w: int) -> DataFrame:
    """(hash, no, first, last, times) of all texts; a run longer than w holds its hash at least twice."""

    def batches(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in them:
            for piece in slices(batch, "text", SLICE_BYTES):
                row, first, last, found = stretches(piece.column("text"), w)
                no, copies = (np.asarray(piece.column(c)) for c in ("no", "copies"))
                times = np.minimum(copies[row], 2) * np.where(last - first >= w, 2, 1)
                for lo in range(0, len(row), 100_000):
                    s = slice(lo, lo + 100_000)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found[s].view(np.int64)), pa.array(no[row[s]]), pa.array(first[s].astype(np.int32)), pa.array(last[s].astype(np.int32)), pa.array(times[s].astype(np.int32))],
                        names=["hash", "no", "first", "last", "times"],
                    )

    return texts.select("no", "text", "copies").mapInArrow(batches, "hash bigint, no bigint, first int, last int, times int")


def _cut(first: np.ndarray, last: np.ndarray, found: np.ndarray, windows: int) -> Iterator[tuple[int, int]]:
    """(start, starts) of the pieces of one text: stretches of places whose strings may repeat, cut at chosen hashes.

    `windows` is the number of consecutive places that a string of `length` bytes spans.
    """
    order = np.argsort(first)
    first, last, found = first[order], last[order], found[order]
    new = np.flatnonzero(np.append(True, first[1:] != last[:-1] + 1))
    for lo, hi in zip(new.tolist(), [*new[1:].tolist(), len(first)]):
        begin, end = int(first[lo]), int(last[hi - 1]) - windows + 2
        if end <= begin:
            continue
        cuts = first[lo + 1 : hi][(found[lo + 1 : hi] >> np.uint64(5)) % np.uint64(CUT) == 0]
        edges = [begin, *cuts[cuts < end].tolist(), end]
        for a, b in zip(edges, edges[1:]):
            for at in range(a, b, LONGEST):
                yield at, min(LONGEST, b - at)


def _pieces(texts: DataFrame, repeated: DataFrame, length: int, ranges: int) -> DataFrame:
    """(no, start, starts, copies, digest, data) of all pieces: `starts` strings begin in a piece, its data hold them whole."""
    windows = length - 2 * width(length) + 2
    found = repeated.groupBy("no").agg(F.collect_list(F.struct("first", "last", "hash")).alias("runs"))
    # a text too short for a whole string of repeated runs has no piece
    found = found.filter(F.aggregate("runs", F.lit(0), lambda s, r: s + r["last"] - r["first"] + 1) >= windows)
    both = texts.select("no", "text", "copies").join(F.broadcast(found) if ranges <= BROADCAST_RANGES else found, "no")

    def batches(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in them:
            out: list[list] = [[], [], [], [], []]
            held = 0
            runs = batch.column("runs")
            parts = [np.asarray(runs.values.field(c)) for c in ("first", "last", "hash")]
            offsets = np.asarray(runs.offsets)
            for r in range(batch.num_rows):
                a, b = int(offsets[r]), int(offsets[r + 1])
                first, last, found = (p[a:b] for p in parts)
                data = None
                for start, starts in _cut(first, last, found.view(np.uint64), windows):
                    if data is None:
                        data = memoryview(batch.column("text")[r].as_buffer())
                        no, copies = batch.column("no")[r].as_py(), batch.column("copies")[r].as_py()
                    piece = bytes(data[start : start + starts + length - 1])
                    held += len(piece)
                    for column, value in zip(out, (no, start, starts, copies, piece)):
                        column.append(value)
                    if held > SLICE_BYTES:
                        yield _piece_batch(out)
                        out, held = [[], [], [], [], []], 0
            if out[0]:
                yield _piece_batch(out)

    rows = both.mapInArrow(batches, "no bigint, start int, starts int, copies bigint, data binary")
    return rows.withColumn("digest", F.unhex(F.substring(F.sha2("data", 256), 1, 32)))


def _piece_batch(out: list[list]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["no", "start", "starts", "copies", "data"])


def _joined(single: DataFrame) -> DataFrame:
    """(no, start, starts, data): pieces that occur once, those that follow each other in a text as one (of at most LONGEST starts)."""
    grouped = single.groupBy("no").agg(F.collect_list(F.struct("start", "starts", "data")).alias("parts"))

    def batches(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in them:
            for no, parts in zip(batch.column("no").to_pylist(), batch.column("parts")):
                start, starts = (np.asarray(parts.values.field(c)) for c in ("start", "starts"))
                out: list[list] = [[], [], []]
                for i in np.argsort(start).tolist():
                    data = parts.values.field("data")[i].as_py()
                    if out[0] and out[0][-1] + out[1][-1] == start[i] and out[1][-1] + starts[i] <= LONGEST:
                        out[2][-1][out[1][-1] :] = data
                        out[1][-1] += int(starts[i])
                    else:
                        for column, value in zip(out, (int(start[i]), int(starts[i]), bytearray(data))):
                            column.append(value)
                columns = [pa.array([no] * len(out[0]), pa.int64()), pa.array(out[0], pa.int32()), pa.array(out[1], pa.int32()), pa.array(map(bytes, out[2]), pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["no", "start", "starts", "data"])

    return grouped.mapInArrow(batches, "no bigint, start int, starts int, data binary")


def _blocks(pieces: DataFrame) -> DataFrame:
    """(block, data, places, starts, numbers, begins): pieces (no, start, starts, data), GAP zero bytes behind each.

    Pieces without a number (`no` null) occur several times, so their strings are known to repeat; their blocks have odd numbers.
    """

    def batches(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId() << 20, 0
        held: dict[bool, list] = {False: [0, [], [], [], [], []], True: [0, [], [], [], [], []]}

        def block(known: bool) -> pa.RecordBatch:
            nonlocal number
            _, data, *lists = held[known]
            held[known] = [0, [], [], [], [], []]
            number += 1
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int32())
            columns = [pa.array([task + 2 * number + known], pa.int64()), pa.array([b"".join(data)], pa.binary()), *(pa.array([x], pa.list_(k)) for x, k in zip(lists, kinds))]
            return pa.RecordBatch.from_arrays(columns, names=["block", "data", "places", "starts", "numbers", "begins"])

        for batch in them:
            for piece, n, no, start in zip(batch.column("data"), *(batch.column(c).to_pylist() for c in ("starts", "no", "start"))):
                mine = held[no is None]
                for column, value in zip(mine[1:], (piece.as_py() + bytes(GAP), mine[0], n, -1 if no is None else no, start or 0)):
                    column.append(value)
                mine[0] += len(mine[1][-1])
                if mine[0] >= BLOCK_BYTES:
                    yield block(no is None)
        for known in (False, True):
            if held[known][0]:
                yield block(known)

    return pieces.select("data", "starts", "no", "start").mapInArrow(batches, BLOCKS)


#: Columns of the rows that are sorted: a triple, and where its suffix begins (block and place in it).
ROWS = "k0 bigint, k1 bigint, k2 bigint, at bigint"
KEYS = ["k0", "k1", "k2"]


@dataclass(frozen=True)
class Cover:
    """A difference cover, and the bytes that the names of each level stand for."""

    length: int
    period: int
    sampled: tuple[int, ...]
    first: int
    #: distances of the second and third name of a triple, by level
    steps: tuple[tuple[int, int], ...]
    #: bytes that the last names stand for
    last: int

    @classmethod
    def of(cls, length: int) -> Cover:
        # any two places below the period differ by the same amount as some two sampled ones
        period, sampled = next((p, s) for p, s in ((21, (0, 1, 4, 14, 16)), (7, (0, 1, 3)), (3, (0, 1))) if length >= 3 * p - 1)
        cover = first = min(24, max(period, (length - period + 1) // 3))
        steps = []
        while two := min(2 * (cover // period), (length - period + 1 - cover) // period) * period:
            steps.append((min(cover // period * period, two), two))
            cover += two
        return cls(length, period, sampled, first, tuple(steps), cover)


def _places(block: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    for number, data, places, starts in zip(*(block.column(c) for c in ("block", "data", "places", "starts"))):
        yield number.as_py(), np.frombuffer(data.as_buffer(), np.uint8), np.asarray(places.values), np.asarray(starts.values)


def _first_rows(blocks: DataFrame, cover: Cover) -> DataFrame:
    """The first triples: eight-byte characters of the sampled suffixes of each piece."""

    def batches(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in them:
            for block, data, places, starts in _places(batch):
                ends = np.append(places[1:], len(data)) - GAP
                position = np.arange(len(data))
                piece = np.searchsorted(places, position, "right") - 1
                chosen = np.isin(position % cover.period, cover.sampled) & (position + cover.first <= ends[piece])
                pos = np.flatnonzero(chosen)
                padded = np.concatenate([data, np.zeros(24, np.uint8)])
                keys = []
                for k in range(0, 24, 8):
                    key = np.zeros(len(pos), np.uint64)
                    for b in range(k, k + 8):
                        key <<= np.uint64(8)
                        if b < cover.first:
                            key |= padded[pos + b]
                    keys.append(key.view(np.int64))
                yield pa.RecordBatch.from_arrays([*map(pa.array, _mixed(keys)), pa.array(block << PLACE | pos)], names=[*KEYS, "at"])

    return blocks.select("block", "data", "places", "starts").mapInArrow(batches, ROWS)


def _mixed(keys: list[np.ndarray]) -> list[np.ndarray]:
    """The triples with a first number that depends on all three (one to one), so that sorting seldom needs the others."""
    a, b, c = (k.view(np.uint64) for k in keys)
    return [mix(a ^ mix(b ^ mix(c + np.uint64(_BASE)))).view(np.int64), keys[1], keys[2]]


def _sorted(rows: DataFrame) -> DataFrame:
    """Triples in order, equal ones in one task; of those first the ones whose strings are not known to repeat."""
    return rows.repartition(*KEYS).sortWithinPartitions(*KEYS, F.shiftright("at", PLACE).bitwiseAND(F.lit(1)))


def _known(at: np.ndarray) -> np.ndarray:
    """Whether the places lie in pieces that occur several times."""
    return (at >> PLACE) & 1 == 1


def _new_runs(batch: pa.RecordBatch, last: tuple | None) -> np.ndarray:
    """Whether each row's triple differs from the one before; `last` is the triple before the batch."""
    new = np.zeros(batch.num_rows, bool)
    for c, before in zip(KEYS, last or (None,) * 3):
        k = np.asarray(batch.column(c))
        new[1:] |= k[1:] != k[:-1]
        new[0] |= before is None or k[0] != before
    return new


def _last(batch: pa.RecordBatch) -> tuple:
    return tuple(batch.column(c)[-1].as_py() for c in KEYS)


def _named(rows: DataFrame) -> DataFrame:
    """(at, name) of the rows whose triple occurs at least twice, once in a piece that occurs once; a name is the triple's place in order.

    Equal triples are in one task, one behind the other. A task holds one batch and one row whose run may go on.
    """

    def batches(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 40
        last, number, held, wanted = None, 0, None, False
        for batch in them:
            if not batch.num_rows:
                continue
            new = _new_runs(batch, last)
            steps, at = np.cumsum(new), np.asarray(batch.column("at"))
            # a row is not alone if it or the next one goes on with a run; the first row of a run tells whether it is wanted
            keep = ~new
            keep[:-1] |= ~new[1:]
            several = bool(keep[-1])
            each = np.append(wanted, ~_known(at[new]))
            keep &= each[steps]
            runs = number + steps
            last, wanted = _last(batch), bool(each[-1])
            if held is not None and not new[0] and each[0]:
                at, runs, keep = np.append(held, at), np.append(number, runs), np.append(True, keep)
            held, number = None if several else int(at[-1]), int(runs[-1])
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(at[keep]), pa.array(runs[keep] + task)], names=["at", "name"])

    return _sorted(rows).mapInArrow(batches, "at bigint, name bigint")


def _named_blocks(named: DataFrame, blocks: DataFrame) -> DataFrame:
    """Blocks with their named places (32-bit numbers) and names (64-bit numbers); a block's names meet in one task."""

    def whole(names: pa.Table, block: pa.Table) -> pa.Table:
        block = block.select(["block", "data", "places", "starts"])
        found = [[], []]
        if names.num_rows and block.num_rows:
            pos = np.asarray(names.column("at")) & (1 << PLACE) - 1
            found = [[pos.astype(np.int32).tobytes()], [np.asarray(names.column("name")).tobytes()]]
        block = block.slice(0, len(found[0]))
        return block.append_column("named", pa.array(found[0], pa.binary())).append_column("names", pa.array(found[1], pa.binary()))

    left = named.withColumn("block", F.shiftright("at", PLACE)).groupBy("block")
    right = blocks.select("block", "data", "places", "starts").groupBy("block")
    return left.cogroup(right).applyInArrow(whole, "block bigint, data binary, places array<int>, starts array<int>, named binary, names binary")


def _next_rows(named: DataFrame, one: int, two: int) -> DataFrame:
    """Triples of the names at a place and `one` and `two` bytes behind it."""

    def batches(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in them:
            for i, block in enumerate(batch.column("block").to_pylist()):
                pos, keys = _triples(batch, i, one, two)
                yield pa.RecordBatch.from_arrays([*map(pa.array, keys), pa.array(block << PLACE | pos)], names=[*KEYS, "at"])

    return named.select("block", "named", "names").mapInArrow(batches, ROWS)


def _triples(batch: pa.RecordBatch, i: int, one: int, two: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The named places of block `i` whose followers are named too, and the (mixed) triples of names."""
    pos = np.frombuffer(batch.column("named")[i].as_buffer(), np.int32).astype(np.int64)
    names = np.full(int(pos.max()) + two + 1, -1, np.int64)
    names[pos] = np.frombuffer(batch.column("names")[i].as_buffer(), np.int64)
    pos = np.sort(pos[(names[pos + one] >= 0) & (names[pos + two] >= 0)])
    return pos, _mixed([names[pos], names[pos + one], names[pos + two]])


def _last_rows(blocks: DataFrame, cover: Cover) -> DataFrame:
    """The last triples, with the bytes before and behind what they stand for, and the distances at which strings begin before them.

    `blocks` has the names of the last level but one.
    """
    before, behind = cover.period - 1, cover.length - cover.last

    def batches(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in them:
            for i, (block, data, places, starts) in enumerate(_places(batch)):
                pos, keys = _triples(batch, i, *cover.steps[-1])
                piece = np.searchsorted(places, pos, "right") - 1
                far = pos - places[piece]
                lo, hi = np.maximum(0, far - starts[piece] + 1), np.minimum(before, far)
                some = lo <= hi
                pos, lo, hi = pos[some], lo[some], hi[some]
                padded = np.concatenate([np.zeros(before, np.uint8), data, np.zeros(cover.length, np.uint8)])
                around = np.append(np.arange(before), before + cover.last + np.arange(behind))
                edges = padded[pos[:, None] + around[None, :]]
                for a in range(0, len(pos), 10_000):
                    s = slice(a, a + 10_000)
                    lists = pa.FixedSizeBinaryArray.from_buffers(pa.binary(before + behind), len(pos[s]), [None, pa.py_buffer(np.ascontiguousarray(edges[s]))])
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(k[some][s]) for k in keys), pa.array(block << PLACE | pos[s]), lists.cast(pa.binary()), pa.array((lo[s] << 8 | hi[s]).astype(np.int32))],
                        names=[*KEYS, "at", "edge", "near"],
                    )

    return blocks.mapInArrow(batches, LAST_ROWS)


def _codes(batch: pa.RecordBatch, cover: Cover) -> tuple[np.ndarray, np.ndarray]:
    """For each row and distance below the period: the hash of the string that begins so far before, and whether a string does."""
    before, behind = cover.period - 1, cover.length - cover.last
    raw = batch.column("edge").cast(pa.large_binary())
    edges = _LETTERS[np.frombuffer(raw.buffers()[2], np.uint8)[raw.offset * (before + behind) :][: len(raw) * (before + behind)].reshape(len(raw), before + behind)]
    powers = _powers(_BASE, before + behind + 1)[1:]
    zero = np.zeros((len(raw), 1), np.uint64)
    left = np.concatenate([zero, np.cumsum(edges[:, :before][:, ::-1] * powers[:before], axis=1, dtype=np.uint64)], axis=1)
    right = np.concatenate([zero, np.cumsum(edges[:, before:] * powers[before:], axis=1, dtype=np.uint64)], axis=1)
    distance = np.arange(before + 1)
    code = left + right[:, behind - distance]
    for c in KEYS:
        code = mix(code + np.asarray(batch.column(c)).view(np.uint64)[:, None] + distance.astype(np.uint64))
    near = np.asarray(batch.column("near"))[:, None]
    return code, (distance >= near >> 8) & (distance <= near & 255)


def _bits(at: np.ndarray, distance: np.ndarray) -> pa.RecordBatch:
    """(at, bits): the distances of each place as bits."""
    places, row = np.unique(at, return_inverse=True)
    bits = np.zeros(len(places), np.int64)
    np.bitwise_or.at(bits, row, np.int64(1) << distance)
    return pa.RecordBatch.from_arrays([pa.array(places), pa.array(bits.astype(np.int32))], names=["at", "bits"])


def _equal_neighbours(rows: DataFrame, cover: Cover) -> DataFrame:
    """(at, bits): the distances before each sampled suffix of single pieces at which a string begins that another string equals.

    Equal strings have sampled suffixes equally far behind their begin that are neighbours in the order; they are compared by hashes
    of 64 bits of the bytes around. Of a run that goes on in the next batch one string of each kind is held, so runs of more than
    LONG_RUN are not compared here (_equal_in_long_runs).
    """

    def batches(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for batch in them:
            if not batch.num_rows:
                continue
            new = _new_runs(batch, last)
            last = _last(batch)
            codes, valid = _codes(batch, cover)
            row, distance = np.nonzero(valid)
            code, at = codes[row, distance], np.asarray(batch.column("at"))[row]
            told, open_run = np.zeros(len(code), bool), row >= np.flatnonzero(np.append(True, new[1:]))[-1]
            if held is not None and not new[0]:
                whole = np.full(len(held[0]), not new.any())
                code, at, distance, told, open_run = (np.concatenate(p) for p in zip(held, (code, at, distance, told, open_run)))
                open_run[: len(whole)] = whole
            order = np.lexsort((~told, code))
            code, at, distance, told, open_run = (x[order] for x in (code, at, distance, told, open_run))
            first = np.append(True, code[1:] != code[:-1])[: len(code)]
            again = ~first
            again[:-1] |= ~first[1:]
            # one that was shown before is held for the equal ones that may follow
            show = again & ~told & ~_known(at)
            if show.any():
                yield _bits(at[show], distance[show])
            stay = first & open_run
            held = [code[stay], at[stay], distance[stay], (again | told)[stay], open_run[stay]]

    return _sorted(rows).mapInArrow(batches, "at bigint, bits int")


def _equal_in_long_runs(rows: DataFrame, cover: Cover) -> DataFrame:
    """The same for runs of any length: strings are counted by their hashes, each a row."""

    def batches(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in them:
            codes, valid = _codes(batch, cover)
            row, distance = np.nonzero(valid)
            columns = [codes[row, distance].view(np.int64), np.asarray(batch.column("at"))[row], (1 << distance).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["code", "at", "bits"])

    each = rows.mapInArrow(batches, "code bigint, at bigint, bits int")
    often = each.groupBy("code").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("code")
    unsure = each.filter(F.shiftright("at", PLACE).bitwiseAND(F.lit(1)) == 0)
    return unsure.join(often, "code", "left_semi").groupBy("at").agg(F.bit_or("bits").alias("bits"))


def _repeats(blocks: DataFrame, cover: Cover) -> DataFrame:
    """(at, bits) of the strings in `blocks` that occur at another place of them too; see _equal_neighbours."""
    now = blocks
    for level in range(len(cover.steps)):
        rows = _first_rows(blocks, cover) if level == 0 else _next_rows(now, *cover.steps[level - 1])
        names = saved(_named(rows), "names")
        before, now = now, saved(_named_blocks(names, blocks), "named")
        forget(names, *([before] if level else []))
    rows = saved(_last_rows(now, cover), "triples")
    forget(now)
    long = saved(rows.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > LONG_RUN).select(*KEYS), "long")
    if long.isEmpty():
        out = saved(_equal_neighbours(rows, cover), "repeats")
    else:
        short = _equal_neighbours(rows.join(long, KEYS, "left_anti"), cover)
        out = saved(short.unionAll(_equal_in_long_runs(rows.join(long, KEYS, "left_semi"), cover)), "repeats")
    forget(rows, long)
    return out


def merged(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges in order, those that overlap or touch as one."""
    order = np.argsort(starts, kind="stable")
    starts, stops = starts[order], np.maximum.accumulate(stops[order])
    new = np.append(True, starts[1:] > stops[:-1])
    return starts[new], stops[np.append(np.flatnonzero(new)[1:], len(starts)) - 1]


def _piece_ranges(repeats: DataFrame, blocks: DataFrame) -> DataFrame:
    """(no, start, stop): ranges of a text's places at which repeated strings of single pieces begin."""

    def ranges(found: pa.Table, block: pa.Table) -> pa.Table:
        no, a, b = (np.zeros(0, np.int64),) * 3
        if found.num_rows and block.num_rows:
            place, bits = np.asarray(found.column("at")) & (1 << PLACE) - 1, np.asarray(found.column("bits"))
            begin = np.unique(np.concatenate([place[(bits >> d) & 1 == 1] - d for d in range(32)]))
            places, numbers, begins = (np.asarray(block.column(c)[0].values) for c in ("places", "numbers", "begins"))
            # the gap behind each piece parts the ranges of different pieces
            a, b = merged(begin, begin + 1)
            piece = np.searchsorted(places, a, "right") - 1
            away = begins[piece].astype(np.int64) - places[piece]
            no, a, b = numbers[piece], a + away, b + away
        return pa.table([pa.array(no), pa.array(a), pa.array(b)], names=["no", "start", "stop"])

    right = blocks.select("block", "places", "numbers", "begins").groupBy("block")
    return repeats.withColumn("block", F.shiftright("at", PLACE)).groupBy("block").cogroup(right).applyInArrow(ranges, "no bigint, start bigint, stop bigint")


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def repeated_spans(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """(digest, spans) of the distinct texts of `docs` that hold repeated strings: the byte ranges they cover, merged, in order.

    The digest is the SHA-256 of the text. Texts that occur several times repeat all of their strings. Null texts and texts under
    `length` bytes have no strings.
    """
    column = F.col(f"`{text}`").cast("string")
    texts = docs.select(column.alias("text")).filter(F.octet_length("text") >= length).groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    texts = saved(texts.select(F.monotonically_increasing_id().alias("no"), "text", "copies", digest_of(F.col("text")).alias("digest")), "texts")
    runs = saved(_stretch_rows(texts, width(length)), "stretches")
    several = runs.groupBy("hash").agg(F.sum("times").alias("times")).filter("times > 1").select("hash")
    repeated = saved(runs.join(several, "hash", "left_semi").select("no", "first", "last", "hash"), "repeated")
    forget(runs)
    pieces = saved(_pieces(texts, repeated, length, repeated.count()), "pieces")
    named = saved(texts.select("no", "digest"), "numbers")
    forget(texts, repeated)
    first = [F.first(c).alias(c) for c in ("starts", "no", "start")]
    distinct = saved(pieces.groupBy("data", "digest").agg(F.sum("copies").alias("copies"), *first), "distinct")
    places = saved(pieces.select("no", "start", "starts", "digest"), "places")
    forget(pieces)
    # of a piece that occurs several times all strings repeat
    several = distinct.filter("copies > 1").withColumn("no", F.lit(None).cast("bigint"))
    columns = ["no", "start", "starts", "data"]
    blocks = saved(_blocks(_joined(distinct.filter("copies = 1")).select(*columns).unionAll(several.select(*columns))), "blocks")
    known = saved(places.join(distinct.filter("copies > 1").select("digest"), "digest", "left_semi"), "known")
    forget(distinct, places)
    repeats = _repeats(blocks, Cover.of(length))
    found = saved(_piece_ranges(repeats, blocks), "found")
    forget(repeats, blocks)
    whole = known.select("no", F.col("start").cast("bigint").alias("start"), (F.col("start") + F.col("starts")).cast("bigint").alias("stop"))
    each = found.unionAll(whole).select("no", F.struct("start", (F.col("stop") + (length - 1)).alias("stop")).alias("r"))
    spans = each.groupBy("no").agg(F.collect_list("r").alias("spans"))

    def batches(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in them:
            out = []
            for row in batch.column("spans"):
                a, b = merged(*(np.asarray(row.values.field(c)) for c in ("start", "stop")))
                out.append([{"start": x, "stop": y} for x, y in zip(a.tolist(), b.tolist())])
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(out, _RANGES)], names=["digest", "spans"])

    out = saved(spans.join(named, "no").select("digest", "spans").mapInArrow(batches, f"digest binary, spans {RANGES}"), "spans")
    forget(named, known, found)
    return out


def without_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, spans: str = "spans", kept: str = "kept") -> DataFrame:
    """`docs` with the removed byte ranges of each text (merged, in order) and the bytes that are kept (binary, for a cut may part a character).

    Every byte that a string of `length` bytes covers which also starts anywhere else, in the same text too, is removed; all occurrences
    go. Null texts count as empty; empty and short texts stay whole. Rows that repeat a text lose all of it if it has `length` bytes.
    Columns of `docs` named like the results are replaced. An empty table gives an empty one.
    """
    base = docs.drop(*[c for c in docs.columns if c.lower() in (spans.lower(), kept.lower()) and c != text])
    found = repeated_spans(base, text, length)
    digest, body = fresh("digest", [*base.columns, spans, kept]), fresh("body", [*base.columns, spans, kept])
    total = found.agg(F.sum(F.size("spans"))).first()[0] or 0
    side = found.withColumnsRenamed({"digest": digest, "spans": spans})
    bytes_of = F.coalesce(F.col(f"`{text}`").cast("string").cast("binary"), F.lit(b""))
    marked = base.withColumn(digest, digest_of(F.col(f"`{text}`").cast("string")))
    both = marked.join(F.broadcast(side) if total <= BROADCAST_RANGES else side, digest, "left").drop(digest)
    both = both.withColumn(spans, F.coalesce(spans, F.array().cast(RANGES))).withColumn(body, bytes_of)
    return both.withColumn(kept, _kept(F.col(body), F.col(spans))).drop(body)


def _kept(body: Column, spans: Column) -> Column:
    """The bytes outside the spans, by slices between one span's end and the next one's begin."""
    edges = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.octet_length(body).cast("bigint")))
    begins = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(spans, lambda s: s["stop"]))
    parts = F.zip_with(begins, edges, lambda a, b: F.substring(body, (a + 1).cast("int"), (b - a).cast("int")))
    return F.aggregate(parts, F.lit(b""), lambda out, part: F.concat(out, part))


def documents_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document."""
    cut = without_repeats(docs.select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda s, r: s + r["stop"] - r["start"])
    return cut.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"), removed.alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
