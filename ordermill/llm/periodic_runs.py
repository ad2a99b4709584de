"""Periodic runs of words, by block convolution at dyadic scales.

A run is a stretch of words with smallest period q, at least ``max(6, 4 q)`` long, that
neither neighbour extends. For periods from B up to 2 B (B = 1, 2, 4, ...) the words
are cut into blocks of B. A run of such a period holds at least two whole blocks in a row that occur
again at the distance of the period, in the 2 B words that follow. Words have random codes
modulo a prime; the sum of squared code differences of a block and of each place in its
window is a convolution, computed exactly by number-theoretic transforms. A sum
of zero is a seed: compared word by word, joined with its neighbours of equal distance and
extended to a run. The sum of equal words is always zero, so no occurrence is missed,
and what is zero by chance falls to the comparison.

Only blocks that can be in a run are transformed: each word of a run but for its last period
occurs again within 2 B. Seeds inside a run already found whose period divides their
distance belong to that run. Texts are searched many at a time, with a word of its own after each.
"""

from __future__ import annotations

import functools
import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A run is at least so many periods and so many words long.
PERIODS, WORDS = 4, 6
# The prime is 7 * 2^20 + 1, and 3 generates its group: transforms of up to 2^20 numbers. Sums of 64 products are
# under 2^53, so products of matrices of doubles are exact.
PRIME, GENERATOR, RADIX, MOST_SIZE = 7340033, 3, 64, 1 << 20
# Numbers transformed at once, and bytes of text searched together.
BATCH_NUMBERS, GROUP_BYTES = 1 << 18, 1 << 20


def _mod(x: np.ndarray) -> np.ndarray:
    """Whole numbers under 2^53 in size, modulo the prime."""
    x = x - np.floor(x * (1.0 / PRIME)) * PRIME
    x += PRIME * (x < 0)
    x -= PRIME * (x >= PRIME)
    return x


def _powers(root: int, exponents: np.ndarray) -> np.ndarray:
    table, value = [], 1
    for _ in range(int(exponents.max()) + 1):
        table.append(value)
        value = value * root % PRIME
    return np.array(table, np.float64)[exponents]


@functools.cache
def _matrix(size: int, root: int) -> np.ndarray:
    at = np.arange(size)
    return _powers(root, at[:, None] * at[None, :] % size)


@functools.cache
def _twiddles(rows: int, columns: int, root: int) -> np.ndarray:
    return _powers(root, np.arange(rows)[:, None] * np.arange(columns)[None, :])


def transform(x: np.ndarray, root: int) -> np.ndarray:
    """The number-theoretic transform of each row, ``root`` being of the row length's order."""
    size = x.shape[-1]
    if size <= RADIX:
        return _mod(x @ _matrix(size, root))
    columns = size // RADIX
    parts = x.reshape(-1, RADIX, columns)
    inner = pow(root, columns, PRIME)
    parts = _mod(np.matmul(_matrix(RADIX, inner), parts))
    parts = _mod(parts * _twiddles(RADIX, columns, root))
    parts = transform(parts.reshape(-1, columns), pow(root, RADIX, PRIME)).reshape(-1, RADIX, columns)
    return np.ascontiguousarray(parts.transpose(0, 2, 1)).reshape(-1, size)


def block_distances(codes: np.ndarray, starts: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of the block, distance) of every likely occurrence of the blocks that begin at ``starts``.

    Distances are from ``block`` up to twice that. A block too long for a transform is
    judged by its beginning, against its window in tiles.
    """
    width = min(block, MOST_SIZE // 2)
    size = 2 * width
    root = pow(GENERATOR, (PRIME - 1) // size, PRIME)
    back, scale = pow(root, -1, PRIME), pow(size, -1, PRIME)
    rows = max(1, BATCH_NUMBERS // size)
    numbers, distances = [], []
    for first in range(0, len(starts), rows):
        begin = starts[first : first + rows]
        own = np.zeros((len(begin), size))
        own[:, :width] = codes[begin[:, None] + np.arange(width)]
        own_squares = _mod(_mod(own[:, :width] ** 2).sum(axis=1))
        own = transform(own, back)
        for tile in range(0, block, width):
            window = codes[begin[:, None] + np.arange(block + tile, block + tile + size)]
            squares = np.cumsum(_mod(window**2), axis=1)
            squares = np.concatenate([np.zeros((len(begin), 1)), squares], axis=1)
            squares = squares[:, width : 2 * width] - squares[:, :width]
            products = transform(_mod(own * transform(window, root)), back)[:, :width]
            # (a - b)^2 summed; the inverse transform still lacks its factor.
            total = _mod(_mod(squares) + own_squares[:, None] + (PRIME - 2) * _mod(products * scale))
            row, shift = np.nonzero(total == 0)
            numbers.append(row + first)
            distances.append(shift + block + tile)
    return np.concatenate(numbers), np.concatenate(distances)


def _reach(ids: np.ndarray, at: int, distance: int, step: int) -> int:
    """How many words in a row from ``at`` on, forwards or backwards, equal the one ``distance`` later."""
    count, width = 0, 16
    while True:
        if step > 0:
            begin = at + count
            end = min(begin + width, len(ids) - distance)
            differ = np.flatnonzero(ids[begin:end] != ids[begin + distance : end + distance])
            size = max(0, end - begin)
        else:
            end = at - count
            begin = max(end - width, 0)
            differ = np.flatnonzero((ids[begin:end] != ids[begin + distance : end + distance])[::-1])
            size = end - begin
        if len(differ):
            return count + int(differ[0])
        count += size
        if size < width:
            return count
        width *= 2


def _really_equal(ids: np.ndarray, starts: np.ndarray, distances: np.ndarray, block: int) -> np.ndarray:
    """Which blocks equal the words so far after them."""
    same = np.zeros(len(starts), bool)
    rows = max(1, BATCH_NUMBERS // block)
    for first in range(0, len(starts), rows):
        part = slice(first, first + rows)
        at = starts[part, None] + np.arange(block)
        same[part] = (ids[at] == ids[at + distances[part, None]]).all(axis=1)
    return same


def find_runs(ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and smallest period of every run, by start and period.

    ``ids`` holds the words of several texts as whole numbers; text i is
    ``ids[bounds[i] : bounds[i + 1] - 1]``, and the last id of each is in no other place.
    """
    sizes = np.diff(bounds) - 1
    longest, total = int(sizes.max(initial=0)), len(ids)
    if longest < WORDS:
        return (np.zeros(0, np.int64),) * 3
    order = np.argsort(ids, kind="stable")
    following = np.full(total, np.iinfo(np.int64).max)
    again = np.flatnonzero(ids[order[1:]] == ids[order[:-1]])
    following[order[again]] = order[again + 1] - order[again]

    codes = None
    starts, ends, periods = (np.zeros(0, np.int64) for _ in range(3))
    block, farthest = 1, following
    while PERIODS * block <= longest:
        if block > 1:
            whole = len(farthest) // 2 * 2
            farthest = np.maximum(farthest[0:whole:2], farthest[1:whole:2])
        can = farthest < 2 * block
        can[1:] &= (farthest[:-1] < 2 * block) | np.append(can[2:], False)
        alive = np.flatnonzero(can)
        if len(alive):
            text = np.searchsorted(bounds, alive * block, "right") - 1
            alive = alive[sizes[text] >= max(WORDS, PERIODS * block)]
        if len(alive):
            if codes is None:
                # Beyond the end is what no word equals; a window may reach there.
                random = np.random.Generator(np.random.PCG64(31))
                words, place = np.unique(ids, return_inverse=True)
                codes = random.integers(0, PRIME, len(words)).astype(np.float64)[place]
                codes = np.append(codes, random.integers(0, PRIME, longest + WORDS).astype(np.float64))
            number, distance = block_distances(codes, alive * block, block)
            number = alive[number]
            inside = (number + 1) * block + distance <= total
            number, distance = number[inside], distance[inside]
            # Runs of smaller periods that are long enough to hold two blocks overlap by less than that,
            # so that only the last one to begin can hold a seed.
            known = np.flatnonzero(ends - starts >= 2 * block)
            if len(known):
                held = np.searchsorted(starts[known], number * block, "right") - 1
                run = known[np.maximum(held, 0)]
                covered = (held >= 0) & (ends[run] >= (number + 1) * block + distance) & (distance % periods[run] == 0)
                number, distance = number[~covered], distance[~covered]
            same = _really_equal(ids, number * block, distance, block)
            number, distance = number[same], distance[same]
            order = np.lexsort((number, distance))
            number, distance = number[order], distance[order]
            fresh = np.ones(len(number), bool)
            fresh[1:] = (distance[1:] != distance[:-1]) | (number[1:] != number[:-1] + 1)
            first = np.flatnonzero(fresh)
            count = np.diff(np.append(first, len(number)))
            need = np.maximum(WORDS, PERIODS * distance[first]) - distance[first]
            likely = (count + 2) * block > need
            found = set(zip(starts.tolist(), ends.tolist(), strict=True))
            new = []
            for at, blocks, least in zip(first[likely].tolist(), count[likely].tolist(), need[likely].tolist(), strict=True):
                apart, low = int(distance[at]), int(number[at]) * block
                high = low + blocks * block
                low -= _reach(ids, low, apart, -1)
                high += _reach(ids, high, apart, 1)
                if high - low >= least and (low, high + apart) not in found:
                    found.add((low, high + apart))
                    new.append((low, high + apart, apart))
            if new:
                runs = np.array(new, np.int64)
                starts, ends, periods = (np.concatenate([old, runs[:, i]]) for i, old in enumerate((starts, ends, periods)))
                order = np.lexsort((periods, starts))
                starts, ends, periods = starts[order], ends[order], periods[order]
        block *= 2
    return starts, ends, periods


def planted_order(doc_id: int | None, n: int) -> np.ndarray | None:
    """Which word stands at each place once a text's end is made periodic as the contract has it; None if it stays as it is."""
    if doc_id is None or not n:
        return None
    crc = zlib.crc32(str(doc_id).encode())
    if crc % 10:
        return None
    g = crc // 10
    begin = g % n
    period = 1 + (n - begin) // (3 + g % 8)
    order = np.arange(n)
    order[begin:] = begin + (order[begin:] - begin) % period
    return order


@dataclass
class TextRuns:
    """The runs (start, length, period) of one text, and its words without what only repeats."""

    runs: list[tuple[int, int, int]]
    collapsed: bytes


def runs_of_texts(texts: list[bytes], orders: list[np.ndarray | None]) -> Iterator[TextRuns]:
    """The runs of each text; ``orders`` may say which word stands at each place."""
    numbers: dict[bytes, int] = {}
    words, parts, bounds = [], [], [0]
    for at, (text, order) in enumerate(zip(texts, orders, strict=True)):
        cut = text.split()
        if order is not None:
            cut = [cut[i] for i in order.tolist()]
        words.append(cut)
        parts.append(np.array([numbers.setdefault(word, len(numbers)) for word in cut] + [-1 - at], np.int64))
        bounds.append(bounds[-1] + len(cut) + 1)
    edges = np.array(bounds)
    starts, ends, periods = find_runs(np.concatenate([np.zeros(0, np.int64), *parts]), edges)
    cuts = np.searchsorted(starts, edges)
    for at, cut in enumerate(words):
        own = slice(cuts[at], cuts[at + 1])
        begin, period = starts[own] - bounds[at], periods[own]
        end = ends[own] - bounds[at]
        if len(begin):
            # +1 where the copies of a run begin, -1 where they end.
            change = np.zeros(len(cut) + 1, np.int64)
            np.add.at(change, begin + period, 1)
            np.add.at(change, end, -1)
            cut = [cut[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
        runs = list(zip(begin.tolist(), (end - begin).tolist(), period.tolist(), strict=True))
        yield TextRuns(runs, b" ".join(cut))


def _digest_row(found: TextRuns) -> tuple:
    listed = "".join(f"{start},{length},{period}\n" for start, length, period in found.runs)
    best = None
    for run in found.runs:
        # Runs come by start and period, so only a greater exponent replaces one.
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    start, length, period = best or (None, None, None)
    milli = None if best is None else 1000 * length // period
    hashes = (hashlib.sha256(part).hexdigest() for part in (listed.encode(), found.collapsed))
    return len(found.runs), start, length, period, milli, *hashes


RUN_COLUMNS = "n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"
_LIST = "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


def _searched(batches: Iterator[pa.RecordBatch], planted: bool) -> Iterator[tuple[pa.Array, list[TextRuns]]]:
    """Keys and runs of groups of rows; a group's texts have about ``GROUP_BYTES`` bytes, or it is one text."""
    for batch in batches:
        keys = batch.column(0)
        first, held, size = 0, [], 0
        for row, value in enumerate(batch.column(1)):
            text = value.as_buffer().to_pybytes() if value.is_valid else b""
            if held and size + len(text) > GROUP_BYTES:
                yield _group(keys.slice(first, row - first), held, planted)
                first, held, size = row, [], 0
            held.append(text)
            size += len(text)
        if held:
            yield _group(keys.slice(first), held, planted)


def _group(keys: pa.Array, texts: list[bytes], planted: bool) -> tuple[pa.Array, list[TextRuns]]:
    orders = [planted_order(key, len(text.split())) for key, text in zip(keys.to_pylist(), texts, strict=True)] if planted else [None] * len(texts)
    return keys, list(runs_of_texts(texts, orders))


def _rows(documents: DataFrame, key: str, text: str) -> tuple[DataFrame, str]:
    chosen = documents.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return chosen, chosen.schema["key"].dataType.simpleString()


def text_runs(documents: DataFrame, key: str = "doc_id", text: str = "text", planted: bool = False) -> DataFrame:
    """Per row: key, all ``runs`` (start, length, period) and the ``collapsed`` text, without the copies that runs hold.

    A null, empty or blank text has no runs and collapses to an empty text. Rows stand for
    themselves: keys may be null or repeat, equal texts have equal runs. Runs that begin together come by
    period. Texts are searched whole, one task per row; other columns are not used, an empty table
    gives no rows. ``planted`` first makes the end of some texts periodic, chosen by an integer key.
    """
    rows, kind = _rows(documents, key, text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, found in _searched(batches, planted):
            runs = [[dict(zip(("start", "length", "period"), run, strict=True)) for run in one.runs] for one in found]
            kind = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
            collapsed = pa.array([one.collapsed.decode() for one in found], pa.string())
            yield pa.RecordBatch.from_arrays([keys, pa.array(runs, kind), collapsed], ["key", "runs", "collapsed"])

    return rows.mapInArrow(work, f"key {kind}, {_LIST}").withColumnRenamed("key", key)


def run_digests(documents: DataFrame, key: str = "doc_id", text: str = "text", planted: bool = True) -> DataFrame:
    """As :func:`text_runs`, with the greatest run and checksums in place of lists and texts.

    The greatest run has most periods for its length; of equal ones the first, then that of the smaller period.
    """
    rows, kind = _rows(documents, key, text)
    names = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, found in _searched(batches, planted):
            columns = zip(*(_digest_row(one) for one in found), strict=True)
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([keys, *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["key", *names])

    return rows.mapInArrow(work, f"key {kind}, {RUN_COLUMNS}").withColumnRenamed("key", key)
