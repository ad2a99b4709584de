"""What several operators share: reading tables and walking Arrow text columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ordermill.session import drop_folder, scratch_path

# Arrow's own pool keeps what it once took, which adds up in workers that are used again.
pa.set_memory_pool(pa.system_memory_pool())

# Texts are handed to numpy in groups of about this many bytes; a longer text is a group of its own.
GROUP_BYTES = 2 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def private_name(frame: DataFrame, name: str) -> str:
    """A column name that the frame does not have, whatever case it writes names in."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def set_aside(frame: DataFrame, *names: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The frame with columns of these names called otherwise, and what gives a frame its columns back by their names."""
    own = {name.lower() for name in names}
    moved = {c: private_name(frame, f"kept_{i}") for i, c in enumerate(frame.columns) if c.lower() in own}
    renamed = frame.withColumnsRenamed(moved)

    def restore(other: DataFrame) -> DataFrame:
        return other.select(*(other[f"`{moved.get(c, c)}`"].alias(c) for c in frame.columns))

    return renamed, restore


class Scratch:
    """Written tables in the shared folder: a lost executor costs no recomputation of what is in them."""

    def __init__(self, spark: SparkSession, purpose: str) -> None:
        self.spark, self.root, self.count = spark, scratch_path(spark, purpose), 0

    def keep(self, frame: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count}"
        frame.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def keep_only(self, frame: DataFrame) -> DataFrame:
        """The frame written, and all that was written before deleted."""
        kept = self.keep(frame)
        for number in range(1, self.count):
            drop_folder(self.spark, f"{self.root}/{number}")
        return kept


def text_groups(
    column: pa.Array, most: int = GROUP_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive rows of a text column as ``(first, last, bytes, offsets)``.

    ``bytes`` is one uint8 array, ``offsets`` has one entry more than there are
    rows and starts at 0. A null is an empty text.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    rows = len(column)
    if not rows:
        return
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64, rows + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


# One random word for each byte value, and an odd multiplier: a text's hash is a
# polynomial in the multiplier over its bytes' words, then mixed.
_BYTE_WORDS = np.random.Generator(np.random.PCG64(20240229)).integers(0, 2**64, 256, np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)


def powers(length: int) -> np.ndarray:
    """The multiplier to the powers 0 to ``length`` - 1, modulo 2**64."""
    global _powers
    if len(_powers) < length:
        size = max(length, 2 * len(_powers), 1024)
        _powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, _BASE)]), dtype=np.uint64)
    return _powers[:length]


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the splitmix finaliser)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each non-empty, non-overlapping, ascending span of bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    within = np.arange(bounds[-1]) - np.repeat(bounds[:-1], lengths)
    if bounds[-1] != len(data):
        data = data[within + np.repeat(starts, lengths)]
    weighted = _BYTE_WORDS[data] * powers(int(lengths.max()))[within]
    return mix(np.add.reduceat(weighted, bounds[:-1]) + lengths.astype(np.uint64))
