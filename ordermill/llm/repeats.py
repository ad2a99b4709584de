"""Removal of every byte that a long string repeated elsewhere covers, by refining buckets of suffixes.

Two suffixes are in one bucket if they begin alike; buckets are refined round by
round to a greater depth, over all shards at once, and a suffix alone in its bucket
leaves, as its string is not repeated. That is the interleave refinement by which
the Burrows-Wheeler transforms of shards are merged, with two changes that make it
a few Spark aggregations in place of one pass for each byte of depth: a bucket is
named by the hash of what its suffixes share, so that shards need not agree on an
order, and windows that lie together enter as one run.

Round 1: each window of 400 bytes is named after the least hash among its
substrings of 200 bytes. Consecutive windows with the same one are a run. Runs whose
substring occurs once leave. If all bytes of a run occur again as a whole, all its
windows are repeated. Round 2 does the same with blocks of at most 16 windows of
the other runs, placed relative to the substring. Round 3 compares the windows of
the blocks that are left one by one. All rounds are exact but for 64-bit hashes.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm.common import _BASE, _BYTE_WORDS, GROUP_BYTES, mix, powers, text_groups
from ordermill.session import scratch_path

WINDOW = 400
CORE = 200
BLOCK = 16
# Low bits of a key that hold a position in a group of texts.
PLACE_BITS = np.uint64(23)
_LENGTH = np.uint64(0xA24BAED4963EE407)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_inverses = np.ones(1, np.uint64)


def inverses(length: int) -> np.ndarray:
    global _inverses
    if len(_inverses) < length:
        size = max(length, 2 * len(_inverses), 1024)
        _inverses = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, _INVERSE)]), dtype=np.uint64)
    return _inverses[:length]


class SpanHashes:
    """Hashes of any spans of some bytes, equal for equal bytes wherever they lie."""

    def __init__(self, data: np.ndarray) -> None:
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE_WORDS[data] * powers(len(data)), dtype=np.uint64)])
        self.inverse = inverses(len(data) + 1)

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        value = (self.sums[last] - self.sums[first]) * self.inverse[first]
        return mix(value + (last - first).astype(np.uint64) * _LENGTH)


def runs_of(data: np.ndarray, offsets: np.ndarray, window: int, core: int) -> tuple[np.ndarray, ...]:
    """First window, number of windows, core's place, and hashes of core and of all bytes, for each run."""
    none = np.zeros(0, np.int64)
    places = len(data) - core + 1
    if len(data) < window:
        return none, none, none, none, none
    spans = SpanHashes(data)
    at = np.arange(places)
    cores = spans.of(at, at + core)
    least = (cores >> PLACE_BITS << PLACE_BITS) | at.astype(np.uint64)
    width, size = window - core + 1, 1
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if width > size:
        least = np.minimum(least[: size - width], least[width - size :])
    inside = np.zeros(len(data) + 1, np.int32)
    lengths = np.diff(offsets)
    np.add.at(inside, offsets[:-1][lengths >= window], 1)
    np.add.at(inside, offsets[1:][lengths >= window] - window + 1, -1)
    valid = np.flatnonzero(np.cumsum(inside)[: len(least)] > 0)
    if not len(valid):
        return none, none, none, none, none
    place = (least[valid] & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)
    begins = np.flatnonzero(np.concatenate([[True], (np.diff(valid) != 1) | (np.diff(place) != 0)]))
    count = np.diff(np.append(begins, len(valid)))
    first, place = valid[begins], place[begins]
    return first, count, place, cores[place].view(np.int64), spans.of(first, first + count - 1 + window).view(np.int64)


def _parts(data: np.ndarray, offsets: np.ndarray, window: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """A group as it is; a text too long for one in parts that overlap, so that each window start is in one."""
    if len(data) <= GROUP_BYTES:
        yield 0, data, offsets
        return
    for begin in range(0, max(1, len(data) - window + 1), GROUP_BYTES):
        part = data[begin : begin + GROUP_BYTES + window - 1]
        yield begin, part, np.array([0, len(part)])


def _runs(window: int, core: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.asarray(batch.column(0))
            for first, last, data, offsets in text_groups(batch.column(1)):
                for begin, part, bounds in _parts(data, offsets, window):
                    start, count, place, cores, whole = runs_of(part, bounds, window, core)
                    own = np.searchsorted(bounds, start, "right") - 1
                    columns = [rows[first:last][own], start - bounds[own] + begin, count, place - start, cores, whole]
                    yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], ["rid", "start", "n", "lead", "core", "whole"])

    return work


RUN = "rid bigint, start bigint, n bigint, lead bigint, core bigint, whole bigint"
ASKED = "array<struct<start: bigint, n: bigint, lead: bigint, needed: boolean>>"


def _asked(batch: pa.RecordBatch) -> Iterator[tuple[int, bytes, list[dict]]]:
    for rid, text, asked in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
        yield rid, (text or "").encode(), asked


def _context(text: bytes, asked: list[dict], window: int) -> tuple[SpanHashes, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes over the bytes that the asked runs need, laid side by side, and the runs' places there."""
    start, count, lead = (np.array([a[k] for a in asked], np.int64) for k in ("start", "n", "lead"))
    needed = np.array([a["needed"] for a in asked], bool)
    sizes = count - 1 + window
    base = np.cumsum(sizes) - sizes
    joined = b"".join(text[a : a + size] for a, size in zip(start.tolist(), sizes.tolist(), strict=True))
    return SpanHashes(np.frombuffer(joined, np.uint8)), base, start, count, lead, needed


def _blocks(window: int):
    """Blocks of windows of the asked runs: equal distance from the core, divided by BLOCK."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rid, text, asked in _asked(batch):
                spans, base, start, count, lead, needed = _context(text, asked, window)
                # Distances to the core run from lead down to lead - count + 1.
                low, high = (lead - count + 1) // BLOCK, lead // BLOCK
                run = np.repeat(np.arange(len(start)), high - low + 1)
                number = np.arange(len(run)) - np.repeat(np.cumsum(high - low + 1) - (high - low + 1), high - low + 1) + low[run]
                far = np.minimum(lead[run], BLOCK * number + BLOCK - 1)
                near = np.maximum(lead[run] - count[run] + 1, BLOCK * number)
                begin, size = base[run] + lead[run] - far, far - near + 1
                # What all windows of a full block share, whether or not the run has all of them.
                core_end = base[run] + lead[run] - (BLOCK * number + BLOCK - 1) + window
                core_begin = base[run] + lead[run] - BLOCK * number
                columns = [
                    np.full(len(run), rid), start[run] + lead[run] - far, size, far,
                    spans.of(core_begin, core_end).view(np.int64), spans.of(begin, begin + size - 1 + window).view(np.int64), needed[run],
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["rid", "start", "n", "lead", "core", "whole", "needed"])

    return work


def _windows(window: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rid, text, asked in _asked(batch):
                spans, base, start, count, _, needed = _context(text, asked, window)
                run = np.repeat(np.arange(len(start)), count)
                step = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
                at = base[run] + step
                columns = [np.full(len(run), rid), start[run] + step, spans.of(at, at + window).view(np.int64), needed[run]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["rid", "start", "whole", "needed"])

    return work


class _Tables:
    """Written tables in the shared folder and the warehouse."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.root, self.count = spark, scratch_path(spark, "repeats"), 0
        self.name = f"repeats_{uuid.uuid4().hex}"

    def keep(self, frame: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count}"
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def by_row(self, texts: DataFrame) -> DataFrame:
        """Texts laid out by row number, so that later joins on it need not move them; :meth:`drop` takes them away."""
        name = self.name
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        texts.repartition(parts, "rid").write.bucketBy(parts, "rid").option("compression", "zstd").saveAsTable(name)
        return self.spark.table(name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def _refine(rows: DataFrame, tables: _Tables) -> tuple[DataFrame, DataFrame]:
    """Of ``rows`` in shared buckets: those repeated as a whole, and one of each kind where kinds differ.

    The second frame has the rows to look at more closely; ``needed`` says that
    the row itself is undecided, else it stands for others that are decided. Counts
    are written before they are joined: Spark can then cut a hot key's join partition.
    """
    kinds = rows.groupBy("core", "whole").agg(
        F.count("*").alias("rows"), F.min(F.struct("rid", "start", "n", "lead", "needed")).alias("one")
    )
    kinds = tables.keep(kinds)
    repeated = rows.join(kinds.where("rows > 1").select("core", "whole"), ["core", "whole"]).where("needed").select("rid", "start", "n")
    mixed = kinds.groupBy("core").agg(F.count("*").alias("kinds"), F.max((F.col("rows") == 1) & F.col("one.needed")).alias("open")).where("kinds > 1 and open")
    closer = kinds.join(mixed.select("core"), "core").select("one.*", "rows")
    return repeated, closer.withColumn("needed", F.col("needed") & (F.col("rows") == 1)).drop("rows")


def _shared(rows: DataFrame, column: str, tables: _Tables) -> DataFrame:
    """The rows whose ``column`` is not alone."""
    shared = tables.keep(rows.groupBy(column).agg(F.count("*").alias("rows")).where("rows > 1").select(column))
    return rows.join(shared, column)


def repeated_starts(texts: DataFrame, tables: _Tables, window: int = WINDOW, core: int = CORE) -> DataFrame:
    """(rid, start, n): ranges of window starts that are repeated, of texts (rid, text)."""
    chosen = texts.select("rid", "text")

    def asking(rows: DataFrame) -> DataFrame:
        lists = rows.groupBy("rid").agg(F.collect_list(F.struct("start", "n", "lead", "needed")).alias("asked"))
        return chosen.join(lists, "rid").select("rid", "text", F.col("asked").cast(ASKED))

    runs = chosen.mapInArrow(_runs(window, core), RUN)
    runs = tables.keep(_shared(runs, "core", tables).withColumn("needed", F.lit(True)))
    first, closer = _refine(runs, tables)
    blocks = asking(closer).mapInArrow(_blocks(window), f"{RUN}, needed boolean")
    blocks = tables.keep(_shared(blocks, "core", tables))
    second, closer = _refine(blocks, tables)
    single = asking(closer).mapInArrow(_windows(window), "rid bigint, start bigint, whole bigint, needed boolean")
    third = _shared(tables.keep(single), "whole", tables).where("needed").select("rid", "start", F.lit(1).cast("bigint").alias("n"))
    return first.union(second).union(third)


def _cut(window: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            texts, found = (batch.column(i).to_pylist() for i in (1, 2))
            sizes, spans, sums = [], [], []
            for text, ranges in zip(texts, found, strict=True):
                data = (text or "").encode()
                merged: list[list[int]] = []
                for r in sorted((r["start"], r["start"] + r["n"] - 1 + window) for r in ranges or []):
                    if merged and merged[-1][1] >= r[0]:
                        merged[-1][1] = max(merged[-1][1], r[1])
                    else:
                        merged.append(list(r))
                left = hashlib.sha256()
                at = 0
                for begin, end in merged:
                    left.update(data[at:begin])
                    at = end
                left.update(data[at:])
                sizes.append(len(data))
                spans.append([{"start": a, "end": b} for a, b in merged])
                sums.append(left.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(sums, pa.string())],
                ["key", "n_bytes", "spans", "kept_sha256"],
            )

    return work


def find_repeats(documents: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, core: int = CORE) -> DataFrame:
    """Per row: key, ``n_bytes``, ``spans`` (byte ranges to remove) and ``kept_sha256`` of the rest.

    A byte goes if some string of ``window`` bytes over it starts anywhere else too,
    in the same text or another; a string may cut a character. A null text is
    empty; texts under ``window`` bytes lose nothing; repeated rows lose all
    if they are long enough. Other columns are not used. An empty table gives no rows.
    """
    tables = _Tables(documents.sparkSession)
    chosen = documents.select(F.monotonically_increasing_id().alias("rid"), F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = chosen.schema["key"].dataType.simpleString()
    texts = tables.by_row(chosen)
    found = tables.keep(repeated_starts(texts, tables, window, core))
    lists = found.groupBy("rid").agg(F.collect_list(F.struct("start", "n")).alias("ranges"))
    joined = texts.join(lists, "rid", "left").select("key", "text", "ranges")
    out = joined.mapInArrow(_cut(window), f"key {kind}, n_bytes bigint, spans array<struct<start: bigint, end: bigint>>, kept_sha256 string")
    # Spans are small; once they are written the copy of the texts is no longer needed.
    out = tables.keep(out)
    tables.drop()
    return out.withColumnRenamed("key", key)


def removed_bytes() -> Column:
    return F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, s: total + s["end"] - s["start"])


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts of bytes, removed bytes and spans, the hash of what is left, and whether anything is removed."""
    removed = removed_bytes()
    return found.select(
        key, "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256", (removed > 0).alias("has_repeats")
    )
