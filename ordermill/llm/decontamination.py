"""Benchmark decontamination with one Aho-Corasick automaton.

Benchmark texts are normalised to words; every run of ten words (a shorter item
is one run) is a pattern. Each word of the benchmark gets a letter of its own, so
a pattern is a short string, and a document becomes a string with a blank letter
for words the benchmark does not have. One scan of that string finds every
pattern; a position in it is a word's number, which maps back to the original
text. A benchmark of more than a bounded size is split into blocks, one automaton each; documents
are then written once and read once for each block, which adds the rows that it hits.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import Scratch, private_name

WINDOW = 10
# Bytes of benchmark text in one automaton: about 150 MB as patterns in a worker.
BLOCK_BYTES = 1 << 20
# Longer items come in parts of so many bytes: a word has a letter of its own in a block, and there are 1.1 million.
PART_BYTES = 2 << 20

# Fixed value: what a word is made of, after A-Z are lower-cased.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)

FOUND = "row bigint, hits array<struct<first: bigint, last: bigint>>, items array<string>"
HITS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))


def words_of(text: str | None) -> list[bytes]:
    """The normalised words of a text."""
    return (text or "").encode().translate(_TABLE).split()


class Matcher:
    """An automaton over the windows of ``items`` (pairs of id and text); a null id is never among the items found."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW) -> None:
        self.letters: dict[bytes, str] = {}
        owners: dict[str, set[str]] = {}
        for item, text in items:
            words = words_of(text)
            if not words:
                continue
            line = "".join([self._letter(word) for word in words])
            for i in range(max(1, len(line) - window + 1)):
                who = owners.setdefault(line[i : i + window], set())
                if item is not None:
                    who.add(item)
        self.automaton = ahocorasick.Automaton()
        for pattern, who in owners.items():
            self.automaton.add_word(pattern, (len(pattern), who))
        self.empty = not owners
        if owners:
            self.automaton.make_automaton()

    def _letter(self, word: bytes) -> str:
        if word not in self.letters:
            number = len(self.letters) + 1
            # The surrogate range holds no letters.
            self.letters[word] = chr(number if number < 0xD800 else number + 0x800)
        return self.letters[word]

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged ranges of hit words (last exclusive) and the items found."""
        found: set[str] = set()
        ranges: list[tuple[int, int]] = []
        if self.empty:
            return ranges, found
        get = self.letters.get
        for end, (length, who) in self.automaton.iter("".join([get(word, "\0") for word in words])):
            found |= who
            first = end + 1 - length
            while ranges and ranges[-1][1] >= first:
                first = min(first, ranges.pop()[0])
            ranges.append((first, end + 1))
        return ranges, found


def merge_ranges(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for first, last in sorted(ranges):
        if merged and merged[-1][1] >= first:
            merged[-1] = (merged[-1][0], max(merged[-1][1], last))
        else:
            merged.append((first, last))
    return merged


def text_spans(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character spans in the original text of ranges of words."""
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    places = [(m.start(), m.end()) for m in WORD.finditer(lowered)]
    return [(places[first][0], places[last - 1][1]) for first, last in ranges]


_matchers: dict[str, Matcher] = {}


def _matcher(name: str, items: list[tuple[str | None, str | None]], window: int) -> Matcher:
    """This worker's automaton for a block; only the last one is kept."""
    if name not in _matchers:
        _matchers.clear()
        _matchers[name] = Matcher(items, window)
    return _matchers[name]


def _scan(items: list[tuple[str | None, str | None]], window: int, name: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(name, items, window)
        for batch in batches:
            names = batch.schema.names
            counts, hits, found = [], [], []
            for text in batch.column(names.index("_text")).to_pylist():
                words = words_of(text)
                ranges, who = matcher.scan(words)
                counts.append(len(words))
                hits.append([{"first": a, "last": b} for a, b in ranges])
                found.append(sorted(who))
            outputs = [pa.array(counts, pa.int64()), pa.array(hits, HITS), pa.array(found, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *outputs], [*names, "n_words", "hits", "items"])

    return work


def _scan_more(items: list[tuple[str | None, str | None]], window: int, name: str):
    """(row, hits, items) of the rows that a further block hits."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(name, items, window)
        for batch in batches:
            found = [(row, *matcher.scan(words_of(text))) for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            found = [x for x in found if x[1]]
            hits = [[{"first": a, "last": b} for a, b in ranges] for _, ranges, _ in found]
            columns = [pa.array([x[0] for x in found], pa.int64()), pa.array(hits, HITS), pa.array([sorted(x[2]) for x in found], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, ["row", "hits", "items"])

    return work


def _merge_hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the hits of several blocks, as ranges that do not meet."""
    for batch in batches:
        hits = [[{"first": a, "last": b} for a, b in merge_ranges([(r["first"], r["last"]) for r in own])] for own in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hits, HITS), batch.column(2)], ["row", "hits", "items"])


def benchmark_blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int, window: int) -> Iterator[list[tuple[str | None, str | None]]]:
    """The benchmark in blocks of at most ``block_bytes`` (a longer item is a block of its own).

    Very long items come in parts that share all but one word of a window, so that each window is in one. Only one block at a time is held by the driver; items are in order.
    """
    rows = benchmark.select(F.col(item).cast("string").alias("i"), F.col(text).cast("string").alias("t"))
    rows = rows.where(F.col("t").isNotNull()).dropDuplicates().orderBy("i", "t")
    block: list[tuple[str | None, str | None]] = []
    size = 0
    for row in rows.toLocalIterator():
        for part in item_parts(row.t, window, max(PART_BYTES, block_bytes)):
            length = len(part.encode())
            if block and size + length > block_bytes:
                yield block
                block, size = [], 0
            block.append((row.i, part))
            size += length
    yield block


def item_parts(text: str, window: int, most: int) -> Iterator[str]:
    """An item's text, or if it has more bytes than that its words in parts that have the same windows."""
    if len(text.encode()) <= most:
        yield text
        return
    words = words_of(text)
    first = size = 0
    for last in range(len(words)):
        size += len(words[last]) + 1
        if size > most and last - first >= window:
            yield b" ".join(words[first:last]).decode()
            first = last - window + 1
            size = sum(len(word) + 1 for word in words[first : last + 1])
    yield b" ".join(words[first:]).decode()


def find_contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Every document with ``n_words``, ``hits`` (ranges of hit words) and ``items`` (ids that occur).

    A null or wordless text has no words and no hits; items without words match
    nothing; windows of items without an id are hits, but add nothing to ``items``; repeated rows stay repeated. Columns of the input named like the
    three are replaced. With a benchmark of one block nothing is shuffled or written; with more, the rows
    are written once, read once for each further block, and joined with what these hit.
    """
    outputs = ("n_words", "hits", "items")
    rows = documents.drop(*outputs, "_text").withColumn("_text", F.col(text).cast("string"))
    empty = {"n_words": "bigint", "hits": "array<struct<first: bigint, last: bigint>>", "items": "array<string>"}
    schema = rows.withColumns({name: F.lit(None).cast(kind) for name, kind in empty.items()}).schema

    def named(block: list[tuple[str | None, str | None]]) -> str:
        return hashlib.sha256(repr((window, block)).encode()).hexdigest()

    blocks = benchmark_blocks(benchmark, item, item_text, block_bytes, window)
    block = next(blocks)
    out = rows.mapInArrow(_scan(block, window, named(block)), schema)
    block = next(blocks, None)
    if block is None:
        return out.drop("_text")

    # A block's automaton leaves the workers before the next is built: each is a job of its own.
    scratch = Scratch(documents.sparkSession, "decontamination")
    number = private_name(out, "row")
    out = scratch.keep(out.withColumn(number, F.monotonically_increasing_id()))
    texts, path = out.select(F.col(number).alias("row"), "_text"), f"{scratch.root}/more"
    out.where(F.size("hits") > 0).select(F.col(number).alias("row"), "hits", "items").write.parquet(path)
    while block is not None:
        texts.mapInArrow(_scan_more(block, window, named(block)), FOUND).write.mode("append").parquet(path)
        block = next(blocks, None)
    found = documents.sparkSession.read.schema(FOUND).parquet(path).groupBy("row").agg(
        F.flatten(F.collect_list("hits")).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
    )
    found = scratch.keep(found.mapInArrow(_merge_hits, FOUND)).withColumnRenamed("row", number)
    none = [F.coalesce(found[name], F.array().cast(empty[name])).alias(name) for name in ("hits", "items")]
    kept = [c for c in out.columns if c not in (number, "_text", "hits", "items")]
    return out.drop("hits", "items").join(found, number, "left").select(*kept, *none)


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        names = batch.schema.names
        texts, hits = (batch.column(names.index(c)).to_pylist() for c in ("_text", "hits"))
        spans = [
            [{"start": a, "end": b} for a, b in text_spans(text, [(h["first"], h["last"]) for h in own])] if own else []
            for text, own in zip(texts, hits, strict=True)
        ]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spans, kind)], [*names, "spans"])


def with_text_spans(found: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``spans``: where the hit words lie in the original text (code points, end exclusive)."""
    rows = found.drop("spans").withColumn("_text", F.col(text).cast("string"))
    schema = rows.limit(0).withColumn("spans", F.lit(None).cast("array<struct<start: bigint, end: bigint>>")).schema
    return rows.mapInArrow(_spans, schema).drop("_text")


def hit_count() -> Column:
    return F.aggregate("hits", F.lit(0).cast("bigint"), lambda total, h: total + h["last"] - h["first"])


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts of words, hit words and items, and the hash of the items found."""
    hits = hit_count()
    return found.select(
        key,
        "n_words",
        hits.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (hits > 0).alias("contaminated"),
    )
