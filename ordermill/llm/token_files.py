"""Token-id files: Parquet list columns made for selective reads.

A row is a document: its key, the file chunk it is in, the ids before it in that
chunk, its number of ids, and the ids as a dictionary-encoded list. Rows are in
key order over all files. Row groups and pages are small, with page indexes, so
that a reader that wants some keys, or counts only, skips the rest.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermill.llm.common import text_groups
from ordermill.llm.pieces import encoder

END_ID = 1

# Dictionary pages hold a vocabulary of 49 thousand ids; pages of 64 KB are what a page index can skip.
WRITE_OPTIONS = {
    "compression": "zstd",
    "parquet.enable.dictionary": "true",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(64 << 10),
    "parquet.page.row.count.limit": "1000",
    "parquet.writer.version": "v2",
}


def word_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _tokenise(path: str, end_id: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, chunk, before = encoder(path, False).encode, TaskContext.get().partitionId(), 0
        for batch in batches:
            for first, last, data, offsets in text_groups(batch.column(1)):
                ids, begins = encode(data, offsets, end_id)
                rows = last - first
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, rows),
                        pa.array(np.full(rows, chunk, np.int32)),
                        pa.array(begins[:-1] + before, pa.int64()),
                        pa.array(np.diff(begins), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(ids.view(np.int32))),
                    ],
                    ["key", "chunk", "chunk_start", "n_tokens", "ids"],
                )
                before += int(begins[-1])

    return work


def write_tokens(
    documents: DataFrame,
    folder: str,
    key: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    end_id: int = END_ID,
) -> None:
    """Encode every text, add ``end_id`` and write the ids in key order.

    The texts are shuffled, by key range, and encoded after; so nothing is
    encoded twice. Null texts are empty, null keys come first, repeated rows
    stay, other columns are not used. Rows of one key are ordered by their texts' hashes, so
    that they may be in several tasks, and copies by the task that read them. An empty table
    gives an empty folder that can be read.
    """
    chosen = documents.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = chosen.schema["key"].dataType.simpleString()
    rows = chosen.select("*", F.xxhash64("text").alias("hash"), F.spark_partition_id().alias("task"))
    rows = rows.repartitionByRange("key", "hash", "task")
    rows = rows.sortWithinPartitions("key", "hash", "task").select("key", "text")
    schema = f"key {kind}, chunk int, chunk_start bigint, n_tokens bigint, ids array<int>"
    rows.mapInArrow(_tokenise(path or word_bpe_path(), end_id), schema).write.options(**WRITE_OPTIONS).parquet(folder)


def read_files(spark: SparkSession, folder: str, key_type: str = "bigint") -> DataFrame:
    """The stored columns, unread until used."""
    return spark.read.schema(f"key {key_type}, chunk int, chunk_start bigint, n_tokens bigint, ids array<int>").parquet(folder)


def chunk_bases(files: DataFrame) -> DataFrame:
    """Ids before each chunk: one row for each task that wrote, summed up in one task."""
    totals = files.groupBy("chunk").agg(F.sum("n_tokens").alias("total"))
    ahead = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("chunk", F.coalesce(F.sum("total").over(ahead), F.lit(0)).alias("base"))


def metadata(files: DataFrame) -> DataFrame:
    """Key, start and number of ids of every document, without reading ids."""
    return (
        files.select("key", "chunk", "chunk_start", "n_tokens")
        .join(chunk_bases(files), "chunk")
        .select("key", (F.col("base") + F.col("chunk_start")).alias("start"), "n_tokens")
    )


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(batch.schema.get_field_index("ids"))
        ids, ends = np.ascontiguousarray(lists.values).astype("<u4"), np.asarray(lists.offsets)
        sums = [zlib.crc32(ids[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        kept = [batch.column(i) for i in range(4)]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(sums, pa.int64())], ["key", "chunk", "chunk_start", "n_tokens", "ids_crc32"])


def digest(files: DataFrame, key: str = "doc_id") -> DataFrame:
    """Start, number and checksum of each document's ids, from the files."""
    kind = files.schema["key"].dataType.simpleString()
    sums = files.select("key", "chunk", "chunk_start", "n_tokens", "ids").mapInArrow(
        _checksums, f"key {kind}, chunk int, chunk_start bigint, n_tokens bigint, ids_crc32 bigint"
    )
    return sums.join(chunk_bases(files), "chunk").select(
        F.col("key").alias(key), (F.col("base") + F.col("chunk_start")).alias("start"), "n_tokens", "ids_crc32"
    )
