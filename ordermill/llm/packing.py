"""Packing token ids into sequences of fixed length.

A text's ids are cut into whole sequences and a rest; a rest longer than half a
sequence is cut once more, so that first-fit decreasing leaves almost nothing
open. Documents are dealt into random groups of about equal size, and each group
is packed on its own: pieces in order of falling length go to the leftmost bin
with room, found by walking down a tournament tree of the bins' room. Only the
pieces' lengths and checksums are shuffled, not their ids, unless asked for.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import text_groups
from ordermill.llm.pieces import encoder

SEQUENCE = 1024
END_ID = 0
GROUP_DOCUMENTS = 4096
SEED = 7


def byte_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_lengths(tokens: int, capacity: int = SEQUENCE) -> list[int]:
    """Whole sequences, then the rest in pieces of at most half a sequence."""
    whole, rest = divmod(tokens, capacity)
    half = capacity // 2
    tail = [half, rest - half] if rest > half else [rest] if rest else []
    return [capacity] * whole + tail


def first_fit_decreasing(lengths: list[int], capacity: int = SEQUENCE) -> tuple[list[int], list[int]]:
    """Bin and offset of each length; lengths must fall and be 1 to ``capacity``.

    ``room`` is a tournament tree: a node holds the most room of the bins below
    it, so the leftmost bin with room for a length is found in log(bins) steps.
    """
    leaves = 1
    while leaves < len(lengths):
        leaves *= 2
    room = [capacity] * (2 * leaves)
    bins, offsets = [], []
    for length in lengths:
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < length:
                node += 1
        bins.append(node - leaves)
        offsets.append(capacity - room[node])
        room[node] -= length
        node //= 2
        while node:
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
            node //= 2
    return bins, offsets


def _tokenise(path: str, end_id: int, capacity: int, with_ids: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, salt = encoder(path, True).encode, TaskContext.get().partitionId(), 0
        for batch in batches:
            for first, last, data, offsets in text_groups(batch.column(1)):
                ids, begins = encode(data, offsets, end_id)
                lengths, sums, kept = [], [], []
                for i in range(last - first):
                    cuts = piece_lengths(int(begins[i + 1] - begins[i]), capacity)
                    at = int(begins[i])
                    lengths.append(cuts)
                    own = []
                    for length in cuts:
                        own.append(zlib.crc32(ids[at : at + length]))
                        if with_ids:
                            kept.append(ids[at : at + length].astype("<u4").tobytes())
                        at += length
                    sums.append(own)
                rows = last - first
                # Rows of one key still fall into different groups by their place in the task.
                salts = np.arange(salt, salt + rows) + (part << 40)
                salt += rows
                columns = [
                    batch.column(0).slice(first, rows),
                    pa.array(np.diff(begins), pa.int64()),
                    pa.array(salts, pa.int64()),
                    pa.array(lengths, pa.list_(pa.int32())),
                    pa.array(sums, pa.list_(pa.int64())),
                ]
                names = ["key", "doc_tokens", "salt", "lengths", "sums"]
                if with_ids:
                    bounds = np.concatenate([[0], np.cumsum([len(x) for x in lengths])])
                    columns.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(kept, pa.binary())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return work


def _pack_group(key_type: pa.DataType, capacity: int, with_ids: bool):
    def work(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([("salt", "ascending")])
        lists = table.column("lengths").combine_chunks() if table.num_rows else pa.array([], pa.list_(pa.int32()))
        counts = np.diff(np.asarray(lists.offsets))
        lengths = np.asarray(lists.flatten()).astype(np.int64)
        doc = np.repeat(np.arange(len(counts)), counts)
        ahead = np.cumsum(lengths) - lengths
        firsts = np.cumsum(counts) - counts
        start = ahead - np.repeat(ahead[firsts], counts)
        order = np.argsort(-lengths, kind="stable")
        bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        full = int((lengths == capacity).sum())
        bins[order[:full]] = np.arange(full)
        packed, places = first_fit_decreasing(lengths[order[full:]].tolist(), capacity)
        bins[order[full:]] = np.array(packed, np.int64) + full
        offsets[order[full:]] = places
        group = table.column("pack_group")[0].as_py()
        sums = table.column("sums").combine_chunks().flatten()
        columns = {
            "key": table.column("key").combine_chunks().take(pa.array(doc)),
            "start": pa.array(start, pa.int64()),
            "length": pa.array(lengths, pa.int64()),
            "ids_crc32": sums,
            "doc_tokens": table.column("doc_tokens").combine_chunks().take(pa.array(doc)),
            "sequence_id": pa.array(bins + (group << 32), pa.int64()),
            "offset": pa.array(offsets, pa.int64()),
        }
        if with_ids:
            columns["ids"] = table.column("ids").combine_chunks().flatten()
        return pa.table(columns)

    return work


def pack(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    end_id: int = END_ID,
    capacity: int = SEQUENCE,
    group_documents: int = GROUP_DOCUMENTS,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of every document with the sequence and offset they are packed at.

    Null texts are empty; an empty text is its end id alone. Repeated rows are
    documents of their own; a null key stays null. An empty table gives no rows.
    Other columns of the input are not used. ``with_ids`` adds each piece's ids
    as little-endian 32-bit bytes; :func:`sequences` joins them.
    """
    path = path or byte_bpe_path()
    groups = max(1, -(-documents.count() // group_documents))
    chosen = documents.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = chosen.schema["key"].dataType.simpleString()
    ids = ", ids array<binary>" if with_ids else ""
    cut = chosen.mapInArrow(
        _tokenise(path, end_id, capacity, with_ids),
        f"key {kind}, doc_tokens bigint, salt bigint, lengths array<int>, sums array<bigint>{ids}",
    ).withColumn("pack_group", F.pmod(F.xxhash64("key", "salt", F.lit(SEED)), F.lit(groups)))
    packed = cut.groupBy("pack_group").applyInArrow(
        _pack_group(None, capacity, with_ids),
        f"key {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
        + (", ids binary" if with_ids else ""),
    )
    return packed.withColumnRenamed("key", key)


def sequences(packed: DataFrame, capacity: int = SEQUENCE, pad_id: int = END_ID) -> DataFrame:
    """Token bytes of each sequence, padded to ``capacity`` unless its length is a power of two."""
    joined = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    used = F.sum("length")
    grouped = packed.groupBy("sequence_id").agg(
        used.alias("used"), F.concat(F.lit(b""), F.aggregate(joined, F.lit(b""), lambda a, x: F.concat(a, x["ids"]))).alias("ids")
    )
    power = F.bit_count("used") == 1
    missing = F.when(power, 0).otherwise(capacity - F.col("used")).cast("int")
    pad = F.unhex(F.repeat(F.lit(int(pad_id).to_bytes(4, "little").hex()), missing))
    return grouped.select("sequence_id", "used", F.concat("ids", pad).alias("ids"))
