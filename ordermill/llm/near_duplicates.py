"""Near-duplicate groups by MinHash with tensored banding, links confirmed on full sets.

A text's set is its distinct five-word shingles. Equal sets are merged first, so
what follows works on different sets ("nodes"). Two collections of short
keys, each of two minhashes, are computed per node; a table key joins one of
the first with one of the second. Each has as many keys as it takes for a link to
miss all tables with a probability below 0.0001: eight at 0.85 (32 minhashes
make 64 tables of four), ten at 0.8.

Nodes joined by shared buckets form a cluster. Each is first compared with the least
node of its buckets, which joins most near copies. Of a cluster that this leaves in
parts, all parts but the largest are compared with everything, block against block: intersections
of a block are one product of 0/1 matrices in its task, and what leaves the task is a spanning forest of the
links found, never pairs. So no pair that shares a bucket is lost, and rows grow with
the members of a group, and with its size times those that are not near its largest part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import Scratch, mix, private_name, span_hashes, text_groups

SHINGLE = 5
# Least similarity of a link, unless a caller says otherwise.
SIMILARITY_PERCENT = 85
# Minhashes in a short key, and the bound of the probability that a link misses all tables.
DEPTH, MISSED = 2, 1e-4
# Sets of a cluster on each side of a comparison, and shingles that one matrix holds.
BLOCK, COLUMNS = 1024, 4096

_FOLD = np.uint64(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def collection_size(similarity: int) -> int:
    """Short keys in each of the two collections, so that links of so many percent are found."""
    keys = 1
    while 1 - (1 - (1 - (similarity / 100) ** DEPTH) ** keys) ** 2 > MISSED:
        keys += 1
    return keys


def short_names(keys: int) -> list[str]:
    return [f"h{i}" for i in range(2 * keys)]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a group of texts, and each text's first word."""
    data = _LOWER[data]
    inside = np.concatenate([~_SPACE[data], [False]])
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    before = np.concatenate([[False], inside[:-1]])
    starts = np.flatnonzero(inside & (~before | first))
    ends = np.flatnonzero(before & (~inside | first))
    return span_hashes(data, starts, ends), np.searchsorted(starts, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a group."""
    words, bounds = word_hashes(data, offsets)
    runs = max(0, len(words) - SHINGLE + 1)
    folded = np.zeros(runs, np.uint64)
    for i in range(SHINGLE):
        folded = folded * _FOLD + words[i : i + runs]
    folded = mix(folded)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            yield np.unique(folded[a : b - SHINGLE + 1])
        elif b > a:
            whole = np.full(1, b - a, np.uint64)
            for i in range(a, b):
                whole = mix(whole * _FOLD + words[i : i + 1])
            yield whole
        else:
            yield np.zeros(0, np.uint64)


def short_keys(shingles: np.ndarray, odd: np.ndarray, xor: np.ndarray) -> np.ndarray:
    """The short keys of a set, from minhashes with the given multipliers and masks."""
    least = np.full(len(odd), ~np.uint64(0))
    for at in range(0, len(shingles), 1 << 15):
        part = shingles[at : at + (1 << 15)]
        np.minimum(least, ((part[None, :] ^ xor[:, None]) * odd[:, None]).min(axis=1), out=least)
    short = np.zeros(len(odd) // DEPTH, np.uint64)
    for i in range(DEPTH):
        short = mix(short * _FOLD + least[i::DEPTH])
    return short.view(np.int64)


def set_id(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _signatures(keys: int):
    seeds = np.random.Generator(np.random.PCG64(977)).integers(0, 2**64, (2, 2 * keys * DEPTH), np.uint64)
    odd, xor = seeds[0] | np.uint64(1), seeds[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text_groups(batch.column(2)):
                sizes, ids, short = [], [], []
                for shingles in shingle_sets(data, offsets):
                    sizes.append(len(shingles))
                    ids.append(set_id(shingles) if len(shingles) else None)
                    short.append(short_keys(shingles, odd, xor))
                shorts = np.array(short).reshape(-1, 2 * keys).T
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i).slice(first, last - first) for i in range(2)),
                        pa.array(sizes, pa.int64()),
                        pa.array(ids, pa.binary()),
                        *(pa.array(np.ascontiguousarray(column)) for column in shorts),
                    ],
                    ["row", "key", "n_shingles", "set_id", *short_names(keys)],
                )

    return work


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sets of texts, if they are the sets that they are fetched for."""
    for batch in batches:
        for first, last, data, offsets in text_groups(batch.column(1)):
            wanted = batch.column(0).slice(first, last - first).to_pylist()
            found = [(name, s) for name, s in zip(wanted, shingle_sets(data, offsets), strict=True) if set_id(s) == name]
            sets = [s for _, s in found]
            bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
            values = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values))
            yield pa.RecordBatch.from_arrays([pa.array([name for name, _ in found], pa.binary()), lists], ["set_id", "shingles"])


def signatures(rows: DataFrame, keys: int) -> DataFrame:
    """Per row: its number, key, size and digest of its set (null if empty), and the short keys."""
    kind = rows.schema["key"].dataType.simpleString()
    shorts = ", ".join(f"{name} bigint" for name in short_names(keys))
    return rows.mapInArrow(_signatures(keys), f"row bigint, key {kind}, n_shingles bigint, set_id binary, {shorts}")


def table_keys(nodes: DataFrame, scratch: Scratch, keys: int) -> DataFrame:
    """Rows (bucket, set_id) of all buckets that can have two members.

    A table key is shared only if both its short keys are, so short keys that one
    node alone has are dropped before they are paired. Counts are written before
    they are joined: Spark can then cut a hot key's join partition.
    """
    short = F.posexplode(F.array(*short_names(keys))).alias("slot", "short")
    single = nodes.select("set_id", short)
    shared = scratch.keep(single.groupBy("slot", "short").agg(F.count("*").alias("n")).where("n > 1").drop("n"))
    live = (
        single.join(shared, ["slot", "short"])
        .groupBy("set_id")
        .agg(F.collect_list(F.when(F.col("slot") < keys, F.struct("slot", "short"))).alias("left"),
             F.collect_list(F.when(F.col("slot") >= keys, F.struct("slot", "short"))).alias("right"))
    )
    paired = live.select("set_id", F.explode("left").alias("a"), "right").select("set_id", "a", F.explode("right").alias("b"))
    return paired.select(F.xxhash64("a.slot", "a.short", "b.slot", "b.short").alias("bucket"), "set_id")


def star_pairs(buckets: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) that join the members of every bucket, about as many as there are nodes.

    A node ``b`` is joined to the least of its buckets' least members, ``a`` (the first frame), and that one to
    the others (the second); these are few, as the members of a group share them.
    """
    anchors = scratch.keep(buckets.groupBy("bucket").agg(F.min("set_id").alias("a")))
    pairs = scratch.keep(buckets.join(anchors, "bucket").where("a != set_id").select("a", F.col("set_id").alias("b")).distinct())
    least = scratch.keep(pairs.groupBy("b").agg(F.min("a").alias("least")))
    others = pairs.join(least, "b").where("a != least").select(F.col("least").alias("a"), F.col("a").alias("b")).distinct()
    return least.select(F.col("least").alias("a"), "b"), others


def linked(left: list[np.ndarray], right: list[np.ndarray], similarity: int = SIMILARITY_PERCENT) -> np.ndarray:
    """Which sets of two lists are similar enough, as a matrix."""
    sides = [left, right]
    sizes = [np.array([len(x) for x in side]) for side in sides]
    values, column, copies = np.unique(np.concatenate([*left, *right]), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(left) + len(right)), np.concatenate(sizes))
    # What is in one set only is in no intersection.
    keep = copies[column] > 1
    number = np.cumsum(copies > 1) - 1
    row, column = row[keep], number[column[keep]]
    shared = np.zeros((len(left), len(right)), np.int64)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        part = slice(*np.searchsorted(column, [at, at + COLUMNS]))
        has = np.zeros((len(left) + len(right), COLUMNS), np.float32)
        has[row[part], column[part] - at] = 1
        # A block's counts are small enough for float32; sums and products need not be.
        shared += (has[: len(left)] @ has[len(left) :].T).astype(np.int64)
    total = sizes[0][:, None] + sizes[1][None, :]
    return shared * (100 + similarity) >= total * similarity


def forest(links: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest, as (root, member), of a symmetric matrix of links."""
    left, edges = np.ones(len(links), bool), []
    for root in range(len(links)):
        if not left[root]:
            continue
        left[root] = False
        front = np.array([root])
        while len(front):
            front = np.flatnonzero(links[front].any(axis=0) & left)
            left[front] = False
            edges += [(root, member) for member in front.tolist()]
    return edges


def _compare_blocks(batches: Iterator[pa.RecordBatch], similarity: int) -> Iterator[pa.RecordBatch]:
    """A spanning forest of the links of each (cluster, i, j), whose rows come together."""
    held: list[pa.RecordBatch] = []

    def compare() -> pa.RecordBatch:
        block = pa.Table.from_batches(held).combine_chunks()
        held.clear()
        ids = block.column("set_id").to_pylist()
        sets = [np.asarray(x.values) for x in block.column("shingles").combine_chunks()]
        side, i, j = (np.asarray(block.column(c)) for c in ("side", "i", "j"))
        if i[0] == j[0]:
            links = linked(sets, sets, similarity)
        else:
            first, second = np.flatnonzero(side == i), np.flatnonzero(side == j)
            across = linked([sets[k] for k in first], [sets[k] for k in second], similarity)
            links = np.zeros((len(sets), len(sets)), bool)
            links[np.ix_(first, second)] = across
            links |= links.T
        edges = forest(links)
        return pa.RecordBatch.from_arrays([pa.array([ids[e[k]] for e in edges], pa.binary()) for k in (0, 1)], ["a", "b"])

    last = None
    for batch in batches:
        clusters = batch.column(batch.schema.get_field_index("cluster")).to_pylist()
        places = list(zip(clusters, *(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("i", "j")), strict=True))
        begin = 0
        for row in range(len(places) + 1):
            if row == len(places) or places[row] != last:
                if row > begin:
                    held.append(batch.slice(begin, row - begin))
                if row < len(places):
                    if held:
                        yield compare()
                    begin, last = row, places[row]
    if held:
        yield compare()


def compared(rows: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Links (a, b) that join what is linked within each (cluster, i, j) of (cluster, i, j, side, set_id)."""
    rows = rows.join(sets, "set_id").select("cluster", "i", "j", "side", "set_id", "shingles")
    rows = rows.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "side")
    return rows.mapInArrow(lambda batches: _compare_blocks(batches, similarity), "a binary, b binary")


def star_links(stars: DataFrame, sets: DataFrame, similarity: int, scratch: Scratch) -> DataFrame:
    """Which nodes ``b`` are linked to the one node ``a`` that each has in ``stars``; a node with many is met by blocks of them.

    The centre comes first in its blocks, so it is the root of their forests: a link's ``a`` is always the centre.
    """
    blocks = scratch.keep(stars.groupBy("a").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")))
    rows = stars.join(blocks, "a").withColumn("j", 1 + F.pmod(F.xxhash64("b"), "blocks").cast("int"))
    rows = rows.select(F.col("a").alias("cluster"), F.lit(0).alias("i"), "j", F.col("j").alias("side"), F.col("b").alias("set_id"))
    each = blocks.select("a", F.explode(F.sequence(F.lit(1), F.col("blocks"))).alias("j"))
    centres = each.select(F.col("a").alias("cluster"), F.lit(0).alias("i"), "j", F.lit(0).alias("side"), F.col("a").alias("set_id"))
    return compared(rows.union(centres), sets, similarity)


def block_links(clusters: DataFrame, sets: DataFrame, similarity: int, scratch: Scratch) -> DataFrame:
    """Links (a, b) that join all that is linked within clusters of (set_id, cluster, part).

    Members of the largest part are known to be joined; all others are compared with all members. Sizes are
    written before they are joined: Spark can then cut the partition of a large cluster.
    """
    parts = clusters.groupBy("cluster", "part").agg(F.count("*").alias("n"))
    sizes = parts.groupBy("cluster").agg(F.sum("n").alias("all"), F.max(F.struct("n", "part")).alias("largest")).select(
        "cluster", F.col("largest.part").alias("largest"),
        F.ceil(F.col("largest.n") / BLOCK).cast("int").alias("inner"),
        F.ceil((F.col("all") - F.col("largest.n")) / BLOCK).cast("int").alias("outer"),
    )
    rows = clusters.join(scratch.keep(sizes.where("outer > 0")), "cluster")
    is_inner, last = F.col("part") == F.col("largest"), F.col("inner") + F.col("outer") - 1
    hashed = F.xxhash64("set_id")
    side = F.when(is_inner, F.pmod(hashed, "inner")).otherwise(F.col("inner") + F.pmod(hashed, "outer")).cast("int")
    others = F.sequence(F.when(is_inner, F.col("inner")).otherwise(0), last)
    rows = rows.withColumn("side", side).withColumn("other", F.explode(others))
    rows = rows.select("cluster", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", "set_id")
    return compared(rows, sets, similarity)


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(set_id, label) of every linked node: the least set_id that it reaches.

    Labels fall to the least of the neighbours' and then to the label's own label,
    which halves the way to go, until none changes. Each round is a written table.
    """
    edges = scratch.keep(links.select("a", "b").union(links.select("b", "a")).distinct().toDF("u", "v"))
    labels = scratch.keep(edges.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("label")))
    while True:
        near = edges.join(labels.select(F.col("u").alias("v"), "label"), "v").groupBy("u").agg(F.min("label").alias("near"))
        lower = scratch.keep(labels.join(near, "u").select("u", "label", F.least("label", "near").alias("next")))
        jump = lower.select(F.col("u").alias("next"), F.col("next").alias("far"))
        step = scratch.keep(lower.join(jump, "next", "left").select("u", F.col("label").alias("old"), F.coalesce("far", "next").alias("label")))
        if step.where(F.col("old") != F.col("label")).isEmpty():
            return step.select(F.col("u").alias("set_id"), "label")
        labels = step.select("u", "label")


def near_duplicates(
    documents: DataFrame, key: str = "doc_id", text: str = "text", similarity: int = SIMILARITY_PERCENT
) -> DataFrame:
    """Per row: key, ``n_shingles``, ``component_id`` (least key reachable by links) and ``kept``.

    Sets are linked from a Jaccard similarity of ``similarity`` percent on.
    A null, empty or blank text has no shingles and stands alone; of several such
    rows each keeps its own key. Rows are told apart by their number, whatever their keys: rows without a
    key and rows that share one are linked like all others, each by its own text. A
    row is kept if its key is the component's, null if no row of it has a key. Null keys are never a component's
    least. Texts are read whole; other columns are not used. An empty table gives no rows.

    Texts are read twice and numbered as they come; if they do not come in the same order again (their
    sets show that), they are written with their numbers first.
    """
    scratch = Scratch(documents.sparkSession, "near-duplicates")
    rows = documents.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(text).cast("string").alias("text")
    )
    signed, nodes, buckets, sets = candidates(rows, similarity, scratch)
    if sets is None:
        signed, nodes, buckets, sets = candidates(scratch.keep(rows), similarity, scratch)

    stars, others = star_pairs(buckets, scratch)
    clusters = components(stars.union(others), scratch).withColumnRenamed("label", "cluster")
    links = scratch.keep(star_links(stars, sets, similarity, scratch))
    parts = links.select(F.col("b").alias("set_id"), F.col("a").alias("part"))
    known = clusters.join(parts, "set_id", "left").withColumn("part", F.coalesce("part", "set_id"))
    more = scratch.keep(block_links(scratch.keep(known), sets, similarity, scratch))
    labels = components(links.union(more), scratch)

    rooted = nodes.select("set_id", "least_key").join(labels, "set_id", "left").withColumn("label", F.coalesce("label", "set_id"))
    least = rooted.groupBy("label").agg(F.min("least_key").alias("component_id"))
    named = rooted.join(least, "label").select("set_id", "component_id")
    out = signed.select("key", "n_shingles", "set_id").join(named, "set_id", "left")
    # Only a row without shingles is its own component; a component without keys has none.
    component = F.when(F.col("set_id").isNull(), F.col("key")).otherwise(F.col("component_id"))
    out = out.select(F.col("key").alias(key), "n_shingles", component.alias("component_id"), F.col("key").eqNullSafe(component).alias("kept"))
    # The result is narrow; once it is written nothing else is needed.
    return scratch.keep_only(out)


def candidates(rows: DataFrame, similarity: int, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame | None]:
    """Signed rows, nodes, buckets with two members, and the nodes' full sets in them, all written.

    There are no sets if numbers told other texts apart when read again.
    """
    per_side = collection_size(similarity)
    signed = scratch.keep(signatures(rows, per_side))
    shorts = (F.max(name).alias(name) for name in short_names(per_side))
    nodes = signed.where("set_id is not null").groupBy("set_id").agg(F.min("row").alias("row"), F.min("key").alias("least_key"), *shorts)
    nodes = scratch.keep(nodes)
    keys = scratch.keep(table_keys(nodes, scratch, per_side))
    shared = scratch.keep(keys.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket"))
    buckets = scratch.keep(keys.join(shared, "bucket"))
    # Full sets of the nodes in some bucket, each from one row that has it.
    wanted = scratch.keep(buckets.select("set_id").distinct().join(nodes.select("set_id", "row"), "set_id"))
    chosen = rows.select("row", "text").join(wanted.hint("shuffle_hash"), "row").select("set_id", "text")
    sets = scratch.keep(chosen.mapInArrow(_full_sets, "set_id binary, shingles array<bigint>"))
    return signed, nodes, buckets, sets if sets.count() == wanted.count() else None


def one_of_each(documents: DataFrame, key: str = "doc_id", text: str = "text", similarity: int = SIMILARITY_PERCENT) -> DataFrame:
    """One row of each component with all its columns: the least key, rows without one last, of equal keys the first row.

    Rows are written with a number, judged and kept by it, so that null and repeated keys do no harm. Rows
    without shingles are no component and stay, each of them.
    """
    number = private_name(documents, "row")
    numbered = Scratch(documents.sparkSession, "near-duplicate-rows").keep(documents.withColumn(number, F.monotonically_increasing_id()))
    judged = near_duplicates(numbered, number, text, similarity).select(number, "component_id")
    order = F.struct(F.col(key).isNull(), F.col(key), F.col(number).alias("number"))
    best = judged.join(numbered.select(key, number), number).groupBy("component_id").agg(F.min(order).alias("best"))
    kept = best.select(F.col("best.number").alias(number))
    return numbered.join(kept, number, "left_semi").select(*documents.columns)
