"""Nearest neighbours by inner product with a forest of random-projection trees.

Equal vectors are one class, so a vector that a third of the rows share is
indexed once. Each tree splits a bounded sample at the median of its projections
on a random direction (the difference of two drawn points, drawn to their sides'
means); every class is then led to its leaf in every tree. A query walks all
trees with one priority queue, cheapest crossing of splits first, until the
leaves it has reached hold enough classes. Leaves of a tree that lie together are
a bucket: a query's vector goes once to each bucket that it visits, with the leaves
it visits there. Leaves are scored block-wise in double precision, first the best
few of each query, whose worst kept score then bounds what the others need to report.

Inner product becomes distance by one more coordinate, sqrt(M^2 - |x|^2) for
classes and 0 for queries, where M is the largest norm.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.session import scratch_path

TOP = 20
EVERY = 20
TREES, LEAF = 10, 128
# Bound of the sample that the splits are fitted on; every row is indexed all the same.
SAMPLE_ROWS = 65_536
# Leaves are visited until they hold so many classes times their number to this power, counted with repeats over the
# trees. On vectors without any structure this keeps recall at 0.92 or more, from 2,000 classes to 51,000.
VISITS, VISIT_POWER = 7.5, 0.75
# Leaves whose scores set a query's bound.
FIRST_LEAVES = 8
# Classes of one leaf that one task scores at once, and queries scored against them at once; a block's product has 32 MB.
BLOCK, QUERY_BLOCK = 4096, 1024
# Leaves that lie together are scored by one task, up to so many classes; a larger leaf is dealt over several.
BUCKET = 32_768
# Queries that visit a bucket are dealt over so many tasks that none is expected to get more than these.
MOST_QUERIES = 65_536
# Queries that a task leads through the trees, and how many of them at once; rows of visits that are dealt to buckets at once.
TASK_QUERIES, SOME_QUERIES, SOME_VISITS = 256, 32, 512
# Scored pairs that a bucket holds before it drops all but the best of each query.
HELD_PAIRS = 1 << 20
SEED = 11


@dataclass(frozen=True)
class Tree:
    """Splits (direction, threshold, children) and leaf sizes; a child below 0 is leaf ``-child - 1``."""

    directions: np.ndarray
    thresholds: np.ndarray
    children: np.ndarray
    sizes: np.ndarray

    def leaves(self, points: np.ndarray) -> np.ndarray:
        at = np.zeros(len(points), np.int64) if len(self.thresholds) else np.full(len(points), -1)
        while (open_rows := np.flatnonzero(at >= 0)).size:
            node = at[open_rows]
            side = np.einsum("ij,ij->i", points[open_rows], self.directions[node]) > self.thresholds[node]
            at[open_rows] = self.children[node, side.astype(int)]
        return -at - 1


def grow(points: np.ndarray, leaf: int, seed: int) -> Tree:
    """A tree over the sample; splits are at the median, so its depth is the logarithm of its leaves."""
    draw = np.random.default_rng(seed)
    directions, thresholds, children, sizes = [], [], [], []

    def split(rows: np.ndarray) -> int:
        own = points[rows]
        a, b = own[draw.choice(len(rows), 2, replace=False)]
        for _ in range(3):
            side = own @ (a - b) > (a @ a - b @ b) / 2
            if side.any() and not side.all():
                a, b = own[side].mean(axis=0), own[~side].mean(axis=0)
        direction = a - b
        length = np.linalg.norm(direction)
        direction = direction / length if length > 0 else draw.normal(size=points.shape[1])
        shadow = own @ direction
        threshold = float(np.median(shadow))
        side = shadow > threshold
        if side.all() or not side.any():
            return leaf_of(rows)
        me = len(thresholds)
        directions.append(direction)
        thresholds.append(threshold)
        children.append([0, 0])
        children[me] = [grown(rows[~side]), grown(rows[side])]
        return me

    def leaf_of(rows: np.ndarray) -> int:
        sizes.append(len(rows))
        return -len(sizes)

    def grown(rows: np.ndarray) -> int:
        return leaf_of(rows) if len(rows) <= leaf else split(rows)

    grown(np.arange(len(points)))
    return Tree(
        np.array(directions).reshape(-1, points.shape[1]), np.array(thresholds), np.array(children, np.int64).reshape(-1, 2), np.array(sizes, np.int64)
    )


def search(trees: list[Tree], scale: float, query: np.ndarray, enough: float) -> list[tuple[int, int]]:
    """(tree, leaf) in order of the squared margins crossed to get there, until they hold enough classes."""
    queue = [(0.0, t, 0 if len(tree.thresholds) else -1) for t, tree in enumerate(trees)]
    heapq.heapify(queue)
    found, held = [], 0.0
    shadows = [tree.directions @ query - tree.thresholds if len(tree.thresholds) else None for tree in trees]
    while queue and held < enough:
        cost, t, node = heapq.heappop(queue)
        tree = trees[t]
        while node >= 0:
            margin = shadows[t][node]
            near = int(margin > 0)
            heapq.heappush(queue, (cost + float(margin) ** 2, t, int(tree.children[node, 1 - near])))
            node = int(tree.children[node, near])
        found.append((t, -node - 1))
        held += tree.sizes[-node - 1] * scale
    return found


def _vectors(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(-1, width)


def _lift(points: np.ndarray, largest: float) -> np.ndarray:
    rest = np.maximum(largest**2 - np.einsum("ij,ij->i", points, points), 0)
    return np.column_stack([points, np.sqrt(rest)])


@dataclass(frozen=True)
class Buckets:
    """Of each leaf, numbered through all trees: its bucket, and over how many from there on it is dealt."""

    bases: np.ndarray
    bucket: np.ndarray
    pieces: np.ndarray


def buckets_of(sizes: list[np.ndarray], most: float = BUCKET) -> Buckets:
    """Leaves of one tree fill a bucket one after another; ``sizes`` are the classes expected in the leaves of each tree."""
    bucket, pieces, following = [], [], 0
    for tree in sizes:
        room = 0.0
        for size in tree.tolist():
            count = max(1, int(np.ceil(size / most)))
            if count > 1 or size > room or not room:
                bucket.append(following)
                following += count
                room = most - size if count == 1 else 0.0
            else:
                bucket.append(following - 1)
                room -= size
            pieces.append(count)
    bases = np.concatenate([[0], np.cumsum([len(x) for x in sizes])]).astype(np.int64)
    return Buckets(bases, np.array(bucket, np.int32), np.array(pieces, np.int32))


def visits(classes: int, times: float = VISITS, power: float = VISIT_POWER) -> float:
    """Classes that a query's leaves hold in all; grows slower than the classes."""
    return times * classes**power


def slices_of(queries: int, classes: int, enough: float, trees: int, most: int = MOST_QUERIES) -> int:
    """Parts of the queries, so that of each part at most so many are expected to visit any bucket."""
    share = min(1.0, BUCKET * enough / max(1, trees * classes))
    return max(1, int(np.ceil(queries * share / most)))


def _lists(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), pa.array(values.astype(np.int32)))


def _index(trees, buckets: Buckets, width: int, largest: float, slices: int):
    """Class, vector and least key as they come, and the places of a class: in each tree one, for each part of the queries."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _lift(_vectors(batch.column(1), width), largest)
            spread = np.asarray(batch.column(3))
            leaves = np.stack([base + tree.leaves(points) for base, tree in zip(buckets.bases, trees.value, strict=False)], axis=1)
            bucket = buckets.bucket[leaves] + (spread[:, None] % buckets.pieces[leaves]).astype(np.int32)
            count = leaves.size
            keys = [np.repeat(bucket.ravel(), slices), np.tile(np.arange(slices), count), np.repeat(leaves.ravel(), slices)]
            places = pa.StructArray.from_arrays([pa.array(k.astype(np.int32)) for k in keys], ["bucket", "part", "leaf"])
            starts = pa.array((np.arange(len(leaves) + 1) * leaves.shape[1] * slices).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.ListArray.from_arrays(starts, places)], ["class_id", "vector", "least_id", "places"])

    return work


def _probe(trees, buckets: Buckets, scale: float, width: int, enough: float, slices: int):
    """For each query and tree the leaves it visits: those among its first few of all trees, and the others."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SOME_QUERIES):
                batch = whole.slice(at, SOME_QUERIES)
                points = np.column_stack([_vectors(batch.column(1), width), np.zeros(batch.num_rows)])
                rows, parts = [], ([], [])
                for i, query in enumerate(points):
                    found = np.array(search(trees.value, scale, query, enough), np.int64).reshape(-1, 2)
                    leaves, early = buckets.bases[found[:, 0]] + found[:, 1], np.arange(len(found)) < FIRST_LEAVES
                    for t in np.unique(found[:, 0]):
                        rows.append(i)
                        for part, chosen in zip(parts, (early, ~early), strict=True):
                            part.append(leaves[(found[:, 0] == t) & chosen])
                if rows:
                    lists = [_lists(np.concatenate(part), np.array([len(x) for x in part])) for part in parts]
                    taken = [batch.column(k).take(pa.array(rows, pa.int64())) for k in range(2)]
                    part = pa.array((np.asarray(batch.column(2)) % slices)[rows].astype(np.int32))
                    yield pa.RecordBatch.from_arrays([*taken, part, *lists], ["query_class", "query", "part", "early", "late"])

    return work


def _ask(buckets: Buckets):
    """A row for each query and bucket: what the query visits there. Columns query_class, query, part, bound, leaves."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SOME_VISITS):
                batch = whole.slice(at, SOME_VISITS)
                row = np.repeat(np.arange(batch.num_rows), np.asarray(pc.list_value_length(batch.column(4))))
                leaf = np.asarray(batch.column(4).flatten())
                pieces = buckets.pieces[leaf]
                # A leaf that is dealt over several buckets is asked for in each.
                which = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                row, leaf = np.repeat(row, pieces), np.repeat(leaf, pieces)
                bucket = buckets.bucket[leaf] + which
                order = np.lexsort((leaf, bucket, row))
                row, leaf, bucket = row[order], leaf[order], bucket[order]
                new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (bucket[1:] != bucket[:-1])])[: len(row)])
                taken = [batch.column(k).take(pa.array(row[new])) for k in (2, 0, 1, 3)]
                lists = _lists(leaf, np.diff(np.concatenate([new, [len(row)]])))
                yield pa.RecordBatch.from_arrays([pa.array(bucket[new].astype(np.int32)), *taken, lists], ["bucket", "part", "query_class", "query", "bound", "leaves"])

    return work


def _best(q: np.ndarray, v: np.ndarray, exact: np.ndarray, least: np.ndarray, keep: int) -> tuple[np.ndarray, ...]:
    """Of each query the pairs that score best, in order; ties go to the smaller key."""
    order = np.lexsort((least[v], -exact, q))
    q, v, exact = q[order], v[order], exact[order]
    best = np.arange(len(q)) - np.searchsorted(q, q) < keep
    return q[best], v[best], exact[best]


def _score_bucket(width: int, keep: int):
    names = ["query_class", "class_id", "least_id", "score"]
    empty = pa.table({n: pa.array([], pa.float64() if n == "score" else pa.int64()) for n in names})

    def work(index: pa.Table, asked: pa.Table) -> pa.Table:
        if not index.num_rows or not asked.num_rows:
            return empty
        index, asked = index.combine_chunks(), asked.combine_chunks()
        # Classes and visits in order of leaves.
        index = index.take(pa.array(np.argsort(np.asarray(index.column("leaf")), kind="stable")))
        vectors, queries = (_vectors(t.column(c).combine_chunks(), width) for t, c in ((index, "vector"), (asked, "query")))
        lists = asked.column("leaves").combine_chunks()
        visited = np.asarray(lists.flatten())
        order = np.argsort(visited, kind="stable")
        visitor, visited = np.repeat(np.arange(len(queries)), np.asarray(pc.list_value_length(lists)))[order], visited[order]
        bounds, least = np.array(asked.column("bound")), np.asarray(index.column("least_id"))
        leaves, begins = np.unique(np.asarray(index.column("leaf")), return_index=True)
        ends = np.append(begins[1:], len(vectors))
        from_, to = np.searchsorted(visited, leaves), np.searchsorted(visited, leaves, "right")
        found, held = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))], 0
        for k in np.flatnonzero(to > from_):
            for first in range(begins[k], ends[k], BLOCK):
                own = vectors[first : min(first + BLOCK, ends[k])]
                for at in range(from_[k], to[k], QUERY_BLOCK):
                    rows = visitor[at : min(at + QUERY_BLOCK, to[k])]
                    some, bound = queries[rows], bounds[rows]
                    rough = some @ own.T
                    if len(own) > keep and (free := np.flatnonzero(bound == -np.inf)).size:
                        bound[free] = np.partition(rough[free], -keep, axis=1)[:, -keep]
                    # The rounding of a block product may differ from that of the exact score.
                    q, v = np.nonzero(rough >= (bound - 1e-9 * (1 + np.abs(bound)))[:, None])
                    found.append((rows[q], v + first, (some[q] * own[v]).sum(axis=1)))
                    held += len(q)
                    if held > HELD_PAIRS:
                        found = [_best(*map(np.concatenate, zip(*found, strict=True)), least, keep)]
                        held = 0
        q, v, exact = _best(*map(np.concatenate, zip(*found, strict=True)), least, keep)
        columns = [asked.column("query_class").combine_chunks().take(pa.array(q)), index.column("class_id").combine_chunks().take(pa.array(v))]
        return pa.table([*columns, pa.array(least[v], pa.int64()), pa.array(exact)], names=names)

    return work


def usable(embeddings: DataFrame, key: str, vector: str) -> tuple[DataFrame, int]:
    """Rows (vec_id, vector) that take part, and the vectors' length: the commonest one."""
    kind = embeddings.select(F.col(vector)).schema[0].dataType
    # What is single precision is sent as such and scored in double precision.
    kind = "array<float>" if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else "array<double>"
    rows = embeddings.select(F.col(key).cast("bigint").alias("vec_id"), F.col(vector).cast(kind).alias("vector")).where("vec_id is not null and vector is not null")
    common = rows.groupBy(F.size("vector").alias("width")).count().where("width > 0").orderBy(F.desc("count"), "width").first()
    width = common.width if common else 1
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("vector", lambda x: x != 0)
    return rows.where((F.size("vector") == width) & ~F.coalesce(bad, F.lit(True)) & some), width


def nearest(
    embeddings: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    every: int = EVERY,
    top: int = TOP,
    trees: int = TREES,
    leaf: int = LEAF,
    sample_rows: int = SAMPLE_ROWS,
    times: float = VISITS,
    power: float = VISIT_POWER,
) -> DataFrame:
    """The ``top`` best found for each row whose key is divisible by ``every``, against all other rows.

    Columns query_id, rank, vec_id, score; ties go to the smaller key. Null keys
    and vectors that are null, zero, of another length, or hold null or non-finite
    numbers take no part. Rows repeated in full are one row, rows of one key no neighbours of each other. An empty table gives
    no rows. Other columns are not used.

    Of equal vectors only the ``top`` + 1 smallest keys can be in a result, so a
    class carries no more; that is exact.
    """
    spark = embeddings.sparkSession
    root = scratch_path(spark, "neighbours")

    def kept(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{root}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{root}/{name}")

    rows, width = usable(embeddings, key, vector)
    kind = rows.schema["vector"].dataType.simpleString()
    wide = F.col("vector").cast("array<double>")
    named = rows.withColumn("class_name", F.concat(F.hex(F.xxhash64(wide)), F.hex(F.xxhash64(F.lit(SEED), wide))))
    named = kept(named.distinct(), "rows")
    smallest = named.withColumn("place", F.row_number().over(Window.partitionBy("class_name").orderBy("vec_id"))).where(F.col("place") <= top + 1)
    classes = smallest.groupBy("class_name").agg(F.first("vector").alias("vector"), F.array_sort(F.collect_list("vec_id")).alias("ids"))
    classes = classes.withColumns({"least_id": F.col("ids")[0], "spread": F.abs(F.xxhash64("class_name") % (1 << 40)), "class_id": F.monotonically_increasing_id()})
    classes = kept(classes, "classes")
    queries = named.where(F.col("vec_id") % every == 0).select("vec_id", "class_name").join(classes.select("class_name", "class_id"), "class_name")
    queries = kept(queries.select("vec_id", "class_id"), "queries")
    asked = queries.select("class_id").distinct().join(classes.select("class_id", "vector", "spread"), "class_id")

    squares = F.aggregate(wide, F.lit(0.0), lambda a, x: a + x * x)
    size = classes.agg(F.count("*").alias("n"), F.sqrt(F.max(squares)).alias("largest")).first()
    total, largest = size.n, float(size.largest or 0.0)
    scale = total / max(1, min(total, sample_rows))
    small = max(8, int(leaf / max(1.0, scale)))
    parts = ["directions", "thresholds", "children", "sizes"]

    def grow_one(sample: pa.Table) -> pa.Table:
        t = sample.column("t")[0].as_py()
        sample = sample.combine_chunks().sort_by("spread")
        tree = grow(_lift(_vectors(sample.column("vector").combine_chunks(), width), largest), small, SEED + t)
        return pa.table([pa.array([t]), *(pa.array([getattr(tree, p).tobytes()], pa.binary()) for p in parts)], names=["t", *parts])

    # Each tree is grown by a task of its own; only trees come to the driver.
    sample = kept(classes.orderBy("spread").limit(sample_rows).select("spread", "vector"), "sample")
    sample = sample.withColumn("t", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(trees - 1).cast("bigint"))))
    grown = sample.repartitionByRange(trees, "t").groupBy("t").applyInArrow(grow_one, "t long, " + ", ".join(f"{p} binary" for p in parts)).collect()
    forest = [
        Tree(
            np.frombuffer(r.directions, np.float64).reshape(-1, width + 1), np.frombuffer(r.thresholds, np.float64),
            np.frombuffer(r.children, np.int64).reshape(-1, 2), np.frombuffer(r.sizes, np.int64),
        )
        for r in sorted(grown, key=lambda r: r.t)
    ] or [grow(np.zeros((0, width + 1)), small, SEED + t) for t in range(trees)]
    buckets = buckets_of([tree.sizes * scale for tree in forest])
    forest = spark.sparkContext.broadcast(forest)

    place = ["bucket", "part"]
    enough = visits(total, times, power)
    count = asked.count()
    slices = slices_of(count, total, enough, trees)
    index = kept(
        classes.select("class_id", "vector", "least_id", "spread").mapInArrow(
            _index(forest, buckets, width, largest, slices), f"class_id bigint, vector {kind}, least_id bigint, places array<struct<bucket:int,part:int,leaf:int>>"
        ),
        "index",
    ).select("class_id", "vector", "least_id", F.inline("places"))
    probes = kept(
        asked.select("class_id", "vector", "spread").repartition(max(1, -(-count // TASK_QUERIES)), "class_id").mapInArrow(
            _probe(forest, buckets, scale, width, enough, slices), f"query_class bigint, query {kind}, part int, early array<int>, late array<int>"
        ),
        "probes",
    )

    def scored(some: DataFrame, leaves: str) -> DataFrame:
        some = some.where(F.size(leaves) > 0).select("query_class", "query", "part", "bound", leaves)
        some = some.mapInArrow(_ask(buckets), f"bucket int, part int, query_class bigint, query {kind}, bound double, leaves array<int>")
        return index.groupBy(*place).cogroup(some.groupBy(*place)).applyInArrow(
            _score_bucket(width, top + 1), "query_class bigint, class_id bigint, least_id bigint, score double"
        )

    best = Window.partitionBy("query_class").orderBy(F.desc("score"), "least_id")

    def top_classes(found: DataFrame) -> DataFrame:
        once = found.dropDuplicates(["query_class", "class_id"])
        return once.withColumn("place", F.row_number().over(best)).where(F.col("place") <= top + 1)

    open_bound = F.lit(float("-inf"))
    first = kept(top_classes(scored(probes.withColumn("bound", open_bound), "early")), "first")
    bound = first.where(F.col("place") == top + 1).select("query_class", F.col("score").alias("worst"))
    rest = probes.join(bound, "query_class", "left").withColumn("bound", F.coalesce("worst", open_bound))
    found = kept(top_classes(first.drop("place").unionByName(scored(rest, "late"))).select("query_class", "class_id", "score"), "found")

    members = found.join(classes.select("class_id", "ids"), "class_id").select("query_class", "score", F.explode("ids").alias("vec_id"))
    members = members.withColumn("place", F.row_number().over(Window.partitionBy("query_class").orderBy(F.desc("score"), "vec_id"))).where(F.col("place") <= top + 1)
    pairs = queries.select(F.col("vec_id").alias("query_id"), F.col("class_id").alias("query_class")).join(members.drop("place"), "query_class").where("query_id != vec_id")
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
