"""A Merkle manifest of a dataset, with a proof for every row, by bitmap ranks.

Each row is a leaf, the hash of its fields. A leaf's place among those of its source is the rank of
its key, and no sort finds it: the keys of a source become bitmaps of 32,768 keys each (Parquet
compresses the sparse ones), a directory adds up their bit counts, and a key's rank is the
directory's sum plus the bits before its own. With places known, a level of
a tree is one aggregation: a node goes to the array of the run of sixteen it belongs to, at
the slot that its place gives. The arrays are kept. From the root
down, each array gives its nodes their siblings, so a leaf's proof meets the leaf at the end.

Sources, too, are numbered and reduced the same way. DataFrame expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.llm.common import Scratch

FANOUT = 16
# Keys of a bitmap as a power of two (its 4 KB are fixed by Spark), and bitmaps that one step of the directory adds up.
BITMAP_BITS, GROUP_BITS = 15, 15
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_PATH = "array<struct<left: string, right: string>>"


def encoded(column: Column) -> Column:
    """A field as text that no other value has: ``-`` for null, else its length in bytes, a colon and itself."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*(encoded(field) for field in fields)), 256)


def levels_of(nodes: int) -> int:
    """How often runs of sixteen become one until one node is left."""
    levels = 0
    while nodes > 1:
        nodes, levels = -(-nodes // FANOUT), levels + 1
    return levels


def numbered(frame: DataFrame, order: list[Column], scratch: Scratch) -> DataFrame:
    """The rows with their ``number`` in an order of all: sorted over many tasks, then the tasks' sizes are added up."""
    placed = scratch.keep(frame.orderBy(*order).withColumn("place", F.monotonically_increasing_id()))
    placed = placed.withColumn("task", F.shiftright("place", 33))
    ahead = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("task").agg(F.count("*").alias("rows"))
    bases = sizes.select("task", F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("base"))
    number = F.col("base") + F.col("place").bitwiseAND((1 << 33) - 1)
    return placed.join(bases, "task").withColumn("number", number).drop("task", "base", "place")


def rank_directory(counts: DataFrame, scratch: Scratch) -> DataFrame:
    """(src, bucket, bits, extras, base): a bitmap of the keys of each bucket, and the rows of the source before it.

    ``counts`` has the rows ``n`` of each (src, key). ``extras`` lists bits whose keys have more rows than one,
    which the bitmap cannot count. Rows without a key come before all others. Sums run over the buckets of a
    group, then over the groups of a source.
    """
    keyed = counts.where("key is not null").select(
        "src", "n", F.shiftright("key", BITMAP_BITS).alias("bucket"), F.col("key").bitwiseAND((1 << BITMAP_BITS) - 1).alias("bit")
    )
    more = F.when(F.col("n") > 1, F.struct("bit", (F.col("n") - 1).alias("more")))
    buckets = scratch.keep(
        keyed.groupBy("src", "bucket").agg(
            F.bitmap_construct_agg("bit").alias("bits"), F.sum("n").alias("rows"), F.collect_list(more).alias("extras")
        )
    )
    buckets = buckets.withColumn("bucket_group", F.shiftright("bucket", GROUP_BITS))
    ahead = (Window.unboundedPreceding, -1)
    groups = buckets.groupBy("src", "bucket_group").agg(F.sum("rows").alias("rows")).select(
        "src", "bucket_group",
        F.coalesce(F.sum("rows").over(Window.partitionBy("src").orderBy("bucket_group").rowsBetween(*ahead)), F.lit(0)).alias("group_base"),
    )
    keyless = counts.where("key is null").select("src", F.col("n").alias("keyless"))
    within = F.sum("rows").over(Window.partitionBy("src", "bucket_group").orderBy("bucket").rowsBetween(*ahead))
    summed = buckets.withColumn("within", F.coalesce(within, F.lit(0))).join(groups, ["src", "bucket_group"]).join(keyless, "src", "left")
    base = F.col("within") + F.col("group_base") + F.coalesce("keyless", F.lit(0))
    return scratch.keep(summed.select("src", "bucket", "bits", "extras", base.alias("base")))


def rank(key: Column) -> Column:
    """The rank of a key from its row of the directory: whole bytes of the bitmap, then the bits of its own byte."""
    bit = key.bitwiseAND((1 << BITMAP_BITS) - 1).cast("int")
    whole = F.bitmap_count(F.substring("bits", F.lit(1), F.floor(bit / 8).cast("int")))
    byte = F.conv(F.hex(F.substring("bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    # The byte's bits before the key's, moved up so that the others fall out of its eight.
    before = F.bit_count(F.pmod(byte * F.pow(F.lit(2), 8 - bit % 8), F.lit(256)).cast("int"))
    extras = F.aggregate("extras", F.lit(0).cast("bigint"), lambda total, x: total + F.when(x["bit"] < bit, x["more"]).otherwise(0))
    return F.col("base") + whole + before + extras


def placed_leaves(leaves: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The leaves with ``at``, their place in their source, and the rows ``n`` of each source.

    Rows of one key come by their hashes; only those are sorted.
    """
    counts = scratch.keep(leaves.groupBy("src", "key").agg(F.count("*").alias("n")))
    directory = rank_directory(counts, scratch)
    tied = scratch.keep(counts.where("n > 1 or key is null").select("src", "key"))
    rows = leaves.withColumn("tie", F.lit(0).cast("bigint"))
    if not tied.isEmpty():
        tied = tied.select(F.col("src").alias("tied_src"), F.col("key").alias("tied_key"))
        same = (F.col("src") == F.col("tied_src")) & F.col("key").eqNullSafe(F.col("tied_key"))
        sorted_ties = scratch.keep(numbered(leaves.join(tied, same, "left_semi"), [F.col(c) for c in ("src", "key", "leaf")], scratch))
        first = sorted_ties.groupBy(F.col("src").alias("tied_src"), F.col("key").alias("tied_key")).agg(F.min("number").alias("first"))
        ties = sorted_ties.join(first, same).withColumn("tie", F.col("number") - F.col("first")).select(*rows.columns)
        rows = rows.join(tied, same, "left_anti").union(ties)
    keyed = rows.withColumn("bucket", F.shiftright("key", BITMAP_BITS)).join(directory, ["src", "bucket"], "left")
    # What has no key is in no bucket and is placed by its number among such rows alone.
    at = F.coalesce(rank(F.col("key")), F.lit(0)) + F.col("tie")
    sizes = counts.groupBy("src").agg(F.sum("n").alias("n"))
    return keyed.select(*leaves.columns, at.alias("at")), scratch.keep(sizes)


def slot_arrays(nodes: DataFrame, payload: list[str], scratch: Scratch) -> DataFrame:
    """One row for each run of sixteen nodes: its tree, its place, and the array of its nodes by slot.

    ``nodes`` has (src, n, at, digest), n being the tree's nodes on this level.
    """
    slot = F.struct((F.col("at") % FANOUT).alias("slot"), "digest", *payload)
    arrays = nodes.groupBy("src", "n", F.floor(F.col("at") / FANOUT).alias("up")).agg(F.array_sort(F.collect_list(slot)).alias("slots"))
    return scratch.keep(arrays)


def joined(slots: Column) -> Column:
    return F.concat_ws("", F.transform(slots, lambda x: x["digest"]))


def parents(arrays: DataFrame) -> DataFrame:
    """The nodes of the next level. A tree's only node stays what it is."""
    digest = F.when(F.col("n") == 1, F.col("slots")[0]["digest"]).otherwise(F.sha2(joined(F.col("slots")), 256))
    return arrays.select("src", F.ceil(F.col("n") / FANOUT).alias("n"), F.col("up").alias("at"), digest.alias("digest"))


def children(arrays: DataFrame, paths: DataFrame) -> DataFrame:
    """The nodes in the arrays, with their paths: siblings left and right, level by level.

    ``paths`` has the path of each array's own node by (src, at).
    """
    known = arrays.join(paths.withColumnRenamed("at", "up"), ["src", "up"])
    each = known.select("*", F.posexplode("slots").alias("pos", "node"))
    left, right = (joined(F.slice("slots", begin, length)) for begin, length in ((F.lit(1), F.col("pos")), (F.col("pos") + 2, F.lit(FANOUT))))
    own = F.array(F.struct(left.alias("left"), right.alias("right"))).cast(_PATH)
    path = F.when(F.col("n") == 1, F.col("path")).otherwise(F.concat(own, F.col("path")))
    at = F.col("up") * FANOUT + F.col("node.slot")
    kept = [c for c in paths.columns if c not in ("src", "at", "path")]
    return each.select("src", at.alias("at"), path.alias("path"), *kept, "node.*").drop("slot")


def manifest(documents: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Per row: key, ``leaf``, ``subroot`` of its source, ``root``, ``path`` from leaf to root, and ``bent``.

    ``fields`` are the columns hashed, in their order; the first is the key, a whole number, the second the source, the last the text.
    ``path`` lists the hashes left and right of the node on each level, joined. ``bent`` is the leaf with
    A-Z of its text lower-cased, where 5 divides the CRC-32 of the decimal key (never without a key), else null.

    Any field may be null; rows without a key come first in their source, rows of one key by
    their leaves, so repeated rows have equal leaves and places of their own. Other columns are not used. An empty table gives
    no rows.
    """
    if not isinstance(documents.schema[fields[0]].dataType, T.IntegralType):
        raise ValueError(f"{fields[0]} is not a whole number")
    scratch = Scratch(documents.sparkSession, "manifest")
    raw = [F.col(f"`{name}`") for name in fields]
    bent = [*raw[:-1], F.translate(raw[-1].cast("string"), UPPER, LOWER)]
    chosen = F.crc32(raw[0].cast("string").cast("binary")) % 5 == 0
    leaves = scratch.keep(
        documents.select(
            raw[0].cast("bigint").alias("key"), raw[1].cast("string").alias("source"), encoded(raw[1]).alias("src"),
            leaf_hash(raw).alias("leaf"), F.when(chosen, leaf_hash(bent)).alias("bent"),
        )
    )
    rows, sizes = placed_leaves(leaves.drop("source"), scratch)
    largest = sizes.agg(F.max("n")).first()[0]

    # Up the trees of all sources together, a level at a time, then up the tree of sources.
    nodes = rows.join(sizes, "src").withColumn("digest", F.col("leaf"))
    own = [slot_arrays(nodes, ["key", "bent"], scratch)]
    for _ in range(1, levels_of(largest or 0)):
        own.append(slot_arrays(parents(own[-1]), [], scratch))
    subroots = scratch.keep(parents(own[-1]).select("src", F.col("digest").alias("subroot")))
    names = leaves.groupBy("src").agg(F.max("source").alias("source"))
    order = scratch.keep(numbered(names, [F.col("source").asc_nulls_first()], scratch).select("src", F.col("number").alias("at")))
    top = subroots.join(order, "src").select(
        F.lit("").alias("src"), F.lit(order.count()).alias("n"), "at", F.col("subroot").alias("digest")
    )
    above = [slot_arrays(top, [], scratch)]
    for _ in range(1, levels_of(order.count())):
        above.append(slot_arrays(parents(above[-1]), [], scratch))

    # Down again: each array hands its nodes the path of their parent and their siblings.
    paths = parents(above[-1]).select("src", "at", F.array().cast(_PATH).alias("path"), F.col("digest").alias("root"))
    for arrays in reversed(above):
        paths = children(arrays, paths).drop("digest")
    paths = paths.drop("src").join(order, "at").join(subroots, "src").select("src", F.lit(0).cast("bigint").alias("at"), "path", "root", "subroot")
    for arrays in reversed(own[1:]):
        paths = children(arrays, paths).drop("digest")
    found = children(own[0], paths)
    return found.select(F.col("key").alias(fields[0]), F.col("digest").alias("leaf"), "subroot", "root", "path", "bent")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a path lead to."""
    return F.aggregate(path, leaf, lambda digest, x: F.sha2(F.concat(x["left"], digest, x["right"]), 256))


def digest(proofs: DataFrame) -> DataFrame:
    """Proofs as checksums, and whether the leaf (the bent one where there is one) leads to the root."""
    siblings = F.concat_ws("", F.transform("path", lambda x: F.concat(x["left"], x["right"])))
    end = folded(F.coalesce("bent", "leaf"), F.col("path"))
    return proofs.select(
        proofs.columns[0], "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), end.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
