"""Toxicity by compression distance: which of two zstandard dictionaries shortens a text's windows more.

A window is a word with its spaces, its letters coded with their place in it, two bytes each, so that only
beginnings match. The ordinary dictionary is trained by zstandard on the words of ordinary text.
The toxic one holds every beginning and word that a test on the sampled documents finds
telling, up to the usual size of a dictionary. Trained by frequency alone it would hold what all text
has in common: zstandard's own choice from toxic text tells the classes apart hardly better than chance.

Every window of a whole text is compressed with both dictionaries, each different word once in a
worker. A window that the toxic dictionary shortens by at least so many bytes more is a hit; how many
is calibrated. The score is the smoothed share of toxic documents among labelled ones with about as many hits and
windows; the threshold is the one under which the scores of labelled documents are likeliest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import Scratch, private_name
from ordermill.session import drop_folder, scratch_path

LIMIT = 0.3
HELD_OUT = 2
# Bound of the labelled rows that the dictionaries are trained on, for each class.
SAMPLE_ROWS = {1: 4000, 0: 8000}
# Bytes of a dictionary: zstandard's usual size. The ordinary one is so many times as large as the toxic one, up to that.
DICTIONARY_BYTES, ORDINARY_TIMES, ORDINARY_LEAST = 112_640, 8, 1024
# A string is telling if it is so many times as frequent in its class's documents, and by a G test not by
# chance: one in ten million strings without a meaning passes.
RATIO, SIGNIFICANCE = 6.0, 28.0
# Beginnings of so many bytes are tried, and whole words up to so many; longer words are known by their beginnings.
BEGINNINGS, LONGEST_WORD = range(3, 17), 64
# What a match costs, in letters; more letters than the second make a string no more telling.
MATCH_COST, MOST_LETTERS = 2, 9
# Words and made-up documents that the ordinary dictionary is trained on.
TRAINING_WORDS, TRAINING_DOCUMENTS = 1 << 15, 512
# Thresholds tried, in bytes.
THRESHOLDS = range(1, 13)
PRIOR = 2.0
# Words whose distance a worker remembers.
KNOWN_WORDS = 1 << 18
# Bins of hits and of windows; a bin doubles the one before.
HIT_BINS, SIZE_BINS = 66, 65

_CLEAN = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


@dataclass(frozen=True)
class Model:
    """Contents of the two dictionaries, the threshold of a hit, and toxic and ordinary labelled documents by (hits, size)."""

    toxic: bytes
    ordinary: bytes
    threshold: int = 1
    counts: tuple[tuple[int, int, int, int], ...] = ()


def normalise(text: str | None) -> bytes:
    """Lower-case words with one space around each."""
    words = (text or "").lower().encode().translate(_CLEAN).split()
    return b" " + b" ".join(words) + b" " if words else b""


def strings_of(line: bytes) -> set[bytes]:
    """What may go into a dictionary: the beginnings of each word, and whole words, with their spaces."""
    found: set[bytes] = set()
    for word in set(line.split()):
        found.update(b" " + word[:k] for k in BEGINNINGS if k <= len(word))
        if len(word) <= LONGEST_WORD:
            found.add(b" " + word + b" ")
    return found


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [normalise(text).split() for text in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.list_(pa.binary()))], ["toxic", "words"])


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for toxic, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found = list(strings_of(b" ".join(words)))
            yield pa.RecordBatch.from_arrays([pa.array([toxic] * len(found), pa.int32()), pa.array(found, pa.binary())], ["toxic", "string"])


def held_out(key: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def training_labels(labels: DataFrame, key: str) -> DataFrame:
    """One label for each key that may be learned from; a key with both labels counts as toxic."""
    usable = labels.where(F.col(key).isNotNull() & F.col("toxic").isNotNull()).where(~held_out(key))
    return usable.groupBy(key).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))


def significance(own: str, other: str, own_rows: float, other_rows: float) -> Column:
    """The G statistic of a string's documents in two classes against the same rate in both."""
    rate = (F.col(own) + F.col(other)) / (own_rows + other_rows)

    def term(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    terms = [
        term(part, F.lit(float(rows)) * share)
        for name, rows in ((own, own_rows), (other, other_rows))
        for part, share in ((F.col(name), rate), (F.lit(float(rows)) - F.col(name), 1 - rate))
    ]
    return 2 * sum(terms[1:], terms[0])


def telling_counts(words: DataFrame, scratch: Scratch) -> tuple[dict[int, float], DataFrame]:
    """Documents of each class, and of each string those that have it: (string, bad, good).

    ``words`` has a row number, the class and the words of each document.

    Near copies of a document tell nothing new, so a word is one document's only with its neighbours:
    of all documents with the same three words in a row the first has them. A class's
    documents are counted by the share of such triples that they have for themselves.
    """
    empty = F.lit(b"")

    def triple(word: Column, at: Column) -> Column:
        before, after = (F.coalesce(F.get("words", at + step), empty) for step in (-1, 1))
        return F.xxhash64(before, word, after)

    triples = F.transform("words", triple)
    each = words.select("row", F.explode(F.arrays_zip(F.col("words").alias("word"), triples.alias("triple"))).alias("x")).select("row", "x.*")
    owned = each.groupBy("triple", "word").agg(F.min("row").alias("row"))
    own = owned.groupBy("row").agg(F.collect_set("word").alias("own_words"), F.count("*").alias("own"))
    sizes = words.select("row", "toxic", F.size(F.array_distinct(triples)).alias("all"))
    kept = scratch.keep(sizes.join(own, "row").select("toxic", "own_words", (F.col("own") / F.col("all")).alias("share")))
    totals = {row.toxic: row.documents for row in kept.groupBy("toxic").agg(F.sum("share").alias("documents")).collect()}
    strings = kept.select("toxic", "own_words").mapInArrow(_strings, "toxic int, string binary")
    counted = strings.groupBy("string").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    return totals, scratch.keep(counted.where("bad + good > 1"))


def pick_strings(scored: list[bytes], most: int = DICTIONARY_BYTES) -> list[bytes]:
    """Strings in their order, none that holds one before it or is part of one, while their coded bytes fit."""
    chosen: list[bytes] = []
    beginnings: set[bytes] = set()
    size, joined = 0, b""
    for string in scored:
        if string in joined or any(string[:k] in beginnings for k in range(1, len(string) + 1)):
            continue
        size += 2 * len(string)
        if size > most:
            break
        chosen.append(string)
        beginnings.add(string)
        joined += string + b"\n"
    return chosen


def train_ordinary(words: list[tuple[bytes, int]], documents: float, size: int) -> bytes:
    """zstandard's dictionary of ordinary words, from documents made up of them at the rates they have."""
    if not words:
        return b""
    rates = np.array([count for _, count in words]) / max(1, documents)
    random = np.random.Generator(np.random.PCG64(5))
    coded = [placed(b" " + word + b" ") for word, _ in words]
    samples = [b"".join(coded[i] for i in np.flatnonzero(random.random(len(words)) < rates).tolist()) for _ in range(TRAINING_DOCUMENTS)]
    try:
        return zstandard.train_dictionary(size, [sample for sample in samples if sample], d=8, k=64).as_bytes()
    except zstandard.ZstdError:
        # Too little text to choose from: all of it, the commonest words last.
        return b"".join(reversed(coded))[-size:]


def train_dictionaries(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[bytes, bytes]:
    """Contents of the toxic and the ordinary dictionary.

    The sample is chosen by key hash from the labels alone, so it is bounded by
    ``SAMPLE_ROWS`` keys and small enough to broadcast to the scan of the texts.
    """
    known = training_labels(labels, key)
    sample = None
    for toxic, rows in SAMPLE_ROWS.items():
        part = known.where(F.col("toxic") == toxic).orderBy(F.xxhash64(key), key).limit(rows)
        sample = part if sample is None else sample.union(part)
    texts = documents.select(key, F.col(text).cast("string").alias("text")).join(F.broadcast(sample), key)
    spark = documents.sparkSession
    scratch = Scratch(spark, "toxicity-training")
    distinct = texts.select("toxic", "text").dropDuplicates()
    words = distinct.mapInArrow(_words, "toxic int, words array<binary>").withColumn("row", F.monotonically_increasing_id())
    totals, counted = telling_counts(scratch.keep(words), scratch)
    bad_rows, good_rows = totals.get(1, 0.0), totals.get(0, 0.0)
    ratio = ((F.col("bad") + 0.5) / (bad_rows + 1)) / ((F.col("good") + 0.5) / (good_rows + 1))
    value = (F.least(F.length("string"), F.lit(MOST_LETTERS)) - MATCH_COST) * F.col("bad") * F.log(ratio)
    telling = (F.col("bad") > 1) & (ratio >= RATIO) & (significance("bad", "good", bad_rows, good_rows) >= SIGNIFICANCE)
    # A word has at most as many beginnings as are tried, so these hold all that fit.
    most = (len(BEGINNINGS) + 1) * DICTIONARY_BYTES // 8
    best = counted.where(telling).orderBy(F.desc(value), F.desc(F.length("string")), "string").limit(most).select("string").collect()
    toxic = b"".join(placed(string) for string in reversed(pick_strings([bytes(row.string) for row in best])))
    size = min(DICTIONARY_BYTES, ORDINARY_TIMES * len(toxic) + ORDINARY_LEAST)
    whole = counted.where("substring(string, -1) = X'20' and good > 0")
    common = whole.orderBy(F.desc("good"), "string").limit(TRAINING_WORDS).select("string", "good").collect()
    drop_folder(spark, scratch.root)
    return toxic, train_ordinary([(bytes(row.string).strip(), row.good) for row in common], good_rows, size)


def placed(word: bytes) -> bytes:
    """Two bytes for each letter, both depending on the letter and on its place."""
    return bytes(x for i, letter in enumerate(word) for x in ((letter + 37 * i) & 255, (letter + 48 * i + 91) & 255))


class Distance:
    """Compressed lengths of windows under the two dictionaries."""

    def __init__(self, toxic: bytes, ordinary: bytes) -> None:
        self.toxic, self.ordinary = (self._compressor(content).compress for content in (toxic, ordinary))
        self.known: dict[bytes, int] = {}

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        # zstandard refuses contents under 8 bytes.
        content = content.ljust(8, b"\n")
        # Tables with a place for every byte of the dictionary, and a window that reaches over all of it.
        log = max(10, len(content).bit_length())
        settings = zstandard.ZstdCompressionParameters(
            format=zstandard.FORMAT_ZSTD1_MAGICLESS, strategy=zstandard.STRATEGY_BTLAZY2, window_log=log + 2, hash_log=log,
            chain_log=log + 1, search_log=6, min_match=6, write_content_size=0, write_checksum=0, write_dict_id=0,
        )
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(compression_params=settings)
        return zstandard.ZstdCompressor(dict_data=held, compression_params=settings)

    def gain(self, word: bytes) -> int:
        """Bytes that the toxic dictionary saves more than the ordinary one, from 0 to the highest threshold."""
        window = placed(b" " + word + b" ")
        return min(max(len(self.ordinary(window)) - len(self.toxic(window)), 0), THRESHOLDS[-1])

    def hits(self, text: str | None) -> tuple[list[int], int]:
        """Windows at each threshold, and all windows."""
        known, words = self.known, normalise(text).split()
        if len(known) > KNOWN_WORDS:
            known.clear()
        for word in set(words):
            if word not in known:
                known[word] = self.gain(word)
        gains = np.bincount(np.fromiter(map(known.__getitem__, words), np.int64, len(words)), minlength=THRESHOLDS[-1] + 1)
        return gains[::-1].cumsum()[::-1][1:].tolist(), len(words)


_distances: dict[tuple[bytes, bytes], Distance] = {}


def distance(toxic: bytes, ordinary: bytes) -> Distance:
    """This worker's compressors and known words; only the last pair of dictionaries is kept."""
    if (toxic, ordinary) not in _distances:
        _distances.clear()
        _distances[toxic, ordinary] = Distance(toxic, ordinary)
    return _distances[toxic, ordinary]


def _measure(toxic: bytes, ordinary: bytes, text: str, names: tuple[str, str]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = distance(toxic, ordinary).hits
        for batch in batches:
            found = [hits(x) for x in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            counts = [pa.array([x[0] for x in found], pa.list_(pa.int64())), pa.array([x[1] for x in found], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *counts], [*batch.schema.names, *names])

    return work


def with_hits(documents: DataFrame, dictionaries: tuple[bytes, bytes], text: str, names: tuple[str, str]) -> DataFrame:
    """The rows with hits at each threshold and windows under new ``names``; a null or wordless text has none."""
    kinds = zip(names, ("array<bigint>", "bigint"), strict=True)
    schema = documents.withColumns({name: F.lit(None).cast(kind) for name, kind in kinds}).schema
    return documents.mapInArrow(_measure(*dictionaries, text, names), schema)


def hit_bin(hits: Column) -> Column:
    return F.when(hits < 4, hits).otherwise(F.length(F.bin(hits)) + 1).cast("int")


def size_bin(windows: Column) -> Column:
    return F.when(windows == 0, 0).otherwise(F.length(F.bin(windows))).cast("int")


def calibrate(measured: DataFrame, labels: DataFrame, dictionaries: tuple[bytes, bytes], key: str = "key") -> Model:
    """The model with labelled documents counted by bin, at the threshold under which they are likeliest.

    ``measured`` has key, ``hits`` and ``windows``. There are at most 66 x 65 bins for a threshold.
    """
    known = training_labels(labels, key)
    each = measured.join(known, key).select("toxic", size_bin(F.col("windows")).alias("size"), F.posexplode("hits").alias("at", "hits"))
    rows = (
        each.groupBy("at", hit_bin(F.col("hits")).alias("bin"), "size")
        .agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")).orderBy("at", "bin", "size").collect()
    )
    best = Model(*dictionaries)
    likelihood = -math.inf
    for at, threshold in enumerate(THRESHOLDS):
        counts = tuple((r["bin"], r["size"], r["bad"], r["good"]) for r in rows if r["at"] == at)
        scores = {c[:2]: score_of(c[0], c[1], counts) for c in counts}
        found = sum(c[2] * math.log(scores[c[:2]]) + c[3] * math.log(1 - scores[c[:2]]) for c in counts)
        if counts and found > likelihood:
            best, likelihood = Model(*dictionaries, threshold, counts), found
    return best


def score_of(hits: int, size: int, counts: tuple[tuple[int, int, int, int], ...]) -> float:
    """Share of toxic documents in a bin, shrunk to that of all sizes with as many hits, and that to the overall one.

    More hits than any labelled document has count as the most that one has.
    """
    seen = max((c[0] for c in counts if c[0] <= hits), default=0)
    bad, good = sum(c[2] for c in counts), sum(c[3] for c in counts)
    rate = (bad + 0.1 * PRIOR) / (bad + good + PRIOR)
    for chosen in ([c for c in counts if c[0] == seen], [c for c in counts if c[:2] == (seen, size)]):
        bad, good = sum(c[2] for c in chosen), sum(c[3] for c in chosen)
        rate = (bad + PRIOR * rate) / (bad + good + PRIOR)
    return rate


def score_column(model: Model, hits: str, windows: str) -> Column:
    """Score in 0 to 1 from the columns of hits and windows."""
    table = np.zeros((HIT_BINS, SIZE_BINS))
    for size in range(SIZE_BINS):
        for bin_ in range(HIT_BINS):
            table[bin_, size] = score_of(bin_, size, model.counts)
    scores = F.lit(table.ravel().tolist())
    place = hit_bin(F.col(f"`{hits}`")[model.threshold - 1]) * SIZE_BINS + size_bin(F.col(f"`{windows}`"))
    return F.get(scores, place)


def score(measured: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """Score and decision of every measured row."""
    scored = measured.withColumn("score", score_column(model, "hits", "windows"))
    return scored.select(
        F.col("key").alias(key), held_out("key").alias("held_out"), "score", (F.col("score") >= LIMIT).cast("int").alias("predicted")
    )


def toxicity(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Train on the labelled rows that are not held out, and score every row.

    Null and wordless texts have no window and get the score of labelled
    documents without. Null keys are not held out. Repeated rows get equal
    scores. Without labels every score is 0.1. Other columns are not used.
    """
    spark = documents.sparkSession
    dictionaries = train_dictionaries(documents, labels, key, text)
    path = scratch_path(spark, "toxicity-measures")
    chosen = documents.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    with_hits(chosen, dictionaries, "text", ("hits", "windows")).drop("text").write.parquet(path)
    measured = spark.read.parquet(path)
    model = calibrate(measured, labels.withColumnRenamed(key, "key"), dictionaries)
    return score(measured, model, key)


def drop_toxic(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows, with all their columns, whose score is under the limit; repeated rows fare alike.

    The rows are written once with what was measured on them, whatever their columns are called.
    """
    spark = documents.sparkSession
    dictionaries = train_dictionaries(documents, labels, key, text)
    hits, windows = (private_name(documents, name) for name in ("hits", "windows"))
    path = scratch_path(spark, "toxicity-measured")
    with_hits(documents, dictionaries, text, (hits, windows)).write.option("compression", "zstd").parquet(path)
    measured = spark.read.parquet(path)
    narrow = measured.select(F.col(key).alias("key"), F.col(hits).alias("hits"), F.col(windows).alias("windows"))
    model = calibrate(narrow, labels.withColumnRenamed(key, "key"), dictionaries)
    return measured.where(score_column(model, hits, windows) < LIMIT).select(*documents.columns)
