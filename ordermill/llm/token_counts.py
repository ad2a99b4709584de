"""Token counts of whole texts, huge ones by overlapping chunks that are spliced where they agree.

A text of more than ``CHUNK`` characters is cut into chunks that overlap; tasks encode
chunks, not texts, with offsets. Neighbouring chunks are spliced at the first place of their overlap at which
a word (a piece that the tokenizer looks at alone) begins in both.

Why such a place is stable: the tokenizer cuts words off from left to right, and where it goes
on depends only on the place reached and on what follows, at most ``MARGIN`` characters
after a word's end. So the words of a chunk are the whole text's up to ``MARGIN`` before its end, once one of them
begins where a word of the whole text does. The first chunk begins where the text does; if it and the second have a common
place, the second's words are the whole text's from there on, and so forth. Added tokens are found
first by the tokenizer; a place within one is no word's beginning in the chunk before, as ``MARGIN`` is longer
than their literals. Merges never cross words.

Texts with an overlap in which no such place is found (one word may be longer than that) are cut anew with chunks and overlaps
``WIDEN`` times as long, until all agree or one chunk holds the text. This needs a tokenizer
whose cutting looks behind nothing, as that of byte-level vocabularies without a prefix space.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from ordermill.llm.common import text_groups  # noqa: E402
from ordermill.llm.packing import byte_bpe_path  # noqa: E402
from ordermill.llm.pieces import encoder  # noqa: E402
from ordermill.session import scratch_path  # noqa: E402

LIMIT = 1024
# Characters of a chunk and of its overlap with the next, and by how much both grow for texts that do not align.
CHUNK, OVERLAP, WIDEN = 1 << 16, 256, 8
# Characters after a word that its cutting may depend on; longer than any added token's literal.
MARGIN = 32
# Characters encoded by one call.
CALL = 1 << 18

_PLACES = "array<struct<place: bigint, n: bigint>>"
_PLACE_KIND = pa.list_(pa.struct([("place", pa.int64()), ("n", pa.int64())]))

_tokenizers: dict[str, Tokenizer] = {}


def own_tokenizer(path: str) -> Tokenizer:
    """This worker's tokenizer of a file, without truncation or padding."""
    if path not in _tokenizers:
        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        longest = max((len(token.content) for token in tokenizer.get_added_tokens_decoder().values()), default=0)
        if longest >= MARGIN:
            raise ValueError(f"an added token of {path} is longer than {MARGIN - 1} characters")
        _tokenizers[path] = tokenizer
    return _tokenizers[path]


def _count(path: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, True).encode
        for batch in batches:
            for first, last, data, offsets in text_groups(batch.column(batch.schema.get_field_index("text"))):
                _, begins = encode(data, offsets, 0)
                kept = [batch.column(i).slice(first, last - first) for i in range(2)]
                # One id is the end mark.
                yield pa.RecordBatch.from_arrays([*kept, pa.array(np.diff(begins) - 1, pa.int64())], ["key", "n_bytes", "n_tokens"])

    return work


def chunk_starts(length: int, chunk: int, overlap: int) -> list[int]:
    """Where the chunks of a text begin; each but the last has ``chunk`` characters."""
    return list(range(0, max(1, length - overlap), chunk - overlap))


def _cut(chunk: int, overlap: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "part", "parts", "start", "piece"]
        for batch in batches:
            for row, text in zip(batch.column(0), batch.column(1), strict=True):
                whole = text.as_py()
                starts = chunk_starts(len(whole), chunk, overlap)
                for part, start in enumerate(starts):
                    values = [row.as_py(), part, len(starts), start]
                    columns = [*(pa.array([x], pa.int64()) for x in values), pa.array([whole[start : start + chunk]], pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return work


def word_begins(encoding) -> tuple[np.ndarray, np.ndarray]:
    """Offsets at which words begin, and the tokens before each."""
    words = np.array(encoding.word_ids, np.int64)
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.append(True, words[1:] != words[:-1]))
    return np.array(encoding.offsets, np.int64)[first, 0], first


def _encode(path: str, chunk: int, overlap: int):
    def places(start: int, where: np.ndarray, n: np.ndarray, chosen: np.ndarray) -> list[dict]:
        return [{"place": start + a, "n": b} for a, b in zip(where[chosen].tolist(), n[chosen].tolist(), strict=True)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, together = own_tokenizer(path), max(1, CALL // chunk)
        for batch in batches:
            for first in range(0, batch.num_rows, together):
                rows = batch.slice(first, together)
                part, parts, start, pieces = (rows.column(i).to_pylist() for i in range(1, 5))
                totals, heads, tails = [], [], []
                encoded = tokenizer.encode_batch(pieces, add_special_tokens=False)
                for i, encoding in enumerate(encoded):
                    where, before = word_begins(encoding)
                    total = len(encoding)
                    head = (where < overlap) & (part[i] > 0)
                    tail = (where >= chunk - overlap) & (where <= chunk - MARGIN) & (part[i] + 1 < parts[i])
                    totals.append(total)
                    heads.append(places(start[i], where, before, head))
                    tails.append(places(start[i], where, total - before, tail))
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(i) for i in range(3)), pa.array(totals, pa.int64()), pa.array(heads, _PLACE_KIND), pa.array(tails, _PLACE_KIND)],
                    ["row", "part", "parts", "tokens", "head", "tail"],
                )

    return work


def spliced(chunks: DataFrame) -> DataFrame:
    """Per text (``row``): its ``n_tokens``, and how many overlaps are ``open``, without a common place.

    A chunk's ``head`` and ``tail`` hold the places of its two overlaps with the tokens that would be counted
    twice if the splice were there: those before the place in the later chunk, those after it in the earlier one.
    """
    later = chunks.select("row", F.col("part").alias("seam"), F.explode("head").alias("at"))
    earlier = chunks.select("row", (F.col("part") + 1).alias("seam"), F.explode("tail").alias("at"))
    sides = later.union(earlier).select("row", "seam", "at.*")
    common = sides.groupBy("row", "seam", "place").agg(F.count("*").alias("sides"), F.sum("n").alias("twice")).where("sides = 2")
    seams = common.groupBy("row", "seam").agg(F.min_by("twice", "place").alias("twice"))
    # Of a text one row for its chunks and one for its seams meet.
    sums = chunks.groupBy("row").agg(F.sum("tokens").alias("n"), (F.max("parts") - 1).alias("seams"))
    both = sums.union(seams.groupBy("row").agg((-F.sum("twice")).alias("n"), (-F.count("*")).alias("seams")))
    return both.groupBy("row").agg(F.sum("n").alias("n_tokens"), F.sum("seams").alias("open"))


def count_huge(texts: DataFrame, path: str, chunk: int, overlap: int, scratch: str) -> DataFrame:
    """Tokens of the texts in a written table (row, text), whose rows are numbered, as (row, n_tokens)."""
    spark, done, turn = texts.sparkSession, [], 0
    while True:
        pieces = texts.mapInArrow(_cut(chunk, overlap), "row bigint, part bigint, parts bigint, start bigint, piece string")
        # A text's chunks go to different tasks.
        dealt = pieces.repartition("row", "part")
        encoded = dealt.mapInArrow(
            _encode(path, chunk, overlap), f"row bigint, part bigint, parts bigint, tokens bigint, head {_PLACES}, tail {_PLACES}"
        )
        encoded.write.parquet(f"{scratch}/chunks-{turn}")
        spliced(spark.read.parquet(f"{scratch}/chunks-{turn}")).write.parquet(f"{scratch}/counts-{turn}")
        counts = spark.read.parquet(f"{scratch}/counts-{turn}")
        done.append(counts.where("open = 0").select("row", "n_tokens"))
        missing = counts.where("open > 0").select("row")
        if missing.isEmpty():
            return reduce(DataFrame.union, done)
        texts = texts.join(missing, "row", "left_semi").select("row", "text")
        chunk, overlap, turn = chunk * WIDEN, overlap * WIDEN, turn + 1


def token_counts(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    limit: int = LIMIT,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """Per row: key, ``n_bytes`` of its UTF-8, ``n_tokens``, and whether those are ``over_limit``.

    A null text is empty and an empty one has no tokens. Rows stand for themselves: keys may be null or
    repeat. Texts are counted whole, however long. Other columns are not used, an empty table
    gives no rows. ``path`` names the file of a byte-level tokenizer; begin and end marks are
    not counted, literals of added tokens count as the tokenizer gives them.
    """
    if not MARGIN < overlap < chunk // 2:
        raise ValueError(f"an overlap has more than {MARGIN} characters and less than half a chunk")
    path = path or byte_bpe_path()
    spark = documents.sparkSession
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = documents.select(F.col(key).alias("key"), F.octet_length(whole).cast("bigint").alias("n_bytes"), whole.alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    short = rows.where(F.length("text") <= chunk).mapInArrow(_count(path), f"key {kind}, n_bytes bigint, n_tokens bigint")

    scratch = scratch_path(spark, "token-counts")
    rows.where(F.length("text") > chunk).select(F.monotonically_increasing_id().alias("row"), "key", "n_bytes", "text").write.parquet(f"{scratch}/huge")
    huge = spark.read.parquet(f"{scratch}/huge")
    counts = short
    if not huge.isEmpty():
        found = count_huge(huge.select("row", "text"), path, chunk, overlap, scratch)
        counts = short.union(huge.select("row", "key", "n_bytes").join(found, "row").select("key", "n_bytes", "n_tokens"))
    return counts.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
