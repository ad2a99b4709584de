"""CSV feeds as text columns with their file order."""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.functions.values import blank_to_null
from ordermill.plans.profile import preview_feed
from ordermill.schema import (
    CUSTOMER_COLUMNS,
    ORDER_COLUMNS,
    PRODUCT_COLUMNS,
    SOURCE_ORDINAL,
    require_columns,
)

_BROKEN = "_broken_row"
_FILE, _RANK = "_file", "_rank"

# Paths of so many characters in all are held by every task, as ranks of the files.
MOST_PATH_CHARACTERS = 8 << 20

# A whole quoted cell, at a cell's start; quotes elsewhere are plain characters.
_QUOTED_CELL = r'(^|,)"[^"]*+(?:""[^"]*+)*+"'
# What a line begins with that ends a cell begun on an earlier line: text, the quote, and what follows it.
_CLOSES = r'^[^"]*+(?:""[^"]*+)*+"(,|$)'
_CANNOT_CLOSE = r'^[^"]*+(?:""[^"]*+)*+"[^",]'


def _line_by_line(encoding: str) -> bool:
    """Whether line ends, quotes and commas of a file can be told from its bytes."""
    try:
        return all(mark.encode(encoding) == mark.encode("ascii") for mark in '\r\n",')
    except LookupError:
        return False


def files_with_line_breaks(
    spark: SparkSession, path: str | list[str], open_quotes: str = "fail"
) -> list[str]:
    """The files of a feed in which some quoted cell spans lines.

    Such a cell leaves a line on which it opens and does not close. A quote that
    is never closed would make a reader take what follows for one cell, up to the
    next quote. So unless ``open_quotes="accept"``, the quotes of a file with such lines must
    pair up, and it must have as many lines that can close a cell as lines that can
    only open one; else this raises and names the file. Files whose cells are
    written as they should be always pass.
    One split pass, in which only lines with a quote are looked at by patterns; the
    driver gets only the names of files that have such lines.
    """
    line = F.col("value")
    opens = F.regexp_replace(line, _QUOTED_CELL, "$1").rlike('(^|,)"')
    found = (
        spark.read.text(path)
        .where(line.contains('"'))
        .groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(
            F.sum(F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))).alias("quotes"),
            F.max(opens).alias("opens"),
            F.count_if(opens & line.rlike(_CANNOT_CLOSE)).alias("opening"),
            F.count_if(line.rlike(_CLOSES)).alias("closing"),
        )
        .where("opens")
        .orderBy("file")
        .collect()
    )
    if open_quotes == "fail":
        wrong = [unquote(r.file) for r in found if r.quotes % 2 or r.opening > r.closing]
        if wrong:
            raise ValueError(f"quote that is never closed in {', '.join(wrong[:5])}")
    return [unquote(row.file) for row in found]


def has_line_breaks_in_cells(
    spark: SparkSession, path: str | list[str], open_quotes: str = "fail"
) -> bool:
    """Whether some quoted cell of the files spans lines; raises on a quote never closed."""
    return bool(files_with_line_breaks(spark, path, open_quotes))


def _has_surplus_cell(row_text: Column, width: int) -> Column:
    """Whether a raw row has more than ``width`` cells, commas in quoted cells aside."""
    outside = F.regexp_replace(row_text, _QUOTED_CELL, "$1")
    commas = F.length(outside) - F.length(F.replace(outside, F.lit(","), F.lit("")))
    return commas >= width


def _holds_a_row(width: int, names: Sequence[str]) -> Column:
    """A text cell with a line inside that has the commas of a whole row, or NULL."""

    def whole_row(line: Column) -> Column:
        return F.length(line) - F.length(F.replace(line, F.lit(","), F.lit(""))) >= width - 1

    def suspicious(cell: Column) -> Column:
        lines = F.split(cell, r"\r?\n")
        inner = F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 2, F.lit(0)))
        return F.when(F.exists(inner, whole_row), cell)

    return F.coalesce(*(suspicious(F.col(f"`{name}`")) for name in names))


def _same_file(name: str) -> str:
    """A file's name however its scheme's slashes are written."""
    return re.sub(r"^([a-z0-9]+):/+", r"\1:/", name)


def file_ranks(spark: SparkSession, path: str | list[str]) -> dict[str, int]:
    """The place of each file of a feed among all, by path."""
    names = sorted(spark.read.text(path).inputFiles(), key=unquote)
    return {_same_file(name): rank for rank, name in enumerate(names)}


def _place_of(rows: DataFrame, ranks: dict[str, int]) -> tuple[DataFrame, Column]:
    """The rows, and the column that orders their files: a number unless the paths are too many to hand out."""
    if len(ranks) <= 1:
        return rows, F.lit(0)
    if sum(map(len, ranks)) > MOST_PATH_CHARACTERS:
        return rows, F.col(_FILE)
    # A scheme may be followed by one slash or by three.
    spelled = {re.sub(r"^([a-z0-9]+):/+", rf"\1:{slashes}", name): rank for name, rank in ranks.items() for slashes in ("/", "//", "///")}
    known = rows.sparkSession.createDataFrame(list(spelled.items()), f"{_FILE} string, {_RANK} int")
    missing = F.raise_error(F.concat(F.lit("file that was not listed: "), F.col(_FILE))).cast("int")
    return rows.join(F.broadcast(known), _FILE, "left"), F.coalesce(F.col(_RANK), missing)


def read_feed(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str],
    multi_line: bool | None = None,
    surplus: str = "fail",
    encoding: str = "UTF-8",
    open_quotes: str = "fail",
    ranks: dict[str, int] | None = None,
) -> DataFrame:
    """CSV files or folders as STRING columns, with ``source_ordinal``.

    Columns are found by header name and every file must carry the same header.
    Missing-cell texts become NULL. ``source_ordinal`` orders rows as they stand
    in the files, files by path: it is the file's rank among all (``ranks``), the
    block and the row, three numbers.

    Cells that span lines keep a file from being split. ``multi_line=None``
    looks for them first, in a job of its own, and reads only the files that have
    them unsplit; say ``False`` to spare that pass on feeds known to have none,
    ``True`` to skip it otherwise. In encodings whose lines cannot be told
    from bytes, such as UTF-16, no file is split.

    A quote that is never closed swallows rows up to the next quote. The pass
    above raises where quotes do not pair up, and reading raises at a cell with a
    line inside that has the commas of a whole row; ``open_quotes="accept"``
    takes such cells as they are. A row with surplus cells stops the read unless
    ``surplus="drop"`` lets the extra cells go.
    """
    if surplus not in ("fail", "drop"):
        raise ValueError("surplus must be 'fail' or 'drop'")
    if open_quotes not in ("fail", "accept"):
        raise ValueError("open_quotes must be 'fail' or 'accept'")
    if not _line_by_line(encoding):
        multi_line = True
    if ranks is None:
        ranks = file_ranks(spark, path)
    if multi_line is None:
        broken = files_with_line_breaks(spark, path, open_quotes)
        if broken:
            files = [unquote(name) for name in spark.read.text(path).inputFiles()]
            whole = [name for name in files if _same_file(name) not in set(map(_same_file, broken))]
            options = {
                "columns": columns,
                "surplus": surplus,
                "encoding": encoding,
                "open_quotes": open_quotes,
                "ranks": ranks,
            }
            feed = read_feed(spark, broken, multi_line=True, **options)
            if whole:
                plain = read_feed(spark, whole, multi_line=False, **options)
                if plain.columns != feed.columns:
                    raise ValueError(f"files of {path} differ in their header")
                feed = plain.union(feed)
            return feed
        multi_line = False

    reader = (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("encoding", encoding)
        .option("multiLine", multi_line)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
    )
    header = reader.csv(path).columns
    schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
    if surplus == "fail":
        schema = schema.add(_BROKEN, T.StringType())
        # A row's width is only checked if all of its cells are read.
        reader = reader.option("columnNameOfCorruptRecord", _BROKEN).option("columnPruning", False)
    rows = reader.schema(schema).csv(path)
    require_columns(rows, columns, str(path))

    if surplus == "fail":
        too_wide = F.coalesce(_has_surplus_cell(F.col(_BROKEN), len(header)), F.lit(False))
        # Naming a cell too keeps a bare count() from reading the raw row alone.
        cell = F.coalesce(F.col(f"`{header[0]}`"), F.lit(""))
        message = F.concat(F.lit("row with surplus cells at '"), cell, F.lit("': "), F.col(_BROKEN))
        rows = rows.filter(F.assert_true(~too_wide, message).isNull())
    if multi_line and open_quotes == "fail" and len(header) > 1:
        swallowed = _holds_a_row(len(header), header)
        message = F.concat(
            F.lit("quote that is never closed, or a cell that holds a whole row, in "),
            F.col("_metadata.file_path"), F.lit(": "), swallowed,
        )
        rows = rows.filter(F.assert_true(swallowed.isNull(), message).isNull())

    rows = rows.select(
        *(blank_to_null(F.col(f"`{name}`")).alias(name) for name in header),
        F.col("_metadata.file_path").alias(_FILE),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )
    rows, file = _place_of(rows, ranks)
    place = F.struct(file.alias("file"), F.col("_block").alias("block"), F.col("_row").alias("row"))
    return rows.select(*(F.col(f"`{name}`") for name in header), place.alias(SOURCE_ORDINAL))


def read_customers(spark: SparkSession, path: str, **options) -> DataFrame:
    """The customers feed; options as in :func:`read_feed`."""
    return read_feed(spark, path, CUSTOMER_COLUMNS, **options)


def read_products(spark: SparkSession, path: str, **options) -> DataFrame:
    """The products feed; options as in :func:`read_feed`."""
    return read_feed(spark, path, PRODUCT_COLUMNS, **options)


def read_orders(spark: SparkSession, path: str, **options) -> DataFrame:
    """The orders feed; options as in :func:`read_feed`."""
    return read_feed(spark, path, ORDER_COLUMNS, **options)


def head_of_feed(
    spark: SparkSession, path: str, columns: Sequence[str], n: int = 3, **options
) -> DataFrame:
    """The first ``n`` rows of a feed, reading only as many files as hold them.

    Starts with the first file and takes four times as many while rows are
    missing, which only files with hardly any rows make necessary.
    """
    ranks = file_ranks(spark, path)
    files = sorted(unquote(name) for name in spark.read.text(path).inputFiles())
    taken = 1
    while True:
        feed = read_feed(spark, files[:taken], columns, ranks=ranks, **options)
        if taken >= len(files) or feed.limit(n).count() == n:
            return preview_feed(feed, n)
        taken *= 4
