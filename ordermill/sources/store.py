"""Storing, reading back and exporting the sales fact.

A stored fact is a folder of versions. A version is written beside those that are
there, compared with what was meant, and only then marked as verified; readers take the
last verified one. So a load that fails or is killed leaves the fact as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.functions.values import is_present
from ordermill.plans.sales import in_date_order
from ordermill.schema import SALES_COLUMNS, SALES_SCHEMA, SALES_TABLE
from ordermill.session import drop_folder
from ordermill.sources.csv_feeds import has_line_breaks_in_cells

MONTH_COLUMN = "year_month"
VALID_COLUMN = "is_valid"
# A version's folder is named by its number; a file of this name says that it is whole and compared.
VERSION_PREFIX, VERIFIED = "fact-", "_VERIFIED"
COPY_BYTES = 4 << 20
DATE_FORMAT = "yyyy-MM-dd"
DATE_AND_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"
# What the reader puts for a quoted empty cell, so that it differs from a missing one.
_EMPTY_MARK = "\u0001"
DATE_WITH_OPTIONAL_TIME = "yyyy-MM-dd[ HH:mm:ss[.SSSSSS]]"


def _replacing(sales: DataFrame, folders: list[str]) -> DataFrameWriter:
    """A writer that replaces everything, whatever the session's overwrite mode.

    ``rebalance`` sends a folder's rows to few tasks, so folders get few files,
    but splits what is too large for one task. Sorting inside tasks gives each
    file a narrow date range, which later scans can skip by.
    """
    rows = sales
    if MONTH_COLUMN in folders:
        rows = sales.hint("rebalance", *folders).sortWithinPartitions(
            *folders, "order_date", "order_id"
        )
    writer = rows.write.mode("overwrite").format("parquet")
    writer = writer.option("partitionOverwriteMode", "static")
    return writer.partitionBy(*folders) if folders else writer


def content_digest(columns: list[str]) -> list[Column]:
    """Two sums over all rows, in whatever order: how many they are, and a sum of hashes of their cells.

    A hash skips missing cells, so which cells are missing goes into it as well.
    """
    cells = [F.col(f"`{name}`") for name in columns]
    row = F.xxhash64(*cells, *(F.isnull(cell) for cell in cells))
    return [F.count(F.lit(1)).alias("n_rows"), F.sum(row.cast("decimal(20,0)")).alias("digest")]


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _versions(spark: SparkSession, path: str) -> dict[str, bool]:
    """The versions in a folder, oldest first, and whether they are verified."""
    files, place = _file_system(spark, f"{path}/{VERSION_PREFIX}*")
    names = sorted(found.getPath().getName() for found in files.globStatus(place) or [])
    marks = {name: _file_system(spark, f"{path}/{name}/{VERIFIED}")[1] for name in names}
    return {name: files.exists(mark) for name, mark in marks.items()}


def current_folder(spark: SparkSession, path: str) -> str:
    """The folder of the last verified version; the path itself if it holds no versions."""
    versions = _versions(spark, path)
    verified = [name for name, good in versions.items() if good]
    if versions and not verified:
        raise FileNotFoundError(f"no load at {path} was ever verified")
    return f"{path}/{verified[-1]}" if verified else path


def _same_content(spark: SparkSession, meant: DataFrame, seen: dict, folder: str) -> None:
    """Raise if the rows of a folder are not those that were meant to be written.

    ``seen`` was counted along with the writing, which may have counted a task twice
    that ran twice; so it can clear a load but not condemn it. In doubt the plan is counted again.
    """
    stored = _read(spark, folder, meant).agg(*content_digest(meant.columns)).first().asDict()
    if stored != seen:
        again = meant.agg(*content_digest(meant.columns)).first().asDict()
        if stored != again:
            raise RuntimeError(f"rows stored in {folder} are not those written: {stored}, not {again}")


def save_sales(
    sales: DataFrame,
    path: str,
    by_month: bool = True,
    check: Callable[[DataFrame], None] | None = None,
    verify: bool = True,
) -> str:
    """Replace the Parquet fact at ``path``; gives the folder of the new version.

    Valid and other rows go to folders of their own, by month if asked, so
    that valid-only reports need not read both names to tell rows apart.

    The old fact stays until the new one is written whole, its cells add up to the digest taken
    while writing (``verify``), and ``check``, given the new rows, does not raise. Then
    it goes, and so does what failed loads left; frames that still read it should be
    done. One load at a time may write to a path.
    """
    spark = sales.sparkSession
    flagged = sales.withColumn(VALID_COLUMN, is_present("customer_name", "product_name"))
    folders = [VALID_COLUMN, MONTH_COLUMN] if by_month else [VALID_COLUMN]
    before = _versions(spark, path)
    number = max((int(name.split("-")[1]) for name in before), default=0) + 1
    version = f"{VERSION_PREFIX}{number:08d}-{uuid.uuid4().hex[:8]}"
    folder = f"{path}/{version}"
    seen = Observation()
    watched = flagged.observe(seen, *content_digest(flagged.columns)) if verify else flagged
    try:
        _replacing(watched, folders).save(folder)
        if verify:
            _same_content(spark, flagged, seen.get, folder)
        if check:
            check(_read(spark, folder, flagged).select(*sales.columns))
    except Exception:
        drop_folder(spark, folder)
        raise
    files, mark = _file_system(spark, f"{folder}/{VERIFIED}")
    files.create(mark).close()
    for name in before:
        drop_folder(spark, f"{path}/{name}")
    # A fact that was stored without versions lies beside them.
    for pattern in (f"{VALID_COLUMN}=*", "part-*", "_SUCCESS"):
        for found in files.globStatus(_file_system(spark, f"{path}/{pattern}")[1]) or []:
            files.delete(found.getPath(), True)
    return folder


def _read(spark: SparkSession, folder: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(folder)


def open_sales(spark: SparkSession, path: str, valid_only: bool = False) -> DataFrame:
    """The stored fact, or its valid rows, columns in their fixed order."""
    schema = T.StructType([*SALES_SCHEMA.fields, T.StructField(VALID_COLUMN, T.BooleanType())])
    stored = spark.read.schema(schema).parquet(current_folder(spark, path))
    if valid_only:
        stored = stored.filter(VALID_COLUMN)
    return stored.select(*SALES_COLUMNS)


def stored_columns(spark: SparkSession, path: str) -> DataFrame:
    """The stored fact as its files and folders have it, no schema imposed.

    The fixed columns that are there come first, in their order, then whatever
    else is; the validity folder is not a column of the fact. Of folders only the
    names are known, and they are taken as text.
    """
    inference = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(inference)
    spark.conf.set(inference, "false")
    try:
        stored = spark.read.parquet(current_folder(spark, path))
    finally:
        spark.conf.set(inference, before)
    known = [name for name in SALES_COLUMNS if name in stored.columns]
    return stored.select(*known, *(c for c in stored.columns if c not in (*known, VALID_COLUMN)))


def save_sales_table(sales: DataFrame, table: str = SALES_TABLE) -> None:
    """Replace a catalog table of the twelve columns, in their order.

    It has no folders per month, as a folder column always comes last; rows are
    laid out by date instead, so that a month is in few files.
    """
    rows = sales.select(*SALES_COLUMNS).repartitionByRange("order_date", "order_id")
    _replacing(rows.sortWithinPartitions("order_date", "order_id"), []).saveAsTable(table)


def save_sales_jdbc(
    sales: DataFrame,
    url: str,
    table: str = SALES_TABLE,
    connections: int = 16,
    properties: dict[str, str] | None = None,
) -> None:
    """Replace a table of a relational database, over a bounded set of connections."""
    options = {"numPartitions": str(connections), **(properties or {})}
    sales.write.mode("overwrite").jdbc(url, table, properties=options)


def verify_load(loaded: DataFrame, meant: DataFrame) -> DataFrame:
    """One row: rows loaded, rows meant to be, and whether they agree.

    ``meant`` has one number, such as the count of the clean orders, each of
    which is a row of the fact; so the fact is not built again to be counted.
    """
    both = loaded.agg(F.count(F.lit(1)).alias("n"), F.lit("loaded").alias("side")).unionByName(
        meant.select(F.col(meant.columns[0]).alias("n"), F.lit("written").alias("side"))
    )
    return both.agg(
        F.max(F.when(F.col("side") == "loaded", F.col("n"))).alias("rows_loaded"),
        F.max(F.when(F.col("side") == "written", F.col("n"))).alias("rows_written"),
    ).withColumn("matches", F.col("rows_loaded") == F.col("rows_written"))


def export_csv(
    sales: DataFrame, path: str, ordered: bool = True, single_file: bool = False
) -> None:
    """Replace a folder of CSV files with a header, in UTF-8.

    Files follow each other in date order. Dates are written without a time if
    all of them are at midnight, else all with one; that takes a pass of its own.
    Cells keep their blanks and line breaks; an empty text is quoted, a missing one is not.

    ``single_file`` makes ``path`` one file with one header. Its parts are written by many tasks
    and joined as files, see :func:`join_files`, so no task gets all rows.

    The rows are first written beside ``path``, until it is there: the look at the dates, the
    sample that a sort takes and the sort itself read those, and build no fact of their own.
    """
    staged = f"{path}.rows-{uuid.uuid4().hex}"
    try:
        _export_staged(_staged(sales, staged), path, ordered, single_file)
    finally:
        drop_folder(sales.sparkSession, staged)


def _staged(rows: DataFrame, folder: str) -> DataFrame:
    """The rows, written once; columns by place, as Parquet does not take all names."""
    placed = rows.toDF(*(f"c{number}" for number in range(len(rows.columns))))
    placed.write.option("compression", "zstd").parquet(folder)
    return rows.sparkSession.read.schema(placed.schema).parquet(folder).toDF(*rows.columns)


def _export_staged(sales: DataFrame, path: str, ordered: bool, single_file: bool) -> None:
    rows = in_date_order(sales) if ordered else sales
    moment = F.col("order_date")
    timed = moment != moment.cast("date").cast("timestamp_ntz")
    if sales.where(timed).isEmpty():
        shown = F.date_format(moment, DATE_FORMAT)
    else:
        shown = F.date_format(moment, DATE_AND_TIME)
    folder = f"{path}.parts-{uuid.uuid4().hex}" if single_file else path
    (
        rows.withColumn("order_date", shown)
        .write.mode("overwrite")
        .option("header", not single_file)
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .option("compression", "none")
        .option("emptyValue", '""')
        .option("nullValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(folder)
    )
    if single_file:
        try:
            join_files(sales.sparkSession, folder, path, ",".join(rows.columns) + "\n")
        finally:
            drop_folder(sales.sparkSession, folder)


def join_files(spark: SparkSession, folder: str, path: str, header: str) -> None:
    """Replace the file at ``path`` by a header and the part files of a folder, in their order.

    A file system that can concatenate files (HDFS) makes the parts' blocks the file's. On others
    bytes are copied from part to file through a buffer of a few megabytes, never rows.
    The old file stays until the new one is whole.
    """
    jvm = spark._jvm
    files, place = _file_system(spark, f"{folder}/part-*")
    parts = [found.getPath() for found in files.globStatus(place) or []]
    parts.sort(key=lambda part: int(part.getName().split("-")[1].split(".")[0]))
    whole = jvm.org.apache.hadoop.fs.Path(f"{folder}/_whole")

    def begin():
        out = files.create(whole, True)
        out.write(bytearray(header.encode("utf-8")))
        return out

    begin().close()
    try:
        listed = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(parts))
        for number, part in enumerate(parts):
            listed[number] = part
        files.concat(whole, listed)
    except (Py4JJavaError, PySparkException):
        # Not every file system can, and those that can want blocks of one size.
        out = begin()
        for part in parts:
            source = files.open(part)
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, COPY_BYTES, False)
            source.close()
        out.close()
    target = jvm.org.apache.hadoop.fs.Path(path)
    files.delete(target, True)
    if not files.rename(whole, target):
        raise OSError(f"cannot move the joined file to {path}")


def read_csv_export(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """An exported folder, or single file, with the fact's types.

    ``multi_line=None`` looks for line breaks in cells first; files with them are not split.
    """
    if multi_line is None:
        # What was exported closes its quotes, whatever its cells look like.
        multi_line = has_line_breaks_in_cells(spark, path, open_quotes="accept")
    rows = (
        spark.read.schema(SALES_SCHEMA)
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("emptyValue", _EMPTY_MARK)
        .option("nullValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampNTZFormat", DATE_WITH_OPTIONAL_TIME)
        .csv(path)
    )
    texts = [field.name for field in SALES_SCHEMA if isinstance(field.dataType, T.StringType)]
    return rows.withColumns({n: F.when(F.col(n) == _EMPTY_MARK, "").otherwise(F.col(n)) for n in texts})
