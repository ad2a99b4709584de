import math
from datetime import datetime

import pandas as pd
import pytest
from helpers import values
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.functions.values import as_moment, as_number, blank_to_null, parse_date, parse_number
from ordermill.schema import MISSING_TOKENS


def texts(spark, cells):
    return spark.createDataFrame([(n, c) for n, c in enumerate(cells)], "n int, cell string")


NUMBER_TEXTS = {
    "1": 1.0,
    "1e3": 1000.0,
    " 12 ": 12.0,
    "1,000": None,
    "inf": math.inf,
    "Infinity": math.inf,
    "nan": None,
    "NaN": None,
    "0x10": None,
    "1d": None,
    "1f": None,
    "True": None,
    "": None,
    " ": None,
    "12abc": None,
    "-5": -5.0,
    "1_000": None,
    "+3": 3.0,
    "-inf": -math.inf,
    "1.": 1.0,
    ".5": 0.5,
    ".": None,
    "1e": None,
    "--1": None,
    "\t7": 7.0,
    "1e400": math.inf,
    "2.5E-2": 0.025,
    "007": 7.0,
}


def test_number_texts(spark):
    found = values(texts(spark, NUMBER_TEXTS).orderBy("n").select(parse_number(F.col("cell"))))
    assert dict(zip(NUMBER_TEXTS, (row[0] for row in found), strict=True)) == NUMBER_TEXTS


def test_number_texts_agree_with_pandas(spark):
    # A blank cell never reaches the number parser of pandas as text.
    cells = [c for c in NUMBER_TEXTS if c.strip() and c not in ("True", "1e400")]
    expected = [None if math.isnan(v) else v for v in pd.to_numeric(pd.Series(cells), errors="coerce")]
    found = [r[0] for r in values(texts(spark, cells).orderBy("n").select(parse_number(F.col("cell"))))]
    assert found == expected


def test_typed_numbers_keep_their_value_and_lose_nan(spark):
    frame = spark.createDataFrame([(1.5,), (math.nan,), (None,), (math.inf,)], "x double")
    assert values(frame.select(as_number(F.col("x"), T.DoubleType()))) == [
        (1.5,), (None,), (None,), (math.inf,),
    ]


def test_date_texts(spark):
    cells = {
        "2023-01-05": datetime(2023, 1, 5),
        "2023/01/06": None,
        "2023-13-01": None,
        "2023-1-7": datetime(2023, 1, 7),
        "2023-02-30": None,
        " 2023-01-08 ": None,
        "2023-01-05 10:11:12": None,
        "2023": None,
        "": None,
        "9999-12-31": None,
        "1600-01-01": None,
        "1677-09-21": None,
        "1677-09-22": datetime(1677, 9, 22),
        "2262-04-11": datetime(2262, 4, 11),
        "2262-04-12": None,
    }
    found = values(texts(spark, cells).orderBy("n").select(parse_date(F.col("cell"))))
    assert dict(zip(cells, (row[0] for row in found), strict=True)) == cells


def test_dates_try_formats_in_order(spark):
    frame = texts(spark, ["2023-01-05", "06/01/2023", "2023-01-07 08:09:10", "x"])
    parsed = parse_date(F.col("cell"), ["yyyy-M-d", "d/M/yyyy", "yyyy-MM-dd HH:mm:ss"])
    assert values(frame.orderBy("n").select(parsed)) == [
        (datetime(2023, 1, 5),),
        (datetime(2023, 1, 6),),
        (datetime(2023, 1, 7, 8, 9, 10),),
        (None,),
    ]
    assert frame.select(parsed.alias("d")).schema["d"].dataType == T.TimestampNTZType()


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Asia/Tokyo"])
def test_dates_do_not_depend_on_the_time_zone(spark, with_conf, zone):
    # Sao Paulo skipped midnight on 2018-11-04.
    with_conf(spark__sql__session__timeZone=zone)
    found = texts(spark, ["2018-11-04"]).select(parse_date(F.col("cell")).cast("string"))
    assert values(found) == [("2018-11-04 00:00:00",)]


def test_typed_dates(spark):
    frame = spark.sql("SELECT DATE'2023-01-05' AS d, TIMESTAMP_NTZ'1600-01-01 00:00:00' AS t")
    dtypes = {f.name: f.dataType for f in frame.schema.fields}
    found = frame.select(*(as_moment(F.col(c), dtypes[c]) for c in ("d", "t")))
    assert values(found) == [(datetime(2023, 1, 5), None)]


def test_missing_texts(spark):
    cells = [*MISSING_TOKENS, "na", "-", " NA"]
    found = [r[0] for r in values(texts(spark, cells).orderBy("n").select(blank_to_null(F.col("cell"))))]
    assert found == [None] * 19 + ["na", "-", " NA"]
