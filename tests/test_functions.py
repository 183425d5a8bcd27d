import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partload.functions import casts, keys, text, times


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "spec,static,dynamic",
    [
        (None, [], []),
        ("", [], []),
        ("date_key", [], ["date_key"]),
        ("region = EU, date_key ,,kind=a=b", ["region", "kind"], ["date_key"]),
        (" , ", [], []),
    ],
)
def test_partition_lists(spark, spec, static, dynamic):
    col = F.lit(spec).cast("string")
    assert value(spark, text.static_partitions(col)) == static
    assert value(spark, text.dynamic_partitions(col)) == dynamic
    assert value(spark, text.has_dynamic_partition(col)) == bool(dynamic)


def test_split_on_semicolons(spark):
    assert value(spark, text.split_list(F.lit("a; b;;c"), ";")) == ["a", "b", "c"]


def test_split_uri(spark):
    assert tuple(value(spark, text.split_uri(F.lit("obs://bucket/a/b")))) == ("bucket", "/a/b")
    assert value(spark, text.split_uri(F.lit("/a/b"))) is None
    assert value(spark, text.split_uri(F.lit(None).cast("string"), strict=True)) is None
    with pytest.raises(Exception, match="not a host and path"):
        value(spark, text.split_uri(F.lit("bucket/a"), strict=True))


def test_schemes(spark):
    assert value(spark, text.with_scheme(F.lit("https://h/p"), "obs")) == "obs://h/p"
    assert value(spark, text.without_scheme(F.lit("https://h/p"))) == "h/p"


def test_quote_line(spark):
    line = text.quote_line(F.lit('a"b'), F.lit(None).cast("string"), F.lit("c"))
    assert value(spark, line) == '"a""b"\x1f""\x1f"c"'


@pytest.mark.parametrize(
    "number,kind,expected",
    [
        (Decimal("7.00"), T.DecimalType(9, 2), "7"),
        (Decimal("7.50"), T.DecimalType(9, 2), "7.5"),
        (Decimal("700"), T.DecimalType(9, 0), "700"),
        (Decimal("100.00"), T.DecimalType(9, 2), "100"),
        (7.0, T.DoubleType(), "7"),
        (7.25, T.DoubleType(), "7.25"),
        (float("nan"), T.DoubleType(), "NaN"),
        (7, T.LongType(), "7"),
        ("", T.StringType(), None),
        ("x", T.StringType(), "x"),
        (dt.date(2024, 1, 2), T.DateType(), "2024-01-02"),
    ],
)
def test_partition_text(spark, number, kind, expected):
    df = spark.createDataFrame([(number,)], T.StructType([T.StructField("v", kind)]))
    assert df.select(casts.partition_text(F.col("v"), kind)).first()[0] == expected


AWKWARD = ["plain", "a/b", "x=y", "50%", "a b", "q?", "c:d", "it's", 'say "hi"', "tab\there", "[1]", "{2}", "é", "a#b", "^"]


def test_directory_names_agree_with_the_writer(spark, tmp_path):
    df = spark.createDataFrame([(v, 1) for v in [*AWKWARD, None]], "k string, n int")
    df.write.partitionBy("k").parquet(str(tmp_path / "t"))
    on_disk = {p.name for p in (tmp_path / "t").glob("k=*")}
    by_column = {f"k={r[0]}" for r in df.select(keys.escape_col(F.col("k"))).collect()}
    by_python = {f"k={keys.escape_value(v)}" for v in [*AWKWARD, None]}
    assert by_column == on_disk == by_python


def test_unit_texts(spark):
    df = spark.createDataFrame([("7", "it's", None)], "a string, b string, c string")
    names = ["a", "b", "c"]
    values = keys.values_map(names)
    row = df.select(
        keys.unit_label(values).alias("label"),
        keys.unit_key(F.lit("t"), values).alias("key"),
        keys.unit_key(F.lit("t:1"), keys.values_map([])).alias("static"),
        keys.partition_spec_text(values).alias("spec"),
        keys.where_text(names, ["a"]).alias("where"),
        keys.where_text([]).alias("no_where"),
        keys.partition_path("/base/", "processing_date", F.lit("2024-01-01"), values).alias("path"),
        keys.sorted_entries(keys.values_map(["c", "a"])).alias("entries"),
    ).first()
    null = keys.NULL_PARTITION
    assert row.label == f"7_it's_{null}" and row.key == f"t:a=7/b=it%27s/c={null}"
    assert row.static == "t%3A1:"
    assert row.spec == f'a="7", b="it\'s", c="{null}"'
    assert row.where == "a = 7 AND b = 'it''s' AND c IS NULL" and row.no_where == ""
    assert row.path == f"/base/processing_date=2024-01-01/a=7/b=it%27s/c={null}"
    assert [tuple(e) for e in row.entries] == [("a", "7"), ("c", None)]


def test_match_values(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "a")], "k int, v string")
    assert df.where(keys.match_values({"k": 1, "v": None})).count() == 1
    assert df.where(keys.match_values({"k": 1})).count() == 2
    assert df.where(keys.match_values({})).count() == 3


@pytest.mark.parametrize(
    "path,expected",
    [
        ("s3://b/t/processing_date=2024-01-31/", dt.date(2024, 1, 31)),
        ("/t/processing_date=2024-01-31/k=1/part-0", dt.date(2024, 1, 31)),
        ("/t/processing_date=2024-01-31", dt.date(2024, 1, 31)),
        ("/t/processing_date=20240131/", None),
        ("/t/processing_date=2024-13-45/", None),
        ("/t/_temporary", None),
    ],
)
def test_date_from_path(spark, path, expected):
    assert value(spark, times.date_from_path(F.lit(path))) == expected


def test_seconds_between_keeps_the_fraction(spark):
    start = F.lit("2024-01-01 00:00:00.25").cast("timestamp")
    end = F.lit("2024-01-02 00:00:00.75").cast("timestamp")
    assert value(spark, times.seconds_between(start, end)) == 86400.5
