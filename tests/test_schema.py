import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partload.functions import casts
from partload.operators import schema as schemas


def one(name, kind, **metadata):
    return T.StructType([T.StructField(name, kind, True, metadata or None)])


def resolve(*kinds, **options):
    return schemas.unify({f"t{i}": one("c", k) for i, k in enumerate(kinds)}, ["C"], **options)[0]


CASES = [
    ((T.DecimalType(10, 2), T.DecimalType(18, 4)), "decimal", T.DoubleType()),
    ((T.LongType(), T.DecimalType(5, 0)), "decimal", T.DoubleType()),
    ((T.FloatType(),), "decimal", T.DoubleType()),
    ((T.DateType(),), "date", T.StringType()),
    ((T.DateType(), T.TimestampType()), "date", T.StringType()),
    ((T.DateType(), T.StringType()), "date", T.StringType()),
    ((T.TimestampNTZType(), T.StringType()), "timestamp", T.StringType()),
    ((T.TimestampType(), T.LongType()), "timestamp", T.StringType()),
    ((T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()), "integer", T.LongType()),
    ((T.StringType(), T.VarcharType(4)), "char", T.StringType()),
    ((T.StringType(), T.DecimalType(5, 1)), "decimal", T.DoubleType()),
]


@pytest.mark.parametrize("kinds,family,target", CASES)
def test_precedence(kinds, family, target):
    got = resolve(*kinds)
    assert (got.name, got.family, got.target_type) == ("C", family, target)


@pytest.mark.parametrize(
    "kinds",
    [
        (T.LongType(), T.StringType()),
        (T.BooleanType(),),
        (T.BinaryType(),),
        (T.ArrayType(T.LongType()),),
        (T.MapType(T.StringType(), T.StringType()),),
        (T.DateType(), T.BooleanType()),
        (T.DateType(), T.DecimalType(5, 0)),
    ],
)
def test_unsupported_mixes_raise(kinds):
    with pytest.raises(ValueError, match="column C"):
        resolve(*kinds)


def test_strict_refuses_text_mixes():
    with pytest.raises(ValueError, match="text mixed"):
        resolve(T.StringType(), T.DecimalType(5, 0), strict=True)


def test_missing_column_names_the_tables():
    with pytest.raises(ValueError, match=r"column x not found in \['t1'\]"):
        schemas.unify({"t0": one("X", T.LongType()), "t1": one("y", T.LongType())}, ["x"])


def test_declared_lengths():
    got = resolve(T.VarcharType(10), T.CharType(20))
    assert (got.length, got.padded) == (20, True)
    declared = {"__CHAR_VARCHAR_TYPE_STRING": "char(7)"}
    got = schemas.unify({"t": one("c", T.StringType(), **declared)}, ["c"])[0]
    assert (got.length, got.padded) == (7, True)
    assert resolve(T.StringType()).length is None


PRESERVED = [
    ((T.DecimalType(12, 2), T.DecimalType(14, 3)), T.DecimalType(14, 3)),
    ((T.DecimalType(12, 2), T.LongType()), T.DecimalType(21, 2)),
    ((T.DecimalType(12, 2), T.DoubleType()), T.DoubleType()),
    ((T.DateType(), T.DateType()), T.DateType()),
    ((T.DateType(), T.TimestampType()), T.TimestampType()),
    ((T.TimestampNTZType(),), T.TimestampNTZType()),
    ((T.IntegerType(), T.LongType()), T.LongType()),
]


@pytest.mark.parametrize("kinds,target", PRESERVED)
def test_preserve_types(kinds, target):
    assert resolve(*kinds, preserve_types=True).target_type == target


def test_preserve_raises_when_no_decimal_is_wide_enough():
    with pytest.raises(ValueError, match="no decimal"):
        resolve(T.DecimalType(38, 0), T.DecimalType(38, 10), preserve_types=True)


def test_conform_casts_and_order(spark):
    df = spark.createDataFrame(
        [(1, Decimal("1.50"), dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 3, 4, 5), "", "pad  ")],
        "I int, d decimal(9,2), day date, ts timestamp_ntz, e string, p string",
    )
    declared = {"__CHAR_VARCHAR_TYPE_STRING": "char(5)"}
    df = df.withColumn("p", F.col("p").alias("p", metadata=declared))
    columns = ["ts", "i", "d", "day", "e", "p"]
    resolved = schemas.unify({"t": df.schema}, columns)
    out = df.select(*schemas.conform(df, resolved))
    assert out.columns == columns
    assert out.first() == ("2024-01-02 03:04:05.000000", 1, 1.5, "2024-01-02", None, "pad")
    kept = df.select(*schemas.conform(df, resolved, empty_as_null=False)).first()
    assert kept.e == ""


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin", "America/Sao_Paulo", "Asia/Kathmandu"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    """02:30 on that day does not exist in Berlin, nor 00:30 on the other one in Sao Paulo."""
    stamps = ["2024-03-31 02:30:00.123456", "2018-11-04 00:30:00", "2024-01-01 23:59:59.5", "1969-12-31 23:59:59.999999"]
    before = spark.conf.get("spark.sql.session.timeZone")
    df = spark.createDataFrame([(s,) for s in stamps], "s string").select(
        F.col("s").cast("timestamp_ntz").alias("wall"),
        F.to_timestamp(F.concat("s", F.lit("+00:00"))).alias("instant"),
        F.col("s").cast("timestamp_ntz").cast("date").alias("day"),
    )
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        resolved = {c: df.schema[c].dataType for c in df.columns}
        got = df.select(
            *[casts.timestamp_text(F.col(c), t).alias(f"{c}_ts") for c, t in resolved.items()],
            *[casts.date_text(F.col(c), t).alias(f"{c}_day") for c, t in resolved.items()],
        ).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    for stamp, row in zip(stamps, got):
        full = (stamp if "." in stamp else stamp + ".").ljust(26, "0")
        assert row.wall_ts == row.instant_ts == full
        assert row.wall_day == row.instant_day == row.day_day == stamp[:10]
        assert row.day_ts == stamp[:10] + " 00:00:00.000000"


def test_target_order():
    assert schemas.target_order(["A", "b", "c"], ["C", "a", "region", "B"], ["Region"]) == ["c", "A", "b"]
    with pytest.raises(ValueError, match="without a source"):
        schemas.target_order(["a"], ["a", "z"])


def test_payload_ignores_case():
    assert schemas.payload_columns(["ID", "Date_Key", "x"], ["date_key"]) == ["ID", "x"]


def metadata(spark, rows):
    return spark.createDataFrame(
        rows, "table_name string, column_name string, column_type string, column_length int"
    )


def test_resolve_metadata(spark):
    meta = metadata(
        spark,
        [
            ("t1", "amount ", "D ", 8), ("t2", "AMOUNT", "I", 4),
            ("t1", "day", "DA", 4), ("t2", "day", "CV", 10),
            ("t1", "at", "SZ", 8), ("t2", "at", "TS", 8),
            ("t1", "n", "I1", 1), ("t2", "n", "I8", 8),
            ("t1", "s", "CV", 10), ("t2", "s", "CF", 30),
            ("t1", "v", "CV", 5), ("t2", "v", "CV", None),
            ("t1", "z", "CV", None),
            ("t1", "bad", "I", 4), ("t2", "bad", "CV", 4),
            ("t1", "blob", "BO", 4),
            ("t1", "mixed", "D", 4), ("t2", "mixed", "DA", 4),
        ],
    )
    asked = spark.createDataFrame(
        [(c,) for c in ("Amount", "day", "at", "n", "s", "v", "z", "bad", "blob", "absent", "mixed")], "column_name string"
    )
    got = {r.column_name: (r.resolved_type, r.needs_cast) for r in schemas.resolve_metadata(meta, asked).collect()}
    assert got == {
        "Amount": ("DOUBLE", True), "day": ("VARCHAR(10)", True), "at": ("VARCHAR(26)", True),
        "n": ("BIGINT", False), "s": ("VARCHAR(30)", True), "v": ("VARCHAR(5)", False),
        "z": ("VARCHAR(1)", False), "bad": (None, True), "blob": (None, True), "absent": (None, None),
        "mixed": (None, True),
    }
    rows = schemas.resolve_metadata(meta, asked).where("missing").collect()
    assert [r.column_name for r in rows] == ["absent"]
    missing = schemas.missing_columns(meta, asked)
    assert [r.column_name for r in missing.collect()] == ["absent"]


def test_metadata_reads_no_data(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    found = schemas.column_metadata(spark, {"orders": orders.schema})
    assert "Scan parquet" not in found._jdf.queryExecution().toString()
    assert {r.column_name for r in found.collect()} == set(orders.columns)
    profile = schemas.profile_columns(orders, ["o_orderstatus"])
    assert "ReadSchema: struct<o_orderstatus:string>" in profile._jdf.queryExecution().toString()


def lists(spark, names):
    return spark.createDataFrame([(n, i) for i, n in enumerate(names)], "column_name string, ordinal int")


@pytest.mark.parametrize(
    "declared,real,verdict",
    [
        (["a", "B"], ["A", "b "], "same"),
        (["a", "b"], ["b", "a"], "other_order"),
        (["a", "b"], ["a", "c"], "different_set"),
    ],
)
def test_column_lists(spark, declared, real, verdict):
    checked = schemas.column_order_check(lists(spark, declared), lists(spark, real))
    assert schemas.column_list_verdict(checked).first().verdict == verdict
