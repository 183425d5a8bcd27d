"""Delimited text: options, round trips of hostile fields, and bad rows."""

import random

import pytest
from pyspark.sql import types as T

from partload.functions.text import FIELD_DELIMITER as US
from partload.sources import delimited
from partload.spec import ErrorLimit

ROWS = {
    "delimiter": ["7", f"left{US}right", f"{US}", "end"],
    "carriage_return": ["8", "first half\rsecond half", "\r", "x"],
    "newline": ["line one\nline two\n\nline four", "\n", "z"],
    "quote": ['a "quoted" word', 'tail"'],
    "all_at_once": [f'{US}"\r\n{US}"', f'"{US}', "\r\"\n", "", "0", f"a{US}\n\"b\"\rc", "last"],
    "backslash": ["a\\", '\\"', "\\\\", "b\\n"],
    "crlf": ["a\r\nb", "\r\n", "c"],
    "blanks": ["  both  ", "\tin tabs\t", " "],
    "only_quotes": ['"', '""', '"""'],
    "unicode": ["héllo", "日本語", "🙂 x"],
}


def frame(spark, rows):
    width = len(rows[0])
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)])
    return spark.createDataFrame([tuple(r) for r in rows], schema)


def test_options_quote_every_field():
    options = delimited.write_options()
    assert options["quoteAll"] == "true"
    assert options["sep"] == "\x1f" and ord(options["sep"]) == 31
    assert options["quote"] == '"' and options["escape"] == '"'


def test_reader_and_writer_share_delimiter_and_quote():
    read, write = delimited.read_options(), delimited.write_options()
    for key in ("sep", "quote", "escape", "lineSep", "encoding"):
        assert read[key] == write[key]
    assert read["multiLine"] == "true" and read["nullValue"] == ""


def test_files_without_line_breaks_in_fields_split(spark, tmp_path):
    df = frame(spark, [[str(i), "x" * 50] for i in range(2000)]).coalesce(1)
    delimited.write_delimited(df, str(tmp_path))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        one = delimited.read_delimited(spark, str(tmp_path), df.schema)
        split = delimited.read_delimited(spark, str(tmp_path), df.schema, multi_line=False)
        assert one.rdd.getNumPartitions() == 1 and split.rdd.getNumPartitions() > 3
        assert split.exceptAll(one).isEmpty() and split.count() == 2000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("name", sorted(ROWS))
@pytest.mark.parametrize("keep_empty", [False, True])
def test_round_trip(spark, tmp_path, name, keep_empty):
    row = ROWS[name]
    df = frame(spark, [row])
    delimited.write_delimited(df, str(tmp_path / "out"), keep_empty=keep_empty)
    back = delimited.read_delimited(spark, str(tmp_path / "out"), df.schema, keep_empty=keep_empty)
    expected = row if keep_empty else [v or None for v in row]
    assert [list(r) for r in back.collect()] == [expected]


def test_carriage_return_first_in_file(spark, tmp_path):
    rows = [ROWS["carriage_return"], ROWS["delimiter"]]
    df = frame(spark, rows).coalesce(1)
    delimited.write_delimited(df, str(tmp_path / "out"))
    back = delimited.read_delimited(spark, str(tmp_path / "out"), df.schema)
    assert sorted(list(r) for r in back.collect()) == sorted(rows)


def test_null_and_empty(spark, tmp_path):
    df = frame(spark, [[None, "", "x"], ["", None, "y"]])
    delimited.write_delimited(df, str(tmp_path / "compat"))
    compat = delimited.read_delimited(spark, str(tmp_path / "compat"), df.schema)
    assert {tuple(r) for r in compat.collect()} == {(None, None, "x"), (None, None, "y")}
    delimited.write_delimited(df, str(tmp_path / "kept"), keep_empty=True)
    kept = delimited.read_delimited(spark, str(tmp_path / "kept"), df.schema, keep_empty=True)
    assert {tuple(r) for r in kept.collect()} == {(None, "", "x"), ("", None, "y")}


def test_quoted_line_on_disk(spark, tmp_path):
    df = frame(spark, [['a"b', "c"]]).coalesce(1)
    delimited.write_delimited(df, str(tmp_path / "out"))
    (part,) = (tmp_path / "out").glob("part-*.csv")
    assert part.read_bytes() == b'"a""b"\x1f"c"\n'


def test_many_files_and_column_choice(spark, tmp_path):
    df = frame(spark, [[str(i), f"v{i}", "z"] for i in range(10)])
    delimited.write_delimited(df.repartition(3), str(tmp_path / "a"))
    delimited.write_delimited(df.repartition(2), str(tmp_path / "b"))
    paths = [str(tmp_path / "a"), str(tmp_path / "b")]
    back = delimited.read_delimited(spark, paths, df.schema, columns=["c2", "c0"])
    assert back.columns == ["c2", "c0"] and back.count() == 20


def test_bounded_files(spark, tmp_path):
    df = frame(spark, [[str(i)] for i in range(100)]).coalesce(1)
    delimited.write_delimited(df, str(tmp_path / "out"), max_records=10)
    assert len(list((tmp_path / "out").glob("part-*.csv"))) == 10


def test_unreadable_field_fails_the_plain_read(spark, tmp_path):
    df = frame(spark, [["1"], ["x"]])
    delimited.write_delimited(df, str(tmp_path / "out"))
    with pytest.raises(Exception, match="(?i)malformed"):
        delimited.read_delimited(spark, str(tmp_path / "out"), "c0 bigint").collect()


LIMITS = [
    (ErrorLimit(record=1), False),
    (ErrorLimit(record=2), True),
    (ErrorLimit(record=0, percentage=1.0), False),
    (ErrorLimit(record=None, percentage=0.5), True),
    (ErrorLimit(record=None, percentage=0.49), False),
]


@pytest.mark.parametrize("limit,passed", LIMITS)
def test_gate(spark, tmp_path, limit, passed):
    path = tmp_path / "rows.txt"
    lines = ['"1"\x1f"1.5"', '"2"\x1f"bad"', '"3"', '""\x1f""']
    path.write_text("\n".join(lines) + "\n")
    schema = T.StructType(
        [T.StructField("k", T.LongType()), T.StructField("v", T.DoubleType())]
    )
    read = delimited.read_with_errors(spark, str(path), schema)
    row = delimited.gate(delimited.error_counts(read), limit).first()
    assert (row.total_rows, row.bad_rows, row.passed) == (4, 2, passed)
    assert delimited.good_rows(read).select("k").count() == 2


def test_gated_read(spark, tmp_path):
    path = tmp_path / "rows.txt"
    path.write_text('"1"\n"x"\n"2"\n')
    schema = T.StructType([T.StructField("k", T.LongType())])
    good = delimited.gated_read(spark, str(path), schema, ErrorLimit(record=1))
    assert sorted(r.k for r in good.collect()) == [1, 2]
    with pytest.raises(ValueError, match="1 of 3 rows"):
        delimited.gated_read(spark, str(path), schema, ErrorLimit())


def test_random_text_round_trip(spark, tmp_path):
    dice = random.Random(7)
    alphabet = ["a", " ", '"', "\\", "\r", "\n", US, ",", "\t", "é", "\\N", "'", "#"]
    rows = [
        ["".join(dice.choices(alphabet, k=dice.randint(0, 12))) or None for _ in range(3)]
        for _ in range(1500)
    ]
    df = frame(spark, [[str(i), *r] for i, r in enumerate(rows)])
    delimited.write_delimited(df, str(tmp_path / "out"))
    back = delimited.read_delimited(spark, str(tmp_path / "out"), df.schema)
    got = {r[0]: list(r)[1:] for r in back.collect()}
    assert got == {str(i): r for i, r in enumerate(rows)}


def test_short_row_is_bad_when_every_column_is_text(spark, tmp_path):
    path = tmp_path / "rows.txt"
    path.write_text('"1"\x1f"a"\n"2"\n')
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("k", "v")])
    read = delimited.read_with_errors(spark, str(path), schema)
    assert delimited.error_counts(read).first() == (2, 1)


def test_unknown_count_fails(spark):
    counts = spark.createDataFrame([(None, None)], "total_rows bigint, bad_rows bigint")
    assert not delimited.gate(counts, ErrorLimit(record=5)).first().passed
