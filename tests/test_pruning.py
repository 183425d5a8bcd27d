"""What a resumed load reads of its sources."""

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from partload import jobs
from partload.plans.inputs import MONTH, month, table
from partload.sources import storage


def plan_of(df):
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def files_of(df):
    """Files that rows of a frame come from."""
    return df.select(F.col("_metadata.file_path")).distinct().count()


@pytest.fixture
def by_month(spark, sf_dir, tmp_path):
    orders = table(spark, sf_dir, "orders").withColumn(MONTH, month())
    orders.repartition(MONTH).write.partitionBy(MONTH).parquet(str(tmp_path / "orders"))
    return spark.read.parquet(str(tmp_path / "orders"))


@pytest.mark.parametrize("listed,sign", [(1000, " IN "), (2, ">=")])
def test_plan_values_prune_partitions(spark, by_month, monkeypatch, listed, sign):
    """A few values are listed, and are all that is read; many become a range, within which rows are looked up."""
    monkeypatch.setattr(jobs, "LISTED_VALUES", listed)
    months = sorted(str(r[0]) for r in by_month.select(MONTH).distinct().collect())
    wanted = storage.materialise(spark.createDataFrame([(m,) for m in (months[3], months[5], months[6])], f"{MONTH} string"))
    pruned, exact = jobs.prune({"a": by_month}, wanted, [MONTH])
    filters = next(x for x in plan_of(pruned["a"]).splitlines() if x.startswith("PartitionFilters"))
    assert sign in filters
    got = sorted(str(r[0]) for r in pruned["a"].select(MONTH).distinct().collect())
    assert exact == (listed == 1000)
    assert got == ([months[3], *months[5:7]] if exact else months[3:7])
    assert files_of(pruned["a"]) == len(got) < files_of(by_month)


@pytest.mark.parametrize("listed", [1000, 1])
def test_pruning_keeps_every_wanted_row(spark, monkeypatch, listed):
    """Nulls, empty and odd texts, numbers of other types, and a plan without values."""
    monkeypatch.setattr(jobs, "LISTED_VALUES", listed)
    texts = spark.createDataFrame([("b", 1), ("", 2), (None, 3), ("B", 4), ("10", 5), ("z'", 6)], "k string, v int")
    longs = spark.createDataFrame([(10, 1), (None, 2), (9, 3), (-1, 4)], "k bigint, v int")
    doubles = spark.createDataFrame([(10.0, 1), (None, 2), (9.5, 3)], "k double, v int")
    tables = {"t": texts, "l": longs, "d": doubles}
    for plan in ([("10",), (None,)], [("b",), ("z'",)], [("9.5",), ("-1",)], []):
        wanted = spark.createDataFrame(plan, "k string")
        every = {t: jobs.values_filter(df, [{"k": p[0]} for p in plan]) for t, df in tables.items()}
        pruned, exact = jobs.prune(tables, wanted, ["k"])
        for name, df in tables.items():
            want = {r.v for r in df.where(every[name]).collect()}
            got = {r.v for r in pruned[name].collect()}
            assert got == want if exact else got >= want
    two, exact = jobs.prune({"t": texts}, spark.createDataFrame([("b", "1")], "k string, v string"), ["k", "v"])
    assert not exact and [r.v for r in two["t"].collect()] == [1]
