"""How many rows and files a task of a write has."""

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from partload.operators import loading
from partload.plans import text
from partload.sources import delimited, storage


@pytest.mark.parametrize("n, files", [(0, 1), (3, 3), (10_001, 4)])
def test_even_files_without_a_shuffle_of_rows(spark, monkeypatch, n, files):
    monkeypatch.setattr(loading, "_STAGED_ROWS", 700)
    df = spark.range(n).select("id", F.col("id").cast("string").alias("a b"))
    path = storage.scratch_dir(spark) + "/even"
    monkeypatch.setattr(type(df), "repartition", None)
    loading.write_dir(df, path, "parquet", files=4)
    back = spark.read.parquet(path)
    counts = [r[1] for r in back.groupBy(F.col("_metadata.file_path")).count().collect()]
    assert storage.count_files(spark, path) == files + 1
    assert sum(counts) == n and max(counts, default=0) - min(counts, default=0) <= 1
    assert back.agg(F.countDistinct("id")).first()[0] == n


def test_split_quoted_read_writes_in_many_tasks(spark, sf_dir, tmp_path, monkeypatch):
    spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    written, write = [], delimited.write_delimited

    def watched(rows, path, **options):
        written.append(rows.rdd.getNumPartitions())
        write(rows, path, **options)

    monkeypatch.setattr(delimited, "write_delimited", watched)
    back = text.split_quoted_read(spark, str(tmp_path))
    assert written == [3]
    want = text.split_quoted_read(spark, sf_dir)
    assert back.exceptAll(want).isEmpty() and want.exceptAll(back).isEmpty()


def test_partitioned_write_keeps_files_open_and_gives_the_setting_back(spark, monkeypatch):
    df = spark.range(0, 40_000, 1, 2).select("id", (F.col("id") % 23).alias("k"))
    path = storage.scratch_dir(spark) + "/by_k"
    name, during, save = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.save
    before = spark.conf.get(name)

    def watched(self, *given, **options):
        during.append(spark.conf.get(name))
        save(self, *given, **options)

    monkeypatch.setattr(DataFrameWriter, "save", watched)
    loading.write_dir(df, path, "parquet", partition_by=["k"])
    assert int(during[0]) > 1 and spark.conf.get(name) == before
    # More values than files that stay open.
    back = spark.read.parquet(path)
    assert back.exceptAll(df).isEmpty() and back.count() == 40_000
    assert storage.count_files(spark, path) == 2 * 23 + 1
