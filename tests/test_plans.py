"""Physical plans: what reaches the scan, what is shuffled, and what must not be there."""

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from partload import jobs
from partload.operators import loading, reconcile, state, units
from partload.plans.inputs import DATE, MONTH, order_tables, orders_job, table
from partload.sources import storage
from partload.sources.tables import restrict, scoped_scan
from partload.spec import RunSetting


def plan_of(df):
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def test_scoped_scan_pushes_filter_and_columns(spark, sf_dir):
    df = scoped_scan(table(spark, sf_dir, "lineitem"), ["l_orderkey"], {"l_returnflag": "A"})
    plan = plan_of(df)
    assert "EqualTo(l_returnflag,A)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in plan
    assert "Exchange" not in plan


def test_capped_scan_keeps_the_top_rows_per_task(spark, sf_dir):
    df = scoped_scan(
        table(spark, sf_dir, "lineitem"), ["l_orderkey"], order_by=["l_orderkey"], limit=5
    )
    assert "TakeOrderedAndProject" in plan_of(df)


def test_planning_reads_key_columns_and_counts_before_the_shuffle(spark, sf_dir):
    plan = plan_of(units.unit_counts(order_tables(spark, sf_dir), [MONTH]))
    assert "o_totalprice" not in plan and "o_orderpriority" not in plan
    tree = plan.split("(1) Scan")[0]
    assert "partial_count" in plan and tree.count("Exchange") == 1
    assert tree.index("Exchange") < tree.rindex("HashAggregate")


def test_value_filter_reaches_the_scan(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    one = plan_of(orders.where(jobs.values_filter(orders, [{"o_custkey": "7"}])))
    assert "EqualTo(o_custkey,7)" in one or "In(o_custkey, [7])" in one
    many = plan_of(orders.where(jobs.values_filter(orders, [{"o_orderstatus": "F"}, {"o_orderstatus": "O"}])))
    assert "In(o_orderstatus, [F,O])" in many
    null = plan_of(orders.where(jobs.values_filter(orders, [{"o_custkey": None}])))
    assert "IsNull(o_custkey)" in null


def test_target_count_reads_no_columns_and_prunes_partitions(spark, sf_dir):
    job, tables = orders_job(spark), order_tables(spark, sf_dir)
    jobs.load(job, tables, DATE)
    target = jobs.target_frame(spark, job, tables).where(F.col("processing_date") == DATE)
    plan = plan_of(reconcile.partition_counts(target, [MONTH]))
    assert "ReadSchema: struct<>" in plan
    assert "PartitionFilters: [isnotnull(processing_date" in plan


def test_scope_is_applied_to_counts_not_rows(spark, sf_dir):
    tables = order_tables(spark, sf_dir)
    wanted = storage.materialise(units.unit_counts(tables, [MONTH]))
    plan = plan_of(reconcile.source_counts(tables, [MONTH], wanted))
    assert "Join" not in plan and "o_totalprice" not in plan
    for scan in plan.split("Scan parquet")[2:]:
        assert "Exchange" not in scan.split("HashAggregate")[0]


def test_restricting_a_load_broadcasts_the_small_stored_plan(spark, sf_dir):
    tables = order_tables(spark, sf_dir)
    wanted = storage.materialise(units.unit_counts(tables, [MONTH]))
    frame = loading.load_frame(tables, jobs.resolve(orders_job(spark), tables), [MONTH], DATE)
    plan = plan_of(restrict(frame, wanted, [MONTH]))
    assert "BroadcastHashJoin LeftSemi" in plan and "NestedLoop" not in plan


def test_row_cap_prunes_before_every_shuffle(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    plan = plan_of(units.cap_rows(orders, ["o_orderstatus"], ["o_orderkey"], 5))
    tree = plan[: plan.index("(1) Scan")]
    assert tree.count("Exchange") == 2 and tree.count("WindowGroupLimit") == 4


def test_latest_state_aggregates_before_the_shuffle(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "value")
    plan = plan_of(state.latest_state(events, ("user_id",), ("event_id",)))
    assert "partial_max_by" in plan and "Window" not in plan


@pytest.mark.parametrize("setting,shuffles", [
    (RunSetting(layout="asis"), 0),
    (RunSetting(), 1),
    (RunSetting(files_per_partition=4), 1),
])
def test_layouts_shuffle_once_at_most(spark, sf_dir, setting, shuffles):
    frame = table(spark, sf_dir, "orders")
    tree = plan_of(loading.arrange(frame, ["o_orderstatus"], setting)).split("(1) Scan")[0]
    assert tree.count("Exchange") == shuffles
    assert "Exchange" not in plan_of(loading.arrange(frame, [], RunSetting()))


def test_asked_file_count_is_exact(spark, sf_dir, tmp_path):
    """Many input tasks and a small advisory size leave the asked number of files as it is."""
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "16kb")
    try:
        df = table(spark, sf_dir, "lineitem").repartition(24).withColumn("processing_date", F.lit(DATE))
        keys = ["l_returnflag", "l_linestatus"]
        laid = loading.arrange(df, keys, RunSetting(files_per_partition=4))
        loading.write_target(laid, str(tmp_path), partition_columns=("processing_date", *keys))
    finally:
        spark.conf.unset(size)
    found = [len(list(p.glob("part-*.parquet"))) for p in tmp_path.glob("*/*/l_linestatus=*")]
    assert found and set(found) == {4}


def test_hot_value_is_split_and_small_ones_are_joined(spark, tmp_path):
    """One value holds nearly all rows: its partition gets several files, the small ones one each."""
    size = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64kb"}
    for key, value in size.items():
        spark.conf.set(key, value)
    try:
        df = spark.range(0, 400_000, 1, 8).select(
            F.col("id"), F.md5(F.col("id").cast("string")).alias("v"),
            F.when(F.col("id") % 1000 == 0, F.col("id") / 1000 % 5 + 1).otherwise(0).cast("int").alias("k"),
            F.lit(DATE).alias("processing_date"),
        )
        loading.write_target(loading.arrange(df, ["k"]), str(tmp_path), partition_columns=("processing_date", "k"))
    finally:
        for key in size:
            spark.conf.unset(key)
    files = {p.name: len(list(p.glob("part-*.parquet"))) for p in tmp_path.glob("*/k=*")}
    assert files["k=0"] > 4
    assert [files[f"k={i}"] for i in range(1, 6)] == [1] * 5
    assert spark.read.parquet(str(tmp_path)).count() == 400_000
