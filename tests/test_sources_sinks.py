import os
from pathlib import Path

import pytest
from helpers import plan
from pyspark.sql import functions as F

from ledgerlens.adapters import raw_files, transactions
from ledgerlens.functions.temporal import on_day
from ledgerlens.session import materialize, scratch_path
from ledgerlens.sinks.parquet import overwrite_days
from ledgerlens.sources import landing, tables, text


def on_disk(root, suffix):
    return [p for p in Path(root).rglob("*") if p.name.endswith(suffix) and not p.name.startswith((".", "_"))]


def test_inventory_and_size(spark, sf_dir):
    root = raw_files(spark, sf_dir)
    files = tables.list_files(spark, root)
    found = on_disk(root, ".txt")
    assert files.columns == ["path", "length", "modificationTime"]
    assert files.count() == len(found)
    assert tables.total_size(files).collect()[0]["bytes"] == sum(os.path.getsize(p) for p in found)


def test_inventory_does_not_read_contents(spark, sf_dir):
    assert "content" not in plan(tables.list_files(spark, raw_files(spark, sf_dir)))


def test_size_of_nothing_is_zero(spark, fresh_path):
    root = fresh_path("empty")
    os.makedirs(root)
    assert tables.total_size(tables.list_files(spark, root)).collect()[0]["bytes"] == 0


def test_datasets_and_choice(spark, fresh_path):
    root = fresh_path("lake")
    for name in ("2024-01-01.txt", "2024-01-02.txt", "other"):
        spark.range(1).write.parquet(f"{root}/{name}")
    files = tables.list_files(spark, root, "*.parquet")
    names = tables.list_datasets(files, root)
    assert {r["dataset"] for r in names.collect()} == {"2024-01-01.txt", "2024-01-02.txt"}
    picks = {s: tables.pick_dataset(names, s).collect()[0]["dataset"] for s in range(12)}
    assert len(set(picks.values())) == 2
    assert all(tables.pick_dataset(names, s).collect()[0]["dataset"] == picks[s] for s in (0, 1))


def test_lines_keep_comments(spark, sf_dir):
    path = raw_files(spark, sf_dir)
    lines, raw = text.read_lines(spark, path), text.read_raw(spark, path)
    comments = lines.filter(F.col("value").startswith("#")).count()
    assert comments > 0 and lines.count() == raw.count() + comments
    assert text.read_lines(spark, path).limit(3).count() == 3


def test_landing_keeps_every_line(spark, sf_dir, fresh_path):
    source, target = raw_files(spark, sf_dir), fresh_path("landed")
    landing.land(spark, source, target)
    before = sorted(r["value"] for r in text.read_lines(spark, source).collect())
    after = sorted(r["value"] for r in text.read_lines(spark, target).collect())
    assert before == after
    one_day = sorted(p["path"] for p in tables.list_files(spark, source).collect())[0].rsplit("/", 1)[0]
    landing.land(spark, one_day, target)  # replaces its day, keeps the others
    assert sorted(r["value"] for r in text.read_lines(spark, target).collect()) == before
    assert text.read_raw(spark, target).filter("file_day is null").count() == 0


def test_landing_plan(spark, sf_dir):
    root = raw_files(spark, sf_dir)
    name = root.rsplit("/", 1)[-1]
    pairs = landing.landing_plan(tables.list_files(spark, root), f"{name}/", "landed/").collect()
    assert all(r["target_path"] == r["source_path"].replace(f"{name}/", "landed/", 1) for r in pairs)


def test_day_filters_prune(spark, sf_dir, fresh_path):
    target = fresh_path("days")
    tx = transactions(spark, sf_dir).withColumn("tx_date", F.to_date("tx_datetime"))
    overwrite_days(tx, target)
    by_partition = tables.read_clean(spark, target, "2024-01-05", "2024-01-05")
    assert "PartitionFilters: [isnotnull(tx_date" in plan(by_partition)
    by_time = tables.read_clean(spark, target).filter(on_day(F.col("tx_datetime"), "2024-01-05"))
    assert "GreaterThanOrEqual(tx_datetime" in plan(by_time)
    assert by_partition.count() == by_time.count() > 0


def test_only_used_columns_are_read(spark, sf_dir, fresh_path):
    target = fresh_path("days")
    overwrite_days(transactions(spark, sf_dir).withColumn("tx_date", F.to_date("tx_datetime")), target)
    out = plan(tables.read_clean(spark, target).groupBy("customer_id").agg(F.sum("tx_amount")))
    assert "ReadSchema: struct<customer_id:bigint,tx_amount:double>" in out


def test_other_days_stay(spark, sf_dir, fresh_path):
    target = fresh_path("days")
    tx = transactions(spark, sf_dir).withColumn("tx_date", F.to_date("tx_datetime"))
    overwrite_days(tx, target)
    overwrite_days(tx.filter("tx_date = '2024-01-05'").limit(1), target)
    left = tables.read_clean(spark, target)
    assert left.filter("tx_date = '2024-01-05'").count() == 1
    assert left.filter("tx_date <> '2024-01-05'").count() == tx.filter("tx_date <> '2024-01-05'").count()


def test_a_large_day_is_split_over_tasks(spark, fresh_path):
    """All rows of one day: the write must not be one task."""
    target = fresh_path("one-day")
    old = {
        k: spark.conf.get(k, None)
        for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions")
    }
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200kb")
    try:
        rows = spark.range(0, 200_000, 1, 16).selectExpr(
            "id as transaction_id", "timestamp '2024-01-05 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id % 80000) as tx_datetime",
            "id % 7 as customer_id", "id % 5 as terminal_id", "rand(1) as tx_amount", "0 as tx_time_seconds",
            "0 as tx_time_days", "0 as tx_fraud", "0 as tx_fraud_scenario", "date'2024-01-05' as tx_date",
        )
        overwrite_days(rows, target)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert tables.read_clean(spark, target).count() == 200_000
    assert len(on_disk(target, ".parquet")) > 1


def test_materialized_table_equals_its_plan(spark, sf_dir):
    tx = transactions(spark, sf_dir)
    table = materialize(tx, "tx")
    assert table.dtypes == tx.dtypes and sorted(table.collect()) == sorted(tx.collect())
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert scratch_path(spark, "x").startswith(shared)


class _Context:
    """Stands for the context of a session whose configuration names no shared folder."""

    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class _Session:
    def __init__(self, master):
        self.sparkContext, self.conf = _Context(master), {}


def test_only_a_local_session_may_use_a_temporary_folder():
    local = _Session("local[2]")
    first, second = scratch_path(local, "a"), scratch_path(local, "b")
    assert first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0] == local.sparkContext.folder
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(_Session("spark://host:7077"), "a")
