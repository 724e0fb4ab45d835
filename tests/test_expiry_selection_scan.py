import random

import pytest
from helpers import by_id, close, plan, tx_frame
from pyspark.sql import functions as F

from ledgerlens.adapters import raw_files
from ledgerlens.functions.hashing import digest
from ledgerlens.operators import expiry, quality, sampling, windows
from ledgerlens.operators.skew import HotKeys
from ledgerlens.plans.cleaning import clean_daily_text
from ledgerlens.sources.text import read_lines, read_marked, read_raw

HOT = HotKeys(hot_rows=2, max_hot_keys=1000, slice_seconds=50, shares=2)

# expiry


@pytest.mark.parametrize("policy", [HotKeys(), HOT])
@pytest.mark.parametrize("seed", range(2))
def test_segments_end_where_a_key_is_forgotten(spark, policy, seed):
    rng = random.Random(seed)
    rows = [(i, rng.randrange(2000), rng.randrange(4), 0, float(i), 0) for i in range(120)] + [(900, 2060, 9, 0, 1.0, 0)]
    rows += [(901, 2160, 9, 0, 1.0, 0), (902, 2261, 9, 0, 1.0, 0), (903, 2261, 9, 0, 1.0, 0)]  # 100 s apart, 101 s, tied
    expected = {}
    for key in {r[2] for r in rows}:
        begun = previous = None
        for i, at, *_ in sorted((r for r in rows if r[2] == key), key=lambda r: (r[1], r[0])):
            begun = at if previous is None or at - previous > 100 else begun
            previous, expected[i] = at, begun
    told = expiry.with_segment(tx_frame(spark, *rows), ["customer_id"], 100_000, policy)
    found = {i: s // 1_000_000 - 1_704_067_200 for i, (s,) in by_id(told, "_segment").items()}
    assert found == expected


def test_features_of_a_forgotten_key_start_anew(spark):
    tx = tx_frame(spark, (1, 0, 1, 1, 10.0, 0), (2, 60, 1, 1, 20.0, 0), (3, 200, 1, 1, 5.0, 0))
    for policy in (HotKeys(), HOT):
        out = expiry.expiring_features(tx, ["customer_id"], "customer", 100_000, gap=True, policy=policy)
        assert by_id(out, "tx_count_customer", "avg_tx_amount_customer", "time_since_last_tx") == {
            1: (1, 10.0, None), 2: (2, 15.0, 60.0), 3: (1, 5.0, None)
        }
        assert out.columns[: len(tx.columns)] == tx.columns and "_segment" not in out.columns


def test_expiry_of_nothing(spark):
    assert expiry.expiring_features(tx_frame(spark), ["customer_id"], "customer", 1).count() == 0


# selection by rank


def classed(spark, n):
    return spark.range(n).select(F.col("id").alias("transaction_id"), (F.col("id") % 3 == 0).cast("int").alias("tx_fraud"))


@pytest.mark.parametrize("n", [300, 30_000])
def test_rows_ranked_in_one_task_stay_bounded(spark, n):
    df = classed(spark, n)
    drawn = df.withColumn("_digest", F.concat(digest(F.lit(42), F.col("transaction_id")), F.lit("0" * 16)))
    cuts = sampling.digest_cuts(drawn, "tx_fraud", {0: n // 3, 1: n // 3}, 1, 20)
    for value, (prefix, left) in cuts.items():
        at_cut = drawn.where((F.col("tx_fraud") == value) & F.col("_digest").startswith(prefix)).count()
        assert 0 < left <= at_cut <= 20
    ours = {r[0] for r in sampling.undersample(df, prefix_digits=1, ranked_rows=20).collect()}
    digests = {r[0]: (r[1], r[2]) for r in drawn.select("transaction_id", "_digest", "tx_fraud").collect()}
    expected = set()
    for value in (0, 1):
        expected |= set(sorted((i for i, d in digests.items() if d[1] == value), key=lambda i: digests[i][0])[: n // 3])
    assert ours == expected


def test_copies_of_one_row_are_counted_not_ranked(spark):
    rows = [(7, 0, 1.0)] * 50 + [(7, 0, float(i)) for i in range(2, 12)] + [(i, 1, 0.0) for i in range(100, 120)]
    df = spark.createDataFrame(rows, "transaction_id bigint, tx_fraud int, amount double")
    out = sampling.undersample(df, prefix_digits=3, ranked_rows=1)
    assert {r[0]: r[1] for r in out.groupBy("tx_fraud").count().collect()} == {0: 20, 1: 20}
    assert out.exceptAll(df).count() == 0 and out.columns == df.columns


def test_undersample_of_nothing(spark):
    assert sampling.undersample(classed(spark, 0)).count() == 0


# trailing spans


def test_windows_grow_linearly_with_chained_calls(spark):
    mixed = [(i, 20 * i, 1 if i % 2 else i, i % 5, 1.0, 0) for i in range(30)]
    tx = tx_frame(spark, *mixed)
    steps, sizes = tx, []
    for number in range(3):
        key = ("customer_id", "terminal_id", "tx_fraud")[number]
        steps = windows.trailing_features(steps, [key], f"s{number}", {"a": 100}, policy=HOT, source=tx)
        sizes.append(steps._jdf.queryExecution().optimizedPlan().toString().count("\n"))
    assert sizes[2] - sizes[1] <= sizes[1] - sizes[0] + 3
    rows = {r["transaction_id"]: (r["count_a_s0"], r["count_a_s1"], r["count_a_s2"]) for r in steps.collect()}
    for i, at, customer, terminal, *_ in mixed:
        seen = [o for o in mixed if at - 100 < o[1] <= at]
        assert rows[i] == (sum(o[2] == customer for o in seen), sum(o[3] == terminal for o in seen), len(seen))


# one scan


def test_marked_lines_are_the_raw_rows_and_the_comments(spark, fresh_path, tmp_path):
    folder = tmp_path / "2024-01-03"
    folder.mkdir()
    odd = ["# a comment", "1,2024-01-03 00:00:00,1,2,3.5,0,2,0,0", "", "   ", '"2","x, y",3', "1,2,3,4,5,6,7,8,9,10,11", ",,", " # no comment,1"]
    (folder / "a.txt").write_bytes("\n".join(odd).encode() + b"\r\nlast,\xc3\xa9\r\n")
    marked, raw = read_marked(spark, str(tmp_path)), read_raw(spark, str(tmp_path))
    rows = marked.filter("not is_comment").drop("is_comment")
    assert rows.schema == raw.schema
    assert sorted(map(str, rows.collect())) == sorted(map(str, raw.collect())) and raw.count() == 6
    comments = marked.filter("is_comment").drop("is_comment", "file_day").collect()
    assert len(comments) == 1 and set(comments[0]) == {None}


def test_report_is_one_scan(spark, sf_dir):
    path = raw_files(spark, sf_dir)
    report = quality.quality_report(read_marked(spark, path))
    steps = plan(report, final=True)
    assert steps.count("FileScan text") == 1 and "FileScan csv" not in steps
    both = quality.quality_report(read_raw(spark, path), read_lines(spark, path))
    assert sorted(map(tuple, report.collect())) == sorted(map(tuple, both.collect()))


def test_cleaning_writes_table_rejects_and_report(spark, sf_dir, fresh_path):
    path, clean, bad, told = raw_files(spark, sf_dir), fresh_path("clean"), fresh_path("bad"), fresh_path("report")
    clean_daily_text(spark, path, clean, rejected=bad, report=told)
    report = {r["defect"]: r["row_count"] for r in spark.read.parquet(told).collect()}
    kept, rejected = spark.read.parquet(clean).count(), spark.read.parquet(bad).count()
    assert report["rows"] == read_raw(spark, path).count() and report["comment"] > 0
    assert kept < report["rows"] - rejected + 1 and kept + rejected + report["duplicate"] >= report["rows"]
