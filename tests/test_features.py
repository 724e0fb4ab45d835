import random

import pytest
from helpers import START, by_id, close, plan, tx_frame
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlens.adapters import transactions
from ledgerlens.functions.temporal import THURSDAY_TO_SATURDAY
from ledgerlens.operators import features, windows
from ledgerlens.operators.skew import HotKeys, hot_keys
from ledgerlens.schemas import SCORING_SCHEMA

HOT = HotKeys(hot_rows=20, max_hot_keys=10**6, slice_seconds=50, shares=4)


def skewed(spark, seed=7):
    """One customer and one terminal hold most rows; times are tied often, some amounts are missing."""
    rng = random.Random(seed)
    rows = []
    for i in range(600):
        customer = 1 if rng.random() < 0.5 else rng.randrange(2, 60)
        terminal = 9 if rng.random() < 0.4 else rng.randrange(10, 60)
        amount = None if rng.random() < 0.05 else round(rng.uniform(1, 200), 2)
        rows.append((i, rng.randrange(0, 900), customer, terminal, amount, int(rng.random() < 0.2)))
    return tx_frame(spark, *rows)


def assert_same(left, right, columns):
    left, right = by_id(left, *columns), by_id(right, *columns)
    assert left.keys() == right.keys()
    for key in left:
        assert all(close(a, b) for a, b in zip(left[key], right[key])), (key, left[key], right[key])


def test_equal_times_see_each_other(spark):
    df = tx_frame(spark, (1, 0, 1, 1, 10.0, 0), (2, 0, 1, 1, 20.0, 0), (3, 5, 1, 1, 60.0, 1))
    out = by_id(
        windows.running_features(df, ["customer_id"], "c", gap=True, prior_fraud=True),
        "avg_tx_amount_c", "tx_count_c", "time_since_last_tx", "prior_fraud_c",
    )
    assert out == {1: (15.0, 2, None, 0), 2: (15.0, 2, 0.0, 0), 3: (30.0, 3, 5.0, 0)}


def test_single_transaction_has_no_spread_and_is_dropped(spark):
    df = tx_frame(spark, (1, 0, 1, 1, 10.0, 0), (2, 9, 1, 1, 20.0, 0), (3, 20, 2, 1, 5.0, 0))
    assert by_id(windows.running_features(df, ["customer_id"], "c"), "sd_tx_amount_c")[3] == (None,)
    assert set(by_id(features.transaction_features(df))) == {2}


def test_nan_amount_is_dropped(spark):
    df = tx_frame(spark, (1, 0, 1, 1, 10.0, 0), (2, 9, 1, 1, 20.0, 0), (3, 20, 1, 1, float("nan"), 0))
    assert set(by_id(features.transaction_features(df))) == {2}


def test_empty_input(spark):
    df = tx_frame(spark)
    assert features.transaction_features(df).count() == 0
    assert windows.trailing_features(df, ["customer_id"], "c", {"1h": 3600}).count() == 0
    assert windows.key_statistics(df, ["customer_id"], "c").count() == 0


def test_unlabelled_transactions_have_features(spark, sf_dir):
    unlabelled = transactions(spark, sf_dir).select(*SCORING_SCHEMA.fieldNames())
    labelled = features.transaction_features(transactions(spark, sf_dir))
    assert features.transaction_features(unlabelled, policy=HOT).count() == labelled.count()


def test_gap_unit(spark):
    df = tx_frame(spark, (1, 0, 1, 1, 1.0, 0), (2, 500, 1, 1, 1.0, 0))
    out = windows.running_features(df, ["customer_id"], "c", gap=True, unit_divisor=1000)
    assert by_id(out, "time_since_last_tx")[2] == (0.5,)


def test_weekend_days(spark):
    days = [(d, d * 86400, 1, 1, 1.0, 0) for d in range(7)]  # Monday 2024-01-01 to Sunday
    df = tx_frame(spark, *days)
    standard = by_id(features.calendar_features(df), "is_weekend")
    assert [standard[d][0] for d in range(7)] == [0, 0, 0, 0, 0, 1, 1]
    other = by_id(features.calendar_features(df, THURSDAY_TO_SATURDAY), "is_weekend")
    assert [other[d][0] for d in range(7)] == [0, 0, 0, 1, 1, 1, 0]


def test_hour_dummies_drop_the_first_level(spark):
    df = tx_frame(spark, (1, 0, 1, 1, 1.0, 0), (2, 5 * 3600, 1, 1, 1.0, 0))
    out = features.calendar_features(df)
    dummies = [f"tx_hour_{h}" for h in range(1, 24)]
    assert "tx_hour_0" not in out.columns
    assert by_id(out, *dummies)[1] == (0,) * 23
    assert by_id(out, *dummies)[2] == tuple(int(h == 5) for h in range(1, 24))


def test_hot_keys_are_found_exactly(spark):
    df = skewed(spark)
    counts = {r["customer_id"]: r["count"] for r in df.groupBy("customer_id").count().collect()}
    found = {r[0] for r in hot_keys(df, ["customer_id"], HOT).collect()}
    assert found == {k for k, n in counts.items() if n > HOT.hot_rows} == {1}


def test_no_more_hot_keys_than_allowed(spark):
    few = HotKeys(hot_rows=0, max_hot_keys=5)
    assert hot_keys(skewed(spark), ["customer_id"], few).count() <= 5


@pytest.mark.parametrize("key", ["customer_id", "terminal_id"])
def test_sliced_running_features_equal_plain_windows(spark, key):
    df = skewed(spark)
    upto = Window.partitionBy(key).orderBy("tx_datetime")
    rows = Window.partitionBy(key).orderBy("tx_datetime", "transaction_id")
    plain = df.select(
        "transaction_id",
        F.avg("tx_amount").over(upto).alias("avg_tx_amount_k"),
        F.count("transaction_id").over(upto).alias("tx_count_k"),
        F.stddev_samp("tx_amount").over(upto).alias("sd_tx_amount_k"),
        F.var_pop("tx_amount").over(upto).alias("var_pop_tx_amount_k"),
        (F.unix_seconds("tx_datetime") - F.unix_seconds(F.lag("tx_datetime").over(rows))).alias("time_since_last_tx"),
        F.coalesce(F.sum("tx_fraud").over(rows.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(
            "prior_fraud_k"
        ),
    )
    columns = [c for c in plain.columns if c != "transaction_id"]
    for policy in (HotKeys(), HOT):
        ours = windows.running_features(
            df, [key], "k", gap=True, prior_fraud=True, population_variance=True, policy=policy
        )
        assert_same(ours, plain, columns)


@pytest.mark.parametrize("key", ["customer_id", "terminal_id"])
def test_trailing_features_equal_sliding_windows(spark, key):
    df, spans = skewed(spark), {"a": 30, "b": 200}
    order = Window.partitionBy(key).orderBy(F.unix_micros("tx_datetime"))
    plain = df.select("transaction_id", *[
        e.over(order.rangeBetween(1 - s * 1_000_000, 0)).alias(f"{what}_{name}_k")
        for name, s in spans.items()
        for what, e in (("sum", F.sum("tx_amount")), ("count", F.count("transaction_id")))
    ])
    columns = [c for c in plain.columns if c != "transaction_id"]
    for policy in (HotKeys(), HOT):
        assert_same(windows.trailing_features(df, [key], "k", spans, policy=policy), plain, columns)


def test_key_statistics_equal_plain_windows(spark):
    df, whole = skewed(spark), Window.partitionBy("customer_id")
    plain = df.select(
        "transaction_id",
        F.avg("tx_amount").over(whole).alias("avg_tx_amount_k"),
        F.count("transaction_id").over(whole).alias("tx_count_k"),
        F.stddev_samp("tx_amount").over(whole).alias("sd_tx_amount_k"),
    )
    for policy in (HotKeys(), HOT):
        ours = windows.key_statistics(df, ["customer_id"], "k", policy=policy)
        assert_same(ours, plain, ["avg_tx_amount_k", "tx_count_k", "sd_tx_amount_k"])


def test_large_amounts_do_not_cancel_in_slices(spark):
    rows = [(i, i * 10, 1, 1, 1e9 + i % 7, 0) for i in range(200)]
    df = tx_frame(spark, *rows)
    plain = df.select(
        "transaction_id",
        F.stddev_samp("tx_amount").over(Window.partitionBy("customer_id").orderBy("tx_datetime")).alias("sd"),
    )
    ours = windows.running_features(df, ["customer_id"], "c", policy=HOT).withColumnRenamed("sd_tx_amount_c", "sd")
    left, right = by_id(ours, "sd"), by_id(plain, "sd")
    assert all(close(left[k][0], right[k][0]) or abs(left[k][0] - right[k][0]) < 1e-5 for k in left)


def test_result_does_not_depend_on_partitioning(spark):
    df = skewed(spark)
    columns = ["avg_tx_amount_terminal", "tx_count_customer", "time_since_last_tx"]
    once = features.transaction_features(df.repartition(1), policy=HOT)
    again = features.transaction_features(df.repartition(13), policy=HOT)
    assert_same(once, again, columns)


def test_feature_plan_has_one_shuffle_per_key_and_no_sort_of_everything(spark, sf_dir):
    out = plan(features.transaction_features(transactions(spark, sf_dir)), final=True)
    assert out.count("Exchange hashpartitioning") == 2
    assert "rangepartitioning" not in out
    assert "Join" not in out  # no hot key: nothing but the windows is left
    assert out.count("Sort [") == 2
    assert "Python" not in out and "Pandas" not in out


def test_trailing_plan_is_one_shuffle_and_one_sort(spark, sf_dir):
    spans = {"1h": 3600, "24h": 86400, "7d": 7 * 86400}
    out = plan(windows.trailing_features(transactions(spark, sf_dir), ["customer_id"], "c", spans), final=True)
    assert out.count("Exchange hashpartitioning") == 1
    assert out.count("Sort [") == 1


def test_start_is_a_monday():
    assert START.weekday() == 0
