import math
from datetime import datetime

import pytest
from helpers import by_id, plan, tx_frame
from pyspark.sql import functions as F

from ledgerlens.adapters import rule_scores, transactions
from ledgerlens.operators import abtest, metrics, registry, sampling, scaling
from ledgerlens.plans.training import run_ab_test


def labelled(spark, *rows):
    return spark.createDataFrame(list(rows), "transaction_id bigint, tx_fraud int, prediction double")


def test_split_is_a_partition_and_stable(spark, sf_dir):
    tx = transactions(spark, sf_dir)
    train, test = sampling.split(tx)
    left, right = set(by_id(train)), set(by_id(test))
    assert not left & right and len(left | right) == tx.count()
    assert 0.75 < len(left) / tx.count() < 0.85
    assert set(by_id(sampling.split(tx.repartition(11))[0])) == left
    assert "Exchange" not in plan(train)
    assert set(by_id(sampling.split(tx, seed=1)[0])) != left


@pytest.mark.parametrize("digits", [1, 2, 5])
def test_undersample_is_exact_for_any_prefix(spark, sf_dir, digits):
    tx = transactions(spark, sf_dir)
    counts = {r["tx_fraud"]: r["row_count"] for r in metrics.class_counts(tx).collect()}
    out = sampling.undersample(tx, prefix_digits=digits)
    rows = out.collect()
    assert len({r["transaction_id"] for r in rows}) == len(rows)
    assert metrics.class_counts(out).collect()[0]["row_count"] == min(counts.values())
    assert len(rows) == 2 * min(counts.values())
    assert out.columns == tx.columns


def test_undersample_with_one_class_keeps_all(spark):
    df = labelled(spark, (1, 0, 0.0), (2, 0, 0.0))
    assert sampling.undersample(df).count() == 2


def test_sample_classes(spark, sf_dir):
    out = sampling.sample_classes(transactions(spark, sf_dir), {0: 0.0, 1: 1.0})
    assert {r["tx_fraud"] for r in out.collect()} == {1}


def test_bootstrap_weights(spark):
    df = spark.range(20000).withColumnRenamed("id", "transaction_id")
    drawn = sampling.bootstrap(df, replicates=3, fraction=0.1)
    sizes = {r["replicate"]: r["n"] for r in drawn.groupBy("replicate").agg(F.sum("weight").alias("n")).collect()}
    assert set(sizes) == {1, 2, 3} and len(set(sizes.values())) == 3
    assert all(abs(n - 2000) < 5 * math.sqrt(2000) for n in sizes.values())
    again = sampling.bootstrap(df.repartition(7), replicates=3, fraction=0.1)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, drawn.collect()))


def test_metrics_by_hand(spark):
    # fraud: 2 hits, 1 false alarm, 1 miss; other: 4 hits
    rows = [(1, 1.0)] * 2 + [(0, 1.0)] + [(1, 0.0)] + [(0, 0.0)] * 4
    df = labelled(spark, *[(i, y, p) for i, (y, p) in enumerate(rows)])
    counts = metrics.confusion(df)
    report = {r["class"]: r for r in metrics.class_report(counts).collect()}
    assert report[1.0]["precision"] == pytest.approx(2 / 3) and report[1.0]["recall"] == pytest.approx(2 / 3)
    assert report[0.0]["precision"] == pytest.approx(4 / 5) and report[0.0]["support"] == 5
    out = metrics.weighted_metrics(counts).collect()[0]
    assert out["accuracy"] == pytest.approx(6 / 8) == metrics.accuracy(df).collect()[0]["accuracy"]
    assert out["precision"] == pytest.approx(2 / 3 * 3 / 8 + 4 / 5 * 5 / 8)
    matrix = {r["label"]: (r["predicted_0"], r["predicted_1"]) for r in metrics.confusion_matrix(counts).collect()}
    assert matrix == {0.0: (4, 1), 1.0: (1, 2)}


def test_class_never_predicted_has_precision_zero(spark):
    counts = metrics.confusion(labelled(spark, (1, 1, 0.0), (2, 0, 0.0)))
    report = {r["class"]: (r["precision"], r["recall"], r["f1"]) for r in metrics.class_report(counts).collect()}
    assert report[1.0] == (0.0, 0.0, 0.0) and report[0.0][0] == 0.5


def test_metrics_equal_sparks_evaluator(spark, sf_dir):
    from ledgerlens.plans.modeling import evaluate

    scored = rule_scores(transactions(spark, sf_dir), 60.0)
    ours = metrics.weighted_metrics(metrics.confusion(scored)).collect()[0].asDict()
    theirs = evaluate(scored)
    assert ours == pytest.approx(theirs, abs=1e-10)


def test_metrics_of_nothing(spark):
    out = metrics.weighted_metrics(metrics.confusion(labelled(spark))).collect()
    assert [tuple(r) for r in out] == [(None, None, None, None)]


def test_scaling(spark, sf_dir):
    tx = transactions(spark, sf_dir)
    out = scaling.standardize(tx, ["tx_amount"]).agg(F.avg("tx_amount"), F.stddev_pop("tx_amount")).collect()[0]
    assert out[0] == pytest.approx(0, abs=1e-12) and out[1] == pytest.approx(1)
    out = scaling.unit_deviation(tx, ["tx_amount"])
    assert out.agg(F.stddev_samp("tx_amount")).collect()[0][0] == pytest.approx(1)
    constant = tx_frame(spark, (1, 0, 1, 1, 5.0, 0), (2, 1, 1, 1, 5.0, 0))
    assert {r["tx_amount"] for r in scaling.standardize(constant, ["tx_amount"]).collect()} == {0.0}
    assert "CartesianProduct" not in plan(out) and "NestedLoop" not in plan(out)


def test_scaling_with_statistics_of_another_table(spark):
    train = tx_frame(spark, (1, 0, 1, 1, 0.0, 0), (2, 1, 1, 1, 2.0, 0))
    other = tx_frame(spark, (3, 0, 1, 1, 5.0, 0))
    assert by_id(scaling.standardize(other, ["tx_amount"], fit_on=train), "tx_amount") == {3: (4.0,)}


def summary(spark, *rows):
    return spark.createDataFrame(list(rows), "metric string, mean double, std double")


def test_summary_of_samples(spark):
    samples = spark.createDataFrame([("f1", v) for v in (1.0, 2.0, 3.0, 4.0, 5.0)], "metric string, value double")
    row = abtest.summarize(samples).collect()[0]
    assert (row["mean"], row["std"]) == (3.0, pytest.approx(math.sqrt(2)))
    assert (row["low"], row["high"]) == (pytest.approx(1.1), pytest.approx(4.9))


def test_z_test_by_hand(spark):
    new = summary(spark, ("f1", 0.9, 0.03), ("recall", 0.8, 0.0), ("accuracy", 0.7, 0.1))
    old = summary(spark, ("f1", 0.8, 0.04), ("recall", 0.7, 0.0))
    out = {r["metric"]: r for r in abtest.compare(new, old).collect()}
    assert out["f1"]["z_score"] == pytest.approx(2.0)
    assert out["f1"]["p_value"] == pytest.approx(math.erfc(2 / math.sqrt(2)))
    assert out["f1"]["significant"] is True
    assert out["f1"]["decision"] == "f1 has statistically significant difference (p_value=0.045500, alpha=0.05)"
    for metric in ("recall", "accuracy"):  # no spread in either run; no previous run
        assert out[metric]["z_score"] is None and out[metric]["p_value"] is None and out[metric]["decision"] is None
    strict = {r["metric"]: r for r in abtest.compare(new, old, alpha=0.01).collect()}
    assert strict["f1"]["decision"].startswith("f1 does not have")


def test_runs_are_compared_with_their_predecessor(spark, sf_dir, fresh_path):
    path, texts, tx = fresh_path("runs"), fresh_path("decisions"), transactions(spark, sf_dir)

    def run(run_id, day, rule):
        return run_ab_test(rule_scores(tx, rule), path, "exp", run_id, datetime(2024, 1, day), decisions=texts)

    first = run("a", 1, 60.0)
    assert {r["p_value"] for r in first.collect()} == {None}
    run("b", 2, 90.0)
    third = {r["metric"]: r for r in run("c", 3, 60.0).collect()}
    runs = registry.read_runs(spark, path)
    assert {r["run_id"] for r in registry.newest_runs(runs).collect()} == {"b", "c"}
    assert registry.nth_newest_run(runs).collect()[0]["run_id"] == "b"
    b = registry.summary_of(runs, registry.nth_newest_run(runs)).collect()
    assert {r["metric"]: r["mean"] for r in b} == {m: third[m]["previous_mean"] for m in metrics.METRICS}
    logged = {(r["metric"], r["stat"]): r["value"] for r in runs.filter("run_id = 'c'").collect()}
    assert logged[("f1", "mean")] == third["f1"]["mean"] and logged[("f1", "p_value")] == third["f1"]["p_value"]
    assert set(abtest.STATS) <= {stat for _, stat in logged}
    before = runs.count()
    run("c", 3, 60.0)  # logged again: replaced, not doubled
    assert registry.read_runs(spark, path).count() == before
    assert registry.before_run(runs, "other", "x").count() == 0
    runs = registry.read_runs(spark, path)
    experiment = runs.first()["experiment"]
    assert registry.before_run(runs, experiment, "a").count() == 0  # "b" and "c" came later
    assert registry.before_run(runs, experiment, "b").count() == len(metrics.METRICS)
    logged = spark.read.parquet(texts).filter("run_id = 'c'").collect()
    assert {r["metric"]: r["decision"] for r in logged} == {m: third[m]["decision"] for m in metrics.METRICS}


def test_bootstrap_is_one_pass(spark, sf_dir):
    out = plan(abtest.bootstrap_metrics(rule_scores(transactions(spark, sf_dir), 60.0), replicates=50))
    assert out.count("Scan parquet") == 1
