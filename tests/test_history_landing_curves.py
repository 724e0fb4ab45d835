import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from helpers import START, by_id, close, tx_frame
from test_streaming import STATE, drained, message, text_files

from ledgerlens.operators import curves, registry, windows
from ledgerlens.sources.ledger import judge_files, land_new, read_landed
from ledgerlens.streaming import jobs, messages, state

# state from history


def history_rows(seed, n):
    rng = random.Random(seed)
    return [(i, 37 * i, rng.randrange(4), rng.randrange(3), rng.random() * 100, 0) for i in range(n)]


@pytest.mark.parametrize("cut", [0, 20, 60])
def test_stream_goes_on_where_the_history_ends(spark, fresh_path, cut):
    rows = history_rows(1, 60)
    whole = tx_frame(spark, *rows)
    history, rest = tx_frame(spark, *rows[:cut]), tx_frame(spark, *rows[cut:])
    texts = [r["value"] for r in messages.encode(rest).collect()]
    path = text_files(spark, fresh_path("in"), [texts[::2], texts[1::2]] if texts else [[""]], pause=0)
    ours = by_id(drained(spark, path, lambda s: state.transaction_state(s, delay="3650 days", history=history)), *STATE)
    batch = windows.running_features(whole, ["customer_id"], "customer", gap=True, population_variance=True)
    batch = by_id(windows.running_features(batch, ["terminal_id"], "terminal", population_variance=True, source=whole), *STATE)
    assert ours.keys() == {r[0] for r in rows[cut:]}
    for i in ours:
        assert all(close(a, b) for a, b in zip(ours[i], batch[i])), (i, ours[i], batch[i])


def test_messages_as_old_as_the_history_are_late(spark, fresh_path):
    history = tx_frame(spark, (1, 3600, 1, 2, 5.0, 0), (2, None, 1, 2, 5.0, 0), (3, 7200, None, 2, 5.0, 0), (4, 60, 9, 9, float("nan"), 0))
    path = text_files(spark, fresh_path("in"), [[message(7, "01:00:00"), message(8, "01:00:01", terminal=5)]], pause=0)
    rows = drained(spark, path, lambda s: state.customer_state(s, delay="1 day", history=history)).collect()
    found = {r["transaction_id"]: (r["late_customer"], r["tx_count_customer"]) for r in rows}
    assert found == {7: (True, None), 8: (False, 2)}


def test_amounts_so_far_of_nothing(spark):
    assert state.amounts_so_far(tx_frame(spark), "customer_id").count() == 0


def test_far_times_are_set_aside_and_the_end_is_not(spark, fresh_path):
    far = message(5, "00:00:00").replace("2024-01-01", "2199-12-31")
    farther = message(-1, "00:00:00", customer=-1, terminal=-1).replace("2024-01-01", "2300-01-01")
    path = text_files(spark, fresh_path("in"), [[message(4, "00:00:00"), far, farther]], pause=0)
    messages.write_end(spark, path)
    decoded = messages.decode(spark.read.text(path))
    assert sorted((r["error"], r["value"]) for r in messages.rejected(decoded).collect()) == sorted(
        [("far_time", far), ("far_time", farther)]
    )
    assert {r["transaction_id"] for r in messages.usable(decoded).collect()} == {4, -1}
    sooner = messages.rejected(messages.decode(spark.read.text(path), "2024-01-01T00:00:00"))
    assert sooner.count() == 3
    stream = messages.usable(messages.decode(messages.read_message_files(spark, path)))
    ours = jobs.run_to_table(state.customer_state(stream), "far")
    assert [r["transaction_id"] for r in ours.collect()] == [4]


# buckets


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("buffer", [state.Buffer(1, 60), state.Buffer(7, 1), state.Buffer(5, 600)])
def test_rows_in_buckets_are_answered_as_those_in_the_list(spark, fresh_path, seed, buffer):
    rows = history_rows(seed, 80)
    whole = tx_frame(spark, *rows)
    texts = [r["value"] for r in messages.encode(whole).orderBy("transaction_id").collect()]
    mixed = [texts[i : i + 20][::-1] for i in range(0, 80, 20)]
    path = text_files(spark, fresh_path("in"), mixed, pause=1.05)
    ours = by_id(drained(spark, path, lambda s: state.transaction_state(s, delay="10 minutes", buffer=buffer)), *STATE)
    batch = windows.running_features(whole, ["customer_id"], "customer", gap=True, population_variance=True)
    batch = by_id(windows.running_features(batch, ["terminal_id"], "terminal", population_variance=True, source=whole), *STATE)
    assert ours.keys() == batch.keys()
    for i in ours:
        assert all(close(a, b) for a, b in zip(ours[i], batch[i])), (i, ours[i], batch[i])


class Memory:
    """A state variable in memory, with what the tested processor calls."""

    def __init__(self):
        self.values, self.most = {}, 0

    def appendValue(self, value):
        self.values[len(self.values)] = value

    def updateValue(self, key, value):
        assert key not in self.values  # no chunk is rewritten
        self.values[key] = value

    def getValue(self, key):
        return self.values[key]

    def removeKey(self, key):
        del self.values[key]

    def keys(self):
        return iter(list(self.values))

    def get(self):
        return iter(list(self.values.values()))

    def clear(self):
        self.values = {}


def test_a_hot_key_is_answered_bucket_by_bucket(spark):
    """A third of 100,000 rows at one terminal: no answer is of more rows than a bucket and the list hold."""
    schema = "transaction_id long, tx_datetime timestamp, tx_amount double"
    empty = spark.createDataFrame([], schema)
    hot = state.RunningAmounts("terminal", False, None, empty.schema, None, buffer=state.Buffer(rows=2000, seconds=600))
    hot.waiting, hot.buckets = Memory(), Memory()

    class One:
        value = None

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

    class Handle:
        def registerTimer(self, at):
            pass

    class Clock:
        now = 0

        def getCurrentWatermarkInMs(self):
            return self.now

    hot.state, hot.handle, clock = One(), Handle(), Clock()
    n = 33_333
    amounts = np.random.default_rng(3).uniform(1, 100, n)
    rows = pd.DataFrame({
        "transaction_id": np.arange(n),
        "tx_datetime": pd.to_datetime(1_704_067_200 + np.arange(n) * 2, unit="s"),
        "tx_amount": amounts,
    })
    shuffled = rows.sample(frac=1, random_state=1)
    chunks = [shuffled.iloc[i : i + 5000] for i in range(0, n, 5000)]
    assert list(hot.handleInputRows((1,), iter(chunks[:4]), clock)) == []
    assert list(hot.handleInputRows((1,), iter(chunks[4:]), clock)) == []
    half = 1_704_067_200 + n  # inside a bucket
    clock.now = half * 1000
    answers = list(hot.handleExpiredTimer((1,), clock, None))
    assert sum(map(len, answers)) == n // 2 + 1 and hot.state.get()[4] == (half + 1) * 1_000_000
    clock.now = 4_000_000_000_000
    answers += list(hot.handleExpiredTimer((1,), clock, None))
    assert max(map(len, answers)) <= 2000 + 300 and not hot.buckets.values and not hot.waiting.values
    every = pd.concat(answers)
    assert every["transaction_id"].tolist() == list(range(n)) and not every["late_terminal"].any()
    assert np.allclose(every["avg_tx_amount_terminal"], np.cumsum(amounts) / np.arange(1, n + 1))
    assert hot.state.get()[4:] == (None, 0, 0)


# repeats


def test_every_message_is_answered_once(spark, fresh_path):
    """Copies that wait with their first, that come after its answer, and a late message with its copy."""
    one, two, three = message(1, "10:00:00"), message(2, "10:00:05"), message(3, "15:00:00", terminal=5)
    old = message(4, "09:00:00")
    path = text_files(spark, fresh_path("in"), [[one, one, two], [three], [one], [old], [old, two, two]], pause=1.05)
    ours = drained(spark, path, lambda s: state.transaction_state(s, delay="1 hour", remember_ms=7 * 86_400_000)).collect()
    count = lambda i, f: sum(r["transaction_id"] == i and f(r) for r in ours)
    assert [count(i, lambda r: not r["repeated_customer"]) for i in (1, 2, 3, 4)] == [1, 1, 1, 1]
    assert [count(i, lambda r: r["repeated_customer"]) for i in (1, 2, 3, 4)] == [2, 2, 0, 1]
    assert count(4, lambda r: r["late_customer"] and not r["repeated_customer"]) == 1
    kept = {r["transaction_id"]: (r["tx_count_customer"], r["tx_count_terminal"]) for r in ours if not r["late_customer"]}
    assert kept == {1: (1, 1), 2: (2, 2), 3: (3, 1)} and len(ours) == 9


def test_answered_ids_are_forgotten(spark, fresh_path):
    one, far = message(1, "00:00:00"), message(2, "23:00:00")
    path = text_files(spark, fresh_path("in"), [[one], [far], [message(3, "23:30:00")], [one]], pause=1.05)
    ours = drained(spark, path, lambda s: state.customer_state(s, delay="1 minute", remember_ms=3_600_000)).collect()
    assert sorted((r["transaction_id"], r["late_customer"], r["repeated_customer"]) for r in ours) == [
        (1, False, False), (1, True, False), (2, False, False), (3, False, False)
    ]


# landing


def lines_of(spark, target):
    return sorted((r["target_folder"], r["source_day"], r["value"]) for r in read_landed(spark, target).collect())


def write_day(spark, path, *lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)


def test_sources_stay_apart_and_files_land_once(spark, fresh_path):
    root, target = fresh_path("raw"), fresh_path("landed")
    write_day(spark, f"{root}/a/2024-01-01", "a1", "a2")
    write_day(spark, f"{root}/b/2024-01-01", "b1")
    write_day(spark, f"{root}/b/nowhere", "b2")
    assert lines_of(spark, target) == []
    assert land_new(spark, f"{root}/", target) and land_new(spark, root, target) is None
    first = [("a", "2024-01-01", "a1"), ("a", "2024-01-01", "a2"), ("b", "2024-01-01", "b1"), ("b", "unknown", "b2")]
    assert lines_of(spark, target) == first
    write_day(spark, f"{root}/a/2024-01-01", "a3")
    assert land_new(spark, f"file://{root}", target)
    assert lines_of(spark, target) == sorted([*first, ("a", "2024-01-01", "a3")])


def test_broken_landing_shows_nothing_and_changed_files_are_named(spark, fresh_path):
    root, target = fresh_path("raw"), fresh_path("landed")
    write_day(spark, f"{root}/a/2024-01-01", "a1")
    write_day(spark, f"{target}/lines/run=broken/target_folder=a/source_day=2024-01-01", "a1")  # and no entry in the ledger
    assert lines_of(spark, target) == []
    land_new(spark, root, target)
    assert lines_of(spark, target) == [("a", "2024-01-01", "a1")]
    path = judge_files(spark, root, target).first()["source_path"].removeprefix("file:")
    with open(path, "a") as f:
        f.write("more\n")
    assert [r["status"] for r in judge_files(spark, root, target).collect()] == ["changed"]
    assert land_new(spark, root, target) is None


# curves


def brute_areas(rows):
    p, n = [s for s, y in rows if y == 1], [s for s, y in rows if y == 0]
    roc = sum((a > b) + (a == b) / 2 for a in p for b in n) / len(p) / len(n)
    at = lambda s: (sum(x >= s for x in p), sum(x >= s for x, _ in rows))
    return roc, sum(at(s)[0] / at(s)[1] for s in p) / len(p)


def test_areas_equal_brute_force(spark):
    rng = random.Random(4)
    rows = [(g, rng.randrange(12) / 4 if g else rng.random(), rng.randrange(2)) for g in (None, 0, 1, 2) for _ in range(80)]
    rows += [(7, 1.0, 1), (7, 2.0, 1), (8, None, 0), (1, None, 1), (1, 2.0, None)]
    df = spark.createDataFrame(rows, "g int, probability double, tx_fraud int").repartition(7)
    found = {r["g"]: r for r in curves.areas_under_curves(df, ["g"]).collect()}
    for g in (None, 0, 1, 2):
        own = [(s, y) for h, s, y in rows if h == g and s is not None and y is not None]
        assert close(found[g]["area_under_roc"], brute_areas(own)[0]) and close(found[g]["area_under_pr"], brute_areas(own)[1])
    assert (found[7]["positives"], found[7]["negatives"], found[7]["area_under_roc"], found[7]["area_under_pr"]) == (2, 0, None, None)
    assert set(found) == {None, 0, 1, 2, 7}
    every = curves.areas_under_curves(df).first()
    scored = [(s, y) for _, s, y in rows if s is not None and y is not None]
    assert close(every["area_under_roc"], brute_areas(scored)[0])
    assert curves.areas_under_curves(df.limit(0)).count() == 0


# run registry


def test_runs_without_commit_are_invisible(spark, fresh_path):
    path, began = fresh_path("runs"), datetime(2024, 1, 1)
    registry.start_registry(spark, path)
    values = spark.createDataFrame([("f1", "mean", 0.5), ("f1", "std", 0.1)], "metric string, stat string, value double")
    registry.log_values(values, path, "e", "one", began)
    registry.log_values(values, path, "e", "two", began + timedelta(days=1), commit=False)
    assert {r["run_id"] for r in registry.read_runs(spark, path).collect()} == {"one"}
    assert registry.before_run(registry.read_runs(spark, path), "e", "three").count() == 1
    registry.commit_run(spark, path, "e", "two")
    assert registry.read_runs(spark, path).groupBy("run_id").count().count() == 2
    assert START <= began
