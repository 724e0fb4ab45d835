import json
import time
from datetime import datetime, timedelta
from pathlib import Path

import pyarrow as pa
import pytest
from helpers import START, by_id, close, tx_frame
from pyspark.sql import functions as F

from ledgerlens.adapters import broken_messages, message_files, transactions
from ledgerlens.operators import sampling, windows
from ledgerlens.operators.features import transaction_features
from ledgerlens.plans import catalog, modeling
from ledgerlens.session import materialize, scratch_path
from ledgerlens.streaming import jobs, messages, state


def text_files(spark, path, batches, pause=1.05):
    """One file per batch of message texts, with a pause in order of modification time."""
    for texts in batches:
        spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.mode("append").text(path)
        time.sleep(pause)
    return path


def decoded(spark, *texts):
    return messages.decode(spark.createDataFrame([(t,) for t in texts], "value string"))


GOOD = (
    '{"transaction_id":7,"tx_datetime":"2024-01-01T10:00:00","customer_id":1,"terminal_id":2,"tx_amount":3.5,'
    '"tx_time_seconds":36000,"tx_time_days":0,"tx_fraud":0,"tx_fraud_scenario":0}'
)


def test_message_form(spark):
    out = messages.encode(tx_frame(spark, (7, 36000, 1, 2, 3.5, 0))).collect()
    assert [(r["key"], r["value"]) for r in out] == [("7", GOOD)]


def test_decode_inverts_encode(spark):
    tx = tx_frame(spark, (1, 5, 1, 2, 3.5, 0), (2, 9, 3, 4, 1e9, 1))
    out = messages.usable(messages.decode(messages.encode(tx).select("value")))
    assert sorted(out.collect()) == sorted(tx.collect()) and out.dtypes == tx.dtypes


@pytest.mark.parametrize(
    ("text", "error"),
    [
        (GOOD, None),
        (GOOD[:-5], "not_json"),
        ("", "not_json"),
        ("[1]", "not_json"),
        (GOOD.replace('"transaction_id":7,', ""), "no_id"),
        (GOOD.replace("10:00:00", "10:00:00.250"), "bad_time"),
        (GOOD.replace("2024-01-01T10:00:00", "2024-01-01 10:00:00"), "bad_time"),
        (GOOD.replace('"customer_id":1,', ""), "incomplete"),
        (GOOD.replace('"terminal_id":2', '"terminal_id":null'), "incomplete"),
        (GOOD.replace("3.5", "null"), "incomplete"),
        (GOOD.replace("3.5", "NaN"), "incomplete"),
        (GOOD.replace('"tx_fraud":0,', ""), None),
    ],
)
def test_unusable_messages_are_set_aside(spark, text, error):
    out = decoded(spark, text)
    assert [r["error"] for r in messages.rejected(out).collect()] == ([error] if error else [])
    assert messages.usable(out).count() == (0 if error else 1)


def test_first_n(spark, sf_dir, fresh_path):
    path = fresh_path("sent")
    messages.write_messages(transactions(spark, sf_dir), path, n=5)
    sent = [json.loads(r["value"])["transaction_id"] for r in spark.read.text(path).collect()]
    assert sorted(sent) == [0, 1, 2, 3, 4]


STATE = ["avg_tx_amount_customer", "tx_count_customer", "sd_tx_amount_customer", "var_pop_tx_amount_customer",
         "time_since_last_tx", "avg_tx_amount_terminal", "tx_count_terminal", "sd_tx_amount_terminal",
         "var_pop_tx_amount_terminal"]


def message(i, clock, customer=1, terminal=2, amount=3.5):
    return (
        f'{{"transaction_id":{i},"tx_datetime":"2024-01-01T{clock}","customer_id":{customer},'
        f'"terminal_id":{terminal},"tx_amount":{amount}}}'
    )


def drained(spark, path, operator):
    stream = messages.usable(messages.decode(messages.read_message_files(spark, path, max_files=1)))
    return jobs.run_to_table(operator(stream), "state", source=path)


@pytest.mark.parametrize("batches", [1, 4, 20])
def test_state_does_not_depend_on_micro_batches(spark, sf_dir, fresh_path, batches):
    """Rows in no order, most of them seconds apart from the rows of other files, some of one instant."""
    tx = transactions(spark, sf_dir).withColumn("tx_datetime", F.date_trunc("hour", "tx_datetime"))
    rows = [r["value"] for r in messages.encode(tx.orderBy(F.xxhash64("transaction_id"))).collect()]
    path = text_files(spark, fresh_path("in"), [rows[i::batches] for i in range(batches)], pause=0)
    ours = drained(spark, path, lambda s: state.transaction_state(s, delay="3650 days"))
    batch = windows.running_features(tx, ["customer_id"], "customer", gap=True, population_variance=True)
    batch = windows.running_features(batch, ["terminal_id"], "terminal", population_variance=True, source=tx)
    left, right = by_id(ours, *STATE), by_id(batch, *STATE)
    assert len(left) == ours.count() == len(rows) and ours.where("late_customer or late_terminal").isEmpty()
    assert left.keys() == right.keys()
    for i in left:
        assert all(close(a, b) for a, b in zip(left[i], right[i])), (left[i], right[i])


@pytest.mark.parametrize("delay", ["0 seconds", "1 hour", "2 days"])
def test_kept_rejected_and_late_are_the_input(spark, sf_dir, fresh_path, delay):
    tx = transactions(spark, sf_dir)
    rows = [r["value"] for r in broken_messages(tx.orderBy(F.xxhash64("transaction_id"))).collect()]
    path = text_files(spark, fresh_path("in"), [rows[i::4] for i in range(4)], pause=0)
    ours = drained(spark, path, lambda s: state.transaction_state(s, delay=delay))
    decoded_rows = messages.decode(spark.createDataFrame([(v,) for v in rows], "value string"))
    assert ours.count() + messages.rejected(decoded_rows).count() == len(rows)
    late = ours.where("late_customer")
    assert not late.isEmpty() and late.where("tx_count_customer is not null or avg_tx_amount_customer is not null").isEmpty()
    kept = ours.where("not late_customer")
    assert kept.where("tx_count_customer is null or time_since_last_tx < 0").isEmpty()
    newest = kept.groupBy("customer_id").agg(F.max("tx_count_customer").alias("n"), F.count(F.lit(1)).alias("rows"))
    assert newest.where("n <> rows").isEmpty()


def test_instants_repeats_and_late_rows(spark, fresh_path):
    first = [message(3, "10:00:00", amount=6), message(1, "09:00:00", amount=1), message(2, "10:00:00", amount=2)]
    second = [message(4, "15:00:00"), message(3, "10:00:00", amount=6)]
    third = [message(5, "10:00:00"), message(6, "09:30:00"), message(7, "14:00:00", customer=9)]
    fourth = [message(8, "15:00:00", customer=8)]
    fifth = [message(9, "09:00:00", amount=100), message(4, "15:00:00")]
    # The second file moves the watermark to 14:00, so the third releases the first, with its own rows.
    path = text_files(spark, fresh_path("in"), [first, second, third, fourth, fifth])
    out = drained(spark, path, state.customer_state)
    got = {}
    for r in out.collect():
        got.setdefault(r["transaction_id"], []).append((r["tx_count_customer"], r["late_customer"], r["time_since_last_tx"]))
    assert got == {
        1: [(1, False, None)],
        6: [(2, False, 1800.0)],
        2: [(5, False, 1800.0)],
        3: [(5, False, 0.0)],
        5: [(5, False, 0.0)],
        4: [(6, False, 18000.0)],
        7: [(1, False, None)],
        8: [(1, False, None)],
        9: [(None, True, None)],
    }


def test_state_that_expires(spark, fresh_path):
    files = [[message(1, "10:00:00")], [message(2, "12:00:00", terminal=3)], [message(3, "13:00:00", terminal=3)],
             [message(4, "14:00:00")]]
    for ttl_ms, count in ((None, 2), (60_000, 1)):
        path = text_files(spark, fresh_path("in"), files)
        out = drained(spark, path, lambda s: state.terminal_state(s, ttl_ms, "0 seconds"))
        assert by_id(out, "tx_count_terminal") == {1: (1,), 2: (1,), 3: ((2,) if ttl_ms is None else (1,)), 4: (count,)}


def test_joined_state_equals_chained_state(spark, sf_dir):
    path = message_files(spark, messages.encode(transactions(spark, sf_dir)).select("value"))

    def stream():
        return messages.usable(messages.decode(messages.read_message_files(spark, path)))

    chained = jobs.run_to_table(state.transaction_state(stream()), "chained", source=path)
    joined = jobs.run_to_table(jobs.joined_state(stream()), "joined", source=path)
    assert joined.count() == chained.count() == transactions(spark, sf_dir).count()
    assert sorted(joined.columns) == sorted(chained.columns)
    columns = ["tx_count_customer", "avg_tx_amount_customer", "tx_count_terminal", "avg_tx_amount_terminal"]
    assert by_id(joined, *columns) == by_id(chained, *columns)


def test_scoring_loses_nothing_and_restarts_without_copies(spark, sf_dir, fresh_path):
    tx = transactions(spark, sf_dir)
    table = materialize(transaction_features(tx), "features")
    model = modeling.fit(sampling.split(table)[0], modeling.logistic(20))
    source, target, bad, checkpoint = (fresh_path(n) for n in ("in", "out", "bad", "checkpoint"))
    lines = [r["value"] for r in broken_messages(tx.limit(300)).collect()]
    text_files(spark, source, [lines])

    def run():
        listened = jobs.RowsSeen()
        spark.streams.addListener(listened)
        jobs.finish(jobs.start_scoring(messages.read_message_files(spark, source), model, target, bad, checkpoint), 120)
        time.sleep(1)
        spark.streams.removeListener(listened)
        scored = [json.loads(r["value"]) for r in spark.read.text(target).collect()]
        return listened.rows, scored, spark.read.json(bad).count()

    seen, scored, rejected = run()
    unusable = sum(1 for i in range(300) if i % 67 == 0 or i % 71 == 0 or i % 73 == 0)
    assert rejected == unusable
    assert seen >= 600  # both queries read the 300 messages
    assert 0 < len(scored) <= 300 - unusable
    assert {"transaction_id", "tx_datetime"} <= set(scored[0])
    datetime.strptime(scored[0]["tx_datetime"], "%Y-%m-%dT%H:%M:%S")
    _, again, still = run()
    assert len(again) == len(scored) and still == rejected
    text_files(spark, source, [[GOOD.replace('"transaction_id":7', '"transaction_id":100007')]])
    _, more, _ = run()
    assert len({r["transaction_id"] for r in more}) == len(more) >= len(scored)
    messages.write_end(spark, source)
    _, every, rejected = run()
    assert len({r["transaction_id"] for r in every}) == len(every) == 301 - unusable and rejected == unusable
    assert {r.get("unscored") for r in every if "prediction" not in r} <= {"no_history", "late"}


def test_repeated_messages_are_dropped(spark, fresh_path):
    path = text_files(spark, fresh_path("in"), [[GOOD, GOOD], [GOOD]])
    stream = messages.usable(messages.decode(messages.read_message_files(spark, path, max_files=1)))
    assert jobs.run_to_table(messages.distinct_messages(stream), "distinct").count() == 1


def test_a_running_query_is_stopped_after_its_time(spark, fresh_path):
    path = text_files(spark, fresh_path("in"), [[GOOD]])
    stream = messages.usable(messages.decode(messages.read_message_files(spark, path)))
    query = jobs.start(
        stream, fresh_path("out"), scratch_path(spark, "checkpoint"), trigger={"processingTime": "1 second"}
    )
    began = time.time()
    jobs.finish([query], seconds=4)
    assert not query.isActive and time.time() - began < 60


def test_kafka_source_and_sink_are_only_options(spark):
    """The connector is not on the class path here, so Spark must name it as the thing that is missing."""
    with pytest.raises(Exception, match="(?i)kafka"):
        messages.read_topic(spark, "tx", {"kafka.bootstrap.servers": "localhost:1"})
    with pytest.raises(Exception, match="(?i)kafka"):
        messages.publish(tx_frame(spark, (1, 1, 1, 1, 1.0, 0)), "tx", {"kafka.bootstrap.servers": "localhost:1"}, n=1)


def test_fixture_starts_where_the_tests_think():
    assert START == datetime(2024, 1, 1)


def test_parts_are_sent_by_all_cores_and_a_micro_batch_each(spark):
    """A gap between parts; then a part too small for a file of every core."""
    cores = spark.sparkContext.defaultParallelism
    for sizes, files in (({0: 400, 2: 400}, cores), ({0: 400, 3: 1}, 1)):
        rows = [(message(1000 * p + i, f"10:{i // 60 % 60:02}:{i % 60:02}"), p) for p, n in sizes.items() for i in range(n)]
        stream, path = catalog._stream_in_order(spark, spark.createDataFrame([*rows, ("x", None)], "value string, part long"))
        written = [f for f in Path(path.removeprefix("file:")).iterdir() if f.name.startswith("part-")]
        assert len(written) == files * len(sizes)
        assert jobs.run_to_table(stream, "sent").count() == len(rows)
        written.sort(key=lambda f: f.stat().st_mtime_ns)
        batches = [written[i : i + files] for i in range(0, len(written), files)]
        found = [{json.loads(line)["transaction_id"] // 1000 for f in b for line in f.read_text().split()} for b in batches]
        assert found == [{p} for p in sizes]


def test_a_long_time_takes_no_more_micro_batches(spark):
    rows = [(message(p, "10:00:00"), p) for p in range(-1, 200)]
    _, path = catalog._stream_in_order(spark, spark.createDataFrame(rows, "value string, part long"))
    written = sorted(Path(path.removeprefix("file:")).glob("part-*"), key=lambda f: f.stat().st_mtime_ns)
    assert len(written) <= catalog.MICRO_BATCHES
    found = [sorted(json.loads(line)["transaction_id"] for line in f.read_text().split()) for f in written]
    assert sum(found, []) == list(range(-1, 200))


def test_rows_are_packed_by_share():
    schema = pa.schema([("transaction_id", pa.int64()), ("tx_datetime", pa.timestamp("us")), ("note", pa.string())])
    rows = [(i % 3 - 1, i, 1_000_000 * i, None if i % 5 == 0 else f"n{i}") for i in range(25_000)]
    zoned = pa.schema([("_share", pa.int64()), schema.field(0), ("tx_datetime", pa.timestamp("us", "Europe/Paris")), schema.field(2)])
    table = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), zoned)], schema=zoned)
    out = list(state._packing(schema)(iter([table.to_batches()[0].slice(0, 0), *table.to_batches(1000)])))
    assert [b.column("_share").to_pylist() for b in out] == [[-1, 0, 1]]
    found = []
    for share, chunk in zip(out[0].column("_share").to_pylist(), out[0].column("rows").to_pylist()):
        batch = pa.ipc.read_record_batch(pa.py_buffer(chunk), schema)
        assert batch.num_rows <= 10_000
        found += [(share, r["transaction_id"], r["tx_datetime"], r["note"]) for r in batch.to_pylist()]
    clock = datetime(1970, 1, 1, 1)
    assert sorted(found, key=lambda r: r[1]) == [(s, i, clock + timedelta(microseconds=t), n) for s, i, t, n in rows]
    assert list(state._packing(schema)(iter([]))) == []
