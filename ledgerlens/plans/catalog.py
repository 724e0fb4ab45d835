"""The registered queries: every operator on the driver's tables.

``oracle`` holds the same results as SQL. Fractions are rounded to four decimals on both sides, since
two engines add doubles in different orders; the small shift keeps exact halves off the boundary.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..adapters import (
    broken_messages,
    daily_runs,
    message_files,
    raw_files,
    raw_lines,
    rule_scores,
    shipments,
    transactions,
)
from ..functions.temporal import THURSDAY_TO_SATURDAY, is_weekend, on_day
from ..operators import abtest, cleaning, curves, features, metrics, quality, registry, sampling, scaling, windows
from ..operators.skew import DEFAULT, HotKeys
from ..session import materialize, scratch_path
from ..sinks.parquet import overwrite_days, write_new
from ..sources.landing import land
from ..sources.ledger import land_new, read_landed
from ..sources.tables import list_datasets, list_files, read_clean
from ..sources.text import read_marked, read_raw, read_typed
from ..streaming import jobs, messages, state
from . import modeling, training

# Low enough that keys of the small test tables count as hot and take the sliced path.
TINY = HotKeys(hot_rows=40, max_hot_keys=1_000_000, slice_seconds=6 * 3600, shares=8)

LOW_RULE, MIDDLE_RULE, HIGH_RULE = 60.0, 75.0, 90.0


def rounded(column: Column) -> Column:
    return F.round(column + F.lit(1e-7), 4)


def presentable(df: DataFrame) -> DataFrame:
    """Doubles rounded, times without zone."""
    shown = []
    for f in df.schema:
        if isinstance(f.dataType, T.DoubleType):
            shown.append(rounded(F.col(f.name)).alias(f.name))
        elif isinstance(f.dataType, T.TimestampType):
            shown.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            shown.append(F.col(f.name))
    return df.select(*shown)


def _new_columns(df: DataFrame, base: DataFrame) -> DataFrame:
    return presentable(df.select("transaction_id", *[c for c in df.columns if c not in base.columns]))


# Cleaning and profiles


def clean_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presentable(cleaning.clean(read_raw(spark, raw_files(spark, sf_dir))))


def clean_by_file_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_path(spark, "clean")
    overwrite_days(cleaning.clean(read_raw(spark, raw_files(spark, sf_dir))), target)
    per_day = read_clean(spark, target).groupBy("tx_date")
    return presentable(per_day.agg(F.count(F.lit(1)).alias("kept_rows"), F.sum("tx_amount").alias("total_amount")))


def clean_written_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written in order of day and id to a new path; a second write to it must fail and change nothing."""
    target, cleaned = scratch_path(spark, "clean-once"), cleaning.clean(read_raw(spark, raw_files(spark, sf_dir)))
    write_new(cleaned, target, globally_sorted=True)
    try:
        write_new(cleaned, target)
    except AnalysisException:
        kept = read_clean(spark, target)
    else:
        raise RuntimeError("written twice")
    id_ = F.col("transaction_id")
    return kept.groupBy("tx_date").agg(F.count(F.lit(1)).alias("kept_rows"), F.min(id_).alias("first_id"), F.max(id_).alias("last_id"))


def dedup_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared = transactions(spark, sf_dir).withColumn("transaction_id", F.floor(F.col("transaction_id") / 3))
    return presentable(cleaning.first_by_id(shared))


def typed_scan_lossy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presentable(cleaning.clean_typed(read_typed(spark, raw_files(spark, sf_dir))))


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_raw(spark, raw_files(spark, sf_dir))


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(read_marked(spark, raw_files(spark, sf_dir)))


def cast_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.cast_failures(_raw(spark, sf_dir))


def negative_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.negative_counts(read_typed(spark, raw_files(spark, sf_dir)))


def duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_groups(_raw(spark, sf_dir))


def quarantine_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = cleaning.quarantine(_raw(spark, sf_dir))
    return bad.groupBy("file_day", "defect").agg(F.count(F.lit(1)).alias("row_count"))


def line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_path(spark, "landed")
    land(spark, raw_files(spark, sf_dir), target)
    comment = F.startswith("value", F.lit("#"))
    return (
        spark.read.schema("value string, source_day date").text(target)
        .groupBy("source_day")
        .agg(F.count(F.lit(1)).alias("line_count"), F.count_if(comment).alias("comment_count"))
    )


def landed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources with the same days, landed one after the other, the first of them twice: lines per folder and day."""
    root, target, tx = scratch_path(spark, "sources"), scratch_path(spark, "landing"), transactions(spark, sf_dir)
    for name, rows in (("all", tx), ("odd", tx.where("transaction_id % 2 = 1"))):
        raw_lines(rows).write.partitionBy("day").text(f"{root}/{name}")
        land_new(spark, root, target)
    land_new(spark, root, target)
    comment = F.startswith("value", F.lit("#"))
    return (
        read_landed(spark, target)
        .groupBy("target_folder", F.col("source_day").cast("date").alias("source_day"))
        .agg(F.count(F.lit(1)).alias("line_count"), F.count_if(comment).alias("comment_count"))
    )


def dataset_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = raw_files(spark, sf_dir)
    files = list_files(spark, root)
    of_file = files.withColumn("dataset", F.regexp_extract("path", r"/(day=[^/]+)/", 1))
    named = list_datasets(files, root, marker="day=")
    return of_file.join(named, "dataset").groupBy("dataset").agg(F.sum("length").alias("bytes"))


def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.row_count(transactions(spark, sf_dir))


def one_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presentable(transactions(spark, sf_dir).filter(on_day(F.col("tx_datetime"), "2024-01-10")))


def valid_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = read_typed(spark, raw_files(spark, sf_dir))
    return presentable(cleaning.known_customers(typed).dropna())


# Window features


def customer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir)
    return _new_columns(features.customer_features(tx), tx)


def terminal_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir)
    return _new_columns(features.terminal_features(tx), tx)


def _feature_table(spark: SparkSession, sf_dir: str, policy: HotKeys) -> DataFrame:
    tx = transactions(spark, sf_dir)
    return presentable(features.transaction_features(tx, policy=policy))


def customer_terminal_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feature_table(spark, sf_dir, DEFAULT)


def customer_terminal_features_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feature_table(spark, sf_dir, TINY)


def _key_statistics(spark: SparkSession, sf_dir: str, key: str, suffix: str, policy: HotKeys = DEFAULT) -> DataFrame:
    tx = transactions(spark, sf_dir)
    return _new_columns(windows.key_statistics(tx, [key], suffix, policy=policy), tx)


def partition_stats_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _key_statistics(spark, sf_dir, "customer_id", "customer")


def partition_stats_terminal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _key_statistics(spark, sf_dir, "terminal_id", "terminal")


def partition_stats_terminal_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _key_statistics(spark, sf_dir, "terminal_id", "terminal", TINY)


def gap_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir)
    gaps = windows.running_features(tx, ["customer_id"], "customer", gap=True)
    return presentable(gaps.select("transaction_id", "customer_id", "time_since_last_tx"))


def _trailing(
    spark: SparkSession, sf_dir: str, key: str, suffix: str, spans: dict[str, int], policy: HotKeys = DEFAULT, **options
) -> DataFrame:
    tx = transactions(spark, sf_dir)
    return _new_columns(windows.trailing_features(tx, [key], suffix, spans, policy=policy, **options), tx)


def rolling_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trailing(spark, sf_dir, "customer_id", "customer", {"1h": windows.HOUR})


def rolling_24h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trailing(spark, sf_dir, "customer_id", "customer", {"24h": windows.DAY})


def rolling_terminal_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trailing(
        spark, sf_dir, "terminal_id", "terminal", {"1h": windows.HOUR, "24h": windows.DAY, "7d": windows.WEEK}, TINY
    )


def _span_counts(spark: SparkSession, sf_dir: str, policy: HotKeys) -> DataFrame:
    tx, spans = transactions(spark, sf_dir), {"7d": windows.WEEK, "30d": windows.MONTH}
    options = {"frequency": True, "policy": policy}
    both = windows.trailing_features(tx, ["customer_id"], "customer", spans, **options)
    both = windows.trailing_features(both, ["terminal_id"], "terminal", spans, source=tx, **options)
    kept = [c for c in both.columns if c.startswith(("count_", "per_day_"))]
    return presentable(both.select("transaction_id", *kept))


def recent_span_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _span_counts(spark, sf_dir, DEFAULT)


def recent_span_counts_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _span_counts(spark, sf_dir, TINY)


def prior_fraud(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir)
    both = windows.running_features(tx, ["customer_id"], "customer", prior_fraud=True)
    both = windows.running_features(both, ["terminal_id"], "terminal", prior_fraud=True, source=tx)
    return both.select("transaction_id", "prior_fraud_customer", "prior_fraud_terminal")


def pair_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir)
    pairs = windows.running_features(tx, ["customer_id", "terminal_id"], "pair", gap=True, prior_fraud=True)
    return _new_columns(pairs, tx)


def tied_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RANGE features of suppliers on day-level times, per supplier and day."""
    moved = windows.running_features(shipments(spark, sf_dir), ["terminal_id"], "terminal")
    return presentable(
        moved.groupBy("terminal_id", "tx_datetime").agg(
            F.count(F.lit(1)).alias("row_count"),
            F.max("tx_count_terminal").alias("tx_count_terminal"),
            F.max("avg_tx_amount_terminal").alias("avg_tx_amount_terminal"),
            F.max("sd_tx_amount_terminal").alias("sd_tx_amount_terminal"),
        )
    )


#: How long a customer or terminal is remembered in the queries with expiry.
REMEMBERED_MS = 86_400_000


def _expiring(spark: SparkSession, sf_dir: str, policy: HotKeys) -> DataFrame:
    """Running features of keys that are forgotten after a day, on whole seconds as in messages."""
    tx = transactions(spark, sf_dir).withColumn("tx_datetime", F.date_trunc("second", "tx_datetime"))
    return _new_columns(features.transaction_features(tx, policy=policy, complete=False, ttl_ms=REMEMBERED_MS), tx).drop("is_weekend")


def expiring_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _expiring(spark, sf_dir, DEFAULT)


def expiring_features_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _expiring(spark, sf_dir, TINY)


def calendar_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir)
    both = features.calendar_features(tx).withColumn(
        "is_thursday_to_saturday", is_weekend(F.col("tx_datetime"), THURSDAY_TO_SATURDAY)
    )
    return _new_columns(both, tx)


# Scaling, sampling and metrics


def _scaled(spark: SparkSession, sf_dir: str, scale: Callable) -> DataFrame:
    # Read twice, for the statistics and for the result.
    table = materialize(features.transaction_features(transactions(spark, sf_dir)), "features")
    return presentable(scale(table, features.FEATURES).select("transaction_id", *features.FEATURES))


def scaled_features_pop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scaled(spark, sf_dir, scaling.standardize)


def scaled_features_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scaled(spark, sf_dir, scaling.unit_deviation)


def undersample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presentable(sampling.undersample(transactions(spark, sf_dir)))


def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = sampling.split_column(F.col("transaction_id"))
    return transactions(spark, sf_dir).select("transaction_id", part.alias("part"))


def class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.class_counts(transactions(spark, sf_dir))


def key_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presentable(metrics.amount_moments(transactions(spark, sf_dir), "terminal_id"))


def _confusion(spark: SparkSession, sf_dir: str, by: Sequence[str] = ()) -> DataFrame:
    return metrics.confusion(rule_scores(transactions(spark, sf_dir), LOW_RULE), by)


def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _confusion(spark, sf_dir)


def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion_matrix(_confusion(spark, sf_dir))


def class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presentable(metrics.class_report(_confusion(spark, sf_dir)))


def weighted_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presentable(metrics.weighted_metrics(_confusion(spark, sf_dir, ["terminal_id"]), ["terminal_id"]))


def rule_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The amount as a fraud score: exact areas per terminal, and over all rows with no terminal."""
    tx = transactions(spark, sf_dir)
    whole = curves.areas_under_curves(tx, score="tx_amount").withColumn("terminal_id", F.lit(None).cast("long"))
    return presentable(curves.areas_under_curves(tx, ["terminal_id"], score="tx_amount").unionByName(whole))


def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presentable(metrics.accuracy(rule_scores(transactions(spark, sf_dir), LOW_RULE)))


# A/B test and run registry


def _samples(spark: SparkSession, sf_dir: str, rule: float) -> DataFrame:
    return abtest.bootstrap_metrics(rule_scores(transactions(spark, sf_dir), rule))


def bootstrap_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presentable(_samples(spark, sf_dir, LOW_RULE))


def bootstrap_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presentable(abtest.summarize(_samples(spark, sf_dir, LOW_RULE)))


def ab_z_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    new, old = (abtest.summarize(_samples(spark, sf_dir, rule)) for rule in (LOW_RULE, HIGH_RULE))
    tested = abtest.compare(new, old)
    return presentable(tested.select("metric", "z_score", "p_value", "significant", "decision"))


def ab_driver_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three rules logged as runs, not in order of their start, and one broken off before its commit; read back."""
    tx, runs, texts = transactions(spark, sf_dir), scratch_path(spark, "runs"), scratch_path(spark, "decisions")
    for run_id, day, threshold in (("first", 1, LOW_RULE), ("third", 3, HIGH_RULE), ("second", 2, MIDDLE_RULE)):
        training.run_ab_test(rule_scores(tx, threshold), runs, "rules", run_id, datetime(2024, 1, day), decisions=texts)
        half = registry.read_runs(spark, runs).where("stat = 'mean'").select("metric", "stat", "value")
        registry.log_values(half, runs, "rules", f"broken-{run_id}", datetime(2024, 2, day), commit=False)
    stored = registry.read_runs(spark, runs)
    stats = ("mean", "std", "z_score", "p_value")
    wide = stored.groupBy("run_id", "metric").agg(*[F.max(F.when(F.col("stat") == x, F.col("value"))).alias(x) for x in stats])
    decided = spark.read.parquet(texts).select("run_id", "metric", "decision")
    return presentable(wide.join(decided, ["run_id", "metric"], "left"))


def previous_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = daily_runs(transactions(spark, sf_dir))
    chosen = registry.nth_newest_run(runs, 2)
    found = chosen.join(registry.summary_of(runs, chosen), ["experiment", "run_id"])
    return presentable(found.select("experiment", "run_id", "start_time", "mean", "std"))


def newest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presentable(registry.newest_runs(daily_runs(transactions(spark, sf_dir)), 2))


# Messages and streams


def kafka_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.encode(transactions(spark, sf_dir))


def first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.encode(messages.first_n(transactions(spark, sf_dir), 1000))


def _decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.decode(broken_messages(transactions(spark, sf_dir)))


def decode_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presentable(messages.usable(_decoded(spark, sf_dir)))


def rejected_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.rejected(_decoded(spark, sf_dir)).groupBy("error").agg(F.count(F.lit(1)).alias("row_count"))


# Messages of any age may come in any file, so that everything waits for the end of the input.
ANY_ORDER = "3650 days"


def _message_stream(spark: SparkSession, lines: DataFrame) -> tuple[DataFrame, str]:
    """The messages dealt over files in no order, read in about four micro-batches, and their folder."""
    files = spark.sparkContext.defaultParallelism
    path = message_files(spark, lines.repartition(files, "value"))
    return messages.read_message_files(jobs.state_session(spark), path, max_files=-(-files // 4)), path


def _stream(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """All transactions as a decoded message stream, and the folder of the messages."""
    lines = messages.encode(transactions(spark, sf_dir)).select("value")
    stream, path = _message_stream(spark, lines)
    return messages.usable(messages.decode(stream)), path


def _state_columns(table: DataFrame) -> DataFrame:
    names = [c for c in table.columns if not c.startswith("late_")]
    added = [c for c in names if c.endswith(("_customer", "_terminal")) or c == "time_since_last_tx"]
    return presentable(table.select("transaction_id", *added))


def stream_customer_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream, path = _stream(spark, sf_dir)
    return _state_columns(jobs.run_to_table(state.customer_state(stream, delay=ANY_ORDER), "customer-state", source=path))


def stream_terminal_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream, path = _stream(spark, sf_dir)
    return _state_columns(jobs.run_to_table(state.terminal_state(stream, delay=ANY_ORDER), "terminal-state", source=path))


def stateful_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream, path = _stream(spark, sf_dir)
    return _state_columns(jobs.run_to_table(state.transaction_state(stream, delay=ANY_ORDER), "state", source=path))


#: Transactions before this time are the history, the others the stream.
STREAM_FROM = "2024-01-16"


def stream_from_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first days as a batch, the rest as a stream that goes on from their state."""
    tx = transactions(spark, sf_dir).withColumn("tx_datetime", F.date_trunc("second", "tx_datetime"))
    newer = F.col("tx_datetime") >= F.lit(STREAM_FROM).cast("timestamp")
    stream, path = _message_stream(spark, messages.encode(tx.where(newer)).select("value"))
    going_on = state.transaction_state(messages.usable(messages.decode(stream)), delay=ANY_ORDER, history=tx.where(~newer))
    return _state_columns(jobs.run_to_table(going_on, "from-history", source=path))


#: The days of a part of the messages that are sent in order.
PART = "tx_time_days div 5 as part"
#: Parts of a longer time share micro-batches, each of which takes seconds, whatever it holds.
MICRO_BATCHES = 32


def _by_days(tx: DataFrame) -> DataFrame:
    """Messages and the five days they are of."""
    return messages.encode(tx, F.expr(PART)).select("value", "part")


def stream_expiring_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``expiring_features`` from a stream in order of days, whose keys are forgotten after a day."""
    stream, path = _stream_in_order(spark, _by_days(transactions(spark, sf_dir)))
    table = jobs.run_to_table(state.transaction_state(stream, REMEMBERED_MS, delay="1 hour"), "expiring", source=path)
    return _state_columns(table).drop("var_pop_tx_amount_customer", "var_pop_tx_amount_terminal")


def _stream_in_order(spark: SparkSession, messages_by_part: DataFrame) -> tuple[DataFrame, str]:
    """Usable messages of ``(value, part)``, a micro-batch for each part, or for as many as leave ``MICRO_BATCHES``, and their folder.

    A micro-batch is a number of files, so all have as many: one for each bucket of messages, or a single one if a
    small micro-batch lacks a bucket.
    """
    path, written = scratch_path(spark, "messages"), scratch_path(spark, "sent")
    first, last = messages_by_part.agg(F.min("part"), F.max("part")).first()
    parts = -(-(last - first + 1) // MICRO_BATCHES)
    steps = messages_by_part.where("part is not null").select("value", F.expr(f"(part - {first}L) div {parts}L as step"))
    steps.write.partitionBy("step").parquet(written)
    sent = spark.read.schema("value string, step long").parquet(written)
    files = spark.sparkContext.defaultParallelism
    bucket = F.pmod(F.xxhash64("value"), F.lit(files)).cast("int")
    dealt_to = sent.groupBy("step").agg(F.count_distinct(bucket).alias("buckets")).orderBy("step").collect()
    if any(r["buckets"] < files for r in dealt_to):
        files = 1
    for r in dealt_to:
        rows = sent.where(F.col("step") == r["step"])
        dealt = rows.coalesce(1) if files == 1 else rows.repartitionById(files, bucket)
        dealt.select("value").write.mode("append").text(path)
    return messages.usable(messages.decode(messages.read_message_files(jobs.state_session(spark), path, max_files=files))), path


def stream_hot_terminal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of all messages at one terminal, in order of days, an hour of delay: its rows wait in buckets of time."""
    tx = transactions(spark, sf_dir).withColumn(
        "terminal_id", F.when(F.col("transaction_id") % 3 == 0, F.lit(0).cast("long")).otherwise(F.col("terminal_id"))
    )
    stream, path = _stream_in_order(spark, _by_days(tx))
    few = state.Buffer(rows=20, seconds=1800)
    return _state_columns(jobs.run_to_table(state.terminal_state(stream, delay="1 hour", buffer=few), "hot", source=path))


def stream_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages in order of days, every seventh sent again ten days later, an hour of delay: each is answered once.

    Answers are released in several micro-batches, most copies come after their answer. ``repeats`` counts the copies.
    """
    tx = transactions(spark, sf_dir)
    texts = messages.encode(tx).select(F.col("key").cast("bigint").alias("transaction_id"), "value")
    sent = texts.join(tx.select("transaction_id", F.expr(PART)), "transaction_id").withColumn("copied", F.col("transaction_id") % 7 == 0)
    every = sent.select("value", "part").unionByName(sent.where("copied").select("value", (F.col("part") + 2).alias("part")))
    stream, path = _stream_in_order(spark, every)
    kept = 60 * 86_400_000
    table = jobs.run_to_table(state.transaction_state(stream, delay="1 hour", remember_ms=kept), "repeats", source=path)
    copies = table.where("repeated_customer").groupBy("transaction_id").agg(F.count(F.lit(1)).alias("repeats"))
    answers = _state_columns(table.where("not repeated_customer").drop("repeated_customer"))
    return answers.join(copies, "transaction_id", "left").withColumn("repeats", F.coalesce("repeats", F.lit(0).cast("long")))


def stateful_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream, path = _stream(spark, sf_dir)
    return _state_columns(jobs.run_to_table(jobs.joined_state(stream, ANY_ORDER), "joined-state", source=path))


def stream_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message arrives twice, its repeat in the same file or another, and is kept once."""
    lines = messages.encode(transactions(spark, sf_dir)).select("value")
    repeats = lines.withColumn("value", F.concat("value", F.lit(" ")))
    stream, _ = _message_stream(spark, lines.unionByName(repeats))
    return presentable(jobs.run_to_table(messages.distinct_messages(messages.usable(messages.decode(stream))), "distinct"))


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream, _ = _message_stream(spark, broken_messages(transactions(spark, sf_dir)))
    bad = messages.rejected(messages.decode(stream))
    return jobs.run_to_table(bad, "quarantine").groupBy("error").agg(F.count(F.lit(1)).alias("row_count"))


# Models


def _features_and_training(tx: DataFrame) -> tuple[DataFrame, DataFrame]:
    table = materialize(features.transaction_features(tx, complete=False), "features")
    return table, sampling.split(table.dropna(subset=features.FEATURES))[0]


def _batch_scores(spark: SparkSession, sf_dir: str, classifier) -> DataFrame:
    table, training = _features_and_training(transactions(spark, sf_dir))
    return modeling.predictions(modeling.fit(training, classifier), table)


def forest_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batch_scores(spark, sf_dir, modeling.forest())


def logistic_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batch_scores(spark, sf_dir, modeling.logistic())


def stream_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = materialize(transactions(spark, sf_dir), "transactions")
    _, training = _features_and_training(tx)
    model = modeling.fit(training, modeling.forest())
    lines = messages.encode(tx).select("value")
    stream, path = _message_stream(spark, lines)
    scored = jobs.scored_messages(stream, model, delay=ANY_ORDER)
    return jobs.run_to_table(scored, "scored", source=path).select("transaction_id", "prediction", "probability", "unscored")


def assembled_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vector that the classifier gets, as columns: the fitted assembler and scaler over all complete rows."""
    table, training = _features_and_training(transactions(spark, sf_dir))
    model = modeling.fit(training, modeling.logistic(1))
    scaled = table.dropna(subset=features.FEATURES)
    for stage in model.stages[:2]:
        scaled = stage.transform(scaled)
    values = vector_to_array("scaled")
    return presentable(scaled.select("transaction_id", *[values[i].alias(c) for i, c in enumerate(features.FEATURES)]))


def logistic_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At the optimum without penalty, scores weigh every feature over the training rows as the labels do."""
    _, training = _features_and_training(transactions(spark, sf_dir))
    model = modeling.fit(training, modeling.logistic().setTol(1e-12))
    scored = model.transform(training)
    score, values = vector_to_array("probability")[1], vector_to_array("scaled")
    weighed = [F.avg(score * values[i]).alias(c) for i, c in enumerate(features.FEATURES)]
    return presentable(scored.agg(F.count(F.lit(1)).alias("row_count"), F.avg(score).alias("label"), *weighed))


def forest_scores_reloaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every transaction: whether it has a score, whether the stored forest gives the same and cuts at a half."""
    table, training = _features_and_training(transactions(spark, sf_dir))
    model = modeling.fit(training, modeling.forest())
    path = scratch_path(spark, "forest")
    modeling.save(model, path)
    stored = modeling.predictions(modeling.load(path), table)
    stored = stored.select("transaction_id", F.col("prediction").alias("_p"), F.col("probability").alias("_q"))
    both = modeling.predict_all(model, table).join(stored, "transaction_id")
    return both.select(
        "transaction_id",
        "tx_fraud",
        F.col("unscored").isNull().alias("scored"),
        (F.col("prediction").eqNullSafe(F.col("_p")) & F.col("probability").eqNullSafe(F.col("_q"))).alias("same_stored"),
        F.coalesce((F.col("prediction") == 1) == (F.col("probability") > 0.5), F.lit(True)).alias("cut_at_half"),
    )


def stream_scores_as_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every transaction: whether it has a score, and whether stream and batch give the same."""
    tx = transactions(spark, sf_dir).withColumn("tx_datetime", F.date_trunc("second", "tx_datetime"))
    tx = materialize(tx, "transactions")
    table, training = _features_and_training(tx)
    model = modeling.fit(training, modeling.logistic())
    stream, path = _message_stream(spark, messages.encode(tx).select("value"))
    online = jobs.run_to_table(jobs.scored_messages(stream, model, delay=ANY_ORDER), "scored", source=path)
    online = online.select("transaction_id", F.col("probability").alias("_q"), F.col("unscored").alias("_why"))
    both = modeling.predictions(model, table).join(online, "transaction_id", "full")
    apart = F.abs(F.col("probability") - F.col("_q")) > 1e-6
    return both.select(
        "transaction_id",
        F.col("_q").isNotNull().alias("scored"),
        (F.col("unscored").eqNullSafe(F.col("_why")) & ~F.coalesce(apart, F.lit(False))).alias("same_in_batch"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in [
        clean_transactions,
        clean_by_file_day,
        clean_written_once,
        dedup_by_id,
        typed_scan_lossy,
        quality_report,
        cast_failures,
        negative_counts,
        duplicate_groups,
        quarantine_reasons,
        line_counts,
        landed_sources,
        dataset_sizes,
        row_count,
        one_day,
        valid_ids,
        customer_features,
        terminal_features,
        customer_terminal_features,
        customer_terminal_features_hot,
        partition_stats_customer,
        partition_stats_terminal,
        partition_stats_terminal_hot,
        gap_seconds,
        rolling_1h,
        rolling_24h,
        rolling_terminal_hot,
        recent_span_counts,
        recent_span_counts_hot,
        prior_fraud,
        pair_features,
        tied_times,
        expiring_features,
        expiring_features_hot,
        calendar_features,
        scaled_features_pop,
        scaled_features_std,
        undersample,
        hash_split,
        class_counts,
        key_moments,
        confusion,
        confusion_matrix,
        class_report,
        weighted_metrics,
        accuracy,
        rule_curves,
        bootstrap_metrics,
        bootstrap_summary,
        ab_z_test,
        ab_driver_runs,
        previous_run,
        newest_runs,
        kafka_payload,
        first_n,
        decode_payload,
        rejected_messages,
        stream_customer_state,
        stream_terminal_state,
        stateful_features,
        stream_from_history,
        stream_hot_terminal,
        stream_expiring_state,
        stream_repeats,
        stateful_join,
        stream_distinct,
        stream_quarantine,
        forest_scores,
        logistic_scores,
        stream_scores,
        assembled_scaled,
        logistic_balance,
        forest_scores_reloaded,
        stream_scores_as_batch,
    ]
}
