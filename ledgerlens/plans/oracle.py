"""The registered queries as SQL for DuckDB, written independently of the DataFrame code."""

from __future__ import annotations

import math

from ..adapters import TRANSACTIONS_SQL

# The columns of the feature vector, in its order.
FEATURES = (
    "tx_amount, time_since_last_tx, avg_tx_amount_customer, tx_count_customer, sd_tx_amount_customer, "
    "avg_tx_amount_terminal, tx_count_terminal, sd_tx_amount_terminal"
).split(", ")

TX = f"tx as ({TRANSACTIONS_SQL})"

COLUMNS = (
    "transaction_id, tx_datetime, customer_id, terminal_id, tx_amount, tx_time_seconds, tx_time_days, "
    "tx_fraud, tx_fraud_scenario"
)


def r(expression: str) -> str:
    return f"round(({expression}) + 1e-7, 4)"


def shown(columns: str = COLUMNS) -> str:
    return columns.replace("tx_amount", f"{r('tx_amount')} as tx_amount")


# One row per distinct line of daily text: its fields as text, the day of its file, its number of copies.
RAW = f"""{TX}, raw as (
  select transaction_id as n, tx_datetime as ts, cast(tx_datetime as date) as file_day,
         case when transaction_id % 41 = 0 then 2 else 1 end as copies,
         cast(case when transaction_id % 97 = 0 then -transaction_id else transaction_id end as varchar) as transaction_id,
         case when transaction_id % 53 = 0 then strftime(tx_datetime, '%Y-%m-%d') || ' 24:00:00'
              when transaction_id % 59 = 0 then strftime(tx_datetime - interval 1 day, '%Y-%m-%d %H:%M:%S')
              else strftime(tx_datetime, '%Y-%m-%d %H:%M:%S') end as tx_datetime,
         case when transaction_id % 89 = 0 then '-1' else cast(customer_id as varchar) end as customer_id,
         case when transaction_id % 101 = 0 then 'Err' else cast(terminal_id as varchar) end as terminal_id,
         case when transaction_id % 103 = 0 then '' else cast(tx_amount as varchar) end as tx_amount,
         cast(tx_time_seconds as varchar) as tx_time_seconds, cast(tx_time_days as varchar) as tx_time_days,
         cast(tx_fraud as varchar) as tx_fraud, cast(tx_fraud_scenario as varchar) as tx_fraud_scenario
  from tx),
lines as (
  select *, concat(transaction_id, ',', tx_datetime, ',', customer_id, ',', terminal_id, ',', tx_amount, ',',
                   tx_time_seconds, ',', tx_time_days, ',', tx_fraud, ',', tx_fraud_scenario) as line,
         n % 53 = 0 as is_midnight, n % 59 = 0 and n % 53 <> 0 as is_foreign, n % 103 = 0 as is_missing,
         n % 101 = 0 as is_uncastable, (n % 97 = 0 and n <> 0) or n % 89 = 0 as is_negative
  from raw)"""

# The typed fields of a line; the repaired midnight is computed, not parsed.
TYPED = """
cast(transaction_id as bigint) as transaction_id,
case when is_midnight then cast(date_trunc('day', ts) + interval 1 day as timestamp)
     when is_foreign then date_trunc('second', ts) - interval 1 day else date_trunc('second', ts) end as tx_datetime,
cast(customer_id as bigint) as customer_id, try_cast(terminal_id as bigint) as terminal_id,
try_cast(tx_amount as double) as tx_amount, cast(tx_time_seconds as integer) as tx_time_seconds,
cast(tx_time_days as integer) as tx_time_days, cast(tx_fraud as integer) as tx_fraud,
cast(tx_fraud_scenario as integer) as tx_fraud_scenario"""

CLEAN = f"""{RAW}, clean as (
  select {TYPED}, file_day as tx_date from lines
  where not (is_foreign or is_missing or is_uncastable or is_negative))"""

FEATURE_TABLE = f"""{TX}, features as (
  select tx.*,
         case when dayofweek(tx_datetime) in (0, 6) then 1 else 0 end as is_weekend,
         floor(epoch(tx_datetime)) - floor(epoch(lag(tx_datetime) over (
             partition by customer_id order by tx_datetime, transaction_id))) as time_since_last_tx,
         avg(tx_amount) over c as avg_tx_amount_customer, count(transaction_id) over c as tx_count_customer,
         stddev_samp(tx_amount) over c as sd_tx_amount_customer,
         avg(tx_amount) over t as avg_tx_amount_terminal, count(transaction_id) over t as tx_count_terminal,
         stddev_samp(tx_amount) over t as sd_tx_amount_terminal
  from tx
  window c as (partition by customer_id order by tx_datetime), t as (partition by terminal_id order by tx_datetime)),
complete as (
  select * from features
  where time_since_last_tx is not null and sd_tx_amount_customer is not null and sd_tx_amount_terminal is not null)"""


def running(suffix: str) -> str:
    return (
        f"{r(f'avg_tx_amount_{suffix}')} as avg_tx_amount_{suffix}, tx_count_{suffix}, "
        f"{r(f'sd_tx_amount_{suffix}')} as sd_tx_amount_{suffix}"
    )


GAP = f"{r('time_since_last_tx')} as time_since_last_tx"

CUSTOMER_TERMINAL = (
    f"with {FEATURE_TABLE} select {shown()}, is_weekend, {GAP}, {running('customer')}, {running('terminal')} from complete"
)


def key_statistics(key: str, suffix: str) -> str:
    part = f"over (partition by {key})"
    return f"""with {TX} select transaction_id, {r(f'avg(tx_amount) {part}')} as avg_tx_amount_{suffix},
        count(transaction_id) {part} as tx_count_{suffix},
        {r(f'stddev_samp(tx_amount) {part}')} as sd_tx_amount_{suffix} from tx"""


def trailing(key: str, suffix: str, spans: dict[str, int], what: tuple[str, ...] = ("sum", "count")) -> str:
    columns = []
    for name, seconds in spans.items():
        # Microseconds: the frame (t - span, t] ends one microsecond after t - span.
        frame = (
            f"over (partition by {key} order by epoch_us(tx_datetime) "
            f"range between {seconds * 1_000_000 - 1} preceding and current row)"
        )
        if "sum" in what:
            columns.append(f"{r(f'sum(tx_amount) {frame}')} as sum_{name}_{suffix}")
        if "count" in what:
            columns.append(f"count(transaction_id) {frame} as count_{name}_{suffix}")
        if "per_day" in what:
            columns.append(f"{r(f'count(transaction_id) {frame} / {seconds / 86400!r}')} as per_day_{name}_{suffix}")
    return ", ".join(columns)


IN_TRAINING = "cast('0x' || substr(md5(concat('42:', transaction_id)), 1, 8) as bigint) / 4294967296.0 < 0.8"


def scaled(expression: str, aggregates: str, rows: str = "true") -> str:
    columns = ", ".join(f"{r(expression.format(c=c))} as {c}" for c in FEATURES)
    stats = ", ".join(aggregates.format(c=c) for c in FEATURES)
    return f"with {FEATURE_TABLE}, stats as (select {stats} from complete where {rows}) select transaction_id, {columns} from complete, stats"


def rule(threshold: float, name: str = "scored") -> str:
    return f"{name} as (select *, case when tx_amount > {threshold} then 1.0 else 0.0 end::double as prediction from tx)"


# tp, fp, fn, tn of the fraud class to the metrics; a class that never occurs counts 0.
def metrics_of(counts: str, keys: str = "") -> str:
    lead = f"{keys}, " if keys else ""
    return f"""select {lead}(tp + tn) / n as accuracy,
         (p1 * (tp + fn) + p0 * (tn + fp)) / n as precision, (tp + tn) / n as recall,
         (coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) * (tp + fn)
          + coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) * (tn + fp)) / n as f1
  from (select *, tp + fp + fn + tn as n,
               coalesce(tp / nullif(tp + fp, 0), 0) as p1, coalesce(tn / nullif(tn + fn, 0), 0) as p0,
               coalesce(tp / nullif(tp + fn, 0), 0) as r1, coalesce(tn / nullif(tn + fp, 0), 0) as r0
        from {counts})"""


def count_cells(source: str, keys: str = "", weight: str = "1") -> str:
    lead, group = (f"{keys}, ", f" group by {keys}") if keys else ("", "")
    cells = {"tp": (1, 1.0), "fp": (0, 1.0), "fn": (1, 0.0), "tn": (0, 0.0)}
    sums = ", ".join(
        f"cast(coalesce(sum({weight}) filter (where tx_fraud = {y} and prediction = {p}), 0) as double) as {name}"
        for name, (y, p) in cells.items()
    )
    return f"(select {lead}{sums} from {source}{group})"


def poisson_steps(rate: float) -> list[float]:
    """P(X <= k), as long as a draw of 32 bits can be above."""
    steps = [math.exp(-rate)]
    while 1.0 - steps[-1] > 2.0**-32:
        k = len(steps)
        steps.append(steps[-1] + math.exp(-rate) * rate**k / math.factorial(k))
    return steps


def samples(scored: str, name: str) -> str:
    u = f"cast('0x' || substr(md5(concat('42:', replicate, ':', transaction_id)), 1, 8) as bigint) / 4294967296.0"
    weight = " + ".join(f"cast(u >= {c!r} as integer)" for c in poisson_steps(0.1))
    return f"""{name}_drawn as (
  select *, {weight} as weight
  from (select *, cast({u} as double) as u
        from {scored}, (select cast(unnest(generate_series(1, 5)) as integer) as replicate))),
{name}_wide as ({metrics_of(count_cells(f'{name}_drawn', 'replicate', 'weight'), 'replicate')}),
{name} as (
  select replicate, 'accuracy' as metric, accuracy as value from {name}_wide union all
  select replicate, 'precision', precision from {name}_wide union all
  select replicate, 'recall', recall from {name}_wide union all
  select replicate, 'f1', f1 from {name}_wide)"""


def summary(source: str, name: str) -> str:
    return f"""{name} as (
  select metric, avg(value) as mean, stddev_pop(value) as std,
         quantile_cont(value, 0.025) as low, quantile_cont(value, 0.975) as high
  from {source} group by metric)"""


def erfc(x: str) -> str:
    """Power series below 2, continued fraction above, as nested SQL terms."""
    series = fraction = "1.0"
    for k in range(60, 0, -1):
        series = f"(1.0 + {series} * 2 * {x} * {x} / {2 * k + 1})"
        fraction = f"(1.0 + {k} / (2 * {x} * {x}) / {fraction})"
    return (
        f"case when {x} < 2 then 1 - 2 / sqrt(pi()) * {x} * exp(-{x} * {x}) * {series} "
        f"else exp(-{x} * {x}) / ({x} * sqrt(pi()) * {fraction}) end"
    )


def z_test(new: str, old: str, name: str) -> str:
    """``(metric, z, p)`` of two summaries."""
    return f"""{name} as (
  select metric, z, {erfc('x')} as p from (
    select *, abs(z) / sqrt(2) as x from (
      select metric, (n.mean - o.mean) / nullif(sqrt(n.std * n.std + o.std * o.std), 0) as z
      from {new} n left join {old} o using (metric))))"""


# Fixed output text.
DECISION = (
    "metric || case when p < 0.05 then ' has' else ' does not have' end || "
    "' statistically significant difference (p_value=' || format('{:.6f}', p) || ', alpha=0.05)'"
)

MESSAGE = (
    """concat('{"transaction_id":', transaction_id, ',"tx_datetime":"', strftime(tx_datetime, '%Y-%m-%dT%H:%M:%S'),"""
    """ '","customer_id":', customer_id, ',"terminal_id":', terminal_id, ',"tx_amount":', cast(tx_amount as varchar),"""
    """ ',"tx_time_seconds":', tx_time_seconds, ',"tx_time_days":', tx_time_days, ',"tx_fraud":', tx_fraud,"""
    """ ',"tx_fraud_scenario":', tx_fraud_scenario, '}')"""
)

ERROR = (
    "case when transaction_id % 67 = 0 then 'not_json' when transaction_id % 71 = 0 then 'bad_time' "
    "when transaction_id % 73 = 0 then 'no_id' end"
)

REJECTED = f"with {TX} select {ERROR} as error, count(*) as row_count from tx where {ERROR} is not null group by 1"


# A stream sees whole seconds and one transaction after the other: a ROWS frame in order of time and id.
def state(suffixes: tuple[str, ...], replaced: str = "") -> str:
    columns = []
    for suffix in suffixes:
        w = suffix[0]
        columns.append(f"{r(f'avg(tx_amount) over {w}')} as avg_tx_amount_{suffix}")
        columns.append(f"count(*) over {w} as tx_count_{suffix}")
        columns.append(f"{r(f'stddev_samp(tx_amount) over {w}')} as sd_tx_amount_{suffix}")
        columns.append(f"{r(f'var_pop(tx_amount) over {w}')} as var_pop_tx_amount_{suffix}")
        if suffix == "customer":
            previous = (
                "lag(tx_datetime) over (partition by customer_id order by tx_datetime, transaction_id)"
            )
            columns.append(f"{r(f'cast(epoch(tx_datetime) - epoch({previous}) as double)')} as time_since_last_tx")
    windows = ", ".join(
        f"{s[0]} as (partition by {s}_id order by tx_datetime, transaction_id rows unbounded preceding)"
        for s in suffixes
    )
    return f"""with {TX}, whole as (select * replace (date_trunc('second', tx_datetime) as tx_datetime{replaced}) from tx)
        select transaction_id, {', '.join(columns)} from whole window {windows}"""


# Keys that are forgotten after a day: islands of transactions without a longer gap, each counted on its own.
def expiring() -> str:
    steps, columns = [f"{TX}, base as (select * replace (date_trunc('second', tx_datetime) as tx_datetime) from tx)"], []
    for key in ("customer", "terminal"):
        steps.append(f"""{key}_gaps as (
  select transaction_id, {key}_id, tx_datetime, tx_amount,
         lag(tx_datetime) over (partition by {key}_id order by tx_datetime, transaction_id) as previous from base),
{key}_islands as (
  select *, sum(case when tx_datetime <= previous + interval 1 day then 0 else 1 end) over (
             partition by {key}_id order by tx_datetime, transaction_id rows unbounded preceding) as island
  from {key}_gaps),
{key}_counted as (
  select transaction_id, avg(tx_amount) over w as a, count(*) over w as n, stddev_samp(tx_amount) over w as s,
         epoch(tx_datetime) - epoch(lag(tx_datetime) over (
             partition by {key}_id, island order by tx_datetime, transaction_id)) as gap
  from {key}_islands window w as (partition by {key}_id, island order by tx_datetime))""")
        c = key[0]
        columns += [f"{r(f'{c}.a')} as avg_tx_amount_{key}", f"{c}.n as tx_count_{key}", f"{r(f'{c}.s')} as sd_tx_amount_{key}"]
    return f"""with {', '.join(steps)} select transaction_id, {r('cast(c.gap as double)')} as time_since_last_tx,
        {', '.join(columns)} from customer_counted c join terminal_counted t using (transaction_id)"""


def per_column(measures: dict[str, dict[str, str]], source: str, with_clause: str) -> str:
    names = COLUMNS.split(", ")
    rows = []
    for c in names:
        values = ", ".join(f"cast({by_column.get(c, '0 * count(*)')} as bigint) as {m}" for m, by_column in measures.items())
        rows.append(f"select '{c}' as column_name, {values} from {source}")
    return f"with {with_clause} " + " union all ".join(rows)


DAY_SECONDS = 86400

SPAN_COUNTS = f"""with {TX} select transaction_id, {', '.join(
        trailing(f'{s}_id', s, {'7d': 7 * DAY_SECONDS, '30d': 30 * DAY_SECONDS}, ('count', 'per_day'))
        for s in ('customer', 'terminal'))} from tx"""

ORACLE: dict[str, str] = {
    "clean_transactions": f"with {CLEAN} select {shown()}, tx_date from clean",
    "clean_by_file_day": f"""with {CLEAN} select tx_date, count(*) as kept_rows,
        {r('sum(tx_amount)')} as total_amount from clean group by tx_date""",
    "clean_written_once": f"""with {CLEAN} select tx_date, count(*) as kept_rows, min(transaction_id) as first_id,
        max(transaction_id) as last_id from clean group by tx_date""",
    "dedup_by_id": f"""with {TX}, shared as (select * replace (transaction_id // 3 as transaction_id) from tx)
        select {shown()} from shared
        qualify row_number() over (partition by transaction_id order by tx_datetime) = 1""",
    "typed_scan_lossy": f"""with {RAW}, typed as (select {TYPED}, is_midnight from lines)
        select {shown()} from typed
        where not is_midnight and transaction_id >= 0 and customer_id >= 0 and terminal_id >= 0""",
    "quality_report": f"""with {RAW}, total as (
          select sum(copies) as n, sum(copies - 1) as dup,
                 sum(copies) filter (where is_midnight) as mid, sum(copies) filter (where is_foreign) as foreign_n,
                 sum(copies) filter (where is_missing) as miss, sum(copies) filter (where is_uncastable) as uncast,
                 sum(copies) filter (where is_negative) as neg, count(distinct file_day) as comments
          from lines)
        select defect, cast(coalesce(row_count, 0) as bigint) as row_count from (
          select 'rows' as defect, n as row_count from total union all select 'duplicate', dup from total union all
          select 'midnight', mid from total union all select 'foreign_day', foreign_n from total union all
          select 'missing', miss from total union all select 'not_castable', uncast from total union all
          select 'negative', neg from total union all select 'comment', comments from total)""",
    "cast_failures": per_column(
        {
            "bad_rows": {"terminal_id": "sum(copies) filter (where is_uncastable)"},
            "missing_rows": {"tx_amount": "sum(copies) filter (where is_missing)"},
        },
        "lines",
        RAW,
    ),
    "negative_counts": " union all ".join(
        f"({part})"
        for part in [
            f"with {RAW} select 'transaction_id' as column_name, cast(sum(copies) filter (where n % 97 = 0 and n <> 0) "
            "as bigint) as negative_rows from lines",
            f"with {RAW} select 'customer_id', cast(sum(copies) filter (where n % 89 = 0) as bigint) from lines",
            "select unnest(['terminal_id', 'tx_amount', 'tx_time_seconds', 'tx_time_days', 'tx_fraud', "
            "'tx_fraud_scenario']), cast(0 as bigint)",
        ]
    ),
    "duplicate_groups": f"""with {RAW} select transaction_id, tx_datetime, customer_id, terminal_id,
        nullif(tx_amount, '') as tx_amount, tx_time_seconds, tx_time_days, tx_fraud, tx_fraud_scenario, file_day,
        cast(copies as bigint) as copies from lines where copies > 1""",
    "quarantine_reasons": f"""with {RAW}, judged as (
          select file_day, copies, case when is_foreign then 'foreign_day' when is_missing then 'missing'
                 when is_uncastable then 'not_castable' when is_negative then 'negative' end as defect from lines)
        select file_day, defect, cast(sum(copies) as bigint) as row_count from judged
        where defect is not null group by all""",
    "line_counts": f"""with {RAW} select file_day as source_day, cast(sum(copies) + 1 as bigint) as line_count,
        cast(1 as bigint) as comment_count from lines group by file_day""",
    "landed_sources": f"""with {RAW} select 'all' as target_folder, file_day as source_day,
        cast(sum(copies) + 1 as bigint) as line_count, cast(1 as bigint) as comment_count from lines group by file_day
        union all select 'odd', file_day, cast(sum(copies) + 1 as bigint), cast(1 as bigint) from lines where n % 2 = 1
        group by file_day""",
    "dataset_sizes": f"""with {RAW} select 'day=' || cast(file_day as varchar) as dataset,
        cast(sum(copies * (length(line) + 1)) + length('# transaction_id | tx_datetime') + 1 as bigint) as bytes
        from lines group by file_day""",
    "row_count": "select count(*) as row_count from events",
    "one_day": f"with {TX} select {shown()} from tx where cast(tx_datetime as date) = date '2024-01-10'",
    "valid_ids": f"""with {RAW}, typed as (select {TYPED}, is_midnight, is_missing, is_uncastable, copies from lines),
        copied as (select *, unnest(generate_series(1, copies)) as copy from typed)
        select {shown()} from copied where customer_id >= 0 and not (is_midnight or is_missing or is_uncastable)""",
    "customer_features": f"with {FEATURE_TABLE} select transaction_id, {GAP}, {running('customer')} from features",
    "terminal_features": f"with {FEATURE_TABLE} select transaction_id, {running('terminal')} from features",
    "customer_terminal_features": CUSTOMER_TERMINAL,
    "customer_terminal_features_hot": CUSTOMER_TERMINAL,
    "partition_stats_customer": key_statistics("customer_id", "customer"),
    "partition_stats_terminal": key_statistics("terminal_id", "terminal"),
    "partition_stats_terminal_hot": key_statistics("terminal_id", "terminal"),
    "gap_seconds": f"with {FEATURE_TABLE} select transaction_id, customer_id, {GAP} from features",
    "rolling_1h": f"with {TX} select transaction_id, {trailing('customer_id', 'customer', {'1h': 3600})} from tx",
    "rolling_24h": f"with {TX} select transaction_id, {trailing('customer_id', 'customer', {'24h': DAY_SECONDS})} from tx",
    "rolling_terminal_hot": f"""with {TX} select transaction_id, {trailing(
        'terminal_id', 'terminal', {'1h': 3600, '24h': DAY_SECONDS, '7d': 7 * DAY_SECONDS})} from tx""",
    "recent_span_counts": SPAN_COUNTS,
    "recent_span_counts_hot": SPAN_COUNTS,
    "prior_fraud": f"""with {TX} select transaction_id,
        cast(coalesce(sum(tx_fraud) over (partition by customer_id order by tx_datetime, transaction_id
             rows between unbounded preceding and 1 preceding), 0) as bigint) as prior_fraud_customer,
        cast(coalesce(sum(tx_fraud) over (partition by terminal_id order by tx_datetime, transaction_id
             rows between unbounded preceding and 1 preceding), 0) as bigint) as prior_fraud_terminal from tx""",
    "pair_features": f"""with {TX} select transaction_id, {r('avg(tx_amount) over p')} as avg_tx_amount_pair,
        count(*) over p as tx_count_pair, {r('stddev_samp(tx_amount) over p')} as sd_tx_amount_pair,
        {r('floor(epoch(tx_datetime)) - floor(epoch(lag(tx_datetime) over q))')} as time_since_last_tx,
        cast(coalesce(sum(tx_fraud) over (q rows between unbounded preceding and 1 preceding), 0) as bigint)
            as prior_fraud_pair
        from tx window p as (partition by customer_id, terminal_id order by tx_datetime),
                       q as (partition by customer_id, terminal_id order by tx_datetime, transaction_id)""",
    "tied_times": f"""with moved as (
          select l_suppkey as terminal_id, l_shipdate as tx_datetime, l_extendedprice as tx_amount
          from lineitem join orders on l_orderkey = o_orderkey),
        stats as (
          select terminal_id, tx_datetime, avg(tx_amount) over w as a, count(*) over w as n, stddev_samp(tx_amount) over w as s
          from moved window w as (partition by terminal_id order by tx_datetime))
        select terminal_id, tx_datetime, count(*) as row_count, max(n) as tx_count_terminal,
               {r('max(a)')} as avg_tx_amount_terminal, {r('max(s)')} as sd_tx_amount_terminal
        from stats group by terminal_id, tx_datetime""",
    "calendar_features": f"""with {TX} select transaction_id,
        case when dayofweek(tx_datetime) in (0, 6) then 1 else 0 end as is_weekend,
        case when dayofweek(tx_datetime) in (4, 5, 6) then 1 else 0 end as is_thursday_to_saturday,
        cast(hour(tx_datetime) as integer) as tx_hour,
        {', '.join(f'cast(hour(tx_datetime) = {h} as integer) as tx_hour_{h}' for h in range(1, 24))} from tx""",
    "scaled_features_pop": scaled("({c} - m_{c}) / s_{c}", "avg({c}) as m_{c}, stddev_pop({c}) as s_{c}"),
    "scaled_features_std": scaled("{c} / s_{c}", "stddev_samp({c}) as s_{c}"),
    "assembled_scaled": scaled("{c} / s_{c}", "stddev_samp({c}) as s_{c}", IN_TRAINING),
    "logistic_balance": f"""with {FEATURE_TABLE}, training as (select * from complete where {IN_TRAINING}),
        stats as (select {', '.join(f'stddev_samp({c}) as s_{c}' for c in FEATURES)} from training)
        select count(*) as row_count, {r('avg(tx_fraud)')} as label,
        {', '.join(f"{r(f'avg(tx_fraud * {c} / s_{c})')} as {c}" for c in FEATURES)} from training, stats""",
    "forest_scores_reloaded": f"""with {FEATURE_TABLE} select transaction_id, tx_fraud,
        transaction_id in (select transaction_id from complete) as scored, true as same_stored, true as cut_at_half from tx""",
    "stream_scores_as_batch": f"""with {FEATURE_TABLE} select transaction_id,
        transaction_id in (select transaction_id from complete) as scored, true as same_in_batch from tx""",
    "undersample": f"""with {TX}, ranked as (
          select *, row_number() over (partition by tx_fraud
                 order by md5(concat('42:', transaction_id)), transaction_id) as place from tx)
        select {shown()} from ranked
        where place <= (select min(n) from (select count(*) as n from tx group by tx_fraud))""",
    "hash_split": f"with {TX} select transaction_id, case when {IN_TRAINING} then 'train' else 'test' end as part from tx",
    "class_counts": f"with {TX} select tx_fraud, count(*) as row_count from tx group by tx_fraud",
    "key_moments": f"""with {TX} select terminal_id, count(*) as tx_count, {r('sum(tx_amount)')} as total_amount,
        {r('sum(tx_amount * tx_amount)')} as sum_of_squares, {r('avg(tx_amount)')} as avg_tx_amount,
        {r('var_pop(tx_amount)')} as var_pop_tx_amount from tx group by terminal_id""",
    "confusion": f"""with {TX}, {rule(60.0)} select round(cast(tx_fraud as double) + 1e-7, 4) as label,
        prediction, count(*) as row_count from scored group by all""",
    "confusion_matrix": f"""with {TX}, {rule(60.0)} select cast(tx_fraud as double) as label,
        count(*) filter (where prediction = 0) as predicted_0, count(*) filter (where prediction = 1) as predicted_1
        from scored group by tx_fraud""",
    "class_report": f"""with {TX}, {rule(60.0)}, c as (select * from {count_cells('scored')}),
        per_class as (
          select 1.0::double as class, tp + fn as support, tp as hits, tp + fp as predicted from c union all
          select 0.0::double, tn + fp, tn, tn + fn from c),
        rates as (
          select *, coalesce(hits / nullif(predicted, 0), 0) as p, coalesce(hits / nullif(support, 0), 0) as q
          from per_class)
        select class, cast(support as bigint) as support, cast(hits as bigint) as hits, {r('p')} as precision,
               {r('q')} as recall, {r('coalesce(2 * p * q / nullif(p + q, 0), 0)')} as f1 from rates""",
    "weighted_metrics": f"""with {TX}, {rule(60.0)},
        m as ({metrics_of(count_cells('scored', 'terminal_id'), 'terminal_id')})
        select terminal_id, {', '.join(f'{r(m)} as {m}' for m in ('accuracy', 'precision', 'recall', 'f1'))} from m""",
    "accuracy": f"""with {TX}, {rule(60.0)} select {r('avg(case when tx_fraud = prediction then 1 else 0 end)')}
        as accuracy from scored""",
    "rule_curves": f"""with {TX}, both_ways as (
          select terminal_id, tx_amount as s, tx_fraud as y from tx union all select null, tx_amount, tx_fraud from tx),
        ranked as (
          select *, sum(y) over w as tp, sum(1 - y) over w as fp, count(*) over w as upto,
                 sum(1 - y) over (partition by terminal_id, s) as tied
          from both_ways window w as (partition by terminal_id order by s desc)),
        summed as (
          select terminal_id, cast(sum(y) as bigint) as positives, cast(sum(1 - y) as bigint) as negatives,
                 sum(y * (fp - tied / 2.0)) as lost, sum(y * tp / upto) as precisions from ranked group by terminal_id)
        select terminal_id, positives, negatives,
          {r('case when positives > 0 and negatives > 0 then 1 - lost / positives / negatives end')} as area_under_roc,
          {r('case when positives > 0 and negatives > 0 then precisions / positives end')} as area_under_pr from summed""",
    "bootstrap_metrics": f"""with {TX}, {rule(60.0)}, {samples('scored', 's')}
        select replicate, metric, {r('value')} as value from s""",
    "bootstrap_summary": f"""with {TX}, {rule(60.0)}, {samples('scored', 's')}, {summary('s', 'm')}
        select metric, {', '.join(f'{r(c)} as {c}' for c in ('mean', 'std', 'low', 'high'))} from m""",
    "ab_z_test": f"""with {TX}, {rule(60.0, 'scored_new')}, {rule(90.0, 'scored_old')},
        {samples('scored_new', 's_new')}, {samples('scored_old', 's_old')},
        {summary('s_new', 'new')}, {summary('s_old', 'old')}, {z_test('new', 'old', 'p')}
        select metric, {r('z')} as z_score, {r('p')} as p_value, p < 0.05 as significant, {DECISION} as decision from p""",
    "ab_driver_runs": f"""with {TX}, {rule(60.0, 'low')}, {rule(75.0, 'middle')}, {rule(90.0, 'high')},
        {samples('low', 's_low')}, {samples('middle', 's_middle')}, {samples('high', 's_high')},
        {summary('s_low', 'm_low')}, {summary('s_middle', 'm_middle')}, {summary('s_high', 'm_high')},
        {z_test('m_high', 'm_low', 'third')}, {z_test('m_middle', 'm_high', 'second')},
        runs as (
          select 'first' as run_id, metric, mean, std, null::double as z, null::double as p from m_low union all
          select 'third', metric, mean, std, z, p from m_high join third using (metric) union all
          select 'second', metric, mean, std, z, p from m_middle join second using (metric))
        select run_id, metric, {r('mean')} as mean, {r('std')} as std, {r('z')} as z_score, {r('p')} as p_value,
               {DECISION} as decision from runs""",
    "previous_run": f"""with {TX}, runs as (
          select cast(terminal_id as varchar) as experiment, cast(cast(tx_datetime as date) as varchar) as run_id,
                 min(tx_datetime) as start_time, avg(tx_amount) as mean, stddev_pop(tx_amount) as std
          from tx group by all)
        select experiment, run_id, start_time, {r('mean')} as mean, {r('std')} as std from runs
        qualify row_number() over (partition by experiment order by start_time desc, run_id desc) = 2""",
    "newest_runs": f"""with {TX}, runs as (
          select cast(terminal_id as varchar) as experiment, cast(cast(tx_datetime as date) as varchar) as run_id,
                 min(tx_datetime) as start_time from tx group by all)
        select * from runs order by start_time desc, run_id desc limit 2""",
    "kafka_payload": f"with {TX} select cast(transaction_id as varchar) as key, {MESSAGE} as value from tx",
    "first_n": f"""with {TX} select cast(transaction_id as varchar) as key, {MESSAGE} as value
        from tx order by transaction_id limit 1000""",
    "decode_payload": f"""with {TX}, whole as (select * replace (date_trunc('second', tx_datetime) as tx_datetime) from tx)
        select {shown()} from whole where {ERROR} is null""",
    "rejected_messages": REJECTED,
    "stream_customer_state": state(("customer",)),
    "stream_terminal_state": state(("terminal",)),
    "stateful_features": state(("customer", "terminal")),
    "stream_hot_terminal": state(
        ("terminal",), ", case when transaction_id % 3 = 0 then 0 else terminal_id end as terminal_id"
    ),
    "expiring_features": expiring(),
    "expiring_features_hot": expiring(),
    "stream_expiring_state": expiring(),
    "stream_repeats": f"""select *, cast(case when transaction_id % 7 = 0 then 1 else 0 end as bigint) as repeats
        from ({state(("customer", "terminal"))})""",
    "stream_from_history": f"""select * from ({state(("customer", "terminal"))}) where transaction_id in
        (select event_id from events where ts >= timestamp '2024-01-16 00:00:00')""",
    "stateful_join": state(("customer", "terminal")),
    "stream_distinct": f"""with {TX}, whole as (select * replace (date_trunc('second', tx_datetime) as tx_datetime) from tx)
        select {shown()} from whole""",
    "stream_quarantine": REJECTED,
}
