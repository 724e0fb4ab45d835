from collections import Counter
from datetime import date, datetime

import pytest
from helpers import plan

from ledgerlens.adapters import raw_files
from ledgerlens.operators import cleaning, quality
from ledgerlens.plans.cleaning import clean_daily_text
from ledgerlens.schemas import COLUMNS, RAW_SCHEMA, TRANSACTION_SCHEMA
from ledgerlens.sources.tables import read_clean
from ledgerlens.sources.text import read_lines, read_raw, read_typed

DAY = date(2024, 1, 2)


def raw(spark, *rows, day=DAY):
    schema = RAW_SCHEMA.simpleString()[7:-1].replace(":", " ") + ", file_day date"
    return spark.createDataFrame([(*r, day) for r in rows], schema)


def line(i="1", at="2024-01-02 10:00:00", customer="5", terminal="6", amount="7.5", fraud="0"):
    return (i, at, customer, terminal, amount, "36000", "1", fraud, "0")


@pytest.mark.parametrize(
    ("row", "defect"),
    [
        (line(), None),
        (line(at="2024-01-02 24:00:00"), None),
        (line(at="2024-01-01 10:00:00"), "foreign_day"),
        (line(at="2024-01-01 24:00:00"), "foreign_day"),
        (line(at="garbage"), "foreign_day"),
        (line(at=None), "foreign_day"),
        (line(at="2024-01-02 99:00:00"), "not_castable"),
        (line(terminal="Err"), "not_castable"),
        (line(customer=None), "missing"),
        (line(amount=None), "missing"),
        (line(amount="NaN"), "not_castable"),
        (line(i="-1"), "negative"),
        (line(customer="-1"), "negative"),
        (line(terminal="-1"), "negative"),
        (line(amount="-0.01"), "negative"),
        (line(fraud="-1"), "negative"),
        (line(i="0"), None),
    ],
)
def test_first_broken_rule(spark, row, defect):
    assert cleaning.with_defect(raw(spark, row)).collect()[0]["defect"] == defect


@pytest.mark.parametrize(
    ("text", "number"),
    [("12", 12), (" 12 ", 12), ("-3", -3), ("12.7", 12), ("12.", 12), ("1e3", None), ("", None), ("Err", None),
     ("9223372036854775807", 2**63 - 1), ("9223372036854775808", None)],
)
def test_whole_numbers(spark, text, number):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(text,)], "t string").select(cleaning.whole_number(F.col("t"), "bigint").alias("n"))
    assert df.collect()[0]["n"] == number


def test_midnight_belongs_to_the_files_day(spark):
    out = cleaning.clean(raw(spark, line(at="2024-01-02 24:00:00"))).collect()
    assert [(r["tx_datetime"], r["tx_date"]) for r in out] == [(datetime(2024, 1, 3), DAY)]


def test_same_text_is_a_copy_other_text_is_not(spark):
    out = cleaning.clean(raw(spark, line(), line(), line(amount="7.50")))
    assert out.count() == 2


def test_columns_and_types(spark):
    out = cleaning.clean(raw(spark, line()))
    assert out.columns == [*COLUMNS, "tx_date"]
    assert [f.dataType for f in out.schema][:9] == [f.dataType for f in TRANSACTION_SCHEMA]


def test_every_row_is_kept_a_copy_or_rejected(spark, sf_dir):
    df = read_raw(spark, raw_files(spark, sf_dir))
    kept, rejected = cleaning.clean(df).count(), cleaning.quarantine(df).count()
    good = cleaning.with_defect(df).filter("defect is null")
    copies = good.count() - good.drop("defect").distinct().count()
    assert kept + rejected + copies == df.count()
    assert kept > 0 and rejected > 0 and copies > 0


def test_cleaning_does_not_depend_on_partitioning(spark, sf_dir):
    df = read_raw(spark, raw_files(spark, sf_dir))
    assert Counter(cleaning.clean(df.repartition(1)).collect()) == Counter(cleaning.clean(df.repartition(9)).collect())


def test_cleaned_rows_are_clean(spark, sf_dir):
    from pyspark.sql import functions as F

    once = cleaning.clean(read_raw(spark, raw_files(spark, sf_dir)))
    text = once.filter("to_date(tx_datetime) = tx_date").select(
        *[
            (F.date_format(c, "yyyy-MM-dd HH:mm:ss") if c == "tx_datetime" else F.col(c).cast("string")).alias(c)
            for c in COLUMNS
        ],
        F.col("tx_date").alias("file_day"),
    )
    twice = cleaning.clean(text)
    assert Counter(twice.collect()) == Counter(once.filter("to_date(tx_datetime) = tx_date").collect())


def test_job_writes_days_and_rejects(spark, sf_dir, fresh_path):
    source, target, bad = raw_files(spark, sf_dir), fresh_path("clean"), fresh_path("bad")
    clean_daily_text(spark, source, target, rejected=bad)
    written = read_clean(spark, target).collect()
    df = read_raw(spark, source)
    assert Counter(written) == Counter(cleaning.clean(df).collect())
    assert spark.read.parquet(bad).count() == cleaning.quarantine(df).count()
    assert {r["tx_date"] for r in read_clean(spark, target, "2024-01-03", "2024-01-04").collect()} == {
        date(2024, 1, 3), date(2024, 1, 4),
    }
    clean_daily_text(spark, source, target)  # replaces the days
    assert Counter(read_clean(spark, target).collect()) == Counter(written)


def test_write_new_refuses_an_existing_path(spark, sf_dir, fresh_path):
    source, target = raw_files(spark, sf_dir), fresh_path("clean")
    clean_daily_text(spark, source, target, replace=False, globally_sorted=True)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        clean_daily_text(spark, source, target, replace=False)


def test_first_row_of_an_id_wins(spark):
    rows = [(1, datetime(2024, 1, 1, h), 5, 6, float(h), 0, 0, 0, 0) for h in (9, 3, 7)]
    out = cleaning.first_by_id(spark.createDataFrame(rows, TRANSACTION_SCHEMA))
    assert [r["tx_amount"] for r in out.collect()] == [3.0]
    assert plan(out).count("WindowGroupLimit") == 2  # one of them before the shuffle


def test_typed_scan_loses_midnight(spark, sf_dir):
    path = raw_files(spark, sf_dir)
    typed = read_typed(spark, path)
    lost = typed.filter("tx_datetime is null").count()
    midnight = read_lines(spark, path).filter("value like '% 24:00:00,%'").count()
    assert lost == midnight > 0


def test_quality_report_of_an_empty_table(spark):
    report = quality.quality_report(raw(spark), spark.createDataFrame([], "value string"))
    assert {r["row_count"] for r in report.collect()} == {0}


def test_reports_show_the_rows_behind_the_counts(spark):
    df = raw(spark, line(), line(terminal="Err"), line(terminal="-4"), line(terminal=None))
    assert quality.uncastable_rows(df, "terminal_id").count() == 1
    counts = {r["column_name"]: (r["bad_rows"], r["missing_rows"]) for r in quality.cast_failures(df).collect()}
    assert counts["terminal_id"] == (1, 1) and counts["tx_amount"] == (0, 0)
    good = cleaning.clean(raw(spark, line()))
    assert {r["negative_rows"] for r in quality.negative_counts(good).collect()} == {0}
    assert quality.negative_rows(good, "tx_amount").count() == 0


def test_schema_table_and_preview(spark):
    df = raw(spark, line(), line(i="2"), line(i="3"))
    assert [tuple(r) for r in quality.schema_table(df).collect()][0] == ("transaction_id", "string")
    assert quality.preview(df, 2).count() == 2
    assert quality.row_count(df).collect()[0]["row_count"] == 3


def test_clean_plan_collapses_copies_before_one_shuffle(spark, sf_dir):
    out = plan(cleaning.clean(read_raw(spark, raw_files(spark, sf_dir))))
    assert out.count("Exchange") == 1 and out.count("HashAggregate") == 2
    assert "Python" not in out


def test_endless_amounts_are_not_castable(spark):
    amounts = ["1.5", "Infinity", "-Infinity", "NaN", "1e999"]
    df = spark.createDataFrame([(a,) for a in amounts], "tx_amount string")
    assert [r[0] for r in df.select(cleaning.typed("tx_amount")).collect()] == [1.5, None, None, None, None]
