import math

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import hashing, stats, temporal
from ledgerlens.sources.landing import target_key


def test_normal_cdf_and_p_value(spark):
    rows = spark.range(-600, 601).select((F.col("id") / 100).alias("z"))
    rows = rows.select("z", stats.normal_cdf(F.col("z")).alias("cdf"), stats.two_sided_p(F.col("z")).alias("p")).collect()
    for r in rows:
        assert r["cdf"] == pytest.approx(0.5 * math.erfc(-r["z"] / math.sqrt(2)), abs=1e-14)
        assert r["p"] == pytest.approx(math.erfc(abs(r["z"]) / math.sqrt(2)), rel=1e-11, abs=1e-15)


def test_p_value_of_null_is_null(spark):
    out = spark.range(1).select(stats.two_sided_p(F.lit(None).cast("double")).alias("p"))
    assert out.collect()[0]["p"] is None


def test_poisson_cutoffs():
    cutoffs = hashing.poisson_cutoffs(0.1)
    assert cutoffs[0] == pytest.approx(math.exp(-0.1))
    assert cutoffs[1] == pytest.approx(math.exp(-0.1) * 1.1)
    assert cutoffs == sorted(cutoffs) and 1 - cutoffs[-1] < 2**-32
    with pytest.raises(ValueError):
        hashing.poisson_cutoffs(0)


def test_uniform_is_uniform_and_repeatable(spark):
    draws = spark.range(20000).select(hashing.uniform(F.lit(1), F.col("id")).alias("u"))
    low, high, mean = draws.agg(F.min("u"), F.max("u"), F.avg("u")).collect()[0]
    assert 0 <= low < 0.001 and 0.999 < high < 1 and abs(mean - 0.5) < 0.01
    assert draws.repartition(7).agg(F.sum("u")).collect()[0][0] == pytest.approx(mean * 20000)


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2024-01-31 24:00:00", "2024-02-01 00:00:00"),
        ("2024-02-28 24:00:00", "2024-02-29 00:00:00"),
        ("2024-12-31 24:00:00", "2025-01-01 00:00:00"),
        ("2024-01-31 23:59:59", "2024-01-31 23:59:59"),
        ("nonsense", "nonsense"),
        ("nonsense!! 24:00:00", None),
        (None, None),
    ],
)
def test_repair_midnight(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string").select(temporal.repair_midnight(F.col("t")).alias("t"))
    assert df.collect()[0]["t"] == expected


def test_day_of_path(spark):
    paths = ["s/2019-08-22.txt", "run-2020-01-01/day=2024-01-05/part-0.txt", "no-date.txt", "x/2024-13-01.txt"]
    df = spark.createDataFrame([(p,) for p in paths], "p string").select(
        temporal.day_of_path(F.col("p")).cast("string").alias("d")
    )
    assert [r["d"] for r in df.collect()] == ["2019-08-22", "2024-01-05", None, None]


def test_only_the_first_prefix_is_replaced(spark):
    df = spark.createDataFrame([("a/in/in/x.txt",), ("b/x.txt",)], "path string")
    out = df.select(target_key(F.col("path"), "in/", "landed/").alias("k")).collect()
    assert [r["k"] for r in out] == ["a/landed/in/x.txt", "b/x.txt"]
