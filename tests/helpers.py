"""Small frames and plan inspection for the tests."""

from datetime import datetime, timedelta

import pytest

from ledgerlens.schemas import TRANSACTION_SCHEMA

START = datetime(2024, 1, 1)


def tx_rows(*rows):
    """``(id, seconds after START or None, customer, terminal, amount, fraud)``"""
    return [
        (i, None if s is None else START + timedelta(seconds=s), c, t, a, s and int(s), 0, f, 0)
        for i, s, c, t, a, f in rows
    ]


def tx_frame(spark, *rows):
    return spark.createDataFrame(tx_rows(*rows), TRANSACTION_SCHEMA)


def by_id(df, *columns):
    return {r["transaction_id"]: tuple(r[c] for c in columns) for r in df.collect()}


def close(a, b):
    if a is None or b is None:
        return a is b
    return a == pytest.approx(b, rel=1e-9, abs=1e-9)


def plan(df, final=False):
    if final:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
