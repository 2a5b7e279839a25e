import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cohortlift.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__driver__memory="6g", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__sql__warehouse__dir="/tmp/cohortlift-warehouse")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def star(spark):
    from verification.adapter import TestStar

    return TestStar(spark, "/root/testdata/sf0.001")


TXN = ("customer_sk bigint, txn_date date, txn_type string, direction string, channel string, mcc_category string, "
       "merchant_sk bigint, amount_gel decimal(12,2)")


@pytest.fixture(scope="session")
def txn_of(spark):
    """Transactions from (customer, day, type, channel, category, merchant, amount) tuples."""
    import datetime as dt
    from decimal import Decimal

    def build(rows):
        return spark.createDataFrame([
            (c, dt.date.fromisoformat(d), t, "credit" if t == "inflow" else "debit", ch, cat, m, Decimal(str(a)))
            for c, d, t, ch, cat, m, a in rows], TXN)
    return build


def by_key(df, key="customer_sk"):
    return {r[key]: r.asDict() for r in df.collect()}
