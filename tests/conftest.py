import sys
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402

from parcelwise.params import Params  # noqa: E402
from parcelwise.plans.warehouse import Warehouse  # noqa: E402
from parcelwise.session import configured  # noqa: E402
from parcelwise.sources.layout import TABLES, schema_of  # noqa: E402
from parcelwise.sources.scratch import Scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = configured(
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def ts(text):
    return None if text is None else datetime.fromisoformat(text)


def order(oid, cid, status="delivered", bought="2018-01-10 10:00:00", approved=None,
          handed=None, arrived=None, promised="2018-01-20 00:00:00"):
    return (oid, cid, status, ts(bought), ts(approved), ts(handed), ts(arrived), ts(promised))


def money(x):
    return Decimal(x).quantize(Decimal("0.01"))


# Small tables holding the edge rows; one line per edge.
RAW = {
    "orders": [
        # delivered at 23:00 on the promised day; 70 minutes to approval crosses two hours
        order("o1", "c1", bought="2018-01-10 10:50:00", approved="2018-01-10 12:00:00",
              handed="2018-01-12 09:00:00", arrived="2018-01-20 23:00:00"),
        # one day late, handed over before approval
        order("o2", "c2", approved="2018-01-13 10:00:00", handed="2018-01-12 10:00:00",
              arrived="2018-01-21 01:00:00"),
        # delivered without a timestamp
        order("o3", "c3", bought="2018-02-01 08:00:00"),
        # canceled with a timestamp
        order("o4", "c4", " Canceled ", bought="2018-02-02 08:00:00",
              arrived="2018-02-05 08:00:00"),
        # delivered before purchase
        order("o5", "c5", bought="2018-03-01 08:00:00", arrived="2018-02-28 08:00:00",
              promised="2018-03-20 00:00:00"),
        # no items at all
        order("o6", "c6", "shipped", bought="2018-03-02 08:00:00"),
        # outside the calendar
        order("o7", "c7", bought="2020-01-01 00:00:00", arrived="2020-01-30 00:00:00",
              promised="2020-01-10 00:00:00"),
    ],
    "order_items": [
        ("o1", 1, "p1", "s2", ts("2018-01-12 00:00:00"), money(10), money(1)),
        ("o1", 2, "p1", "s1", ts("2018-01-13 00:00:00"), money(6), money(1)),
        ("o1", 3, "p2", "s1", ts("2018-01-11 00:00:00"), money(4), money(1)),
        ("o2", 1, "p2", "s1", None, money(100), money("0.05")),
        ("o3", 1, "p3", "s3", None, money(7), money(0)),
        ("o4", 1, "p1", "s1", None, money(1), money(1)),
        ("o5", 1, "p1", "s1", None, money(50), money(2)),
        ("o7", 1, "p9", "s9", None, money(30), money(3)),
    ],
    "order_payments": [
        ("o1", 1, " Voucher ", 1, money("11.50")),
        ("o1", 2, "boleto", 3, money("11.50")),
        ("o2", 1, "credit_card", 2, money("100.05")),
        ("o3", 1, "credit_card", 1, money("9.00")),
    ],
    "order_reviews": [
        ("r2", "o1", 5, None, "good", ts("2018-01-25 00:00:00"), None),
        ("r1", "o1", 3, None, "  ", ts("2018-01-25 00:00:00"), None),
        ("r0", "o1", 1, None, None, ts("2018-01-21 00:00:00"), None),
        ("r1", "o1", 3, None, "  ", ts("2018-01-25 00:00:00"), None),  # exact copy
        ("r3", "o2", 1, None, "late", ts("2018-01-25 00:00:00"), None),
    ],
    "customers": [
        ("c1", "anna", 100, " são paulo ", "sp"),
        ("c2", "anna", 200, "rio", "RJ"),
        ("c3", "bela", 100, "sao paulo", "SP"),
        ("c4", "only canceled", 100, "x", "XX"),
        ("c5", "carl", None, None, None),
        ("c6", "carl", 300, "recife", "PE"),
        ("c7", "dora", 100, "sp", "SP"),
    ],
    "products": [
        ("p1", " Beleza_Saude ", 10, 20, 1, 499, 2, 3, 4),
        ("p2", "untranslated", 10, 20, 1, 500, 2, 3, None),
        ("p3", None, None, None, None, None, None, None, None),
        ("p4", "beleza_saude", 1, 1, 1, 10000, 1, 1, 1),
    ],
    "sellers": [("s1", 100, "campinas", "sp "), ("s2", 200, "niteroi", "RJ"),
                ("s3", 999, "y", "ZZ")],
    "geolocation": [
        (100, -23.5, -46.6, "sao paulo", "sp"), (100, -23.4, -46.5, "Sao Paulo", "SP"),
        (100, 45.0, 9.0, "são paulo", "SP"), (200, -22.9, -43.2, "rio", "RJ"),
        (None, 0.0, 0.0, "nowhere", "SP"),
    ],
    "product_category_translation": [("beleza_saude", "Health_Beauty ")],
}


@pytest.fixture(scope="session")
def raw(spark):
    return {t: spark.createDataFrame(RAW[t], schema_of(t)) for t in TABLES}


@pytest.fixture(scope="session")
def shop(spark, raw):
    """Warehouse over the edge rows."""
    params = Params(calendar_end=Params.calendar_end, min_orders=2, min_month_orders=2)
    return Warehouse(spark, {t: (lambda df=df: df) for t, df in raw.items()}, params,
                     Scratch(spark, "test"))


def rows_by(df, key):
    return {r[key]: r for r in df.collect()}
