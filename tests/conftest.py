from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from tallyline import pipeline  # noqa: E402
from tallyline.contracts import RAW_SCHEMA  # noqa: E402
from tallyline.session import local_session  # noqa: E402

UK = "United Kingdom"


def at(text: str | None) -> datetime | None:
    return None if text is None else datetime.fromisoformat(text)


def raw_frame(spark, rows, schema=None):
    """Raw lines from (invoice, code, text, quantity, date, price, customer, country)."""
    typed = [(i, s, d, q, at(t), p, None if c is None else float(c), g) for i, s, d, q, t, p, c, g in rows]
    loose = schema or RAW_SCHEMA
    for field in loose.fields:
        field.nullable = True
    return spark.createDataFrame(typed, loose)


# Lines of an invented shop: each table holds the cases that its tests ask about.
PROFILE_ROWS = [
    ("840001", "71001", "MUG", 12, "2012-09-03", 1.25, 801, UK),
    ("840001", "71001", "MUG", 12, "2012-09-03", 1.25, 801, UK),
    ("840001", "71002", "PLATE", 4, "2012-09-03", 2.75, 801, UK),
    ("840002", "71003", None, 7, "2012-09-05", 0.0, None, "Italy"),
    ("C840003", "71001", "MUG", -2, "2012-09-10", 1.25, 802, "Italy"),
    ("840004", "71004", "BOWL", -3, "2012-09-11", 4.0, 803, UK),
    ("840005", "71002", "PLATE", 1, "2012-09-15", 2.75, None, "Malta"),
    ("840006", "71005", "JUG", 2, "2012-09-18", 6.0, 804, "Malta"),
    ("840007", "71001", "MUG", 3, "2012-09-21", 1.25, 802, UK),
]
CLASS_ROWS = [
    ("850001", "72001", "SCARF", 3, "2012-10-01", 4.0, 901, UK),
    ("850001", "72001", "SCARF", 3, "2012-10-01", 4.0, 901, UK),
    ("850002", "POST", "CARRIAGE", 1, "2012-10-02", 6.5, 902, UK),
    ("850003", "72002", "GLOVES", 2, "2012-10-03", 7.25, None, UK),
    ("C850004", "72001", "SCARF", -1, "2012-10-04", 4.0, 901, UK),
    ("C850005", "72002", "GLOVES", 1, "2012-10-05", 7.25, 903, "Italy"),
    ("850006", "72003", "HAT", -6, "2012-10-06", 0.0, None, "Malta"),
    ("850007", "72004", None, 5, "2012-10-07", 0.0, None, "Italy"),
    ("X850008", "72005", "CORRECTION", 1, "2012-10-08", 33.0, None, UK),
    ("850009", "72006", "BELT", 0, "2012-10-09", 9.0, 904, UK),
    ("850010", "72007", "TIE", 1, None, 8.5, 905, UK),
]
SALES_ROWS = [
    ("810101", "51010", "CLAY POT", 4, "2013-06-01 08:15", 3.0, 11, "Ireland"),
    ("810101", "51020", "SEED TRAY", 10, "2013-06-01 08:15", 1.5, 11, "Ireland"),
    ("810102", "51010", "CLAY POT", 2, "2013-06-08 12:40", 3.0, 12, "Spain"),
    ("810103", "51030", "HOSE", 1, "2013-06-17 16:05", 20.0, 12, "Spain"),
    ("810104", "51020", "SEED TRAY", 6, "2013-07-03 10:00", 1.5, 13, "Ireland"),
    ("810104", "51020", "SEED TRAY", 6, "2013-07-03 10:00", 1.5, 13, "Ireland"),
    ("810105", "51010", "CLAY POT", 6, "2013-07-09 09:30", 3.0, 11, "Ireland"),
    ("C810106", "51030", "HOSE", -1, "2013-07-11 11:11", 20.0, 12, "Spain"),
]
PUBLIC_ROWS = [
    ("830501", "62001", "DESK LAMP", 2, "2014-02-01 09:00", 12.0, 501, UK),
    ("830502", "62002", "WALL CLOCK", 1, "2014-02-14 10:30", 18.0, 502, "Norway"),
    ("830503", "62001", "DESK LAMP", 1, "2014-03-03 15:20", 12.0, 503, UK),
    ("C830504", "62002", "WALL CLOCK", -1, "2014-03-05 08:45", 18.0, 502, "Norway"),
    ("830505", "POST", "CARRIAGE", 1, "2014-03-09 13:10", 7.5, 501, UK),
    ("B830506", "M", "MANUAL CHARGE", 2, "2014-03-20 17:00", 11.0, None, "Norway"),
]


@pytest.fixture(scope="session")
def spark():
    return local_session(4, "tallyline-tests", partitions=4)


@pytest.fixture(scope="session")
def profile_raw(spark):
    return raw_frame(spark, PROFILE_ROWS).cache()


@pytest.fixture(scope="session")
def class_raw(spark):
    return raw_frame(spark, CLASS_ROWS).cache()


def load(spark, rows, folder):
    return pipeline.run(spark, lambda: raw_frame(spark, rows), str(folder))


@pytest.fixture(scope="session")
def sales_tables(spark, tmp_path_factory):
    return load(spark, SALES_ROWS, tmp_path_factory.mktemp("sales"))


@pytest.fixture(scope="session")
def public_tables(spark, tmp_path_factory):
    return load(spark, PUBLIC_ROWS, tmp_path_factory.mktemp("public"))


def rows_of(df, key=None):
    collected = [r.asDict() for r in df.collect()]
    return {r[key]: r for r in collected} if key else collected


