from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from keytide.session import drop_scratch, local_session, scratch_namespace  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"

# The sample pairs.
PAIRS = [
    (1, "One"),
    (5, "Five"),
    (6, "Six"),
    (7, "Seven"),
    (9, "Nine"),
    (10, "Ten"),
    (12, "Twelve"),
    (16, "Sixteen"),
    (19, "Nineteen"),
]

# The sample readings, time in UTC and value.
READINGS = [
    ("2015-03-30 08:50:11", "89.0 F"),
    ("2015-03-30 08:50:12", "89.0 F"),
    ("2015-03-30 08:50:13", "89.1 F"),
    ("2015-03-30 08:50:14", "89.1 F"),
    ("2015-03-30 08:50:15", "89.2 F"),
    ("2015-03-30 08:50:16", "89.1 F"),
    ("2015-03-30 08:50:17", "89.2 F"),
    ("2015-03-30 08:50:18", "89.3 F"),
    ("2015-03-30 08:50:19", "89.3 F"),
    ("2015-03-30 08:50:20", "89.2 F"),
    ("2015-03-30 08:50:21", "89.3 F"),
    ("2015-03-30 08:50:22", "89.3 F"),
    ("2015-03-30 08:50:23", "89.5 F"),
    ("2015-03-30 08:50:24", "89.5 F"),
    ("2015-03-30 08:50:25", "89.8 F"),
    ("2015-03-30 08:50:26", "89.6 F"),
    ("2015-03-30 08:50:27", "89.9 F"),
    ("2015-03-30 08:50:28", "99.0 F"),
    ("2015-03-30 08:50:29", "89.6 F"),
    ("2015-03-30 08:50:30", "89.7 F"),
    ("2015-03-30 08:50:31", "89.7 F"),
]


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=4, app="keytide-tests")
    session.sparkContext.setLogLevel("OFF")
    yield session
    drop_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def namespace(spark):
    return scratch_namespace(spark, "test")


@pytest.fixture(params=["UTC", "America/Los_Angeles"])
def zone(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)
