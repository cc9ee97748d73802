"""The registered queries that SQL can express, against DuckDB on whole given tables."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from oracle_check import actual, connect, expected  # noqa: E402

from keytide.llm.oracle import ORACLE  # noqa: E402
from keytide.llm.queries import QUERIES  # noqa: E402


@pytest.mark.parametrize("name", list(ORACLE))
def test_query(spark, sf_dir, name):
    assert actual(QUERIES[name](spark, sf_dir)) == expected(connect(sf_dir), ORACLE[name])
