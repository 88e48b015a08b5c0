"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from quartermet.plans import registered
from tests.conftest import SF_SMALL
from tools import check_sql

ALL = sorted(registered.queries())


@pytest.fixture(scope="module")
def duck():
    return check_sql.duck(SF_SMALL)


def test_every_query_has_sql():
    assert sorted(registered.sql()) == ALL


@pytest.mark.parametrize("name", ALL)
def test_query(spark, duck, name):
    said = check_sql.compare(spark, duck, name, SF_SMALL)
    assert said.startswith("ok") and "TYPES" not in said, said


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "temp_mean_c" in df.columns
