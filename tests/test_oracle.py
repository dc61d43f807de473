"""Every registered query against its SQL, on the smallest driver tables."""

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

from check_oracle import compare, duck_connection  # noqa: E402

from tidings.catalog import SPARK, SQL  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables are absent")


@pytest.fixture(scope="module")
def duck():
    return duck_connection(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    note, ok = compare(spark, duck, FOLDER, name, SPARK[name], SQL[name])
    assert ok, note


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(SQL) <= set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
