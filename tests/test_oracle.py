"""Every registered deterministic query equals its DuckDB twin (sf0.001, fast)."""
import os

import pytest

from oracle_harness import run

pytestmark = pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test data absent")


def test_every_twin_matches(spark):
    """Exactly the names of the twins, each equal in rows, columns, types and values."""
    from vigilo.plans.oracle import SQL
    res = run("/root/testdata/sf0.001", set(SQL), verbose=False)
    assert {k: v for k, v in res.items() if v[0] != "OK"} == {}
    assert set(res) == set(SQL) and len(SQL) >= 89
