"""Rank recurrences with real exchanges: several buckets give what one bucket gives."""

import pytest

from rankloom.operators import rank as R
from rankloom.sources.tables import lineitem_readings, part_follow_graph
from rankloom.operators import series as S
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("preset", ["total", "list", "matrix_row", "matrix_col", "unnormalised_phantom"])
def test_many_buckets_agree_with_one(spark, preset):
    g = part_follow_graph(spark, SF_SMALL)
    one, many = (
        {r["node"]: r["rank_n"] for r in R.scaled_ranks(g, R.PRESETS[preset].with_(iterations=3), buckets=b).collect()} for b in (1, 5)
    )
    assert one.keys() == many.keys() and all(abs(one[n] - many[n]) < 2e-9 for n in one)


def test_flag_filter_reaches_the_scan(spark):
    df = S.yearly_means(lineitem_readings(spark, SF_SMALL))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(l_returnflag, [A,R])]" in plan
