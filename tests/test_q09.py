"""The top tenth of the orders without sorting them, against a plain sort."""

import random
from decimal import Decimal

import pytest

from conftest import SF_SMALL
from ledgerline.operators import queries as Q
from ledgerline.plans.lineage import cut
from ledgerline.sources.fact import order_totals


def orders(spark, rows):
    return cut(spark.createDataFrame([(i, Decimal(s), Decimal(p)) for i, s, p in rows], "order_id long, os decimal(18,2), op decimal(18,4)"))


@pytest.mark.parametrize("n", [0, 1, 9, 10, 11, 237])
@pytest.mark.parametrize("values", [1, 4, 1000])
def test_top_tenth_as_a_sort(spark, n, values):
    """Ties at the border of any number, down to all orders alike."""
    rng = random.Random(n * values)
    rows = [(i * 7 % 1009, rng.randrange(values) + 1, rng.randrange(-5, 5)) for i in range(n)]
    top = sorted(rows, key=lambda r: (-r[1], r[0]))[:-(-n // 10)]
    df = orders(spark, rows)
    assert sorted(r["order_id"] for r in df.where(Q.in_top_tenth(df)).collect()) == sorted(r[0] for r in top)
    got = [r["order_id"] for r in Q.top_losses(df, 0.1, 3).collect()]
    assert got == [r[0] for r in top if r[2] < 0.1 * r[1]][:3]


def test_totals_keep_no_text_and_sort_nothing(spark):
    plan = order_totals(spark, SF_SMALL, [], ["sales", "profit", "shipping_cost", "quantity"])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Window" not in plan and "rangepartitioning" not in plan


def test_from_lines_and_from_totals_alike(spark):
    from ledgerline.plans.registry import queries
    from ledgerline.sources.fact import order_lines
    lines = order_lines(spark, SF_SMALL)
    assert Q.q09_loss_in_top_decile(lines, 0.4).collect() == queries()["q09_loss_in_top_decile"](spark, SF_SMALL).collect()
