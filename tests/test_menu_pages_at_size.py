"""Pages are made and searched once, whatever is read off them."""

from tallymart.plans import catalog


def test_pages_are_made_once(spark, sf_dir):
    """Each table that a query joined used to make the pages again from lineitem, and met others by broadcasts."""
    plan = catalog.queries()["menu_page_restaurants"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan and "l_suppkey" not in plan and "BroadcastExchange" not in plan
