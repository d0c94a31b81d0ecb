"""Pages and what is found in them meet by sorted joins, and what is read more than once is worked out once."""

import pytest

from tallymart.plans import catalog
from tallymart.sources import product_pages


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["carrefour_pages", "second_shop_pages"])
def test_pages_are_not_broadcast(spark, sf_dir, name):
    """The first had 29 broadcasts, the second 70, each of as many rows as there are pages."""
    assert "BroadcastExchange" not in plan(catalog.queries()[name](spark, sf_dir))


def test_ends_without_pairs_of_tags(spark):
    """Each of many equal elements met every closing tag after it."""
    html = "<ul>" + "<li>x</li>" * 3000 + "</ul>"
    stream = product_pages.tag_stream(spark.createDataFrame([(1, html)], "page_id long, html string"))
    assert "Join" not in plan(stream)
    assert all(r.end == r.at + 2 for r in stream.where("name = 'li' AND NOT closes").collect())
