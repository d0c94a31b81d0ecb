"""Menus are parsed once, and the quick ways to texts give what the plain patterns give."""

import pytest
from pyspark.sql import functions as F

from tallymart.functions.item_text import BIDI
from tallymart.plans import catalog
from tallymart.sources import menu_pages


@pytest.mark.parametrize("query", ["menu_page_items", "menu_page_stats", "menu_page_warnings"])
def test_menus_are_parsed_once(spark, sf_dir, query):
    """Each table used to parse the pages' states again; items were dealt anew for categories, for options and for places."""
    plan = catalog.queries()[query](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "parsejson" not in plan.replace("_", "").lower() and "description" not in plan.lower()


def test_items_are_dealt_once(spark, sf_dir):
    plan = catalog.queries()["menu_page_items"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1 and "Join" not in plan


def test_states(spark):
    tag = '<script id="__NEXT_DATA__" type="x">'
    pages = [
        f"<html>{tag}{{1}}</script>{tag}{{2}}</script>", f"{tag}{{1}}</SCRIPT> <script>3</script>", f"{tag}a</b>c</script>", f"{tag}never closed", "no script", "", None, f"{tag}</script>", f"a{tag}x{tag}y</script>",
        '<SCRIPT data-x id="__next_data__">Ä\nß</script>', f"é漢𝄞{tag}é漢𝄞</script>é", "<script id=\"__NEXT_DATA__\"\n>q</sCript></script>",
    ]
    df = spark.createDataFrame([(p,) for p in pages], "html string")
    got = df.select(menu_pages.state_text(F.col("html")).alias("a"), F.regexp_extract("html", menu_pages.STATE, 1).alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got]


def test_clean_texts(spark):
    texts = ["a b", " a", "a ", "a  b", "a\tb", "a\n", "‎a‏", "‎", "  ", "", None, "a b ", "a  ", "a  b", "x" * 50, "⁦ a ⁩  b"]
    df = spark.createDataFrame([(x,) for x in texts], "t string")
    plain = F.nullif(F.trim(F.regexp_replace(F.regexp_replace("t", BIDI, ""), "\\s+", " ")), F.lit(""))
    got = df.select(menu_pages.clean(F.col("t")).alias("a"), plain.alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got]


def test_values_are_written_whole_and_the_setting_is_put_back(spark):
    was = spark.conf.get("spark.sql.variant.writeShredding.enabled")
    pages = menu_pages.MenuPages(spark.createDataFrame([(1, "en", '<script id="__NEXT_DATA__">{"props":{"initialState":{"menuPage":{"menu":{"metas":{"root":{"items":[]}}}}}}}</script>')], "page_id int, locale string, html string"))
    assert spark.conf.get("spark.sql.variant.writeShredding.enabled") == was
    assert pages.stats.collect()[0].items_seen == 0 and pages.pages.select(F.col("v").cast("string")).collect()[0][0].startswith("{")
