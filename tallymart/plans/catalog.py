"""Registry of the reference-side queries: each module adds name -> (query, SQL)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_QUERIES: dict = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: `fn(spark, sf_dir)` becomes the query `name`, with its SQL if there is one."""

    def put(fn):
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn

    return put


def _all() -> None:
    from tallymart.plans import decision_queries, evidence_queries, grocery_queries, identity_queries, match_queries, menu_page_queries, menu_queries, merge_queries, offer_queries, page_queries, product_page_queries, product_queries, ranking_queries, run_queries, shop_page_queries, stat_queries, text_queries, upkeep_queries, validation_queries  # noqa: F401  (they register themselves)


def queries() -> dict:
    _all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _all()
    return dict(_SQL)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries()["price_range_derived"](spark, sf_dir)
