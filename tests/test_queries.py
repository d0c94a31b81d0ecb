"""Every registered query outside the llm folder against its SQL on the smallest tables."""

import duckdb
import pytest

from tallymart.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return [columns[i] for i in order], sorted(tuple(f"{r[i]:.9g}" if isinstance(r[i], float) else str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_equals_sql(spark, sf_dir, duck, name):
    df = catalog.queries()[name](spark, sf_dir)
    found = duck.execute(catalog.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    assert plain([tuple(r) for r in df.collect()], df.columns) == plain(found.fetchall(), columns)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
