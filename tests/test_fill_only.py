"""The merge of all parts has a row for every part."""

from tallymart.plans import catalog


def test_every_part_is_merged(spark, sf_dir):
    ids = sorted(r.p_partkey for r in spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey").collect())
    got = catalog.queries()["fill_only_merge_all_parts"](spark, sf_dir).collect()
    assert sorted(r.id for r in got) == ids and {r.action for r in got} == {"created", "kept", "updated"}
