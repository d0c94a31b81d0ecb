"""A quota bounds the pairs that are made and the rounds that are taken, whatever the number of candidates."""

from tallymart.operators import batch_selection
from tests.test_batch_selection import SCHEMA, chosen, one_by_one


def test_pairs_follow_the_quota(spark, tmp_path):
    """Every candidate of one brand met every one of the other platform: 250,000 pairs here, in 500 rounds."""
    rows = [(f"{p}{i:04d}", p, "b", ["a"], i % 50, None) for p in "dt" for i in range(500)]
    df = spark.createDataFrame(rows, SCHEMA)
    folder = f"{tmp_path}/selection"
    found = batch_selection.selected(df, {"d": 3, "t": 4}, ("d", "t"), 1, 2, folder)
    assert chosen(found) == one_by_one([r.asDict() for r in df.collect()], {"d": 3, "t": 4}, ("d", "t"), 1, 2)
    assert spark.read.parquet(f"{folder}/edges").count() == 9
