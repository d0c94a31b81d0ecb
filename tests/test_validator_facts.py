"""What rules ask of a document is worked out once for it, outside of lambdas."""

import json

from pyspark.sql import functions as F

from tallymart.operators import validators


def test_rules_read_columns(spark):
    """One lambda over the document used to hold all rules, and Spark interprets lambdas: each value was taken in one of its own."""
    doc = spark.createDataFrame([("a", "{}")], "id string, json string").select("id", F.parse_json("json").alias("doc"))
    for rules in validators.KINDS.values():
        plan = validators.validated(doc, rules)._jdf.queryExecution().optimizedPlan()
        told = plan.expressions().mkString(" ")
        assert "schema_of" not in told.split("transform(")[0].lower() and "try_variant_get(doc" not in told


def test_as_in_one_column(spark):
    """The facts of documents and the rules over one VARIANT column say the same, whatever the values are."""
    odd = [None, 1, 1.5, True, "", " x", "MATCHED", "IMPORT", "UNMATCHED", "REJECTED", "a" * 24, "2024-01-01T00:00:00Z", [], ["A_B"], [1], [{}], {}, {"en": "x"}, {"en": 1, "zz": 2}]
    fields = ["matchStatus", "matchMethod", "isActive", "confidence", "evidence", "canonicalItemId", "restaurantGroupId", "supersededAt", "platform", "note", "decidedAt", "name"]
    docs = [{f: v, "matchStatus" if f != "matchStatus" else "platform": "MATCHED", "evidence" if f != "evidence" else "note": {"nameScore": v, "reasons": v, "conflicts": []}} for f in fields for v in odd] + [1, None, [], "x"]
    rows = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "id int, json string").select("id", F.parse_json("json").alias("doc"), F.lit(0).alias("_fact_0"))
    for kind in ("item_mapping", "group"):
        rules = validators.KINDS[kind]
        got = {r.id: r.issues for r in validators.validated(rows, rules).collect()}
        want = {r.id: r.issues for r in rows.select("id", validators.issues(F.col("doc"), rules).alias("issues")).collect()}
        assert got == want and sum(map(len, want.values())) > 1000
    assert validators.validated(rows, rules).columns == ["id", "doc", "_fact_0", "issues"]
