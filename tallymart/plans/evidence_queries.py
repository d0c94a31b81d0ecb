"""Query on the evidence for menu items: cases written out with what is expected of them, dealt to parts by key."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymart.operators import item_evidence
from tallymart.plans.catalog import register
from tallymart.plans.menu_queries import _column, _expected
from tallymart.sources.tables import table

SIDE = "name_en string, name_ar string, alias string, description_en string, description_ar string, category_en string, category_ar string, image string"
GROUPS = "array<struct<en: string, ar: string, required: boolean, least: int, most: int, options_en: array<string>, options_ar: array<string>>>"


def _side(name=None, ar=None, alias=None, description=None, category=None, image=None, modifiers=None):
    return (name, ar, alias, description, None, category, None, image, modifiers)


def _size(most, options=("small", "large")):
    return [("size", None, True, 1, most, list(options), None)]


#: source, candidate, platforms that the candidate is mapped on; confidence, method, status, conflicts
CASES = [
    (_side("Chicken Biryani", category="Rice"), _side("chicken  biryani", category="rice"), [], 0.6, "EXACT_NORMALIZED", "REVIEW", ""),
    (_side("Chicken Biryani", category="Rice", description="with raita"), _side("Chicken Biryani", category="Rice", description="With Raita!"), [], 0.8, "EXACT_NORMALIZED", "MATCHED", ""),
    (_side("Plain Dosa (2 Pcs)", description="crisp", category="Dosa"), _side("Plain Dosa (4 Pcs)", description="crisp", category="Dosa"), [], 0.45, "NAME_DESCRIPTION", "REVIEW", "QUANTITY_MISMATCH"),
    (_side("Pizza 12 inch"), _side("Pizza 2 pcs"), [], 0.45, "EXACT_NORMALIZED", "UNMATCHED", "UNIT_MISMATCH"),
    (_side("Chicken Tikka Rice", category="Grill"), _side("Chicken Rice", category="Rice"), [], 0.27, "EXACT_NORMALIZED", "UNMATCHED", "CATEGORY_DIFFERENT"),
    (_side("Lamb Chops"), _side("Grilled Lamb", alias="lamb chops"), [], 0.5, "EXACT_NORMALIZED", "REVIEW", ""),
    (_side("Latte", image="https://a.b/x.jpg?w=1", modifiers=_size(1)), _side("Latte", image="http://A.b/x.jpg", modifiers=_size(2)), [], 0.67, "MODIFIER", "REVIEW", "MODIFIER_LIMITS_DIFFER"),
    (_side("Latte", modifiers=_size(1)), _side("Latte", modifiers=_size(1, ["oat", "soy"])), [], 0.525, "MODIFIER", "REVIEW", "MODIFIER_OPTIONS_DIFFER"),
    (_side("Cola 330ml", category="Drinks"), _side("Cola", category="Drinks"), [], 0.45, "NAME_CATEGORY", "REVIEW", "VARIANT_ONLY_ONE_SIDE"),
    (_side("Cola 330 ml", category="Drinks", description="cold"), _side("Cola 330ml", category="Drinks", description="cold"), [], 0.75, "VARIANT", "MATCHED", ""),
    (_side("Chicken Biryani", category="Rice", description="with raita"), _side("Chicken Biryani", category="Rice", description="with raita"), ["p"], 0.8, "EXACT_NORMALIZED", "REVIEW", "PLATFORM_ALREADY_MAPPED"),
    (_side(None), _side(None), [], 0.0, "EXACT_NORMALIZED", "UNMATCHED", ""),
    (_side(None, ar="دجاج"), _side("Chicken", ar="دجاج"), [], 0.5, "EXACT_NORMALIZED", "REVIEW", ""),
]


@register("item_evidence", _expected(confidence=_column(CASES, 3), method=_column(CASES, 4), status=_column(CASES, 5), conflicts=_column(CASES, 6)))
def evidence(spark, sf):
    """E12-E18."""
    schema = ", ".join(["at int", *[f"{p}{x}" for p in ("s_", "c_") for x in [*SIDE.split(", "), f"modifiers {GROUPS}"]], "c_platforms array<string>"])
    cases = spark.createDataFrame([(i, *s, *k, on) for i, (s, k, on, *_) in enumerate(CASES)], schema)
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), (F.col("p_partkey") % len(CASES)).cast("int").alias("at"))
    both = F.broadcast(item_evidence.prepared(item_evidence.prepared(cases, "s_"), "c_"))  # a row for each case above
    pairs = parts.join(both, "at").withColumns({"item": F.col("id"), "canonical": F.col("id"), "s_platform": F.lit("p")})
    scores = item_evidence.scored(pairs)
    status = item_evidence.decided(parts, scores).select("item", "status")
    return scores.join(status, "item").select(F.col("item").alias("id"), "confidence", "method", "status", F.array_join("conflicts", ",").alias("conflicts"))
